"""From what a user names to a site universe."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from ..contracts import FASTA_SUFFIXES, Reference, ReferenceError_
from ..sinks.files import exists, is_directory, output_file
from . import fasta, ron


def is_fasta(path: str) -> bool:
    return path.removesuffix(".gz").endswith(FASTA_SUFFIXES)


def save_reference(reference: Reference, path: str) -> None:
    """Parquet tables and the release name: the native form of sites."""
    reference.sites.write.mode("overwrite").parquet(f"{path}/sites")
    reference.contigs.write.mode("overwrite").parquet(f"{path}/contigs")
    with output_file(f"{path}/release.json", reference.sites.sparkSession) as f:
        f.write(json.dumps({"release_name": reference.release_name}).encode())


def load_reference(spark: SparkSession, path: str) -> Reference:
    name = json.loads(spark.read.text(f"{path}/release.json", wholetext=True).first()["value"])["release_name"]
    return Reference(spark.read.parquet(f"{path}/sites"), spark.read.parquet(f"{path}/contigs"), name)


def resolve_reference(spark: SparkSession, genome: str) -> Reference:
    """A site folder, a RON file, a FASTA file, or a name beside which
    ``<name>.ron`` lies."""
    if is_directory(spark, genome):
        return load_reference(spark, genome)
    if genome.lower().endswith(".ron"):
        return ron.read_sites(spark, genome)
    if exists(spark, genome):
        return fasta.extract_sites(spark, genome) if is_fasta(genome) else ron.read_sites(spark, genome)
    if exists(spark, f"{genome}.ron"):
        return ron.read_sites(spark, f"{genome}.ron")
    raise ReferenceError_(f"{genome}: no reference there; give a FASTA file or a site file")
