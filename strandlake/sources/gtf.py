"""GTF gene models: discovery and rows. Rows that don't fit are skipped."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import U32_MAX, AnnotationError
from ..functions.columns import trimmed
from ..functions.names import genome_key
from ..sinks.files import is_directory, list_files


def find_gtf(spark: SparkSession, directory: str, genome: str) -> str:
    """The genome's file by name, else the only gene model there is."""
    key = genome_key(genome)
    found = [p for p in list_files(spark, directory) if p.endswith((".gtf", ".gtf.gz"))] if is_directory(spark, directory) else []
    for name in (f"{key}.gtf", f"{key}.gtf.gz"):
        for path in found:
            if os.path.basename(path) == name:
                return path
    if len(found) != 1:
        raise AnnotationError(f"{directory}: {'no gene model' if not found else 'several gene models'} for {key}")
    return found[0]


def attribute(attrs, key: str):
    """Value of an attribute: null where it is missing, the last of several;
    quotes cut. Entries are split at ";" and at their first space."""
    entries = F.transform(F.split(attrs, ";"), lambda x: F.trim(x))
    mine = F.filter(entries, lambda x: F.substring_index(x, " ", 1) == key)
    last = F.when(F.size(mine) > 0, F.element_at(mine, -1))
    return F.regexp_replace(F.trim(F.substr(last, F.lit(len(key) + 1))), '^"+|"+$', "")


def parse_gtf(lines: DataFrame) -> DataFrame:
    """``lines``: value, line_no. Rows of the gene model with 0-based
    half-open coordinates."""
    cut = lines.where("length(trim(value)) > 0 AND NOT startswith(value, '#')").withColumn("f", F.split(F.regexp_replace("value", "\r$", ""), "\t", -1)).where("size(f) = 9")
    number = lambda i: F.when(F.get("f", F.lit(i)).rlike(r"^\+?[0-9]{1,18}$"), F.regexp_replace(F.get("f", F.lit(i)), r"^\+", "").cast("long"))
    attrs = F.get("f", F.lit(8))
    parts = {
        "seqname": F.get("f", F.lit(0)),
        "feature": F.lower(F.get("f", F.lit(2))),
        "start1": number(3),
        "end": number(4),
        "strand": F.when(F.length(F.get("f", F.lit(6))) > 0, F.substring(F.get("f", F.lit(6)), 1, 1)).otherwise("+"),
        "tid": attribute(attrs, "transcript_id"),
        "gid": attribute(attrs, "gene_id"),
        "name": attribute(attrs, "gene_name"),
    }
    # a one-row generator, so that the filters below use the fields and don't repeat how they are parsed
    rows = cut.select("line_no", F.inline(F.array(F.struct(*[c.alias(k) for k, c in parts.items()]))))
    sound = rows.where(f"start1 IS NOT NULL AND end IS NOT NULL AND start1 <= {U32_MAX} AND end <= {U32_MAX} AND end >= start1")
    named = sound.select(trimmed(F.col("seqname")).alias("seqname"), "feature", F.greatest(F.col("start1") - 1, F.lit(0)).alias("start"), "end", "strand", F.coalesce("tid", "gid", F.lit("")).alias("transcript_id"), F.coalesce("gid", F.lit("")).alias("gene_id"), F.coalesce("name", "gid", F.lit("")).alias("gene_symbol"), "line_no")
    return named.where("transcript_id <> '' AND gene_id <> ''")


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """Rows of one file; ``line_no`` ascends with the file's lines. One task has
    to unpack a packed file; its lines are dealt to all tasks before they are
    parsed."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("line_no"))
    return parse_gtf(lines.repartition("line_no") if path.endswith(".gz") else lines)
