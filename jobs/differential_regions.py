"""Differentially methylated regions of two groups of samples, with their genes.

Reads the tables of a folder, aligns records to sites, compares the groups site
by site, joins neighbouring sites that differ the same way to regions, and names
the gene region that each one begins in. Writes two tables, partitioned by
contig:

    sites/    every site that both groups cover, with means, delta and t
    regions/  the regions

Each run writes both tables whole, so a rerun gives the same result, also after
a run that was broken off.

    spark-submit jobs/differential_regions.py --tables T --output O [--config F]
"""

from __future__ import annotations

import logging
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import command_line
from strandlake.contracts import EngineError
from strandlake.operators.align import align
from strandlake.operators.annotate import annotate
from strandlake.operators.assay import build_assay
from strandlake.operators.differential import differential_regions, site_differences
from strandlake.operators.genes import features, transcripts
from strandlake.plans.projection import Projection
from strandlake.sinks.files import discard, written

JOB = "differential_regions"
log = logging.getLogger(JOB)

#: No task sorts more of a contig than 16 Mi positions.
BLOCK_BITS = 24

SITES = "cpg_idx long, start long, end long, n_first long, n_second long, mean_first double, mean_second double, delta double, t double, contig_key string"
REGIONS = "start_1based long, end_1based long, direction string, n_sites long, mean_delta double, annotation string, gene_id string, gene_symbol string, distance_to_tss int, contig_key string"


def groups_of(samples: DataFrame, config: dict) -> DataFrame:
    """``sample_idx, grp``. A sample that is not there, or in both groups, is
    an error: a silent mistake in a name would change every number."""
    chosen = {**{s: 1 for s in config["first"]}, **{s: 2 for s in config["second"]}}
    if both := sorted(set(config["first"]) & set(config["second"])):
        raise EngineError(f"samples in both groups: {', '.join(both)}")
    known = {r["sample_id"]: r["sample_idx"] for r in samples.select("sample_id", "sample_idx").collect()}  # one row per sample
    if lost := sorted(set(chosen) - set(known)):
        raise EngineError(f"no such samples: {', '.join(lost)}")
    return samples.sparkSession.createDataFrame([(known[s], g) for s, g in chosen.items()], "sample_idx int, grp int")


def run(spark: SparkSession, tables: str, output: str, config: dict) -> DataFrame:
    """Both tables; returns the regions, read back."""
    p = Projection(spark, tables)
    sites, records = p.sites(), written(p.records(), "records")  # the one join and sum over all observations
    samples = p.samples_of(records)
    log.info("read %s: %d sites, %d observations", tables, sites.count(), p.raw["lineitem"].count())
    groups = groups_of(samples, config)
    assay = build_assay(align(records, sites).join(F.broadcast(samples.select("sample_id", "sample_idx")), "sample_id"), config["min_coverage"])  # one row per sample
    by_block = "contig_key", F.shiftright("start", BLOCK_BITS)
    compared = site_differences(assay, groups, config["min_samples"]).join(sites.select("cpg_idx", "contig_key", "start", "end"), "cpg_idx")
    compared.repartition(*by_block).sortWithinPartitions("contig_key", "start").write.mode("overwrite").partitionBy("contig_key").parquet(f"{output}/sites")
    discard(records)
    stored = spark.read.schema(SITES).parquet(f"{output}/sites")
    log.info("wrote %s/sites: %d sites that both groups cover", output, stored.count())
    found = written(differential_regions(sites, stored, config["min_delta"], config["max_gap"], config["min_sites"]), "regions")
    models = written(transcripts(p.gtf_rows()), "models")
    begun = written(sites.join(found.select(F.col("first_idx").alias("cpg_idx")), "cpg_idx", "left_semi"), "begun")
    named = annotate(begun, models, features(models)).select(F.col("cpg_idx").alias("first_idx"), "annotation", "gene_id", "gene_symbol", "distance_to_tss")
    way = F.when(F.col("direction") > 0, "gain").otherwise("loss")
    regions = found.join(named, "first_idx").select((F.col("start") + 1).alias("start_1based"), F.col("end").alias("end_1based"), way.alias("direction"), "n_sites", "mean_delta", "annotation", "gene_id", "gene_symbol", "distance_to_tss", "contig_key")
    regions.repartition("contig_key").sortWithinPartitions("contig_key", "start_1based").write.mode("overwrite").partitionBy("contig_key").parquet(f"{output}/regions")
    back = spark.read.schema(REGIONS).parquet(f"{output}/regions")
    for table in (found, begun, models):
        discard(table)
    log.info("wrote %s/regions: %d regions", output, back.count())
    return back


if __name__ == "__main__":
    command_line(JOB, __doc__, {"tables": "folder of the tables", "output": "folder to write to"}, run)
