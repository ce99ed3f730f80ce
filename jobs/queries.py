"""The jobs as registered queries: each runs twice into one new folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandlake.plans.catalogue import _A5, _ANN, _with
from strandlake.plans.cohort_queries import DIFFERENTIAL_REGIONS, SITE_DIFFERENCES
from strandlake.sinks.files import scratch_path

from . import differential_regions, sequence_inventory
from .common import default_config


def job1_differential_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, config = scratch_path(spark, "job1"), default_config(differential_regions.JOB)
    differential_regions.run(spark, sf_dir, root, config)
    return differential_regions.run(spark, sf_dir, root, config)


def job2_sequence_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, config = scratch_path(spark, "job2"), default_config(sequence_inventory.JOB)
    for _ in range(2):
        found = sequence_inventory.run(spark, f"{sf_dir}/documents.parquet", f"{root}/out", f"{root}/state", config)
    return found.drop("batch")


QUERIES = {f.__name__: f for f in (job1_differential_regions, job2_sequence_inventory)}

_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LEFT = lambda drop: f"length(translate(seq, '{drop}', ''))"

ORACLES = {
    "job1_differential_regions": _with("""
        SELECT r.contig_key, r.start0 + 1 AS start_1based, r.end0 AS end_1based, CASE WHEN direction > 0 THEN 'gain' ELSE 'loss' END AS direction, n_sites, mean_delta,
               a.annotation, a.gene_id, a.gene_symbol, a.distance_to_tss
        FROM regions r JOIN annotation a ON a.cpg_idx = r.first_idx""", *_A5, SITE_DIFFERENCES, DIFFERENTIAL_REGIONS, *_ANN),
    "job2_sequence_inventory": f"""
        WITH s AS (SELECT doc_id AS record_id, source AS grp, translate(coalesce(text, ''), 'acgtunU' || {_SPACE}, 'ACGTTNT') AS seq FROM documents),
        c AS (SELECT record_id, grp, length(seq) AS n_bases, length(seq) - {_LEFT("C")} AS n_c, length(seq) - {_LEFT("G")} AS n_g,
                     (length(seq) - length(replace(seq, 'CG', ''))) // 2 AS n_cpg, {_LEFT("ACGTN")} AS n_other FROM s),
        r AS (SELECT *, CASE WHEN n_c * n_g > 0 THEN round(CAST(n_cpg * n_bases AS DOUBLE) / (n_c * n_g), 6) END AS cpg_ratio FROM c)
        SELECT *, coalesce(n_bases > 0 AND n_c + n_g >= 0.5 * n_bases AND cpg_ratio >= 0.6, false) AS island FROM r""",
}
