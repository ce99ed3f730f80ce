"""Coverage statistics per sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import THRESHOLDS
from ..functions.columns import f32_ratio


def coverage_stats(assay: DataFrame, col_data: DataFrame, n_total: int | DataFrame, thresholds: tuple[int, ...] = THRESHOLDS) -> DataFrame:
    """``sample_id, n_total, n_covered, mean_coverage`` (over covered sites)
    and ``n_ge_t`` for each threshold, in one pass. Samples without a covered
    site are listed with zeros. ``n_total``: a number, or a one-row frame."""
    counted = assay.groupBy("sample_idx").agg(F.count("*").alias("n_covered"), F.sum("cov").alias("reads"), *[F.count_if(F.col("cov") >= t).alias(f"n_ge_{t}") for t in thresholds])
    joined = col_data.select("sample_idx", "sample_id").join(counted, "sample_idx", "left")
    if isinstance(n_total, DataFrame):
        joined = joined.join(F.broadcast(n_total.select(F.col(n_total.columns[0]).cast("long").alias("n_total"))), how="cross")  # one row by contract
    else:
        joined = joined.withColumn("n_total", F.lit(n_total).cast("long"))
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    mean = F.when(F.col("n_covered") > 0, f32_ratio(F.col("reads"), F.col("n_covered"))).otherwise(F.lit(0.0).cast("float"))
    return joined.select("sample_id", "n_total", zero("n_covered"), mean.alias("mean_coverage"), *[zero(f"n_ge_{t}") for t in thresholds])


def coverage_distribution(assay: DataFrame, thresholds: tuple[int, ...] = THRESHOLDS) -> DataFrame:
    """``threshold, n_cells``: covered cells that reach each threshold."""
    one = assay.agg(*[F.count_if(F.col("cov") >= t).alias(f"t{t}") for t in thresholds])
    pairs = F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"t{t}").alias("n_cells")) for t in thresholds])
    return one.select(F.inline(pairs))
