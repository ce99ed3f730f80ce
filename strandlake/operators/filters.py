"""Row filters over the covered cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remove_uncovered(row_data: DataFrame, assay: DataFrame) -> DataFrame:
    """Sites that some sample covers."""
    return row_data.join(assay.select("cpg_idx").distinct(), "cpg_idx", "left_semi")


def coverage_filter(row_data: DataFrame, assay: DataFrame, threshold: int, min_samples: int, n_samples: int) -> DataFrame:
    """Every site with ``kept``: at least ``min_samples`` samples cover it with
    ``threshold`` reads. A threshold of 0 counts every sample."""
    if threshold <= 0:
        return row_data.select("cpg_idx", F.lit(n_samples >= min_samples).alias("kept"))
    counts = assay.groupBy("cpg_idx").agg(F.count_if(F.col("cov") >= threshold).alias("n"))
    return row_data.select("cpg_idx").join(counts, "cpg_idx", "left").select("cpg_idx", (F.coalesce("n", F.lit(0)) >= min_samples).alias("kept"))
