"""Assays: coverage and methylated fraction per site and sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import beta_value, checked_u32


def build_assay(aligned: DataFrame, min_coverage: int = 1, sample: str = "sample_idx") -> DataFrame:
    """Sums of both strands, then the coverage mask, then beta. ``aligned``
    has the column ``sample`` and ``cpg_idx, methylated, unmethylated``; records without a
    site are left out. A minimum of 0 means 1: uncovered cells don't exist.
    The strands of a cell come from different tasks, so records are shuffled as
    they are, not summed before it as well."""
    summed = aligned.where("cpg_idx IS NOT NULL").repartition("cpg_idx", sample).groupBy("cpg_idx", sample).agg(F.sum("methylated").alias("m"), F.sum("unmethylated").alias("u"))
    total = summed.withColumn("cov", checked_u32(F.col("m") + F.col("u"), "coverage"))
    return total.where((F.col("cov") >= min_coverage) & (F.col("cov") > 0)).select("cpg_idx", sample, "cov", beta_value(F.col("m"), F.col("cov")).alias("beta"))


def out_of_reach(records: DataFrame, min_coverage: int) -> bool:
    """Whether no cell can have the minimum, as far as records tell before they
    are aligned. A site has two positions (see ``probe_table``) and a sample
    one record of each, so no cell has more than twice the reads of the largest
    record. A minimum of 1 isn't worth a look."""
    if min_coverage <= 1:
        return False
    largest = records.agg(F.max(F.col("methylated") + F.col("unmethylated"))).first()[0]
    return 2 * (largest or 0) < min_coverage


def dense(assay: DataFrame, row_data: DataFrame, col_data: DataFrame) -> DataFrame:
    """Every site with every sample: coverage 0 and null beta where nothing is
    stored. Meant for exports; the number of samples multiplies the rows."""
    cells = row_data.select("cpg_idx").join(col_data.select("sample_idx"), how="cross")
    return cells.join(assay, ["cpg_idx", "sample_idx"], "left").select("cpg_idx", "sample_idx", F.coalesce("cov", F.lit(0)).alias("cov"), "beta")


def wide(assay: DataFrame, row_data: DataFrame, samples: list[tuple[int, str]], value: str = "beta") -> DataFrame:
    """One row per site, one column per sample, in sample order."""
    columns = [F.max(F.when(F.col("sample_idx") == i, F.col(value))).alias(name) for i, name in samples]
    pivoted = assay.groupBy("cpg_idx").agg(*columns) if columns else assay.select("cpg_idx").distinct()
    out = row_data.select("cpg_idx").join(pivoted, "cpg_idx", "left")
    return out if value != "cov" else out.fillna(0, [n for _, n in samples])
