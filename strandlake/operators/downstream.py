"""Downstream analyses of a finished run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_beta(assay: DataFrame) -> DataFrame:
    """Per sample, over covered sites."""
    return assay.groupBy("sample_idx").agg(F.avg(F.col("beta").cast("double")).alias("mean_beta"))


def mean_coverage(assay: DataFrame, n_sites: int | DataFrame) -> DataFrame:
    """Per sample, over all sites, uncovered ones as 0."""
    sums = assay.groupBy("sample_idx").agg(F.sum("cov").alias("reads"))
    if isinstance(n_sites, DataFrame):
        sums = sums.join(F.broadcast(n_sites.select(F.col(n_sites.columns[0]).alias("n_sites"))), how="cross")  # one row by contract
    else:
        sums = sums.withColumn("n_sites", F.lit(n_sites))
    return sums.select("sample_idx", (F.col("reads").cast("double") / F.col("n_sites")).alias("mean_cov"))


def region_subset(row_data: DataFrame, assay: DataFrame, contigs: list[str]) -> tuple[DataFrame, DataFrame]:
    """Sites and cells on contigs, by display name."""
    rows = row_data.where(F.col("chr").isin(*contigs))
    return rows, assay.join(rows.select("cpg_idx"), "cpg_idx", "left_semi")


def high_coverage_sites(assay: DataFrame, n_samples: int, above: float) -> DataFrame:
    """Sites whose mean coverage over all samples exceeds ``above``."""
    return assay.groupBy("cpg_idx").agg((F.sum("cov").cast("double") / n_samples).alias("mean_cov")).where(F.col("mean_cov") > above)


def delta_beta(assay: DataFrame, first: int, second: int, top: int | None = 100) -> DataFrame:
    """Sites covered in both samples by falling absolute difference."""
    pair = assay.where(F.col("sample_idx").isin(first, second)).groupBy("cpg_idx").agg(F.max(F.when(F.col("sample_idx") == first, F.col("beta"))).cast("double").alias("beta_first"), F.max(F.when(F.col("sample_idx") == second, F.col("beta"))).cast("double").alias("beta_second"))
    delta = pair.where("beta_first IS NOT NULL AND beta_second IS NOT NULL").withColumn("delta", F.col("beta_first") - F.col("beta_second"))
    return delta if top is None else delta.orderBy(F.abs("delta").desc(), "cpg_idx").limit(top)


def bedgraph(row_data: DataFrame, assay: DataFrame, value: str = "beta") -> DataFrame:
    """``chr, start, end, value`` of covered sites, 0-based half-open."""
    return row_data.join(assay.where("cov > 0 AND beta IS NOT NULL"), "cpg_idx").select("chr", "start", "end", F.col(value).cast("double").alias("value"), "sample_idx")


def gene_mean_beta(assay: DataFrame, annotation: DataFrame) -> DataFrame:
    """Per gene and sample: mean beta of its sites."""
    return assay.join(annotation.where("gene_id <> ''").select("cpg_idx", "gene_id"), "cpg_idx").groupBy("gene_id", "sample_idx").agg(F.avg(F.col("beta").cast("double")).alias("mean_beta"), F.count("*").alias("n_sites"))


def inspect(row_data: DataFrame, assay: DataFrame) -> DataFrame:
    """Dimensions, contigs, range and cells of a run, in one row."""
    rows = row_data.agg(F.count("*").alias("n_sites"), F.countDistinct("chr").alias("n_contigs"))
    cells = assay.agg(F.count("*").alias("n_cells"), F.countDistinct("sample_idx").alias("n_samples"), F.min(F.col("beta").cast("double")).alias("min_beta"), F.max(F.col("beta").cast("double")).alias("max_beta"), F.max("cov").alias("max_cov"))
    return rows.join(cells, how="cross")  # one row each


def assay_diff(left: DataFrame, right: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Cells in which two assays differ: there in one alone, coverage not
    equal, or beta apart by more than ``tolerance``."""
    a = left.select("cpg_idx", "sample_idx", F.col("cov").alias("cov_left"), F.col("beta").cast("double").alias("beta_left"))
    b = right.select("cpg_idx", "sample_idx", F.col("cov").alias("cov_right"), F.col("beta").cast("double").alias("beta_right"))
    joined = a.join(b, ["cpg_idx", "sample_idx"], "full")
    reason = F.when(F.col("cov_left").isNull(), "right only").when(F.col("cov_right").isNull(), "left only").when(F.col("cov_left") != F.col("cov_right"), "coverage").when(F.abs(F.col("beta_left") - F.col("beta_right")) > tolerance, "beta")
    return joined.withColumn("reason", reason).where("reason IS NOT NULL")
