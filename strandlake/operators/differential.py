"""Differential methylation between two groups of samples: per site, then in
regions of neighbouring sites that differ the same way."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import bin_of


def site_differences(assay: DataFrame, groups: DataFrame, min_samples: int = 1) -> DataFrame:
    """``cpg_idx, n_first, n_second, mean_first, mean_second, delta, t`` of
    sites with at least ``min_samples`` covered samples in both groups.
    ``groups``: sample_idx, grp (1 or 2). ``t`` is Welch's statistic, null where
    a group has one sample or neither varies (standard error below 1e-6). Means and delta are rounded to 9
    digits, so that thresholds on them don't hang on the order of a sum."""
    cells = assay.join(F.broadcast(groups), "sample_idx")  # one row per sample
    value = F.col("beta").cast("double")
    of = lambda g: F.when(F.col("grp") == g, value)
    stats = cells.groupBy("cpg_idx").agg(*[f(of(g)).alias(f"{name}_{k}") for g, k in ((1, "first"), (2, "second")) for f, name in ((F.count, "n"), (F.avg, "mean"), (F.var_samp, "var"))])
    both = stats.where((F.col("n_first") >= min_samples) & (F.col("n_second") >= min_samples))
    mean = lambda k: F.round(f"mean_{k}", 9).alias(f"mean_{k}")
    error = F.sqrt(F.col("var_first") / F.col("n_first") + F.col("var_second") / F.col("n_second"))
    delta = F.col("mean_second") - F.col("mean_first")
    t = F.when((F.col("n_first") > 1) & (F.col("n_second") > 1) & (error > 1e-6), F.round(delta / error, 6))
    return both.select("cpg_idx", "n_first", "n_second", mean("first"), mean("second"), F.round(delta, 9).alias("delta"), t.alias("t"))


def differential_regions(sites: DataFrame, differences: DataFrame, min_delta: float, max_gap: int, min_sites: int = 1) -> DataFrame:
    """``contig_key, start, end, direction, first_idx, n_sites, mean_delta`` of
    the longest runs of sites with a difference of ``min_delta`` or more, all
    the same way, whose starts lie no more than ``max_gap`` apart.

    Runs are found inside bins; then only the first and the last run of each bin
    are looked at once more, contig by contig, and stitched where they go on
    over the border. So no task sorts a whole contig of sites."""
    strong = differences.where(F.abs("delta") >= min_delta).select("cpg_idx", "delta").join(sites.select("cpg_idx", "contig_key", "start", "end"), "cpg_idx")
    at = strong.withColumns({"bin": bin_of(F.col("start")), "direction": F.signum("delta").cast("int")})
    order = Window.partitionBy("contig_key", "bin").orderBy("start", "cpg_idx")
    apart = F.lag("start").over(order).isNull() | (F.lag("direction").over(order) != F.col("direction")) | (F.col("start") - F.lag("start").over(order) > max_gap)
    runs = at.withColumn("new", apart.cast("int")).withColumn("run", F.sum("new").over(order)).groupBy("contig_key", "bin", "run").agg(
        F.first("direction").alias("direction"), F.min("start").alias("start"), F.max("start").alias("last"), F.max("end").alias("end"), F.min_by("cpg_idx", F.struct("start", "cpg_idx")).alias("first_idx"), F.count("*").alias("n_sites"), F.sum("delta").alias("total"))
    of_bin = Window.partitionBy("contig_key", "bin")
    placed = runs.withColumns({"opens": F.col("run") == 1, "closes": F.col("run") == F.max("run").over(of_bin)})
    edges = placed.where("opens OR closes")
    by_contig = Window.partitionBy("contig_key").orderBy("bin", "run")
    before = lambda c: F.lag(c).over(by_contig)
    goes_on = F.col("opens") & before("closes") & (before("direction") == F.col("direction")) & (F.col("start") - before("last") <= max_gap)
    stitched = edges.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("part", F.sum("new").over(by_contig))
    whole = stitched.groupBy("contig_key", "part").agg(
        F.first("direction").alias("direction"), F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("first_idx", F.struct("start", "first_idx")).alias("first_idx"), F.sum("n_sites").alias("n_sites"), F.sum("total").alias("total")).drop("part")
    regions = whole.unionByName(placed.where("NOT opens AND NOT closes").select(*whole.columns))
    return regions.where(F.col("n_sites") >= min_sites).select("contig_key", "start", "end", "direction", "first_idx", "n_sites", F.round(F.col("total") / F.col("n_sites"), 6).alias("mean_delta"))
