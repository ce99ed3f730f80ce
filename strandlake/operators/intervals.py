"""Sites by intervals: regions to keep, variants to mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import bin_of


def merged(intervals: DataFrame) -> DataFrame:
    """The normal form of ``contig_key, start, end``: intervals that overlap or
    touch become one, empty ones vanish, so a position lies in one at most. An
    interval begins a new one where its start lies behind all ends before it."""
    order = Window.partitionBy("contig_key").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0)
    runs = intervals.where(F.col("end") > F.col("start")).withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order))
    return runs.groupBy("contig_key", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_merged")).drop("run")


def _spread(intervals: DataFrame, lead: int = 0) -> DataFrame:
    """A row for each bin that an interval, begun ``lead`` earlier, touches."""
    first = F.greatest(F.col("start") - lead, F.lit(0))
    return intervals.where(F.col("end") > F.col("start")).select("contig_key", F.explode(F.sequence(bin_of(first), bin_of(F.col("end") - 1))).alias("bin"), F.col("start").alias("i_start"), F.col("end").alias("i_end"))


def _matched(sites: DataFrame, intervals: DataFrame, fits: Column, how: str, lead: int = 0) -> DataFrame:
    """A site lies in the one bin of its start, so bins and contig are an
    equi-join and ``fits`` its residual test."""
    spread = _spread(intervals, lead).withColumnRenamed("contig_key", "i_contig").withColumnRenamed("bin", "i_bin")
    return sites.join(spread, (F.col("contig_key") == F.col("i_contig")) & (bin_of(F.col("start")) == F.col("i_bin")) & fits, how)


def sites_in_regions(sites: DataFrame, regions: DataFrame) -> DataFrame:
    """Sites whose first base lies in some region."""
    inside = (F.col("start") >= F.col("i_start")) & (F.col("start") < F.col("i_end"))
    return _matched(sites, merged(regions), inside, "left_semi")


def mask_variants(sites: DataFrame, variants: DataFrame, single_base: bool = False) -> DataFrame:
    """Sites neither base of which a variant's reference bases cover; with
    ``single_base``, only variants of one base for another count."""
    if single_base:
        variants = variants.where((F.length("ref") == 1) & F.col("alt").rlike("^[ACGT](,[ACGT])*$"))
    touched = (F.col("i_start") < F.col("end")) & (F.col("i_end") > F.col("start"))
    # a site may begin one base before the variant, so in the bin before it
    return _matched(sites, variants, touched, "left_anti", lead=1)


def cells_of(assay: DataFrame, sites: DataFrame) -> DataFrame:
    """The cells of those sites."""
    return assay.join(sites.select("cpg_idx"), "cpg_idx", "left_semi")
