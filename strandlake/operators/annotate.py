"""Gene regions of sites: range join by bins, then the nearest start site."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import I32_MAX
from ..functions.columns import bin_of, signed_distance
from .genes import binned


def overlap(sites: DataFrame, intervals: DataFrame) -> DataFrame:
    """Per site that lies in some interval, the best one: by priority, then
    distance to the start site, then a fixed order. ``sites``: cpg_idx,
    contig_key, start. A site has one bin, so no pair is seen twice."""
    at = sites.select("cpg_idx", "contig_key", F.col("start").alias("pos"), bin_of(F.col("start")).alias("bin"))
    spread = binned(intervals).select("contig_key", "bin", F.col("start").alias("f_start"), F.col("end").alias("f_end"), "strand", "transcript_id", "gene_id", "gene_symbol", "tx_start", "tx_end", "tss", "feature_seq", "annotation", "priority", "rank_label")
    hits = at.join(spread, ["contig_key", "bin"]).where("pos >= f_start AND pos < f_end")
    distance = signed_distance(F.col("pos"), F.col("tss"), F.col("strand"))
    order = F.struct(F.col("priority"), F.abs(distance).alias("far"), "tx_start", "tx_end", "transcript_id", "feature_seq", "annotation", "gene_id", "gene_symbol", distance.alias("distance_to_tss"), F.col("rank_label").alias("exon_intron_rank"))
    best = hits.groupBy("cpg_idx").agg(F.min(order).alias("b"))
    return best.select("cpg_idx", "b.annotation", "b.gene_id", "b.gene_symbol", "b.transcript_id", "b.distance_to_tss", "b.exon_intron_rank")


def nearest_tss(sites: DataFrame, models: DataFrame) -> DataFrame:
    """Per site whose contig has transcripts, the nearest start site; of two
    equally near the left one. Left of a site is the last start before it,
    right the first at or after it.

    Starts are looked up inside the site's bin; what lies beyond comes from
    one row per bin, so no task holds a whole contig of sites."""
    tss = models.select("contig_key", F.col("tss").alias("pos"), bin_of(F.col("tss")).alias("bin"), F.struct("tss", "tx_start", "tx_end", "transcript_id", "gene_id", "gene_symbol", "strand").alias("t"))
    at = sites.select("cpg_idx", "contig_key", F.col("start").alias("pos"), bin_of(F.col("start")).alias("bin"))
    per_bin = tss.groupBy("contig_key", "bin").agg(F.min("t").alias("first"), F.max("t").alias("last"))
    bins = at.select("contig_key", "bin").distinct().join(per_bin, ["contig_key", "bin"], "full")
    by_bin = Window.partitionBy("contig_key").orderBy("bin")
    beyond = bins.select("contig_key", "bin", F.last("last", ignorenulls=True).over(by_bin.rowsBetween(Window.unboundedPreceding, -1)).alias("far_left"), F.first("first", ignorenulls=True).over(by_bin.rowsBetween(1, Window.unboundedFollowing)).alias("far_right"))
    nothing = F.lit(None).cast(tss.schema["t"].dataType)
    both = at.select("contig_key", "bin", "pos", F.lit(0).alias("kind"), nothing.alias("t"), "cpg_idx").unionByName(tss.select("contig_key", "bin", "pos", F.lit(1).alias("kind"), "t", F.lit(None).cast("long").alias("cpg_idx")))
    order = Window.partitionBy("contig_key", "bin").orderBy("pos", "kind", "t")
    looked = both.select("contig_key", "bin", "pos", "kind", "cpg_idx", F.last("t", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("left"), F.first("t", ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing)).alias("right")).where("kind = 0")
    joined = looked.join(beyond, ["contig_key", "bin"]).select("cpg_idx", "pos", F.coalesce("left", "far_left").alias("l"), F.coalesce("right", "far_right").alias("r"))
    nearer = F.when(F.col("r").isNull() | (F.col("l").isNotNull() & (F.col("pos") - F.col("l.tss") <= F.col("r.tss") - F.col("pos"))), F.col("l")).otherwise(F.col("r"))
    chosen = joined.withColumn("n", nearer).where("n IS NOT NULL")
    return chosen.select("cpg_idx", "n.gene_id", "n.gene_symbol", "n.transcript_id", signed_distance(F.col("pos"), F.col("n.tss"), F.col("n.strand")).alias("distance_to_tss"))


def annotate(sites: DataFrame, models: DataFrame, intervals: DataFrame) -> DataFrame:
    """The annotation of every site: its best region; else Intergenic with the
    nearest gene; else, on a contig without transcripts, Intergenic with no
    gene and the sentinel distance."""
    hit = overlap(sites, intervals)
    near = nearest_tss(sites.join(hit.select("cpg_idx"), "cpg_idx", "left_anti"), models)
    found = hit.unionByName(near.select("cpg_idx", F.lit("Intergenic").alias("annotation"), "gene_id", "gene_symbol", "transcript_id", "distance_to_tss", F.lit("").alias("exon_intron_rank")))
    out = sites.join(found, "cpg_idx", "left")
    text = lambda name: F.coalesce(name, F.lit("")).alias(name)
    return out.select("cpg_idx", "chr", (F.col("start") + 1).alias("start_1based"), F.col("end").alias("end_1based"), sites["strand"].alias("strand"), F.coalesce("annotation", F.lit("Intergenic")).alias("annotation"), text("gene_id"), text("gene_symbol"), text("transcript_id"), F.coalesce("distance_to_tss", F.lit(I32_MAX)).alias("distance_to_tss"), text("exon_intron_rank"))
