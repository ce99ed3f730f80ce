"""Gene models: transcripts from GTF rows, and their labelled intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import DOWNSTREAM_REACH, PRIORITY, PROMOTER_REACH
from ..functions.columns import BIN_BITS, canonical_contig, rank_label, saturating_add, saturating_sub

#: Spellings of features in gene models.
TRANSCRIPT_FEATURES = ("transcript", "mrna")
UTR5_FEATURES = ("five_prime_utr", "5utr", "5'utr")
UTR3_FEATURES = ("three_prime_utr", "3utr", "3'utr")


def transcripts(rows: DataFrame) -> DataFrame:
    """``rows``: seqname, feature, start, end (0-based half-open), strand,
    transcript_id, gene_id, gene_symbol, line_no. One row per transcript with
    its parts as arrays. The last row names contig and strand, the last
    transcript row the bounds, the first row the gene. Without bounds the
    exons give them: start of the first and end of the last by start."""
    kind = F.lower("feature")
    piece = F.struct("start", "line_no", "end")
    plain = F.struct("line_no", "start", "end")
    grouped = rows.groupBy("transcript_id").agg(
        F.max_by("seqname", "line_no").alias("seqname"),
        F.max_by("strand", "line_no").alias("strand"),
        F.min_by("gene_id", "line_no").alias("gene_id"),
        F.coalesce(F.min_by("gene_symbol", F.when(F.col("gene_symbol") != "", F.col("line_no"))), F.lit("")).alias("gene_symbol"),
        F.max_by(F.struct("start", "end"), F.when(kind.isin(*TRANSCRIPT_FEATURES), F.col("line_no"))).alias("bounds"),
        F.array_sort(F.collect_list(F.when(kind == "exon", piece))).alias("exons"),
        F.array_sort(F.collect_list(F.when(kind.isin(*UTR5_FEATURES), plain))).alias("utr5"),
        F.array_sort(F.collect_list(F.when(kind.isin(*UTR3_FEATURES), plain))).alias("utr3"),
    )
    bounded = grouped.select(
        canonical_contig(F.col("seqname")).alias("contig_key"),
        "strand",
        "transcript_id",
        "gene_id",
        "gene_symbol",
        F.coalesce(F.col("bounds.start"), F.get("exons", F.lit(0))["start"]).alias("tx_start"),
        F.coalesce(F.col("bounds.end"), F.element_at(F.when(F.size("exons") > 0, F.col("exons")), -1)["end"]).alias("tx_end"),
        *[F.transform(c, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias(c) for c in ("exons", "utr5", "utr3")],
    )
    return with_regions(bounded.where("tx_start IS NOT NULL AND tx_end > tx_start"))


def with_regions(models: DataFrame) -> DataFrame:
    """Adds tss, promoter, downstream and introns; ranks exons and introns in
    the direction of the strand."""
    minus = F.col("strand") == "-"
    tss = F.when(minus, F.col("tx_end") - 1).otherwise(F.col("tx_start"))
    n = F.size("exons")
    gaps = F.when(n >= 2, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.struct(F.element_at("exons", i)["end"].alias("start"), F.element_at("exons", i + 1)["start"].alias("end")))).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))

    def ranked(name: str, kind: str):
        count = F.size(name)
        return F.transform(name, lambda x, i: F.struct(x["start"].alias("start"), x["end"].alias("end"), rank_label(kind, F.when(minus, count - i).otherwise(i + 1), count).alias("rank_label")))

    out = models.withColumn("tss", tss).withColumn("introns", F.filter(gaps, lambda x: x["start"] < x["end"]))
    return out.select(
        "contig_key", "strand", "transcript_id", "gene_id", "gene_symbol", "tx_start", "tx_end", "tss",
        F.struct(saturating_sub(F.col("tss"), PROMOTER_REACH).alias("start"), saturating_add(F.col("tss"), PROMOTER_REACH + 1).alias("end")).alias("promoter"),
        F.when(minus, F.struct(saturating_sub(F.col("tx_start"), DOWNSTREAM_REACH).alias("start"), F.col("tx_start").alias("end"))).otherwise(F.struct(F.col("tx_end").alias("start"), saturating_add(F.col("tx_end"), DOWNSTREAM_REACH).alias("end"))).alias("downstream"),
        ranked("exons", "Exon").alias("exons"), ranked("introns", "Intron").alias("introns"), "utr5", "utr3",
    )


def features(models: DataFrame) -> DataFrame:
    """All intervals of all transcripts, one row each: annotation, priority,
    rank label and place in the transcript (promoter, 5' UTRs, 3' UTRs, exons,
    introns, downstream)."""

    def part(name: str, label: str, ranked: bool = False):
        return F.transform(name, lambda x: F.struct(F.lit(label).alias("annotation"), x["start"].alias("start"), x["end"].alias("end"), (x["rank_label"] if ranked else F.lit("")).alias("rank_label")))

    one = lambda name: F.array(F.col(name))
    parts = F.concat(part(one("promoter"), "Promoter"), part("utr5", "5' UTR"), part("utr3", "3' UTR"), part("exons", "Exon", True), part("introns", "Intron", True), part(one("downstream"), "Downstream"))
    rows = models.select("contig_key", "strand", "transcript_id", "gene_id", "gene_symbol", "tx_start", "tx_end", "tss", F.posexplode(parts).alias("feature_seq", "f"))
    return rows.select("contig_key", "strand", "transcript_id", "gene_id", "gene_symbol", "tx_start", "tx_end", "tss", "feature_seq", "f.*").withColumn("priority", F.create_map(*[F.lit(x) for kv in PRIORITY.items() for x in kv])[F.col("annotation")])


def binned(intervals: DataFrame, bits: int = BIN_BITS) -> DataFrame:
    """One row for each bin that an interval touches; empty ones vanish."""
    return intervals.where("end > start").withColumn("bin", F.explode(F.sequence(F.shiftright("start", bits), F.shiftright(F.col("end") - 1, bits))))
