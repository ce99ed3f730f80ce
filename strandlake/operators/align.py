"""Records onto sites: exact position first, else the position before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import CoverageError, EngineError


def probe_table(sites: DataFrame) -> DataFrame:
    """Every position a record may have, with the site it belongs to. A site
    answers for its own position and, where no other site starts there, for
    the next one (the G of the other strand)."""
    none = F.lit(None).cast("long")
    own = sites.select("contig_key", F.col("start").alias("pos"), F.col("cpg_idx").alias("own"), none.alias("before"))
    after = sites.select("contig_key", (F.col("start") + 1).alias("pos"), none.alias("own"), F.col("cpg_idx").alias("before"))
    # two minima of numbers are hashed; one of a struct would be sorted
    return own.unionByName(after).groupBy("contig_key", "pos").agg(F.coalesce(F.min("own"), F.min("before")).alias("cpg_idx"))


def align(records: DataFrame, sites: DataFrame) -> DataFrame:
    """``records`` with ``cpg_idx``, null where no site fits. The probe table
    comes out of its aggregation partitioned by the join keys, so records are
    shuffled once. A task hashes its share of the sites, so records, of which
    there are many more, aren't sorted."""
    return records.join(probe_table(sites).withColumnRenamed("pos", "start").hint("shuffle_hash"), ["contig_key", "start"], "left")


def duplicate_sites(sites: DataFrame) -> DataFrame:
    """Canonical keys that two sites share, with the first and last index."""
    grouped = sites.groupBy("contig_key", "start").agg(F.count("*").alias("n"), F.min("cpg_idx").alias("first_idx"), F.max("cpg_idx").alias("last_idx"))
    return grouped.where("n > 1")


def check_sites(sites: DataFrame) -> None:
    bad = duplicate_sites(sites).orderBy("first_idx").first()
    if bad:
        raise EngineError(f"duplicate site {bad['contig_key']}:{bad['start']} at indices {bad['first_idx']} and {bad['last_idx']}")


def match_totals(aligned: DataFrame) -> DataFrame:
    """Per sample: records and how many found a site."""
    return aligned.groupBy("sample_id").agg(F.count("*").alias("n_records"), F.count("cpg_idx").alias("n_matched"))


def contig_totals(aligned: DataFrame, sample: str = "sample_id") -> DataFrame:
    """The same per sample and contig, as it is spelt: all that totals and
    warnings are made of."""
    return aligned.groupBy(sample, "chr").agg(F.count("*").alias("n_records"), F.count("cpg_idx").alias("n_matched"))


def sample_totals(contigs: DataFrame) -> DataFrame:
    """``match_totals`` from ``contig_totals``."""
    return contigs.groupBy("sample_id").agg(F.sum("n_records").alias("n_records"), F.sum("n_matched").alias("n_matched"))


def lost_contigs(contigs: DataFrame) -> DataFrame:
    """``unmatched_contigs`` from ``contig_totals``."""
    return contigs.where("n_matched = 0").groupBy("sample_id").agg(F.array_sort(F.collect_set("chr")).alias("contigs"))


def unmatched_contigs(aligned: DataFrame) -> DataFrame:
    """Per sample: its contigs of which no record found a site, sorted."""
    return lost_contigs(contig_totals(aligned))


def check_matches(aligned: DataFrame) -> None:
    check_totals(contig_totals(aligned))


def check_totals(contigs: DataFrame, totals: list | None = None) -> None:
    """A sample without any match is an error that names its contigs.
    ``contigs``: ``contig_totals``; ``totals``: the rows of ``sample_totals``,
    if they are at hand."""
    totals = totals if totals is not None else sample_totals(contigs).collect()  # one row per sample
    lost = min((t for t in totals if t["n_records"] and not t["n_matched"]), key=lambda t: t["sample_id"], default=None)
    if lost:
        names = lost_contigs(contigs.where(F.col("sample_id") == lost["sample_id"])).first()["contigs"]
        raise CoverageError(f"sample {lost['sample_id']}: no record matches the reference; its contigs: {', '.join(names)}")
