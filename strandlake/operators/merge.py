"""Several finished runs as one: the union of their sites and samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import EngineError, MethylationSet
from ..functions.columns import canonical_contig
from .numbering import numbered


def _check(sets: list[MethylationSet]) -> list[list]:
    """The samples of each set (one row per sample); none may come twice, and
    all must be of one genome."""
    if not sets:
        raise EngineError("no runs to merge")
    genomes = sorted({s.genome for s in sets})
    if len(genomes) > 1:
        raise EngineError(f"runs of different genomes: {', '.join(genomes)}")
    samples = [s.col_data.orderBy("sample_idx").select("sample_idx", "sample_id", "sample_name").collect() for s in sets]
    names = [r["sample_id"] for rows in samples for r in rows]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise EngineError(f"samples in more than one run: {', '.join(twice)}")
    return samples


def merge_sets(sets: list[MethylationSet]) -> MethylationSet:
    """Sites of any run, once each, numbered anew by contig and position;
    samples in the order of the runs; every cell keeps its values. Two names of
    one contig are one site, under the name of the earlier run."""
    samples = _check(sets)
    spark = sets[0].assay.sparkSession
    place = [r.withColumns({"contig_key": canonical_contig(F.col("chr")), "run": F.lit(i)}).select("run", F.col("cpg_idx").alias("old_idx"), "contig_key", "start", "end", "strand", "chr") for i, r in enumerate(s.row_data for s in sets)]
    every = reduce(DataFrame.unionByName, place)
    sites = every.groupBy("contig_key", "start").agg(F.min_by(F.struct("chr", "end", "strand"), "run").alias("s")).select("contig_key", "start", "s.*")
    rows = numbered(sites, ["contig_key", "start"])
    renumbered = every.select("run", "old_idx", "contig_key", "start").join(rows.select("contig_key", "start", "cpg_idx"), ["contig_key", "start"]).select("run", "old_idx", "cpg_idx")
    listed = [(i, r["sample_idx"], r["sample_id"], r["sample_name"]) for i, of in enumerate(samples) for r in of]
    cols = spark.createDataFrame([(n, *x) for n, x in enumerate(listed)], "sample_idx int, run int, old_sample int, sample_id string, sample_name string")
    cells = reduce(DataFrame.unionByName, [s.assay.select(F.lit(i).alias("run"), F.col("cpg_idx").alias("old_idx"), F.col("sample_idx").alias("old_sample"), "cov", "beta") for i, s in enumerate(sets)])
    assay = cells.join(renumbered, ["run", "old_idx"]).join(F.broadcast(cols.select("run", "old_sample", "sample_idx")), ["run", "old_sample"])  # one row per sample
    return MethylationSet(rows.select("cpg_idx", "chr", "contig_key", "start", "end", "strand"), cols.select("sample_idx", "sample_id", "sample_name"), assay.select("cpg_idx", "sample_idx", "cov", "beta"), sets[0].genome, max(s.universe for s in sets))
