"""Annotation counts per sample, and the report made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import REPORT_REGIONS, AnnotationError
from ..functions.columns import percent


def annotation_counts(assay: DataFrame, annotation: DataFrame, col_data: DataFrame) -> DataFrame:
    """``sample_id, annotation, n``: covered sites by region."""
    joined = assay.where("cov > 0").join(annotation.select("cpg_idx", "annotation"), "cpg_idx")
    counts = joined.groupBy("sample_idx", "annotation").agg(F.count("*").alias("n"))
    return counts.join(col_data.select("sample_idx", "sample_id"), "sample_idx").select("sample_id", "annotation", "n")


def report_regions(annotation: DataFrame) -> list[str]:
    """The four fixed regions, then what else occurs, sorted. At most seven
    labels exist, so they are collected."""
    seen = {r["annotation"] for r in annotation.select("annotation").distinct().collect()}
    return [*REPORT_REGIONS, *sorted(seen - set(REPORT_REGIONS))]


def annotation_report(counts: DataFrame, col_data: DataFrame, regions: list[str]) -> DataFrame:
    """One row per sample: covered sites, and count and percent per region."""
    columns = [F.coalesce(F.sum(F.when(F.col("annotation") == r, F.col("n"))), F.lit(0)).alias(f"{r}_count") for r in regions]
    summed = counts.groupBy("sample_id").agg(F.sum("n").alias("covered_cpgs"), *columns)
    joined = col_data.select("sample_id").join(summed, "sample_id", "left").fillna(0)
    pairs = [c for r in regions for c in (F.col(f"`{r}_count`"), percent(F.col(f"`{r}_count`"), F.col("covered_cpgs")).alias(f"{r}_percent"))]
    return joined.select(F.col("sample_id").alias("sample"), "covered_cpgs", *pairs)


def coverage_cube(assay: DataFrame, row_data: DataFrame, annotation: DataFrame, col_data: DataFrame) -> DataFrame:
    """``sample_id, contig_key, region, level, n_cells, reads`` for each
    combination of the three, of two, of one and of all: one pass. ``level``
    has a bit for each column that is summed over (sample 4, contig 2, region
    1), which tells that from a region that is null (outside all genes)."""
    place = row_data.select("cpg_idx", "contig_key").join(annotation.select("cpg_idx", F.nullif("annotation", F.lit("Intergenic")).alias("region")), "cpg_idx", "left")
    cells = assay.join(place, "cpg_idx").groupBy("sample_idx", "contig_key", "region").agg(F.count("*").alias("n"), F.sum("cov").alias("reads"))
    named = cells.join(F.broadcast(col_data.select("sample_idx", "sample_id")), "sample_idx")  # one row per sample
    return named.cube("sample_id", "contig_key", "region").agg(F.grouping_id().cast("int").alias("level"), F.sum("n").alias("n_cells"), F.sum("reads").alias("reads"))


def check_dimensions(n_annotation: int, n_rows: int) -> None:
    if n_annotation != n_rows:
        raise AnnotationError(f"annotation has {n_annotation} rows, coverage has {n_rows}")
