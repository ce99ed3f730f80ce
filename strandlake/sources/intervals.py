"""Interval files: BED regions and VCF variants, as 0-based half-open rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import ReferenceError_
from ..functions.columns import canonical_contig, trimmed


def _fields(cut: DataFrame, *parts: Column) -> DataFrame:
    """The parts by a generator of one row, so that what follows uses them and
    doesn't repeat how they are made."""
    return cut.select(F.inline(F.array(F.struct(*parts))))


def parse_bed(lines: DataFrame, value: str = "value") -> DataFrame:
    """``contig_key, start, end, name`` of BED lines, and ``problem`` where a
    line breaks the format. Comments, ``track`` and ``browser`` lines and empty
    ones are left out; fields may be parted by tabs or spaces."""
    text = trimmed(F.col(value))
    cut = lines.where((F.length(text) > 0) & ~text.rlike(r"^(#|track\b|browser\b)")).select(F.split(text, r"[\t ]+").alias("f"))
    f = lambda i: F.get("f", F.lit(i))
    rows = _fields(cut, canonical_contig(f(0)).alias("contig_key"), f(1).try_cast("long").alias("start"), f(2).try_cast("long").alias("end"), f(3).alias("name"), F.size("f").alias("n"))
    wrong = F.col("start").isNull() | F.col("end").isNull() | (F.col("start") < 0) | (F.col("end") < F.col("start"))
    problem = F.when(F.col("n") < 3, "a region needs 3 fields").when(wrong, "start and end are not an interval")
    return rows.select("contig_key", "start", "end", "name", problem.alias("problem"))


def parse_vcf(lines: DataFrame, value: str = "value") -> DataFrame:
    """``contig_key, start, end, ref, alt, id`` of VCF lines (``end``: behind
    the last reference base), and ``problem``. Header lines are left out."""
    cut = lines.where((F.length(trimmed(F.col(value))) > 0) & ~F.col(value).startswith("#")).select(F.split(F.col(value), "\t").alias("f"))
    f = lambda i: F.get("f", F.lit(i))
    rows = _fields(cut, canonical_contig(f(0)).alias("contig_key"), f(1).try_cast("long").alias("at"), F.upper(f(3)).alias("ref"), F.upper(f(4)).alias("alt"), F.nullif(f(2), F.lit(".")).alias("id"), F.size("f").alias("n"))
    problem = F.when(F.col("n") < 5, "a variant needs 5 fields").when(F.col("at").isNull() | (F.col("at") < 1), "position is not a positive number").when(~F.col("ref").rlike("^[ACGTN]+$"), "reference bases are not ACGTN")
    return rows.select("contig_key", (F.col("at") - 1).alias("start"), (F.col("at") - 1 + F.length("ref")).alias("end"), "ref", "alt", "id", problem.alias("problem"))


def _sound(parsed: DataFrame, path: str) -> DataFrame:
    bad = parsed.where("problem IS NOT NULL").first()
    if bad:
        raise ReferenceError_(f"{path}: {bad['problem']}: {bad['contig_key']}:{bad['start']}")
    return parsed.drop("problem")


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """Regions of a BED file or folder; a broken line is an error."""
    return _sound(parse_bed(spark.read.text(path)), path)


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """Variants of a VCF file or folder; a broken line is an error."""
    return _sound(parse_vcf(spark.read.text(path)), path)
