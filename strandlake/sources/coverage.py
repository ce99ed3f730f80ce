"""Coverage text files: discovery, parsing, fail-fast validation."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import COVERAGE_SUFFIXES, PERCENT_TOLERANCE, U32_MAX, CoverageError
from ..functions.columns import canonical_contig, trimmed
from ..functions.names import sample_names
from ..sinks.files import discard, list_files, written


def find_files(spark: SparkSession, directory: str) -> list[str]:
    """Coverage files of a directory, not below it, by path. None is an error.
    Links to files count."""
    found = [p for p in list_files(spark, directory) if p.endswith(COVERAGE_SUFFIXES)]
    if not found:
        raise CoverageError(f"{directory}: no coverage files ({', '.join('*' + s for s in COVERAGE_SUFFIXES)})")
    return found


def _u32(c: Column) -> Column:
    """The cast itself leaves out white space on both sides."""
    value = c.try_cast("long")
    return F.when(value.between(0, U32_MAX), value)


def _f64(c: Column) -> Column:
    """Casts read "1.0d" and "1f" as numbers; here they are not."""
    last = F.right(c, F.lit(1))
    return F.when(~((last.isin("d", "D", "f", "F") | (last <= " ")) & c.rlike(r"[0-9.][dDfF]\s*$")), c.try_cast("double"))


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``lines`` with the parsed fields, the ``rule`` that a line breaks first,
    and the ``problem`` in words; both are null for sound lines. Empty lines are
    left out; a carriage return at the end of a line is cut."""
    text = F.when(F.col(value).endswith("\r"), F.expr(f"left(`{value}`, length(`{value}`) - 1)")).otherwise(F.col(value))
    cut = lines.withColumn("__f", F.split(text, "\t", -1)).where(F.length(text) > 0)
    f = lambda i: F.get("__f", F.lit(i))
    parts = {"chr": trimmed(f(0)), "start1": _u32(f(1)), "end1": _u32(f(2)), "percent": _f64(f(3)), "methylated": _u32(f(4)), "unmethylated": _u32(f(5))}
    # a one-row generator, so that the rules below use the fields and don't repeat how they are parsed
    fields = cut.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in parts.items()]))))
    total = F.col("methylated") + F.col("unmethylated")
    expected = F.when(total == 0, F.lit(0.0)).otherwise(100.0 * F.col("methylated").cast("double") / total.cast("double"))
    shown = lambda words, column: F.concat(F.lit(words), column.cast("string"))
    rules = (
        ("encoding", ~F.is_valid_utf8(F.col(value)), F.lit("line is not valid UTF-8")),
        ("columns", F.size("__f") != 6, shown("a line needs 6 fields parted by tabs; fields here: ", F.size("__f"))),
        ("chromosome", F.length("chr") == 0, F.lit("chromosome is empty")),
        ("fields", F.col("start1").isNull(), F.lit("start is not an unsigned 32-bit number")),
        ("fields", F.col("end1").isNull(), F.lit("end is not an unsigned 32-bit number")),
        ("fields", F.col("percent").isNull(), F.lit("methylation percentage is not a number")),
        ("fields", F.col("methylated").isNull(), F.lit("methylated count is not an unsigned 32-bit number")),
        ("fields", F.col("unmethylated").isNull(), F.lit("unmethylated count is not an unsigned 32-bit number")),
        ("start", F.col("start1") < 1, F.lit("start must be at least 1")),
        ("single_base", F.col("end1") != F.col("start1"), F.concat(shown("end ", F.col("end1")), shown(" must equal start ", F.col("start1")))),
        ("percent_range", F.isnan("percent") | ~F.col("percent").between(0, 100), F.lit("methylation percentage must be between 0 and 100")),
        ("overflow", total > U32_MAX, F.lit("Coverage overflow: counts exceed the unsigned 32-bit range")),
        ("percent_match", F.abs(expected - F.col("percent")) > PERCENT_TOLERANCE, F.concat(shown("methylation percentage ", F.col("percent")), F.lit(" does not match counts"))),
    )
    broken = F.lit(None).cast("struct<rule:string,problem:string>")
    for name, wrong, words in reversed(rules):
        broken = F.when(wrong, F.struct(F.lit(name).alias("rule"), words.alias("problem"))).otherwise(broken)
    return fields.withColumn("__broken", broken).select(*lines.columns, *parts, F.col("__broken.rule").alias("rule"), F.col("__broken.problem").alias("problem"))


def records(parsed: DataFrame, *keep: str) -> DataFrame:
    """Canonical records of sound parsed lines, positions 0-based."""
    return parsed.select(*keep, "chr", canonical_contig(F.col("chr")).alias("contig_key"), (F.col("start1") - 1).alias("start"), "methylated", "unmethylated")


def _locate(spark: SparkSession, path: str) -> str:
    """Line and reason of the first problem of one file, read once more, line
    by line: rows are numbered in the order of the file."""
    lines = written(spark.read.text(path).withColumn("at", F.monotonically_increasing_id()), "numbered")
    first = parse_lines(lines).where("problem IS NOT NULL").agg(F.min(F.struct("at", "problem")).alias("x")).first()["x"]
    number = lines.where(F.col("at") < first["at"]).count() + 1
    discard(lines)
    return f"{path}, line {number}: {first['problem']}"


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``value, file`` of all lines. One task has to unpack a packed file; its
    lines are dealt to all tasks before they are parsed."""
    packed, plain = [p for p in paths if p.endswith(".gz")], [p for p in paths if not p.endswith(".gz")]
    read = lambda some: spark.read.text(some).select("value", F.col("_metadata.file_name").alias("file"))
    if not packed:
        return read(plain)
    dealt = read(packed).repartition("value")
    return dealt.unionByName(read(plain)) if plain else dealt


def read_coverage(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Records of all files, validated, and the samples (``sample_idx,
    sample_id, sample_name``) in order of path. Texts are read and parsed once,
    to a table of records; every check is one aggregate over that table. Only a
    file known to be bad is read again for its line."""
    names = sample_names(paths)
    samples = spark.createDataFrame([(i, n, n) for i, n in enumerate(names)], "sample_idx int, sample_id string, sample_name string")
    by_file = spark.createDataFrame([(os.path.basename(p), i) for i, p in enumerate(paths)], "file string, sample_idx int")
    # as many rows as the driver listed files
    stored = written(records(parse_lines(_lines(spark, paths).join(F.broadcast(by_file), "file")), "sample_idx", "problem"), "records")
    if bad := stored.where("problem IS NOT NULL").select("sample_idx").distinct().collect():  # one row per file at most
        discard(stored)
        raise CoverageError(_locate(spark, min(paths[b["sample_idx"]] for b in bad)))
    found = stored.drop("problem").join(F.broadcast(samples.select("sample_idx", "sample_id")), "sample_idx")  # one row per file
    if may_repeat(stored) and (twice := duplicates(found).orderBy("sample_id", "contig_key", "start").first()):
        discard(stored)
        raise CoverageError(f"sample {twice['sample_id']}: duplicate record at {twice['contig_key']}:{twice['start'] + 1}")
    found._strandlake_path = stored._strandlake_path  # whoever is done with the records may discard them
    return found, samples


def may_repeat(stored: DataFrame) -> bool:
    """Whether two records have the same hash of sample and position: only then
    can a sample list a position twice. Hashes are all that is shuffled."""
    hashes = stored.select(F.xxhash64("sample_idx", "contig_key", "start").alias("hash")).repartition("hash")
    return (hashes.groupBy("hash").count().agg(F.max("count")).first()[0] or 0) > 1


def duplicates(found: DataFrame) -> DataFrame:
    """Positions that one sample lists more than once, contig aliases alike."""
    return found.groupBy("sample_id", "contig_key", "start").agg(F.count("*").alias("n")).where("n > 1")
