"""FASTA: contigs and their CpG sites."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import U32_MAX, Reference, ReferenceError_
from ..functions.columns import canonical_contig, is_standard_contig
from ..functions.names import release_name
from ..sinks.files import reach_workers, written


#: Bases of short contigs that are searched together.
TOGETHER = 1 << 24


def _parsed(spark: SparkSession, path: str) -> DataFrame:
    """``contig_idx, contig, seq`` of every record, and ``problem``. The index
    says no more than the order of records within one evaluation."""
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.monotonically_increasing_id().alias("at"), "value")
    parts = raw.select("at", F.regexp_replace("value", "^>", "").alias("body"), F.col("value").startswith(">").alias("marked"))
    header = F.regexp_extract("body", r"^([^\r\n]*)", 1)
    rows = parts.where(F.length(F.trim("body")) > 0).select(F.col("at").alias("contig_idx"), "marked", F.regexp_extract(header, r"^(\S*)", 1).alias("contig"), F.upper(F.regexp_replace(F.regexp_replace("body", r"^[^\r\n]*", ""), r"\s", "")).alias("seq"))
    problem = F.when((F.col("contig_idx") == 0) & ~F.col("marked"), "sequence before the first header").when(F.col("contig") == "", "a header without a name")
    return rows.select("contig_idx", "contig", "seq", problem.alias("problem"))


def _refuse(rows: DataFrame, path: str) -> None:
    if bad := rows.where("problem IS NOT NULL").orderBy("contig_idx").select("problem").first():
        raise ReferenceError_(f"{path}: {bad['problem']}")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """One row per contig: ``contig_idx, contig, seq`` (upper case, no white
    space). Compressed files may have several members."""
    rows = _parsed(spark, path)
    _refuse(rows, path)
    return rows.drop("problem")


def select_contigs(contigs: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The listed contigs, by exact name; standard chromosomes by default."""
    return contigs.where(F.col("contig").isin(*names) if names else is_standard_contig(F.col("contig")))


def contig_lengths(contigs: DataFrame) -> DataFrame:
    return contigs.select(F.col("contig_idx"), "contig", F.length("seq").cast("long").alias("length"))


def composition(contigs: DataFrame) -> DataFrame:
    """``contigs`` with ``n_bases, n_c, n_g, n_cpg`` and ``n_other`` (neither
    A, C, G, T nor N) of ``seq``, in capitals and without white space."""
    n = F.length("seq").cast("long")
    without = lambda drop: F.length(F.translate("seq", drop, "")).cast("long")
    pairs = F.floor((n - F.length(F.replace(F.col("seq"), F.lit("CG"), F.lit("")))) / 2).cast("long")
    return contigs.withColumns({"n_bases": n, "n_c": n - without("C"), "n_g": n - without("G"), "n_cpg": pairs, "n_other": without("ACGTN")})


def cpg_positions(contigs: DataFrame) -> DataFrame:
    """``contig_idx, contig, start`` of every C before a G, in SQL: for many
    short sequences. Upper and lower case alike."""
    seq = F.upper("seq")
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.length("seq") - 1, F.lit(1))), lambda i: F.substr(seq, i, F.lit(2)) == "CG")
    return contigs.select("contig_idx", "contig", F.explode(at).alias("i")).select("contig_idx", "contig", (F.col("i") - 1).cast("long").alias("start"))


def _sites_of(batches):
    """``contig_idx, contig, start, nth`` of batches of contigs. Contigs are laid
    behind one another, up to ``TOGETHER`` bases of them or a longer one alone,
    and searched in one pass; so short ones cost no pass and no message each."""
    for batch in batches:
        texts = [(s or "").upper().encode() for s in batch.column(2).to_pylist()]
        first = 0
        while first < len(texts):
            last, size = first + 1, len(texts[first])
            while last < len(texts) and size + len(texts[last]) < TOGETHER:
                size += len(texts[last])
                last += 1
            yield from _sites_in(batch.slice(first, last - first), texts[first:last])
            first = last


def _sites_in(contigs, texts: list[bytes]):
    """Sites of contigs with the bases ``texts``, sent on in slices."""
    bases = np.frombuffer(b"\n".join(texts), np.uint8)
    at = np.flatnonzero((bases[:-1] == 67) & (bases[1:] == 71)).astype(np.int64)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    begins = np.cumsum(lengths) - lengths
    before = np.searchsorted(at, begins)  # sites of the contigs before each
    for a in range(0, len(at), 500_000):
        part = at[a : a + 500_000]
        row = np.searchsorted(begins, part, "right") - 1
        yield pa.RecordBatch.from_arrays([contigs.column(0).take(pa.array(row)), contigs.column(1).take(pa.array(row)), pa.array(part - begins[row]), pa.array(np.arange(a, a + len(part)) - before[row])], names=["contig_idx", "contig", "start", "nth"])


def scan_cpgs(contigs: DataFrame) -> DataFrame:
    """The same for whole chromosomes: vectorised passes, sites sent on in
    slices."""

    reach_workers(contigs.sparkSession)
    return contigs.select("contig_idx", "contig", "seq").mapInArrow(_sites_of, "contig_idx long, contig string, start long, nth long")


def scan_records(records: DataFrame) -> DataFrame:
    """One pass over ``_parsed`` records: a row with ``problem`` and ``length``
    for each, and one with ``start`` and ``nth`` for each of its sites."""
    def run(batches):
        names = ["contig_idx", "contig", "problem", "length", "start", "nth"]
        for batch in batches:
            n = batch.num_rows
            lengths = pa.array([len(s) for s in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), lengths, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=names)
            for part in _sites_of([batch]):
                m = part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.nulls(m, pa.string()), pa.nulls(m, pa.int64()), part.column(2), part.column(3)], names=names)

    reach_workers(records.sparkSession)
    return records.select("contig_idx", "contig", "seq", "problem").mapInArrow(run, "contig_idx long, contig string, problem string, length long, start long, nth long")


def extract_sites(spark: SparkSession, path: str, contigs: list[str] | None = None) -> Reference:
    """Sites and contigs of a FASTA file, numbered in file order. The file is
    read once, to a table below the shared folder, of which everything else is
    made. The number of a site is its place in its contig plus all sites of
    earlier contigs, which takes one row per contig on the driver, not a global
    sort."""
    records = _parsed(spark, path)
    chosen = F.col("contig").isin(*contigs) if contigs else is_standard_contig(F.col("contig"))
    scanned = written(scan_records(records.where(chosen | F.col("problem").isNotNull())), "fasta")
    heads, sites = scanned.where("length IS NOT NULL"), scanned.where("start IS NOT NULL")
    _refuse(heads, path)
    lengths = heads.select("contig_idx", "contig", "length")
    if lengths.where(F.col("length") > U32_MAX).limit(1).count():
        raise ReferenceError_(f"{path}: a contig exceeds the unsigned 32-bit range")
    base, total = [], 0
    for row in sites.groupBy("contig_idx").count().orderBy("contig_idx").collect():
        base.append((row["contig_idx"], total))
        total += row["count"]
    bases = spark.createDataFrame(base, "contig_idx long, base long")
    numbered = sites.join(F.broadcast(bases), "contig_idx")  # one row per contig
    out = numbered.select((F.col("base") + F.col("nth")).alias("cpg_idx"), F.col("contig").alias("chr"), canonical_contig(F.col("contig")).alias("contig_key"), "start", (F.col("start") + 2).alias("end"), F.lit("+").alias("strand"))
    return Reference(out, lengths, release_name(path))
