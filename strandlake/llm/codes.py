"""Vector codes by product codebooks, entries found by annular norm pruning.

A component x becomes the integer floor(256 x); a vector is cut into equal
consecutive parts, and each part is coded by the nearest entry of its
position's codebook. Entries are sorted by norm. For a part of norm |x|, the
entries next to that norm give a first distance d; by the triangle inequality
no entry whose norm lies outside [|x| - d, |x| + d] is nearer, so two binary
searches find the annulus, whose entries alone are compared, bounds included,
in exact integers. Ties go to the lower index, wherever it lies in the order of
norms: an entry at distance d lies inside the annulus or on its edge.

Codebooks start as the parts of the vectors of the smallest ids and are refined
by rounds of assignment and floored means. A task sums up the parts of each
entry before anything is shuffled, so a round sends parts x entries rows a
task; codebooks (parts x entries x width numbers) are all that reaches the
driver and goes back to the tasks.

Null vectors and those with null or non-finite components are dropped, as are
empty ones. So are vectors of another length than the first one's (by id), or
of a length that ``parts`` doesn't divide, and vectors with a component of
2**24 / 256 or more in size, beyond which distances would leave 64 bits. Zero
vectors count. Repeated rows are vectors of their own; equal ids are ordered by
their vectors, null ids come last. Fewer vectors than ``entries`` make smaller
codebooks; an empty table gives an empty result. Columns other than id, vector
and label aren't read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, reach_workers

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LIMIT = 1 << 24
#: Pairs of part and entry that are compared at once.
BLOCK_PAIRS = 1 << 20
#: Entries on either side of a part's norm that give the first distance.
PROBE = 3


class Annuli:
    """One part's codebook, sorted by norm."""

    def __init__(self, entries: np.ndarray):
        norms = np.sqrt((entries.astype(np.float64) ** 2).sum(axis=1))
        self.index = np.argsort(norms, kind="stable")
        self.entries, self.norms = entries[self.index], norms[self.index]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each row of ``x``: index of its nearest entry, the squared
        distance, and how many entries were compared."""
        norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        at = np.searchsorted(self.norms, norm)[:, None] + np.arange(-PROBE, PROBE)
        near = self.entries[np.clip(at, 0, len(self.norms) - 1)] - x[:, None, :]
        reach = np.sqrt((near * near).sum(axis=2).min(axis=1).astype(np.float64))
        slack = 1e-9 * (norm + reach) + 1e-9  # rounding of norms may not lose an entry
        low = np.searchsorted(self.norms, norm - reach - slack, side="left")
        high = np.searchsorted(self.norms, norm + reach + slack, side="right")
        n = high - low
        best, dist = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
        ends = np.cumsum(n)
        cuts = [0, *(np.flatnonzero(np.diff(ends // BLOCK_PAIRS)) + 1).tolist(), len(x)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            own = n[a:b]
            row = np.repeat(np.arange(a, b), own)
            begins = np.cumsum(own) - own
            entry = np.arange(own.sum()) - np.repeat(begins - low[a:b], own)
            away = ((x[row] - self.entries[entry]) ** 2).sum(axis=1)
            least = np.minimum.reduceat(away, begins)
            name = np.where(away == np.repeat(least, own), self.index[entry], len(self.index))
            best[a:b], dist[a:b] = np.minimum.reduceat(name, begins), least
        return best, dist, n


def kept_vectors(table: DataFrame, id_col: str, vector: str, label: str, parts: int) -> DataFrame:
    """``vec_id, label, values`` of the vectors that are coded."""
    rows = table.select(F.col(id_col).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("values"))
    bound = F.lit(float(LIMIT) / SCALE)
    sound = rows.where(F.col("values").isNotNull() & (F.size("values") > 0) & (F.size("values") % parts == 0)).where(~F.exists("values", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= bound)))
    first = sound.orderBy(F.col("vec_id").asc_nulls_last(), "values").select(F.size("values")).first()
    return sound.where(F.size("values") == (first[0] if first else 0))


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    return np.floor(column.flatten().to_numpy() * SCALE).astype(np.int64).reshape(-1, dim)


def _blocks(batches, column: int, dim: int, rows: int = 4096) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, _integers(part.column(column), dim)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part x entry x component) of ``kept_vectors``."""
    reach_workers(vectors.sparkSession)
    start = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "values").select("values").limit(entries).collect()  # as many as there are entries
    if not start:
        return np.zeros((parts, 0, 0), np.int64)
    first = np.floor(np.array([r["values"] for r in start]) * SCALE).astype(np.int64)
    dim = first.shape[1]
    wide = dim // parts
    books = np.ascontiguousarray(first.reshape(len(first), parts, wide).transpose(1, 0, 2))
    for _ in range(rounds):
        books = _refined(vectors, books, dim)
    return books


def _refined(vectors: DataFrame, books: np.ndarray, dim: int) -> np.ndarray:
    parts, entries, wide = books.shape

    def sums(batches):
        annuli = [Annuli(b) for b in books]
        total, count = np.zeros((parts * entries, wide), np.int64), np.zeros(parts * entries, np.int64)
        for _, x in _blocks(batches, 0, dim):
            for p in range(parts):
                own = x[:, p * wide : (p + 1) * wide]
                best = annuli[p].nearest(own)[0] + p * entries
                np.add.at(total, best, own)
                count += np.bincount(best, minlength=parts * entries)
        used = np.flatnonzero(count)
        if len(used):
            flat = pa.array(total[used].ravel())
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * wide), flat)], names=["entry", "n", "total"])

    partial = vectors.select("values").mapInArrow(sums, "entry long, n long, total array<long>")
    merged = partial.groupBy("entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(wide)]).alias("total"))
    out = books.reshape(parts * entries, wide).copy()
    for row in merged.collect():  # one row per entry of the codebooks
        out[row["entry"]] = [t // row["n"] for t in row["total"]]
    return out.reshape(books.shape)


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code`` (one byte a part), ``error`` (squared distance)
    and ``compared`` (entries inside the annuli) of ``kept_vectors``."""
    reach_workers(vectors.sparkSession)
    parts, entries, wide = books.shape
    if entries > 256:
        raise ValueError("a code has one byte for a part: at most 256 entries")
    ids = vectors.schema["vec_id"].dataType.simpleString()
    kind = vectors.schema["label"].dataType.simpleString()

    def run(batches):
        annuli = [Annuli(b) for b in books]
        for batch, x in _blocks(batches, 2, parts * wide):
            code, error, seen = np.empty((len(x), parts), np.uint8), np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
            for p in range(parts):
                best, away, n = annuli[p].nearest(x[:, p * wide : (p + 1) * wide])
                code[:, p] = best
                error += away
                seen += n
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error), pa.array(seen)], names=["vec_id", "label", "code", "error", "compared"])

    return vectors.select("vec_id", "label", "values").mapInArrow(run, f"vec_id {ids}, label {kind}, code binary, error long, compared long")


def decode(coded: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, vector``: what the codes stand for, as doubles (the
    middle of each integer's interval)."""
    reach_workers(coded.sparkSession)
    parts = len(books)
    ids, kind = (coded.schema[c].dataType.simpleString() for c in ("vec_id", "label"))

    def run(batches):
        for batch in batches:
            raw = batch.column(2).to_pylist()
            code = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, parts)
            x = np.concatenate([books[p][code[:, p]] for p in range(parts)], axis=1)
            flat = pa.array(((x + 0.5) / SCALE).ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(np.arange(len(raw) + 1, dtype=np.int32) * x.shape[1]), flat)], names=["vec_id", "label", "vector"])

    return coded.select("vec_id", "label", "code").mapInArrow(run, f"vec_id {ids}, label {kind}, vector array<double>")


def fingerprint_of(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def code_digest(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, code`` (hex), ``error, label_error, codebooks_sha256``. Errors
    are summed for each label before they are shuffled, then joined back."""
    vectors = kept_vectors(table, id_col, vector, label, PARTS)
    books = train(vectors)
    coded = materialize(encode(vectors, books), "codes")
    per_label = materialize(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "labels")
    joined = coded.join(per_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(fingerprint_of(books)).alias("codebooks_sha256"))
