"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by document: one row is a segment of whole documents
with the postings (term, positions) of every term in it: the distinct terms,
the length of each one's list, and all lists in a row. Positions run through
the segment with a gap after each document, so no phrase can cross documents.
A search visits every segment once, takes a phrase's terms from the rarest (by
their count in the whole corpus) to the most frequent, and intersects their
lists after subtracting each term's offset in the phrase, stopping as soon as
nothing is left. The index doesn't depend on the benchmark.

The benchmark is read in blocks of at most ``BLOCK_BYTES`` of text, checked
before anything is sent to executors; a larger benchmark makes more blocks,
each searched over the same index, whose spans are merged per document. A
single item is never split, so one block may exceed the bound by one item.

Nulls and texts without words have no words and are never hit. Repeated rows
are separate documents, whatever their ids; items of one id count as one item.
A text of any length is one document of a segment. An empty benchmark leaves
every document clean, an empty table gives an empty result. Item ids may have
any plain type; a null id is an item, though it has no place in the digest's
list. Extra columns, whatever their names, pass through ``decontaminate``
untouched.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from .common import ROW, discard, materialize, small_batches, stable, with_row_id, without_rows

WINDOW = 10
BLOCK_BYTES = 1 << 20
SEGMENT_WORDS = 1_000_000

#: Fixed by the contract: ASCII letters and digits and everything beyond ASCII
#: make words, A-Z in lower case.
_WORDS = bytes(ord(chr(i).lower()) if chr(i).isascii() and chr(i).isalnum() else i if i > 127 else 32 for i in range(256))

SEGMENT_SCHEMA = "segment long, n_words binary, doc_key binary, terms array<binary>, lengths binary, gaps binary"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORDS).split()


def windows_of(tokens: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    if not tokens:
        return []
    return list(dict.fromkeys(tuple(tokens[i : i + size]) for i in range(max(1, len(tokens) - size + 1))))


class Phrases:
    """The distinct windows of one block of benchmark items."""

    def __init__(self, items: list[tuple], size: int):
        found: dict[tuple[bytes, ...], set] = {}
        self.item_words = {}
        for item, text in items:
            tokens = words_of(text)
            if tokens:
                self.item_words.setdefault(item, []).append(tokens)
            for window in windows_of(tokens, size):
                found.setdefault(window, set()).add(item)
        #: Numbers of the terms, in ascending order of insertion.
        self.term = {t: i for i, t in enumerate(dict.fromkeys(t for w in found for t in w))}
        self.windows = [tuple(self.term[t] for t in w) for w in found]
        self.items = [list(x) for x in found.values()]

    def ordered(self, counts: np.ndarray) -> np.ndarray:
        """Each window's (term, offset) pairs from the rarest term on, filled
        up with (-1, -1)."""
        longest = max(map(len, self.windows), default=1)
        out = np.full((len(self.windows), longest, 2), -1, np.int32)
        for i, w in enumerate(self.windows):
            out[i, : len(w)] = sorted(((t, o) for o, t in enumerate(w)), key=lambda p: (counts[p[0]], p))
        return out


def build_index(docs: DataFrame, text: str = "text", segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Segments of positional postings of all terms, over whole texts; ``docs``
    carries ROW. One index serves any number of benchmarks."""
    small_batches(docs.sparkSession)
    slim = docs.select(ROW, F.col(text).cast("binary").alias("__sl_text"))

    def run(batches):
        keys: list[int] = []
        sizes: list[int] = []
        tokens: list[bytes] = []

        def flush():
            coded = pa.array(tokens, pa.binary()).dictionary_encode()
            codes = coded.indices.to_numpy()
            places = np.arange(len(codes), dtype=np.int32) + np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            order = np.argsort(codes, kind="stable")
            lengths = np.bincount(codes, minlength=len(coded.dictionary))
            lists = places[order]
            gaps = np.diff(lists, prepend=np.int32(0))
            begins = np.cumsum(lengths) - lengths
            gaps[begins] = lists[begins]  # each list starts with its first place, then come gaps
            terms = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
            arrays = [pa.array([x.tobytes()], pa.binary()) for x in (np.array(sizes, "<i8"), np.array(keys, "<i8"), lengths.astype("<i4"), gaps.astype("<i4"))]
            return pa.RecordBatch.from_arrays([pa.array([keys[0]], pa.int64()), arrays[0], arrays[1], terms, arrays[2], arrays[3]], names=["segment", "n_words", "doc_key", "terms", "lengths", "gaps"])

        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = words_of(value)
                keys.append(key)
                sizes.append(len(found))
                tokens += found
                if len(tokens) + len(keys) >= segment_words:
                    yield flush()
                    keys, sizes, tokens = [], [], []
        if keys:
            yield flush()

    return slim.mapInArrow(run, SEGMENT_SCHEMA)


class Segment:
    """One row of the index, opened for searching the terms ``wanted``, which
    go by their numbers in that array."""

    def __init__(self, n_words: bytes, doc_key: bytes, terms: pa.Array, lengths: bytes, gaps: bytes, wanted: pa.Array):
        self.sizes = np.frombuffer(n_words, "<i8")
        self.keys = np.frombuffer(doc_key, "<i8")
        self.bases = np.concatenate([[0], np.cumsum(self.sizes + 1)[:-1]]).astype(np.int64)
        flat, stops = np.frombuffer(gaps, "<i4"), np.cumsum(np.frombuffer(lengths, "<i4"), dtype=np.int64)
        number, at = found_in(wanted, terms)
        self.lists = {n: np.cumsum(flat[stops[k - 1] if k else 0 : stops[k]], dtype=np.int32) for n, k in zip(number.tolist(), at.tolist())}

    def phrase(self, ordered: list[list[int]]) -> np.ndarray:
        """Start positions of an exact phrase."""
        ordered = [x for x in ordered if x[0] >= 0]
        for t, _ in ordered:
            if t not in self.lists:
                return np.zeros(0, np.int64)
        (t, o), *rest = ordered
        starts = self.lists[t] - o
        for t, o in rest:
            if not len(starts):
                break
            have = self.lists[t]
            at = np.searchsorted(have, starts + o)
            at[at == len(have)] = 0
            starts = starts[have[at] == starts + o]
        return starts

    def near(self, terms: list[int], slop: int, counts: np.ndarray) -> np.ndarray:
        """(first, last) positions of all stretches of at most ``slop`` words
        that hold every one of ``terms`` (a repeated one as often), from each
        term that can begin one to the nearest end."""
        need = Counter(terms)
        order = sorted(need, key=lambda t: (counts[t], t))
        if not order or any(t not in self.lists for t in order):
            return np.zeros((0, 2), np.int64)
        lists = [self.lists[t].astype(np.int64) for t in order]
        anchor = lists[0]
        for t, have in zip(order, lists):
            anchor = anchor[np.searchsorted(have, anchor + slop) - np.searchsorted(have, anchor - slop, side="right") >= need[t]]
        starts = []
        for have in lists:
            low, high = np.searchsorted(have, anchor - slop, side="right"), np.searchsorted(have, anchor, side="right")
            n = high - low
            starts.append(have[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())])
        first = np.unique(np.concatenate(starts))
        last, good = first, np.ones(len(first), bool)
        for t, have in zip(order, lists):
            at = np.searchsorted(have, first) + need[t] - 1
            good &= at < len(have)
            last = np.maximum(last, have[np.minimum(at, len(have) - 1)])
        doc = np.searchsorted(self.bases, first, side="right") - 1
        good &= (last - first < slop) & (last < self.bases[doc] + self.sizes[doc])
        return np.stack([first[good], last[good]], axis=1)


def found_in(wanted: pa.Array, terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` are among ``terms``, and where."""
    at = pc.index_in(wanted, value_set=terms)
    number = np.flatnonzero(pc.is_valid(at).to_numpy(zero_copy_only=False))
    return number, at.take(pa.array(number)).to_numpy()


def corpus_counts(index: DataFrame, wanted: list[bytes]) -> np.ndarray:
    """How often each of ``wanted`` occurs in the corpus; as many numbers reach
    the driver, whatever the corpus."""

    def run(batches):
        names, total = pa.array(wanted, pa.binary()), np.zeros(len(wanted), np.int64)
        for batch in batches:
            for i, n in enumerate(batch.column(1).to_pylist()):
                number, at = found_in(names, batch.column(0)[i].values)
                total[number] += np.frombuffer(n, "<i4")[at]
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int64)), pa.array(total[seen])], names=["term", "n"])

    counts = np.zeros(len(wanted), np.int64)
    for row in index.select("terms", "lengths").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row["term"]] = row["n"]
    return counts


def _blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> list[list[tuple[int, bytes]]]:
    """The benchmark in blocks by size; items stream in one at a time."""
    total = benchmark.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    if total > 256 * limit:
        raise ValueError(f"a benchmark of {total} bytes needs over 256 passes; raise block_bytes")
    blocks: list[list[tuple[int, bytes]]] = [[]]
    held = 0
    for row in benchmark.select(F.col(item).alias("i"), F.col(text).cast("binary").alias("t")).toLocalIterator():
        value = bytes(row["t"] or b"")
        if held and held + len(value) > limit:
            blocks.append([])
            held = 0
        blocks[-1].append((row["i"], value))
        held += len(value)
    return blocks


def search(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, slop: int | None = None, block_bytes: int = BLOCK_BYTES, index: DataFrame | None = None) -> DataFrame:
    """Per document row (ROW): ``n_words``, ``spans`` (array of first word and
    length, merged and ascending) and ``items`` (ids found in it). ``docs``
    carries ROW; ``index`` is what ``build_index`` made of it, if that is at
    hand. With ``slop``, an item is found where all its terms lie within that
    many words instead of by exact windows."""
    index = index if index is not None else materialize(build_index(docs, text), "postings")
    kind = benchmark.schema[item_id].dataType
    parts = []
    for block in _blocks(benchmark, item_id, item_text, block_bytes):
        phrases = Phrases(block, window)
        counts = corpus_counts(index, list(phrases.term)) if phrases.term else np.zeros(0, np.int64)
        parts.append(_search_block(index, phrases, counts, slop, kind))
    if len(parts) == 1:
        return parts[0]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    grouped = merged.groupBy(ROW).agg(F.max("n_words").alias("n_words"), F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    joined = F.expr(
        """aggregate(spans, cast(array() as array<struct<first:bigint,length:bigint>>), (acc, s) ->
             case when size(acc) > 0 and s.first <= element_at(acc, -1).first + element_at(acc, -1).length
                  then concat(slice(acc, 1, size(acc) - 1), array(named_struct('first', element_at(acc, -1).first, 'length',
                       greatest(element_at(acc, -1).length, s.first + s.length - element_at(acc, -1).first))))
                  else concat(acc, array(s)) end)"""
    )
    return grouped.select(ROW, "n_words", joined.alias("spans"), "items")


def _search_block(index: DataFrame, phrases: Phrases, counts: np.ndarray, slop: int | None, kind: DataType) -> DataFrame:
    ordered = phrases.ordered(counts)
    items = phrases.items
    lengths = [len(w) for w in phrases.windows]
    bags = [(item, [phrases.term[t] for t in tokens]) for item, lists in phrases.item_words.items() for tokens in lists]
    span = pa.struct([("first", pa.int64()), ("length", pa.int64())])
    names, item_type = list(phrases.term), to_arrow_type(kind)

    def run(batches):
        wanted = pa.array(names, pa.binary())
        for batch in batches:
            sizes, keys, lengths_of, gaps = (batch.column(c).to_pylist() for c in ("n_words", "doc_key", "lengths", "gaps"))
            for i in range(batch.num_rows):
                segment = Segment(sizes[i], keys[i], batch.column("terms")[i].values, lengths_of[i], gaps[i], wanted)
                found_start, found_stop, found_item = [], [], []
                if slop is None:
                    rarest = np.isin(ordered[:, 0, 0], list(segment.lists)) if len(ordered) else []
                    for w in np.flatnonzero(rarest).tolist():
                        starts, size = segment.phrase(ordered[w].tolist()), lengths[w]
                        if len(starts):
                            for owner in items[w]:
                                found_start.append(starts.astype(np.int64))
                                found_stop.append(starts.astype(np.int64) + size)
                                found_item.append((owner, len(starts)))
                else:
                    for owner, bag in bags:
                        places = segment.near(bag, slop, counts)
                        if len(places):
                            found_start.append(places[:, 0])
                            found_stop.append(places[:, 1] + 1)
                            found_item.append((owner, len(places)))
                spans: dict[int, list] = {}
                owners_of: dict[int, set] = {}
                if found_start:
                    start, stop = np.concatenate(found_start), np.concatenate(found_stop)
                    owner = [o for o, n in found_item for _ in range(n)]
                    doc = np.searchsorted(segment.bases, start, side="right") - 1
                    for d, a, b, o in sorted(zip(doc.tolist(), start.tolist(), stop.tolist(), owner), key=lambda x: x[:3]):
                        owners_of.setdefault(d, set()).add(o)
                        have = spans.setdefault(d, [])
                        if have and a <= have[-1][1]:
                            have[-1][1] = max(have[-1][1], b)
                        else:
                            have.append([a, b])
                base = segment.bases
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(segment.keys),
                        pa.array(segment.sizes),
                        pa.array([[{"first": a - int(base[d]), "length": b - a} for a, b in spans.get(d, ())] for d in range(len(base))], pa.list_(span)),
                        pa.array([list(owners_of.get(d, ())) for d in range(len(base))], pa.list_(item_type)),
                    ],
                    names=[ROW, "n_words", "spans", "items"],
                )

    return index.mapInArrow(run, f"`{ROW}` long, n_words long, spans array<struct<first: long, length: long>>, items array<{kind.simpleString()}>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark window."""
    docs = stable(docs)
    index = materialize(build_index(with_row_id(docs), text), "postings")
    found = search(with_row_id(docs), benchmark, text, index=index)
    hit = materialize(found.where(F.size("spans") > 0).select(ROW), "contaminated")
    discard(index)
    return without_rows(docs, hit)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from the result of ``search`` (and its ids)."""
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["length"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def check_items(items: list[int]) -> str:
    """Python twin of the digest's item hash, for tests."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
