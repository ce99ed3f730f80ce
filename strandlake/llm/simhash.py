"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are computed from whole texts where they lie. Distinct
fingerprints are dealt over a square grid of cells; a cell sorts its two sides
by the population counts of their 16-bit parts and compares tile against tile
with exclusive-or and bit counts, skipping tile pairs whose population counts
already differ by more than the radius (the sum of the parts' count gaps never
exceeds the Hamming distance, so nothing is lost). A cell emits only a
spanning forest of what it links, never all pairs of a group.

Null or wordless texts have fingerprint zero and link like any other. Null ids
never become a component's id unless all its ids are null. Repeated rows keep
one result row each, as do different texts of one id. Texts of any length are
read whole. An empty table gives an empty result. Columns other than id and
text are ignored by ``fingerprint`` and pass through ``drop_near_duplicates``
untouched, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, by_block, discard, drop_path, materialize, small_batches, stable, with_own_block, with_row_id, without_rows
from .components import connected_components

TILE = 256
SMALL, BLOCK = 16_384, 131_072
GROUP_BLOCK, GROUP_BYTES, SET_BYTES = 512, 16 << 20, 4 << 20


def _bits(hashes: np.ndarray) -> np.ndarray:
    """Majority bits of an (n, bytes) array of hash digests."""
    n, total = len(hashes), 0
    for i in range(0, n, 65_536):
        total = total + np.unpackbits(hashes[i : i + 65_536], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * total > n)


def shingle_places(tokens: list[bytes], words: int) -> tuple[bytes, list[int], list[int]]:
    """The words joined by spaces, and where each shingle starts and stops."""
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    k = min(words, len(tokens))
    return b" ".join(tokens), np.concatenate([[0], ends[: len(tokens) - k]]).tolist(), (ends[k - 1 :] - 1).tolist()


def text_fingerprint(text: bytes | None, words: int, bits: int) -> bytes:
    """Fingerprint of one UTF-8 text, as big-endian bytes."""
    import xxhash

    tokens = (text or b"").lower().split()
    if not tokens:
        return bytes(bits // 8)
    joined, starts, stops = shingle_places(tokens, words)
    if bits == 64:
        digest = xxhash.xxh64_intdigest
        out = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops)], np.uint64)
        table = out.astype(">u8").view(np.uint8).reshape(-1, 8)
    else:
        wide = xxhash.xxh3_128_digest
        table = np.frombuffer(b"".join([wide(joined[a:b], 42) for a, b in zip(starts, stops)]), np.uint8).reshape(-1, 16)
    return _bits(table).tobytes()


def fingerprint(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), words: int = 4, bits: int = 64) -> DataFrame:
    """The columns ``keep`` and ``fp``: the fingerprint as ``bits / 8`` bytes
    (64 bits: majority over XXH64 with seed 42; 128: over XXH3-128)."""
    small_batches(docs.sparkSession)
    slim = docs.select(*keep, F.col(text).cast("binary").alias("__sl_text"))

    def run(batches):
        for batch in batches:
            fps = [text_fingerprint(t, words, bits) for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(fps, pa.binary())], names=[*keep, "fp"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema[: len(keep)])
    return slim.mapInArrow(run, f"{schema}, fp binary")


def _parts(values: np.ndarray) -> np.ndarray:
    """Population counts of the 16-bit parts of (n, w) 64-bit words."""
    return np.bitwise_count(np.ascontiguousarray(values).view(np.uint16)).astype(np.int16)


def _tiles(values: np.ndarray, sizes: np.ndarray):
    """Order that puts like sizes and equal part counts together, and each
    tile's box of counts and sizes."""
    parts = _parts(values)
    order = np.lexsort((*parts.T[::-1], parts.sum(axis=1), np.log(np.maximum(sizes, 1)) // 0.1))
    parts = parts[order]
    cuts = np.arange(0, len(order), TILE)
    low, high = np.minimum.reduceat(parts, cuts, axis=0), np.maximum.reduceat(parts, cuts, axis=0)
    total = parts.sum(axis=1)
    sizes = sizes[order]
    return order, cuts, low, high, np.minimum.reduceat(total, cuts), np.maximum.reduceat(total, cuts), np.minimum.reduceat(sizes, cuts), np.maximum.reduceat(sizes, cuts)


def _hook(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the pairs (a, b) in the forest ``label``."""
    while len(a):
        ra, rb = label[a], label[b]
        while True:
            na, nb = label[ra], label[rb]
            if (na == ra).all() and (nb == rb).all():
                break
            ra, rb = na, nb
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))


def near_pairs(left: np.ndarray, right: np.ndarray | None, radius: int, sizes: np.ndarray | None = None, similarity: float = 0.0, odd: bool = False):
    """``(i, j, distance)`` arrays of all pairs within ``radius`` between the
    sides (of one side where ``right`` is None), as positions in left + right,
    tile by tile. Pairs of one side may come in both orders. With ``sizes`` (of
    the sets, of left + right) pairs whose sizes rule out ``similarity`` are
    left out, and with ``odd`` those that differ in more bits than so similar
    sets differ in shingles."""
    if len(left) == 0 or (right is not None and len(right) == 0):
        return
    if sizes is None:
        sizes = np.ones(len(left) + (0 if right is None else len(right)), np.int64)
    share = (1 - similarity) / (1 + similarity)
    lo, lcut, lmin, lmax, ltmin, ltmax, lsmin, lsmax = mine = _tiles(left, sizes[: len(left)])
    ro, rcut, rmin, rmax, rtmin, rtmax, rsmin, rsmax = mine if right is None else _tiles(right, sizes[len(left) :])
    lv = left[lo]
    rv = lv if right is None else right[ro]
    rpos = lo if right is None else ro + len(left)
    for t in range(len(lcut)):
        gap = np.maximum(0, np.maximum(lmin[t] - rmax, rmin - lmax[t])).sum(axis=1)
        total = np.maximum(ltmin[t] - rtmax, rtmin - ltmax[t])
        most = np.minimum(radius, share * (lsmax[t] + rsmax) + 1e-6) if odd else np.full(len(rcut), radius)
        alike = (rsmax >= similarity * lsmin[t] - 1e-6) & (lsmax[t] >= similarity * rsmin - 1e-6)
        near = np.flatnonzero((gap <= most) & (total <= most) & alike)
        if right is None:
            near = near[near >= t]
        mine = lv[lcut[t] : lcut[t] + TILE]
        for group in range(0, len(near), 8):
            cols = np.concatenate([np.arange(rcut[x], min(rcut[x] + TILE, len(rv))) for x in near[group : group + 8]])
            distance = np.bitwise_count(mine[:, None, 0] ^ rv[None, cols, 0])
            for w in range(1, left.shape[1]):
                distance = distance + np.bitwise_count(mine[:, None, w] ^ rv[None, cols, w])
            i, j = np.nonzero(distance <= most[near[group : group + 8]].max())
            if not len(i):
                continue
            i, j, d = lo[lcut[t] + i], rpos[cols[j]], distance[i, j]
            small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
            able = small >= similarity * large - 1e-6
            if odd:
                able &= d <= share * (small + large) + 1e-6
            yield i[able], j[able], d[able]


def _settled(label: np.ndarray) -> np.ndarray:
    while True:
        deeper = label[label]
        if (deeper == label).all():
            return label
        label = deeper


def link_cell(left: np.ndarray, right: np.ndarray | None, radius: int, sizes: np.ndarray | None = None, similarity: float = 0.0, odd: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest, as (node, root) positions in left + right, of the pairs
    of ``near_pairs``."""
    label = np.arange(len(left) + (0 if right is None else len(right)))
    for i, j, _ in near_pairs(left, right, radius, sizes, similarity, odd):
        _hook(label, i, j)
    label = _settled(label)
    linked = np.flatnonzero(label != np.arange(len(label)))
    return linked, label[linked]


def similar_in_cell(sets: list[np.ndarray], cut: int, sketches: list[tuple[np.ndarray, np.ndarray, bool]], radius: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest, as (node, root), of the candidates whose ``sets``
    (sorted) have at least ``similarity``; the first ``cut`` of them are
    compared with the others, or with one another where there are none.
    ``sketches``: places, their sketches, whether these are odd ones. Closest
    pairs are compared first; pairs already joined need no comparison."""
    sizes = np.array([len(x) for x in sets])
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for places, values, odd in sketches:
        first = places < cut
        order = np.concatenate([places[first], places[~first]])
        sides = (values, None) if cut == len(sets) else (values[first], values[~first])
        for i, j, d in near_pairs(*sides, radius, sizes[order], similarity, odd):
            i, j, d = order[i[i != j]], order[j[i != j]], d[i != j]
            for x in np.argsort(d, kind="stable").tolist():
                a, b = int(i[x]), int(j[x])
                ra, rb = find(a), find(b)
                if ra != rb:
                    both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    if both >= similarity * (sizes[a] + sizes[b] - both):
                        parent[max(ra, rb)] = min(ra, rb)
    root = np.array([find(x) for x in range(len(sets))], np.int64)
    linked = np.flatnonzero(root != np.arange(len(root)))
    return linked, root[linked]


def grid_side(n: int) -> int:
    """Blocks along a side of the grid: enough to keep some dozens of tasks
    busy, more where a block would exceed ``BLOCK`` rows. Each row is sent to
    that many cells."""
    return max(4 if n <= SMALL else 8, math.ceil(n / BLOCK))


def fingerprint_edges(distinct: DataFrame, radius: int, bits: int, similarity: float = 0.0, odd: bool = False) -> DataFrame:
    """Spanning forests of the links of ``near_pairs``, over all pairs of cells
    of a grid: ``distinct`` has node long, fp binary and size int, one row per
    node."""
    side = grid_side(distinct.count())
    width = bits // 64
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    cells = (
        distinct.withColumn("mine", F.pmod(F.xxhash64("node"), F.lit(side)).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(side - 1))))
        .select(((high * (high + 1) / 2).cast("int") + low).alias("cell"), (F.col("mine") <= F.col("other")).alias("first"), (F.col("mine") == F.col("other")).alias("alone"), "node", "fp", "size")
    )

    def compare(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        # cells are numbered, and each number is a partition of its own
        table = pa.Table.from_batches(held)
        nodes, sizes = table.column("node").to_numpy(), table.column("size").to_numpy()
        fps = np.frombuffer(b"".join(table.column("fp").to_pylist()), ">u8").astype(np.uint64).reshape(-1, width)
        first = table.column("first").to_numpy()
        one = bool(table.column("alone")[0].as_py())
        order = np.arange(len(nodes)) if one else np.concatenate([np.flatnonzero(first), np.flatnonzero(~first)])
        sides = (fps, None) if one else (fps[first], fps[~first])
        node, root = link_cell(*sides, radius, sizes[order], similarity, odd)
        yield pa.RecordBatch.from_arrays([pa.array(nodes[order[node]]), pa.array(nodes[order[root]])], names=["a", "b"])

    return cells.repartitionById(side * (side + 1) // 2, "cell").drop("cell").mapInArrow(compare, "a long, b long")


def link_fingerprints(distinct: DataFrame, radius: int, bits: int) -> DataFrame:
    """``node, root`` of the fingerprints linked within ``radius``: ``distinct``
    has node long and fp binary, one row per fingerprint."""
    return connected_components(fingerprint_edges(distinct.withColumn("size", F.lit(1)), radius, bits))


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a whole text."""
    import xxhash

    tokens = (text or b"").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined, starts, stops = shingle_places(tokens, words)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b]) for a, b in zip(starts, stops)], np.uint64))


def _mixed(values: np.ndarray) -> np.ndarray:
    """64-bit numbers, mixed anew (the finalizer of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def majority_sketch(shingles: np.ndarray, bits: int) -> bytes:
    """Majority bits over distinct shingles."""
    if not len(shingles):
        return bytes(bits // 8)
    steps = np.arange(1, bits // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return _bits(_mixed(shingles[:, None] + steps).view(np.uint8).reshape(len(shingles), -1)).tobytes()


def odd_sketch(shingles: np.ndarray, bits: int) -> bytes:
    """Every shingle flips one bit, so two sketches never differ in more bits
    than the sets have shingles in which they differ."""
    at = (_mixed(shingles) % np.uint64(bits)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1).tobytes()


def reach_of(radius: int, similarity: float) -> tuple[int, int, int]:
    """Sizes of shingle sets: the least one that a different set can resemble,
    the largest whose partners all differ in at most ``radius`` shingles, and
    the largest such partner."""
    odds = similarity / max(1 - similarity, 1e-9)
    border = int(radius * odds + 1e-6)
    return math.ceil(odds - 1e-6), border, int(border / similarity + 1e-6)


def set_fingerprints(docs: DataFrame, text: str, keep: tuple[str, ...], words: int, bits: int, upper: int) -> DataFrame:
    """The columns ``keep``, ``node`` (a hash of the whole shingle set), its
    ``size``, ``fp`` (the majority sketch) and ``odd`` (the odd sketch, of sets
    of at most ``upper`` shingles). Documents of equal sets share a node, others
    don't, whatever their fingerprints."""
    import xxhash

    small_batches(docs.sparkSession)
    slim = docs.select(*keep, F.col(text).cast("binary").alias("__sl_text"))

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t, words) for t in batch.column(len(keep)).to_pylist()]
            nodes = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in sets], np.uint64).view(np.int64)
            fps = [majority_sketch(x, bits) for x in sets]
            odd = [odd_sketch(x, bits) if len(x) <= upper else None for x in sets]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(nodes), pa.array([len(x) for x in sets], pa.int32()), pa.array(fps, pa.binary()), pa.array(odd, pa.binary())], names=[*keep, "node", "size", "fp", "odd"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema[: len(keep)])
    return slim.mapInArrow(run, f"{schema}, node long, size int, fp binary, odd binary")


def link_similar(distinct: DataFrame, radius: int, bits: int, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """``node, root`` where shingle sets have at least ``similarity`` (Jaccard).
    ``distinct`` has one row per shingle set (see ``set_fingerprints``), and
    ``at``, the row of one of its documents; ``texts``: body, ROW.

    Candidates among small sets are those whose odd sketches allow it, which
    loses no pair; among larger ones those whose majority sketches are within
    ``radius``. Groups of candidates are cut into blocks, bounded by number and
    by bytes, and every pair of blocks is a cell that compares its candidates
    exactly and emits a spanning forest.
    """
    width = bits // 64
    least, border, upper = reach_of(radius, similarity)
    small = distinct.where(F.col("size").between(least, upper)).select("node", "size", F.col("odd").alias("fp"))
    large = distinct.where(F.col("size") > border).select("node", "size", "fp")
    edges = fingerprint_edges(small, radius, bits, similarity, True).unionByName(fingerprint_edges(large, radius, bits, similarity))
    groups = materialize(connected_components(edges), "candidates")
    wanted = by_block(distinct.join(groups, "node").select("root", "node", "fp", "odd", F.col("at").alias(ROW)), texts, "wanted")
    carried = ["root", "node", "fp", "odd"]

    def sets_of(batches):
        for batch, table in with_own_block(batches, wanted, [ROW, *carried]):
            rows = np.asarray(table.column(ROW), np.int64)
            order = np.argsort(rows)
            mine = batch.column(1).to_numpy()
            at = np.searchsorted(rows[order], mine)
            found = np.flatnonzero(at < len(rows))
            found = found[rows[order[at[found]]] == mine[found]]
            there = table.take(pa.array(order[at[found]])).combine_chunks()
            texts_found = batch.column(0).take(pa.array(found))
            begin, sets, held = 0, [], 0
            for i in range(len(found)):  # long texts in a row leave in parts
                sets.append(shingle_set(texts_found[i].as_py(), words).tobytes())
                held += len(sets[-1])
                if held >= SET_BYTES or i == len(found) - 1:
                    part = there.slice(begin, i + 1 - begin)
                    yield from pa.table([*(part.column(c) for c in carried), pa.array(sets, pa.binary())], names=[*carried, "shingles"]).to_batches()
                    begin, sets, held = i + 1, [], 0

    members = materialize(texts.mapInArrow(sets_of, "root long, node long, fp binary, odd binary, shingles binary"), "shingles")
    sizes = materialize(members.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / F.lit(GROUP_BLOCK), F.sum(F.octet_length("shingles")) / F.lit(GROUP_BYTES))).cast("int").alias("blocks")), "blocks")
    cells = (
        members.join(sizes, "root")
        .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("root", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "fp", "odd", "shingles")
    )

    def compare(batches):
        from .embeddings import groups as sorted_groups

        for (_, i, j), table in sorted_groups(batches, 3):
            if table.num_rows < 2:
                continue
            nodes = table.column("node").to_numpy()
            mine = table.column("mine").to_numpy()
            order = np.arange(len(nodes)) if i == j else np.concatenate([np.flatnonzero(mine == i), np.flatnonzero(mine != i)])
            cut = len(nodes) if i == j else int((mine == i).sum())
            if i != j and cut in (0, len(nodes)):
                continue
            fps, odds, sets = (table.column(c).to_pylist() for c in ("fp", "odd", "shingles"))
            nodes, sets = nodes[order], [np.frombuffer(sets[x], np.uint64) for x in order.tolist()]
            sizes, sketches = np.array([len(x) for x in sets]), []
            for places, raw, odd in ((np.flatnonzero(sizes <= upper), odds, True), (np.flatnonzero(sizes > border), fps, False)):
                values = np.frombuffer(b"".join(raw[x] for x in order[places].tolist()), ">u8").astype(np.uint64).reshape(-1, width)
                sketches.append((places, values, odd))
            node, root = similar_in_cell(sets, cut, sketches, radius, similarity)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[node]), pa.array(nodes[root])], names=["a", "b"])

    edges = cells.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(compare, "a long, b long")
    roots = materialize(connected_components(edges), "similar")
    for table in (groups, members, sizes):
        discard(table)
    drop_path(texts.sparkSession, wanted.path)
    return roots


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 4, bits: int = 64, radius: int = 4, keep_row: bool = False, similarity: float | None = None) -> DataFrame:
    """One row per document: ``id_col``, ``fp`` and ``component_id``, the
    smallest id reachable over links. Fingerprints link within ``radius``
    differing bits; with ``similarity``, the radius makes candidates, whose
    shingle sets are then compared (see ``link_similar``).

    With ``similarity`` nodes are shingle sets, named by a 64-bit hash; else
    they are fingerprints, with ``bits=128`` named by one, too. ``keep_row``
    adds ROW and ``group``, which is the same within a component alone.
    """
    rowed = keep_row or similarity is not None
    keep = (id_col, ROW) if rowed else (id_col,)
    docs = stable(docs) if rowed else docs
    made = fingerprint(with_row_id(docs) if rowed else docs, text, keep, words, bits) if similarity is None else set_fingerprints(with_row_id(docs), text, keep, words, bits, reach_of(radius, similarity)[2])
    rows = materialize(made.withColumnRenamed(id_col, "__sl_id"), "fingerprints")
    if similarity is None:
        rows = rows.withColumn("node", F.conv(F.hex("fp"), 16, -10).cast("long") if bits == 64 else F.xxhash64("fp"))
    # any one row of a node will do; by a hash, so that they lie in all files
    first_row = [F.min_by(ROW, F.xxhash64(ROW)).alias("at")] if rowed else []
    if similarity is not None:
        first_row += [F.first("size").alias("size"), F.first("odd").alias("odd")]
    distinct = materialize(rows.groupBy("node").agg(F.first("fp").alias("fp"), F.min("__sl_id").alias("least"), *first_row), "distinct")
    if similarity is None:
        roots = materialize(link_fingerprints(distinct.select("node", "fp"), radius, bits), "roots")
    else:
        texts = with_row_id(docs.select(F.col(text).cast("binary").alias("body")))
        roots = link_similar(distinct, radius, bits, texts, words, similarity)
    grouped = roots.join(distinct, "node")
    best = materialize(grouped.groupBy("root").agg(F.min("least").alias("component")), "best")
    reached = roots.join(best, "root").select("node", "root", "component")
    named = materialize(distinct.join(reached, "node", "left").select("node", F.coalesce("root", "node").alias("group"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component")).alias("component_id")), "named")
    for table in (distinct, roots, best):
        discard(table)
    return rows.join(named, "node").select(F.col("__sl_id").alias(id_col), *([ROW, "group"] if keep_row else []), "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 5, bits: int = 256, radius: int = 62, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id
    (ties: the first in the input). Pairs of which one has at most 4 * 62 = 248
    distinct shingles are all found. Of larger sets at a Jaccard similarity of
    just 0.8 two fingerprints of 256 bits differ in 256 * acos(2 * 0.8 / 1.8) /
    pi = 38.8 bits on average, with a deviation of 5.7, so radius 62 misses
    about one pair in 30,000 there, and fewer the more alike they are.
    """
    docs = stable(docs)
    rows = near_duplicates(docs, id_col, text, words, bits, radius, keep_row=True, similarity=similarity)
    rows = materialize(rows.select(ROW, F.col(id_col).alias("id"), "group"), "members")
    first = materialize(rows.groupBy("group").agg(F.min_by(ROW, F.struct(F.col("id").isNull(), "id", ROW)).alias("first")), "first")
    lost = rows.join(first, "group").where(F.col(ROW) != F.col("first")).select(ROW)
    return without_rows(docs, lost)
