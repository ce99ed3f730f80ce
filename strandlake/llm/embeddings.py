"""Embedding near-duplicates by NN-descent.

Equal vectors of a label form one class, so copies cost nothing more. A first
neighbour graph joins classes that lie close together when sorted by random
hyperplane codes. Rounds of NN-descent refine it: whoever shares a neighbour is
compared, and every class keeps its best ``k``. Edges at the threshold are
links; what they join is a group.

A class whose list is saturated (``k`` entries, all of them links) may have
more. Its list is enlarged until its last entry is below the threshold: entries
of its own group give way to others, found by the same rounds among the
saturated groups, of which only pairs of different groups are compared. An edge
at the threshold joins two groups and the rounds go on; they end when the best
entry from outside is below it in every list. The links inside a group of three
and more are then counted in blocks, each against each, so no list grows with
its group and nothing is capped. Two classes of different groups are compared
in those rounds and in the audit alone.

The audit takes classes by a hash, ``AUDIT`` and four times the root of all
others, compares them with all classes in double precision, and states which
share of their links lies inside groups (recall). Links that it finds missing
join their groups, and another sample is taken, until one misses nothing. Labels
in which ``AUDITS`` samples in a row have found something missing, and only
these, are compared in blocks as a whole.

Neighbour lists of hubs are split into blocks, so no task holds an unbounded
list; blocks of vectors are bounded in bytes. Nothing is broadcast; counts,
recall and the wanting labels' number go to the driver.

Null labels, and vectors that are null, zero, or hold null or non-finite
components, link with nothing and stand alone; vectors of different lengths
never link. Repeated rows are vectors of their own, and so are rows of one id.
Lists of neighbours break ties by number; no result depends on them. An empty
table gives an empty result. Columns other than id, vector and label aren't
read, whatever their names.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, drop_path, fresh_path, materialize, shared_fs
from .components import connected_components

log = logging.getLogger(__name__)

K, TABLES, WINDOW, ROUNDS, MERGES = 8, 10, 12, 2, 20
HUB = 512
TILE, SMALL, BLOCK_BYTES = 256, 1024, 32 << 20
AUDIT, AUDITS, AUDIT_BLOCK = 256, 3, 2048
SLACK = 1e-4


@dataclass
class Audit:
    """``recall``: the share of the links of the first sample of ``classes``
    classes that the lists had found; ``rounds``: samples taken; ``wanting``:
    labels that were compared as a whole."""

    recall: float
    classes: int
    rounds: int
    wanting: int


def groups(batches, keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """The groups of sorted rows, whole across batches, by the first columns."""
    held: list[pa.RecordBatch] = []
    last = None

    def key_at(batch, i):
        return tuple(batch.column(c)[i].as_py() for c in range(keys))

    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for c in range(keys):
            values = batch.column(c).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = key_at(batch, a)
            if held and key != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield last, pa.Table.from_batches(held)


def classes_of(table: DataFrame, label: str, vector: str) -> DataFrame:
    """``label, embedding`` classes with ``cls`` (a number), ``unit`` (unit
    vector, doubles), ``brief`` (the same in single precision, for the
    neighbour lists, on which no result depends), ``dim``, ``n`` (rows) and ``least`` (smallest id)."""
    sound = table.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    grouped = sound.groupBy("label", "embedding").agg(F.count("*").alias("n"), F.min("vec").alias("least"))
    kind = grouped.schema["label"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            units, brief, dims = [], [], []
            for values in batch.column(1).to_pylist():
                x = np.array(values, np.float64)
                x = x / (np.abs(x).max() or 1)
                size = np.sqrt(x @ x)
                units.append((x / size).tobytes() if size else None)
                brief.append((x / size).astype(np.float32).tobytes() if size else None)
                dims.append(len(x))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(units, pa.binary()), pa.array(brief, pa.binary()), pa.array(dims, pa.int32())], names=[*batch.schema.names, "unit", "brief", "dim"])

    out = grouped.mapInArrow(run, f"label {kind}, embedding array<double>, n long, least long, unit binary, brief binary, dim int").where("unit IS NOT NULL")
    numbered = materialize(out.withColumn("cls", F.monotonically_increasing_id()), "classes")
    alone = numbered.withColumn("root", F.col("cls"))
    alone._strandlake_path = numbered._strandlake_path
    return alone


def seed_edges(classes: DataFrame, tables: int, seed: int, window: int, threshold: float) -> DataFrame:
    """``src, dst, sim, inside``: near neighbours in the order of hyperplane
    codes, always of another ``root``: the members of one root that lie in a row
    there are passed over, from each of them to what comes before and behind."""
    schema = classes.schema
    kind = schema["label"].dataType.simpleString()

    def codes(batches):
        for batch in batches:
            dims = batch.column(3).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                x = np.frombuffer(b"".join(part.column(4).to_pylist()), np.float32).reshape(part.num_rows, -1)
                for t in range(tables):
                    planes = np.random.default_rng([seed, dim, t]).standard_normal((dim, 40))
                    code = ((x @ planes) > 0) @ (1 << np.arange(40, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array([t] * part.num_rows, pa.int32()), part.column(2), part.column(3), pa.array(code), part.column(0), part.column(1), part.column(4)], names=["t", "label", "dim", "code", "cls", "root", "unit"])

    coded = classes.select("cls", "root", "label", "dim", "brief").mapInArrow(codes, f"t int, label {kind}, dim int, code long, cls long, root long, unit binary")
    ordered = coded.repartitionByRange("t", "label", "dim", "code", "cls").sortWithinPartitions("t", "label", "dim", "code", "cls")

    def sweep(batches):
        held = None
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            n = batch.num_rows
            held = batch.slice(max(0, n - window))
            if n < 2:
                continue
            part = np.zeros(n, np.int64)
            for c in range(3):
                v = batch.column(c).to_numpy(zero_copy_only=False)
                part[1:] |= v[1:] != v[:-1]
            part = np.cumsum(part)
            cls, root = (batch.column(c).to_numpy() for c in (4, 5))
            run = np.concatenate([[0], np.cumsum((root[1:] != root[:-1]) | (part[1:] != part[:-1]))])
            begin, end = np.searchsorted(run, run), np.searchsorted(run, run, side="right")
            raw = batch.column(6).to_pylist()
            src, dst, sim = [], [], []
            for p in range(int(part[-1]) + 1):
                lo, hi = np.searchsorted(part, [p, p + 1])
                if hi - lo < 2:
                    continue
                x = np.frombuffer(b"".join(raw[lo:hi]), np.float32).reshape(hi - lo, -1)
                rows = np.arange(lo, hi)
                other = np.concatenate([end[lo:hi, None] + np.arange(window), begin[lo:hi, None] - 1 - np.arange(window)], axis=1)
                there = (other >= lo) & (other < hi)
                other = np.clip(other, lo, hi - 1)
                near = np.stack([np.einsum("ij,ij->i", x, x[other[:, o] - lo]) for o in range(2 * window)], axis=1)
                near[~there | (root[other] == root[rows][:, None])] = -2
                keep = near >= threshold - SLACK
                np.put_along_axis(keep, np.argsort(-near, axis=1)[:, :3], True, axis=1)
                i, o = np.nonzero(keep & (near > -2))
                src.append(cls[lo + i])
                dst.append(cls[other[i, o]])
                sim.append(near[i, o])
            if src:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (src, dst, sim)], names=["src", "dst", "sim"])

    return ordered.mapInArrow(sweep, "src long, dst long, sim float").withColumns({"fresh": F.lit(True), "inside": F.lit(False)})


def best_lists(edges: DataFrame, k: int) -> DataFrame:
    """The best ``k`` neighbours of each class inside its group, and the best
    ``k`` outside; ``fresh`` edges were not in the lists before."""
    single = edges.groupBy("src", "dst").agg(F.max("sim").alias("sim"), F.min(F.col("fresh").cast("int")).alias("fresh"), F.max("inside").alias("inside"))
    ranked = single.selectExpr("*", "row_number() OVER (PARTITION BY src, inside ORDER BY sim DESC, dst) AS place")
    return ranked.where(F.col("place") <= k).select("src", "dst", "sim", (F.col("fresh") == 1).alias("fresh"), "inside")


def descend(graph: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """One round: all pairs of different groups that share a neighbour, at
    least one of them new to it, where the pair beats the worst of a full list,
    and the lists that the old ones and these pairs make. ``graph`` is
    discarded."""
    both = graph.select(F.col("src").alias("mid"), F.col("dst").alias("who"), "fresh").unionByName(graph.select(F.col("dst").alias("mid"), F.col("src").alias("who"), "fresh"))
    both = both.groupBy("mid", "who").agg(F.max(F.col("fresh").cast("int")).alias("fresh"))
    degree = materialize(both.groupBy("mid").agg(F.count("*").alias("deg"), F.max("fresh").alias("any")), "degree")
    floor = materialize(graph.where("NOT inside").groupBy("src").agg(F.count("*").alias("have"), F.min("sim").alias("worst")).selectExpr("src AS who", f"CASE WHEN have >= {k} THEN worst ELSE cast(-2 AS float) END AS worst"), "floor")
    blocks = F.ceil(F.col("deg") / F.lit(HUB)).cast("int")
    members = both.join(degree.where("any = 1"), "mid").withColumn("block", F.pmod(F.xxhash64("who"), blocks).cast("int"))
    members = members.join(floor, "who", "left").join(classes.select(F.col("cls").alias("who"), "root", "brief"), "who")
    ordered = members.select("mid", "block", "who", "root", "fresh", F.coalesce("worst", F.lit(-2.0).cast("float")).alias("worst"), "brief").repartition("mid", "block").sortWithinPartitions("mid", "block")

    def local(batches):
        src, dst, sim, held = [], [], [], 0
        for _, table in groups(batches, 2):
            if table.num_rows < 2:
                continue
            who, root = (table.column(c).to_numpy() for c in ("who", "root"))
            fresh = table.column("fresh").to_numpy() > 0
            worst = table.column("worst").to_numpy()
            x = np.frombuffer(b"".join(table.column("brief").to_pylist()), np.float32).reshape(len(who), -1)
            s = x @ x.T
            s[~(fresh[:, None] | fresh[None, :]) | (root[:, None] == root[None, :])] = -3
            good = s > worst[:, None]
            if len(who) > k:  # k of each row exactly, however many are alike
                best = np.zeros(s.shape, bool)
                np.put_along_axis(best, np.argpartition(-s, k - 1, axis=1)[:, :k], True, axis=1)
                good &= best
            i, j = np.nonzero(good & (s > -3))
            src.append(who[i])
            dst.append(who[j])
            sim.append(s[i, j].astype(np.float32))
            held += len(i)
            if held > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in (src, dst, sim)], names=["src", "dst", "sim"])
                src, dst, sim, held = [], [], [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in (src, dst, sim)], names=["src", "dst", "sim"])

    found = ordered.mapInArrow(local, "src long, dst long, sim float").withColumns({"fresh": F.lit(True), "inside": F.lit(False)})
    after = materialize(best_lists(graph.withColumn("fresh", F.lit(False)).unionByName(found), k), "graph")
    for table in (degree, floor, graph):
        discard(table)
    return after


def settled(graph: DataFrame, classes: DataFrame, k: int, rounds: int, threshold: float) -> DataFrame:
    """The graph after at most ``rounds`` rounds; fewer where nearly nothing,
    and no link, is new."""
    for _ in range(rounds):
        graph = descend(graph, classes, k)
        n, fresh, strong = graph.agg(F.count("*"), F.count_if("fresh"), F.count_if(F.col("fresh") & (F.col("sim") >= threshold - SLACK))).first()
        if not strong and fresh < 0.001 * n:
            break
    return graph


def regrouped(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` with the roots of the groups that ``links`` (two roots of
    classes) join."""
    roots = connected_components(links).select(F.col("node").alias("root"), F.col("root").alias("__root"))
    joined = classes.join(roots, "root", "left").withColumn("root", F.coalesce("__root", "root")).drop("__root")
    after = materialize(joined.select(*classes.columns), "classes")
    discard(classes)
    return after


def _by_roots(links: DataFrame, classes: DataFrame) -> DataFrame:
    """``src, dst`` as the roots of both."""
    at = classes.select("cls", "root")
    return links.join(at.select(F.col("cls").alias("src"), F.col("root").alias("a")), "src").join(at.select(F.col("cls").alias("dst"), F.col("root").alias("b")), "dst").select("a", "b").distinct()


def enlarged(graph: DataFrame, classes: DataFrame, k: int, tables: int, window: int, rounds: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Lists of saturated groups enlarged until the best entry from outside is
    below the threshold. Returns the classes, regrouped, and the graph."""
    strong = F.col("sim") >= threshold - SLACK
    for turn in range(MERGES):
        full = graph.where(strong).groupBy("src").agg(F.count("*").alias("n")).where(F.col("n") >= k).select(F.col("src").alias("cls"))
        some = materialize(classes.join(full, "cls", "left_semi").select("root").distinct(), "saturated")
        if some.isEmpty():
            break
        inside = materialize(classes.join(some, "root", "left_semi"), "members")
        at = inside.select("cls", "root")
        kept = graph.join(at.select(F.col("cls").alias("src"), F.col("root").alias("a")), "src").join(at.select(F.col("cls").alias("dst"), F.col("root").alias("b")), "dst")
        routes = kept.select("src", "dst", "sim", F.lit(True).alias("fresh"), (F.col("a") == F.col("b")).alias("inside"))
        lists = materialize(best_lists(routes.unionByName(seed_edges(inside, tables, turn + 1, window, threshold)), k), "graph")
        outside = settled(lists, inside, k, min(rounds, 1), threshold)  # what one round misses the next turn may find
        links = materialize(_by_roots(outside.where(strong & ~F.col("inside")).select("src", "dst"), classes), "joined")
        for table in (some, inside, outside):
            discard(table)
        if links.isEmpty():
            break
        classes = regrouped(classes, links)
    return classes, graph


def tiles_of(x: np.ndarray):
    """Cuts of ``x`` (unit vectors) into tiles, each tile's centre, and the
    largest angle between it and a member."""
    cuts = np.arange(0, len(x), TILE)
    centre = np.add.reduceat(x, cuts, axis=0)
    size = np.linalg.norm(centre, axis=1)
    centre = np.where(size[:, None] > 1e-9, centre / np.maximum(size, 1e-9)[:, None], x[cuts])
    own = np.clip(np.einsum("ij,ij->i", x, np.repeat(centre, np.diff([*cuts, len(x)]), axis=0)), -1, 1)
    return cuts, centre, np.arccos(np.minimum.reduceat(own, cuts))


def links_in_cell(x: np.ndarray, n: np.ndarray, order: np.ndarray, left: np.ndarray, right: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows linked to each of ``x``, and the root of each in a spanning forest,
    over all pairs of ``left`` and ``right`` (of ``left`` where that is None).
    Sides are sorted by ``order``; tile pairs that lie too far apart to hold a
    link, by the triangle inequality of angles, are left out."""
    from .simhash import _hook, _settled

    left = left[np.argsort(order[left], kind="stable")]
    lx = x[left]
    lcut, lcentre, lwide = tiles_of(lx)
    if right is None:
        other, rx, rcut, rcentre, rwide = left, lx, lcut, lcentre, lwide
    else:
        other = right[np.argsort(order[right], kind="stable")]
        rx = x[other]
        rcut, rcentre, rwide = tiles_of(rx)
    links, label = np.zeros(len(x), np.int64), np.arange(len(x))
    reach = np.arccos(min(1.0, threshold)) + 1e-6
    for t, at in enumerate(lcut.tolist()):
        mine = left[at : at + TILE]
        apart = np.arccos(np.clip(rcentre @ lcentre[t], -1, 1))
        near = np.flatnonzero(apart <= lwide[t] + rwide + reach)
        if right is None:
            near = near[near >= t]
        for group in range(0, len(near), 16):
            cols = np.concatenate([np.arange(rcut[k], min(rcut[k] + TILE, len(other))) for k in near[group : group + 16]])
            theirs = other[cols]
            hit = lx[at : at + TILE] @ rx[cols].T >= threshold
            hit &= mine[:, None] != theirs[None, :]
            a, b = np.nonzero(hit)
            if not len(a):
                continue
            links[mine] += hit @ n[theirs]
            # within one side a tile meets itself with both orders of its pairs, later tiles with one
            back = cols >= at + TILE if right is None else slice(None)
            links[theirs[back]] += n[mine] @ hit[:, back]
            _hook(label, mine[a], theirs[b])
    return links, _settled(label)


def exact_links(classes: DataFrame, threshold: float) -> DataFrame:
    """``classes``: part, cls, n, dim, unit; vectors of a part are of one label
    and length. Every pair of a part is compared in double precision, block
    against block. Per class and block pair: ``cls, links`` (rows linked) and
    ``joined``, a class it is joined to (a spanning forest of the links)."""
    size = F.ceil(F.col("classes") * F.col("dim") * 8 / F.lit(BLOCK_BYTES))
    blocks = F.when(F.col("classes") <= SMALL, 1).otherwise(F.greatest(F.lit(4), size)).cast("int")
    sizes = materialize(classes.groupBy("part").agg(F.count("*").alias("classes"), F.first("dim").alias("dim")).where("classes > 1").select("part", blocks.alias("blocks")), "sizes")
    mine = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    spread = classes.join(sizes, "part").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = spread.select("part", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "cls", "n", "unit")
    ordered = cells.repartition("part", "i", "j").sortWithinPartitions("part", "i", "j")

    def run(batches):
        out: list[list[np.ndarray]] = [[], [], []]
        held = 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).astype(np.int64)) for v in out], names=["cls", "links", "joined"])

        for (_, i, j), table in groups(batches, 3):
            cls, n = (table.column(c).to_numpy() for c in ("cls", "n"))
            x = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64).reshape(len(cls), -1)
            order = x @ np.random.default_rng(0).standard_normal(x.shape[1])
            first = table.column("mine").to_numpy() == i
            left, right = np.flatnonzero(first), None if i == j else np.flatnonzero(~first)
            if not len(left) or (right is not None and not len(right)):
                continue
            links, label = links_in_cell(x, n, order, left, right, threshold)
            some = np.flatnonzero(links)
            if not len(some):
                continue
            out[0].append(cls[some])
            out[1].append(links[some])
            out[2].append(cls[label[some]])
            held += len(some)
            if held > 50_000:
                yield batch()
                out, held = [[], [], []], 0
        if held:
            yield batch()

    return ordered.mapInArrow(run, "cls long, links long, joined long")


def audited(classes: DataFrame, turn: int, threshold: float) -> tuple[DataFrame, int]:
    """Sampled classes against all of their label, in blocks: ``src`` (the
    sampled one), ``found`` and ``missed`` (linked rows inside and outside its
    group) and ``dst``, a class of each group that it should be in. Returns that
    and the size of the sample."""
    n = classes.count()
    wanted = min(n, AUDIT + int(4 * n**0.5))
    sample = classes.where(F.pmod(F.xxhash64("cls", F.lit(turn)), F.lit(1 << 40)) < F.lit(-(-(wanted << 40) // max(n, 1))))
    path = fresh_path(classes.sparkSession, "audit")
    sample.select("cls", "root", F.col("label").cast("string").alias("label"), "dim", "unit").write.parquet(path)

    def blocks():
        import pyarrow.dataset as ds

        fs, root = shared_fs(path)
        for batch in ds.dataset(root, filesystem=fs, format="parquet", exclude_invalid_files=False).to_batches(batch_size=AUDIT_BLOCK):
            if batch.num_rows:
                yield batch

    def compare(batches):
        for batch in batches:
            mine = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:5]]
            raw = batch.column(5).to_pylist()
            for block in blocks():
                cls, root, label, dims = (block.column(c).to_numpy(zero_copy_only=False) for c in ("cls", "root", "label", "dim"))
                unit = block.column("unit").to_pylist()
                for dim in np.unique(dims).tolist():
                    q, r = np.flatnonzero(dims == dim), np.flatnonzero(mine[3] == dim)
                    if not len(r):
                        continue
                    x = np.frombuffer(b"".join(unit[i] for i in q), np.float64).reshape(len(q), -1)
                    y = np.frombuffer(b"".join(raw[i] for i in r), np.float64).reshape(len(r), -1)
                    i, j = np.nonzero(x @ y.T >= threshold)
                    i, j = q[i], r[j]
                    real = (label[i] == mine[2][j]) & (cls[i] != mine[0][j])
                    i, j = i[real], j[real]
                    within = root[i] == mine[1][j]
                    inside, outside = (np.bincount(i[w], mine[4][j[w]], len(cls)).astype(np.int64) for w in (within, ~within))
                    some = np.flatnonzero(inside + outside)
                    if not len(some):
                        continue
                    # one class of each group that a sampled one should be in
                    pairs = np.stack([cls[i[~within]], mine[1][j[~within]]])
                    pairs, at = np.unique(pairs, axis=1, return_index=True)
                    none = np.zeros(pairs.shape[1], np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([cls[some], pairs[0]])),
                            pa.array(np.concatenate([inside[some], none])),
                            pa.array(np.concatenate([outside[some], none])),
                            pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(mine[0][j[~within]][at])]),
                        ],
                        names=["src", "found", "missed", "dst"],
                    )

    rows = classes.select("cls", "root", F.col("label").cast("string").alias("label"), "dim", "n", "unit")
    result = materialize(rows.mapInArrow(compare, "src long, found long, missed long, dst long"), "audited")
    size = sample.count()
    drop_path(classes.sparkSession, path)
    return result, size


def link_groups(table: DataFrame, threshold: float, k: int = K, tables: int = TABLES, window: int = WINDOW, rounds: int = ROUNDS, mend: bool = True) -> tuple[DataFrame, DataFrame, Audit]:
    """``table``: vec, embedding, label. The classes with their groups' roots,
    the graph, and what the audit says of them. Without ``mend`` the first
    audit's recall is stated and nothing is done about it."""
    classes = classes_of(table, "label", "embedding")
    graph = materialize(best_lists(seed_edges(classes, tables, 0, window, threshold), k), "graph")
    graph = settled(graph, classes, k, rounds, threshold)
    links = graph.where(F.col("sim") >= threshold - SLACK).select("src", "dst")
    classes = regrouped(classes, links)
    classes, graph = enlarged(graph, classes, k, tables, window, rounds, threshold)
    audit = Audit(1.0, 0, 0, 0)
    for turn in range(AUDITS if mend else 1):
        seen, size = audited(classes, turn, threshold)
        found, missed = seen.agg(F.coalesce(F.sum("found"), F.lit(0)), F.coalesce(F.sum("missed"), F.lit(0))).first()
        if not turn:
            audit = Audit(found / (found + missed) if missed else 1.0, size, 1, 0)
        audit.rounds = turn + 1
        log.info("audit %d: %d classes, %d of %d links found", turn + 1, size, found, found + missed)
        if not missed or not mend:
            break
        lost = seen.where("dst IS NOT NULL").select("src", "dst")
        if turn == AUDITS - 1:
            wanting = classes.join(lost.select(F.col("src").alias("cls")), "cls", "left_semi").select("label", "dim").distinct()
            wanting = materialize(wanting.withColumn("part", F.monotonically_increasing_id()), "wanting")
            audit.wanting = wanting.count()
            whole = classes.join(wanting, ["label", "dim"])
            links = exact_links(whole.select("part", "cls", "n", "dim", "unit"), threshold).select(F.col("cls").alias("src"), F.col("joined").alias("dst"))
        else:
            links = lost
        classes = regrouped(classes, materialize(_by_roots(links, classes), "joined"))
        discard(seen)
    return classes, graph, audit


def link_embeddings(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93, k: int = K, tables: int = TABLES, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """One row per vector: ``id_col, n_links, component_id, kept``. The audit's
    recall is logged."""
    rows = table.select(F.col(id_col).alias("vec"), F.col(vector).cast("array<double>").alias("embedding"), F.col(label).alias("label"))
    classes, graph, audit = link_groups(rows, threshold, k, tables, window, rounds)
    log.info("recall %.6f over %d classes, %d audits, %d labels compared whole", audit.recall, audit.classes, audit.rounds, audit.wanting)
    discard(graph)
    exact = materialize(exact_links(classes.select(F.col("root").alias("part"), "cls", "n", "dim", "unit"), threshold), "exact")
    counted = exact.groupBy("cls").agg(F.sum("links").alias("links"))
    final = connected_components(exact.select("cls", "joined")).withColumnRenamed("node", "cls").withColumnRenamed("root", "home")
    named = materialize(classes.join(final, "cls", "left").join(counted, "cls", "left").select("cls", "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("home", "cls").alias("root"), "least"), "linked")
    least = materialize(named.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    lookup = materialize(named.join(least, "root").select("label", "embedding", "n_links", "component_id"), "lookup")
    for table in (classes, exact, named, least):
        discard(table)
    joined = rows.join(lookup, ["label", "embedding"], "left")
    component = F.coalesce("component_id", "vec")
    return joined.select(F.col("vec").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec").eqNullSafe(component).alias("kept"))
