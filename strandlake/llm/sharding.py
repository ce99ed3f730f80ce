"""Sharding by sampled splitters, near equal in bytes.

Rows are ordered by a key, a hash of the text, so equal texts lie together.
Keys are sampled with a chance in proportion to the row's size; quantiles of
the sample cut the key space into many more ranges than shards. A key that
fills several quantiles becomes a range of its own. Ranges that are still
overfull are cut again at keys sampled inside them; a single key too large for
a shard is cut by row, the one case in which equal texts part. Whole ranges
then go to shards, largest first, each to the emptiest shard. A range of very
many rows, as of one text with very many copies, is numbered in pieces by
several tasks, which all go to the same shard.

The driver gets the sampled keys, 32 for each range, and the ranges' sizes: 64
ranges for a shard, or one for half a million rows where that is more, plus one
row for each piece. The table of pieces that goes back is broadcast; it has as
many rows, and above ``MOST_PLACES`` of them it is joined without a hint.

Null texts weigh the fixed row cost alone and share one key. Repeated rows are
placed one by one, ties of key and id by their place in the input. Texts of any
length count whole. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from itertools import count as count_up

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, stable, with_row_id

RANGES_PER_SHARD = 64
SAMPLES_PER_RANGE = 32
ROUNDS = 6
#: Rows that one task numbers: a range holds about so many, a piece of it as well.
ROWS_PER_RANGE = 500_000
MOST_PLACES = 1_000_000


@dataclass
class Plan:
    """Cuts of the key space (range i holds keys in [cut i, cut i + 1)), the
    pieces of each range, and shard and first slot of each piece."""

    cuts: np.ndarray
    pieces: np.ndarray
    placed: list[tuple[int, int, int, int]]


def _range_of(cuts: np.ndarray):
    @F.pandas_udf("int")
    def find(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(), side="right").astype(np.int32) - 1)

    return find


def _sample(rows: DataFrame, total: int, wanted: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and how often each is drawn, in proportion to the sizes of
    its rows. Chances come from key and id alone, so a rerun draws the same."""
    expect = F.col("size") * F.lit(wanted / max(total, 1))
    chance = F.pmod(F.xxhash64("key", "mark", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.select("key", F.floor(expect + chance).alias("n")).where("n > 0")
    table = drawn.groupBy("key").agg(F.sum("n").alias("n")).toPandas().sort_values("key")
    return table["key"].to_numpy(np.int64), table["n"].to_numpy(np.int64)


def _quantile_cuts(sample: tuple[np.ndarray, np.ndarray], ranges: int) -> np.ndarray:
    drawn, n = sample
    if not len(drawn):
        return np.zeros(0, np.int64)
    upto = np.cumsum(n)
    at = drawn[np.searchsorted(upto, (np.arange(1, ranges) * int(upto[-1])) // ranges, side="right")]
    keys, times = np.unique(at, return_counts=True)
    hot = keys[times > 1]
    return np.concatenate([keys, hot[hot < np.iinfo(np.int64).max] + 1])


def plan_shards(rows: DataFrame, shards: int, ranges_per_shard: int = RANGES_PER_SHARD, rows_per_range: int = ROWS_PER_RANGE) -> Plan:
    """``rows``: key long, mark long (a hash of the id), row long (to part
    equal keys), size long."""
    low = np.iinfo(np.int64).min
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    ranges = max(shards * ranges_per_shard, -(-count // rows_per_range))
    cuts = np.unique(np.concatenate([[low], _quantile_cuts(_sample(rows, total, ranges * SAMPLES_PER_RANGE, 0), ranges)])).astype(np.int64)
    limit, share = 4 * total / ranges, total / shards
    for turn in count_up():
        sized = rows.withColumn("range", _range_of(cuts)("key"))
        table = sized.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).toPandas().sort_values("range")
        over = table[(table["bytes"] > limit) & (table["low"] < table["high"])]
        # a range of several keys that overfills a shard is cut whatever the rounds
        if turn >= ROUNDS - 1:
            over = over[over["bytes"] > share]
        if over.empty:
            break
        inside = sized.where(F.col("range").isin(over["range"].tolist()))
        sample = _sample(inside, int(over["bytes"].sum()), int(len(over) * 8 * SAMPLES_PER_RANGE), turn + 1)
        cuts = np.unique(np.concatenate([cuts, _quantile_cuts(sample, len(over) * 8), over["low"], over["low"] + 1])).astype(np.int64)
    pieces = np.ones(len(cuts), np.int64)
    long = table[table["n"] > 2 * rows_per_range]
    pieces[long["range"]] = np.ceil(long["n"] / rows_per_range).astype(np.int64)
    heavy = table[(table["bytes"] > share) & (table["n"] > 1)]
    pieces[heavy["range"]] = np.maximum(pieces[heavy["range"]], np.ceil(heavy["bytes"] / (share / 8)).astype(np.int64))
    apart = set(heavy["range"].tolist())
    parts = {(int(r), 0): (int(b), int(n)) for r, b, n in zip(table["range"], table["bytes"], table["n"]) if pieces[r] == 1}
    if len(some := np.flatnonzero(pieces > 1).tolist()):
        cut = sized.where(F.col("range").isin(some)).withColumn("piece", _piece(pieces, F.col("range"), F.col("row")))
        for r in cut.groupBy("range", "piece").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect():
            parts[r["range"], r["piece"]] = (r["bytes"], r["n"])
    units: dict[tuple[int, int], list[int]] = {}  # what goes to one shard: a range, or a piece of an overfull key
    for r, p in sorted(parts):
        units.setdefault((r, p if r in apart else 0), []).append(p)
    weight = {u: sum(parts[u[0], p][0] for p in ps) for u, ps in units.items()}
    heap = [(0, s) for s in range(shards)]
    filled = [0] * shards
    placed = []
    for unit in sorted(units, key=lambda u: (-weight[u], u)):
        held, s = heapq.heappop(heap)
        for p in units[unit]:
            placed.append((unit[0], p, s, filled[s]))
            filled[s] += parts[unit[0], p][1]
        heapq.heappush(heap, (held + weight[unit], s))
    return Plan(cuts, pieces, placed)


def _piece(pieces: np.ndarray, ranges: Column, row: Column) -> Column:
    """Which piece of its range a row belongs to."""

    @F.pandas_udf("int")
    def count(r: pd.Series) -> pd.Series:
        return pd.Series(pieces[r.to_numpy()].astype(np.int32))

    return F.pmod(F.xxhash64(row), count(ranges)).cast("int") if (pieces > 1).any() else F.lit(0)


def shard(docs: DataFrame, shards: int = 24, group: str = "text", size: Column | None = None, id_col: str = "doc_id", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (gapless from 0 in each shard).

    ``size`` is what is to be near equal (default: UTF-8 bytes of ``group``
    plus 8); rows with an equal ``group`` column stay together. Columns of
    these names that ``docs`` has are replaced.
    """
    own = ("__sl_key", "__sl_line", "__sl_size", "__sl_range", "__sl_piece")
    weight = size if size is not None else F.coalesce(F.octet_length(F.col(group)), F.lit(0)).cast("long") + 8
    docs = stable(docs)
    rows = with_row_id(docs).withColumnRenamed(ROW, own[1]).withColumns({own[0]: F.xxhash64(F.col(group)), own[2]: weight})
    plan = plan_shards(rows.select(F.col(own[0]).alias("key"), F.xxhash64(F.col(f"`{id_col}`")).alias("mark"), F.col(own[1]).alias("row"), F.col(own[2]).alias("size")), shards, rows_per_range=rows_per_range)
    spark = docs.sparkSession
    places = spark.createDataFrame(plan.placed, "__sl_range int, __sl_piece int, __sl_shard int, __sl_base long")
    dealt = rows.withColumn(own[3], _range_of(plan.cuts)(own[0])).withColumn(own[4], _piece(plan.pieces, F.col(own[3]), F.col(own[1])))
    # a piece is bounded by the plan, so numbering it in one task is, too
    numbered = dealt.selectExpr("*", f"row_number() OVER (PARTITION BY {own[3]}, {own[4]} ORDER BY {own[0]}, `{id_col}`, {own[1]}) - 1 AS __sl_n")
    joined = numbered.join(F.broadcast(places) if len(plan.placed) <= MOST_PLACES else places, ["__sl_range", "__sl_piece"])
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "slot")]
    return joined.select(*kept, F.col("__sl_shard").alias("shard"), (F.col("__sl_base") + F.col("__sl_n")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 24, group: str = "text") -> None:
    """One folder per shard, rows in slot order."""
    placed = shard(docs, shards, group)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
