"""Mixing sources to target weights by hash thresholds.

Each source gets a target of words: its weight's share of the budget, at most
``most`` times the words that it has; what it cannot take is shared out again
by weight until no target is above. Whole rounds of a source are taken first,
then a part of it: documents in ascending order of a hash of id and text, as
long as their words fit. Nothing is sorted for that. One histogram of words by
source and hash bucket shows in which bucket the words run out, only that
bucket is cut finer, and only a last bucket of at most ``LEAF`` rows is summed
hash by hash. The document that doesn't fit is passed over and the room that is
left is given, by the same steps, to those behind it that are no longer than
that room (``levels`` nested thresholds). In the end a row is taken if its hash
lies between two thresholds of its source and its size fits: one filter over
the table, with one row of thresholds for each source.

Only counts of words and sources reach the driver. Rows of one source are
summed before they are shuffled, so a source of any share is no burden; the
thresholds are broadcast while they are ``BROADCAST`` sources or fewer.

Null and empty texts have size 0 and take nothing; a null source is a source of
its own, the last. Repeated rows (equal id and text) have one hash and are
taken or left together; ties between other rows don't occur but by a chance of
2 to the minus 60. Null ids are hashed as empty. Texts of any length count
whole. A source without words has target 0, an empty table an empty result.
Columns other than those named are not read by ``mix_plan``; ``mixed`` passes
them on, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

WORDS = r"[^\x20\x09-\x0D]+"
HASH_BITS, STEP_BITS = 60, 12
LEAF, LEVELS, BROADCAST = 4096, 5, 10_000
END = 1 << HASH_BITS


def words_in(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def hash_of(id_col: str, text: str) -> Column:
    """60 bits of the MD5 of id and text."""
    whole = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, HASH_BITS // 4), 16, 10).cast("long")


def key_of(source: str) -> Column:
    """A source's name that is never null."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))


@dataclass
class Mix:
    """``rows``: id, key, size, hash of every document. ``sources``: key, words,
    target, whole (rounds taken whole) and thresholds of every source."""

    rows: DataFrame
    sources: DataFrame


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...], source: str = "source") -> DataFrame:
    """``sources`` (distinct) with ``weight``: the cycle over and over, by code
    point, null last. Numbered range by range, with one count for each range on
    the driver."""
    ordered = sources.repartitionByRange(F.col(source).asc_nulls_last()).withColumn("part", F.spark_partition_id())
    ordered = materialize(ordered, "ranges")
    base, total = [], 0
    for row in ordered.groupBy("part").count().orderBy("part").collect():  # one row per range
        base.append((row["part"], total))
        total += row["count"]
    bases = ordered.sparkSession.createDataFrame(base, "part int, base long")
    numbered = ordered.selectExpr("*", f"row_number() OVER (PARTITION BY part ORDER BY `{source}` ASC NULLS LAST) AS nth").join(F.broadcast(bases), "part")
    weights = F.element_at(F.array(*[F.lit(w) for w in cycle]), (F.pmod(F.col("base") + F.col("nth") - 1, F.lit(len(cycle))) + 1).cast("int"))
    return numbered.withColumn("weight", weights).drop("part", "nth", "base")


def with_targets(sources: DataFrame, share: Fraction, most: int) -> DataFrame:
    """``sources`` (words, weight) with ``target``. A round finds those that
    the present level would lift above ``most`` times their words; the level
    only rises, so a source that stopped stays so. Sums alone reach the driver."""
    total, weights = (int(x or 0) for x in sources.agg(F.sum("words"), F.sum("weight")).first())
    exact = lambda c: F.lit(c).cast("decimal(38,0)") if isinstance(c, int) else c.cast("decimal(38,0)")
    weighed = lambda n: exact(F.col("weight")).cast("decimal(9,0)") * F.lit(n).cast("decimal(26,0)")  # noqa: E731  (as integers they leave 32 bits)
    rest, stopped = share.numerator * total, 0
    while True:
        full = exact(F.col("words") * (most * share.denominator)) * F.lit(weights).cast("decimal(12,0)") <= weighed(rest)
        n, words, kept = sources.agg(F.count_if(full), F.sum(F.when(full, F.col("words"))), F.sum(F.when(~full, F.col("weight")))).first()
        if n == stopped or not kept:
            break
        stopped, weights, rest = n, int(kept), share.numerator * total - share.denominator * most * int(words)
    level = weighed(rest).cast("double") / F.lit(float(share.denominator * weights or 1))
    return sources.withColumn("target", F.when(full, (F.col("words") * most).cast("double")).otherwise(level))


def _with_state(rows: DataFrame, state: DataFrame, few: bool) -> DataFrame:
    return rows.join(F.broadcast(state) if few else state, "key")


def _threshold(rows: DataFrame, state: DataFrame, few: bool) -> DataFrame:
    """``key, stop, used``: the first hash above ``pos`` at which the words of
    rows no longer than ``gap`` exceed ``gap`` (the end where they don't), and
    the words of those before it."""
    fits = _with_state(rows, state, few).where("hash > pos AND size <= gap AND size > 0")
    at, shift = state.selectExpr("key", "pos", "gap", "gap AS room", "CAST(0 AS long) AS bucket"), HASH_BITS
    done = None
    while True:
        shift -= STEP_BITS
        inside = fits if shift == HASH_BITS - STEP_BITS else _with_state(fits.drop("pos", "gap"), at, few).where(F.shiftright("hash", shift + STEP_BITS) == F.col("bucket"))
        histogram = inside.groupBy("key", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        running = histogram.selectExpr("*", "sum(words) OVER (PARTITION BY key ORDER BY bucket) AS upto")  # 4,096 buckets of a key at most
        crossed = running.join(at.select("key", "room"), "key").groupBy("key").agg(F.min(F.when(F.col("upto") > F.col("room"), F.struct("bucket", "words", "upto", "n"))).alias("cut"), F.max("upto").alias("all"), F.first("room").alias("room"))
        found = materialize(crossed.select("key", F.col("cut.bucket").alias("bucket"), F.col("cut.n").alias("n"), "all", (F.col("room") - F.col("cut.upto") + F.col("cut.words")).alias("room")), "buckets")
        if done is None:  # where all fits there is nothing to cut
            done = found.where("bucket IS NULL").select("key", F.lit(END).alias("stop"), F.col("all").alias("used"))
        largest = found.agg(F.max("n")).first()[0]
        at = found.where("bucket IS NOT NULL").join(state.select("key", "pos", "gap"), "key").select("key", "pos", "gap", "room", "bucket")
        if largest is None or largest <= LEAF or not shift:
            break
    leaf = _with_state(fits.drop("pos", "gap"), at, few).where(F.shiftright("hash", shift) == F.col("bucket"))
    one = leaf.groupBy("key", "hash", "room", "gap").agg(F.sum("size").alias("words")).selectExpr("*", "sum(words) OVER (PARTITION BY key ORDER BY hash) AS upto")
    cut = one.where("upto > room").groupBy("key").agg(F.min(F.struct("hash", "words", "upto", "room", "gap")).alias("c"))
    exact = cut.select("key", F.col("c.hash").alias("stop"), (F.col("c.gap") - F.col("c.room") + F.col("c.upto") - F.col("c.words")).alias("used"))
    return done.unionByName(exact)


def mix_plan(docs: DataFrame, weights: DataFrame | tuple[int, ...], share: Fraction = Fraction(3, 2), most: int = 2, id_col: str = "doc_id", text: str = "text", source: str = "source", levels: int = LEVELS) -> Mix:
    """Sizes, targets and thresholds. ``weights``: one row (source, weight) for
    each source, whole and positive (sources that it doesn't name get nothing),
    or a cycle of weights for the sources by code point."""
    rows = materialize(docs.select(F.col(id_col).alias("id"), F.col(source).cast("string").alias("source"), key_of(source).alias("key"), words_in(text).alias("size"), hash_of(id_col, text).alias("hash")), "sizes")
    sources = materialize(rows.groupBy("key", "source").agg(F.sum("size").alias("words")), "sources")
    if isinstance(weights, tuple):
        sources = cycled_weights(sources, weights)
    else:
        named = weights.select(key_of(source).alias("key"), F.col("weight").cast("long").alias("weight"))
        sources = sources.join(named, "key", "left").fillna(0, ["weight"])
    rounds = F.when(F.col("words") > 0, F.least(F.floor(F.col("target") / F.col("words")), F.lit(most))).otherwise(0).cast("long")
    planned = with_targets(materialize(sources, "weights"), share, most).withColumn("whole", rounds)
    gap = F.greatest(F.floor(F.col("target") - F.col("whole") * F.col("words")), F.lit(0)).cast("long")
    planned = planned.select("key", "words", "target", "whole", F.lit(-1).cast("long").alias("pos"), gap.alias("gap"), F.expr("cast(array() as array<struct<pos:long,stop:long,gap:long>>)").alias("thresholds"))
    planned = materialize(planned, "targets")
    few = planned.count() <= BROADCAST
    for _ in range(levels):
        open_ = planned.where("gap > 0 AND pos < %d" % END)
        if open_.isEmpty():
            break
        found = _threshold(rows, open_.select("key", "pos", "gap"), few)
        joined = planned.join(found, "key", "left")
        step = F.when(F.col("stop").isNull(), F.col("thresholds")).otherwise(F.concat("thresholds", F.array(F.struct("pos", "stop", "gap"))))
        planned = materialize(joined.select("key", "words", "target", "whole", F.coalesce("stop", F.lit(END)).alias("pos"), (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap"), step.alias("thresholds")), "targets")
    return Mix(rows, planned.drop("pos", "gap"))


def _copies(rows: DataFrame, plan: Mix) -> DataFrame:
    """``rows`` (key, size, hash) with what the plan says of each; a filter by
    thresholds, without a shuffle of ``rows`` where sources are few."""
    few = plan.sources.count() <= BROADCAST
    return _with_state(rows, plan.sources, few).withColumn("copies", F.col("whole") + F.expr("exists(thresholds, t -> hash > t.pos AND hash < t.stop AND size <= t.gap)").cast("long"))


def decisions(plan: Mix) -> DataFrame:
    """Every document: ``id, size, source_size, target, taken``."""
    return _copies(plan.rows, plan).select("id", "size", F.col("words").alias("source_size"), "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, plan: Mix, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken.
    Documents without words are left out."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    slim = docs.select(whole, key_of(source).alias("key"), words_in(text).alias("size"), hash_of(id_col, text).alias("hash"))
    taken = _copies(slim, plan).where("copies > 0 AND size > 0").select("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("__nth"))
    return taken.select("__row.*")


def mix_digest(docs: DataFrame) -> DataFrame:
    """The registered query: weights 3, 1, 2 in turn, 150 % of all words."""
    plan = mix_plan(docs, (3, 1, 2))
    out = decisions(plan).withColumnRenamed("id", "doc_id")
    return out
