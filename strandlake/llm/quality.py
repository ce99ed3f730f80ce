"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every document. The counts of
all vote patterns over the whole corpus (at most 3 ** labellers rows) go to the
driver, where expectation-maximisation fits a two-class model in which each
labeller has its own chance of each vote in each class. The posterior of a
document's pattern is its label; posterior labels train a logistic scorer on
hashed words, word shapes and repeats. The scorer decides.

The scorer is fitted on a sample of documents whose expected size is
``train_rows`` (chosen by a hash, evenly over the corpus); everything else
covers all documents and whole texts.

Null and empty texts get no words, score 0 and are rejected. Repeated rows get
the same score, and so do equal texts of different ids. Texts of any length are
read whole. An empty table fits a model that knows nothing and gives an empty
result. Extra columns, whatever their names, pass through ``keep_good``
untouched; ``score`` returns the named columns alone.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, small_batches

TRAIN_ROWS = 4000
LEVEL_BITS = 62
DIMS = 2048
GOOD, BAD, NONE = 1, 0, 2

#: Frequent function words of the languages at hand.
STOP_WORDS = frozenset(
    """the and of to in is that it for on with as are was this be by at from or an not have
    le la les de des du et en un une que qui dans pour est sur au avec par pas plus se
    der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als
    el los las y que del se por con no una su para es al lo como más o""".encode().split()
)
_SYMBOLS = b"#$%&*|<>{}[]~^\\_=+@"
_CAPITALS = bytes(range(65, 91))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))


def statistics(tokens: list[bytes], text: bytes) -> dict[str, float]:
    """What the labellers look at, for a text of at least one word."""
    n = len(tokens)
    bare = [t.strip(b".,;:!?\"'()").lower() for t in tokens]
    return {
        "words": n,
        "stops": sum(map(STOP_WORDS.__contains__, bare)) / n,
        "symbols": (len(text) - len(text.translate(None, _SYMBOLS))) / n,
        "letters": (len(text) - len(text.translate(None, _LETTERS))) / len(text),
        "repeats": sum(map(eq, tokens, tokens[1:])) / n,
        "runs": sum(a == b == c for a, b, c in zip(tokens, tokens[1:], tokens[2:])) / n,
        "capitals": (len(text) - len(text.translate(None, _CAPITALS))) / max(1, len(text) - len(text.translate(None, _LETTERS))),
        "exclaimed": text.count(b"!!") / n,
        "bare": sum(1 for t in tokens if len(t) == 1 and t in _SYMBOLS) / n,
        "length": (len(text) - n) / n,
        "stopped": sum(t.endswith((b".", b"!", b"?")) for t in tokens) / n,
    }


#: Each labeller: name, and what it votes. Those that look for junk abstain on
#: the rest, and the other way round, so that no vote is forced.
LABELLERS = (
    ("symbol_noise", lambda s: BAD if s["symbols"] > 0.25 else NONE),
    ("bare_symbols", lambda s: BAD if s["bare"] > 0.1 else NONE),
    ("stutter", lambda s: BAD if s["repeats"] > 0.15 else NONE),
    ("runs", lambda s: BAD if s["runs"] > 0.08 else NONE),
    ("shouting", lambda s: BAD if s["capitals"] > 0.5 and s["words"] >= 5 else NONE),
    ("exclaiming", lambda s: BAD if s["exclaimed"] > 0.15 else NONE),
    ("no_prose", lambda s: BAD if s["stops"] < 0.03 and s["words"] >= 12 else NONE),
    ("few_letters", lambda s: BAD if s["letters"] < 0.5 else NONE),
    ("long_words", lambda s: BAD if s["length"] > 14 else NONE),
    ("prose", lambda s: GOOD if (s["stops"] > 0.12 or s["words"] < 12) and s["repeats"] < 0.08 and s["capitals"] < 0.3 and s["letters"] > 0.4 else NONE),
    ("sentences", lambda s: GOOD if s["stopped"] > 0.02 and (s["stopped"] < 0.5 or s["words"] < 12) and s["symbols"] < 0.1 and s["exclaimed"] < 0.05 and s["runs"] < 0.03 else NONE),
)


def votes_of(text: bytes | None, tokens: list[bytes]) -> int:
    """All votes as one number in base 3; -1 where there are no words."""
    if not tokens:
        return -1
    stats, code = statistics(tokens, text), 0
    for _, vote in LABELLERS:
        code = 3 * code + vote(stats)
    return code


def _digits(codes: np.ndarray) -> np.ndarray:
    return np.stack([(codes // 3**k) % 3 for k in range(len(LABELLERS) - 1, -1, -1)], axis=1)


@dataclass
class LabelModel:
    """``chance[c, l, v]``: labeller l votes v on documents of class c."""

    prior: np.ndarray
    chance: np.ndarray

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        """Probability of the good class for vote patterns."""
        digits = _digits(codes)
        logs = np.log(self.prior)[:, None] + np.log(self.chance[:, np.arange(digits.shape[1])[None, :], digits]).sum(axis=2)
        return 1 / (1 + np.exp(np.clip(logs[BAD] - logs[GOOD], -500, 500)))


def fit_label_model(codes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over vote patterns and how often each occurs,
    from a start in which every labeller is more right than wrong."""
    digits, weight = _digits(codes), counts.astype(float)
    net = (digits == GOOD).sum(axis=1) - 1.5 * (digits == BAD).sum(axis=1)
    good = 1 / (1 + np.exp(-2 * net))
    model = None
    for _ in range(rounds):
        share = np.stack([1 - good, good]) * weight
        prior = (share.sum(axis=1) + 1) / (weight.sum() + 2)
        chance = np.stack([(share[:, None, :] * (digits.T[None] == v)).sum(axis=2) for v in range(3)], axis=2) + 0.05
        model = LabelModel(prior, chance / chance.sum(axis=2, keepdims=True))
        after = model.posterior(codes)
        if np.abs(after - good).max() < 1e-7:
            break
        good = after
    return model or LabelModel(np.array([0.5, 0.5]), np.full((2, len(LABELLERS), 3), 1 / 3))


_RUNS = re.compile(rb"([Aa0])\1+")
_SHAPE = bytes(65 if i in _CAPITALS else 97 if i in _LETTERS else 48 if 48 <= i <= 57 else i for i in range(256))


class WordHash(dict):
    """Word to the hashed places of itself and its shape, as one number;
    bounded in memory."""

    def __missing__(self, word: bytes) -> int:
        from zlib import crc32

        if len(self) > 200_000:
            self.clear()
        shape = _RUNS.sub(rb"\1", word.translate(_SHAPE))
        self[word] = found = crc32(word.lower()) % (DIMS // 2) * DIMS + DIMS // 2 + crc32(b"shape " + shape) % (DIMS // 2 - 1)
        return found


def features(tokens: list[bytes], places: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """Hashed places and weights: shares of words, shapes and repeats."""
    both = np.fromiter(map(places.__getitem__, tokens), np.int64, len(tokens))
    counts = np.bincount(both // DIMS, minlength=DIMS) + np.bincount(both % DIMS, minlength=DIMS)
    counts[DIMS - 1] = sum(map(eq, tokens, tokens[1:]))
    at = np.flatnonzero(counts)
    return at, counts[at] / len(tokens)


def fit_scorer(table: np.ndarray, target: np.ndarray, rounds: int = 400, ridge: float = 1e-4) -> np.ndarray:
    """Logistic weights (the last is the intercept) by Adam on soft labels,
    with both classes weighing the same."""
    n = len(table)
    weight = np.zeros(DIMS + 1)
    if not n:
        return weight
    share = np.clip([1 - target.mean(), target.mean()], 0.02, None)
    balance = (1 - target) / share[0] + target / share[1]
    balance /= balance.sum()
    first, second = np.zeros_like(weight), np.zeros_like(weight)
    for step in range(1, rounds + 1):
        chance = 1 / (1 + np.exp(-np.clip(table @ weight[:-1].astype(table.dtype) + weight[-1], -30, 30)))
        pull = balance * (chance - target)
        grad = np.concatenate([table.T @ pull.astype(table.dtype), [pull.sum()]])
        grad[:-1] += ridge * weight[:-1]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        weight -= 0.1 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weight


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray

    def score(self, tokens: list[bytes], places: WordHash) -> float:
        at, share = features(tokens, places)
        return float(1 / (1 + np.exp(-np.clip(self.weights[at] @ share + self.weights[-1], -500, 500))))


def sample_level(total: int, wanted: int) -> int:
    """Of the numbers below 2 ** LEVEL_BITS, how many let a row into the sample."""
    return min(1 << LEVEL_BITS, -(-(wanted << LEVEL_BITS) // max(total, 1)))


def fit(docs: DataFrame, text: str = "text", train_rows: int = TRAIN_ROWS, id_col: str = "doc_id") -> QualityModel:
    """Count votes over all of ``docs``, fit the label model, then the scorer.
    One pass over the texts makes both the counts and the scorer's sample,
    which is drawn by a hash of text and id (where there is one)."""
    spark = docs.sparkSession
    small_batches(spark)
    level = sample_level(docs.count(), train_rows)
    chance = F.pmod(F.xxhash64(text, *([id_col] if id_col in docs.columns else []), F.lit("quality")), F.lit(1 << LEVEL_BITS))
    slim = docs.select(F.col(text).cast("binary").alias("t"), (chance < level).alias("chosen"))

    def look(batches):
        places, counts, known = WordHash(), Counter(), set()
        names = ["votes", "n", "at", "share"]
        for batch in batches:
            at, share, codes = [], [], []
            for t, chosen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = (t or b"").split()
                code = votes_of(t, tokens)
                counts[code] += 1
                if chosen and tokens and hash(t) not in known:  # a text counts once, however many copies of it are drawn
                    known.add(hash(t))
                    place, weight = features(tokens, places)
                    at.append(place.astype("<i2").tobytes())
                    share.append(weight.astype("<f4").tobytes())
                    codes.append(code)
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.nulls(len(codes), pa.int64()), pa.array(at, pa.binary()), pa.array(share, pa.binary())], names=names)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64()), pa.nulls(len(counts), pa.binary()), pa.nulls(len(counts), pa.binary())], names=names)

    seen = materialize(slim.mapInArrow(look, "votes long, n long, at binary, share binary"), "votes")
    known = seen.where("n IS NOT NULL AND votes >= 0").groupBy("votes").agg(F.sum("n").alias("n")).toPandas().sort_values("votes")
    rows = seen.where("n IS NULL").select("at", "share", "votes").distinct().collect()  # about train_rows of them, or fewer
    discard(seen)
    if len(known) and not rows:
        raise ValueError(f"no document with words is among about {train_rows} sampled ones; raise train_rows")
    model = fit_label_model(known["votes"].to_numpy(np.int64), known["n"].to_numpy(np.int64)) if len(known) else fit_label_model(np.zeros(1, np.int64), np.zeros(1))
    rows.sort(key=lambda r: (r["votes"], bytes(r["at"]), bytes(r["share"])))
    table = np.zeros((len(rows), DIMS), np.float32)
    for i, r in enumerate(rows):
        table[i, np.frombuffer(r["at"], "<i2")] = np.frombuffer(r["share"], "<f4")
    target = model.posterior(np.array([r["votes"] for r in rows], np.int64)) if rows else np.zeros(0)
    return QualityModel(model, fit_scorer(table, target))


def score(docs: DataFrame, model: QualityModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.3) -> DataFrame:
    """The columns ``keep``, the scorer's ``score``, the label model's
    ``posterior`` and ``good``: score at least ``threshold``."""
    small_batches(docs.sparkSession)
    slim = docs.select(*keep, F.col(text).cast("binary").alias("__sl_text"))
    k = len(keep)

    def run(batches):
        places = WordHash()
        for batch in batches:
            scores, codes = [], []
            for t in batch.column(k).to_pylist():
                tokens = (t or b"").split()
                scores.append(model.score(tokens, places) if tokens else 0.0)
                codes.append(votes_of(t, tokens))
            code = np.array(codes, np.int64)
            posterior = np.where(code < 0, 0.0, model.labels.posterior(np.maximum(code, 0))) if len(code) else np.zeros(0)
            result = np.array(scores)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(k)), pa.array(result, pa.float64()), pa.array(posterior, pa.float64()), pa.array((result >= threshold) & (code >= 0))], names=[*keep, "score", "posterior", "good"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema[:k])
    return slim.mapInArrow(run, f"{schema}, score double, posterior double, good boolean")


def keep_good(docs: DataFrame, text: str = "text", train_rows: int = TRAIN_ROWS, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the documents that the classifier rejects, in the pass
    that scores them: nothing is shuffled or joined."""
    model = fit(docs, text, train_rows)
    at = docs.columns.index(text)

    def run(batches):
        places = WordHash()
        for batch in batches:
            words = ((t or b"").split() for t in batch.column(at).cast(pa.binary()).to_pylist())
            yield batch.filter(pa.array([bool(w) and model.score(w, places) >= threshold for w in words], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
