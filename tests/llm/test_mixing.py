import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from strandlake.llm import mixing

SCHEMA = "doc_id long, text string, source string, size long, key string, `hash` long, n_chars int"


def table_of(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "k", 2, 3) for i, t, s in rows], SCHEMA)


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def hash_of(i, text):
    return int(hashlib.md5(f"{'' if i is None else i}|{text or ''}".encode()).hexdigest()[:15], 16)


def plain_targets(words, weights, share, most):
    """Shares of the budget; whoever would exceed its limit stops there."""
    budget, full = share * sum(words.values()), set()
    while True:
        rest, open_ = budget - sum(most * words[k] for k in full), sum(w for k, w in weights.items() if k not in full)
        level = Fraction(rest) / open_ if open_ else 0
        more = {k for k in words if k not in full and most * words[k] <= weights[k] * level}
        if not more:
            return {k: Fraction(most * words[k]) if k in full else weights[k] * level for k in words}
        full |= more


def plain(rows, weights=None, share=Fraction(3, 2), most=2, levels=mixing.LEVELS):
    words = defaultdict(int)
    for _, t, s in rows:
        words[s] += size_of(t)
    order = sorted(words, key=lambda s: (s is None, s or ""))
    weights = weights or {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    targets = plain_targets(words, weights, share, most)
    out = []
    for s in order:
        target = targets[s]
        whole = min(most, int(target // words[s])) if words[s] else 0
        gap, taken, at = int(target - whole * words[s]), set(), -1
        docs = sorted({(hash_of(i, t), size_of(t)) for i, t, q in rows if q == s and size_of(t)})
        copies = Counter(hash_of(i, t) for i, t, q in rows if q == s)
        for _ in range(levels):
            room, stop, chosen = gap, 1 << 60, []
            for h, n in docs:
                if h <= at or n > gap:
                    continue
                if n * copies[h] > room:
                    stop = h
                    break
                room -= n * copies[h]
                chosen.append(h)
            taken |= set(chosen)
            at, gap = stop, room
        for i, t, q in rows:
            if q == s:
                out.append((i, size_of(t), words[s], float(target), size_of(t) * (whole + (hash_of(i, t) in taken))))
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def corpus(n=600):
    rows = []
    for i in range(n):
        source = ("hot" if i % 3 else f"s{i % 7}") if i % 11 else None
        rows.append((i, " ".join(["w"] * (1 + (i * i) % 97)), source))
    rows += [(n, None, "hot"), (n + 1, "", "s1"), (n + 2, " \t\n", None), (None, "a null id", "hot"), (n + 3, "long " * 30_000, "hot"), (n + 4, "x y z", "\U0001f600"), (n + 5, None, "no words")]
    return rows + [(5, "again and again", "s5")] * 9


def test_against_plain_python(spark):
    rows = corpus()
    assert got(mixing.mix_digest(table_of(spark, rows))) == plain(rows)


def test_buckets_are_cut_finer_without_a_change(spark, monkeypatch):
    rows = [r for r in corpus() if size_of(r[1]) < 1000]
    monkeypatch.setattr(mixing, "LEAF", 3)
    monkeypatch.setattr(mixing, "STEP_BITS", 4)
    assert got(mixing.mix_digest(table_of(spark, rows))) == plain(rows)


def test_words_taken_come_near_targets(spark):
    rows = [r for r in corpus() if size_of(r[1]) < 1000]  # else no choice comes near
    taken, target = Counter(), {}
    by_id = {i: s for i, _, s in rows}
    for i, size, _, t, n in got(mixing.mix_digest(table_of(spark, rows))):
        taken[by_id[i]] += n
        target[by_id[i]] = t
        assert n in (0, size, 2 * size)
    for s, t in target.items():
        assert t - 97 <= taken[s] <= t or s == "s5"  # the longest document; a row nine times over is taken nine times or not


def test_given_weights_and_the_mix_itself(spark):
    rows = [r for r in corpus() if r[0] != 5]
    docs = table_of(spark, rows)
    weights = {"hot": 1, "s1": 5, None: 2}
    named = spark.createDataFrame(list(weights.items()), "source string, weight int")
    plan = mixing.mix_plan(docs, named, Fraction(1, 2), 3)
    known = {s: weights.get(s, 0) for s in {r[2] for r in rows}}
    want = plain(rows, known, Fraction(1, 2), 3)
    assert got(mixing.decisions(plan)) == want
    out = mixing.mixed(docs, plan)
    assert out.schema == docs.schema
    found = Counter((r["doc_id"], r["text"], r["source"]) for r in out.collect())
    copies = {(w[0]): w[4] // w[1] for w in want if w[1]}
    assert found == Counter({r: copies[r[0]] for r in rows if copies.get(r[0])})


def test_one_row_holds_all_words(spark):
    rows = [(1, "a b c", "x"), (2, None, "y"), (3, "", None)]
    assert got(mixing.mix_digest(table_of(spark, rows))) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None), (2, "", "a")]])
def test_no_words(spark, rows):
    assert got(mixing.mix_digest(table_of(spark, rows))) == [(i, 0, 0, 0.0, 0) for i, _, _ in rows]


def test_plan_does_not_depend_on_partitions(spark, tmp_path):
    rows = corpus()
    docs = table_of(spark, rows)
    first = got(mixing.mix_digest(docs.repartition(1)))
    assert got(mixing.mix_digest(docs.repartition(13))) == first


@pytest.mark.parametrize("times", [1, 5, 100, 10**6])
def test_targets_of_any_number_of_words(spark, times):
    """A source's weight times the budget leaves 32 bits long before its words do."""
    words = {s: n * times for s, n in {"a": 90_000_000, "b": 7_000_000, "c": 8_000_000, "d": 30_000_000, "\U0001f600": 0, None: 9_000_000}.items()}
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(words, key=lambda s: (s is None, s or "")))}
    sources = mixing.cycled_weights(spark.createDataFrame(list(words.items()), "source string, words long"), (3, 1, 2))
    found = {r["source"]: r["target"] for r in mixing.with_targets(sources, Fraction(3, 2), 2).collect()}
    assert found == {s: float(t) for s, t in plain_targets(words, weights, Fraction(3, 2), 2).items()}


def test_weights_in_any_unit(spark):
    rows = corpus()
    docs = table_of(spark, rows)
    assert got(mixing.decisions(mixing.mix_plan(docs, (300_000_000, 100_000_000, 200_000_000)))) == plain(rows)
