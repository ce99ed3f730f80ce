import os

import numpy as np
import pytest

from strandlake.llm import quality as qu

from .conftest import EDGES

SF = "/root/testdata/sf0.01"


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.8
    votes = np.full((len(truth), len(qu.LABELLERS)), qu.NONE)
    for k in range(4):
        speak, right = rng.random(len(truth)) < 0.6, rng.random(len(truth)) < 0.85
        votes[speak, k] = np.where(truth == right, qu.GOOD, qu.BAD)[speak]
    codes = votes @ (3 ** np.arange(len(qu.LABELLERS) - 1, -1, -1))
    patterns, counts = np.unique(codes, return_counts=True)
    model = qu.fit_label_model(patterns, counts)
    assert abs(model.prior[qu.GOOD] - 0.8) < 0.05
    share = model.chance[qu.GOOD, 0, qu.GOOD] / (model.chance[qu.GOOD, 0, qu.GOOD] + model.chance[qu.GOOD, 0, qu.BAD])
    assert abs(share - 0.85) < 0.05
    spoke = (votes[:, :4] != qu.NONE).sum(axis=1) >= 3
    assert ((model.posterior(codes) > 0.5) == truth)[spoke].mean() > 0.9


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").groupBy("doc_id").agg({"quality": "min"}).withColumnRenamed("min(quality)", "quality")
    scored = qu.score(docs, qu.fit(docs)).join(labels, "doc_id").collect()
    bad, good = [r for r in scored if r["quality"] == 0], [r for r in scored if r["quality"] == 1]
    assert sum(r["good"] for r in good) / len(good) > 0.99
    assert sum(not r["good"] for r in bad) / len(bad) > 0.95


@pytest.mark.parametrize("total", [10**k for k in range(3, 13)])
def test_sample_at_any_size(total):
    expected = qu.sample_level(total, 4000) / 2**qu.LEVEL_BITS * total
    assert expected == pytest.approx(min(total, 4000), rel=1e-6)


def test_a_sample_without_words_is_an_error(spark, docs_of):
    rows = docs_of([(i, None) for i in range(3000)] + [(3000, "the one text")])
    with pytest.raises(ValueError, match="train_rows"):
        qu.fit(rows, train_rows=1)


def test_stage_is_one_pass(spark, docs_of):
    docs = docs_of([(i, f"the text of no {i} and that is it.") for i in range(20)] + [(30, "$$ ## @@ $$ ## @@ || <<" * 9)] * 3)
    kept = qu.keep_good(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    scored = {r["doc_id"]: r["good"] for r in qu.score(docs, qu.fit(docs)).collect()}
    assert {r["doc_id"] for r in kept.collect()} == {k for k, v in scored.items() if v}


def test_edges(spark, docs_of, edge_docs, no_docs):
    model = qu.fit(edge_docs)
    rows = qu.score(edge_docs, model).collect()
    assert len(rows) == len(EDGES)
    assert not any(r["good"] for r in rows if r["doc_id"] in (0, 1, 2))
    twice = [(r["score"], r["good"]) for r in rows if r["doc_id"] == 5]
    assert twice[0] == twice[1]
    assert qu.keep_good(edge_docs).columns == edge_docs.columns
    assert qu.keep_good(no_docs).count() == 0


def by_hand(texts):
    """Votes, label model and posteriors row by row, without patterns."""
    rows = [[vote(qu.statistics(t.split(), t)) for _, vote in qu.LABELLERS] for t in texts]
    good = [1 / (1 + np.exp(-2 * (r.count(qu.GOOD) - 1.5 * r.count(qu.BAD)))) for r in rows]
    for _ in range(200):
        n = len(rows)
        prior = [(sum(1 - g for g in good) + 1) / (n + 2), (sum(good) + 1) / (n + 2)]
        chance = {}
        for c in (0, 1):
            for k in range(len(qu.LABELLERS)):
                seen = [sum((g if c else 1 - g) for g, r in zip(good, rows) if r[k] == v) + 0.05 for v in range(3)]
                chance[c, k] = [x / sum(seen) for x in seen]
        likely = [[prior[c] * np.prod([chance[c, k][v] for k, v in enumerate(r)]) for c in (0, 1)] for r in rows]
        after = [b / (a + b) for a, b in likely]
        if max(abs(a - g) for a, g in zip(after, good)) < 1e-7:
            return after
        good = after
    return good


def score_by_hand(text, weights):
    """Shares of words, shapes and repeats, each in its hashed place."""
    import re
    from zlib import crc32

    words = text.split()
    z = weights[-1] + weights[qu.DIMS - 1] * sum(a == b for a, b in zip(words, words[1:])) / len(words)
    for w in words:
        shape = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in w)
        z += weights[crc32(w.lower()) % (qu.DIMS // 2)] / len(words)
        z += weights[qu.DIMS // 2 + crc32(b"shape " + re.sub(rb"([Aa0])\1+", rb"\1", shape)) % (qu.DIMS // 2 - 1)] / len(words)
    return 1 / (1 + np.exp(-z))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_posterior_score_and_filter_by_hand(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    spoken = [i for i, t in texts.items() if t.split()]
    posterior = dict(zip(spoken, by_hand([texts[i] for i in spoken])))
    model = qu.fit(docs)
    rows = qu.score(docs, model).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        i = r["doc_id"]
        if i not in posterior:
            assert (r["score"], r["posterior"], r["good"]) == (0, 0, False)
            continue
        assert r["posterior"] == pytest.approx(posterior[i], abs=1e-4)
        assert r["score"] == pytest.approx(score_by_hand(texts[i], model.weights), abs=1e-9)
        assert r["good"] == (r["score"] >= 0.3)
    assert {r["doc_id"] for r in qu.keep_good(docs).collect()} == {r["doc_id"] for r in rows if r["good"]}


def test_the_sample_does_not_depend_on_splits(spark, docs_of):
    docs = docs_of([(i % 700, f"the text of no {i % 500} and that is it.") for i in range(1500)])
    one, many = (qu.fit(docs.repartition(n), train_rows=200).weights for n in (1, 13))
    assert (one == many).all() and one.any()
