"""The corpus pipeline, stage by stage, against plain Python."""

import os
from zlib import crc32

import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from strandlake.llm import quality as qu
from strandlake.llm import secrets as se

from .test_decontaminate import words

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input and what each stage returned, as {doc_id: row}."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, seen[-1], SF).write.parquet(f"{folder}/{name}")
        seen.append(spark.read.parquet(f"{folder}/{name}"))
        assert seen[-1].schema == docs.schema
    tables = []
    for table in seen:
        rows = {r["doc_id"]: r for r in table.collect()}
        assert len(rows) == table.count()
        tables.append(rows)
    return tables, seen


def test_quality(spark, stages):
    (before, after, *_), frames = stages
    model, places = qu.fit(frames[0]), qu.WordHash()
    good = {i for i, r in before.items() if (t := (r["text"] or "").encode().split()) and model.score(t, places) >= 0.3}
    assert set(after) == good and all(after[i] == before[i] for i in after)


def test_near_duplicates(stages):
    _, before, after, *_ = stages[0]
    ids = sorted(before)
    sets = []
    for i in ids:
        w = before[i]["text"].encode().lower().split()
        sets.append({b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))})
    holders: dict = {}
    for n, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(n)
    shared: dict = {}
    for have in holders.values():
        for a in have:
            for b in have:
                if a < b:
                    shared[a, b] = shared.get((a, b), 0) + 1
    label = list(range(len(ids)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for (a, b), both in shared.items():
        if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
            ra, rb = find(a), find(b)
            label[max(ra, rb)] = min(ra, rb)
    assert set(after) == {ids[n] for n in range(len(ids)) if find(n) == n}
    assert 0 < len(after) < len(before)


def test_decontamination(stages):
    _, _, before, after, _ = stages[0]
    windows = {}
    for text in pq.read_table(f"{SF}/benchmark.parquet").column("text").to_pylist():
        w = words(text)
        k = min(10, len(w))
        windows.setdefault(k, set()).update(tuple(w[s : s + k]) for s in range(len(w) - k + 1) if k)
    hit = {i for i, r in before.items() for w in [words(r["text"])] if any(tuple(w[s : s + k]) in have for k, have in windows.items() for s in range(len(w) - k + 1))}
    assert hit and set(after) == set(before) - hit


def test_secrets(spark, stages):
    (*_, before, after), frames = stages
    found: dict = {}
    for r in se.scan(frames[3], se.fit(se.labelled_findings(spark))).where("is_secret").collect():
        found.setdefault(r["doc_id"], set()).add(r["candidate"])
    assert found and set(after) == set(before)
    for i, row in after.items():
        changed = row["text"] != before[i]["text"]
        assert changed == (i in found) and row["n_chars"] == (len(row["text"]) if changed else before[i]["n_chars"])
        assert not any(x in row["text"] for x in found.get(i, ()))


def test_packing(spark, stages):
    from tokenizers import Tokenizer

    public_tokenizers = pytest.importorskip("public_tokenizers")
    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    last = stages[0][-1]
    rows = corpus_pipeline.STAGES[-1][1](spark, stages[1][-1], SF).collect()
    seen: dict = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == r["length"] and r["ids_crc32"] == crc32(ids.astype("<u4").tobytes()) and r["start"] == len(seen.setdefault(r["doc_id"], []))
        seen[r["doc_id"]] += ids.tolist()
    assert seen == {i: [*encoder.encode(r["text"], add_special_tokens=False).ids, 1] for i, r in last.items()}
