"""Every registered query over whole tables, against plain Python where SQL
says nothing about it."""

import os
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow.parquet as pq
import pytest

from strandlake.llm import secrets as se
from strandlake.llm.queries import QUERIES

from .test_simhash import plain_components, plain_fingerprint
from .test_url_filter import plain as plain_parts
from .test_url_filter import plain_rule

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def docs():
    table = pq.read_table(f"{SF}/documents.parquet")
    return list(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), table.column("source").to_pylist()))


@pytest.fixture(scope="module")
def vocabulary():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def rows_of(spark, name):
    return QUERIES[name](spark, SF).collect()


def crc(ids):
    return crc32(np.array(ids, "<u4").tobytes())


def test_op1(spark):
    table = pq.read_table(f"{SF}/pages.parquet")
    want = {}
    for page, url in zip(table.column("page_id").to_pylist(), table.column("url").to_pylist()):
        host, path = plain_parts(url)
        want[page] = (host, path, *plain_rule(host, path))
    rows = rows_of(spark, "op1_url_filter")
    assert len(rows) == table.num_rows
    for r in rows:
        host, path, rule, verdict = want[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["score"] >= 0.5 else "allow"))


def test_op2(spark):
    pattern = re.compile(se.PATTERN)
    larger = f"{os.path.dirname(SF)}/sf0.01"
    table = pq.read_table(f"{larger}/documents.parquet")
    want = Counter((i, m.start(), m[0]) for i, t in zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist()) for m in pattern.finditer(t or ""))
    rows = QUERIES["op2_secrets"](spark, larger).collect()
    assert want and Counter((r["doc_id"], r["position"], r["candidate"]) for r in rows) == want
    for r in rows:
        assert r["kind"] == next(k for k, p in se.KINDS if re.match(p, r["candidate"]))
        assert r["is_secret"] == (r["probability"] >= se.THRESHOLD)


def test_op3(spark, docs):
    fps = [plain_fingerprint(t) for _, t, _ in docs]
    want = plain_components([i for i, _, _ in docs], fps, 4)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows_of(spark, "op3_simhash")}
    assert got == {i: (f"{f:016x}", want[i]) for (i, _, _), f in zip(docs, fps)}


def test_op4(spark, docs):
    rows = rows_of(spark, "op4_sharding")
    bodies = {i: (t or "").encode() for i, t, _ in docs}
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _, _ in docs)
    slots, held, homes = defaultdict(list), Counter(), defaultdict(set)
    for r in rows:
        body = bodies[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(body) + 8, crc32(body), "bytes", None)
        slots[r["shard"]].append(r["slot"])
        held[r["shard"]] += r["size"]
        homes[body].add(r["shard"])
    assert set(slots) <= set(range(24))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert all(len(x) == 1 for x in homes.values())
    # whole texts: no shard exceeds its share by more than the largest of them
    assert max(held.values()) <= sum(held.values()) / 24 + max(len(b) + 8 for b in bodies.values())


def test_op6(spark, docs):
    rows = rows_of(spark, "op6_quality")
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _, _ in docs)
    empty = {i for i, t, _ in docs if not (t or "").split()}
    assert not any(r["keep"] for r in rows if r["doc_id"] in empty)
    labels = pq.read_table(f"{SF}/labels.parquet")
    quality = dict(zip(labels.column("doc_id").to_pylist(), labels.column("quality").to_pylist()))
    judged = [(bool(quality[r["doc_id"]]), r["keep"]) for r in rows if r["doc_id"] in quality]
    assert sum(a == b for a, b in judged) / len(judged) > 0.9


def test_op7(spark, docs, vocabulary):
    rows = rows_of(spark, "op7_packing")
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert set(by) == {i for i, _, _ in docs}
    for i, t, _ in docs:
        ids, at = [*vocabulary.encode(t or "", add_special_tokens=False).ids, 1], 0
        for r in sorted(by[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert 0 < r["length"] <= 2048 and r["ids_crc32"] == crc(ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(ids)
    placed = defaultdict(list)
    for r in rows:
        placed[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in placed.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048
        assert ends[-1] & (ends[-1] - 1) == 0  # a power of two: no padding


def test_op8(spark, docs, vocabulary):
    at, want = 0, []
    for i, t, _ in sorted(docs):
        ids = [*vocabulary.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows_of(spark, "op8_tokens")) == want
