import random
import re

import numpy as np
import pytest
import xxhash

from strandlake.llm import simhash as sh
from strandlake.llm.components import connected_components

from .conftest import EDGES


def plain_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, radius):
    fps = np.array(fps, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    label = list(range(len(ids)))
    changed = True
    while changed:
        new = [min(label[j] for j in np.flatnonzero(near[i])) for i in range(len(ids))]
        changed = new != label
        label = new
    return {k: min(ids[i] for i in range(len(ids)) if label[i] == label[n] and ids[i] is not None) for n, k in enumerate(ids)}


def variants(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for g in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 300))]
        for _ in range(rng.randrange(1, 6)):
            copy = list(base)
            if rng.random() < 0.6:
                copy[rng.randrange(len(copy))] = "changed"
            out.append(" ".join(copy))
    out += ["Same TEXT here now"] * 40 + ["same text here now", "", None, "  "]
    rng.shuffle(out)
    return list(enumerate(out))


def test_against_brute_force(spark, docs_of):
    rows = variants()
    got = {r["doc_id"]: r for r in sh.near_duplicates(docs_of(rows)).collect()}
    fps = [plain_fingerprint(t) for _, t in rows]
    want = plain_components([i for i, _ in rows], fps, 4)
    assert {k: r["component_id"] for k, r in got.items()} == want
    assert [int.from_bytes(got[i]["fp"]) for i, _ in rows] == fps


@pytest.mark.parametrize("width, radius", [(1, 4), (2, 22)])
def test_cells_lose_no_link(width, radius):
    rng = np.random.default_rng(2)
    values = rng.integers(0, 2**63, (1500, width), dtype=np.uint64)
    for i in range(0, 600, 3):  # chains of neighbours
        values[i + 1] = values[i]
        for b in rng.choice(64, radius // 2, replace=False):
            values[i + 1, 0] ^= np.uint64(1) << np.uint64(b)
    near = sum(np.bitwise_count(values[:, None, w] ^ values[None, :, w]).astype(int) for w in range(width)) <= radius

    def roots(node, root, n):
        label = np.arange(n)
        for a, b in zip(node, root):
            ra, rb = label[a], label[b]
            label[label == max(ra, rb)] = min(ra, rb)
        return label

    want = roots(*np.nonzero(near), 1500)
    assert (roots(*sh.link_cell(values, None, radius), 1500) == want).all()
    parts = [sh.link_cell(values[:700], None, radius), tuple(x + 700 for x in sh.link_cell(values[700:], None, radius)), sh.link_cell(values[:700], values[700:], radius)]
    node, root = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    assert (roots(node, root, 1500) == want).all()


def test_edges(spark, edge_docs, no_docs):
    got = sorted(((r["doc_id"] is None, r["doc_id"]), r["component_id"]) for r in sh.near_duplicates(edge_docs).collect() if r["doc_id"] is not None)
    assert [c for _, c in got][:3] == [0, 0, 0] and len(got) == len(EDGES) - 1
    assert sh.near_duplicates(no_docs).count() == 0
    kept = sh.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == [0, 3, 5, 6, 7]
    assert sh.drop_near_duplicates(no_docs).count() == 0


def test_stage_finds_near_copies_and_leaves_others(spark, docs_of):
    rng = random.Random(1)
    base = [[f"w{rng.randrange(3000)}" for _ in range(300)] for _ in range(40)]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    near = [(100 + i, " ".join(b[:150] + ["inserted"] + b[150:])) for i, b in enumerate(base[:20])]
    kept = {r["doc_id"] for r in sh.drop_near_duplicates(docs_of(rows + near).repartition(7)).collect()}
    assert kept == set(range(40))


def test_stage_compares_shingles(spark, docs_of):
    rng = random.Random(8)
    rows, at = [], 0
    for _ in range(40):
        base = [f"w{rng.randrange(5000)}" for _ in range(120)]
        for _ in range(3):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
            rows.append((at, " ".join(copy)))
            at += 1
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for _, t in rows]
    label = list(range(len(rows)))
    for _ in range(3):
        for i in range(len(rows)):
            for j in range(i):
                if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    got = {r["doc_id"]: r["component_id"] for r in sh.near_duplicates(docs_of(rows), words=5, bits=128, radius=28, similarity=0.8).collect()}
    wrong = sum(got[i] != label[i] for i in range(len(rows)))
    assert 40 < len(set(label)) < len(rows) and wrong <= 1


def test_components(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 200)] + [(500, 500)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    label = {v: v for e in edges for v in e}
    for _ in range(200):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges + [(3, 2)], "a long, b long")).collect()}
    linked = {v for a, b in edges if a != b for v in (a, b)}
    assert got == {v: label[v] for v in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stage_keeps_different_texts_of_one_fingerprint(spark, docs_of):
    rng = random.Random(9)
    line = [f"line{i}" for i in range(9)]
    rows = [(i, " ".join(line * 170 + [f"w{rng.randrange(10**6)}" for _ in range(1500)])) for i in range(6)]
    assert len({sh.text_fingerprint(t.encode(), 5, 128) for _, t in rows}) == 1
    assert {r["doc_id"] for r in sh.drop_near_duplicates(docs_of(rows)).collect()} == set(range(6))


def test_sketches_allow_every_similar_pair():
    rng = np.random.default_rng(3)
    for size in [*range(4, 30), 100, 248, 249, 300, 1000]:
        for _ in range(10):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            drop, add = rng.multinomial(int(rng.integers(0, size // 4 + 1)), [0.5, 0.5])
            sets = [a, np.concatenate([a[drop:], rng.integers(0, 2**63, add, dtype=np.uint64)])]
            if size - drop < 0.8 * (size + add):
                continue
            least, border, upper = sh.reach_of(62, 0.8)
            assert (least, border, upper) == (4, 248, 310)
            odd = min(map(len, sets)) <= border
            values = np.array([np.frombuffer((sh.odd_sketch if odd else sh.majority_sketch)(x, 256), ">u8") for x in sets], np.uint64)
            node, _ = sh.link_cell(values, None, 62, np.array([len(x) for x in sets]), 0.8, odd)
            assert len(node) == 1


def test_stage_finds_short_and_repetitive_near_copies(spark, docs_of):
    rng = random.Random(12)
    rows, word = [], lambda: f"w{rng.randrange(10**6)}"
    for i in range(40):  # 4 of 5 shingles, and 12 of 15 shingles
        base = [word() for _ in range(9)]
        rows += [(1000 * i, " ".join(base[:8])), (1000 * i + 1, " ".join(base))]
        base = [word() for _ in range(19)]
        rows += [(1000 * i + 10, " ".join(base[:16])), (1000 * i + 11, " ".join(base))]
    for i in range(100, 110):  # a line repeated in one copy
        base, line = [word() for _ in range(300)], [word() for _ in range(10)]
        rows += [(1000 * i, " ".join(base + line * 2)), (1000 * i + 1, " ".join(base + line * 40))]
    kept = {r["doc_id"] for r in sh.drop_near_duplicates(docs_of(rows)).collect()}
    assert kept == {i for i, _ in rows if i % 10 == 0}


def test_stage_keeps_different_texts_of_null_or_equal_ids(spark, docs_of):
    rows = [(None, "one text without an id"), (None, "another text without an id"), (None, "another text without an id"), (7, "a text with the id seven"), (7, "quite another text of that id"), (8, "a text with the id seven")]
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in sh.drop_near_duplicates(docs_of(rows)).collect())
    assert kept == sorted([(0, rows[0][1]), (0, rows[1][1]), (7, rows[3][1]), (7, rows[4][1])])
