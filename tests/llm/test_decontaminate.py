import random
import re

from strandlake.llm import decontaminate as dc
from strandlake.llm.common import ROW, with_row_id

from .conftest import EDGES


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items, size=10):
    out = []
    for key, text in docs:
        have, hit, found = words(text), set(), set()
        for item, body in items:
            w = words(body)
            for s in range(max(1, len(w) - size + 1)) if w else ():
                window = w[s : s + size]
                for p in range(len(have) - len(window) + 1):
                    if have[p : p + len(window)] == window:
                        hit.update(range(p, p + len(window)))
                        found.add(item)
        out.append((key, len(have), len(hit), len(found), dc.check_items(list(found)), bool(hit)))
    return out


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = ["the", "of"] * 30 + [f"t{i}" for i in range(40)] + ["Éa", "ß9"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(0, 30))) for i in range(25)] + [(30, "the"), (31, None), (32, ""), (33, "the of THE, of.the"), (3, text(15))]
    docs = []
    for i in range(80):
        body = text(rng.randrange(0, 120))
        if rng.random() < 0.5:
            item = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(item)) if item else 0
            body += "\n" + ", ".join(item[a : a + rng.randrange(5, 20)]) + " " + text(3)
        docs.append((i, body))
    return docs + [(200, None), (201, ""), (7, docs[7][1])], items


def run(spark, docs_of, docs, items, **more):
    table = with_row_id(docs_of(docs))
    found = dc.search(table, spark.createDataFrame(items, "item_id long, text string"), **more)
    return sorted(tuple(r) for r in dc.digest(found.join(table.select(ROW, "doc_id"), ROW)).collect())


def test_against_brute_force(spark, docs_of):
    docs, items = corpus()
    want = sorted(brute_force(docs, items))
    assert run(spark, docs_of, docs, items) == want
    assert any(x[5] for x in want) and not all(x[5] for x in want)


def test_benchmark_in_blocks_gives_the_same(spark, docs_of):
    docs, items = corpus(4)
    assert run(spark, docs_of, docs, items, block_bytes=700) == sorted(brute_force(docs, items))


def test_proximity(spark, docs_of):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = with_row_id(docs_of([(0, "gamma x beta y alpha"), (1, "alpha beta z z z z z z gamma"), (2, "alpha beta")]))
    found = dc.search(docs, items, slop=5).join(docs.select(ROW, "doc_id"), ROW)
    assert {r["doc_id"]: r["items"] for r in found.collect()} == {0: [1], 1: [], 2: []}


def test_edges(spark, docs_of, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "word word word word word word word word word word"), (2, None)], "item_id long, text string")
    kept = dc.decontaminate(edge_docs, items)
    assert kept.columns == edge_docs.columns
    assert kept.count() == len(EDGES) - 2
    assert dc.decontaminate(edge_docs, items.where("item_id > 5")).count() == len(EDGES)
    assert dc.decontaminate(no_docs, items).count() == 0


def test_proximity_against_brute_force(spark, docs_of):
    rng = random.Random(6)
    text = lambda n: " ".join(rng.choice("abcdefgh") for _ in range(n))
    bodies = [(i, text(rng.randrange(1, 4))) for i in range(12)] + [(20, "alpha beta gamma"), (21, "a a b")]
    docs = [(i, text(rng.randrange(0, 25))) for i in range(60)] + [(100, "beta x x alpha x gamma x beta"), (101, "x a b x x x a"), (102, None)]
    want = {}
    for key, body in docs:
        have, hit, found = words(body), set(), set()
        for item, wanted in bodies:
            for a in range(len(have)):
                for b in range(a + 1, min(a + 5, len(have)) + 1):
                    stretch, bag = have[a:b], words(wanted)
                    if all(stretch.count(w) >= bag.count(w) for w in bag) and stretch[0] in bag and stretch[-1] in bag:
                        hit.update(range(a, b))
                        found.add(item)
                        break
        want[key] = (len(hit), found)
    table = with_row_id(docs_of(docs))
    found = dc.search(table, spark.createDataFrame(bodies, "item_id long, text string"), slop=5).join(table.select(ROW, "doc_id"), ROW)
    assert {r["doc_id"]: (sum(s["length"] for s in r["spans"]), set(r["items"])) for r in found.collect()} == want
    assert 20 in want[100][1] and 21 not in want[101][1]


def test_item_ids_of_any_type(spark, docs_of):
    docs, items = corpus(9)
    named = [(f"item-{i}", t) for i, t in items]
    table = with_row_id(docs_of(docs))
    found = dc.search(table, spark.createDataFrame(named, "item_id string, text string"))
    got = sorted(tuple(r) for r in dc.digest(found.join(table.select(ROW, "doc_id"), ROW)).collect())
    assert got == sorted(brute_force(docs, named))


def test_one_index_serves_several_benchmarks(spark, docs_of):
    docs, items = corpus(11)
    table = with_row_id(docs_of(docs)).cache()
    index = dc.build_index(table, segment_words=500).cache()
    assert index.count() > 5
    for part in (items[:10], items[10:]):
        bench = spark.createDataFrame(part, "item_id long, text string")
        found = dc.search(docs=table, benchmark=bench, index=index)
        got = sorted(tuple(r) for r in dc.digest(found.join(table.select(ROW, "doc_id"), ROW)).collect())
        assert got == sorted(brute_force(docs, part))
