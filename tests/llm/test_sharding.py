import random

import pytest

from strandlake.llm.sharding import shard, write_shards

from .conftest import EDGES


def check(rows, n):
    by: dict = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert set(by) <= set(range(n))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def sizes(rows, n):
    out = [0] * n
    for r in rows:
        out[r["shard"]] += len((r["text"] or "").encode()) + 8
    return out


def test_near_equal_and_groups_together(spark, docs_of):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randrange(1, 2000)) for i in range(3000)] + [(5000 + i, "copied text") for i in range(300)]
    got = shard(docs_of(rows), 8).collect()
    check(got, 8)
    assert len(got) == len(rows)
    parts = sizes(got, 8)
    assert max(parts) - min(parts) < 0.02 * sum(parts) / 8
    homes: dict = {}
    for r in got:
        homes.setdefault(r["text"], set()).add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())


def test_hot_group_is_cut(spark, docs_of):
    rows = [(i, "hot " * 50) for i in range(2000)] + [(9000 + i, f"cold {i} " * 20) for i in range(2000)]
    got = shard(docs_of(rows), 8).collect()
    check(got, 8)
    parts = sizes(got, 8)
    assert max(parts) < 1.1 * sum(parts) / 8


@pytest.mark.parametrize("n", [1, 3])
def test_edges(spark, edge_docs, no_docs, tmp_path, n):
    got = shard(edge_docs, n).collect()
    check(got, n)
    assert len(got) == len(EDGES)
    assert shard(no_docs, n).count() == 0
    write_shards(edge_docs, str(tmp_path / "s"), n)
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(EDGES)


def test_copies_that_fit_a_shard_stay_together(spark, docs_of):
    rows = [(i, "same text here now") for i in range(95)] + [(1000 + i, f"some text no {i:05d}") for i in range(305)]
    table = docs_of([(i, t.ljust(40)) for i, t in rows])
    placed = shard(table, 4).where("doc_id < 1000")
    assert placed.select("shard").distinct().count() == 1


def test_many_copies_are_numbered_in_pieces_of_one_shard(spark, docs_of):
    rows = [(i, "tiny") for i in range(900)] + [(2000 + i, f"{i} " * 60) for i in range(600)]
    got = shard(docs_of(rows), 4, rows_per_range=100).collect()
    check(got, 4)
    assert len(got) == len(rows)
    assert len({r["shard"] for r in got if r["text"] == "tiny"}) == 1
    parts = sizes(got, 4)
    assert max(parts) < 1.05 * sum(parts) / 4
