"""Results don't depend on how scans are split, even if that changes between
two evaluations of one scan, as it does when executors come and go."""

import itertools
from pathlib import Path

import pytest

from strandlake.llm import common, decontaminate, sharding, simhash, warc
from strandlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables here")
SPLITS = "spark.sql.leafNodeDefaultParallelism"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The tables in 24 files each, some of them twice over."""
    home = tmp_path_factory.mktemp("many files")
    for name in ("documents", "pages"):
        table = spark.read.parquet(f"{SF}/{name}.parquet")
        table.unionByName(table.limit(50)).repartition(24).write.parquet(f"{home}/{name}.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{home}/benchmark.parquet")
    return str(home)


@pytest.fixture
def restless(spark, monkeypatch):
    """Another number of cores before every table that an operator writes."""
    counts = itertools.cycle([1, 24, 3, 11])

    def other(df, tag, write=common.materialize):
        spark.conf.set(SPLITS, str(next(counts)))
        return write(df, tag)

    def switch():
        for module in (common, decontaminate, sharding, simhash, warc):
            if hasattr(module, "materialize"):
                monkeypatch.setattr(module, "materialize", other)
        by_block, rows = common.by_block, common.with_row_id

        def moved(f):
            def call(*a):
                spark.conf.set(SPLITS, str(next(counts)))
                return f(*a)

            return call

        for module in (common, simhash, warc, decontaminate, sharding):
            for name, f in (("by_block", by_block), ("with_row_id", rows)):
                if hasattr(module, name):
                    monkeypatch.setattr(module, name, moved(f))

    yield switch
    spark.conf.unset(SPLITS)


def result(frame):
    return sorted(map(repr, frame.collect()))


@pytest.mark.parametrize("name", ["op4_sharding", "op5_warc", "op9_decontaminate"])
def test_queries(spark, tables, restless, name):
    want = result(QUERIES[name](spark, tables))
    restless()
    assert result(QUERIES[name](spark, tables)) == want


def test_pieces_of_a_range(spark, tables, restless):
    docs = spark.read.parquet(f"{tables}/documents.parquet").selectExpr("doc_id", "'all alike' AS text")
    restless()
    rows = sharding.shard(docs, 3, rows_per_range=100).collect()
    for s in range(3):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert len(rows) == docs.count()


@pytest.mark.parametrize("stage", ["near_duplicates", "decontamination"])
def test_stages(spark, tables, restless, stage):
    from corpus_pipeline import STAGES

    docs = spark.read.parquet(f"{tables}/documents.parquet")
    run = dict(STAGES)[stage]
    want = result(run(spark, docs, tables))
    assert 0 < len(want) < docs.count()
    restless()
    assert result(run(spark, docs, tables)) == want


def test_numbers_are_distinct_and_stay(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    numbers = []
    for n in ("1", "24"):
        spark.conf.set(SPLITS, n)
        numbers.append({(r[common.ROW], r["doc_id"], r["text"]) for r in common.with_row_id(docs).collect()})
    spark.conf.unset(SPLITS)
    assert numbers[0] == numbers[1] and len({n for n, _, _ in numbers[0]}) == docs.count()


def test_only_plain_scans_of_parquet_are_left_as_they_are(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "lang")
    docs.write.json(f"{tmp_path}/json")
    plain = docs.where("doc_id > 3").selectExpr("doc_id + 1 AS doc_id")
    assert common.stable(plain) is plain
    for other in (docs.unionByName(docs), docs.where("rand() < 0.9"), docs.repartition(2), docs.limit(5), spark.read.json(f"{tmp_path}/json"), spark.range(3).toDF("doc_id")):
        assert common.stable(other) is not other
        rows = common.with_row_id(other)
        assert rows.count() == rows.select(common.ROW).distinct().count()
    clash = docs.selectExpr("doc_id", "1 AS _metadata")
    assert common.with_row_id(clash).select(common.ROW).distinct().count() == docs.count()
