import os

import duckdb
import pytest

from strandlake.llm.oracles import ORACLES
from strandlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def test_twelve_operators():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 13)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(ORACLES[name])
    columns = sorted(c[0] for c in want.description)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    order = [[c[0] for c in want.description].index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str) == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=str)


def test_pipeline(spark):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r[0] for r in docs.select("doc_id").collect()}
    packed = corpus_pipeline.run(spark, SF)
    kept = packed.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert 0 < len(kept) < len(ids) and {r["doc_id"] for r in kept} <= ids


def test_a_cluster_without_shared_folder_is_refused(monkeypatch):
    from types import SimpleNamespace

    from strandlake.llm import common

    monkeypatch.setattr(common, "reach_workers", lambda spark: None)
    for master in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077"):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            common.work_root(SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context))
