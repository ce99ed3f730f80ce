import json
import logging
import os
import re
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from jobs import differential_regions as dr
from jobs import sequence_inventory as si
from jobs.common import default_config, read_config
from jobs.queries import ORACLES, QUERIES
from strandlake.contracts import EngineError

SF = "/root/testdata/sf0.001"
HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plain_record(text):
    seq = re.sub(r"[ \t\n\x0b\f\r]", "", text or "").translate(str.maketrans("acgtunU", "ACGTTNT"))
    c, g, pairs = seq.count("C"), seq.count("G"), seq.count("CG")
    ratio = round(pairs * len(seq) / (c * g), 6) if c and g else None
    return len(seq), c, g, pairs, sum(x not in "ACGTN" for x in seq), ratio, bool(seq) and c + g >= 0.5 * len(seq) and ratio is not None and ratio >= 0.6


TEXTS = [(1, "acg tCG\nNN", "a"), (2, None, "a"), (3, "", None), (4, "CGCGCGCG", "b"), (5, "plain words", "b"), (None, "uuU cgß", "7"), (4, "CGCGCGCG", "b")]
SCHEMA = "doc_id long, text string, source string, n_cpg int"


def texts_of(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)


def want_of(rows):
    return sorted(((i, s, *plain_record(t)) for i, t, s in rows), key=repr)


def got_of(frame):
    return sorted((tuple(r) for r in frame.drop("batch").collect()), key=repr)


@pytest.fixture
def place(tmp_path):
    return {k: f"{tmp_path}/{k}" for k in ("in", "out", "state")}


def test_only_what_is_new_is_taken(spark, place, caplog):
    config = default_config(si.JOB)
    run = lambda: si.run(spark, place["in"], place["out"], place["state"], config)
    texts_of(spark, TEXTS[:4]).coalesce(1).write.parquet(place["in"])
    assert got_of(run()) == want_of(TEXTS[:4])
    with caplog.at_level(logging.INFO, "sequence_inventory"):
        assert got_of(run()) == want_of(TEXTS[:4])  # nothing is new
    assert "0 new rows" in caplog.text and "batch" not in caplog.text
    caplog.clear()
    texts_of(spark, TEXTS[4:]).coalesce(1).write.mode("append").parquet(place["in"])
    with caplog.at_level(logging.INFO, "sequence_inventory"):
        after = run()
    assert got_of(after) == want_of(TEXTS)
    assert "3 new rows" in caplog.text and "batch 1: wrote 3 records" in caplog.text and "batch 0" not in caplog.text
    assert got_of(after.where("batch = 0")) == want_of(TEXTS[:4])
    totals = {r["grp"]: (r["n_records"], r["n_bases"], r["n_cpg"], r["n_islands"]) for r in spark.read.parquet(f"{place['out']}/totals").collect()}
    for s in {r[2] for r in TEXTS}:
        mine = [plain_record(t) for _, t, x in TEXTS if x == s]
        assert totals[s] == (len(mine), sum(m[0] for m in mine), sum(m[3] for m in mine), sum(m[6] for m in mine))


def test_a_batch_that_was_broken_off_is_replaced(spark, place, monkeypatch):
    """The write ends but the batch isn't noted; the next run does it again."""
    config = default_config(si.JOB)
    texts_of(spark, TEXTS).coalesce(1).write.parquet(place["in"])
    count = si.log.info

    def fail(words, *args):
        if words.startswith("batch"):
            raise RuntimeError("broken off")
        count(words, *args)

    monkeypatch.setattr(si.log, "info", fail)
    with pytest.raises(Exception, match="broken off"):
        si.run(spark, place["in"], place["out"], place["state"], config)
    assert spark.read.parquet(f"{place['out']}/records").count() == len(TEXTS)
    monkeypatch.undo()
    assert got_of(si.run(spark, place["in"], place["out"], place["state"], config)) == want_of(TEXTS)


def test_several_batches_and_one_file(spark, place, tmp_path):
    config = default_config(si.JOB) | {"files_per_batch": 1}
    texts_of(spark, TEXTS).repartition(3).write.parquet(place["in"])
    found = si.run(spark, place["in"], place["out"], place["state"], config)
    assert got_of(found) == want_of(TEXTS) and found.select("batch").distinct().count() > 1
    file = next(f for f in os.listdir(place["in"]) if f.endswith(".parquet"))
    one = spark.read.parquet(f"{place['in']}/{file}").count()
    found = si.run(spark, f"{place['in']}/{file}", f"{tmp_path}/out1", f"{tmp_path}/state1", config)
    assert found.count() == one
    assert si.run(spark, f"{place['in']}/{file}", f"{tmp_path}/out1", f"{tmp_path}/state1", config).count() == one


def test_an_empty_source(spark, place):
    texts_of(spark, TEXTS).limit(0).write.parquet(place["in"])
    for _ in range(2):
        found = si.run(spark, place["in"], place["out"], place["state"], default_config(si.JOB))
        assert found.count() == 0 and "record_id" in found.columns


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_oracle(spark, name):
    con = duckdb.connect()
    for table in ("part", "lineitem", "supplier", "documents"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    before = dict(spark.sparkContext.getConf().getAll())
    got = QUERIES[name](spark, SF)
    assert dict(spark.sparkContext.getConf().getAll()) == before and not spark.streams.active
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str) == sorted(want.fetchall(), key=str)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Copies of the tables, which may be changed."""
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    home = str(tmp_path_factory.mktemp("tables"))
    for name in ("part", "lineitem", "supplier", "documents"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{home}/{name}.parquet")
    return home


def test_a_rerun_follows_its_input(spark, tables, tmp_path):
    config, out = default_config(dr.JOB), f"{tmp_path}/out"
    rows = lambda f: sorted((tuple(r) for r in f.collect()), key=str)
    first = rows(dr.run(spark, tables, out, config))
    assert first and rows(dr.run(spark, tables, out, config)) == first
    contigs = {r[-1] for r in first}
    folders = {f.removeprefix("contig_key=") for f in os.listdir(f"{out}/regions") if "=" in f}
    assert folders == contigs
    # fewer sites: contigs that have no region any more leave no old folder behind
    part = spark.read.parquet(f"{SF}/part.parquet").where("p_partkey % 22 < 3")
    part.write.mode("overwrite").parquet(f"{tables}/part.parquet")
    again = rows(dr.run(spark, tables, out, config))
    assert {r[-1] for r in again} <= {"1", "2", "3"} and again != first
    sites = spark.read.parquet(f"{out}/sites")
    assert sites.select("contig_key").distinct().count() <= 3 and sites.where(F.abs("delta") > 1).count() == 0


def test_groups_must_fit_the_samples(spark):
    samples = spark.createDataFrame([(0, "a"), (1, "b")], "sample_idx int, sample_id string")
    with pytest.raises(EngineError, match="no such samples: c"):
        dr.groups_of(samples, {"first": ["a"], "second": ["c"]})
    with pytest.raises(EngineError, match="both groups: a"):
        dr.groups_of(samples, {"first": ["a"], "second": ["a", "b"]})


def test_config_files(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"max_gap": 7}')
    assert read_config(spark, f"{tmp_path}/c.json", dr.JOB) == default_config(dr.JOB) | {"max_gap": 7}
    (tmp_path / "d.json").write_text('{"max_gaps": 7}')
    with pytest.raises(ValueError, match="unknown settings: max_gaps"):
        read_config(spark, f"{tmp_path}/d.json", dr.JOB)


def test_command_line(tmp_path):
    """A job of its own in a process of its own, twice."""
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    (tmp_path / "c.json").write_text(json.dumps({"island_gc": 0.0}))
    args = ["--source", f"{SF}/documents.parquet", "--output", f"{tmp_path}/out", "--checkpoint", f"{tmp_path}/state", "--config", f"{tmp_path}/c.json"]
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"}
    said = [subprocess.run([sys.executable, f"{HOME}/jobs/sequence_inventory.py", *args], env=env, capture_output=True, text=True, timeout=300, check=True).stderr for _ in range(2)]
    assert re.search(r"batch 0: wrote \d+ records", said[0]) and "0 new rows" in said[1]


def test_jobs_do_without_the_training_data_operators():
    for folder in ("jobs",):
        for file in os.listdir(f"{HOME}/{folder}"):
            if file.endswith(".py"):
                assert not re.search(r"\bllm\b|corpus_pipeline", open(f"{HOME}/{folder}/{file}").read())
