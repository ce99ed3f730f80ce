"""What has to stay bounded or spread as tables grow."""

import gzip
import os

import numpy as np
import pyarrow as pa
import pytest

from strandlake.contracts import CoverageError, EngineError, Reference
from strandlake.operators import align as al
from strandlake.operators import validate as va
from strandlake.plans import pipeline as pl
from strandlake.plans.sql import close_store, open_store
from strandlake.sources import coverage as co
from strandlake.sources import fasta, gtf


@pytest.fixture
def as_planned(spark):
    """Partitions as they are planned, however small."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_short_contigs_are_searched_together():
    texts = ["acg", "", None, "CG", "GC", "C", "GCGCG", "c"] * 5000
    names = ["contig_idx", "contig", "seq"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array([f"c{i}" for i in range(len(texts))]), pa.array(texts)], names=names)
    sent = list(fasta._sites_of([batch]))
    assert len(sent) == 1  # one message, not one for each contig
    want = [(i, f"c{i}", k, n) for i, s in enumerate(texts) for n, k in enumerate(k for k in range(len(s or "")) if s[k : k + 2].upper() == "CG")]
    assert list(zip(*(c.to_pylist() for c in sent[0].columns))) == want


def test_contigs_are_cut_into_runs(monkeypatch):
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("ACGTcg"), rng.integers(0, 30))) for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array(["x"] * 200), pa.array(texts)], names=["contig_idx", "contig", "seq"])
    whole = pa.Table.from_batches(fasta._sites_of([batch]))
    for size in (1, 40, 1000):
        monkeypatch.setattr(fasta, "TOGETHER", size)
        assert pa.Table.from_batches(fasta._sites_of([batch])).equals(whole.combine_chunks()) or pa.Table.from_batches(fasta._sites_of([batch])).to_pylist() == whole.to_pylist()


@pytest.fixture
def store(spark, tmp_path):
    from strandlake.contracts import MethylationSet
    from strandlake.sinks.store import write_store

    starts = [0, 9, 65_534, 65_535, 65_536, 131_071, 200_000, 4_294_967_293]
    rows = spark.createDataFrame([(i, "chr1", s, s + 2, "+") for i, s in enumerate(starts)], "cpg_idx long, chr string, start long, end long, strand string")
    people = spark.createDataFrame([(0, "a", "a")], "sample_idx int, sample_id string, sample_name string")
    assay = spark.createDataFrame([(i, 0, 5, 0.5) for i in range(len(starts))], "cpg_idx long, sample_idx int, cov long, beta float")
    write_store(MethylationSet(rows, people, assay, "mini", 8), str(tmp_path / "s.store"))
    return starts, str(tmp_path / "s.store")


def test_windows_meet_sites_by_bins(spark, store):
    starts, path = store
    names = open_store(spark, path, "grown")
    try:
        windows = [(1, 10), (0, 65_535), (65_536, 65_536), (65_535, 131_072), (-5, 9_000_000_000_000), (20, 10), (131_073, 4_294_967_294), (None, 5)]
        spark.createDataFrame([("chr1", *w) for w in windows], "contig string, first long, last long").createOrReplaceTempView("windows")
        got = spark.sql("SELECT w.first, w.last, c.position FROM windows w, LATERAL grown_cells_in(w.contig, w.first, w.last) c")
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate explode(sequence(" in plan
        assert sorted(tuple(r) for r in got.collect()) == sorted((a, b, s + 1) for a, b in windows[:-1] for s in starts if a <= s + 1 <= b)
        assert [r["position"] for r in spark.sql("SELECT position FROM grown_cells_in('CHR1', 5, 65536) ORDER BY 1").collect()] == [10, 65_535, 65_536]
    finally:
        close_store(spark, names)


def test_the_keys_of_cells_are_checked_in_one_pass(spark, as_planned):
    cells = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 0), (7, 0), (1, 5), (None, 0), (1, None)], "cpg_idx long, sample_idx int")
    rows, people = spark.createDataFrame([(0,), (1,)], "cpg_idx long"), spark.createDataFrame([(0,), (1,)], "sample_idx int")
    assert va.key_faults(cells, rows, people) == (1, 4)
    assert va.key_faults(cells.where("cpg_idx = 0"), rows, people) == (0, 0)


def test_a_packed_gene_model_is_parsed_by_many_tasks(spark, tmp_path, as_planned):
    with gzip.open(tmp_path / "x.gtf.gz", "wt") as f:
        f.writelines(f'chr1\ts\texon\t{i}\t{i + 5}\t.\t+\t.\tgene_id "g{i}"; transcript_id "t{i}";\n' for i in range(1, 1001))
    rows = gtf.read_gtf(spark, str(tmp_path / "x.gtf.gz"))
    assert rows.rdd.getNumPartitions() > 1
    assert [r["gene_id"] for r in rows.orderBy("line_no").collect()] == [f"g{i}" for i in range(1, 1001)]


def test_lines_of_a_packed_file_are_parsed_by_many_tasks(spark, tmp_path, as_planned):
    for name in ("a.cov.gz", "b.cov.gz"):
        with gzip.open(tmp_path / name, "wt") as f:
            f.writelines(f"chr1\t{i}\t{i}\t50\t1\t1\n" for i in range(1, 1001))
    (tmp_path / "c.cov").write_text("chr1\t7\t7\t50\t1\t1\n")
    found, _ = co.read_coverage(spark, co.find_files(spark, str(tmp_path)))
    assert found.count() == 2001 and found.where("sample_idx = 2").count() == 1
    assert len([p for p in found.inputFiles()]) > 3  # not one for each file


def test_faults_of_layout_name_their_files(spark, store):
    cells = spark.read.parquet(f"{store[1]}/assays")
    assert va.layout_faults(cells).count() == 0
    plan = va.layout_faults(cells)._jdf.queryExecution().optimizedPlan().toString()
    inside = next(line for line in plan.splitlines() if "MapInArrow" in line)
    assert "number" in inside and "file_path" not in inside  # no path for each cell to Python


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables here")
def test_no_task_sorts_a_whole_contig(spark, tmp_path, monkeypatch, as_planned):
    from jobs import differential_regions as job
    from jobs.common import default_config

    monkeypatch.setattr(job, "BLOCK_BITS", 10)
    job.run(spark, "/root/testdata/sf0.001", str(tmp_path / "o"), default_config(job.JOB)).collect()
    parts = [len(list(c.glob("part-*"))) for c in (tmp_path / "o/sites").glob("contig_key=*")]
    assert max(parts) > 1


def reference_of(spark, *starts):
    sites = spark.createDataFrame([(i, "chr1", "1", s, s + 2, "+") for i, s in enumerate(starts)], "cpg_idx long, chr string, contig_key string, start long, end long, strand string")
    return Reference(sites, spark.createDataFrame([(0, "chr1", 100)], "contig_idx int, contig string, length long"), "mini")


def test_a_minimum_out_of_reach_writes_neither_records_nor_cells(spark, tmp_path, monkeypatch, caplog):
    (tmp_path / "a.cov").write_text("chr1\t10\t10\t50\t3\t3\nchr1\t11\t11\t50\t3\t3\nchrZ\t9\t9\t100\t1\t0\n")
    path, reference, tags = str(tmp_path / "a.cov"), reference_of(spark, 9), []
    real = pl.written
    monkeypatch.setattr(pl, "written", lambda df, tag: tags.append(tag) or real(df, tag))
    assert [r["cov"] for r in pl.process_files(spark, reference, [path], 12).assay.collect()] == [12]  # both strands just reach it
    assert {"aligned", "assay"} <= set(tags)
    tags.clear(), caplog.clear()
    with caplog.at_level("INFO", pl.log.name), pytest.raises(EngineError, match="no site is covered in any sample"):
        pl.process_files(spark, reference, [path], 13)
    assert tags == ["contigs"]
    assert [r.getMessage() for r in caplog.records] == ["sample a: 3 records, 2 on a site", "sample a: no record of these contigs is on a site: chrZ", "1 sites in the reference"]
    (tmp_path / "b.cov").write_text("chrZ\t9\t9\t100\t1\t0\n")
    with pytest.raises(CoverageError, match="sample b: no record matches"):  # which still comes first
        pl.process_files(spark, reference, [path, str(tmp_path / "b.cov")], 13)
    assert pl.process_files(spark, reference, [path], 13, drop_uncovered=False).row_data.count() == 1


def test_sound_records_are_shuffled_as_hashes(spark, tmp_path, monkeypatch):
    calls, real = [], co.duplicates
    monkeypatch.setattr(co, "duplicates", lambda df: calls.append(1) or real(df))
    for name in ("a.cov", "b.cov"):
        (tmp_path / name).write_text("chr1\t10\t10\t50\t1\t1\nchr2\t10\t10\t50\t1\t1\n")
    found, _ = co.read_coverage(spark, co.find_files(spark, str(tmp_path)))
    assert found.count() == 4 and sorted({r["sample_id"] for r in found.collect()}) == ["a", "b"] and not calls
    (tmp_path / "b.cov").write_text("chr2\t10\t10\t50\t1\t1\n2\t10\t10\t50\t1\t1\n")
    with pytest.raises(CoverageError, match="sample b: duplicate record at 2:10"):
        co.read_coverage(spark, co.find_files(spark, str(tmp_path)))
    assert calls


def test_records_are_aligned_without_a_sort(spark):
    records = spark.createDataFrame([("a", "1", i) for i in range(8, 14)], "sample_id string, contig_key string, start long")
    out = al.align(records, reference_of(spark, 9, 10).sites)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "ShuffledHashJoin" in plan
    assert sorted((r["start"], r["cpg_idx"]) for r in out.collect() if r["cpg_idx"] is not None) == [(9, 0), (10, 1), (11, 1)]
