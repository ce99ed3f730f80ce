import gzip
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from strandlake import cli
from strandlake.contracts import AnnotationError, EngineError, ValidationError
from strandlake.operators.validate import check_metadata, check_samples, check_types, dense_rules, validate_store, violations
from strandlake.plans import pipeline as pl
from strandlake.sinks.publish import AtomicOutputs, write_atomically
from strandlake.sinks.store import read_matrix, read_metadata, read_store
from strandlake.streaming.ingest import ingest

SITES = "(cpgs: [" + ",".join(f'(chr: "chr1", start: {s}, end: {s + 2}, strand: \'+\')' for s in (9, 19, 29)) + '], contig_lens: [(contig: "chr1", length: 100)], release_name: "mini")'
OUTPUTS = (pl.STORE, pl.COVERAGE, pl.ANNOTATION, pl.TABLE)


@pytest.fixture
def inputs(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/sample_a.cov").write_text("chr1\t10\t10\t50\t35000\t35000\nchr1\t20\t20\t100\t5\t0\n")
    with gzip.open(tmp_path / "in/sample_b.cov.gz", "wt") as f:
        f.write("1\t20\t20\t0\t0\t5\n1\t30\t30\t25\t1\t3\n")
    (tmp_path / "sites.ron").write_text(SITES)
    (tmp_path / "gtf").mkdir()
    attrs = 'gene_id "g"; transcript_id "t"; gene_name "G";'
    (tmp_path / "gtf/model.gtf").write_text(f"chr1\ts\ttranscript\t1\t40\t.\t+\t.\t{attrs}\nchr1\ts\texon\t15\t25\t.\t+\t.\t{attrs}\n")
    return tmp_path


def config(root, **more):
    return pl.Config(**{"input_dir": str(root / "in"), "output_dir": str(root / "out"), "genome": str(root / "sites.ron"), "annotation_dir": str(root / "gtf"), **more})


def test_whole_run(spark, inputs):
    pl.process(spark, config(inputs))
    out = str(inputs / "out")
    assert sorted(os.listdir(out)) == sorted(OUTPUTS)
    data = read_store(spark, f"{out}/{pl.STORE}")
    assert sorted((r["sample_idx"], r["cpg_idx"], r["cov"]) for r in data.assay.collect()) == [(0, 0, 70000), (0, 1, 5), (1, 1, 5), (1, 2, 4)]
    stored = spark.read.parquet(f"{out}/{pl.STORE}/rowData").orderBy("cpg_idx").collect()
    assert [(r["start"], r["end"], r["width"]) for r in stored] == [(10, 11, 2), (20, 21, 2), (30, 31, 2)]
    assert [r["sample_id"] for r in data.col_data.orderBy("sample_idx").collect()] == ["sample_a", "sample_b"]
    assert validate_store(spark, f"{out}/{pl.STORE}")["cpg_count"] == 3
    with gzip.open(f"{out}/{pl.TABLE}", "rt") as f:
        rows = f.read().splitlines()
    assert len(rows) == 4 and rows[0].startswith("chr\tstart_1based") and "\tPromoter\tg\tG\tt\t" in rows[1]
    sheet = zipfile.ZipFile(f"{out}/{pl.COVERAGE}").read("xl/worksheets/sheet1.xml").decode()
    assert "Covered CpGs" in sheet and "sample_a" in sheet
    report = pl.qc_report(spark, f"{out}/{pl.STORE}", f"{out}/again.xlsx").collect()
    assert {r["sample_id"]: r["n_covered"] for r in report} == {"sample_a": 2, "sample_b": 2}


def test_skipping_removes_stale_reports(spark, inputs):
    (inputs / "out").mkdir()
    for name in (pl.ANNOTATION, pl.TABLE):
        (inputs / "out" / name).write_text("old")
    pl.process(spark, config(inputs, skip_annotation=True))
    assert sorted(os.listdir(inputs / "out")) == sorted(OUTPUTS[:2])


@pytest.mark.parametrize("more", [{"annotation_dir": None}, {"annotation_dir": "empty"}])
def test_failure_keeps_old_outputs(spark, inputs, more):
    (inputs / "out").mkdir()
    (inputs / "empty").mkdir()
    if more["annotation_dir"]:
        more = {"annotation_dir": str(inputs / "empty")}
    for name in OUTPUTS:
        (inputs / "out" / name).write_text(f"old {name}")
    with pytest.raises(AnnotationError):
        pl.process(spark, config(inputs, **more))
    assert {n: (inputs / "out" / n).read_text() for n in os.listdir(inputs / "out")} == {n: f"old {n}" for n in OUTPUTS}


def test_uncovered_sites_can_stay(spark, inputs):
    (inputs / "in/sample_b.cov.gz").unlink()
    kept = pl.process(spark, config(inputs, skip_annotation=True, remove_uncovered=False))
    assert kept.row_data.count() == 3 and kept.universe == 3
    with pytest.raises(EngineError):
        pl.process(spark, config(inputs, skip_annotation=True, min_coverage=1_000_000))
    with pytest.raises(EngineError):
        pl.process(spark, config(inputs, threads=0))


def test_command_line(spark, tmp_path):
    (tmp_path / "mini.fa").write_text(">chr1\nAACGTTTCGAA\n")
    (tmp_path / "in").mkdir()
    (tmp_path / "in/s.cov").write_text("chr1\t3\t3\t75\t3\t1\nchr1\t8\t8\t25\t1\t3\n")
    reference = pl.extract_cpgs(spark, str(tmp_path / "mini.fa"), str(tmp_path / "mini.ron"))
    assert reference.sites.count() == 2
    data = pl.process(spark, pl.Config(str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mini.ron"), skip_annotation=True))
    assert sorted(r["cov"] for r in data.assay.collect()) == [4, 4]
    stored = spark.read.parquet(str(tmp_path / "out" / pl.STORE / "rowData"))
    assert sorted(r["start"] for r in stored.collect()) == [3, 8]
    assert read_metadata(spark, str(tmp_path / "out" / pl.STORE))["genome"] == "mini"
    args = cli.build_parser().parse_args(["process", "--input-dir", "a", "--output-dir", "b", "--genome", "g", "--no-remove-uncovered"])
    assert args.remove_uncovered is False and args.min_coverage == 1


def spoil(spark, path, table, **columns):
    good = spark.read.parquet(f"{path}/{table}")
    changed = good.withColumns({k: F.when(F.col(good.columns[0]) == 0, F.lit(v)).otherwise(F.col(k)).cast(good.schema[k].dataType) for k, v in columns.items()})
    rows = changed.collect()
    fresh = spark.createDataFrame(rows, changed.schema)
    writer = fresh.write.mode("overwrite")
    (writer.partitionBy("sample_idx") if table == "assays" else writer).parquet(f"{path}/{table}")


@pytest.mark.parametrize(
    "table, change, words",
    [
        ("rowData", {"width": 1}, "bad_width"),
        ("rowData", {"strand": "?"}, "bad_strand"),
        ("rowData", {"start": 0}, "start_below_one"),
        ("rowData", {"chr": ""}, "chr_empty"),
        ("assays", {"beta": 1.25}, "beta_out_of_range"),
        ("assays", {"cov": 0}, "uncovered_cell"),
    ],
)
def test_validator_rejects(spark, inputs, table, change, words):
    pl.process(spark, config(inputs, skip_annotation=True))
    path = str(inputs / "out" / pl.STORE)
    spoil(spark, path, table, **change)
    with pytest.raises(ValidationError, match=words):
        validate_store(spark, path)


def test_validator_schema_rules(spark, inputs):
    import shutil

    pl.process(spark, config(inputs, skip_annotation=True))
    path = str(inputs / "out" / pl.STORE)
    meta = read_metadata(spark, path)
    for key, value in (("genome", " "), ("schema_version", "9.9.9"), ("is_h5", True)):
        with pytest.raises(ValidationError, match=key):
            check_metadata({**meta, key: value})
    with pytest.raises(ValidationError, match="not float"):
        check_types(spark.createDataFrame([(1, 1)], "cpg_idx long, beta long"), {"beta": "float"}, "assays")
    for rows, words in (([(0, "a", "a"), (1, "a", "a")], "duplicate"), ([(0, "a", "b")], "differs"), ([(0, " a", " a")], "bad id")):
        with pytest.raises(ValidationError, match=words):
            check_samples(spark.createDataFrame(rows, "sample_idx int, sample_id string, sample_name string"))
    shutil.rmtree(f"{path}/assays")
    with pytest.raises(ValidationError, match="assays is missing"):
        validate_store(spark, path)


def test_dense_rules(spark):
    table = spark.createDataFrame([(0, 0, 0.25), (1, 4, None), (2, 4, 1.25), (3, 0, None), (4, 4, 0.5)], "cpg_idx long, cov long, beta float")
    assert {r["rule"]: r["n"] for r in violations(table, dense_rules()).collect()} == {"beta_without_coverage": 1, "coverage_without_beta": 1, "beta_out_of_range": 1}


@pytest.mark.parametrize("values", [[[1, 0, 5], [2, 3, 0]], [[1, 2], [0, 3], [5, 0]]])
def test_matrix_in_either_orientation(spark, values):
    rows = read_matrix(spark, values, 2, ["a", "b"]).orderBy("sample_idx", "cpg_idx").collect()
    assert [r["cov"] for r in rows] == [1, 0, 5, 2, 3, 0]


def test_publishing(tmp_path, monkeypatch):
    (tmp_path / "a").write_text("old")
    (tmp_path / "gone").write_text("stale")
    with AtomicOutputs(str(tmp_path)) as out:
        open(out.stage("a"), "w").write("new")
        out.remove("gone")
        out.publish()
    assert sorted(os.listdir(tmp_path)) == ["a"] and (tmp_path / "a").read_text() == "new"
    with pytest.raises(RuntimeError), AtomicOutputs(str(tmp_path)) as out:
        open(out.stage("a"), "w").write("never")
        raise RuntimeError
    with AtomicOutputs(str(tmp_path)) as out:
        open(out.stage("a"), "w").write("never")
        open(out.stage("b"), "w").write("never")
        real, calls = os.replace, []

        def failing(source, target):
            calls.append(target)
            if len(calls) == 3:
                raise OSError("disk")
            real(source, target)

        monkeypatch.setattr(os, "replace", failing)
        with pytest.raises(OSError):
            out.publish()
        monkeypatch.setattr(os, "replace", real)
    assert sorted(os.listdir(tmp_path)) == ["a"] and (tmp_path / "a").read_text() == "new"
    write_atomically(str(tmp_path / "n.json"), json.dumps({}))
    assert (tmp_path / "n.json").read_text() == "{}"


def test_streaming_ingest(spark, inputs):
    from strandlake.sources.ron import read_sites

    sites = read_sites(spark, str(inputs / "sites.ron")).sites
    out, checkpoint = str(inputs / "stream"), str(inputs / "cp")
    ingest(spark, str(inputs / "in"), sites, out, checkpoint).awaitTermination(120)
    assert spark.read.parquet(out).count() == 4
    (inputs / "in/sample_c.cov").write_text("chr1\t11\t11\t100\t2\t0\n")
    ingest(spark, str(inputs / "in"), sites, out, checkpoint).awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == 5 and got.where("sample_id = 'sample_c'").first()["cpg_idx"] == 0
    # a sample that comes again, under another name, stops the stream
    with gzip.open(inputs / "in/sample_c.cov.gz", "wt") as f:
        f.write("chr1\t21\t21\t100\t2\t0\n")
    with pytest.raises(Exception, match="sample_c came before"):
        ingest(spark, str(inputs / "in"), sites, out, checkpoint).awaitTermination(120)
    assert spark.read.parquet(out).count() == 5


def test_arrays_in_either_orientation(spark, inputs):
    import numpy as np

    from strandlake.sinks.arrays import read_arrays, write_arrays

    data = pl.process(spark, config(inputs, skip_annotation=True))
    folder = str(inputs / "arrays")
    os.makedirs(folder)
    assert write_arrays(data, folder, bits=1) == (2, 3)
    cov, beta = np.load(f"{folder}/cov.npy"), np.load(f"{folder}/beta.npy")
    assert cov.tolist() == [[70000, 5, 0], [0, 5, 4]] and cov.dtype == np.uint32 and beta.dtype == np.float32
    assert np.isnan(beta).tolist() == (cov == 0).tolist()
    want = sorted((r["sample_idx"], r["cpg_idx"], r["cov"], r["beta"]) for r in data.assay.collect())
    assert sorted(map(tuple, read_arrays(spark, folder, 2, bits=1).collect())) == want
    np.save(f"{folder}/cov.npy", cov.T.copy()), np.save(f"{folder}/beta.npy", beta.T.copy())
    assert sorted(map(tuple, read_arrays(spark, folder, 2, bits=1).collect())) == want
    with pytest.raises(ValueError, match="5 samples"):
        read_arrays(spark, folder, 5)


def test_contigs_without_a_site_are_warned_of(spark, inputs, caplog):
    import logging

    from strandlake.plans import pipeline
    from strandlake.sources.reference import resolve_reference

    (inputs / "in" / "odd.cov").write_text("chr1\t10\t10\t50\t1\t1\nchrZ\t1\t1\t50\t1\t1\nchrA\t9\t9\t100\t1\t0\n")
    paths = sorted(map(str, (inputs / "in").glob("*.cov*")))
    with caplog.at_level(logging.WARNING, pipeline.log.name):
        pipeline.process_files(spark, resolve_reference(spark, config(inputs).genome), paths)
    said = [r.getMessage() for r in caplog.records if r.levelno == logging.WARNING]
    assert "sample odd: no record of these contigs is on a site: chrA, chrZ" in said


def test_a_run_shuffles_its_records_once_and_leaves_none_behind(spark, inputs, monkeypatch):
    import os
    from pathlib import Path

    from strandlake.plans import pipeline

    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    held = lambda: {p.name for p in (shared / "strandlake").glob("*") if p.name.split("-")[0] in ("records", "aligned", "models")} if (shared / "strandlake").exists() else set()
    before = held()
    calls = []
    align = pipeline.align
    monkeypatch.setattr(pipeline, "align", lambda *a: calls.append(1) or align(*a))
    data = pipeline.process(spark, config(inputs))
    assert len(calls) == 1 and held() == before
    plan = data.assay._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and os.path.isdir(inputs)


def test_the_form_of_the_annotation_table_is_a_setting(spark, inputs):
    from strandlake.plans import pipeline

    pipeline.process(spark, config(inputs))
    one = f"{config(inputs).output_dir}/{pipeline.TABLE}"
    rows = sorted(r["value"] for r in spark.read.text(one).collect())
    pipeline.process(spark, config(inputs, table_parts=True))
    parts = spark.read.text(one)
    assert len(parts.inputFiles()) >= 1 and parts.inputFiles()[0].rstrip("/") != f"file://{one}"
    assert sorted({r["value"] for r in parts.collect()}) == sorted(set(rows))


def test_the_layout_of_a_store(spark, inputs):
    from strandlake.operators.validate import check_layout

    pl.process(spark, config(inputs, skip_annotation=True))
    path = str(inputs / "out" / pl.STORE)
    check_layout(spark, path)
    cells = spark.read.parquet(f"{path}/assays").collect()
    table = spark.createDataFrame(sorted(cells, key=lambda r: -r["cpg_idx"]), "cpg_idx long, cov long, beta float, sample_idx int").coalesce(1)
    for name, writer, words in (("turned", table.write.partitionBy("sample_idx"), "not in the order of sites"), ("flat", table.orderBy("cpg_idx").write, "outside a folder of its sample")):
        writer.parquet(str(inputs / name / "assays"))
        with pytest.raises(ValidationError, match=words):
            check_layout(spark, str(inputs / name))
