import gzip

import pytest

from strandlake.contracts import CoverageError
from strandlake.sources import coverage as co

GOOD = "chr1\t10469\t10469\t20.000000\t2\t8"


def parsed(spark, *lines):
    return co.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()


@pytest.mark.parametrize(
    "line, words",
    [
        ("chr1\t10\t10\t2\t8", "needs 6 fields"),
        ("\t10\t10\t20\t2\t8", "chromosome is empty"),
        ("chr1\tx\t10\t20\t2\t8", "start is not"),
        ("chr1\t10\t4294967296\t20\t2\t8", "end is not"),
        ("chr1\t10\t10\t1.0d\t2\t8", "percentage is not a number"),
        ("chr1\t10\t10\t20\t-2\t8", "methylated count"),
        ("chr1\t10\t10\t20\t2\t", "unmethylated count"),
        ("chr1\t0\t0\t20\t2\t8", "at least 1"),
        ("chr1\t10\t11\t50.0\t1\t1", "end 11 must equal start 10"),
        ("chr1\t10\t10\t120\t2\t8", "between 0 and 100"),
        ("chr1\t10\t10\tNaN\t2\t8", "between 0 and 100"),
        ("chr1\t10\t10\t100\t4294967295\t1", "Coverage overflow"),
        ("chr1\t10\t10\t90.0\t2\t8", "does not match counts"),
    ],
)
def test_bad_lines(spark, line, words):
    assert words in parsed(spark, line)[0]["problem"]


@pytest.mark.parametrize(
    "line, total",
    [(GOOD, 10), ("chr1\t10\t10\t50.000000\t35000\t35000", 70000), ("chr1\t10\t10\t100.0\t4294967294\t1", 4294967295), ("chr1\t10\t10\t0\t0\t0", 0), (" chr1 \t +10 \t10\t20.005\t2\t8\r", 10)],
)
def test_good_lines(spark, line, total):
    (row,) = parsed(spark, line)
    assert row["problem"] is None and row["methylated"] + row["unmethylated"] == total


def test_empty_lines_are_left_out(spark):
    assert len(parsed(spark, "", "\r", GOOD)) == 1


def write(path, *lines):
    body = "\n".join(lines) + "\n"
    if str(path).endswith(".gz"):
        with gzip.open(path, "wt") as f:
            f.write(body)
    else:
        path.write_text(body)
    return str(path)


def test_files_are_found_in_order(spark, tmp_path):
    for name in ("b.cov", "a.bismark.cov.gz", "c.txt"):
        write(tmp_path / name, GOOD)
    (tmp_path / "d.cov").mkdir()
    assert [p.rsplit("/", 1)[1] for p in co.find_files(spark, str(tmp_path))] == ["a.bismark.cov.gz", "b.cov"]
    with pytest.raises(CoverageError):
        co.find_files(spark, str(tmp_path / "d.cov"))


def test_read_both_codecs(spark, tmp_path):
    paths = [write(tmp_path / "a.cov.gz", GOOD), write(tmp_path / "b.cov", GOOD, "chrM\t5\t5\t100\t1\t0")]
    found, samples = co.read_coverage(spark, paths)
    rows = sorted(tuple(r[c] for c in ("sample_idx", "contig_key", "start", "methylated", "unmethylated")) for r in found.collect())
    assert rows == [(0, "1", 10468, 2, 8), (1, "1", 10468, 2, 8), (1, "MT", 4, 1, 0)]
    assert [r["sample_id"] for r in samples.orderBy("sample_idx").collect()] == ["a", "b"]


def test_errors_name_file_and_line(spark, tmp_path):
    path = write(tmp_path / "bad.cov", *["chr1\t%d\t%d\t20\t2\t8" % (i, i) for i in range(1, 7)], "chr1\t10\t10\t90.0\t2\t8")
    with pytest.raises(CoverageError, match=r"bad.cov, line 7: .*does not match counts"):
        co.read_coverage(spark, [path])


def test_duplicates_through_aliases(spark, tmp_path):
    path = write(tmp_path / "d.cov", "chr1\t10\t10\t20\t2\t8", "1\t10\t10\t20\t2\t8")
    with pytest.raises(CoverageError, match="duplicate record at 1:10"):
        co.read_coverage(spark, [path])


def test_invalid_bytes_are_named(spark, tmp_path):
    path = tmp_path / "bytes.cov"
    path.write_bytes(GOOD.encode() + b"\nchr\xff1\t5\t5\t100\t1\t0\n")
    with pytest.raises(CoverageError, match=r"bytes.cov, line 2: line is not valid UTF-8"):
        co.read_coverage(spark, [str(path)])


def test_texts_are_scanned_once(spark, tmp_path):
    found, _ = co.read_coverage(spark, [write(tmp_path / "a.cov", GOOD)])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in plan and "Scan text" not in plan


def test_files_through_hadoop(spark, tmp_path, monkeypatch):
    from strandlake.sinks import files
    from strandlake.sinks.publish import AtomicOutputs

    for name in ("b.cov", "a.cov.gz", "c.txt"):
        write(tmp_path / name, GOOD)
    monkeypatch.setattr(files, "local_path", lambda path: None)
    monkeypatch.setattr("strandlake.sinks.publish.local_path", lambda path: None)
    where = f"file://{tmp_path}"
    assert [p.rsplit("/", 1)[1] for p in co.find_files(spark, where)] == ["a.cov.gz", "b.cov"]
    assert files.is_directory(spark, where) and not files.is_directory(spark, f"{where}/none")
    with AtomicOutputs(f"{where}/out", spark) as out:
        with files.output_file(out.stage("x.txt")) as f:
            f.write(b"new")
        out.publish()
    assert (tmp_path / "out/x.txt").read_text() == "new" and [p.name for p in (tmp_path / "out").iterdir() if not p.name.endswith(".crc")] == ["x.txt"]
