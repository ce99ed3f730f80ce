from strandlake.streaming.totals import current_totals, stream_totals

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def state(spark, root):
    return {r["sample_id"]: tuple(r)[1:] for r in current_totals(spark, f"{root}/out").collect()}


def run(spark, root):
    stream_totals(spark, f"{root}/in", f"{root}/out", f"{root}/state")
    return state(spark, root)


def test_state_outlives_a_restart(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.cov").write_text("chr1\t10\t10\t50\t3\t3\nchr1\t20\t20\t100\t5\t0\n")
    (tmp_path / "in/b.cov").write_text("1\t20\t20\t0\t0\t5\n")
    (tmp_path / "in/notes.txt").write_text("nothing\n")
    before = spark.conf.get(PROVIDER, None)
    first = {"a": ("a.cov", 2, 8, 3, None), "b": ("b.cov", 1, 0, 5, None)}
    assert run(spark, tmp_path) == first
    assert run(spark, tmp_path) == first  # nothing new
    # the same sample in another file, and a new one
    (tmp_path / "in/a.bismark.cov").write_text("chr1\t99\t99\t100\t7\t0\n")
    (tmp_path / "in/c.cov").write_text("2\t1\t1\t100\t1\t0\n")
    assert run(spark, tmp_path) == first | {"c": ("c.cov", 1, 1, 0, None)}
    refused = spark.read.parquet(f"{tmp_path}/out").where("problem IS NOT NULL").collect()
    assert [(r["sample_id"], r["records"], r["problem"]) for r in refused] == [("a", 2, "came before, in a.cov")]
    assert spark.conf.get(PROVIDER, None) == before


def test_bad_lines_and_two_files_at_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.cov").write_text("chr1\t10\t10\t50\t3\t3\nchr1\tx\t20\t100\t5\t0\n")
    (tmp_path / "in/b.cov").write_text("1\t20\t20\t0\t0\t5\n")
    (tmp_path / "in/b.bismark.cov").write_text("1\t21\t21\t0\t0\t5\n")
    got = run(spark, tmp_path)
    assert got["a"] == ("a.cov", 0, 0, 0, "start is not an unsigned 32-bit number")
    assert got["b"][1:] == (0, 0, 0, "comes from several files: b.bismark.cov, b.cov")
    # a sample that was refused may come again, mended
    (tmp_path / "in/a.cov.gz").write_bytes(__import__("gzip").compress(b"chr1\t10\t10\t50\t3\t3\n"))
    assert run(spark, tmp_path)["a"] == ("a.cov.gz", 1, 3, 3, None)
