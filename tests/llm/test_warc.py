import base64
import hashlib

import pyarrow.fs as pafs
import pytest
import zstandard
from pyspark.sql import functions as F

from strandlake.llm import warc

ROWS = [(3, "http://a/1", "<p>same</p>"), (1, "http://a/2", "<p>same</p>"), (2, "http://a/3", None), (7, None, ""), (9, "http://a/\r\nX: y", "é\r\n\r\nWARC/1.1\r\n"), (None, "u", "<p>same</p>"), (1, "http://a/2", "<p>same</p>"), (20, "u", "z" * 700_000)]


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('warc')}"
    pages = spark.createDataFrame([(*r, "extra") for r in ROWS], "page_id long, url string, html string, sha string").repartition(3)
    return warc.write_warc(pages, path).cache()


def expected(rows):
    out, first = [], {}
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        known = first.setdefault(data, (page,))
        mine = known == (page,) and not any(o[0] == page and o[2] == base64.b32encode(hashlib.sha1(data).digest()).decode() for o in out)
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if mine else "revisit", None if mine else known[0]))
    return out


def test_round_trip(written):
    got = [tuple(r)[:5] for r in warc.read_warc(written).collect()]
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    assert sorted(got, key=key) == sorted(expected(ROWS), key=key)


def test_random_access_and_footer(written):
    for r in written.collect():
        head, block = warc.read_one(r["file"], r["frame_start"], r["frame_size"], r["record_start"], r["record_size"])
        assert head["WARC-Record-ID"] == f"<{r['record_id']}>"
    fs, path = pafs.FileSystem.from_uri(written.first()["file"])
    with fs.open_input_file(path) as f:
        table = warc.seek_table(f, f.size())
        f.seek(0)
        whole = f.read()
    # a plain decoder skips the footer and reads all frames in a row
    plain = zstandard.ZstdDecompressor().stream_reader(whole, read_across_frames=True).read()
    assert len(plain) == sum(x[2] for x in table) and plain.startswith(b"WARC/1.1\r\n")


def test_small_payloads_stay_responses(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    got = warc.read_warc(warc.write_warc(pages, f"file://{tmp_path}/m", min_bytes=5)).collect()
    assert {r["record_type"] for r in got if r["payload_bytes"] < 5} == {"response"}
    assert sum(r["record_type"] == "revisit" for r in got) == 3


def test_one_file_a_task(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 40_000) for i in range(12)], "page_id long, url string, html string").repartition(2)
    index = warc.write_warc(pages, f"file://{tmp_path}/n", file_bytes=100)
    n = index.select("file").distinct().count()
    filled = warc.read_warc(index).groupBy(F.spark_partition_id()).count().count()
    assert n > 8 and filled == n


def test_empty(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_warc(warc.write_warc(pages, f"file://{tmp_path}/e")).count() == 0


def test_broken_bundle_is_noticed(tmp_path):
    (tmp_path / "x").write_bytes(b"0" * 40)
    with open(tmp_path / "x", "rb") as f, pytest.raises(ValueError):
        warc.seek_table(f, 40)
