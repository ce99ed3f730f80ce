import gzip
import hashlib
import io

import pytest

from strandlake.contracts import ReferenceError_
from strandlake.sources import download, fasta, ron
from strandlake.sources.reference import load_reference, resolve_reference, save_reference


def sites(reference):
    return [(r["cpg_idx"], r["chr"], r["start"]) for r in reference.sites.orderBy("cpg_idx").collect()]


def test_extract(spark, tmp_path):
    path = tmp_path / "mini.fa"
    path.write_text(">chr1 source\nACCG\n>chrUn\nCG\n>chr2\nCGCG")
    found = fasta.extract_sites(spark, str(path))
    assert sites(found) == [(0, "chr1", 2), (1, "chr2", 0), (2, "chr2", 2)]
    assert [(r["contig"], r["length"]) for r in found.contigs.orderBy("contig_idx").collect()] == [("chr1", 4), ("chr2", 4)]
    assert found.release_name == "mini"
    assert sites(fasta.extract_sites(spark, str(path), ["chrUn"])) == [(0, "chrUn", 0)]


def test_site_across_lines_any_case_and_codec(spark, tmp_path):
    path = tmp_path / "x.fa.gz"
    with gzip.open(path, "wt") as f:
        f.write(">chr1\r\nAAc\r\ng N\r\n")
    with gzip.open(path, "at") as f:
        f.write(">chrX\nCCGG\n")
    assert sites(fasta.extract_sites(spark, str(path))) == [(0, "chr1", 2), (1, "chrX", 1)]


def test_sql_and_vector_scans_agree(spark):
    import random

    random.seed(3)
    rows = [(i, f"c{i}", "".join(random.choice("ACGTacgtN") for _ in range(random.randrange(0, 80)))) for i in range(40)]
    table = spark.createDataFrame(rows, "contig_idx long, contig string, seq string")
    key = lambda df: sorted(map(tuple, df.select("contig_idx", "start").collect()))
    assert key(fasta.cpg_positions(table)) == key(fasta.scan_cpgs(table)) == [(i, k) for i, _, s in rows for k in range(len(s) - 1) if s[k : k + 2].upper() == "CG"]


@pytest.mark.parametrize("text, words", [("ACG\n>chr1\nCG\n", "before the first header"), ("> \nCG\n", "without a name")])
def test_bad_fasta(spark, tmp_path, text, words):
    path = tmp_path / "bad.fa"
    path.write_text(text)
    with pytest.raises(ReferenceError_, match=words):
        fasta.extract_sites(spark, str(path))


def test_ron_and_folder_round_trip(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">chr1\nAACGTTTCGAA\n")
    first = resolve_reference(spark, str(tmp_path / "g.fa"))
    ron.write_sites(first, str(tmp_path / "g.ron"))
    save_reference(first, str(tmp_path / "g"))
    for other in (resolve_reference(spark, str(tmp_path / "g.ron")), load_reference(spark, str(tmp_path / "g"))):
        assert sites(other) == sites(first) == [(0, "chr1", 2), (1, "chr1", 7)]
        assert other.release_name == "g"
    assert sites(resolve_reference(spark, str(tmp_path / "g"))) == sites(first)


def test_ron_values():
    assert ron.parse_ron('(cpgs: [(chr: "a", start: 1, end: 3, strand: \'+\'), ], n: CpG(x: 1_000), o: Some(2.5), t: true) // x') == {"cpgs": [{"chr": "a", "start": 1, "end": 3, "strand": "+"}], "n": {"x": 1000}, "o": [2.5], "t": True}


def test_missing_reference(spark, tmp_path):
    with pytest.raises(ReferenceError_):
        resolve_reference(spark, str(tmp_path / "none"))


def test_download_checks(tmp_path):
    body = gzip.compress(b">chr1\nACGT\n")
    release = download.Release("mini", "http://localhost/mini.fa.gz", hashlib.md5(body).hexdigest())
    opener = lambda url: io.BytesIO(body)
    path = download.download_genome(str(tmp_path), release, opener)
    assert open(path).read().startswith(">chr1")
    assert download.check_cached(str(tmp_path), release) == path
    with open(path, "r+") as f:
        f.write(">chr2")
    with pytest.raises(ReferenceError_, match="digest mismatch"):
        download.check_cached(str(tmp_path), release)
    with pytest.raises(ReferenceError_, match="limit"):
        download.copy_bounded(io.BytesIO(b"12345"), io.BytesIO(), 4)
    assert download.find_release([release], "MINI") is release
    with pytest.raises(ReferenceError_):
        download.find_release([release], "other")


@pytest.mark.parametrize("chunk", [1, 3, 7, 50])
def test_ron_in_pieces(spark, tmp_path, monkeypatch, chunk):
    text = '( // sites follow\n cpgs: [(chr: "a // b", start: 10, end: 12, strand: \'+\'), ("c\\"d", 1_000, 1_002, \'-\'), ( chr:"e",start:3,end:5,strand:\'+\',),], // then\n other: Some([1, 2.5]), contig_lens: [(contig: "a", length: 99)], release_name: "r" ) // end'
    monkeypatch.setattr(ron, "CHUNK", chunk)
    monkeypatch.setattr(ron, "SLICE", 2)
    (tmp_path / "x.ron").write_text(text)
    back = ron.read_sites(spark, str(tmp_path / "x.ron"))
    assert [(r["chr"], r["start"], r["end"], r["strand"]) for r in back.sites.orderBy("cpg_idx").collect()] == [("a // b", 10, 12, "+"), ('c"d', 1000, 1002, "-"), ("e", 3, 5, "+")]
    assert back.release_name == "r" and back.contigs.first()["length"] == 99
    for bad in (text[:60], "(cpgs: [", "[1, 2]", "(other: 1)", "(cpgs: [%])"):
        (tmp_path / "bad.ron").write_text(bad)
        with pytest.raises(ReferenceError_):
            ron.read_sites(spark, str(tmp_path / "bad.ron"))


def test_a_genome_is_scanned_once(spark, tmp_path, monkeypatch):
    """Whatever is made of the sites comes from the written table."""
    from strandlake.sources import fasta

    (tmp_path / "g.fa").write_text(">chr1\nACGTCGCG\n>chrUn\nCG\n>chr2\nCCGG\n")
    scans = []
    scan = fasta.scan_records
    monkeypatch.setattr(fasta, "scan_records", lambda records: scans.append(1) or scan(records))
    reference = fasta.extract_sites(spark, str(tmp_path / "g.fa"))
    for _ in range(3):
        assert reference.sites.count() == 4 and reference.contigs.count() == 2
    plan = reference.sites._jdf.queryExecution().executedPlan().toString()
    assert len(scans) == 1 and "FileScan text" not in plan and "MapInArrow" not in plan
