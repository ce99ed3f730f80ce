import pytest
from pyspark.sql import functions as F

from strandlake.contracts import CoverageError
from strandlake.functions import columns, names

CONTIGS = ["chr1", "1", "CHR1", "Chr1", "chrM", "MT", "M", " chrX ", "chrchr1", "chrUn"]


@pytest.mark.parametrize("name, key", [("chr1", "1"), ("1", "1"), ("chrM", "MT"), ("MT", "MT"), ("Chr1", "CHR1"), ("CHRx", "X")])
def test_contig_aliases(name, key):
    assert names.canonical_contig(name) == key


def test_column_and_python_agree(spark):
    rows = spark.createDataFrame([(c,) for c in CONTIGS], "c string").select("c", columns.canonical_contig(F.col("c")).alias("k"), columns.is_standard_contig(F.col("c")).alias("s")).collect()
    for r in rows:
        assert r["k"] == names.canonical_contig(r["c"])
        assert r["s"] == names.is_standard_contig(r["c"])


def test_standard_contigs():
    assert all(map(names.is_standard_contig, ["chr1", "Chr1", "chrX", "chrY", "chrM", "MT"]))
    assert not names.is_standard_contig("chrUn")


@pytest.mark.parametrize("path, name", [("/x/sample.bismark.cov.gz", "sample"), ("sample.cov", "sample"), ("a.b.cov.gz", "a.b"), ("s.bismark.cov", "s")])
def test_sample_names(path, name):
    assert names.sample_name(path) == name


def test_sample_names_must_differ():
    with pytest.raises(CoverageError, match="duplicate"):
        names.sample_names(["sample.cov", "sample.cov.gz"])
    with pytest.raises(CoverageError, match="no sample name"):
        names.sample_name(".cov")


def test_release_and_genome_names():
    assert names.release_name("/g/hg19.fa.gz") == "hg19"
    assert names.release_name("mini.fasta") == "mini"
    assert names.release_name(".fa") == "unknown"
    assert names.genome_key("UCSC_HG19_release.fa") == "hg19"
    assert names.genome_key("Other") == "other"


def test_single_precision_ratio(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    m, t = rng.integers(0, 2**32 - 1, 20_000), rng.integers(1, 2**32 - 1, 20_000)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(m, t)], "m long, t long")
    got = np.array([r[0] for r in df.select(columns.f32_ratio(F.col("m"), F.col("t"))).collect()], np.float32)
    assert (got == m.astype(np.float32) / t.astype(np.float32)).all()


def test_scalar_columns(spark):
    row = spark.range(1).select(
        columns.signed_distance(F.lit(10), F.lit(4), F.lit("-")).alias("minus"), columns.signed_distance(F.lit(10), F.lit(4), F.lit("+")).alias("plus"),
        columns.tsv_field(F.lit("gene\t1")).alias("tsv"), columns.percent(F.lit(1), F.lit(0)).alias("none"), columns.percent(F.lit(1), F.lit(4)).alias("quarter"),
        columns.saturating_sub(F.lit(5), 10).alias("low"), columns.saturating_add(F.lit(4294967290), 10).alias("high"), columns.thousands(F.lit(1234567)).alias("th"),
        columns.site_name(F.lit("chr1"), F.lit(9)).alias("site"), columns.width(F.lit(10), F.lit(11)).alias("w"),
    ).first()
    assert tuple(row) == (-6, 6, "gene 1", 0.0, 25.0, 0, 4294967295, "1,234,567", "chr1:10", 2)


def test_file_names_as_columns_agree(spark):
    paths = [f"{folder}{stem}{suffix}" for folder in ("", "/a/b/") for stem in ("s", "a.b", "My_HG19", "mm39.x") for suffix in ("", ".cov", ".cov.gz", ".bismark.cov", ".bismark.cov.gz", ".fa", ".fa.gz", ".fasta", ".fna.gz", ".gz", ".fa.fasta")]
    found = spark.createDataFrame([(p,) for p in paths], "p string").select("p", columns.sample_of(F.col("p")), columns.release_of(F.col("p")), columns.genome_key_of(F.col("p"))).collect()
    for p, sample, release, genome in found:
        assert (sample, release, genome) == (names.sample_name(p), names.release_name(p), names.genome_key(p))


def test_sequences_and_composition(spark):
    from strandlake.sources.fasta import composition

    texts = ["acg\tTCG n", "", None, "uUxCGCG\r\n"]
    rows = composition(spark.createDataFrame([(t,) for t in texts], "t string").select("t", columns.sequence_of(F.col("t")).alias("seq"))).collect()
    assert {r["t"]: tuple(r)[1:] for r in rows} == {"acg\tTCG n": ("ACGTCGN", 7, 2, 2, 2, 0), "": ("", 0, 0, 0, 0, 0), None: ("", 0, 0, 0, 0, 0), "uUxCGCG\r\n": ("TTxCGCG", 7, 2, 2, 2, 1)}
