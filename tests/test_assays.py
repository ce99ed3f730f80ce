import pytest
from pyspark.sql import functions as F

from strandlake.contracts import CoverageError, EngineError
from strandlake.operators import align as al
from strandlake.operators import downstream as ds
from strandlake.operators import filters as fi
from strandlake.operators import stats as st
from strandlake.operators.assay import build_assay, dense, wide


def site_table(spark, *starts):
    rows = [(i, "chr1", "1", s, s + 2, "+") for i, s in enumerate(starts)]
    return spark.createDataFrame(rows, "cpg_idx long, chr string, contig_key string, start long, end long, strand string")


def record_table(spark, *rows):
    return spark.createDataFrame([(i, f"s{i}", "chr1", "1", p, m, u) for i, p, m, u in rows], "sample_idx int, sample_id string, chr string, contig_key string, start long, methylated long, unmethylated long")


def cells(df):
    return sorted((r["cpg_idx"], r["sample_idx"], r["cov"], round(r["beta"], 6)) for r in df.collect())


def test_strands_merge(spark):
    out = build_assay(al.align(record_table(spark, (0, 0, 8, 0), (0, 1, 0, 2)), site_table(spark, 0)))
    assert cells(out) == [(0, 0, 10, 0.8)]


def test_c_only(spark):
    assert cells(build_assay(al.align(record_table(spark, (0, 0, 8, 0)), site_table(spark, 0)))) == [(0, 0, 8, 1.0)]


def test_exact_match_wins_over_shift(spark):
    out = al.align(record_table(spark, (0, 10, 1, 0), (0, 11, 1, 0), (0, 12, 1, 0), (0, 13, 1, 0)), site_table(spark, 10, 11))
    assert sorted((r["start"], r["cpg_idx"]) for r in out.where("cpg_idx IS NOT NULL").collect()) == [(10, 0), (11, 1), (12, 1)]


def test_mask_after_merge(spark):
    aligned = al.align(record_table(spark, (0, 0, 3, 0), (0, 1, 0, 2), (0, 5, 4, 0)), site_table(spark, 0, 5))
    assert cells(build_assay(aligned, 5)) == [(0, 0, 5, 0.6)]
    assert cells(build_assay(aligned, 0)) == cells(build_assay(aligned, 1))


def test_overflow_of_sums_is_an_error(spark):
    aligned = al.align(record_table(spark, (0, 0, 4294967290, 0), (0, 1, 10, 0)), site_table(spark, 0))
    with pytest.raises(Exception, match="32-bit range"):
        build_assay(aligned).collect()


def test_no_match_names_contigs(spark):
    aligned = al.align(record_table(spark, (0, 99, 1, 0)), site_table(spark, 0))
    with pytest.raises(CoverageError, match="chr1"):
        al.check_matches(aligned)


def test_duplicate_sites(spark):
    with pytest.raises(EngineError, match="indices 0 and 1"):
        al.check_sites(site_table(spark, 4, 4))


def test_partitions_do_not_matter(spark):
    rows = [(s, p + k, (s + p) % 5, (s * p) % 3) for s in range(3) for p in (9, 19, 29) for k in (0, 1)]
    base = record_table(spark, *rows)
    sites = site_table(spark, 9, 19, 29)
    one, many = (cells(build_assay(al.align(base.repartition(n), sites))) for n in (1, 7))
    assert one == many


@pytest.fixture(scope="module")
def small(spark):
    values = [(0, 0, 5), (0, 1, 10), (1, 0, 2), (2, 1, 1)]
    assay = spark.createDataFrame([(c, s, v, float(v) / 10) for c, s, v in values], "cpg_idx long, sample_idx int, cov long, beta float")
    samples = spark.createDataFrame([(0, "s1"), (1, "s2"), (2, "empty")], "sample_idx int, sample_id string")
    return assay, samples


def test_stats(spark, small):
    got = {r["sample_id"]: r for r in st.coverage_stats(small[0], small[1], 3).collect()}
    assert (got["s1"]["n_covered"], got["s1"]["mean_coverage"], got["s1"]["n_ge_5"]) == (2, 3.5, 1)
    assert (got["s2"]["n_covered"], got["s2"]["mean_coverage"], got["s2"]["n_ge_10"]) == (2, 5.5, 1)
    assert (got["empty"]["n_covered"], got["empty"]["mean_coverage"], got["empty"]["n_total"]) == (0, 0.0, 3)


def test_distribution(spark):
    assay = spark.createDataFrame([(i, 0, v, 0.5) for i, v in enumerate((1, 2, 5, 10, 15))], "cpg_idx long, sample_idx int, cov long, beta float")
    got = {r["threshold"]: r["n_cells"] for r in st.coverage_distribution(assay).collect()}
    assert got[1] == 5 and got[10] == 2


def test_filters(spark, small):
    sites = site_table(spark, 0, 10, 20, 30)
    assert sorted(r["cpg_idx"] for r in fi.remove_uncovered(sites, small[0]).collect()) == [0, 1, 2]
    kept = lambda *a: [r["kept"] for r in fi.coverage_filter(sites, small[0], *a).orderBy("cpg_idx").collect()]
    assert kept(2, 1, 3) == [True, True, False, False]
    assert kept(1, 2, 3) == [True, False, False, False]
    assert kept(1, 0, 3) == [True] * 4
    assert kept(0, 3, 3) == [True] * 4


def test_dense_and_wide(spark, small):
    sites = site_table(spark, 0, 10, 20)
    assert dense(small[0], sites, small[1]).count() == 9
    row = wide(small[0], sites, [(0, "s1"), (1, "s2")], "cov").orderBy("cpg_idx").collect()
    assert [(r["s1"], r["s2"]) for r in row] == [(5, 10), (2, 0), (0, 1)]


def test_downstream(spark, small):
    assay = small[0]
    assert {r["sample_idx"]: round(r["mean_cov"], 4) for r in ds.mean_coverage(assay, 4).collect()} == {0: 1.75, 1: 2.75}
    assert [r["cpg_idx"] for r in ds.delta_beta(assay, 0, 1).collect()] == [0]
    assert [r["cpg_idx"] for r in ds.high_coverage_sites(assay, 2, 5).collect()] == [0]
    other = assay.where("cpg_idx < 2").withColumn("cov", F.when(F.col("cpg_idx") == 1, 3).otherwise(F.col("cov")))
    assert {r["reason"]: 1 for r in ds.assay_diff(assay, other).collect()} == {"left only": 1, "coverage": 1}
    assert ds.inspect(site_table(spark, 0, 10), assay).first()["n_cells"] == 4
