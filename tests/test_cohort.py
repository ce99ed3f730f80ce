import math
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.contracts import EngineError, MethylationSet, ReferenceError_
from strandlake.operators import differential as di
from strandlake.operators import intervals as iv
from strandlake.operators import similarity as si
from strandlake.operators.merge import merge_sets
from strandlake.operators.numbering import numbered
from strandlake.plans.cohort_queries import ORACLES, QUERIES
from strandlake.sources.intervals import read_bed, read_vcf

SF = "/root/testdata/sf0.001"
SITES = "cpg_idx long, chr string, contig_key string, start long, end long, strand string"


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for name in ("part", "lineitem", "supplier", "documents"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str) == sorted(want.fetchall(), key=str)


def sites_of(spark, places):
    return spark.createDataFrame([(i, f"chr{c}", str(c), p, p + 2, "+") for i, (c, p) in enumerate(places)], SITES)


def plain_regions(rows, max_gap):
    """Runs of (contig, start, delta) by one pass over all of them."""
    out, last = [], None
    for i, (contig, start, delta) in sorted(rows.items(), key=lambda x: x[1]):
        way = 1 if delta > 0 else -1
        if last and last[0] == contig and last[3] == way and start - last[4] <= max_gap:
            last[2], last[4] = start + 2, start
            last[6].append(delta)
        else:
            last = [contig, start, start + 2, way, start, i, [delta]]
            out.append(last)
    return sorted((c, a, b, w, i, len(d), round(sum(d) / len(d), 6)) for c, a, b, w, _, i, d in out)


@pytest.mark.parametrize("max_gap", [500, 40_000, 200_000])
def test_regions_go_on_over_bins(spark, max_gap):
    rng = random.Random(max_gap)
    places = sorted({(c, rng.randrange(0, 600_000) if rng.random() < 0.5 else 65_536 * rng.randrange(1, 9) + rng.randrange(-300, 300)) for c in (1, 2) for _ in range(120)})
    deltas = [rng.choice([0.3, 0.25, -0.4, 0.01]) for _ in places]
    differences = spark.createDataFrame(list(enumerate(deltas)), "cpg_idx long, delta double")
    got = di.differential_regions(sites_of(spark, places), differences, 0.1, max_gap)
    want = plain_regions({i: (str(c), p, d) for i, ((c, p), d) in enumerate(zip(places, deltas)) if abs(d) >= 0.1}, max_gap)
    assert sorted(tuple(r) for r in got.select("contig_key", "start", "end", "direction", "first_idx", "n_sites", "mean_delta").collect()) == want


def test_site_statistics(spark):
    rows = [(1, 0, 5, 0.2), (1, 1, 5, 0.4), (1, 2, 5, 0.9), (1, 3, 5, 0.7), (2, 0, 5, 0.5), (3, 0, 5, 0.5), (3, 2, 5, 0.5)]
    assay = spark.createDataFrame(rows, "cpg_idx long, sample_idx int, cov long, beta double")
    groups = spark.createDataFrame([(0, 1), (1, 1), (2, 2), (3, 2)], "sample_idx int, grp int")
    got = {r["cpg_idx"]: r for r in di.site_differences(assay, groups).collect()}
    assert set(got) == {1, 3} and got[3]["t"] is None and got[3]["delta"] == 0
    assert (got[1]["delta"], got[1]["t"]) == (0.5, round(0.5 / math.sqrt(0.02 / 2 + 0.02 / 2), 6))
    assert di.site_differences(assay, groups, 2).count() == 1


def test_normal_form_and_sites_of_regions(spark):
    rng = random.Random(1)
    spans = [(str(rng.randrange(2)), a := rng.randrange(0, 400_000), a + rng.choice([0, 1, 100, 70_000])) for _ in range(60)] + [("0", 5, 9), ("0", 9, 12), ("0", 6, 7)]
    regions = spark.createDataFrame(spans, "contig_key string, start long, end long")
    covered = {c: np.zeros(500_000, bool) for c in "01"}
    for c, a, b in spans:
        covered[c][a:b] = True
    want = set()
    for c, mask in covered.items():
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
        want |= {(c, int(a), int(b)) for a, b in zip(edge[::2], edge[1::2])}
    got = iv.merged(regions).collect()
    assert {(r["contig_key"], r["start"], r["end"]) for r in got} == want and len(got) == len(want)
    places = [(c, rng.randrange(0, 480_000)) for c in (0, 1) for _ in range(300)] + [(0, p) for p in (4, 5, 11, 12)]
    kept = iv.sites_in_regions(sites_of(spark, places), regions)
    assert sorted(r["cpg_idx"] for r in kept.collect()) == [i for i, (c, p) in enumerate(places) if covered[str(c)][p]]


def test_variants_mask_sites_they_touch(spark):
    places = [(1, 65_535), (1, 65_536), (1, 65_534), (1, 100), (1, 102), (1, 104), (2, 100), (1, 200_000)]
    variants = [("1", 65_536, 65_537, "C", "T"), ("1", 101, 104, "GAC", "G"), ("1", 150_000, 260_000, "N" * 5, "A")]
    table = spark.createDataFrame(variants, "contig_key string, start long, end long, ref string, alt string")
    left = lambda single: {places[r["cpg_idx"]] for r in iv.mask_variants(sites_of(spark, places), table, single).collect()}
    assert left(False) == {(1, 65_534), (1, 104), (2, 100)}
    assert left(True) == set(places) - {(1, 65_535), (1, 65_536)}


def test_interval_files(spark, tmp_path):
    (tmp_path / "r.bed").write_text("track name=x\n# c\nchr1\t5\t9\tname one\nCHRM 1 2\n\nX\t0\t4\n")
    rows = sorted(tuple(r) for r in read_bed(spark, str(tmp_path / "r.bed")).collect())
    assert rows == [("1", 5, 9, "name"), ("MT", 1, 2, None), ("X", 0, 4, None)]
    (tmp_path / "v.vcf").write_text("##fileformat=VCFv4.3\n#CHROM\tPOS\nchr2\t10\t.\tca\tt,g\t.\n2\t1\trs5\tG\tA\n")
    rows = sorted(tuple(r) for r in read_vcf(spark, str(tmp_path / "v.vcf")).collect())
    assert rows == [("2", 0, 1, "G", "A", "rs5"), ("2", 9, 11, "CA", "T,G", None)]
    (tmp_path / "bad.bed").write_text("chr1\t9\t5\n")
    with pytest.raises(ReferenceError_, match="not an interval"):
        read_bed(spark, str(tmp_path / "bad.bed"))
    (tmp_path / "bad.vcf").write_text("chr1\t0\t.\tA\tC\n")
    with pytest.raises(ReferenceError_, match="positive"):
        read_vcf(spark, str(tmp_path / "bad.vcf"))


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(2)
    x = rng.random((500, 7)).astype(np.float32)
    x[:, 3] = np.clip(x[:, 1] + rng.normal(0, 0.05, 500), 0, 1)
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 6] = np.nan  # a sample without cells
    return x.astype(np.float64)


@pytest.fixture(scope="module")
def pairs(spark, matrix):
    cells = [(int(i), int(j), 9, float(matrix[i, j])) for i, j in zip(*np.nonzero(~np.isnan(matrix)))]
    return si.pair_measures(si.gram(spark.createDataFrame(cells, "cpg_idx long, sample_idx int, cov long, beta float"), 7)).cache()


def plain_measures(x):
    out = {}
    for i in range(7):
        for j in range(i, 7):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if both.any():
                a, b = x[both, i], x[both, j]
                out[i, j] = (int(both.sum()), np.mean(a * b) - a.mean() * b.mean(), math.sqrt(np.mean((a - b) ** 2)))
    return out


def test_products_of_samples(pairs, matrix):
    want = plain_measures(matrix)
    got = {(r["i"], r["j"]): (r["n"], r["covariance"], r["distance"]) for r in pairs.collect()}
    assert set(got) == set(want)
    for k, (n, c, d) in want.items():
        assert got[k][0] == n and got[k][1:] == pytest.approx((c, d), abs=1e-6)


def test_components(pairs, matrix):
    square = np.zeros((7, 7))
    for (i, j), (_, c, _) in plain_measures(matrix).items():
        square[i, j] = square[j, i] = c
    at, share = si.principal_components(pairs, 7, 3)
    values, vectors = np.linalg.eigh(square)
    for k in range(3):
        want = vectors[:, -1 - k] * math.sqrt(values[-1 - k])
        want *= 1 if want[np.abs(want).argmax()] > 0 else -1
        assert at[:, k] == pytest.approx(want, abs=1e-6)
        assert share[k] == pytest.approx(values[-1 - k] / np.trace(square), abs=1e-6)
    assert (at[6] == 0).all()


def test_clusters(pairs, matrix):
    want, far = plain_measures(matrix), max(d for _, _, d in plain_measures(matrix).values())
    apart = lambda a, b: np.mean([want.get((min(i, j), max(i, j)), (0, 0, far))[2] for i in a for j in b])
    live, expect = {frozenset([i]): i for i in range(7)}, []
    while len(live) > 1:
        a, b = min(((a, b) for a in live for b in live if live[a] < live[b]), key=lambda p: (apart(*p), live[p[0]], live[p[1]]))
        expect.append((live[a], live[b], apart(a, b), len(a | b)))
        del live[a], live[b]
        live[a | b] = 6 + len(expect)
    got = si.sample_clusters(pairs, 7)
    assert got[0][:2] == (1, 3)
    for g, e in zip(got, expect, strict=True):
        assert (g[0], g[1], g[3]) == (e[0], e[1], e[3]) and g[2] == pytest.approx(e[2], abs=1e-5)


def test_too_many_samples(spark):
    with pytest.raises(ValueError, match="in parts"):
        si.gram(spark.createDataFrame([], "cpg_idx long, sample_idx int, cov long, beta float"), si.MOST_SAMPLES + 1)


def test_numbers_in_order(spark):
    rows = [(c, p) for c in "cab" for p in range(50)]
    random.Random(0).shuffle(rows)
    got = numbered(spark.createDataFrame(rows, "c string, p int").repartition(7), ["c", "p"], "at").collect()
    assert [(r["c"], r["p"]) for r in sorted(got, key=lambda r: r["at"])] == sorted(rows)
    assert sorted(r["at"] for r in got) == list(range(150))


def run_of(spark, places, names, cells, genome="g"):
    samples = spark.createDataFrame([(i, n, n) for i, n in enumerate(names)], "sample_idx int, sample_id string, sample_name string")
    return MethylationSet(sites_of(spark, places), samples, spark.createDataFrame(cells, "cpg_idx long, sample_idx int, cov long, beta float"), genome, len(places))


def test_merged_runs(spark):
    one = run_of(spark, [(1, 10), (2, 5)], ["b", "a"], [(0, 0, 3, 0.5), (1, 1, 4, 0.25)])
    two = run_of(spark, [(2, 5), (1, 20), (1, 10)], ["c"], [(0, 0, 7, 1.0), (2, 0, 8, 0.0)])
    both = merge_sets([one, two])
    sites = {(r["contig_key"], r["start"]): r["cpg_idx"] for r in both.row_data.collect()}
    assert sites == {("1", 10): 0, ("1", 20): 1, ("2", 5): 2}
    assert [r["sample_id"] for r in both.col_data.orderBy("sample_idx").collect()] == ["b", "a", "c"]
    assert sorted(tuple(r) for r in both.assay.collect()) == [(0, 0, 3, 0.5), (0, 2, 8, 0.0), (2, 1, 4, 0.25), (2, 2, 7, 1.0)]
    assert both.universe == 3


def test_runs_that_do_not_fit(spark):
    one, again = run_of(spark, [(1, 1)], ["a"], [(0, 0, 1, 1.0)]), run_of(spark, [(1, 1)], ["a", "z"], [(0, 0, 1, 1.0)])
    with pytest.raises(EngineError, match="more than one run: a"):
        merge_sets([one, again])
    with pytest.raises(EngineError, match="different genomes: g, h"):
        merge_sets([one, run_of(spark, [(1, 1)], ["b"], [(0, 0, 1, 1.0)], "h")])
    with pytest.raises(EngineError, match="no runs"):
        merge_sets([])


def test_cells_of_sites(spark):
    run = run_of(spark, [(1, 1), (1, 9)], ["a"], [(0, 0, 1, 1.0), (1, 0, 1, 1.0)])
    assert [r["cpg_idx"] for r in iv.cells_of(run.assay, run.row_data.where(F.col("start") > 5)).collect()] == [1]
