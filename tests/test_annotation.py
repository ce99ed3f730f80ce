import random

import pytest

from strandlake.contracts import I32_MAX, AnnotationError
from strandlake.operators import annotate as an
from strandlake.operators import genes as ge
from strandlake.operators import summary as su
from strandlake.sources import gtf


def model(spark, *lines):
    table = spark.createDataFrame(list(enumerate(lines)), "line_no long, value string")
    return ge.transcripts(gtf.parse_gtf(table))


def line(feature, start, end, strand="+", attrs='gene_id "g1"; transcript_id "t1"; gene_name "G 1";', contig="chr1"):
    return "\t".join([contig, "src", feature, str(start), str(end), ".", strand, ".", attrs])


def sites_at(spark, *positions):
    return spark.createDataFrame([(i, f"chr{c}", c, p, p + 2, "+") for i, (c, p) in enumerate(positions)], "cpg_idx long, chr string, contig_key string, start long, end long, strand string")


def labels(spark, models, *positions):
    rows = an.annotate(sites_at(spark, *positions), models, ge.features(models)).orderBy("cpg_idx").collect()
    return rows


def test_attributes(spark):
    table = spark.createDataFrame([('gene_id "g;x"; transcript_id "t1" ; gene_id "g2"; note;',)], "a string")
    row = table.select(gtf.attribute("a", "gene_id"), gtf.attribute("a", "transcript_id"), gtf.attribute("a", "missing")).first()
    assert tuple(row) == ("g2", "t1", None)


def test_rows_that_do_not_fit_are_skipped(spark):
    rows = gtf.parse_gtf(spark.createDataFrame(list(enumerate(["# head", "", "a\tb", line("exon", 9, 4), line("exon", "x", 4), line("exon", 1, 4, attrs='transcript_id "t";'), line("exon", 1, 4, attrs='transcript_id ""; gene_id "g";'), line("exon", 1, 4, attrs='gene_id "g";')])), "line_no long, value string"))
    assert [(r["transcript_id"], r["start"], r["end"], r["gene_symbol"]) for r in rows.collect()] == [("g", 0, 4, "g")]


def test_seven_regions(spark):
    # promoter 0-3101 would hide the rest, so the parts are set by hand
    rows = [("1", "+", "t1", "g1", "s1", 100, 500, 100)]
    base = spark.createDataFrame(rows, "contig_key string, strand string, transcript_id string, gene_id string, gene_symbol string, tx_start long, tx_end long, tss long")
    parts = [("Promoter", 1, 90, 110, ""), ("5' UTR", 2, 110, 120, ""), ("Exon", 4, 120, 150, "Exon 1 of 2"), ("Intron", 5, 150, 200, "Intron 1 of 1"), ("Exon", 4, 200, 300, "Exon 2 of 2"), ("3' UTR", 3, 230, 240, ""), ("Downstream", 6, 500, 600, "")]
    intervals = base.crossJoin(spark.createDataFrame([(i, *p) for i, p in enumerate(parts)], "feature_seq int, annotation string, priority int, start long, end long, rank_label string"))
    got = an.annotate(sites_at(spark, *[("1", p) for p in (100, 115, 130, 175, 235, 550, 700)]), base, intervals).orderBy("cpg_idx").collect()
    assert [r["annotation"] for r in got] == ["Promoter", "5' UTR", "Exon", "Intron", "3' UTR", "Downstream", "Intergenic"]
    assert [r["exon_intron_rank"] for r in got][2:4] == ["Exon 1 of 2", "Intron 1 of 1"]
    assert got[6]["gene_id"] == "g1" and got[6]["distance_to_tss"] == 600
    assert got[0]["start_1based"] == 101 and got[0]["end_1based"] == 102


def test_priority_and_aliases(spark):
    models = model(spark, line("transcript", 1001, 3000), line("exon", 1201, 1300), line("transcript", 1, 50, attrs='gene_id "m"; transcript_id "tm";', contig="chrM"))
    got = labels(spark, models, ("1", 1250), ("MT", 10), ("7", 5))
    assert [r["annotation"] for r in got] == ["Promoter", "Promoter", "Intergenic"]
    assert got[2]["distance_to_tss"] == I32_MAX and got[2]["gene_id"] == ""


def test_ranks_and_introns_follow_the_strand(spark):
    lines = [line("exon", s + 1, s + 100, "-") for s in (500, 100, 900)]
    row = model(spark, *lines).first()
    assert (row["tx_start"], row["tx_end"], row["tss"]) == (100, 1000, 999)
    assert [(x["start"], x["rank_label"]) for x in row["exons"]] == [(100, "Exon 3 of 3"), (500, "Exon 2 of 3"), (900, "Exon 1 of 3")]
    assert [(x["start"], x["end"], x["rank_label"]) for x in row["introns"]] == [(200, 500, "Intron 2 of 2"), (600, 900, "Intron 1 of 2")]
    assert tuple(row["downstream"]) == (0, 100) and tuple(row["promoter"]) == (0, 4000)


def test_bounds_last_row_wins(spark):
    row = model(spark, line("transcript", 1, 100), line("mRNA", 11, 200, "-")).first()
    assert (row["tx_start"], row["tx_end"], row["strand"]) == (10, 200, "-")
    assert model(spark, line("CDS", 1, 100)).count() == 0


def brute_force(models, site):
    best = None
    for t in models:
        if t["contig_key"] == site["contig_key"]:
            d = abs(t["tss"] - site["start"])
            left = t["tss"] < site["start"]
            own = (t["tx_start"], t["tx_end"], t["transcript_id"])
            key = (d, not left)
            if best is None or key < best[0] or key == best[0] and (own > best[1] if left else own < best[1]):
                best = (key, own)
    return best and best[1][2]


@pytest.mark.parametrize("seed", [0, 1])
def test_nearest_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(120):
        start = rng.choice([rng.randrange(0, 400_000), rng.randrange(0, 40) * 1000])
        end = start + rng.randrange(1, 3000)
        strand = rng.choice("+-")
        rows.append((rng.choice("12"), strand, f"t{i:03}", f"g{i}", f"s{i}", start, end, start if strand == "+" else end - 1))
    models = spark.createDataFrame(rows, "contig_key string, strand string, transcript_id string, gene_id string, gene_symbol string, tx_start long, tx_end long, tss long")
    points = [(rng.choice("123"), rng.choice([rng.randrange(0, 500_000), rng.randrange(0, 50) * 1000])) for _ in range(300)]
    sites = sites_at(spark, *points)
    got = {r["cpg_idx"]: r["transcript_id"] for r in an.nearest_tss(sites, models).collect()}
    plain = models.collect()
    assert got == {s["cpg_idx"]: b for s in sites.collect() if (b := brute_force(plain, s))}


def test_summary_and_report(spark):
    assay = spark.createDataFrame([(0, 0, 5, 0.5), (1, 1, 7, 0.5)], "cpg_idx long, sample_idx int, cov long, beta float")
    records = spark.createDataFrame([(0, "Promoter"), (1, "Exon")], "cpg_idx long, annotation string")
    samples = spark.createDataFrame([(0, "s1"), (1, "s2")], "sample_idx int, sample_id string")
    counts = su.annotation_counts(assay, records, samples)
    assert {tuple(r) for r in counts.collect()} == {("s1", "Promoter", 1), ("s2", "Exon", 1)}
    report = su.annotation_report(counts, samples, su.report_regions(records)).orderBy("sample").collect()
    assert report[0]["Promoter_count"] == 1 and report[0]["Promoter_percent"] == 100.0 and report[1]["Promoter_count"] == 0
    only = spark.createDataFrame([(0, "5' UTR")], "cpg_idx long, annotation string")
    assert su.report_regions(only) == ["Promoter", "Exon", "Intron", "Intergenic", "5' UTR"]
    with pytest.raises(AnnotationError):
        su.check_dimensions(1, 2)


def test_gene_model_is_found_or_named(spark, tmp_path):
    with pytest.raises(AnnotationError, match="no gene model"):
        gtf.find_gtf(spark, str(tmp_path), "hg19")
    (tmp_path / "only.gtf").write_text("")
    assert gtf.find_gtf(spark, str(tmp_path), "hg19").endswith("only.gtf")
    (tmp_path / "b.gtf.gz").write_text("")
    with pytest.raises(AnnotationError, match="several"):
        gtf.find_gtf(spark, str(tmp_path), "hg19")
    (tmp_path / "hg19.gtf").write_text("")
    assert gtf.find_gtf(spark, str(tmp_path), "my_HG19").endswith("hg19.gtf")
