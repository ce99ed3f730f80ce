"""Every operator as a query over the driver's tables, with its SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import I32_MAX, THRESHOLDS
from ..functions.columns import canonical_contig, is_standard_contig, percent, priority_of, site_name, thousands, tsv_field
from ..operators import align as al
from ..operators import annotate as an
from ..operators import downstream as ds
from ..operators import filters as fi
from ..operators import genes as ge
from ..operators import stats as st
from ..operators import summary as su
from ..operators import validate as va
from ..operators.assay import build_assay, dense, wide
from ..sinks.report import annotation_table, coverage_report
from ..sinks.store import row_data_table
from ..sources import coverage as co
from ..sources import fasta as fa
from ..sources import gtf as gt
from . import file_queries
from .projection import BOUNDARIES, LINES, SEQUENCES, Projection, oracle_views

MIN_COVERAGE = 5
SAMPLES = [(0, "A_F"), (1, "A_O"), (2, "N_F"), (3, "N_O"), (4, "R_F"), (5, "R_O")]


_HELD: list[DataFrame] = []


def _cached(df: DataFrame) -> DataFrame:
    """One evaluation for the several uses a query makes of a table. It is
    released when the next query begins; results read later are made anew."""
    _HELD.append(df.cache())
    return df


class Run:
    """What a run of the engine has in hand, built as far as it is used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.p = Projection(spark, sf_dir)
        while _HELD:
            old = _HELD.pop()
            if old.sparkSession.sparkContext is spark.sparkContext:
                old.unpersist()

    def aligned(self) -> DataFrame:
        return al.align(self.p.records(), self.p.sites())

    def assay(self, minimum: int = MIN_COVERAGE) -> DataFrame:
        samples = self.p.samples().select("sample_id", "sample_idx")
        return build_assay(self.aligned().join(samples, "sample_id"), minimum)

    def kept(self, assay: DataFrame) -> DataFrame:
        return fi.remove_uncovered(self.p.sites(), assay)

    def models(self) -> DataFrame:
        return ge.transcripts(self.p.gtf_rows())

    def annotation(self) -> DataFrame:
        models = _cached(self.models())
        return an.annotate(self.p.sites(), models, ge.features(models))


def _double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def cpg_extract(spark, sf_dir):
    found = fa.cpg_positions(Projection(spark, sf_dir).sequences())
    return found.select("contig_idx", "contig", F.col("start").alias("start0"))


def cpg_scan(spark, sf_dir):
    found = fa.scan_cpgs(Projection(spark, sf_dir).sequences())
    return found.select("contig_idx", "contig", F.col("start").alias("start0"), "nth")


def gtf_parse(spark, sf_dir):
    rows = gt.parse_gtf(Projection(spark, sf_dir).gtf_lines())
    return rows.withColumnsRenamed({"start": "start0", "end": "end0"})


def annotation_regions(spark, sf_dir):
    return Run(spark, sf_dir).annotation().groupBy("annotation").agg(F.count("*").alias("n"), F.min(priority_of(F.col("annotation"))).alias("priority"))


def contig_canonical(spark, sf_dir):
    seen = Projection(spark, sf_dir).observations().select("shown").distinct()
    return seen.select("shown", canonical_contig(F.col("shown")).alias("contig_key"))


def contig_lengths(spark, sf_dir):
    return fa.contig_lengths(Projection(spark, sf_dir).sequences()).groupBy("contig").agg(F.sum("length").alias("bases"), F.count("*").alias("n"))


def standard_contigs(spark, sf_dir):
    seen = Projection(spark, sf_dir).sequences().select("contig").distinct()
    return seen.select("contig", is_standard_contig(F.col("contig")).alias("standard"))


def record_validation(spark, sf_dir):
    parsed = co.parse_lines(Projection(spark, sf_dir).lines())
    return parsed.groupBy(F.coalesce("rule", F.lit("sound")).alias("rule")).agg(F.count("*").alias("n"))


def coverage_parse(spark, sf_dir):
    parsed = co.parse_lines(Projection(spark, sf_dir).lines()).where("problem IS NULL")
    found = co.records(parsed, "l_orderkey")
    return found.groupBy("contig_key").agg(F.count("*").alias("n"), F.sum("start").alias("starts"), F.sum("methylated").alias("m"), F.sum("unmethylated").alias("u"))


def duplicate_records(spark, sf_dir):
    raw = Projection(spark, sf_dir).observations().withColumn("contig_key", canonical_contig(F.col("shown"))).withColumnRenamed("pos0", "start")
    return co.duplicates(raw).withColumnRenamed("start", "pos0")


def align_exact_shift(spark, sf_dir):
    return Run(spark, sf_dir).aligned().select("sample_id", "contig_key", F.col("start").alias("pos0"), "cpg_idx", "methylated", "unmethylated")


def match_totals(spark, sf_dir):
    return al.match_totals(Run(spark, sf_dir).aligned())


def unmatched_contigs(spark, sf_dir):
    run = Run(spark, sf_dir)
    odd = run.p.records().withColumn("chr", F.when(F.col("start") % 5 == 3, F.concat("chr", F.lit("_alt"))).otherwise(F.col("chr"))).withColumn("contig_key", canonical_contig(F.col("chr")))
    out = al.unmatched_contigs(al.align(odd, run.p.sites()))
    return out.select("sample_id", F.array_join("contigs", ",").alias("contigs"))


def duplicate_sites(spark, sf_dir):
    sites = Projection(spark, sf_dir).sites()
    twice = sites.unionByName(sites.where("cpg_idx % 7 = 0").withColumn("cpg_idx", F.col("cpg_idx") + 1_000_000))
    return al.duplicate_sites(twice).withColumnRenamed("start", "start0")


def assay_long(spark, sf_dir):
    return _double(Run(spark, sf_dir).assay(), "beta")


def assay_min_cov(spark, sf_dir):
    return _double(Run(spark, sf_dir).assay(10), "beta")


def dense_cells(spark, sf_dir):
    run = Run(spark, sf_dir)
    return _double(dense(run.assay(), run.p.sites(), run.p.samples()), "beta")


def beta_matrix_wide(spark, sf_dir):
    run = Run(spark, sf_dir)
    return _double(wide(run.assay(), run.p.sites(), SAMPLES), *[n for _, n in SAMPLES])


def cov_matrix_wide(spark, sf_dir):
    run = Run(spark, sf_dir)
    return wide(run.assay(), run.p.sites(), SAMPLES, "cov")


def remove_uncovered(spark, sf_dir):
    run = Run(spark, sf_dir)
    return run.kept(run.assay()).select("cpg_idx", "chr", F.col("start").alias("start0"))


def coverage_filter(spark, sf_dir):
    run = Run(spark, sf_dir)
    return fi.coverage_filter(run.p.sites(), run.assay(1), 10, 3, len(SAMPLES))


def coverage_stats(spark, sf_dir):
    """Per-sample coverage statistics over the filtered matrix."""
    run = Run(spark, sf_dir)
    assay = _cached(run.assay())
    rows = assay.agg(F.countDistinct("cpg_idx").alias("n"))
    return _double(st.coverage_stats(assay, run.p.samples(), rows), "mean_coverage")


def coverage_report_table(spark, sf_dir):
    run = Run(spark, sf_dir)
    assay = _cached(run.assay())
    return coverage_report(st.coverage_stats(assay, run.p.samples(), assay.agg(F.countDistinct("cpg_idx").alias("n"))))


def coverage_distribution(spark, sf_dir):
    return st.coverage_distribution(Run(spark, sf_dir).assay(1))


def gtf_transcripts(spark, sf_dir):
    return Run(spark, sf_dir).models().select("transcript_id", "contig_key", "strand", "gene_id", "gene_symbol", "tx_start", "tx_end", "tss", F.size("exons").alias("n_exons"), F.size("introns").alias("n_introns"), F.size("utr5").alias("n_utr5"), F.size("utr3").alias("n_utr3"))


def _parts(spark, sf_dir, name):
    return Run(spark, sf_dir).models().select("transcript_id", F.inline(name)).select("transcript_id", F.col("start").alias("start0"), F.col("end").alias("end0"), "rank_label")


def exon_ranks(spark, sf_dir):
    return _parts(spark, sf_dir, "exons")


def introns(spark, sf_dir):
    return _parts(spark, sf_dir, "introns")


def promoters_downstream(spark, sf_dir):
    return Run(spark, sf_dir).models().select("transcript_id", F.col("promoter.start").alias("promoter_start"), F.col("promoter.end").alias("promoter_end"), F.col("downstream.start").alias("downstream_start"), F.col("downstream.end").alias("downstream_end"))


def feature_intervals(spark, sf_dir):
    return ge.features(Run(spark, sf_dir).models()).select("transcript_id", "annotation", "priority", F.col("start").alias("start0"), F.col("end").alias("end0"), "rank_label")


def feature_bins(spark, sf_dir):
    return ge.binned(ge.features(Run(spark, sf_dir).models())).groupBy("contig_key", "bin").agg(F.count("*").alias("n"))


def annotate_overlap(spark, sf_dir):
    run = Run(spark, sf_dir)
    return an.overlap(run.p.sites(), ge.features(run.models()))


def nearest_tss(spark, sf_dir):
    run = Run(spark, sf_dir)
    return an.nearest_tss(run.p.sites(), run.models())


def annotate_full(spark, sf_dir):
    return Run(spark, sf_dir).annotation()


def annotation_tsv(spark, sf_dir):
    return annotation_table(Run(spark, sf_dir).annotation()).drop("cpg_idx")


def annotation_summary(spark, sf_dir):
    run = Run(spark, sf_dir)
    return su.annotation_counts(run.assay(), run.annotation(), run.p.samples())


def annotation_report(spark, sf_dir):
    run = Run(spark, sf_dir)
    regions = [*su.REPORT_REGIONS, "3' UTR", "5' UTR", "Downstream"]
    report = su.annotation_report(su.annotation_counts(run.assay(), run.annotation(), run.p.samples()), run.p.samples(), regions)
    return report.toDF(*[c.replace("'", "").replace(" ", "_").lower() for c in report.columns])


def stored_rows(spark, sf_dir):
    return row_data_table(Projection(spark, sf_dir).sites()).withColumnsRenamed({"start": "start1", "end": "end1"}).withColumn("site", site_name(F.col("chr"), F.col("start1") - 1))


def validate_rowdata(spark, sf_dir):
    rows = row_data_table(Projection(spark, sf_dir).sites())
    k = F.col("cpg_idx")
    spoilt = rows.withColumns({
        "chr": F.when(k % 11 == 0, "").otherwise(F.col("chr")), "start": F.when(k % 13 == 0, F.lit(0)).otherwise(F.col("start")),
        "width": F.when(k % 17 == 0, F.lit(1)).otherwise(F.col("width")), "strand": F.when(k % 19 == 0, "?").otherwise(F.col("strand")),
        "end": F.when(k % 23 == 0, F.lit(-1)).otherwise(F.col("end")),
    })
    return va.violations(spoilt, va.row_rules()).withColumnRenamed("first", "first_idx")


def validate_assay(spark, sf_dir):
    k = F.col("cpg_idx")
    spoilt = Run(spark, sf_dir).assay().withColumns({"cov": F.when(k % 29 == 0, F.lit(0)).otherwise(F.col("cov")), "beta": F.when(k % 31 == 0, F.lit(None)).when(k % 37 == 0, F.lit(1.25)).otherwise(F.col("beta")).cast("float")})
    return va.violations(spoilt, va.assay_rules()).withColumnRenamed("first", "first_idx")


def assay_diff(spark, sf_dir):
    run = Run(spark, sf_dir)
    left = _cached(run.assay())
    k = F.col("cpg_idx")
    right = left.where(k % 41 != 0).withColumns({"cov": F.when(k % 43 == 0, F.col("cov") + 1).otherwise(F.col("cov")), "beta": F.when(k % 47 == 0, F.lit(0.5)).otherwise(F.col("beta")).cast("float")})
    return ds.assay_diff(left.where(k % 53 != 0), right).groupBy("reason").agg(F.count("*").alias("n"), F.sum("cpg_idx").alias("sites"))


def sample_mean_beta(spark, sf_dir):
    return ds.mean_beta(Run(spark, sf_dir).assay()).withColumn("mean_beta", F.round("mean_beta", 9))


def sample_mean_cov(spark, sf_dir):
    run = Run(spark, sf_dir)
    return ds.mean_coverage(run.assay(), run.p.sites().agg(F.count("*").alias("n"))).withColumn("mean_cov", F.round("mean_cov", 9))


def region_subset(spark, sf_dir):
    run = Run(spark, sf_dir)
    rows, cells = ds.region_subset(run.p.sites(), run.assay(), ["chr3", "chr21"])
    return _double(cells.join(rows.select("cpg_idx", "chr"), "cpg_idx"), "beta")


def high_coverage_sites(spark, sf_dir):
    return ds.high_coverage_sites(Run(spark, sf_dir).assay(), len(SAMPLES), 10.0).withColumn("mean_cov", F.round("mean_cov", 9))


def delta_beta_topk(spark, sf_dir):
    return ds.delta_beta(Run(spark, sf_dir).assay(), 0, 3, 100)


def bedgraph_export(spark, sf_dir):
    run = Run(spark, sf_dir)
    return ds.bedgraph(run.p.sites(), run.assay()).withColumnsRenamed({"start": "start0", "end": "end0"})


def gene_mean_beta(spark, sf_dir):
    run = Run(spark, sf_dir)
    return ds.gene_mean_beta(run.assay(), run.annotation()).withColumn("mean_beta", F.round("mean_beta", 9))


def dataset_inspect(spark, sf_dir):
    run = Run(spark, sf_dir)
    return ds.inspect(run.p.sites(), run.assay())


def report_percent(spark, sf_dir):
    run = Run(spark, sf_dir)
    totals = al.match_totals(run.aligned())
    return totals.select("sample_id", percent(F.col("n_matched"), F.col("n_records")).alias("matched_percent"))


def adjacent_sites(spark, sf_dir):
    """Every site has a neighbour at the next base: an exact match goes before
    a shifted one."""
    p = Projection(spark, sf_dir)
    sites = p.sites()
    both = sites.unionByName(sites.withColumns({"cpg_idx": F.col("cpg_idx") + 10_000_000, "start": F.col("start") + 1, "end": F.col("end") + 1}))
    return al.align(p.records(), both).select("sample_id", "contig_key", F.col("start").alias("pos0"), "cpg_idx")


def orphan_contigs(spark, sf_dir):
    """Half of the contigs have no transcript."""
    run = Run(spark, sf_dir)
    models = _cached(run.models().where(F.col("contig_key").cast("int") <= 11))
    return an.annotate(run.p.sites(), models, ge.features(models))


def gene_fallbacks(spark, sf_dir):
    """Other spellings of features, bounds given by exons alone on the minus
    strand, and transcripts of which nothing but an UTR is there."""
    rows = Run(spark, sf_dir).p.gtf_rows()
    spelled = F.create_map(*map(F.lit, ("transcript", "mRNA", "five_prime_utr", "5'UTR", "three_prime_utr", "3utr", "exon", "EXON")))
    left = rows.where("NOT (feature = 'transcript' AND strand = '-')").where("feature = 'three_prime_utr' OR NOT endswith(transcript_id, '7')")
    models = ge.transcripts(left.withColumn("feature", spelled[F.col("feature")]))
    return models.select("transcript_id", "tx_start", "tx_end", "tss", F.size("exons").alias("n_exons"), F.size("utr5").alias("n_utr5"), F.size("utr3").alias("n_utr3"))


def empty_intervals(spark, sf_dir):
    found = ge.features(Run(spark, sf_dir).models())
    return ge.binned(found.withColumn("end", F.when(F.col("priority") == 6, F.col("start")).when(F.col("priority") == 1, F.col("start") - 5).otherwise(F.col("end")))).groupBy("contig_key", "annotation").agg(F.count("*").alias("n"))


def line_boundaries(spark, sf_dir):
    """Lines just inside and just outside of each bound."""
    parsed = co.parse_lines(Projection(spark, sf_dir).sql(BOUNDARIES))
    return parsed.groupBy("l_linenumber", F.coalesce("rule", F.lit("sound")).alias("rule")).agg(F.count("*").alias("n"))


def thousands_shown(spark, sf_dir):
    part = Projection(spark, sf_dir).raw["part"]
    return part.select("p_partkey", thousands(F.col("p_partkey") * 12345 - 5_000_000).alias("shown"))


def tsv_escapes(spark, sf_dir):
    genes = Projection(spark, sf_dir).genes()
    return genes.select(tsv_field(F.concat("transcript_id", F.lit("\t"), "gene_id", F.lit("\n\r"), "strand")).alias("field"))


def coverage_filter_edges(spark, sf_dir):
    run = Run(spark, sf_dir)
    assay = _cached(run.assay(1))
    cases = [fi.coverage_filter(run.p.sites(), assay, t, need, len(SAMPLES)).select("cpg_idx", "kept", F.lit(t).alias("threshold"), F.lit(need).alias("need")) for t, need in ((0, 3), (0, 7), (1, 6), (4, 1))]
    return cases[0].unionByName(cases[1]).unionByName(cases[2]).unionByName(cases[3])


def validate_dense(spark, sf_dir):
    run = Run(spark, sf_dir)
    k = F.col("cpg_idx")
    cells = dense(run.assay(), run.p.sites(), run.p.samples())
    spoilt = cells.withColumn("beta", F.when(k % 31 == 0, F.lit(0.5)).when(k % 37 == 0, F.lit(None)).when(k % 41 == 0, F.lit(-0.25)).otherwise(F.col("beta")).cast("float"))
    return va.violations(spoilt, va.dense_rules()).withColumnRenamed("first", "first_idx")


QUERIES = {
    f.__name__: f
    for f in (
        cpg_extract, cpg_scan, gtf_parse, annotation_regions, contig_canonical, contig_lengths, standard_contigs, record_validation, coverage_parse, duplicate_records, align_exact_shift,
        match_totals, unmatched_contigs, duplicate_sites, assay_long, assay_min_cov, dense_cells, beta_matrix_wide, cov_matrix_wide, remove_uncovered,
        coverage_filter, coverage_stats, coverage_report_table, coverage_distribution, gtf_transcripts, exon_ranks, introns, promoters_downstream,
        feature_intervals, feature_bins, annotate_overlap, nearest_tss, annotate_full, annotation_tsv, annotation_summary, annotation_report, stored_rows,
        validate_rowdata, validate_assay, assay_diff, sample_mean_beta, sample_mean_cov, region_subset, high_coverage_sites, delta_beta_topk,
        bedgraph_export, gene_mean_beta, dataset_inspect, report_percent,
        adjacent_sites, orphan_contigs, gene_fallbacks, empty_intervals, line_boundaries, thousands_shown, tsv_escapes, coverage_filter_edges, validate_dense,
    )
}


# --- the same in SQL, written apart from the operators ---------------------

_ALIGNED = """
aligned AS (
  SELECT r.sample_id, r.contig_key, r.pos0, r.m, r.u, coalesce(e.cpg_idx, s.cpg_idx) AS cpg_idx
  FROM records r
  LEFT JOIN sites e ON e.contig_key = r.contig_key AND e.start0 = r.pos0
  LEFT JOIN sites s ON s.contig_key = r.contig_key AND s.start0 = r.pos0 - 1)"""


def _assay(name: str, minimum: int) -> str:
    return f"""
{name} AS (
  SELECT cpg_idx, sample_idx, CAST(sum(m + u) AS BIGINT) AS cov,
         CAST(CAST(CAST(sum(m) AS FLOAT) / CAST(sum(m + u) AS FLOAT) AS FLOAT) AS DOUBLE) AS beta
  FROM aligned JOIN samples USING (sample_id) WHERE cpg_idx IS NOT NULL
  GROUP BY cpg_idx, sample_idx HAVING sum(m + u) >= {minimum} AND sum(m + u) > 0)"""


_MODEL = """
models AS (
  SELECT transcript_id, gene_id, upper(gene_id) AS gene_symbol, contig_key, strand, n, b AS tx_start, b + (n - 1) * 2500 + 600 AS tx_end,
         CASE WHEN strand = '-' THEN b + (n - 1) * 2500 + 599 ELSE b END AS tss, b FROM genes),
parts AS (
  SELECT transcript_id, 1 AS priority, 'Promoter' AS annotation, 0 AS feature_seq, greatest(tss - 3000, 0) AS start0, tss + 3001 AS end0, '' AS rank_label FROM models
  UNION ALL
  SELECT transcript_id, 2, '5'' UTR', 1, CASE WHEN strand = '-' THEN b + (n - 3) * 2500 ELSE b + 5000 END, CASE WHEN strand = '-' THEN b + (n - 3) * 2500 ELSE b + 5000 END + 150, '' FROM models WHERE n >= 4
  UNION ALL
  SELECT transcript_id, 3, '3'' UTR', 2, CASE WHEN strand = '-' THEN b ELSE tx_end - 200 END, CASE WHEN strand = '-' THEN b + 200 ELSE tx_end END, '' FROM models
  UNION ALL
  SELECT transcript_id, 4, 'Exon', CAST(2 + i AS INT), b + (i - 1) * 2500, b + (i - 1) * 2500 + 600, concat('Exon ', CAST(CASE WHEN strand = '-' THEN n - i + 1 ELSE i END AS VARCHAR), ' of ', CAST(n AS VARCHAR))
  FROM models, (SELECT unnest(range(1, 8)) AS i) k WHERE i <= n AND i <= (SELECT max(l_linenumber) FROM lineitem)
  UNION ALL
  SELECT transcript_id, 5, 'Intron', CAST(20 + i AS INT), b + (i - 1) * 2500 + 600, b + i * 2500, concat('Intron ', CAST(CASE WHEN strand = '-' THEN n - i ELSE i END AS VARCHAR), ' of ', CAST(n - 1 AS VARCHAR))
  FROM models, (SELECT unnest(range(1, 8)) AS i) k WHERE i < n
  UNION ALL
  SELECT transcript_id, 6, 'Downstream', 90, CASE WHEN strand = '-' THEN greatest(tx_start - 3000, 0) ELSE tx_end END, CASE WHEN strand = '-' THEN tx_start ELSE tx_end + 3000 END, '' FROM models)"""

_NEAREST = """
near AS (
  SELECT cpg_idx, gene_id, gene_symbol, transcript_id, CAST(CASE WHEN strand = '-' THEN tss - pos ELSE pos - tss END AS INT) AS distance_to_tss
  FROM (
    SELECT s.cpg_idx, s.start0 AS pos, m.*, row_number() OVER (PARTITION BY s.cpg_idx ORDER BY abs(m.tss - s.start0), CASE WHEN m.tss < s.start0 THEN 0 ELSE 1 END,
             CASE WHEN m.tss < s.start0 THEN -m.tx_start ELSE m.tx_start END, CASE WHEN m.tss < s.start0 THEN -m.tx_end ELSE m.tx_end END, m.transcript_id) AS r
    FROM sites s JOIN models m ON m.contig_key = s.contig_key) x
  WHERE r = 1)"""

_OVERLAP = """
best AS (
  SELECT cpg_idx, annotation, gene_id, gene_symbol, transcript_id, distance_to_tss, rank_label AS exon_intron_rank FROM (
    SELECT s.cpg_idx, p.annotation, m.gene_id, m.gene_symbol, m.transcript_id, p.rank_label,
           CAST(CASE WHEN m.strand = '-' THEN m.tss - s.start0 ELSE s.start0 - m.tss END AS INT) AS distance_to_tss,
           row_number() OVER (PARTITION BY s.cpg_idx ORDER BY p.priority, abs(s.start0 - m.tss), m.tx_start, m.tx_end, m.transcript_id, p.feature_seq) AS r
    FROM sites s JOIN models m ON m.contig_key = s.contig_key JOIN parts p ON p.transcript_id = m.transcript_id AND p.start0 <= s.start0 AND s.start0 < p.end0) x
  WHERE r = 1)"""

_FULL = f"""
annotation AS (
  SELECT s.cpg_idx, s.chr, s.start0 + 1 AS start_1based, s.end0 AS end_1based, s.strand, coalesce(b.annotation, 'Intergenic') AS annotation,
         coalesce(b.gene_id, n.gene_id, '') AS gene_id, coalesce(b.gene_symbol, n.gene_symbol, '') AS gene_symbol,
         coalesce(b.transcript_id, n.transcript_id, '') AS transcript_id,
         CAST(CASE WHEN b.cpg_idx IS NOT NULL THEN b.distance_to_tss WHEN n.cpg_idx IS NOT NULL THEN n.distance_to_tss ELSE {I32_MAX} END AS INT) AS distance_to_tss,
         coalesce(b.exon_intron_rank, '') AS exon_intron_rank
  FROM sites s LEFT JOIN best b ON b.cpg_idx = s.cpg_idx LEFT JOIN near n ON n.cpg_idx = s.cpg_idx)"""


def _with(query: str, *more: str) -> str:
    return "WITH " + ",\n".join((oracle_views(), *more)) + "\n" + query


_A5 = (_ALIGNED, _assay("assay", MIN_COVERAGE))
_ANN = (_MODEL, _OVERLAP, _NEAREST, _FULL)
_GE = ", ".join(f"CAST(coalesce(count(*) FILTER (cov >= {t}), 0) AS BIGINT) AS n_ge_{t}" for t in THRESHOLDS)
_STATS = f"""
stats AS (
  SELECT sample_id, (SELECT count(DISTINCT cpg_idx) FROM assay) AS n_total, count(cpg_idx) AS n_covered,
         coalesce(CAST(CAST(CAST(sum(cov) AS FLOAT) / CAST(nullif(count(cpg_idx), 0) AS FLOAT) AS FLOAT) AS DOUBLE), 0.0) AS mean_coverage, {_GE}
  FROM samples LEFT JOIN assay USING (sample_idx) GROUP BY sample_id)"""
_REPORT_REGIONS = (("promoter", "Promoter"), ("exon", "Exon"), ("intron", "Intron"), ("intergenic", "Intergenic"), ("3_utr", "3'' UTR"), ("5_utr", "5'' UTR"), ("downstream", "Downstream"))
_COLUMNS_WIDE = lambda v: ", ".join(f'max({v}) FILTER (sample_idx = {i}) AS "{n}"' for i, n in SAMPLES)
_SPLIT = "string_split(value, chr(9))"

ORACLES = {
    "cpg_extract": f"WITH s AS ({SEQUENCES}) SELECT contig_idx, contig, CAST(i - 1 AS BIGINT) AS start0 FROM (SELECT *, unnest(range(1, length(seq))) AS i FROM s) x WHERE substr(seq, i, 2) = 'CG'",
    "cpg_scan": f"WITH s AS ({SEQUENCES}) SELECT contig_idx, contig, CAST(i - 1 AS BIGINT) AS start0, row_number() OVER (PARTITION BY contig_idx, seq ORDER BY i) - 1 AS nth FROM (SELECT *, unnest(range(1, length(seq))) AS i FROM s) x WHERE substr(seq, i, 2) = 'CG'",
    "gtf_parse": """
        SELECT concat('chr', CAST(s_suppkey % 22 + 1 AS VARCHAR)) AS seqname, 'exon' AS feature, s_suppkey * 10 AS start0, s_suppkey * 10 + 100 AS end0,
               CASE WHEN s_nationkey % 2 = 0 THEN '-' ELSE '+' END AS strand, concat(CASE WHEN s_suppkey % 7 = 4 THEN 'g' ELSE 'tx' END, CAST(s_suppkey AS VARCHAR)) AS transcript_id,
               concat('g', CAST(s_suppkey AS VARCHAR)) AS gene_id, concat(CASE WHEN s_suppkey % 7 = 4 THEN 'g' ELSE 'N ' END, CAST(s_suppkey AS VARCHAR)) AS gene_symbol, s_suppkey AS line_no
        FROM supplier WHERE s_suppkey % 7 NOT IN (1, 2, 3, 5)""",
    "annotation_regions": _with("SELECT annotation, count(*) AS n, CASE annotation WHEN 'Promoter' THEN 1 WHEN '5'' UTR' THEN 2 WHEN '3'' UTR' THEN 3 WHEN 'Exon' THEN 4 WHEN 'Intron' THEN 5 WHEN 'Downstream' THEN 6 ELSE 7 END AS priority FROM annotation GROUP BY annotation", *_ANN),
    "contig_canonical": _with("SELECT DISTINCT shown, contig_key FROM observations"),
    "contig_lengths": f"WITH s AS ({SEQUENCES}) SELECT contig, CAST(sum(length(seq)) AS BIGINT) AS bases, count(*) AS n FROM s GROUP BY contig",
    "standard_contigs": f"WITH s AS ({SEQUENCES}) SELECT DISTINCT contig, CAST(substr(contig, 4) AS INT) BETWEEN 1 AND 22 AS standard FROM s",
    "record_validation": """
        SELECT CASE l_suppkey % 13 WHEN 1 THEN 'columns' WHEN 2 THEN 'chromosome' WHEN 3 THEN 'fields' WHEN 4 THEN 'start' WHEN 5 THEN 'single_base'
               WHEN 6 THEN 'percent_range' WHEN 7 THEN 'overflow' WHEN 8 THEN 'percent_match' ELSE 'sound' END AS rule, count(*) AS n FROM lineitem GROUP BY 1""",
    "coverage_parse": f"""
        WITH l AS ({LINES}), f AS (SELECT {_SPLIT} AS f FROM l WHERE l_suppkey % 13 NOT BETWEEN 1 AND 8)
        SELECT substr(f[1], 4) AS contig_key, count(*) AS n, CAST(sum(CAST(f[2] AS BIGINT) - 1) AS BIGINT) AS starts, CAST(sum(CAST(f[5] AS BIGINT)) AS BIGINT) AS m,
               CAST(sum(CAST(f[6] AS BIGINT)) AS BIGINT) AS u FROM f GROUP BY 1""",
    "duplicate_records": _with("SELECT sample_id, contig_key, pos0, count(*) AS n FROM observations GROUP BY sample_id, contig_key, pos0 HAVING count(*) > 1"),
    "align_exact_shift": _with("SELECT sample_id, contig_key, pos0, cpg_idx, m AS methylated, u AS unmethylated FROM aligned", _ALIGNED),
    "match_totals": _with("SELECT sample_id, count(*) AS n_records, count(cpg_idx) AS n_matched FROM aligned GROUP BY sample_id", _ALIGNED),
    "unmatched_contigs": _with("""
        SELECT sample_id, string_agg(c, ',' ORDER BY c) AS contigs FROM (
          SELECT sample_id, CASE WHEN pos0 % 5 = 3 THEN concat('chr', contig_key, '_alt') ELSE concat('chr', contig_key) END AS c,
                 count(CASE WHEN pos0 % 5 = 3 THEN NULL ELSE cpg_idx END) AS hits FROM aligned GROUP BY 1, 2) x WHERE hits = 0 GROUP BY sample_id""", _ALIGNED),
    "duplicate_sites": _with("SELECT contig_key, start0, CAST(2 AS BIGINT) AS n, cpg_idx AS first_idx, cpg_idx + 1000000 AS last_idx FROM sites WHERE cpg_idx % 7 = 0"),
    "assay_long": _with("SELECT * FROM assay", *_A5),
    "assay_min_cov": _with("SELECT * FROM assay", _ALIGNED, _assay("assay", 10)),
    "dense_cells": _with("SELECT s.cpg_idx, p.sample_idx, coalesce(cov, 0) AS cov, beta FROM sites s CROSS JOIN samples p LEFT JOIN assay a ON a.cpg_idx = s.cpg_idx AND a.sample_idx = p.sample_idx", *_A5),
    "beta_matrix_wide": _with(f"SELECT s.cpg_idx, {_COLUMNS_WIDE('beta')} FROM sites s LEFT JOIN assay a ON a.cpg_idx = s.cpg_idx GROUP BY s.cpg_idx", *_A5),
    "cov_matrix_wide": _with("SELECT cpg_idx, " + ", ".join(f'coalesce("{n}", 0) AS "{n}"' for _, n in SAMPLES) + f" FROM (SELECT s.cpg_idx, {_COLUMNS_WIDE('cov')} FROM sites s LEFT JOIN assay a ON a.cpg_idx = s.cpg_idx GROUP BY s.cpg_idx) x", *_A5),
    "remove_uncovered": _with("SELECT cpg_idx, chr, start0 FROM sites WHERE cpg_idx IN (SELECT cpg_idx FROM assay)", *_A5),
    "coverage_filter": _with("SELECT s.cpg_idx, count(*) FILTER (cov >= 10) >= 3 AS kept FROM sites s LEFT JOIN assay a ON a.cpg_idx = s.cpg_idx GROUP BY s.cpg_idx", _ALIGNED, _assay("assay", 1)),
    "coverage_stats": _with("SELECT * FROM stats", *_A5, _STATS),
    "coverage_report_table": _with('SELECT sample_id AS "Sample", n_total AS "Total CpGs", n_covered AS "Covered CpGs", ' + ", ".join(f'n_ge_{t} AS "{t}X"' for t in THRESHOLDS) + " FROM stats", *_A5, _STATS),
    "coverage_distribution": _with(" UNION ALL ".join(f"SELECT {t} AS threshold, count(*) FILTER (cov >= {t}) AS n_cells FROM assay" for t in THRESHOLDS), _ALIGNED, _assay("assay", 1)),
    "gtf_transcripts": _with("""
        SELECT transcript_id, contig_key, strand, gene_id, gene_symbol, tx_start, tx_end, tss, CAST(n AS INT) AS n_exons, CAST(n - 1 AS INT) AS n_introns,
               CASE WHEN n >= 4 THEN 1 ELSE 0 END AS n_utr5, 1 AS n_utr3 FROM models""", _MODEL),
    "exon_ranks": _with("SELECT transcript_id, start0, end0, rank_label FROM parts WHERE annotation = 'Exon'", _MODEL),
    "introns": _with("SELECT transcript_id, start0, end0, rank_label FROM parts WHERE annotation = 'Intron'", _MODEL),
    "promoters_downstream": _with("""
        SELECT p.transcript_id, p.start0 AS promoter_start, p.end0 AS promoter_end, d.start0 AS downstream_start, d.end0 AS downstream_end
        FROM parts p JOIN parts d USING (transcript_id) WHERE p.annotation = 'Promoter' AND d.annotation = 'Downstream'""", _MODEL),
    "feature_intervals": _with("SELECT transcript_id, annotation, priority, start0, end0, rank_label FROM parts", _MODEL),
    "feature_bins": _with("""
        SELECT contig_key, bin, count(*) AS n FROM (SELECT contig_key, unnest(range(start0 >> 16, ((end0 - 1) >> 16) + 1)) AS bin
          FROM parts JOIN models USING (transcript_id) WHERE end0 > start0) x GROUP BY 1, 2""", _MODEL),
    "annotate_overlap": _with("SELECT * FROM best", _MODEL, _OVERLAP),
    "nearest_tss": _with("SELECT * FROM near", _MODEL, _NEAREST),
    "annotate_full": _with("SELECT * FROM annotation", *_ANN),
    "annotation_tsv": _with("SELECT * EXCLUDE (cpg_idx) FROM annotation", *_ANN),
    "annotation_summary": _with("SELECT sample_id, annotation, count(*) AS n FROM assay JOIN annotation USING (cpg_idx) JOIN samples USING (sample_idx) GROUP BY 1, 2", *_A5, *_ANN),
    "annotation_report": _with(
        "SELECT sample_id AS sample, count(annotation) AS covered_cpgs, "
        + ", ".join(f"count(*) FILTER (annotation = '{v}') AS \"{k}_count\", CASE WHEN count(annotation) > 0 THEN CAST(count(*) FILTER (annotation = '{v}') AS DOUBLE) * 100.0 / count(annotation) ELSE 0.0 END AS \"{k}_percent\"" for k, v in _REPORT_REGIONS)
        + " FROM samples LEFT JOIN assay USING (sample_idx) LEFT JOIN annotation USING (cpg_idx) GROUP BY sample_id", *_A5, *_ANN),
    "stored_rows": _with("SELECT cpg_idx, chr, chr AS seqnames, start0 + 1 AS start1, end0 AS end1, end0 - start0 AS width, strand, concat(chr, ':', CAST(start0 + 1 AS VARCHAR)) AS site FROM sites"),
    "validate_rowdata": _with(
        " UNION ALL ".join(f"SELECT '{rule}' AS rule, count(*) FILTER ({c}) AS n, min(cpg_idx) FILTER ({c}) AS first_idx FROM r" for rule, c in (
            ("chr_empty", "c = ''"), ("chr_not_seqnames", "c <> chr"), ("start_below_one", "s < 1"), ("end_before_start", "e < s"), ("bad_width", "w <> e - s + 1"), ("bad_strand", "d NOT IN ('+', '-', '*')"))),
        """r AS (SELECT cpg_idx, chr, CASE WHEN cpg_idx % 11 = 0 THEN '' ELSE chr END AS c, CASE WHEN cpg_idx % 13 = 0 THEN 0 ELSE start0 + 1 END AS s,
             CASE WHEN cpg_idx % 23 = 0 THEN -1 ELSE end0 END AS e, CASE WHEN cpg_idx % 17 = 0 THEN 1 ELSE 2 END AS w, CASE WHEN cpg_idx % 19 = 0 THEN '?' ELSE '+' END AS d FROM sites)"""),
    "validate_assay": _with(
        " UNION ALL ".join(f"SELECT '{rule}' AS rule, count(*) FILTER ({c}) AS n, min(cpg_idx) FILTER ({c}) AS first_idx FROM assay" for rule, c in (
            ("uncovered_cell", "cpg_idx % 29 = 0"), ("beta_missing", "cpg_idx % 31 = 0"), ("beta_out_of_range", "cpg_idx % 37 = 0 AND cpg_idx % 31 <> 0"))), *_A5),
    "assay_diff": _with("""
        SELECT reason, count(*) AS n, CAST(sum(cpg_idx) AS BIGINT) AS sites FROM (
          SELECT cpg_idx, CASE WHEN cpg_idx % 53 = 0 AND cpg_idx % 41 = 0 THEN NULL WHEN cpg_idx % 53 = 0 THEN 'right only' WHEN cpg_idx % 41 = 0 THEN 'left only'
                 WHEN cpg_idx % 43 = 0 THEN 'coverage' WHEN cpg_idx % 47 = 0 AND abs(beta - 0.5) > 1e-6 THEN 'beta' END AS reason FROM assay) x
        WHERE reason IS NOT NULL GROUP BY reason""", *_A5),
    "sample_mean_beta": _with("SELECT sample_idx, round(avg(beta), 9) AS mean_beta FROM assay GROUP BY sample_idx", *_A5),
    "sample_mean_cov": _with("SELECT sample_idx, round(CAST(sum(cov) AS DOUBLE) / (SELECT count(*) FROM sites), 9) AS mean_cov FROM assay GROUP BY sample_idx", *_A5),
    "region_subset": _with("SELECT cpg_idx, sample_idx, cov, beta, chr FROM assay JOIN sites USING (cpg_idx) WHERE chr IN ('chr3', 'chr21')", *_A5),
    "high_coverage_sites": _with("SELECT cpg_idx, round(CAST(sum(cov) AS DOUBLE) / 6, 9) AS mean_cov FROM assay GROUP BY cpg_idx HAVING CAST(sum(cov) AS DOUBLE) / 6 > 10.0", *_A5),
    "delta_beta_topk": _with("""
        SELECT a.cpg_idx, a.beta AS beta_first, b.beta AS beta_second, a.beta - b.beta AS delta FROM assay a JOIN assay b USING (cpg_idx)
        WHERE a.sample_idx = 0 AND b.sample_idx = 3 ORDER BY abs(a.beta - b.beta) DESC, cpg_idx LIMIT 100""", *_A5),
    "bedgraph_export": _with("SELECT chr, start0, end0, beta AS value, sample_idx FROM assay JOIN sites USING (cpg_idx)", *_A5),
    "gene_mean_beta": _with("SELECT gene_id, sample_idx, round(avg(beta), 9) AS mean_beta, count(*) AS n_sites FROM assay JOIN annotation USING (cpg_idx) WHERE gene_id <> '' GROUP BY 1, 2", *_A5, *_ANN),
    "dataset_inspect": _with("""
        SELECT (SELECT count(*) FROM sites) AS n_sites, (SELECT count(DISTINCT chr) FROM sites) AS n_contigs, count(*) AS n_cells, count(DISTINCT sample_idx) AS n_samples,
               min(beta) AS min_beta, max(beta) AS max_beta, max(cov) AS max_cov FROM assay""", *_A5),
    "adjacent_sites": _with("""
        SELECT r.sample_id, r.contig_key, r.pos0, coalesce(e.cpg_idx, s.cpg_idx) AS cpg_idx FROM records r
        LEFT JOIN twins e ON e.contig_key = r.contig_key AND e.start0 = r.pos0 LEFT JOIN twins s ON s.contig_key = r.contig_key AND s.start0 = r.pos0 - 1""",
        "twins AS (SELECT cpg_idx, contig_key, start0 FROM sites UNION ALL SELECT cpg_idx + 10000000, contig_key, start0 + 1 FROM sites)"),
    "orphan_contigs": _with("SELECT * FROM annotation", _MODEL.replace("b FROM genes)", "b FROM genes WHERE CAST(contig_key AS INT) <= 11)"), _OVERLAP, _NEAREST, _FULL),
    "gene_fallbacks": _with("SELECT transcript_id, tx_start, tx_end, tss, CAST(n AS INT) AS n_exons, CASE WHEN n >= 4 THEN 1 ELSE 0 END AS n_utr5, 1 AS n_utr3 FROM models WHERE transcript_id NOT LIKE '%7'", _MODEL),
    "empty_intervals": _with("""
        SELECT contig_key, annotation, count(*) AS n FROM (SELECT contig_key, annotation, unnest(range(start0 >> 16, ((end0 - 1) >> 16) + 1)) AS bin
          FROM parts JOIN models USING (transcript_id) WHERE end0 > start0 AND priority NOT IN (1, 6)) x GROUP BY 1, 2""", _MODEL),
    "line_boundaries": "SELECT l_linenumber, CASE l_linenumber WHEN 2 THEN 'percent_match' WHEN 4 THEN 'fields' WHEN 5 THEN 'percent_range' WHEN 7 THEN 'overflow' ELSE 'sound' END AS rule, count(*) AS n FROM lineitem GROUP BY 1, 2",
    "thousands_shown": "SELECT p_partkey, format('{:,}', p_partkey * 12345 - 5000000) AS shown FROM part",
    "tsv_escapes": _with("SELECT concat(transcript_id, ' ', gene_id, '  ', strand) AS field FROM genes"),
    "coverage_filter_edges": _with(
        "SELECT cpg_idx, true AS kept, 0 AS threshold, 3 AS need FROM sites UNION ALL SELECT cpg_idx, false, 0, 7 FROM sites UNION ALL SELECT s.cpg_idx, count(cov) >= 6, 1, 6 FROM sites s LEFT JOIN assay a ON a.cpg_idx = s.cpg_idx GROUP BY s.cpg_idx"
        " UNION ALL SELECT s.cpg_idx, count(*) FILTER (cov >= 4) >= 1, 4, 1 FROM sites s LEFT JOIN assay a ON a.cpg_idx = s.cpg_idx GROUP BY s.cpg_idx", _ALIGNED, _assay("assay", 1)),
    "validate_dense": _with(
        " UNION ALL ".join(f"SELECT '{rule}' AS rule, count(*) FILTER ({c}) AS n, min(cpg_idx) FILTER ({c}) AS first_idx FROM spoilt" for rule, c in (
            ("beta_without_coverage", "cov = 0 AND beta IS NOT NULL"), ("coverage_without_beta", "cov > 0 AND beta IS NULL"), ("beta_out_of_range", "beta < 0"))),
        *_A5, """spoilt AS (SELECT s.cpg_idx, coalesce(cov, 0) AS cov, CASE WHEN s.cpg_idx % 31 = 0 THEN 0.5 WHEN s.cpg_idx % 37 = 0 THEN NULL WHEN s.cpg_idx % 41 = 0 THEN -0.25 ELSE beta END AS beta
             FROM sites s CROSS JOIN samples p LEFT JOIN assay a ON a.cpg_idx = s.cpg_idx AND a.sample_idx = p.sample_idx)"""),
    "report_percent": _with("SELECT sample_id, CAST(count(cpg_idx) AS DOUBLE) * 100.0 / count(*) AS matched_percent FROM aligned GROUP BY sample_id", _ALIGNED),
}

QUERIES |= file_queries.QUERIES
ORACLES |= file_queries.oracles(_with, _A5, _ANN, _STATS)
