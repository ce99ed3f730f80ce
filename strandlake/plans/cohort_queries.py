"""Queries on whole cohorts: groups of samples, regions, variants, several runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import MethylationSet
from ..operators import differential as di
from ..operators import intervals as iv
from ..operators import similarity as si
from ..operators.merge import merge_sets
from ..operators.summary import coverage_cube as cube_of
from ..sources import intervals as so
from .catalogue import _A5, _ANN, Run, _with
from .projection import Projection

#: Samples by their place in the order of names: the first group and the second.
FIRST, SECOND = (0, 1), (2, 3, 4, 5)
MIN_DELTA, MAX_GAP = 0.02, 3000

BED_LINES = """
SELECT s_suppkey, CASE
         WHEN s_suppkey % 11 = 1 THEN concat('# ', chr(9), c)
         WHEN s_suppkey % 11 = 2 THEN 'track name=made'
         WHEN s_suppkey % 11 = 3 THEN concat(c, chr(9), '12')
         WHEN s_suppkey % 11 = 4 THEN concat(c, chr(9), CAST(b + 9 AS STRING), chr(9), CAST(b AS STRING))
         WHEN s_suppkey % 11 = 5 THEN concat(c, ' ', CAST(b AS STRING), '  ', CAST(b + w AS STRING))
         ELSE concat(c, chr(9), CAST(b AS STRING), chr(9), CAST(b + w AS STRING), chr(9), 'r', CAST(s_suppkey AS STRING)) END AS value
FROM (SELECT s_suppkey, concat(CASE WHEN s_nationkey % 3 = 0 THEN '' WHEN s_nationkey % 3 = 1 THEN 'chr' ELSE 'CHR' END, CAST(s_suppkey % 22 + 1 AS STRING)) AS c,
             CAST((s_suppkey - s_suppkey % 22) / 22 AS BIGINT) * 2000 + s_nationkey * 100 AS b, CAST(s_nationkey AS BIGINT) * 400 AS w FROM supplier) x
"""

VCF_LINES = """
SELECT p_partkey, CASE
         WHEN p_partkey % 31 = 1 THEN '#CHROM and so on'
         WHEN p_partkey % 31 = 2 THEN concat(c, chr(9), CAST(pos AS STRING), chr(9), '.', chr(9), 'X', chr(9), 'A')
         WHEN p_partkey % 31 = 3 THEN concat(c, chr(9), '0', chr(9), '.', chr(9), 'A', chr(9), 'G')
         WHEN p_partkey % 31 = 4 THEN concat(c, chr(9), CAST(pos AS STRING))
         ELSE concat(c, chr(9), CAST(pos AS STRING), chr(9), 'rs', CAST(p_partkey AS STRING), chr(9), ref, chr(9), CASE WHEN p_size % 5 = 0 THEN 'a,T' ELSE 'G' END, chr(9), '.') END AS value
FROM (SELECT p_partkey, p_size, concat(CASE WHEN p_size % 2 = 0 THEN 'chr' ELSE '' END, CAST(p_partkey % 22 + 1 AS STRING)) AS c,
             CAST((p_partkey - p_partkey % 22) / 22 AS BIGINT) * 1000 + p_size * 4 + p_partkey % 7 - 2 AS pos, substr('ACGT', 1, CAST(p_size % 4 + 1 AS INT)) AS ref
      FROM part WHERE p_partkey % 3 = 0) x
"""


def _bed(p: Projection) -> DataFrame:
    return so.parse_bed(p.sql(BED_LINES))


def _vcf(p: Projection) -> DataFrame:
    return so.parse_vcf(p.sql(VCF_LINES))


def _groups(p: Projection) -> DataFrame:
    samples = p.samples().select("sample_idx")
    return samples.select("sample_idx", F.when(F.col("sample_idx").isin(*FIRST), 1).when(F.col("sample_idx").isin(*SECOND), 2).alias("grp")).where("grp IS NOT NULL")


def differential_sites(spark, sf_dir):
    run = Run(spark, sf_dir)
    return di.site_differences(run.assay(), _groups(run.p))


def differential_regions(spark, sf_dir):
    run = Run(spark, sf_dir)
    found = di.differential_regions(run.p.sites(), di.site_differences(run.assay(), _groups(run.p)), MIN_DELTA, MAX_GAP, 2)
    return found.withColumnsRenamed({"start": "start0", "end": "end0"})


def bed_parse(spark, sf_dir):
    rows = _bed(Projection(spark, sf_dir))
    return rows.groupBy(F.coalesce("problem", F.lit("sound")).alias("kind")).agg(F.count("*").alias("n"), F.sum("start").alias("starts"), F.count("name").alias("named"))


def vcf_parse(spark, sf_dir):
    rows = _vcf(Projection(spark, sf_dir))
    return rows.groupBy(F.coalesce("problem", F.lit("sound")).alias("kind")).agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("bases"), F.count_if(F.col("alt") == "A,T").alias("two_alts"))


def regions_merged(spark, sf_dir):
    return iv.merged(_bed(Projection(spark, sf_dir)).where("problem IS NULL")).withColumnsRenamed({"start": "start0", "end": "end0"})


def region_sites(spark, sf_dir):
    p = Projection(spark, sf_dir)
    return iv.sites_in_regions(p.sites(), _bed(p).where("problem IS NULL")).select("cpg_idx", "contig_key", F.col("start").alias("start0"))


def variant_mask(spark, sf_dir):
    """Sites that no variant touches, and those that no exchange of one base
    touches."""
    p = Projection(spark, sf_dir)
    variants = _vcf(p).where("problem IS NULL")
    parts = [iv.mask_variants(p.sites(), variants, single).select("cpg_idx", F.lit(single).alias("single_base")) for single in (False, True)]
    return parts[0].unionByName(parts[1])


def sample_gram(spark, sf_dir):
    return si.pair_measures(si.gram(Run(spark, sf_dir).assay(), 6))


def sample_components(spark, sf_dir):
    run = Run(spark, sf_dir)
    n = run.p.samples().count()
    at, share = si.principal_components(si.pair_measures(si.gram(run.assay(), n)), n)
    rows = [(i, *map(float, row), *map(float, share)) for i, row in enumerate(at)]
    return spark.createDataFrame(rows, "sample_idx int, pc1 double, pc2 double, share1 double, share2 double")


def sample_clusters(spark, sf_dir):
    run = Run(spark, sf_dir)
    n = run.p.samples().count()
    merges = si.sample_clusters(si.pair_measures(si.gram(run.assay(), n)), n)
    return spark.createDataFrame([(i, *m) for i, m in enumerate(merges)], "step int, a int, b int, height double, size int")


def _two_runs(run: Run) -> MethylationSet:
    """The projection as two runs: other sites, samples, numbers and names."""
    cells, sites, samples = run.assay(), run.p.sites(), run.p.samples()
    later = lambda c: F.col(c) - 3
    first = MethylationSet(sites.where("cpg_idx % 3 <> 0"), samples.where("sample_idx < 3"), cells.where("sample_idx < 3 AND cpg_idx % 3 <> 0"), "made", 1)
    moved = sites.where("cpg_idx % 3 <> 1").withColumns({"cpg_idx": F.col("cpg_idx") + 7, "chr": F.col("contig_key")})
    second = MethylationSet(moved, samples.where("sample_idx >= 3").withColumn("sample_idx", later("sample_idx")), cells.where("sample_idx >= 3 AND cpg_idx % 3 <> 1").withColumns({"cpg_idx": F.col("cpg_idx") + 7, "sample_idx": later("sample_idx")}), "made", 2)
    return merge_sets([first, second])


def merged_sites(spark, sf_dir):
    return _two_runs(Run(spark, sf_dir)).row_data.withColumnsRenamed({"start": "start0", "end": "end0"})


def merged_cells(spark, sf_dir):
    both = _two_runs(Run(spark, sf_dir))
    return both.assay.join(both.col_data.select("sample_idx", "sample_id"), "sample_idx").select("sample_id", "cpg_idx", "cov", F.col("beta").cast("double").alias("beta"))


def coverage_cube(spark, sf_dir):
    run = Run(spark, sf_dir)
    return cube_of(run.assay(), run.p.sites(), run.annotation(), run.p.samples())


QUERIES = {f.__name__: f for f in (differential_sites, differential_regions, bed_parse, vcf_parse, regions_merged, region_sites, variant_mask, sample_gram, sample_components, sample_clusters, merged_sites, merged_cells, coverage_cube)}

SITE_DIFFERENCES = f"""
grp AS (SELECT *, CASE WHEN sample_idx IN {FIRST} THEN 1 ELSE 2 END AS g FROM assay WHERE sample_idx IN {FIRST + SECOND}),
pooled AS (
  SELECT cpg_idx, count(*) FILTER (g = 1) AS n_first, count(*) FILTER (g = 2) AS n_second, avg(beta) FILTER (g = 1) AS m1, avg(beta) FILTER (g = 2) AS m2,
         sqrt(var_samp(beta) FILTER (g = 1) / count(*) FILTER (g = 1) + var_samp(beta) FILTER (g = 2) / count(*) FILTER (g = 2)) AS error
  FROM (SELECT cpg_idx, g, CAST(beta AS DOUBLE) AS beta FROM grp) x GROUP BY cpg_idx HAVING count(*) FILTER (g = 1) > 0 AND count(*) FILTER (g = 2) > 0),
differences AS (SELECT cpg_idx, n_first, n_second, round(m1, 9) AS mean_first, round(m2, 9) AS mean_second, round(m2 - m1, 9) AS delta,
                       CASE WHEN n_first > 1 AND n_second > 1 AND error > 1e-6 THEN round((m2 - m1) / error, 6) END AS t FROM pooled)"""

DIFFERENTIAL_REGIONS = f"""
strong AS (SELECT *, CASE WHEN delta < 0 THEN -1 ELSE 1 END AS direction FROM differences JOIN sites USING (cpg_idx) WHERE abs(delta) >= {MIN_DELTA}),
cut AS (SELECT *, CASE WHEN lag(direction) OVER w = direction AND start0 - lag(start0) OVER w <= {MAX_GAP} THEN 0 ELSE 1 END AS fresh FROM strong WINDOW w AS (PARTITION BY contig_key ORDER BY start0)),
run AS (SELECT *, sum(fresh) OVER (PARTITION BY contig_key ORDER BY start0) AS run FROM cut),
regions AS (
  SELECT contig_key, min(start0) AS start0, max(end0) AS end0, CAST(any_value(direction) AS INT) AS direction, min_by(cpg_idx, start0) AS first_idx, count(*) AS n_sites, round(sum(delta) / count(*), 6) AS mean_delta
  FROM run GROUP BY contig_key, run HAVING count(*) >= 2)"""

_BED = f"""
bed AS (
  SELECT upper(CASE WHEN f[1] LIKE 'chr%' OR f[1] LIKE 'CHR%' THEN substr(f[1], 4) ELSE f[1] END) AS contig_key, TRY_CAST(f[2] AS BIGINT) AS start0, TRY_CAST(f[3] AS BIGINT) AS end0, f[4] AS name, len(f) AS n
  FROM (SELECT regexp_split_to_array(value, '[\\t ]+') AS f FROM ({BED_LINES}) l WHERE NOT regexp_matches(value, '^(#|track)')) x),
sound_bed AS (SELECT * FROM bed WHERE n >= 3 AND end0 >= start0),
merged AS (
  SELECT contig_key, min(start0) AS start0, max(end0) AS end0, count(*) AS n_merged FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY contig_key ORDER BY start0, end0 ROWS UNBOUNDED PRECEDING) AS run FROM (
      SELECT *, CASE WHEN start0 <= max(end0) OVER (PARTITION BY contig_key ORDER BY start0, end0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
      FROM sound_bed WHERE end0 > start0) y) z GROUP BY contig_key, run)"""

_VCF = f"""
vcf AS (
  SELECT CASE WHEN f[1] LIKE 'chr%' THEN substr(f[1], 4) ELSE f[1] END AS contig_key, TRY_CAST(f[2] AS BIGINT) - 1 AS start0, upper(f[4]) AS ref, upper(f[5]) AS alt, len(f) AS n
  FROM (SELECT string_split(value, chr(9)) AS f FROM ({VCF_LINES}) l WHERE value NOT LIKE '#%') x),
sound_vcf AS (SELECT *, start0 + length(ref) AS end0 FROM vcf WHERE n >= 5 AND start0 >= 0 AND regexp_full_match(ref, '[ACGTN]+'))"""

_MASK = "SELECT cpg_idx, {single} AS single_base FROM sites s WHERE NOT EXISTS (SELECT 1 FROM sound_vcf v WHERE v.contig_key = s.contig_key AND v.start0 < s.end0 AND v.end0 > s.start0 AND {fits})"

_MERGED = "merged_sites AS (SELECT row_number() OVER (ORDER BY contig_key, start0) - 1 AS new_idx, * FROM sites)"

ORACLES = {
    "differential_sites": _with("SELECT * FROM differences", *_A5, SITE_DIFFERENCES),
    "differential_regions": _with("SELECT * FROM regions", *_A5, SITE_DIFFERENCES, DIFFERENTIAL_REGIONS),
    "bed_parse": _with("""
        SELECT CASE WHEN n < 3 THEN 'a region needs 3 fields' WHEN start0 IS NULL OR end0 IS NULL OR start0 < 0 OR end0 < start0 THEN 'start and end are not an interval' ELSE 'sound' END AS kind,
               count(*) AS n, CAST(sum(start0) AS BIGINT) AS starts, count(name) AS named FROM bed GROUP BY 1""", _BED),
    "vcf_parse": _with("""
        SELECT CASE WHEN n < 5 THEN 'a variant needs 5 fields' WHEN start0 IS NULL OR start0 < 0 THEN 'position is not a positive number' WHEN NOT regexp_full_match(ref, '[ACGTN]+') THEN 'reference bases are not ACGTN' ELSE 'sound' END AS kind,
               count(*) AS n, CAST(sum(length(ref)) AS BIGINT) AS bases, count(*) FILTER (alt = 'A,T') AS two_alts FROM vcf GROUP BY 1""", _VCF),
    "regions_merged": _with("SELECT * FROM merged", _BED),
    "region_sites": _with("SELECT cpg_idx, contig_key, start0 FROM sites s WHERE EXISTS (SELECT 1 FROM sound_bed b WHERE b.contig_key = s.contig_key AND s.start0 >= b.start0 AND s.start0 < b.end0)", _BED),
    "variant_mask": _with(_MASK.format(single="false", fits="true") + " UNION ALL " + _MASK.format(single="true", fits="length(ref) = 1 AND regexp_full_match(alt, '[ACGT](,[ACGT])*')"), _VCF),
    "sample_gram": _with("""
        SELECT CAST(a.sample_idx AS BIGINT) AS i, CAST(b.sample_idx AS BIGINT) AS j, count(*) AS n, round(sum(CAST(a.beta AS DOUBLE) * b.beta) / count(*) - avg(CAST(a.beta AS DOUBLE)) * avg(CAST(b.beta AS DOUBLE)), 9) AS covariance,
               round(sqrt(sum((CAST(a.beta AS DOUBLE) - b.beta) * (CAST(a.beta AS DOUBLE) - b.beta)) / count(*)), 6) AS distance
        FROM assay a JOIN assay b ON a.cpg_idx = b.cpg_idx AND a.sample_idx <= b.sample_idx GROUP BY 1, 2""", *_A5),
    "merged_sites": _with("SELECT new_idx AS cpg_idx, CASE WHEN cpg_idx % 3 = 0 THEN contig_key ELSE chr END AS chr, contig_key, start0, end0, strand FROM merged_sites", _MERGED),
    "merged_cells": _with("""
        SELECT sample_id, new_idx AS cpg_idx, cov, beta FROM assay JOIN merged_sites USING (cpg_idx) JOIN samples USING (sample_idx)
        WHERE (sample_idx < 3 AND cpg_idx % 3 <> 0) OR (sample_idx >= 3 AND cpg_idx % 3 <> 1)""", *_A5, _MERGED),
    "coverage_cube": _with("""
        SELECT sample_id, contig_key, region, CAST(GROUPING(sample_id, contig_key, region) AS INT) AS level, count(*) AS n_cells, CAST(sum(cov) AS BIGINT) AS reads
        FROM (SELECT sample_id, contig_key, nullif(annotation, 'Intergenic') AS region, cov FROM assay JOIN sites USING (cpg_idx) JOIN annotation USING (cpg_idx) JOIN samples USING (sample_idx)) x
        GROUP BY CUBE (sample_id, contig_key, region)""", *_A5, *_ANN),
}
