"""Methylation tables made of the star schema, for queries and their oracle.

The texts below are plain SQL that both engines read alike; identifiers avoid
reserved words. Samples are numbered by name.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SITES = """
SELECT p_partkey AS cpg_idx, concat('chr', CAST(p_partkey % 22 + 1 AS STRING)) AS chr,
       CAST(p_partkey % 22 + 1 AS STRING) AS contig_key,
       CAST((p_partkey - p_partkey % 22) / 22 AS BIGINT) * 1000 + p_size * 4 AS start0,
       CAST((p_partkey - p_partkey % 22) / 22 AS BIGINT) * 1000 + p_size * 4 + 2 AS end0, '+' AS strand
FROM part
"""

OBSERVATIONS = """
SELECT concat(l_returnflag, '_', l_linestatus) AS sample_id, CAST(l_partkey % 22 + 1 AS STRING) AS contig_key,
       CASE WHEN l_linenumber % 3 = 0 THEN concat('chr', CAST(l_partkey % 22 + 1 AS STRING))
            WHEN l_linenumber % 3 = 1 THEN CAST(l_partkey % 22 + 1 AS STRING)
            ELSE concat('CHR', CAST(l_partkey % 22 + 1 AS STRING)) END AS shown,
       CAST((p_partkey - p_partkey % 22) / 22 AS BIGINT) * 1000 + p_size * 4 + l_linenumber % 2
         + CASE WHEN l_suppkey % 10 = 0 THEN 500 ELSE 0 END AS pos0,
       CAST(l_quantity AS BIGINT) AS m, CAST(l_suppkey % 7 AS BIGINT) AS u, l_linenumber, l_suppkey, l_orderkey
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_suppkey % 3 = 0
"""

RECORDS = """
SELECT sample_id, contig_key, pos0, CAST(sum(m) AS BIGINT) AS m, CAST(sum(u) AS BIGINT) AS u
FROM observations GROUP BY sample_id, contig_key, pos0
"""

SAMPLES = """
SELECT sample_id, CAST(row_number() OVER (ORDER BY sample_id) - 1 AS INT) AS sample_idx
FROM (SELECT DISTINCT sample_id FROM observations) s
"""

GENES = """
SELECT concat('tx', CAST(s_suppkey AS STRING)) AS transcript_id, concat('g', CAST(s_suppkey AS STRING)) AS gene_id,
       CAST(s_suppkey % 22 + 1 AS STRING) AS contig_key, CASE WHEN s_nationkey % 2 = 0 THEN '-' ELSE '+' END AS strand,
       CAST((s_suppkey - s_suppkey % 22) / 22 AS BIGINT) * 20000 + 2000 AS b, CAST(s_nationkey % 5 + 1 AS BIGINT) AS n
FROM supplier
"""

GTF_ROWS = """
SELECT contig_key, transcript_id, gene_id, strand, 'transcript' AS feature, b AS start0, b + (n - 1) * 2500 + 600 AS end0, CAST(0 AS BIGINT) AS line_no FROM genes
UNION ALL
SELECT contig_key, transcript_id, gene_id, strand, 'exon', b + (i - 1) * 2500, b + (i - 1) * 2500 + 600, 10 - i
FROM genes JOIN (SELECT DISTINCT CAST(l_linenumber AS BIGINT) AS i FROM lineitem) k ON i <= n
UNION ALL
SELECT contig_key, transcript_id, gene_id, strand, 'five_prime_utr', CASE WHEN strand = '-' THEN b + (n - 3) * 2500 ELSE b + 5000 END,
       CASE WHEN strand = '-' THEN b + (n - 3) * 2500 ELSE b + 5000 END + 150, CAST(20 AS BIGINT)
FROM genes WHERE n >= 4
UNION ALL
SELECT contig_key, transcript_id, gene_id, strand, 'three_prime_utr', CASE WHEN strand = '-' THEN b ELSE b + (n - 1) * 2500 + 400 END,
       CASE WHEN strand = '-' THEN b ELSE b + (n - 1) * 2500 + 400 END + 200, CAST(21 AS BIGINT)
FROM genes
"""

SEQUENCES = """
SELECT doc_id AS contig_idx, concat('chr', CAST(doc_id % 30 AS STRING)) AS contig,
       translate(md5(CAST(concat(CAST(doc_id AS STRING), '-', CAST(k AS STRING)) AS STRING)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq
FROM (SELECT DISTINCT doc_id FROM documents) d CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) kk
"""

#: Lines of a coverage file, a few broken in each of the ways that count.
LINES = """
SELECT l_orderkey, l_linenumber, l_suppkey, CASE
         WHEN l_suppkey % 13 = 1 THEN concat(a, chr(9), p, chr(9), p, chr(9), pct, chr(9), m)
         WHEN l_suppkey % 13 = 2 THEN concat(' ', chr(9), p, chr(9), p, chr(9), pct, chr(9), m, chr(9), u)
         WHEN l_suppkey % 13 = 3 THEN concat(a, chr(9), p, chr(9), p, chr(9), pct, chr(9), 'x', chr(9), u)
         WHEN l_suppkey % 13 = 4 THEN concat(a, chr(9), '0', chr(9), '0', chr(9), pct, chr(9), m, chr(9), u)
         WHEN l_suppkey % 13 = 5 THEN concat(a, chr(9), p, chr(9), CAST(CAST(p AS BIGINT) + 1 AS STRING), chr(9), pct, chr(9), m, chr(9), u)
         WHEN l_suppkey % 13 = 6 THEN concat(a, chr(9), p, chr(9), p, chr(9), '150.0', chr(9), m, chr(9), u)
         WHEN l_suppkey % 13 = 7 THEN concat(a, chr(9), p, chr(9), p, chr(9), '50', chr(9), '4294967295', chr(9), '1')
         WHEN l_suppkey % 13 = 8 THEN concat(a, chr(9), p, chr(9), p, chr(9), '90.5', chr(9), m, chr(9), u)
         ELSE concat(a, chr(9), p, chr(9), p, chr(9), pct, chr(9), m, chr(9), u) END AS value
FROM (SELECT l_orderkey, l_linenumber, l_suppkey, concat('chr', CAST(l_partkey % 22 + 1 AS STRING)) AS a, CAST(l_partkey + 1 AS STRING) AS p,
             CASE WHEN l_linenumber % 2 = 0 THEN '100.0' ELSE '50' END AS pct, CAST(CAST(l_quantity AS BIGINT) AS STRING) AS m,
             CASE WHEN l_linenumber % 2 = 0 THEN '0' ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS u FROM lineitem) x
"""

#: Lines at the bounds of the rules: tolerance, largest position and sums.
BOUNDARIES = """
SELECT l_orderkey, l_linenumber, CASE l_linenumber
         WHEN 1 THEN concat('chr1', chr(9), '5', chr(9), '5', chr(9), '50.0099', chr(9), '1', chr(9), '1')
         WHEN 2 THEN concat('chr1', chr(9), '5', chr(9), '5', chr(9), '50.0101', chr(9), '1', chr(9), '1')
         WHEN 3 THEN concat('chr1', chr(9), '4294967295', chr(9), '4294967295', chr(9), '100', chr(9), '4294967295', chr(9), '0')
         WHEN 4 THEN concat('chr1', chr(9), '4294967296', chr(9), '4294967296', chr(9), '100', chr(9), '1', chr(9), '0')
         WHEN 5 THEN concat('chr1', chr(9), '5', chr(9), '5', chr(9), '100.0001', chr(9), '1', chr(9), '0')
         WHEN 6 THEN concat('chr1', chr(9), '1', chr(9), '1', chr(9), '0.0', chr(9), '0', chr(9), '0')
         ELSE concat('chr1', chr(9), '5', chr(9), '5', chr(9), '99', chr(9), '4294967294', chr(9), '2') END AS value
FROM lineitem
"""

#: Lines of a gene model; some break a rule and are to be skipped.
GTF_LINES = """
SELECT s_suppkey AS line_no, CASE
         WHEN s_suppkey % 7 = 1 THEN concat('# ', lead, tail)
         WHEN s_suppkey % 7 = 2 THEN concat(lead, chr(9), 'gene_id "short"')
         WHEN s_suppkey % 7 = 3 THEN concat(head, '500', chr(9), '400', tail, full_attrs)
         WHEN s_suppkey % 7 = 4 THEN concat(lead, tail, 'gene_id "', gene_id, '"; note "x";')
         WHEN s_suppkey % 7 = 5 THEN concat(lead, tail, 'gene_id "', gene_id, '"; transcript_id "";')
         ELSE concat(lead, tail, full_attrs) END AS value
FROM (SELECT s_suppkey, concat('g', CAST(s_suppkey AS STRING)) AS gene_id,
             concat('chr', CAST(s_suppkey % 22 + 1 AS STRING), chr(9), 'src', chr(9), 'Exon', chr(9)) AS head,
             concat('chr', CAST(s_suppkey % 22 + 1 AS STRING), chr(9), 'src', chr(9), 'Exon', chr(9), CAST(s_suppkey * 10 + 1 AS STRING), chr(9), CAST(s_suppkey * 10 + 100 AS STRING)) AS lead,
             concat(chr(9), '.', chr(9), CASE WHEN s_nationkey % 2 = 0 THEN '-' ELSE '+' END, chr(9), '.', chr(9)) AS tail,
             concat('gene_id "old"; transcript_id "tx', CAST(s_suppkey AS STRING), '" ; gene_name "N ', CAST(s_suppkey AS STRING), '"; gene_id "g', CAST(s_suppkey AS STRING), '";') AS full_attrs
      FROM supplier) x
"""

TABLES = ("part", "lineitem", "supplier", "documents")


class Projection:
    """The projected tables of one input folder, as frames of the engine."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.raw = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}

    def sql(self, text: str, **tables: DataFrame) -> DataFrame:
        names = self.raw | tables
        used = {}
        for name, table in names.items():
            text, n = re.subn(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", text)
            if n:
                used[name] = table
        return self.spark.sql(text, **used)

    def sites(self) -> DataFrame:
        return self.sql(SITES).select("cpg_idx", "chr", "contig_key", F.col("start0").alias("start"), F.col("end0").alias("end"), "strand")

    def observations(self) -> DataFrame:
        return self.sql(OBSERVATIONS)

    def samples(self) -> DataFrame:
        return self.samples_of(self.observations())

    def samples_of(self, observations: DataFrame) -> DataFrame:
        """The same of a table that has them all, as ``records`` does."""
        return self.sql(SAMPLES, observations=observations).withColumn("sample_name", F.col("sample_id"))

    def records(self) -> DataFrame:
        """Pre-aggregated: the engine rejects repeated positions. Few repeat, so
        observations are shuffled as they are, not summed before it as well."""
        found = self.sql(RECORDS, observations=self.observations().repartition("contig_key", "pos0"))
        return found.select("sample_id", F.concat(F.lit("chr"), "contig_key").alias("chr"), "contig_key", F.col("pos0").alias("start"), F.col("m").alias("methylated"), F.col("u").alias("unmethylated"))

    def genes(self) -> DataFrame:
        return self.sql(GENES)

    def sql_gtf_rows(self) -> DataFrame:
        return self.sql(GTF_ROWS, genes=self.genes())

    def gtf_rows(self) -> DataFrame:
        rows = self.sql_gtf_rows()
        return rows.select(F.concat(F.lit("chr"), "contig_key").alias("seqname"), "feature", F.col("start0").alias("start"), F.col("end0").alias("end"), "strand", "transcript_id", "gene_id", F.upper("gene_id").alias("gene_symbol"), "line_no")

    def sequences(self) -> DataFrame:
        return self.sql(SEQUENCES)

    def gtf_lines(self) -> DataFrame:
        return self.sql(GTF_LINES)

    def lines(self) -> DataFrame:
        return self.sql(LINES)


def oracle_views() -> str:
    """The projected tables as SQL common table expressions."""
    parts = {"sites": SITES, "observations": OBSERVATIONS, "records": RECORDS, "samples": SAMPLES, "genes": GENES, "gtf_rows": GTF_ROWS}
    return ",\n".join(f"{k} AS ({v.strip()})" for k, v in parts.items())
