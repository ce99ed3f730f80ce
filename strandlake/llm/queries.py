"""The registered query of each operator: its digest over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import fit, judge, labelled_urls

    return judge(_table(spark, sf_dir, "pages"), fit(labelled_urls(spark)))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import fit, labelled_findings, scan

    return scan(_table(spark, sf_dir, "documents"), fit(labelled_findings(spark)))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    rows = near_duplicates(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .binary import fresh_path, read_tokens, write_tokens

    path = fresh_path(spark, "token-files")
    return read_tokens(write_tokens(_table(spark, sf_dir, "documents"), path), path, with_ids=False)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import ROW, with_row_id
    from .decontaminate import digest, search

    docs = with_row_id(_table(spark, sf_dir, "documents")).select(ROW, "doc_id", "text")
    return digest(search(docs, _table(spark, sf_dir, "benchmark")).join(docs.select(ROW, "doc_id"), ROW))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import materialize
    from .sharding import shard

    docs = _table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    digest = docs.select("doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.xxhash64("text").alias("text_hash"))
    placed = shard(materialize(digest, "sizes"), 24, group="text_hash", size=F.col("size"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import fresh_path
    from .warc import read_warc, write_warc

    path = fresh_path(spark, "warc")
    return read_warc(write_warc(_table(spark, sf_dir, "pages"), path)).drop("url")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import fit, score

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(docs)).withColumnRenamed("good", "keep")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"), with_ids=False).drop("bucket")


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embeddings import link_embeddings

    return link_embeddings(_table(spark, sf_dir, "embeddings"))


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .codes import code_digest

    return code_digest(_table(spark, sf_dir, "embeddings"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_digest

    return mix_digest(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_secrets, op3_simhash, op4_sharding, op5_warc, op6_quality, op7_packing, op8_tokens, op9_decontaminate, op10_embeddings, op11_codes, op12_mixing)}
