"""An inventory of sequence texts that grows with its input.

Before a new reference is used, its records are looked through: how many bases
they have, how many CpG sites, and whether they are as dense in them as a CpG
island. Each row of the source table is a record whose text is a sequence, as in
a FASTA file: white space doesn't count, case doesn't either, U is T.

The source is read as a stream of files: the checkpoint knows which ones were
taken, a run takes all that are new and ends. Batch N goes to ``records/batch=N``
and replaces what an earlier attempt left there, so a run that was broken off
can be repeated. ``totals/``, by group, is made anew from all records.

    spark-submit jobs/sequence_inventory.py --source S --output O --checkpoint C [--config F]
"""

from __future__ import annotations

import logging
import os
import re
import sys
from urllib.parse import unquote

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import command_line
from strandlake.functions.columns import sequence_of
from strandlake.sources.fasta import composition

JOB = "sequence_inventory"
log = logging.getLogger(JOB)

COUNTS = ("n_bases", "n_c", "n_g", "n_cpg", "n_other")


def inventory(texts: DataFrame, config: dict) -> DataFrame:
    """One row per record: ``record_id, grp``, the counts, ``cpg_ratio``
    (observed to expected sites) and ``island``. A null text has no bases."""
    named = texts.select(F.col(config["id"]).cast("long").alias("record_id"), F.col(config["group"]).cast("string").alias("grp"), sequence_of(F.col(config["text"])).alias("seq"))
    counted = composition(named)
    ratio = F.when(F.col("n_c") * F.col("n_g") > 0, F.round(F.col("n_cpg") * F.col("n_bases") / (F.col("n_c") * F.col("n_g")), 6))
    dense = (F.col("n_c") + F.col("n_g") >= F.lit(config["island_gc"]) * F.col("n_bases")) & (F.col("cpg_ratio") >= config["island_ratio"])
    return counted.drop("seq").withColumn("cpg_ratio", ratio).withColumn("island", F.coalesce(dense & (F.col("n_bases") > 0), F.lit(False)))


def arriving(spark: SparkSession, source: str, files_per_batch: int) -> DataFrame:
    """``source`` as a stream of files. A stream reads folders, so a path that
    is one file is the folder it lies in, and its name a filter."""
    given = spark.read.parquet(source)
    files = given.inputFiles()
    folder, _, name = source.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(given.schema).option("maxFilesPerTrigger", files_per_batch)
    if len(files) == 1 and unquote(files[0]).endswith(f"/{name}"):
        return reader.option("pathGlobFilter", re.sub(r"([*?{}\[\]\\])", r"\\\1", name)).parquet(folder or "/")
    return reader.parquet(source)


def run(spark: SparkSession, source: str, output: str, checkpoint: str, config: dict) -> DataFrame:
    """Take in what is new in ``source``; returns all records, read back."""
    stream = arriving(spark, source, config["files_per_batch"])
    empty = inventory(spark.createDataFrame([], stream.schema), config).withColumn("batch", F.lit(0).cast("long"))
    records = f"{output.rstrip('/')}/records"
    empty.write.mode("append").partitionBy("batch").parquet(records)  # the folder is there even if nothing ever comes

    def take(batch: DataFrame, number: int) -> None:
        rows = inventory(batch, config).withColumn("batch", F.lit(number).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(records)
        written = spark.read.schema(rows.schema).parquet(records).where(F.col("batch") == number).count()
        log.info("batch %d: wrote %d records to %s", number, written, records)

    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("read %s: %d new rows", source, sum(p["numInputRows"] for p in query.recentProgress))
    back = spark.read.schema(empty.schema).parquet(records)
    totals = back.groupBy("grp").agg(F.count("*").alias("n_records"), *[F.sum(c).alias(c) for c in COUNTS], F.count_if("island").alias("n_islands"))
    totals.write.mode("overwrite").parquet(f"{output.rstrip('/')}/totals")
    log.info("wrote %s/totals: %d groups, %d records in all", output, totals.count(), back.count())
    return back


if __name__ == "__main__":
    command_line(JOB, __doc__, {"source": "Parquet file or folder with a text column", "output": "folder to write to", "checkpoint": "folder of the stream's state"}, run)
