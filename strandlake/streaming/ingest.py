"""Incremental ingestion: new coverage files join a growing assay table.

A file is the unit: there is no event time, and a sample's records all come
from one file. Each micro-batch parses, validates, aligns and appends what
arrived; the batch number is part of the path, so a batch that runs again
replaces its own output. A list of samples lies beside the output; a sample
that arrives a second time, in whatever file, is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contracts import CoverageError
from ..operators.align import align, check_matches
from ..operators.assay import build_assay
from ..sinks.files import exists
from ..sources.coverage import duplicates, parse_lines, records

_SUFFIX = r"(\.bismark)?\.cov(\.gz)?$"


def ingest(spark: SparkSession, directory: str, sites: DataFrame, output: str, checkpoint: str, min_coverage: int = 1, once: bool = True) -> StreamingQuery:
    """Stream ``directory`` into ``output/batch=N`` (sample_id, cpg_idx, cov,
    beta). With ``once`` the query ends when all present files are done."""
    name = F.element_at(F.split(F.col("_metadata.file_name"), "/"), -1)
    lines = spark.readStream.schema("value string").text(directory).select("value", name.alias("file"), F.regexp_replace(name, _SUFFIX, "").alias("sample_id"))
    ledger = f"{output.rstrip('/')}-samples"

    def arrived(batch: DataFrame, number: int) -> list[str]:
        """The batch's samples, one row per file, none of which came before."""
        files = batch.select("sample_id", "file").distinct()
        if twice := files.groupBy("sample_id").agg(F.count("*").alias("n"), F.min("file").alias("a"), F.max("file").alias("b")).where("n > 1").first():
            raise CoverageError(f"sample {twice['sample_id']} comes from two files: {twice['a']}, {twice['b']}")
        names = [r["sample_id"] for r in files.collect()]
        if exists(spark, ledger):
            earlier = spark.read.schema("sample_id string, batch long").parquet(ledger).where(F.col("batch") != number)
            if old := earlier.where(F.col("sample_id").isin(names)).first():
                raise CoverageError(f"sample {old['sample_id']} came before, in batch {old['batch']}")
        return names

    def append(batch: DataFrame, number: int) -> None:
        names = arrived(batch, number)
        parsed = parse_lines(batch)
        bad = parsed.where("problem IS NOT NULL").select("sample_id", "problem").first()
        if bad:
            raise CoverageError(f"sample {bad['sample_id']}: {bad['problem']}")
        found = records(parsed, "sample_id")
        if twice := duplicates(found).first():
            raise CoverageError(f"sample {twice['sample_id']}: duplicate record at {twice['contig_key']}:{twice['start'] + 1}")
        aligned = align(found, sites)
        check_matches(aligned)
        build_assay(aligned, min_coverage, "sample_id").write.mode("overwrite").parquet(f"{output}/batch={number}")
        spark.createDataFrame([(n,) for n in names], "sample_id string").coalesce(1).write.mode("overwrite").parquet(f"{ledger}/batch={number}")

    writer = lines.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
