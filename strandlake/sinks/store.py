"""The assay store: Parquet tables with a versioned schema.

    assays/   covered cells (cpg_idx, cov, beta), partitioned by sample_idx
    rowData/  cpg_idx, chr, seqnames, start, end (1-based closed), width, strand
    colData/  sample_idx, sample_id, sample_name
    metadata/ one JSON line
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import STORE_SCHEMA_NAME, STORE_SCHEMA_VERSION, MethylationSet
from .files import written


def row_data_table(row_data: DataFrame) -> DataFrame:
    """Sites as stored: 1-based closed."""
    start = (F.col("start") + 1).alias("start")
    return row_data.select("cpg_idx", "chr", F.col("chr").alias("seqnames"), start, "end", (F.col("end") - F.col("start")).alias("width"), "strand")


def metadata_of(genome: str, universe: int) -> dict:
    return {"genome": genome, "schema_name": STORE_SCHEMA_NAME, "schema_version": STORE_SCHEMA_VERSION, "loader_compatibility": "parquet", "is_h5": False, "universe": universe}


def write_store(data: MethylationSet, path: str) -> None:
    spark = data.assay.sparkSession
    data.assay.repartition("sample_idx", F.shiftright("cpg_idx", 22)).sortWithinPartitions("sample_idx", "cpg_idx").write.partitionBy("sample_idx").option("compression", "zstd").parquet(f"{path}/assays")
    row_data_table(data.row_data).write.option("compression", "zstd").parquet(f"{path}/rowData")
    data.col_data.coalesce(1).write.parquet(f"{path}/colData")
    spark.createDataFrame([(json.dumps(metadata_of(data.genome, data.universe), ensure_ascii=False),)], "value string").coalesce(1).write.text(f"{path}/metadata")


def read_metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/metadata").first()["value"])


def read_store(spark: SparkSession, path: str) -> MethylationSet:
    """The store as it was: sites 0-based half-open again."""
    meta = read_metadata(spark, path)
    rows = spark.read.parquet(f"{path}/rowData").select("cpg_idx", "chr", (F.col("start") - 1).alias("start"), "end", "strand")
    assay = spark.read.schema("cpg_idx long, cov long, beta float, sample_idx int").parquet(f"{path}/assays").select("cpg_idx", "sample_idx", "cov", "beta")
    return MethylationSet(rows, spark.read.parquet(f"{path}/colData"), assay, meta["genome"], meta.get("universe", 0))


def read_matrix(spark: SparkSession, values: list[list[int]], n_samples: int, sample_ids: list[str]) -> DataFrame:
    """Long cells of a small dense coverage matrix in either orientation."""
    lines = spark.createDataFrame([("\t".join(map(str, row)),) for row in values], "value string").coalesce(1)
    return matrix_cells(lines, n_samples, sample_ids)


def read_matrix_file(spark: SparkSession, path: str, sample_ids: list[str]) -> DataFrame:
    """Long cells of a file of tab-separated counts in either orientation."""
    return matrix_cells(spark.read.text(path), len(sample_ids), sample_ids)


def matrix_cells(lines: DataFrame, n_samples: int, sample_ids: list[str]) -> DataFrame:
    """``sample_idx, cpg_idx, cov, sample_id`` of the lines of a dense matrix:
    the first dimension that equals the number of samples holds them. Lines are
    numbered by their partition's base, which takes one number per partition on
    the driver, and their place in it."""
    numbered = written(lines.where("value <> ''").select("value", F.monotonically_increasing_id().alias("at")), "matrix")
    part = F.shiftright("at", 33)
    counts = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min(F.size(F.split("value", "\t"))).alias("low"), F.max(F.size(F.split("value", "\t"))).alias("high")).orderBy("part").collect()
    rows, widths = sum(c["n"] for c in counts), {w for c in counts for w in (c["low"], c["high"])}
    if len(widths) > 1:
        raise ValueError(f"lines of the matrix have {min(widths)} to {max(widths)} values")
    if n_samples not in (rows, *widths):
        raise ValueError(f"no dimension of the matrix equals {n_samples} samples")
    bases, total = [], 0
    for c in counts:
        bases.append((c["part"], total))
        total += c["n"]
    spark = lines.sparkSession
    base = spark.createDataFrame(bases, "part long, base long")  # one row per partition
    row = (F.col("base") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("row")
    cells = numbered.join(F.broadcast(base), part == F.col("part")).select(row, F.posexplode(F.split("value", "\t")).alias("column", "cov"))
    sample, site = ("row", "column") if rows == n_samples else ("column", "row")
    long = cells.select(F.col(site).cast("long").alias("cpg_idx"), F.col(sample).cast("int").alias("sample_idx"), F.col("cov").cast("long").alias("cov"))
    names = spark.createDataFrame(list(enumerate(sample_ids)), "sample_idx int, sample_id string")
    return long.join(F.broadcast(names), "sample_idx")  # as many names as samples
