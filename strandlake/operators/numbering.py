"""Gapless row numbers in an order, without sorting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.files import scratch_path


def numbered(df: DataFrame, order: list[str], name: str = "cpg_idx") -> DataFrame:
    """``df`` with ``name``: the place of each row, from 0, in ascending order
    of the columns ``order``, which must tell rows apart. Rows are dealt by
    range and written, each range counted (one number a range on the driver) and
    numbered by itself; the counts before it are its base."""
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()).write.option("compression", "zstd").parquet(path)
    ranges = spark.read.parquet(path)
    bases, total = [], 0
    for row in ranges.groupBy("__part").count().orderBy("__part").collect():
        bases.append((row["__part"], total))
        total += row["count"]
    base = spark.createDataFrame(bases, "__part int, __base long")
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order)).cast("long") - 1
    return ranges.withColumn("__nth", place).join(F.broadcast(base), "__part").withColumn(name, F.col("__base") + F.col("__nth")).drop("__part", "__nth", "__base")  # one row per range
