"""Running totals of samples as their files arrive, kept as streaming state.

The state of a sample is the file it came from and its totals. It lies in the
stream's checkpoint, so it outlives a restart: a sample that comes again, in
whatever file, is refused then as well, and its totals stay as they were. Lines
are summed inside each task before they are dealt to their sample, so a sample
of any size is a few rows to the task that holds its state.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..sinks.files import reach_workers
from ..sources.coverage import parse_lines

STATE = "file string, records long, methylated long, unmethylated long"
TOTALS = "sample_id string, file string, records long, methylated long, unmethylated long, problem string"
_COLUMNS = ("sample_id", "file", "records", "methylated", "unmethylated", "problem")
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SampleTotals(StatefulProcessor):
    """One row for each batch in which a sample has lines: its totals, or why
    the lines were refused."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        parts = pd.concat(list(rows))  # a few rows for each task of the batch
        files = sorted(parts["file"].unique())
        problems = sorted(parts["problem"].dropna())
        known = self.total.get() if self.total.exists() else None
        if known is not None:
            problem = f"came before, in {known[0]}"
        elif len(files) > 1:
            problem = f"comes from several files: {', '.join(files)}"
        else:
            problem = problems[0] if problems else None
        if problem is None:
            found = (files[0], *(int(parts[c].sum()) for c in ("records", "methylated", "unmethylated")))
            self.total.update(found)
        else:
            found = tuple(known) if known is not None else (files[0], 0, 0, 0)
        yield pd.DataFrame([(key[0], *found, problem)], columns=list(_COLUMNS))

    def close(self) -> None:
        pass


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums by sample and file of the rows of one batch of a task, and the
    first problem among them."""
    for batch in batches:
        grouped = batch.groupby(["sample_id", "file"], sort=False)
        sums = grouped[["methylated", "unmethylated"]].sum().astype("int64")
        worst = grouped["problem"].max()  # none is empty, which comes first
        yield sums.assign(records=grouped.size(), problem=worst.where(worst != "", None)).reset_index()[list(_COLUMNS)]


def totals_of(lines: DataFrame) -> DataFrame:
    """``lines`` (a stream of value, file, sample_id) as updates of totals."""
    parsed = parse_lines(lines).select("sample_id", "file", F.coalesce("methylated", F.lit(0)).alias("methylated"), F.coalesce("unmethylated", F.lit(0)).alias("unmethylated"), F.coalesce("problem", F.lit("")).alias("problem"))
    reach_workers(lines.sparkSession)
    parts = parsed.mapInPandas(_summed, TOTALS)
    return parts.groupBy("sample_id").transformWithStateInPandas(SampleTotals(), TOTALS, "Update", "None")


@contextmanager
def _state_store(spark: SparkSession):
    """State of this kind needs its own store; the setting is put back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def stream_totals(spark: SparkSession, directory: str, output: str, checkpoint: str) -> StreamingQuery:
    """Stream the coverage files of ``directory`` that are new into
    ``output/batch=N``, a row for each sample that came, then end."""
    name = F.element_at(F.split(F.col("_metadata.file_name"), "/"), -1)
    lines = spark.readStream.schema("value string").text(directory).select("value", name.alias("file"), F.regexp_replace(name, r"(\.bismark)?\.cov(\.gz)?$", "").alias("sample_id"))

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={number}")

    with _state_store(spark):
        query = totals_of(lines.where(F.col("file").rlike(r"\.cov(\.gz)?$"))).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return query


def current_totals(spark: SparkSession, output: str) -> DataFrame:
    """The totals as they stand: of each sample the accepted row, or else its
    first refusal."""
    rows = spark.read.schema(f"{TOTALS}, batch long").parquet(output)
    order = F.struct(F.col("problem").isNotNull().alias("refused"), "batch")
    best = rows.groupBy("sample_id").agg(F.min_by(F.struct("file", "records", "methylated", "unmethylated", "problem"), order).alias("x"))
    return best.select("sample_id", "x.*")
