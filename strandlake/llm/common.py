"""Plumbing that the training-data operators share.

Intermediate tables go to the folder that the cluster names in
``spark.checkpoint.dir``; a folder of our own is set only where that is unset
and driver and executors are one process; on a cluster its absence is an
error. A row's identity is its file and its place in that file, so it is the
same on every evaluation of a scan, on whatever executors and in whatever
splits.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from dataclasses import dataclass
from pathlib import Path
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "__sl_row"
#: A row's number: 36 bits for its file, then 27 for its place in it; rows are
#: looked up by blocks of 2 ** BLOCK_BITS.
ROW_BITS, BLOCK_BITS, MOST_FOLDERS = 27, 20, 4096


def reach_workers(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it, too."""
    home = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in known:
        env["PYTHONPATH"] = os.pathsep.join([home, *known])


def work_root(spark: SparkSession) -> str:
    """The shared folder of this session, as a URI."""
    reach_workers(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        local = tempfile.mkdtemp(prefix="strandlake-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        sc.setCheckpointDir(f"file://{local}")
        root = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{work_root(spark)}/strandlake/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it read back: the lineage
    ends at a table that outlives any executor."""
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._strandlake_path = path
    return back


def discard(df: DataFrame) -> None:
    """Delete what ``materialize`` wrote, once nothing reads it any more."""
    path = getattr(df, "_strandlake_path", None)
    if path:
        drop_path(df.sparkSession, path)


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_SCANS = {"Relation", "Project", "Filter"}


def stable(df: DataFrame) -> DataFrame:
    """``df`` itself where its rows are those of Parquet files, each with a
    place in its file; else a written copy of it. Rows that ``with_row_id``
    numbers keep their numbers however a later evaluation cuts the files."""
    plan = df._jdf.queryExecution().optimizedPlan()
    lines = [line.lstrip(" :+-") for line in plan.toString().splitlines() if line.strip()]
    scans = [line for line in lines if line.startswith("Relation")]
    plain = {line.split(" ")[0].split("[")[0] for line in lines} <= _SCANS and len(scans) == 1 and scans[0].endswith(" parquet")
    return df if plain and plan.deterministic() else materialize(df, "stable")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of whole texts must stay small whatever their length."""
    reach_workers(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def _salt(files: list[str]) -> int:
    """The first number under which all file names have hashes of their own.
    Names count as the file system gives them and with escapes undone."""
    names = [re.sub(r"^(\w+):/+(?=/)", r"\1:", f) for f in files]
    for salt in range(1000):
        if all(len({_name_hash(salt, n) for n in some}) == len(set(some)) for some in (names, [unquote(n) for n in names])):
            return salt
    raise ValueError(f"{len(files)} input files are too many to be numbered")


def _name_hash(salt: int, name: str) -> int:
    return xxhash.xxh64_intdigest(f"{salt}:{name}".encode(), seed=42) >> (1 + ROW_BITS)


def with_row_id(df: DataFrame) -> DataFrame:
    """``df`` (as ``stable`` returns it) with ROW: a hash of the row's file,
    which no other of its files shares, then the row's place in it. Neither
    depends on how the scan is split, so on cores or executors."""
    df = stable(df)
    meta = df.metadataColumn("_metadata")
    file = F.concat(F.lit(f"{_salt(df.inputFiles())}:"), meta["file_path"])
    place = F.when(meta["row_index"] < (1 << ROW_BITS), meta["row_index"]).otherwise(F.raise_error(F.lit("a file has too many rows to be numbered")))
    return df.withColumn(ROW, F.shiftleft(F.shiftrightunsigned(F.xxhash64(file), 1 + ROW_BITS), ROW_BITS).bitwiseOR(place.cast("long")))


@dataclass(frozen=True)
class Lookup:
    """A table of rows by ROW, written so that whoever reads a stretch of a
    file finds what belongs to it."""

    path: str
    folders: int


def by_block(table: DataFrame, docs: DataFrame, tag: str) -> Lookup:
    """Write ``table``, which has ROW, so that each task over the numbered
    ``docs`` finds its own rows: whole texts then stay where they are, however
    many rows the table has. Blocks of a file's rows are dealt over folders, as
    many as there are files (up to MOST_FOLDERS)."""
    spark = table.sparkSession
    found = Lookup(fresh_path(spark, tag), min(len(docs.inputFiles()), MOST_FOLDERS) | 1)
    keyed = table.withColumn("block", F.shiftright(F.col(ROW), BLOCK_BITS)).withColumn("folder", F.pmod("block", F.lit(found.folders)).cast("int"))
    keyed.repartition("folder").sortWithinPartitions("block").write.partitionBy("folder").option("compression", "zstd").parquet(found.path)
    return found


def own_block(lookup: Lookup, block: int, columns: list[str]) -> pa.Table:
    """The rows of a block of the scan, from what ``by_block`` wrote."""
    from pyarrow import parquet
    from pyarrow.fs import FileType

    fs, root = shared_fs(f"{lookup.path}/folder={block % lookup.folders}")
    if fs.get_file_info(root).type == FileType.NotFound:
        return pa.table({c: [] for c in columns})
    return parquet.read_table(root, columns=columns, filters=[("block", "=", block)], filesystem=fs, partitioning=None)


def with_own_block(batches, lookup: Lookup, columns: list[str]):
    """Pairs of each stretch of a batch (whose last column is ROW) that lies in
    one block, and that block's table."""
    known, table = -1, None
    for batch in batches:
        blocks = batch.column(batch.num_columns - 1).to_numpy() >> BLOCK_BITS
        cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)] if len(blocks) else []
        for a, b in zip(cuts, cuts[1:]):
            if blocks[a] != known:
                known = int(blocks[a])
                table = own_block(lookup, known, columns)
            yield batch.slice(a, b - a), table


def without_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """``df`` (as ``stable`` returns it) without the rows listed in ``rows``;
    every task drops its own, so only the list is shuffled."""
    numbered = with_row_id(df)
    lookup = by_block(rows.select(ROW), numbered, "left-out")

    def run(batches):
        for batch, table in with_own_block(batches, lookup, [ROW]):
            lost = np.isin(batch.column(batch.num_columns - 1).to_numpy(), np.asarray(table.column(ROW), np.int64))
            yield batch.select(range(batch.num_columns - 1)).filter(pa.array(~lost))

    return numbered.mapInArrow(run, df.schema)


def shared_fs(uri: str):
    """A pyarrow file system and path for ``uri``, usable on driver and executors."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)
