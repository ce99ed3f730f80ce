"""Dense matrices of a run as NumPy arrays, for tools that read no Parquet.

The store and its arrays hold what an HDF5 assay file of this kind holds, under
these names:

    /cov                  cov.npy, unsigned 32 bits, [sample, site], 0 where uncovered
    /beta                 beta.npy, single precision, [sample, site], NaN where uncovered
    /rowData/{chr, seqnames, start, end, width, strand}   columns of rowData, in order of cpg_idx
    /colData/{sample_id, sample_name}                     columns of colData, in order of sample_idx
    /metadata/*                                           keys of the line in metadata

Sites are numbered by cpg_idx without gaps. Slices of the arrays are made by
tasks and written one after the other, so the driver holds one slice. Arrays
are read by ranges of their bytes, in either orientation: the first dimension
that equals the number of samples holds them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import MethylationSet
from .files import output_file

SLICE_BITS = 18
KINDS = {"cov": np.dtype("<u4"), "beta": np.dtype("<f4")}


def numbered_sites(row_data: DataFrame, bits: int = SLICE_BITS) -> tuple[DataFrame, int]:
    """``cpg_idx, place``: gapless numbers, and how many. The driver sees one
    count for each ``1 << bits`` indices."""
    spark = row_data.sparkSession
    part = F.shiftright("cpg_idx", bits)
    bases, total = [], 0
    for r in row_data.groupBy(part.alias("part")).count().orderBy("part").collect():
        bases.append((r["part"], total))
        total += r["count"]
    base = spark.createDataFrame(bases, "part long, base long")
    ranked = row_data.select("cpg_idx", part.alias("part")).selectExpr("cpg_idx", "part", "row_number() OVER (PARTITION BY part ORDER BY cpg_idx) - 1 AS nth")
    return ranked.join(F.broadcast(base), "part").select("cpg_idx", (F.col("base") + F.col("nth")).alias("place")), total  # one row per part


def write_arrays(data: MethylationSet, folder: str, bits: int = SLICE_BITS) -> tuple[int, int]:
    """Write cov.npy and beta.npy below ``folder``; their shape."""
    places, n = numbered_sites(data.row_data, bits)
    samples = data.col_data.count()
    width = 1 << bits
    cells = data.assay.join(places, "cpg_idx").select("sample_idx", F.shiftright("place", bits).alias("slice"), (F.col("place") % width).cast("int").alias("at"), "cov", "beta")

    def lay(key, table):
        at = table.column("at").to_numpy()
        cov, beta = np.zeros(width, KINDS["cov"]), np.full(width, np.nan, KINDS["beta"])
        cov[at], beta[at] = table.column("cov").to_numpy(), table.column("beta").to_numpy()
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()), pa.array([cov.tobytes()], pa.binary()), pa.array([beta.tobytes()], pa.binary())], names=["sample_idx", "slice", "cov", "beta"])

    slices = cells.groupBy("sample_idx", "slice").applyInArrow(lay, "sample_idx int, slice long, cov binary, beta binary").orderBy("sample_idx", "slice")
    empty = {"cov": np.zeros(width, KINDS["cov"]).tobytes(), "beta": np.full(width, np.nan, KINDS["beta"]).tobytes()}
    spark = data.assay.sparkSession
    with output_file(f"{folder}/cov.npy", spark) as cov, output_file(f"{folder}/beta.npy", spark) as beta:
        for f, kind in ((cov, KINDS["cov"]), (beta, KINDS["beta"])):
            np.lib.format.write_array_header_1_0(f, {"descr": kind.str, "fortran_order": False, "shape": (samples, n)})
        order = ((s, k) for s in range(samples) for k in range(-(-n // width)))
        found = slices.toLocalIterator()
        row = next(found, None)
        for s, k in order:
            mine = row if row is not None and (row["sample_idx"], row["slice"]) == (s, k) else None
            stop = 4 * min(width, n - k * width)
            cov.write((mine["cov"] if mine else empty["cov"])[:stop])
            beta.write((mine["beta"] if mine else empty["beta"])[:stop])
            row = next(found, None) if mine else row
    return samples, n


def _open(path: str):
    from pyarrow import fs

    system, own = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    return system.open_input_file(own)


def _header(path: str) -> tuple[tuple[int, ...], np.dtype, int]:
    with _open(path) as f:
        if np.lib.format.read_magic(f) != (1, 0):
            raise ValueError(f"{path}: not an array of version 1.0")
        shape, fortran, kind = np.lib.format.read_array_header_1_0(f)
        if fortran or len(shape) != 2:
            raise ValueError(f"{path}: two dimensions in C order are needed, not {shape}")
        return shape, kind, f.tell()


def read_arrays(spark: SparkSession, folder: str, n_samples: int, bits: int = SLICE_BITS) -> DataFrame:
    """``sample_idx, place, cov, beta`` of the covered cells of arrays in either
    orientation; each task reads a range of both files."""
    (shape, kind, start), (other, beta_kind, beta_start) = (_header(f"{folder}/{n}.npy") for n in ("cov", "beta"))
    if shape != other or n_samples not in shape:
        raise ValueError(f"{folder}: arrays of {shape} and {other} don't fit {n_samples} samples")
    columns, width = shape[1], 1 << bits
    by_sample = shape[0] == n_samples
    total = shape[0] * columns
    ranges = spark.range(-(-total // width)).select((F.col("id") * width).alias("a"))

    def run(batches):
        with _open(f"{folder}/cov.npy") as cov, _open(f"{folder}/beta.npy") as beta:
            for batch in batches:
                for a in batch.column(0).to_pylist():
                    n = min(width, total - a)
                    cov.seek(start + a * kind.itemsize)
                    beta.seek(beta_start + a * beta_kind.itemsize)
                    c, b = np.frombuffer(cov.read(n * kind.itemsize), kind), np.frombuffer(beta.read(n * beta_kind.itemsize), beta_kind)
                    hit = np.flatnonzero(c)
                    first, second = np.divmod(hit + a, columns)
                    sample, place = (first, second) if by_sample else (second, first)
                    yield pa.RecordBatch.from_arrays([pa.array(sample.astype(np.int32)), pa.array(place.astype(np.int64)), pa.array(c[hit].astype(np.int64)), pa.array(b[hit].astype(np.float32))], names=["sample_idx", "place", "cov", "beta"])

    return ranges.mapInArrow(run, "sample_idx int, place long, cov long, beta float")
