"""Samples against samples: pairwise-complete products, components, clusters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.files import reach_workers

#: Samples whose matrices a task and the driver hold with ease (5 x 8 bytes a pair).
MOST_SAMPLES = 4000
BLOCK_SITES = 4096


def gram(assay: DataFrame, n_samples: int) -> DataFrame:
    """``i, j, n, sum_i, sum_j, sq_i, sq_j, dot`` for every ordered pair i <= j
    of samples that share a covered site: sums over the sites that both cover.

    A site's cells come together in one row (one cell a sample at most); a task
    turns blocks of sites into a matrix and adds up products, so samples x
    samples rows a task are shuffled, whatever the number of sites."""
    if n_samples > MOST_SAMPLES:
        raise ValueError(f"{n_samples} samples are more than {MOST_SAMPLES}; compare them in parts")
    rows = assay.groupBy("cpg_idx").agg(F.collect_list(F.struct("sample_idx", F.col("beta").cast("double").alias("beta"))).alias("cells"))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square, dot = (np.zeros((n_samples, n_samples)) for _ in range(4))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_SITES):
                cells = batch.column(0).slice(at, BLOCK_SITES)
                flat = cells.flatten()
                site = np.repeat(np.arange(len(cells)), cells.value_lengths().to_numpy())
                x, there = np.zeros((len(cells), n_samples)), np.zeros((len(cells), n_samples))
                sample = flat.field("sample_idx").to_numpy()
                x[site, sample] = flat.field("beta").to_numpy()
                there[site, sample] = 1
                n += there.T @ there
                total += x.T @ there
                square += (x * x).T @ there
                dot += x.T @ x
        i, j = np.nonzero(np.triu(n))
        if len(i):
            values = (i, j, n[i, j].astype(np.int64), total[i, j], total[j, i], square[i, j], square[j, i], dot[i, j])
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=["i", "j", "n", "sum_i", "sum_j", "sq_i", "sq_j", "dot"])

    reach_workers(assay.sparkSession)
    parts = rows.select("cells").mapInArrow(products, "i long, j long, n long, sum_i double, sum_j double, sq_i double, sq_j double, dot double")
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sum_i", "sum_j", "sq_i", "sq_j", "dot")])


def pair_measures(products: DataFrame) -> DataFrame:
    """``i, j, n, covariance, distance``: of the sites that both samples cover,
    the covariance of their beta values (over n) and the root of the mean
    squared difference; rounded to 9 and 6 digits."""
    n = F.col("n").cast("double")
    covariance = F.col("dot") / n - (F.col("sum_i") / n) * (F.col("sum_j") / n)
    square = (F.col("sq_i") - 2 * F.col("dot") + F.col("sq_j")) / n
    return products.select("i", "j", "n", F.round(covariance, 9).alias("covariance"), F.when(F.col("i") == F.col("j"), 0.0).otherwise(F.round(F.sqrt(F.greatest(square, F.lit(0.0))), 6)).alias("distance"))


def _square(pairs: DataFrame, n_samples: int, value: str, missing: float) -> np.ndarray:
    """A symmetric matrix of samples x samples, on the driver."""
    out = np.full((n_samples, n_samples), missing)
    for r in pairs.select("i", "j", value).collect():  # one row per pair of samples
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r[value]
    return out


def principal_components(pairs: DataFrame, n_samples: int, k: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates (samples x k) and the share of variance of each component,
    from the pairwise-complete covariances of the samples. Pairs without a
    common site count as 0. The sample of the largest coordinate of a component
    lies on its positive side. Only this small matrix is on the driver."""
    matrix = _square(pairs, n_samples, "covariance", 0.0)
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:k]
    values, vectors = np.maximum(values[order], 0), vectors[:, order]
    vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None], 0) < 0, -1, 1)
    trace = np.trace(matrix)
    return vectors * np.sqrt(values), values / trace if trace > 0 else np.zeros(len(values))


def sample_clusters(pairs: DataFrame, n_samples: int) -> list[tuple[int, int, float, int]]:
    """Average linkage over the distances: merges ``(a, b, height, size)`` in
    their order; samples are clusters 0 to n - 1, each merge makes the next.
    Pairs without a common site are as far apart as any pair is. Ties go to the
    smaller numbers."""
    apart = _square(pairs, n_samples, "distance", np.nan)
    np.fill_diagonal(apart, 0)
    far = np.nanmax(apart) if n_samples else 0.0
    apart = np.where(np.isnan(apart), far, apart)
    live = {i: [i] for i in range(n_samples)}
    out = []
    while len(live) > 1:
        keys = sorted(live)
        height, a, b = min((float(np.mean(apart[np.ix_(live[a], live[b])])), a, b) for x, a in enumerate(keys) for b in keys[x + 1 :])
        live[n_samples + len(out)] = joined = live.pop(a) + live.pop(b)
        out.append((a, b, height, len(joined)))
    return out
