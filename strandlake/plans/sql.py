"""Finished runs in SQL: views of a store's tables, and functions over them.

``open_store`` names everything by a prefix, so several runs lie side by side
in one session. The functions are SQL's own: Catalyst puts their bodies into the
query, so filters on their arguments reach the scan of the store.

    open_store(spark, "out/assays.store", "run")
    SELECT * FROM run_cells_in('chr1', 10000, 20000)
    SELECT r.name, sample_id, avg(beta) FROM regions r, LATERAL run_cells_in(r.contig, r.first, r.last) GROUP BY ALL
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..contracts import BIN_BITS, U32_MAX
from ..functions.columns import canonical_contig
from ..sinks.store import read_store

#: Windows meet sites by bins of this many bits, so that many windows aren't each held against a whole contig; and the last position that a site may have.
BITS, END = str(BIN_BITS), f"{U32_MAX + 1}L"
_BARE = "upper(regexp_replace(trim(name), '^(chr|CHR)', ''))"
_FUNCTIONS = (
    f"""{{p}}_contig_key(name STRING) RETURNS STRING COMMENT 'a contig by its one name'
       RETURN CASE WHEN {_BARE} = 'M' THEN 'MT' ELSE {_BARE} END""",
    """{p}_cells_in(contig STRING, first BIGINT, last BIGINT) RETURNS TABLE (sample_id STRING, cpg_idx BIGINT, contig_key STRING, position BIGINT, cov BIGINT, beta DOUBLE)
       COMMENT 'covered cells of the sites that start at 1-based positions from first to last' RETURN
       SELECT c.sample_id, c.cpg_idx, s.contig_key, s.position, c.cov, c.beta
       FROM (SELECT explode(sequence(shiftright(least(greatest({p}_cells_in.first, 0L), """ + END + """), """ + BITS + """), shiftright(least(greatest({p}_cells_in.last, 0L), """ + END + """), """ + BITS + """))) AS bin) b
       JOIN {p}_sites s ON shiftright(s.position, """ + BITS + """) = b.bin JOIN {p}_cells c ON c.cpg_idx = s.cpg_idx
       WHERE s.contig_key = {p}_contig_key({p}_cells_in.contig) AND s.position >= {p}_cells_in.first AND s.position <= {p}_cells_in.last""",
)


def open_store(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Temporary views ``<prefix>_sites``, ``_samples``, ``_cells`` and the
    functions above; returns their names. Tables stay where they are."""
    if not re.fullmatch(r"[a-z][a-z0-9_]*", prefix):
        raise ValueError(f"{prefix!r} is not a plain lower-case name")
    data = read_store(spark, path)
    sites = data.row_data.select("cpg_idx", "chr", canonical_contig(F.col("chr")).alias("contig_key"), (F.col("start") + 1).alias("position"), "end", "strand")
    names = data.col_data.select("sample_idx", "sample_id", "sample_name")
    cells = data.assay.join(F.broadcast(names.select("sample_idx", "sample_id")), "sample_idx")  # one row per sample
    views = {"sites": sites, "samples": names, "cells": cells.select("sample_id", "cpg_idx", "cov", F.col("beta").cast("double").alias("beta"))}
    for name, table in views.items():
        table.createOrReplaceTempView(f"{prefix}_{name}")
    for body in _FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {body.format(p=prefix)}")
    return [*(f"{prefix}_{name}" for name in views), *(re.match(r"\w+", b.format(p=prefix))[0] for b in _FUNCTIONS)]


def close_store(spark: SparkSession, names: list[str]) -> None:
    """Drop what ``open_store`` made."""
    for name in reversed(names):
        if not spark.catalog.dropTempView(name):
            spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
