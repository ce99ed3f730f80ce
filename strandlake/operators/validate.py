"""Validation of stores: each rule counts its violations, in one pass."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import STORE_SCHEMA_NAME, STORE_SCHEMA_VERSION, ValidationError

ROW_TYPES = {"cpg_idx": "bigint", "chr": "string", "seqnames": "string", "start": "bigint", "end": "bigint", "width": "bigint", "strand": "string"}
ASSAY_TYPES = {"cpg_idx": "bigint", "cov": "bigint", "beta": "float", "sample_idx": "int"}
SAMPLE_TYPES = {"sample_idx": "int", "sample_id": "string", "sample_name": "string"}


def row_rules() -> dict[str, Column]:
    """What is wrong with a stored site, by rule; null counts as wrong."""
    wrong = {
        "chr_empty": F.col("chr") == "",
        "chr_not_seqnames": F.col("chr") != F.col("seqnames"),
        "start_below_one": F.col("start") < 1,
        "end_before_start": F.col("end") < F.col("start"),
        "bad_width": F.col("width") != F.col("end") - F.col("start") + 1,
        "bad_strand": ~F.col("strand").isin("+", "-", "*"),
    }
    return {k: F.coalesce(v, F.lit(True)) for k, v in wrong.items()}


def assay_rules() -> dict[str, Column]:
    """What is wrong with a stored cell. Stored cells are covered ones, so
    their beta is a number from 0 to 1."""
    beta = F.col("beta").cast("double")
    wrong = {"uncovered_cell": F.col("cov") <= 0, "beta_missing": F.col("beta").isNull() | F.isnan("beta"), "beta_out_of_range": F.col("beta").isNotNull() & ~F.isnan("beta") & ~beta.between(0.0, 1.0)}
    return {k: F.coalesce(v, F.lit(True)) for k, v in wrong.items()}


def dense_rules() -> dict[str, Column]:
    """What is wrong with a dense cell: null or NaN beta where, and only
    where, nothing covers it."""
    missing = F.col("beta").isNull() | F.isnan("beta")
    return {"beta_without_coverage": (F.col("cov") == 0) & ~missing, "coverage_without_beta": (F.col("cov") > 0) & missing, "beta_out_of_range": F.coalesce(~missing & ~F.col("beta").cast("double").between(0.0, 1.0), F.lit(False))}


def violations(table: DataFrame, rules: dict[str, Column], key: str = "cpg_idx") -> DataFrame:
    """``rule, n, first``: how many rows break each rule, and the smallest key."""
    one = table.agg(*[x for k, c in rules.items() for x in (F.count_if(c).alias(f"n_{k}"), F.min(F.when(c, F.col(key))).alias(f"f_{k}"))])
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(f"n_{k}").alias("n"), F.col(f"f_{k}").alias("first")) for k in rules])))


def check_types(table: DataFrame, types: dict[str, str], name: str) -> None:
    have = dict(table.dtypes)
    for column, kind in types.items():
        if column not in have:
            raise ValidationError(f"{name}: required column {column} is missing")
        if have[column] != kind:
            raise ValidationError(f"{name}: column {column} is {have[column]}, not {kind}")


def check_samples(col_data: DataFrame) -> int:
    """Samples are as many as input files, so they are read whole."""
    seen: set[str] = set()
    rows = col_data.orderBy("sample_idx").collect()
    for r in rows:
        name = r["sample_id"]
        if name != r["sample_name"]:
            raise ValidationError(f"sample {r['sample_idx']}: id {name!r} differs from name {r['sample_name']!r}")
        if not name or name != name.strip() or any(x in name for x in "\t\r\n"):
            raise ValidationError(f"sample {r['sample_idx']}: bad id {name!r}")
        if name in seen:
            raise ValidationError(f"duplicate sample id {name!r}")
        seen.add(name)
    return len(rows)


def check_metadata(meta: dict) -> None:
    if not str(meta.get("genome", "")).strip():
        raise ValidationError("metadata: genome is blank")
    for key, want in (("schema_name", STORE_SCHEMA_NAME), ("schema_version", STORE_SCHEMA_VERSION), ("loader_compatibility", "parquet"), ("is_h5", False)):
        if meta.get(key) != want:
            raise ValidationError(f"metadata: {key} is {meta.get(key)!r}, not {want!r}")


def _raise_first(table: DataFrame, rules: dict[str, Column], name: str) -> None:
    bad = violations(table, rules).where("n > 0").orderBy("rule").collect()  # one row per rule
    if bad:
        raise ValidationError(f"{name}: " + "; ".join(f"{b['rule']} in {b['n']} rows, first at {b['first']}" for b in bad))


def key_faults(assays: DataFrame, rows: DataFrame, samples: DataFrame) -> tuple[int, int]:
    """How many cells are stored more than once, and how many belong to no site
    or no sample. The keys are shuffled once, by site, for both; sites are as
    many as the data wants, so they aren't broadcast."""
    counted = assays.select("cpg_idx", "sample_idx").repartition("cpg_idx").groupBy("cpg_idx", "sample_idx").count()
    known = rows.select("cpg_idx", F.lit(True).alias("site")).hint("merge")
    people = samples.select("sample_idx", F.lit(True).alias("sample"))
    found = counted.join(known, "cpg_idx", "left").join(F.broadcast(people), "sample_idx", "left")  # one row per sample
    both = found.agg(F.count_if(F.col("count") > 1).alias("twice"), F.count_if(F.col("site").isNull() | F.col("sample").isNull()).alias("stray")).first()
    return both["twice"], both["stray"]


def layout_faults(assays: DataFrame) -> DataFrame:
    """``file, fault`` of stored cells that don't lie as ``write_store`` lays
    them: a folder a sample, cells of a file in ascending order of sites. Each
    task looks along the files that it reads, which go by a number of 8 bytes a
    cell; names are looked up for those with a fault."""
    file = assays.metadataColumn("_metadata")["file_path"]

    def run(batches):
        file, last = None, -1
        for batch in batches:
            sites = batch.column(0).to_numpy()
            for name in batch.column(1).unique().to_pylist():
                here = pc.equal(batch.column(1), name).to_numpy(zero_copy_only=False)
                mine = sites[here]
                before = last if name == file else -1
                inside = batch.column(2)[int(here.argmax())].as_py()
                fault = "outside a folder of its sample" if not inside else "not in the order of sites" if (np.diff(mine, prepend=before) < 0).any() else None
                file, last = name, int(mine[-1])
                if fault:
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([fault])], names=["number", "fault"])

    number = F.xxhash64(file).alias("number")
    found = assays.select("cpg_idx", number, F.contains(file, F.lit("/sample_idx=")).alias("inside")).mapInArrow(run, "number long, fault string").distinct()
    return assays.select(file.alias("file"), number).distinct().join(F.broadcast(found), "number").select("file", "fault")  # two rows per file at most


def check_layout(spark: SparkSession, path: str) -> None:
    """Readers of a range of sites rely on the order of cells."""
    bad = layout_faults(spark.read.parquet(f"{path}/assays")).orderBy("file", "fault").first()
    if bad:
        raise ValidationError(f"assays: {bad['file'].rsplit('/', 1)[-1]} is {bad['fault']}")


def validate_store(spark: SparkSession, path: str) -> dict:
    """Check a store whole; its summary, or ValidationError."""
    from pyspark.errors import AnalysisException

    from ..sinks.store import read_metadata

    tables = {}
    for name in ("assays", "rowData", "colData"):
        try:
            tables[name] = spark.read.parquet(f"{path}/{name}")
        except AnalysisException as e:
            raise ValidationError(f"required table {name} is missing") from e
    try:
        meta = read_metadata(spark, path)
    except AnalysisException as e:
        raise ValidationError("required metadata is missing") from e
    check_metadata(meta)
    check_types(tables["rowData"], ROW_TYPES, "rowData")
    check_types(tables["assays"], ASSAY_TYPES, "assays")
    check_types(tables["colData"], SAMPLE_TYPES, "colData")
    samples = check_samples(tables["colData"])
    sites = tables["rowData"].count()
    if not sites or not samples:
        raise ValidationError("a store needs a site and a sample at least")
    _raise_first(tables["rowData"], row_rules(), "rowData")
    _raise_first(tables["assays"], assay_rules(), "assays")
    twice, stray = key_faults(tables["assays"], tables["rowData"], tables["colData"])
    if twice:
        raise ValidationError("assays: a cell is stored twice")
    if stray:
        raise ValidationError("assays: a cell of no site or no sample")
    return {"sample_count": samples, "cpg_count": sites, "genome": meta["genome"], "schema_name": meta["schema_name"], "schema_version": meta["schema_version"]}
