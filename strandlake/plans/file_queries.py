"""Queries that go through files: discovery, reading, whole runs and what they
publish, with their SQL oracles.

Inputs are written from the projected tables: a coverage file per sample, in
two codecs, a FASTA file, a gene model and a site folder. One run serves all
queries of a session over the same tables.
"""

from __future__ import annotations

import hashlib
import io
import logging
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import ANNOTATION_COLUMNS, THRESHOLDS, EngineError, Reference
from ..functions.columns import genome_key_of, release_of, sample_of
from ..functions.names import sample_name, sample_names
from ..operators import validate as va
from ..operators.summary import check_dimensions
from ..sinks.arrays import read_arrays, write_arrays
from ..sinks.files import Remote, discard, list_files, scratch_path, written
from ..sinks.store import read_matrix_file, read_metadata, read_store
from ..sources import coverage as co
from ..sources import download as dl
from ..sources import fasta, ron
from ..sources.gtf import find_gtf
from ..sources.reference import resolve_reference, save_reference
from ..streaming.ingest import ingest
from ..streaming.totals import current_totals
from ..streaming.totals import stream_totals as running_totals
from . import pipeline
from .sql import open_store
from .projection import Projection

MIN_COVERAGE = 5
CONTIGS = (*(f"chr{i}" for i in range(1, 23)), "chrX", "chrY", "chrM", "chrUn_alt")

COVERAGE_FILE = "CASE WHEN substr(sample_id, 3) = 'F' THEN concat(sample_id, '.cov.gz') ELSE concat(sample_id, '.bismark.cov') END"

#: Pieces of the made contigs; every other one in lower case.
PIECES = """
SELECT doc_id, doc_id % 26 AS k, CASE WHEN doc_id % 2 = 0 THEN s ELSE lower(s) END AS piece
FROM (SELECT doc_id, translate(md5(CAST(doc_id AS STRING)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS s FROM (SELECT DISTINCT doc_id FROM documents) d) x
"""

GTF_TEXT = """
SELECT concat('chr', contig_key, chr(9), 'made', chr(9), feature, chr(9), CAST(start0 + 1 AS STRING), chr(9), CAST(end0 AS STRING), chr(9), '.', chr(9), strand, chr(9), '.', chr(9),
              'gene_id "', gene_id, '"; transcript_id "', transcript_id, '"; gene_name "', upper(gene_id), '";') AS value
FROM gtf_rows
"""


def write_named(lines: DataFrame, path: str, packed: bool = False) -> str:
    """``lines`` (one column of text) as one file of that name."""
    spark = lines.sparkSession
    held = f"{os.path.dirname(path)}/.held-{os.path.basename(path)}"
    writer = lines.coalesce(1).write.option("compression", "gzip") if packed else lines.coalesce(1).write
    writer.text(held)
    _take(spark, held, path)
    return path


def _take(spark: SparkSession, folder: str, path: str) -> None:
    """Move the only part file of ``folder`` to ``path``."""
    remote = Remote(spark, path)
    (part,) = (p for p in list_files(spark, folder) if os.path.basename(p).startswith("part-"))
    remote.make(os.path.dirname(path))
    remote.move(part, path)
    remote.remove(folder)


class Made:
    """The generated inputs and the run over them, each made when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.p = spark, Projection(spark, sf_dir)
        self.root = scratch_path(spark, "made")
        self.done: dict[str, object] = {}

    def once(self, name: str, make):
        if name not in self.done:
            self.done[name] = make()
        return self.done[name]

    def coverage(self) -> str:
        return self.once("coverage", self._coverage)

    def _coverage(self) -> str:
        total = F.col("methylated") + F.col("unmethylated")
        position = (F.col("start") + 1).cast("string")
        percent = (F.lit(100.0) * F.col("methylated") / total).cast("double").cast("string")
        value = F.concat_ws("\t", "chr", position, position, percent, F.col("methylated").cast("string"), F.col("unmethylated").cast("string"))
        lines = written(self.p.records().select(F.expr(COVERAGE_FILE).alias("file"), value.alias("value")), "lines")  # once for both codecs
        for codec, mine in (("gzip", "file LIKE '%.gz'"), ("none", "file NOT LIKE '%.gz'")):
            held = f"{self.root}/.held-{codec}"
            lines.where(mine).repartition("file").write.partitionBy("file").option("compression", codec).text(held)
            remote = Remote(self.spark, held)
            for status in remote.fs.listStatus(remote.path(held)):
                name = status.getPath().getName()
                if status.isDirectory() and name.startswith("file="):
                    _take(self.spark, f"{held}/{name}", f"{self.root}/in/{name[5:]}")
        discard(lines)
        write_named(self.spark.createDataFrame([("not a coverage file",)], "value string"), f"{self.root}/in/notes.txt")
        return f"{self.root}/in"

    def fasta(self) -> str:
        return self.once("fasta", lambda: write_named(self.fasta_records(), f"{self.root}/made.fa.gz", packed=True))

    def fasta_records(self) -> DataFrame:
        pieces = self.p.sql(PIECES).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("doc_id", "piece"))).alias("pieces"))
        name = F.element_at(F.array(*map(F.lit, CONTIGS)), (F.col("k") + 1).cast("int"))
        bases = F.regexp_replace(F.array_join(F.transform("pieces", lambda x: x["piece"]), ""), "(.{60})", "$1\n")
        return pieces.coalesce(1).sortWithinPartitions("k").select(F.concat(F.lit(">"), name, F.lit(" made "), F.col("k").cast("string"), F.lit("\n"), bases).alias("value"))

    def sites(self) -> str:
        def make():
            contigs = self.spark.createDataFrame([(0, "chr1", 1)], "contig_idx long, contig string, length long")
            save_reference(Reference(self.p.sites(), contigs, "made"), f"{self.root}/sites")
            return f"{self.root}/sites"

        return self.once("sites", make)

    def model(self) -> str:
        def make():
            write_named(self.p.sql(GTF_TEXT, gtf_rows=self.p.sql_gtf_rows()), f"{self.root}/gtf/only.gtf.gz", packed=True)
            return f"{self.root}/gtf"

        return self.once("model", make)

    def run(self) -> tuple[str, list[str]]:
        """Where a whole run published, and what it logged."""

        def make():
            with _Said(logging.INFO) as said:
                pipeline.process(self.spark, pipeline.Config(self.coverage(), f"{self.root}/out", self.sites(), min_coverage=MIN_COVERAGE, annotation_dir=self.model()))
            return f"{self.root}/out", said

        return self.once("run", make)


_MADE: dict[tuple[str, str], Made] = {}


def made(spark: SparkSession, sf_dir: str) -> Made:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = Made(spark, sf_dir)
    return _MADE[key]


def content(spark: SparkSession, path: str) -> bytes:
    """One small file, whole."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])


def read_xlsx(spark: SparkSession, path: str) -> tuple[str, list[list]]:
    """Name and rows of the sheet of a workbook as this engine writes them."""
    space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(content(spark, path))) as z:
        name = ElementTree.fromstring(z.read("xl/workbook.xml")).find(f".//{space}sheet").get("name")
        rows = ElementTree.fromstring(z.read("xl/worksheets/sheet1.xml")).iter(f"{space}row")
        return name, [["".join(c.itertext()) if c.get("t") == "inlineStr" else float("".join(c.itertext())) for c in row] for row in rows]


# --- queries ---------------------------------------------------------------


def files_discovered(spark, sf_dir):
    paths = co.find_files(spark, made(spark, sf_dir).coverage())
    return spark.createDataFrame([(i, os.path.basename(p), sample_name(p)) for i, p in enumerate(paths)], "sample_idx int, file string, sample_id string")


def files_read(spark, sf_dir):
    found, samples = co.read_coverage(spark, co.find_files(spark, made(spark, sf_dir).coverage()))
    sums = found.groupBy("sample_idx", "contig_key").agg(F.count("*").alias("n"), F.sum("start").alias("starts"), F.sum("methylated").alias("m"), F.sum("unmethylated").alias("u"))
    return sums.join(samples.select("sample_idx", "sample_id"), "sample_idx")


def fasta_sites(spark, sf_dir):
    reference = resolve_reference(spark, made(spark, sf_dir).fasta())
    return reference.sites.select("cpg_idx", "chr", "contig_key", F.col("start").alias("start0"), F.col("end").alias("end0"), F.lit(reference.release_name).alias("genome"))


def fasta_listed_contigs(spark, sf_dir):
    reference = fasta.extract_sites(spark, made(spark, sf_dir).fasta(), ["chrUn_alt", "chrX", "absent"])
    counts = reference.sites.groupBy(F.col("chr").alias("contig")).agg(F.count("*").alias("n_sites"), F.min("cpg_idx").alias("first_idx"))
    return reference.contigs.join(counts, "contig").select(F.col("contig_idx").cast("long").alias("contig_idx"), "contig", "length", "n_sites", "first_idx")


def ron_sites(spark, sf_dir):
    m = made(spark, sf_dir)

    def make():
        reference = resolve_reference(spark, m.sites())
        ron.write_sites(reference, f"{m.root}/again.ron")
        return f"{m.root}/again.ron"

    back = resolve_reference(spark, m.once("ron", make).removesuffix(".ron"))
    return back.sites.select("cpg_idx", "chr", "contig_key", F.col("start").alias("start0"), F.col("end").alias("end0"), "strand", F.lit(back.release_name).alias("genome"))


def genome_download(spark, sf_dir):
    """A download, its provenance, and what happens to a spoilt cache."""
    data = content(spark, made(spark, sf_dir).fasta())
    release = dl.Release("hg19", "https://host/made.fa.gz", hashlib.md5(data).hexdigest())
    folder = tempfile.mkdtemp(prefix="strandlake-")
    try:
        path = dl.download_genome(folder, release, opener=lambda url: io.BytesIO(data))
        md5, size = dl._digest(path)
        again = dl.download_genome(folder, release, opener=lambda url: 1 / 0) == path
        with open(path, "ab") as f:
            f.write(b"N")
        spoilt = refusal(lambda: dl.check_cached(folder, release), folder)
        wrong = refusal(lambda: dl.download_genome(f"{folder}/x", dl.Release("x", "u", "0" * 32), opener=lambda url: io.BytesIO(data)), folder)
        return spark.createDataFrame([(release.name, md5, size, again, spoilt, wrong, ",".join(r.name for r in dl.RELEASES))], "name string, fasta_md5 string, fasta_bytes long, cached boolean, spoilt string, wrong string, known string")
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def run_cells(spark, sf_dir):
    out, _ = made(spark, sf_dir).run()
    data = read_store(spark, f"{out}/{pipeline.STORE}")
    return data.assay.join(data.col_data.select("sample_idx", "sample_id"), "sample_idx").select("sample_id", "cpg_idx", "cov", F.col("beta").cast("double").alias("beta"))


def run_rows(spark, sf_dir):
    out, _ = made(spark, sf_dir).run()
    return spark.read.parquet(f"{out}/{pipeline.STORE}/rowData").withColumnsRenamed({"start": "start1", "end": "end1"})


def run_samples(spark, sf_dir):
    out, _ = made(spark, sf_dir).run()
    meta = read_metadata(spark, f"{out}/{pipeline.STORE}")
    summary = va.validate_store(spark, f"{out}/{pipeline.STORE}")
    return spark.read.parquet(f"{out}/{pipeline.STORE}/colData").select("*", F.lit(meta["genome"]).alias("genome"), F.lit(meta["universe"]).cast("long").alias("universe"), F.lit(summary["cpg_count"]).cast("long").alias("n_sites"), F.lit(summary["sample_count"]).alias("n_samples"))


def run_coverage_sheet(spark, sf_dir):
    out, _ = made(spark, sf_dir).run()
    sheet, (header, *rows) = read_xlsx(spark, f"{out}/{pipeline.COVERAGE}")
    names = ["sheet", *(h.replace(" ", "_").lower() for h in header)]
    return spark.createDataFrame([(sheet, r[0], *map(int, r[1:])) for r in rows], ", ".join(f"`{n}` {'string' if i < 2 else 'long'}" for i, n in enumerate(names)))


def run_annotation_sheet(spark, sf_dir):
    out, _ = made(spark, sf_dir).run()
    sheet, (header, *rows) = read_xlsx(spark, f"{out}/{pipeline.ANNOTATION}")
    cells = [(sheet, r[0], int(r[1]), i // 2, header[2 + i].removesuffix("_count"), int(r[2 + i]), float(r[3 + i])) for r in rows for i in range(0, len(header) - 2, 2)]
    return spark.createDataFrame(cells, "sheet string, sample_id string, covered long, place int, region string, n long, percent double")


def run_annotation_table(spark, sf_dir):
    out, _ = made(spark, sf_dir).run()
    rows = spark.read.csv(f"{out}/{pipeline.TABLE}", sep="\t", header=True, quote="")
    kinds = {"start_1based": "long", "end_1based": "long", "distance_to_tss": "int"}
    return rows.select(*[F.coalesce(F.col(c).cast(kinds.get(c, "string")), F.lit(None if c in kinds else "")).alias(c) for c in ANNOTATION_COLUMNS])


def run_log(spark, sf_dir):
    _, said = made(spark, sf_dir).run()
    return spark.createDataFrame(list(enumerate(said)), "place int, message string")


def store_in_sql(spark, sf_dir):
    """Windows of four contigs, under several of their names, from the views and
    the table function of a finished run."""
    out, _ = made(spark, sf_dir).run()
    prefix = f"run_{uuid.uuid4().hex}"
    open_store(spark, f"{out}/{pipeline.STORE}", prefix)
    return spark.sql(f"""
        WITH regions AS (SELECT contig, 1 + 20000 * i AS first, 20000 * (i + 1) AS last FROM (VALUES ('chr3'), ('CHR6'), ('9'), (' chr12 ')) k(contig), (SELECT DISTINCT (position - 1) DIV 20000 AS i FROM {prefix}_sites) w)
        SELECT c.contig_key, c.sample_id, (r.first - 1) DIV 20000 AS place, count(*) AS n_sites, sum(c.cov) AS reads, round(avg(c.beta), 9) AS mean_beta
        FROM regions r, LATERAL {prefix}_cells_in(r.contig, r.first, r.last) c GROUP BY ALL""")


def matrix_file(spark, sf_dir):
    """The same counts from a file with samples in rows and one with samples in
    columns."""
    m = made(spark, sf_dir)
    samples = ["flag", "status"]
    part = m.p.raw["part"].select(F.col("p_partkey").alias("k"), F.col("p_size").cast("string").alias("a"), (F.col("p_size") % 7).cast("string").alias("b"))

    def make():
        write_named(part.orderBy("k").select(F.concat_ws("\t", "a", "b").alias("value")), f"{m.root}/columns.tsv")
        lists = part.agg(F.array_sort(F.collect_list(F.struct("k", "a", "b"))).alias("x"))
        write_named(lists.select(F.explode(F.array(F.array_join("x.a", "\t"), F.array_join("x.b", "\t"))).alias("value")), f"{m.root}/rows.tsv")
        return f"{m.root}/columns.tsv", f"{m.root}/rows.tsv"

    columns, rows = (read_matrix_file(spark, path, samples) for path in m.once("matrix", make))
    both = columns.withColumn("layout", F.lit("columns")).unionByName(rows.withColumn("layout", F.lit("rows")))
    return both.select("layout", "sample_id", "cpg_idx", "cov")


def array_cells(spark, sf_dir):
    """A finished store as arrays, and the covered cells read from them."""
    m = made(spark, sf_dir)
    out, _ = m.run()
    data = read_store(spark, f"{out}/{pipeline.STORE}")

    def make():
        Remote(spark, m.root).make(f"{m.root}/arrays")
        return write_arrays(data, f"{m.root}/arrays")

    samples, sites = m.once("arrays", make)
    cells = read_arrays(spark, f"{m.root}/arrays", samples)
    return cells.select("sample_idx", "place", "cov", F.col("beta").cast("double").alias("beta"), F.lit(sites).cast("long").alias("n_sites"))


def _arrive(spark: SparkSession, path: str, folder: str, name: str = "") -> None:
    """Copy a file to a folder that a stream watches."""
    remote = Remote(spark, folder)
    remote.make(folder)
    copy = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy
    copy(remote.fs, remote.path(path), remote.fs, remote.path(f"{folder}/{name or os.path.basename(path)}"), False, spark.sparkContext._jsc.hadoopConfiguration())


def stream_totals(spark, sf_dir):
    """Half of the files, then the rest and one sample over again under
    another name, which has to be refused after the restart."""
    m = made(spark, sf_dir)

    def make():
        paths = co.find_files(spark, m.coverage())
        for some in (paths[:3], paths[3:]):
            for path in some:
                _arrive(spark, path, f"{m.root}/coming")
            if some == paths[3:]:
                _arrive(spark, paths[0], f"{m.root}/coming", f"{sample_name(paths[0])}.bismark.cov.gz")
            running_totals(spark, f"{m.root}/coming", f"{m.root}/totals", f"{m.root}/totals-state")
        return f"{m.root}/totals"

    out = m.once("totals", make)
    refused = spark.read.parquet(out).where("problem IS NOT NULL").select("sample_id", F.lit(True).alias("again"))
    return current_totals(spark, out).drop("problem").join(refused, "sample_id", "left").select("sample_id", "file", "records", "methylated", "unmethylated", F.coalesce("again", F.lit(False)).alias("again"))


def stream_ingest(spark, sf_dir):
    m = made(spark, sf_dir)

    def make():
        for path in co.find_files(spark, m.coverage()):
            _arrive(spark, path, f"{m.root}/arriving")
        ingest(spark, f"{m.root}/arriving", m.p.sites(), f"{m.root}/ingested", f"{m.root}/ingest-state", MIN_COVERAGE).awaitTermination()
        return f"{m.root}/ingested"

    return spark.read.parquet(m.once("ingested", make)).select("sample_id", "cpg_idx", "cov", F.col("beta").cast("double").alias("beta"))


NAMES = """
SELECT s_suppkey, concat('/d/', CASE WHEN s_suppkey % 5 = 0 THEN 'sub/' ELSE '' END, CAST(s_suppkey AS STRING), CASE WHEN s_suppkey % 3 = 0 THEN '.x' ELSE '_HG19' END) AS stem,
       CASE s_suppkey % 6 WHEN 0 THEN '.bismark.cov.gz' WHEN 1 THEN '.bismark.cov' WHEN 2 THEN '.cov.gz' WHEN 3 THEN '.cov' WHEN 4 THEN '.txt' ELSE '.gz' END AS coverage,
       CASE s_suppkey % 7 WHEN 0 THEN '.fa.gz' WHEN 1 THEN '.fasta' WHEN 2 THEN '.fna.gz' WHEN 3 THEN '.fa' WHEN 4 THEN '.gz' WHEN 5 THEN '.fa.fasta' ELSE '' END AS fasta
FROM supplier
"""


def names_found(spark, sf_dir):
    """Names of samples, releases and genomes in paths made of the suppliers."""
    rows = Projection(spark, sf_dir).sql(NAMES)
    kinds = (("sample", "coverage", sample_of), ("release", "fasta", release_of), ("genome", "fasta", genome_key_of))
    parts = [rows.select(F.lit(kind).alias("kind"), F.concat("stem", column).alias("given")).withColumn("found", f(F.col("given"))) for kind, column, f in kinds]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


class _Said:
    """What the pipeline logs from a level on, while it lasts."""

    def __init__(self, level: int):
        self.level, self.lines, self.handler = level, [], logging.Handler()
        self.handler.emit = lambda record: self.lines.append(record.getMessage()) if record.levelno >= level else None

    def __enter__(self) -> list[str]:
        self.before = pipeline.log.level
        pipeline.log.addHandler(self.handler)
        pipeline.log.setLevel(logging.INFO)
        return self.lines

    def __exit__(self, *_) -> None:
        pipeline.log.removeHandler(self.handler)
        pipeline.log.setLevel(self.before)


def run_warnings(spark, sf_dir):
    """What a run over sites that lack two contigs warns of."""
    m = made(spark, sf_dir)
    sites = m.p.sites().where("contig_key NOT IN ('5', '17')")
    contigs = spark.createDataFrame([(0, "chr1", 1)], "contig_idx long, contig string, length long")
    with _Said(logging.WARNING) as said:
        pipeline.process_files(spark, Reference(sites, contigs, "made"), co.find_files(spark, m.coverage()), MIN_COVERAGE)
    return spark.createDataFrame(list(enumerate(said)), "place int, message string")


def refusal(act, root: str) -> str:
    """What the engine says against ``act``; folders left out."""
    try:
        act()
    except (EngineError, ValueError, FileNotFoundError) as e:
        return re.sub(r"\S*" + re.escape(os.path.basename(root)) + r"\S*", lambda m: m[0].rsplit("/", 1)[-1], f"{type(e).__name__}: {e}")
    return "accepted"


def run_refusals(spark, sf_dir):
    """Runs that have to stop, and that the old outputs are still there."""
    m = made(spark, sf_dir)
    inputs, sites, model = m.coverage(), m.sites(), m.model()
    out, _ = m.run()
    before = sorted(map(os.path.basename, list_files(spark, out)))

    def run(**more):
        return lambda: pipeline.process(spark, pipeline.Config(**{"input_dir": inputs, "output_dir": out, "genome": sites, "annotation_dir": model, "min_coverage": MIN_COVERAGE, **more}))

    def other(name: str, *lines: str) -> str:
        folder = f"{m.root}/{name}"
        m.once(name, lambda: write_named(spark.createDataFrame([(x,) for x in lines], "value string"), f"{folder}/{name}.cov"))
        return folder

    cases = {
        "no threads": run(threads=0),
        "no files": run(input_dir=model),
        "no gene model": run(annotation_dir=inputs),
        "annotation without folder": run(annotation_dir=None),
        "no reference": run(genome=f"{m.root}/absent"),
        "bad line": run(input_dir=other("badline", "chr1\t1\t1\t50\t1\t1", "chr1\t2\t2\t50\t1\t2")),
        "repeated record": run(input_dir=other("repeated", "chr1\t1\t1\t50\t1\t1", "1\t1\t1\t50\t1\t1")),
        "no match": run(input_dir=other("nomatch", "chrZ\t1\t1\t50\t1\t1", "chrA\t1\t1\t50\t1\t1")),
        "nothing covered": run(min_coverage=2_000_000_000),
        "same sample twice": lambda: sample_names(["a/x.cov", "b/x.cov.gz"]),
        "dimensions": lambda: check_dimensions(3, 4),
        "gene model by name": lambda: find_gtf(spark, inputs, "hg19"),
    }
    rows = [(name, refusal(act, m.root)) for name, act in cases.items()]
    kept = sorted(map(os.path.basename, list_files(spark, out))) == before and refusal(lambda: va.validate_store(spark, f"{out}/{pipeline.STORE}"), m.root) == "accepted"
    return spark.createDataFrame([*rows, ("old outputs", "kept" if kept else "lost")], "attempt string, said string")


def store_refusals(spark, sf_dir):
    """Stores that have to be refused, one fault at a time."""
    m = made(spark, sf_dir)
    out, _ = m.run()
    store = f"{out}/{pipeline.STORE}"
    meta = read_metadata(spark, store)
    rows, cells = spark.read.parquet(f"{store}/rowData"), spark.read.parquet(f"{store}/assays")

    def copied(name: str, table: DataFrame):
        """A copy of the store with other cells."""

        def check():
            folder = f"{m.root}/store-{name}"
            table.write.mode("overwrite").partitionBy("sample_idx").parquet(f"{folder}/assays")
            for part in ("rowData", "colData"):
                spark.read.parquet(f"{store}/{part}").write.mode("overwrite").parquet(f"{folder}/{part}")
            spark.read.text(f"{store}/metadata").write.mode("overwrite").text(f"{folder}/metadata")
            va.validate_store(spark, folder)

        return check

    people = lambda *r: lambda: va.check_samples(spark.createDataFrame(list(r), "sample_idx int, sample_id string, sample_name string"))
    cases = {
        "missing table": lambda: va.validate_store(spark, f"{out}/absent"),
        "missing column": lambda: va.check_types(rows.drop("width"), va.ROW_TYPES, "rowData"),
        "wrong type": lambda: va.check_types(cells.withColumn("beta", F.col("beta").cast("double")), va.ASSAY_TYPES, "assays"),
        "good types": lambda: va.check_types(rows, va.ROW_TYPES, "rowData"),
        "blank genome": lambda: va.check_metadata({**meta, "genome": " "}),
        "schema name": lambda: va.check_metadata({**meta, "schema_name": "other"}),
        "schema version": lambda: va.check_metadata({**meta, "schema_version": "0.9"}),
        "flagged as HDF5": lambda: va.check_metadata({**meta, "is_h5": True}),
        "good metadata": lambda: va.check_metadata(meta),
        "duplicate sample": people((0, "a", "a"), (1, "a", "a")),
        "renamed sample": people((0, "a", "b")),
        "blank sample": people((0, " ", " ")),
        "good samples": people((0, "a", "a"), (1, "b", "b")),
        "cells stored twice": copied("twice", cells.unionByName(cells)),
        "cells of no site": copied("nosite", cells.withColumn("cpg_idx", F.col("cpg_idx") + 1)),
        "good store": copied("good", cells),
    }
    return spark.createDataFrame([(name, refusal(act, m.root)) for name, act in cases.items()], "attempt string, said string")


QUERIES = {
    f.__name__: f
    for f in (
        files_discovered, files_read, fasta_sites, fasta_listed_contigs, ron_sites, genome_download, run_cells, run_rows, run_samples, run_coverage_sheet,
        run_annotation_sheet, run_annotation_table, run_log, store_in_sql, matrix_file, array_cells, stream_ingest, stream_totals, names_found, run_warnings, run_refusals, store_refusals,
    )
}


#: What the engine has to say, as users read it.
RUN_REFUSALS = (
    ("no threads", "EngineError: threads must be at least 1"),
    ("no files", "CoverageError: gtf: no coverage files (*.bismark.cov.gz, *.bismark.cov, *.cov.gz, *.cov)"),
    ("no gene model", "AnnotationError: in: no gene model for sites"),
    ("annotation without folder", "AnnotationError: annotation needs a folder with a gene model; or skip it"),
    ("no reference", "ReferenceError_: absent: no reference there; give a FASTA file or a site file"),
    ("bad line", "CoverageError: badline.cov, line 2: methylation percentage 50.0 does not match counts"),
    ("repeated record", "CoverageError: sample repeated: duplicate record at 1:1"),
    ("no match", "CoverageError: sample nomatch: no record matches the reference; its contigs: chrA, chrZ"),
    ("nothing covered", "EngineError: no site is covered in any sample"),
    ("same sample twice", "CoverageError: duplicate sample names: x"),
    ("dimensions", "AnnotationError: annotation has 3 rows, coverage has 4"),
    ("gene model by name", "AnnotationError: in: no gene model for hg19"),
    ("old outputs", "kept"),
)
STORE_REFUSALS = (
    ("missing table", "ValidationError: required table assays is missing"),
    ("missing column", "ValidationError: rowData: required column width is missing"),
    ("wrong type", "ValidationError: assays: column beta is double, not float"),
    ("good types", "accepted"),
    ("blank genome", "ValidationError: metadata: genome is blank"),
    ("schema name", "ValidationError: metadata: schema_name is 'other', not 'strandlake_assays'"),
    ("schema version", "ValidationError: metadata: schema_version is '0.9', not '1.0.0'"),
    ("flagged as HDF5", "ValidationError: metadata: is_h5 is True, not False"),
    ("good metadata", "accepted"),
    ("duplicate sample", "ValidationError: duplicate sample id 'a'"),
    ("renamed sample", "ValidationError: sample 0: id 'a' differs from name 'b'"),
    ("blank sample", "ValidationError: sample 0: bad id ' '"),
    ("good samples", "accepted"),
    ("cells stored twice", "ValidationError: assays: a cell is stored twice"),
    ("cells of no site", "ValidationError: assays: a cell of no site or no sample"),
    ("good store", "accepted"),
)


# --- the same in SQL -------------------------------------------------------

_GENOME = f"""
WITH pieces AS ({PIECES.strip()}),
genome AS (
  SELECT k, CASE WHEN k < 22 THEN concat('chr', CAST(k + 1 AS VARCHAR)) WHEN k = 22 THEN 'chrX' WHEN k = 23 THEN 'chrY' WHEN k = 24 THEN 'chrM' ELSE 'chrUn_alt' END AS contig,
         string_agg(piece, '' ORDER BY doc_id) AS seq FROM pieces GROUP BY k),
hits AS (SELECT k, contig, i FROM (SELECT k, contig, upper(seq) AS s, unnest(range(1, length(seq))) AS i FROM genome) x WHERE substr(s, i, 2) = 'CG')"""


def _values(columns: str, *rows: tuple) -> str:
    cell = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) v({columns})"


def oracles(with_views, assay: tuple[str, ...], annotation: tuple[str, ...], stats: str) -> dict[str, str]:
    """``with_views`` puts the projected tables before a query; ``assay``,
    ``annotation`` and ``stats`` are the catalogue's views."""
    kept = "(SELECT DISTINCT cpg_idx FROM assay)"
    return {
        "files_discovered": with_views(f"SELECT CAST(row_number() OVER (ORDER BY file) - 1 AS INT) AS sample_idx, file, sample_id FROM (SELECT sample_id, {COVERAGE_FILE} AS file FROM samples) x"),
        "files_read": with_views("SELECT sample_idx, sample_id, contig_key, count(*) AS n, CAST(sum(pos0) AS BIGINT) AS starts, CAST(sum(m) AS BIGINT) AS m, CAST(sum(u) AS BIGINT) AS u FROM records JOIN samples USING (sample_id) GROUP BY 1, 2, 3"),
        "fasta_sites": _GENOME + " SELECT row_number() OVER (ORDER BY k, i) - 1 AS cpg_idx, contig AS chr, CASE WHEN contig = 'chrM' THEN 'MT' ELSE substr(contig, 4) END AS contig_key, CAST(i - 1 AS BIGINT) AS start0, CAST(i + 1 AS BIGINT) AS end0, 'made' AS genome FROM hits WHERE k < 25",
        "fasta_listed_contigs": _GENOME + """
            , numbered AS (SELECT *, row_number() OVER (ORDER BY k, i) - 1 AS idx FROM hits WHERE contig IN ('chrUn_alt', 'chrX'))
            SELECT g.k AS contig_idx, g.contig, length(g.seq) AS length, count(*) AS n_sites, min(idx) AS first_idx FROM genome g JOIN numbered USING (k) GROUP BY g.k, g.contig, g.seq""",
        "ron_sites": with_views("SELECT row_number() OVER (ORDER BY cpg_idx) - 1 AS cpg_idx, chr, contig_key, start0, end0, strand, 'made' AS genome FROM sites"),
        "genome_download": _GENOME + r"""
            , t AS (SELECT string_agg(concat('>', contig, ' made ', CAST(k AS VARCHAR), chr(10), regexp_replace(seq, '(.{60})', concat('\1', chr(10)), 'g'), chr(10)), '' ORDER BY k) AS body FROM genome)
            SELECT 'hg19' AS name, md5(body) AS fasta_md5, length(body) AS fasta_bytes, true AS cached, 'ReferenceError_: hg19.fa: size mismatch' AS spoilt,
                   'ReferenceError_: u: digest mismatch' AS wrong, 'hg19,hg38,mm10,mm39' AS known FROM t""",
        "run_cells": with_views("SELECT sample_id, cpg_idx, cov, beta FROM assay JOIN samples USING (sample_idx)", *assay),
        "run_rows": with_views(f"SELECT cpg_idx, chr, chr AS seqnames, start0 + 1 AS start1, end0 AS end1, end0 - start0 AS width, strand FROM sites WHERE cpg_idx IN {kept}", *assay),
        "run_samples": with_views(f"SELECT sample_idx, sample_id, sample_id AS sample_name, 'made' AS genome, (SELECT count(*) FROM sites) AS universe, (SELECT count(*) FROM {kept} x) AS n_sites, CAST((SELECT count(*) FROM samples) AS INT) AS n_samples FROM samples", *assay),
        "run_coverage_sheet": with_views("SELECT 'Coverage' AS sheet, sample_id AS sample, n_total AS total_cpgs, n_covered AS covered_cpgs, " + ", ".join(f'n_ge_{t} AS "{t}x"' for t in THRESHOLDS) + " FROM stats", *assay, stats),
        "run_annotation_sheet": with_views(
            """SELECT 'ChIPseeker_By_Sample' AS sheet, s.sample_id, count(a.cpg_idx) AS covered, r.place, r.region, count(*) FILTER (n.annotation = r.region) AS n,
                      count(*) FILTER (n.annotation = r.region) * 100.0::DOUBLE / count(a.cpg_idx) AS percent
               FROM samples s CROSS JOIN regions r JOIN assay a USING (sample_idx) JOIN annotation n USING (cpg_idx) GROUP BY s.sample_id, r.place, r.region""",
            *assay, *annotation,
            f"""regions AS (
  SELECT region, CAST(row_number() OVER (ORDER BY o, region) - 1 AS INT) AS place FROM (
    SELECT * FROM (VALUES ('Promoter', 1), ('Exon', 2), ('Intron', 3), ('Intergenic', 4)) v(region, o)
    UNION ALL SELECT DISTINCT annotation, 5 FROM annotation WHERE cpg_idx IN {kept} AND annotation NOT IN ('Promoter', 'Exon', 'Intron', 'Intergenic')) x)"""),
        "run_annotation_table": with_views(f"SELECT * EXCLUDE (cpg_idx) FROM annotation WHERE cpg_idx IN {kept}", *assay, *annotation),
        "run_log": with_views(
            """SELECT CAST(row_number() OVER (ORDER BY o, message) - 1 AS INT) AS place, message FROM (
                 SELECT 1 AS o, concat('sample ', sample_id, ': ', CAST(count(*) AS VARCHAR), ' records, ', CAST(count(cpg_idx) AS VARCHAR), ' on a site') AS message FROM aligned GROUP BY sample_id
                 UNION ALL SELECT 2, concat(CAST(count(*) AS VARCHAR), ' sites in the reference') FROM sites
                 UNION ALL SELECT 3, concat(CAST(count(DISTINCT cpg_idx) AS VARCHAR), ' sites are covered in some sample') FROM assay) x""", *assay),
        "store_in_sql": with_views("""
            SELECT contig_key, sample_id, start0 // 20000 AS place, count(*) AS n_sites, CAST(sum(cov) AS BIGINT) AS reads, round(avg(beta), 9) AS mean_beta
            FROM assay JOIN sites USING (cpg_idx) JOIN samples USING (sample_idx) WHERE contig_key IN ('3', '6', '9', '12') GROUP BY contig_key, sample_id, start0 // 20000""", *assay),
        "matrix_file": """
            SELECT layout, sample_id, cpg_idx, CAST(CASE sample_id WHEN 'flag' THEN p_size ELSE p_size % 7 END AS BIGINT) AS cov
            FROM (SELECT p_size, row_number() OVER (ORDER BY p_partkey) - 1 AS cpg_idx FROM part) p, (VALUES ('columns'), ('rows')) l(layout), (VALUES ('flag'), ('status')) s(sample_id)""",
        "array_cells": with_views(
            "SELECT sample_idx, place, cov, beta, (SELECT count(*) FROM places) AS n_sites FROM assay JOIN places USING (cpg_idx)", *assay,
            f"places AS (SELECT cpg_idx, row_number() OVER (ORDER BY cpg_idx) - 1 AS place FROM {kept} x)"),
        "stream_ingest": with_views("SELECT sample_id, cpg_idx, cov, beta FROM assay JOIN samples USING (sample_idx)", *assay),
        "stream_totals": with_views(f"""
            SELECT sample_id, {COVERAGE_FILE} AS file, count(*) AS records, CAST(sum(m) AS BIGINT) AS methylated, CAST(sum(u) AS BIGINT) AS unmethylated,
                   sample_id = (SELECT min(sample_id) FROM records) AS again FROM records GROUP BY sample_id"""),
        "names_found": f"""
            WITH n AS ({NAMES}), g AS (SELECT 'sample' AS kind, concat(stem, coverage) AS given FROM n UNION ALL SELECT k, concat(stem, fasta) FROM n, (VALUES ('release'), ('genome')) v(k)),
            b AS (SELECT *, regexp_replace(given, '^.*/', '') AS name FROM g)
            SELECT kind, given, CASE kind WHEN 'sample' THEN regexp_replace(name, '(\\.bismark)?\\.cov(\\.gz)?$', '') WHEN 'release' THEN regexp_replace(regexp_replace(name, '\\.gz$', ''), '\\.(fasta|fna|fa)$', '')
                   ELSE CASE WHEN contains(lower(name), 'hg19') THEN 'hg19' ELSE lower(name) END END AS found FROM b""",
        "run_warnings": with_views(
            """SELECT CAST(row_number() OVER (ORDER BY sample_id) - 1 AS INT) AS place, concat('sample ', sample_id, ': no record of these contigs is on a site: ', string_agg(chr, ', ' ORDER BY chr)) AS message
               FROM (SELECT DISTINCT sample_id, concat('chr', contig_key) AS chr FROM records WHERE contig_key IN ('5', '17')) x GROUP BY sample_id"""),
        "run_refusals": _values("attempt, said", *RUN_REFUSALS),
        "store_refusals": _values("attempt, said", *STORE_REFUSALS),
    }
