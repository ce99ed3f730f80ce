"""The engine's entry points: process, extract sites, coverage report."""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import AnnotationError, EngineError, MethylationSet, Reference
from ..operators.align import align, check_sites, check_totals, contig_totals, lost_contigs, sample_totals
from ..operators.annotate import annotate
from ..operators.assay import build_assay, out_of_reach
from ..operators.filters import remove_uncovered
from ..operators.genes import features, transcripts
from ..operators.stats import coverage_stats
from ..operators.summary import annotation_counts, annotation_report, check_dimensions, report_regions
from ..operators.validate import check_layout, validate_store
from ..sinks.files import discard, local_path, written
from ..sinks.publish import AtomicOutputs
from ..sinks.report import write_annotation_parts, write_annotation_tsv, write_annotation_xlsx, write_coverage_xlsx
from ..sinks.store import read_store, write_store
from ..sources.coverage import find_files, read_coverage
from ..sources.fasta import extract_sites
from ..sources.gtf import find_gtf, read_gtf
from ..sources.reference import resolve_reference, save_reference
from ..sources.ron import write_sites

log = logging.getLogger(__name__)

STORE, COVERAGE, ANNOTATION, TABLE = "assays.store", "coverage_report.xlsx", "annotation_report.xlsx", "annotation.tsv.gz"


@dataclass
class Config:
    """A run: where inputs and outputs lie, and what to keep. With
    ``table_parts`` the annotation table is a folder of sorted parts, written by
    many tasks, instead of one file; the size of the genome doesn't decide."""

    input_dir: str
    output_dir: str
    genome: str
    threads: int = 8
    min_coverage: int = 1
    remove_uncovered: bool = True
    annotation_dir: str | None = None
    skip_annotation: bool = False
    table_parts: bool = False


def process_files(spark: SparkSession, reference: Reference, paths: list[str], min_coverage: int = 1, drop_uncovered: bool = True) -> MethylationSet:
    """Files to assays. Strands merge first, then the coverage mask, then the
    row filter. Where no site can reach the minimum, records are aligned for the
    checks and the log alone, and neither they nor cells are written."""
    if not paths:
        raise EngineError("no coverage files")
    check_sites(reference.sites)
    found, samples = read_coverage(spark, paths)
    hopeless = drop_uncovered and out_of_reach(found, min_coverage)
    aligned = align(found, reference.sites).select("sample_idx", "chr", "cpg_idx", "methylated", "unmethylated")
    if not hopeless:
        aligned = written(aligned, "aligned")  # the one shuffle of all records
    contigs = written(contig_totals(aligned, "sample_idx").join(F.broadcast(samples), "sample_idx"), "contigs")  # samples: one row per file
    discard(found)
    totals = sample_totals(contigs).orderBy("sample_id").collect()  # one row per file
    check_totals(contigs, totals)
    for t in totals:
        log.info("sample %s: %d records, %d on a site", t["sample_id"], t["n_records"], t["n_matched"])
    for lost in lost_contigs(contigs).orderBy("sample_id").toLocalIterator():  # one row per file
        log.warning("sample %s: no record of these contigs is on a site: %s", lost["sample_id"], ", ".join(lost["contigs"]))
    discard(contigs)
    rows = reference.sites
    universe = rows.count()
    if not hopeless:
        assay = written(build_assay(aligned, min_coverage), "assay")
        discard(aligned)
    log.info("%d sites in the reference", universe)
    if hopeless:
        raise EngineError("no site is covered in any sample")
    if drop_uncovered:
        rows = written(remove_uncovered(rows, assay), "rows")
        kept = rows.count()
        if not kept:
            raise EngineError("no site is covered in any sample")
        log.info("%d sites are covered in some sample", kept)
    return MethylationSet(rows, samples, assay, reference.release_name, universe)


def annotate_set(spark: SparkSession, data: MethylationSet, gtf: str, sites: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Annotation of the kept sites, and the report per sample."""
    models = written(transcripts(read_gtf(spark, gtf)), "models")
    if models.isEmpty():
        raise AnnotationError(f"{gtf}: no usable transcript")
    result = written(annotate(sites, models, features(models)), "annotation")
    discard(models)
    check_dimensions(result.count(), data.row_data.count())
    return result, annotation_report(annotation_counts(data.assay, result, data.col_data), data.col_data, report_regions(result))


def process(spark: SparkSession, config: Config) -> MethylationSet:
    """Everything that can fail comes before publication, so a failure leaves
    the old outputs as they are."""
    if config.threads < 1:
        raise EngineError("threads must be at least 1")
    reference = resolve_reference(spark, config.genome)
    paths = find_files(spark, config.input_dir)
    gtf = None
    if not config.skip_annotation:
        if not config.annotation_dir:
            raise AnnotationError("annotation needs a folder with a gene model; or skip it")
        gtf = find_gtf(spark, config.annotation_dir, config.genome)
    data = process_files(spark, reference, paths, config.min_coverage, config.remove_uncovered)
    stats = coverage_stats(data.assay, data.col_data, data.row_data.count())
    with AtomicOutputs(config.output_dir, spark) as out:
        write_store(data, out.stage(STORE))
        validate_store(spark, f"{out.staging}/{STORE}")
        check_layout(spark, f"{out.staging}/{STORE}")
        write_coverage_xlsx(stats, out.stage(COVERAGE))
        if gtf:
            annotation, report = annotate_set(spark, data, gtf, data.row_data)
            write_annotation_xlsx(report, out.stage(ANNOTATION))
            if config.table_parts:
                write_annotation_parts(annotation, out.stage(TABLE))
            else:
                write_annotation_tsv(annotation, out.stage(TABLE))
        else:
            out.remove(ANNOTATION)
            out.remove(TABLE)
        out.publish()
    return data


def _folder(path: str) -> str:
    own = local_path(path)
    return path.rsplit("/", 1)[0] if own is None else os.path.dirname(os.path.abspath(own))


def extract_cpgs(spark: SparkSession, fasta: str, output: str, contigs: list[str] | None = None) -> Reference:
    """Sites of a FASTA file, saved as RON (by suffix) or as a site folder."""
    reference = extract_sites(spark, fasta, contigs)
    if output.lower().endswith(".ron"):
        with AtomicOutputs(_folder(output), spark) as out:
            write_sites(reference, out.stage(os.path.basename(output)))
            out.publish()
    else:
        save_reference(reference, output)
    return reference


def qc_report(spark: SparkSession, store: str, output: str) -> DataFrame:
    """The coverage workbook of a finished store."""
    data = read_store(spark, store)
    stats = coverage_stats(data.assay, data.col_data, data.row_data.count())
    with AtomicOutputs(_folder(output), spark) as out:
        write_coverage_xlsx(stats, out.stage(os.path.basename(output)))
        out.publish()
    return stats
