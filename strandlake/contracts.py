"""Constants, schemas and errors that the whole engine agrees on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

U32_MAX = 4_294_967_295
I32_MAX = 2_147_483_647
PROMOTER_REACH = 3000
DOWNSTREAM_REACH = 3000
BIN_BITS = 16
PERCENT_TOLERANCE = 0.01

#: Coverage thresholds of the statistics and of the coverage report.
THRESHOLDS = (1, 2, 3, 4, 5, 10)

#: Gene regions by rank: the first that a site lies in wins.
REGIONS = ("Promoter", "5' UTR", "3' UTR", "Exon", "Intron", "Downstream", "Intergenic")
PRIORITY = {name: rank for rank, name in enumerate(REGIONS, 1)}
REPORT_REGIONS = ("Promoter", "Exon", "Intron", "Intergenic")

STANDARD_CONTIGS = (*map(str, range(1, 23)), "X", "Y", "M", "MT")

COVERAGE_SUFFIXES = (".bismark.cov.gz", ".bismark.cov", ".cov.gz", ".cov")
FASTA_SUFFIXES = (".fasta", ".fna", ".fa")
GENOME_KEYS = ("hg19", "hg38", "mm10", "mm39")

STORE_SCHEMA_NAME = "strandlake_assays"
STORE_SCHEMA_VERSION = "1.0.0"

SITE_SCHEMA = "cpg_idx long, chr string, contig_key string, start long, end long, strand string"
CONTIG_SCHEMA = "contig_idx int, contig string, length long"
RECORD_SCHEMA = "sample_id string, chr string, contig_key string, start long, methylated long, unmethylated long"
ASSAY_SCHEMA = "cpg_idx long, sample_idx int, cov long, beta float"

ANNOTATION_COLUMNS = ("chr", "start_1based", "end_1based", "strand", "annotation", "gene_id", "gene_symbol", "transcript_id", "distance_to_tss", "exon_intron_rank")


class EngineError(ValueError):
    """Anything that stops a run before it publishes."""


class CoverageError(EngineError):
    """A coverage file that breaks its contract."""


class ReferenceError_(EngineError):
    """A reference genome or site file that can't be used."""


class AnnotationError(EngineError):
    """A gene model that is missing or ambiguous."""


class ValidationError(EngineError):
    """A store that breaks its schema."""


@dataclass
class Reference:
    """The site universe of a genome release."""

    sites: DataFrame
    contigs: DataFrame
    release_name: str


@dataclass
class MethylationSet:
    """Sites, samples and the covered cells of a run. Cells that are not there
    have coverage 0 and no beta."""

    row_data: DataFrame
    col_data: DataFrame
    assay: DataFrame
    genome: str
    universe: int
