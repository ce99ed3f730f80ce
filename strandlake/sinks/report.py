"""Reports: coverage and annotation workbooks, and the annotation table."""

from __future__ import annotations

import gzip
import os
import zipfile
from collections.abc import Iterable
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import ANNOTATION_COLUMNS, THRESHOLDS
from ..functions.columns import tsv_field
from .files import Remote, join_files, list_files, output_file, scratch_path

COVERAGE_HEADERS = ("Sample", "Total CpGs", "Covered CpGs", *(f"{t}X" for t in THRESHOLDS))


def coverage_report(stats: DataFrame) -> DataFrame:
    """The columns of the coverage workbook; the mean stays in the statistics."""
    return stats.select(F.col("sample_id").alias("Sample"), F.col("n_total").alias("Total CpGs"), F.col("n_covered").alias("Covered CpGs"), *[F.col(f"n_ge_{t}").alias(f"{t}X") for t in THRESHOLDS])


def _cell(ref: str, value) -> str:
    if value is None:
        return ""
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return f'<c r="{ref}"><v>{value}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def _column(i: int) -> str:
    name = ""
    i += 1
    while i:
        i, rest = divmod(i - 1, 26)
        name = chr(65 + rest) + name
    return name


def write_xlsx(path: str, sheet: str, header: Iterable[str], rows: Iterable[Iterable]) -> None:
    """A plain one-sheet workbook, from the standard library alone."""
    lines = []
    for r, row in enumerate([tuple(header), *map(tuple, rows)], 1):
        lines.append(f'<row r="{r}">' + "".join(_cell(f"{_column(c)}{r}", v) for c, v in enumerate(row)) + "</row>")
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    files = {
        "[Content_Types].xml": f'{head}<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
        "_rels/.rels": f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'{head}<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{escape(sheet[:31])}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'{head}<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
    }
    with output_file(path) as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in files.items():
            z.writestr(name, body)


def write_coverage_xlsx(stats: DataFrame, path: str) -> None:
    """One row per sample; samples are as many as input files."""
    write_xlsx(path, "Coverage", COVERAGE_HEADERS, (tuple(r) for r in coverage_report(stats).orderBy("Sample").toLocalIterator()))


def write_annotation_xlsx(report: DataFrame, path: str) -> None:
    """The sheet's name is fixed: tools open it by that."""
    write_xlsx(path, "ChIPseeker_By_Sample", report.columns, (tuple(r) for r in report.orderBy("sample").toLocalIterator()))


def annotation_table(annotation: DataFrame) -> DataFrame:
    """The ten columns of the table, fit for tab-separated text."""
    kinds = dict(annotation.dtypes)
    return annotation.select("cpg_idx", *[(tsv_field(F.col(c)) if kinds[c] == "string" else F.col(c)).alias(c) for c in ANNOTATION_COLUMNS])


def _table_lines(annotation: DataFrame) -> DataFrame:
    """The lines of the table, range by range in site order."""
    rows = annotation_table(annotation).repartitionByRange("cpg_idx").sortWithinPartitions("cpg_idx")
    return rows.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in ANNOTATION_COLUMNS]).alias("value"))


def write_annotation_tsv(annotation: DataFrame, path: str) -> None:
    """One gzip file in site order. Tasks format and compress its lines, a gzip
    member each; the driver copies their bytes behind one another."""
    spark = annotation.sparkSession
    held = scratch_path(spark, "table")
    _table_lines(annotation).write.option("compression", "gzip").text(held)
    parts = [p for p in list_files(spark, held) if os.path.basename(p).startswith("part-")]
    join_files(spark, parts, path, gzip.compress(("\t".join(ANNOTATION_COLUMNS) + "\n").encode(), mtime=0))
    Remote(spark, held).remove(held)


def write_annotation_parts(annotation: DataFrame, path: str) -> None:
    """The same table as sorted compressed part files, each with the header."""
    rows = annotation_table(annotation).repartitionByRange("cpg_idx").sortWithinPartitions("cpg_idx").drop("cpg_idx")
    rows.write.csv(path, sep="\t", header=True, compression="gzip", quote="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_bedgraph(table: DataFrame, path: str) -> None:
    table.repartitionByRange("chr", "start").sortWithinPartitions("chr", "start").select("chr", "start", "end", "value").write.csv(path, sep="\t", compression="gzip")
