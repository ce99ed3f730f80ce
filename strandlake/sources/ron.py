"""Site files in RON, for exchange with other tools. The driver reads and
writes them as streams; Parquet is the native form."""

from __future__ import annotations

import io
import json
import re
from collections import deque

import pyarrow as pa
from pyarrow import parquet
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..contracts import Reference, ReferenceError_
from ..functions.columns import canonical_contig
from ..sinks.files import disk_of, input_text, local_path, output_file, scratch_path

_TOKEN = re.compile(r"""(?:\s|//[^\n]*(?:\n|$))*(?:("(?:[^"\\]|\\.)*")|('(?:[^'\\]|\\.)')|(-?[0-9][0-9_.eE+-]*)|([A-Za-z_][A-Za-z0-9_]*)|([()\[\]{}:,]))""")
_BLANK = re.compile(r"(?:\s|//[^\n]*(?:\n|$))*$")
CHUNK, SLICE = 1 << 20, 200_000


def _tokens(read):
    """(kind, text) of what ``read`` gives piece by piece; (0, "") at the end.
    A token at the end of what is at hand may go on, so more is read first."""
    held, at, more = read(CHUNK), 0, True
    while True:
        m = _TOKEN.match(held, at)
        if more and (m is None or m.end() >= len(held)):
            piece = read(CHUNK)
            held, at, more = held[at:] + piece, 0, bool(piece)
            continue
        if m is None:
            if not _BLANK.match(held, at):
                raise ReferenceError_(f"RON: cannot read {held[at : at + 20]!r}")
            break
        at = m.end()
        yield m.lastindex, m.group(m.lastindex)
    while True:
        yield 0, ""


class _Parser:
    """Values from a stream of tokens, of which a few are looked at ahead."""

    def __init__(self, read):
        self.tokens = _tokens(read)
        self.ahead: deque = deque()

    def peek(self, ahead: int = 0):
        while len(self.ahead) <= ahead:
            self.ahead.append(next(self.tokens))
        return self.ahead[ahead]

    def take(self, symbol: str | None = None):
        kind, value = self.peek()
        if symbol is not None and value != symbol:
            raise ReferenceError_(f"RON: expected {symbol!r}, found {value or 'the end'!r}")
        self.ahead.popleft()
        return kind, value

    def value(self):
        kind, value = self.peek()
        if kind == 0:
            raise ReferenceError_("RON: the text ends too early")
        if kind == 4 and self.peek(1)[1] == "(":
            self.take()
            kind, value = self.peek()
        if value == "(":
            return self.struct()
        if value == "[":
            return self.items("[", "]")
        self.take()
        if kind == 1:
            return json.loads(value)
        if kind == 2:
            return value[1:-1]
        if kind == 3:
            return float(value) if "." in value else int(value.replace("_", ""))
        return {"true": True, "false": False}.get(value, value)

    def each(self, opening: str, closing: str):
        """The values of a list, one at a time."""
        self.take(opening)
        while self.peek()[1] != closing:
            yield self.value()
            if self.peek()[1] == ",":
                self.take()
        self.take(closing)

    def items(self, opening: str, closing: str) -> list:
        return list(self.each(opening, closing))

    def fields(self):
        """The names of a struct; the caller takes the value after each."""
        if self.peek()[0] == 4:
            self.take()
        self.take("(")
        while self.peek()[1] != ")":
            name = self.take()[1]
            self.take(":")
            yield name
            if self.peek()[1] == ",":
                self.take()
        self.take(")")

    def struct(self):
        if self.peek(1)[0] != 4 or self.peek(2)[1] != ":":
            return self.items("(", ")")
        return {name: self.value() for name in self.fields()}


def parse_ron(text: str):
    return _Parser(io.StringIO(text).read).value()


def _row(value, names: tuple[str, ...]) -> tuple:
    return tuple(value[n] for n in names) if isinstance(value, dict) else tuple(value)


def read_sites(spark: SparkSession, path: str) -> Reference:
    """Sites go to a Parquet table in slices as they are read, so the driver
    holds one slice."""
    folder = scratch_path(spark, "sites")
    disk_of(folder, spark).make(local_path(folder) or folder)
    schema = pa.schema([("cpg_idx", pa.int64()), ("chr", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("strand", pa.string())])
    contigs, release, seen = [], "unknown", None

    def write(rows: list[tuple], first: int) -> None:
        columns = [range(first, first + len(rows)), *zip(*rows)] if rows else [[]] * 5
        with output_file(f"{folder}/part-{first:012d}.parquet", spark) as out:
            parquet.write_table(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema), out)

    with input_text(path, spark) as f:
        parser = _Parser(f.read)
        if parser.peek()[0] not in (0, 4) and parser.peek()[1] != "(":
            raise ReferenceError_(f"{path}: not a site file")
        for name in parser.fields():
            if name == "cpgs":
                seen, rows = 0, []
                for value in parser.each("[", "]"):
                    rows.append(_row(value, ("chr", "start", "end", "strand")))
                    if len(rows) == SLICE:
                        write(rows, seen)
                        seen, rows = seen + len(rows), []
                write(rows, seen)
            elif name == "contig_lens":
                contigs = [(i, *_row(v, ("contig", "length"))) for i, v in enumerate(parser.each("[", "]"))]
            elif name == "release_name":
                release = parser.value()
            else:
                parser.value()
    if seen is None:
        raise ReferenceError_(f"{path}: not a site file")
    table = spark.read.schema("cpg_idx long, chr string, start long, end long, strand string").parquet(folder).withColumn("contig_key", canonical_contig(F.col("chr")))
    return Reference(table.select("cpg_idx", "chr", "contig_key", "start", "end", "strand"), spark.createDataFrame(contigs, "contig_idx long, contig string, length long"), release)


def write_sites(reference: Reference, path: str) -> None:
    quote = lambda s: json.dumps(s, ensure_ascii=False)
    with output_file(path, reference.sites.sparkSession) as out, io.TextIOWrapper(out, "utf-8", newline="") as f:
        f.write("(\n    cpgs: [\n")
        for r in reference.sites.orderBy("cpg_idx").toLocalIterator():
            f.write(f"        (\n            chr: {quote(r['chr'])},\n            start: {r['start']},\n            end: {r['end']},\n            strand: '{r['strand']}',\n        ),\n")
        f.write("    ],\n    contig_lens: [\n")
        for r in reference.contigs.orderBy("contig_idx").toLocalIterator():
            f.write(f"        (\n            contig: {quote(r['contig'])},\n            length: {r['length']},\n        ),\n")
        f.write(f"    ],\n    release_name: {quote(reference.release_name)},\n)\n")
