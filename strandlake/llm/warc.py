"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames of about ``FRAME_BYTES``; each frame is
compressed on its own, and a skippable frame at the end of the file lists the
compressed and plain size of every frame (the public seekable format: magic
0x184D2A5E, entries of two u32, frame count u32, descriptor u8, magic
0x8F92EAB1). The writer returns an index row per record: file, place and size
of its frame, and the record's offset and length inside the plain frame, so one
record is read by one ranged read and one decompression.

Payloads stay where the scan finds them: only their digests are shuffled, and
each task looks up which of its own rows are revisits, and of what.

Of records with equal payloads (by SHA-1, size at least ``min_bytes``) the one
with the smallest page id, nulls last, ties by place in the input, is written
as a response; the others become revisits that name it. Null payloads are
empty. Repeated rows are records of their own. A payload of any length is one
record; a frame holds whole records and so may exceed its usual size. An empty
table makes no file and reads back as an empty table. Columns other than id,
url and payload aren't read, whatever their names.

Writers name files by attempt, and only files that a finished task reports are
in the index, so tasks may run again anywhere.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, by_block, discard, drop_path, materialize, shared_fs, small_batches, stable, with_own_block, with_row_id

FRAME_BYTES = 256 << 10
FILE_BYTES = 64 << 20
READ_TASKS = 10_000
TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A5E, 0x8F92EAB1
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

INDEX_SCHEMA = "file string, record_id string, frame_start long, frame_size long, record_start long, record_size long"


def digest_of(payload: bytes) -> str:
    """SHA-1 as bare upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page: int | None, row: int) -> str:
    return f"urn:page:{'' if page is None else page}:{row}"


def record_bytes(page: int | None, row: int, url: str | None, payload: bytes, first: tuple[int | None, int] | None) -> bytes:
    """One WARC/1.1 record: a response, or a revisit of ``first`` (page, row)."""
    head = {
        "WARC-Type": "response" if first is None else "revisit",
        "WARC-Record-ID": f"<{record_name(page, row)}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": " ".join((url or "").split()),
        "WARC-Payload-Digest": f"sha1:{digest_of(payload)}",
        "Content-Type": "application/http; msgtype=response",
    }
    block = _HTTP
    if first is None:
        block = _HTTP + payload
    else:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["WARC-Refers-To"] = f"<{record_name(*first)}>"
        head["X-Payload-Length"] = str(len(payload))
    head["Content-Length"] = str(len(block))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at ``at``, and where the next begins."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) for x in lines[1:])
    start = end + 4
    stop = start + int(head["Content-Length"])
    return head, data[start:stop], stop + 4


class BundleWriter:
    """One seekable bundle; remembers where each record went."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = 3):
        import zstandard

        self.out, self.frame_bytes = out, frame_bytes
        self.press = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.held: list[tuple[str, bytes]] = []
        self.size = self.at = 0
        self.frames: list[tuple[int, int]] = []
        self.index: list[tuple[str, int, int, int, int]] = []

    def add(self, name: str, record: bytes) -> None:
        self.held.append((name, record))
        self.size += len(record)
        if self.size >= self.frame_bytes:
            self._flush()

    def _flush(self) -> None:
        if not self.held:
            return
        frame = self.press.compress(b"".join(r for _, r in self.held))
        self.out.write(frame)
        place = 0
        for name, record in self.held:
            self.index.append((name, self.at, len(frame), place, len(record)))
            place += len(record)
        self.frames.append((len(frame), place))
        self.at += len(frame)
        self.held, self.size = [], 0

    def close(self) -> None:
        self._flush()
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.out.close()


def seek_table(f, size: int) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame of an open bundle."""
    f.seek(size - 9)
    frames, descriptor, magic = struct.unpack("<IBI", f.read(9))
    if magic != FOOTER_MAGIC or descriptor:
        raise ValueError("not a seekable bundle")
    f.seek(size - 9 - 8 * frames)
    sizes = struct.iter_unpack("<II", f.read(8 * frames))
    out, at = [], 0
    for packed, plain in sizes:
        out.append((at, packed, plain))
        at += packed
    return out


def read_one(file: str, frame_start: int, frame_size: int, record_start: int, record_size: int) -> tuple[dict[str, str], bytes]:
    """Random access: a record by its index row."""
    import zstandard

    fs, path = shared_fs(file)
    with fs.open_input_file(path) as f:
        f.seek(frame_start)
        plain = zstandard.ZstdDecompressor().decompress(f.read(frame_size))
    head, block, _ = parse_record(plain[record_start : record_start + record_size])
    return head, block


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` to bundles under ``path``; returns the record index."""
    small_batches(pages.sparkSession, 500)
    numbered = with_row_id(stable(pages))
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = numbered.select(F.col(id_col).cast("long").alias("page"), F.col(url).cast("string").alias("url"), body.alias("body"), ROW)
    digests = materialize(rows.where(F.octet_length("body") >= min_bytes).select("page", ROW, F.sha1("body").alias("sha")), "digests")
    first = digests.groupBy("sha").agg(F.min(F.struct(F.col("page").isNull().alias("absent"), "page", ROW)).alias("first"))
    first = materialize(first.select("sha", F.col("first.page").alias("first_page"), F.col(f"first.{ROW}").alias("first_row")), "first")
    # both sides are plain scans, so adaptive execution may split a hot payload
    again = digests.join(first, "sha").where(F.col(ROW) != F.col("first_row")).select(ROW, "first_page", "first_row")
    revisits = by_block(again, numbered, "revisits")
    fs, root = shared_fs(path)
    fs.create_dir(root, recursive=True)
    uri = path.rstrip("/")

    def run(batches):
        fs, root = shared_fs(uri)

        def report(name, writer):
            writer.close()
            cols = list(zip(*writer.index))
            return pa.RecordBatch.from_arrays([pa.array([f"{uri}/{name}"] * len(cols[0])), pa.array(cols[0]), *(pa.array(c, pa.int64()) for c in cols[1:])], names=["file", "record_id", "frame_start", "frame_size", "record_start", "record_size"])

        writer, name, known, seen = None, "", None, {}
        for batch, table in with_own_block(batches, revisits, [ROW, "first_page", "first_row"]):
            if table is not known:
                known, seen = table, dict(zip(table.column(0).to_pylist(), zip(table.column(1).to_pylist(), table.column(2).to_pylist())))
            for page, link, data, row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if writer is None:
                    name = f"part-{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(fs.open_output_stream(f"{root}/{name}", compression=None))
                writer.add(record_name(page, row), record_bytes(page, row, link, data, seen.get(row)))
                if writer.at >= file_bytes:
                    yield report(name, writer)
                    writer = None
        if writer is not None:
            yield report(name, writer)

    index = materialize(rows.mapInArrow(run, INDEX_SCHEMA), "warc-index")
    for table in (digests, first):
        discard(table)
    drop_path(pages.sparkSession, revisits.path)
    return index


def read_warc(index: DataFrame) -> DataFrame:
    """Read every record of the bundles in ``index`` through their seek tables:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to, url``."""
    files = index.select("file").distinct()
    # by range of their names: one file a task, or several where there are very many
    files = files.repartitionByRange(max(1, min(files.count(), READ_TASKS)), "file")

    def number(name: str) -> int | None:
        page = name.strip("<>").split(":")[2]
        return int(page) if page else None

    def run(batches):
        import zstandard

        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for file in batch.column(0).to_pylist():
                fs, path = shared_fs(file)
                with fs.open_input_file(path) as f:
                    for start, packed, plain in seek_table(f, f.size()):
                        f.seek(start)
                        data = opener.decompress(f.read(packed), max_output_size=plain)
                        out, at = [], 0
                        while at < len(data):
                            head, block, at = parse_record(data, at)
                            if head["WARC-Type"] == "response":
                                payload = block[len(_HTTP) :]
                                size, digest, refers = len(payload), digest_of(payload), None
                                if head["WARC-Payload-Digest"] != f"sha1:{digest}":
                                    raise ValueError(f"{file}: digest of {head['WARC-Record-ID']} does not fit")
                            else:
                                size, digest, refers = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"][5:], number(head["WARC-Refers-To"])
                            out.append((number(head["WARC-Record-ID"]), size, digest, head["WARC-Type"], refers, head["WARC-Target-URI"]))
                        cols = list(zip(*out))
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()))], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"])

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    return files.mapInArrow(run, schema)
