"""Token ids in binary files: frequency ranks in byte-aligned variable lengths.

Ids are replaced by their rank in the whole corpus (most frequent: 0) and each
rank takes one to four bytes. Two bits of a control byte give the length of one
id, so four ids share a control byte, and control bytes lie apart from the
data. Encoding and decoding are numpy table lookups.

A file holds consecutive documents in ascending id order (nulls first):

    magic  8 bytes "SLTOKEN1"
    block* 4 little-endian u64 (documents, ids, control bytes, data bytes),
           document ids as i64, null flags as u8, id counts as u64, controls, data
    footer u64 offset of each block, u64 number of blocks, magic

The rank table is a file of its own (u32 ids by rank). A block holds whole
documents, about ``BLOCK_IDS`` ids (a longer document makes a block alone); a
file holds whole blocks and ends once it has ``FILE_BYTES``.

Null texts hold the end id alone. Repeated rows are written once each; null
document ids are flagged. Texts of one id stand in the order of a hash of their
ids. Texts of any length are encoded whole. An empty table makes no file but
the rank table and reads back as an empty table. Columns other than id and text
aren't read, whatever their names. Writers name files by attempt and only a
finished task's files reach the manifest, so a task may run again anywhere.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, fresh_path, materialize, shared_fs, small_batches
from .tokens import default_vocabulary, encoder_for

MAGIC = b"SLTOKEN1"
BLOCK_IDS = 1 << 20
FILE_BYTES = 64 << 20
END_ID = 2
READ_TASKS = 10_000

#: For each control byte, the lengths of its four ids.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    values = ranks.astype("<u4")
    size = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = size - 1
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    ends = np.cumsum(size, dtype=np.int64)
    begin = ends - size
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    data[begin] = values.view(np.uint8)[0::4]
    for k in range(1, int(size.max(initial=0))):
        long = np.flatnonzero(size > k)
        data[begin[long] + k] = values[long] >> 8 * k & 0xFF
    return control.tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers that ``encode_ranks`` was given."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    raw = np.frombuffer(data, np.uint8)
    begin = np.cumsum(size, dtype=np.int64) - size
    out = raw[begin].astype("<u4")
    for k in range(1, int(size.max(initial=0))):
        long = np.flatnonzero(size > k)
        out[long] |= raw[begin[long] + k].astype("<u4") << 8 * k
    return out


def rank_table(counts: np.ndarray) -> np.ndarray:
    """Ids by falling count; ties by id."""
    return np.lexsort((np.arange(len(counts)), -counts)).astype(np.uint32)


def _tokenize(docs: DataFrame, id_col: str, text: str, vocabulary: str, end_id: int) -> DataFrame:
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text).cast("string").alias("body"))

    def run(batches):
        encoder, end = encoder_for(vocabulary), end_id.to_bytes(2, "little")
        for batch in batches:
            ids = [x + end for x in encoder.encode(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc", "ids"])

    return slim.mapInArrow(run, "doc long, ids binary")


def _count(tokens: DataFrame, size: int) -> np.ndarray:
    """Occurrences of each id in the corpus: one number per vocabulary entry
    reaches the driver."""
    wide = 1024

    def run(batches):
        total = np.zeros(-(-size // wide) * wide, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u2"), minlength=len(total))
        parts = total.reshape(-1, wide)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "counts"])

    def add(key, table):
        total = sum(np.frombuffer(x, "<i8") for x in table.column("counts").to_pylist())
        return pa.table({"part": [key[0].as_py()], "counts": [total.tobytes()]}, schema=pa.schema([("part", pa.int32()), ("counts", pa.binary())]))

    partial = tokens.select("ids").mapInArrow(run, "part int, counts binary")
    rows = partial.groupBy("part").applyInArrow(add, "part int, counts binary").collect()
    counts = np.zeros(-(-size // wide) * wide, np.int64)
    for row in rows:
        counts[row["part"] * wide : (row["part"] + 1) * wide] = np.frombuffer(row["counts"], "<i8")
    return counts[:size]


def _write_block(out, docs: list, bodies: list[bytes], rank: np.ndarray) -> int:
    ids = np.frombuffer(b"".join(bodies), "<u2")
    control, data = encode_ranks(rank[ids])
    sizes = np.array([len(b) // 2 for b in bodies], "<u8")
    body = b"".join((struct.pack("<4Q", len(docs), len(ids), len(control), len(data)), np.array([0 if d is None else d for d in docs], "<i8").tobytes(), bytes(d is None for d in docs), sizes.tobytes(), control, data))
    out.write(body)
    return len(body)


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", vocabulary: str | None = None, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Tokenise ``docs`` and write them to files under ``path``. Returns the
    manifest: ``file, first_doc, documents, n_ids`` (files in order of
    ``number`` and ``part``)."""
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    tokens = materialize(_tokenize(docs, id_col, text, vocabulary, end_id), "tokens")
    table = rank_table(_count(tokens, 65_536))
    rank = np.empty(65_536, np.uint32)
    rank[table] = np.arange(65_536, dtype=np.uint32)
    fs, root = shared_fs(path)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/ranks.u32", compression=None) as out:
        out.write(table.astype("<u4").tobytes())

    def run(batches):
        fs, root = shared_fs(path)
        names = ["file", "number", "part", "first_doc", "documents", "n_ids"]
        out = name = first = None
        docs, bodies, offsets = [], [], []
        held = count = total = at = part = 0

        def end_block():
            nonlocal docs, bodies, held, at
            offsets.append(at)
            at += _write_block(out, docs, bodies, rank)
            docs, bodies, held = [], [], 0

        def end_file(number):
            nonlocal out, offsets, count, total, part
            out.write(np.array([*offsets, len(offsets)], "<u8").tobytes() + MAGIC)
            out.close()
            done = pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((name, pa.string()), (number, pa.int32()), (part, pa.int32()), (first, pa.int64()), (count, pa.int64()), (total, pa.int64()))], names=names)
            out, offsets, count, total, part = None, [], 0, 0, part + 1
            return done

        number = None
        for batch in batches:
            for doc, body, number in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if bodies and held + len(body) // 2 > BLOCK_IDS:
                    end_block()
                    if at >= file_bytes:
                        yield end_file(number)
                if out is None:
                    name, first, at = f"{root}/part-{uuid.uuid4().hex}.tok", doc, len(MAGIC)
                    out = fs.open_output_stream(name, compression=None)
                    out.write(MAGIC)
                docs.append(doc)
                bodies.append(body)
                held += len(body) // 2
                count, total = count + 1, total + len(body) // 2
        if out is not None:
            end_block()
            yield end_file(number)

    ordered = tokens.withColumn("tie", F.xxhash64("ids")).repartitionByRange("doc", "tie").sortWithinPartitions("doc", "tie").select("doc", "ids", F.spark_partition_id().alias("number"))
    manifest = materialize(ordered.mapInArrow(run, "file string, number int, part int, first_doc long, documents long, n_ids long"), "manifest")
    discard(tokens)
    return manifest


def read_block(raw: bytes, table: np.ndarray):
    """``(doc, ids)`` of each document of one block."""
    n, total, controls, data = struct.unpack_from("<4Q", raw)
    at = 32
    docs = np.frombuffer(raw, "<i8", n, at).tolist()
    nulls = raw[at + 8 * n : at + 9 * n]
    at += 9 * n
    sizes = np.frombuffer(raw, "<u8", n, at).astype(np.int64)
    at += 8 * n
    ids = table[decode_ranks(raw[at : at + controls], raw[at + controls : at + controls + data], total)]
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    for i in range(n):
        yield (None if nulls[i] else docs[i]), ids[cuts[i] : cuts[i + 1]]


def read_tokens(manifest: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """Decode the files of a manifest: ``doc_id, start, n_tokens, ids_crc32``
    per document and, with ``with_ids``, ``ids`` (array of int)."""
    spark = manifest.sparkSession
    listed = manifest.select("number", "part", "file", "n_ids")
    base, at = {}, 0
    for row in sorted(listed.collect(), key=lambda r: (r["number"], r["part"])):  # one row per file written
        base[row["file"]] = at
        at += row["n_ids"]

    def run(batches):
        from zlib import crc32

        fs, root = shared_fs(path)
        with fs.open_input_file(f"{root}/ranks.u32") as f:
            table = np.frombuffer(f.read(), "<u4")
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(name) as f:
                    end = f.size()
                    f.seek(end - len(MAGIC) - 8)
                    blocks = struct.unpack("<Q", f.read(8))[0]
                    if f.read() != MAGIC:
                        raise ValueError(f"{name} is not a finished token file")
                    f.seek(end - len(MAGIC) - 8 * (blocks + 1))
                    stops = [*np.frombuffer(f.read(8 * blocks), "<u8").tolist(), end - len(MAGIC) - 8 * (blocks + 1)]
                    for a, b in zip(stops, stops[1:]):
                        f.seek(a)
                        docs, starts, sizes, crcs, lists = [], [], [], [], []
                        for doc, ids in read_block(f.read(b - a), table):
                            docs.append(doc)
                            starts.append(start)
                            sizes.append(len(ids))
                            crcs.append(crc32(ids.astype("<u4").tobytes()))
                            if with_ids:
                                lists.append(ids.astype(np.int32))
                            start += len(ids)
                        columns = [pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())]
                        if with_ids:
                            columns.append(pa.array(lists, pa.list_(pa.int32())))
                        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    files = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(base.items())], "file string, start long, task int")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return files.repartitionById(max(1, min(len(base), READ_TASKS)), "task").mapInArrow(run, schema)  # one file a task, or several where there are very many


__all__ = ["decode_ranks", "encode_ranks", "fresh_path", "rank_table", "read_tokens", "write_tokens"]
