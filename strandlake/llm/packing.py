"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are the binary digits of
its id count: as many pieces of the longest length as fit, then one piece for
each binary digit of the rest, longest first. Each piece is a sequence of its
own in the bucket of its length, so no sequence crosses documents and, every
length being a power of two, none is padded.

Null and empty texts pack as one piece with the end id. Texts of any length are
packed whole, piece after piece. Repeated rows and equal ids pack once each, so
ties mean nothing. An empty table gives an empty result. Columns other than id
and text aren't read, whatever their names. Nothing is shuffled. ``sequence_id`` joins the number of the input
partition with a count inside it, and is the same whenever a task runs again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .tokens import default_vocabulary, encoder_for

MAX_LENGTH = 2048
END_ID = 1


def piece_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Powers of two that sum to ``n``, none over ``longest``, falling."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << b for b in range(longest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, text: str = "text", id_col: str = "doc_id", vocabulary: str | None = None, longest: int = MAX_LENGTH, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, bucket`` and, with ``with_ids``, ``ids`` (the piece's
    ids as little-endian unsigned 16-bit bytes). ``longest`` is a power of two.
    """
    if longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    small_batches(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary()
    slim = docs.select(F.col(id_col).alias("__sl_id"), F.col(text).cast("string").alias("__sl_text"))
    id_type = slim.schema[0].dataType.simpleString()

    def run(batches):
        from zlib import crc32

        from pyspark import TaskContext

        encoder = encoder_for(vocabulary)
        end = end_id.to_bytes(2, "little")
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column(0)
            owner, start, length, crc, total, raw = [], [], [], [], [], []
            for i, body in enumerate(encoder.encode(batch.column(1))):
                body += end
                n, at = len(body) // 2, 0
                wide = np.frombuffer(body, "<u2").astype("<u4").tobytes()
                for size in piece_lengths(n, longest):
                    owner.append(i)
                    start.append(at)
                    length.append(size)
                    crc.append(crc32(wide[4 * at : 4 * (at + size)]))
                    total.append(n)
                    if with_ids:
                        raw.append(body[2 * at : 2 * (at + size)])
                    at += size
            rows = len(owner)
            columns = [ids.take(pa.array(owner, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(total, pa.int64()), pa.array(range(number, number + rows), pa.int64()), pa.array([0] * rows, pa.int64()), pa.array(length, pa.int32())]
            names = ["__sl_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"]
            if with_ids:
                columns.append(pa.array(raw, pa.binary()))
                names.append("ids")
            number += rows
            yield pa.RecordBatch.from_arrays(columns, names=names)

    out = slim.mapInArrow(run, f"__sl_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bucket int" + ", ids binary" * with_ids)
    return out.withColumnRenamed("__sl_id", id_col)


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder of sequences per length, as trainers read them."""
    packed.write.partitionBy("bucket").parquet(path)
