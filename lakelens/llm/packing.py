"""Packing by power-of-two decomposition: each document is cut into pieces of binary lengths, pieces of equal length
share a bucket, and each piece is a sequence of its own. So no sequence crosses documents and none is padded.

Nulls: a null text is an empty document (end id alone); a null doc_id stays null. Repeated rows are separate documents.
An empty table gives no pieces; extra columns are ignored. Very long texts are encoded whole, and their pieces are handed
on by bytes. Rows need no shuffle: a document is cut where it is read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import single_pass
from .encoding import END_ID, byte_bpe, encoder
from .hashing import lean

MAX_LENGTH = 2048
#: Bytes of pieces that a task gathers before it hands them on, and what a piece takes beside its ids.
OUT_BYTES, PIECE_BYTES = 2 << 20, 200


def binary_lengths(n: int, most: int = MAX_LENGTH) -> list[int]:
    """Full pieces first, then one piece for each set bit of the rest, largest first."""
    return [most] * (n // most) + [1 << k for k in range(most.bit_length() - 2, -1, -1) if n % most >> k & 1]


def pack_pieces(docs: DataFrame, tokenizer: tuple[str, bool] | None = None, most: int = MAX_LENGTH) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, bucket (log2 of the length), ids (unsigned 32-bit
    little-endian), sequence_id and offset. sequence_id numbers the pieces by bucket: its top digits are the bucket's, the
    others the piece's place in the scan, so sorting by it puts equal lengths together. A task that is run again gives
    the same ids."""
    if most & (most - 1):
        raise ValueError("the longest piece must be a power of two")
    path, drops = tokenizer or byte_bpe()
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("bucket", pa.int32()), ("ids", pa.binary())]
    schema = pa.schema(fields)

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices, end, out, held = encoder(path, drops).batches, np.array([END_ID], "<u4"), [[] for _ in fields], 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(out, fields, strict=True)], schema=schema)

        for batch in batches:
            docs = batch.column(0).to_pylist()
            for first, ids, counts in slices(batch.column(1)):
                ends = np.cumsum(counts)
                for doc, a, b in zip(docs[first : first + len(counts)], (ends - counts).tolist(), ends.tolist(), strict=True):
                    raw, total = np.concatenate([ids[a:b], end]).tobytes(), b - a + 1
                    start = 0
                    for length in binary_lengths(total, most):
                        piece = raw[4 * start : 4 * (start + length)]
                        for column, value in zip(out, (doc, start, length, zlib.crc32(piece), total, length.bit_length() - 1, piece), strict=True):
                            column.append(value)
                        start += length
                        held += PIECE_BYTES + len(piece)
                        if held > OUT_BYTES:
                            yield packed()
                            out, held = [[] for _ in fields], 0
        yield packed()

    ddl = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bucket int, ids binary"
    pieces = single_pass(docs, ["doc_id", "text"]).mapInArrow(cut, ddl)
    number = F.col("bucket").cast("long") * (1 << 58) + F.monotonically_increasing_id()
    return pieces.withColumn("sequence_id", number).withColumn("offset", F.lit(0).cast("long"))
