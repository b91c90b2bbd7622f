"""Language-model scores by stupid backoff over the corpus itself, each document scored without its own counts.

* Blocks: rows are written once with the number of their block, a run of documents of about BLOCK_BYTES of text. A block
  counts its n-grams (all orders up to ORDER) and sends each distinct one once, packed by hash bucket: sorted, as
  differences. So a frequent n-gram costs an entry per block, never one per occurrence.
* Buckets: count tables partitioned by hash, a range of hashes each, as many as keep one of them to about BUCKET n-grams.
  They sum the counts, join the sums to the blocks' n-grams, and send each block its totals in the order of its n-grams.
  The n-grams themselves don't go back, as a block's documents give them again.
* Scores: documents and totals are joined by block. A document's n-grams look up their totals, its own counts are
  subtracted, and the logarithms are summed per document.

S(w | context) = count(context w) / count(context) if that n-gram occurs elsewhere, else 0.4 S(w | shorter context); a
single word's is its share of the other documents' words, half a count if it is new.

Nulls: a null text is empty; a text without words has log_score 0 and a null mean. A null doc_id is scored as well.
Repeated rows are separate documents, so they support one another. An empty table gives an empty result; extra columns
are ignored. A text longer than a block is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize
from .hashing import lean, ngrams, word_hashes

ORDER, BACKOFF = 3, 0.4
#: Bytes of text of a block, and n-grams of a bucket, about.
BLOCK_BYTES, BUCKET = 12 << 20, 4_000_000
#: The key under which words are counted.
ALL = np.uint64(0)


def orders(text: str | None, order: int) -> list[np.ndarray]:
    words = word_hashes(text)
    return [ngrams(words, n) for n in range(1, order + 1)]


def packed(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte of all, compressed: high bytes are zeros, and small counts take a few bits."""
    return zstandard.ZstdCompressor(level=1).compress(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct keys as differences."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw), dtype=np.uint64)


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so sorted keys are sorted by bucket too."""
    half = np.uint64(32)
    return ((keys >> half) * np.uint64(n_buckets) >> half).astype(np.int64)


def in_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """A table doc_id, text, block: a task numbers its blocks, so no two tasks share one."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            got = []
            for size in pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0).to_pylist():
                if held and held + size > block_bytes:
                    block, held = block + 1, 0
                held += size
                got.append(block)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.int64())], ["doc_id", "text", "block"])

    return materialize(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text string, block long"), "blocks")


def counted(rows: DataFrame, order: int, n_buckets: int) -> DataFrame:
    """bucket, block, keys, counts: the distinct n-grams of each block by bucket; ALL, with the words, is in every bucket 0."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, words = None, [], 0

        def flush() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            more = keys != ALL
            keys, counts = np.concatenate([[ALL], keys[more]]), np.concatenate([[words], counts[more]])
            ends = np.searchsorted(bucket_of(keys, n_buckets), np.arange(n_buckets + 1))
            full = np.flatnonzero(np.diff(ends))
            parts = [slice(ends[b], ends[b + 1]) for b in full]
            columns = [pa.array(full, pa.int64()), pa.array(np.full(len(full), block), pa.int64())]
            columns += [pa.array([packed_keys(keys[z]) for z in parts], pa.binary()), pa.array([packed(counts[z]) for z in parts], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["bucket", "block", "keys", "counts"])

        for batch in batches:
            for text, of in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                if held and of != block:
                    yield flush()
                    held, words = [], 0
                block = of
                grams = orders(text.as_py(), order)
                held += grams
                words += len(grams[0])
        if held:
            yield flush()

    return rows.mapInArrow(run, "bucket long, block long, keys binary, counts binary")


def bucket_totals(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: bucket, block and the totals over all blocks of the block's n-grams, in the order of their hashes."""
    keys = [unpacked_keys(x) for x in pdf["keys"]]
    everything, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros(len(everything), np.uint64)
    np.add.at(sums, at, np.concatenate([unpacked(x) for x in pdf["counts"]]))
    del at
    bucket, blocks, out = int(pdf["bucket"].iloc[0]), pdf["block"].to_numpy(), []
    for block in np.unique(blocks):
        # a block that was read in two parts counted each of them
        mine = np.unique(np.concatenate([keys[i] for i in np.flatnonzero(blocks == block)]))
        out.append((bucket, int(block), packed(sums[np.searchsorted(everything, mine)])))
    return pd.DataFrame(out, columns=["bucket", "block", "totals"])


def lm_scores(docs: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES, bucket: int = BUCKET) -> DataFrame:
    """doc_id, n_words, log_score (sum of natural logarithms), mean_log_score."""
    rows = in_blocks(docs, block_bytes)
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n_buckets = max(1, -(-size * order // (6 * bucket)))  # about six characters a word
    # a table, so that the counts' shuffle files are gone before documents are shuffled
    totals = materialize(counted(rows, order, n_buckets).groupBy("bucket").applyInPandas(bucket_totals, "bucket long, block long, totals binary"), "totals")

    def score(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        """Of one block: its documents' scores, from the totals of its n-grams."""
        if not len(texts):
            return pd.DataFrame({"doc_id": [], "n_words": [], "log_score": [], "mean_log_score": []})
        grams = [orders(text, order) for text in texts["text"]]
        lengths = [[len(x) for x in of] for of in grams]
        keys, at = np.unique(np.concatenate([np.array([ALL]), *(x for of in grams for x in of)]), return_inverse=True)
        del grams
        sums = np.concatenate([unpacked(x) for x in found.sort_values("bucket")["totals"]]).astype(np.int64)
        if len(keys) != len(sums):
            raise ValueError(f"{len(sums)} totals for {len(keys)} n-grams of a block")

        def in_others(mine: np.ndarray) -> np.ndarray:
            """Counts in the other documents of one document's n-grams, by their places in keys."""
            got = sums[mine]
            more = got > 1
            _, inverse, own = np.unique(mine[more], return_inverse=True, return_counts=True)
            got[more] -= own[inverse]
            got[~more] = 0  # its only one is here
            return got

        n_words, scores, end = [], [], 1
        everything = sums[0]
        for of in lengths:
            n = of[0]
            n_words.append(n)
            if not n:
                scores.append(0.0)
                continue
            ends = np.cumsum([0, *of])
            found_here = in_others(at[end : end + ends[-1]])
            end += ends[-1]
            counts = [found_here[a:b] for a, b in zip(ends, ends[1:]) if b > a]
            got = np.log(np.maximum(counts[0], 0.5) / max(1, everything - n))
            for k in range(1, len(counts)):  # longer contexts replace what shorter ones gave
                longer, context = counts[k], counts[k - 1][: len(counts[k])]
                got[k:] = np.where(longer > 0, np.log(np.maximum(longer, 1) / np.maximum(context, 1)), np.log(BACKOFF) + got[k:])
            scores.append(float(got.sum()))
        mean = [s / n if n else None for s, n in zip(scores, n_words, strict=True)]
        return pd.DataFrame({"doc_id": texts["id"].astype("Int64").mask(texts["missing"]), "n_words": n_words, "log_score": scores, "mean_log_score": mean})

    # ids as whole numbers: a column with nulls would reach pandas as floats
    texts = rows.select("block", F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("missing"), "text")
    joined = texts.groupBy("block").cogroup(totals.groupBy("block")).applyInPandas(score, "doc_id long, n_words long, log_score double, mean_log_score double")
    got = materialize(joined, "lm-scores")
    discard(rows, totals)
    return got
