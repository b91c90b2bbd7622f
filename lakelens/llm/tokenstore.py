"""Token-id output: raw id shards with a minimal perfect hash index from document key to offset.

A store is a folder of shards, each a contiguous doc_id range in ascending order:

* `shard-N.ids`: the ids, unsigned little-endian, 2 bytes each where the vocabulary allows it, else 4; nothing else;
* `shard-N.keys`: the doc_ids and occurrences in order, 8 bytes each, for scans;
* `shard-N.mph`: levels of a minimal perfect hash over (doc_id, occurrence) with a rank for each block of 512 bits, and by
  slot a 32-bit fingerprint, the first id's position and the count of ids. `Shard.get` reads by position: a block and a
  rank for each level that it tries, then one entry of each array, whatever the size of the shard.

The manifest has a row per shard: shard, n_docs, n_tokens, width, its first and last key and the rows of the last one.
`Store.lookup` finds a key's shard in it by binary search.

Nulls: a null text is an empty document (end id alone); a null doc_id sorts first and has a key of its own.
Repeated doc_ids are kept as occurrences 0, 1, ... in order of (hash of the text, text), over all shards that hold them:
within a shard they are counted from 0, and the manifest tells how many come before. An empty table gives an empty
store; extra columns are ignored; a very long text is encoded whole, in a slice of its own.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, shared_path, single_pass
from .encoding import END_ID, encoder, word_bpe
from .hashing import lean, mix

GAMMA, NULL_MARK = 2.0, 1 << 40
#: Bits of a block of a level; each has its rank.
BLOCK = 512
#: Names that Spark's file systems and Arrow's give the same store.
ALIASES = {"s3a://": "s3://", "s3n://": "s3://"}
STEP = np.uint64(0x9E3779B97F4A7C15)


def hashed(ids: np.ndarray, occurrence: np.ndarray, seed: int) -> np.ndarray:
    return mix(mix(ids.astype(np.int64).view(np.uint64) + np.full(len(ids), seed, np.uint64) * STEP) ^ mix(occurrence.astype(np.uint64)))


class PerfectHash:
    """Levels of bits: a key sits at the first level where no other key left shares its position."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.base = np.cumsum([0, *(int(x.sum()) for x in levels)])
        self.rank = [np.cumsum(x) - x for x in levels]

    @classmethod
    def build(cls, ids: np.ndarray, occurrence: np.ndarray) -> PerfectHash:
        levels = []
        while len(ids):
            size = max(1, int(GAMMA * len(ids)))
            at = (hashed(ids, occurrence, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = ~alone[at]
            ids, occurrence = ids[left], occurrence[left]
        return cls(levels)

    def slots(self, ids: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for one that no level takes."""
        out, left = np.full(len(ids), -1, np.int64), np.arange(len(ids))
        for k, bits in enumerate(self.levels):
            at = (hashed(ids[left], occurrence[left], k) % np.uint64(len(bits))).astype(np.int64)
            here = bits[at]
            out[left[here]] = self.base[k] + self.rank[k][at[here]]
            left = left[~here]
        return out


def fingerprint(ids: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    return (hashed(ids, occurrence, 1 << 20) >> np.uint64(32)).astype(np.uint32)


def files(root: str):
    from pyarrow import fs

    for spark_name, name in ALIASES.items():
        if root.startswith(spark_name):
            root = name + root.removeprefix(spark_name)
    return fs.FileSystem.from_uri(root)


def put(root: str, name: str, data: bytes) -> None:
    """Written under an attempt's own name, then renamed: a lost or repeated task leaves whole files only."""
    store, at = files(root)
    context = TaskContext.get()
    own = f"{at}/.{name}-{context.taskAttemptId() if context else 0}"
    with store.open_output_stream(own) as out:
        out.write(data)
    store.move(own, f"{at}/{name}")


def get(root: str, name: str) -> bytes:
    store, at = files(root)
    with store.open_input_file(f"{at}/{name}") as f:
        return f.read()


def index_file(index: PerfectHash, prints: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> bytes:
    """Count of levels, bits of each and count of keys; then the levels' blocks, ranks, and the arrays by slot."""
    sizes = np.array([len(x) for x in index.levels], "<i8")
    padded = [np.concatenate([x, np.zeros(-len(x) % BLOCK, bool)]) for x in index.levels]
    bits = np.concatenate([np.zeros(0, bool), *padded])
    ones = bits.reshape(-1, BLOCK).sum(1)
    head = np.concatenate([[len(sizes)], sizes, [len(prints)]]).astype("<i8")
    arrays = (np.packbits(bits), (np.cumsum(ones) - ones).astype("<i8"), offsets.astype("<i8"), lengths.astype("<i8"), prints.astype("<u4"))
    return head.tobytes() + b"".join(x.tobytes() for x in arrays)


class Shard:
    """Keyed access to one shard; occurrences count within it."""

    def __init__(self, root: str, shard: int, width: int):
        self.root, self.shard, self.width = root, shard, width
        store, at = files(root)
        self.index = store.open_input_file(f"{at}/shard-{shard:06d}.mph")
        self.ids = store.open_input_file(f"{at}/shard-{shard:06d}.ids")
        levels = int(self.at(0, "<i8", 1)[0])
        self.sizes, self.n = self.at(8, "<i8", levels), int(self.at(8 * (levels + 1), "<i8", 1)[0])
        blocks = -(-self.sizes // BLOCK)
        self.first = np.concatenate([[0], np.cumsum(blocks)])
        self.bits = 8 * (levels + 2)
        self.ranks = self.bits + int(self.first[-1]) * BLOCK // 8
        self.offsets = self.ranks + int(self.first[-1]) * 8
        self.lengths, self.prints = self.offsets + 8 * self.n, self.offsets + 16 * self.n

    def at(self, place: int, kind: str, count: int) -> np.ndarray:
        self.index.seek(place)
        return np.frombuffer(self.index.read(np.dtype(kind).itemsize * count), kind)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(get(self.root, f"shard-{self.shard:06d}.keys"), "<i8").reshape(2, -1)
        return raw[0], raw[1]

    def slot(self, ids: np.ndarray, occurrence: np.ndarray) -> int:
        """Of one key, by reading a block of each level until its bit is set; -1 if no level has it."""
        for k, size in enumerate(self.sizes.tolist()):
            at = int(hashed(ids, occurrence, k)[0] % np.uint64(size))
            block = int(self.first[k]) + at // BLOCK
            bits = np.unpackbits(self.at(self.bits + block * BLOCK // 8, "u1", BLOCK // 8))
            if bits[at % BLOCK]:
                return int(self.at(self.ranks + 8 * block, "<i8", 1)[0]) + int(bits[: at % BLOCK].sum())
        return -1

    def get(self, doc_id: int | None, occurrence: int = 0) -> np.ndarray | None:
        """The ids of a document, None if the shard doesn't hold it."""
        ids, seen = np.array([doc_id or 0], np.int64), np.array([occurrence + NULL_MARK * (doc_id is None)], np.int64)
        slot = self.slot(ids, seen)
        if slot < 0 or self.at(self.prints + 4 * slot, "<u4", 1)[0] != fingerprint(ids, seen)[0]:
            return None
        return self.read(int(self.at(self.offsets + 8 * slot, "<i8", 1)[0]), int(self.at(self.lengths + 8 * slot, "<i8", 1)[0]))

    def find(self, ids: np.ndarray, occurrence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offset and length in ids of many keys, with the index in memory; -1 and 0 for keys that the fingerprints deny."""
        raw = np.unpackbits(self.at(self.bits, "u1", (self.ranks - self.bits))).astype(bool)
        index = PerfectHash([raw[a * BLOCK : a * BLOCK + n] for a, n in zip(self.first.tolist(), self.sizes.tolist(), strict=False)])
        slots = index.slots(ids, occurrence)
        known = slots >= 0
        if not self.n:
            return np.full(len(ids), -1, np.int64), np.zeros(len(ids), np.int64)
        known[known] = self.at(self.prints, "<u4", self.n)[slots[known]] == fingerprint(ids[known], occurrence[known])
        safe = np.where(known, slots, 0)
        return np.where(known, self.at(self.offsets, "<i8", self.n)[safe], -1), np.where(known, self.at(self.lengths, "<i8", self.n)[safe], 0)

    def read(self, offset: int, length: int) -> np.ndarray:
        self.ids.seek(offset * self.width)
        return np.frombuffer(self.ids.read(length * self.width), f"<u{self.width}")


class Store:
    """Keyed access to a whole store. Only the manifest is held; shards are opened as they are asked for."""

    def __init__(self, root: str, manifest: DataFrame):
        self.shards = placed(manifest)
        self.starts = [(x["first_key"], x["before"]) for x in self.shards]
        self.open = lru_cache(maxsize=64)(lambda shard, width: Shard(root, shard, width))

    def lookup(self, doc_ids: list[int | None], occurrence: int = 0) -> list[np.ndarray | None]:
        """The ids of each document, None for one that the store doesn't hold."""
        got = []
        for doc_id in doc_ids:
            key = order_key(doc_id)
            k = bisect_right(self.starts, (key, occurrence)) - 1
            x = self.shards[k] if k >= 0 else None
            within = occurrence - (x["before"] if x and x["first_key"] == key else 0)
            got.append(self.open(x["shard"], x["width"]).get(doc_id, within) if x else None)
        return got


def order_key(doc_id: int | None) -> tuple[bool, int]:
    """Null first, then by id."""
    return doc_id is not None, doc_id or 0


def placed(manifest: DataFrame) -> list[dict]:
    """Shards with documents in order, with base (ids before it) and before (rows of its first key in earlier shards)."""
    found, base, last, run = [], 0, None, 0
    for x in sorted(manifest.collect(), key=lambda r: r.shard):
        if not x.n_docs:
            continue
        first, end = order_key(x.first_id), order_key(x.last_id)
        before = run if first == last else 0
        found.append({"shard": x.shard, "width": x.width, "base": base, "first_key": first, "first_id": x.first_id, "before": before})
        run = x.last_rows + (before if first == end else 0)
        base, last = base + x.n_tokens, end
    return found


def occurrences(ids: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of equal ids; ids are sorted, nulls first."""
    if not len(ids):
        return np.zeros(0, np.int64)
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (nulls[1:] != nulls[:-1])
    at = np.arange(len(ids))
    return at - np.maximum.accumulate(np.where(new, at, 0)) + nulls * NULL_MARK


def write_store(docs: DataFrame, root: str, tokenizer: tuple[str, bool] | None = None, width: int | None = None, shards: int | None = None) -> DataFrame:
    """Writes the store and returns its manifest, one row per shard: shard, n_docs, n_tokens, width.

    Documents are dealt by ranges of (doc_id, hash of the text), so even a repeated doc_id spreads over shards; a shard
    streams through its task in Arrow batches, and only keys and offsets of its documents are held.
    """
    spark = docs.sparkSession
    path, drops = tokenizer or word_bpe()
    if width is None:
        vocabulary = encoder(path, drops).tokenizer.get_vocab().values()
        width = 2 if max(vocabulary, default=0) < 1 << 16 else 4
    store, at = files(root)
    store.create_dir(at, recursive=True)
    kind = f"<u{width}"

    @lean
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, slices = TaskContext.get().partitionId(), encoder(path, drops).batches
        ids, nulls, lengths = [np.zeros(0, np.int64)], [np.zeros(0, bool)], [np.zeros(0, np.int64)]
        store, at = files(root)
        own = f"{at}/.shard-{shard:06d}.ids-{TaskContext.get().taskAttemptId()}"
        with store.open_output_stream(own) as out:
            for batch in batches:
                ids.append(batch.column(0).to_numpy())
                nulls.append(batch.column(1).to_numpy(zero_copy_only=False))
                for _, got, counts in slices(batch.column(2)):
                    if len(got) and int(got.max()) >= 1 << 8 * width:
                        raise ValueError(f"token id {got.max()} does not fit in {width} bytes")
                    ended = np.full(len(got) + len(counts), END_ID, kind)
                    inside = np.ones(len(ended), bool)
                    inside[np.cumsum(counts + 1) - 1] = False
                    ended[inside] = got
                    out.write(ended.tobytes())
                    lengths.append(counts + 1)
        store.move(own, f"{at}/shard-{shard:06d}.ids")
        keys, missing, size = np.concatenate(ids), np.concatenate(nulls), np.concatenate(lengths)
        seen = occurrences(keys, missing)
        index = PerfectHash.build(keys, seen)
        slots = index.slots(keys, seen)
        prints, offsets, counts = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        prints[slots], offsets[slots], counts[slots] = fingerprint(keys, seen), np.cumsum(size) - size, size
        put(root, f"shard-{shard:06d}.mph", index_file(index, prints, offsets, counts))
        put(root, f"shard-{shard:06d}.keys", np.stack([keys, seen]).astype("<i8").tobytes())
        ends = [None if not len(keys) or missing[k] else int(keys[k]) for k in (0, -1)] if len(keys) else [None, None]
        last_rows = int(seen[-1] % NULL_MARK) + 1 if len(keys) else 0
        row = [shard, len(keys), int(size.sum()), width, *ends, last_rows]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)

    names, kinds = ["shard", "n_docs", "n_tokens", "width", "first_id", "last_id", "last_rows"], [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    h = F.xxhash64("text")
    dealt = single_pass(docs, ["doc_id", "text"])
    dealt = dealt.repartitionByRange(shards or partitions(spark), F.col("doc_id").asc_nulls_first(), h)
    dealt = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), h, "text")
    # a column with nulls would reach numpy as floats, which can't hold all ids
    dealt = dealt.select(F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.col("doc_id").isNull().alias("missing"), "text")
    manifest = dealt.mapInArrow(write, "shard long, n_docs long, n_tokens long, width int, first_id long, last_id long, last_rows long")
    kept = shared_path(spark, "manifest")
    manifest.write.parquet(kept)
    return spark.read.schema(manifest.schema).parquet(kept)


def scan_store(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """Reads every key through the index: doc_id, occurrence, start (ids of all documents before it), n_tokens, ids_crc32.

    The manifest has one row per shard; it is what the driver sums, never documents.
    """
    rows = [(x["shard"], x["base"], x["width"], x["first_id"], x["before"]) for x in placed(manifest)]
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "occurrence"]

    @lean
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, base, width, first_id, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shard = Shard(root, number, width)
                ids, seen = shard.keys()
                offsets, lengths = shard.find(ids, seen)
                if (offsets < 0).any():
                    raise ValueError(f"shard {number}: the index denies a stored key")
                crcs = np.zeros(len(ids), np.int64)
                for k, (offset, length) in enumerate(zip(offsets.tolist(), lengths.tolist(), strict=True)):
                    crcs[k] = zlib.crc32(shard.read(offset, length).astype("<u4").tobytes())
                null = seen >= NULL_MARK
                of_first = null if first_id is None else (ids == first_id) & ~null
                occurrence = seen % NULL_MARK + before * of_first
                for a in range(0, len(ids), 20_000):
                    z = slice(a, a + 20_000)
                    columns = [pa.array(ids[z], mask=null[z]), *(pa.array(x[z]) for x in (base + offsets, lengths, crcs, occurrence))]
                    yield pa.RecordBatch.from_arrays(columns, names)

    listed = spark.createDataFrame(rows, "shard long, base long, width int, first_id long, before long").repartition(max(1, len(rows)))
    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, occurrence long")
