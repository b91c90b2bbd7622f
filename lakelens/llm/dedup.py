"""Exact dedup by progressive refinement: equal lengths, then equal prefix hashes, then full hashes of what is left.

One pass writes the rows with their length and prefix hash. Each round marks the keys that more than one row has in a
filter of bounded size, reading those small columns alone; whole texts are read again only for rows that both filters
let pass. A false pass costs one more hash, never a wrong group: groups are formed by the full hash alone.

Texts are equal when identical without ASCII white space. The row with most code points stays, then the smallest
doc_id (null last), then the first in the scan, so of rows repeated as a whole one stays. A null text is empty; empty
texts are equal to each other. An empty table gives an empty result. Columns of any other name are kept by exact_dedup
and ignored by exact_groups. Very long texts are hashed whole, one row at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, bitmap, drop_rows, materialize, maybe_in, numbered

PREFIX = 256


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def text_sha256(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def measured(docs: DataFrame) -> DataFrame:
    """The rows, numbered, with the code points of each text and the length and prefix hash of the text without white space."""
    norm = normalised(F.col("text"))
    length = F.length(norm)
    return numbered(docs, n_chars=F.length(F.coalesce("text", F.lit(""))).cast("long"), length=length, prefix=F.xxhash64(length, F.substring(norm, 1, PREFIX)))


def full_hashes(rows: DataFrame, digest_all: bool = False) -> DataFrame:
    """One row per document of measured rows: _row, doc_id, n_chars, full_hash (null where length or prefix is unique) and,
    if digest_all, digest: the full hash of rows that need none."""
    small = rows.select("_row", "length", "prefix")
    lengths = bitmap(rows.groupBy("length").count().where("count > 1"), F.col("length"))
    same = maybe_in(small, lengths, F.col("length"), "_same").where("_same").groupBy("prefix").count().where("count > 1")
    prefixes = bitmap(same, F.col("prefix"))
    wide = rows.select("_row", F.col("rec.doc_id").alias("doc_id"), "n_chars", "length", "prefix", F.col("rec.text").alias("text"))
    left = maybe_in(maybe_in(wide, lengths, F.col("length"), "_same_length"), prefixes, F.col("prefix"), "_same_prefix")
    needed = F.col("_same_length") & F.col("_same_prefix")
    full = text_sha256(F.col("text"))
    return left.select("_row", "doc_id", "n_chars", F.when(needed, full).alias("full_hash"), *[F.when(~needed, full).alias("digest")] * digest_all)


def exact_groups(docs: DataFrame) -> DataFrame:
    return groups_of(measured(docs.select("doc_id", "text")))


def groups_of(rows: DataFrame, digest_all: bool = False) -> DataFrame:
    """full_hashes of measured rows with keep_id, group_size, kept. Groups are summed before the shuffle, and the join
    that brings the result back to the rows is one that Spark splits where a group is large."""
    hashed = materialize(full_hashes(rows, digest_all), "full-hashes")
    best = F.min(F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"), F.col("_row").alias("d")))
    groups = hashed.where("full_hash is not null").groupBy("full_hash").agg(best.alias("_best"), F.count("*").alias("_size")).where("_size > 1")
    # rows without a hash have keys of their own, so that they spread over the tasks
    groups = groups.withColumnRenamed("full_hash", "_key")
    joined = hashed.withColumn("_key", F.coalesce("full_hash", F.col("_row").cast("string"))).join(groups, "_key", "left")
    alone = F.col("_size").isNull()
    return joined.select(
        "_row", "doc_id", "full_hash", *["digest"] * digest_all,
        F.when(alone, F.col("doc_id")).otherwise(F.col("_best.c")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_best.d") == F.col("_row"))).alias("kept"),
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns."""
    rows = measured(docs)
    dropped = materialize(groups_of(rows).where("not kept").select("_row"), "copies")
    return drop_rows(rows.select("_row", "rec"), dropped).select("rec.*")
