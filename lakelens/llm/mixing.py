"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document gets the exponential key -ln(u) / quality weight, u from a hash of its doc_id, so reruns agree. Within a
source, whole epochs come first; the rest of the target is filled in key order by prefix sums of sizes.

The prefix sum never sorts a source in one task: keys fall into BINS bins, sizes are summed by (source, bin) before the
shuffle, and only the one bin in which a source's budget ends is sorted row by row.

Nulls: a null text has size 0; a null source is a source of its own, last in order; a null doc_id has a key as well.
Repeated rows are separate documents with equal keys. An empty table gives an empty result; extra columns, of whatever
name, are ignored by mix and kept by mixed_rows. A very long text counts whole. A source of size 0 has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, numbered

MOST = 3
BINS = 4096


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Between 0.25 and 1: the share of characters that are neither digits nor symbols."""
    n = F.length(text)
    plain = F.length(F.translate(text, "0123456789#*$%&|<>{}[]=\\/_~^@+", ""))
    return F.coalesce(F.when(n > 0, 0.25 + 0.75 * plain / n), F.lit(1.0))


def uniform(doc_id: Column, seed: int = 0) -> Column:
    """In (0, 1), from 32 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(str(seed))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 32))


def targets(totals: DataFrame) -> DataFrame:
    """Water filling over one row per source (source, source_size): shares by weight 1, 2, 3, 1, ... in code point
    order, each at most MOST times its size; the excess goes to the others by weight until none is above.

    The fixed point is target = min(MOST * size, level * weight), with one level for all. Sources that are capped come
    first by cap / weight, so prefix sums over the sources find the level.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    t = totals.withColumn("w", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))
    t = t.withColumn("cap", MOST * F.col("source_size").cast("double"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("all", F.sum("source_size").over(everything).cast("double")).withColumn("all_w", F.sum("w").over(everything))
    t = t.withColumn("capped", F.coalesce(F.sum("cap").over(by_ratio), F.lit(0.0))).withColumn("capped_w", F.coalesce(F.sum("w").over(by_ratio), F.lit(0.0)))
    # The level if exactly the sources before this one are capped; the true one is at the first source it doesn't cap.
    t = t.withColumn("at", (F.col("all") - F.col("capped")) / (F.col("all_w") - F.col("capped_w")))
    free = F.when(F.col("at") * F.col("w") <= F.col("cap"), F.struct((F.col("cap") / F.col("w")).alias("ratio"), F.col("source").isNull(), "source", "at"))
    t = t.withColumn("level", F.min(free).over(everything)["at"])
    return t.select("source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target"))


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """One row per document: _row, doc_id, source, size, source_size, target, copies, taken."""
    return mix_numbered(docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "source", "text"), seed)


def mix_numbered(docs: DataFrame, seed: int = 0) -> DataFrame:
    rows = docs.select(
        "_row", "doc_id", "source",
        size(F.col("text")).alias("size"),
        (-F.log(uniform(F.col("doc_id"), seed)) / quality_weight(F.col("text"))).alias("key"),
    )
    # exp(-key) is u ** (1 / weight), so bins are about evenly filled
    rows = rows.withColumn("bin", F.floor((1 - F.exp(-F.col("key"))) * BINS).cast("int"))
    return _take(rows)


def _take(rows: DataFrame) -> DataFrame:
    rows = materialize(rows, "mix-keys")
    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    goal = goal.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("bin_size").over(before), F.lit(0)))
    g = goal.select(F.col("source").alias("g"), "source_size", "target", "epochs", "rest")
    ends = bins.join(g, F.col("source").eqNullSafe(F.col("g")), "right")
    ends = ends.where((F.col("before") <= F.col("rest")) | F.col("before").isNull())
    ends = ends.groupBy("g", "source_size", "target", "epochs", "rest").agg(F.max(F.struct("bin", "before")).alias("end"))
    ends = ends.select("g", "source_size", "target", "epochs", "rest", F.col("end.bin").alias("last"), F.col("end.before").alias("before"))
    joined = rows.join(ends, F.col("source").eqNullSafe(F.col("g")), "left")
    sure = joined.where("bin <> last").withColumn("picked", (F.col("bin") < F.col("last")).cast("long"))
    inside = Window.partitionBy("source", "bin").orderBy("key", "doc_id", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    close = joined.where("bin = last").withColumn("upto", F.col("before") + F.sum("size").over(inside))
    # a document that crosses the budget is taken if that ends nearer to it
    close = close.withColumn("picked", (F.col("upto") - F.col("size") / 2 <= F.col("rest")).cast("long")).drop("upto")
    both = sure.unionByName(close).withColumn("copies", (F.col("epochs") + F.col("picked")).cast("long"))
    return both.select("_row", "doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix itself: each document as often as it is taken, with all its columns."""
    rows = numbered(docs)
    named = rows.select("_row", *[F.col(f"rec.{c}").alias(c) for c in ("doc_id", "source", "text")])
    copies = mix_numbered(named, seed).where("copies > 0").select("_row", "copies")
    joined = rows.join(copies, "_row")
    return joined.select("rec", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("rec.*")
