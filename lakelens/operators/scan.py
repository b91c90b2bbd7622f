"""The scan: data files read by field id, less the rows that position deletes name.

Columns are read under names of their own (__fid_N), as a name that another column once had would misdirect the
Parquet reader and its filters; the last projection gives them their current names. Filters and projections above
reach the Parquet scan, through the anti join too. Files that no delete file can name are read without a join.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import NotSupportedError
from ..plans.snapshot import Entry, TablePlan, check_readable
from ..sources.files import Files, literal
from ..sources.schema import has_uuid

#: Deletes are broadcast up to this many bytes, as their manifests count them.
BROADCAST_BYTES = 64 << 20
#: Bytes of a word of 64 positions in a broadcast table.
WORD_BYTES = 64
#: Bits of a key that may hold a position, and the seed of Spark's xxhash64.
MOST_ROW_BITS, HASH_SEED = 40, 42
#: Names of so many files are compared one by one; more are joined.
INLINE_FILES = 16
SETTINGS = {"spark.sql.parquet.fieldId.read.enabled": "true", "spark.sql.timeType.enabled": "true"}


def prepare(spark: SparkSession) -> None:
    """Settings without which fields can't be found by id: they are read when a plan is made, so they stay."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


def uuid_text(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.hex(c)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def shown(c: Column, kind) -> Column:
    """A stored value as queries see it: UUIDs as text, at any depth."""
    if not has_uuid(kind):
        return c
    if kind == "uuid":
        return uuid_text(c)
    if kind["type"] == "struct":
        return F.when(c.isNotNull(), F.struct(*[shown(c[f["name"]], f["type"]).alias(f["name"]) for f in kind["fields"]]))
    if kind["type"] == "list":
        return F.transform(c, lambda x: shown(x, kind["element"]))
    return F.transform_values(F.transform_keys(c, lambda k, _: shown(k, kind["key"])), lambda _, v: shown(v, kind["value"]))


def plain(uri: str) -> str:
    """A local file's URI comes with one slash or three, as its path was spelled: with one."""
    return "file:/" + uri[5:].lstrip("/") if uri.startswith("file:/") else uri


def basename(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_data(spark: SparkSession, plan: TablePlan, files: list[str], helpers: list[str]) -> tuple[DataFrame, list[str | Column]]:
    """The data files with helper columns, and the projection to the table's columns."""
    columns = plan.metadata.columns
    if columns is None:  # by the names in the table's first file
        schema = spark.read.parquet(literal(plan.path(plan.entries(0)[0].file_path))).schema
        stored = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
        df = spark.read.schema(stored).parquet(*map(literal, files))
        return df.selectExpr(*map(quoted, stored.names), *helpers), [quoted(n) for n in stored.names]
    stored = T.StructType([T.StructField(f"__fid_{c.id}", c.stored, True, {"parquet.field.id": c.id}) for c in columns])
    df = spark.read.schema(stored).parquet(*map(literal, files))
    final = [shown(F.col(f"__fid_{c.id}"), c.type).alias(c.name) if has_uuid(c.type) else f"__fid_{c.id} AS {quoted(c.name)}" for c in columns]
    return df.selectExpr(*stored.names, *helpers) if helpers else df, final


def project(df: DataFrame, final: list[str | Column]) -> DataFrame:
    return df.selectExpr(*final) if all(isinstance(c, str) for c in final) else df.select(*[F.expr(c) if isinstance(c, str) else c for c in final])


def no_rows(spark: SparkSession, plan: TablePlan) -> DataFrame:
    columns = plan.metadata.columns or []
    empty = spark.createDataFrame([], T.StructType([T.StructField(f"__fid_{c.id}", c.stored, True) for c in columns]))
    return empty.select(*[shown(F.col(f"__fid_{c.id}"), c.type).alias(c.name) for c in columns])


def touched(plan: TablePlan, entries: list[Entry]) -> list[bool]:
    """Whether a delete file can name each data file: not if its stored path lies outside the bounds of them all."""
    bounds = [(e.low, e.high) for e in plan.entries(1)]
    if plan.moved or any(low is None or high is None for low, high in bounds):
        return [True] * len(entries)
    lows, highs = [], []  # merged: disjoint and in order
    for low, high in sorted(bounds):
        if highs and low <= highs[-1]:
            highs[-1] = max(highs[-1], high)
        else:
            lows.append(low)
            highs.append(high)
    at = [bisect_right(lows, e.file_path.encode()) - 1 for e in entries]
    return [k >= 0 and e.file_path.encode() <= highs[k] for e, k in zip(entries, at, strict=True)]


def file_keys(uris: set[str], rows: int) -> tuple[dict[str, int], int, str]:
    """A 64-bit number for each file name, whose low bits are free for row positions: the numbers differ above them, so
    number XOR position is a key of its own for each position. Gives the numbers, the free bits and the salt that the hash took."""
    for salt in ("", *map(str, range(64))):
        keys = {u: xxhash.xxh64_intdigest((salt + u).encode(), HASH_SEED) for u in uris}
        for bits in range(MOST_ROW_BITS, max(1, rows.bit_length()) - 1, -1):
            if len({k >> bits for k in keys.values()}) == len(keys):
                return {u: k - (k >> 63 << 64) for u, k in keys.items()}, bits, salt
    raise NotSupportedError(f"{len(uris)} data files of up to {rows} rows are too many for 64-bit keys")


def without_deleted(spark: SparkSession, plan: TablePlan, entries: list[Entry], uris: list[str]) -> DataFrame:
    """Rows of these data files less those that any delete file names.

    Deleted positions are gathered into words of 64 bits, so the join has one long key on both sides and a row of its
    smaller side stands for up to 64 positions. Delete files are sorted, so most of the gathering is done where they are read.
    """
    deletes = [plan.path(e.file_path) for e in plan.entries(1)]
    df, final = read_data(spark, plan, [plan.path(e.file_path) for e in entries], ["_metadata.file_path AS __file", "_metadata.row_index AS __row"])
    gone = spark.read.schema("file_path string, pos long").parquet(*map(literal, deletes))
    if plan.moved:
        # stored folders are those before the move, so only file names are compared
        names = {plan.path(e.file_path).rsplit("/", 1)[-1]: uri.rsplit("/", 1)[-1] for e, uri in zip(entries, uris, strict=True)}
        named, mine = basename(F.col("file_path")), basename(F.col("__file"))
    else:
        names = {e.file_path: uri for e, uri in zip(entries, uris, strict=True)}
        named, mine = F.col("file_path"), F.col("__file")
        if any(uri.startswith("file:/") for uri in uris):
            mine = F.expr("if(startswith(__file, 'file:///'), concat('file:', substr(__file, 8)), __file)")
    keys, bits, salt = file_keys(set(names.values()), max(e.record_count for e in entries))
    # positions that no row can have name nothing, nor do files that are not among these
    gone = gone.where(f"pos between 0 and {(1 << bits) - 1}")
    if len(names) <= INLINE_FILES:
        number = F.coalesce(*[F.when(named == raw, F.lit(keys[uri])) for raw, uri in names.items()])
        gone = gone.where(named.isin(list(names))).select(number.alias("number"), "pos")
    else:
        listed = pa.table({"raw": list(names), "number": pa.array([keys[uri] for uri in names.values()], pa.int64())})
        gone = gone.select(named.alias("raw"), "pos").join(spark.createDataFrame(listed), "raw")
    words = gone.groupBy(F.expr("number ^ shiftright(pos, 6)").alias("__word")).agg(F.expr("bit_or(shiftleft(1L, cast(pos & 63 as int)))").alias("__gone"))
    if min(plan.delete_rows, plan.data_rows // 64 + len(entries)) * WORD_BYTES <= BROADCAST_BYTES:
        words = F.broadcast(words)
    # the scan's file and position are never null, so plain equality is the null-safe one
    word = F.xxhash64(F.concat(F.lit(salt), mine) if salt else mine).bitwiseXOR(F.expr("shiftright(__row, 6)"))
    return project(df.join(words, (word == F.col("__word")) & F.expr("shiftright(__gone, cast(__row & 63 as int)) & 1 = 1"), "left_anti"), final)


def scan_plan(spark: SparkSession, plan: TablePlan) -> DataFrame:
    check_readable(plan)
    prepare(spark)
    data = plan.entries(0)
    if not data:
        return no_rows(spark, plan)
    hit = [False] * len(data)
    if plan.entries(1):
        uris = [plain(x) for x in Files(spark).uris([plan.path(e.file_path) for e in data])]
        hit = touched(plan, data)
    parts = []
    if not all(hit):  # files that no delete file can name stay outside the join
        df, final = read_data(spark, plan, [plan.path(e.file_path) for e, h in zip(data, hit, strict=True) if not h], [])
        parts.append(project(df, final))
    if any(hit):
        parts.append(without_deleted(spark, plan, *([x for x, h in zip(of, hit, strict=True) if h] for of in (data, uris))))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
