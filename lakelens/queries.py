"""The registered queries over table snapshots: each builds a table from the driver's Parquet tables, and scans it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.tables import metadata, scan, snapshots, sql
from .operators.scan import prepare
from .sources.files import shared_folder
from .sources.metadata import GUESSING
from .testing.builder import TableBuilder

LINEITEM = [
    (1, "l_orderkey", "long"), (2, "l_partkey", "long"), (3, "l_suppkey", "long"), (4, "l_linenumber", "int"), (5, "l_quantity", "double"), (6, "l_extendedprice", "double"),
    (7, "l_discount", "double"), (8, "l_tax", "double"), (9, "l_returnflag", "string"), (10, "l_linestatus", "string"), (11, "l_shipdate", "timestamp"),
]
ORDERS = [(1, "o_orderkey", "long"), (2, "o_custkey", "long"), (3, "o_orderstatus", "string"), (4, "o_totalprice", "double"), (5, "o_orderdate", "timestamp"), (6, "o_orderpriority", "string")]
T1, T2 = 1676473674504, 1676473694730
ID1, ID2 = 3776207205136740581, 7635660646343998149


def ids(columns) -> dict[str, int]:
    return {n: i for i, n, _ in columns}


def base(spark: SparkSession, sf_dir: str, name: str = "lineitem") -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def appended(spark, sf_dir, name="lineitem", columns=LINEITEM, files=("a.parquet",), **kw) -> tuple[TableBuilder, list[dict]]:
    b = TableBuilder(spark, shared_folder(spark, "table"), columns, **kw)
    entries = b.write_files(base(spark, sf_dir, name), list(files), ids(columns))
    b.snapshot(ID1, T1, [b.manifest("m0.avro", [(1, e) for e in entries])])
    return b, entries


def one(spark, sf_dir, **kw) -> str:
    b, _ = appended(spark, sf_dir, **kw)
    b.commit()
    return b.root


def deleted(spark, sf_dir, files=("a.parquet",), stored_root=None, where="l_extendedprice < 10000") -> TableBuilder:
    """A second snapshot with one position-delete file for each data file."""
    b, entries = appended(spark, sf_dir, files=files, stored_root=stored_root)
    gone = [b.write_deletes([(e, b.read_rows(e).where(where))], f"d{k}.parquet") for k, e in enumerate(entries)]
    b.snapshot(ID2, T2, [b.manifest("m1.avro", [(0, e) for e in entries], sequence=2), b.manifest("m2.avro", [(1, e) for e in gone], content=1, sequence=2)])
    b.commit("v2", "2")
    return b


def rewritten(spark, sf_dir, version=2) -> TableBuilder:
    """A second snapshot by copy on write: one file added, one removed."""
    b, entries = appended(spark, sf_dir, version=version)
    new = b.write_files(base(spark, sf_dir).where("not (l_extendedprice < 10000)"), ["b.parquet"], ids(LINEITEM))
    b.commit("v1", None)
    b.snapshot(ID2, T2, [b.manifest("m1.avro", [(1, e) for e in new], sequence=2), b.manifest("m2.avro", [(2, e) for e in entries], sequence=2)])
    b.commit("v2", "2")
    return b


def updated(spark, sf_dir) -> str:
    """Rows updated as delete and insert: three data files, two delete files, one file of new rows."""
    b, entries = appended(spark, sf_dir, files=("a 1.parquet", "b%2.parquet", "c#3.parquet"))
    gone = [b.write_deletes([(e, b.read_rows(e).where("l_linenumber = 1")) for e in part], f"d{k}.parquet") for k, part in enumerate((entries[:2], entries[2:]))]
    new = b.write_files(base(spark, sf_dir).where("l_linenumber = 1").withColumn("l_quantity", F.col("l_quantity") + 1), ["e.parquet"], ids(LINEITEM))
    b.snapshot(ID2, T2, [b.manifest("m1.avro", [(0, e) for e in entries] + [(1, e) for e in new]), b.manifest("m2.avro", [(1, e) for e in gone], content=1)])
    b.commit("v2", "2")
    return b.root


def scan_count(spark, sf_dir):
    return scan(spark, one(spark, sf_dir)).agg(F.count("*").alias("n"))


def scan_version_guess(spark, sf_dir):
    b, _ = appended(spark, sf_dir)
    b.commit("v3", None)
    before = spark.conf.get(GUESSING, "false")
    spark.conf.set(GUESSING, "true")
    try:
        return scan(spark, b.root)
    finally:
        spark.conf.set(GUESSING, before)


def scan_gzip_metadata(spark, sf_dir):
    b, _ = appended(spark, sf_dir, version=1, codec="deflate")
    b.commit("v2", "2", zipped=True)
    return scan(spark, b.root, metadata_compression_codec="gzip")


def scan_hint_file_arg(spark, sf_dir):
    b, _ = appended(spark, sf_dir)
    b.commit("v7", None)
    b.files.write(f"{b.root}/metadata/other-hint.txt", b"7\n")
    return scan(spark, b.root, version="other-hint.txt")


def scan_version_name_format(spark, sf_dir):
    b, _ = appended(spark, sf_dir)
    b.commit("rev-5", None)
    return scan(spark, b.root, version="5", version_name_format="rev-%s%s.metadata.json")


def scan_moved_paths(spark, sf_dir):
    b = deleted(spark, sf_dir, files=("a.parquet", "b c.parquet"), stored_root="/nowhere/warehouse/t")
    return scan(spark, b.root, allow_moved_paths=True)


def evolved(spark, sf_dir, first, then, name="lineitem") -> DataFrame:
    b = TableBuilder(spark, shared_folder(spark, "table"), first)
    df = base(spark, sf_dir, name).select(*[n for _, n, _ in first])
    entries = b.write_files(df, ["a.parquet"], ids(first))
    b.snapshot(ID1, T1, [b.manifest("m0.avro", [(1, e) for e in entries])])
    b.evolve(then)
    b.commit()
    return scan(spark, b.root)


def scan_partition_dirs(spark, sf_dir):
    b = TableBuilder(spark, shared_folder(spark, "table"), ORDERS)
    orders, entries = base(spark, sf_dir, "orders"), []
    for s in ("F", "O", "P"):
        entries += b.write_files(orders.where(F.col("o_orderstatus") == s), [f"o_orderstatus={s}/a.parquet"], ids(ORDERS))
    entries += b.write_files(orders.where("o_orderstatus not in ('F', 'O', 'P')"), ["o_orderstatus=rest/a.parquet"], ids(ORDERS))
    b.snapshot(ID1, T1, [b.manifest("m0.avro", [(1, e) for e in entries])])
    b.commit()
    return scan(spark, b.root)


def scan_nested(spark, sf_dir):
    columns = [
        (1, "event_id", "long"),
        (2, "about", {"type": "struct", "fields": [{"id": 5, "name": "kind", "type": "string", "required": False}, {"id": 6, "name": "user", "type": "long", "required": False}]}),
        (3, "pair", {"type": "list", "element-id": 7, "element": "long", "element-required": False}),
        (4, "lookup", {"type": "map", "key-id": 8, "key": "string", "value-id": 9, "value": "double", "value-required": False}),
    ]
    b = TableBuilder(spark, shared_folder(spark, "table"), columns)
    df = base(spark, sf_dir, "events").select("event_id", F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("user")).alias("about"), F.array("event_id", "user_id").alias("pair"), F.create_map("event_type", "value").alias("lookup"))
    b.snapshot(ID1, T1, [b.manifest("m0.avro", [(1, e) for e in b.write_files(df, ["a.parquet"], ids(columns))])])
    b.commit()
    return scan(spark, b.root).select("event_id", F.col("about.kind").alias("kind"), F.col("about.user").alias("user_id"), F.col("pair")[1].alias("second"), F.element_at("lookup", F.col("about.kind")).alias("value"))


def scan_uuid(spark, sf_dir):
    columns = [(1, "o_orderkey", "long"), (2, "u", "uuid")]
    b = TableBuilder(spark, shared_folder(spark, "table"), columns)
    df = base(spark, sf_dir, "orders").select("o_orderkey", F.unhex(F.md5(F.col("o_orderkey").cast("string").cast("binary"))).alias("u"))
    b.snapshot(ID1, T1, [b.manifest("m0.avro", [(1, e) for e in b.write_files(df, ["a.parquet"], ids(columns))])])
    b.commit()
    return scan(spark, b.root)


def scan_sql(spark, sf_dir):
    b = deleted(spark, sf_dir)
    return sql(spark, f"SELECT l_returnflag, count(*) AS n, min(l_orderkey) AS first_key, max(l_shipdate) AS last_ship FROM lake_scan('{b.root}', {ID2}, version => '2') WHERE l_linenumber > 1 GROUP BY l_returnflag")


def scan_filter_project(spark, sf_dir):
    return scan(spark, deleted(spark, sf_dir).root).where("l_quantity > 30 and l_returnflag = 'R'").select("l_orderkey", "l_linenumber")


def scan_join(spark, sf_dir):
    orders = scan(spark, one(spark, sf_dir, name="orders", columns=ORDERS))
    lines = scan(spark, deleted(spark, sf_dir).root)
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.max("l_extendedprice").alias("top"))


def scan_window(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return scan(spark, one(spark, sf_dir, name="orders", columns=ORDERS)).withColumn("place", F.row_number().over(w)).where("place <= 2").select("o_custkey", "o_orderkey", "place")


def scan_topk(spark, sf_dir):
    return scan(spark, one(spark, sf_dir, name="orders", columns=ORDERS)).orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10).select("o_orderkey", "o_totalprice")


def scan_setops(spark, sf_dir):
    b = rewritten(spark, sf_dir)
    old, new = (scan(spark, b.root, snapshot_id=s).select("l_orderkey", "l_linenumber") for s in (ID1, ID2))
    return old.exceptAll(new)


def short(c: str):
    return F.element_at(F.split(c, "/"), -1).alias(c)


def list_files(spark, sf_dir):
    return scan(spark, deleted(spark, sf_dir, files=("a.parquet",)).root, mode="list_files").select(short("file"), "type")


def metadata_entries(spark, sf_dir):
    got = metadata(spark, rewritten(spark, sf_dir).root)
    return got.select(short("manifest_path"), "manifest_sequence_number", "manifest_content", "status", "content", short("file_path"), "file_format", "record_count")


def metadata_v1(spark, sf_dir):
    got = metadata(spark, rewritten(spark, sf_dir, version=1).root, snapshot_id=ID1)
    return got.select(short("manifest_path"), "manifest_sequence_number", "manifest_content", "status", "content", short("file_path"), "file_format", "record_count")


def snapshots_of(version):
    def run(spark, sf_dir):
        return snapshots(spark, rewritten(spark, sf_dir, version=version).root).select("sequence_number", "snapshot_id", "timestamp_ms", short("manifest_list"))

    return run


def at(ms: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms)


def but(columns, *changes):
    """columns with some of them replaced: (id, new tuple or None)."""
    new = dict(changes)
    return [new.get(c[0], c) for c in columns if new.get(c[0], c) is not None]


QUERIES = {
    "scan_latest": lambda s, d: scan(s, one(s, d)),
    "scan_count": scan_count,
    "scan_v1_copy_on_write": lambda s, d: scan(s, rewritten(s, d, version=1).root),
    "scan_position_deletes": lambda s, d: scan(s, deleted(s, d).root),
    "scan_multi_delete_files": lambda s, d: scan(s, updated(s, d)),
    "scan_by_snapshot_id": lambda s, d: scan(s, rewritten(s, d).root, snapshot_id=ID1),
    "scan_by_timestamp_exact": lambda s, d: scan(s, rewritten(s, d).root, as_of=at(T2)),
    "scan_by_timestamp_between": lambda s, d: scan(s, rewritten(s, d).root, as_of=at(T2 - 1)),
    "scan_by_version": lambda s, d: scan(s, rewritten(s, d).root, version="1"),
    "scan_hint_file_arg": scan_hint_file_arg,
    "scan_version_name_format": scan_version_name_format,
    "scan_metadata_json_path": lambda s, d: scan(s, f"{deleted(s, d).root}/metadata/v2.metadata.json"),
    "scan_gzip_metadata": scan_gzip_metadata,
    "scan_version_guess": scan_version_guess,
    "scan_moved_paths": scan_moved_paths,
    "scan_skip_schema": lambda s, d: scan(s, deleted(s, d).root, skip_schema_inference=True),
    "scan_added_column": lambda s, d: evolved(s, d, ORDERS, [*ORDERS, (7, "o_note", "string")], "orders"),
    "scan_dropped_column": lambda s, d: evolved(s, d, ORDERS, but(ORDERS, (3, None)), "orders"),
    "scan_renamed": lambda s, d: evolved(s, d, ORDERS, but(ORDERS, (4, (4, "price", "double"))), "orders"),
    "scan_swapped_names": lambda s, d: evolved(s, d, LINEITEM, but(LINEITEM, (1, (1, "l_partkey", "long")), (2, (2, "l_orderkey", "long")))).where("l_orderkey > 50"),
    "scan_dropped_readded": lambda s, d: evolved(s, d, ORDERS, but(ORDERS, (4, (7, "o_totalprice", "double"))), "orders"),
    "scan_promoted_int_long": lambda s, d: evolved(s, d, LINEITEM, but(LINEITEM, (4, (4, "l_linenumber", "long")))),
    "scan_partition_dirs": scan_partition_dirs,
    "scan_nested": scan_nested,
    "scan_uuid": scan_uuid,
    "scan_sql": scan_sql,
    "scan_filter_project": scan_filter_project,
    "scan_agg": lambda s, d: scan(s, deleted(s, d).root).groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"), F.sum("l_orderkey").alias("keys")),
    "scan_join": scan_join,
    "scan_window": scan_window,
    "scan_topk": scan_topk,
    "scan_setops": scan_setops,
    "list_files": list_files,
    "metadata_entries": metadata_entries,
    "metadata_v1": metadata_v1,
    "snapshots_v1": snapshots_of(1),
    "snapshots_v2": snapshots_of(2),
}

LEFT = "SELECT * FROM lineitem WHERE NOT (l_extendedprice < 10000)"
ALL, ORD = "SELECT * FROM lineitem", "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def entry_values(rows: list[str]) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") t(manifest_path, manifest_sequence_number, manifest_content, status, content, file_path, file_format, record_count)"


def snapshot_values(first: int, second: int) -> str:
    rows = f"({first}::BIGINT, {ID1}::BIGINT, TIMESTAMP '2023-02-15 15:07:54.504', 'snap-{ID1}.avro'), ({second}::BIGINT, {ID2}::BIGINT, TIMESTAMP '2023-02-15 15:08:14.730', 'snap-{ID2}.avro')"
    return f"SELECT * FROM (VALUES {rows}) t(sequence_number, snapshot_id, timestamp_ms, manifest_list)"


ORACLES = {
    "scan_count": "SELECT count(*) AS n FROM lineitem",
    "scan_multi_delete_files": "SELECT * REPLACE (CASE WHEN l_linenumber = 1 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity) FROM lineitem",
    "scan_added_column": "SELECT *, CAST(NULL AS VARCHAR) AS o_note FROM orders",
    "scan_dropped_column": "SELECT * EXCLUDE (o_orderstatus) FROM orders",
    "scan_renamed": "SELECT * RENAME (o_totalprice AS price) FROM orders",
    "scan_swapped_names": "SELECT * EXCLUDE (l_orderkey, l_partkey), l_orderkey AS l_partkey, l_partkey AS l_orderkey FROM lineitem WHERE l_partkey > 50",
    "scan_dropped_readded": "SELECT * REPLACE (CAST(NULL AS DOUBLE) AS o_totalprice) FROM orders",
    "scan_promoted_int_long": "SELECT * REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM lineitem",
    "scan_partition_dirs": f"SELECT {ORD} FROM orders",
    "scan_nested": "SELECT event_id, event_type AS kind, user_id, user_id AS second, value FROM events",
    "scan_uuid": "SELECT o_orderkey, regexp_replace(md5(CAST(o_orderkey AS VARCHAR)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS u FROM orders",
    "scan_sql": f"SELECT l_returnflag, count(*) AS n, min(l_orderkey) AS first_key, max(l_shipdate) AS last_ship FROM ({LEFT}) WHERE l_linenumber > 1 GROUP BY l_returnflag",
    "scan_filter_project": f"SELECT l_orderkey, l_linenumber FROM ({LEFT}) WHERE l_quantity > 30 AND l_returnflag = 'R'",
    "scan_agg": f"SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_extendedprice) AS low, max(l_extendedprice) AS high, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM ({LEFT}) GROUP BY ALL",
    "scan_join": f"SELECT o_orderpriority, count(*) AS n, max(l_extendedprice) AS top FROM ({LEFT}) JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority",
    "scan_window": "SELECT o_custkey, o_orderkey, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders) WHERE place <= 2",
    "scan_topk": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "scan_setops": f"SELECT l_orderkey, l_linenumber FROM lineitem EXCEPT ALL SELECT l_orderkey, l_linenumber FROM ({LEFT})",
    "list_files": "SELECT * FROM (VALUES ('a.parquet', 'data'), ('d0.parquet', 'delete')) t(file, type)",
    "metadata_entries": entry_values([f"('m1.avro', 2::BIGINT, 'DATA', 'ADDED', 'EXISTING', 'b.parquet', 'PARQUET', (SELECT count(*) FROM ({LEFT})))", "('m2.avro', 2::BIGINT, 'DATA', 'DELETED', 'EXISTING', 'a.parquet', 'PARQUET', (SELECT count(*) FROM lineitem))"]),
    "metadata_v1": entry_values(["('m0.avro', 0::BIGINT, 'DATA', 'ADDED', 'EXISTING', 'a.parquet', 'PARQUET', (SELECT count(*) FROM lineitem))"]),
    "snapshots_v1": snapshot_values(0, 0),
    "snapshots_v2": snapshot_values(1, 2),
}
ORACLES |= {k: ALL for k in ("scan_latest", "scan_by_snapshot_id", "scan_by_timestamp_between", "scan_by_version", "scan_hint_file_arg", "scan_version_name_format", "scan_gzip_metadata", "scan_version_guess")}
ORACLES |= {k: LEFT for k in ("scan_v1_copy_on_write", "scan_position_deletes", "scan_by_timestamp_exact", "scan_metadata_json_path", "scan_moved_paths", "scan_skip_schema")}
