"""Scans of built tables: deletes, moves, evolution, plans, errors; random histories against a model."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import lakelens
from lakelens import queries as Q
from lakelens.errors import InvalidInputError, NotSupportedError, TableIOError
from lakelens.functions import tables as functions
from lakelens.operators import scan as scans
from lakelens.plans import snapshot as plans
from lakelens.sources import avro
from lakelens.sources.files import shared_folder
from lakelens.testing.builder import TableBuilder

COLUMNS = [(1, "id", "long"), (2, "name", "string"), (3, "v", "int")]


def table(spark, tmp_path, columns=COLUMNS, **kw):
    return TableBuilder(spark, f"{tmp_path}/t", columns, **kw)


def rows(spark, n, start=0):
    return spark.range(start, start + n).select("id", F.concat(F.lit("n"), F.col("id")).alias("name"), (F.col("id") % 7).cast("int").alias("v"))


def plan_text(df):
    return df._jdf.queryExecution().toString()


def test_deletes_and_pushdown(spark, tmp_path):
    b = table(spark, tmp_path)
    entries = b.write_files(rows(spark, 100), ["a b.parquet", "c%20#+ü.parquet"], Q.ids(COLUMNS))
    b.snapshot(1, 1000, [b.manifest("m0.avro", [(1, e) for e in entries])])
    b.commit()
    df = lakelens.scan(spark, b.root)
    assert df.count() == 100 and "LeftAnti" not in plan_text(df) and df.schema["id"].nullable
    gone = b.write_deletes([(e, b.read_rows(e).where("id % 3 = 0")) for e in entries], "d.parquet")
    b.snapshot(2, 2000, [b.manifest("m1.avro", [(0, e) for e in entries]), b.manifest("m2.avro", [(1, gone)], content=1)])
    b.commit("v2", "2")
    df = lakelens.scan(spark, b.root)
    assert sorted(x.id for x in df.collect()) == [i for i in range(100) if i % 3]
    text = plan_text(df.where("v > 5").select("id"))
    assert "LeftAnti" in text and "PushedFilters: [IsNotNull(__fid_3), GreaterThan(__fid_3,5)]" in text and "__fid_2" not in text.split("== Physical Plan ==")[1]
    plan = lakelens.table_plan(spark, b.root)
    assert (plan.data_rows, plan.delete_rows) == (100, 34)
    assert lakelens.scan(spark, b.root, snapshot_id=1).count() == 100
    files = [(x.file.rsplit("/", 1)[-1], x.type) for x in lakelens.scan(spark, b.root, mode="list_files").collect()]
    assert files == [("a b.parquet", "data"), ("c%20#+ü.parquet", "data"), ("d.parquet", "delete")]


def test_moved_paths(spark, tmp_path):
    b = table(spark, tmp_path, stored_root="s3://old/place")
    entries = b.write_files(rows(spark, 20), ["x y.parquet"], Q.ids(COLUMNS))
    gone = b.write_deletes([(entries[0], b.read_rows(entries[0]).where("id < 5"))], "d.parquet")
    b.snapshot(1, 1000, [b.manifest("m1.avro", [(1, entries[0])]), b.manifest("m2.avro", [(1, gone)], content=1)])
    b.commit()
    assert lakelens.scan(spark, b.root, allow_moved_paths=True).count() == 15
    assert lakelens.metadata(spark, b.root, allow_moved_paths=True).first().file_path == "s3://old/place/data/x y.parquet"
    with pytest.raises(InvalidInputError, match="allow_moved_paths needs the table"):
        lakelens.scan(spark, f"{b.root}/metadata/v1.metadata.json", allow_moved_paths=False)


def test_errors(spark, tmp_path):
    b = table(spark, tmp_path)
    entry = b.write_files(rows(spark, 3), ["a.parquet"], Q.ids(COLUMNS))[0]
    b.snapshot(1, 1000, [b.manifest("m.avro", [(1, entry | {"file_format": "orc"})])])
    b.snapshot(2, 2000, [b.manifest("m2.avro", [(1, entry)]), b.manifest("m3.avro", [(1, entry | {"content": 2})], content=1)])
    b.snapshot(3, 3000, [])
    b.files.write(f"{b.root}/metadata/broken.avro", b"Obj\x01junk")
    b.snapshot(4, 3500, [{**b.manifest("m4.avro", []), "manifest_path": f"{b.root}/metadata/broken.avro"}])
    b.commit()
    for s, error in ((1, NotSupportedError), (2, NotSupportedError), (4, TableIOError)):
        with pytest.raises(error):
            lakelens.scan(spark, b.root, snapshot_id=s)
    empty = lakelens.scan(spark, b.root, snapshot_id=3)
    assert empty.columns == ["id", "name", "v"] and empty.count() == 0
    with pytest.raises(NotSupportedError, match="Unknown mode"):
        lakelens.scan(spark, b.root, snapshot_id=3, mode="x")
    with pytest.raises(InvalidInputError):
        lakelens.scan(spark, b.root, snapshot_id=3, as_of=Q.at(1))
    b.files.write(f"{b.root}/metadata/v5.metadata.json", b"{")
    with pytest.raises(TableIOError):
        lakelens.snapshots(spark, b.root, version="5")


def test_many_manifests_are_decoded_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(plans, "DRIVER_MANIFESTS", 2)
    b = table(spark, tmp_path, codec="deflate")
    entries = b.write_files(rows(spark, 60), [f"{k}.parquet" for k in range(4)], Q.ids(COLUMNS))
    b.snapshot(1, 1000, [b.manifest(f"m {k}.avro", [(1, e)]) for k, e in enumerate(entries)])
    b.commit()
    assert lakelens.scan(spark, b.root).count() == 60
    assert [x.file_path.rsplit("/", 1)[-1] for x in lakelens.metadata(spark, b.root).collect()] == [f"{k}.parquet" for k in range(4)]


def test_time_travel_uses_current_schema(spark, tmp_path):
    b = table(spark, tmp_path)
    b.snapshot(1, 1000, [b.manifest("m.avro", [(1, e) for e in b.write_files(rows(spark, 5), ["a.parquet"], Q.ids(COLUMNS))])])
    b.commit()
    b.evolve([(1, "key", "long"), (9, "name", "string"), (3, "v", "long")])
    b.commit("v2", "2")
    now, then = lakelens.scan(spark, b.root, snapshot_id=1), lakelens.scan(spark, b.root, version="1")
    assert dict(now.dtypes) == {"key": "bigint", "name": "string", "v": "bigint"} and dict(then.dtypes)["v"] == "int"
    assert now.where("name is null").count() == 5 and then.where("name is not null").count() == 5


def test_sql(spark, tmp_path):
    b = table(spark, tmp_path)
    b.snapshot(7, 1000, [b.manifest("m.avro", [(1, e) for e in b.write_files(rows(spark, 5), ["a.parquet"], Q.ids(COLUMNS))])])
    b.commit()
    lakelens.register(spark)
    got = lakelens.sql(spark, f"SELECT s.snapshot_id, (SELECT count(*) FROM lake_scan('{b.root}', 7) x JOIN LAKE_SCAN('{b.root}', TIMESTAMP '1970-01-01 00:00:01') y ON x.id = y.id) AS n FROM lake_snapshots('{b.root}', version => '1') s").first()
    assert (got.snapshot_id, got.n) == (7, 5)
    assert lakelens.sql(spark, f"SELECT * FROM lake_metadata('{b.root}')").columns[:3] == ["manifest_path", "manifest_sequence_number", "manifest_content"]
    with pytest.raises(InvalidInputError):
        lakelens.sql(spark, f"SELECT * FROM lake_snapshots('{b.root}', 5)")
    with pytest.raises(InvalidInputError):
        lakelens.sql(spark, f"SELECT * FROM lake_scan('{b.root}', nonsense => 1)")


@pytest.mark.parametrize("seed", range(3))
def test_random_history(spark, seed):
    """Appends, deletes, renames, promotions against a model of rows."""
    rng = random.Random(seed)
    columns = list(COLUMNS)
    b = TableBuilder(spark, shared_folder(spark, "history"), columns)
    data, deletes, model, at = [], [], {}, 0
    for step in range(6):
        action = rng.choice(["append", "delete", "rename", "promote"]) if step else "append"
        if action == "append":
            n = rng.randint(1, 30)
            first = [(1, "id", "long"), (2, "name", "string"), (3, "v", "int")]
            data += b.write_files(rows(spark, n, at), [f"f{step}.parquet"], Q.ids(first))
            model |= {i: (f"n{i}", i % 7) for i in range(at, at + n)}
            at += n
        elif action == "delete":
            k = rng.randint(0, 6)
            deletes.append(b.write_deletes([(e, b.read_rows(e).where(f"v = {k}")) for e in data], f"d{step}.parquet"))
            model = {i: x for i, x in model.items() if x[1] != k}
        elif action == "rename":
            columns = [(1, "id", "long"), (2, f"name{step}", "string"), columns[2]]
            b.evolve(columns)
        else:
            columns = [*columns[:2], (3, columns[2][1], "long")]
            b.evolve(columns)
        b.snapshot(step + 1, step + 1, [b.manifest(f"m{step}.avro", [(0, e) for e in data]), b.manifest(f"k{step}.avro", [(1, e) for e in deletes], content=1)])
        b.commit(f"v{step}", str(step))
    got = {x[0]: (x[1], x[2]) for x in lakelens.scan(spark, b.root).collect()}
    assert got == model


def test_sql_leaves_strings_and_session_alone(spark):
    """The text of a call inside a string or a comment is not a call, no view stays behind, and a scan keeps the time zone."""
    got = lakelens.sql(spark, "SELECT 'see lake_scan(''x'')' AS a, \"lake_scan('y')\" AS b -- lake_scan('z')")
    assert got.first() == ("see lake_scan('x')", "lake_scan('y')")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("__lake")]
    from lakelens.operators.scan import prepare

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        prepare(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_names_that_look_like_patterns(spark, tmp_path):
    from lakelens.sources.files import literal

    path = str(tmp_path / "a[1]{x}*.parquet")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(literal(path)).count() == 3


def test_files_outside_delete_bounds_are_not_joined(spark, tmp_path):
    b = table(spark, tmp_path)
    entries = b.write_files(rows(spark, 90), [f"{k}.parquet" for k in range(3)], Q.ids(COLUMNS))
    gone = b.write_deletes([(entries[1], b.read_rows(entries[1]).where("__pos % 2 = 0"))], "d.parquet")
    b.snapshot(1, 1000, [b.manifest("m.avro", [(1, e) for e in entries]), b.manifest("d.avro", [(1, gone)], content=1)])
    b.commit()
    expected = {tuple(r) for r in lakelens.scan(spark, b.root).collect()}
    plan = functions.table_plan(spark, b.root)
    name = entries[1]["file_path"].encode()
    bounded = [replace(m, entries=[replace(e, low=name, high=name) if e.content else e for e in m.entries]) for m in plan.manifests]
    plan = replace(plan, manifests=bounded)
    assert scans.touched(plan, plan.entries(0)) == [False, True, False]
    df = scans.scan_plan(spark, plan)
    assert {tuple(r) for r in df.collect()} == expected and len(expected) == 90 - (entries[1]["record_count"] + 1) // 2
    assert str(df._jdf.queryExecution().optimizedPlan()).count("LeftAnti") == 1


def test_keys_of_files_are_apart():
    names = {f"s3a://b/{k}.parquet" for k in range(5000)}
    keys, bits, _ = scans.file_keys(names, 1 << 20)
    assert len({k >> bits for k in keys.values()}) == len(names) and bits >= 21 and all(-(1 << 63) <= k < 1 << 63 for k in keys.values())


def test_deletes_above_the_broadcast_limit(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scans, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(scans, "INLINE_FILES", 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = table(spark, tmp_path)
        entries = b.write_files(rows(spark, 500), ["a b.parquet", "c.parquet"], Q.ids(COLUMNS))
        gone = b.write_deletes([(e, b.read_rows(e).where("__pos % 3 = 0")) for e in entries] * 2, "d.parquet")  # each twice
        b.snapshot(1, 1000, [b.manifest("m.avro", [(1, e) for e in entries]), b.manifest("d.avro", [(1, gone)], content=1)])
        b.commit()
        df = lakelens.scan(spark, b.root)
        assert df.count() == sum(e["record_count"] - (e["record_count"] + 2) // 3 for e in entries)
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_table_functions_of_plain_sql(spark, tmp_path):
    b = table(spark, tmp_path, codec="deflate")
    b.snapshot(7, 1000, [b.manifest("m.avro", [(1, e) for e in b.write_files(rows(spark, 5), ["a.parquet"], Q.ids(COLUMNS))])])
    b.commit()
    lakelens.register(spark)
    for name, path in (("lake_snapshots", b.root), ("lake_metadata", b.root)):
        for at in (path, f"{path}/metadata/v1.metadata.json"):
            plain = spark.sql(f"SELECT * FROM {name}('{at}')")
            ours = {"lake_snapshots": lakelens.snapshots, "lake_metadata": lakelens.metadata}[name](spark, at)
            assert plain.schema == ours.schema and plain.collect() == ours.collect()
    assert spark.sql(f"SELECT * FROM lake_snapshots('{b.root}', version => '1')").count() == 1
    assert spark.sql(f"SELECT file_path FROM lake_metadata('{b.root}', 7) WHERE record_count = 5").count() == 1
    with pytest.raises(Exception, match="Could not find snapshot with id 8"):
        spark.sql(f"SELECT * FROM lake_metadata('{b.root}', 8)").collect()


def test_avro_projection_skips_what_is_not_wanted():
    inner = {"type": "record", "name": "i", "fields": [{"name": "a", "type": {"type": "array", "items": ["null", "bytes"]}}, {"name": "b", "type": "string"}]}
    schema = {"type": "record", "name": "o", "fields": [{"name": "i", "type": inner}, {"name": "x", "type": "long"}, {"name": "y", "type": ["null", "string"]}]}
    records = [{"i": {"a": [b"1", None, b""], "b": str(k)}, "x": -k, "y": None if k % 2 else "z"} for k in range(9)]
    data = avro.write(schema, records)
    assert avro.read(data) == records
    assert avro.read(data, {"i": {"b": None}, "y": None}) == [{"i": {"b": r["i"]["b"]}, "y": r["y"]} for r in records]
