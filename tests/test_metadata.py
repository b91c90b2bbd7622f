"""Metadata resolution, snapshot choice, schema and Avro parsing."""

import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from lakelens.errors import InvalidInputError, LakeError, NotSupportedError, TableIOError
from lakelens.functions.tables import arguments
from lakelens.plans.snapshot import choose, milliseconds
from lakelens.sources import avro
from lakelens.sources.metadata import Options, full_path, metadata_file, parse
from lakelens.sources.schema import columns, current_columns, spark_type


def doc(**kw):
    schema = {"type": "struct", "schema-id": 0, "fields": [{"id": 1, "name": "a", "type": "int", "required": True}]}
    snaps = [{"snapshot-id": i, "sequence-number": i, "timestamp-ms": t, "manifest-list": f"m{i}"} for i, t in ((1, 1000), (2, 3000), (3, 3000), (4, 2000))]
    return {"format-version": 2, "current-schema-id": 0, "schemas": [schema], "snapshots": snaps} | kw


def test_snapshot_choice():
    m = parse(doc())
    when = lambda ms: dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms)
    assert choose(m, None, None).snapshot_id == 3  # the later of equal times
    assert choose(m, 4, None).snapshot_id == 4 and choose(m, None, when(1000)).snapshot_id == 1 and choose(m, None, when(2999)).snapshot_id == 4
    for args, text in (((9, None), "Could not find snapshot with id 9"), ((None, when(999)), "Could not find latest snapshots for timestamp"), ((None, dt.datetime(1960, 1, 1)), "Could not find latest")):
        with pytest.raises(TableIOError, match=text):
            choose(m, *args)
    with pytest.raises(TableIOError, match="No snapshots found"):
        choose(parse(doc(snapshots=None)), None, None)
    assert milliseconds(dt.datetime(1970, 1, 1, 2, tzinfo=dt.timezone(dt.timedelta(hours=2)))) == 0


def test_parse_errors():
    for bad, text in (
        (doc(**{"current-schema-id": 5}), "no schema of schema-id 5"),
        ({k: v for k, v in doc().items() if k != "schemas"}, "Neither a valid schema or schemas field was found"),
        (doc(snapshots=[3]), "A snapshot in the metadata file has a missing or wrong field"),
        (doc(snapshots=[{"snapshot-id": 1, "sequence-number": 1, "timestamp-ms": 1}]), "missing or wrong member: manifest-list"),
        (doc(snapshots=[{"snapshot-id": "x", "sequence-number": 1, "timestamp-ms": 1, "manifest-list": ""}]), "missing or wrong member: snapshot-id"),
        ({}, "missing or wrong member: format-version"),
    ):
        with pytest.raises(TableIOError, match=text):
            parse(bad)
    with pytest.raises(NotSupportedError):
        parse(doc(**{"format-version": 3}))
    v1 = parse({"format-version": 1, "schema": doc()["schemas"][0], "snapshots": [{"snapshot-id": 7, "timestamp-ms": 1, "manifest-list": "m"}]})
    assert v1.snapshots[0].sequence_number == 0 and v1.columns[0].name == "a"
    assert parse(doc(schemas=[{"type": "struct", "schema-id": 0, "fields": [{"id": 1, "name": "a", "type": "variant", "required": True}]}]), skip_schema=True).columns is None


def test_types():
    plain = {"boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "date": T.DateType(), "time": T.TimeType(6), "timestamp": T.TimestampNTZType(), "timestamptz": T.TimestampType(), "string": T.StringType(), "uuid": T.BinaryType(), "fixed[16]": T.BinaryType(), "binary": T.BinaryType(), "decimal(9, 2)": T.DecimalType(9, 2), "decimal(38,10)": T.DecimalType(38, 10)}
    assert {k: spark_type(k) for k in plain} == plain
    nested = {"type": "list", "element": {"type": "map", "key": "string", "value": {"type": "struct", "fields": [{"name": "x", "type": "int"}]}}}
    assert spark_type(nested) == T.ArrayType(T.MapType(T.StringType(), T.StructType([T.StructField("x", T.IntegerType())])))
    with pytest.raises(TableIOError, match='Unknown type in the schema: "timestamp_ns"'):
        spark_type("timestamp_ns")
    for bad in ({"type": "tuple"}, None, 5, {"type": "list"}):
        with pytest.raises(TableIOError, match="missing or wrong member: type"):
            spark_type(bad)
    with pytest.raises(TableIOError, match="not a struct of fields"):
        columns({"type": "list"})
    with pytest.raises(TableIOError, match="wrong member: required"):
        columns({"type": "struct", "fields": [{"id": 1, "name": "a", "type": "int"}]})
    with pytest.raises(TableIOError, match="schema-id"):
        current_columns([{"type": "struct", "fields": []}], 0)


def test_full_path():
    assert full_path("s3://b/w/t/data/x=1/a.parquet", "/new/") == "/new/data/x=1/a.parquet"
    assert full_path("/a/data/t/metadata/m.avro", "/new") == "/new/metadata/m.avro"
    assert full_path("/a/data/data/f", "/new") == "/new/data/f"
    with pytest.raises(TableIOError, match="moved path needs"):
        full_path("/a/b.parquet", "/new")


SCHEMA = {"type": "record", "name": "r", "fields": [{"name": "a", "type": "long"}, {"name": "b", "type": ["null", "string"]}, {"name": "c", "type": {"type": "array", "items": "int"}}, {"name": "d", "type": "bytes"}, {"name": "e", "type": "boolean"}]}
RECORDS = st.lists(st.fixed_dictionaries({"a": st.integers(-(2**63), 2**63 - 1), "b": st.none() | st.text(), "c": st.lists(st.integers(-(2**31), 2**31 - 1)), "d": st.binary(), "e": st.booleans()}))


@settings(max_examples=60, deadline=None)
@given(RECORDS, st.sampled_from(["null", "deflate"]))
def test_avro_round_trip(records, codec):
    data = avro.write(SCHEMA, records, codec)
    assert avro.read(data) == records
    if records:
        header = data.index(avro.SYNC) + len(avro.SYNC)
        assert avro.read(data[:header]) == []  # a file that ends with its header is whole
        for cut in {3, len(data) // 2, len(data) - 1} - {header}:
            with pytest.raises(LakeError):
                avro.read(data[:cut])


def test_avro_codecs():
    import pyarrow as pa
    import zstandard

    raw = b"abc" * 500
    assert avro.unpack("snappy", pa.compress(raw, codec="snappy", asbytes=True) + b"crc!") == raw
    assert avro.unpack("zstandard", zstandard.compress(raw)) == raw
    with pytest.raises(TableIOError):
        avro.unpack("lz9", raw)


def test_resolution(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(TableIOError, match="Metadata directory does not exist"):
        metadata_file(spark, root, Options())
    folder = tmp_path / "metadata"
    folder.mkdir()
    name = lambda **kw: metadata_file(spark, root, Options(**kw)).rsplit("/", 1)[-1]
    assert metadata_file(spark, "/x/y.json", Options(version="nonsense")) == "/x/y.json"
    spark.conf.unset("unsafe_enable_version_guessing")
    with pytest.raises(InvalidInputError, match="SET unsafe_enable_version_guessing = true"):
        name()
    spark.sql("SET unsafe_enable_version_guessing = true")
    with pytest.raises(TableIOError, match="with compression 'none', so no version can be guessed"):
        name()
    for v in ("v9", "v10", "v2.gz", "7"):
        (folder / f"{v}.metadata.json").write_text(json.dumps(doc()))
    assert name() == "v9.metadata.json" and name(metadata_compression_codec="gzip") == "v2.gz.metadata.json"
    spark.conf.unset("unsafe_enable_version_guessing")
    assert name(version="10") == "v10.metadata.json" and name(version="7") == "7.metadata.json"
    assert name(version="2", metadata_compression_codec="gzip") == "v2.gz.metadata.json"
    with pytest.raises(TableIOError, match="table version '1' using 'blarg' compression and format\\(s\\): 'blat%s%s'"):
        name(version="1", metadata_compression_codec="blarg", version_name_format="blat%s%s")
    with pytest.raises(TableIOError, match="not found for table version '2'"):
        name(version="2")
    (folder / "hint.txt").write_text("10\n")
    assert name(version="hint.txt") == "v10.metadata.json"
    (folder / "version-hint.text").write_text("9")
    assert name() == "v9.metadata.json"


def test_sql_arguments():
    args, named = arguments("'/a/it''s', 12, Version => '1', ALLOW_MOVED_PATHS=true", "f")
    assert args == ["/a/it's", 12] and named == {"version": "1", "allow_moved_paths": True}
    assert arguments("'p', TIMESTAMP '2023-02-15 15:07:54.504'", "f")[0][1] == dt.datetime(2023, 2, 15, 15, 7, 54, 504000) == arguments("'p', '2023-02-15 15:07:54.504'::TIMESTAMP", "f")[0][1]
    with pytest.raises(InvalidInputError):
        arguments("'p', !", "f")


def test_avro_named_types_and_damage():
    """A type by its full name, and a damaged block of any codec."""
    from lakelens.sources import avro

    fixed = {"type": "record", "name": "r", "namespace": "n.s", "fields": [{"name": "a", "type": {"type": "record", "name": "x", "fields": [{"name": "v", "type": "long"}]}}, {"name": "b", "type": "n.s.x"}]}
    names: dict = {}
    avro.collect(fixed, names)
    assert avro.Reader(avro.put_long(3) + avro.put_long(4)).value(fixed, names) == {"a": {"v": 3}, "b": {"v": 4}}
    for codec in ("deflate", "xz", "bzip2", "zstandard", "snappy"):
        whole = avro.write({"type": "record", "name": "r", "fields": [{"name": "v", "type": "long"}]}, [{"v": 1}], codec="null")
        damaged = whole.replace(b"avro.codec" + avro.put_long(4) + b"null", b"avro.codec" + avro.put_long(len(codec)) + codec.encode())
        with pytest.raises(TableIOError):
            avro.read(damaged)
