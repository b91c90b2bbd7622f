"""The public table functions, and SQL over them."""

from __future__ import annotations

import ast
import datetime as dt
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import InvalidInputError, NotSupportedError
from ..operators.scan import prepare, scan_plan
from ..plans.snapshot import TablePlan, entry_columns, entry_frame, few, list_manifests, plan_table, with_entries
from ..sources.files import Files, WorkerFiles
from ..sources.metadata import GUESSING, UNKNOWN_VERSION, VERSION_FORMATS, Options, load, may_guess

METADATA_DDL = "manifest_path string, manifest_sequence_number long, manifest_content string, status string, content string, file_path string, file_format string, record_count long"
SNAPSHOTS_DDL = "sequence_number long, snapshot_id long, timestamp_ms timestamp_ntz, manifest_list string"


def table_plan(spark: SparkSession, path: str, *, snapshot_id: int | None = None, as_of: dt.datetime | None = None, allow_moved_paths: bool | None = None, skip_schema_inference: bool = False, metadata_compression_codec: str = "none", version: str = UNKNOWN_VERSION, version_name_format: str = VERSION_FORMATS) -> TablePlan:
    """The files of a snapshot and the row counts its manifests claim (data_rows, delete_rows)."""
    not_both(snapshot_id, as_of)
    options = Options(allow_moved_paths, skip_schema_inference, metadata_compression_codec, version, version_name_format)
    return plan_table(spark, path, options, snapshot_id, as_of)


def not_both(snapshot_id: int | None, as_of: dt.datetime | None) -> None:
    if snapshot_id is not None and as_of is not None:
        raise InvalidInputError("Give a snapshot id or a timestamp, not both")


def scan(spark: SparkSession, path: str, *, mode: str = "default", allow_moved_paths: bool | None = None, **options) -> DataFrame:
    """The table's rows at a snapshot (latest, by id, or as of a time); with mode='list_files', its files instead."""
    if allow_moved_paths is not None and path.endswith(".json"):
        raise InvalidInputError("allow_moved_paths needs the table's folder, not a metadata file")
    plan = table_plan(spark, path, allow_moved_paths=allow_moved_paths, **options)
    if mode == "list_files":
        rows = [(plan.path(e.file_path), kind) for c, kind in ((0, "data"), (1, "delete")) for e in plan.entries(c)]
        return spark.createDataFrame(rows, "file string, type string")
    if mode != "default":
        raise NotSupportedError(f"Unknown mode: '{mode}'")
    return scan_plan(spark, plan)


def metadata(spark: SparkSession, path: str, *, snapshot_id: int | None = None, as_of: dt.datetime | None = None, allow_moved_paths: bool | None = None, skip_schema_inference: bool = False, metadata_compression_codec: str = "none", version: str = UNKNOWN_VERSION, version_name_format: str = VERSION_FORMATS) -> DataFrame:
    """One row for each manifest entry of a snapshot, removed files included; paths as stored. Many manifests are decoded by
    tasks, whose rows don't pass the driver."""
    not_both(snapshot_id, as_of)
    files, options = Files(spark), Options(allow_moved_paths, skip_schema_inference, metadata_compression_codec, version, version_name_format)
    listed = list_manifests(files, may_guess(spark), path, options, snapshot_id, as_of)
    if not few(listed.manifests):
        return entry_frame(spark, listed, METADATA_DDL)
    return spark.createDataFrame(metadata_rows(with_entries(files, listed)), METADATA_DDL)


def metadata_rows(plan: TablePlan) -> list[tuple]:
    return [entry_columns({"manifest_path": m.path, "sequence_number": m.sequence_number, "content": m.content}, e) for m in plan.manifests for e in m.entries]


def snapshots(spark: SparkSession, path: str, *, skip_schema_inference: bool = False, metadata_compression_codec: str = "none", version: str = UNKNOWN_VERSION, version_name_format: str = VERSION_FORMATS) -> DataFrame:
    """One row for each snapshot, in the order of the metadata file."""
    found = load(Files(spark), may_guess(spark), path, Options(None, skip_schema_inference, metadata_compression_codec, version, version_name_format))
    return spark.createDataFrame([(s.sequence_number, s.snapshot_id, s.timestamp, s.manifest_list) for s in found.snapshots], SNAPSHOTS_DDL)


def table_functions(guessing: bool) -> dict[str, type]:
    """lake_metadata and lake_snapshots for plain SQL: a worker reads the files, so they are planned like any other call."""

    class LakeMetadata:
        def eval(self, path, snapshot=None, allow_moved_paths=None, skip_schema_inference=False, metadata_compression_codec="none", version=UNKNOWN_VERSION, version_name_format=VERSION_FORMATS):
            at = {} if snapshot is None else {"as_of" if isinstance(snapshot, dt.datetime) else "snapshot_id": snapshot}
            options = Options(allow_moved_paths, skip_schema_inference, metadata_compression_codec, version, version_name_format)
            yield from metadata_rows(with_entries(WorkerFiles(), list_manifests(WorkerFiles(), guessing, path, options, **at)))

    class LakeSnapshots:
        def eval(self, path, skip_schema_inference=False, metadata_compression_codec="none", version=UNKNOWN_VERSION, version_name_format=VERSION_FORMATS):
            found = load(WorkerFiles(), guessing, path, Options(None, skip_schema_inference, metadata_compression_codec, version, version_name_format))
            for s in found.snapshots:
                yield s.sequence_number, s.snapshot_id, s.timestamp, s.manifest_list

    return {"lake_metadata": F.udtf(LakeMetadata, returnType=METADATA_DDL), "lake_snapshots": F.udtf(LakeSnapshots, returnType=SNAPSHOTS_DDL)}


FUNCTIONS = {"lake_scan": scan, "lake_metadata": metadata, "lake_snapshots": snapshots}
#: Calls, after what may hold the text of one without being one: strings, quoted names and comments.
CALL = re.compile(
    r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/|"""
    rf"\b({'|'.join(FUNCTIONS)})\s*\(((?:[^()']|'(?:[^']|'')*'|\([^()]*\))*)\)",
    re.IGNORECASE | re.DOTALL,
)
ARGUMENT = re.compile(r"""\s*(?:(\w+)\s*(?:=>|:=|=)\s*)?(?:(?:TIMESTAMP\s+)('(?:[^']|'')*')|('(?:[^']|'')*')(?:\s*::\s*(TIMESTAMP))?|(\d+)|(true|false))(?:\s*::\s*\w+)?\s*(?:,|$)""", re.IGNORECASE)


def arguments(text: str, name: str) -> tuple[list, dict]:
    """Positional and named arguments of a call; names in any case."""
    at, args, named = 0, [], {}
    while at < len(text.rstrip()):
        m = ARGUMENT.match(text, at)
        if not m:
            raise InvalidInputError(f"Cannot read the arguments of {name}: {text[at:]}")
        key, stamp, string, cast, number, flag = m.groups()
        quoted = stamp or string
        value = quoted[1:-1].replace("''", "'") if quoted else int(number) if number else ast.literal_eval(flag.capitalize())
        if stamp or cast:
            value = dt.datetime.fromisoformat(value)
        if key:
            named[key.lower()] = value
        else:
            args.append(value)
        at = m.end()
    return args, named


def sql(spark: SparkSession, query: str, **tables) -> DataFrame:
    """spark.sql with the table functions lake_scan, lake_metadata and lake_snapshots in FROM:

    SELECT count(*) FROM lake_scan('path', 1234, allow_moved_paths => true)
    SELECT * FROM lake_scan('path', TIMESTAMP '2023-02-15 15:07:54.504')
    """

    views = []

    def planned(m: re.Match) -> str:
        if m[1] is None:
            return m[0]
        name = m[1].lower()
        args, named = arguments(m[2], name)
        if not args or not isinstance(args[0], str) or len(args) > (1 if name == "lake_snapshots" else 2):
            raise InvalidInputError(f"{name} takes a path" + " and a snapshot id or a timestamp" * (name != "lake_snapshots"))
        if len(args) == 2:
            named["as_of" if isinstance(args[1], dt.datetime) else "snapshot_id"] = args[1]
        try:
            df = FUNCTIONS[name](spark, args[0], **named)
        except TypeError as e:
            raise InvalidInputError(f"{name}: {e}") from e
        view = f"__{name}_{uuid.uuid4().hex}"
        df.createOrReplaceTempView(view)
        views.append(view)
        return view

    try:
        return spark.sql(CALL.sub(planned, query), **tables)
    finally:  # the plan holds what the views stood for
        for view in views:
            spark.catalog.dropTempView(view)


def register(spark: SparkSession) -> None:
    """Prepares a session: reader settings, times in UTC, the version-guessing setting at its default, and the table functions
    lake_metadata and lake_snapshots of plain SQL, with that setting as it is now. A scan alone leaves the session's time zone
    as it is."""
    prepare(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get(GUESSING, None) is None:
        spark.conf.set(GUESSING, "false")
    for name, function in table_functions(may_guess(spark)).items():
        spark.udtf.register(name, function)
