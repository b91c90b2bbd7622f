"""From a table's folder to its parsed metadata: which file holds the current version, and what it says."""

from __future__ import annotations

import datetime as dt
import gzip
import json
from dataclasses import dataclass, field as data_field

from pyspark.sql import SparkSession

from ..errors import InvalidInputError, NotSupportedError, TableIOError
from .files import Files, WorkerFiles
from .schema import Column, current_columns, field

UNKNOWN_VERSION = "?"
VERSION_FORMATS = "v%s%s.metadata.json,%s%s.metadata.json"
GUESSING = "unsafe_enable_version_guessing"


@dataclass(frozen=True)
class Options:
    allow_moved_paths: bool | None = None  # None: not given
    skip_schema_inference: bool = False
    metadata_compression_codec: str = "none"
    version: str = UNKNOWN_VERSION
    version_name_format: str = VERSION_FORMATS

    @property
    def suffix(self) -> str:
        return ".gz" if self.metadata_compression_codec == "gzip" else ""

    @property
    def formats(self) -> list[str]:
        return self.version_name_format.split(",")


def fill(name_format: str, *values: str) -> str:
    """Puts values in place of %s, in order."""
    for v in values:
        name_format = name_format.replace("%s", v, 1)
    return name_format


@dataclass(frozen=True)
class Snapshot:
    sequence_number: int
    snapshot_id: int
    timestamp_ms: int
    manifest_list: str

    @property
    def timestamp(self) -> dt.datetime:
        return dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=self.timestamp_ms)


@dataclass(frozen=True)
class TableMetadata:
    path: str
    format_version: int
    snapshots: list[Snapshot]
    columns: list[Column] | None = data_field(default=None)  # None: not parsed


def named_version(files: Files, folder: str, version: str, options: Options) -> str:
    for f in options.formats:
        path = f"{folder}/{fill(f, version, options.suffix)}"
        if files.exists(path):
            return path
    raise TableIOError(f"Iceberg metadata file not found for table version '{version}' using '{options.metadata_compression_codec}' compression and format(s): '{options.version_name_format}'")


def guessed_version(files: Files, folder: str, options: Options) -> str:
    """The last name in code point order among the files of the first format that has any: v9 is after v10."""
    for f in options.formats:
        if found := files.glob(f"{folder}/{fill(f, '*', options.suffix)}"):
            return max(found)
    raise TableIOError(f"No metadata file matches {options.version_name_format!r} with compression {options.metadata_compression_codec!r}, so no version can be guessed")


def hinted(files: Files, path: str) -> str:
    if not files.exists(path):
        raise TableIOError(f'Cannot open "{path}": No such file')
    return files.read(path).decode().strip()


def resolved(files: Files | WorkerFiles, guessing: bool, table: str, options: Options) -> str:
    """The metadata file that a table path, a version and the guessing setting lead to."""
    if table.endswith(".json"):
        return table
    folder = f"{table.rstrip('/')}/metadata"
    if not files.is_dir(folder):
        raise TableIOError(f'Cannot open "{table}": Metadata directory does not exist')
    if options.version.endswith((".text", ".txt")):
        return named_version(files, folder, hinted(files, f"{folder}/{options.version}"), options)
    if options.version != UNKNOWN_VERSION:
        return named_version(files, folder, options.version, options)
    hint = f"{folder}/version-hint.text"
    if files.exists(hint):
        return named_version(files, folder, hinted(files, hint), options)
    if not guessing:
        raise InvalidInputError("The table has no version hint and none was given. To take the last metadata file by name: SET unsafe_enable_version_guessing = true")
    return guessed_version(files, folder, options)


def may_guess(spark: SparkSession) -> bool:
    return str(spark.conf.get(GUESSING, "false")).lower() in ("true", "1")


def metadata_file(spark: SparkSession, table: str, options: Options) -> str:
    return resolved(Files(spark), may_guess(spark), table, options)


def load(files: Files | WorkerFiles, guessing: bool, table: str, options: Options) -> TableMetadata:
    path = resolved(files, guessing, table, options)
    if not files.exists(path):
        raise TableIOError(f'Cannot open "{path}": No such file')
    try:
        raw = files.read(path)
        doc = json.loads(gzip.decompress(raw) if options.metadata_compression_codec == "gzip" else raw)
    except (ValueError, OSError, EOFError) as e:
        raise TableIOError(f'Cannot parse metadata file "{path}": {e}') from e
    return parse(doc, path, options.skip_schema_inference)


def parse(doc: dict, path: str = "", skip_schema: bool = False) -> TableMetadata:
    version = field(doc, "format-version", int)
    if version not in (1, 2):
        raise NotSupportedError(f"Table format version {version} is not supported")
    if "current-schema-id" in doc and isinstance(doc.get("schemas"), list):
        schemas, schema_id = doc["schemas"], field(doc, "current-schema-id", int)
    elif isinstance(doc.get("schema"), dict):
        schemas, schema_id = [doc["schema"]], field(doc["schema"], "schema-id", int)
    else:
        raise TableIOError("Neither a valid schema or schemas field was found")
    listed = doc.get("snapshots") or []
    snapshots = [snapshot(s, version) for s in listed]
    return TableMetadata(path, version, snapshots, None if skip_schema else current_columns(schemas, schema_id))


def snapshot(doc, version: int) -> Snapshot:
    if not isinstance(doc, dict):
        raise TableIOError("A snapshot in the metadata file has a missing or wrong field")
    sequence = 0 if version == 1 else field(doc, "sequence-number", int)
    return Snapshot(sequence, field(doc, "snapshot-id", int), field(doc, "timestamp-ms", int), field(doc, "manifest-list", str))


def full_path(stored: str, root: str) -> str:
    """A stored path below another root: its part from the last /metadata/, else from the last /data/."""
    for mark in ("/metadata/", "/data/"):
        at = stored.rfind(mark)
        if at >= 0:
            return root.rstrip("/") + stored[at:]
    raise TableIOError(f"A moved path needs a data or metadata folder in it: {stored}")
