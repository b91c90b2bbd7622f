"""Which snapshot a query means, and which files that snapshot consists of."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..errors import NotSupportedError, TableIOError
from ..sources import avro
from ..sources.files import Files, WorkerFiles, literal
from ..sources.metadata import Options, Snapshot, TableMetadata, full_path, load, may_guess

MANIFEST_CONTENT = ("DATA", "DELETE")
STATUS = ("EXISTING", "ADDED", "DELETED")
#: A data file's content prints as EXISTING.
CONTENT = ("EXISTING", "POSITION_DELETES", "EQUALITY_DELETES")
#: More manifests than this, or more bytes of them, are decoded on the executors.
DRIVER_MANIFESTS, DRIVER_BYTES = 64, 8 << 20
ENTRY_DDL = "manifest string, at long, status int, content int, file_path string, file_format string, record_count long, low binary, high binary, error string"
#: What is decoded of manifest lists and manifests; the rest, column statistics above all, is passed over.
LISTED = dict.fromkeys(("manifest_path", "manifest_length", "sequence_number", "content"))
FILE = dict.fromkeys(("content", "file_path", "file_format", "record_count"))
ENTRIES = {"status": None, "data_file": FILE}
#: A position-delete file's bounds say which data files it can name (fixed value: the id of its file_path column).
DELETE_ENTRIES = {"status": None, "data_file": FILE | dict.fromkeys(("lower_bounds", "upper_bounds"))}
PATH_ID = 2147483546


@dataclass(frozen=True)
class Entry:
    status: int
    content: int
    file_path: str
    file_format: str
    record_count: int
    low: bytes | None = None  # of a delete file: least and greatest data file it can name, where its manifest says so
    high: bytes | None = None


@dataclass(frozen=True)
class Manifest:
    path: str
    sequence_number: int
    content: int
    entries: list[Entry]


@dataclass(frozen=True)
class TablePlan:
    """A snapshot with its files, and the row counts its manifests claim."""

    root: str
    metadata: TableMetadata
    snapshot: Snapshot
    manifests: list[Manifest]
    moved: bool

    def entries(self, content: int) -> list[Entry]:
        return [e for m in self.manifests if m.content == content for e in m.entries if e.status != 2]

    def path(self, stored: str) -> str:
        return full_path(stored, self.root) if self.moved else stored

    @property
    def data_rows(self) -> int:
        return sum(e.record_count for c in (0, 1) for e in self.entries(c) if e.content == 0)

    @property
    def delete_rows(self) -> int:
        return sum(e.record_count for c in (0, 1) for e in self.entries(c) if e.content != 0)


def latest(snapshots: list[Snapshot]) -> Snapshot | None:
    """The greatest timestamp; of equal ones the later in the list."""
    best = None
    for s in snapshots:
        if best is None or s.timestamp_ms >= best.timestamp_ms:
            best = s
    return best


def milliseconds(when: dt.datetime) -> int:
    """Whole milliseconds since 1970; a time without zone counts as UTC."""
    if when.tzinfo is not None:
        when = when.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return (when - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1)


def choose(metadata: TableMetadata, snapshot_id: int | None, as_of: dt.datetime | None) -> Snapshot:
    if snapshot_id is not None:
        found = next((s for s in metadata.snapshots if s.snapshot_id == snapshot_id), None)
        if found is None:
            raise TableIOError(f"Could not find snapshot with id {snapshot_id}")
    elif as_of is not None:
        limit = milliseconds(as_of)
        found = latest([s for s in metadata.snapshots if s.timestamp_ms <= limit])
        if found is None:
            raise TableIOError(f"Could not find latest snapshots for timestamp {as_of}")
    else:
        found = latest(metadata.snapshots)
        if found is None:
            raise TableIOError("No snapshots found")
    return found


def entry_row(record: dict) -> tuple:
    f = record["data_file"]
    low, high = ((next((x["value"] for x in f.get(k) or [] if x["key"] == PATH_ID), None)) for k in ("lower_bounds", "upper_bounds"))
    return record["status"], f.get("content") or 0, f["file_path"], f["file_format"], f["record_count"], low, high


def few(manifests: list[dict]) -> bool:
    return len(manifests) <= DRIVER_MANIFESTS and sum(m.get("manifest_length") or 0 for m in manifests) <= DRIVER_BYTES


def read_entries(files: Files | WorkerFiles, paths: list[str], contents: list[int], spark: SparkSession | None = None) -> list[list[Entry]]:
    """The entries of each manifest, in order: decoded by tasks, a file each, where a session is given."""
    if spark is None:
        return [[Entry(*entry_row(r)) for r in decoded(files.read(p), p, DELETE_ENTRIES if c else ENTRIES)] for p, c in zip(paths, contents, strict=True)]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    none = (path, -1, *[None] * 8)  # so that a manifest without entries is told from a missing one
                    rows = [none, *((path, i, *entry_row(r), None) for i, r in enumerate(avro.read(bytes(content), DELETE_ENTRIES)))]
                except (TableIOError, KeyError, TypeError) as e:
                    rows = [(path, 0, *[None] * 7, str(e))]
                yield pd.DataFrame(rows, columns=[x.split(" ")[0] for x in ENTRY_DDL.split(", ")])

    got = spark.read.format("binaryFile").load([literal(p) for p in paths]).select("path", "content").mapInPandas(decode, ENTRY_DDL)
    by = {}
    for r in got.collect():  # one job for all: the plan holds every entry anyway
        if r.error is not None:
            raise TableIOError(f'Cannot read manifest "{r.manifest}": {r.error}')
        by.setdefault(r.manifest, []).append((r.at, Entry(r.status, r.content, r.file_path, r.file_format, r.record_count, r.low and bytes(r.low), r.high and bytes(r.high))))
    by = {plain(k): [e for i, e in sorted(v, key=lambda x: x[0]) if i >= 0] for k, v in by.items()}
    keys = list(map(plain, files.uris(paths, encoded=False)))
    if missing := [p for p, k in zip(paths, keys, strict=True) if k not in by]:
        raise TableIOError(f'Cannot open "{missing[0]}": No such file')
    return [by[k] for k in keys]


def plain(path: str) -> str:
    return path.replace("file:///", "file:/")


def entry_frame(spark: SparkSession, listed: ListedSnapshot, ddl: str) -> DataFrame:
    """Rows of the columns in ddl for all entries of a snapshot, from the tasks that decode them: none pass the driver."""
    files = Files(spark)
    paths = files.uris([listed.path(m["manifest_path"]) for m in listed.manifests], encoded=False)
    known = dict(zip(map(plain, paths), listed.manifests, strict=True))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                m = known[plain(path)]
                entries = [Entry(*entry_row(r)) for r in decoded(bytes(content), path, ENTRIES)]
                yield pd.DataFrame([entry_columns(m, e) for e in entries], columns=[x.split(" ")[0] for x in ddl.split(", ")])

    return spark.read.format("binaryFile").load([literal(p) for p in known]).select("path", "content").mapInPandas(decode, ddl)


def entry_columns(m: dict, e: Entry) -> tuple:
    """A manifest entry as the metadata function shows it."""
    return m["manifest_path"], m.get("sequence_number") or 0, MANIFEST_CONTENT[m.get("content") or 0], STATUS[e.status], CONTENT[e.content], e.file_path, e.file_format, e.record_count


def decoded(data: bytes, path: str, wanted: dict) -> list[dict]:
    try:
        return avro.read(data, wanted)
    except TableIOError as e:
        raise TableIOError(f'Cannot read "{path}": {e}') from e


@dataclass(frozen=True)
class ListedSnapshot:
    """A snapshot with its manifest list's records; the manifests are not read yet."""

    root: str
    metadata: TableMetadata
    snapshot: Snapshot
    manifests: list[dict]
    moved: bool

    def path(self, stored: str) -> str:
        return full_path(stored, self.root) if self.moved else stored


def list_manifests(files: Files | WorkerFiles, guessing: bool, path: str, options: Options, snapshot_id: int | None = None, as_of: dt.datetime | None = None) -> ListedSnapshot:
    metadata = load(files, guessing, path, options)
    chosen = choose(metadata, snapshot_id, as_of)
    moved = bool(options.allow_moved_paths)
    at = full_path(chosen.manifest_list, path) if moved else chosen.manifest_list
    if not files.exists(at):
        raise TableIOError(f'Cannot open "{at}": No such file')
    return ListedSnapshot(path, metadata, chosen, decoded(files.read(at), at, LISTED), moved)


def with_entries(files: Files | WorkerFiles, of: ListedSnapshot, spark: SparkSession | None = None) -> TablePlan:
    entries = read_entries(files, [of.path(m["manifest_path"]) for m in of.manifests], [m.get("content") or 0 for m in of.manifests], None if few(of.manifests) else spark)
    manifests = [Manifest(m["manifest_path"], m.get("sequence_number") or 0, m.get("content") or 0, e) for m, e in zip(of.manifests, entries, strict=True)]
    return TablePlan(of.root, of.metadata, of.snapshot, manifests, of.moved)


def plan_table(spark: SparkSession, path: str, options: Options, snapshot_id: int | None = None, as_of: dt.datetime | None = None) -> TablePlan:
    files = Files(spark)
    return with_entries(files, list_manifests(files, may_guess(spark), path, options, snapshot_id, as_of), spark)


def check_readable(plan: TablePlan) -> None:
    for content in (0, 1):
        for e in plan.entries(content):
            if e.file_format.upper() != "PARQUET":
                raise NotSupportedError(f"Cannot read {e.file_format} files: {e.file_path}")
            if content == 1 and e.content == 2:
                raise NotSupportedError(f"Equality deletes are not supported: {e.file_path}")
