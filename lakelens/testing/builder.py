"""Writes small tables in the snapshot format: test fixtures, and inputs of the registered queries."""

from __future__ import annotations

import gzip
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import avro
from ..sources.files import Files

LISTED = [("manifest_path", "string"), ("manifest_length", "long"), ("partition_spec_id", "int"), ("content", "int"), ("sequence_number", "long"), ("min_sequence_number", "long"), ("added_snapshot_id", "long")]
FILE = [("content", "int"), ("file_path", "string"), ("file_format", "string"), ("record_count", "long"), ("file_size_in_bytes", "long")]
V2_ONLY = {"content", "sequence_number", "min_sequence_number"}


def record(name: str, fields: list, version: int) -> dict:
    return {"type": "record", "name": name, "fields": [{"name": n, "type": t} for n, t in fields if version > 1 or n not in V2_ONLY]}


class TableBuilder:
    """A table below root. Stored paths begin with stored_root, root itself unless the table is to look moved."""

    def __init__(self, spark: SparkSession, root: str, columns: list[tuple[int, str, object]], version: int = 2, stored_root: str | None = None, codec: str = "null"):
        self.spark, self.root, self.version, self.codec = spark, root, version, codec
        self.stored_root, self.files = stored_root or root, Files(spark)
        self.schemas = [self.schema(columns, 0)]
        self.snapshots: list[dict] = []

    @staticmethod
    def schema(columns: list[tuple[int, str, object]], schema_id: int) -> dict:
        return {"type": "struct", "schema-id": schema_id, "fields": [{"id": i, "name": n, "type": t, "required": False} for i, n, t in columns]}

    def evolve(self, columns: list[tuple[int, str, object]]) -> None:
        self.schemas.append(self.schema(columns, len(self.schemas)))

    def write_files(self, df: DataFrame, names: list[str], ids: dict[str, int] | None = None) -> list[dict]:
        """Parquet files of these names below data/, rows dealt in order; gives their entries."""
        marked = df.select(*[F.col(f"`{c}`").alias(c, metadata={"parquet.field.id": ids[c]}) if ids else F.col(f"`{c}`") for c in df.columns])
        folder = f"{self.root}/tmp-{uuid.uuid4().hex}"
        (marked.coalesce(1) if len(names) == 1 else marked.repartition(len(names))).write.parquet(folder)
        parts = sorted(self.files.glob(f"{folder}/part-*.parquet"))
        out = []
        for part, name in zip(parts, names, strict=True):
            self.files.rename(part, f"{self.root}/data/{name}")
            count = self.spark.read.parquet(f"{self.root}/data/{name}").count()
            out.append({"content": 0, "file_path": f"{self.stored_root}/data/{name}", "file_format": "PARQUET", "record_count": count, "file_size_in_bytes": 1})
        return out

    def read_rows(self, entry: dict) -> DataFrame:
        """A data file's rows with __pos."""
        path = self.root + entry["file_path"][len(self.stored_root) :]
        return self.spark.read.parquet(path).select("*", F.col("_metadata.row_index").alias("__pos"))

    def write_deletes(self, positions: list[tuple[dict, DataFrame]], name: str) -> dict:
        """A position-delete file: for each data entry, a DataFrame with __pos."""
        rows = None
        for entry, df in positions:
            one = df.select(F.lit(entry["file_path"]).alias("file_path"), F.col("__pos").cast("long").alias("pos"))
            rows = one if rows is None else rows.unionByName(one)
        return self.write_files(rows, [name])[0] | {"content": 1}

    def manifest(self, name: str, entries: list[tuple[int, dict]], content: int = 0, sequence: int = 1) -> dict:
        """entries: (status, file). Gives the manifest list's record."""
        schema = record("manifest_entry", [("status", "int"), ("snapshot_id", ["null", "long"]), ("data_file", record("r2", FILE, self.version))], self.version)
        data = avro.write(schema, [{"status": s, "snapshot_id": None, "data_file": f} for s, f in entries], self.codec)
        self.files.write(f"{self.root}/metadata/{name}", data)
        return {"manifest_path": f"{self.stored_root}/metadata/{name}", "manifest_length": len(data), "partition_spec_id": 0, "content": content, "sequence_number": sequence, "min_sequence_number": sequence, "added_snapshot_id": 1}

    def snapshot(self, snapshot_id: int, timestamp_ms: int, manifests: list[dict]) -> None:
        name, sequence = f"snap-{snapshot_id}.avro", len(self.snapshots) + 1
        self.files.write(f"{self.root}/metadata/{name}", avro.write(record("manifest_file", LISTED, self.version), manifests, self.codec))
        s = {"snapshot-id": snapshot_id, "timestamp-ms": timestamp_ms, "manifest-list": f"{self.stored_root}/metadata/{name}"}
        self.snapshots.append(s | ({"sequence-number": sequence} if self.version > 1 else {}))

    def document(self) -> dict:
        doc = {"format-version": self.version, "current-schema-id": len(self.schemas) - 1, "schemas": self.schemas, "snapshots": self.snapshots}
        return doc | ({"schema": self.schemas[-1]} if self.version == 1 else {})

    def commit(self, name: str = "v1", hint: str | None = "1", zipped: bool = False, doc: dict | None = None) -> None:
        raw = json.dumps(self.document() if doc is None else doc).encode()
        self.files.write(f"{self.root}/metadata/{name}{'.gz' * zipped}.metadata.json", gzip.compress(raw) if zipped else raw)
        if hint is not None:
            self.files.write(f"{self.root}/metadata/version-hint.text", hint.encode())
