"""Table schemas from metadata JSON, as Spark types."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

from ..errors import TableIOError

PRIMITIVES = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "timestamptz": T.TimestampType(),
    "string": T.StringType(),
    "uuid": T.BinaryType(),  # as stored; scans render it as text
    "binary": T.BinaryType(),
}


@dataclass(frozen=True)
class Column:
    id: int
    name: str
    type: object  # as in the JSON
    required: bool

    @property
    def stored(self) -> T.DataType:
        return spark_type(self.type)


def field(doc, name: str, kind: type):
    """A typed member of a JSON object; missing or of another type is an error."""
    value = doc.get(name) if isinstance(doc, dict) else None
    if not isinstance(value, kind) or (kind is int and isinstance(value, bool)):
        raise TableIOError(f"A field of the metadata has a missing or wrong member: {name}")
    return value


def spark_type(kind) -> T.DataType:
    if isinstance(kind, dict):
        match field(kind, "type", str):
            case "struct":
                return T.StructType([T.StructField(field(f, "name", str), spark_type(f.get("type")), True) for f in field(kind, "fields", list)])
            case "list":
                return T.ArrayType(spark_type(kind.get("element")), True)
            case "map":
                return T.MapType(spark_type(kind.get("key")), spark_type(kind.get("value")), True)
        raise TableIOError("A field of the metadata has a missing or wrong member: type")
    if not isinstance(kind, str):
        raise TableIOError("A field of the metadata has a missing or wrong member: type")
    if kind in PRIMITIVES:
        return PRIMITIVES[kind]
    if kind == "time":
        return T.TimeType(6)
    if kind.startswith("fixed"):
        return T.BinaryType()
    if m := re.fullmatch(r"decimal\(\s*(\d+)\s*,\s*(\d+)\s*\)", kind):
        return T.DecimalType(int(m[1]), int(m[2]))
    raise TableIOError(f'Unknown type in the schema: "{kind}"')


def has_uuid(kind) -> bool:
    if isinstance(kind, dict):
        parts = [f.get("type") for f in kind.get("fields", [])] if kind["type"] == "struct" else [kind.get(x) for x in ("element", "key", "value")]
        return any(has_uuid(x) for x in parts if x is not None)
    return kind == "uuid"


def columns(schema: dict) -> list[Column]:
    if not isinstance(schema, dict) or schema.get("type") != "struct":
        raise TableIOError("The current schema is not a struct of fields")
    out = []
    for f in field(schema, "fields", list):
        c = Column(field(f, "id", int), field(f, "name", str), f.get("type"), field(f, "required", bool))
        spark_type(c.type)
        out.append(c)
    return out


def current_columns(schemas: list[dict], schema_id: int) -> list[Column]:
    for s in schemas:
        if field(s, "schema-id", int) == schema_id:
            return columns(s)
    raise TableIOError(f"The metadata has no schema of schema-id {schema_id}")
