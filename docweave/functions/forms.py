"""Forms of records in JSON: camel-case names, manifests of inputs, and hashed names of results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def camel(name: str) -> str:
    """``content_text_length`` as ``contentTextLength``."""
    head, *rest = name.split("_")
    return head + "".join(p.capitalize() for p in rest)


def camel_schema(schema: T.StructType) -> T.StructType:
    """The schema with camel-case names, inner ones too."""
    def kind(t):
        if isinstance(t, T.StructType):
            return camel_schema(t)
        if isinstance(t, T.ArrayType):
            return T.ArrayType(kind(t.elementType), t.containsNull)
        return t

    return T.StructType([T.StructField(camel(f.name), kind(f.dataType), f.nullable) for f in schema])


def manifest_json(schema: T.StructType, columns: dict[str, Column] | None = None, without: tuple[str, ...] = ("docs",)) -> Column:
    """The arguments of a task as JSON with camel-case names, in order of the schema; nulls and ``without`` are left out."""
    fields = [f for f in schema if f.name not in without]
    value = lambda f: (columns or {}).get(f.name, F.col(f.name))
    return F.to_json(F.struct(*(value(f).cast(camel_schema(T.StructType([f]))[0].dataType).alias(camel(f.name)) for f in fields)))


def from_manifest(text: Column, schema: T.StructType) -> Column:
    """The struct of a camel-case JSON object; a text that doesn't fit fails the query."""
    return F.from_json(text, camel_schema(schema), {"mode": "FAILFAST"}).cast(schema)


def result_name(payload: Column) -> Column:
    """Name of the file of a partial result: a hash of what it holds."""
    return F.concat(F.sha2(payload, 256), F.lit(".json"))
