"""JSON record codec (X-17): camelCase names written, any case read, at every level.

Names follow from the schema's snake_case names.  The topic score record has
two names of its own (``TOPIC_NAMES``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The topic score's JSON names that do not follow from the column names.
TOPIC_NAMES = {"name": "topicName", "path": "topicPath"}


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(w[:1].upper() + w[1:] for w in rest)


def json_names(schema: T.StructType) -> dict[str, str]:
    """Column name -> JSON name for one record."""
    own = TOPIC_NAMES if {"topic_id", "name", "path", "confidence"} <= set(schema.names) else {}
    return {n: own.get(n, camel(n)) for n in schema.names}


def renamed(value: Column, kind: T.DataType) -> Column:
    """``value`` with the JSON names at every level, ready for ``to_json``."""
    if isinstance(kind, T.StructType):
        names = json_names(kind)
        return F.when(value.isNotNull(), F.struct(*[renamed(value[f.name], f.dataType).alias(names[f.name]) for f in kind]))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return F.transform(value, lambda x: renamed(x, kind.elementType))
    return value


def _with(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: Spark evaluates a column again wherever it is
    used inside conditions and lambdas, so a parsed text is bound to a lambda variable."""
    return F.get(F.transform(F.array(value), body), 0)


def parsed(text: Column, kind: T.DataType) -> Column:
    """JSON text -> a value of ``kind``; object keys match in any case at every level.  The text is
    parsed once for each level it is nested, whatever the number of fields."""
    if isinstance(kind, T.StructType):
        names = json_names(kind)

        def struct(entries: Column) -> Column:
            # of keys that differ only in case the last one counts
            keys = F.transform(F.map_keys(entries), lambda k: F.lower(k))
            return _with(F.struct(F.reverse(keys).alias("k"), F.reverse(F.map_values(entries)).alias("v")), fields)

        def fields(e: Column) -> Column:
            return F.struct(*[field(e, f) for f in kind])

        def field(e: Column, f: T.StructField) -> Column:
            at = F.array_position(e["k"], names[f.name].lower())
            value = F.get(e["v"], F.when(at > 0, at - 1).cast("int"))
            return parsed(value, f.dataType).alias(f.name)

        return _with(F.from_json(text, T.MapType(T.StringType(), T.StringType())), lambda m: F.when(m.isNotNull(), struct(m)))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StructType, T.ArrayType)):
            return F.transform(F.from_json(text, T.ArrayType(T.StringType())), lambda x: parsed(x, kind.elementType))
        return F.from_json(text, kind)
    if isinstance(kind, T.MapType):
        return F.from_json(text, kind)
    return text.try_cast(kind)


def parse_record(col: str, schema: T.StructType) -> Column:
    """X-17 read side: JSON text column -> struct of ``schema``; a null, empty or
    unreadable value gives null."""
    return F.when(F.length(F.trim(F.col(col))) > 0, parsed(F.col(col), schema))
