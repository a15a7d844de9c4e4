"""JSON payload helpers kept JVM-side (no Python parsing)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .periods import col_


def is_json_object(c: str | Column) -> Column:
    """True when the text parses to a JSON object (arrays and scalars give false)."""
    return F.json_object_keys(col_(c)).isNotNull()


def has_key(c: str | Column, key: str) -> Column:
    """JSON object has a top-level key, even when its value is JSON null.

    ``get_json_object`` returns null for a null member, so key listing is used.
    """
    return F.coalesce(F.array_contains(F.json_object_keys(col_(c)), F.lit(key)), F.lit(False))


def json_text(c: str | Column, path: str) -> Column:
    """Text value at a JSON path (``$.a.b``); null when absent or JSON null."""
    return F.get_json_object(col_(c), path)


def json_count_map(c: str | Column) -> Column:
    """Parse a ``{"name": count}`` object into ``map<string,bigint>``."""
    return F.from_json(col_(c), "map<string,bigint>")


def merge_json_objects(left: str | Column, right: str | Column) -> Column:
    """Shallow merge of two JSON objects, right-hand keys winning (JSONB ``||``).

    Values are carried as VARIANT, so numbers, objects and nulls keep their type.
    """
    as_map = lambda c: F.coalesce(F.from_json(col_(c), "map<string,variant>"), F.from_json(F.lit("{}"), "map<string,variant>"))
    lm, rm = as_map(left), as_map(right)
    # keep left entries whose key is not overridden, then all right entries
    kept = F.map_filter(lm, lambda k, _v: ~F.array_contains(F.map_keys(rm), k))
    return F.to_json(F.map_concat(kept, rm), {"ignoreNullFields": "false"})
