"""JSON text access with the warehouse's two spellings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parsed(text: Column) -> Column:
    """The text as a variant, null if it is broken. Put it in a column and read all paths from that."""
    return F.try_parse_json(text)


def json_query(document: Column, path: str) -> Column:
    """JSON text at ``path`` of a parsed document: strings stay quoted, arrays and objects stay whole."""
    return F.to_json(F.try_variant_get(document, path, "variant"))


def json_value(document: Column, path: str) -> Column:
    """Scalar text at ``path`` of a parsed document; null where an array or object is found."""
    kind = F.schema_of_variant(F.try_variant_get(document, path, "variant"))
    scalar = ~(kind.startswith("ARRAY") | kind.startswith("OBJECT"))
    return F.when(scalar, F.try_variant_get(document, path, "string"))
