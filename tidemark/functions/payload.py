"""Bytes, text and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode_utf8(value: Column, strict: bool = False) -> Column:
    """Bytes to text. Bad bytes raise when strict, and give NULL otherwise."""
    if strict:
        return F.decode(value, "UTF-8")
    return F.try_validate_utf8(value.cast("string"))


def parse_json(text: Column, schema: T.StructType, strict: bool = False) -> Column:
    """Text to a struct. Broken text raises when strict, else every field is NULL."""
    mode = "FAILFAST" if strict else "PERMISSIVE"
    return F.from_json(text, schema, {"mode": mode, "allowSingleQuotes": "false"})


def has_key(text: Column, key: str) -> Column:
    """Is ``key`` present in a JSON object, whatever its value (null included)?

    NULL when the text is broken or is not an object.
    """
    return F.array_contains(F.json_object_keys(text), key)


def is_whole(text: Column) -> Column:
    """Is the text one JSON value from its first character to its last?

    Key tests and parsers stop at the first value's end. Inside brackets, whatever follows is
    read too: a closing bracket of its own can end the list or the object early, not both.
    """
    listed = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    held = F.size(F.json_object_keys(F.concat(F.lit('{"x":'), text, F.lit("}")))) == 1
    return F.coalesce(listed & held, F.lit(False))


def is_unusable(text: Column) -> Column:
    """True for missing or broken text, for text after the JSON value, and for JSON that is not an object."""
    return F.json_object_keys(text).isNull() | ~is_whole(text)


def encode_json(value: Column) -> Column:
    """Struct to JSON text, null fields kept."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def variant_state(value: Column) -> Column:
    """``absent``, ``null``, ``object``, ``array`` or ``scalar``: what a VARIANT field of a message holds."""
    kind = F.schema_of_variant(value)
    return (
        F.when(value.isNull(), F.lit("absent"))
        .when(F.is_variant_null(value), F.lit("null"))
        .when(F.startswith(kind, F.lit("OBJECT")), F.lit("object"))
        .when(F.startswith(kind, F.lit("ARRAY")), F.lit("array"))
        .otherwise(F.lit("scalar"))
    )


def at_path(value: Column, path: str, kind: str) -> Column:
    """What stands at a path such as ``$.city.name`` of a VARIANT field, as ``kind``; NULL if nothing does or it cannot be read so.

    Only paths that are asked for are looked up, and the message is parsed once for all of them.
    """
    return F.try_variant_get(value, path, kind)
