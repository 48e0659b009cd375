"""Array, JSON and mixed-type value expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def offset(array: Column, index: int) -> Column:
    """Element at a zero-based offset, NULL when out of range."""
    return F.get(array, F.lit(index))


def joined_text(array: Column, separator: str = ",") -> Column:
    """Elements joined by ``separator``, skipping NULLs."""
    return F.array_join(array, separator)


def keyed_max(params: Column, key: str, field: str = "string_value") -> Column:
    """Largest non-NULL value stored under ``key`` in an array of key/value structs.

    ``field`` may be a dotted path inside the struct.  Works on the array itself,
    so nothing has to be exploded.
    """

    def read(entry: Column) -> Column:
        value = entry
        for part in field.split("."):
            value = value[part]
        return value

    return F.array_max(F.transform(F.filter(params, lambda e: e["key"] == key), read))


def json_scalar(document: Column, path: str) -> Column:
    """Scalar at a JSON path as text; NULL for objects, arrays, JSON null and bad JSON."""
    return variant_scalar(F.try_parse_json(document), path)


def variant_scalar(document: Column, path: str) -> Column:
    """``json_scalar`` for text that was already parsed (one parse serves many paths)."""
    found = F.try_variant_get(document, path, "variant")
    kind = F.schema_of_variant(found)
    return F.when(
        ~kind.startswith("OBJECT") & ~kind.startswith("ARRAY"), F.try_variant_get(document, path, "string")
    )


def mixed_value_text(value: Column) -> Column:
    """Text of a VARIANT that may hold a flag, a list or a scalar.

    Flags become ``True``/``False``; each item of a list is followed by a line
    break; other values keep their text.
    """
    kind = F.schema_of_variant(value)
    items = F.try_variant_get(value, "$", "array<string>")
    listed = F.array_join(F.transform(items, lambda item: F.concat(item, F.lit("\n"))), "")
    return (
        F.when(kind == "BOOLEAN", F.initcap(value.cast("string")))
        .when(kind.startswith("ARRAY"), listed)
        .otherwise(value.cast("string"))
    )


def nested_text(raw_json: Column) -> Column:
    """Raw JSON of a nested value as text, NULL when it is empty."""
    return F.when(~raw_json.isin("{}", "[]", "", "null"), raw_json)


def quoted_text(text: Column) -> Column:
    """A plain string serialised as JSON, NULL when blank."""
    return F.to_json(F.nullif(text, F.lit("")).cast("variant"))


def nonzero(value: Column) -> Column:
    """Integer with 0 read as missing."""
    return F.nullif(value.cast("bigint"), F.lit(0).cast("bigint"))


def nonblank(value: Column) -> Column:
    """Text with the empty string read as missing."""
    return F.nullif(value.cast("string"), F.lit(""))


def as_list(value: Column) -> Column:
    """A bare object as a one-element array, NULL as NULL."""
    return F.when(value.isNotNull(), F.array(value))
