"""Type names and nesting depth of JSON held as text or VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logharbor.functions.binding import bind

#: JSON type names used by schemas and messages.
TYPE_NAMES = {
    "string": "str",
    "integer": "int",
    "float": "float",
    "boolean": "bool",
    "list": "list",
    "dict": "dict",
}


def _type_of_shape(shape: Column) -> Column:
    return (
        F.when(shape.isNull() | (shape == "VOID"), F.lit(None).cast("string"))
        .when(shape == "STRING", "string")
        .when(shape == "BOOLEAN", "boolean")
        .when((shape == "BIGINT") | shape.rlike(r"^DECIMAL\(\d+,0\)$"), "integer")
        .when(shape.startswith("ARRAY"), "list")
        .when(shape.startswith("OBJECT"), "dict")
        .otherwise("float")
    )


def variant_type(value: Column) -> Column:
    """string, integer, float, boolean, list, dict or null for the JSON value in a VARIANT."""
    return bind(F.schema_of_variant(value), _type_of_shape)


def parse_strict(text: Column) -> Column:
    """VARIANT of a text that is exactly one JSON value, else null.

    The parser stops after the first value. Text that continues cannot close both an array and an
    object around it, so it fails in one of the two wrappings.
    """
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    in_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.when(in_array.isNotNull(), F.try_variant_get(in_object, "$.v", "variant"))


def json_path(field: str) -> str:
    return f"$.{field}" if field.isidentifier() else f"$['{field}']"


def variant_field(value: Column, field: str) -> Column:
    return F.try_variant_get(value, json_path(field), "variant")


def json_depth(text: Column) -> Column:
    """Levels of nesting of a valid JSON text; a scalar leaf is a level and `{}` is 1."""
    bare = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*"', "s")
    bare = F.regexp_replace(bare, r"s\s*:", "")
    bare = F.regexp_replace(bare, r"[^\[\]{}s,\s]+", "s")
    bare = F.regexp_replace(bare, r"[,\s]+", "")
    start = F.struct(F.lit(0).alias("open"), F.lit(0).alias("deepest"))

    def step(state: Column, mark: Column) -> Column:
        opened = (
            F.when(mark.isin("{", "["), state["open"] + 1)
            .when(mark.isin("}", "]"), state["open"] - 1)
            .otherwise(state["open"])
        )
        level = F.when(mark == "s", opened + 1).otherwise(opened)
        return F.struct(opened.alias("open"), F.greatest(state["deepest"], level).alias("deepest"))

    return F.aggregate(F.split(bare, ""), start, step, lambda s: s["deepest"])


def deeper_than(text: Column, limit: int) -> Column:
    """True where the nesting passes `limit`; counted only where enough brackets open."""
    opening = F.length(F.regexp_replace(text, r"[^\[{]", ""))
    return F.when(opening + 1 > limit, json_depth(text) > limit).otherwise(F.lit(False))
