"""JSON logs: one record per line with a schema, or objects in any of three layouts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logharbor.functions.binding import bind
from logharbor.functions.tagging import REASON, computed_once, first_reason
from logharbor.functions.variants import deeper_than, parse_strict, variant_field, variant_type

# Limits on one JSON payload.
MAX_BYTES = 10 * 1024 * 1024
MAX_DEPTH = 50


@dataclass(frozen=True)
class JsonSchema:
    """Required fields and expected types (string, integer, float, boolean, list, dict)."""

    required: tuple[str, ...] = ()
    types: dict[str, str] = field(default_factory=dict)


def parse_json_lines(
    lines: DataFrame,
    schema: JsonSchema | None = None,
    line: str = "line",
    max_bytes: int = MAX_BYTES,
    max_depth: int = MAX_DEPTH,
) -> DataFrame:
    """Adds `record` (VARIANT) and `reason`; a bad payload has a reason and a null record."""
    schema = schema or JsonSchema()
    text = F.col(line)
    fits = F.octet_length(text) <= max_bytes
    parsed = lines.withColumn("record", F.when(fits, parse_strict(text)))

    checks = [
        (~fits, "too_large"),
        (F.col("record").isNull(), "invalid_json"),
        (deeper_than(text, max_depth), "too_deep"),
    ]
    for name in schema.required:
        checks.append((variant_field(F.col("record"), name).isNull(), f"missing_field:{name}"))
    for name, expected in schema.types.items():
        value = variant_field(F.col("record"), name)

        def misfits(found, expected=expected):
            # a boolean is also an integer; null has no type
            same = (found == expected) | ((found == "boolean") & F.lit(expected == "integer"))
            return ~F.coalesce(same, F.lit(False))

        wrong = value.isNotNull() & bind(variant_type(value), misfits)
        checks.append((wrong, f"wrong_type:{name}"))

    tagged = computed_once(parsed, *lines.columns, "record", first_reason(*checks).alias(REASON))
    return tagged.withColumn("record", F.when(F.col(REASON).isNull(), F.col("record")))


def explode_json_objects(objects: DataFrame, content: str = "content") -> DataFrame:
    """Records of objects that hold an array, a single value, or one value per line.

    Lines that do not parse are skipped. The frame keeps its other columns and gains `record`.
    """
    keep = [c for c in objects.columns if c != content]
    text = F.col(content)
    whole = parse_strict(text)
    lines = F.filter(F.split(F.trim(text), "\n"), lambda part: F.trim(part) != "")
    by_line = F.filter(
        F.transform(lines, parse_strict), lambda v: v.isNotNull()
    )
    shaped = objects.withColumn("_whole", whole).withColumn(
        "_records",
        F.when(F.col("_whole").isNull(), by_line).otherwise(
            F.coalesce(F.try_variant_get("_whole", "$", "array<variant>"), F.array("_whole"))
        ),
    )
    return shaped.select(*keep, F.explode("_records").alias("record"))
