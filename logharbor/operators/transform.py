"""Declarative column transforms: a rule set becomes one projection."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logharbor.functions.network import canonical_ip
from logharbor.functions.tagging import REASON, computed_once, first_reason
from logharbor.functions.timestamps import format_timestamp, parse_timestamp
from logharbor.functions.variants import parse_strict

# Default formats and words.
INPUT_FORMATS = ["%Y-%m-%dT%H:%M:%S.%fZ", "%Y-%m-%d %H:%M:%S", "%b %d %Y %H:%M:%S"]
OUTPUT_FORMAT = "%Y-%m-%dT%H:%M:%S.%fZ"
TRUE_WORDS = ["true", "1", "yes", "on"]
FALSE_WORDS = ["false", "0", "no", "off"]


@dataclass(frozen=True)
class Transform:
    """`field` in, `target` (default: the same name) out, by a named kind."""

    field: str
    kind: str
    target: str | None = None
    required: bool = False
    parameters: dict[str, Any] = field(default_factory=dict)

    @property
    def output(self) -> str:
        return self.target or self.field


def _timestamp(value: Column, dtype: T.DataType, p: dict) -> Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.concat(F.regexp_replace(text, r"\.000000$", ""), F.lit("+00:00"))
    parsed = parse_timestamp(value, p.get("input_formats", INPUT_FORMATS))
    return format_timestamp(parsed, p.get("output_format", OUTPUT_FORMAT))


def _boolean(value: Column, dtype: T.DataType, p: dict) -> Column:
    if isinstance(dtype, T.BooleanType):
        return value
    word = F.lower(value.cast("string"))
    return F.when(word.isin(*p.get("true_values", TRUE_WORDS)), True).when(
        word.isin(*p.get("false_values", FALSE_WORDS)), False
    )


def _string(value: Column, dtype: T.DataType, p: dict) -> Column:
    text = value.cast("string")
    if p.get("strip", True):
        text = F.trim(text)
    if p.get("upper"):
        text = F.upper(text)
    if p.get("lower"):
        text = F.lower(text)
    for old, new in (p.get("replace") or {}).items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.coalesce(text, F.lit(""))


def _json(value: Column, dtype: T.DataType, p: dict) -> Column:
    return parse_strict(value) if isinstance(dtype, T.StringType) else value


def _list(value: Column, dtype: T.DataType, p: dict) -> Column:
    if isinstance(dtype, T.ArrayType):
        return value
    if not isinstance(dtype, T.StringType):
        return F.lit(None).cast("array<string>")
    pattern = "\\Q" + p.get("separator", ",") + "\\E"
    return F.transform(F.split(value, pattern), lambda item: F.trim(item))


# Kinds of a rule; a kind not listed here is skipped.
KINDS = {
    "timestamp": _timestamp,
    "ip": lambda v, dtype, p: canonical_ip(v),
    "integer": lambda v, dtype, p: v.try_cast("bigint"),
    "float": lambda v, dtype, p: v.try_cast("double"),
    "boolean": _boolean,
    "string": _string,
    "json": _json,
    "list": _list,
}
MAP = "map"


def _mapped(df: DataFrame, rule: Transform, name: str) -> DataFrame:
    """A lookup as a left join, whatever the number of entries; a value without an entry has the default.

    The entries are a relation of known size, which the optimizer broadcasts if it is small.
    """
    mapping, default = rule.parameters.get("mapping") or {}, F.lit(rule.parameters.get("default"))
    if not mapping:
        return df.withColumn(name, default)
    lookup = df.sparkSession.createDataFrame(list(mapping.items()), [f"{name}_key", name])
    joined = df.join(lookup, F.col(f"`{rule.field}`") == F.col(f"{name}_key"), "left").drop(f"{name}_key")
    return joined.withColumn(name, F.coalesce(F.col(name), default))


def transform_table(df: DataFrame, rules: list[Transform], keep: list[str] = ()) -> DataFrame:
    """Transformed columns plus `reason`.

    A failed optional field is null; a failed required field gives the row a reason. Rules on absent
    fields or of unknown kind produce no column, unless the field is required.
    """
    checks, outputs = [], []
    for i, rule in enumerate(rules):
        if rule.kind not in KINDS and rule.kind != MAP:
            continue
        failure = F.lit(f"Failed to transform field {rule.field}")
        if rule.field not in df.columns:
            if rule.required and rule.kind not in ("string", MAP):
                checks.append((F.lit(True), failure))
            continue
        name = f"_t{i}"
        source = F.col(f"`{rule.field}`")
        if rule.kind == MAP:
            df = _mapped(df, rule, name)
        else:
            df = df.withColumn(name, KINDS[rule.kind](source, df.schema[rule.field].dataType, rule.parameters))
        if not rule.required:
            df = df.withColumn(name, F.when(source.isNotNull(), F.col(name)))
        if rule.required and rule.kind not in ("string", MAP):
            checks.append((F.col(name).isNull(), failure))
        outputs.append(F.col(name).alias(rule.output))
    reason = first_reason(*checks) if checks else F.lit(None).cast("string")
    return computed_once(df, *keep, *outputs, reason.alias(REASON))
