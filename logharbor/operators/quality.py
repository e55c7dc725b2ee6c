"""Data-quality rules over a table: violations, a summary per rule, and a clean/quarantine split."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logharbor.functions.binding import bind
from logharbor.functions.network import ip_version
from logharbor.functions.timestamps import parse_timestamp
from logharbor.functions.variants import TYPE_NAMES, parse_strict, variant_type

# Value patterns that point at secrets, and how references to a secret store begin.
SENSITIVE_PATTERNS = (r"password[s]?", r"secret[s]?", r"key[s]?", r"token[s]?", r"credential[s]?")
REFERENCE_PREFIX = "keyvault:"
REFERENCE_PARTS = ("https://", ".vault.azure.net/secrets/")


@dataclass(frozen=True)
class Rule:
    """One check of one field; `message` replaces the rule's own text."""

    field: str
    kind: str
    parameters: dict[str, Any] = field(default_factory=dict)
    message: str | None = None


def _blank(value: Column, dtype: T.DataType) -> Column:
    """Null or an empty value."""
    if isinstance(dtype, T.StringType):
        return value.isNull() | (value == "")
    return value.isNull()


def _declared_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.IntegralType):
        return "integer"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, T.NumericType):
        return "float"
    if isinstance(dtype, T.ArrayType):
        return "list"
    if isinstance(dtype, (T.StructType, T.MapType)):
        return "dict"
    return "string" if isinstance(dtype, T.StringType) else dtype.simpleString()


def _required(value, dtype, p):
    empty = F.trim(value) == "" if isinstance(dtype, T.StringType) else F.lit(False)
    return F.when(value.isNull() | empty, "Field is required")


def _type(value, dtype, p):
    expected = p.get("type")
    if expected not in TYPE_NAMES:
        return F.lit(None).cast("string")
    if isinstance(dtype, T.VariantType):
        found = variant_type(value)
    else:
        found = F.when(value.isNotNull(), F.lit(_declared_type(dtype)))
    names = F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair])

    def message(kind: Column) -> Column:
        # a boolean is also an integer
        fits = (kind == expected) | ((kind == "boolean") & F.lit(expected == "integer"))
        shown = F.coalesce(F.try_element_at(names, kind), kind)
        return F.when(kind.isNotNull() & ~fits, F.concat(F.lit(f"Expected type {expected}, got "), shown))

    return bind(found, message)


def _regex(value, dtype, p):
    if not p.get("pattern") or not isinstance(dtype, T.StringType):
        return F.lit(None).cast("string")
    missed = ~value.rlike(f"^(?:{p['pattern']})")
    return F.when(~_blank(value, dtype) & missed, "Value does not match required pattern")


def _range(value, dtype, p):
    number = value.try_cast("double")
    low, high = p.get("min"), p.get("max")
    arms = [F.when(value.isNotNull() & number.isNull(), "Value must be numeric")]
    if low is not None:
        arms.append(F.when(number < float(low), f"Value must be greater than or equal to {low}"))
    if high is not None:
        arms.append(F.when(number > float(high), f"Value must be less than or equal to {high}"))
    return F.coalesce(*arms)


def _enum(value, dtype, p):
    allowed = list(p.get("values", []))
    listed = value.isin(*allowed) if allowed else F.lit(False)
    return F.when(value.isNotNull() & ~listed, f"Value must be one of: {', '.join(map(str, allowed))}")


def _ip(value, dtype, p):
    wanted = p.get("version")

    def message(version: Column) -> Column:
        wrong = F.when(version.isNull(), "Invalid IP address")
        if wanted in (4, 6):
            wrong = F.coalesce(wrong, F.when(version != wanted, f"Must be an IPv{wanted} address"))
        return wrong

    return F.when(~_blank(value, dtype), bind(ip_version(value), message))


def _timestamp(value, dtype, p):
    parsed = parse_timestamp(value, p.get("formats", ["%Y-%m-%dT%H:%M:%S.%fZ"]))
    return F.when(~_blank(value, dtype) & parsed.isNull(), "Invalid timestamp format")


def _length(value, dtype, p):
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        size = F.when(value.isNotNull(), F.size(value))
    elif isinstance(dtype, T.StringType):
        size = F.length(value)
    else:
        return F.when(value.isNotNull(), "Value must have a length")
    arms = [F.lit(None).cast("string")]
    if p.get("min") is not None:
        arms.append(F.when(size < p["min"], f"Length must be at least {p['min']}"))
    if p.get("max") is not None:
        arms.append(F.when(size > p["max"], f"Length must be at most {p['max']}"))
    return F.coalesce(*arms)


def _custom(value, dtype, p):
    """`function` maps a Column to a message (null = good), or a Python value to a verdict.

    A verdict is true for good, a string for a message, anything else for a failure. Python functions
    run in Arrow batches.
    """
    if p.get("column"):
        return p["column"](value)
    function: Callable | None = p.get("function")
    if not callable(function):
        return F.lit(None).cast("string")

    def verdict(item):
        try:
            result = function(item)
        except Exception as error:
            return f"Custom validation error: {error!s}"
        if isinstance(result, str):
            return result
        return None if result else "Custom validation failed"

    @F.pandas_udf("string")
    def judge(items: pd.Series) -> pd.Series:
        return items.map(verdict)

    return judge(value)


# Kinds of a rule; a kind not listed here is skipped.
KINDS = {
    "required": _required,
    "type": _type,
    "regex": _regex,
    "range": _range,
    "enum": _enum,
    "ip": _ip,
    "timestamp": _timestamp,
    "length": _length,
    "custom": _custom,
}

VIOLATIONS = "violations"


def with_violations(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The frame plus an array of (rule_no, field, rule_type, message), empty for a clean row."""
    found = []
    for number, rule in enumerate(rules):
        if rule.kind not in KINDS:
            continue
        present = rule.field in df.columns
        value = F.col(f"`{rule.field}`") if present else F.lit(None).cast("string")
        dtype = df.schema[rule.field].dataType if present else T.StringType()
        message = KINDS[rule.kind](value, dtype, rule.parameters)
        if rule.message:
            message = F.when(message.isNotNull(), rule.message)
        entry = F.struct(
            F.lit(number).alias("rule_no"),
            F.lit(rule.field).alias("field"),
            F.lit(rule.kind).alias("rule_type"),
            message.alias("message"),
        )
        found.append(entry)
    return df.withColumn(VIOLATIONS, F.filter(F.array(*found), lambda v: v["message"].isNotNull()))


def violations(df: DataFrame, rules: list[Rule], key: list[str]) -> DataFrame:
    """One row per violated rule and table row."""
    # the outer form keeps the optimizer from testing the size of the array first, which would
    # evaluate every rule twice
    rows = with_violations(df, rules).select(*key, F.inline_outer(VIOLATIONS))
    return rows.where(F.col("rule_no").isNotNull())


def summary(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per rule: rows checked, rows failed, share passed; one pass without exploding the rows."""
    checked = with_violations(df, rules)
    live = [(n, r) for n, r in enumerate(rules) if r.kind in KINDS]
    totals = checked.agg(
        F.count("*").alias("_all"),
        *[
            F.count_if(F.array_contains(F.col(f"{VIOLATIONS}.rule_no"), F.lit(n))).alias(f"_f{n}")
            for n, _ in live
        ],
    )
    lines = [
        F.struct(
            F.lit(n).alias("rule_no"),
            F.lit(r.field).alias("field"),
            F.lit(r.kind).alias("rule_type"),
            F.col("_all").alias("checked"),
            F.col(f"_f{n}").alias("failed"),
            F.coalesce(
                F.try_divide(F.col("_all") - F.col(f"_f{n}"), F.col("_all")), F.lit(1.0)
            ).alias("pass_rate"),
        )
        for n, r in live
    ]
    return totals.select(F.inline(F.array(*lines)))


def split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows with their violations)."""
    checked = with_violations(df, rules)
    clean = checked.where(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)
    return clean, checked.where(F.size(VIOLATIONS) > 0)


def preload_rules(required: list[str], time: str = "TimeGenerated") -> list[Rule]:
    """Required columns present and the event time in ISO form."""
    # Notations of an ISO time.
    formats = [
        "%Y-%m-%dT%H:%M:%S.%fZ", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S",
        "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d %H:%M:%S",
    ]
    rules = [Rule(name, "required", message=f"Missing required field '{name}'") for name in required]
    return [*rules, Rule(time, "timestamp", {"formats": formats}, f"Invalid {time} format")]


def is_sensitive(text: Column) -> Column:
    """True where the text mentions a secret and is not a reference to a secret store."""
    normal = F.lower(F.trim(text))
    reference = normal.startswith(REFERENCE_PREFIX) | (
        normal.startswith(REFERENCE_PARTS[0]) & normal.contains(REFERENCE_PARTS[1])
    )
    return ~reference & text.rlike("(?i)" + "|".join(SENSITIVE_PATTERNS))


def sensitive_patterns(text: Column) -> Column:
    """Number of patterns a text matches, each of which is one warning; 0 for a reference."""
    hits = F.lit(0)
    for pattern in SENSITIVE_PATTERNS:
        hits = hits + F.when(text.rlike(f"(?i){pattern}"), 1).otherwise(0)
    return F.when(is_sensitive(text), hits).otherwise(0)


def sensitive_columns(df: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Rows and columns whose text points at a secret, with the number of warnings."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("path"), sensitive_patterns(F.col(c)).alias("warnings")) for c in columns]
    )
    return df.select(*key, F.inline(F.filter(cells, lambda c: c["warnings"] > 0)))


def sensitive_values(df: DataFrame, key: list[str], json_text: str) -> DataFrame:
    """String values at any path of a JSON column that point at a secret.

    Only texts that mention a pattern (or hide letters in escapes) and are one JSON value are walked, each
    once, in Arrow batches; the plan and the time per value do not depend on how deep they lie. Objects
    inside lists are entered, lists inside lists are not. The parser takes up to 1000 levels, and a text
    with more is not JSON to it.
    """
    text = F.col(json_text)
    hinted = text.rlike("(?i)" + "|".join(SENSITIVE_PATTERNS)) | text.contains("\\u")
    walked = df.where(hinted & parse_strict(text).isNotNull()).select(*key, text.alias("_json"))
    kept = walked.select(*key).schema
    found = walked.mapInArrow(_walked(kept.names), T.StructType([*kept.fields, T.StructField("path", T.StringType()), T.StructField("value", T.StringType())]))
    found = found.where(is_sensitive(F.col("value")))
    return found.withColumn("warnings", sensitive_patterns(F.col("value")))


def _walked(key: list[str]):
    """The key columns with each string value and its path, a row per value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, paths, values = [], [], []
            for row, text in enumerate(batch.column("_json").to_pylist()):
                for path, value in string_values(text):
                    rows.append(row)
                    paths.append(path.encode("utf-8", "replace"))
                    values.append(value.encode("utf-8", "replace"))
            found = [batch.column(c).take(pa.array(rows, pa.int64())) for c in key]
            texts = [pa.array(x, pa.binary()).cast(pa.string()) for x in (paths, values)]
            yield pa.record_batch([*found, *texts], [*key, "path", "value"])

    return run


def string_values(text: str) -> Iterator[tuple[str, str]]:
    """The strings of a JSON object with their paths: members by dots, elements of a list by [n]."""
    root = json.loads(text)
    stack = [("", root)] if isinstance(root, dict) else []
    while stack:
        path, value = stack.pop()
        if isinstance(value, str):
            yield path, value
        elif isinstance(value, dict):
            prefix = path and f"{path}."
            for name, member in value.items():
                if isinstance(member, list):
                    stack += [(f"{prefix}{name}[{n}]", v) for n, v in enumerate(member) if not isinstance(v, list)]
                else:
                    stack.append((prefix + name, member))
