"""Redaction of personal data and secrets by pattern and by field name."""

from __future__ import annotations

import json
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns in the order they are applied.
PII_PATTERNS = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phone": r"\b\d{3}[-.]?\d{4}\b|\b\d{3}[-.]?\d{3}[-.]?\d{4}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "credit_card": r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b",
    "ipv4": r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b",
    "api_key": r"\b[a-zA-Z0-9_]{32,}\b",
}

# What each pattern implies about the place where it starts. Tested first, it spares the costly word
# boundary test at almost every character; it never changes what matches.
_STARTS = {
    "phone": r"(?=\d)",
    "ssn": r"(?=\d)",
    "credit_card": r"(?=\d)",
    "ipv4": r"(?=[0-9])",
    "api_key": r"(?<![a-zA-Z0-9_])(?=[a-zA-Z0-9_]{32})",
}


def _regex(kind: str, pattern: str) -> str:
    """The pattern with Unicode meaning of word boundary, digit and blank."""
    known = PII_PATTERNS.get(kind) == pattern
    return f"(?U){_STARTS[kind]}(?:{pattern})" if known and kind in _STARTS else f"(?U){pattern}"


#: Patterns that need a digit, next to each other in the order they are applied.
_NUMERIC = ("phone", "ssn", "credit_card", "ipv4")


def _may_match(kind: str, pattern: str, text: Column) -> Column:
    """False where a plain test already rules the pattern out."""
    if PII_PATTERNS.get(kind) != pattern:
        return F.lit(True)
    if kind == "email":
        return text.contains("@")
    return _has_digit(text) if kind in _NUMERIC else F.lit(True)


def _has_digit(text: Column) -> Column:
    return text.rlike(r"(?U)\d")


# A field whose lower-case name contains one of these holds personal data.
PII_NAME_PARTS = (
    "password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "authorization", "auth",
    "bearer", "cookie", "session", "email", "e_mail", "mail", "phone", "telephone", "mobile", "ssn",
    "social_security", "credit_card", "creditcard", "card_number", "address", "street", "zipcode",
    "postal_code", "firstname", "lastname", "fullname", "username", "user_name",
)


def marker(kind: str) -> str:
    return f"[REDACTED:{kind.upper()}]"


def is_pii_name(name: str) -> bool:
    return any(part in name.lower() for part in PII_NAME_PARTS)


def redact_text(text: Column, patterns: dict[str, str] | None = None) -> Column:
    """Text with every pattern match replaced by its marker, pattern after pattern.

    Markers hold no digit, so one look at the text decides for all numeric patterns.
    """
    source, plain = text, patterns is None

    def replaced(value: Column, kind: str) -> Column:
        return F.regexp_replace(value, _regex(kind, (patterns or PII_PATTERNS)[kind]), marker(kind))

    for kind, pattern in (patterns or PII_PATTERNS).items():
        if plain and kind in _NUMERIC:
            if kind == _NUMERIC[0]:
                numeric = reduce(replaced, _NUMERIC, text)
                text = F.when(_has_digit(source), numeric).otherwise(text)
            continue
        text = F.when(_may_match(kind, pattern, text), replaced(text, kind)).otherwise(text)
    return text


def _redact_value(value: Column, dtype: T.DataType, name: str) -> Column:
    """Structs, lists and maps are entered before the name is judged; only scalars go by name."""
    if _is_nested(dtype):
        return _redact_inside(value, dtype)
    if is_pii_name(name):
        return F.lit(marker(name))
    return redact_text(value) if isinstance(dtype, T.StringType) else value


def _is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def _redact_inside(value: Column, dtype: T.DataType) -> Column:
    """A nested value; elements of a list have no name, so only patterns apply. Lists in lists are not entered."""
    if isinstance(dtype, T.StructType):
        return _redact_struct(value, dtype)
    if isinstance(dtype, T.MapType):
        return _redact_map(value, dtype)
    element = dtype.elementType
    if isinstance(element, (T.StructType, T.MapType)):
        return F.transform(value, lambda item: _redact_inside(item, element))
    return F.transform(value, lambda item: redact_text(item)) if isinstance(element, T.StringType) else value


def _redact_struct(value: Column, dtype: T.StructType) -> Column:
    fields = [_redact_value(value[f.name], f.dataType, f.name).alias(f.name) for f in dtype.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def _redact_map(value: Column, dtype: T.MapType) -> Column:
    """Maps carry their field names as keys, so the name test runs per entry.

    Scalars become text, since a value under a personal name does.
    """
    inner = dtype.valueType

    def entry(key: Column, item: Column) -> Column:
        if _is_nested(inner):
            return _redact_inside(item, inner)
        name = key.cast("string")
        named = F.lit(False)
        for part in PII_NAME_PARTS:
            named = named | F.lower(name).contains(part)
        kept = redact_text(item) if isinstance(inner, T.StringType) else item.cast("string")
        return F.when(named, F.concat(F.lit("[REDACTED:"), F.upper(name), F.lit("]"))).otherwise(kept)

    return F.transform_values(value, entry)


def redact_frame(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The frame with the given columns (default: all) redacted; decided from the schema."""
    chosen = set(df.columns if columns is None else columns)
    return df.select(
        *[
            _redact_value(F.col(f"`{f.name}`"), f.dataType, f.name).alias(f.name)
            if f.name in chosen
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _redact_member(name: str | None, value, compiled: dict[str, re.Pattern]):
    """One JSON value; objects and lists are entered before the name is judged."""
    if isinstance(value, dict):
        return {k: _redact_member(k, v, compiled) for k, v in value.items()}
    if isinstance(value, list):
        return [_redact_member(None, v, compiled) if isinstance(v, (str, dict)) else v for v in value]
    if name is not None and is_pii_name(name):
        return marker(name)
    if isinstance(value, str):
        for kind, pattern in compiled.items():
            value = pattern.sub(marker(kind), value)
    return value


def redact_json(text: Column) -> Column:
    """JSON text with its members redacted at any depth, for records without a declared structure.

    The names are only known per value, so this runs in Python, in Arrow batches. Text that is not
    JSON is redacted as plain text.
    """

    @F.pandas_udf("string")
    def redacted(texts: pd.Series) -> pd.Series:
        compiled = {kind: re.compile(p) for kind, p in PII_PATTERNS.items()}

        def one(item):
            if item is None:
                return None
            try:
                value = json.loads(item)
            except ValueError:
                return _redact_member(None, item, compiled)
            return json.dumps(_redact_member(None, value, compiled), ensure_ascii=False)

        return texts.map(one)

    return redacted(text)


def pii_report(df: DataFrame, column: str, patterns: dict[str, str] | None = None) -> DataFrame:
    """Per pattern: rows with a match and number of matches; one pass, one row per pattern.

    Each pattern is counted on the original text.
    """
    patterns = patterns or PII_PATTERNS
    text = F.col(column)
    hits = {
        kind: F.when(_may_match(kind, p, text), F.regexp_count(text, F.lit(_regex(kind, p)))).otherwise(0)
        for kind, p in patterns.items()
    }
    totals = df.select(*[h.alias(k) for k, h in hits.items()]).agg(
        *[
            F.struct(
                F.lit(k).alias("pattern"),
                F.count_if(F.col(k) > 0).alias("rows_hit"),
                F.coalesce(F.sum(F.col(k).cast("bigint")), F.lit(0)).alias("matches"),
            ).alias(k)
            for k in hits
        ]
    )
    return totals.select(F.inline(F.array(*hits)))
