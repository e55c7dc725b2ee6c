"""Audit events: stamping with a content hash and finding lines whose hash no longer fits."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logharbor.functions.tagging import computed_once

# Fields of an audit event.
EVENT_FIELDS = (
    "timestamp", "event_type", "user", "action", "resource", "status", "details", "source_ip",
    "correlation_id",
)


# UTF-16 units with a short escape in JSON.
SHORT_ESCAPES = {"0022": '\\"', "005C": "\\\\", "000A": "\\n", "000D": "\\r", "0009": "\\t", "0008": "\\b", "000C": "\\f"}


def _json_text(text: Column) -> Column:
    """A string as a JSON literal in ASCII, as the hash is taken over; most need few escapes or none."""
    plain = text.rlike(r"^[ !#-\[\]-~]*\z")
    short = text.rlike(r"^[ -~\x08\t\n\f\r]*\z")
    quoted = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for code, escape in SHORT_ESCAPES.items():
        if code != "005C":  # the backslash comes first
            quoted = F.replace(quoted, F.lit(chr(int(code, 16))), F.lit(escape))
    body = F.when(plain, text).when(short, quoted).otherwise(_escaped(text))
    return F.when(text.isNull(), "null").otherwise(F.concat(F.lit('"'), body, F.lit('"')))


def _escaped(text: Column) -> Column:
    """Text with JSON escapes, one UTF-16 unit at a time."""
    units = F.regexp_extract_all(F.hex(F.encode(text, "UTF-16BE")), F.lit("(.{4})"), F.lit(1))

    def shown(unit: Column) -> Column:
        out = F.when(unit.between("0020", "007E"), F.char(F.conv(unit, 16, 10).cast("bigint")))
        out = out.otherwise(F.concat(F.lit("\\u"), F.lower(unit)))
        for code, escape in SHORT_ESCAPES.items():
            out = F.when(unit == code, F.lit(escape)).otherwise(out)
        return out

    return F.array_join(F.transform(units, shown), "")


def canonical_event(df: DataFrame, details: str = "details") -> Column:
    """Key-sorted JSON text of an event whose `details` is map<string,string>."""
    entries = F.array_sort(F.map_entries(F.col(details)))
    body = F.array_join(
        F.transform(entries, lambda e: F.concat(_json_text(e["key"]), F.lit(": "), _json_text(e["value"]))),
        ", ",
    )
    parts = []
    for name in sorted(EVENT_FIELDS):
        if name == details:
            value = F.concat(F.lit("{"), F.coalesce(body, F.lit("")), F.lit("}"))
        elif name in df.columns:
            value = _json_text(F.col(name))
        else:
            value = F.lit("null")
        parts.append(F.concat(F.lit(f'"{name}": '), value))
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def stamp(df: DataFrame) -> DataFrame:
    """Adds `hash`, the SHA-256 of the canonical event."""
    return df.withColumn("hash", F.sha2(canonical_event(df), 256))


def to_lines(stamped: DataFrame, written_at: Column) -> Column:
    """The text line of a stamped event: time, pipe, canonical JSON with the hash appended."""
    text = canonical_event(stamped)
    body = F.substring(text, F.lit(1), F.length(text) - 1)
    return F.concat(written_at, F.lit("|"), body, F.lit(', "hash": "'), F.col("hash"), F.lit('"}'))


def check_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Adds `finding`: null for an intact line, else unreadable, unhashed or tampered.

    Lines may hold any JSON, so the canonical text is rebuilt by the JSON library in Arrow batches;
    only the verdict comes back.
    """
    def judge(text: str | None) -> str | None:
        try:
            event = json.loads(text.strip().split("|", 1)[1])
            claimed = event.pop("hash", None)
        except (AttributeError, IndexError, ValueError, TypeError):
            return "unreadable"
        if not claimed:
            return "unhashed"
        actual = hashlib.sha256(json.dumps(event, sort_keys=True).encode()).hexdigest()
        return None if actual == claimed else "tampered"

    @F.pandas_udf("string")
    def verdicts(texts: pd.Series) -> pd.Series:
        return texts.map(judge)

    return computed_once(lines, *[F.col(f"`{c}`") for c in lines.columns if c != "finding"], verdicts(F.col(line)).alias("finding"))


def tampered_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    return check_lines(lines, line).where(F.col("finding").isNotNull())
