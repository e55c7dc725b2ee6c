"""Timestamp parsing and formatting from strptime-style format strings."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats tried in order for log timestamps.
LOG_FORMATS = [
    "%Y-%m-%dT%H:%M:%S.%fZ",
    "%Y-%m-%dT%H:%M:%SZ",
    "%Y-%m-%d %H:%M:%S",
    "%b %d %Y %H:%M:%S",
    "%Y/%m/%d %H:%M:%S",
]

# directive -> (pattern when a literal follows, pattern next to another directive, text shape)
_DIRECTIVES = {
    "Y": ("yyyy", "yyyy", r"\d{4}"),
    "y": ("yy", "yy", r"\d{2}"),
    "m": ("M", "MM", r"\d{1,2}"),
    "d": ("d", "dd", r"\d{1,2}"),
    "H": ("H", "HH", r"\d{1,2}"),
    "I": ("h", "hh", r"\d{1,2}"),
    "M": ("m", "mm", r"\d{1,2}"),
    "S": ("s", "ss", r"\d{1,2}"),
    "f": ("SSSSSS", "SSSSSS", r"\d{1,6}"),
    "b": ("MMM", "MMM", r"[A-Za-z]{3}"),
    "B": ("MMMM", "MMMM", r"[A-Za-z]+"),
    "p": ("a", "a", r"[AaPp][Mm]"),
    "z": ("XX", "XX", r"(?:Z|[+-]\d{4})"),
}


def _tokens(fmt: str) -> list[tuple[str, str]]:
    """('d', directive) and ('t', literal) pieces of a strptime format."""
    pieces = re.findall(r"%(.)|([^%]+)", fmt)
    return [("d", directive) if directive else ("t", text) for directive, text in pieces]


def _quoted(text: str) -> str:
    return re.sub(r"[A-Za-z]+", lambda m: f"'{m.group()}'", text).replace("''", "")


def spark_pattern(fmt: str, padded: bool = False) -> str:
    """Spark datetime pattern for a strptime format."""
    tokens = _tokens(fmt)
    out = []
    for i, (kind, token) in enumerate(tokens):
        if kind == "t":
            out.append(_quoted(token))
            continue
        loose, tight, _ = _DIRECTIVES[token]
        joined = (i + 1 < len(tokens) and tokens[i + 1][0] == "d") or (i and tokens[i - 1][0] == "d")
        out.append(tight if padded or joined else loose)
    return "".join(out)


def shape_of(fmt: str) -> str:
    """Anchored regular expression for the texts a format can accept."""
    parts = []
    for kind, token in _tokens(fmt):
        if kind == "d":
            parts.append(_DIRECTIVES[token][2])
        else:
            parts.append(r"\s+".join(re.escape(p) for p in re.split(r"\s+", token)))
    return "^" + "".join(parts) + r"\z"


def parse_timestamp(text: Column, formats: list[str] | None = None) -> Column:
    """First format that fits wins; text that fits none gives null. Times are UTC.

    The shape test keeps the parser away from text it would reject: a rejected parse costs a Java
    exception per row.
    """
    tries = []
    for fmt in formats or LOG_FORMATS:
        value = F.regexp_replace(text, r"\s+", " ") if " " in fmt else text
        tries.append(
            F.when(text.rlike(shape_of(fmt)), F.try_to_timestamp(value, F.lit(spark_pattern(fmt))))
        )
    return F.coalesce(*tries)


def format_timestamp(ts: Column, fmt: str) -> Column:
    return F.date_format(ts, spark_pattern(fmt, padded=True))


def bin_time(ts: Column, width: str) -> Column:
    """Start of the fixed-width bin holding `ts`, e.g. width '5 minutes'."""
    seconds = width_seconds(width)
    return F.timestamp_seconds((F.floor(F.unix_seconds(ts) / F.lit(seconds)) * seconds).cast("bigint"))


def width_seconds(width: str) -> int:
    amount, unit = width.split()
    per_unit = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(amount) * per_unit[unit.rstrip("s")]


def since(ts: Column, as_of, lookback: str) -> Column:
    """Rows at or after `as_of - lookback`; a plain range on the column, so it reaches the scan."""
    return ts >= as_timestamp(as_of) - F.expr(f"interval {lookback}")


def as_timestamp(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(str(value).replace("T", " ").removesuffix("Z")).cast("timestamp")


def lag_seconds(ts: Column, as_of) -> Column:
    """Seconds from `ts` to `as_of`, never below zero."""
    micros = F.unix_micros(as_timestamp(as_of)) - F.unix_micros(ts)
    return F.greatest(micros / F.lit(1_000_000.0), F.lit(0.0))
