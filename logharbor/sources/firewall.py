"""Pipe-delimited firewall lines to typed rows, in one projection and without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logharbor.functions.network import canonical_ip
from logharbor.functions.tagging import REASON, computed_once, first_reason, missing_names
from logharbor.functions.timestamps import LOG_FORMATS, as_timestamp, parse_timestamp

# Field order of a line, required fields and known actions.
LINE_LAYOUT = (
    "TimeGenerated",
    "SourceIP",
    "DestinationIP",
    "FirewallAction",
    "RuleName",
    "Protocol",
    "SourcePort",
    "DestinationPort",
    "BytesTransferred",
)
REQUIRED = ("TimeGenerated", "SourceIP", "DestinationIP", "FirewallAction")
ACTIONS = ("allow", "deny", "drop", "reset")
INTEGERS = {"SourcePort": "int", "DestinationPort": "int", "BytesTransferred": "bigint"}
ADDRESSES = ("SourceIP", "DestinationIP")


def _typed(name: str, text: Column) -> Column:
    if name == "TimeGenerated":
        return parse_timestamp(text, LOG_FORMATS)
    if name in ADDRESSES:
        return canonical_ip(F.trim(text))
    if name in INTEGERS:
        return text.try_cast(INTEGERS[name])
    if name == "FirewallAction":
        return F.lower(text)
    if name == "Protocol":
        return F.upper(text)
    return F.trim(text)


def parse_firewall_lines(lines: DataFrame, as_of, line: str = "line") -> DataFrame:
    """Typed columns plus `reason`, null for a usable line; the other input columns are kept.

    A missing tail gives nulls, extra fields are ignored.
    """
    parts = lines.withColumn("_parts", F.split(F.trim(F.col(line)), r"\|"))
    raw = parts.withColumns(
        {
            f"_{name}": F.nullif(F.get("_parts", F.lit(i)), F.lit(""))
            for i, name in enumerate(LINE_LAYOUT)
        }
    )
    typed = raw.withColumns({name: _typed(name, F.col(f"_{name}")) for name in LINE_LAYOUT})

    lost = {
        name: F.col(f"_{name}").isNotNull() & F.col(name).isNull()
        for name in ("TimeGenerated", *ADDRESSES, *INTEGERS)
    }
    missing = missing_names(list(REQUIRED))
    reason = first_reason(
        (F.col("TimeGenerated").isNull(), "bad_timestamp"),
        *[(lost[name], f"bad_ip:{name}") for name in ADDRESSES],
        *[(lost[name], f"bad_integer:{name}") for name in INTEGERS],
        (missing != "", F.concat(F.lit("missing_fields:"), missing)),
        (~F.col("FirewallAction").isin(*ACTIONS), "bad_action"),
    )
    return computed_once(
        typed,
        *lines.columns,
        *LINE_LAYOUT,
        F.lit("Firewall").alias("LogSource"),
        as_timestamp(as_of).alias("ProcessingTime"),
        reason.alias(REASON),
    )


def is_valid_firewall_row(
    source: str = "SourceIP",
    destination: str = "DestinationIP",
    action: str = "Action",
    time: str = "TimeGenerated",
    actions: tuple[str, ...] = ACTIONS,
) -> Column:
    """Required present, both addresses well formed, action known; never null."""
    ok = (
        F.col(time).isNotNull()
        & canonical_ip(F.col(source)).isNotNull()
        & canonical_ip(F.col(destination)).isNotNull()
        & F.lower(F.col(action)).isin(*actions)
    )
    return F.coalesce(ok, F.lit(False))
