"""Delimited lines whose separator is found per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_line(line: Column) -> Column:
    """Fields by pipe, else by comma, else by runs of blanks."""
    return (
        F.when(line.contains("|"), F.split(line, r"\|"))
        .when(line.contains(","), F.split(line, ","))
        .otherwise(F.split(F.trim(line), r"\s+"))
    )


def parse_delimited_lines(lines: DataFrame, layout: Sequence[str], line: str = "line") -> DataFrame:
    """Trimmed text columns named by position; blank lines are left out, absent fields are null."""
    kept = [c for c in lines.columns if c != line]
    fields = lines.where(F.trim(F.col(line)) != "").withColumn("_fields", split_line(F.col(line)))
    return fields.select(
        *kept, *[F.trim(F.get("_fields", F.lit(i))).alias(name) for i, name in enumerate(layout)]
    )
