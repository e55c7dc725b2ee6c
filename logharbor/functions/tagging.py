"""One tagged frame feeds the accepted rows, the quarantine and the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reason"


def computed_once(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Select that a later filter is not pushed through.

    A filter on a derived column is otherwise rewritten below the projection, where every expression
    it depends on is evaluated a second time for every row. Predicates stop at a generator's output.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def first_reason(*checks: tuple[Column, str | Column]) -> Column:
    """Text of the first check that is true, null when none is."""
    arms = [
        F.when(F.coalesce(failed, F.lit(False)), text if isinstance(text, Column) else F.lit(text))
        for failed, text in checks
    ]
    return F.coalesce(*arms)


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).drop(REASON)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNotNull())


def missing_names(names: list[str]) -> Column:
    """Comma-separated names of the columns that are null, in the given order."""
    return F.concat_ws(",", *[F.when(F.col(n).isNull(), F.lit(n)) for n in names])
