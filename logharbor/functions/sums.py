"""Sums that cannot overflow."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LANE = 2**32


def wide_sum(column: Column) -> Column:
    """Exact sum of a BIGINT column as DECIMAL(38,0), even where the BIGINT sum would overflow.

    Two BIGINT lanes keep the aggregation in fixed-width buffers; the lanes meet once per group.
    """
    high = F.sum(F.shiftright(column, 32))
    low = F.sum(column.bitwiseAND(F.lit(_LANE - 1)))
    return high.cast("decimal(38,0)") * F.lit(_LANE).cast("decimal(11,0)") + low.cast("decimal(38,0)")


def megabytes(total: Column) -> Column:
    return F.round(total.cast("double") / F.lit(1048576.0), 2)
