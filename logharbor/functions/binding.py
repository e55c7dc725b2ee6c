"""A value that an expression uses several times and that is computed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over `value`, which is evaluated once whatever the number of its uses."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))
