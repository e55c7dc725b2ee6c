"""Ordered work per key when one key may hold a large share of all rows.

A window over (key, time) sorts every row of a key in one task. Here every key is cut into slices of about
equally many rows, in the total order the work needs, so that a burst of one key within one second and rows
without a time are cut like any others. The cuts come from a sample of the rows, as those of a sample sort
do. The window runs per (key, slice), and what a slice needs from earlier or later ones travels in a table
with one row per slice: each slice is summed up, a window over the slices of a key turns the summaries into
what is carried, and an equi join hands it to the rows.

The frame is counted and sampled when `Blocks` is made, so an input that is costly to compute is written
first. Rows that agree in every column of the order stay in one slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logharbor.session import max_group_rows, slice_rows

#: Names a slice: the key columns and the slice's number within the key. A struct compares null keys as equal.
AT = "_at"
BLOCK = "_block"
#: Slices of a frame for each shuffle partition: with some to each task, tasks come out about even.
PER_PARTITION = 16
#: Sampled rows that make up a slice. Slices differ by about one part in the root of this.
SAMPLES = 64


def same_key(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality of the key columns of two aliased frames."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def cut_points(df: DataFrame, keys: list[str], order: list[str], least: int | None = None) -> tuple[DataFrame, int] | None:
    """For each key with more than one slice, where its slices but the first begin, in order; and the most cuts of a key.

    A slice has about `least` rows or more (`spark.logharbor.sliceRows` unless given), and there are at most PER_PARTITION slices for
    each shuffle partition, so this table, which the driver holds and broadcasts, is bounded by the
    settings. None where the whole frame is one slice.
    """
    spark, places = df.sparkSession, df.select(*keys, *order)
    total, partitions = places.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = max(least or slice_rows(spark), -(-total // (PER_PARTITION * partitions)))
    if total <= rows:
        return None
    drawn = places.where(F.pmod(F.xxhash64(F.lit(5), *keys, *order), F.lit(rows)) < SAMPLES)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    # a row for a sample: of a slice with fewer rows than samples each row is one
    begins = drawn.withColumn("_nth", nth).where(F.col("_nth") % min(SAMPLES, rows) == 0)
    cuts = begins.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct(*order))).alias("_cuts"))
    found = cuts.toArrow()
    longest = max((len(c) for c in found.column("_cuts")), default=0)
    return spark.createDataFrame(found, cuts.schema), longest


class Blocks:
    """A frame whose keys are cut into slices; `order` is a total order within a key, nulls first."""

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], least: int | None = None):
        self.keys, self.order = list(keys), list(order)
        found = cut_points(df, self.keys, self.order, least)
        # 0 in every row; a literal would be folded, and a join on it alone be a nested loop
        number = F.pmod(F.xxhash64(*self.order), F.lit(1)).cast("int")
        if found:
            cuts, longest = found
            if keys:
                joined = df.alias("d").join(F.broadcast(cuts.alias("c")), same_key("d", "c", self.keys), "left")
                df = joined.select("d.*", "_cuts")
            else:
                df = df.withColumn("_cuts", cuts.select("_cuts").scalar())
            number = self._number(longest)
        self.df = df.withColumn(AT, F.struct(*self.keys, number.alias(BLOCK))).drop("_cuts")

    def _number(self, longest: int) -> Column:
        """How many cuts of the key are at or before a row, by binary search."""
        place = F.struct(*self.order)
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(longest.bit_length()))] or [F.lit(1)])

        def step(at: Column, width: Column) -> Column:
            return F.when(F.get("_cuts", at + width - 1) <= place, at + width).otherwise(at)

        return F.aggregate(steps, F.lit(0), step)

    @property
    def window(self):
        return Window.partitionBy(AT).orderBy(*self.order)

    @property
    def running(self):
        return self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def neighbours(self, begin: int, end: int):
        """Slices of the same key from `begin` to `end` places away."""
        keys = [F.col(f"{AT}.{k}") for k in self.keys]
        return Window.partitionBy(*keys).orderBy(f"{AT}.{BLOCK}").rowsBetween(begin, end)

    @property
    def earlier(self):
        return self.neighbours(Window.unboundedPreceding, -1)

    def carried(self, df: DataFrame, summary: dict[str, Column], carry: dict[str, Column]) -> DataFrame:
        """Adds to every row the `carry` columns, windows over the summaries of its key's slices."""
        sums = df.groupBy(AT).agg(*[c.alias(name) for name, c in summary.items()])
        edges = sums.select(AT, *[c.alias(name) for name, c in carry.items()])
        return df.join(edges, AT)

    def previous(self, columns: dict[str, str]) -> DataFrame:
        """Adds the value each column had in the row before, null in the first row of a key."""
        order = F.struct(*self.order)
        summary = {f"_l_{new}": F.max_by(F.struct(F.col(old).alias("v")), order) for new, old in columns.items()}
        carry = {f"_c_{new}": F.last(f"_l_{new}").over(self.earlier) for new in columns}
        out = self.carried(self.df, summary, carry)
        first = F.row_number().over(self.window) == 1
        for new, old in columns.items():
            out = out.withColumn(new, F.when(first, F.col(f"_c_{new}.v")).otherwise(F.lag(old).over(self.window)))
        return out.drop(*carry)


def running_number(df: DataFrame, keys: list[str], order: list[str], name: str, least: int | None = None) -> DataFrame:
    """Position of each row within its key in the given order, starting at 1."""
    blocks = Blocks(df, keys, order, least)
    out = blocks.carried(
        blocks.df, {"_n": F.count(F.lit(1))}, {"_before": F.coalesce(F.sum("_n").over(blocks.earlier), F.lit(0))}
    )
    number = (F.row_number().over(blocks.window) + F.col("_before")).cast("bigint")
    return out.withColumn(name, number).drop("_before", AT)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str,
    spread: list[str],
    counts: DataFrame | None = None,
) -> DataFrame:
    """Equi join against a side that is unique per key, with large left keys spread over tasks.

    Left keys over the row limit get a salt from the `spread` columns; only those keys are repeated
    on the right. The list of large keys is bounded by (left rows / limit). `counts` gives the left rows
    per key (`_rows`) where they are known already.
    """
    limit = max_group_rows(left.sparkSession)
    counts = left.groupBy(*on).agg(F.count("*").alias("_rows")) if counts is None else counts
    large = (
        counts.where(F.col("_rows") > limit)
        .select(*on, F.ceil(F.col("_rows") / F.lit(float(limit))).cast("int").alias("_salts"))
    )
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    spread_left = (
        left.alias("d").join(large.alias("h"), same_key("d", "h", on), "left")
        .select("d.*", "_salts")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int"))
        .drop("_salts")
    )
    spread_right = (
        right.alias("d").join(large.alias("h"), same_key("d", "h", on), "left")
        .select("d.*", "_salts")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )
    return spread_left.join(spread_right, [*on, "_salt"], how).drop("_salt")
