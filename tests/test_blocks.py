"""Ordered operators on a frame where one key holds most rows, against plain Python."""

import datetime
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logharbor.functions.blocks import AT, BLOCK, Blocks, running_number, salted_join
from logharbor.operators.metrics import counter_increase
from logharbor.operators.patterns import sequence_hashes
from logharbor.session import SLICE_ROWS_KEY

START = datetime.datetime(2024, 1, 1)


def rows(seed=3, n=120):
    """A hot key with bursts and gaps, small keys, and a null key."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        second = rng.choice([rng.randrange(20), rng.randrange(5000), 100_000 + rng.randrange(30)])
        out.append((i, key, START + datetime.timedelta(seconds=second), rng.choice([None, 1.0, 2.0, 3.0])))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(rows(), "id long, key string, ts timestamp, value double")


def by_key():
    groups = {}
    for row in sorted(rows(), key=lambda r: (r[2], r[0])):
        groups.setdefault(row[1], []).append(row)
    return groups


def test_every_key_is_cut_in_its_order(frame, small_groups):
    got = Blocks(frame, ["key"], ["ts", "id"]).df.select("id", "ts", f"{AT}.*").collect()
    sizes = Counter((r["key"], r[BLOCK]) for r in got)
    assert max(sizes.values()) <= 2 * small_groups and len(sizes) > 10
    for key in {r["key"] for r in got}:
        numbers = [r[BLOCK] for r in sorted((r for r in got if r["key"] == key), key=lambda r: (r["ts"], r["id"]))]
        assert numbers == sorted(numbers) and set(numbers) == set(range(max(numbers) + 1))


@pytest.mark.parametrize("value", [None, START])
def test_a_key_without_times_and_a_burst_are_cut(spark, value):
    """A third of the rows in one second of one key, a third without a time, as one frame of many slices."""
    n = 60_000
    some = F.when(F.col("id") % 3 == 0, F.lit(value).cast("timestamp")).otherwise(F.timestamp_seconds("id"))
    df = spark.range(n).select("id", F.when(F.col("id") % 3 < 2, "hot").otherwise((F.col("id") % 50).cast("string")).alias("key"), some.alias("ts"))
    spark.conf.set(SLICE_ROWS_KEY, "1000")
    try:
        blocks = Blocks(df, ["key"], ["ts", "id"])
        numbered = running_number(df, ["key"], ["ts", "id"], "n")
    finally:
        spark.conf.unset(SLICE_ROWS_KEY)
    sizes = [r["count"] for r in blocks.df.groupBy(AT).count().collect()]
    assert max(sizes) < 2 * 1000 and sum(sizes) == n
    of_tasks = blocks.df.repartition(4, AT).groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert of_tasks.max() <= 2 * of_tasks.median()
    assert numbered.where("key = 'hot'").agg(F.max("n"), F.count_distinct("n")).first() == (40_000, 40_000)


def test_positions(frame, small_groups):
    got = {r["id"]: r["n"] for r in running_number(frame, ["key"], ["ts", "id"], "n").collect()}
    assert got == {r[0]: i + 1 for g in by_key().values() for i, r in enumerate(g)}


def test_positions_over_the_whole_frame(frame, small_groups):
    got = {r["id"]: r["n"] for r in running_number(frame, [], ["ts", "id"], "n").collect()}
    everything = sorted(rows(), key=lambda r: (r[2], r[0]))
    assert got == {r[0]: i + 1 for i, r in enumerate(everything)}


def test_previous_value(frame, small_groups):
    df = Blocks(frame, ["key"], ["ts", "id"]).previous({"before": "value"})
    got = {r["id"]: r["before"] for r in df.collect()}
    assert got == {r[0]: g[i - 1][3] if i else None for g in by_key().values() for i, r in enumerate(g)}


@pytest.mark.parametrize("window", [3, 60, 200_000])
def test_increase_over_windows_of_many_slices(frame, small_groups, window):
    got = {r["id"]: r["increase"] for r in counter_increase(frame, ["key"], "id", window).collect()}
    for group in by_key().values():
        gains = [0.0]
        for before, row in zip(group, group[1:]):
            a, b = before[3], row[3]
            gains.append(0.0 if a is None or b is None else b if b < a else b - a)
        for row in group:
            inside = [g for g, r in zip(gains, group) if row[2] - datetime.timedelta(seconds=window) < r[2] <= row[2]]
            later = [g for g, r in zip(gains, group) if r[2] == row[2] and r[0] > row[0]]
            assert got[row[0]] == pytest.approx(sum(inside) - sum(later))


def test_sequences_over_slice_edges(frame, small_groups):
    df = sequence_hashes(frame, ["key"], ["ts", "id"], F.col("id"), 4)
    got = {r["id"]: r["pattern"] for r in df.collect()}
    want = {}
    for group in by_key().values():
        for i, row in enumerate(group):
            four = [str(x[0]) for x in group[i : i + 4]]
            want[row[0]] = hashlib.md5("\x1f".join(four).encode()).hexdigest() if len(four) == 4 else None
    assert got == want


def test_rows_without_a_time_come_first(spark, small_groups):
    rows = [(1, "a", START), (2, "a", None), (3, "a", START + datetime.timedelta(days=1)), (4, None, None)]
    frame = spark.createDataFrame(rows, "id long, key string, ts timestamp")
    got = {r["id"]: r["n"] for r in running_number(frame, ["key"], ["ts", "id"], "n").collect()}
    assert got == {2: 1, 1: 2, 3: 3, 4: 1}


def test_salted_join_keeps_every_row(spark, frame, small_groups):
    right = spark.createDataFrame([("hot", 1), ("a", 2)], "key string, mark int")
    joined = salted_join(frame, right, ["key"], "left", ["id"]).collect()
    marks = {"hot": 1, "a": 2}
    assert {r["id"]: r["mark"] for r in joined} == {r[0]: marks.get(r[1]) for r in rows()}
