"""Density clusters against the definition, over all pairs."""

import datetime
import math
import random
import re

import pytest

from logharbor.operators import clusters
from logharbor.operators.clusters import density_clusters
from logharbor.session import MAX_GROUP_ROWS_KEY

START = datetime.datetime(2024, 1, 1)


def by_definition(rows, radius, least):
    """Label of each id: -1, or the number of its cluster in the order of first core points."""
    points = {r[0]: r[2:] for r in rows if all(v is not None and math.isfinite(v) for v in r[2:])}
    near = {a: [b for b in points if sum((x - y) ** 2 for x, y in zip(points[a], points[b])) <= radius * radius] for a in points}
    core = {a for a in points if len(near[a]) >= least}
    label = {}
    for a in sorted(core, key=lambda a: next((r[1], a) for r in rows if r[0] == a)):
        if a in label:
            continue
        number, stack = len(set(label.values())), [a]
        while stack:
            b = stack.pop()
            if b not in label:
                label[b] = number
                stack += [c for c in near[b] if c in core]
    return {r[0]: label.get(r[0], min((label[b] for b in near.get(r[0], []) if b in core), default=-1)) for r in rows}


def cloud(columns, seed, n=260):
    """A dense spot of a third of the rows, a chain, equal rows, a loose cloud, and values that are none."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        kind = draw.randrange(6)
        if kind < 2:
            point = [draw.gauss(1, 0.02) for _ in range(columns)]
        elif kind == 2:
            point = [i / n * 4] + [2.0] * (columns - 1)
        elif kind == 3:
            point = [draw.choice([-3.0, -2.7, 0.3, 0.6])] * columns
        else:
            point = [draw.uniform(-2, 3) for _ in range(columns)]
        if draw.random() < 0.03:
            point[draw.randrange(columns)] = draw.choice([None, math.nan, math.inf])
        rows.append((i, START + datetime.timedelta(seconds=draw.randrange(50)), *point))
    return rows


@pytest.mark.parametrize(("columns", "radius", "least"), [(1, 0.05, 4), (2, 0.3, 5), (2, 0.05, 3), (3, 0.4, 5)])
def test_density_clusters(spark, columns, radius, least):
    rows = cloud(columns, 7 * columns + least)
    names = ["a", "b", "c"][:columns]
    frame = spark.createDataFrame(rows, "id long, ts timestamp, " + ", ".join(f"{n} double" for n in names))
    spark.conf.set(MAX_GROUP_ROWS_KEY, "20")
    try:
        found = density_clusters(frame, names, "ts", "id", radius, least)
        got = {r.id: r.cluster for r in found.collect()}
    finally:
        spark.conf.unset(MAX_GROUP_ROWS_KEY)
    assert found.columns == ["id", "ts", *names, "cluster"]
    assert got == by_definition(rows, radius, least)
    assert len(set(got.values())) > 2


def test_cells_that_only_a_long_division_tells_apart(spark):
    """Two spots whose nearest points lie just within the radius, and two just beyond it."""
    reach = 1.0
    spot = lambda x, y: [(x + 0.01 * k, y) for k in range(6)]
    points = spot(0.0, 0.0) + spot(0.05 + reach, 0.0) + spot(5.0, 0.0) + spot(5.05 + reach * (1 + 1e-12), 0.0)
    rows = [(i, START, x, y) for i, (x, y) in enumerate(points)]
    frame = spark.createDataFrame(rows, "id long, ts timestamp, a double, b double")
    got = {r.id: r.cluster for r in density_clusters(frame, ["a", "b"], "ts", "id", reach, 5).collect()}
    assert got == by_definition(rows, reach, 5)


def test_edge_cases(spark):
    frame = spark.createDataFrame([(1, START, 1.5, None)], "id long, ts timestamp, a double, cluster int")
    assert [r.cluster for r in density_clusters(frame.drop("cluster"), ["a"], "ts", "id").collect()] == [-1]
    assert density_clusters(frame.limit(0).drop("cluster"), ["a"], "ts", "id").count() == 0
    with pytest.raises(ValueError, match="one to 3"):
        density_clusters(frame, ["a"] * 4, "ts", "id")


def test_nodes_are_contracted_to_their_components(spark):
    draw = random.Random(2)
    edges = [(k, k + 1) for k in range(40)] + [(100 + draw.randrange(30), 100 + draw.randrange(30)) for _ in range(20)]
    nodes = spark.createDataFrame([(n,) for n in [*range(41), *range(100, 130)]], "node long")
    found = clusters.contracted(nodes, spark.createDataFrame(edges, "_a long, _b long"))
    groups = {}
    for r in found.collect():
        groups.setdefault(r.label, set()).add(r.node)
    parts = [{n} for n in [*range(41), *range(100, 130)]]
    for a, b in edges:
        one, two = (next(p for p in parts if x in p) for x in (a, b))
        if one is not two:
            parts.remove(two)
            one |= two
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, parts))


def test_size_estimates_do_not_grow_from_round_to_round(spark, capsys):
    """The planner multiplies the sizes of joined frames: handed on by rounds, they become numbers of thousands of digits."""
    nodes = spark.range(400).withColumnRenamed("id", "node")
    found = clusters.contracted(nodes, nodes.where("node < 399").selectExpr("node as _a", "node + 1 as _b"))
    found.explain("cost")
    assert not re.search(r"sizeInBytes=[\d.]+E\+|sizeInBytes=[\d.,]+ EiB", capsys.readouterr().out)
    assert found.select("label").distinct().count() == 1


@pytest.mark.parametrize("spread", [1e-9, 0.02, 0.2])
def test_boxes_of_many_and_of_few_places(spark, spread):
    """Cells with more places than are compared at once next to cells with few, repeated places among them."""
    draw = random.Random(4)
    points = [(x + draw.uniform(-spread, spread), draw.uniform(-spread, spread)) for x in (0.0, 0.99, 2.0, 3.02) for _ in range(40)]
    points += points[:20] + [(4.0 + 0.001 * k, 0.0) for k in range(5)] + [(-0.0, 0.0), (0.0, -0.0)]
    rows = [(i, START, x, y) for i, (x, y) in enumerate(points)]
    frame = spark.createDataFrame(rows, "id long, ts timestamp, a double, b double")
    got = {r.id: r.cluster for r in density_clusters(frame, ["a", "b"], "ts", "id", 1.0, 5).collect()}
    assert got == by_definition(rows, 1.0, 5)
