"""Density clustering of real-valued points, exact, by a grid.

A cell of the grid is so small that all points in it are neighbours. A cell with enough points for a core
consists of core points, however many it has, and needs no pair of them to be looked at. Points of other
cells count their neighbours box by box: cells are divided into boxes with their extent and number of
points, and only boxes that the sphere around a point cuts through are opened. Two cells of core points
are one cluster if any two of their points are neighbours; that is settled by comparing extents, and
dividing further only what they leave open. Cells are then contracted to clusters.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logharbor.functions.blocks import running_number, salted_join
from logharbor.session import cut_lineage, written

# Neighbourhood radius and the points, itself included, that make a core point.
RADIUS = 0.3
MIN_CLUSTER = 5
#: Most columns; the cells around one grow with a power of their number.
MOST_COLUMNS = 3
#: Boxes along each side of a cell when neighbours are counted.
FINE = 8
#: Share by which cells are smaller than they could be, so that rounding does not part neighbours.
SLACK = 1e-6
#: Divisions after which points are compared one by one, and places of a box that are compared so at once.
FINEST, FEW = 50, 16


class Grid:
    """Names and expressions for points of some columns and cells of one side."""

    def __init__(self, columns: list[str], radius: float):
        n = len(columns)
        self.square = radius * radius
        self.side = radius / n**0.5 * (1 - SLACK)
        self.cell = [f"_c{k}" for k in range(n)]
        self.at = [f"_x{k}" for k in range(n)]
        self.low, self.high = [f"_l{k}" for k in range(n)], [f"_h{k}" for k in range(n)]
        reach = range(-int(n**0.5) - 1, int(n**0.5) + 2)
        gap = lambda o: sum((max(abs(k) - 1, 0) * self.side) ** 2 for k in o)
        #: Cells that may hold neighbours of a point in a cell, as steps from it.
        self.steps = [o for o in product(reach, repeat=n) if gap(o) <= self.square * (1 + 4 * SLACK)]

    def cells(self) -> dict[str, Column]:
        return {c: F.floor(F.col(x) / self.side).cast("bigint") for c, x in zip(self.cell, self.at)}

    def codes(self, parts: int, names: list[str]) -> dict[str, Column]:
        """Which of `parts` equal divisions of the cell's sides a point lies in."""
        inside = [F.col(x) / self.side - F.floor(F.col(x) / self.side) for x in self.at]
        return {name: F.floor(i * F.lit(float(parts))).cast("bigint") for name, i in zip(names, inside)}

    def extent(self) -> list[Column]:
        lows = [F.min(x).alias(name) for x, name in zip(self.at, self.low)]
        return lows + [F.max(x).alias(name) for x, name in zip(self.at, self.high)]

    def around(self, steps: list[tuple]) -> Column:
        """The cells at these steps from a row's own, to be inlined as the cell columns."""
        return F.inline(F.array(*[F.struct(*[(F.col(c) + s).alias(c) for c, s in zip(self.cell, o)]) for o in steps]))

    def nearest(self, a: str, b: str) -> Column:
        """Square of the least distance of two boxes; rounding is that of the distance of two points."""
        sides = zip(self.low, self.high)
        gaps = [F.greatest(F.col(f"{a}.{lo}") - F.col(f"{b}.{hi}"), F.col(f"{b}.{lo}") - F.col(f"{a}.{hi}"), F.lit(0.0)) for lo, hi in sides]
        return reduce(Column.__add__, [g * g for g in gaps])

    def farthest(self, a: str, b: str) -> Column:
        sides = zip(self.low, self.high)
        spans = [F.greatest(F.col(f"{a}.{hi}") - F.col(f"{b}.{lo}"), F.col(f"{b}.{hi}") - F.col(f"{a}.{lo}")) for lo, hi in sides]
        return reduce(Column.__add__, [s * s for s in spans])

    def as_boxes(self, points: DataFrame, *kept: str) -> DataFrame:
        """Points as boxes without extent."""
        pairs = [F.col(x).alias(name) for names in (self.low, self.high) for x, name in zip(self.at, names)]
        return points.select(*kept, *pairs)


def _neighbours(grid: Grid, probes: DataFrame, points: DataFrame, boxes: DataFrame) -> DataFrame:
    """For each probe and cell around it, how many of the points are within the radius: _row, the cell, n.

    `probes` has _row, the extent of a point and a cell around it; there are few for each cell. Boxes
    wholly within the radius count at once, and of those that are cut the points are looked at.
    """
    codes = [f"_f{k}" for k in range(len(grid.cell))]
    met = probes.alias("p").join(boxes.alias("b"), [F.col(f"p.{c}") == F.col(f"b.{c}") for c in grid.cell])
    met = met.where(grid.nearest("p", "b") <= grid.square)
    whole = grid.farthest("p", "b") <= grid.square
    inside = met.where(whole).select("p._row", *[f"p.{c}" for c in grid.cell], "b.n")
    cut = met.where(~whole).select("p._row", *[F.col(f"p.{c}").alias(f"_p{c}") for c in grid.low], *[f"b.{c}" for c in [*grid.cell, *codes]])
    cut = cut.withColumnRenamed("_row", "_probe")
    key = [*grid.cell, *codes]
    opened = points.withColumns(grid.codes(FINE, codes)).join(cut.select(*key).distinct(), key, "left_semi")
    pairs = salted_join(opened, cut, key, "inner", ["_row"], boxes.select(*key, F.col("n").alias("_rows")))
    apart = [F.col(x) - F.col(f"_p{low}") for x, low in zip(grid.at, grid.low)]
    close = pairs.where(reduce(Column.__add__, [a * a for a in apart]) <= grid.square)
    close = close.select(F.col("_probe").alias("_row"), *grid.cell, F.lit(1).cast("bigint").alias("n"))
    return inside.unionByName(close).groupBy("_row", *grid.cell).agg(F.sum("n").alias("n"))


def _linked(grid: Grid, core: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs of core cells (_a, _b as structs) with a pair of core points within the radius.

    `core` has the extent of each core cell, `points` the core points. Each round divides the boxes that
    are still open along every side, those with few different places into the places; a cell pair leaves
    with its first pair of boxes that is wholly close.
    """
    as_key = F.struct(*grid.cell).alias("key")
    boxes = core.select(as_key, F.lit("").alias("code"), *grid.low, *grid.high)
    half = [o for o in grid.steps if o > (0,) * len(o)]
    sides = core.select(as_key.alias("_a"), grid.around(half)).select("_a", F.struct(*grid.cell).alias("_b"))
    state = sides.withColumns({"_ca": F.lit(""), "_cb": F.lit("")})
    here = points.groupBy(as_key, *grid.at).agg(F.lit("").alias("code"), F.lit(FEW + 1).cast("bigint").alias("n"))
    links, level = [], 0
    while True:
        a, b = boxes.alias("a"), boxes.alias("b")
        parent = "code" if level == 0 else "parent"
        met = state.join(a, (F.col("_a") == F.col("a.key")) & (F.col("_ca") == F.col(f"a.{parent}")))
        met = met.join(b, (F.col("_b") == F.col("b.key")) & (F.col("_cb") == F.col(f"b.{parent}")))
        met = met.where(grid.nearest("a", "b") <= grid.square)
        close = (grid.farthest("a", "b") <= grid.square).alias("close")
        met = written(met.select("_a", "_b", F.col("a.code").alias("_ca"), F.col("b.code").alias("_cb"), close), "clusters")
        found = met.where("close").select("_a", "_b").distinct()
        links.append(found)
        state = met.where("not close").drop("close").join(found, ["_a", "_b"], "left_anti")
        if state.isEmpty():
            return reduce(DataFrame.unionByName, links).distinct()
        level += 1
        ends = [F.struct(F.col(c).alias("key"), F.col(code).alias("code")) for c, code in (("_a", "_ca"), ("_b", "_cb"))]
        opened = state.select(F.inline(F.array(*ends))).distinct()
        names = [f"_f{k}" for k in range(len(grid.cell))]
        finer = F.concat_ws(",", *grid.codes(1 << level, names).values())
        place = F.concat_ws(":", *grid.at)
        here = here.join(opened, ["key", "code"], "left_semi").withColumnRenamed("code", "parent")
        here = here.withColumn("code", F.when((F.col("n") <= FEW) | F.lit(level >= FINEST), place).otherwise(finer)).drop("n")
        here = written(here, "clusters")
        boxes = here.groupBy("key", "parent", "code").agg(*grid.extent(), F.count(F.lit(1)).alias("n"))
        boxes = written(boxes, "clusters")
        here = here.drop("parent").join(boxes.select("key", "code", "n"), ["key", "code"])


def contracted(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """`node, label` with one label for the nodes that edges (_a, _b) connect.

    Every round each node joins the neighbour with the least hash, itself included, and edges between
    what is left are kept; the hash differs from round to round, so the number of nodes falls by a share
    each time whatever the shape. Least hashes come from a partial aggregate. What a round leaves is
    written as a table, whose size is known: a checkpoint would hand on the planner's estimate, and as each
    round multiplies those of the rounds before, it would soon be a number of many thousand digits.
    """
    labels, turn = nodes.select("node", F.col("node").alias("label")), 0
    edges = written(edges.select("_a", "_b").distinct(), "clusters")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
        order = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("hash"), F.col(c).alias("to"))
        least = both.groupBy("_a").agg(F.least(F.min(order("_b")), F.min(order("_a")))["to"].alias("to"))
        least = written(least.withColumnRenamed("_a", "from"), "clusters")
        moved = edges.join(least, F.col("_a") == F.col("from")).select(F.col("to").alias("_a"), "_b")
        moved = moved.join(least, F.col("_b") == F.col("from")).select("_a", F.col("to").alias("_b"))
        edges = written(moved.where("_a <> _b").distinct(), "clusters")
        labels = labels.join(least, F.col("label") == F.col("from"), "left")
        labels = written(labels.select("node", F.coalesce("to", "label").alias("label")), "clusters")
        turn += 1
    return labels


def density_clusters(
    rows: DataFrame, columns: list[str], ts: str, tie: str, radius: float = RADIUS, min_size: int = MIN_CLUSTER
) -> DataFrame:
    """Rows with their density cluster, -1 for noise, for up to three numeric columns.

    A core point has at least `min_size` points within `radius`, itself included, and clusters are the core
    points that chains of such steps connect, with the points within the radius of one. Clusters are
    numbered by their first core point in the order of (ts, tie), and a point at the edge of several
    belongs to the first of them. Rows with a null or non-finite value are noise, and so are values beyond
    2^52 cells from zero. Distances are compared as sums of squares in doubles.

    The rows are written once. No pair of points within a cell is formed; a cell of any size is joined
    in parts (`salted_join`).
    """
    if not 1 <= len(columns) <= MOST_COLUMNS:
        raise ValueError(f"density clusters are for one to {MOST_COLUMNS} columns")
    grid = Grid(columns, radius)
    placed = rows.withColumns({x: F.col(f"`{c}`").cast("double") for x, c in zip(grid.at, columns)})
    placed = cut_lineage(placed.withColumn("_row", F.monotonically_increasing_id()))
    usable = reduce(Column.__and__, [F.coalesce(F.abs(F.col(x)) < grid.side * 2.0**52, F.lit(False)) for x in grid.at])
    points = placed.where(usable).withColumns(grid.cells())
    codes = [f"_f{k}" for k in range(len(columns))]
    boxes = points.withColumns(grid.codes(FINE, codes)).groupBy(*grid.cell, *codes)
    boxes = written(boxes.agg(*grid.extent(), F.count(F.lit(1)).alias("n")), "clusters")
    sizes = written(boxes.groupBy(*grid.cell).agg(F.sum("n").alias("_n")), "clusters")
    counts = sizes.select(*grid.cell, F.col("_n").alias("_rows"))
    dense = sizes.where(F.col("_n") >= min_size).select(*grid.cell)

    sized = salted_join(points.select("_row", *grid.at, *grid.cell), sizes, grid.cell, "inner", ["_row"], counts)
    loose = written(sized.where(F.col("_n") < min_size).drop("_n"), "clusters")
    probes = grid.as_boxes(loose, "_row", *grid.cell).select("_row", *grid.low, *grid.high, grid.around(grid.steps))
    near = written(_neighbours(grid, probes, points.select("_row", *grid.at, *grid.cell), boxes), "clusters")
    enough = near.groupBy("_row").agg(F.sum("n").alias("n")).where(F.col("n") >= min_size).select("_row")
    lone = written(loose.join(enough, "_row"), "clusters")

    in_dense = points.join(dense, grid.cell, "left_semi")
    core_points = in_dense.select(*grid.cell, *grid.at).unionByName(lone.select(*grid.cell, *grid.at))
    core = written(core_points.groupBy(*grid.cell).agg(*grid.extent()), "clusters")
    nodes = core.select(F.struct(*grid.cell).alias("node"))
    labels = contracted(nodes, _linked(grid, core, core_points))

    place = F.struct(F.col(f"`{ts}`").alias("ts"), F.col(f"`{tie}`").alias("tie"))
    lone_rows = placed.join(lone.select("_row", *grid.cell), "_row").select(*grid.cell, ts, tie)
    first = in_dense.select(*grid.cell, ts, tie).unionByName(lone_rows).groupBy(F.struct(*grid.cell).alias("node")).agg(F.min(place).alias("first"))
    first = labels.join(first, "node").groupBy("label").agg(F.min("first").alias("first"))
    numbered = running_number(cut_lineage(first.select("label", "first.ts", "first.tie")), [], ["ts", "tie"], "nth")
    of_cell = labels.join(numbered, "label").select("node.*", (F.col("nth") - 1).alias("_label"))
    of_cell = written(of_cell, "clusters")

    # a loose point is core, or at the edge of a dense cell or of a loose core point, or noise
    edge = probes.join(lone.select("_row"), "_row", "left_anti")
    by_dense = near.join(edge.select("_row", *grid.cell), ["_row", *grid.cell], "left_semi").join(dense, grid.cell, "left_semi")
    others = grid.as_boxes(lone, *grid.cell)
    by_lone = edge.alias("p").join(others.alias("b"), [F.col(f"p.{c}") == F.col(f"b.{c}") for c in grid.cell])
    by_lone = by_lone.where(grid.nearest("p", "b") <= grid.square).select("p._row", *[f"p.{c}" for c in grid.cell])
    held = by_dense.select("_row", *grid.cell).unionByName(by_lone).unionByName(lone.select("_row", *grid.cell))
    of_row = held.join(of_cell, grid.cell).groupBy("_row").agg(F.min("_label").alias("_own"))

    whole = salted_join(points, dense.join(of_cell, grid.cell), grid.cell, "left", ["_row"], counts).drop(*grid.cell)
    whole = whole.join(of_row, "_row", "left").withColumn("cluster", F.coalesce("_label", "_own", F.lit(-1).cast("bigint")))
    noise = placed.where(~usable).withColumn("cluster", F.lit(-1).cast("bigint"))
    return whole.select(*rows.columns, "cluster").unionByName(noise.select(*rows.columns, "cluster"))
