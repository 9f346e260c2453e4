"""Cell cover of polygons: which polygons a position lies in, by equi-joins on grid cells.

The globe is cut into cells of one degree. A cell that an outline crosses keeps
the few edges in it; one with many edges is halved both ways until they are few.
A cell that no edge crosses is inside as a whole or not listed at all.

A position is inside if the ray from it towards larger longitude crosses an odd
number of edges. A cell needs only its own edges for that, and one bit for all
others. Edges that cross the line of its east side above the cell count once
each in that bit; so it follows from the cells above by a running sum over a
column. In a halved cell the sum starts with the answer for the point where the
column's east side leaves the cell at the top.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roost.functions.geo import inside_cell, with_wkt_edges
from roost.sources.stage import stage

CELL_DEG = 1.0
# Odd origins: no outline of round numbers runs along a cell's side.
WEST, SOUTH = -180.0123456789, -90.0123456789
COLUMNS = 362

# Cells with more edges are halved, at most so many times.
EDGES_PER_CELL = 16
MAX_DEPTH = 6

# Rows towards both ends by which an edge is listed beyond its computed height.
MARGIN_DEG = 1e-9

# Listed zones and edges that may be broadcast (about 50 bytes each).
MAX_BROADCAST_EDGES = 2_000_000

# Least number of copies of each cell when there are too many to broadcast.
CELL_COPIES = 32

CELL = ["col", "row"]
FINE = ["col", "row", "fine_col", "fine_row"]


def place_of(value: Column, origin: Column, size: Column) -> Column:
    return F.floor((value - origin) / size)


def crossed_cells(edges: DataFrame, n: Column, col: str, row: str) -> DataFrame:
    """The cells, ``n`` a side, that each edge ``e`` crosses, in a grid given by ``west``, ``south`` and ``size``.

    ``here``: the edge crosses the line of the cell's east side at the cell's height.
    """
    west, south, size = F.col("west"), F.col("south"), F.col("size")
    x0, y0, x1, y1 = (F.col(f"e.{c}") for c in ("x0", "y0", "x1", "y1"))
    at = F.col(col)

    def height(x: Column, level: Column) -> Column:
        # A vertical edge has both its ends in the column.
        y = y0 + (x - x0) * (y1 - y0) / F.nullif(x1 - x0, F.lit(0.0))
        return F.least(F.greatest(F.coalesce(y, level), F.least(y0, y1)), F.greatest(y0, y1))

    columns = (
        edges.withColumn("_first", place_of(F.least(x0, x1), west, size))
        .withColumn("_last", place_of(F.greatest(x0, x1), west, size))
        .withColumn("_from", F.greatest("_first", F.lit(0)))
        .withColumn("_to", F.least(F.col("_last"), n - 1))
        .where("_from <= _to")
        .withColumn(col, F.explode(F.sequence("_from", "_to")))
        .withColumn("_left", height(F.greatest(F.least(x0, x1), west + at * size), y0))
        .withColumn("_right", height(F.least(F.greatest(x0, x1), west + (at + 1) * size), y1))
    )
    lowest = place_of(F.least("_left", "_right") - MARGIN_DEG, south, size)
    highest = place_of(F.greatest("_left", "_right") + MARGIN_DEG, south, size)
    crossing = F.when(at < F.col("_last"), place_of(F.col("_right"), south, size))
    return (
        columns.withColumn("_crossing", crossing)
        .withColumn("_low", F.greatest(lowest, F.lit(0)))
        .withColumn("_high", F.least(highest, n - 1))
        .where("_low <= _high")
        .withColumn(row, F.explode(F.sequence("_low", "_high")))
        .withColumn("here", F.coalesce(F.col("_crossing") == F.col(row), F.lit(False)))
        .drop("_first", "_last", "_from", "_to", "_left", "_right", "_crossing", "_low", "_high")
    )


def edge_lists() -> list[Column]:
    return [
        F.collect_list(F.struct("e.x0", "e.y0", "e.x1", "e.y1", "here")).alias("edges"),
        F.sum(F.col("here").cast("int")).alias("crossings"),
    ]


def with_inside(listed: DataFrame, column: list[str], row: str) -> DataFrame:
    """(column..., row, odd, edges): listed cells with their bit, and the empty cells between them that lie inside.

    A row without ``edges`` is the top of a column: its ``crossings`` count for all below.
    """
    downwards = Window.partitionBy(*column).orderBy(F.desc(row))
    above = F.coalesce(F.sum("crossings").over(downwards.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = (
        listed.withColumn("above", above)
        .withColumn("next", F.coalesce(F.lead(row).over(downwards), F.lit(-1)))
        .withColumn("odd", F.col("above") % 2 == 1)
        .withColumn("odd_below", (F.col("above") + F.col("crossings")) % 2 == 1)
    )
    crossed = rows.where("edges IS NOT NULL").select(*column, row, "odd", "edges")
    empty = rows.where(F.col("odd_below") & (F.col("next") < F.col(row) - 1)).select(
        *column, F.explode(F.sequence(F.col("next") + 1, F.col(row) - 1)).alias(row), F.lit(True).alias("odd")
    )
    return crossed.unionByName(empty, allowMissingColumns=True)


def parts_of(cells: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """One row per cell: ``parts`` lists what its polygons have there, with the box ``low``, ``high``, ``right`` of the edges.

    Off the box no edge is crossed. There is none if an edge is ``here``, which counts off its box too.
    """
    plain = ~F.exists("edges", lambda e: e["here"])

    def bound(most, of, axis: str) -> Column:
        return F.when(plain, most(F.transform("edges", lambda e: of(e[f"{axis}0"], e[f"{axis}1"]))))

    box = {
        "low": bound(F.array_min, F.least, "y"),
        "high": bound(F.array_max, F.greatest, "y"),
        "right": bound(F.array_max, F.greatest, "x") + MARGIN_DEG,
    }
    part = F.struct("timezone", "odd", "east", "edges", *box)
    return cells.withColumns(box).groupBy(*keys).agg(F.collect_list(part).alias("parts"), *more)


def polygon_cover(lookup: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(whole cells: col, row, depth, parts; parts of halved cells: col, row, fine_col, fine_row, parts); staged.

    ``depth`` tells how often the cell is halved for polygons with many edges
    there; the second table is None if no cell is. Malformed or missing geometry covers nothing; equal rows of
    ``lookup`` are polygons of their own.
    """
    outlines = with_wkt_edges(lookup.withColumnRenamed("tz", "timezone"), "geometry").where("edges IS NOT NULL")
    # The numbers are written, so they stay when a task is run again.
    parsed = stage(outlines.select(F.monotonically_increasing_id().alias("polygon"), "timezone", "edges"), "outlines")
    polygon = ["polygon", "timezone"]
    grid = {"west": F.lit(WEST), "south": F.lit(SOUTH), "size": F.lit(CELL_DEG)}
    edges = parsed.select(*polygon, F.explode("edges").alias("e")).withColumns(grid)
    listed = crossed_cells(edges, F.lit(COLUMNS), *CELL).groupBy(*polygon, *CELL).agg(*edge_lists())
    cells = with_inside(listed, [*polygon, "col"], "row")
    halvings = F.ceil(F.log2(F.size("edges") / EDGES_PER_CELL))
    depth = F.when(F.size("edges") > EDGES_PER_CELL, F.least(halvings, F.lit(MAX_DEPTH))).otherwise(0).cast("int")
    cells = stage(cells.withColumns({"east": F.lit(WEST) + (F.col("col") + 1) * CELL_DEG, "depth": depth}), "cover-cells")
    whole = parts_of(cells.withColumn("timezone", F.expr("IF(depth = 0, timezone, NULL)")), CELL, F.max("depth").alias("depth"))
    # A polygon that is halved here has its parts in the other table.
    whole = whole.withColumn("parts", F.filter("parts", lambda p: p["timezone"].isNotNull()))
    whole = stage(whole, "cover-whole")
    if whole.where("depth > 0").isEmpty():
        return whole, None

    depths = whole.where("depth > 0").select(*CELL, F.col("depth").alias("deep"))
    halved = cells.where("depth > 0").join(depths, CELL).select(
        *polygon, *CELL, "odd", F.col("east").alias("cell_east"), "edges",
        F.expr("shiftleft(1L, deep)").alias("n"),
        (F.lit(WEST) + F.col("col") * CELL_DEG).alias("west"),
        (F.lit(SOUTH) + F.col("row") * CELL_DEG).alias("south"),
    )
    halved = stage(halved.withColumn("size", F.lit(CELL_DEG) / F.col("n")), "cover-halved")
    key = [*polygon, *CELL]
    grid = ["west", "south", "size", "n"]
    fine = crossed_cells(halved.select(*key, *grid, F.explode("edges").alias("e")), F.col("n"), "fine_col", "fine_row")
    fine = fine.groupBy(*key, "west", "size", "fine_col", "fine_row").agg(*edge_lists())
    side = F.col("west") + (F.col("fine_col") + 1) * F.col("size")
    # Of a cell's many edges only those at its top or its east side bear on its columns' tops.
    top = F.col("south") + CELL_DEG
    few = F.filter("edges", lambda e: e["here"] | ((e["y0"] > top) != (e["y1"] > top)))
    started = inside_cell("few", "odd", "cell_east", side, top)
    tops = halved.withColumn("few", few).drop("edges").withColumn("fine_col", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    tops = tops.select(
        *key, "west", "size", "fine_col", F.col("n").alias("fine_row"), started.cast("bigint").alias("crossings")
    )
    filled = with_inside(fine.unionByName(tops, allowMissingColumns=True), [*key, "west", "size", "fine_col"], "fine_row")
    return whole, stage(parts_of(filled.withColumn("east", side), FINE), "cover-fine")


def with_parts(points: DataFrame, cells: DataFrame, keys: list[str], turn: Column, max_broadcast_edges: int) -> DataFrame:
    """Left join on the cell: by broadcast if the counted cells allow, else with points spread over copies of them."""
    weight = cells.agg(F.sum(F.aggregate("parts", F.lit(1), lambda a, p: a + 1 + F.greatest(F.size(p["edges"]), F.lit(0))))).first()[0]
    if (weight or 0) <= max_broadcast_edges:
        return points.join(F.broadcast(cells), keys, "left")
    # A city's cell may hold most points.
    partitions = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(CELL_COPIES, partitions // 8)
    copies = cells.withColumn("_turn", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    spread = points.withColumn("_turn", F.pmod(turn, F.lit(n)).cast("int"))
    return spread.join(copies, [*keys, "_turn"], "left").drop("_turn")


def zones_at(
    points: DataFrame, lat: str, lon: str, lookup: DataFrame, turn: Column, max_broadcast_edges: int = MAX_BROADCAST_EDGES
) -> DataFrame:
    """Add ``zones``: the zone of every polygon that contains the position; no zones off the globe.

    ``turn`` spreads points of one cell if the cover is too large to broadcast.
    """
    whole, fine = polygon_cover(lookup)
    on_globe = F.col(lat).between(-90.0, 90.0) & F.col(lon).between(-180.0, 180.0)
    size = F.lit(CELL_DEG)
    placed = points.withColumn("col", F.when(on_globe, place_of(F.col(lon), F.lit(WEST), size))).withColumn(
        "row", F.when(on_globe, place_of(F.col(lat), F.lit(SOUTH), size))
    )
    found = with_parts(placed, whole, CELL, turn, max_broadcast_edges).withColumnRenamed("parts", "_whole")
    n = F.expr("shiftleft(1L, depth)")

    def inside(parts: str) -> Column:
        def contains(p: Column) -> Column:
            off = (F.col(lat) < p["low"]) | (F.col(lat) >= p["high"]) | (F.col(lon) > p["right"])
            tested = inside_cell(p["edges"], p["odd"], p["east"], F.col(lon), F.col(lat))
            return p["edges"].isNull() | F.when(off, p["odd"]).otherwise(tested)

        names = F.transform(F.filter(parts, contains), lambda p: p["timezone"])
        return F.coalesce(names, F.array().cast("array<string>"))

    if fine is None:
        return found.withColumn("zones", inside("_whole")).drop(*CELL, "depth", "_whole")

    def fine_place(value: Column, origin: float, cell: Column) -> Column:
        inside = F.floor((value - (F.lit(origin) + cell * CELL_DEG)) / (size / n))
        return F.when(F.col("depth") > 0, F.greatest(F.least(inside, n - 1), F.lit(0)))

    found = found.withColumn("fine_col", fine_place(F.col(lon), WEST, F.col("col"))).withColumn(
        "fine_row", fine_place(F.col(lat), SOUTH, F.col("row"))
    )
    found = with_parts(found, fine, FINE, turn, max_broadcast_edges)
    return found.withColumn("zones", F.concat(inside("_whole"), inside("parts"))).drop(*FINE, "depth", "_whole", "parts")
