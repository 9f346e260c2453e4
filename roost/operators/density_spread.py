"""Density clustering of devices too large for one task, as Spark jobs.

Same definition and result as ``density.label_pack``. Positions collapse to
weighted sites, sites to grid cells; only sparse cells need neighbour counts,
and cells are linked by testing boxes that shrink until every question is
settled - never by emitting the pairs of a crowded cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roost.functions.geo import Grid, box_gap_m, haversine_m
from roost.operators.components import connected
from roost.operators.skew import CHUNK_ROWS, range_chunks, spread_join
from roost.sources.stage import discard, stage

DEVICE = "device_id"
LAT, LON = "median_latitude", "median_longitude"
CELL = [DEVICE, "cell"]
SITE = [DEVICE, LAT, LON]

# At 2^-30 of a cell a box is far below the resolution of doubles in degrees;
# what is still open then is decided site by site.
LAST_LEVEL = 30

# Links of cells (a device, two cells) whose components one task may find.
FINISH_LINKS = 500_000


def spread_labels(
    stops: DataFrame, eps_m: float, min_points: int, rows_per_chunk: int = CHUNK_ROWS
) -> DataFrame:
    """Add ``raw_cluster_label``; stops need a device and a position."""
    stops = stage(stops, "crowded-stops")
    sites, pieces = sites_and_cells(stops, eps_m, rows_per_chunk)
    near = stage(sparse_neighbours(sites, pieces, eps_m, min_points), "sparse-neighbours")
    core = stage(core_sites(sites, pieces, near, min_points), "core-sites")
    edges = linked_cells(core, eps_m)
    roots = connected_cells(core.select(*CELL).distinct(), edges)

    core = stage(
        spread_join(core, roots, CELL, [LAT, LON], rows_per_chunk=rows_per_chunk, staged=True), "rooted"
    )
    earliest = core.groupBy(DEVICE, "root").agg(F.min("first").alias("earliest"))
    beside = near.join(core.select(*SITE), SITE, "left_anti").join(
        core.select(DEVICE, F.col(LAT).alias("near_lat"), F.col(LON).alias("near_lon"), "root"),
        [DEVICE, "near_lat", "near_lon"],
    )
    choices = beside.select(*SITE, "root").distinct()
    border = (
        spread_join(choices, earliest, [DEVICE, "root"], [LAT, LON], rows_per_chunk=rows_per_chunk)
        .groupBy(*SITE)
        .agg(F.min(F.struct("earliest", "root")).alias("pick"))
        .select(*SITE, F.col("pick.root").alias("root"))
    )
    labels = core.select(*SITE, "root").unionByName(border)
    return spread_join(
        stops, labels, SITE, ["start_timestamp", "stop_events"], "left", rows_per_chunk, staged=True
    ).select(*stops.columns, F.coalesce("root", F.lit(-1)).cast("bigint").alias("raw_cluster_label"))


def sites_and_cells(
    stops: DataFrame, eps_m: float, rows_per_chunk: int = CHUNK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Weighted sites in even chunks, and for each cell and chunk the cell's total weight."""
    cell = Grid(eps_m).cell(F.col(LAT), F.col(LON))
    sites = (
        stops.groupBy(*SITE)
        .agg(
            F.count("*").alias("weight"),
            # The site's place is its last resort against ties, as in the numpy plan.
            F.min(F.struct("start_timestamp", "stop_events", LAT, LON)).alias("first"),
        )
        .withColumn("cell", cell)
    )
    sites = range_chunks(sites, CELL + [LAT, LON], rows_per_chunk)
    parts = sites.groupBy(*CELL, "chunk").agg(F.sum("weight").alias("part"))
    total = parts.groupBy(*CELL).agg(F.sum("part").alias("in_cell"))
    return sites, stage(parts.join(total, CELL).drop("part"), "cells")


def sparse_neighbours(sites: DataFrame, pieces: DataFrame, eps_m: float, min_points: int) -> DataFrame:
    """For each site of a sparse cell, the sites within eps (itself included).

    A sparse cell has fewer than ``min_points`` sites and at most two dozen
    neighbour cells, so the rows grow linearly with the sites.
    """
    key = CELL + ["chunk"]
    sparse = sites.join(pieces.where(F.col("in_cell") < min_points), key).select(*SITE)
    probes = sparse.select(
        *SITE,
        F.explode(Grid(eps_m).reachable(F.col(LAT), F.col(LAT), F.col(LON), F.col(LON))).alias("cell"),
    )
    targets = sites.select(
        *key, F.col(LAT).alias("near_lat"), F.col(LON).alias("near_lon"), F.col("weight").alias("near_weight")
    )
    return (
        probes.join(pieces.select(*key), CELL)
        .join(targets, key)
        .where(haversine_m(LAT, LON, "near_lat", "near_lon") <= F.lit(eps_m))
        .select(*SITE, "near_lat", "near_lon", "near_weight")
    )


def core_sites(sites: DataFrame, pieces: DataFrame, near: DataFrame, min_points: int) -> DataFrame:
    """Sites with at least ``min_points`` stops within eps."""
    by_count = near.groupBy(*SITE).agg(F.sum("near_weight").alias("n")).where(F.col("n") >= min_points)
    placed = sites.join(pieces, CELL + ["chunk"])
    columns = SITE + ["cell", "weight", "first"]
    dense = placed.where(F.col("in_cell") >= min_points).select(*columns)
    return dense.unionByName(
        placed.where(F.col("in_cell") < min_points).join(by_count, SITE, "left_semi").select(*columns)
    )


def linked_cells(core: DataFrame, eps_m: float) -> DataFrame:
    """Pairs of cells (``u`` < ``v``) that have core sites within eps of each other.

    Every candidate pair is judged by boxes around the cells' sites: linked if
    one site of each box is near enough, dropped if the boxes are too far
    apart, else both boxes are quartered and the parts judged.
    """
    grid = Grid(eps_m)
    row = F.floor(F.col("cell") / F.lit(1 << 32))
    inside_row = (F.col(LAT) + 90.0) / grid.row_deg - row
    column = (F.col(LON) + 180.0) / 360.0 * grid.columns_in(row)
    sites = stage(
        core.select(*SITE, "cell", inside_row.alias("fy"), (column - F.floor(column)).alias("fx")), "box-sites"
    )

    box = boxes(sites, 0)
    reach = grid.reachable(F.col("lat0"), F.col("lat1"), F.col("lon0"), F.col("lon1"))
    pairs = (
        box.select(DEVICE, F.col("cell").alias("u"), F.explode(reach).alias("v"))
        .where("u < v")
        .join(box.select(DEVICE, F.col("cell").alias("v")), [DEVICE, "v"])
    )
    zero = F.lit(0).cast("bigint")
    pending = pairs.select(
        DEVICE, "u", "v", *[zero.alias(c) for c in ("uy", "ux", "vy", "vx")]
    )
    found = []
    for level in range(LAST_LEVEL + 1):
        last = level == LAST_LEVEL
        if level:
            # Few cells are still in question: the boxes of the others need not be made.
            ends = pending.select(DEVICE, F.col("u").alias("cell")).unionByName(pending.select(DEVICE, F.col("v").alias("cell")))
            fewer = stage(sites.join(ends.distinct(), CELL, "left_semi"), "box-sites")
            discard(sites)
            sites = fewer
        judged = stage(judge(pending, boxes(sites, level, by_site=last), eps_m), "judged")
        links = judged.where("linked").select(DEVICE, "u", "v").distinct()
        found.append(links)
        pending = judged.where("NOT linked").drop("linked").join(links, [DEVICE, "u", "v"], "left_anti")
        if last or pending.isEmpty():
            break
    out = found[0]
    for links in found[1:]:
        out = out.unionByName(links)
    return stage(out, "links")


def boxes(sites: DataFrame, level: int, by_site: bool = False) -> DataFrame:
    """Bounding boxes of the sites at 2^-level of a cell, with one site as witness."""
    parts = 1 << level
    y = F.floor(F.col("fy") * parts).cast("bigint").alias("y")
    x = F.floor(F.col("fx") * parts).cast("bigint").alias("x")
    return (
        sites.groupBy(*CELL, y, x, *([LAT, LON] if by_site else []))
        .agg(
            F.min(LAT).alias("lat0"),
            F.max(LAT).alias("lat1"),
            F.min(LON).alias("lon0"),
            F.max(LON).alias("lon1"),
            F.min(F.struct(F.col(LAT).alias("lat"), F.col(LON).alias("lon"))).alias("site"),
        )
        .withColumn("up_y", F.floor(F.col("y") / 2))
        .withColumn("up_x", F.floor(F.col("x") / 2))
    )


def judge(pending: DataFrame, box: DataFrame, eps_m: float) -> DataFrame:
    """Replace each pending pair of boxes by the open or linked pairs of their parts."""

    def side(name: str) -> DataFrame:
        return box.select(
            DEVICE,
            F.col("cell").alias(name),
            F.col("up_y").alias(f"{name}y"),
            F.col("up_x").alias(f"{name}x"),
            F.struct("y", "x", "lat0", "lat1", "lon0", "lon1", "site").alias(f"{name}_box"),
        )

    both = pending.join(side("u"), [DEVICE, "u", "uy", "ux"]).join(side("v"), [DEVICE, "v", "vy", "vx"])
    u, v = F.col("u_box"), F.col("v_box")
    linked = haversine_m(u["site"]["lat"], u["site"]["lon"], v["site"]["lat"], v["site"]["lon"]) <= F.lit(eps_m)
    corners = ("lat0", "lat1", "lon0", "lon1")
    apart = box_gap_m({k: u[k] for k in corners}, {k: v[k] for k in corners}) > F.lit(eps_m)
    return both.where(linked | ~apart).select(
        DEVICE, "u", "v",
        u["y"].alias("uy"), u["x"].alias("ux"), v["y"].alias("vy"), v["x"].alias("vx"),
        linked.alias("linked"),
    )


def connected_cells(cells: DataFrame, links: DataFrame) -> DataFrame:
    """``root``: the smallest cell of each connected component; a cell without links is its own."""
    roots = connected(links, [DEVICE], finish_edges=FINISH_LINKS)
    return cells.join(roots.withColumnRenamed("node", "cell"), CELL, "left").select(
        *CELL, F.coalesce("root", "cell").alias("root")
    )
