"""Geometry as Column expressions, on plain latitude and longitude doubles.

Contract: spherical distances (haversine) on one radius; polygon edges are
straight in the longitude/latitude plane.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in metres.
EARTH_RADIUS_M = 6_371_010.0


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Metres between two points; NULL if any coordinate is NULL."""
    points = [F.col(c) if isinstance(c, str) else c for c in (lat1, lon1, lat2, lon2)]
    known = points[0].isNotNull()
    for c in points[1:]:
        known = known & c.isNotNull()
    lat1, lon1, lat2, lon2 = (F.radians(c) for c in points)
    # LEAST skips NULLs, hence the explicit test.
    return F.when(known, _arc_m(lat2 - lat1, lon2 - lon1, F.cos(lat1) * F.cos(lat2)))


def _arc_m(dlat: Column, dlon: Column, cos_product: Column) -> Column:
    # pow, not a product: each sine is then computed once, also inside a filter.
    h = F.pow(F.sin(dlat / 2), F.lit(2.0)) + cos_product * F.pow(F.sin(dlon / 2), F.lit(2.0))
    return F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * (2 * EARTH_RADIUS_M)


def box_gap_m(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """A lower bound in metres between any point of box a and any of box b.

    Boxes are dicts of Columns ``lat0, lat1, lon0, lon1``. The shortest
    longitude gap is taken either way around the globe.
    """
    zero = F.lit(0.0)
    dlat = F.greatest(zero, b["lat0"] - a["lat1"], a["lat0"] - b["lat1"])
    east = F.greatest(zero, b["lon0"] - a["lon1"], a["lon0"] - b["lon1"])
    west = F.greatest(
        zero, 360 - (F.greatest(a["lon1"], b["lon1"]) - F.least(a["lon0"], b["lon0"]))
    )
    dlon = F.least(east, west)
    farthest = F.greatest(*(F.abs(box[k]) for box in (a, b) for k in ("lat0", "lat1")))
    cos = F.cos(F.radians(farthest))
    return _arc_m(F.radians(dlat), F.radians(dlon), cos * cos) * (1 - 1e-9)


# --- grid -------------------------------------------------------------------


@dataclass(frozen=True)
class Grid:
    """Cells so small that two points of one cell are always within ``eps_m``.

    Rows are ``eps / sqrt(2)`` high. Each row has a whole number of columns, so
    columns wrap around the globe, and none is wider than the row is high.
    """

    eps_m: float

    @property
    def row_deg(self) -> float:
        # A hair under eps/sqrt(2), so rounding cannot break the promise above.
        return math.degrees(self.eps_m * (1 - 1e-9) / math.sqrt(2.0) / EARTH_RADIUS_M)

    @property
    def reach_deg(self) -> float:
        return math.degrees(self.eps_m * (1 + 1e-9) / EARTH_RADIUS_M)

    def row(self, lat: Column) -> Column:
        return F.floor((lat + 90.0) / self.row_deg).cast("bigint")

    def columns_in(self, row: Column) -> Column:
        """Number of columns of a row, set by its edge nearest to the equator."""
        low = F.abs(row * F.lit(self.row_deg) - 90.0)
        high = F.abs((row + 1) * F.lit(self.row_deg) - 90.0)
        straddles = (row * F.lit(self.row_deg) - 90.0 <= 0) & ((row + 1) * F.lit(self.row_deg) - 90.0 >= 0)
        nearest = F.when(straddles, F.lit(0.0)).otherwise(F.least(low, high))
        return F.greatest(
            F.lit(1), F.ceil(F.cos(F.radians(nearest)) * (360.0 / self.row_deg))
        ).cast("bigint")

    def col(self, lon: Column, row: Column) -> Column:
        n = self.columns_in(row)
        return F.pmod(F.floor((lon + 180.0) / 360.0 * n).cast("bigint"), n)

    def cell(self, lat: Column, lon: Column) -> Column:
        """Row and column packed in one bigint (exact for eps above 2 cm)."""
        row = self.row(lat)
        return self.pack(row, self.col(lon, row))

    @staticmethod
    def pack(row: Column, col: Column) -> Column:
        return row * F.lit(1 << 32) + col

    def reachable(self, lat0: Column, lat1: Column, lon0: Column, lon1: Column) -> Column:
        """Array of cells that may hold a point within eps of the given box."""
        # Widest at the latitude farthest from the equator; everything at a pole.
        far = F.least(F.greatest(F.abs(lat0), F.abs(lat1)) + 2 * self.reach_deg, F.lit(90.0))
        cos = F.cos(F.radians(far))
        reach = F.when(cos * 180.0 > self.reach_deg * 1.0001, F.lit(self.reach_deg * 1.0001) / cos).otherwise(180.0)

        def cells_of_row(row: Column) -> Column:
            n = self.columns_in(row)
            first = F.floor((lon0 - reach + 180.0) / 360.0 * n).cast("bigint")
            last = F.floor((lon1 + reach + 180.0) / 360.0 * n).cast("bigint")
            last = F.least(last, first + n - 1)
            return F.transform(F.sequence(first, last), lambda c: self.pack(row, F.pmod(c, n)))

        rows = F.sequence(self.row(lat0 - self.reach_deg), self.row(lat1 + self.reach_deg))
        return F.flatten(F.transform(rows, cells_of_row))


# --- polygons ---------------------------------------------------------------

def with_wkt_edges(df: DataFrame, wkt: str, name: str = "edges") -> DataFrame:
    """Add the edges of a POLYGON or MULTIPOLYGON text; NULL if the text is malformed or leaves the globe.

    Works on arrays and character classes only, never on a repeated regex
    group, so that outlines of a million vertices parse without deep recursion.
    """
    # The shape without numbers: every ring becomes '#', lists shrink to one.
    shape = F.regexp_replace(F.regexp_replace("_text", r"\([^()]*\)", "#"), " ", "")
    shape = F.regexp_replace(shape, r"#,(?=#)", "")
    shape = F.regexp_replace(F.regexp_replace(shape, r"\(#\)", "@"), r"@,(?=@)", "")

    def point(pair: Column) -> Column:
        xy = F.split(F.trim(pair), " ")
        x, y = (F.get(xy, F.lit(i)).try_cast("double") for i in (0, 1))
        # Not a number counts as larger than any, so it is out of range too.
        on_earth = x.between(-180.0, 180.0) & y.between(-90.0, 90.0)
        return F.when((F.size(xy) == 2) & on_earth, F.struct(x.alias("x"), y.alias("y")))

    def bad_ring(ring: Column) -> Column:
        return (
            (F.size(ring) < 4)
            | F.exists(ring, lambda p: p.isNull() | p["x"].isNull() | p["y"].isNull())
            | (F.get(ring, F.lit(0)) != F.element_at(ring, -1))
        )

    def ring_edges(ring: Column) -> Column:
        def edge(p: Column, q: Column) -> Column:
            return F.struct(
                p["x"].alias("x0"), p["y"].alias("y0"), q["x"].alias("x1"), q["y"].alias("y1")
            )

        n = F.size(ring) - 1
        return F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), edge)

    rings = F.transform(
        F.regexp_extract_all("_text", F.lit(r"\(([^()]*)\)"), F.lit(1)),
        lambda ring: F.transform(F.split(ring, ","), point),
    )
    well_formed = F.col("_shape").isin("POLYGON@", "MULTIPOLYGON(@)")
    return (
        df.withColumn("_text", F.upper(F.regexp_replace(wkt, r"\s+", " ")))
        .withColumn("_shape", shape)
        .withColumn("_rings", F.when(well_formed, rings))
        .withColumn("_sound", ~F.exists("_rings", bad_ring))
        .withColumn(name, F.when(F.col("_sound"), F.flatten(F.transform("_rings", ring_edges))))
        .drop("_text", "_shape", "_rings", "_sound")
    )


def inside_cell(edges, odd, east, lon: Column, lat: Column) -> Column:
    """Even-odd test of a point in a cell whose ``edges`` are listed: the ray towards larger x crosses an odd number of edges.

    ``odd`` counts the edges that cross the line of the cell's ``east`` side above
    the cell. A listed edge that crosses that line at the cell's height (``here``)
    adds to it if its end beyond the line lies above the point; other edges count
    up to the line only. Holes and several parts need no special care. An edge
    owns its lower end only, so a ray through a vertex counts once; points on an
    outline fall on one side of it by that rule.
    """
    edges, odd, east = (F.col(c) if isinstance(c, str) else c for c in (edges, odd, east))

    def flip(found: Column, e: Column) -> Column:
        spans = (e["y0"] > lat) != (e["y1"] > lat)
        # Never evaluated for a level edge, which spans nothing.
        x = (e["x1"] - e["x0"]) * (lat - e["y0"]) / F.nullif(e["y1"] - e["y0"], F.lit(0.0)) + e["x0"]
        crossed = spans & F.coalesce(lon < x, F.lit(False))
        beyond = F.when(e["x1"] > e["x0"], e["y1"]).otherwise(e["y0"]) > lat
        return found != F.when(e["here"], crossed != beyond).otherwise(crossed & F.coalesce(x <= east, F.lit(False)))

    return F.aggregate(edges, odd, flip)
