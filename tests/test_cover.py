"""The cell cover of polygons against counting all edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roost.operators import cover


def ring(rng, x, y, radius, vertices, digits):
    """A star-shaped outline with teeth; few digits put vertices and edges on round numbers."""
    angle = np.linspace(0, 2 * np.pi, vertices, endpoint=False)
    far = radius * rng.uniform(0.4, 1.0, vertices)
    points = [(round(x + r * np.cos(a), digits), round(y + r * np.sin(a), digits)) for r, a in zip(far, angle, strict=True)]
    return [*points, points[0]]


def text_of(*rings):
    return "POLYGON (" + ", ".join("(" + ", ".join(f"{x} {y}" for x, y in r) + ")" for r in rings) + ")"


def plain_inside(rings, x, y):
    odd = False
    for r in rings:
        for (x0, y0), (x1, y1) in zip(r, r[1:], strict=False):
            if (y0 > y) != (y1 > y) and x < (x1 - x0) * (y - y0) / (y1 - y0) + x0:
                odd = not odd
    return odd


@pytest.mark.parametrize("limit", [cover.MAX_BROADCAST_EDGES, 0])
def test_cover_equals_counting_edges(spark, limit):
    rng = np.random.default_rng(11)
    shapes = {
        "coarse": [ring(rng, 0, 0, 6, 9, 0)],
        "fine": [ring(rng, 1.5, 0.5, 2, 4000, 7)],
        "holed": [ring(rng, -2, -2, 5, 300, 1), ring(rng, -2, -2, 1, 500, 3)],
        "box": [[(-3, -3), (4, -3), (4, 4), (-3, 4), (-3, -3)]],
        "edge of the globe": [[(175, 80), (180, 80), (180, 90), (175, 90), (175, 80)]],
    }
    points = [(float(x), float(y)) for x in range(-7, 8) for y in range(-7, 8)]
    points += [tuple(p) for p in rng.uniform(-7, 7, (1500, 2)).tolist()]
    points += [tuple(p) for p in rng.uniform(-1, 3, (1500, 2)).round(2).tolist()]
    points += [p for rings in shapes.values() for r in rings for p in r[:300]]
    points += [(179.5, 85.0), (180.0, 85.0), (175.0, 80.0), (178.0, 90.0), (181.0, 85.0)]
    lookup = spark.createDataFrame([("XX", z, text_of(*r)) for z, r in shapes.items()], "country_code string, tz string, geometry string")
    odd = [(None, 1.0), (1.0, None), (float("nan"), 1.0), (1e300, 0.0)]
    frame = spark.createDataFrame([(i, *map(lambda v: None if v is None else float(v), p)) for i, p in enumerate(points + odd)], "i int, x double, y double")
    found = cover.zones_at(frame, "y", "x", lookup, F.xxhash64("i"), limit)
    assert found.columns == ["i", "x", "y", "zones"]
    got = {r["i"]: sorted(r["zones"]) for r in found.collect()}
    want = {i: sorted(z for z, rings in shapes.items() if plain_inside(rings, x, y)) for i, (x, y) in enumerate(points)}
    want[len(points) - 1] = []
    assert {i: got[i] for i in want} == want
    assert all(got[len(points) + k] == [] for k in range(len(odd)))


def test_cells_inside_hold_no_edges(spark):
    angle = np.linspace(0, 2 * np.pi, 5000, endpoint=False)
    circle = [(round(3 * np.cos(a), 6), round(3 * np.sin(a), 6)) for a in angle]
    lookup = spark.createDataFrame([("XX", "UTC", text_of([*circle, circle[0]]))], "country_code string, tz string, geometry string")
    whole, fine = cover.polygon_cover(lookup)
    parts = whole.select(F.explode("parts").alias("p")).unionByName(fine.select(F.explode("parts").alias("p")))
    empty = parts.where("p.edges IS NULL").count()
    held = parts.where("p.edges IS NOT NULL").agg(F.count("*"), F.max(F.size("p.edges"))).first()
    assert empty > 1000 and held[0] > 500 and held[1] < 60
    assert parts.where("p.edges IS NULL AND NOT p.odd").isEmpty()
