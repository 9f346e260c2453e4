"""Density clustering of one pack of devices, vectorised over the pack.

A point is *core* if at least ``min_points`` points of its device, itself
included, lie within eps. Clusters are the connected components of core points
within eps of each other; another point within eps of a core point is a border
point of that cluster; the rest is noise. A border point near several clusters
joins the one with the earliest core stop.

Points share a grid cell only if they are within eps of each other, so a cell
needs no pair tests inside: a busy cell is core as a whole, and clustering is
a question about neighbouring cells.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd

from roost.functions.geo import EARTH_RADIUS_M, Grid

NOISE = -1

# Pairs of sites that are compared at once when two groups are judged.
TOUCH_PAIRS = 4096
PAIR_BLOCK = 2_000_000


def distance_m(lat1, lon1, lat2, lon2):
    p1, p2 = np.radians(lat1), np.radians(lat2)
    s1, s2 = np.sin((p2 - p1) / 2), np.sin((np.radians(lon2) - np.radians(lon1)) / 2)
    h = s1 * s1 + np.cos(p1) * np.cos(p2) * s2 * s2
    return 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(h, 1.0)))


def label_pack(pdf: pd.DataFrame, eps_m: float, min_points: int) -> np.ndarray:
    """Cluster number per stop, unique within its device; -1 for noise."""
    if pdf.empty:
        return np.empty(0, dtype=np.int64)
    device, _ = pd.factorize(pdf["device_id"])
    turn = np.empty(len(pdf), dtype=np.int64)
    lat = pdf["median_latitude"].to_numpy(float)
    lon = pdf["median_longitude"].to_numpy(float)
    # Equal starts and numbers are told apart by place: no result hangs on the order of rows.
    turn[np.lexsort((lon, lat, pdf["stop_events"], pdf["start_timestamp"]))] = np.arange(len(pdf))

    # Equal positions of a device collapse to one weighted site.
    order = np.lexsort((lon, lat, device))
    d, y, x = device[order], lat[order], lon[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (y[1:] != y[:-1]) | (x[1:] != x[:-1])
    at = np.flatnonzero(new)
    site_of = np.empty(len(d), dtype=np.int64)
    site_of[order] = np.cumsum(new) - 1
    sites = _Sites(
        d[at], y[at], x[at],
        np.diff(np.append(at, len(d))),
        np.minimum.reduceat(turn[order], at),
        Grid(eps_m),
    )
    return _cluster_sites(sites, eps_m, min_points)[site_of]


class _Sites:
    """Sites sorted by cell, with the slice of every cell."""

    def __init__(self, device, lat, lon, weight, first, grid: Grid):
        self.grid = grid
        row = self._row(lat)
        n_rows = int(180 / grid.row_deg) + 8
        self.strips, strip = np.unique(device.astype(np.int64) * n_rows + row + 4, return_inverse=True)
        key = (strip.astype(np.int64) << 32) + self._col(lon, row)
        self.by_cell = np.argsort(key, kind="stable")
        self.lat, self.lon, self.weight, self.first = (
            v[self.by_cell] for v in (lat, lon, weight, first)
        )
        self.cells, self.start, cell = np.unique(
            key[self.by_cell], return_index=True, return_inverse=True
        )
        self.cell = cell
        self.size = np.diff(np.append(self.start, len(cell)))

    def _row(self, lat):
        return np.floor((lat + 90.0) / self.grid.row_deg).astype(np.int64)

    def _columns_in(self, row):
        low = np.abs(row * self.grid.row_deg - 90.0)
        high = np.abs((row + 1) * self.grid.row_deg - 90.0)
        straddles = (row * self.grid.row_deg <= 90.0) & ((row + 1) * self.grid.row_deg >= 90.0)
        nearest = np.where(straddles, 0.0, np.minimum(low, high))
        n = np.ceil(np.cos(np.radians(nearest)) * (360.0 / self.grid.row_deg))
        return np.maximum(1, n).astype(np.int64)

    def _col(self, lon, row):
        n = self._columns_in(row)
        return np.mod(np.floor((lon + 180.0) / 360.0 * n).astype(np.int64), n)

    def neighbour_cells(self):
        """Pairs (cell, other cell) of one device that may hold points within eps."""
        reach = self.grid.reach_deg
        lat0, lat1 = np.minimum.reduceat(self.lat, self.start), np.maximum.reduceat(self.lat, self.start)
        lon0, lon1 = np.minimum.reduceat(self.lon, self.start), np.maximum.reduceat(self.lon, self.start)
        far = np.minimum(np.maximum(np.abs(lat0), np.abs(lat1)) + 2 * reach, 90.0)
        cos = np.cos(np.radians(far))
        wide = np.where(cos * 180.0 > reach * 1.0001, reach * 1.0001 / np.maximum(cos, 1e-12), 180.0)
        row = self._row(lat0)
        strip = self.strips[self.cells >> 32]
        me, other = [], []
        for step in range(-2, 3):
            n = self._columns_in(row + step)
            first = np.floor((lon0 - wide + 180.0) / 360.0 * n).astype(np.int64)
            last = np.floor((lon1 + wide + 180.0) / 360.0 * n).astype(np.int64)
            count = np.minimum(last - first + 1, n)
            i, k = _expand(count)
            col = np.mod(first[i] + k, n[i])
            s = np.searchsorted(self.strips, strip[i] + step)
            ok = (s < len(self.strips)) & (self.strips[np.minimum(s, len(self.strips) - 1)] == strip[i] + step)
            key = (s[ok] << 32) + col[ok]
            i = i[ok]
            c = np.minimum(np.searchsorted(self.cells, key), len(self.cells) - 1)
            hit = self.cells[c] == key
            me.append(i[hit])
            other.append(c[hit])
        me, other = np.concatenate(me), np.concatenate(other)
        keep = me != other
        return me[keep], other[keep]


def _expand(count):
    """Index of the owner and running number for ``count`` items per owner."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)


def _site_pairs(s: _Sites, a, b) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All (pair number, site of cell a, site of cell b), in blocks of bounded size."""
    size = s.size[a] * s.size[b]
    block = (np.cumsum(size) - 1) // PAIR_BLOCK
    for lo, hi in _runs(block):
        p, k = _expand(size[lo:hi])
        p = p + lo
        yield p, s.start[a[p]] + k // s.size[b[p]], s.start[b[p]] + k % s.size[b[p]]


def _runs(values) -> Iterator[tuple[int, int]]:
    if len(values):
        cuts = np.flatnonzero(np.diff(values)) + 1
        yield from zip(np.append(0, cuts), np.append(cuts, len(values)))


def _near(s: _Sites, i, j, eps_m: float):
    return distance_m(s.lat[i], s.lon[i], s.lat[j], s.lon[j]) <= eps_m


def _cluster_sites(s: _Sites, eps_m: float, min_points: int) -> np.ndarray:
    a, b = s.neighbour_cells()
    in_cell = np.add.reduceat(s.weight, s.start)
    sparse = in_cell < min_points

    # Neighbour counts are needed in sparse cells only; those have fewer than
    # min_points sites, so the pairs grow linearly with the points.
    count = in_cell[s.cell].astype(np.int64)
    found_i, found_j = [], []
    for _, i, j in _site_pairs(s, a[sparse[a]], b[sparse[a]]):
        near = _near(s, i, j, eps_m)
        i, j = i[near], j[near]
        count += np.bincount(i, weights=s.weight[j], minlength=len(count)).astype(np.int64)
        found_i.append(i)
        found_j.append(j)
    core = count >= min_points

    root = _join_cells(s, a, b, core, eps_m)
    label = np.where(core, root[s.cell], NOISE)

    if found_i and not core.all():
        i, j = np.concatenate(found_i), np.concatenate(found_j)
        # A border site may also share its cell with core sites.
        same_i, same_j = _same_cell_pairs(s, sparse, core)
        i, j = np.append(i, same_i), np.append(j, same_j)
        keep = ~core[i] & core[j]
        i, j = i[keep], j[keep]
        earliest = np.full(len(s.cells), np.iinfo(np.int64).max)
        np.minimum.at(earliest, label[core], s.first[core])
        best = np.full(len(label), np.iinfo(np.int64).max)
        np.minimum.at(best, i, earliest[label[j]])
        wins = best[i] == earliest[label[j]]
        label[i[wins]] = label[j[wins]]

    out = np.empty_like(label)
    out[s.by_cell] = label
    return out


def _same_cell_pairs(s: _Sites, sparse, core):
    cells = np.flatnonzero(sparse & (np.add.reduceat(core, s.start) > 0))
    parts = [(i, j) for _, i, j in _site_pairs(s, cells, cells)]
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _join_cells(s: _Sites, a, b, core, eps_m: float) -> np.ndarray:
    """The component of every cell, linking cells whose core sites come within eps."""
    has_core = np.add.reduceat(core, s.start) > 0
    keep = (a < b) & has_core[a] & has_core[b]
    a, b = a[keep], b[keep]
    size = s.size[a] * s.size[b]
    small = size <= PAIR_BLOCK // 100
    linked = np.zeros(len(a), dtype=bool)
    which = np.flatnonzero(small)
    for p, i, j in _site_pairs(s, a[small], b[small]):
        hit = core[i] & core[j]
        hit[hit] = _near(s, i[hit], j[hit], eps_m)
        linked[which[p[hit]]] = True
    root = _components(len(s.cells), a[linked], b[linked])
    for p in np.flatnonzero(~small):
        if root[a[p]] != root[b[p]] and _touch(s, core, a[p], b[p], eps_m):
            linked[p] = True
            root = np.where(root == max(root[a[p]], root[b[p]]), min(root[a[p]], root[b[p]]), root)
    return root


def _components(n: int, a, b) -> np.ndarray:
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        np.minimum.at(after, root[a], low)
        np.minimum.at(after, root[b], low)
        after = after[after]
        if np.array_equal(after, root):
            return root
        root = after


def _touch(s: _Sites, core, a: int, b: int, eps_m: float) -> bool:
    """Whether two full cells have core sites within eps of each other.

    Two groups of sites are near if one site of each is, apart if their
    bounding boxes are; else the wider one is halved and the halves judged.
    Few pairs are left to compare, whatever the shape of the groups.
    """
    sides = []
    for c in (a, b):
        i = np.arange(s.start[c], s.start[c] + s.size[c])
        sides.append(i[core[i]])
    open_pairs = [tuple(sides)]
    while open_pairs:
        i, j = open_pairs.pop()
        if not len(i) or not len(j) or _apart(s, i, j, eps_m):
            continue
        if _near(s, i[len(i) // 2], j[len(j) // 2], eps_m):
            return True
        if len(i) * len(j) <= TOUCH_PAIRS:
            if _near(s, np.repeat(i, len(j)), np.tile(j, len(i)), eps_m).any():
                return True
            continue
        if len(i) < len(j):
            i, j = j, i
        axis = s.lat[i] if np.ptp(s.lat[i]) >= np.ptp(s.lon[i]) else s.lon[i]
        order = np.argsort(axis, kind="stable")
        half = len(i) // 2
        open_pairs += [(i[order[:half]], j), (i[order[half:]], j)]
    return False


def _apart(s: _Sites, i, j, eps_m: float) -> bool:
    """Whether the bounding boxes of two groups are surely more than eps apart."""
    lat0, lat1, lon0, lon1 = (f(x[k]) for x in (s.lat, s.lon) for f, k in ((np.min, i), (np.max, i)))
    lat2, lat3, lon2, lon3 = (f(x[k]) for x in (s.lat, s.lon) for f, k in ((np.min, j), (np.max, j)))
    north = max(0.0, lat2 - lat1, lat0 - lat3)
    east = max(0.0, lon2 - lon1, lon0 - lon3)
    if math.radians(max(lon1, lon3) - min(lon0, lon2)) > 0.01:
        east = 0.0  # too wide to be taken for flat; the way round the other side may be shorter
    cos = math.cos(math.radians(max(abs(lat0), abs(lat1), abs(lat2), abs(lat3))))
    return math.radians(math.hypot(north, east * cos)) * EARTH_RADIUS_M > eps_m * (1 + 1e-5)
