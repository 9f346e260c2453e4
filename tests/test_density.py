"""The vectorised clustering against a direct reading of the definition."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roost.operators import density
from roost.operators.density import distance_m, label_pack


def brute_force(pdf, eps, min_points):
    out = np.full(len(pdf), -1, dtype=object)
    turn = pdf.sort_values(["start_timestamp", "stop_events"]).index
    for device in pdf["device_id"].unique():
        i = np.array([k for k in turn if pdf["device_id"][k] == device])
        lat, lon = pdf["median_latitude"].to_numpy()[i], pdf["median_longitude"].to_numpy()[i]
        near = distance_m(lat[:, None], lon[:, None], lat, lon) <= eps
        core = near.sum(1) >= min_points
        group = np.full(len(i), -1)
        for k in range(len(i)):
            if core[k] and group[k] < 0:
                todo = [k]
                group[k] = k
                while todo:
                    for j in np.flatnonzero(near[todo.pop()] & core & (group < 0)):
                        group[j] = k
                        todo.append(j)
        for k in range(len(i)):
            if not core[k] and (near[k] & core).any():
                group[k] = group[near[k] & core].min()
        for k, g in zip(i, group):
            out[k] = -1 if g < 0 else (device, i[g])
    return out


def partition(labels, devices):
    """Each stop's cluster as the set of its members; noise stays apart."""
    keys = [(d, v) if v != -1 else -1 for d, v in zip(devices, labels)]
    members = {}
    for i, k in enumerate(keys):
        members.setdefault(k, []).append(i)
    return [-1 if k == -1 else tuple(members[k]) for k in keys]


def check(pdf, eps, min_points):
    got = partition(label_pack(pdf, eps, min_points), pdf["device_id"])
    want = partition(brute_force(pdf, eps, min_points), pdf["device_id"])
    assert got == want


def frame(device, lat, lon, seed=0):
    n = len(lat)
    order = np.random.default_rng(seed).permutation(n)
    return pd.DataFrame(
        {
            "device_id": device,
            "stop_events": order,
            "start_timestamp": order.astype(float) // 2,
            "median_latitude": np.asarray(lat, float),
            "median_longitude": np.asarray(lon, float),
        }
    )


@settings(max_examples=60, deadline=None)
@given(
    st.integers(0, 10_000),
    st.integers(1, 6),
    st.sampled_from([0.0, 4.6, -33.4, 71.0, 89.9995]),
    st.sampled_from([-74.1, 179.9999, 0.0]),
    st.sampled_from([10, 60, 200]),
    st.sampled_from([40.0, 120.0, 400.0]),
)
def test_matches_the_definition(seed, min_points, lat, lon, n, spread_m):
    r = np.random.default_rng(seed)
    m = 1 / 111_195
    cos = max(np.cos(np.radians(lat)), 1e-4)
    y = np.minimum(lat + np.round(r.uniform(-1, 1, n) * spread_m) * m, 90.0)
    x = lon + np.round(r.uniform(-1, 1, n) * spread_m) * m / cos
    x = (x + 180) % 360 - 180
    check(frame(r.choice(["a", "b", "c"], n), y, x, seed), 20.0, min_points)


@pytest.mark.parametrize("min_points", [1, 2, 3, 5])
def test_crowded_cells(min_points, monkeypatch):
    # Tiny blocks force the block-wise and the large-cell code.
    monkeypatch.setattr(density, "PAIR_BLOCK", 500)
    r = np.random.default_rng(5)
    m = 1 / 111_195
    centres = r.integers(0, 6, 400) * 17.0
    y = 4.6 + (centres + r.normal(0, 2.0, 400)) * m
    x = -74.0 + (r.integers(0, 3, 400) * 19.0 + r.normal(0, 2.0, 400)) * m
    check(frame(r.choice(["a", "b"], 400), y, x), 20.0, min_points)


def test_gap_just_over_eps_between_full_cells(monkeypatch):
    monkeypatch.setattr(density, "PAIR_BLOCK", 500)
    m = 1 / 111_195.08
    y = np.concatenate([np.linspace(0, 4, 60), np.linspace(24.5, 28, 60)]) * m + 10
    pdf = frame("a", y, np.full(120, 20.0))
    assert len(set(label_pack(pdf, 20.0, 2))) == 2
    assert len(set(label_pack(pdf, 21.0, 2))) == 1


def test_chain_longer_than_eps_is_one_cluster():
    y = np.arange(30) * 19 / 111_195
    assert len(set(label_pack(frame("a", y, np.zeros(30)), 20.0, 2))) == 1


def test_wider_eps_adds_no_noise():
    r = np.random.default_rng(2)
    pdf = frame("a", r.uniform(0, 0.01, 150), r.uniform(0, 0.01, 150))
    noise = [(label_pack(pdf, eps, 2) == -1) for eps in (10, 20, 40, 80)]
    for narrow, wide in zip(noise, noise[1:]):
        assert not (wide & ~narrow).any()


def test_empty_pack():
    assert len(label_pack(frame("a", [], []), 20.0, 2)) == 0


def test_slanted_lines_just_apart_are_quick():
    """Two full cells whose boxes overlap all along, but no two sites of which are near."""
    import time

    n, metre = 32_000, 1 / 111_194.9
    t = np.linspace(0, 60 * metre, n)
    gap = 20.3 * metre / 2**0.5
    lat, lon = np.concatenate([t, t - gap]), np.concatenate([t, t + gap])
    pdf = frame(np.zeros(2 * n, dtype=int), lat, lon)
    start = time.perf_counter()
    labels = label_pack(pdf, 20.0, 2)
    assert time.perf_counter() - start < 10
    assert len(set(labels.tolist())) == 2
