import numpy as np
import pytest
from conftest import rows

from roost.operators import selection, skew
from roost.operators.selection import large_groups, middle_values, small_groups

DDL = "k string, i int, a double, b double"


def sample():
    rng = np.random.default_rng(7)
    out = []
    for k, n in (("even", 400), ("odd", 401), ("one", 1), ("ties", 300)):
        for i in range(n):
            a = float(rng.integers(0, 3)) if k == "ties" else float(rng.normal() * 10.0 ** rng.integers(-9, 9))
            out.append((k, i, a, None if i % 5 == 0 and n > 1 else -a))
    out += [("odd values", i, v, v) for i, v in enumerate((-0.0, 0.0, float("-inf"), 5e-324, -5e-324, float("inf")))]
    out += [("not a number", i, v, 1.0) for i, v in enumerate((float("nan"), 1.0, float("nan")))]
    out += [("nothing", i, None, None) for i in range(3)]
    return out


def found(df):
    # One zero: the sign of a zero is not part of a value's order.
    return [(k, str(a + 0.0) if a is not None else None, str(b + 0.0) if b is not None else None) for k, a, b in rows(df, "k", "a", "b")]


@pytest.mark.parametrize("observed", [True, False])
def test_counting_passes_equal_the_percentile(spark, observed):
    df = spark.createDataFrame(sample(), DDL)
    if not observed:
        df = df.where("k <> 'odd values'")  # the mean of two infinities is no middle
    want = found(small_groups(df, ["k"], ["a", "b"], observed))
    assert found(large_groups(df, ["k"], ["a", "b"], observed)) == want
    assert found(middle_values(df, ["k"], ["a", "b"], observed, limit=350)) == want


def test_many_ranks_spread_over_copies(spark, monkeypatch):
    df = spark.createDataFrame(sample(), DDL)
    want = found(small_groups(df, ["k"], ["a", "b"], True))
    monkeypatch.setattr(selection, "MAX_HOT_KEYS", 0)
    monkeypatch.setattr(skew, "MAX_HOT_KEYS", 0)
    assert found(middle_values(df, ["k"], ["a", "b"], limit=1)) == want


def test_several_keys_and_a_null_key(spark):
    data = [(k, j, float(v), 0.0) for k in ("x", None) for j in (1, 2) for v in range(9)]
    df = spark.createDataFrame(data, DDL)
    got = rows(middle_values(df, ["k", "i"], ["a"], limit=4), "k", "i", "a")
    assert sorted(got, key=repr) == sorted([(k, j, 4.0) for k in ("x", None) for j in (1, 2)], key=repr)


def test_empty_table(spark):
    assert middle_values(spark.createDataFrame([], DDL), ["k"], ["a"]).count() == 0
