import random

import pytest
from conftest import rows

from roost.operators.components import connected


@pytest.mark.parametrize("finish", [1_000, 12])
def test_one_task_finishes_what_the_rounds_leave(spark, finish):
    r = random.Random(7)
    edges = [(s, r.randrange(60), r.randrange(60)) for s in ("a", "b") for _ in range(35)]
    edges += [("c", i, i + 1) for i in range(20)] + [(None, None, 1), ("c", 3, None), ("d", 5, 5)]
    df = spark.createDataFrame(edges, "s string, u bigint, v bigint")
    plain = connected(df, ["s"])
    assert rows(connected(df, ["s"], finish_edges=finish), "s", "node", "root") == rows(plain, "s", "node", "root")
    assert ("c", 20, 0) in rows(plain, "s", "node", "root")


def test_no_edges(spark):
    df = spark.createDataFrame([], "u bigint, v bigint")
    assert connected(df, finish_edges=10).count() == 0
