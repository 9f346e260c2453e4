"""Connected components by repeated contraction, as Spark jobs.

Each round every node points at its smallest neighbour, the pointers are
followed to their ends, and the edges are rewritten between the ends. A tree
of pointers becomes one node, however many nodes it had, so the rounds grow
with the logarithm of the longest path and the tables shrink from round to
round. Edges lie in staged tables; nothing but emptiness tests reaches the
driver. Adaptive execution splits the joins on a node with very many edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roost.sources.ship import ship_package
from roost.sources.stage import discard, stage


def connected(edges: DataFrame, scope: list[str] | None = None, finish_edges: int = 0) -> DataFrame:
    """(scope..., node, root): every node that has an edge, and the smallest node it reaches.

    ``edges`` has columns u and v and may repeat edges, in either direction;
    rows with a null end are ignored. Nodes are told apart within ``scope``.
    Once a round begins with at most ``finish_edges`` counted edges, one task
    finishes them.
    """
    roots, rounds = [], 0
    open_edges = stage(between(edges.where("u IS NOT NULL AND v IS NOT NULL"), scope or []), "edges")
    left = open_edges.count() if finish_edges else 0
    while rounds == 0 or not open_edges.isEmpty():
        if finish_edges and left <= finish_edges:
            roots.append(stage(finished(open_edges, scope or []), "ends"))
            rounds += 1
            break
        hooked = ends(open_edges, scope or [])
        roots.append(hooked)
        rounds += 1
        contracted = stage(contract(open_edges, hooked, scope or []), "edges")
        discard(open_edges)
        open_edges = contracted
        left = open_edges.count() if finish_edges else 0
    discard(open_edges)
    out = roots[0]
    for later in roots[1:]:
        above = later.select(*(scope or []), F.col("node").alias("root"), F.col("root").alias("far"))
        out = out.join(above, (scope or []) + ["root"], "left").select(
            *(scope or []), "node", F.coalesce("far", "root").alias("root")
        )
    out = stage(out.select(*(scope or []), "node", "root"), "components")
    discard(*roots)
    out.rounds = rounds
    return out


def between(edges: DataFrame, scope: list[str]) -> DataFrame:
    """Each edge once, the smaller end first, without loops."""
    return (
        edges.where("u <> v")
        .select(*scope, F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct()
    )


def ends(edges: DataFrame, scope: list[str]) -> DataFrame:
    """Where each node's chain of smallest neighbours ends."""
    both = edges.unionByName(edges.select(*scope, F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy(*scope, F.col("u").alias("node")).agg(F.min("v").alias("near"))
    here = stage(smallest.select(*scope, "node", F.least("node", "near").alias("root")), "ends")
    while True:
        above = here.select(*scope, F.col("node").alias("root"), F.col("root").alias("far"))
        jumped = stage(
            here.join(above, scope + ["root"]).select(
                *scope, "node", F.col("far").alias("root"), (F.col("far") != F.col("root")).alias("moved")
            ),
            "ends",
        )
        discard(here)
        here = jumped
        if here.where("moved").isEmpty():
            return here


def finished(edges: DataFrame, scope: list[str]) -> DataFrame:
    """The components of few edges, whose number the caller has checked, in one task."""
    ship_package(edges.sparkSession)
    kinds = dict(edges.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in scope), f"node {kinds['u']}", f"root {kinds['u']}"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if not parts:
            return
        pairs = pd.concat(parts, ignore_index=True)
        sides = [pairs[[*scope, end]].rename(columns={end: "node"}) for end in ("u", "v")]
        # Sorted by node, so that the smallest number of a component is its smallest node's.
        nodes = pd.concat(sides).drop_duplicates().sort_values("node", ignore_index=True)
        numbered = nodes.reset_index(names="_number")
        u, v = (side.merge(numbered, on=[*scope, "node"], how="left")["_number"].to_numpy() for side in sides)
        root, before = np.arange(len(nodes)), None
        while before is None or (root != before).any():
            before = root.copy()
            low = np.minimum(root[u], root[v])
            for end in (root[u], root[v], u, v):
                np.minimum.at(root, end, low)
            root = root[root]
        yield nodes.assign(root=nodes["node"].to_numpy()[root])

    return edges.coalesce(1).mapInPandas(run, schema)


def contract(edges: DataFrame, roots: DataFrame, scope: list[str]) -> DataFrame:
    side = roots.select(*scope, "node", "root")
    low = side.select(*scope, F.col("node").alias("u"), F.col("root").alias("low"))
    high = side.select(*scope, F.col("node").alias("v"), F.col("root").alias("high"))
    moved = edges.join(low, scope + ["u"]).join(high, scope + ["v"])
    return between(moved.select(*scope, F.col("low").alias("u"), F.col("high").alias("v")), scope)
