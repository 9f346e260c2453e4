"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends. Words are appended one by one to a suffix automaton.
Every state knows where its strings ended last: the states between a state and
the root lie on paths of one such position each, kept in splay trees as in a
link-cut tree. The new prefix's access walks its way to the root and recolours
it. Each path segment met tells the longest suffix (length L) that ended last
at some j: if the distance d = i - j is at most L, the words j-L+1..i are a
square of smallest period d, which is then extended both ways to its run.

Why that finds all runs: inside a run of period q, from its second period on,
the suffix that goes back to one period after the run's start ended q words ago,
and not later, as by Fine and Wilf a smaller distance would be a smaller period
of the run. Each run is extended once: two runs of equal period share less than
a period, so a square that ends inside the last run of its period is part of it.

A word that occurs less often in a text than the least exponent cannot be in
any run. Such words cut the text into stretches, each with its own automaton.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Hashable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roost.llm.batches import ready_workers, slices


@dataclass(frozen=True)
class RunParams:
    """Runs of at least ``least_length`` words and ``least_exponent`` (2 or more) whole periods."""

    least_length: int = 6
    least_exponent: int = 4


class PathForest:
    """The automaton's suffix links as paths of equal last end, each path a splay tree.

    Nodes are numbered from 1. In a tree, left is nearer to the root of the
    links. ``up`` of a tree's root is the node above the path's top; ``last``
    holds for a tree's root and means the whole path.
    """

    def __init__(self) -> None:
        self.left, self.right, self.up, self.last = [0], [0], [0], [-1]

    def leaf(self, above: int) -> int:
        """A new path of one node below ``above``."""
        self.left.append(0)
        self.right.append(0)
        self.up.append(above)
        self.last.append(-1)
        return len(self.up) - 1

    def splice(self, node: int) -> int:
        """A new node directly above ``node``, on the same path."""
        self.splay(node)
        new = self.leaf(node)
        beyond = self.left[node]
        self.left[new] = beyond
        if beyond:
            self.up[beyond] = new
        self.left[node] = new
        return new

    def rotate(self, x: int, p: int) -> None:
        left, right, up = self.left, self.right, self.up
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            up[b] = p
        up[p], up[x] = x, g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def splay(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        p = up[x]
        if not p or (left[p] != x and right[p] != x):
            return
        while p and (left[p] == x or right[p] == x):
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                self.rotate(*((p, g) if (left[g] == p) == (left[p] == x) else (x, p)))
                self.rotate(x, up[x])
            else:
                self.last[x] = self.last[p]
                self.rotate(x, p)
                return
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                # The old root of the tree is now below x by at most two steps: hand its path's end on.
                self.last[x] = self.last[g]
                return

    def access(self, x: int, end: int) -> list[tuple[int, int]]:
        """Recolour the way from ``x`` to the root with ``end``; (deepest node, former end) of each segment."""
        left, right, up, last = self.left, self.right, self.up, self.last
        met, below = [], 0
        while x:
            p = up[x]
            if p and (left[p] == x or right[p] == x):
                self.splay(x)
            met.append((x, last[x]))
            deeper = right[x]
            if deeper:
                last[deeper] = last[x]
            right[x] = below
            below, x = x, up[x]
        last[below] = end
        return met


def stretch_runs(words: Sequence[int], params: RunParams) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in one stretch."""
    n = len(words)
    forest = PathForest()
    root = forest.leaf(0)
    follow: list[dict[int, int]] = [{}, {}]
    link, size = [0, 0], [0, 0]
    reached: dict[int, int] = {}  # period -> end of its last run
    found = []
    tip = root
    for i, word in enumerate(words):
        new = len(size)
        size.append(size[tip] + 1)
        follow.append({})
        p = tip
        while p and word not in follow[p]:
            follow[p][word] = new
            p = link[p]
        fresh_copy = 0
        if not p:
            above = root
        else:
            above = follow[p][word]
            if size[above] != size[p] + 1:
                q, fresh_copy = above, new + 1
                size.append(size[p] + 1)
                follow.append(follow[q].copy())
                above = fresh_copy
                while p and follow[p].get(word) == q:
                    follow[p][word] = above
                    p = link[p]
        link.append(above)
        forest.leaf(above)
        if fresh_copy:
            link.append(link[q])
            link[q] = fresh_copy
            forest.splice(q)
        tip = new
        for node, j in forest.access(new, i):
            d = i - j
            if j < 0 or d > size[node] or reached.get(d, -1) >= i:
                continue
            start, stop = j - size[node] + 1, i + 1
            while start > 0 and words[start - 1] == words[start - 1 + d]:
                start -= 1
            while stop < n and words[stop] == words[stop - d]:
                stop += 1
            reached[d] = stop - 1
            if stop - start >= max(params.least_length, params.least_exponent * d):
                found.append((start, stop - start, d))
    return found


def runs_of(words: Sequence[Hashable], params: RunParams = RunParams()) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    if params.least_exponent < 2:
        raise ValueError("least_exponent is 2 or more")
    counts = Counter(words)
    codes = {w: k for k, (w, c) in enumerate(counts.items()) if c >= params.least_exponent}
    least = max(params.least_length, params.least_exponent)
    found, start = [], 0
    coded = [codes.get(w, -1) for w in words]
    coded.append(-1)
    while start < len(coded):
        stop = coded.index(-1, start)
        if stop - start >= least:
            found += [(start + s, n, q) for s, n, q in stretch_runs(coded[start:stop], params)]
        start = stop + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: Sequence, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that some run contains after its first period."""
    if not runs:
        return list(words)
    keep = bytearray(b"\x01") * len(words)
    for start, length, period in runs:
        keep[start + period : start + length] = bytes(length - period)
    return [w for w, k in zip(words, keep, strict=True) if k]


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame, params: RunParams = RunParams()) -> DataFrame:
    """(doc_id, n_words, runs array<struct<start, length, period>>, collapsed), one row per input row.

    Words end at ASCII white space, are compared as they are and numbered from
    0; runs come by start, then period, and may overlap. ``collapsed`` joins the
    kept words by one space. A null text counts as empty: no words, no runs.
    Each row is answered by itself, so order, ties and repeated rows do not
    matter; an empty table gives an empty one; other columns are ignored,
    whatever their names. A whole text is one task's work, about 1 KB of memory
    a word of its stretches.
    """
    ready_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, "raw")):
            counts, spans, texts = [], [], []
            for raw in part.column("raw"):
                words = (raw.as_py() or b"").split()
                runs = runs_of(words, params)
                counts.append(len(words))
                spans.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
                texts.append(b" ".join(collapse(words, runs)))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(spans, pa.list_(RUN)),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("raw")
    )
    schema = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return narrow.mapInArrow(run, schema)


def run_digests(docs: DataFrame, params: RunParams = RunParams()) -> DataFrame:
    """Per document: the number of runs, the one of greatest exponent, digests of all runs and of the kept words."""
    found = find_runs(docs, params)
    better = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    # Runs come by start, then period: of equal exponents the first stays.
    best = F.aggregate("runs", F.try_element_at("runs", F.lit(1)), lambda a, b: F.when(better(a, b), b).otherwise(a))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
