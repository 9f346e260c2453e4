"""Toxicity with classifier chains.

Categories are predicted one after another; each linear model sees the words
of the text and the probabilities of the categories before it. While training,
those probabilities come from models that have not seen the row (folds), so
that a later model meets the same kind of input as when it predicts.

Words are judged by presence, whole and by their beginnings: one slur in a
very long text weighs as much as in a short one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roost.llm.batches import ready_workers, slices
from roost.sources.stage import discard, stage

WORD = re.compile(r"[^\W\d_]+")
# The categories that the table of labels can teach, in chain order: name -> condition.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


@dataclass(frozen=True)
class ToxicityParams:
    """``sample_rows`` bounds the labelled rows that the models are fitted on, ``max_features`` the words."""

    sample_rows: int = 6000
    max_features: int = 2000
    starts: tuple[int, ...] = (4, 5, 6)
    min_rows: int = 4
    folds: int = 5
    steps: int = 200
    penalty: float = 0.2
    threshold: float = 0.35
    seed: int = 11


@dataclass(frozen=True)
class ChainModel:
    categories: list[str]
    words: dict[str, int]
    weights: list[np.ndarray]  # per category: words, earlier categories, bias


def parts(text: str, params: ToxicityParams) -> set[str]:
    """The distinct words of a whole text, and their beginnings of k letters marked by k stars."""
    words = set(WORD.findall(text.lower()))
    return words.union(*({w[:k] + "*" * k for w in words if len(w) >= k} for k in params.starts))


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, str], params: ToxicityParams) -> ChainModel:
    """Fit the chain on at most about ``sample_rows`` labelled documents, chosen by a hash of the id.

    A label without a document teaches nothing, a null condition counts as
    false, a null text as empty. Several labels of one id: it is in a category
    if any says so. A category without a positive row among those fitted on,
    or without any row, scores 0 everywhere: no document is toxic by it.
    """
    flags = [F.max(F.coalesce(F.expr(c), F.lit(False))).alias(f"y{i}") for i, c in enumerate(categories.values())]
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*flags)
    total = known.count()
    share = min(1.0, params.sample_rows / max(1, total))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(params.seed)), F.lit(1 << 30)) / float(1 << 30)
    # Broadcast bound: about sample_rows ids.
    taken = F.broadcast(known.where(draw < share))
    names = [f"y{i}" for i in range(len(categories))]

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [sorted(parts(t or "", params)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(n) for n in names), pa.array(found, pa.list_(pa.string()))],
                ["doc_id", *names, "parts"],
            )

    ready_workers(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, " + "".join(f"{n} boolean, " for n in names) + "parts array<string>"
    sampled = narrow.join(taken, "doc_id").select("doc_id", *names, "text")
    # Read three times below: words to count, their numbers, the rows.
    rows = stage(sampled.mapInArrow(bags, schema), "sampled-labels")
    chosen = vocabulary(rows, names, params)
    words = {w: i for i, w in enumerate(chosen)}

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(words[p] for p in ps if p in words) for ps in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(n) for n in names), pa.array(found, pa.list_(pa.int32()))],
                ["doc_id", *names, "places"],
            )

    placed = rows.mapInArrow(places, schema.replace("parts array<string>", "places array<int>")).collect()
    discard(rows)
    placed.sort(key=lambda r: (r["doc_id"], r["places"]))
    x = np.zeros((len(placed), len(words)), dtype=np.float32)
    y = np.zeros((len(placed), len(names)), dtype=np.float32)
    for i, r in enumerate(placed):
        x[i, r["places"]] = 1.0
        y[i] = [bool(r[n]) for n in names]
    return ChainModel(list(categories), words, chain(x, y, params))


def vocabulary(rows: DataFrame, names: list[str], params: ToxicityParams) -> list[str]:
    """The parts that tell most about some category: a bounded list, counted over all sampled rows."""
    hits = [F.sum(F.col(n).cast("int")).alias(f"h{i}") for i, n in enumerate(names)]
    totals = rows.agg(F.count("*").alias("n"), *hits).first()
    if not totals["n"]:
        return []
    gain = F.lit(0.0)
    for i in range(len(names)):
        rate = (totals[f"h{i}"] or 0) / totals["n"]
        spread = max(rate * (1 - rate), 1e-9)
        gain = F.greatest(gain, F.abs(F.col(f"h{i}") - rate * F.col("n")) / F.sqrt(F.col("n") * spread))
    counted = (
        rows.select(*names, F.explode("parts").alias("part"))
        .groupBy("part")
        .agg(F.count("*").alias("n"), *hits)
        .where(F.col("n") >= params.min_rows)
    )
    best = counted.orderBy(F.desc(gain), "part").limit(params.max_features)
    return [r["part"] for r in best.select("part").collect()]


def chain(x: np.ndarray, y: np.ndarray, params: ToxicityParams) -> list[np.ndarray]:
    """One model per category; earlier categories enter by their out-of-fold probabilities."""
    fold = np.arange(len(x)) % params.folds
    before = np.zeros((len(x), 0), dtype=np.float32)
    models = []
    for k in range(y.shape[1]):
        inputs = np.hstack([x, before])
        models.append(logistic(inputs, y[:, k], params))
        if k + 1 == y.shape[1]:
            break
        unseen = np.zeros(len(x), dtype=np.float32)
        for f in range(params.folds):
            out = fold == f
            if out.any():
                unseen[out] = probability(inputs[out], logistic(inputs[~out], y[~out, k], params))
        before = np.hstack([before, unseen[:, None]])
    return models


def tilt(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How much more often an input is set where y is than where it is not, as a logarithm."""
    there, away = x[y > 0].sum(axis=0) + 1.0, x[y == 0].sum(axis=0) + 1.0
    return np.log(there / (y.sum() + 2.0)) - np.log(away / (len(y) - y.sum() + 2.0))


def logistic(x: np.ndarray, y: np.ndarray, params: ToxicityParams) -> np.ndarray:
    """Penalised logistic regression by accelerated gradient steps; the last weight is the bias.

    Inputs are scaled by their tilt, so that the penalty spares the telling
    ones: of words that mostly come together, each alone is then enough.
    Without a positive row the bias is minus infinity: probability 0.
    """
    scale = tilt(x, y).astype(np.float32)
    x = x * scale
    w = np.zeros(x.shape[1] + 1, dtype=np.float64)
    if not y.any():
        w[-1] = -np.inf
        return w
    # The largest curvature: a bound on the squared norm of the inputs, by power steps.
    v = np.ones(x.shape[1], dtype=np.float32)
    for _ in range(8):
        v = x.T @ (x @ v)
        v /= max(float(np.linalg.norm(v)), 1e-12)
    reach = float(np.linalg.norm(x @ v)) ** 2 + len(x)
    step = 1.0 / (0.3 * reach + params.penalty)
    ahead, speed = w.copy(), 1.0
    for _ in range(params.steps):
        error = probability(x, ahead) - y
        slope = np.append(x.T @ error.astype(np.float32), error.sum()) + params.penalty * np.append(ahead[:-1], 0.0)
        new = ahead - step * slope
        faster = (1 + np.sqrt(1 + 4 * speed**2)) / 2
        ahead = new + (speed - 1) / faster * (new - w)
        w, speed = new, faster
    return w * np.append(scale, 1.0)


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    if np.isneginf(w[-1]):
        return np.zeros(len(x))
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1].astype(np.float32) + w[-1], -30, 30)))


def scorer(model: ChainModel, params: ToxicityParams):
    """text -> probability of each category, in chain order."""
    size = len(model.words)
    whole = {w: i for w, i in model.words.items() if "*" not in w}
    starts = {k: {w[:k]: i for w, i in model.words.items() if w[k:] == "*" * k} for k in params.starts}

    def score(text: str | None) -> list[float]:
        words = set(WORD.findall((text or "").lower()))
        at = [whole[w] for w in whole.keys() & words]
        for k, places in starts.items():
            at += [places[w] for w in places.keys() & {w[:k] for w in words}]
        given: list[float] = []
        for w in model.weights:
            z = w[at].sum() + sum(p * w[size + i] for i, p in enumerate(given)) + w[-1]
            given.append(0.0 if np.isneginf(z) else float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return given

    return score


def score_documents(docs: DataFrame, model: ChainModel, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """(doc_id, p_<category>..., toxic, kept), one row per document, from whole texts.

    A null text counts as empty. ``toxic``: the last category's probability
    reaches the threshold; ``kept`` is its opposite.
    """
    ready_workers(docs.sparkSession)
    names = [f"p_{c}" for c in model.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model, params)
        for batch in (p for whole in batches for p in slices(whole, "text")):
            found = [score(t.as_py()) for t in batch.column("text")]
            bad = [s[-1] >= params.threshold for s in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array([s[i] for s in found], pa.float64()) for i in range(len(names))),
                    pa.array(bad, pa.bool_()),
                    pa.array([not b for b in bad], pa.bool_()),
                ],
                ["doc_id", *names, "toxic", "kept"],
            )

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    columns = "".join(f"`{n}` double, " for n in names)
    return narrow.mapInArrow(run, f"doc_id bigint, {columns}toxic boolean, kept boolean")


def drop_toxic(docs: DataFrame, model: ChainModel, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """The documents that are not toxic, with all their columns as they are, whatever their names.

    A null text counts as empty. Texts are held in slices, not a whole batch at a time.
    """
    ready_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model, params)
        for part in (p for batch in batches for p in slices(batch, "text")):
            keep = [score(t.as_py())[-1] < params.threshold for t in part.column("text")]
            yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
