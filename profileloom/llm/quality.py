"""A quality classifier learnt from trusted positives and unlabelled text (nnPU).

The risk of a scorer z over positives P and unlabelled rows U with class prior pi is
pi * E_P[l(z)] + max(0, E_U[l(-z)] - pi * E_P[l(-z)]), l being the logistic loss. The
second part estimates the risk on the unseen negatives; where it turns negative the
fit has gone too far, and the step goes back. Negative labels are never used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profileloom.llm.shared import map_arrow, small_batches, sql_type, text_bytes

#: Rows of each class the model is fitted on: the least by a hash of the doc_id.
SAMPLE = 10_000
#: Every fifth document by crc32 is held out from learning.
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
_STEPS, _RATE, _DECAY = 400, 0.05, 1e-4
_KEPT_BYTES = 256


def features(text: bytes) -> np.ndarray:
    """What a text looks like, whatever its language: byte mix, words, lines, repetition."""
    size = max(len(text), 1)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=_KEPT_BYTES)
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    n, m = max(len(words), 1), max(len(lines), 1)
    letters = counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum()
    different = len(set(words)) / n
    shape = [
        np.log1p(len(text)), np.log1p(len(words)), size / n / 10, different, len(set(lines)) / m,
        np.log1p(size / m), letters / size, counts[65:91].sum() / size, counts[48:58].sum() / size,
        (size - letters - counts[48:58].sum() - counts[32] - counts[10]) / size, counts[10] * 10 / size,
        len({*zip(words, words[1:], strict=False)}) / n, different * np.log1p(n),
    ]
    return np.concatenate([np.sqrt(counts / size), np.array(shape)]).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Weights of the standardised features; ``prior`` is the estimated share of positives."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -8, 8) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(gradient, size: int) -> np.ndarray:
    """Adam from zero, always with the same steps."""
    w, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, _STEPS + 1):
        g = gradient(w) + _DECAY * w
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w = w - _RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimate_prior(positives: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled, by the best bin.

    A scorer tells positives from unlabelled rows on one half of each; on the other half
    the ratio of the shares above a threshold is the prior wherever no negatives are
    above it, so its least reliable upper bound is taken.
    """
    p, u = positives[::2], unlabelled[::2]
    x = np.r_[p, u]
    y = np.r_[np.ones(len(p)), np.zeros(len(u))]
    side = np.where(y == 1, 0.5 / max(len(p), 1), 0.5 / max(len(u), 1))
    w = _descend(lambda w: x.T @ (side * (_sigmoid(x @ w) - y)), x.shape[1])
    p, u = np.sort(positives[1::2] @ w), np.sort(unlabelled[1::2] @ w)
    if not len(p) or not len(u):
        return 0.5
    at = np.quantile(p, np.linspace(0, 0.9, 91))
    share_p = 1 - np.searchsorted(p, at) / len(p)
    share_u = 1 - np.searchsorted(u, at) / len(u)
    slack = np.sqrt(np.log(20.0) / (2 * len(u))) + np.sqrt(np.log(20.0) / (2 * len(p)))
    best = np.argmin((share_u + slack) / np.maximum(share_p, 1e-9))
    return float(np.clip(share_u[best] / share_p[best], 0.05, 0.98))


def fit(positives: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> Model:
    """A model from features of positives and unlabelled rows; without either, every score is 0.5."""
    every = np.r_[positives, unlabelled].astype(np.float64)
    mean, scale = every.mean(0), every.std(0) + 1e-3
    p, u = (
        np.c_[np.clip((x - mean) / scale, -8, 8), np.ones(len(x))] for x in (positives, unlabelled)
    )
    if prior is None:
        prior = estimate_prior(p, u)

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = p @ w, u @ w
        like = lambda z: np.logaddexp(0, z).mean()  # noqa: E731  E[l(-z)]
        towards = p.T @ (_sigmoid(zp) - 1) / len(p) * prior
        away = u.T @ _sigmoid(zu) / len(u) - prior * (p.T @ _sigmoid(zp)) / len(p)
        return towards + away if like(zu) - prior * like(zp) >= 0 else -away

    return Model(mean, scale, _descend(gradient, p.shape[1]), prior)


def fold(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the doc_id as text, modulo ``FOLDS``; a null id counts as empty text, hence held out."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the learnable folds of ``documents`` and ``labels`` (doc_id, quality, ...).

    Positives are documents all of whose labels are 1, unlabelled ones have no label.
    At most ``sample`` rows of each are taken, the least by a hash of doc_id and text, equal
    rows once; only those rows' features reach the driver, however often a doc_id occurs.
    """
    judged = labels.groupBy("doc_id").agg(F.min("quality").alias("least"), F.count("*").alias("n"))
    texts = documents.filter(fold() != HELD_OUT).select("doc_id", text_bytes().alias("_t")).withColumn("_h", F.xxhash64("doc_id", "_t"))
    rows = texts.select("doc_id", "_h").distinct()  # equal rows count once
    positive = rows.join(judged.filter("least = 1").select("doc_id"), "doc_id", "left_semi")
    unlabelled = rows.join(judged.select("doc_id"), "doc_id", "left_anti")
    chosen = [(F.lit(p).alias("_p"), kind.select("_h").distinct().orderBy("_h").limit(sample)) for p, kind in ((1, positive), (0, unlabelled))]
    chosen = chosen[0][1].withColumn("_p", chosen[0][0]).unionByName(chosen[1][1].withColumn("_p", chosen[1][0]))
    # At most two samples of hashes: bounded by ``sample``.
    rows = texts.join(F.broadcast(chosen), "_h").select("_p", "_h", "_t")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()  # of at most two samples
        for batch in batches:
            first = [i for i, h in enumerate(batch.column(1).to_pylist()) if not (h in done or done.add(h))]
            batch = batch.take(pa.array(first, pa.int64()))
            seen = [features(t).tolist() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(seen, pa.list_(pa.float32()))], names=["p", "h", "x"]
            )

    table = map_arrow(rows, look, "p int, h bigint, x array<float>").groupBy("p", "h").agg(F.first("x").alias("x")).toArrow()
    table = table.sort_by([("p", "ascending"), ("h", "ascending")])  # the fit doesn't depend on tasks' order
    width = len(features(b""))
    x = np.asarray(table["x"].combine_chunks().flatten(), np.float64).reshape(-1, width)
    is_p = np.asarray(table["p"]) == 1
    if not is_p.any() or is_p.all():
        return Model(np.zeros(width), np.ones(width), np.zeros(width + 1), 0.5)
    return fit(x[is_p], x[~is_p])


def _scored(texts: pa.Array, model: Model) -> np.ndarray:
    return model.scores(np.array([features(t) for t in texts.to_pylist()]).reshape(len(texts), -1))


def score(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``documents`` (doc_id, text, ...).

    ``score`` is the estimated chance of quality 1, read from the whole text alone;
    null counts as empty, and empty texts are scored like others. Null and repeated
    ids and repeated rows are rows like others. Other columns are ignored. Without
    labelled positives or unlabelled documents every score is 0.5.
    """
    model = learn(documents, labels, sample)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(_scored(batch.column(1), model))], names=["doc_id", "score"]
                )

    schema = f"doc_id {sql_type(documents, 'doc_id')}, score double"
    scored = map_arrow(documents.select("doc_id", text_bytes().alias("text")), work, schema)
    return scored.select(
        "doc_id", (fold() == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_good(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``documents`` whose score reaches the threshold, with all their columns."""
    model = learn(documents, labels, sample)
    at = documents.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column(at).cast(pa.large_binary()).fill_null(b"")
            yield batch.filter(pa.array(_scored(texts, model) >= THRESHOLD))

    return documents.mapInArrow(work, documents.schema)
