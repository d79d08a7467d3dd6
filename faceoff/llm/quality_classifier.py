"""Quality classifier: an SVM over n-gram indicators scaled by naive Bayes.

The n-grams are of bytes (2 to 4) over the text's words, a word equal to the one
before it written as a mark, hashed to ``BUCKETS``.  Each indicator is scaled
by its log-count ratio of the classes, vectors are scaled to length one, and a
linear hinge-loss model is fitted by dual coordinate descent.  A part of the
sample is left out of that fit and turns margins into probabilities.

The fit sees at most ``MAX_FIT_ROWS`` labelled rows (a documented bound), in one
task; every document is scored, whole, in map tasks.

Defined results: null and empty texts have no n-grams and score what the
bias says; without labels of both kinds every score is the share of ones
(0.5 without labels); an empty table gives an empty result; rows are scored one by
one; extra columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faceoff.llm.common import sample_labelled

MAX_FIT_ROWS = 8192
BUCKETS = 1 << 18
GRAMS = (2, 3, 4)
EPOCHS = 10
COST = 1.0
_REPEAT = b"\x01"
_SCRATCH = np.zeros(BUCKETS, bool)


def indicators(text: str | None) -> np.ndarray:
    """Sorted buckets of the n-grams in a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    stream = b" ".join([_REPEAT if a == b else a for a, b in zip(words, [None, *words])])
    data = np.frombuffer(b" " + stream + b" ", np.uint8).astype(np.uint32)
    if not words:
        return np.zeros(0, np.int32)
    code = data + np.uint32(1)
    for n in range(2, max(GRAMS) + 1):
        if len(data) < n:
            break
        code = code[:-1] * np.uint32(0x01000193) ^ data[n - 1 :]
        if n in GRAMS:
            _SCRATCH[(code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 18)] = True
    found = np.flatnonzero(_SCRATCH).astype(np.int32)
    _SCRATCH[found] = False
    return found


def descend(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: np.ndarray, epochs: int = EPOCHS):
    """Weights and bias of the L2-regularised hinge loss by dual coordinate descent; y is -1 or 1."""
    norm = [max(1e-6, float(np.sqrt((scale[r] ** 2).sum()))) for r in rows]
    values = [scale[r] / n for r, n in zip(rows, norm)]
    weight, bias, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    square = np.array([float(v @ v) + 1.0 for v in values])
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            gradient = y[k] * (float(weight[rows[k]] @ values[k]) + bias) - 1
            new = min(max(alpha[k] - gradient / square[k], 0.0), cost[k])
            step = (new - alpha[k]) * y[k]
            if step:
                alpha[k] = new
                weight[rows[k]] += step * values[k]
                bias += step
    return weight, bias


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of the logistic curve through (margin, 0/1), by Newton steps."""
    up, down = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    x, theta = np.stack([margin, np.ones(len(margin))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta = theta + np.linalg.solve(h, x.T @ (target - p) - 1e-3 * theta)
    return max(float(theta[0]), 0.0), float(theta[1])


class Classifier:
    """Scores from the indicators of a text."""

    def __init__(self, rows: list[np.ndarray], labels: np.ndarray):
        y = labels.astype(int)
        self.constant = float(y.mean()) if len(y) else 0.5
        if len(set(y.tolist())) < 2:
            return
        self.constant = None
        learn = np.arange(len(y)) % 4 != 3 if min(y.sum(), (1 - y).sum()) >= 8 else np.ones(len(y), bool)
        counts = np.ones((2, BUCKETS))
        for r, k, used in zip(rows, y, learn):
            if used:
                counts[k][r] += 1
        ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
        share = np.array([(y[learn] == k).mean() for k in (0, 1)])
        cost = COST / (2 * np.maximum(share, 1e-3))[y[learn]]  # both classes weigh the same
        weight, self.bias = descend([r for r, u in zip(rows, learn) if u], ratio, 2 * y[learn] - 1, cost)
        self.weight, self.square = (weight * ratio).astype(np.float32), (ratio**2).astype(np.float32)
        held = ~learn if (~learn).any() else learn
        margins = np.array([self.margin(r) for r, u in zip(rows, held) if u])
        self.slope, self.offset = platt(margins, y[held])

    def margin(self, found: np.ndarray) -> float:
        if not len(found):
            return self.bias
        length = np.sqrt(max(float(self.square[found].sum(dtype=np.float64)), 1e-12))
        return float(self.weight[found].sum(dtype=np.float64)) / length + self.bias

    def score(self, text: str | None) -> float:
        if self.constant is not None:
            return self.constant
        z = self.slope * self.margin(indicators(text)) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_rows: int = MAX_FIT_ROWS) -> Classifier:
    """The classifier of at most ``max_rows`` labelled rows outside the held-out fold."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [indicators(t).tobytes() for t in rows.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), rows.column(1)], names=["found", "label"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((f, k) for b in batches for f, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        shuffled = np.random.default_rng(11).permutation(len(rows))
        model = Classifier([np.frombuffer(rows[i][0], np.int32) for i in shuffled], np.array([rows[i][1] for i in shuffled], int))
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)]})

    sample = sample_labelled(docs, labels, label_col, max_rows, id_col, text_col).select("text", "label")
    made = sample.mapInArrow(features, "found binary, label int").repartition(1).mapInArrow(learn, "model binary").first()
    return pickle.loads(bytes(made["model"])) if made else Classifier([], np.zeros(0, int))


def score(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            scores = [shared.value.score(t) for t in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(scores, pa.float64())], names=[id_col, "score"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)
