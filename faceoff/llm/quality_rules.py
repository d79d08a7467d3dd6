"""Quality rules: base rules, then gradient-boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled rows and kept as flat numpy
node arrays, so a task scores a batch with a few gathers a level.  For the
features in ``MONOTONE`` the score never rises as the feature grows.

Defined results: null or empty text has no words and fails the base rules;
without labels of both kinds there are no trees and the base rules
decide alone; an empty table gives an empty result; rows are judged one by one, so
repeats are alike; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faceoff.llm.common import sample_labelled

# Documented bound of the fit: labelled rows, taken by hash of their id.
MAX_FIT_ROWS = 8192
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
KEEP_FROM = 0.3
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share",
            "mark_share", "distinct_share", "words_per_line", "next_equal_share", "line_end_share")
# -1: the score may not rise with the feature
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "next_equal_share": -1}
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b"!?~^_=+@\\{}[]"


def _repeated(ids: np.ndarray, size: int = REPEAT_WINDOW) -> int:
    """Words inside a window of ``size`` words that occurs twice or more."""
    n = len(ids) - size + 1
    if n < 2:
        return 0
    key = ids[:n].astype(np.int64)
    for k in range(1, size):  # exact: pairs are ranked again before they could overflow
        top = int(ids.max()) + 1
        if int(key.max()) >= (1 << 62) // top:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key * top + ids[k : k + n]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(twice)
    cover[at] += 1
    np.add.at(cover, at + size, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """(the BASE counts, the FEATURES) of a whole text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words, seen = data.split(), {}
    n, n_bytes = len(words), max(1, len(data))
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    without = lambda chars: len(data) - len(data.translate(None, chars))
    word_chars = len(text) - without(SPACES)
    lines = [x for x in data.split(b"\n") if x.strip(SPACES)]
    symbols, dup, repeats = without(SYMBOLS), len(lines) - len(set(lines)), _repeated(ids)
    share = lambda x, of: x / of if of else 0.0
    ends = sum(x.rstrip(SPACES)[-1:] in b".!?" for x in lines)
    return [n, word_chars, symbols, dup, repeats], [
        float(np.log1p(n)), share(word_chars, n), symbols / n_bytes, share(dup, len(lines)), share(repeats, n),
        without(_UPPER) / n_bytes, without(_DIGITS) / n_bytes, without(_MARKS) / n_bytes, share(len(seen), n),
        share(n, len(lines)), share(int((ids[1:] == ids[:-1]).sum()), n), share(ends, len(lines)),
    ]


@dataclass
class Trees:
    """Trees as node arrays (tree, node); a leaf's children are itself."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        trees, node = np.arange(len(self.feature)), np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(self.depth):
            feature = self.feature[trees, node]
            go = np.take_along_axis(x, feature, 1) <= self.threshold[trees, node]
            node = np.where(go, self.left[trees, node], self.right[trees, node])
        return self.base + self.value[trees, node].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x))) if len(x) else np.zeros(0)


def boost(x: np.ndarray, y: np.ndarray, signs: np.ndarray, n_trees: int = 60, depth: int = 3, rate: float = 0.15,
          bins: int = 64, l2: float = 1.0, least: float = 5.0) -> Trees:
    """Logistic boosting on binned features; ``signs`` holds -1, 0 or 1 per feature."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    coded = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    prior = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(prior / (1 - prior)))
    margin, size = np.full(len(y), base), 2 ** (depth + 1) - 1
    shape = (n_trees, size)
    out = Trees(base, np.zeros(shape, np.int64), np.full(shape, np.inf), np.tile(np.arange(size), (n_trees, 1)),
                np.tile(np.arange(size), (n_trees, 1)), np.zeros(shape), depth)
    for t in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        todo = [(0, np.arange(len(y)), -np.inf, np.inf)]
        while todo:
            node, rows, low, high = todo.pop()
            value = lambda a, b: np.clip(a / (b + l2), low, high)  # noqa: B023, E731
            total_g, total_h = g[rows].sum(), h[rows].sum()
            own = float(value(total_g, total_h))
            out.value[t, node] = rate * own
            gain = lambda a, b, v: a * v - 0.5 * (b + l2) * v * v
            best = (1e-6, None)
            if 2 * node + 2 < size:
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    code = coded[rows, f]
                    left_g = np.cumsum(np.bincount(code, g[rows], len(e) + 1))[:-1]
                    left_h = np.cumsum(np.bincount(code, h[rows], len(e) + 1))[:-1]
                    left_n = np.cumsum(np.bincount(code, minlength=len(e) + 1))[:-1]
                    lv, rv = value(left_g, left_h), value(total_g - left_g, total_h - left_h)
                    ok = (left_n >= least) & (len(rows) - left_n >= least) & (signs[f] * (rv - lv) >= 0)
                    won = gain(left_g, left_h, lv) + gain(total_g - left_g, total_h - left_h, rv) - gain(total_g, total_h, own)
                    won = np.where(ok, won, -np.inf)
                    k = int(won.argmax())
                    if won[k] > best[0]:
                        best = (float(won[k]), (f, k, float(lv[k]), float(rv[k])))
            if best[1] is None:
                margin[rows] += rate * own
                continue
            f, k, lv, rv = best[1]
            a, b, go = 2 * node + 1, 2 * node + 2, coded[rows, f] <= k
            out.feature[t, node], out.threshold[t, node] = f, edges[f][k]
            out.left[t, node], out.right[t, node] = a, b
            middle = (lv + rv) / 2
            lows, highs = ((low, middle), (middle, high)), ((middle, high), (low, middle))
            left, right = (lows if signs[f] > 0 else highs) if signs[f] else ((low, high), (low, high))
            todo += [(a, rows[go], *left), (b, rows[~go], *right)]
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_rows: int = MAX_FIT_ROWS) -> Trees | None:
    """Trees from at most ``max_rows`` labelled rows; None without both labels."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = [statistics(t)[1] for t in rows["text"]]
            yield pd.DataFrame(np.array(found).reshape(-1, len(FEATURES)), columns=FEATURES).assign(label=rows["label"].to_numpy())

    schema = ", ".join(f"{f} double" for f in FEATURES) + ", label int"
    rows = sample_labelled(docs, labels, label_col, max_rows, id_col, text_col).mapInPandas(measure, schema).toPandas()
    rows = rows.sort_values([*FEATURES, "label"])
    if rows["label"].nunique() < 2:
        return None
    signs = np.array([MONOTONE.get(f, 0) for f in FEATURES])
    return boost(rows[list(FEATURES)].to_numpy(float), rows["label"].to_numpy(float), signs)


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])


def _judged(texts: list, trees: Trees | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(BASE counts, base_failed, score) of each text."""
    found = [statistics(t) for t in texts]
    counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(BASE))
    score = np.ones(len(texts))
    if trees is not None:
        score = trees.probability(np.array([f for _, f in found]).reshape(-1, len(FEATURES)))
    return counts, base_failed(counts), score


def judge(docs: DataFrame, trees: Trees | None, id_col: str = "doc_id", text_col: str = "text",
          keep_from: float = KEEP_FROM) -> DataFrame:
    """(id, the BASE counts, base_failed, score, kept) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            counts, failed, value = _judged(rows.column(1).to_pylist(), shared.value)
            columns = [rows.column(0), *(pa.array(counts[:, k]) for k in range(len(BASE)))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(failed), pa.array(value), pa.array(~failed & (value >= keep_from))],
                names=[id_col, *BASE, "base_failed", "score", "kept"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, " + ", ".join(f"{c} long" for c in BASE)
    return docs.select(id_col, text_col).mapInArrow(score, schema + ", base_failed boolean, score double, kept boolean")


def keep(docs: DataFrame, trees: Trees | None, text_col: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """``docs`` without the rejected rows."""
    shared, text_at = docs.sparkSession.sparkContext.broadcast(trees), docs.columns.index(text_col)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            _, failed, value = _judged(rows.column(text_at).to_pylist(), shared.value)
            yield rows.filter(pa.array(~failed & (value >= keep_from)))

    return docs.mapInArrow(choose, docs.schema)
