"""Quality scores by Bradley-Terry pairwise ranking.

A document's strength is a linear function of features of its own text. The
weights come from preference pairs, one document of label 1 and one of label 0,
by the logistic loss on the difference of their features. The threshold is a
quantile of the strengths of the labelled sample.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.llm.frames import crc, per_batch
from rainledger.llm.labelled import sample

#: Labelled rows that the weights are fitted on at most, and preference pairs.
FIT_ROWS, FIT_PAIRS = 20_000, 60_000

_KINDS = np.zeros(256, np.uint8)
_KINDS[[*range(65, 91)]] = 1
_KINDS[[*range(97, 123), *range(128, 256)]] = 2
_KINDS[[*range(48, 58)]] = 3
_KINDS[[32, 9, 10, 11, 12, 13]] = 4
for _k, _set in enumerate((b".,;:", b"!?", b"|<>{}[]\\/=_", b"#$%&*@~^+", b"\"'()-"), 5):
    _KINDS[[*_set]] = _k
FEATURES = 10 + 16


def features(text: str) -> np.ndarray:
    """Shares of kinds of bytes, and how words and lines repeat; zeros for an empty text apart from what tells that it's empty."""
    out = np.zeros(FEATURES, np.float64)
    raw = text.encode()
    if raw:
        out[:10] = np.bincount(_KINDS[np.frombuffer(raw, np.uint8)], minlength=10)[:10] / len(raw)
    words = text.split()
    n = len(words)
    out[10] = np.log1p(len(raw))
    out[11] = float(not n)
    if n:
        counts = Counter(words)
        lines = [x for x in text.split("\n") if x.strip()]
        top = counts.most_common(3)
        out[12] = len(counts) / n
        out[13] = top[0][1] / n
        out[14] = sum(c for _, c in top) / n
        out[15] = sum(a == b for a, b in zip(words, words[1:])) / n
        out[16] = len(raw) / n / 16
        out[17] = sum(w.isupper() for w in words) / n
        out[18] = len(set(lines)) / max(len(lines), 1)
        out[19] = min(len(lines) / n, 1)
        out[20] = sum(c == 1 for c in counts.values()) / n
        out[21] = len(zlib.compress(raw, 1)) / len(raw)
        out[22] = np.log1p(n) * out[12]
        out[23] = sum(len(w) > 20 for w in words) / n
        out[24] = sum(not w.isalpha() for w in words) / n
        out[25] = len(set(zip(words, words[1:], words[2:]))) / max(n - 2, 1)
    return out


def widened(x: np.ndarray) -> np.ndarray:
    """Features with the squares of those that are shares, so that a strength may fall on either side of a usual value."""
    return np.hstack([x, x * x])


def fit(x: np.ndarray, y: np.ndarray, pairs: int = FIT_PAIRS, ridge: float = 1e-3, seed: int = 11) -> tuple[np.ndarray, float]:
    """Weights over widened features, and the strength at the quantile of label 0's share.

    Without documents of both labels the weights are 0 and so is the threshold.
    """
    x = widened(x)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    weights = np.zeros(x.shape[1])
    if not len(good) or not len(bad):
        return weights, 0.0
    middle, scale = x.mean(0), x.std(0) + 1e-6
    z = (x - middle) / scale
    dice = np.random.default_rng(seed)
    difference = z[dice.choice(good, pairs)] - z[dice.choice(bad, pairs)]
    for _ in range(25):  # Newton steps of a convex loss
        p = 1 / (1 + np.exp(np.clip(difference @ weights, -30, 30)))
        slope = difference.T @ p / pairs - ridge * weights
        curve = (difference * (p * (1 - p))[:, None]).T @ difference / pairs + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    weights = weights / scale
    strength = x @ weights
    low, high = np.quantile(strength, len(bad) / len(y) - 0.5 / len(y)), np.quantile(strength, len(bad) / len(y) + 0.5 / len(y))
    return weights, float((low + high) / 2)


def score(x: np.ndarray, weights: np.ndarray, threshold: float, at: float) -> np.ndarray:
    """Strengths as probabilities, with `at` where the strength is the threshold."""
    return 1 / (1 + np.exp(-np.clip(widened(x) @ weights - threshold, -30, 30)) * (1 - at) / at)


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held_out: int = 2, at: float = 0.7, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 if score >= at) of each row of docs.

    Weights are fitted on at most fit_rows labelled rows of the other folds
    (a bounded sample by design); everything else covers all rows. A score
    depends on nothing but the text: null counts as empty, and equal texts
    have equal scores. Rows without an id are scored and are in no held-out
    fold. Without labels of both kinds each score is `at`. Repeated rows stay;
    other columns aren't read; an empty table gives no rows.
    """

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([features(x) for x in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column("label"), pa.array(list(found), pa.list_(pa.float64()))], ["label", "x"])

    fitted = sample(docs, labels, label, folds, held_out, fit_rows, id_col, text_col)
    known = per_batch(fitted.select("label", "text"), rows, "label int, x array<double>").toPandas()
    x = np.array(known.x.tolist()) if len(known) else np.zeros((0, FEATURES))
    order = np.lexsort([*x.T, known.label.to_numpy()])  # the same in whatever order the rows come
    weights, threshold = fit(x[order], known.label.to_numpy()[order])

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([features(x or "") for x in batch.column("text").to_pylist()])
        value = score(found, weights, threshold, at)
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(value), pa.array((value >= at).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = F.coalesce(crc(F.col(id_col)) % folds == held_out, F.lit(False))
    return per_batch(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), out.alias("held_out")), scored, f"doc_id {kind}, held_out boolean, score double, predicted int")
