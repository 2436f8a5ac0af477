"""Toxicity: a character n-gram linear classifier with naive Bayes features.

Each n-gram of the lower-cased text is hashed; a feature counts once per
document and is scaled by its naive Bayes log-count ratio between the two
classes.  A logistic regression on the scaled features gives the score.  Only
features with enough support and a ratio away from zero take part, so a long
clean text does not drift.

Defined results: null and empty texts have no feature and score the bias;
labels that are null, or without a document, are left out; several labels of
one document count as the lowest; with labels of one class only, or none, the
score is the share of label 1 (0.5 without any).  Extra columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from basinflow.llm import textops as T
from basinflow.llm.quality_rules import labelled_sample
from basinflow.llm.store import batch_rows, cut

ORDERS = (3, 4, 6)       # characters (bytes of the lower-cased text)
BITS = 18                # hashed feature space
SAMPLE_ROWS = 12000      # labelled rows that the model is fitted on
PARTS = 64               # slices of the class counts while they are added up


def hashed_ngrams(data: np.ndarray, offs: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of each n-gram that lies inside one document."""
    low = np.concatenate([T.lower_ascii(data), np.zeros(8, np.uint8)])
    lane = np.ndarray((len(data),), "<u8", low, strides=(1,))
    x = lane & np.uint64((1 << 8 * order) - 1)
    x += np.uint64(order)
    h = (T.mix64(x) >> np.uint64(64 - BITS)).astype(np.int64)
    n = np.maximum(np.diff(offs) - order + 1, 0)
    row = T.rows_of(n)
    at = np.arange(len(row)) + np.repeat(offs[:-1] - (np.cumsum(n) - n), n)
    return row, h[at]


def present(data, offs, wanted: np.ndarray | None = None) -> np.ndarray:
    """Sorted distinct ``row << BITS | feature``, of the wanted features."""
    keys = []
    for order in ORDERS:
        row, h = hashed_ngrams(data, offs, order)
        if wanted is not None:
            keep = wanted[h]
            row, h = row[keep], h[keep]
        keys.append(np.unique(row << BITS | h))
    return np.unique(np.concatenate(keys))


@dataclass
class NaiveBayesLinear:
    """``weight[f]`` is coefficient times ratio; 0 where f takes no part."""
    weight: np.ndarray
    bias: float

    def scores(self, data, offs) -> np.ndarray:
        key = present(data, offs, self.weight != 0)
        z = np.bincount(key >> BITS, self.weight[key & ((1 << BITS) - 1)], len(offs) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _class_counts(batches):
    """Documents of each class that hold each feature, in slices."""
    got = np.zeros((2, 1 << BITS), np.int64)
    for b in batches:
        y = b.column("y").to_numpy(zero_copy_only=False)
        for i, j, data, offs in T.text_slices(b.column("text")):
            key = present(data, offs)
            f, c = key & ((1 << BITS) - 1), y[i:j][key >> BITS]
            for k in (0, 1):
                got[k] += np.bincount(f[c == k], minlength=1 << BITS)
    for p, part in enumerate(np.split(got, PARTS, axis=1)):
        if part.any():
            yield pa.RecordBatch.from_pydict({"part": pa.array([p], pa.int32()), "counts": [part.tobytes()]})


def _add_counts(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist())
    return pa.table({"part": table.column("part")[:1], "counts": pa.array([total.tobytes()], pa.binary())})


def class_counts(sample: DataFrame) -> np.ndarray:
    schema = "part int, counts binary"
    rows = (sample.select("text", "y").mapInArrow(_class_counts, schema)
            .groupBy("part").applyInArrow(_add_counts, schema).collect())   # PARTS rows at most
    out = np.zeros((PARTS, 2, (1 << BITS) // PARTS), np.int64)
    for r in rows:
        out[r["part"]] = np.frombuffer(r["counts"], np.int64).reshape(2, -1)
    return out.transpose(1, 0, 2).reshape(2, -1)


def log_count_ratio(counts: np.ndarray, totals: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    p = (counts[1] + smooth) / (totals[1] + 2 * smooth)
    q = (counts[0] + smooth) / (totals[0] + 2 * smooth)
    return np.log(p / q)


def _features_udf(wanted: np.ndarray):
    def features(text: pa.Array) -> pa.Array:
        counts, parts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, _, data, offs in T.text_slices(text):
            key = present(data, offs, wanted)
            counts.append(np.bincount(key >> BITS, minlength=len(offs) - 1))
            parts.append(key & ((1 << BITS) - 1))
        ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts), pa.int32()))
    return F.arrow_udf(features, ArrayType(IntegerType()))


def logistic(rows, feats, ratio, y, l2=1.0, steps=200):
    """Coefficients of the scaled binary features, by Nesterov's method."""
    n = len(y)
    x = ratio[feats]
    w, b = np.zeros(len(ratio)), np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))
    vw, vb = w.copy(), b
    rate = 4.0 / (1 + np.bincount(rows, x * x, n).max() + l2 / n)
    for k in range(steps):
        z = np.bincount(rows, x * vw[feats], n) + vb
        g = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        gw = np.bincount(feats, x * g[rows], len(ratio)) / n + l2 * vw / n
        nw, nb = vw - 8 * rate * gw, vb - rate * g.mean()
        m = k / (k + 3)
        vw, vb, w, b = nw + m * (nw - w), nb + m * (nb - b), nw, nb
    return w, b


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS, min_docs: int = 5,
        min_ratio: float = 1.0, l2: float = 0.5) -> NaiveBayesLinear:
    """Fit on a bounded sample of labelled rows outside the held-out fold.

    ``min_ratio`` is the least size of a feature's log-count ratio.  What
    reaches the driver: the class counts (2**BITS features) and the chosen
    features of at most ``rows`` documents."""
    batch_rows(docs.sparkSession)
    sample = cut(labelled_sample(docs, labels, label, rows), "labelled")
    totals = np.zeros(2, np.int64)
    for r in sample.groupBy("y").count().where("y in (0, 1)").collect():
        totals[r["y"]] = r["count"]
    none = np.zeros(1 << BITS)
    if totals.min() == 0:
        share = (totals[1] + 1e-4) / (totals.sum() + 2e-4)
        return NaiveBayesLinear(none, float(np.log(share / (1 - share))))
    counts = class_counts(sample)
    ratio = log_count_ratio(counts, totals)
    ratio[(counts.sum(0) < min_docs) | (np.abs(ratio) < min_ratio)] = 0
    got = sample.select("doc_id", "y", _features_udf(ratio != 0)("text").alias("f")).toPandas()
    got = got.sort_values("doc_id", kind="stable")
    feats = np.concatenate([np.asarray(f, np.int64) for f in got["f"]])
    r = np.repeat(np.arange(len(got)), got["f"].map(len))
    w, b = logistic(r, feats, ratio, got["y"].to_numpy(np.float64), l2)
    return NaiveBayesLinear(w * ratio, float(b))


def score_column(model, text: Column) -> Column:
    """Probability of label 1 for each whole text, by ``model.scores``."""
    def scores(col: pa.Array) -> pa.Array:
        parts = [model.scores(data, offs) for _, _, data, offs in T.text_slices(col)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())
    return F.arrow_udf(scores, DoubleType()).asNondeterministic()(text)


def with_score(docs: DataFrame, model, text_col: str = "text", into: str = "score") -> DataFrame:
    batch_rows(docs.sparkSession)
    return docs.withColumn(into, score_column(model, F.col(text_col)))
