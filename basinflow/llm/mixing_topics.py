"""Topics of documents, for a mixture over tables without a topic column.

A document is the set of its longer words, hashed to ``FEATURES`` groups and
weighted by inverse document frequency.  Topics are centroids of such vectors:
they begin as the company of anchor words (frequent, informative and least
alike in what they occur with) and are moved by spherical k-means, every
document going to the centroid of the largest dot product.

Every count is taken over all documents, in whole numbers, so the result does
not depend on how they are partitioned.  Tasks add up their documents' counts
and yield one table of fixed size; what reaches the driver (frequencies, company
of the candidates, centroids) has at most ``topics * FEATURES`` or
``CANDIDATES * FEATURES`` cells, whatever the size of the corpus.

Defined results: a text that is null, empty or without a weighted word has no
topic (null).  Ties go to the lowest topic.  Repeated rows count each.  A corpus
with fewer anchors than topics leaves the last topics empty.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from basinflow.llm import textops as T
from basinflow.llm.store import batch_rows, cut

WORD_BYTES = 6
FEATURES = 8192         # fits two bytes
CANDIDATES = 32
ROUNDS = 2
_DENSE_ROWS = 256
_UNIT = 1 << 16


@dataclass(frozen=True)
class Topics:
    """``weight`` (FEATURES) and ``centre`` (topics x FEATURES), whole numbers."""
    weight: np.ndarray
    centre: np.ndarray

    def of(self, row: np.ndarray, feature: np.ndarray, rows: int) -> np.ndarray:
        """Topic of each of ``rows`` documents, -1 where none is."""
        best = np.full(rows, -1, np.int64)
        if not len(row) or not len(self.centre):
            return best
        at = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        score = np.add.reduceat((self.centre[:, feature] * self.weight[feature]), at, axis=1)
        top = score.argmax(0)
        best[row[at]] = np.where(score.max(0) > 0, top, -1)
        return best


def features(low: np.ndarray, s: np.ndarray, e: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature), distinct and in order, of the words of lower-cased texts."""
    long = e - s >= WORD_BYTES
    h = (T.hash_spans(low, s[long], e[long]) % np.uint64(FEATURES)).astype(np.int64)
    key = np.unique(T.rows_of(per)[long] * FEATURES + h)
    return key // FEATURES, key % FEATURES


def _features_udf():
    def packed(text: pa.Array) -> pa.Array:
        out = []
        for _, _, data, offs in T.text_slices(text):
            low = T.lower_ascii(data)
            s, e, first = T.words(low, offs)
            row, f = features(low, s, e, np.diff(first))
            ends = np.searchsorted(row, np.arange(len(offs)))
            raw = f.astype("<u2").tobytes()
            out += [raw[2 * a:2 * b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pa.array(out, pa.binary())
    return F.arrow_udf(packed, BinaryType()).asNondeterministic()


def _unpacked(column) -> tuple[np.ndarray, np.ndarray, int]:
    raw = column.to_pylist()
    row = T.rows_of(np.array([len(x) // 2 for x in raw], np.int64))
    return row, np.frombuffer(b"".join(raw), "<u2").astype(np.int64), len(raw)


def _added(vectors: DataFrame, size: int, count) -> np.ndarray:
    """``count(row, feature, rows)`` of all batches added up: whole numbers in
    a table of ``size`` cells, one table a task."""
    def task(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            total += count(*_unpacked(b.column(0)))
        key = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(total[key], pa.int64())], ["cell", "n"])
    out = np.zeros(size, np.int64)
    cells = vectors.select("f").mapInArrow(task, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    for r in cells.collect():      # at most ``size`` rows
        out[r["cell"]] = r["n"]
    return out


def _frequencies(row, feature, rows):
    return np.append(np.bincount(feature, minlength=FEATURES), rows)


def _company(anchors: np.ndarray):
    """Documents that hold each anchor together with each feature."""
    def count(row, feature, rows):
        total = np.zeros((len(anchors), FEATURES), np.int64)
        for a in range(0, rows, _DENSE_ROWS):
            i, j = np.searchsorted(row, [a, a + _DENSE_ROWS])
            x = np.zeros((_DENSE_ROWS, FEATURES), np.float32)
            x[row[i:j] - a, feature[i:j]] = 1
            total += (x[:, anchors].T @ x).astype(np.int64)
        return total.ravel()
    return count


def _moved(model: Topics):
    """Sum of the unit vectors of each topic's documents."""
    def count(row, feature, rows):
        topic = model.of(row, feature, rows)
        w = model.weight[feature]
        norm = np.sqrt(np.bincount(row, w * w, rows))
        use = (topic[row] >= 0) & (w > 0)
        unit = np.rint(w[use] * _UNIT / norm[row[use]])
        return np.bincount(topic[row[use]] * FEATURES + feature[use], unit, model.centre.size).astype(np.int64)
    return count


def _centres(profile: np.ndarray) -> np.ndarray:
    norm = np.sqrt((profile.astype(np.float64) ** 2).sum(1, keepdims=True))
    return np.rint(np.divide(profile * float(_UNIT), norm, out=np.zeros(profile.shape), where=norm > 0)).astype(np.int64)


def _spread(profiles: np.ndarray, topics: int) -> list[int]:
    """The first profile, then always the one least like those chosen."""
    unit = _centres(profiles) / _UNIT
    like = np.round(unit @ unit.T, 9)
    chosen = [0]
    while len(chosen) < min(topics, len(profiles)):
        nearest = like[:, chosen].max(1)
        nearest[chosen] = np.inf
        chosen.append(int(nearest.argmin()))
    return chosen


def fit_topics(docs: DataFrame, topics: int, text_col: str = "text", rounds: int = ROUNDS) -> Topics:
    """Topics of all documents of ``docs``."""
    batch_rows(docs.sparkSession)
    vectors = cut(docs.select(_features_udf()(F.col(text_col)).alias("f")).where(F.length("f") > 0), "topics")
    counted = _added(vectors, FEATURES + 1, _frequencies)
    df, n = counted[:-1], int(counted[-1])
    weight = np.where(df >= 2, np.rint(64 * np.log2(max(n, 1) / np.maximum(df, 1))), 0).astype(np.int64)
    mass = df * weight * weight
    anchors = np.argsort(-mass, kind="stable")[:CANDIDATES]
    anchors = anchors[mass[anchors] > 0]
    if not len(anchors):
        return Topics(weight, np.zeros((0, FEATURES), np.int64))
    company = _added(vectors, len(anchors) * FEATURES, _company(anchors)).reshape(-1, FEATURES) * weight
    model = Topics(weight, _centres(company[_spread(company, topics)]))
    for _ in range(rounds):
        sums = _added(vectors, model.centre.size, _moved(model)).reshape(model.centre.shape)
        kept = sums.any(1, keepdims=True)
        model = Topics(weight, np.where(kept, _centres(sums), model.centre))
    return model

