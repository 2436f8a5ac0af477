"""Quality classifier: a factorisation machine.

Inputs of a text are its hashed lower-cased words (square root of the share
of each) and standardised structure statistics and sizes.  The score is

    bias + sum w_i x_i + 1/2 sum_f [(sum v_if x_i)^2 - sum v_if^2 x_i^2]

through a logistic: all pairwise interactions in time linear in the number of
inputs, by the sum-of-squares identity.

Defined results: null and empty texts have structure inputs only; labels that
are null, or without a document, are left out; several labels of one document
count as the lowest; with labels of one class only, or none, the score is the
share of label 1 (0.5 without any).  Extra columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from basinflow.llm import quality_rules
from basinflow.llm import textops as T
from basinflow.llm.store import batch_rows, cut

WORD_BITS = 16
WORDS = 1 << WORD_BITS
SAMPLE_ROWS = 8000       # labelled rows that the model is fitted on
SIZES = ["log_bytes", "log_words"]
DENSE = quality_rules.RATIOS + SIZES


def word_inputs(data, offs):
    """(row, hashed word, square root of its share) of each distinct word."""
    low = T.lower_ascii(data)
    s, e, first = T.words(low, offs)
    n = np.diff(first)
    h = (T.hash_spans(low, s, e) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    key, count = np.unique(T.rows_of(n) << WORD_BITS | h, return_counts=True)
    row = key >> WORD_BITS
    return row, key & (WORDS - 1), np.sqrt(count / n[row])


def dense_inputs(data, offs) -> np.ndarray:
    st = quality_rules.statistics(data, offs)
    cols = [st[c] for c in quality_rules.RATIOS] + [np.log1p(np.diff(offs)), np.log1p(st["n_words"])]
    return np.stack(cols, 1).astype(np.float64) if len(offs) > 1 else np.zeros((0, len(DENSE)))


@dataclass
class FactorMachine:
    bias: float
    w: np.ndarray       # WORDS + len(DENSE)
    v: np.ndarray       # the same rows, one column a factor
    mean: np.ndarray
    scale: np.ndarray

    def standard(self, dense):
        return np.clip((dense - self.mean) / self.scale, -5, 5)

    def logits(self, row, word, x, dense):
        n = len(dense)
        z = self.bias + dense @ self.w[WORDS:] + np.bincount(row, self.w[word] * x, n)
        for f in range(self.v.shape[1]):
            a = self.v[word, f] * x
            d = dense * self.v[WORDS:, f]
            total = np.bincount(row, a, n) + d.sum(1)
            z += 0.5 * (total ** 2 - np.bincount(row, a * a, n) - (d * d).sum(1))
        return z

    def scores(self, data, offs):
        z = self.logits(*word_inputs(data, offs), self.standard(dense_inputs(data, offs)))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(row, word, x, dense, y, factors=8, epochs=12, batch=64, rate=0.02, l2=1e-4, seed=7) -> FactorMachine:
    """Adam on the logistic loss over mini-batches in a seeded order; rows of
    the batch only are touched."""
    rng = np.random.default_rng(seed)
    n = len(y)
    mean, scale = dense.mean(0), dense.std(0) + 1e-6
    fm = FactorMachine(float(np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))), np.zeros(WORDS + len(DENSE)),
                       rng.normal(0, 0.02, (WORDS + len(DENSE), factors)), mean, scale)
    dense = fm.standard(dense)
    bounds = np.searchsorted(row, np.arange(n + 1))
    params = np.concatenate([fm.w[:, None], fm.v], 1)
    m1, m2 = np.zeros_like(params), np.zeros_like(params)
    step, dense_at = 0, WORDS + np.arange(len(DENSE))
    for _ in range(epochs):
        order = rng.permutation(n)
        for k in range(0, n, batch):
            rows = order[k:k + batch]
            size = bounds[rows + 1] - bounds[rows]
            take = np.arange(size.sum()) + np.repeat(bounds[rows] - (np.cumsum(size) - size), size)
            r = np.concatenate([T.rows_of(size), np.repeat(np.arange(len(rows)), len(DENSE))])
            f = np.concatenate([word[take], np.tile(dense_at, len(rows))])
            xv = np.concatenate([x[take], dense[rows].ravel()])
            p = params[f]
            a = p[:, 1:] * xv[:, None]
            total = np.stack([np.bincount(r, a[:, c], len(rows)) for c in range(factors)], 1)
            squares = np.bincount(r, (a * a).sum(1), len(rows))
            z = fm.bias + np.bincount(r, p[:, 0] * xv, len(rows)) + 0.5 * ((total ** 2).sum(1) - squares)
            g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[rows]) / len(rows)
            uniq, inv = np.unique(f, return_inverse=True)
            gx = g[r] * xv
            grads = np.concatenate([gx[:, None], gx[:, None] * (total[r] - a)], 1)
            gu = np.stack([np.bincount(inv, grads[:, c], len(uniq)) for c in range(factors + 1)], 1) + l2 * params[uniq]
            step += 1
            m1[uniq] = 0.9 * m1[uniq] + 0.1 * gu
            m2[uniq] = 0.99 * m2[uniq] + 0.01 * gu * gu
            params[uniq] -= rate * m1[uniq] / (np.sqrt(m2[uniq]) + 1e-6)
            fm.bias -= rate * g.sum()
    fm.w, fm.v = np.ascontiguousarray(params[:, 0]), np.ascontiguousarray(params[:, 1:])
    return fm


_INPUTS = StructType([StructField("word", ArrayType(IntegerType())), StructField("x", ArrayType(FloatType())),
                      StructField("dense", ArrayType(DoubleType()))])


@F.arrow_udf(_INPUTS)
def _inputs_udf(text: pa.Array) -> pa.Array:
    counts, words, xs, dense = [], [np.zeros(0, np.int64)], [np.zeros(0)], []
    for _, _, data, offs in T.text_slices(text):
        row, word, x = word_inputs(data, offs)
        counts.append(np.bincount(row, minlength=len(offs) - 1))
        words.append(word)
        xs.append(x)
        dense.append(dense_inputs(data, offs))
    ends = pa.array(np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *counts]))]), pa.int32())
    flat = np.concatenate(dense).ravel() if dense else np.zeros(0)
    return pa.StructArray.from_arrays([
        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(words), pa.int32())),
        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(xs), pa.float32())),
        pa.ListArray.from_arrays(pa.array(np.arange(len(text) + 1) * len(DENSE), pa.int32()), pa.array(flat)),
    ], ["word", "x", "dense"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS, **how) -> FactorMachine:
    """Fit on a bounded sample of labelled rows outside the held-out fold; the
    inputs of at most ``rows`` documents reach the driver."""
    batch_rows(docs.sparkSession)
    sample = cut(quality_rules.labelled_sample(docs, labels, label, rows), "labelled")
    got = sample.select("doc_id", "y", _inputs_udf("text").alias("in")).select("doc_id", "y", "in.*").toPandas()
    got = got[got["y"].isin([0, 1])].sort_values("doc_id", kind="stable")
    y = got["y"].to_numpy(np.float64)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1e-4) / (len(y) + 2e-4)
        k = len(DENSE)
        return FactorMachine(float(np.log(share / (1 - share))), np.zeros(WORDS + k), np.zeros((WORDS + k, 1)),
                             np.zeros(k), np.ones(k))
    row = np.repeat(np.arange(len(got)), got["word"].map(len))
    word, x = (np.concatenate([np.asarray(a, t) for a in got[c]]) for c, t in (("word", np.int64), ("x", np.float64)))
    return train(row, word, x, np.stack([np.asarray(d) for d in got["dense"]]), y, **how)
