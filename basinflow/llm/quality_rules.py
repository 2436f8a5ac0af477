"""Quality rules: learned decision lists over text statistics.

Sequential covering: a rule is a conjunction of thresholds on the statistics,
grown greedily by information gain on two thirds of the labelled rows, pruned
from its end on the rest, and kept while it is precise enough.  The rows it
covers leave, and the next rule is learned.  The list is emitted as one
ordered Spark ``CASE WHEN`` over the statistics.

Defined results: a null text is an empty one (all statistics 0).  Labels that
are null, or whose document is missing, are left out; several labels of one
document count as the lowest.  With no usable label of either class the list
is empty and only the base rule decides.  Repeated rows are judged alike, each
on its own.  Other columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from basinflow.llm import textops as T
from basinflow.llm.store import batch_rows

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = ["symbol_ratio", "dup_line_ratio", "repeat_ratio", "upper_ratio", "digit_ratio",
          "mark_ratio", "mean_word_chars", "distinct_ratio", "words_per_line"]
FEATURES = ["n_words", *RATIOS]
_STATS = StructType([StructField(c, LongType()) for c in COUNTS] + [StructField(c, DoubleType()) for c in RATIOS])

SYMBOLS = b"#*$%&|<>"
SAMPLE_ROWS = 8000      # labelled rows that the list is learned from
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _table(members: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(members)] = True
    return t


_SYMBOL = _table(SYMBOLS)
_UPPER = _table(bytes(range(65, 91)))
_DIGIT = _table(bytes(range(48, 58)))
_MARK = _table(b"!?.,;:'\"()[]{}-_=+/\\~^@`") | _SYMBOL


def _per_row(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(np.flatnonzero(mask), offs))


def _repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    return twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys


def _salted(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    return T.mix64(h ^ ((row.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)))


def _lines(data, offs, word_starts):
    """Spans and rows of the lines that hold a word."""
    cut = np.flatnonzero(data == 10)
    # Unique: an empty text, or the end of one, starts where the next one does.
    s = np.unique(np.concatenate([offs[:-1], cut + 1]))
    row_s = np.minimum(np.searchsorted(offs, s, "right") - 1, len(offs) - 2)
    nxt = np.append(cut, len(data))
    e = np.minimum(nxt[np.searchsorted(nxt, s)], offs[row_s + 1])
    has = np.searchsorted(word_starts, e) > np.searchsorted(word_starts, s)
    return s[has], e[has], row_s[has]


def statistics(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offs) - 1
    s, e, first = T.words(data, offs)
    n_words = np.diff(first)
    row = T.rows_of(n_words)
    starts_cp = np.concatenate([[0], np.cumsum(T.code_points(data))])
    chars = starts_cp[e] - starts_cp[s]
    word_chars = np.bincount(row, chars, n).astype(np.int64)
    h = T.hash_spans(data, s, e)
    at, per = T.ngram_index(first, 3)
    g = T.ngrams(h, 3)
    again = at[_repeated(_salted(g[at], T.rows_of(per)))]
    covered = np.zeros(len(s) + 2, bool)
    for k in range(3):
        covered[again + k] = True
    ls, le, lrow = _lines(data, offs, s)
    lines = np.bincount(lrow, minlength=n)
    _, one = np.unique(_salted(T.hash_spans(data, ls, le), lrow), return_index=True)
    dup = lines - np.bincount(lrow[one], minlength=n)
    _, one = np.unique(_salted(h, row), return_index=True)
    distinct = np.bincount(row[one], minlength=n)
    out = {"n_words": n_words, "word_chars": word_chars, "n_symbols": _per_row(_SYMBOL[data], offs),
           "n_dup_lines": dup, "n_repeat_words": np.bincount(row[covered[:len(s)]], minlength=n)}
    w, c = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    out |= {"symbol_ratio": out["n_symbols"] / w, "dup_line_ratio": dup / np.maximum(lines, 1),
            "repeat_ratio": out["n_repeat_words"] / w, "upper_ratio": _per_row(_UPPER[data], offs) / c,
            "digit_ratio": _per_row(_DIGIT[data], offs) / c, "mark_ratio": _per_row(_MARK[data], offs) / c,
            "mean_word_chars": word_chars / w, "distinct_ratio": distinct / w,
            "words_per_line": n_words / np.maximum(lines, 1)}
    return out


@F.arrow_udf(_STATS)
def _statistics_udf(text: pa.Array) -> pa.Array:
    parts = [statistics(d, o) for _, _, d, o in T.text_slices(text)]
    names = COUNTS + RATIOS
    kinds = [pa.int64()] * len(COUNTS) + [pa.float64()] * len(RATIOS)
    cols = [pa.array(np.concatenate([p[c] for p in parts]) if parts else [], k) for c, k in zip(names, kinds)]
    return pa.StructArray.from_arrays(cols, names)


# Non-deterministic only for the planner: one evaluation a row, never copied
# into a pushed-down filter.
_statistics_udf = _statistics_udf.asNondeterministic()


def with_statistics(docs: DataFrame, text_col: str = "text", into: str = "stats") -> DataFrame:
    """``docs`` with one struct column of statistics of each whole text."""
    batch_rows(docs.sparkSession)
    return docs.withColumn(into, _statistics_udf(F.col(text_col)))


@dataclass(frozen=True)
class Condition:
    stat: str
    above: bool
    value: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, FEATURES.index(self.stat)]
        return v > self.value if self.above else v <= self.value

    def column(self, stats: str) -> Column:
        c = F.col(f"{stats}.{self.stat}")
        return c > F.lit(self.value) if self.above else c <= F.lit(self.value)

    def __str__(self):
        return f"{self.stat} {'>' if self.above else '<='} {self.value:.6g}"


def _covers(rule, x):
    m = np.ones(len(x), bool)
    for c in rule:
        m &= c.holds(x)
    return m


def _grow(x, y, max_conditions, n_thresholds):
    rule, live = [], np.ones(len(y), bool)
    while len(rule) < max_conditions and (~y[live]).any():
        p0, n0 = y[live].sum(), (~y[live]).sum()
        best, chosen = 1e-9, None
        for f, stat in enumerate(FEATURES):
            v = x[live, f]
            cuts = np.unique(np.quantile(v[y[live]], np.linspace(0, 1, n_thresholds)))
            cuts = np.unique(np.concatenate([cuts, np.quantile(v, np.linspace(0, 1, n_thresholds))]))
            pos, neg = np.sort(v[y[live]]), np.sort(v[~y[live]])
            lo_p, lo_n = np.searchsorted(pos, cuts, "right"), np.searchsorted(neg, cuts, "right")
            for above, p, n in ((False, lo_p, lo_n), (True, p0 - lo_p, n0 - lo_n)):
                gain = p * (np.log2((p + 1e-9) / (p + n + 1e-9)) - np.log2(p0 / (p0 + n0)))
                k = int(np.argmax(gain))
                if gain[k] > best:
                    best, chosen = gain[k], Condition(stat, above, float(cuts[k]))
        if chosen is None:
            break
        rule.append(chosen)
        live &= chosen.holds(x)
    return rule


def _prune(rule, x, y):
    def worth(r):
        m = _covers(r, x)
        p, n = y[m].sum(), (~y[m]).sum()
        return (p - n) / max(p + n, 1)
    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=rule)


def learn_rules(x: np.ndarray, reject: np.ndarray, max_rules: int = 16, max_conditions: int = 4,
                n_thresholds: int = 32, min_precision: float = 0.9, min_cover: int = 5) -> list[list[Condition]]:
    """Ordered conjunctions that cover rows to reject; ``x`` has FEATURES' order."""
    rules, left = [], np.arange(len(reject))
    turn = np.arange(len(reject)) % 3
    while len(rules) < max_rules:
        xl, yl, tl = x[left], reject[left], turn[left]
        grow = tl != 2
        if yl[grow].sum() < min_cover or not (~yl[grow]).any():
            break
        rule = _grow(xl[grow], yl[grow], max_conditions, n_thresholds)
        if rule and yl[~grow].any():
            rule = _prune(rule, xl[~grow], yl[~grow])
        m = _covers(rule, xl)
        if not rule or m.sum() < min_cover or yl[m].mean() < min_precision:
            break
        rules.append(rule)
        left = left[~m]
    return rules


def rules_column(rules, stats: str = "stats") -> Column:
    """Number of the first rule that rejects the row, from 1; 0 if none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        test = rule[0].column(stats)
        for c in rule[1:]:
            test = test & c.column(stats)
        out = F.when(test, k) if out is None else out.when(test, k)
    return F.lit(0) if out is None else out.otherwise(0)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, y) of at most ``rows`` labelled documents outside the held-out
    fold, chosen by a hash of their id; the one limit of the learning."""
    key = F.col("doc_id")
    chosen = (labels.where(key.isNotNull() & F.col(label).isNotNull() & (F.crc32(key.cast("string")) % 5 != 0))
              .groupBy("doc_id").agg(F.min(label).alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .select("doc_id", "text", F.col("y").cast("int").alias("y")))


def fit_rules(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, **how) -> list[list[Condition]]:
    """Learn from a bounded sample: at most ``rows`` rows of FEATURES reach
    the driver, as for any fitted model."""
    sample = with_statistics(labelled_sample(docs, labels, "quality", rows))
    got = sample.select("doc_id", "y", *[F.col(f"stats.{c}").cast("double").alias(c) for c in FEATURES]).toPandas()
    got = got.sort_values(["doc_id", *FEATURES], kind="stable")
    return learn_rules(got[FEATURES].to_numpy(np.float64).reshape(-1, len(FEATURES)), got["y"].to_numpy() == 0, **how)


def base_failed(stats: str = "stats") -> Column:
    n, r = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PERCENT * n)


def judge(docs: DataFrame, rules, text_col: str = "text", into: str = "verdict") -> DataFrame:
    """``docs`` with a struct: the statistics, ``rule``, ``base_failed``, ``kept``."""
    tmp = f"{into}_stats"
    while tmp in docs.columns:
        tmp += "_"
    out = with_statistics(docs, text_col, tmp)
    hit = rules_column(rules, tmp)
    return out.withColumn(into, F.struct(
        F.col(f"{tmp}.*"), hit.alias("rule"), base_failed(tmp).alias("base_failed"),
        (~base_failed(tmp) & (hit == 0)).alias("kept"))).drop(tmp)


def keep_good(docs: DataFrame, rules, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that neither the base rule nor the list rejects."""
    name = "verdict"
    while name in docs.columns:
        name += "_"
    return judge(docs, rules, text_col, name).where(F.col(f"{name}.kept")).drop(name)
