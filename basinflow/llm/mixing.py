"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells by their category in each dimension (source,
language, topic).  The expected sampled tokens of the cells are raked: scaled
in turn to every dimension's target shares, never above the tokens a cell
has, until the shares hold.  A document is then sampled with its cell's
probability (expected over present tokens) by a hash of its id.

Only cells move to the driver; there are at most the product of (targets + 1)
of them, checked before the work starts, whatever the size of the corpus.

Defined results: categories that are null or without a target share the cell
``(other)``, whose share is what the targets leave (its own share of the corpus
if they leave none, and then all shares are scaled to fit).  A target without
tokens is left out and the rest scaled up.  A text without a topic is in
``(other)``.  Null texts have no token and are sampled with their cell's probability; a cell without tokens has probability
1.  Repeated rows are sampled alike.  An empty table gives no row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from basinflow.llm import textops as T
from basinflow.llm.mixing_topics import Topics, features, fit_topics
from basinflow.llm.store import batch_rows

OTHER = "(other)"
MAX_CELLS = 1_000_000


def _tokens_topic_udf(model: Topics | None):
    def tokens_topic(text: pa.Array) -> pa.Array:
        n, best = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, _, data, offs in T.text_slices(text):
            low = T.lower_ascii(data)
            s, e, first = T.words(low, offs)
            per = np.diff(first)
            n.append(per)
            best.append(model.of(*features(low, s, e, per), len(per)) if model else np.full(len(per), -1))
        best = np.concatenate(best)
        return pa.StructArray.from_arrays([pa.array(np.concatenate(n), pa.int64()),
                                           pa.array(best, pa.int32(), mask=best < 0)], ["tokens", "topic"])
    schema = StructType([StructField("tokens", LongType()), StructField("topic", IntegerType())])
    return F.arrow_udf(tokens_topic, schema).asNondeterministic()


def tokens_and_topic(text: Column, model: Topics | None) -> Column:
    """Words of a whole text, and its topic (null: none)."""
    return _tokens_topic_udf(model)(text)


def rake(tokens: np.ndarray, shares: list[np.ndarray], budget: float, steps: int = 500, tol: float = 1e-9):
    """Expected sampled tokens per cell: each dimension's sums go to
    ``budget * share`` as far as no cell exceeds its ``tokens``."""
    x = tokens * (budget / max(tokens.sum(), 1e-300))
    for _ in range(steps):
        before = x
        for d, share in enumerate(shares):
            sums = x.sum(tuple(k for k in range(x.ndim) if k != d))
            f = np.divide(budget * share, sums, out=np.zeros_like(share), where=sums > 0)
            x = np.minimum(x * f.reshape([-1 if k == d else 1 for k in range(x.ndim)]), tokens)
        if np.abs(x - before).max(initial=0) <= tol * max(budget, 1):
            break
    return x


def _share(present: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Target shares over the categories (``(other)`` last) with tokens."""
    share = target.astype(np.float64).copy()
    share[-1] = max(0.0, 1 - share[:-1].sum())
    if share[-1] <= 1e-12:
        share[-1] = present[-1] / max(present.sum(), 1)
    share[present <= 0] = 0
    return share / share.sum() if share.sum() > 0 else share


def cell_columns(dims: dict[str, Column], targets: dict[str, dict]) -> dict[str, Column]:
    out = {}
    for name, col in dims.items():
        known = list(map(str, targets[name]))
        text = col.cast("string")
        out[name] = F.when(text.isin(known), text).otherwise(F.lit(OTHER)) if known else F.lit(OTHER)
    return out


def calibrate(cells: DataFrame, targets: dict[str, dict], fraction: float) -> list[tuple]:
    """(category of each dimension..., probability, weight) of each cell.

    ``cells`` has the dimensions and ``tokens``; ``fraction`` of all tokens is
    the budget.  ``weight`` is the cell's share sampled over its share held."""
    names = list(targets)
    bound = math.prod(len(t) + 1 for t in targets.values())
    if bound > MAX_CELLS:
        raise ValueError(f"{bound} cells exceed the bound of {MAX_CELLS}")
    index = {n: {c: k for k, c in enumerate([*map(str, targets[n]), OTHER])} for n in names}
    tokens = np.zeros([len(index[n]) for n in names])
    for r in cells.groupBy(*names).agg(F.sum("tokens").alias("tokens")).collect():    # at most ``bound`` rows
        tokens[tuple(index[n][r[n]] for n in names)] = r["tokens"] or 0
    shares = []
    for d, n in enumerate(names):
        present = tokens.sum(tuple(k for k in range(tokens.ndim) if k != d))
        shares.append(_share(present, np.array([*targets[n].values(), 0.0])))
    budget = fraction * tokens.sum()
    x = rake(tokens, shares, budget)
    p = np.divide(x, tokens, out=np.ones_like(x), where=tokens > 0)
    w = p * (tokens.sum() / x.sum() if x.sum() > 0 else 1.0)
    labels = [list(index[n]) for n in names]
    return [(*[labels[d][k] for d, k in enumerate(at)], float(p[at]), float(w[at])) for at in np.ndindex(*p.shape)]


def uniform(key: Column, seed: int) -> Column:
    """A fixed uniform number in [0, 1) of each key."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)


def mix(docs: DataFrame, targets: dict[str, dict], fraction: float, dims: dict[str, Column] | None = None,
        topics: int | None = None, id_col="doc_id", text_col="text", seed: int = 17, into: str = "mix") -> DataFrame:
    """``docs`` with a struct ``into``: the categories, tokens, weight,
    probability and ``sampled``.

    ``targets`` maps each dimension to its categories' shares; ``dims`` maps it
    to a column of ``docs`` (its own name by default; ``topic`` is learned from
    the texts of ``docs`` if ``topics`` is given, see ``mixing_topics``)."""
    spark = docs.sparkSession
    batch_rows(spark)
    tmp = "mix_input"
    while tmp in docs.columns or tmp == into:
        tmp += "_"
    model = fit_topics(docs, topics, text_col) if topics else None
    made = docs.withColumn(tmp, tokens_and_topic(F.col(text_col), model))
    dims = dict(dims or {})
    for n in targets:
        dims.setdefault(n, F.col(f"{tmp}.topic") if n == "topic" and topics else F.col(n))
    cols = cell_columns(dims, targets)
    cells = made.select(*[c.alias(n) for n, c in cols.items()], F.col(f"{tmp}.tokens").alias("tokens"))
    names = list(targets)
    table = calibrate(cells.select(*names, "tokens"), targets, fraction)
    schema = ", ".join(f"_{k} string" for k in range(len(names))) + ", _p double, _w double"
    found = F.broadcast(spark.createDataFrame(table, schema))     # as many rows as cells, bounded above
    keyed = made.withColumn(tmp, F.struct(F.col(f"{tmp}.tokens").alias("tokens"), *[cols[n].alias(n) for n in names]))
    out = keyed.join(found, [F.col(f"{tmp}.{n}") == F.col(f"_{k}") for k, n in enumerate(names)], "left")
    return out.withColumn(into, F.struct(
        f"{tmp}.*", F.col("_w").alias("weight"), F.col("_p").alias("probability"),
        (uniform(F.col(id_col), seed) < F.col("_p")).alias("sampled"))).drop(tmp, "_p", "_w", *[f"_{k}" for k in range(len(names))])


def sample(docs: DataFrame, targets: dict[str, dict], fraction: float, **how) -> DataFrame:
    """The sampled rows of ``docs``."""
    name = "mix"
    while name in docs.columns:
        name += "_"
    return mix(docs, targets, fraction, into=name, **how).where(F.col(f"{name}.sampled")).drop(name)
