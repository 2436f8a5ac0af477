"""Ranking, distributions and scoring hooks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import gauge_int
from .ranking import global_row_number

UNKNOWN_NAME = "Unknown"


def with_gauge_name(df: DataFrame, names: DataFrame, key: str = "basin_id",
                    out: str = "gauge_name") -> DataFrame:
    """Name of ``int(key)`` from the names table, ``Unknown`` if absent.

    Names are de-duplicated per id first (the lexically first name stands in
    for "first row", since files have no row order in Spark).  The names table
    is one row per gauge.
    """
    first = names.groupBy(F.col("gauge_id").alias("_gid")).agg(F.min("gauge_name").alias("_nm"))
    j = df.join(first, gauge_int(key) == F.col("_gid"), "left")
    return j.withColumn(out, F.coalesce(F.col("_nm"), F.lit(UNKNOWN_NAME))).drop("_gid", "_nm")


def best_k(scores: DataFrame, value: str, k: int, ties: list[str]) -> DataFrame:
    """``k`` highest scores (NaN ranks first, as it compares highest),
    with ``rank`` 1..k; ties broken by ``ties`` ascending."""
    order = [F.col(value).desc_nulls_last()] + [F.col(t).asc() for t in ties]
    top = scores.orderBy(*order).limit(k)
    return global_rank_small(top, order)


def worst_k(scores: DataFrame, value: str, k: int, ties: list[str]) -> DataFrame:
    """The last ``k`` of the descending order, listed high to low."""
    rev = [F.col(value).asc_nulls_first()] + [F.col(t).desc() for t in ties]
    bottom = scores.orderBy(*rev).limit(k)
    order = [F.col(value).desc_nulls_last()] + [F.col(t).asc() for t in ties]
    return global_rank_small(bottom, order)


def global_rank_small(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rank inside an already limited (k-row) result."""
    from pyspark.sql import Window
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def empirical_cdf(scores: DataFrame, value: str, ties: list[str]) -> DataFrame:
    """``i / n`` of the ascending sorted scores, ties given distinct
    ranks by ``ties`` -- a distributed row number, not one big window."""
    ranked = global_row_number(scores, [F.col(value).asc_nulls_first()] + [F.col(t) for t in ties],
                               out="rank", total="_n")
    return ranked.withColumn("cdf", F.col("rank") / F.col("_n")).drop("_n")


def apply_static_hook(static: DataFrame, fn: Callable[[Column], Column] | None,
                      col: str = "features") -> DataFrame:
    """Optional caller-supplied transform of the static vector.

    ``fn`` maps a Column to a Column (built-in expressions or a pandas UDF).
    """
    if fn is None:
        return static
    return static.withColumn(col, fn(F.col(col)))


_LOADED: dict[str, object] = {}      # models of this Python worker, by name
MAX_LOADED = 4


def worker_model(name: str, load: Callable[[], object]) -> object:
    """The model ``name`` of this Python worker, loaded at its first use and
    kept for the worker's later tasks; the oldest goes when there are more
    than MAX_LOADED.  Workers that are started anew load again."""
    if name not in _LOADED:
        while len(_LOADED) >= MAX_LOADED:
            _LOADED.pop(next(iter(_LOADED)))
        _LOADED[name] = load()
    return _LOADED[name]


def score_batches(samples: DataFrame, predict: Callable[..., pd.Series], keys: list[str], schema: str,
                  load: Callable[[], object] | None = None, model: str | None = None) -> DataFrame:
    """Run a predictor over Arrow batches of samples on the executors.

    ``predict`` receives a pandas frame of the input columns and returns the
    ``y_hat`` series.  With ``load``, it receives ``load()`` as well, which runs
    once in a Python worker and not once a task: only the loader is shipped,
    the model (named ``model``, for instance by its path and version) is read
    where it is used.  Output: the keys plus ``y`` and ``y_hat``.
    """
    if load is not None and not model:
        raise ValueError("a loaded model needs a name")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from basinflow.operators.evaluate import worker_model      # the worker's own module, which outlives the task
        more = () if load is None else (worker_model(model, load),)
        for pdf in batches:
            out = pdf[keys + ["y"]].copy()
            out["y_hat"] = predict(pdf, *more).to_numpy()
            yield out

    return samples.mapInPandas(run, schema)
