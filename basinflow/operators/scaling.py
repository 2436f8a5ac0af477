"""Train-only scalers and the static-attribute join.

A scaler is a one-row-per-feature table ``(feature, mean, std)``; it is tiny
(one row per feature, a schema property) and is broadcast into the column
arithmetic.  Statistics are computed in double over float32 inputs; NULL
(the build's missing marker) is skipped like pandas/numpy nan-functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import denormalize, normalize, standardize, unstandardize


def fit_scaler(df: DataFrame, features: list[str]) -> DataFrame:
    """Per-feature mean and *population* std over all rows given
    (samples x time of the train split)."""
    aggs = []
    for c in features:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_pop(x).alias(f"{c}__std")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__mean`, `{c}__std`" for c in features)
    return wide.selectExpr(f"stack({len(features)}, {stack}) AS (feature, mean, std)")


def partial_moments(df: DataFrame, features: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """A8 in parts: (``by``..., feature, n, mean, m2) of the rows given, m2 being
    the sum of squared distances from the mean.  Parts of a sample set, such as
    its written chunks or its gauges, merge into the statistics of the whole."""
    aggs = []
    for c in features:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"), (F.var_pop(x) * F.count(x)).alias(f"{c}__m2")]
    stack = ", ".join(f"'{c}', `{c}__n`, `{c}__mean`, `{c}__m2`" for c in features)
    return df.groupBy(*by).agg(*aggs).selectExpr(*by, f"stack({len(features)}, {stack}) AS (feature, n, mean, m2)")


def merge_moments(parts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(``by``..., feature, n, mean, m2, std) of all parts together.

    Parts are combined by their counts and their distances from the common
    mean, which loses nothing to cancellation; a part without values (n = 0)
    adds nothing.  One pass adds up the means, one the distances."""
    keys = [*by, "feature"]
    some = parts.where("n > 0")
    whole = some.groupBy(*keys).agg(F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    apart = some.join(whole, keys).groupBy(*keys, "_n", "_mean").agg(
        F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("_mean"), 2)).alias("m2"))
    found = apart.select(*keys, F.col("_n").alias("n"), F.col("_mean").alias("mean"), "m2",
                         F.sqrt(F.col("m2") / F.col("_n")).alias("std"))
    # A feature without any value keeps its row, like an aggregate over nothing.
    return parts.select(*keys).distinct().join(found, keys, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def packed_moments(packed: DataFrame, features: list[str], by: tuple[str, ...] = ("split",)) -> DataFrame:
    """``partial_moments`` of packed samples (``dynamic_inputs``, ``targets``)."""
    z = packed.select(*by, F.explode(F.arrays_zip(F.col("dynamic_inputs").alias("x"), F.col("targets").alias("y"))).alias("e"))
    rows = z.select(*by, *[F.col("e.x")[i].alias(f) for i, f in enumerate(features)], F.col("e.y").alias("target"))
    return partial_moments(rows, [*features, "target"], by)


def fit_static_scaler(static: DataFrame, col: str = "features") -> DataFrame:
    """Per-position nan-mean / nan-std over gauges."""
    e = static.select(F.posexplode(col).alias("idx", "x"))
    x = F.when(~F.isnan("x"), F.col("x"))
    return e.groupBy("idx").agg(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"))


def scaler_params(scaler: DataFrame) -> dict[str, tuple[float, float]]:
    """Fitted parameters on the driver, like a fitted ML model.

    One row per feature -- the size is fixed by the schema, not the data.
    """
    return {r["feature"]: (r["mean"], r["std"]) for r in scaler.collect()}


def _apply(df: DataFrame, params, features: list[str], fn, suffix: str) -> DataFrame:
    if isinstance(params, DataFrame):
        params = scaler_params(params)
    return df.select("*", *[
        fn(F.col(c).cast("double"), F.lit(params[c][0]).cast("double"),
           F.lit(params[c][1]).cast("double")).alias(f"{c}{suffix}")
        for c in features])


def apply_normalize(df, scaler, features, suffix="_n"):
    """F1 with a fitted scaler."""
    return _apply(df, scaler, features, normalize, suffix)


def apply_denormalize(df, scaler, features, suffix="_d"):
    """F2 with a fitted scaler."""
    return _apply(df, scaler, features, denormalize, suffix)


def apply_standardize(df, scaler, features, suffix="_s"):
    """F3 with a fitted scaler."""
    return _apply(df, scaler, features, standardize, suffix)


def apply_unstandardize(df, scaler, features, suffix="_u"):
    """F4 with a fitted scaler."""
    return _apply(df, scaler, features, unstandardize, suffix)


def normalize_static(static: DataFrame, stats: DataFrame, col: str = "features") -> DataFrame:
    """F1 on static vectors, position by position (stats: one row per position)."""
    p = sorted((r["idx"], r["mean"], r["std"]) for r in stats.collect())
    means = F.array(*[F.lit(m).cast("double") for _, m, _ in p])
    stds = F.array(*[F.lit(s).cast("double") for _, _, s in p])
    return static.select(
        *[c for c in static.columns if c != col],
        F.transform(col, lambda x, i: normalize(x, means[i], stds[i])).alias(col))


def attach_static(samples: DataFrame, static: DataFrame, key: str = "basin_id",
                  static_key: str = "gauge_id", how: str = "error") -> DataFrame:
    """Attach the static vector of each sample's gauge.

    ``how='error'`` raises when a sample's gauge has no static row (the
    reference fails on the dictionary lookup); ``'left'`` keeps it with NULL.
    """
    s = static.withColumnRenamed(static_key, key)
    if how == "error":
        missing = samples.select(key).distinct().join(s.select(key), key, "left_anti").limit(1).collect()
        if missing:
            raise KeyError(f"no static attributes for gauge {missing[0][0]!r}")
        return samples.join(s, key, "inner")
    return samples.join(s, key, how)
