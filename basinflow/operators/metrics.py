"""Forecast skill metrics (A10-A15, W4, X3) over a long-form predictions table.

``predictions(<sample keys>, step, y, y_hat)``: one row per sample step.  Every
metric is a grouped aggregate keyed by sample, so it partial-aggregates before
its shuffle; nothing is collected per sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .selection import lower_median

EPS = 1e-6  # epsilon of the reference's metric formulas


def tail_crop(pred: DataFrame, keys: list[str], seq_len: int | None,
              step: str = "step") -> DataFrame:
    """Keep the last ``seq_len`` steps of every sample (0/None = all)."""
    if not seq_len:
        return pred
    last = F.max(step).over(Window.partitionBy(*keys))
    return pred.withColumn("_last", last).where(F.col(step) > F.col("_last") - seq_len).drop("_last")


def nse(pred: DataFrame, keys: list[str], seq_len: int | None = None) -> DataFrame:
    """``1 - sum((y-yh)^2) / (sum((y-mean y)^2) + 1e-6)`` per sample."""
    return scores(pred, keys, seq_len).select(*keys, "nse")


def kge(pred: DataFrame, keys: list[str], seq_len: int | None = None,
        components: bool = False) -> DataFrame:
    """Kling-Gupta efficiency per sample (evaluation form).

    ``r`` from population moments with epsilon in the denominator, ``alpha``
    from sample standard deviations each with epsilon, ``beta`` with epsilon
    on the observed mean (exact placement of the reference's evaluation form).
    """
    return scores(pred, keys, seq_len).select(*keys, *(["r", "alpha", "beta"] if components else []), "kge")


def _distance(alpha: str) -> Column:
    return F.lit(1.0) - F.sqrt(F.pow(F.col("r") - 1, 2) + F.pow(F.col(alpha) - 1, 2) + F.pow(F.col("beta") - 1, 2))


def scores(pred: DataFrame, keys: list[str], seq_len: int | None = None) -> DataFrame:
    """Every per-sample metric in one grouped aggregate: squared-error sum and
    steps, mse, nse, kge with its parts, and the loss form of kge (epsilon on
    the observed standard deviation only)."""
    n, error = F.count("y"), F.pow(F.col("y") - F.col("y_hat"), 2)
    spread, sd, sd_hat = F.var_pop("y") * n, F.stddev_samp("y"), F.stddev_samp("y_hat")
    out = tail_crop(pred, keys, seq_len).groupBy(*keys).agg(
        F.sum(error).alias("squares"), n.alias("steps"), F.avg(error).alias("mse"),
        (F.lit(1.0) - F.sum(error) / (spread + F.lit(EPS))).alias("nse"),
        (n * F.covar_pop("y", "y_hat") / (F.sqrt(spread) * F.sqrt(n * F.var_pop("y_hat")) + F.lit(EPS))).alias("r"),
        ((sd_hat + F.lit(EPS)) / (sd + F.lit(EPS))).alias("alpha"), (sd_hat / (sd + F.lit(EPS))).alias("alpha_loss"),
        (F.avg("y_hat") / (F.avg("y") + F.lit(EPS))).alias("beta"))
    return out.withColumn("kge", _distance("alpha")).withColumn("kge_loss", _distance("alpha_loss")).drop("alpha_loss")


def mse_loss(pred: DataFrame, keys: list[str], seq_len: int | None = None) -> DataFrame:
    """A10: mean over all samples x (tail) steps, one row."""
    s = scores(pred, keys, seq_len)
    return s.agg((F.sum("squares") / F.sum("steps")).alias("loss"))


def nse_loss(pred: DataFrame, keys: list[str], seq_len: int | None = None) -> DataFrame:
    """Negative mean of the per-sample NSE, one row."""
    return scores(pred, keys, seq_len).agg((-F.avg("nse")).alias("loss"))


def kge_loss(pred: DataFrame, keys: list[str], seq_len: int | None = None) -> DataFrame:
    """Negative mean of the per-sample KGE in its loss form, one row."""
    return scores(pred, keys, seq_len).agg((-F.avg("kge_loss")).alias("loss"))


LOSSES = {"mse": mse_loss, "nse": nse_loss, "kge": kge_loss}


def metric(name: str, seq_len: int | None = None):
    """``loss(pred, keys)`` by name over the last ``seq_len`` steps; all
    three are interchangeable, and unknown names are an error."""
    if name not in LOSSES:
        raise ValueError(f"Unknown loss type: {name}")
    return lambda pred, keys: LOSSES[name](pred, keys, seq_len)


def batch_means(scored: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """A13/A14 input: per batch the samples, mean KGE, mean NSE and MSE loss."""
    return scored.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("n_samples"), F.avg("kge").alias("mean_kge"), F.avg("nse").alias("mean_nse"),
        (F.sum("squares") / F.sum("steps")).alias("loss"))


def mean_of_batches(per_batch: DataFrame) -> DataFrame:
    """Mean batch loss and the lower medians of the batch means.
    ``per_batch`` is read once a pass of the selection: give a written table."""
    medians = [lower_median(per_batch, c) for c in ("mean_kge", "mean_nse")]
    return per_batch.agg(*[F.lit(m).cast("double").alias(c) for m, c in zip(medians, ("median_kge", "median_nse"), strict=True)],
                         F.avg("loss").alias("avg_loss"))


def nan_median(df: DataFrame, value: str, out: str | None = None) -> DataFrame:
    """Lower median, NaN/NULL skipped, one row (NULL without a value)."""
    return df.sparkSession.range(1).select(F.lit(lower_median(df, value)).cast("double").alias(out or f"median_{value}"))
