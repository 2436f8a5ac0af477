"""Metrics (A10-A15, W4), ranking and batches."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basinflow.operators import metrics as M
from basinflow.operators.evaluate import best_k, empirical_cdf, worst_k
from basinflow.operators.ranking import assign_batches, global_row_number, resume_candidates


def _pred(spark, samples):
    rows = [(k, i, float(y), float(yh)) for k, (ys, yhs) in samples.items()
            for i, (y, yh) in enumerate(zip(ys, yhs))]
    return spark.createDataFrame(rows, "k string, step int, y double, y_hat double")


def _kge_ref(y, yh):
    y, yh = np.asarray(y, float), np.asarray(yh, float)
    my, mh = y.mean(), yh.mean()
    r = ((y - my) * (yh - mh)).sum() / (math.sqrt(((y - my) ** 2).sum()) * math.sqrt(((yh - mh) ** 2).sum()) + 1e-6)
    a = (yh.std(ddof=1) + 1e-6) / (y.std(ddof=1) + 1e-6)
    b = yh.mean() / (y.mean() + 1e-6)
    return 1 - math.sqrt((r - 1) ** 2 + (a - 1) ** 2 + (b - 1) ** 2)


def test_kge_and_nse_match_formulas(spark):
    rng = np.random.default_rng(1)
    y, yh = rng.random(106) * 10, rng.random(106) * 10
    p = _pred(spark, {"s": (y, yh)})
    k = M.kge(p, ["k"]).collect()[0].kge
    n = M.nse(p, ["k"]).collect()[0].nse
    assert abs(k - _kge_ref(y, yh)) < 1e-9
    assert abs(n - (1 - ((y - yh) ** 2).sum() / (((y - y.mean()) ** 2).sum() + 1e-6))) < 1e-9


def test_perfect_prediction_scores_one(spark):
    y = np.arange(1, 107, dtype=float)
    p = _pred(spark, {"s": (y, y)})
    assert abs(M.kge(p, ["k"]).collect()[0].kge - 1) < 1e-6
    assert abs(M.nse(p, ["k"]).collect()[0].nse - 1) < 1e-6


def test_constant_target_stays_finite(spark):
    p = _pred(spark, {"s": ([3.0] * 20, [2.0] * 20)})
    k, n = M.kge(p, ["k"]).collect()[0].kge, M.nse(p, ["k"]).collect()[0].nse
    assert math.isfinite(k) and math.isfinite(n)


def test_lower_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (float("nan"),)], "v double")
    assert M.nan_median(df, "v").collect()[0][0] == 2.0


def test_tail_crop_longer_than_series_keeps_all(spark):
    p = _pred(spark, {"s": (list(range(106)), list(range(106)))})
    assert M.tail_crop(p, ["k"], 366).count() == 106
    assert M.tail_crop(p, ["k"], 10).agg(F.min("step")).collect()[0][0] == 96
    assert M.tail_crop(p, ["k"], None).count() == 106


def test_metric_dispatch(spark):
    rng = np.random.default_rng(2)
    y, yh = rng.random((2, 30)), rng.random((2, 30))
    p = _pred(spark, {f"s{i}": (y[i], yh[i]) for i in range(2)})
    got = {n: M.metric(n, 10)(p, ["k"]).first()["loss"] for n in M.LOSSES}
    t, th = y[:, -10:], yh[:, -10:]
    nse = 1 - ((t - th) ** 2).sum(1) / (((t - t.mean(1, keepdims=True)) ** 2).sum(1) + 1e-6)
    assert abs(got["mse"] - ((t - th) ** 2).mean()) < 1e-12 and abs(got["nse"] + nse.mean()) < 1e-9
    c, ch = t - t.mean(1, keepdims=True), th - th.mean(1, keepdims=True)
    r = (c * ch).sum(1) / (np.sqrt((c ** 2).sum(1)) * np.sqrt((ch ** 2).sum(1)) + 1e-6)
    a, b = th.std(1, ddof=1) / (t.std(1, ddof=1) + 1e-6), th.mean(1) / (t.mean(1) + 1e-6)
    assert abs(got["kge"] + (1 - np.sqrt((r - 1) ** 2 + (a - 1) ** 2 + (b - 1) ** 2)).mean()) < 1e-9
    try:
        M.metric("rmse")
    except ValueError as e:
        assert "rmse" in str(e)
    else:
        raise AssertionError("unknown metric accepted")


def test_tail_loss_of_samples_of_different_length(spark):
    p = _pred(spark, {"a": ([1.0, 1.0, 1.0], [1.0, 1.0, 1.0]), "b": ([0.0], [2.0])})
    assert M.metric("mse", 1)(p, ["k"]).first()["loss"] == 2.0


def test_global_row_number_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("x"))
    rn = global_row_number(df, ["x"], partitions=7)
    got = sorted((r.rn, r.x) for r in rn.collect())
    assert got == [(i + 1, i) for i in range(1000)]


def test_short_last_batch(spark):
    df = spark.range(35).select(F.col("id").alias("s"))
    b = assign_batches(df, 16, ["s"])
    sizes = sorted((r.batch_id, r["count"]) for r in b.groupBy("batch_id").count().collect())
    assert sizes == [(0, 16), (1, 16), (2, 3)]


def test_batches_restart_per_group(spark):
    df = spark.createDataFrame([(g, i) for g in ("a", "b") for i in range(20)], "g string, s int")
    b = assign_batches(df, 16, ["s"], within=["g"])
    got = sorted((r.g, r.batch_id, r["count"]) for r in b.groupBy("g", "batch_id").count().collect())
    assert got == [("a", 0, 16), ("a", 1, 4), ("b", 0, 16), ("b", 1, 4)]


def test_best_and_worst_with_fewer_than_k(spark):
    sc = spark.createDataFrame([(f"s{i}", float(i)) for i in range(6)], "k string, kge double")
    best = [r.k for r in best_k(sc, "kge", 10, ["k"]).orderBy("rank").collect()]
    worst = [r.k for r in worst_k(sc, "kge", 10, ["k"]).orderBy("rank").collect()]
    assert best == worst == ["s5", "s4", "s3", "s2", "s1", "s0"]


def test_nan_score_ranks_first_when_descending(spark):
    sc = spark.createDataFrame([("a", 0.5), ("b", float("nan")), ("c", 0.9)], "k string, kge double")
    assert [r.k for r in best_k(sc, "kge", 2, ["k"]).orderBy("rank").collect()] == ["b", "c"]


def test_empirical_cdf_distinct_ranks_for_ties(spark):
    sc = spark.createDataFrame([("a", 0.5), ("b", 0.5), ("c", 0.1), ("d", 0.9)], "k string, kge double")
    got = [(r.k, r.rank, r.cdf) for r in empirical_cdf(sc, "kge", ["k"]).orderBy("rank").collect()]
    assert got == [("c", 1, 0.25), ("a", 2, 0.5), ("b", 3, 0.75), ("d", 4, 1.0)]


def test_no_valid_sample_is_an_error(spark):
    from basinflow.operators.quality import require_valid
    stats = spark.createDataFrame([(106, 105), (0, 106)], "len_target int, len_weather int")
    with pytest.raises(ValueError):
        require_valid(stats, 106)
    ok = stats.unionByName(spark.createDataFrame([(106, 106)], "len_target int, len_weather int"))
    assert require_valid(ok, 106).count() == 3


def test_resume_twice_is_resume_once(spark):
    c = spark.createDataFrame([("s", "b", i) for i in range(10)], "split string, basin_id string, issue_date int")
    done = c.where(F.col("issue_date") < 4)
    once = resume_candidates(c, done)
    twice = resume_candidates(once, done)
    assert sorted(once.collect()) == sorted(twice.collect()) and once.count() == 6


def test_epoch_positions_are_permutations_that_mix(spark):
    from basinflow.operators.ranking import epoch_batches, epoch_position, round_keys
    for n in (1, 2, 3, 16, 97, 1000):
        got = [r[0] for r in spark.range(n).select(epoch_position(F.col("id"), F.lit(n), 4)).collect()]
        assert sorted(got) == list(range(n))
    n = 1000
    a, b = ([r[0] for r in spark.range(n).coalesce(1).select(epoch_position(F.col("id"), F.lit(n), s)).collect()] for s in (1, 2))
    assert a != b and sum(x == y for x, y in zip(a, b, strict=True)) < 20
    assert sum(abs(x - y) < 50 for x, y in zip(a, a[1:], strict=False)) < 250          # neighbours are spread
    keys, x = round_keys(1, 24), 17                                                      # the same in plain Python
    for shift, factor, offset in keys:
        mirror = (shift - x) % n
        if (max(x, mirror) * factor + offset) % 2147483647 % 2 == 1:
            x = mirror
    assert a[17] == x
    rows = spark.range(130).selectExpr("id as pos", "'t' as split").unionByName(spark.range(9).selectExpr("id as pos", "'v' as split"))
    batches = epoch_batches(rows, 16, 3).groupBy("split", "batch_id").count().collect()
    assert sorted(r["count"] for r in batches if r["split"] == "t") == [2, *[16] * 8]
    assert [r["count"] for r in batches if r["split"] == "v"] == [9]
