"""Selection by rank against sorting."""
import math
import random

import pytest

from basinflow.operators.selection import lower_median, nth

INF = float("inf")
CASES = {
    "few": [3.0, 1.0, 2.0], "even": [4.0, 1.0, 3.0, 2.0], "one": [7.0], "equal": [2.5] * 50,
    "missing": [None, float("nan"), 5.0, None, 1.0], "infinite": [-INF, INF, 0.0, INF, -INF, 1.0, INF],
    "zeros": [0.0, -0.0, 0.0, 1e-300, -1e-300], "wide": [10.0 ** k for k in range(-300, 300, 7)] + [-(10.0 ** k) for k in range(-300, 300, 11)],
    "ends": [-1.7976931348623157e308, 1.7976931348623157e308, 0.0, 5.0],
    "neighbours": [1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0)] * 9,
}


@pytest.mark.parametrize("name", CASES)
def test_every_rank(spark, name):
    values = CASES[name]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    order = sorted(v for v in values if v is not None and v == v)
    ranks = range(1, len(order) + 1) if len(order) < 10 else [1, 2, len(order) // 2, len(order)]
    for rank in ranks:
        assert nth(df, "v", rank, cells=4, few=1) == order[rank - 1]
    assert nth(df, "v", len(order) + 1) is None and nth(df, "v", 0) is None


def test_skewed_values_and_the_median(spark):
    r = random.Random(6)
    values = [0.5] * 4000 + [r.lognormvariate(0, 3) for _ in range(5000)] + [float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7).cache()
    order = sorted(v for v in values if v is not None and v == v)
    assert lower_median(df, "v", cells=8, few=50) == order[math.ceil(len(order) / 2) - 1]
    assert nth(df, "v", 8000, few=0) == order[7999]
    assert lower_median(df.where("v is null"), "v") is None


def test_no_aggregate_holds_all_values(spark):
    from basinflow.plans.queries import REGISTRY
    df = REGISTRY["nan_median"][0](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "ObjectHashAggregate" not in plan
