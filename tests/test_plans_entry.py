"""Plan shape and the driver contract."""

import pytest

import __spark_entry__ as E
from basinflow.fixtures import INPUT_TABLES, Fixtures
from basinflow.operators import samples as smp
from basinflow.operators.ranking import assign_batches
from basinflow.plans.queries import REGISTRY, mixed_steps
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _above(plan: str, mark: str) -> list[str]:
    """The operators between the root and the first line holding ``mark``."""
    lines = [line for line in plan.split("== Initial Plan ==")[-1].splitlines() if line.strip()]
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    at = next(i for i, line in enumerate(lines) if mark in line)
    out, level = [], depth[at]
    for i in range(at - 1, -1, -1):
        if depth[i] < level:
            out.append(lines[i])
            level = depth[i]
    return out


def _exchanges(ops: list[str]) -> list[str]:
    return [op for op in ops if "Exchange" in op]


FAN_OUT = "Generate explode(filter(_days"


def test_core_plan_has_no_python(spark):
    plan = _plan(mixed_steps(Fixtures(spark, SF)))
    for word in ("BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert word not in plan


def test_no_exchange_above_the_fan_out(spark):
    """Windows, aggregates, gates and either scope reuse (basin, block)."""
    steps = mixed_steps(Fixtures(spark, SF))
    assert _exchanges(_above(_plan(steps), FAN_OUT)) == []
    assert _exchanges(_above(_plan(smp.apply_scope(steps, "group")), FAN_OUT)) == []


def test_per_sample_reports_move_one_row_per_sample(spark):
    plan = _plan(smp.scope_samples(smp.sample_stats(mixed_steps(Fixtures(spark, SF))), "group"))
    assert len(_exchanges(_above(plan, FAN_OUT))) == 1


def test_gates_need_no_step_and_no_window(spark):
    from basinflow.plans.queries import MIXED_BLOCKS, _gates, mixed_candidates
    f = Fixtures(spark, SF)
    plan = _plan(_gates(f))
    above = _above(plan, FAN_OUT)
    assert _exchanges(above) == []
    steps = _above(_plan(mixed_steps(f)), FAN_OUT)
    assert sum("Window" in x for x in above) < sum("Window" in x for x in steps)
    keys = [*smp.SAMPLE_GROUP, "reason", "len_target", "len_weather"]
    for obs in (f.obs, f.obs_holes):
        a = sorted(map(str, smp.sample_stats(mixed_steps(f, obs=obs)).select(*keys).collect()))
        assert a == sorted(map(str, _gates(f, obs).select(*keys).collect())) and a
    lean = smp.mixed_gates(f.flow, f.obs_holes, f.fcst, mixed_candidates(f), MIXED_BLOCKS, 5, nan_policy="precip_target")
    full = smp.sample_stats(mixed_steps(f, "precip_target", obs=f.obs_holes))
    assert sorted(map(str, lean.select(*keys).collect())) == sorted(map(str, full.select(*keys).collect()))


def test_samples_are_packed_where_they_are(spark):
    from basinflow.plans.queries import _packed
    assert _exchanges(_above(_plan(_packed(Fixtures(spark, SF))), FAN_OUT)) == []


def test_an_epoch_moves_no_sample(spark):
    from basinflow.operators.ranking import epoch_batches
    rows = spark.range(1000).selectExpr("id as pos", "concat('s', id % 3) as split", "id % 7 as batch_id")
    plan = _plan(epoch_batches(rows, 16, 5))
    assert "rangepartitioning" not in plan and "Sort " not in plan
    # The only exchanges are of the groups' counts.
    assert "Exchange hashpartitioning(split" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_batches_move_the_samples_once(spark):
    plan = _plan(assign_batches(spark.range(100).withColumn("g", F.col("id") % 3), 10, ["id"], within=["g"]))
    assert "SortMergeJoin" not in plan and _exchanges(_above(plan, "ExistingRDD")) == []


def test_landed_inputs_follow_their_files(spark, tmp_path):
    for t in INPUT_TABLES:
        spark.read.parquet(f"{SF}/{t}.parquet").coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
    first = Fixtures(spark, str(tmp_path))
    total = first.flow_dense.agg(F.sum("streamflow_cms")).first()[0]
    want = spark.read.parquet(f"{SF}/orders.parquet").join(
        spark.read.parquet(f"{SF}/customer.parquet"), F.col("o_custkey") == F.col("c_custkey"))
    assert total == pytest.approx(want.agg(F.sum("o_totalprice")).first()[0])
    (spark.read.parquet(f"{SF}/orders.parquet").withColumn("o_totalprice", F.col("o_totalprice") * 2)
     .coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet"))
    again = Fixtures(spark, str(tmp_path))
    assert again is not first
    assert again.flow_dense.agg(F.sum("streamflow_cms")).first()[0] == pytest.approx(2 * total)
    rain = again.obs.agg(F.sum(F.col("precip").cast("double"))).first()[0]
    items = spark.read.parquet(f"{SF}/lineitem.parquet").join(
        spark.read.parquet(f"{SF}/supplier.parquet"), F.col("l_suppkey") == F.col("s_suppkey"))
    assert rain == pytest.approx(items.agg(F.sum("l_quantity")).first()[0])


def test_entry_runs_and_queries_have_oracles(spark):
    df = E.entry(spark)
    assert df.columns == ["basin_id", "split", "forecast_date", "step", "flag", "precip", "temp",
                          "net_solar", "target"]
    assert df.count() > 0 and df.count() % 106 == 0
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q) and len(REGISTRY) >= 70
    assert set(REGISTRY) <= set(sql)


@pytest.mark.parametrize("name", ["gauge_suffix", "candidates", "nearest_issue", "kge"])
def test_registered_queries_run_small(spark, name):
    assert E.queries()[name](spark, SF).count() > 0
