"""Properties from SURVEY section 5 (3)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basinflow.fixtures import Fixtures, MIXED_BLOCKS
from basinflow.functions.columns import denormalize, normalize, standardize, unstandardize
from basinflow.operators import calendar as cal
from basinflow.operators import samples as smp
from basinflow.plans.queries import mixed_steps

SF = "/root/testdata/sf0.001"
finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False)


@settings(max_examples=15, deadline=None)
@given(st.lists(finite, min_size=1, max_size=20), finite, st.floats(min_value=1e-3, max_value=1e5))
def test_normalize_round_trip(spark, xs, mean, std):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    m, s = F.lit(mean), F.lit(std)
    got = df.select(denormalize(normalize("x", m, s), m, s).alias("a"),
                    unstandardize(standardize("x", m, s), m, s).alias("b")).collect()
    for x, r in zip(xs, got):
        assert abs(r.a - x) <= 1e-6 * max(1.0, abs(x)) and abs(r.b - x) <= 1e-6 * max(1.0, abs(x))


def test_splits_are_disjoint_by_issue_date(spark):
    c = cal.issue_calendar(spark, MIXED_BLOCKS, 5)
    per_date = c.groupBy("issue_date").agg(F.countDistinct("split").alias("n"))
    assert per_date.where(F.col("n") > 1).count() == 0


def test_group_scope_is_subset_of_sample_scope(spark):
    f = Fixtures(spark, SF)
    st_ = mixed_steps(f, obs=f.obs_holes)
    keys = ["basin_id", "split", "issue_date"]
    sample = smp.apply_scope(st_, "sample").select(*keys).distinct()
    group = smp.apply_scope(st_, "group").select(*keys).distinct()
    assert group.join(sample, keys, "left_anti").count() == 0


def test_every_accepted_sample_has_each_step_once(spark):
    acc = smp.apply_scope(mixed_steps(Fixtures(spark, SF)), "sample")
    per = acc.groupBy("basin_id", "issue_date").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("step").alias("d"),
        F.min("step").alias("lo"), F.max("step").alias("hi"))
    bad = per.where((F.col("n") != 106) | (F.col("d") != 106) | (F.col("lo") != 0) | (F.col("hi") != 105))
    assert per.count() > 0 and bad.count() == 0
