"""Mixed-resolution sample semantics (FIXTURES.md section 3, SURVEY 2.12)."""

from pyspark.sql import functions as F

from helpers import ONE, T0, build, mixed_inputs, sample_row
from basinflow.operators import samples as smp


def test_complete_sample_has_steps_0_to_105_once(spark):
    st = build(spark)
    r = sample_row(st)
    assert (r.len_target, r.len_weather, r.reason) == (106, 106, None)
    steps = [x.step for x in st.select("step").orderBy("step").collect()]
    assert steps == list(range(106))
    flags = {x.step: x.flag for x in st.select("step", "flag").collect()}
    assert flags[0] == 0 and flags[34] == 0 and flags[35] == 1 and flags[95] == 1
    assert flags[96] == 2 and flags[105] == 2


def test_late_slice_start_still_35_bins(spark):
    skip = {T0 - 305 * ONE + i * ONE for i in range(3)}
    st = build(spark, flow_skip=skip)
    r = sample_row(st)
    assert (r.len_target, r.reason) == (106, None)
    # first bin anchored at day 4 of the slice: mean of t0-302 .. t0-296
    vals = [float((T0 - (302 - i) * ONE).toordinal() % 17) for i in range(7)]
    got = st.where(F.col("step") == 0).select("target").collect()[0][0]
    assert abs(got - sum(vals) / 7) < 1e-4


def test_seven_missing_days_at_start_is_rejected(spark):
    skip = {T0 - 305 * ONE + i * ONE for i in range(7)}
    r = sample_row(build(spark, flow_skip=skip))
    assert (r.len_target, r.reason) == (105, "target_length")


def test_empty_inner_week_counts_but_is_missing(spark):
    skip = {T0 - 305 * ONE + (35 + i) * ONE for i in range(7)}   # whole bin 5
    r = sample_row(build(spark, flow_skip=skip))
    assert (r.len_target, r.reason) == (106, "missing_values")


def test_partial_week_averages_present_days(spark):
    start = T0 - 305 * ONE + 14 * ONE                      # bin 2
    skip = {start + i * ONE for i in (1, 3, 5)}
    st = build(spark, flow_skip=skip)
    assert sample_row(st).reason is None
    present = [start + i * ONE for i in (0, 2, 4, 6)]
    want = sum(float(x.toordinal() % 17) for x in present) / 4
    got = st.where(F.col("step") == 2).select("target").collect()[0][0]
    assert abs(got - want) < 1e-4


def test_nan_inside_week_is_skipped_after_source_conversion(spark):
    from basinflow.functions.columns import nan_to_null
    flow, obs, fc, cand = mixed_inputs(spark)
    bad = T0 - 300 * ONE
    flow = flow.withColumn("streamflow_cms", F.when(F.col("date") == F.lit(bad), F.lit(float("nan")))
                           .otherwise(F.col("streamflow_cms")))
    flow = flow.withColumn("streamflow_cms", nan_to_null("streamflow_cms"))
    st = smp.mixed_steps(flow, obs, fc, cand, {"test": (str(T0), str(T0))}, 5)
    assert sample_row(st).reason is None
    vals = [float((T0 - (305 - i) * ONE).toordinal() % 17) for i in range(7) if (305 - i) != 300]
    got = st.where(F.col("step") == 0).select("target").collect()[0][0]
    assert abs(got - sum(vals) / 6) < 1e-4


def test_one_missing_daily_row_is_rejected(spark):
    r = sample_row(build(spark, flow_skip={T0 - 20 * ONE}))
    assert (r.len_target, r.reason) == (105, "target_length")
    r = sample_row(build(spark, obs_skip={T0 - 20 * ONE}))
    assert (r.len_weather, r.reason) == (105, "weather_length")


def test_nan_only_in_temp_depends_on_policy(spark):
    holes = {"temp": {T0 - 10 * ONE}}
    assert sample_row(build(spark, policy="precip_target", obs_nulls=holes)).reason is None
    assert sample_row(build(spark, policy="all", obs_nulls=holes)).reason == "missing_values"


def test_group_scope_drops_the_whole_group(spark):
    # five issue dates of one gauge; one of them sees a NULL precipitation day
    t0s = [T0 + 5 * i * ONE for i in range(5)]
    flow, obs, fc, _ = mixed_inputs(spark, t0=t0s[-1])
    flow2, obs2, _, _ = mixed_inputs(spark, t0=t0s[0])
    flow = flow.unionByName(flow2).distinct()
    bad_day = t0s[0] - 30 * ONE
    obs = obs.unionByName(obs2).distinct().withColumn(
        "precip", F.when(F.col("date") == F.lit(bad_day), F.lit(None)).otherwise(F.col("precip")))
    cand = spark.createDataFrame([("g1", "test", t) for t in t0s], "basin_id string, split string, issue_date date")
    blocks = {"test": (str(t0s[0]), str(t0s[-1]))}
    st = smp.mixed_steps(flow, obs, fc, cand, blocks, 5)
    per_sample = smp.apply_scope(st, "sample").select("issue_date").distinct().count()
    per_group = smp.apply_scope(st, "group").select("issue_date").distinct().count()
    n_bad = smp.sample_stats(st).where(F.col("reason") == "missing_values").count()
    assert n_bad >= 1 and per_sample == 5 - n_bad and per_group == 0


def test_forecast_part_uses_first_ten_leads(spark):
    st = build(spark)
    got = {r.step: r.precip for r in st.where(F.col("step") > 95).select("step", "precip").collect()}
    assert got == {95 + k: float(k) for k in range(1, 11)}


def test_annual_leap_year_window(spark):
    import datetime as dt
    t0 = dt.date(2001, 1, 1)
    start = t0 - 365 * ONE
    assert start == dt.date(2000, 1, 2)
    flow = spark.createDataFrame([("g1", start + i * ONE, float(i)) for i in range(366)],
                                 "gauge_id string, date date, streamflow_cms double")
    obs = spark.createDataFrame([("camels_g1", start + i * ONE, *([float(i)] * 6)) for i in range(366)],
                                "basin_id string, date date, precip float, temp float, u_wind float, "
                                "v_wind float, dew_point float, net_solar float")
    out = smp.annual_samples(flow, obs, {"test": ("2001-01-01", "2001-12-31")})
    assert out.count() == 366
    assert out.agg(F.min("step"), F.max("step")).collect()[0] == (0, 365)


def test_pack_and_unpack_round_trip(spark):
    st = smp.apply_scope(build(spark), "sample").withColumn("forecast_date", F.lit("x"))
    packed = smp.pack_samples(st, ["precip", "temp", "net_solar", "flag"])
    row = packed.collect()[0]
    assert len(row.dynamic_inputs) == 106 and len(row.dynamic_inputs[0]) == 4 and len(row.targets) == 106
    back = smp.unpack_samples(packed, ["precip", "temp", "net_solar", "flag"])
    a = {r.step: (r.precip, r.target) for r in back.collect()}
    b = {r.step: (r.precip, r.target) for r in st.collect()}
    assert a == b


def test_copies_are_combined_with_row_counts_kept(spark):
    flow, obs, fc, cand = mixed_inputs(spark)
    wk_day, daily_day = T0 - 300 * ONE, T0 - 20 * ONE
    blocks = {"test": (str(T0), str(T0))}
    # a copy inside the weekly slice: the bin mean counts it twice, length unchanged
    dup = flow.where(F.col("date") == F.lit(wk_day))
    st = smp.mixed_steps(flow.unionByName(dup), obs, fc, cand, blocks, 5)
    assert sample_row(st).reason is None
    vals = [float((T0 - (305 - i) * ONE).toordinal() % 17) for i in range(7)]
    vals.append(float(wk_day.toordinal() % 17))
    got = st.where(F.col("step") == 0).select("target").collect()[0][0]
    assert abs(got - sum(vals) / 8) < 1e-4
    # a copy of a daily row: one row too many, rejected on length
    dup = flow.where(F.col("date") == F.lit(daily_day))
    r = sample_row(smp.mixed_steps(flow.unionByName(dup), obs, fc, cand, blocks, 5))
    assert (r.len_target, r.reason) == (107, "target_length")
