"""Small hand-made inputs for the edge cases (FIXTURES.md section 3)."""

import datetime as dt

from basinflow.operators import samples as smp

T0 = dt.date(2000, 6, 15)
ONE = dt.timedelta(days=1)


def series(start, end, value=lambda day: float(day.toordinal() % 17), skip=()):
    out, cur = [], start
    while cur <= end:
        if cur not in skip:
            out.append((cur, value(cur)))
        cur += ONE
    return out


def mixed_inputs(spark, t0=T0, flow_skip=(), obs_skip=(), flow_value=None, obs_nulls=None,
                 gauge="g1"):
    """One basin, one issue date: complete flow/obs windows unless told otherwise."""
    fv = flow_value or (lambda day: float(day.toordinal() % 17))
    flow = spark.createDataFrame(
        [(gauge, day, v) for day, v in series(t0 - 305 * ONE, t0 + 10 * ONE, fv, flow_skip)],
        "gauge_id string, date date, streamflow_cms double")
    obs_nulls = obs_nulls or {}
    rows = []
    for day, v in series(t0 - 305 * ONE, t0, skip=obs_skip):
        vals = [float(v), float(v) + 1.0, float(v) + 2.0]
        for col, bad_days in obs_nulls.items():
            if day in bad_days:
                vals[["precip", "temp", "net_solar"].index(col)] = None
        rows.append((f"camels_{gauge}", day, *vals))
    obs = spark.createDataFrame(rows, "basin_id string, date date, precip float, temp float, net_solar float")
    fc = spark.createDataFrame(
        [(f"camels_{gauge}", t0, lead, float(lead), float(lead), float(lead)) for lead in range(1, 13)],
        "basin_id string, issue_date date, lead_days int, precip float, temp float, net_solar float")
    cand = spark.createDataFrame([(gauge, "test", t0)], "basin_id string, split string, issue_date date")
    return flow, obs, fc, cand


def build(spark, policy="all", t0=T0, **kw):
    flow, obs, fc, cand = mixed_inputs(spark, t0=t0, **kw)
    blocks = {"test": (t0.isoformat(), t0.isoformat())}
    return smp.mixed_steps(flow, obs, fc, cand, blocks, 5, nan_policy=policy)


def sample_row(steps):
    return smp.sample_stats(steps).collect()[0]
