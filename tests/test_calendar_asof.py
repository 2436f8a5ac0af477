"""Calendars (C1-C4) and the nearest as-of join."""

import datetime as dt
import random

from pyspark.sql import functions as F

from basinflow.operators import calendar as cal
from basinflow.operators.asof import first_leads, nearest_asof

# Issue blocks of the reference's forecast recipe and its annual recipe.
REF_BLOCKS = {"train": ("2016-01-01", "2020-09-30"), "validation": ("2020-10-01", "2022-09-30"),
              "test": ("2022-10-01", "2024-09-30")}
REF_YEARS = {"train": ("2001-01-01", "2006-12-31"), "validation": ("2007-01-01", "2008-12-31"),
             "test": ("2009-01-01", "2010-12-31")}


def _counts(df):
    return {r.split: r["count"] for r in df.groupBy("split").count().collect()}


def test_five_day_calendar_counts(spark):
    assert _counts(cal.issue_calendar(spark, REF_BLOCKS, 5)) == {"train": 347, "validation": 146, "test": 147}
    assert len(cal.calendar_dates(REF_BLOCKS, 5)) == 640


def test_year_start_calendar_counts(spark):
    assert _counts(cal.issue_calendar(spark, REF_YEARS, "year-start")) == {"train": 6, "validation": 2, "test": 2}
    off = {"x": ("2001-03-01", "2003-12-31")}
    got = [r.issue_date for r in cal.issue_calendar(spark, off, "year-start").collect()]
    assert got == [dt.date(2002, 1, 1), dt.date(2003, 1, 1)]


def test_candidates_are_generated_per_gauge(spark):
    g = spark.createDataFrame([("a",), ("b",)], "gauge_id string")
    c = cal.candidates(g, REF_BLOCKS, 5)
    assert c.count() == 1280
    assert c.where(F.col("gauge_id") == "a").select("issue_date").distinct().count() == 640


def test_split_of(spark):
    df = spark.createDataFrame([(dt.date(2020, 9, 30),), (dt.date(2020, 10, 1),), (dt.date(2030, 1, 1),)], "d date")
    got = [r.s for r in df.select(cal.split_of("d", REF_BLOCKS).alias("s")).collect()]
    assert got == ["train", "validation", None]


def _near(spark, issues, t0s):
    right = spark.createDataFrame([("b", d) for d in issues], "basin_id string, issue_date date")
    left = spark.createDataFrame([("b", d) for d in t0s], "basin_id string, issue_date date")
    out = nearest_asof(left, right, "basin_id", "issue_date", "issue_date", "m")
    return {r.issue_date: r.m for r in out.collect()}


def test_nearest_tie_goes_to_later_date(spark):
    D = dt.date
    got = _near(spark, [D(2000, 1, 1), D(2000, 1, 5)], [D(2000, 1, 3), D(2000, 1, 2), D(2000, 1, 4)])
    assert got == {D(2000, 1, 3): D(2000, 1, 5), D(2000, 1, 2): D(2000, 1, 1), D(2000, 1, 4): D(2000, 1, 5)}


def test_nearest_clamps_outside_coverage_and_matches_exactly(spark):
    D = dt.date
    issues = [D(2000, 1, 10), D(2000, 2, 10)]
    got = _near(spark, issues, [D(1999, 1, 1), D(2001, 1, 1), D(2000, 1, 10)])
    assert got == {D(1999, 1, 1): D(2000, 1, 10), D(2001, 1, 1): D(2000, 2, 10), D(2000, 1, 10): D(2000, 1, 10)}


def test_nearest_keeps_keys_apart(spark):
    D = dt.date
    right = spark.createDataFrame([("a", D(2000, 1, 1)), ("b", D(2000, 3, 1))], "basin_id string, issue_date date")
    left = spark.createDataFrame([("a", D(2000, 2, 28)), ("b", D(2000, 1, 2))], "basin_id string, issue_date date")
    got = {r.basin_id: r.m for r in nearest_asof(left, right, "basin_id", "issue_date", "issue_date", "m").collect()}
    assert got == {"a": D(2000, 1, 1), "b": D(2000, 3, 1)}


def test_nearest_over_blocks_equals_brute_force(spark):
    """Gaps of many blocks, copies, nulls, keys of one side only, any block length."""
    rng, start = random.Random(5), dt.date(1960, 1, 1)
    day = lambda span: start + dt.timedelta(days=rng.randrange(span))
    right = [(k, day(9000)) for k in "ab" for _ in range(40)] + [("c", day(9000)), ("r", day(9000)), (None, start), ("a", None)]
    left = [(k, day(12000) - dt.timedelta(days=1500)) for k in "abc" for _ in range(300)] + [("l", start), (None, start), ("a", None)]
    right, left = right + right[:30], left + left[:50] + [r for r in right if r[0] == "a" and r[1]]
    r = spark.createDataFrame(right, "basin_id string, issue_date date")
    x = spark.createDataFrame([(*row, i) for i, row in enumerate(left)], "basin_id string, day date, i int")
    for block_days in (7, 320):
        got = {g.i: g.m for g in nearest_asof(x, r, "basin_id", "day", "issue_date", "m", block_days).collect()}
        assert set(got) == {i for i, (k, d) in enumerate(left) if k and d}
        for i, m in got.items():
            k, d = left[i]
            dates = [y for q, y in right if q == k and y]
            assert m == (max(dates, key=lambda y: (-abs((y - d).days), y)) if dates else None)
    assert nearest_asof(x, r.limit(0), "basin_id", "day", "issue_date", "m").where("m is not null").count() == 0
    assert nearest_asof(x.limit(0), r, "basin_id", "day", "issue_date", "m").count() == 0


def test_no_scan_of_a_whole_key(spark):
    """Dates are scanned per (key, block); only block edges are grouped by key."""
    rows = spark.range(50).selectExpr("concat('b', id % 3) as basin_id", "date_add(date'2000-01-01', cast(id * 40 as int)) as issue_date")
    df = nearest_asof(rows, rows, "basin_id", "issue_date", "issue_date", "m")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line]
    assert windows and all("[basin_id#" in w and "block#" in w.split("windowspecdefinition")[1] for w in windows)
    assert "ReusedExchange" in plan and "Python" not in plan


def test_first_leads_takes_lowest_ten(spark):
    D = dt.date
    rows = [("b", D(2000, 1, 1), lead, float(lead)) for lead in (12, 3, 1, 2, 11, 4, 5, 6, 7, 8, 9, 10)]
    fc = spark.createDataFrame(rows, "basin_id string, issue_date date, lead_days int, precip float")
    got = sorted((r.lead_rank, r.lead_days) for r in first_leads(fc, "basin_id", 10).collect())
    assert got == [(i, i) for i in range(1, 11)]
