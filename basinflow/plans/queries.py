"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, derives the hydrology views from the
driver's tables (``basinflow.fixtures``) and returns a DataFrame; floats are
rounded to 4 decimals and dates rendered ``yyyy-MM-dd`` in the *query output
only*, so the oracle comparison is stable.  Column names match the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixtures import MIXED_BLOCKS, Fixtures, with_views
from ..functions.columns import FLAG_LEGEND, gauge_suffix, iso_date
from ..operators import calendar as cal
from ..operators import samples as smp
from . import oracle as osql

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def rnd(col, digits: int):
    """Rounded output value; ``+ 0.0`` turns -0.0 into 0.0 so the sign of a
    zero never depends on summation order."""
    return F.round(col, digits) + F.lit(0.0)


def r4(col: str, alias: str | None = None):
    return rnd(F.col(col).cast("double"), 4).alias(alias or col)


def split_blocks(blocks, split: str | None):
    """The calendar of one split only.  Samples of a split depend only on its
    own issue dates, so a query needing one split fans out only that split's
    windows (the calendar is generated, so Catalyst cannot push this down)."""
    return blocks if split is None else {split: blocks[split]}


def mixed_candidates(f: Fixtures, blocks=MIXED_BLOCKS) -> DataFrame:
    """C3 over the gauges that have streamflow."""
    g = f.gauges.select(gauge_suffix("gauge_id").alias("basin_id"))
    g = g.join(f.flow.select(F.col("gauge_id").alias("basin_id")).distinct(), "basin_id", "left_semi")
    return cal.candidates(g, blocks, 5, key="basin_id")


def mixed_steps(f: Fixtures, nan_policy: str = "all", flow=None, obs=None,
                split: str | None = None) -> DataFrame:
    blocks = split_blocks(MIXED_BLOCKS, split)
    return smp.mixed_steps(flow if flow is not None else f.flow,
                           obs if obs is not None else f.obs, f.fcst,
                           mixed_candidates(f, blocks), blocks, 5, nan_policy=nan_policy)


WEATHER3 = smp.WEATHER3


# --------------------------------------------------------------------------
# flagship
# --------------------------------------------------------------------------

@register("mixed_samples", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, step, flag, "
    + ", ".join(osql.r4(c) for c in WEATHER3 + ["target"])
    + " FROM mixed WHERE reason IS NULL",
    "gauges", "flow", "obs", "fcst", extra=osql.mixed_ctes()))
def q_mixed_samples(spark, sf_dir):
    f = Fixtures(spark, sf_dir)
    out = smp.apply_scope(mixed_steps(f), "sample")
    return out.select("basin_id", "split", iso_date("issue_date").alias("forecast_date"),
                      "step", "flag", *[r4(c) for c in WEATHER3 + ["target"]])


# --------------------------------------------------------------------------
# projections, filters, predicates
# --------------------------------------------------------------------------

SLICE = ("1999-01-01", "1999-12-31")


@register("date_slice", with_views(
    "SELECT basin_id, strftime(date, '%Y-%m-%d') AS date, "
    + ", ".join(osql.r4(c) for c in WEATHER3)
    + f" FROM obs WHERE date BETWEEN DATE '{SLICE[0]}' AND DATE '{SLICE[1]}'", "obs"))
def q_date_slice(spark, sf_dir):
    """Inclusive date range, variable projection (pushed to the scan)."""
    f = Fixtures(spark, sf_dir)
    o = f.obs.where(F.col("date").between(F.lit(SLICE[0]).cast("date"), F.lit(SLICE[1]).cast("date")))
    return o.select("basin_id", iso_date("date").alias("date"), *[r4(c) for c in WEATHER3])


@register("gauge_suffix", with_views(
    "SELECT gauge_id, string_split(gauge_id, '_')[-1] AS suffix, "
    "'camels_' || string_split(gauge_id, '_')[-1] AS basin_key, "
    "TRY_CAST(string_split(gauge_id, '_')[-1] AS INTEGER) AS gauge_int FROM gauges", "gauges"))
def q_gauge_suffix(spark, sf_dir):
    """Id from a prefixed key, key from an id, integer lookup key."""
    from ..functions.columns import basin_key, gauge_int
    g = Fixtures(spark, sf_dir).gauges
    return g.select("gauge_id", gauge_suffix("gauge_id").alias("suffix"),
                    basin_key(gauge_suffix("gauge_id")).alias("basin_key"),
                    gauge_int(gauge_suffix("gauge_id")).alias("gauge_int"))


@register("cfs_to_cms", with_views(
    "SELECT gauge_id, strftime(date, '%Y-%m-%d') AS date, "
    "0.0::DOUBLE + round(TRY_CAST(value AS DOUBLE) * 0.0283168, 4) AS streamflow_cms "
    "FROM flow_text WHERE TRY_CAST(value AS DOUBLE) IS NOT NULL", "flow_text"))
def q_cfs_to_cms(spark, sf_dir):
    """Text to number (``Ice`` -> missing), drop missing, cfs -> cms."""
    from ..functions.columns import cfs_to_cms, to_number
    t = Fixtures(spark, sf_dir).flow_text
    v = t.select("gauge_id", "date", to_number("value").alias("cfs")).dropna(subset=["cfs"])
    return v.select("gauge_id", iso_date("date").alias("date"),
                    rnd(cfs_to_cms("cfs"), 4).alias("streamflow_cms"))


@register("date_parts", with_views(
    "SELECT gauge_id AS site_no, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, "
    "CAST(day(date) AS INTEGER) AS day, 0.0::DOUBLE + round(streamflow_cms, 4) AS streamflow, "
    "strftime(make_date(year(date), month(date), day(date)), '%Y-%m-%d') AS datetime "
    "FROM flow_dense WHERE date BETWEEN DATE '1981-01-01' AND DATE '2011-01-31'", "flow_dense"))
def q_date_parts(spark, sf_dir):
    """Site id column, date parts, date rebuilt from parts."""
    from ..functions.columns import date_from_parts
    fl = Fixtures(spark, sf_dir).flow_dense.where(
        F.col("date").between(F.lit("1981-01-01").cast("date"), F.lit("2011-01-31").cast("date")))
    p = fl.select(F.col("gauge_id").alias("site_no"), F.year("date").alias("year"),
                  F.month("date").alias("month"), F.dayofmonth("date").alias("day"),
                  rnd("streamflow_cms", 4).alias("streamflow"))
    return p.withColumn("datetime", iso_date(date_from_parts("year", "month", "day")))


@register("missing_flags", with_views(
    "SELECT basin_id, COUNT(*) AS n_cells, "
    "COUNT(*) FILTER (WHERE precip IS NULL OR isnan(precip)) AS n_missing_precip, "
    "COUNT(*) FILTER (WHERE temp IS NULL OR isnan(temp) OR isinf(temp)) AS n_missing_temp "
    "FROM obs_holes GROUP BY basin_id", "obs_holes"))
def q_missing_flags(spark, sf_dir):
    """NaN/NULL (and Inf) predicate, counted per basin."""
    from ..functions.columns import is_missing
    o = Fixtures(spark, sf_dir).obs_holes
    return o.groupBy("basin_id").agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.count(F.when(is_missing("precip"), 1)).alias("n_missing_precip"),
        F.count(F.when(is_missing("temp", check_inf=True), 1)).alias("n_missing_temp"))


@register("segment_flag", with_views(
    "SELECT split, flag, COUNT(*) AS n_steps FROM mixed WHERE reason IS NULL GROUP BY split, flag",
    "gauges", "flow", "obs", "fcst", extra=osql.mixed_ctes()))
def q_segment_flag(spark, sf_dir):
    """Weather segment flag 0/1/2 of accepted steps, counted per split."""
    s = smp.apply_scope(mixed_steps(Fixtures(spark, sf_dir)), "sample")
    return s.groupBy("split", "flag").agg(F.count(F.lit(1)).alias("n_steps"))


# --------------------------------------------------------------------------
# calendars and the candidate grid
# --------------------------------------------------------------------------

def _cal_with_flow(spark, f: Fixtures, blocks, stride) -> DataFrame:
    per_day = f.flow.groupBy("date").agg(F.count(F.lit(1)).alias("n_gauges"))
    c = cal.issue_calendar(spark, blocks, stride)
    return (c.join(per_day, c.issue_date == per_day.date, "left")
            .select("split", iso_date("issue_date").alias("issue_date"),
                    F.coalesce("n_gauges", F.lit(0)).alias("n_gauges")))


_CAL_FLOW_SQL = ("SELECT c.split, strftime(c.issue_date, '%Y-%m-%d') AS issue_date, "
                 "COALESCE(n.n_gauges, 0) AS n_gauges FROM c LEFT JOIN "
                 "(SELECT date, COUNT(*) AS n_gauges FROM flow GROUP BY date) n ON n.date = c.issue_date")


@register("issue_calendar", with_views(_CAL_FLOW_SQL, "flow",
                                       extra={"c": fx.calendar_sql(MIXED_BLOCKS, 5)}))
def q_issue_calendar(spark, sf_dir):
    """5-day issue calendar per split, with the gauges reporting that day."""
    return _cal_with_flow(spark, Fixtures(spark, sf_dir), MIXED_BLOCKS, 5)


@register("issue_calendar_years", with_views(_CAL_FLOW_SQL, "flow",
                                             extra={"c": fx.calendar_sql(fx.ANNUAL_BLOCKS, "year-start")}))
def q_issue_calendar_years(spark, sf_dir):
    """Year-start issue calendar."""
    return _cal_with_flow(spark, Fixtures(spark, sf_dir), fx.ANNUAL_BLOCKS, "year-start")


@register("split_assignment", with_views(
    "SELECT gauge_id, COALESCE(CASE "
    + " ".join(f"WHEN date BETWEEN DATE '{a}' AND DATE '{b}' THEN '{s}'" for s, (a, b) in MIXED_BLOCKS.items())
    + " END, 'none') AS split, COUNT(*) AS n_days FROM flow GROUP BY ALL", "flow"))
def q_split_assignment(spark, sf_dir):
    """C4: split of an arbitrary date (flow days per gauge and split)."""
    fl = Fixtures(spark, sf_dir).flow
    sp = F.coalesce(cal.split_of("date", MIXED_BLOCKS), F.lit("none"))
    return fl.groupBy("gauge_id", sp.alias("split")).agg(F.count(F.lit(1)).alias("n_days"))


@register("candidates", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date FROM cand",
    "gauges", "flow", extra={"cal": fx.calendar_sql(MIXED_BLOCKS, 5),
                             "cand": osql.mixed_ctes()["cand"]}))
def q_candidates(spark, sf_dir):
    """C3 + J9: gauges with flow x issue calendar (generated, no join)."""
    c = mixed_candidates(Fixtures(spark, sf_dir))
    return c.select("basin_id", "split", iso_date("issue_date").alias("forecast_date"))


# --------------------------------------------------------------------------
# window joins
# --------------------------------------------------------------------------

def _flow_window_stats(spark, sf_dir, lo, hi, blocks=MIXED_BLOCKS, stride=5, dense=False):
    from ..operators.windows import fan_out
    f = Fixtures(spark, sf_dir)
    fl = f.flow_dense if dense else f.flow
    ser = fl.select(F.col("gauge_id").alias("basin_id"), "date", "streamflow_cms")
    fan = fan_out(ser, "basin_id", blocks, stride, lo, hi)
    return fan.groupBy("basin_id", "block", "split", "issue_date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.date_format(F.min("date"), "yyyy-MM-dd").alias("first_date"),
        F.date_format(F.max("date"), "yyyy-MM-dd").alias("last_date"),
        rnd(F.sum("streamflow_cms"), 2).alias("total")
    ).select("basin_id", "split", iso_date("issue_date").alias("forecast_date"),
             "n_rows", "first_date", "last_date", "total")


def _flow_window_sql(lo, hi, cal_sql, flow="flow"):
    return with_views(
        "SELECT f.gauge_id AS basin_id, c.split, strftime(c.issue_date, '%Y-%m-%d') AS forecast_date, "
        "COUNT(*) AS n_rows, strftime(MIN(f.date), '%Y-%m-%d') AS first_date, "
        "strftime(MAX(f.date), '%Y-%m-%d') AS last_date, 0.0::DOUBLE + round(SUM(f.streamflow_cms), 2) AS total "
        f"FROM c JOIN {flow} f ON f.date BETWEEN c.issue_date + ({lo}) AND c.issue_date + ({hi}) "
        "GROUP BY ALL", flow, extra={"c": cal_sql})


@register("weekly_rows", _flow_window_sql(-305, -61, fx.calendar_sql(MIXED_BLOCKS, 5)))
def q_weekly_rows(spark, sf_dir):
    """Look-back slice t0-305 .. t0-61 of every sample."""
    return _flow_window_stats(spark, sf_dir, -305, -61)


@register("daily_rows", _flow_window_sql(-60, -1, fx.calendar_sql(MIXED_BLOCKS, 5)))
def q_daily_rows(spark, sf_dir):
    """Daily slice t0-60 .. t0-1 (streamflow side)."""
    return _flow_window_stats(spark, sf_dir, -60, -1)


@register("horizon_rows", _flow_window_sql(0, 10, fx.calendar_sql(MIXED_BLOCKS, 5)))
def q_horizon_rows(spark, sf_dir):
    """Horizon slice t0 .. t0+10."""
    return _flow_window_stats(spark, sf_dir, 0, 10)


@register("annual_rows", _flow_window_sql(-365, 0, fx.calendar_sql(fx.ANNUAL_BLOCKS, "year-start"),
                                          flow="flow_dense"))
def q_annual_rows(spark, sf_dir):
    """Annual slice t0-365 .. t0 at year starts."""
    return _flow_window_stats(spark, sf_dir, -365, 0, fx.ANNUAL_BLOCKS, "year-start", dense=True)


def _near(f: Fixtures) -> DataFrame:
    from ..operators.asof import nearest_asof
    fc = f.fcst.select(gauge_suffix("basin_id").alias("basin_id"), "issue_date")
    return nearest_asof(mixed_candidates(f), fc, "basin_id", "issue_date", "issue_date", out="fc_issue")


_NEAR_CTES = {k: v for k, v in osql.mixed_ctes().items() if k in ("cal", "cand", "fi", "prv", "nxt", "near")}


@register("nearest_issue", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, "
    "strftime(fc_issue, '%Y-%m-%d') AS fc_issue, CAST(date_diff('day', issue_date, fc_issue) AS INTEGER) AS diff_days "
    "FROM near", "gauges", "flow", "fcst", extra=_NEAR_CTES))
def q_nearest_issue(spark, sf_dir):
    """Nearest forecast issue in either direction, ties to the later one."""
    n = _near(Fixtures(spark, sf_dir))
    return n.select("basin_id", "split", iso_date("issue_date").alias("forecast_date"),
                    iso_date("fc_issue").alias("fc_issue"),
                    F.datediff("fc_issue", "issue_date").alias("diff_days"))


_LEAD_SQL = ("SELECT n.basin_id, n.split, strftime(n.issue_date, '%Y-%m-%d') AS forecast_date, "
             "CAST(l.lead_rank AS INTEGER) AS lead_rank, l.lead_days, "
             "strftime(CAST(l.issue_date + l.lead_days AS DATE), '%Y-%m-%d') AS valid_date, "
             "CAST(date_diff('day', n.issue_date, CAST(l.issue_date + l.lead_days AS DATE)) AS INTEGER) AS days_ahead{vals} "
             "FROM near n JOIN leads l ON l.basin_id = n.basin_id AND l.issue_date = n.fc_issue "
             "WHERE l.lead_rank <= 10")


def _leads(spark, sf_dir, with_values: bool):
    from ..operators.asof import first_leads, valid_time
    f = Fixtures(spark, sf_dir)
    fc = f.fcst.withColumn("basin_id", gauge_suffix("basin_id"))
    leads = first_leads(fc, "basin_id", 10).withColumnRenamed("issue_date", "fc_issue")
    j = _near(f).join(leads, ["basin_id", "fc_issue"])
    vd = valid_time("fc_issue", "lead_days")
    cols = ["basin_id", "split", iso_date("issue_date").alias("forecast_date"),
            F.col("lead_rank").cast("int").alias("lead_rank"), "lead_days",
            iso_date(vd).alias("valid_date"), F.datediff(vd, "issue_date").alias("days_ahead")]
    if with_values:
        cols += [r4(c) for c in WEATHER3]
    return j.select(*cols)


_LEAD_CTES = dict(_NEAR_CTES, leads=osql.mixed_ctes()["leads"])


@register("first_leads", with_views(
    _LEAD_SQL.format(vals=", " + ", ".join(osql.r4(f"l.v{i}", c) for i, c in enumerate(WEATHER3))),
    "gauges", "flow", "fcst", extra=_LEAD_CTES))
def q_first_leads(spark, sf_dir):
    """First 10 leads of the matched forecast, with values."""
    return _leads(spark, sf_dir, True)


@register("valid_time", with_views(_LEAD_SQL.format(vals=""), "gauges", "flow", "fcst", extra=_LEAD_CTES))
def q_valid_time(spark, sf_dir):
    """valid date = matched issue + lead, replacing the lead axis."""
    return _leads(spark, sf_dir, False)


# --------------------------------------------------------------------------
# joins with lookups
# --------------------------------------------------------------------------

_STATIC_STATS_SQL = (
    "SELECT i AS idx, AVG(x) AS mean, STDDEV_POP(x) AS std FROM "
    "(SELECT features[i] AS x, i - 1 AS i FROM static, range(1, 5) r(i)) "
    "WHERE x IS NOT NULL AND NOT isnan(x) GROUP BY i")


@register("fit_static_scaler", with_views(
    "SELECT CAST(idx AS INTEGER) AS idx, 0.0::DOUBLE + round(mean, 4) AS mean, 0.0::DOUBLE + round(std, 4) AS std FROM st",
    "static", extra={"st": _STATIC_STATS_SQL}))
def q_fit_static_scaler(spark, sf_dir):
    """Per-position nan-mean / population nan-std of the static vectors."""
    from ..operators.scaling import fit_static_scaler
    st = fit_static_scaler(Fixtures(spark, sf_dir).static)
    return st.select(F.col("idx").cast("int").alias("idx"), r4("mean"), r4("std"))


@register("attach_static", with_views(
    "SELECT c.basin_id, c.split, strftime(c.issue_date, '%Y-%m-%d') AS forecast_date, "
    + ", ".join(
        f"0.0::DOUBLE + round((s.features[{i + 1}] - (SELECT mean FROM st WHERE idx = {i})) / "
        f"((SELECT std FROM st WHERE idx = {i}) + 1e-6), 6) AS s{i}" for i in range(4))
    + " FROM cand c JOIN static s ON s.gauge_id = c.basin_id",
    "gauges", "flow", "static", extra={"cal": fx.calendar_sql(MIXED_BLOCKS, 5),
                                       "cand": osql.mixed_ctes()["cand"], "st": _STATIC_STATS_SQL}))
def q_attach_static(spark, sf_dir):
    """J7 + F1: normalised static vector attached to every candidate sample."""
    from ..operators.scaling import attach_static, fit_static_scaler, normalize_static
    f = Fixtures(spark, sf_dir)
    st = normalize_static(f.static, fit_static_scaler(f.static))
    j = attach_static(mixed_candidates(f), st, "basin_id", "gauge_id", how="error")
    return j.select("basin_id", "split", iso_date("issue_date").alias("forecast_date"),
                    *[rnd(F.col("features")[i], 6).alias(f"s{i}") for i in range(4)])


@register("static_hook", with_views(
    "SELECT gauge_id, " + ", ".join(f"0.0::DOUBLE + round(ln(1 + abs(features[{i + 1}])), 6) AS s{i}" for i in range(4))
    + " FROM static", "static"))
def q_static_hook(spark, sf_dir):
    """Caller-supplied transform of the static vectors (a log scale)."""
    from ..operators.evaluate import apply_static_hook
    st = apply_static_hook(Fixtures(spark, sf_dir).static, lambda c: F.transform(c, lambda x: F.log1p(F.abs(x))))
    return st.select("gauge_id", *[rnd(F.col("features")[i], 6).alias(f"s{i}") for i in range(4)])


@register("gauge_names", with_views(
    "SELECT g.basin_id, COALESCE(n.gauge_name, 'Unknown') AS gauge_name FROM "
    "(SELECT DISTINCT string_split(gauge_id, '_')[-1] AS basin_id FROM gauges) g "
    "LEFT JOIN (SELECT gauge_id, MIN(gauge_name) AS gauge_name FROM gauge_names GROUP BY 1) n "
    "ON n.gauge_id = TRY_CAST(g.basin_id AS INTEGER)", "gauges", "gauge_names"))
def q_gauge_names(spark, sf_dir):
    """J8 + S6: name lookup on the integer id via the landed ``;`` file."""
    from ..operators.evaluate import with_gauge_name
    from ..sources.readers import read_gauge_names
    f = Fixtures(spark, sf_dir)
    names = read_gauge_names(spark, f.names_csv)
    g = f.gauges.select(gauge_suffix("gauge_id").alias("basin_id")).distinct()
    return with_gauge_name(g, names, "basin_id").select("basin_id", "gauge_name")


MIN_END = "2001-07-25"

_PARSED_FLOW_SQL = ("SELECT gauge_id, date, TRY_CAST(value AS DOUBLE) * 0.0283168 AS streamflow_cms "
                    "FROM flow_text WHERE TRY_CAST(value AS DOUBLE) IS NOT NULL")
_COVER_SQL = ("SELECT gauge_id, COUNT(*) AS n_rows, MAX(date) AS last_date, "
              f"CASE WHEN MAX(date) < DATE '{MIN_END}' THEN 'stale' END AS reason FROM pf GROUP BY gauge_id")


def _parsed_flow(f: Fixtures) -> DataFrame:
    from ..functions.columns import cfs_to_cms, to_number
    return f.flow_text.select("gauge_id", "date", cfs_to_cms(to_number("value")).alias("streamflow_cms"))


@register("usable_gauges", with_views(
    "SELECT g.gauge_id, c.n_rows, strftime(c.last_date, '%Y-%m-%d') AS last_date FROM "
    "(SELECT string_split(gauge_id, '_')[-1] AS gauge_id FROM gauges) g JOIN cov c "
    "ON c.gauge_id = g.gauge_id WHERE c.reason IS NULL", "gauges", "flow_text",
    extra={"pf": _PARSED_FLOW_SQL, "cov": _COVER_SQL}))
def q_usable_gauges(spark, sf_dir):
    """Gauges whose record is non-empty and reaches the required end."""
    from ..operators.quality import coverage
    f = Fixtures(spark, sf_dir)
    g = f.gauges.select(gauge_suffix("gauge_id").alias("gauge_id"))
    cov = coverage(_parsed_flow(f), MIN_END)
    good = g.join(cov.where(F.col("reason").isNull()), "gauge_id")
    return good.select("gauge_id", "n_rows", iso_date("last_date").alias("last_date"))


@register("skipped_gauges", with_views(
    "SELECT g.gauge_id, COALESCE(c.reason, 'no_data') AS reason, "
    "strftime(c.last_date, '%Y-%m-%d') AS last_date FROM "
    "(SELECT string_split(gauge_id, '_')[-1] AS gauge_id FROM gauges) g LEFT JOIN cov c "
    "ON c.gauge_id = g.gauge_id WHERE c.reason IS NOT NULL OR c.gauge_id IS NULL",
    "gauges", "flow_text", extra={"pf": _PARSED_FLOW_SQL, "cov": _COVER_SQL}))
def q_skipped_gauges(spark, sf_dir):
    """Gauges without usable streamflow and why (anti-join)."""
    from ..operators.quality import skipped_gauges
    f = Fixtures(spark, sf_dir)
    g = f.gauges.select(gauge_suffix("gauge_id").alias("gauge_id"))
    s = skipped_gauges(g, _parsed_flow(f), MIN_END)
    return s.select("gauge_id", "reason", iso_date("last_date").alias("last_date"))


# --------------------------------------------------------------------------
# target side, batches and resume
# --------------------------------------------------------------------------

def target_steps(f: Fixtures, split: str | None = None) -> DataFrame:
    return smp.target_steps(f.flow, split_blocks(MIXED_BLOCKS, split), 5)


def accepted_targets(f: Fixtures) -> DataFrame:
    """Samples whose streamflow side passes both gates (one row per sample)."""
    st = target_steps(f).where(F.col("reason").isNull())
    return (st.groupBy("basin_id", "block", "split", "issue_date").agg(F.count(F.lit(1)).alias("n"))
            .select("basin_id", "split", "issue_date", iso_date("issue_date").alias("forecast_date")))


_TARGET = osql.target_ctes()


@register("target_segments", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, step, seg, "
    + osql.r4("target") + " FROM target WHERE reason IS NULL", "flow", extra=_TARGET))
def q_target_segments(spark, sf_dir):
    """Weekly ++ daily ++ horizon streamflow of every valid sample."""
    st = target_steps(Fixtures(spark, sf_dir)).where(F.col("reason").isNull())
    return st.select("basin_id", "split", iso_date("issue_date").alias("forecast_date"),
                     "step", "seg", r4("target"))


@register("resample_weekly", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, "
    "CAST(floor(date_diff('day', anchor, date) / 7) AS INTEGER) AS bin, "
    "strftime(MIN(anchor), '%Y-%m-%d') AS anchor, COUNT(*) AS n_days, 0.0::DOUBLE + round(AVG(v0), 4) AS mean_flow "
    "FROM tbins WHERE seg = 0 GROUP BY basin_id, split, issue_date, bin", "flow", extra=_TARGET))
def q_resample_weekly(spark, sf_dir):
    """7-day means anchored at the first present day of the slice."""
    from ..operators.samples import SAMPLE_KEYS
    from ..operators.windows import fan_out, weekly_bins
    f = Fixtures(spark, sf_dir)
    ser = f.flow.select(F.col("gauge_id").alias("basin_id"), "date", "streamflow_cms")
    fan = fan_out(ser, "basin_id", MIXED_BLOCKS, 5, -305, 10)
    fan = weekly_bins(fan, SAMPLE_KEYS, F.col("off") < -60).where(F.col("bin").isNotNull())
    g = fan.groupBy(*smp.SAMPLE_GROUP, "bin").agg(
        F.min("anchor").alias("anchor"), F.count(F.lit(1)).alias("n_days"),
        rnd(F.avg("streamflow_cms"), 4).alias("mean_flow"))
    return g.select("basin_id", "split", iso_date("issue_date").alias("forecast_date"), "bin",
                    iso_date("anchor").alias("anchor"), "n_days", "mean_flow")


_BATCH_SQL = ("SELECT *, CAST(floor((rn - 1) / {size}) AS INTEGER) AS batch_id, "
              "CAST((rn - 1) % {size} AS INTEGER) AS pos_in_batch FROM (SELECT basin_id, split, issue_date, "
              "ROW_NUMBER() OVER (PARTITION BY split ORDER BY basin_id, issue_date) AS rn "
              "FROM target WHERE reason IS NULL GROUP BY basin_id, split, issue_date)")


def _batched(f: Fixtures, size: int) -> DataFrame:
    from ..operators.ranking import assign_batches
    return assign_batches(accepted_targets(f), size, ["basin_id", "issue_date"], within=["split"])


@register("assign_batches", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, batch_id, pos_in_batch, "
    "split || '_data_batch' || lpad(CAST(batch_id AS VARCHAR), 5, '0') AS file_name FROM b",
    "flow", extra=dict(_TARGET, b=_BATCH_SQL.format(size=200))))
def q_assign_batches(spark, sf_dir):
    """200 samples per numbered batch file within each split."""
    from ..operators.ranking import batch_names
    b = batch_names(_batched(Fixtures(spark, sf_dir), 200))
    return b.select("basin_id", "split", "forecast_date", "batch_id", "pos_in_batch", "file_name")


@register("shuffle_batches", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, "
    "CAST(floor((rn - 1) / 16) AS INTEGER) AS batch_id, CAST((rn - 1) % 16 AS INTEGER) AS pos_in_batch "
    "FROM (SELECT basin_id, split, issue_date, ROW_NUMBER() OVER (PARTITION BY split ORDER BY "
    "md5(basin_id || '|' || strftime(issue_date, '%Y-%m-%d') || '|1'), basin_id, issue_date) AS rn "
    "FROM target WHERE reason IS NULL GROUP BY basin_id, split, issue_date)", "flow", extra=_TARGET))
def q_shuffle_batches(spark, sf_dir):
    """Per-epoch shuffled batches of 16 (MD5 order of keys and seed)."""
    from ..operators.ranking import assign_batches, shuffle_key
    s = accepted_targets(Fixtures(spark, sf_dir)).withColumn(
        "_h", shuffle_key(["basin_id", "forecast_date"], seed=1))
    b = assign_batches(s, 16, ["_h", "basin_id", "issue_date"], within=["split"])
    return b.select("basin_id", "split", "forecast_date", "batch_id", "pos_in_batch")


_EPOCH_SEED, _EPOCH_ROUNDS = 3, 24


def _epoch_sql() -> str:
    """The keyed permutation of places, round by round."""
    from ..operators.ranking import _PRIME, round_keys
    keys = ", ".join(f"({r}, {a}, {b}, {c})" for r, (a, b, c) in enumerate(round_keys(_EPOCH_SEED, _EPOCH_ROUNDS)))
    mirror = "(((s - x) % total) + total) % total"
    return (f"WITH RECURSIVE key(r, s, a, c) AS (VALUES {keys}), walk(split, basin_id, issue_date, total, x, r) AS ("
            "SELECT split, basin_id, issue_date, COUNT(*) OVER (PARTITION BY split), (rn - 1)::BIGINT, 0 FROM b UNION ALL "
            f"SELECT split, basin_id, issue_date, total, CASE WHEN ((greatest(x, {mirror}) % {_PRIME}) * a::BIGINT + c) % {_PRIME} % 2 = 1 "
            f"THEN {mirror} ELSE x END, walk.r + 1 FROM walk JOIN key ON key.r = walk.r) SELECT * FROM walk WHERE r = {_EPOCH_ROUNDS}")


@register("epoch_batches", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, CAST(floor(x / 16) AS INTEGER) AS batch_id, "
    f"CAST(x % 16 AS INTEGER) AS pos_in_batch FROM ({_epoch_sql()})",
    "flow", extra=dict(_TARGET, b=_BATCH_SQL.format(size=200))))
def q_epoch_batches(spark, sf_dir):
    """An epoch's batches of 16 by a keyed permutation of the numbers that
    the samples were given once."""
    from ..operators.ranking import epoch_batches
    b = epoch_batches(_batched(Fixtures(spark, sf_dir), 200), 16, _EPOCH_SEED)
    return b.select("basin_id", "split", "forecast_date", "batch_id", "pos_in_batch")


_DONE_BATCHES = 10


@register("resume", with_views(
    "SELECT c.basin_id, c.split, strftime(c.issue_date, '%Y-%m-%d') AS forecast_date FROM cand c "
    f"ANTI JOIN (SELECT * FROM b WHERE split = 'train' AND batch_id < {_DONE_BATCHES}) d "
    "ON d.basin_id = c.basin_id AND d.split = c.split AND d.issue_date = c.issue_date",
    "gauges", "flow", extra=dict(_TARGET, cal=fx.calendar_sql(MIXED_BLOCKS, 5),
                                 cand=osql.mixed_ctes()["cand"], b=_BATCH_SQL.format(size=200))))
def q_resume(spark, sf_dir):
    """Candidates left after an earlier run wrote the first train batches."""
    from ..operators.ranking import resume_candidates
    f = Fixtures(spark, sf_dir)
    done = _batched(f, 200).where((F.col("split") == "train") & (F.col("batch_id") < _DONE_BATCHES))
    r = resume_candidates(mixed_candidates(f), done)
    return r.select("basin_id", "split", iso_date("issue_date").alias("forecast_date"))


@register("resume_state", with_views(
    "SELECT s.split, l.basin_id AS last_basin, strftime(l.issue_date, '%Y-%m-%d') AS last_date, "
    "COALESCE(l.batch_id + 1, 0) AS next_batch FROM (VALUES ('train'), ('validation'), ('test'), ('holdout')) s(split) "
    "LEFT JOIN (SELECT split, arg_max(basin_id, rn) AS basin_id, arg_max(issue_date, rn) AS issue_date, "
    "MAX(batch_id) AS batch_id FROM b GROUP BY split) l ON l.split = s.split",
    "flow", extra=dict(_TARGET, b=_BATCH_SQL.format(size=200))))
def q_resume_state(spark, sf_dir):
    """Last written key and next batch number per split (0 if none)."""
    from ..operators.ranking import resume_state
    b = _batched(Fixtures(spark, sf_dir), 200)
    return resume_state(b, ["train", "validation", "test", "holdout"])


# --------------------------------------------------------------------------
# quality gates and reports
# --------------------------------------------------------------------------

def _sample_counts(steps: DataFrame) -> DataFrame:
    """Per sample: lengths, non-missing step counts, gate reason (no exchange)."""
    return steps.groupBy(*smp.SAMPLE_GROUP, "reason").agg(
        F.max("len_target").alias("len_target"), F.max("len_weather").alias("len_weather"),
        F.count("precip").alias("n_precip"), F.count("temp").alias("n_temp"),
        F.count("net_solar").alias("n_solar"), F.count("target").alias("n_target"))


_MIX = osql.mixed_ctes()
_MIX_HOLES = osql.mixed_ctes(obs="obs_holes")
_SAMPLE_SQL = ("SELECT basin_id, split, issue_date, strftime(issue_date, '%Y-%m-%d') AS forecast_date, "
               "MAX(len_target) AS len_target, MAX(len_weather) AS len_weather, COUNT(precip) AS n_precip, "
               "COUNT(temp) AS n_temp, COUNT(net_solar) AS n_solar, COUNT(target) AS n_target, "
               "MAX(reason) AS reason FROM mixed GROUP BY basin_id, split, issue_date")


@register("sequence_length", with_views(
    "SELECT basin_id, split, forecast_date, len_target, len_weather FROM sq",
    "gauges", "flow", "obs", "fcst", extra=dict(_MIX, sq=_SAMPLE_SQL)))
def q_sequence_length(spark, sf_dir):
    """A2: target and weather sequence length of every sample."""
    s = _sample_counts(mixed_steps(Fixtures(spark, sf_dir)))
    return s.select("basin_id", "split", iso_date("issue_date").alias("forecast_date"),
                    "len_target", "len_weather")


@register("length_histogram", with_views(
    "SELECT split, len_target, len_weather, COUNT(*) AS n_samples, "
    "(len_target = 106 AND len_weather = 106) AS expected FROM sq GROUP BY split, len_target, len_weather",
    "gauges", "flow", "obs", "fcst", extra=dict(_MIX, sq=_SAMPLE_SQL)))
def q_length_histogram(spark, sf_dir):
    """Samples per length and whether it is the declared length."""
    from ..operators.quality import length_histogram, require_valid
    s = smp.sample_stats(mixed_steps(Fixtures(spark, sf_dir)))
    expected = smp.MixedRecipe().expected_len
    return length_histogram(require_valid(s, expected), expected)


@register("sample_quality", with_views(
    "SELECT basin_id, split, forecast_date, len_target, len_weather, n_precip, n_temp, n_solar, n_target, "
    "(n_precip < len_weather OR n_target < len_target) AS bad_precip_target, "
    "(n_precip < len_weather OR n_temp < len_weather OR n_solar < len_weather OR n_target < len_target) AS bad_all "
    "FROM sq", "gauges", "flow", "obs_holes", "fcst", extra=dict(_MIX_HOLES, sq=_SAMPLE_SQL)))
def q_sample_quality(spark, sf_dir):
    """A4: missing values per sample under both NaN policies (grid with holes)."""
    f = Fixtures(spark, sf_dir)
    s = _sample_counts(mixed_steps(f, obs=f.obs_holes))
    lw, lt = F.col("len_weather"), F.col("len_target")
    return s.select("basin_id", "split", iso_date("issue_date").alias("forecast_date"),
                    "len_target", "len_weather", "n_precip", "n_temp", "n_solar", "n_target",
                    ((F.col("n_precip") < lw) | (F.col("n_target") < lt)).alias("bad_precip_target"),
                    ((F.col("n_precip") < lw) | (F.col("n_temp") < lw) | (F.col("n_solar") < lw)
                     | (F.col("n_target") < lt)).alias("bad_all"))


@register("drop_bad_groups", with_views(
    "SELECT basin_id, split, COUNT(*) AS n_candidates, "
    "COUNT(*) FILTER (WHERE reason IS NULL) AS n_kept_sample, "
    "CASE WHEN COUNT(*) FILTER (WHERE reason = 'missing_values') > 0 THEN 0 "
    "ELSE COUNT(*) FILTER (WHERE reason IS NULL) END AS n_kept_group FROM sq GROUP BY basin_id, split",
    "gauges", "flow", "obs_holes", "fcst", extra=dict(_MIX_HOLES, sq=_SAMPLE_SQL)))
def q_drop_bad_groups(spark, sf_dir):
    """A5: samples kept per (gauge, split) in sample scope and in group scope."""
    f = Fixtures(spark, sf_dir)
    stats = _gates(f, f.obs_holes)
    kept = F.count(F.when(F.col("reason").isNull(), 1))
    failed = F.count(F.when(F.col("reason") == "missing_values", 1))
    return stats.groupBy("basin_id", "split").agg(
        F.count(F.lit(1)).alias("n_candidates"), kept.alias("n_kept_sample"),
        F.when(failed > 0, F.lit(0)).otherwise(kept).alias("n_kept_group"))


@register("combine_splits", with_views(
    "SELECT split, COUNT(DISTINCT basin_id) AS n_files, COUNT(*) AS n_samples FROM sq s WHERE reason IS NULL "
    "AND NOT EXISTS (SELECT 1 FROM sq b WHERE b.basin_id = s.basin_id AND b.split = s.split "
    "AND b.reason = 'missing_values') GROUP BY split",
    "gauges", "flow", "obs_holes", "fcst", extra=dict(_MIX_HOLES, sq=_SAMPLE_SQL)))
def q_combine_splits(spark, sf_dir):
    """Per split, the (gauge) files that survive the NaN check, combined."""
    f = Fixtures(spark, sf_dir)
    kept = smp.scope_samples(_gates(f, f.obs_holes), "group")
    return kept.groupBy("split").agg(F.countDistinct("basin_id").alias("n_files"),
                                     F.count(F.lit(1)).alias("n_samples"))


@register("drop_report", with_views(
    "SELECT c.split, CASE WHEN s.basin_id IS NULL THEN 'no_data' ELSE COALESCE(s.reason, 'accepted') END "
    "AS outcome, COUNT(*) AS n_samples FROM cand c LEFT JOIN sq s ON s.basin_id = c.basin_id "
    "AND s.split = c.split AND s.issue_date = c.issue_date GROUP BY ALL",
    "gauges", "flow", "obs", "fcst", extra=dict(_MIX, sq=_SAMPLE_SQL)))
def q_drop_report(spark, sf_dir):
    """Candidates per split and outcome (accepted or first failed gate)."""
    from ..operators.quality import drop_report
    f = Fixtures(spark, sf_dir)
    return drop_report(mixed_candidates(f), _gates(f))


@register("run_summary", with_views(
    "SELECT basin_id, split, COUNT(DISTINCT issue_date) AS n_samples, "
    "split || '_' || basin_id || '_' || CAST(COUNT(DISTINCT issue_date) AS VARCHAR) AS filename "
    "FROM mixed WHERE reason IS NULL GROUP BY basin_id, split",
    "gauges", "flow", "obs", "fcst", extra=_MIX))
def q_run_summary(spark, sf_dir):
    """Accepted samples per (gauge, split) and the group file label."""
    from ..operators.quality import run_summary
    s = smp.apply_scope(mixed_steps(Fixtures(spark, sf_dir)), "sample")
    return run_summary(s, "basin_id", "split", "issue_date")


@register("null_report", with_views(
    "SELECT c AS column, CAST(n AS BIGINT) AS n_missing, n > 0 AS any_missing FROM (SELECT "
    + ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL OR isnan({c})) AS {c}" for c in smp.WEATHER6 + ["target"])
    + " FROM annual WHERE reason IS NULL AND split = 'train') UNPIVOT (n FOR c IN ("
    + ", ".join(smp.WEATHER6 + ["target"]) + "))",
    "flow_dense", "obs_holes", extra=osql.annual_ctes(obs="obs_holes")))
def q_null_report(spark, sf_dir):
    """Missing cells per column of the written train set (annual recipe)."""
    from ..operators.quality import null_report
    f = Fixtures(spark, sf_dir)
    st = smp.annual_steps(f.flow_dense, f.obs_holes, split_blocks(fx.ANNUAL_BLOCKS, "train"))
    acc = st.where(F.col("reason").isNull())
    return null_report(acc, smp.WEATHER6 + ["target"])


# --------------------------------------------------------------------------
# scaling (A8, F1-F4)
# --------------------------------------------------------------------------

DYN_FEATURES = WEATHER3 + ["flag"]
_TRAIN_MIX = "(SELECT * FROM mixed WHERE reason IS NULL AND split = 'train')"


def _accepted_mixed(f: Fixtures, split: str | None = None) -> DataFrame:
    return smp.apply_scope(mixed_steps(f, split=split), "sample")


def _gates(f: Fixtures, obs=None) -> DataFrame:
    """One row per candidate sample with its lengths and the gate it failed."""
    return smp.mixed_gates(f.flow, f.obs if obs is None else obs, f.fcst, mixed_candidates(f), MIXED_BLOCKS, 5)


def _written_mixed(f: Fixtures) -> DataFrame:
    """The accepted samples of every split, built once and written by split."""
    from ..sinks.writers import write_partitioned
    from ..sources.readers import read_partitioned
    path = f.scratch_path("mixed_by_split")
    write_partitioned(_accepted_mixed(f).select("basin_id", "split", "issue_date", "step", *DYN_FEATURES, "target"), path, ("split",))
    return read_partitioned(f.spark, path)


def _mixed_scaler(samples: DataFrame) -> DataFrame:
    """Train statistics, merged from those of each gauge."""
    from ..operators.scaling import merge_moments, partial_moments
    train = samples.where(F.col("split") == "train")
    return merge_moments(partial_moments(train, DYN_FEATURES + ["target"], ("basin_id",)))


@register("fit_scaler", with_views(
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, 0.0::DOUBLE + round(AVG(CAST({c} AS DOUBLE)), 4) AS mean, "
        f"0.0::DOUBLE + round(STDDEV_POP(CAST({c} AS DOUBLE)), 4) AS std FROM {_TRAIN_MIX}"
        for c in DYN_FEATURES + ["target"]),
    "gauges", "flow", "obs", "fcst", extra=_MIX))
def q_fit_scaler(spark, sf_dir):
    """Train-only per-feature mean and population std (samples x time)."""
    s = _mixed_scaler(_accepted_mixed(Fixtures(spark, sf_dir), "train"))
    return s.select("feature", r4("mean"), r4("std"))


def _scale_cte(train: str, features: list[str]) -> str:
    """One row with every feature's mean and deviation."""
    return "SELECT " + ", ".join(f"AVG(CAST({c} AS DOUBLE)) AS {c}_m, STDDEV_POP(CAST({c} AS DOUBLE)) AS {c}_sd"
                                 for c in features) + f" FROM {train}"


_SCALE_CTE = _scale_cte(_TRAIN_MIX, DYN_FEATURES + ["target"])


def _sc(c: str, what: str) -> str:
    return f"sc.{c}_{what}"


def _norm_sql(c: str) -> str:
    return f"(CAST({c} AS DOUBLE) - {_sc(c, 'm')}) / ({_sc(c, 'sd')} + 1e-6)"


@register("normalize", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, step, "
    + ", ".join(f"0.0::DOUBLE + round({_norm_sql(c)}, 6) AS {c}_n" for c in DYN_FEATURES + ["target"])
    + " FROM mixed, sc WHERE reason IS NULL",
    "gauges", "flow", "obs", "fcst", extra=dict(_MIX, sc=_SCALE_CTE)))
def q_normalize(spark, sf_dir):
    """samples of every split normalised with the train scaler."""
    from ..operators.scaling import apply_normalize
    f = Fixtures(spark, sf_dir)
    feats = DYN_FEATURES + ["target"]
    samples = _written_mixed(f)
    n = apply_normalize(samples, _mixed_scaler(samples), feats)
    return n.select("basin_id", "split", iso_date("issue_date").alias("forecast_date"), "step",
                    *[rnd(f"{c}_n", 6).alias(f"{c}_n") for c in feats])


@register("denormalize", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, step, "
    + ", ".join(f"0.0::DOUBLE + round({_norm_sql(c)} * ({_sc(c, 'sd')} + 1e-6) + {_sc(c, 'm')}, 4) AS {c}_d"
                for c in DYN_FEATURES + ["target"])
    + " FROM mixed, sc WHERE reason IS NULL",
    "gauges", "flow", "obs", "fcst", extra=dict(_MIX, sc=_SCALE_CTE)))
def q_denormalize(spark, sf_dir):
    """denormalise(normalise(x)) on every split (round trip)."""
    from ..operators.scaling import apply_denormalize, apply_normalize, scaler_params
    f = Fixtures(spark, sf_dir)
    feats = DYN_FEATURES + ["target"]
    samples = _written_mixed(f)
    params = scaler_params(_mixed_scaler(samples))
    n = apply_normalize(samples, params, feats)
    n = n.select("basin_id", "split", "issue_date", "step", *[F.col(f"{c}_n").alias(c) for c in feats])
    d = apply_denormalize(n, params, feats)
    return d.select("basin_id", "split", iso_date("issue_date").alias("forecast_date"), "step",
                    *[rnd(f"{c}_d", 4).alias(f"{c}_d") for c in feats])


ANNUAL_FEATURES = smp.WEATHER6 + ["target"]
_ANN = osql.annual_ctes()
_TRAIN_ANN = "(SELECT * FROM annual WHERE reason IS NULL AND split = 'train')"
_ASCALE_CTE = _scale_cte(_TRAIN_ANN, ANNUAL_FEATURES)


def _annual(f: Fixtures, split: str | None = None) -> DataFrame:
    blocks = split_blocks(fx.ANNUAL_BLOCKS, split)
    return smp.annual_steps(f.flow_dense, f.obs, blocks).where(F.col("reason").isNull())


def _std_sql(c: str) -> str:
    return f"(CAST({c} AS DOUBLE) - {_sc(c, 'm')}) / NULLIF({_sc(c, 'sd')}, 0)"


@register("standardize", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, step, "
    + ", ".join(f"0.0::DOUBLE + round({_std_sql(c)}, 6) AS {c}_s" for c in ANNUAL_FEATURES)
    + " FROM annual, sc WHERE reason IS NULL",
    "flow_dense", "obs", extra=dict(_ANN, sc=_ASCALE_CTE)))
def q_standardize(spark, sf_dir):
    """F3 (+A8): annual samples of every split standardised with train statistics."""
    from ..operators.scaling import apply_standardize, fit_scaler
    f = Fixtures(spark, sf_dir)
    sc = fit_scaler(_annual(f, "train"), ANNUAL_FEATURES)
    s = apply_standardize(_annual(f), sc, ANNUAL_FEATURES)
    return s.select("basin_id", "split", iso_date("issue_date").alias("forecast_date"), "step",
                    *[rnd(f"{c}_s", 6).alias(f"{c}_s") for c in ANNUAL_FEATURES])


@register("unstandardize", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, step, "
    + ", ".join(f"0.0::DOUBLE + round({_std_sql(c)} * {_sc(c, 'sd')} + {_sc(c, 'm')}, 4) AS {c}_u" for c in ANNUAL_FEATURES)
    + " FROM annual, sc WHERE reason IS NULL",
    "flow_dense", "obs", extra=dict(_ANN, sc=_ASCALE_CTE)))
def q_unstandardize(spark, sf_dir):
    """unstandardise(standardise(x)) round trip."""
    from ..operators.scaling import apply_standardize, apply_unstandardize, fit_scaler, scaler_params
    f = Fixtures(spark, sf_dir)
    params = scaler_params(fit_scaler(_annual(f, "train"), ANNUAL_FEATURES))
    s = apply_standardize(_annual(f), params, ANNUAL_FEATURES)
    s = s.select("basin_id", "split", "issue_date", "step", *[F.col(f"{c}_s").alias(c) for c in ANNUAL_FEATURES])
    u = apply_unstandardize(s, params, ANNUAL_FEATURES)
    return u.select("basin_id", "split", iso_date("issue_date").alias("forecast_date"), "step",
                    *[rnd(f"{c}_u", 4).alias(f"{c}_u") for c in ANNUAL_FEATURES])


@register("annual_samples", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, step, "
    + ", ".join(osql.r4(c) for c in ANNUAL_FEATURES) + " FROM annual WHERE reason IS NULL",
    "flow_dense", "obs", extra=_ANN))
def q_annual_samples(spark, sf_dir):
    """Annual recipe (J5, C2): 366 daily steps of six weather variables + flow."""
    a = _annual(Fixtures(spark, sf_dir))
    return a.select("basin_id", "split", iso_date("issue_date").alias("forecast_date"), "step",
                    *[r4(c) for c in ANNUAL_FEATURES])


@register("blocked_samples", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, step, "
    + ", ".join(osql.r4(c) for c in ANNUAL_FEATURES) + " FROM annual WHERE reason IS NULL",
    "flow_dense", "obs", extra=_ANN))
def q_blocked_samples(spark, sf_dir):
    """K6 + J5: annual samples from a series stored by (basin, time block)."""
    from ..sinks.blocked import read_blocked, write_blocked
    f = Fixtures(spark, sf_dir)
    path = f.scratch_path("blocked_series")
    write_blocked(smp.annual_series(f.flow_dense, f.obs), path, smp.AnnualRecipe().lo, 0)
    a = smp.annual_steps(None, None, fx.ANNUAL_BLOCKS, stored=read_blocked(spark, path)).where(F.col("reason").isNull())
    return a.select("basin_id", "split", iso_date("issue_date").alias("forecast_date"), "step",
                    *[r4(c) for c in ANNUAL_FEATURES])


# --------------------------------------------------------------------------
# metrics on predictions
# --------------------------------------------------------------------------

PRED_KEYS = ["basin_id", "block", "split", "issue_date"]


def predictions(f: Fixtures, split: str = "test") -> DataFrame:
    """Persistence forecast of one split: ``y_hat`` = previous step's ``y``.

    A test aid standing in for model output (the model is not data work).
    """
    from pyspark.sql import Window
    st = target_steps(f, split).where(F.col("reason").isNull())
    y = F.col("target").cast("double")
    w = Window.partitionBy(*PRED_KEYS).orderBy("step")
    return st.select(*PRED_KEYS, iso_date("issue_date").alias("forecast_date"), "step",
                     y.alias("y"), F.coalesce(F.lag(y).over(w), y).alias("y_hat"))


@register("scored_steps", with_views(
    "SELECT basin_id, forecast_date, step, 0.0::DOUBLE + round(y, 4) AS y, 0.0::DOUBLE + round(0.5 * (y + y_hat), 4) AS y_hat "
    "FROM pred", "flow", extra=_TARGET))
def q_scored_steps(spark, sf_dir):
    """A caller's model (mean of this and the last step), loaded once a
    worker, run on the executors over Arrow batches of the test steps."""
    from ..operators.evaluate import score_batches
    p = predictions(Fixtures(spark, sf_dir)).select("basin_id", "forecast_date", "step", "y", F.col("y_hat").alias("x"))
    out = score_batches(p, lambda pdf, half: half * (pdf["y"] + pdf["x"]), ["basin_id", "forecast_date", "step"],
                        "basin_id string, forecast_date string, step int, y double, y_hat double",
                        load=lambda: 0.5, model="mean of two")
    return out.select("basin_id", "forecast_date", "step", r4("y"), r4("y_hat"))


def _target_scaler(f: Fixtures):
    from ..operators.scaling import fit_scaler, scaler_params
    st = target_steps(f, "train").where(F.col("reason").isNull())
    return scaler_params(fit_scaler(st, ["target"]))["target"]


def _normalized_pred(f: Fixtures, split: str = "test") -> DataFrame:
    from ..functions.columns import normalize
    m, sd = _target_scaler(f)
    p = predictions(f, split)
    return p.withColumn("y", normalize("y", F.lit(m), F.lit(sd))).withColumn(
        "y_hat", normalize("y_hat", F.lit(m), F.lit(sd)))


_NSE_SQL = ("SELECT basin_id, split, issue_date, forecast_date, "
            "1 - SUM(POWER(y - y_hat, 2)) / (SUM(POWER(y - my, 2)) + 1e-6) AS nse "
            "FROM (SELECT *, AVG(y) OVER s AS my FROM pred WINDOW s AS (PARTITION BY basin_id, split, issue_date)) "
            "GROUP BY ALL")
_KGE_SQL = (
    "SELECT basin_id, split, issue_date, forecast_date, r, alpha, beta, "
    "1 - SQRT(POWER(r - 1, 2) + POWER(alpha - 1, 2) + POWER(beta - 1, 2)) AS kge FROM ("
    "SELECT basin_id, split, issue_date, forecast_date, "
    "SUM((y - my) * (y_hat - mh)) / (SQRT(SUM(POWER(y - my, 2))) * SQRT(SUM(POWER(y_hat - mh, 2))) + 1e-6) AS r, "
    "(STDDEV_SAMP(y_hat) + 1e-6) / (STDDEV_SAMP(y) + 1e-6) AS alpha, AVG(y_hat) / (AVG(y) + 1e-6) AS beta "
    "FROM (SELECT *, AVG(y) OVER s AS my, AVG(y_hat) OVER s AS mh FROM pred "
    "WINDOW s AS (PARTITION BY basin_id, split, issue_date)) GROUP BY ALL)")
_PRED_CTES = dict(_TARGET, nse=_NSE_SQL, kge=_KGE_SQL)


@register("mse", with_views(
    "SELECT 0.0::DOUBLE + round(AVG(POWER((y_hat - m) / (sd + 1e-6) - (y - m) / (sd + 1e-6), 2)), 8) AS mse "
    "FROM pred, tscale", "flow", extra=_PRED_CTES))
def q_mse(spark, sf_dir):
    """A10: MSE loss over all test samples x steps (normalised targets)."""
    from ..operators.metrics import metric
    return metric("mse")(_normalized_pred(Fixtures(spark, sf_dir)), PRED_KEYS).select(rnd("loss", 8).alias("mse"))


@register("nse", with_views("SELECT basin_id, forecast_date, 0.0::DOUBLE + round(nse, 6) AS nse FROM nse",
                            "flow", extra=_PRED_CTES))
def q_nse(spark, sf_dir):
    """Nash-Sutcliffe efficiency per test sample."""
    from ..operators.metrics import nse
    n = nse(predictions(Fixtures(spark, sf_dir)), PRED_KEYS + ["forecast_date"])
    return n.select("basin_id", "forecast_date", rnd("nse", 6).alias("nse"))


@register("kge", with_views(
    "SELECT basin_id, forecast_date, 0.0::DOUBLE + round(kge, 6) AS kge, 0.0::DOUBLE + round(r, 6) AS r, 0.0::DOUBLE + round(alpha, 6) AS alpha, "
    "0.0::DOUBLE + round(beta, 6) AS beta FROM kge", "flow", extra=_PRED_CTES))
def q_kge(spark, sf_dir):
    """Kling-Gupta efficiency and its components per test sample."""
    from ..operators.metrics import kge
    k = kge(predictions(Fixtures(spark, sf_dir)), PRED_KEYS + ["forecast_date"], components=True)
    return k.select("basin_id", "forecast_date", *[rnd(c, 6).alias(c) for c in ("kge", "r", "alpha", "beta")])


@register("tail_crop", with_views(
    "SELECT basin_id, forecast_date, COUNT(*) AS n_steps, "
    "0.0::DOUBLE + round(1 - SUM(POWER(y - y_hat, 2)) / (SUM(POWER(y - my, 2)) + 1e-6), 6) AS nse_tail FROM "
    "(SELECT *, AVG(y) OVER s AS my FROM pred WHERE step > 95 WINDOW s AS (PARTITION BY basin_id, split, issue_date)) "
    "GROUP BY basin_id, split, issue_date, forecast_date", "flow", extra=_PRED_CTES))
def q_tail_crop(spark, sf_dir):
    """NSE over the last 10 steps of every sample (loss_seq_len = 10)."""
    from ..operators.metrics import scores
    n = scores(predictions(Fixtures(spark, sf_dir)), PRED_KEYS + ["forecast_date"], 10)
    return n.select("basin_id", "forecast_date", F.col("steps").alias("n_steps"), rnd("nse", 6).alias("nse_tail"))


EVAL_BATCH = 16
_BATCH_PRED_SQL = (
    "SELECT k.*, n.nse, CAST(floor((ROW_NUMBER() OVER (ORDER BY k.basin_id, k.issue_date) - 1) / 16) AS INTEGER) "
    "AS batch_id FROM kge k JOIN nse n USING (basin_id, split, issue_date)")


def _per_batch(f: Fixtures) -> DataFrame:
    """Validation scores in batches; one pass over the predictions.  The loss
    is on normalised values: normalising divides squared errors by a constant."""
    from ..functions.columns import NORM_EPS
    from ..operators.metrics import batch_means, scores
    from ..operators.ranking import assign_batches
    scored = scores(predictions(f, "validation"), PRED_KEYS + ["forecast_date"])
    _, sd = _target_scaler(f)
    scored = scored.withColumn("squares", F.col("squares") / F.lit((sd + NORM_EPS) ** 2))
    return batch_means(assign_batches(scored, EVAL_BATCH, ["basin_id", "issue_date"]))


_PER_BATCH_SQL = (
    "SELECT b.batch_id, b.n_samples, b.mean_kge, b.mean_nse, l.loss FROM "
    "(SELECT batch_id, COUNT(*) AS n_samples, AVG(kge) AS mean_kge, AVG(nse) AS mean_nse FROM bk GROUP BY batch_id) b "
    "JOIN (SELECT bk.batch_id, AVG(POWER((p.y_hat - t.m) / (t.sd + 1e-6) - (p.y - t.m) / (t.sd + 1e-6), 2)) AS loss "
    "FROM pred p JOIN bk USING (basin_id, split, issue_date) CROSS JOIN tscale t GROUP BY bk.batch_id) l "
    "USING (batch_id)")
_VALIDATION = dict(osql.target_ctes(pred_split="validation"), nse=_NSE_SQL, kge=_KGE_SQL)
_METRIC_CTES = dict(_VALIDATION, bk=_BATCH_PRED_SQL, pb=_PER_BATCH_SQL)
# Normalised validation predictions, and the per-sample means a loss needs.
_NPRED = ("SELECT basin_id, split, issue_date, step, (y - m) / (sd + 1e-6) AS y, (y_hat - m) / (sd + 1e-6) AS y_hat "
          "FROM pred, tscale")
_LOSS_CTES = dict(osql.target_ctes(pred_split="validation"), np=_NPRED, nm=(
    "SELECT *, AVG(y) OVER s AS my, AVG(y_hat) OVER s AS mh FROM np "
    "WINDOW s AS (PARTITION BY basin_id, split, issue_date)"))


def _validation_loss(spark, sf_dir, name: str, seq_len: int | None = None) -> DataFrame:
    from ..operators.metrics import metric
    pred = _normalized_pred(Fixtures(spark, sf_dir), "validation")
    return metric(name, seq_len)(pred, PRED_KEYS).select(rnd("loss", 6).alias("loss"))


@register("nse_loss", with_views(
    "SELECT 0.0::DOUBLE + round(-AVG(nse), 6) AS loss FROM (SELECT 1 - SUM(POWER(y - y_hat, 2)) "
    "/ (SUM(POWER(y - my, 2)) + 1e-6) AS nse FROM nm GROUP BY basin_id, split, issue_date)",
    "flow", extra=_LOSS_CTES))
def q_nse_loss(spark, sf_dir):
    """NSE as a loss (negative mean) on normalised validation targets."""
    return _validation_loss(spark, sf_dir, "nse")


@register("kge_loss", with_views(
    "SELECT 0.0::DOUBLE + round(-AVG(1 - SQRT(POWER(r - 1, 2) + POWER(a - 1, 2) + POWER(b - 1, 2))), 6) AS loss FROM ("
    "SELECT SUM((y - my) * (y_hat - mh)) / (SQRT(SUM(POWER(y - my, 2))) * SQRT(SUM(POWER(y_hat - mh, 2))) + 1e-6) AS r, "
    "STDDEV_SAMP(y_hat) / (STDDEV_SAMP(y) + 1e-6) AS a, AVG(y_hat) / (AVG(y) + 1e-6) AS b "
    "FROM nm GROUP BY basin_id, split, issue_date)", "flow", extra=_LOSS_CTES))
def q_kge_loss(spark, sf_dir):
    """KGE as a loss, epsilon on the observed deviation only."""
    return _validation_loss(spark, sf_dir, "kge")


@register("mse_tail", with_views(
    "SELECT 0.0::DOUBLE + round(AVG(POWER(y_hat - y, 2)), 6) AS loss FROM np WHERE step > 95", "flow", extra=_LOSS_CTES))
def q_mse_tail(spark, sf_dir):
    """MSE loss over the last 10 steps of every validation sample."""
    return _validation_loss(spark, sf_dir, "mse", 10)


@register("metric_means", with_views(
    "SELECT batch_id, n_samples, 0.0::DOUBLE + round(mean_kge, 6) AS mean_kge, 0.0::DOUBLE + round(mean_nse, 6) AS mean_nse, "
    "0.0::DOUBLE + round(loss, 8) AS loss FROM pb", "flow", extra=_METRIC_CTES))
def q_metric_means(spark, sf_dir):
    """Per evaluation batch (16 samples) mean KGE, NSE and MSE loss."""
    b = _per_batch(Fixtures(spark, sf_dir))
    return b.select("batch_id", "n_samples", rnd("mean_kge", 6).alias("mean_kge"),
                    rnd("mean_nse", 6).alias("mean_nse"), rnd("loss", 8).alias("loss"))


@register("nan_median", with_views(
    "SELECT 0.0::DOUBLE + round(quantile_disc(mean_kge, 0.5), 6) AS median_kge, 0.0::DOUBLE + round(quantile_disc(mean_nse, 0.5), 6) "
    "AS median_nse, 0.0::DOUBLE + round(AVG(loss), 8) AS avg_loss FROM pb", "flow", extra=_METRIC_CTES))
def q_nan_median(spark, sf_dir):
    """A15 (+A14): lower nan-median of batch means; mean of batch losses."""
    from ..operators.metrics import mean_of_batches
    from ..sinks.tables import materialize
    f = Fixtures(spark, sf_dir)
    b = mean_of_batches(materialize(_per_batch(f), f.scratch_path("per_batch")))      # read once a pass
    return b.select(rnd("median_kge", 6).alias("median_kge"), rnd("median_nse", 6).alias("median_nse"),
                    rnd("avg_loss", 8).alias("avg_loss"))


def _scores(f: Fixtures) -> DataFrame:
    from ..operators.metrics import kge
    return kge(predictions(f), PRED_KEYS + ["forecast_date"])


@register("kge_cdf", with_views(
    "SELECT basin_id, forecast_date, 0.0::DOUBLE + round(kge, 6) AS kge, "
    "ROW_NUMBER() OVER (ORDER BY kge NULLS FIRST, basin_id, issue_date) AS rank, "
    "0.0::DOUBLE + round(ROW_NUMBER() OVER (ORDER BY kge NULLS FIRST, basin_id, issue_date) / COUNT(*) OVER (), 8) AS cdf "
    "FROM kge", "flow", extra=_PRED_CTES))
def q_kge_cdf(spark, sf_dir):
    """Empirical CDF of per-sample KGE (distributed ranking)."""
    from ..operators.evaluate import empirical_cdf
    c = empirical_cdf(_scores(Fixtures(spark, sf_dir)), "kge", ["basin_id", "issue_date"])
    return c.select("basin_id", "forecast_date", rnd("kge", 6).alias("kge"), "rank",
                    rnd("cdf", 8).alias("cdf"))


_NAMES_JOIN = ("LEFT JOIN (SELECT gauge_id, MIN(gauge_name) AS gauge_name FROM gauge_names GROUP BY 1) n "
               "ON n.gauge_id = TRY_CAST(t.basin_id AS INTEGER)")


@register("best_k", with_views(
    "SELECT CAST(rank AS INTEGER) AS rank, t.basin_id, COALESCE(n.gauge_name, 'Unknown') AS gauge_name, "
    "t.forecast_date, 0.0::DOUBLE + round(t.kge, 6) AS kge FROM (SELECT *, ROW_NUMBER() OVER "
    "(ORDER BY kge DESC NULLS LAST, basin_id, issue_date) AS rank FROM kge) t " + _NAMES_JOIN
    + " WHERE rank <= 10", "flow", "gauge_names", extra=_PRED_CTES))
def q_best_k(spark, sf_dir):
    """T2 + J8: the 10 best samples by KGE with gauge names."""
    from ..operators.evaluate import best_k, with_gauge_name
    f = Fixtures(spark, sf_dir)
    b = with_gauge_name(best_k(_scores(f), "kge", 10, ["basin_id", "issue_date"]), f.gauge_names)
    return b.select("rank", "basin_id", "gauge_name", "forecast_date", rnd("kge", 6).alias("kge"))


@register("worst_k", with_views(
    "SELECT CAST(ROW_NUMBER() OVER (ORDER BY kge DESC NULLS LAST, basin_id, issue_date) AS INTEGER) AS rank, "
    "t.basin_id, COALESCE(n.gauge_name, 'Unknown') AS gauge_name, t.forecast_date, 0.0::DOUBLE + round(t.kge, 6) AS kge "
    "FROM (SELECT * FROM kge ORDER BY kge ASC NULLS FIRST, basin_id DESC, issue_date DESC LIMIT 10) t "
    + _NAMES_JOIN, "flow", "gauge_names", extra=_PRED_CTES))
def q_worst_k(spark, sf_dir):
    """T3 + J8: the 10 worst samples by KGE, listed high to low."""
    from ..operators.evaluate import with_gauge_name, worst_k
    f = Fixtures(spark, sf_dir)
    w = with_gauge_name(worst_k(_scores(f), "kge", 10, ["basin_id", "issue_date"]), f.gauge_names)
    return w.select("rank", "basin_id", "gauge_name", "forecast_date", rnd("kge", 6).alias("kge"))


# --------------------------------------------------------------------------
# segment union, packing
# --------------------------------------------------------------------------

@register("concat_segments", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, step, flag, "
    + ", ".join(osql.r4(c) for c in WEATHER3)
    + " FROM mixed WHERE len_weather = 106 AND c_p = 106 AND c_t = 106 AND c_s = 106 AND flag IS NOT NULL",
    "gauges", "flow", "obs", "fcst", extra=_MIX))
def q_concat_segments(spark, sf_dir):
    """Weekly ++ daily ++ forecast weather of every complete weather sequence."""
    from pyspark.sql import Window
    st = mixed_steps(Fixtures(spark, sf_dir))
    w = Window.partitionBy(*smp.SAMPLE_KEYS)
    full = F.lit(True)
    for c in WEATHER3:
        full = full & (F.count(c).over(w) == 106)
    st = st.withColumn("_full", full).where((F.col("len_weather") == 106) & F.col("_full")
                                            & F.col("flag").isNotNull())
    return st.select("basin_id", "split", iso_date("issue_date").alias("forecast_date"), "step", "flag",
                     *[r4(c) for c in WEATHER3])


def _packed(f: Fixtures) -> DataFrame:
    acc = _accepted_mixed(f).withColumn("forecast_date", iso_date("issue_date"))
    return smp.pack_samples(acc, DYN_FEATURES)


@register("pack_samples", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, CAST(COUNT(*) AS INTEGER) AS n_time, "
    "4 AS n_feature, 0.0::DOUBLE + round(SUM(CAST(precip AS DOUBLE) + CAST(temp AS DOUBLE) + CAST(net_solar AS DOUBLE) + flag), 2) "
    "AS sum_inputs, 0.0::DOUBLE + round(SUM((step + 1) * CAST(target AS DOUBLE)), 2) AS weighted_targets, "
    "0.0::DOUBLE + round(SUM(CAST(target AS DOUBLE)), 2) AS sum_targets FROM mixed WHERE reason IS NULL "
    "GROUP BY basin_id, split, issue_date", "gauges", "flow", "obs", "fcst", extra=_MIX))
def q_pack_samples(spark, sf_dir):
    """[time][feature] input arrays and target arrays per sample (checksums)."""
    p = _packed(Fixtures(spark, sf_dir))
    flat = F.flatten("dynamic_inputs")
    return p.select(
        "basin_id", "split", "forecast_date", F.size("dynamic_inputs").alias("n_time"),
        F.size(F.col("dynamic_inputs")[0]).alias("n_feature"),
        rnd(F.aggregate(flat, F.lit(0.0), lambda a, x: a + x), 2).alias("sum_inputs"),
        rnd(F.aggregate(F.transform("targets", lambda x, i: x * (i + 1)), F.lit(0.0),
                            lambda a, x: a + x), 2).alias("weighted_targets"),
        rnd(F.aggregate("targets", F.lit(0.0), lambda a, x: a + x), 2).alias("sum_targets"))


@register("feature_split", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, step, "
    + ", ".join(osql.r4(c, f"feat{i}") for i, c in enumerate(DYN_FEATURES)) + ", " + osql.r4("target")
    + " FROM mixed WHERE reason IS NULL", "gauges", "flow", "obs", "fcst", extra=_MIX))
def q_feature_split(spark, sf_dir):
    """Packed inputs split back into named ``feat{i}`` columns."""
    from ..functions.columns import feature_names
    names = feature_names("feat", len(DYN_FEATURES))
    u = smp.unpack_samples(_packed(Fixtures(spark, sf_dir)), names)
    return u.select("basin_id", "split", "forecast_date", F.col("step").cast("int").alias("step"),
                    *[r4(c) for c in names], r4("target"))


# --------------------------------------------------------------------------
# sources and sinks over landed files
# --------------------------------------------------------------------------

@register("csv_flow", REGISTRY["date_parts"][1])
def q_csv_flow(spark, sf_dir):
    """S3: per-gauge CSV files read in one scan, site id from the path."""
    from ..sources.readers import read_flow_csv
    f = Fixtures(spark, sf_dir)
    c = read_flow_csv(spark, f.flow_csv_dir)
    return c.select("site_no", "year", "month", "day", rnd("streamflow", 4).alias("streamflow"),
                    iso_date("datetime").alias("datetime"))


@register("rdb_flow", with_views(
    "SELECT gauge_id AS site_no, strftime(date, '%Y-%m-%d') AS date, "
    "0.0::DOUBLE + round(TRY_CAST(value AS DOUBLE) * 0.0283168, 4) AS streamflow_cms FROM rdb_lines "
    "WHERE TRY_CAST(value AS DOUBLE) IS NOT NULL AND has_columns AND NOT damaged", "rdb_lines"))
def q_rdb_flow(spark, sf_dir):
    """Landed gauge-service text parsed by its format-code row; damaged
    lines and files without the columns are left out."""
    from ..sources.readers import read_rdb
    p = read_rdb(spark, Fixtures(spark, sf_dir).rdb_dir)
    return p.select(F.regexp_extract("file", r"camels_(\d+)", 1).alias("site_no"),
                    iso_date("date").alias("date"), rnd("streamflow_cms", 4).alias("streamflow_cms"))


@register("rdb_checks", with_views(
    "SELECT gauge_id AS site_no, BOOL_AND(has_columns) AS has_columns, COUNT(*) AS n_lines, "
    "COUNT(*) FILTER (WHERE damaged OR NOT has_columns) AS n_bad FROM rdb_lines GROUP BY gauge_id", "rdb_lines"))
def q_rdb_checks(spark, sf_dir):
    """Per landed text file, required columns and unreadable lines."""
    from ..sources.readers import check_rdb
    c = check_rdb(spark, Fixtures(spark, sf_dir).rdb_dir)
    return c.select(F.regexp_extract("file", r"camels_(\d+)", 1).alias("site_no"), "has_columns", "n_lines", "n_bad")


@register("csv_missing", with_views(
    "SELECT gauge_id AS site_no, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE gap) AS n_missing, "
    "0.0::DOUBLE + round(SUM(streamflow_cms) FILTER (WHERE NOT gap), 2) AS total FROM "
    f"(SELECT *, (date_diff('day', {fx._d(fx.ORIGIN)}, date) + k) % {fx.CSV_NAN_MOD} = 0 AS gap FROM flow_dense) "
    "GROUP BY gauge_id", "flow_dense"))
def q_csv_missing(spark, sf_dir):
    """NaN text in the per-gauge CSV files is missing, not a number."""
    from ..functions.columns import is_missing
    from ..sources.readers import read_flow_csv
    c = read_flow_csv(spark, Fixtures(spark, sf_dir).flow_csv_nan_dir)
    return c.groupBy("site_no").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.count(F.when(is_missing("streamflow"), 1)).alias("n_missing"),
                                    rnd(F.sum("streamflow"), 2).alias("total"))


_CSV_BAD_SQL = (f"(SELECT *, date_diff('day', {fx._d(fx.ORIGIN)}, date) + k AS day FROM flow_dense)")
_CSV_IS_BAD = " OR ".join(f"day % {m} = 0" for m in fx.CSV_BAD)


@register("csv_checks", with_views(
    f"SELECT gauge_id AS site_no, COUNT(*) AS n_lines, COUNT(*) FILTER (WHERE {_CSV_IS_BAD}) AS n_bad, "
    f"0.0::DOUBLE + round(SUM(streamflow_cms) FILTER (WHERE NOT ({_CSV_IS_BAD})), 2) AS total FROM {_CSV_BAD_SQL} "
    "GROUP BY gauge_id", "flow_dense"))
def q_csv_checks(spark, sf_dir):
    """Damaged lines of the per-gauge CSV files are counted and left
    out; the others are read."""
    from ..sources.readers import flow_csv_checks, read_flow_csv
    path = Fixtures(spark, sf_dir).flow_csv_damaged_dir
    checks = flow_csv_checks(spark, path).groupBy("site_no").agg(F.sum("n_lines").alias("n_lines"), F.sum("n_bad").alias("n_bad"))
    read = read_flow_csv(spark, path, "0001-01-01", "9999-12-31").groupBy("site_no").agg(rnd(F.sum("streamflow"), 2).alias("total"))
    return checks.join(read, "site_no")


@register("obs_scan", with_views(
    "SELECT basin_id, strftime(date, '%Y-%m-%d') AS date, " + ", ".join(osql.r4(c) for c in smp.WEATHER6)
    + " FROM obs WHERE date >= DATE '1996-01-01'", "obs"))
def q_obs_scan(spark, sf_dir):
    """Landed weather grid, all six variables from a start date."""
    from ..sources.readers import read_obs
    o = read_obs(spark, Fixtures(spark, sf_dir).obs_path, smp.WEATHER6, start="1996-01-01")
    return o.select("basin_id", iso_date("date").alias("date"), *[r4(c) for c in smp.WEATHER6])


@register("basin_scan", with_views(
    "SELECT basin_id, strftime(date, '%Y-%m-%d') AS date, " + ", ".join(osql.r4(c) for c in WEATHER3)
    + " FROM obs WHERE basin_id = 'camels_00000003'", "obs"))
def q_basin_scan(spark, sf_dir):
    """One basin's record; the filter reaches the Parquet scan."""
    from ..sources.readers import read_obs
    o = read_obs(spark, Fixtures(spark, sf_dir).obs_path, basin="camels_00000003")
    return o.select("basin_id", iso_date("date").alias("date"), *[r4(c) for c in WEATHER3])


@register("forecast_scan", with_views(
    "SELECT basin_id, strftime(issue_date, '%Y-%m-%d') AS issue_date, lead_days, "
    + ", ".join(osql.r4(c) for c in WEATHER3) + " FROM fcst", "fcst"))
def q_forecast_scan(spark, sf_dir):
    """Landed forecast grid, lead time in whole days."""
    from ..sources.readers import read_forecast
    o = read_forecast(spark, Fixtures(spark, sf_dir).fcst_path)
    return o.select("basin_id", iso_date("issue_date").alias("issue_date"), "lead_days", *[r4(c) for c in WEATHER3])


@register("gauge_static", with_views(
    "SELECT s.gauge_id, " + ", ".join(f"0.0::DOUBLE + round(s.features[{i + 1}], 4) AS s{i}" for i in range(4))
    + " FROM static s JOIN gauges g ON string_split(g.gauge_id, '_')[-1] = s.gauge_id", "static", "gauges"))
def q_gauge_static(spark, sf_dir):
    """Gauge inventory and static attributes from their landed tables."""
    from ..sources.readers import read_gauges, read_static
    f = Fixtures(spark, sf_dir)
    s = read_static(spark, f.landed_path("static")).join(read_gauges(spark, f.landed_path("gauges")), "gauge_id")
    return s.select("gauge_id", *[rnd(F.col("features")[i], 4).alias(f"s{i}") for i in range(4)])


@register("flow_cache", with_views(
    "SELECT g.gauge_id, COALESCE(c.n_rows, 0) AS n_rows, c.gauge_id IS NULL AS skipped FROM "
    "(SELECT string_split(gauge_id, '_')[-1] AS gauge_id FROM gauges) g LEFT JOIN "
    "(SELECT * FROM cov WHERE reason IS NULL) c ON c.gauge_id = g.gauge_id",
    "gauges", "flow_text", extra={"pf": _PARSED_FLOW_SQL, "cov": _COVER_SQL}))
def q_flow_cache(spark, sf_dir):
    """Usable streamflow and skipped gauges written once, then loaded."""
    from ..operators.quality import skipped_gauges, usable_gauges
    from ..sources.readers import load_or_build
    f = Fixtures(spark, sf_dir)
    g = f.gauges.select(gauge_suffix("gauge_id").alias("gauge_id"))
    path, gone = f.scratch_path("flow"), f.scratch_path("skipped")

    def load():
        return load_or_build(
            spark, path, lambda: _parsed_flow(f).dropna().join(usable_gauges(g, _parsed_flow(f), MIN_END), "gauge_id"),
            gone, lambda: skipped_gauges(g, _parsed_flow(f), MIN_END))

    load()
    flow, skipped = load()                     # the second call only reads
    rows = flow.groupBy("gauge_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.withColumn("skipped", F.lit(False)).unionByName(
        skipped.select("gauge_id", F.lit(0).cast("long").alias("n_rows"), F.lit(True).alias("skipped")))


@register("batch_files", REGISTRY["resume_state"][1])
def q_batch_files(spark, sf_dir):
    """Batches written, then last key and next number per split
    read back from the files."""
    from ..operators.ranking import batch_names, resume_state
    from ..sinks.writers import write_batches
    from ..sources.readers import read_batches
    f = Fixtures(spark, sf_dir)
    path = f.scratch_path("batches")
    write_batches(batch_names(_batched(f, 200)).drop("issue_date"), path)
    return resume_state(read_batches(spark, path), ["train", "validation", "test", "holdout"])


@register("resumable_batches", REGISTRY["assign_batches"][1])
def q_resumable_batches(spark, sf_dir):
    """Batches written in logged chunks; the first run ends after two
    chunks, the second writes the rest, and the whole equals one full write."""
    from ..sinks.chunked import read_chunks, write_chunks
    f = Fixtures(spark, sf_dir)
    path = f.scratch_path("chunked_batches")
    keys = f.flow.select(F.col("gauge_id").alias("basin_id"))

    def build(chunk):
        st = smp.target_steps(f.flow.where(chunk.holds("gauge_id")), MIXED_BLOCKS, 5).where(F.col("reason").isNull())
        return (st.groupBy("basin_id", "block", "split", "issue_date").agg(F.count(F.lit(1)).alias("n"))
                .select("basin_id", "split", iso_date("issue_date").alias("forecast_date")))

    for limit in (2, None):
        write_chunks(spark, path, keys, build, 200, chunks=4, limit=limit)
    return read_chunks(spark, path).select("basin_id", "split", "forecast_date", "batch_id", "pos_in_batch", "file_name")


@register("chunk_scaler", REGISTRY["fit_scaler"][1])
def q_chunk_scaler(spark, sf_dir):
    """A8 + K1: packed samples written in logged chunks, and the train scaler
    merged from the moments in the log."""
    from ..operators.scaling import merge_moments, packed_moments
    from ..sinks.chunked import chunk_moments, write_chunks
    f = Fixtures(spark, sf_dir)
    path = f.scratch_path("chunked_samples")
    cand = mixed_candidates(f)

    def build(chunk):
        steps = smp.mixed_steps(f.flow.where(chunk.holds("gauge_id")), f.obs.where(chunk.holds("basin_id", "camels_")),
                                f.fcst.where(chunk.holds("basin_id", "camels_")), cand.where(chunk.holds("basin_id")), MIXED_BLOCKS, 5)
        steps = smp.apply_scope(steps, "sample").withColumn("forecast_date", iso_date("issue_date"))
        return smp.pack_samples(steps, DYN_FEATURES)

    write_chunks(spark, path, cand, build, 200, chunks=2, moments=lambda df: packed_moments(df, DYN_FEATURES))
    s = merge_moments(chunk_moments(spark, path).where(F.col("split") == "train").drop("split"))
    return s.select("feature", r4("mean"), r4("std"))


@register("summary_csv", REGISTRY["run_summary"][1])
def q_summary_csv(spark, sf_dir):
    """K4: the run summary written as CSV and read back."""
    from ..operators.quality import run_summary
    from ..sinks.writers import write_summary
    f = Fixtures(spark, sf_dir)
    path = f.scratch_path("summary")
    s = smp.apply_scope(mixed_steps(f), "sample")
    write_summary(run_summary(s, "basin_id", "split", "issue_date"), path)
    return spark.read.schema("basin_id string, split string, n_samples long, filename string").option(
        "header", True).csv(path)


@register("relayout", with_views(
    "SELECT basin_id, COUNT(*) AS n_rows, strftime(MIN(date), '%Y-%m-%d') AS first_date, "
    "strftime(MAX(date), '%Y-%m-%d') AS last_date, 0.0::DOUBLE + round(SUM(CAST(precip AS DOUBLE)), 2) AS total_precip "
    "FROM obs GROUP BY basin_id", "obs"))
def q_relayout(spark, sf_dir):
    """K6: grid rewritten basin-contiguous and date-sorted; content unchanged."""
    from ..sinks.writers import relayout
    f = Fixtures(spark, sf_dir)
    path = f.scratch_path("obs_relayout")
    relayout(f.obs, path)
    r = spark.read.parquet(path)
    return r.groupBy("basin_id").agg(
        F.count(F.lit(1)).alias("n_rows"), iso_date(F.min("date")).alias("first_date"),
        iso_date(F.max("date")).alias("last_date"),
        rnd(F.sum(F.col("precip").cast("double")), 2).alias("total_precip"))


@register("sample_store", with_views(
    "SELECT basin_id, strftime(issue_date, '%Y-%m-%d') AS forecast_date, CAST(COUNT(*) AS INTEGER) AS n_time, "
    "0.0::DOUBLE + round(SUM(CAST(target AS DOUBLE)), 2) AS sum_targets FROM mixed WHERE reason IS NULL AND split = 'test' "
    "GROUP BY basin_id, issue_date", "gauges", "flow", "obs", "fcst", extra=_MIX))
def q_sample_store(spark, sf_dir):
    """K3 + S8: samples written one folder per split, the test split read back."""
    from ..sinks.writers import write_splits
    from ..sources.readers import read_samples
    f = Fixtures(spark, sf_dir)
    path = f.scratch_path("samples_by_split")
    write_splits(_packed(f), path, features=DYN_FEATURES)
    t = read_samples(spark, path, "test")
    return t.select("basin_id", "forecast_date", F.size("targets").alias("n_time"),
                    rnd(F.aggregate("targets", F.lit(0.0), lambda a, x: a + x), 2).alias("sum_targets"))


@register("flag_legend", with_views(
    "SELECT CAST(flag AS VARCHAR) AS flag, CASE flag " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in FLAG_LEGEND.items())
    + " END AS meaning, " + f"'{','.join(DYN_FEATURES)}' AS features, COUNT(*) AS n_steps FROM mixed "
    "WHERE reason IS NULL GROUP BY flag", "gauges", "flow", "obs", "fcst", extra=_MIX))
def q_flag_legend(spark, sf_dir):
    """feature names and flag meanings, read back from the metadata of the
    written sample set, beside the steps that carry each flag."""
    from ..sinks.writers import write_splits
    from ..sources.readers import read_legend, read_samples
    f = Fixtures(spark, sf_dir)
    path = f.scratch_path("samples_with_legend")
    write_splits(_packed(f), path, features=DYN_FEATURES)
    t = read_samples(spark, path)
    at = DYN_FEATURES.index("flag")
    steps = t.select(F.explode(F.transform("dynamic_inputs", lambda x: x[at].cast("int").cast("string"))).alias("flag"))
    return steps.groupBy("flag").agg(F.count(F.lit(1)).alias("n_steps")).join(F.broadcast(read_legend(t)), "flag")


# --------------------------------------------------------------------------
# incremental build (streaming re-expression of flush + resume)
# --------------------------------------------------------------------------

@register("incremental_samples", with_views(
    "SELECT basin_id, split, strftime(issue_date, '%Y-%m-%d') AS forecast_date, step, flag, "
    + ", ".join(osql.r4(c) for c in WEATHER3 + ["target"]) + " FROM mixed WHERE reason IS NULL",
    "gauges", "flow_dense", "obs", "fcst", extra=osql.mixed_ctes(flow="flow_dense")))
def q_incremental_samples(spark, sf_dir):
    """Landed per-gauge flow files streamed in (availableNow), samples written
    per (split, gauge); a second run finds nothing new (resume)."""
    from ..streaming import incremental_build
    f = Fixtures(spark, sf_dir)
    out, ckpt = f.scratch_path("incremental_out"), f.scratch_path("incremental_ckpt")
    from ..sources.readers import read_partitioned
    incremental_build(spark, f.flow_csv_dir, f.obs, f.fcst, MIXED_BLOCKS, out, ckpt,
                      max_files_per_trigger=10)
    r = read_partitioned(spark, out)
    return r.select("basin_id", "split", "forecast_date", "step", "flag",
                    *[r4(c) for c in WEATHER3 + ["target"]])
