"""Sample recipes: segment unions, feature/target pairing, gates, packing.

U1-U3, J12, A2, A17, W2 and the two recipes of the reference:

* **mixed** -- 106 steps: 35 weekly means (``t0-305 .. t0-61``), daily values
  (target ``t0-60 .. t0-1``, weather ``t0-60 .. t0``) and a forecast part
  (target ``t0 .. t0+10``, weather = first 10 leads of the nearest forecast
  issue).  Flag 0/1/2 follows the weather segmentation.
* **annual** -- 366 daily steps ``t0-365 .. t0`` of six weather variables and
  streamflow.

Everything is long form ``(basin_id, split, issue_date, step, ...)`` until the
sink packs arrays (``pack_samples``).  Steps use the closed forms: weekly step
= bin, daily/forecast step = ``n_weekly + off - daily_lo`` (``95 + off``),
forecast-lead step = ``95 + lead_rank``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import gauge_suffix, iso_date, nan_to_null
from .asof import nearest_asof
from .windows import (DEFAULT_BLOCK_DAYS, block_of, cell_mean, combine_copies, fan_out,
                      fan_partitions, weekly_bins)

if TYPE_CHECKING:
    from ..sinks.blocked import Blocked

# Grouping keys of a sample: issue day number first (a cheap, selective sort
# prefix), then the basin and the time block the rows are partitioned by.
# ``split`` and ``issue_date`` depend on ``sday``; aggregates carry them as
# extra grouping keys (hashed, never sorted on, and never put in an
# aggregation buffer -- a string buffer would force a sort-based aggregate).
SAMPLE_KEYS = ["sday", "basin_id", "block"]
SAMPLE_GROUP = SAMPLE_KEYS + ["split", "issue_date"]


def _with_carried(df: DataFrame, blocks) -> DataFrame:
    """Re-derive ``issue_date`` and ``split`` after a hot aggregate keyed on
    ``SAMPLE_KEYS`` only (fewer and narrower hash keys per fanned-out row)."""
    from .calendar import split_of
    d = F.date_from_unix_date("sday")
    return df.withColumn("issue_date", d).withColumn("split", split_of(d, blocks))
WEATHER3 = ["precip", "temp", "net_solar"]
WEATHER6 = ["precip", "temp", "u_wind", "v_wind", "dew_point", "net_solar"]
NAN_POLICIES = ("precip_target", "all")
SCOPES = ("sample", "group")


@dataclass(frozen=True)
class MixedRecipe:
    """Window geometry of the mixed-resolution sample (fixed by the reference)."""
    weekly_lo: int = -305
    daily_lo: int = -60          # weekly slice ends at daily_lo - 1
    target_hi: int = 10          # streamflow horizon t0 .. t0+10
    weather_daily_hi: int = 0    # weather daily part includes t0
    n_leads: int = 10
    week_days: int = 7
    expected_len: int = 106

    @property
    def n_weekly(self) -> int:
        return -(-(self.daily_lo - self.weekly_lo) // self.week_days)

    @property
    def lead_step0(self) -> int:
        return self.n_weekly + self.weather_daily_hi - self.daily_lo


@dataclass(frozen=True)
class AnnualRecipe:
    lo: int = -365
    expected_len: int = 366


# ---------------------------------------------------------------------------
# shared pieces
# ---------------------------------------------------------------------------

def _series(flow: DataFrame, obs: DataFrame, weather: list[str]) -> DataFrame:
    """U1/U2 input: flow (src 0) and weather (src 1) in one long series,
    copies of a (basin, date, source) cell combined before any shuffle."""
    nulls = [F.lit(None).cast("double").alias(f"v{i}") for i in range(1, len(weather))]
    f = flow.select(F.col("gauge_id").alias("basin_id"), "date", F.lit(0).alias("src"),
                    nan_to_null(F.col("streamflow_cms").cast("double")).alias("v0"), *nulls)
    o = obs.select(gauge_suffix("basin_id").alias("basin_id"), "date", F.lit(1).alias("src"),
                   *[nan_to_null(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(weather)])
    return combine_copies(f.unionByName(o), "basin_id", [f"v{i}" for i in range(len(weather))])


def _cells(n_values: int) -> list[str]:
    return ["n"] + [x for i in range(n_values) for x in (f"s{i}", f"c{i}")]


def _gate(steps: DataFrame, expected: int, nan_cols: list[str], w) -> DataFrame:
    """Adds ``reason``: first failed gate, NULL when the sample is accepted."""
    ok_counts = [F.count(F.col(c)).over(w) for c in nan_cols]
    nan_ok = F.lit(True)
    for c in ok_counts:
        nan_ok = nan_ok & (c == expected)
    return steps.withColumn(
        "reason",
        F.when(F.col("len_target") != expected, F.lit("target_length"))
        .when(F.col("len_weather") != expected, F.lit("weather_length"))
        .when(~nan_ok, F.lit("missing_values")))


def nan_columns(policy: str, weather: list[str]) -> list[str]:
    if policy == "precip_target":
        return ["precip", "target"]
    if policy == "all":
        return weather + ["target"]
    raise ValueError(f"unknown nan policy {policy!r}")


def apply_scope(steps: DataFrame, scope: str, stats: DataFrame | None = None) -> DataFrame:
    """A5: ``sample`` drops failed samples; ``group`` also drops every sample of
    a (basin, split) group that holds a sample failing only the NaN gate.

    Group scope is decided on one row per sample (``scope_samples``); what is
    kept comes back as one array of issue days per (basin, block), the keys the
    step rows are partitioned by, so the step rows are not shuffled again.
    ``stats`` gives that row per sample (``mixed_gates``, or ``sample_stats`` of
    written steps); by default it is taken from ``steps``.
    """
    if scope not in SCOPES:
        raise ValueError(f"unknown scope {scope!r}")
    kept = steps.where(F.col("reason").isNull())
    if scope == "sample":
        return kept
    good = (scope_samples(sample_stats(steps) if stats is None else stats, scope)
            .groupBy("basin_id", "block").agg(F.collect_set("sday").alias("_good"))
            .repartition(fan_partitions(steps.sparkSession), "basin_id", "block"))
    return (kept.join(good.hint("shuffle_hash"), ["basin_id", "block"])
            .where(F.array_contains("_good", F.col("sday"))).drop("_good"))


def scope_samples(stats: DataFrame, scope: str) -> DataFrame:
    """The accepted rows of a per-sample table (``sample_stats``) in either
    scope: one pass, one row per sample moved."""
    if scope == "group":
        bad = F.max((F.col("reason") == "missing_values").cast("int")).over(Window.partitionBy("basin_id", "split"))
        stats = stats.withColumn("_bad", bad).where(F.coalesce("_bad", F.lit(0)) == 0).drop("_bad")
    return stats.where(F.col("reason").isNull())


# ---------------------------------------------------------------------------
# mixed-resolution recipe
# ---------------------------------------------------------------------------

def _mixed_rows(flow: DataFrame, obs: DataFrame, fcst: DataFrame, candidates: DataFrame,
                blocks, stride, recipe: MixedRecipe, block_days: int) -> DataFrame:
    """One row per (sample, source, day or lead) with its step and cell sums,
    partitioned by (basin, block): what steps and gates are made of."""
    r = recipe
    candidates = candidates.select("basin_id", "split", "issue_date")
    fan = fan_out(_series(flow, obs, WEATHER3), "basin_id", blocks, stride,
                  r.weekly_lo, r.target_hi, block_days, candidates=candidates)
    fan = fan.where((F.col("src") == 0) | (F.col("off") <= r.weather_daily_hi))
    seg = (F.when(F.col("off") < r.daily_lo, F.lit(0))
           .when((F.col("src") == 1) | (F.col("off") < 0), F.lit(1))
           .otherwise(F.lit(2)))
    part = SAMPLE_KEYS + ["src"]
    fan = weekly_bins(fan.withColumn("seg", seg), part, F.col("seg") == 0, r.week_days,
                      extra={"n_rest": F.sum(F.when(F.col("seg") > 0, F.col("n")))})
    fan = fan.select(
        *SAMPLE_KEYS, "split", "issue_date", "src", "seg",
        F.when(F.col("seg") == 0, F.col("bin"))
        .otherwise(F.col("off") + (r.n_weekly - r.daily_lo)).alias("step"),
        (F.col("n_bins") + F.coalesce(F.col("n_rest"), F.lit(0))).alias("src_len"),
        *_cells(len(WEATHER3)))

    # Forecast part: nearest issue per sample (J6), then its first leads
    # ranked inside the join -- only matched issues are ranked, and the rank
    # window reuses the join's (basin, issue) partitioning.
    fc = fcst.withColumn("basin_id", gauge_suffix("basin_id"))
    near = nearest_asof(candidates, fc.select("basin_id", "issue_date"),
                        "basin_id", "issue_date", "issue_date", out="fc_issue")
    leads = fc.select("basin_id", F.col("issue_date").alias("fc_issue"), "lead_days",
                      *[nan_to_null(F.col(c).cast("double")).alias(f"_w{i}") for i, c in enumerate(WEATHER3)])
    matched = near.join(leads, ["basin_id", "fc_issue"])
    rank = F.row_number().over(Window.partitionBy("basin_id", "fc_issue", "issue_date").orderBy("lead_days"))
    matched = matched.withColumn("lead_rank", rank).where(F.col("lead_rank") <= r.n_leads)
    frows = (matched
             .select(F.unix_date("issue_date").alias("sday"), "basin_id",
                     block_of("issue_date", block_days).alias("block"),
                     "split", "issue_date", F.lit(2).alias("src"), F.lit(2).alias("seg"),
                     (F.col("lead_rank") + r.lead_step0).alias("step"),
                     F.lit(None).cast("long").alias("src_len"), F.lit(1).cast("long").alias("n"),
                     *[x for i in range(len(WEATHER3))
                       for x in (F.col(f"_w{i}").alias(f"s{i}"),
                                 F.when(F.col(f"_w{i}").isNotNull(), 1).otherwise(0).cast("long").alias(f"c{i}"))])
             .repartition(fan_partitions(fcst.sparkSession), "basin_id", "block"))

    return fan.unionByName(frows)


def mixed_steps(flow: DataFrame, obs: DataFrame, fcst: DataFrame, candidates: DataFrame,
                blocks, stride=5, recipe: MixedRecipe = MixedRecipe(),
                nan_policy: str = "all", block_days: int = DEFAULT_BLOCK_DAYS) -> DataFrame:
    """Long-form steps of every candidate sample, with gate columns.

    ``flow(gauge_id, date, streamflow_cms)``, ``obs(basin_id='camels_<id>', date,
    precip, temp, net_solar)``, ``fcst(basin_id, issue_date, lead_days, ...)``,
    ``candidates(basin_id, split, issue_date)`` (short ids).  Only candidate
    samples are built.

    Output: ``basin_id, block, split, issue_date, step, flag, precip, temp,
    net_solar, target, len_target, len_weather, reason`` (one row per step).
    """
    rows = _mixed_rows(flow, obs, fcst, candidates, blocks, stride, recipe, block_days)
    r = recipe
    is_w = F.col("src") != 0
    steps = rows.groupBy(*SAMPLE_KEYS, "step").agg(
        F.max(F.when(is_w, F.col("seg"))).alias("flag"),
        *[cell_mean(i, is_w).cast("float").alias(c) for i, c in enumerate(WEATHER3)],
        cell_mean(0, ~is_w).cast("float").alias("target"),
        F.max(F.when(F.col("src") == 0, F.col("src_len"))).alias("_lf"),
        F.max(F.when(F.col("src") == 1, F.col("src_len"))).alias("_lo"),
        F.coalesce(F.sum(F.when(F.col("src") == 2, F.col("n"))), F.lit(0)).alias("_nf"))
    steps = _with_carried(steps, blocks)
    w2 = Window.partitionBy(*SAMPLE_KEYS)
    steps = (steps
             .withColumn("len_target", F.coalesce(F.max("_lf").over(w2), F.lit(0)).cast("int"))
             .withColumn("len_weather", (F.coalesce(F.max("_lo").over(w2), F.lit(0))
                                         + F.sum("_nf").over(w2)).cast("int"))
             .drop("_lf", "_lo", "_nf"))
    return _gate(steps, r.expected_len, nan_columns(nan_policy, WEATHER3), w2)


def mixed_gates(flow: DataFrame, obs: DataFrame, fcst: DataFrame, candidates: DataFrame, blocks, stride=5,
                recipe: MixedRecipe = MixedRecipe(), nan_policy: str = "all", block_days: int = DEFAULT_BLOCK_DAYS) -> DataFrame:
    """``sample_stats(mixed_steps(...))`` without building a step: per sample
    the lengths and, as two bit sets a column, the steps that have a value; one
    aggregate on the keys the rows are partitioned by, no window."""
    if recipe.expected_len > 126:
        raise ValueError("steps do not fit two bit sets")
    rows = _mixed_rows(flow, obs, fcst, candidates, blocks, stride, recipe, block_days)
    is_w = F.col("src") != 0

    def steps_with(test, half):
        there = test & (F.col("step") >= 63 * half) & (F.col("step") < 63 * (half + 1))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("step") - 63 * half).cast("int"))
        return F.bit_or(F.when(there, bit).otherwise(F.lit(0).cast("long")))

    has = {"target": ~is_w & (F.col("c0") > 0), **{c: is_w & (F.col(f"c{i}") > 0) for i, c in enumerate(WEATHER3)}}
    cols = nan_columns(nan_policy, WEATHER3)
    g = rows.groupBy(*SAMPLE_KEYS).agg(
        F.max(F.when(F.col("src") == 0, F.col("src_len"))).alias("_lf"), F.max(F.when(F.col("src") == 1, F.col("src_len"))).alias("_lo"),
        F.coalesce(F.sum(F.when(F.col("src") == 2, F.col("n"))), F.lit(0)).alias("_nf"),
        *[steps_with(has[c], half).alias(f"_{c}{half}") for c in cols for half in (0, 1)])
    full = F.lit(True)
    for c in cols:
        full = full & (F.bit_count(f"_{c}0") + F.bit_count(f"_{c}1") == recipe.expected_len)
    g = _with_carried(g, blocks).select(
        *SAMPLE_GROUP, F.coalesce("_lf", F.lit(0)).cast("int").alias("len_target"),
        (F.coalesce("_lo", F.lit(0)) + F.col("_nf")).cast("int").alias("len_weather"), full.alias("_full"))
    reason = (F.when(F.col("len_target") != recipe.expected_len, F.lit("target_length"))
              .when(F.col("len_weather") != recipe.expected_len, F.lit("weather_length"))
              .when(~F.col("_full"), F.lit("missing_values")))
    return g.select(*SAMPLE_GROUP, reason.alias("reason"), "len_target", "len_weather")


def target_steps(flow: DataFrame, blocks, stride=5, recipe: MixedRecipe = MixedRecipe(),
                 block_days: int = DEFAULT_BLOCK_DAYS) -> DataFrame:
    """The streamflow target sequence alone (weekly ++ daily ++ horizon).

    Output per step: ``basin_id, block, split, issue_date, step, seg, target,
    len_target, reason`` with ``reason`` in (target_length, missing_values).
    """
    r = recipe
    ser = flow.select(F.col("gauge_id").alias("basin_id"), "date",
                      nan_to_null(F.col("streamflow_cms").cast("double")).alias("v0"))
    ser = combine_copies(ser, "basin_id", ["v0"], extra_keys=())
    fan = fan_out(ser, "basin_id", blocks, stride, r.weekly_lo, r.target_hi, block_days)
    seg = (F.when(F.col("off") < r.daily_lo, F.lit(0))
           .when(F.col("off") < 0, F.lit(1)).otherwise(F.lit(2)))
    fan = weekly_bins(fan.withColumn("seg", seg), SAMPLE_KEYS, F.col("seg") == 0, r.week_days,
                      extra={"n_rest": F.sum(F.when(F.col("seg") > 0, F.col("n")))})
    step = (F.when(F.col("seg") == 0, F.col("bin"))
            .otherwise(F.col("off") + (r.n_weekly - r.daily_lo)))
    steps = (fan.groupBy(*SAMPLE_KEYS, step.alias("step"))
             .agg(F.max("seg").alias("seg"), cell_mean(0).cast("float").alias("target"),
                  F.max(F.col("n_bins") + F.coalesce(F.col("n_rest"), F.lit(0))).alias("_len")))
    steps = _with_carried(steps, blocks)
    w2 = Window.partitionBy(*SAMPLE_KEYS)
    steps = steps.withColumn("len_target", F.max("_len").over(w2).cast("int")).drop("_len")
    return steps.withColumn(
        "reason",
        F.when(F.col("len_target") != r.expected_len, F.lit("target_length"))
        .when(F.count("target").over(w2) != r.expected_len, F.lit("missing_values")))


def mixed_samples(flow, obs, fcst, candidates, blocks, stride=5,
                  recipe: MixedRecipe = MixedRecipe(), nan_policy: str = "all",
                  scope: str = "sample", block_days: int = DEFAULT_BLOCK_DAYS) -> DataFrame:
    """Flagship: accepted mixed samples, long form, float32 values.

    ``basin_id, split, forecast_date, step, flag, precip, temp, net_solar, target``
    """
    steps = mixed_steps(flow, obs, fcst, candidates, blocks, stride, recipe,
                        nan_policy, block_days)
    stats = None
    if scope == "group":
        stats = mixed_gates(flow, obs, fcst, candidates, blocks, stride, recipe, nan_policy, block_days)
    return apply_scope(steps, scope, stats).select(
        "basin_id", "split", iso_date("issue_date").alias("forecast_date"), "step",
        "flag", *WEATHER3, "target")


def sample_stats(steps: DataFrame) -> DataFrame:
    """A2: one row per sample with lengths and the gate reason.

    Grouped on the keys the steps are already partitioned by: no exchange.
    ``reason`` is constant per sample, so it is a grouping key too (a string
    in the aggregation buffer would force a sort-based aggregate).
    """
    return steps.groupBy(*SAMPLE_GROUP, "reason").agg(
        F.max("len_target").alias("len_target"),
        F.max("len_weather").alias("len_weather"))


# ---------------------------------------------------------------------------
# annual recipe
# ---------------------------------------------------------------------------

def annual_series(flow: DataFrame, obs: DataFrame, weather: list[str] = WEATHER6) -> DataFrame:
    """What the annual windows read, to be stored by ``write_blocked``."""
    return _series(flow, obs, weather)


def annual_steps(flow: DataFrame | None, obs: DataFrame | None, blocks, recipe: AnnualRecipe = AnnualRecipe(),
                 weather: list[str] = WEATHER6, block_days: int = DEFAULT_BLOCK_DAYS,
                 stored: Blocked | None = None) -> DataFrame:
    """Daily ``t0-365 .. t0`` windows of weather and flow, with gates.

    NaN/Inf in precipitation or flow rejects a sample; a length other than
    ``expected_len`` (the reference lets the first sample fix it) too.
    ``stored`` (``write_blocked`` of ``annual_series``) stands for ``flow`` and
    ``obs``; no row is moved then.
    """
    r = recipe
    series = annual_series(flow, obs, weather) if stored is None else stored
    fan = fan_out(series, "basin_id", blocks, "year-start", r.lo, 0, block_days)
    fan = fan.withColumn("step", F.col("off") - r.lo)
    is_w = F.col("src") != 0
    steps = fan.groupBy(*SAMPLE_KEYS, "step").agg(
        *[cell_mean(i, is_w).cast("float").alias(c) for i, c in enumerate(weather)],
        cell_mean(0, ~is_w).cast("float").alias("target"),
        F.coalesce(F.sum(F.when(~is_w, F.col("n"))), F.lit(0)).alias("_nf"),
        F.coalesce(F.sum(F.when(is_w, F.col("n"))), F.lit(0)).alias("_nw"))
    steps = _with_carried(steps, blocks)
    w2 = Window.partitionBy(*SAMPLE_KEYS)
    bad = (F.col("precip").isNull() | F.isnan("precip") | (F.abs("precip") == float("inf"))
           | F.col("target").isNull() | F.isnan("target") | (F.abs("target") == float("inf")))
    steps = (steps
             .withColumn("len_target", F.sum("_nf").over(w2).cast("int"))
             .withColumn("len_weather", F.sum("_nw").over(w2).cast("int"))
             .withColumn("_bad", F.max(bad.cast("int")).over(w2))
             .withColumn("reason",
                         F.when(F.col("len_target") != r.expected_len, F.lit("target_length"))
                         .when(F.col("len_weather") != r.expected_len, F.lit("weather_length"))
                         .when(F.col("_bad") == 1, F.lit("missing_values")))
             .drop("_nf", "_nw", "_bad"))
    return steps


def annual_samples(flow, obs, blocks, recipe: AnnualRecipe = AnnualRecipe(),
                   weather: list[str] = WEATHER6, block_days: int = DEFAULT_BLOCK_DAYS) -> DataFrame:
    steps = annual_steps(flow, obs, blocks, recipe, weather, block_days)
    return steps.where(F.col("reason").isNull()).select(
        "basin_id", "split", iso_date("issue_date").alias("forecast_date"), "step",
        *weather, "target")


# ---------------------------------------------------------------------------
# packing (A17) and unpacking (F8)
# ---------------------------------------------------------------------------

def pack_samples(steps: DataFrame, features: list[str], target: str = "target",
                 keys: tuple[str, ...] = ("basin_id", "split", "forecast_date")) -> DataFrame:
    """``dynamic_inputs array<array<float>>`` ``[time][feature]`` and
    ``targets array<float>`` per sample, ordered by step.

    The group is one sample (at most ``expected_len`` rows by the gates), so
    the collected arrays have a fixed, small size.  Steps that still have their
    ``block`` are packed where they are: it follows from the issue date, and
    (basin, block) is what they are partitioned by.
    """
    row = F.struct("step", F.array(*[F.col(c).cast("float") for c in features]).alias("x"),
                   F.col(target).cast("float").alias("y"))
    carried = ["block"] if "block" in steps.columns and "block" not in keys else []
    packed = steps.groupBy(*keys, *carried).agg(F.array_sort(F.collect_list(row)).alias("_r"))
    return packed.select(*keys,
                         F.transform("_r", lambda e: e["x"]).alias("dynamic_inputs"),
                         F.transform("_r", lambda e: e["y"]).alias("targets"))


def unpack_samples(packed: DataFrame, features: list[str],
                   keys: tuple[str, ...] = ("basin_id", "split", "forecast_date")) -> DataFrame:
    """F8 / inverse of A17: one row per step, feature ``i`` as its own column."""
    z = packed.select(*keys, F.posexplode(F.arrays_zip(
        F.col("dynamic_inputs").alias("x"), F.col("targets").alias("y"))).alias("step", "e"))
    return z.select(*keys, "step",
                    *[F.col("e.x")[i].alias(f) for i, f in enumerate(features)],
                    F.col("e.y").alias("target"))
