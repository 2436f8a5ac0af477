"""Nearest as-of join (J6) and forecast valid times.

``nearest_asof`` finds, for each left date, the right date of the same key
that is nearest in either direction, with no distance limit (dates outside the
right side's coverage clamp to its first/last date) and ties going to the later
date.

It never pairs every left row with every right row of a key.  The distinct
dates of both sides are grouped by (key, time block), copies combined before
they move, and scanned in date order within their block.  Between the blocks
only their edges travel: one row per (key, block) with its first and last right
date.  The edges of a key meet in one short array and give every block the last
right date before it and the first one after it.  So a long record is spread
over many tasks, and a key with a third of all rows has no more dates, blocks
or edges than any other key of its period.

Null keys and null dates match nothing; a key without right dates keeps its
left rows with a null match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .windows import DEFAULT_BLOCK_DAYS, block_of


def _carried(days: DataFrame, by: str) -> DataFrame:
    """(key, block, _before, _after): the nearest right dates outside a block,
    for every block with left dates."""
    edge = F.struct("block", F.array_min("_r").alias("first"), F.array_max("_r").alias("last"),
                    (F.size("_l") > 0).alias("asked"))
    edges = days.groupBy(by).agg(F.collect_list(edge).alias("_e")).select(
        by, F.filter("_e", lambda e: e["asked"]).alias("_asked"),
        F.filter("_e", lambda e: e["last"].isNotNull()).alias("_has"))
    one = edges.select(by, F.explode("_asked.block").alias("block"), "_has")
    before = F.filter("_has", lambda e: e["block"] < F.col("block"))
    after = F.filter("_has", lambda e: e["block"] > F.col("block"))
    return one.select(by, "block", F.array_max(F.transform(before, lambda e: e["last"])).alias("_before"),
                      F.array_min(F.transform(after, lambda e: e["first"])).alias("_after"))


def nearest_asof(left: DataFrame, right: DataFrame, by: str, left_on: str,
                 right_on: str, out: str = "matched", block_days: int = DEFAULT_BLOCK_DAYS) -> DataFrame:
    """``left`` plus column ``out``: nearest ``right_on`` date per ``by``.

    Only distinct (key, date) pairs are scanned; the left rows, any number of
    them per date, meet their date's match in an equi-join that can be split.
    """
    none = F.lit(None).cast("date")
    rows = (left.select(by, F.col(left_on).alias("_x"), none.alias("_y"))
            .unionByName(right.select(by, none.alias("_x"), F.col(right_on).alias("_y"))))
    rows = rows.where(F.col(by).isNotNull() & F.coalesce("_x", "_y").isNotNull())
    # A block is never null; said plainly, no filter sets the two uses of
    # ``days`` apart and they share an exchange.
    block = F.coalesce(block_of(F.coalesce("_x", "_y"), block_days), F.lit(0))
    days = (rows.groupBy(by, block.alias("block"))
            .agg(F.collect_set("_x").alias("_l"), F.collect_set("_y").alias("_r")))
    # kind 0 (right) sorts before kind 1 (left) at equal dates: an exact match
    # is the "previous" date at distance 0.
    dates = F.concat(F.transform("_r", lambda d: F.struct(d.alias("x"), F.lit(0).alias("kind"))),
                     F.transform("_l", lambda d: F.struct(d.alias("x"), F.lit(1).alias("kind"))))
    u = days.select(by, "block", F.inline(dates).alias("_x", "_kind"))
    w = Window.partitionBy(by, "block").orderBy("_x", "_kind")
    r_date = F.when(F.col("_kind") == 0, F.col("_x"))
    p = F.last(r_date, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    n = F.first(r_date, ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    u = u.select("*", p.alias("_p"), n.alias("_n")).where(F.col("_kind") == 1)
    u = u.join(_carried(days, by), [by, "block"]).select(
        by, F.col("_x").alias(left_on), F.coalesce("_p", "_before").alias("_p"), F.coalesce("_n", "_after").alias("_n"))
    x = F.col(left_on)
    nearest = (F.when(F.col("_p").isNull(), F.col("_n"))
               .when(F.col("_n").isNull(), F.col("_p"))
               .when(F.datediff(x, "_p") < F.datediff("_n", x), F.col("_p"))
               .otherwise(F.col("_n")))
    return left.join(u.select(by, left_on, nearest.alias(out)), [by, left_on])


def first_leads(fcst: DataFrame, by: str, n: int = 10, issue: str = "issue_date",
                lead: str = "lead_days") -> DataFrame:
    """The first ``n`` lead rows of every forecast issue, ``lead_rank`` 1..n.

    Ranked per (key, issue) -- a group the size of one forecast -- so the
    filter runs before the rows meet any sample.
    """
    w = Window.partitionBy(by, issue).orderBy(lead)
    return fcst.withColumn("lead_rank", F.row_number().over(w)).where(F.col("lead_rank") <= n)


def valid_time(issue_col, lead_col) -> "F.Column":
    """forecast valid date = issue date + lead."""
    return F.date_add(F.col(issue_col) if isinstance(issue_col, str) else issue_col,
                      F.col(lead_col) if isinstance(lead_col, str) else lead_col)
