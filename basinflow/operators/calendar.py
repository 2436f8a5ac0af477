"""Issue calendars, split assignment and the candidate grid.

A calendar is a *parameter* of a run (split -> date range + stride), not data,
so its size is known on the driver before any job starts and rows generate
their issue dates by arithmetic (``issue_days_between``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Blocks = Mapping[str, tuple[str, str]]


def _to_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value)[:10])


def calendar_dates(blocks: Blocks, stride: str | int = 5) -> list[tuple[str, dt.date]]:
    """(split, issue_date) pairs; end inclusive, like a fixed-frequency range.

    ``stride`` is a day count or ``'year-start'`` (first day of each year that
    is not before the range start).  Overlapping ranges are an error: a sample
    belongs to one split.
    """
    spans = sorted((_to_date(a), _to_date(b), s) for s, (a, b) in blocks.items())
    for (_, end, s), (start, _, t) in zip(spans, spans[1:], strict=False):
        if start <= end:
            raise ValueError(f"splits {s!r} and {t!r} overlap")
    out: list[tuple[str, dt.date]] = []
    for split, (start, end) in blocks.items():
        lo, hi = _to_date(start), _to_date(end)
        if stride == "year-start":
            year = lo.year if (lo.month, lo.day) == (1, 1) else lo.year + 1
            d = dt.date(year, 1, 1)
            while d <= hi:
                out.append((split, d))
                d = dt.date(d.year + 1, 1, 1)
        else:
            step = dt.timedelta(days=int(stride))
            d = lo
            while d <= hi:
                out.append((split, d))
                d += step
    return out


def issue_calendar(spark: SparkSession, blocks: Blocks, stride: str | int = 5) -> DataFrame:
    """``calendar(split string, issue_date date)``.

    Generated with ``sequence`` so the rows are produced by Spark; the row
    count equals ``len(calendar_dates(blocks, stride))``.
    """
    spec = spark.createDataFrame(
        [(s, str(_to_date(a)), str(_to_date(b))) for s, (a, b) in blocks.items()],
        "split string, lo string, hi string",
    )
    lo, hi = F.to_date("lo"), F.to_date("hi")
    if stride == "year-start":
        first = F.when(F.trunc(lo, "year") == lo, lo).otherwise(F.add_months(F.trunc(lo, "year"), 12))
        seq = F.when(first <= hi, F.sequence(first, hi, F.expr("INTERVAL 1 YEAR")))
    else:
        seq = F.sequence(lo, hi, F.expr(f"INTERVAL {int(stride)} DAYS"))
    return spec.select("split", F.explode(seq).alias("issue_date"))


def split_of(date_col: Column | str, blocks: Blocks) -> Column:
    """C4: split name of an arbitrary date (NULL outside every block)."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    expr = None
    for split, (start, end) in blocks.items():
        cond = c.between(F.lit(_to_date(start)), F.lit(_to_date(end)))
        expr = F.when(cond, F.lit(split)) if expr is None else expr.when(cond, F.lit(split))
    return expr


def calendar_generator(blocks: Blocks, stride: str | int = 5) -> Column:
    """The calendar as a generated ``array<struct<split, issue_date>>``.

    One ``sequence`` per split, evaluated at run time, so the plan stays small
    however long the calendar is.
    """
    per_split = []
    for split, (start, end) in blocks.items():
        lo, hi = F.lit(_to_date(start)), F.lit(_to_date(end))
        if stride == "year-start":
            d = _to_date(start)
            first = F.lit(d if (d.month, d.day) == (1, 1) else dt.date(d.year + 1, 1, 1))
            seq = F.sequence(first, hi, F.expr("INTERVAL 1 YEAR"))
            seq = F.when(first <= hi, seq).otherwise(F.array().cast("array<date>"))
        else:
            seq = F.sequence(lo, hi, F.expr(f"INTERVAL {int(stride)} DAYS"))
        per_split.append(F.transform(seq, _tag(split)))
    return F.flatten(F.array(*per_split))


def _tag(split: str):
    def fn(d):
        return F.struct(F.lit(split).alias("split"), d.alias("issue_date"))
    return fn


def issue_days_between(lo: Column, hi: Column, blocks: Blocks, stride: str | int = 5) -> Column:
    """``array<struct<split, sday>>`` of the issue dates (as day numbers) in
    ``[lo, hi]``.  A fixed stride needs arithmetic only, not a calendar."""
    per_split = []
    for split, (start, end) in blocks.items():
        first, last = _to_date(start), _to_date(end)
        if stride == "year-start":
            days = [_day_number(d) for _, d in calendar_dates({split: (start, end)}, stride)]
            seq = F.filter(F.array(*map(F.lit, days)).cast("array<int>"), _between(lo, hi))
        else:
            step, zero = int(stride), _day_number(first)
            a = F.greatest(F.lit(0), F.ceil((lo - zero) / step).cast("int"))
            b = F.least(F.lit((_day_number(last) - zero) // step), F.floor((hi - zero) / step).cast("int"))
            seq = F.when(a <= b, F.transform(F.sequence(a, b), _times(step, zero))).otherwise(
                F.array().cast("array<int>"))
        per_split.append(F.transform(seq, _day_tag(split)))
    return F.flatten(F.array(*per_split))


def _day_number(d: dt.date) -> int:
    return (d - dt.date(1970, 1, 1)).days


def _between(lo, hi):
    return lambda d: (d >= lo) & (d <= hi)


def _times(step, zero):
    return lambda i: i * step + zero


def _day_tag(split: str):
    return lambda d: F.struct(F.lit(split).alias("split"), d.alias("sday"))


def candidates(gauges: DataFrame, blocks: Blocks, stride: str | int = 5,
               key: str = "gauge_id") -> DataFrame:
    """Every gauge x every issue date of every split.

    The calendar is a parameter of bounded size, so each gauge row generates
    its issue dates (a ``Generate``: no join, no shuffle).
    """
    return gauges.select(key, F.inline(calendar_generator(blocks, stride)))
