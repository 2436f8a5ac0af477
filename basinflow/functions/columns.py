"""Column helpers: projections, predicates and scalar functions.

All of them return built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values taken over from the reference's processing.
BASIN_PREFIX = "camels_"          # grid label = prefix + gauge id
CFS_TO_CMS = 0.0283168            # cubic feet/s -> cubic metres/s
NORM_EPS = 1e-6                   # epsilon of the normaliser
FLAG_LEGEND = {"0": "weekly ERA5", "1": "daily ERA5", "2": "HRES"}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# -- ids ---------------------------------------------------------------------

def gauge_suffix(col) -> Column:
    """Last ``_``-separated part of a prefixed key (``camels_0101`` -> ``0101``)."""
    return F.element_at(F.split(_c(col), "_"), -1)


def basin_key(col) -> Column:
    """Grid label of a gauge id."""
    return F.concat(F.lit(BASIN_PREFIX), _c(col))


def gauge_int(col) -> Column:
    """integer gauge key for name lookups (leading zeros dropped)."""
    return _c(col).try_cast("int")


# -- values ------------------------------------------------------------------

def nan_to_null(col) -> Column:
    """Sources turn NaN into NULL once; every operator treats NULL as missing."""
    c = _c(col)
    return F.when(~F.isnan(c), c)


def to_number(col) -> Column:
    """Text to double, unparsable text (``Ice``) becomes NULL."""
    return _c(col).try_cast("double")


def cfs_to_cms(col) -> Column:
    """Cubic feet per second to cubic metres per second."""
    return _c(col) * F.lit(CFS_TO_CMS)


def is_missing(col, check_inf: bool = False) -> Column:
    """NULL or NaN (and optionally +-Inf)."""
    c = _c(col)
    cond = c.isNull() | F.isnan(c)
    if check_inf:
        cond = cond | (F.abs(c) == F.lit(float("inf")))
    return F.coalesce(cond, F.lit(True))


def iso_date(col) -> Column:
    """``yyyy-MM-dd`` label."""
    return F.date_format(_c(col), "yyyy-MM-dd")


def date_from_parts(year, month, day) -> Column:
    """P10: date from its parts."""
    return F.make_date(_c(year), _c(month), _c(day))


# -- scaling -------------------------------------------------------------------

def normalize(x, mean, std) -> Column:
    """``(x - mean) / (std + 1e-6)``."""
    return (_c(x) - _c(mean)) / (_c(std) + F.lit(NORM_EPS))


def denormalize(x, mean, std) -> Column:
    """inverse of ``normalize``."""
    return _c(x) * (_c(std) + F.lit(NORM_EPS)) + _c(mean)


def standardize(x, mean, std) -> Column:
    """``(x - mean) / std`` without epsilon; NULL where std is 0."""
    return F.try_divide(_c(x) - _c(mean), _c(std))


def unstandardize(x, mean, std) -> Column:
    """``x * std + mean``."""
    return _c(x) * _c(std) + _c(mean)


# -- labels --------------------------------------------------------------------

def batch_file_name(split, batch_id) -> Column:
    """``{split}_data_batch{n:05d}``."""
    return F.format_string("%s_data_batch%05d", _c(split), _c(batch_id))


def batch_number(name) -> Column:
    """batch number parsed back out of a file name (NULL if absent)."""
    return F.regexp_extract(_c(name), r"_data_batch(\d+)", 1).try_cast("int")


def group_file_name(split, gauge, n) -> Column:
    """``{split}_{gauge}_{n}`` name of a per-group file."""
    return F.format_string("%s_%s_%d", _c(split), _c(gauge), _c(n))


def feature_names(prefix: str, n: int) -> list[str]:
    """positional names ``feat0``, ``feat1``, ..."""
    return [f"{prefix}{i}" for i in range(n)]
