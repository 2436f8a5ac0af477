"""Series stored by (basin, time block): same samples, no exchange of its rows."""

import datetime as dt

import pytest

from basinflow.fixtures import ANNUAL_BLOCKS, Fixtures
from basinflow.operators import samples as smp
from basinflow.operators.windows import fan_out
from basinflow.sinks.blocked import _table, read_blocked, write_blocked
from test_plans_entry import SF, _plan

RECIPE = smp.AnnualRecipe()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    f = Fixtures(spark, SF)
    path = str(tmp_path_factory.mktemp("blocked") / "series")
    return path, write_blocked(smp.annual_series(f.flow_dense, f.obs), path, RECIPE.lo, 0)


def test_same_steps_without_moving_a_row(spark, stored):
    f = Fixtures(spark, SF)
    got, want = smp.annual_steps(None, None, ANNUAL_BLOCKS, stored=stored[1]), smp.annual_steps(f.flow_dense, f.obs, ANNUAL_BLOCKS)
    assert "Exchange" not in _plan(got) and "Bucketed: true" in _plan(got) and "Exchange" in _plan(want)
    a, b = got.collect(), want.select(*got.columns).collect()
    assert a and sorted(map(str, a)) == sorted(map(str, b))


def test_found_again_by_a_session_that_did_not_declare_it(spark, stored):
    path, first = stored
    spark.sql(f"DROP TABLE {_table(path)}")
    again = read_blocked(spark, path)
    assert (again.lo, again.hi, again.buckets) == (first.lo, first.hi, first.buckets)
    steps = smp.annual_steps(None, None, ANNUAL_BLOCKS, stored=again)
    assert "Exchange" not in _plan(steps) and steps.count() > 0


def test_windows_are_checked_and_cut_out(spark, tmp_path):
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=i) for i in range(60)]
    df = spark.createDataFrame([(b, d, float(i)) for b in "xy" for i, d in enumerate(days)] + [("x", None, 1.0), (None, days[0], 2.0)],
                               "basin_id string, date date, v double")
    store = write_blocked(df, str(tmp_path / "s"), -20, 5, block_days=7, buckets=3)
    blocks = {"a": ("2000-01-20", "2000-02-10")}
    for lo, hi in ((-20, 5), (-3, 0)):
        got = fan_out(store, "basin_id", blocks, 5, lo, hi, 7)
        want = fan_out(df, "basin_id", blocks, 5, lo, hi, 7)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())) and want.count()
    for lo, hi, length in ((-21, 5, 7), (-20, 6, 7), (-20, 5, 8)):
        with pytest.raises(ValueError):
            fan_out(store, "basin_id", blocks, 5, lo, hi, length)
    with pytest.raises(FileExistsError):
        write_blocked(df, str(tmp_path / "s"), -20, 5)
    with pytest.raises(FileNotFoundError):
        read_blocked(spark, str(tmp_path / "nothing"))
    none = write_blocked(df.limit(0), str(tmp_path / "empty"), -20, 5, block_days=7, buckets=3)
    assert fan_out(none, "basin_id", blocks, 5, -20, 5, 7).count() == 0
