"""Sources and sinks (S3, S4, S6, S9, K1-K6) over files written to a temp dir."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from basinflow.operators.quality import coverage, skipped_gauges, usable_gauges
from basinflow.sources import readers as R
from basinflow.sinks import writers as W


def _tmp():
    return tempfile.mkdtemp(prefix="bf-test-", dir="/tmp")


RDB = """# comment line
# another comment
agency_cd\tsite_no\tdatetime\t01_00060_00003\t01_00060_00003_cd\t02_00065_00003
5s\t15s\t20d\t14n\t10s\t14n
USGS\t0101\t2024-12-30\t100\tA\t5.0
USGS\t0101\t2024-12-31\tIce\tA\t5.0
USGS\t0101\t2025-01-01\t200\tA\t6.0
USGS\t0101
USGS\t0101\tnot a date\t300\tA\t6.0
"""
RDB_NO_VALUE = """# only a code column
agency_cd\tsite_no\tdatetime\tcode
5s\t15s\t20d\t10s
USGS\t0202\t2024-12-30\tA
"""


def test_rdb_parse_drops_ice_and_files_without_value_column(spark):
    root = _tmp()
    for name, text in (("camels_0101.rdb", RDB), ("camels_0202.rdb", RDB_NO_VALUE)):
        with open(os.path.join(root, name), "w") as fh:
            fh.write(text)
    lines = R.read_rdb_text(spark, root)
    got = sorted((r.date, round(r.streamflow_cms, 6)) for r in R.parse_rdb(lines).collect())
    assert got == [(dt.date(2024, 12, 30), round(100 * 0.0283168, 6)),
                   (dt.date(2025, 1, 1), round(200 * 0.0283168, 6))]
    checks = {os.path.basename(r.file): (r.has_columns, r.n_lines, r.n_bad) for r in R.rdb_checks(lines).collect()}
    assert checks == {"camels_0101.rdb": (True, 5, 2), "camels_0202.rdb": (False, 1, 1)}


def test_stale_gauge_is_skipped(spark):
    flow = spark.createDataFrame([("a", dt.date(2024, 12, 31), 1.0), ("b", dt.date(2024, 12, 30), 1.0),
                                  ("c", dt.date(2024, 12, 31), None)],
                                 "gauge_id string, date date, streamflow_cms double")
    gauges = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "gauge_id string")
    assert [r.gauge_id for r in usable_gauges(gauges, flow, "2024-12-31").collect()] == ["a"]
    sk = {r.gauge_id: r.reason for r in skipped_gauges(gauges, flow, "2024-12-31").collect()}
    assert sk == {"b": "stale", "c": "no_data", "d": "no_data"}
    assert coverage(flow, "2024-12-31").count() == 2


def test_flow_csv_reads_site_from_path(spark):
    root = _tmp()
    for site, rows in (("camels_0101", ["1980-12-31,1.0", "1981-01-01,2.0", "1981-01-02,NaN"]), ("camels_0202", ["2011-01-31,3.0"])):
        with open(os.path.join(root, f"{site}.csv"), "w") as fh:
            fh.write("date,streamflow\n" + "\n".join(rows) + "\n")
    got = sorted((r.site_no, r.year, r.month, r.day, r.streamflow) for r in R.read_flow_csv(spark, root).collect())
    assert got == [("0101", 1981, 1, 1, 2.0), ("0101", 1981, 1, 2, None), ("0202", 2011, 1, 31, 3.0)]


def test_gauge_names_and_lookup(spark):
    from basinflow.operators.evaluate import with_gauge_name
    root = _tmp()
    with open(os.path.join(root, "names.txt"), "w") as fh:
        fh.write("gauge_id;gauge_name\n1013500;Fish River\n2000000;Other\n")
    names = R.read_gauge_names(spark, root)
    df = spark.createDataFrame([("01013500",), ("09999999",)], "basin_id string")
    got = {r.basin_id: r.gauge_name for r in with_gauge_name(df, names).collect()}
    assert got == {"01013500": "Fish River", "09999999": "Unknown"}


def test_load_or_build_reuses_committed_table(spark):
    root = _tmp()
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([("a", 1.0)], "gauge_id string, v double")

    def skipped():
        return spark.createDataFrame([("z",)], "gauge_id string")

    for _ in range(2):
        flow, sk = R.load_or_build(spark, f"{root}/flow", build, f"{root}/skipped", skipped)
        assert flow.count() == 1 and [r.gauge_id for r in sk.collect()] == ["z"]
    assert len(calls) == 1


def test_partitioned_and_batched_writes(spark):
    root = _tmp()
    df = spark.createDataFrame(
        [("train", "a", 0, 0, "train_data_batch00000", [[1.0]], [1.0]), ("test", "b", 3, 7, "test_data_batch00003", [[2.0]], [2.0])],
        "split string, basin_id string, batch_id int, pos long, file_name string, dynamic_inputs array<array<float>>, "
        "targets array<float>")
    assert R.read_batches(spark, f"{root}/batches") is None
    W.write_batches(df, f"{root}/batches", features=["precip"])
    assert {(r.split, r.batch_id) for r in R.read_batches(spark, f"{root}/batches").collect()} == {("train", 0), ("test", 3)}
    df = df.drop("pos", "file_name")
    assert sorted(n for n in os.listdir(f"{root}/batches") if not n.startswith(".")) == [
        "_SUCCESS", "split=test", "split=train"]
    W.write_partitioned(df.drop("batch_id"), f"{root}/groups")
    assert os.path.isdir(f"{root}/groups/split=train/basin_id=a")
    gone = spark.createDataFrame([("train", "a"), ("train", "never")], "split string, basin_id string")
    assert [W.drop_groups(gone, f"{root}/groups") for _ in range(2)] == [1, 0]
    assert [r.basin_id for r in R.read_partitioned(spark, f"{root}/groups").collect()] == ["b"]
    W.write_splits(df.drop("batch_id"), f"{root}/splits")
    back = R.read_samples(spark, f"{root}/splits", "test")
    assert [r.basin_id for r in back.collect()] == ["b"]


def test_relayout_keeps_content(spark):
    root = _tmp()
    df = spark.createDataFrame([("b", dt.date(2000, 1, i), float(i)) for i in range(1, 20)]
                               + [("a", dt.date(2000, 1, i), float(-i)) for i in range(1, 20)],
                               "basin_id string, date date, precip double")
    W.relayout(df, f"{root}/grid", partitions=3)
    back = spark.read.parquet(f"{root}/grid")
    assert sorted(back.collect()) == sorted(df.collect())


def test_summary_csv_and_batch_labels(spark):
    from basinflow.functions.columns import batch_file_name, batch_number, group_file_name
    root = _tmp()
    s = spark.createDataFrame([("0101", "train", 3)], "gauge_id string, split string, n_samples int")
    s = s.withColumn("filename", group_file_name("split", "gauge_id", F.col("n_samples")))
    W.write_summary(s, f"{root}/summary")
    back = spark.read.option("header", True).csv(f"{root}/summary").collect()[0]
    assert (back.gauge_id, back.filename) == ("0101", "train_0101_3")
    df = spark.createDataFrame([("train", 7)], "split string, b int")
    row = df.select(batch_file_name("split", "b").alias("f")).select(
        "f", batch_number("f").alias("n")).collect()[0]
    assert (row.f, row.n) == ("train_data_batch00007", 7)


def test_whole_rdb_files_equal_line_by_line_and_move_no_line(spark):
    root = _tmp()
    odd = {"camels_0303.rdb": "", "camels_0404.rdb": "# only comments\n", "camels_0505.rdb": RDB.replace("\n", "\r\n"),
           "camels_0606.rdb": RDB + "\n", "camels_0707.rdb": RDB.rstrip("\n")}
    for name, text in {"camels_0101.rdb": RDB, "camels_0202.rdb": RDB_NO_VALUE, **odd}.items():
        with open(os.path.join(root, name), "w", newline="") as fh:
            fh.write(text)

    def seen(df):
        return sorted((os.path.basename(r["file"]), *[str(x) for x in list(r)[1:]]) for r in df.collect())

    lines = R.read_rdb_text(spark, root)
    for limit in (0, 100, 1 << 20):                   # all by line, some, all whole
        assert seen(R.read_rdb(spark, root, limit)) == seen(R.parse_rdb(lines))
        assert seen(R.check_rdb(spark, root, limit)) == seen(R.rdb_checks(lines))
    whole = R._whole_rdb_rows(spark.read.text(root, wholetext=True).select(F.input_file_name().alias("file"), "value"), "file")
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()


def test_damaged_csv_lines_are_counted_and_kept_apart(spark):
    root = _tmp()
    os.makedirs(f"{root}/site=camels_01")
    with open(f"{root}/site=camels_01/a.csv", "w") as fh:
        fh.write("date,streamflow\n2000-01-01,1.5\nno-date,2.0\n2000-01-03,broken\n2000-01-04\n2000-01-05,\n2000-01-06,NaN\n2000-01-07,3.0,9\n2000-01-08,4\n")
    c = R.flow_csv_checks(spark, root).first()
    assert (c.site_no, c.n_lines, c.n_bad, c.n_missing) == ("01", 8, 4, 2)
    assert sorted(r.damaged for r in R.flow_csv_damaged(spark, root).collect()) == ["2000-01-03,broken", "2000-01-04", "2000-01-07,3.0,9", "no-date,2.0"]
    assert R.flow_csv_checks(spark, root).select("n_bad").first()[0] == 4          # pruned columns do not hide damage
    assert sorted((r.day, r.streamflow) for r in R.read_flow_csv(spark, root).collect()) == [(1, 1.5), (5, None), (6, None), (8, 4.0)]
