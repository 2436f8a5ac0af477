"""Sources (S1-S9): explicit schemas, no inference, pushdown-friendly.

The reference opens Zarr/NetCDF grids, per-gauge CSV files, gauge-service
text (RDB) and a names file.  Grids enter this package as Parquet tables
(one row per cell); text formats are read with Spark's own readers.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import batch_number, cfs_to_cms, date_from_parts, gauge_suffix, nan_to_null, to_number
from ..sinks.tables import committed
from ..sinks.writers import write_flow_cache

OBS_SCHEMA = T.StructType([
    T.StructField("basin_id", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("precip", T.FloatType()), T.StructField("temp", T.FloatType()),
    T.StructField("net_solar", T.FloatType()), T.StructField("u_wind", T.FloatType()),
    T.StructField("v_wind", T.FloatType()), T.StructField("dew_point", T.FloatType())])
FCST_SCHEMA = T.StructType([
    T.StructField("basin_id", T.StringType()), T.StructField("issue_date", T.DateType()),
    T.StructField("lead_days", T.IntegerType()), T.StructField("precip", T.FloatType()),
    T.StructField("temp", T.FloatType()), T.StructField("net_solar", T.FloatType())])
NAMES_SCHEMA = "gauge_id INT, gauge_name STRING"
# Format codes that pick the columns of the gauge-service text,
# and the period kept of the per-gauge CSV files.
RDB_DATE_CODE = "20d"
RDB_VALUE_CODE = "14n"
FLOW_CSV_RANGE = ("1981-01-01", "2011-01-31")
WHOLE_FILE_BYTES = 16 << 20      # text files up to this size are parsed whole, in one row


def _nan_free(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sources turn NaN into NULL once (pandas skips NaN, Spark's avg would not)."""
    return df.select(*[nan_to_null(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def read_obs(spark: SparkSession, path: str, variables: list[str] | None = None,
             start=None, end=None, basin: str | None = None) -> DataFrame:
    """S1 (+P3-P5): observed weather grid; filters reach the Parquet scan."""
    df = spark.read.schema(OBS_SCHEMA).parquet(path)
    if basin is not None:
        df = df.where(F.col("basin_id") == basin)
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("date") <= F.lit(end).cast("date"))
    variables = variables or ["precip", "temp", "net_solar"]
    return _nan_free(df.select("basin_id", "date", *variables), variables)


def read_forecast(spark: SparkSession, path: str, variables: list[str] | None = None) -> DataFrame:
    """Forecast grid, lead time as whole days."""
    variables = variables or ["precip", "temp", "net_solar"]
    df = spark.read.schema(FCST_SCHEMA).parquet(path).select(
        "basin_id", "issue_date", "lead_days", *variables)
    return _nan_free(df, variables)


def flow_csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the per-gauge CSV files: site_no, file, date, streamflow,
    and in ``damaged`` the line itself where it does not fit the schema (a field
    that is no date or number, too few or too many fields), else NULL.

    The site number comes from the ``camels_<id>`` part of each file's path."""
    df = (spark.read.schema("date STRING, streamflow STRING, odd STRING").option("header", True)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "odd").csv(path))
    file, date, flow = F.input_file_name(), F.col("date").try_cast("date"), F.col("streamflow").try_cast("double")
    bad = F.col("odd").isNotNull() | date.isNull() | (F.col("streamflow").isNotNull() & flow.isNull())
    line = F.coalesce("odd", F.concat_ws(",", F.coalesce("date", F.lit("")), F.coalesce("streamflow", F.lit(""))))
    return df.select(F.regexp_extract(file, r"camels_(\d+)", 1).alias("site_no"), file.alias("file"), date.alias("date"),
                     nan_to_null(flow).alias("streamflow"), F.when(bad, line).alias("damaged"))


def read_flow_csv(spark: SparkSession, path: str, start: str = FLOW_CSV_RANGE[0],
                  end: str = FLOW_CSV_RANGE[1]) -> DataFrame:
    """S3 (+P10, P16): one CSV per gauge, all read in one scan; damaged lines
    are left out (``flow_csv_checks`` counts them, ``flow_csv_damaged`` has them)."""
    df = flow_csv_rows(spark, path).where(F.col("damaged").isNull())
    df = df.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    out = df.select("site_no", F.year("date").alias("year"), F.month("date").alias("month"),
                    F.dayofmonth("date").alias("day"), "streamflow")
    return out.withColumn("datetime", date_from_parts("year", "month", "day"))


def flow_csv_damaged(spark: SparkSession, path: str) -> DataFrame:
    """The quarantine: site_no, file and text of each damaged line."""
    return flow_csv_rows(spark, path).where(F.col("damaged").isNotNull()).select("site_no", "file", "damaged")


def flow_csv_checks(spark: SparkSession, path: str) -> DataFrame:
    """Per file its lines, how many are damaged, and how many of the others
    have no value."""
    bad = F.col("damaged").isNotNull()
    return flow_csv_rows(spark, path).groupBy("site_no", "file").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count(F.when(bad, 1)).alias("n_bad"),
        F.count(F.when(~bad & F.col("streamflow").isNull(), 1)).alias("n_missing"))


_RDB_FORMAT = r"^\d+[sdn](\t\d+[sdn])*$"


def _at(fields: Column) -> Column:
    """Places of the date and value codes in a format row's fields."""
    return F.named_struct(F.lit("d"), F.array_position(fields, RDB_DATE_CODE).cast("int"),
                          F.lit("v"), F.array_position(fields, RDB_VALUE_CODE).cast("int"))


def _rdb_fields(data: DataFrame, file_col: str) -> DataFrame:
    """Data lines (``_f``) with the columns their file's format row (``_at``)
    names: ``date`` and ``text`` are NULL where the line is short, the date is
    no date, or the file names no such column."""
    def field(at):
        return F.when(at > 0, F.try_element_at("_f", at))

    has = F.coalesce((F.col("_at.d") > 0) & (F.col("_at.v") > 0), F.lit(False))
    return data.select(file_col, has.alias("has_columns"), field(F.col("_at.d")).try_cast("date").alias("date"),
                       field(F.col("_at.v")).alias("text"))


def _rdb_rows(lines: DataFrame, file_col: str) -> DataFrame:
    """``_rdb_fields`` of single lines, which meet their file's format row in a join."""
    body = lines.where(~F.col("value").startswith("#")).withColumn("_f", F.split("value", "\t"))
    is_fmt = F.col("value").rlike(_RDB_FORMAT)
    fmt = body.where(is_fmt).groupBy(file_col).agg(F.max(_at(F.col("_f"))).alias("_at"))
    data = body.where(~is_fmt & ~F.col("value").startswith("agency_cd"))
    return _rdb_fields(data.join(fmt, file_col, "left"), file_col)


def _whole_rdb_rows(files: DataFrame, file_col: str) -> DataFrame:
    """``_rdb_fields`` of whole files (``value``): the format row is found and
    applied where the file is read, so no line is moved."""
    split = files.select(file_col, F.split("value", "\r\n|\r|\n", -1).alias("_all"))
    ended = F.element_at("_all", -1) == ""           # the file ends with a line end
    body = split.select(file_col, F.filter(
        F.slice("_all", F.lit(1), F.size("_all") - F.when(ended, 1).otherwise(0)), lambda x: ~x.startswith("#")).alias("_lines"))
    fmt = F.filter("_lines", lambda x: x.rlike(_RDB_FORMAT))
    # The format row is sought once a file, before its lines become rows.
    known = body.select(file_col, "_lines", F.array_max(F.transform(fmt, lambda x: _at(F.split(x, "\t")))).alias("_at"))
    each = known.select(file_col, "_at", F.explode("_lines").alias("value"))
    data = each.where(~F.col("value").rlike(_RDB_FORMAT) & ~F.col("value").startswith("agency_cd"))
    return _rdb_fields(data.select(file_col, "_at", F.split("value", "\t").alias("_f")), file_col)


def rdb_rows(spark: SparkSession, path: str, max_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Fields of all landed text files: those of at most ``max_bytes`` are read
    whole, larger ones line by line (their lines meet the format row in a join)."""
    size, file = F.col("_metadata.file_size"), F.input_file_name().alias("file")
    whole = spark.read.text(path, wholetext=True).where(size <= max_bytes).select(file, "value")
    lines = spark.read.text(path).where(size > max_bytes).select(file, "value")
    return _whole_rdb_rows(whole, "file").unionByName(_rdb_rows(lines, "file"))


def _rdb_flow(rows: DataFrame, file_col: str) -> DataFrame:
    out = rows.where("has_columns").select(file_col, "date", nan_to_null(to_number("text")).alias("cfs")).dropna(subset=["cfs", "date"])
    return out.select(file_col, "date", cfs_to_cms("cfs").alias("streamflow_cms"))


def _rdb_checks(rows: DataFrame, file_col: str) -> DataFrame:
    bad = ~F.col("has_columns") | F.col("date").isNull() | F.col("text").isNull()
    return rows.groupBy(file_col).agg(F.max("has_columns").alias("has_columns"), F.count(F.lit(1)).alias("n_lines"),
                                      F.count(F.when(bad, 1)).alias("n_bad"))


def parse_rdb(lines: DataFrame, file_col: str = "file") -> DataFrame:
    """S4 (+P6-P9, P15, X4): gauge-service text lines -> ``(file, date, streamflow_cms)``.

    Lines starting with ``#`` are comments; the first other line names the
    columns and the second gives format codes (``5s 15s 20d 14n 10s``), which
    is the row the reference uses as header, so columns are picked by the
    codes ``20d`` (date) and the first ``14n`` (value).  Rows are classified
    by content (Spark keeps no line order); a file without both codes and a
    line that cannot be read are left out (``rdb_checks`` counts them) and never
    stop the others.  Unparsable values (``Ice``) become NULL and are dropped;
    cfs are converted to cubic metres per second.
    """
    return _rdb_flow(_rdb_rows(lines, file_col), file_col)


def read_rdb(spark: SparkSession, path: str, max_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """``parse_rdb`` of landed files, read whole up to ``max_bytes`` each."""
    return _rdb_flow(rdb_rows(spark, path, max_bytes), "file")


def rdb_checks(lines: DataFrame, file_col: str = "file") -> DataFrame:
    """Per file, whether both required format codes are present, its
    data lines, and how many of them cannot be read (short, or no date)."""
    return _rdb_checks(_rdb_rows(lines, file_col), file_col)


def check_rdb(spark: SparkSession, path: str, max_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """``rdb_checks`` of landed files; only counts are moved."""
    return _rdb_checks(rdb_rows(spark, path, max_bytes), "file")


def read_rdb_text(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines of landed RDB files with their file name."""
    return spark.read.text(path).withColumn("file", F.input_file_name())


def read_gauges(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Gauge inventory, short ids (geometry, if any, is not read)."""
    return (spark.read.format(fmt).option("header", True).load(path)
            .select(gauge_suffix("gauge_id").alias("gauge_id")))


def read_gauge_names(spark: SparkSession, path: str) -> DataFrame:
    """``;``-delimited names file with header."""
    return spark.read.schema(NAMES_SCHEMA).option("header", True).option("sep", ";").csv(path)


def read_static(spark: SparkSession, path: str, feature_cols: list[str] | None = None) -> DataFrame:
    """Static attributes as ``(gauge_id string, features array<double>)``.

    Either already an array column or one column per attribute (packed here).
    """
    df = spark.read.parquet(path)
    gid = F.col("gauge_id").cast("string").alias("gauge_id")
    if feature_cols:
        return df.select(gid, F.array(*[F.col(c).cast("double") for c in feature_cols]).alias("features"))
    return df.select(gid, "features")


def read_partitioned(spark: SparkSession, path: str, keys: tuple[str, ...] = ("split", "basin_id")) -> DataFrame:
    """Parquet folder with ``key=value`` partitions, ``keys`` read as *strings*.

    Gauge ids such as ``01013500`` must not be inferred as integers, so the
    schema is given; no session setting changes.
    """
    found = spark.read.parquet(path).schema
    fixed = T.StructType([T.StructField(f.name, T.StringType()) if f.name in keys else f for f in found])
    return spark.read.schema(fixed).parquet(path)


def read_samples(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A written sample set; ``split`` prunes partitions."""
    df = read_partitioned(spark, path)
    return df.where(F.col("split") == split) if split is not None else df


def read_legend(samples: DataFrame, col: str = "dynamic_inputs") -> DataFrame:
    """(flag, meaning, features) from the column metadata of a written
    sample set: one row a flag value, the features' names in order."""
    meta = samples.schema[col].metadata
    names = ",".join(meta.get("feature", []))
    rows = [(k, v, names) for k, v in json.loads(meta.get("flag_description", "{}")).items()]
    return samples.sparkSession.createDataFrame(rows, "flag string, meaning string, features string")


def read_batches(spark: SparkSession, path: str) -> DataFrame | None:
    """What ``write_batches`` wrote, with the batch number taken from each
    batch's file label (F10); None when nothing was written yet."""
    if not committed(spark, path):
        return None
    return read_partitioned(spark, path, ("split",)).withColumn("batch_id", batch_number("file_name"))


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                  skipped_path: str | None = None,
                  skipped: Callable[[], DataFrame] | None = None):
    """Reuse a committed table (and skipped-gauge list) or build and save."""
    if not committed(spark, path) or (skipped_path and not committed(spark, skipped_path)):
        if skipped_path and skipped is not None:
            write_flow_cache(build(), skipped(), path, skipped_path)
        else:
            build().write.mode("overwrite").parquet(path)
    flow = spark.read.parquet(path)
    if skipped_path:
        return flow, spark.read.text(skipped_path).withColumnRenamed("value", "gauge_id")
    return flow
