"""Series stored by (key, time block) for the window joins (K6 for J2-J5).

``write_blocked`` makes the copies that the window fan-out needs (one per time
block whose issue dates can use a row) once and stores them bucketed and sorted
by (key, block).  ``windows.fan_out`` takes what ``read_blocked`` returns in
place of a series and then moves none of its rows: a re-run, another calendar
or another candidate set costs a scan of the blocks it uses.

The layout (window, block length, buckets) lies beside the files and is checked
where they are used: a window wider than the stored one is refused, a narrower
one is cut out.  Rows without a date are in no window and are not stored; an
empty series gives an empty store.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.windows import DEFAULT_BLOCK_DAYS, block_of, fan_partitions
from .tables import committed, small_files, write_small

LAYOUT = "_layout"


@dataclass(frozen=True)
class Blocked:
    """A stored series and the windows it can serve."""
    df: DataFrame
    key: str
    lo: int
    hi: int
    block_days: int
    buckets: int

    def check(self, key: str, lo: int, hi: int, block_days: int) -> None:
        if key != self.key or block_days != self.block_days or lo < self.lo or hi > self.hi:
            raise ValueError(f"stored for {self.key}, days {self.lo}..{self.hi}, blocks of {self.block_days}; "
                             f"asked for {key}, days {lo}..{hi}, blocks of {block_days}")


def _table(path: str) -> str:
    return "blocked_" + hashlib.sha1(path.encode()).hexdigest()


def write_blocked(series: DataFrame, path: str, lo: int, hi: int, key: str = "basin_id", date_col: str = "date",
                  block_days: int = DEFAULT_BLOCK_DAYS, buckets: int | None = None) -> Blocked:
    """Store ``series`` for windows of days ``lo`` .. ``hi`` around an issue
    date, in a new folder; rows are moved once, each task writes one bucket."""
    spark = series.sparkSession
    if small_files(spark, path, LAYOUT):
        raise FileExistsError(path)
    n = fan_partitions(spark, buckets)
    b_lo, b_hi = (block_of(F.date_sub(F.col(date_col), days), block_days) for days in (hi, lo))
    rows = series.where(F.col(date_col).isNotNull()).withColumn("block", F.explode(F.sequence(b_lo, b_hi)))
    spark.sql(f"DROP TABLE IF EXISTS {_table(path)}")
    (rows.repartition(n, key, "block").write.mode("overwrite").bucketBy(n, key, "block").sortBy(key, "block")
     .option("path", path).format("parquet").saveAsTable(_table(path)))
    write_small(spark, f"{path.rstrip('/')}/{LAYOUT}.json", json.dumps(
        {"key": key, "lo": lo, "hi": hi, "block_days": block_days, "buckets": n, "schema": rows.schema.jsonValue()}))
    return read_blocked(spark, path)


def read_blocked(spark: SparkSession, path: str) -> Blocked:
    """The stored series of ``path``; also in a session that did not write it."""
    found = small_files(spark, path, LAYOUT)
    if not found or not committed(spark, path):
        raise FileNotFoundError(f"no stored series in {path}")
    m = json.loads(found[f"{LAYOUT}.json"])
    schema = StructType.fromJson(m.pop("schema"))
    name = _table(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{m['key']}`, block) "
                  f"SORTED BY (`{m['key']}`, block) INTO {m['buckets']} BUCKETS LOCATION '{path}'")
    return Blocked(spark.table(name), **m)
