"""Materialised tables in the shared checkpoint folder.

``materialize`` writes a DataFrame once as Parquet and returns a DataFrame
reading it back, cutting the lineage (an executor lost later recomputes from
the written files, not from the whole upstream plan).  A folder whose write
committed (``_SUCCESS`` present) is reused; an unfinished one is overwritten.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def committed(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def delete_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p) and fs.delete(p, True))


def file_state(spark: SparkSession, paths: list[str]) -> str:
    """Digest of the names, sizes and modification times of the files under
    ``paths``, listed through Hadoop (any file system Spark reads)."""
    found = []

    def walk(fs, status):
        if status.isDirectory():
            for child in fs.listStatus(status.getPath()):
                walk(fs, child)
        else:
            found.append(f"{status.getPath().toString()}|{status.getLen()}|{status.getModificationTime()}")

    for path in paths:
        fs, p = _fs(spark, path)
        walk(fs, fs.getFileStatus(p))
    return hashlib.sha1("\n".join(sorted(found)).encode()).hexdigest()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all; it must be new."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    part = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + ".part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(part, p):
        raise OSError(f"could not create {path}")


def small_files(spark: SparkSession, folder: str, prefix: str) -> dict[str, str]:
    """Texts of the small ``.json`` files of a folder whose names begin so."""
    if not path_exists(spark, folder):
        return {}
    fs, p = _fs(spark, folder)
    io, found = spark.sparkContext._jvm.org.apache.commons.io.IOUtils, {}
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith(prefix) and name.endswith(".json"):
            stream = fs.open(status.getPath())
            try:
                found[name] = io.toString(stream, "UTF-8")
            finally:
                stream.close()
    return found


# Read DataFrames of immutable inputs, per session: a plan is reusable, and
# re-reading Parquet footers for every query costs driver time.
_READS: dict[tuple, DataFrame] = {}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """``spark.read.parquet`` of an input that does not change while the
    session lives (landed tables, the given test tables)."""
    key = (id(spark), spark.sparkContext.applicationId, path)
    df = _READS.get(key)
    if df is None:
        df = _READS[key] = spark.read.parquet(path)
    return df


def materialize(df, path: str, partition_by: list[str] | None = None,
                spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` once (``df`` may be a zero-argument builder, called only
    when the table is not there yet) and return a DataFrame reading it."""
    if spark is None:
        spark = df.sparkSession
    if not committed(spark, path):
        frame = df() if callable(df) else df
        w = frame.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        _READS.pop((id(spark), spark.sparkContext.applicationId, path), None)
    return read_parquet(spark, path)
