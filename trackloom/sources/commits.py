"""A table in folders whose upserts are there as a whole or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Layout: rows/version=N/<by>=K/*.parquet, and manifests/N, a small table that names for each part (a value of `by`)
# the version that holds it. Only manifests with the marker of a finished job count, and the last of them is the table.


def _numbers(spark: SparkSession, folder: str, finished: bool) -> list[int]:
    """The numbers that the names of a folder's folders end in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    found = [x.getPath() for x in fs.listStatus(at) if x.isDirectory()]
    whole = [p for p in found if not finished or fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().rpartition("=")[2]) for p in whole)


def current(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows of the last commit; None before the first."""
    done = _numbers(spark, f"{root}/manifests", True)
    if not done:
        return None
    manifest = spark.read.parquet(f"{root}/manifests/{done[-1]}")
    by = manifest.columns[0]
    rows = spark.read.option("basePath", f"{root}/rows").parquet(*[f"{root}/rows/version={r[0]}" for r in manifest.select("version").distinct().collect()])
    rows = rows.withColumn(by, F.col(by).cast(manifest.schema[by].dataType))
    parts = manifest.select(F.col(by).alias("_by"), F.col("version").alias("_version"))
    return rows.join(parts, F.col(by).eqNullSafe(F.col("_by")) & (F.col("version") == F.col("_version")), "left_semi").drop("version")


def stage(root: str, new: DataFrame, keys: list[str], by: str = "video_id") -> tuple[int, DataFrame]:
    """Writes the parts that new touches, with their other rows of the table, as a version that nothing reads yet; what to commit."""
    spark = new.sparkSession
    number = max([0, *_numbers(spark, f"{root}/rows", False), *_numbers(spark, f"{root}/manifests", False)]) + 1
    touched, old = new.select(by).distinct(), current(spark, root)
    merged = new
    if old is not None:
        near = old.join(F.broadcast(touched.withColumnRenamed(by, "_by")), F.col(by).eqNullSafe(F.col("_by")), "left_semi")
        merged = near.join(new.select(*keys).distinct(), keys, "left_anti").select(*new.columns).unionByName(new)
    merged.write.partitionBy(by).parquet(f"{root}/rows/version={number}")
    return number, touched


def commit(root: str, staged: tuple[int, DataFrame]) -> None:
    """Makes a staged version part of the table, by one small job whose end is the commit."""
    number, touched = staged
    spark = touched.sparkSession
    by, done = touched.columns[0], _numbers(spark, f"{root}/manifests", True)
    parts = touched.withColumn("version", F.lit(number))
    if done:
        before = spark.read.parquet(f"{root}/manifests/{done[-1]}")
        gone = touched.withColumnRenamed(by, "_by")
        parts = before.join(gone, F.col(by).eqNullSafe(F.col("_by")), "left_anti").unionByName(parts)
    parts.coalesce(1).write.parquet(f"{root}/manifests/{number}")


def upsert(root: str, new: DataFrame, keys: list[str], by: str = "video_id") -> DataFrame:
    """The table at root with new's rows in place of those with their keys; new rows of one key all stay.

    Only the parts that new touches are written again. Whatever stops before the end leaves the table as it was,
    and readable; what it staged is never read. One writer at a time. Keys must not be null.
    """
    commit(root, stage(root, new, keys, by))
    return current(new.sparkSession, root)


def vacuum(spark: SparkSession, root: str) -> list[int]:
    """Removes versions that the last commit does not name, and all manifests but the last; the versions that went. Not while others read or write."""
    done = _numbers(spark, f"{root}/manifests", True)
    named = {r[0] for r in spark.read.parquet(f"{root}/manifests/{done[-1]}").select("version").distinct().collect()} if done else set()
    gone = [n for n in _numbers(spark, f"{root}/rows", False) if n not in named]
    for path in [*[f"{root}/rows/version={n}" for n in gone], *[f"{root}/manifests/{n}" for n in _numbers(spark, f"{root}/manifests", False)[:-1] if n != (done or [0])[-1]]]:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return gone
