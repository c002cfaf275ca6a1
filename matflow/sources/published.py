"""Published tables: one folder per table under a root, partitioned by run date."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def folder_files(spark: SparkSession, folder: str):
    """The Hadoop file system of a folder, its path, and the names of the files in it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system, path, {s.getPath().getName() for s in system.listStatus(path)} if system.exists(path) else set()


def _is_constant(spark: SparkSession, value: Column) -> bool:
    """Whether a value names no column."""
    try:
        spark.range(1).select(F.lit(0).alias("__none")).select(value)
    except AnalysisException:
        return False
    return True


def publish(
    df: DataFrame,
    root: str,
    table: str,
    as_of: Column | None = None,
    run_dates: Iterable[date] = (),
    cluster: bool = True,
) -> None:
    """Write a table, replacing the run dates that occur in ``df`` and those listed in ``run_dates``.

    ``as_of`` sets the run date of all rows; without it the table must have that column. A row without a run date is
    an error. A listed date without rows loses what it had, once the new rows are written. ``cluster`` brings the rows
    of a run date together first, so that a date gets few files: a rebalance splits a run date that is too large for
    one task and joins small ones. Switch it off for inputs that already lie by date; rows that ``as_of`` gives one and
    the same date lie so anyway and are written where they are, without a shuffle.
    """
    spark = df.sparkSession
    day = F.col("as_of") if as_of is None else as_of
    missing = F.raise_error(F.lit(f"a row of {table} has no run date")).cast("date")
    dated = df.withColumn("as_of", F.coalesce(day, missing))
    if cluster and (as_of is None or not _is_constant(spark, as_of)):
        dated = dated.hint("rebalance", F.col("as_of"))
    folders = [f"{root}/{table}/as_of={day.isoformat()}" for day in run_dates]
    before = {folder: folder_files(spark, folder)[2] for folder in folders}
    (
        dated.write.partitionBy("as_of")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(f"{root}/{table}")
    )
    for folder, old in before.items():
        system, path, now = folder_files(spark, folder)
        if now & old:  # a date that was written again has new files only
            system.delete(path, True)


def read_published(spark: SparkSession, root: str, table: str, schema: StructType | None = None) -> DataFrame:
    """A published table; a filter on ``as_of`` reads only those run dates.

    A table that never had a row has no file to tell its columns and needs ``schema``.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root}/{table}").withColumn("as_of", F.col("as_of").cast("date"))


def publish_tables(
    tables: Mapping[str, DataFrame], root: str, as_of: Column | None = None, run_dates: Iterable[date] = ()
) -> None:
    """Write several named tables under one root."""
    days = list(run_dates)
    for name, df in tables.items():
        publish(df, root, name, as_of, days)


def read_tables(spark: SparkSession, root: str, *tables: str) -> DataFrame:
    """Several published tables stacked by name, with a ``table`` column."""
    parts = [
        read_published(spark, root, name).select(F.lit(name).alias("table"), "*") for name in tables
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
