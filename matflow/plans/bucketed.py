"""Demand of many weeks without moving the bill of materials again: both sides lie in buckets of the join's key.

The lines of the bill of materials and the pivoted forecast are written once in buckets of (snapshot_date, mfg_ref).
Every later join of the two reads bucket by bucket, without a shuffle of either side.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from matflow.operators.frames import project_positional
from matflow.operators.lookups import lookup_join
from matflow.plans.bom import BOM_COLUMNS, bom_demand
from matflow.plans.forecast import complete_months, forecast_lag1
from matflow.plans.weekly import RUN, choose_snapshots, forecasts_in_reach

KEYS = ("snapshot_date", "mfg_ref")
LAYOUT = "_layout"
#: A bucket of more than so many times the rows of the average one is too hot to be joined in one task.
UNEVEN = 4


#: Rows of an average bucket at most; a table has as many times the least number of buckets as this takes, in powers of 2.
BUCKET_ROWS, MOST_TIMES = 500_000, 1024


def bucket_rows(df: DataFrame, keys: Sequence[str], buckets: int) -> list[int]:
    """How many rows have each remainder of the keys' hash by ``buckets`` * ``MOST_TIMES``: one number for each on the driver."""
    most = buckets * MOST_TIMES
    rows = [0] * most
    for row in df.groupBy(F.pmod(F.hash(*keys), F.lit(most)).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():
        rows[row["b"]] = row["n"]
    return rows


def fitting_buckets(rows: Sequence[int], least: int) -> int:
    """``least`` buckets, or twice, four times ... as many, so that an average one has at most ``BUCKET_ROWS`` rows."""
    buckets = least
    while sum(rows) > buckets * BUCKET_ROWS and buckets < least * MOST_TIMES:
        buckets *= 2
    return buckets


def write_bucketed(df: DataFrame, folder: str, keys: Sequence[str], buckets: int, rows: Sequence[int] | None = None) -> None:
    """``df`` in ``buckets`` files by the hash of ``keys``, each in their order; replaces what the folder had.

    Rows are counted by bucket first, unless ``rows`` tells them by a multiple of ``buckets`` (``bucket_rows``). Where
    one bucket is too hot, rows are written as they are dealt, without buckets.
    """
    spark = df.sparkSession
    rows = bucket_rows(df, keys, buckets) if rows is None else rows
    most = max(sum(rows[bucket::buckets]) for bucket in range(buckets))
    even = most <= UNEVEN * max(1, sum(rows) / buckets)
    if even:
        table = f"matflow_{uuid.uuid4().hex}"
        writer = df.repartition(buckets, *keys).write.format("parquet").mode("overwrite").option("path", folder)
        writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")
    else:
        df.write.mode("overwrite").parquet(folder)
    layout = {"schema": df.schema.json(), "keys": list(keys), "buckets": buckets if even else 0}
    spark.createDataFrame([(json.dumps(layout),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}{LAYOUT}")


def read_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The rows with their buckets, in any session; as plain files where one bucket was too hot.

    A shuffle join then takes the place of the join by bucket, and adaptive execution splits the hot key.
    """
    layout = json.loads(spark.read.text(f"{folder}{LAYOUT}").first()[0])
    schema, keys, buckets = StructType.fromJson(json.loads(layout["schema"])), layout["keys"], layout["buckets"]
    if not buckets:
        return spark.read.schema(schema).parquet(folder)
    table = f"matflow_{uuid.uuid4().hex}"
    names = ", ".join(f"`{key}`" for key in keys)
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    clustered = f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets} BUCKETS"
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {clustered} LOCATION '{folder}'")
    return spark.table(table)


def publish_demand_inputs(bom: DataFrame, forecast: DataFrame, runs: DataFrame, root: str, buckets: int) -> None:
    """The lines of every run with their lag-1 snapshot, and the forecast of every snapshot in use, in buckets.

    ``buckets`` is the least number of them; both tables have the same, which grows with the rows of the longer one.
    """
    reach = forecasts_in_reach(forecast, runs)
    chosen = choose_snapshots(runs, reach)
    complete = F.coalesce(F.col("months_found") >= complete_months(), F.lit(False))
    used = chosen.filter(complete).select("snapshot_date").distinct()
    lag1 = forecast_lag1(reach.join(used, "snapshot_date", "left_semi"), by=["snapshot_date"])
    lines = project_positional(bom.drop("as_of"), range(1, BOM_COLUMNS + 1)).columns
    dated = lookup_join(bom, chosen, RUN, null_safe=False).withColumn("known", complete)
    kept = dated.select("as_of", "snapshot_date", "known", *lines).withColumnRenamed("ref", "mfg_ref")
    tables = {"bom_lines": kept, "forecast_lag1": lag1}
    rows = {name: bucket_rows(df, KEYS, buckets) for name, df in tables.items()}
    wanted = max(fitting_buckets(counted, buckets) for counted in rows.values())
    for name, df in tables.items():
        write_bucketed(df, f"{root}/{name}", KEYS, wanted, rows[name])


def bucketed_bom_demand(spark: SparkSession, root: str) -> DataFrame:
    """As ``weekly_bom_demand``, from the tables of ``publish_demand_inputs``."""
    lines = read_bucketed(spark, f"{root}/bom_lines").withColumnRenamed("mfg_ref", "ref")
    lag1 = read_bucketed(spark, f"{root}/forecast_lag1")
    keys = ["as_of", "snapshot_date", "known"]
    return bom_demand(lines, lag1, by=["snapshot_date"], keys=keys, known=F.col("known")).drop("known")
