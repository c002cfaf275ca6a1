"""The weekly job for new weeks only: a stream of run dates that starts, publishes what is new, and ends."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import fields
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matflow.plans.weekly import WeeklyInputs, publish_weekly
from matflow.sources.manifests import publish_set
from matflow.sources.published import folder_files

Tables = Callable[[SparkSession, list[date]], Mapping[str, DataFrame]]


def _for_new_runs(
    spark: SparkSession, runs: str, publish_days: Callable[[SparkSession, list[date]], None], checkpoint: str
) -> StreamingQuery:
    def publish_batch(batch: DataFrame, _: int) -> None:
        days = sorted(row["as_of"] for row in batch.select("as_of").distinct().collect())
        if days:
            publish_days(batch.sparkSession, days)

    new = spark.readStream.schema("as_of date").parquet(runs)
    writer = new.writeStream.foreachBatch(publish_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def publish_new_runs(spark: SparkSession, runs: str, tables: Tables, root: str, checkpoint: str) -> StreamingQuery:
    """Publish ``tables`` of the run dates in those files of the folder ``runs`` that no earlier start has read.

    ``runs`` gets a Parquet file (as_of) when the inputs of its dates are complete. The checkpoint remembers the files
    that were read. All tables of a batch become visible together, and a batch that is repeated after a failure
    replaces the same dates, so every date counts once. The stream ends when no new file is left.
    """

    def publish_days(session: SparkSession, days: list[date]) -> None:
        publish_set(tables(session, days), root, run_dates=days)

    return _for_new_runs(spark, runs, publish_days, checkpoint)


def landed_inputs(spark: SparkSession, landing: str, days: Sequence[date]) -> WeeklyInputs:
    """The inputs of some run dates below ``landing``, where each has a folder, partitioned by ``as_of``.

    Only the folders of these dates are listed and read; campus and forecast (partitioned by ``snapshot_date``) serve
    all dates. An input that lacks all of them is empty, with the columns that it has elsewhere.
    """

    def read(name: str) -> DataFrame:
        whole = f"{landing}/{name}"
        folders = [f"{whole}/as_of={day.isoformat()}" for day in days]
        there = [folder for folder in folders if folder_files(spark, folder)[2]]
        if name in ("campus", "forecast"):
            df = spark.read.parquet(whole)
        elif there:
            df = spark.read.option("basePath", whole).parquet(*there)
        else:
            df = spark.read.parquet(whole).limit(0)
        return df.withColumns({c: F.col(c).cast("date") for c in ("as_of", "snapshot_date") if c in df.columns})

    runs = spark.createDataFrame([(day,) for day in days], "as_of date")
    return WeeklyInputs(runs=runs, **{f.name: read(f.name) for f in fields(WeeklyInputs) if f.name != "runs"})


def publish_new_weeks(spark: SparkSession, landing: str, root: str, checkpoint: str) -> StreamingQuery:
    """``publish_new_runs`` for all tables of the weekly job, from the inputs below ``landing``."""

    def publish_days(session: SparkSession, days: list[date]) -> None:
        publish_weekly(landed_inputs(session, landing, days), root, together=True)

    return _for_new_runs(spark, f"{landing}/runs", publish_days, checkpoint)
