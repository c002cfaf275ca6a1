"""Tables that are published together, and weeks that are published once."""

from __future__ import annotations

import datetime as dt
import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from matflow import plans
from matflow import sources as src
from testbed.queries import weekly_inputs
from tests.test_properties import bag

SF_DIR = "/root/testdata/sf0.001"
DAY1, DAY2 = dt.date(2024, 1, 2), dt.date(2024, 1, 9)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "ref string, as_of date")


def refs(spark, root, name, **options):
    return sorted(tuple(r) for r in src.read_set(spark, root, name, **options).collect())


@pytest.mark.parametrize("failing", [0, 1, 2])
def test_a_failure_leaves_last_week_whole(spark, tmp_path, failing):
    root, names = str(tmp_path), ["po", "receipt", "bom"]
    src.publish_set({name: table(spark, ("old", DAY1)) for name in names}, root)
    new = {name: table(spark, ("new", DAY1), ("more", DAY2)) for name in names}
    broken = F.when(F.col("as_of") == F.lit(DAY2), F.raise_error(F.lit("disk full"))).otherwise(F.col("ref"))
    new[names[failing]] = new[names[failing]].withColumn("ref", broken)
    with pytest.raises(Exception, match="disk full"):
        src.publish_set(new, root)
    for name in names:
        assert refs(spark, root, name) == [("old", DAY1)]
        assert len(list((tmp_path / name).glob("version=*"))) == 1
    assert src.read_manifest(spark, root).number == 1


def test_dates_are_replaced_and_cleared(spark, tmp_path):
    root = str(tmp_path)
    assert src.publish_set({"po": table(spark, ("a", DAY1), ("b", DAY2))}, root) == 1
    assert src.publish_set({"po": table(spark, ("c", DAY1))}, root, run_dates=[DAY1, DAY2]) == 2
    assert refs(spark, root, "po") == [("c", DAY1)]
    assert refs(spark, root, "po", number=1) == [("a", DAY1), ("b", DAY2)]
    assert refs(spark, root, "po", run_dates=[DAY2]) == []
    src.publish_set({"po": table(spark)}, root, run_dates=[DAY1])
    assert refs(spark, root, "po") == [] and src.read_set(spark, root, "po").columns == ["ref", "as_of"]
    with pytest.raises(ValueError, match="no table receipt"):
        src.read_set(spark, root, "receipt")
    with pytest.raises(Exception, match="no run date"):
        src.publish_set({"po": table(spark, ("x", None))}, root)


def test_new_columns_are_missing_in_older_dates(spark, tmp_path):
    root = str(tmp_path)
    src.publish_set({"po": table(spark, ("a", DAY1))}, root)
    src.publish_set({"po": table(spark, ("b", DAY2)).withColumn("qty", F.lit(1.5))}, root)
    rows = src.read_set(spark, root, "po").select("ref", "qty").collect()
    assert sorted(tuple(r) for r in rows) == [("a", None), ("b", 1.5)]


def test_publications_at_the_same_time_all_count(spark, tmp_path):
    root, days = str(tmp_path), [dt.date(2024, 1, n) for n in range(1, 7)]
    threads = [threading.Thread(target=src.publish_set, args=({"po": table(spark, ("x", day))}, root)) for day in days]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert refs(spark, root, "po") == [("x", day) for day in days]
    assert src.read_manifest(spark, root).number == len(days)


def test_unused_folders_go(spark, tmp_path):
    root = str(tmp_path)
    for n in range(4):
        src.publish_set({"po": table(spark, (str(n), DAY1))}, root)
    src.publish_set({"po": table(spark, ("later", DAY2))}, root)
    assert src.drop_unused(spark, root) == 0  # all are too young
    assert src.drop_unused(spark, root, keep=1, older_than=0) == 3
    assert refs(spark, root, "po") == [("3", DAY1), ("later", DAY2)]
    assert len(list((tmp_path / "po").glob("version=*"))) == 2


def test_a_filter_on_the_date_prunes_files(spark, tmp_path):
    root = str(tmp_path)
    src.publish_set({"po": table(spark, ("a", DAY1), ("b", DAY2))}, root)
    one = src.read_set(spark, root, "po").filter(F.col("as_of") == F.lit(DAY2))
    assert "PartitionFilters: [isnotnull(as_of" in one._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in one.collect()] == [("b", DAY2)]


def land(inputs, landing, weeks):
    """The inputs of some weeks, then the file that says they are there."""
    some = inputs.only(*weeks)
    for name in ("po", "receipt", "bom", "exception_report", "lots", "erp_lots"):
        df = getattr(some, name)
        df.coalesce(1).write.mode("append").partitionBy("as_of").parquet(f"{landing}/{name}")
    some.runs.coalesce(1).write.mode("append").parquet(f"{landing}/runs")


def test_a_second_start_reads_the_new_week_only(spark, tmp_path):
    inputs = weekly_inputs(spark, SF_DIR)
    weeks = [r["as_of"] for r in inputs.runs.orderBy("as_of").collect()][-5:]
    landing, root, checkpoint = (str(tmp_path / name) for name in ("landing", "published", "checkpoint"))
    inputs.campus.write.parquet(f"{landing}/campus")
    inputs.forecast.write.partitionBy("snapshot_date").parquet(f"{landing}/forecast")
    land(inputs, landing, weeks[:4])
    first = plans.publish_new_weeks(spark, landing, root, checkpoint)
    first.awaitTermination()
    # Whatever would read the weeks from before fails.
    for name in ("po", "receipt", "bom", "exception_report", "lots", "erp_lots", "runs"):
        for file in (tmp_path / "landing" / name).glob("**/*.parquet"):
            file.write_bytes(b"not a table")
            file.with_name(f".{file.name}.crc").unlink()
    land(inputs, landing, weeks[4:])
    second = plans.publish_new_weeks(spark, landing, root, checkpoint)
    second.awaitTermination()
    assert sum(p["numInputRows"] for p in second.recentProgress) == 1
    third = plans.publish_new_weeks(spark, landing, root, checkpoint)
    third.awaitTermination()
    assert sum(p["numInputRows"] for p in third.recentProgress) == 0
    assert src.read_manifest(spark, root).number == 2
    full = plans.weekly_tables(inputs.only(*weeks))
    for name, df in full.items():
        assert bag(src.read_set(spark, root, name).select(df.columns)) == bag(df), name


def test_a_published_week_reads_its_forecast_once(spark, tmp_path):
    inputs = weekly_inputs(spark, SF_DIR)
    some = inputs.only(*[r["as_of"] for r in inputs.runs.orderBy("as_of").collect()][-12:])
    reads = spark.sparkContext.accumulator(0)
    stored = str(tmp_path / "forecast")
    inputs.forecast.write.parquet(stored)
    forecast = spark.read.parquet(stored)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    once = replace(some, forecast=forecast.mapInArrow(counted, forecast.schema))
    plans.publish_weekly(once, str(tmp_path / "published"), together=True)
    assert reads.value == forecast.count()
    assert not list((tmp_path / "published").glob("_months*"))
    for name, df in plans.weekly_tables(some).items():
        assert bag(src.read_set(spark, str(tmp_path / "published"), name).select(df.columns)) == bag(df), name
