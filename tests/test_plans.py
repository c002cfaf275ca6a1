"""Shape of the physical plans: what is read, shuffled and broadcast."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from matflow import operators as op
from matflow import plans
from matflow import sources as src
from testbed import adapters as fx
from testbed.queries import PUBLISHED, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture
def conf(spark):
    """Sets session options for one test."""
    before = {}

    def set_options(**options):
        for name, value in options.items():
            key = "spark.sql." + name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield set_options
    for key, value in before.items():
        spark.conf.set(key, value)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df)


def count(text: str, operator: str) -> int:
    return len(re.findall(rf"\b{operator}\b", text))


WRITERS = {"src_delimited_lines", "src_numbered_lines", "snapshot_sink", "multi_table_publish"}
WRITERS |= {"workbook_source", "workbook_sink", "published_set", "weekly_incremental"}
WRITERS |= {"record_rejects", "record_counts", "bucketed_bom_demand"}
WRITERS |= {f"weekly_{name}" for name in PUBLISHED}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_python_and_no_pair_joins(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "Python" not in text and "Pandas" not in text
    assert "Cartesian" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["open_po", "receipts", "exception_enriched"])
def test_one_broadcast_and_no_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert count(text, "BroadcastHashJoin") == 1
    assert "Exchange hashpartitioning" not in text


def test_lookups_beyond_their_bound_are_shuffled(spark, conf):
    conf(autoBroadcastJoinThreshold="100")
    assert count(plan(QUERIES["open_po"](spark, SF_DIR)), "SortMergeJoin") == 1
    lots = spark.range(10).select(F.col("id").cast("double").alias("item"))
    labels = op.label_items(fx.fx_exception(spark, SF_DIR))
    assert not op.fits_broadcast(labels, max_bytes=1000)
    wide = op.lookup_join(lots, op.broadcast_if_small(labels, max_bytes=1000), ["item"], "left_semi")
    assert count(plan(wide), "SortMergeJoin") == 1
    conf(autoBroadcastJoinThreshold="-1")
    assert not op.fits_broadcast(labels)
    assert count(plan(op.semi_join_labels(lots, labels)), "SortMergeJoin") == 1


def test_forecast_needs_one_shuffle_of_its_rows(spark):
    text = plan(QUERIES["forecast_lag1"](spark, SF_DIR))
    assert count(text, "Exchange hashpartitioning") == 2  # distinct months, and the key
    assert "Exchange SinglePartition" not in text


def stored_lots(spark, tmp_path):
    folder = str(tmp_path / "lots")
    lots = fx.fx_lot(spark, SF_DIR).withColumn("unused", F.lit("x"))
    lots.withColumn("as_of", F.trunc("as_of", "year")).write.partitionBy("as_of", "sheet").parquet(folder)
    return spark.read.parquet(folder)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    lots = stored_lots(spark, tmp_path)
    one_run = lots.filter(F.col("as_of") == F.lit("2000-01-01").cast("date"))
    rm = plan(plans.rm_inventory_lot(src.named_sheet(one_run, "RM")))
    assert re.search(r"PartitionFilters: \[.*sheet.* = RM.*as_of|PartitionFilters: \[.*as_of.*sheet.* = RM", rm)
    data_filters = re.search(r"DataFilters: \[(.*?)Format", rm).group(1)
    assert "RLIKE" in data_filters or "StartsWith" in data_filters
    columns = re.findall(r"(\w+)#", re.search(r"FileScan parquet \[(.*?)\]", rm).group(1))
    assert set(columns) == {
        *("location", "campus_no", "item", "description", "current_inventory_balance"),
        *("as_of", "sheet"),
    }
    assert rm.index("HashAggregate") < rm.index("RLIKE(", rm.index("HashAggregate")) < rm.index("FileScan")


def test_sums_are_partial_before_the_shuffle(spark):
    for name in ("rm_inventory_lot", "fg_inventory_lot", "forecast_lag1", "fg_inventory_mfg"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "partial_sum" in text, name
        assert "SortAggregate" not in text and "ObjectHashAggregate" not in text, name


def test_stock_is_summed_before_the_manufacturer_join(spark):
    text = plan(QUERIES["fg_inventory_mfg"](spark, SF_DIR))
    assert text.index("LeftOuter") < text.index("HashAggregate")


def test_hot_key_is_split(spark, conf, tmp_path):
    """A third of all rows share one key, and the lookup is too large to broadcast."""
    conf(
        autoBroadcastJoinThreshold="-1",
        shuffle__partitions="64",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        adaptive__advisoryPartitionSizeInBytes="32KB",
    )
    rows = spark.range(0, 300_000, 1, 16)
    key = F.when(F.col("id") % 3 == 0, "1-1ABC").otherwise(F.concat(F.lit("2-"), "id"))
    bom = rows.select(
        key.alias("ref"),
        F.col("id").alias("component"),
        F.lit("2").alias("quantity_w_scrap"),
        F.lit("3").alias("next_28_days_open_order"),
    )
    months = [f"fcst_m{n:02d}" for n in range(1, 13)]
    forecast = rows.filter("id % 3 > 0 or id = 0").select(
        F.when(F.col("id") == 0, "1-1ABC").otherwise(F.concat(F.lit("2-"), "id")).alias("mfg_ref"),
        *(F.lit(float(n)).alias(name) for n, name in enumerate(months, start=1)),
    )
    demand = plans.bom_demand(bom, forecast, width=4)
    demand.write.parquet(str(tmp_path / "demand"))
    result = spark.read.parquet(str(tmp_path / "demand"))
    assert result.count() == 300_000
    assert result.filter("dep_m01 <> 6 or dep_m12 <> 24").count() == 0
    assert "skew=true" in final_plan(demand)


def test_a_date_gets_few_files(spark, tmp_path):
    rows = spark.range(0, 20_000, 1, 32)
    mixed = rows.withColumn("as_of", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int")))
    src.publish(mixed, str(tmp_path), "t")
    files = [len(list(folder.glob("*.parquet"))) for folder in (tmp_path / "t").glob("as_of=*")]
    assert len(files) == 20 and max(files) <= 2


def test_all_months_take_one_shuffle_of_their_rows(spark):
    text = plan(QUERIES["forecast_wide_all"](spark, SF_DIR))
    assert count(text, "Exchange hashpartitioning") == 1


def test_building_a_flow_starts_no_job(spark):
    lots, report = fx.fx_jde_lot(spark, SF_DIR), fx.fx_exception(spark, SF_DIR)
    spark.sparkContext.setJobGroup("build", "build")
    plans.label_inventory(lots, report)
    plans.forecast_lag1(fx.fx_dsx(spark, SF_DIR))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_run_reads_one_snapshot(spark, tmp_path):
    folder = str(tmp_path / "forecast")
    by_month = fx.fx_dsx_snapshots(spark, SF_DIR).hint("rebalance", F.col("snapshot_date"))
    by_month.write.partitionBy("snapshot_date").parquet(folder)
    run = spark.sql("select date '2000-03-06' as as_of")
    bom = fx.fx_bom(spark, SF_DIR).withColumn("as_of", F.lit("2000-03-06").cast("date"))
    demand = plans.weekly.weekly_bom_demand(bom, spark.read.parquet(folder), run)
    text = final_plan(demand)
    scans = re.findall(r"FileScan parquet \[[^\]]*snapshot_date.*", text)
    assert scans and all(re.search(r"PartitionFilters: \[.*>= 2000-02-01.*< 2000-03-01", scan) for scan in scans)
    assert demand.filter("fcst_m01 > 0").count() > 0


def test_demand_of_a_small_forecast_moves_no_line(spark, conf):
    """The wide lines meet a forecast that measures small where they lie, whatever the planner's bound is."""
    conf(autoBroadcastJoinThreshold="1k")
    run = spark.sql("select date '2000-03-06' as as_of")
    bom = fx.fx_bom(spark, SF_DIR).withColumn("as_of", F.lit("2000-03-06").cast("date"))
    demand = plans.weekly.weekly_bom_demand(bom, fx.fx_dsx_snapshots(spark, SF_DIR), run)
    text = final_plan(demand)
    assert not re.search(r"SortMergeJoin \[[^\]]*mfg_ref", text) and re.search(r"BroadcastHashJoin \[[^\]]*mfg_ref", text)
    assert demand.count() == bom.count()


def test_demand_by_bucket_moves_no_row(spark, conf, tmp_path):
    conf(autoBroadcastJoinThreshold="-1")
    inputs = (fx.fx_bom_week(spark, SF_DIR), fx.fx_dsx_snapshots(spark, SF_DIR), fx.fx_ship_weeks(spark, SF_DIR))
    plans.bucketed.publish_demand_inputs(*inputs, str(tmp_path), 8)
    text = final_plan(plans.bucketed.bucketed_bom_demand(spark, str(tmp_path)))
    assert count(text, "SortMergeJoin") >= 1 and "Exchange" not in text
    assert len(list((tmp_path / "bom_lines").glob("*.parquet"))) <= 8


def test_one_run_date_is_published_without_a_shuffle(spark, tmp_path, monkeypatch):
    hints = []
    hint = type(spark.range(0)).hint
    monkeypatch.setattr(type(spark.range(0)), "hint", lambda df, name, *more: hints.append(name) or hint(df, name, *more))
    rows = spark.range(0, 100, numPartitions=3).withColumn("day", F.expr("date_add(date '2024-01-02', int(id % 2))"))
    src.publish_set({"t": rows}, str(tmp_path / "one"), F.lit("2024-01-09").cast("date"))
    assert hints == [] and len(list((tmp_path / "one").glob("t/*/as_of=2024-01-09/*.parquet"))) == 3
    assert src.read_set(spark, str(tmp_path / "one"), "t").count() == 100
    src.publish(rows, str(tmp_path / "two"), "t", F.col("day"))
    assert hints == ["rebalance"] and len(list((tmp_path / "two").glob("t/*/*.parquet"))) == 2


def test_more_rows_have_more_buckets(spark, conf, tmp_path, monkeypatch):
    """A task joins one bucket, so its rows must not grow with the table; the join still moves none."""
    conf(autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr(plans.bucketed, "BUCKET_ROWS", 2_000)
    inputs = (fx.fx_bom_week(spark, SF_DIR), fx.fx_dsx_snapshots(spark, SF_DIR), fx.fx_ship_weeks(spark, SF_DIR))
    plans.bucketed.publish_demand_inputs(*inputs, str(tmp_path), 8)
    demand = plans.bucketed.bucketed_bom_demand(spark, str(tmp_path))
    tasks = [row["count"] for row in demand.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) > 8 and max(tasks) <= 4 * 2_000
    assert "Exchange" not in final_plan(demand)
    assert sum(tasks) == inputs[0].count()


def test_a_hot_bucket_is_joined_by_shuffle(spark, conf, tmp_path):
    conf(autoBroadcastJoinThreshold="-1")
    day = F.lit("2024-01-01").cast("date")
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    rows = spark.range(0, 3000).select(day.alias("snapshot_date"), key.alias("mfg_ref"), "id")
    for name, df in (("hot", rows), ("even", rows.filter("mfg_ref <> 'hot'"))):
        plans.bucketed.write_bucketed(df, f"{tmp_path}/{name}", ["snapshot_date", "mfg_ref"], 16)
    other = plans.bucketed.read_bucketed(spark, f"{tmp_path}/even")
    for name, moves in (("hot", True), ("even", False)):
        joined = plans.bucketed.read_bucketed(spark, f"{tmp_path}/{name}").join(other.drop("id"), ["snapshot_date", "mfg_ref"])
        assert joined.count() == 2000
        assert ("Exchange hashpartitioning" in plan(joined)) == moves
