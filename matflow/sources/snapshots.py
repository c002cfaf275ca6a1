"""Which forecast snapshot a run uses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_snapshot(runs: DataFrame, snapshots: DataFrame) -> DataFrame:
    """(as_of, snapshot_date): the first snapshot of the month before the run month, or NULL.

    Snapshots are reduced to one per month before the join, so no run matches more than one row.
    """
    month = F.trunc("snapshot_date", "MM")
    firsts = snapshots.groupBy(month.alias("month")).agg(F.min("snapshot_date").alias("snapshot_date"))
    wanted = runs.select("as_of").distinct().withColumn("month", F.add_months(F.trunc("as_of", "MM"), -1))
    return wanted.join(firsts, "month", "left").select("as_of", "snapshot_date")
