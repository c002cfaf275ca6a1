"""Record files: one ``~``-separated record per line, one file or folder per run date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# A run date in a path is the last mm.dd.yyyy or mm.dd.yy (also without leading zeros) of a folder or file name, or
# else a folder mm.dd below a folder yyyy.
_FULL_DATE = r"^.*(?<![\d.])(\d{1,2}\.\d{1,2}\.\d{4})(?!\d)"
_SHORT_DATE = r"^.*(?<![\d.])(\d{1,2}\.\d{1,2}\.\d{2})(?!\d)"
_YEAR_AND_DAY_FOLDERS = r"/(\d{4}/\d{1,2}\.\d{1,2})/"


def as_of_from_path(path: Column | None = None) -> Column:
    """Run date of the file a row was read from; NULL if the path names none."""
    path = F.col("_metadata.file_path") if path is None else path
    return F.coalesce(
        F.try_to_date(F.regexp_extract(path, _FULL_DATE, 1), "M.d.yyyy"),
        F.try_to_date(F.regexp_extract(path, _SHORT_DATE, 1), "M.d.yy"),
        F.try_to_date(F.regexp_extract(path, _YEAR_AND_DAY_FOLDERS, 1), "yyyy/M.d"),
    )


def _run_date(as_of: Column | None) -> Column:
    return (as_of_from_path() if as_of is None else as_of).alias("as_of")


def read_record_lines(spark: SparkSession, *paths: str, as_of: Column | None = None) -> DataFrame:
    """(line, as_of) of headerless files whose first field is the record; blank lines are skipped.

    A field may be quoted, with quotes in it doubled. ``as_of`` is for paths that name no run date.
    """
    lines = spark.read.csv(list(paths), schema="line string", escape='"').filter(F.trim("line") != "")
    return lines.select("line", _run_date(as_of))


def read_numbered_lines(spark: SparkSession, *paths: str, as_of: Column | None = None) -> DataFrame:
    """(line, as_of) of the newer export: a row-number column, the record, and a header row to drop."""
    numbered = spark.read.csv(list(paths), header=True, schema="row_no string, line string", escape='"')
    return numbered.select("line", _run_date(as_of))


# --- records that don't have the declared fields ------------------------------------------------

ACCEPTED, REJECTED = "accepted", "rejected"


def checked_records(lines: DataFrame, fields: int, sep: str = "~") -> DataFrame:
    """``lines`` with ``n_fields`` and ``reason``: 'missing', 'short' or 'long', or NULL for a record of ``fields`` fields.

    Reading goes on regardless: a short record has NULLs, a long one loses what it has too much.
    """
    count = F.coalesce(F.length("line") - F.length(F.replace("line", F.lit(sep))) + 1, F.lit(0))
    reason = F.when(F.col("line").isNull(), "missing").when(count < fields, "short").when(count > fields, "long")
    return lines.withColumns({"n_fields": count, "reason": reason})


def publish_checked(lines: DataFrame, folder: str, fields: int, sep: str = "~") -> dict[str, int]:
    """Write all records to ``folder``, rejected ones apart, and count them: read, accepted, and each reason.

    One pass writes both tables and counts. ``read_checked`` reads either without touching the other's files.
    """
    checked = checked_records(lines, fields, sep)
    reasons = ("missing", "short", "long")
    seen = Observation()
    counted = checked.observe(
        seen,
        F.count(F.lit(1)).alias("read"),
        F.count_if(F.col("reason").isNull()).alias("accepted"),
        *(F.count_if(F.col("reason") == reason).alias(reason) for reason in reasons),
    )
    status = F.when(F.col("reason").isNull(), ACCEPTED).otherwise(REJECTED)
    counted.withColumn("status", status).write.partitionBy("status").mode("overwrite").parquet(folder)
    return {name: seen.get[name] for name in ("read", "accepted", *reasons)}


def read_checked(spark: SparkSession, folder: str, status: str = ACCEPTED) -> DataFrame:
    """The accepted records, or with ``REJECTED`` the others with ``n_fields`` and ``reason``."""
    rows = spark.read.parquet(folder).filter(F.col("status") == status).drop("status")
    return rows.drop("n_fields", "reason") if status == ACCEPTED else rows
