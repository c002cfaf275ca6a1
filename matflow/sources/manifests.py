"""Several published tables as one unit: new rows go to folders of their own, and a manifest that is swapped last says
which folders count.

``root/<table>/version=<id>/as_of=<date>`` holds rows; ``root/_manifests/<number>.json`` says for each table which
version every run date has. Readers follow the newest manifest, so they see all tables of a publication or none.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from matflow.sources.published import folder_files, publish

FOLDER = "_manifests"
#: Publications that finish at the same time and have to give way to each other before one gives up.
MOST_TRIES = 20
#: The local file system renames in two steps, rows and checksum: threads of one driver take turns. HDFS needs no lock.
_TURN = threading.Lock()


@dataclass(frozen=True)
class Manifest:
    """``tables``: of each table its schema (as JSON) and the version of every run date (in ISO form)."""

    number: int
    tables: dict[str, dict]

    def dates(self, table: str) -> dict[date, str]:
        return {date.fromisoformat(day): version for day, version in self.tables[table]["dates"].items()}


def read_manifest(spark: SparkSession, root: str, number: int | None = None) -> Manifest:
    """The newest manifest, or the one of a number; number 0 is the empty one before the first publication."""
    system, path, names = folder_files(spark, f"{root}/{FOLDER}")
    numbers = sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))
    wanted = number if number is not None else numbers[-1] if numbers else 0
    if not wanted:
        return Manifest(0, {})
    stream = system.open(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, f"{wanted:08d}.json"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(wanted, json.loads(text))


def _written(spark: SparkSession, root: str, manifest: Manifest) -> bool:
    """Whether this manifest could take its number: a file is written aside and renamed, and never replaces another."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs
    system, folder, _ = folder_files(spark, f"{root}/{FOLDER}")
    aside = hadoop.Path(folder, f".{uuid.uuid4().hex}")
    stream = system.create(aside)
    stream.write(bytearray(json.dumps(manifest.tables, indent=1).encode()))
    stream.close()
    context = hadoop.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    never_replace = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(system.makeQualified(aside), system.makeQualified(hadoop.Path(folder, f"{manifest.number:08d}.json")), never_replace)
    except Py4JJavaError as error:
        system.delete(aside, False)
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    return True


def publish_set(
    tables: Mapping[str, DataFrame], root: str, as_of: Column | None = None, run_dates: Iterable[date] = ()
) -> int:
    """Replace the run dates that occur in the tables, and those listed, in all tables at once; the manifest's number.

    If a table fails, what was written is deleted and readers keep what they had. A listed date that a table has no
    rows for is empty in it. Publications of other dates or tables at the same time don't disturb each other.
    """
    spark = next(iter(tables.values())).sparkSession
    version, days = uuid.uuid4().hex, [day.isoformat() for day in run_dates]
    found: dict[str, list[str]] = {}
    try:
        for name, df in tables.items():
            publish(df, f"{root}/{name}", f"version={version}", as_of)
            _, _, folders = folder_files(spark, f"{root}/{name}/version={version}")
            found[name] = [folder.removeprefix("as_of=") for folder in folders if folder.startswith("as_of=")]
    except Exception:
        for name in tables:
            system, path, _ = folder_files(spark, f"{root}/{name}/version={version}")
            system.delete(path, True)
        raise
    for _ in range(MOST_TRIES):
        with _TURN:
            before = read_manifest(spark, root)
            after = dict(before.tables)
            for name, df in tables.items():
                kept = {day: v for day, v in before.tables.get(name, {"dates": {}})["dates"].items() if day not in days}
                fields = [field for field in df.schema.fields if field.name != "as_of"]
                after[name] = {"schema": StructType(fields).json(), "dates": {**kept, **dict.fromkeys(found[name], version)}}
            if _written(spark, root, Manifest(before.number + 1, after)):
                return before.number + 1
    raise RuntimeError(f"{MOST_TRIES} other publications came first")


def read_set(
    spark: SparkSession, root: str, table: str, run_dates: Iterable[date] | None = None, number: int | None = None
) -> DataFrame:
    """A table as the newest manifest has it, or that of a number; ``run_dates`` chooses some of its dates."""
    manifest = read_manifest(spark, root, number)
    if table not in manifest.tables:
        raise ValueError(f"{root} has no table {table}")
    wanted = None if run_dates is None else set(run_dates)
    chosen = {day: v for day, v in manifest.dates(table).items() if wanted is None or day in wanted}
    schema = StructType.fromJson(json.loads(manifest.tables[table]["schema"])).add("as_of", "date")
    if not chosen:
        return spark.createDataFrame([], schema)
    folders = [f"{root}/{table}/version={version}/as_of={day.isoformat()}" for day, version in sorted(chosen.items())]
    return spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(*folders).select(*schema.names)


def read_tables_of_set(spark: SparkSession, root: str, *tables: str, number: int | None = None) -> DataFrame:
    """Tables of one manifest stacked by name, with a ``table`` column."""
    number = read_manifest(spark, root).number if number is None else number
    parts = [read_set(spark, root, name, number=number).select(F.lit(name).alias("table"), "*") for name in tables]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def drop_unused(spark: SparkSession, root: str, keep: int = 2, older_than: float = 86_400) -> int:
    """Delete the folders that none of the newest ``keep`` manifests names, and older manifests; how many folders went.

    Only those of more than ``older_than`` seconds: a younger one may belong to a publication that is not ended.
    """
    newest = read_manifest(spark, root)
    numbers = range(max(1, newest.number - keep + 1), newest.number + 1)
    manifests = [read_manifest(spark, root, number) for number in numbers]
    gone, now = 0, time.time()
    for table in newest.tables:
        used = {version for m in manifests for version in m.tables.get(table, {"dates": {}})["dates"].values()}
        system, path, names = folder_files(spark, f"{root}/{table}")
        for name in names:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, name)
            old = now - system.getFileStatus(folder).getModificationTime() / 1000 >= older_than
            if name.startswith("version=") and name.removeprefix("version=") not in used and old:
                system.delete(folder, True)
                gone += 1
    system, path, names = folder_files(spark, f"{root}/{FOLDER}")
    for name in names:
        if name.endswith(".json") and int(name.removesuffix(".json")) < numbers.start:
            system.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, name), False)
    return gone
