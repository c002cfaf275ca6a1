"""Sums that don't depend on the order of rows, types of text columns, headers that are found, rejected records."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from matflow import functions as fn
from matflow import operators as op
from matflow import plans
from matflow import sources as src


def amounts(seed=1, count=4000):
    draw = random.Random(seed)
    scale = [1, 10, 1000, 10**6, 10**9]
    return [(n % 3, str(Decimal(draw.randrange(-(10**6), 10**6)) / draw.choice(scale) * draw.choice(scale[:4]))) for n in range(count)]


@pytest.mark.parametrize("digits", [0, 9])
def test_sums_have_equal_bits_however_rows_are_dealt(spark, digits):
    rows = [(site, f"{Decimal(text):.{digits}f}") for site, text in amounts()]
    df = spark.createDataFrame(rows, "site int, amount string")
    value = fn.tolerant_double("amount")
    want = {site: float(sum(Fraction(text) for s, text in rows if s == site)) for site in range(3)}
    months = spark.createDataFrame([(f"{n:02d}",) for n in range(1, 15)], "month string")
    for dealt in (df.repartition(1), df.repartition(7), df.repartition(64, F.rand(3)), df.orderBy(F.rand(5)).coalesce(2)):
        got = {r["site"]: r["total"] for r in op.group_sum_strict(dealt, ["site"], value, "total").collect()}
        assert got == want
        cases = dealt.select("site", F.lit("03").alias("month"), value.alias("qty"))
        cases = cases.unionByName(months.select(F.lit(9).alias("site"), "month", F.lit(1.0).alias("qty")))
        pivoted = op.pivot_months(cases, "site", "month", "qty").filter("site < 9").collect()
        assert {r["site"]: r["fcst_m01"] for r in pivoted} == want


def test_plain_sums_would_differ(spark):
    """The rows above do tell: added up as doubles in another order they give other bits."""
    values, totals = [float(text) for _, text in amounts()], set()
    for seed in range(20):
        random.Random(seed).shuffle(values)
        total = 0.0
        for value in values:  # sum() would compensate
            total += value
        totals.add(total)
    assert len(totals) > 1


@pytest.mark.parametrize(
    ("values", "total"),
    [
        ([0.1] * 10, 1.0),
        ([1e15, 0.1, -1e15], 0.1),
        ([2.0**52, 0.25, 0.25, 0.5], 2.0**52 + 1),
        ([-0.5, -0.25], -0.75),
        ([-1e-9, 1.0], 0.999999999),
        ([1e20, 0.1], 1e20),
        ([1.0, None], None),
        ([1.5, float("inf")], float("inf")),
        ([], None),
    ],
)
def test_exact_totals(spark, values, total):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert df.agg(fn.strict_sum("x")).first()[0] == total


# --- types ------------------------------------------------------------------------------------

VALUES = {
    "boolean": ["TRUE", "F", "true"],
    "integer": ["12", "-7", "+0", "999999999999999999"],
    "double": ["1.5", "1e5", ".5", "5.", "1234567890123456789"],
    "time": ["7:05", "23:59:59", "00:00:00.25"],
    "date": ["2024-01-31", "2024/2/5"],
    "timestamp": ["2024-01-31 07:05", "2024/2/5T23:59:59.5Z"],
    "string": ["007", "24:00", "2024-02-30", "2024-01-31 25:00", "12345F", "1:5", "abc", "2024-01-31 x"],
}


@pytest.mark.parametrize("kind", VALUES)
def test_every_type_is_found(spark, kind):
    for value in VALUES[kind]:
        df = spark.createDataFrame([(value,), (None,), (" ",), ("NA",)], "a string")
        assert [r["type"] for r in op.types_of(op.type_masks(df)).collect()] == [kind], value


@pytest.mark.parametrize(
    ("left", "right", "joined"),
    [
        ("integer", "double", "double"),
        ("date", "timestamp", "timestamp"),
        ("boolean", "integer", "string"),
        ("time", "date", "string"),
        ("date", "date", "date"),
        ("double", "string", "string"),
    ],
)
def test_types_join(spark, left, right, joined):
    weeks = [(1, v) for v in VALUES[left]] + [(2, v) for v in VALUES[right]]
    masks = op.type_masks(spark.createDataFrame(weeks, "week int, a string"), by=["week"])
    found = {r["week"]: r["type"] for r in op.types_of(masks).collect()}
    assert found == {1: left, 2: right}
    assert op.types_of(op.merge_masks(masks)).first()["type"] == joined


def test_casts(spark):
    rows = [("T", "12", "1.5", "7:05:30.5", "2024/2/5", "2024-01-31T07:05Z", "007"), ("NA",) + ("",) * 5 + (" x ",)]
    df = spark.createDataFrame(rows, "b string, i string, d string, t string, day string, at string, s string")
    found = {r["column"]: r["type"] for r in op.types_of(op.type_masks(df)).collect()}
    assert list(found.values()) == ["boolean", "integer", "double", "time", "date", "timestamp", "string"]
    got = [tuple(r) for r in op.cast_columns(df, found).collect()]
    moment = dt.datetime(2024, 1, 31, 7, 5)
    assert got == [(True, 12, 1.5, 7 * 3600 + 330.5, dt.date(2024, 2, 5), moment, "007"), (None,) * 6 + ("x",)]
    assert dict(op.cast_columns(df, found).dtypes) == {
        **{"b": "boolean", "i": "bigint", "d": "double", "t": "double"},
        **{"day": "date", "at": "timestamp_ntz", "s": "string"},
    }


def test_no_rows_and_no_text_columns(spark):
    empty = spark.createDataFrame([], "a string, b int")
    assert [tuple(r) for r in op.type_masks(empty).collect()] == [("a", 63)]
    assert op.inferred_types(empty).first()["type"] == "boolean"


# --- headers ----------------------------------------------------------------------------------

NAMES = ("location", "campus_no", "item", "description")


def grid(spark, *rows):
    return spark.createDataFrame(list(rows), "as_of int, row_no int, c1 string, c2 string, c3 string, c4 string")


def test_headers_are_found_by_their_names(spark):
    rows = [
        (1, 1, "Lots of the item", None, None, None),
        (1, 4, "Location", "Campus No", "Item ", "Description"),
        (1, 5, "location", "1", "item", "x"),
        (2, 2, "ITEM", "Campus-No", "Remarks", "location"),
        (2, 3, "7", "1", "a", "26"),
        (3, 1, "Location", "Item", None, None),
        (3, 2, "Item", "Location", None, None),
        (4, 1, "Item", None, None, None),
        (5, 30, "Location", "Campus No", "Item ", "Description"),
    ]
    got = {r["as_of"]: tuple(r)[1:] for r in src.detect_headers(grid(spark, *rows), NAMES).collect()}
    assert got == {1: (4, 4, 0), 2: (2, 3, 0), 3: (1, 2, 1), 4: (None, 1, 0)}
    assert src.detect_headers(grid(spark, *rows), NAMES, within=30).filter("as_of = 5").first()["header_row"] == 30


def test_a_sheet_without_a_header_is_an_error(spark):
    rows = [(1, 2, "Location", "Campus No", "Item", "x"), (1, 3, "26", "1", "7", "y"), (4, 1, "Item", None, None, None)]
    found = src.promote_header_per_run(grid(spark, *rows[:2]), names=NAMES).select("as_of", *NAMES[:3]).collect()
    assert [tuple(r) for r in found] == [(1, "26", "1", "7")]
    with pytest.raises(ValueError, match=r"don't have one header: \[4\]"):
        src.promote_header_per_run(grid(spark, *rows), names=NAMES)


# --- rejected records -------------------------------------------------------------------------


def test_every_record_is_accepted_or_rejected_with_a_reason(spark, tmp_path):
    lines = ["a~b~c", "a~b", "a~b~c~d", "", None, "~~", "a~b~c"]
    df = spark.createDataFrame([(line, n) for n, line in enumerate(lines)], "line string, as_of int")
    counts = src.publish_checked(df, str(tmp_path), 3)
    assert counts == {"read": 7, "accepted": 3, "missing": 1, "short": 2, "long": 1}
    accepted, rejected = (src.read_checked(spark, str(tmp_path), status) for status in (src.ACCEPTED, src.REJECTED))
    assert sorted(r["as_of"] for r in accepted.collect()) == [0, 5, 6] and accepted.columns == ["line", "as_of"]
    assert sorted((r["as_of"], r["n_fields"], r["reason"]) for r in rejected.collect()) == [
        (1, 2, "short"),
        (2, 4, "long"),
        (3, 1, "short"),
        (4, 0, "missing"),
    ]


def test_records_are_read_once(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(0, 5000, 1, 4).select(F.concat_ws("~", "id", F.lit("x")).alias("line")).write.parquet(source)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    lines = spark.read.parquet(source).mapInArrow(counted, "line string")
    assert src.publish_checked(lines, str(tmp_path / "out"), 2)["accepted"] == 5000
    assert reads.value == 5000


def test_rejected_orders_are_those_with_missing_fields(spark):
    lines = spark.createDataFrame([("GLB-RP-1~00026~x~y~5~P1~2024-01-02~z",), ("short~1",)], "line string")
    parsed = plans.orders.parse_records(src.checked_records(lines, 8).filter("reason IS NULL"), "po_no")
    assert [r["item"] for r in parsed.collect()] == ["1"]


def test_types_of_many_columns_are_one_aggregate(spark):
    """One expression for all columns: one for each made the compiled method too long for the JIT."""
    df = spark.createDataFrame([("1", "a.b", "2024-02-30", "2024/02/28")], "`x.1` string, b string, c string, d string")
    masks = op.type_masks(df)
    assert masks._jdf.queryExecution().optimizedPlan().toString().count("bit_and(") == 1
    found = {row["column"]: row["type"] for row in op.types_of(masks).collect()}
    assert found == {"x.1": "integer", "b": "string", "c": "string", "d": "date"}


def test_the_first_look_that_fits_decides_as_every_test_would(spark):
    from matflow.operators import inference as inf

    texts = ["12", "-0", "007", "1e-5", ".5", "12\n", "T", "true", "1:02", "24:00", "12:30:59.5", "12:30\n", "2024-1-5", "\t2024-01-05", "2024-13-01"]
    texts += ["2024/01/05 7:00", "2024-01-05T07:00:00Z", "2024-02-30 1:00", "2024-01-05 25:00", "1-2", "a/b", ":", "", " NA ", None, "2024-01-05x"]
    text, value = F.col("t"), F.trim("t")
    tests = {
        "boolean": value.isin(*inf._LOGICAL),
        "integer": value.rlike(inf._INTEGER),
        "double": value.rlike(inf._NUMBER),
        "time": inf.tolerant_time(value).isNotNull(),
        "date": value.rlike(inf.DATE_PATTERN + "$") & inf.tolerant_date(value).isNotNull(),
        "timestamp": inf.tolerant_timestamp(value).isNotNull(),
    }
    bits = sum((F.when(test, 1 << inf.TYPES.index(name)).otherwise(0) for name, test in tests.items()), F.lit(0))
    want = F.when(text.isNull() | value.isin("", "NA"), inf.ALL).otherwise(bits)
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", inf.type_bits(text).alias("got"), want.alias("want"))
    assert [(r["t"], r["got"]) for r in rows.collect()] == [(r["t"], r["want"]) for r in rows.collect()]
