"""One test per rule for missing values, item codes, dates and keys, on literal rows."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from matflow import functions as fn
from matflow import operators as op
from matflow import plans


def values(df, column):
    return [row[column] for row in df.collect()]


def apply(spark, texts, expression, kind="string"):
    df = spark.createDataFrame([(t,) for t in texts], f"v {kind}")
    return values(df.select(expression.alias("out")), "out")


def forecast_rows(spark, rows):
    return spark.createDataFrame(
        rows,
        "product_manufacturing_location_code string, product_label_sku_code string, "
        "forecast_month_year_id string, adjusted_forecast_cases string",
    )


FOURTEEN = [f"2024{m:02d}" for m in range(1, 13)] + ["202501", "202502"]


def test_missing_key_part_is_spelled_out(spark):
    # concat would give NULL, concat_ws would give '123'
    df = spark.createDataFrame([(None, "123"), ("7", None)], "campus string, item string")
    assert values(df.select(fn.composite_key("campus", "item").alias("k")), "k") == ["NA-123", "7-NA"]


def test_strict_sum_is_null_if_any_value_is(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", None), ("b", 2.0), ("b", 3.0), ("c", None)], "k string, x double")
    sums = {row.k: row.s for row in df.groupBy("k").agg(fn.strict_sum("x").alias("s")).collect()}
    assert sums == {"a": None, "b": 5.0, "c": None}


def test_bad_forecast_row_zeroes_its_month_only(spark):
    rows = [("1", "X-ABC", m, "10") for m in FOURTEEN] + [("1", "X-ABC", "202404", None)]
    rows += [("1", "X-ABC", "202405", "oops"), ("1", "X-ABC", "202406", "5")]
    got = plans.forecast_lag1(forecast_rows(spark, rows)).first().asDict()
    assert got["mfg_ref"] == "1-XABC"
    assert [got[n] for n in op.month_names("fcst")] == [10.0, 0.0, 0.0, 15.0] + [10.0] * 8
    bad = plans.poisoned_groups(forecast_rows(spark, rows)).collect()
    assert sorted((r.forecast_month_year_id, r.rows, r.bad_rows) for r in bad) == [("202404", 2, 1), ("202405", 2, 1)]


def test_first_month_demand_is_null_without_open_order(spark):
    bom = spark.createDataFrame(
        [("1-XABC", "2", None), ("1-XABC", "2", "9"), ("1-XABC", "2", "4"), ("9-NONE", "2", "4"), (None, "x", "4")],
        "ref string, quantity_w_scrap string, next_28_days_open_order string",
    )
    lag1 = plans.forecast_lag1(forecast_rows(spark, [("1", "X-ABC", m, "7") for m in FOURTEEN]))
    got = plans.bom_demand(bom, lag1, width=3).collect()
    key = {(r.mfg_ref, r.next_28_days_open_order): (r.dep_m01, r.dep_m02) for r in got}
    # greatest would give 14 in the first row
    assert key == {
        ("1-XABC", None): (None, 14.0),
        ("1-XABC", 9.0): (18.0, 14.0),
        ("1-XABC", 4.0): (14.0, 14.0),
        ("9-NONE", 4.0): (8.0, 0.0),
        (None, 4.0): (None, None),
    }


def test_null_keys_match(spark):
    facts = spark.createDataFrame([("1",), (None,), ("2",)], "location string")
    campus = spark.createDataFrame([("1", "A"), (None, "B")], "location string, campus string")
    got = {r.location: r.campus for r in op.join_campus_text(facts, campus).collect()}
    assert got == {"1": "A", None: "B", "2": None}


def test_unlisted_shared_column_is_an_error(spark):
    left = spark.createDataFrame([("1", "x")], "k string, v string")
    with pytest.raises(ValueError, match="'v'"):
        op.lookup_join(left, left, ["k"])


def test_tolerant_double(spark):
    texts = ["abc", "12345F", "12345D", " 12 ", "1e3", "", None, ".5", "5.", "-3", "0x1p3", "NaN", "Infinity"]
    expected = [None, None, None, 12.0, 1000.0, None, None, 0.5, 5.0, -3.0, None, None, None]
    assert apply(spark, texts, fn.tolerant_double("v")) == expected


def test_codes_print_as_plain_digits(spark):
    numbers = [12345.0, 12345678.0, 100000.0, 12.5, 12345678.25, -7.0, 0.0, 1e17, None]
    expected = ["12345", "12345678", "100000", "12.5", "12345678.25", "-7", "0", "1" + "0" * 17, None]
    assert apply(spark, numbers, fn.code_to_text("v"), "double") == expected


def test_short_and_long_records(spark):
    df = spark.createDataFrame([("a~b",), ("a~~c~d",)], "line string")
    got = df.select(*fn.split_fixed("line", ["x", "y", "z"])).collect()
    assert [tuple(r) for r in got] == [("a", "b", None), ("a", "", "c")]


def test_separator_is_taken_literally(spark):
    df = spark.createDataFrame([("a.b||c",)], "line string")
    assert tuple(df.select(*fn.split_fixed("line", ["x", "y"], ".")).first()) == ("a", "b||c")
    assert tuple(df.select(*fn.split_fixed("line", ["x", "y"], "||")).first()) == ("a.b", "c")


def test_compound_code_parts(spark):
    df = spark.createDataFrame([("G-RP-1234-X",), ("G.*RP__9",), ("G",), ("-G-1",), (None,)], "code string")
    got = df.select(*fn.split_regex("code", ["global", "rp", "item"])).collect()
    assert [tuple(r) for r in got] == [
        ("G", "RP", "1234"),
        ("G", "RP", "9"),
        ("G", None, None),
        ("", "G", "1"),
        (None, None, None),
    ]


def test_compound_codes_with_single_hyphens(spark):
    """These are cut without the general expression; a line feed at the end, two hyphens and other letters are not."""
    codes = ["a-b-c", "-a-b", "a-b-", "a", "", "-", "a-b\n", "a--b", "--", "a-é-b", "a-b~c"]
    got = spark.createDataFrame([(c,) for c in codes], "code string").select("code", *fn.split_regex("code", ["x", "y", "z"])).collect()
    assert {r["code"]: tuple(r)[1:] for r in got} == {c: tuple((re.split("[^0-9A-Za-z]+", c) + [None] * 3)[:3]) for c in codes}


def test_missing_description_is_dropped(spark):
    df = spark.createDataFrame(
        [(None,), ("PWS x",), ("PWSx",), ("PALLETS",), ("SUB a",), ("THW a",), ("ok",)], "d string"
    )
    assert values(df.filter(fn.keeps_description("d")), "d") == ["PWSx", "ok"]


def test_months_are_placed_by_calendar_order(spark):
    first = [("1", "A-ABC", m, "1") for m in FOURTEEN if m != "202402"]
    second = [("2", "B-ABC", m, str(i)) for i, m in enumerate(FOURTEEN)]
    got = {r.mfg_ref: r for r in plans.forecast_lag1(forecast_rows(spark, first + second)).collect()}
    assert got["2-BABC"].fcst_m01 == 2.0 and got["2-BABC"].fcst_m12 == 13.0
    assert got["1-AABC"].fcst_m01 == 1.0


def test_key_without_a_chosen_month_keeps_its_row(spark):
    rows = [("1", "A-ABC", m, "1") for m in FOURTEEN] + [("2", "B-ABC", "202401", "5")]
    got = {r.mfg_ref: r for r in plans.forecast_lag1(forecast_rows(spark, rows)).collect()}
    assert [got["2-BABC"][n] for n in op.month_names("fcst")] == [0.0] * 12


def test_keys_that_become_equal_stay_apart(spark):
    rows = [("1-2", "3", m, "1") for m in FOURTEEN] + [("1", "2_3", m, "5") for m in FOURTEEN]
    got = plans.forecast_lag1(forecast_rows(spark, rows)).collect()
    assert sorted((r.mfg_ref, r.fcst_m01) for r in got) == [("1-2-3", 1.0), ("1-2-3", 5.0)]


def lots(spark, rows):
    return spark.createDataFrame(
        rows,
        "location string, campus_no string, item string, description string, "
        "inventory_hold_status string, current_inventory_balance string",
    )


def test_equal_numbers_with_different_text_stay_two_rows(spark):
    report = lots(spark, [("1", "9", "007", "d", "u", "1"), ("1", "9", "7", "d", "u", "2"), ("1", "9", "0-07", "d", "u", "4")])
    got = plans.rm_inventory_lot(report).collect()
    assert sorted((r.ref, r.campus_ref, r.item, r.inventory) for r in got) == [
        ("1-7", "9-7", 7.0, 2.0),
        ("1-7", "9-7", 7.0, 5.0),
    ]


def test_underscores_inside_an_item_become_dashes(spark):
    report = lots(spark, [("1", None, "A_1-ABC", "d", "Useable", "1")])
    got = plans.fg_inventory_lot(report).first()
    assert (got.ref, got.campus_ref, got.item) == ("1-A-1ABC", "NA-A-1ABC", "A_1ABC")


def test_leading_zeros(spark):
    assert apply(spark, ["00026", "000", "10", "", None], fn.strip_leading_zeros("v")) == ["26", "", "10", "", None]


def test_dates(spark):
    day = dt.date(2024, 1, 2)
    texts = ["2024-01-02", "2024-01-02 00:00:00", "2024/01/02", "2024-1-2", "2024-01-02T10", "2024-01-023"]
    assert apply(spark, texts, fn.tolerant_date("v")) == [day] * len(texts)
    bad = ["x", "", None, "2024", "2024-03", " 2024-03 ", "12024-03-01", "2024-13-01", "20240102"]
    assert apply(spark, bad, fn.tolerant_date("v")) == [None] * len(bad)


def test_blank_and_na_texts_are_missing(spark):
    assert apply(spark, [" a ", "", "NA", "  ", None], fn.blank_to_null("v")) == ["a", None, None, None, None]


def test_inferred_types(spark):
    df = spark.createDataFrame(
        [("1", "007", "T", "2024-01-02", "", "12345F"), ("2.5", "8", "FALSE", "NA", None, "1")],
        "a string, b string, c string, d string, e string, f string",
    )
    found = {r["column"]: r["type"] for r in op.inferred_types(df).collect()}
    assert found == {"a": "double", "b": "string", "c": "boolean", "d": "date", "e": "boolean", "f": "string"}
    typed = op.infer_types(df)
    assert [f.dataType.simpleString() for f in typed.schema] == ["double", "string", "boolean", "date", "boolean", "string"]
    assert typed.orderBy("a").first()["d"] == dt.date(2024, 1, 2)


def test_clean_names():
    raw = ["Item Number", "B/P", None, "NA", "...2", "CampusNo", "% Scrap", "Item  Number", "", "28 Days", "Loc'n #"]
    assert op.clean_name_list(raw) == [
        *("item_number", "b_p", "na", "na_2", "x2", "campus_no", "percent_scrap", "item_number_2"),
        *("x", "x28_days", "locn_number"),
    ]


def test_clean_names_are_unique_and_plain():
    assert op.clean_name_list(["Item", "Item", "Item 2", "Número", "item_2"]) == ["item", "item_2", "item_2_2", "numero", "item_2_3"]


def test_positions_must_exist(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert op.project_positional(df, [3, 1]).columns == ["c", "a"]
    with pytest.raises(ValueError, match="3 columns"):
        op.project_positional(df, range(1, 5))
    with pytest.raises(ValueError, match="3 columns"):
        op.project_positional(df, [0])


def test_a_short_snapshot_is_an_error(spark):
    rows = forecast_rows(spark, [("1", "X-ABC", m, "7") for m in FOURTEEN[:8]])
    with pytest.raises(Exception, match="needs 14 months and has 8"):
        plans.forecast_lag1(rows).collect()


def weekly_forecast(spark):
    months = {"2024-01-03": FOURTEEN, "2024-02-01": FOURTEEN[:8]}
    rows = [(day, "1", "X-ABC", m, "7") for day, listed in months.items() for m in listed]
    columns = (
        "snapshot_date string, product_manufacturing_location_code string, product_label_sku_code string, "
        "forecast_month_year_id string, adjusted_forecast_cases string"
    )
    return spark.createDataFrame(rows, columns).withColumn("snapshot_date", F.col("snapshot_date").cast("date"))


def test_runs_without_a_complete_snapshot_have_no_forecast(spark):
    days = ["2024-02-06", "2024-03-05", "2024-05-07"]
    runs = spark.createDataFrame([(d,) for d in days], "as_of string").withColumn("as_of", F.col("as_of").cast("date"))
    wide = {f"x{n:02d}": F.lit("x") for n in range(4, 44)}
    bom = runs.select("as_of", *(F.lit(v).alias(n) for n, v in (("ref", "1-XABC"), ("quantity_w_scrap", "2"), ("next_28_days_open_order", "3"))))
    got = plans.weekly.weekly_bom_demand(bom.withColumns(wide), weekly_forecast(spark), runs)
    assert got.columns[:3] == ["as_of", "snapshot_date", "mfg_ref"] and "x31" in got.columns and "x32" not in got.columns
    rows = {str(r.as_of): (r.fcst_m01, r.fcst_m12, r.dep_m01) for r in got.collect()}
    assert rows == {days[0]: (7.0, 7.0, 14.0), days[1]: (None, None, None), days[2]: (None, None, None)}
    chosen = plans.weekly.choose_snapshots(runs, weekly_forecast(spark))
    gaps = sorted((str(r.as_of), str(r.snapshot_date), r.months_found) for r in plans.weekly.forecast_gaps(chosen).collect())
    assert gaps == [(days[1], "2024-02-01", 8), (days[2], "None", 0)]


def test_lookup_gives_one_row_a_ref(spark):
    rows = [(a, b, m, q) for a, b, q in (("1_2", "X-ABC", "5"), ("1-2", "XA-BC", "9")) for m in FOURTEEN]
    forecast = plans.forecast_lag1(forecast_rows(spark, rows), keep_raw=True)
    assert sorted(r.raw_ref for r in forecast.collect()) == ["1-2_XABC", "1_2_XABC"]
    refs = spark.createDataFrame([("1-2-XABC",), ("other",)], "ref string")
    got = sorted((r.ref, r.lag1) for r in plans.lag1_lookup(refs, forecast).collect())
    assert got == [("1-2-XABC", 9.0), ("other", 0.0)]


def test_a_null_location_finds_the_null_campus(spark):
    campus = spark.createDataFrame([(None, "C"), ("7", "D")], "location string, campus string")
    rows = spark.createDataFrame([(None, "a"), ("7", "b"), ("8", "c")], "location string, item string")
    got = sorted((r.item, r.campus or "-") for r in op.join_campus_text(rows, campus).collect())
    assert got == [("a", "C"), ("b", "D"), ("c", "-")]


def test_label_lots_are_added_once_and_keep_the_item_text(spark):
    erp = spark.createDataFrame(
        [("25", "007", "lab", "3"), ("25", "007", "lab", "3"), ("55", "8", "no label", "1"), ("25", "7ABC", "fg", "1")],
        "bp string, item_number string, description string, on_hand string",
    )
    report = spark.createDataFrame(
        [("1", "7", "LBL"), ("2", "7", "LBL"), ("1", "8", "OTH"), ("1", "x", "LBL")],
        "b_p string, item_number string, mpf_or_line string",
    )
    got = plans.label_inventory(erp, report).collect()
    assert [(r.ref, r.campus_ref, r.campus, r.item, r.inventory) for r in got] == [("25-007", "25-007", "25", 7.0, 3.0)] * 2


def test_number_suffix_codes_are_finished_goods(spark):
    inv_bal = spark.createDataFrame(
        [("1", "12345F", "d", "9", "1", None, "3"), ("1", "12345", "d", "9", "1", None, "3"), ("226", "5", "d", "9", "1", "1", "1")],
        "bp string, item string, description string, inventory string, usable string, soft_hold string, hard_hold string",
    )
    campus = spark.createDataFrame([("01", "C")], "location string, campus string")
    rm_store = spark.createDataFrame(
        [("226", "77", "w", "5", "K"), ("1", "78", "w", "5", "K")],
        "location string, item string, na_2 string, current_inventory_balance string, campus string",
    )
    rm = plans.rm_inventory_balance(inv_bal, rm_store, campus).collect()
    assert sorted((r.ref, r.campus_ref, r.item, r.inventory) for r in rm) == [
        ("1-12345", "C-12345", 12345.0, 9.0),
        ("226-77", "K-77", 77.0, 5.0),
    ]
    fg_store = spark.createDataFrame(
        [("226", "M", "9-ABC", "w", "Useable", None)],
        "location string, product_manufacturing_location string, item string, na_2 string, "
        "hold_status string, current_inventory_balance string",
    )
    fg = plans.fg_inventory_balance(inv_bal, fg_store, campus).collect()
    assert sorted((r.ref, r.campus_ref, r.inventory_hold_status, r.inventory_qty_cases or 0) for r in fg) == [
        ("1-12345F", "C-12345F", "Hard Hold", 3.0),
        ("1-12345F", "C-12345F", "Soft Hold", 0.0),
        ("1-12345F", "C-12345F", "Useable", 1.0),
        ("226-9ABC", "M-9ABC", "Useable", 0),
    ]
    # A hold without quantity counts as 0, a warehouse row without quantity stays unknown.
    assert [r.inventory_qty_cases for r in fg if r.location == "226"] == [None]


def test_repeated_map_rows_multiply_the_stock(spark):
    analysis = spark.createDataFrame(
        [("1", "n", "A-ABC", "d", "u", "2"), ("1", "n", "AABC", "d", "u", "3"), ("1", "n", "B-ABC", "d", "u", None),
         ("1", "n", "C-ABC", "d", "u", "n/a"), ("1", "n", "'1", "d", "u", "1")],
        "location string, location_nm string, product_label_sku string, description string, "
        "inventory_hold_status string, inventory_qty_cases string",
    )
    mfg_map = spark.createDataFrame(
        [("1", "A-ABC", "M"), ("1", "AABC", "M"), ("1", "A-ABC", "K")],
        "location_no string, product_label_sku_code string, product_manufacturing_location_code string",
    )
    got = plans.fg_inventory_mfg(analysis, mfg_map).collect()
    assert sorted((r.ref, str(r.mfg_ref), str(r.current_inventory_balance)) for r in got) == [
        ("1-'1", "None", "1.0"),
        ("1-AABC", "K-AABC", "5.0"),
        ("1-AABC", "M-AABC", "10.0"),
        ("1-BABC", "None", "None"),
        ("1-CABC", "None", "None"),
    ]
    later = plans.fg_inventory_mfg(analysis, mfg_map, missing_is_zero=True, drop_items=["'1"]).collect()
    assert sorted((r.ref, str(r.current_inventory_balance)) for r in later) == [
        ("1-AABC", "10.0"),
        ("1-AABC", "5.0"),
        ("1-BABC", "0.0"),
        ("1-CABC", "None"),
    ]


def test_lookup_rounds_half_away_from_zero(spark):
    refs = spark.createDataFrame([("a",), ("b",), ("c",)], "ref string")
    forecast = spark.createDataFrame([("a", 2.5), ("b", -2.5)], "mfg_ref string, fcst_m01 double")
    got = {r.ref: r.lag1 for r in plans.lag1_lookup(refs, forecast).collect()}
    assert got == {"a": 3.0, "b": -3.0, "c": 0.0}


def test_duplicate_lookup_keys_are_reported(spark):
    lookup = spark.createDataFrame([("1", "A"), ("1", "B"), ("2", "C")], "location string, campus string")
    assert [tuple(r) for r in op.duplicate_keys(lookup, ["location"]).collect()] == [("1", 2)]


def test_bad_exception_numbers_keep_their_rows(spark):
    report = spark.createDataFrame(
        [("OLD", "5", "LBL", "x"), ("7", "bad", "OTH", "y")], "b_p string, item_number string, mpf_or_line string, note string"
    )
    campus = spark.createDataFrame([("7", "C"), ("2", "D")], "location string, campus string")
    got = plans.exception_enriched(report, campus)
    assert got.columns == ["ref", "campus_ref", "campus", "b_p", "item_number", "mpf_or_line", "note"]
    assert sorted(tuple(r)[:3] for r in got.select("ref", "campus_ref", F.coalesce("campus", F.lit("-"))).collect()) == [
        ("7-NA", "C-NA", "C"),
        ("NA-5", "NA-5", "-"),
    ]
