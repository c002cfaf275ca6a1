"""Column functions against plain-Python models, on many generated texts in one job each."""

from __future__ import annotations

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from matflow import functions as fn

RANDOM = random.Random(7)


def texts(alphabet: str, count: int = 4000, longest: int = 12) -> list[str]:
    return ["".join(RANDOM.choices(alphabet, k=RANDOM.randint(0, longest))) for _ in range(count)]


def check(spark, values, expression, model):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for value, out in df.select("v", expression.alias("out")).collect():
        assert out == model(value), repr(value)


def test_numbers(spark):
    pattern = re.compile(r"[ \t]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t]*")
    values = texts("0123456789.", longest=6) + texts("01.eE+- dDfFxX", longest=6) + ["NaN", "inf", "-Infinity"]
    check(spark, values, fn.tolerant_double("v"), lambda v: float(v) if pattern.fullmatch(v) else None)


def test_dates(spark):
    pattern = re.compile(r"\s*(\d{4})([-/])(\d{1,2})\2(\d{1,2})")

    def model(value):
        found = pattern.match(value)
        if not found or found[1] == "0000":
            return None
        try:
            return dt.date(int(found[1]), int(found[3]), int(found[4]))
        except ValueError:
            return None

    def part(limit):
        return RANDOM.choice([str, "{:02d}".format, "{:03d}".format])(RANDOM.randint(0, limit))

    values = texts("0123-/ ", longest=11)
    for _ in range(4000):
        sep = RANDOM.choice("-/")
        day = f"{RANDOM.randint(1000, 2999)}{sep}{part(14)}{sep}{part(33)}"
        values.append(RANDOM.choice(["", "", " "]) + day + RANDOM.choice(["", "", " 10:00", "T1", "x", "7"]))
    check(spark, values, fn.tolerant_date("v"), model)


def test_splits(spark):
    names = ["a", "b", "c"]

    def fixed(value):
        parts = value.split("~")[:3]
        return tuple(parts + [None] * (3 - len(parts)))

    def compound(value):
        parts = re.split("[^0-9A-Za-z]+", value)[:3]
        return tuple(parts + [None] * (3 - len(parts)))

    values = texts("ab1~-_ ")
    check(spark, values, F.struct(*fn.split_fixed("v", names)), fixed)
    check(spark, values, F.struct(*fn.split_regex("v", names)), compound)


def test_characters(spark):
    values = texts("0a-_1")
    check(spark, values, fn.strip_leading_zeros("v"), lambda v: v.lstrip("0"))
    check(spark, values, fn.remove_char("v"), lambda v: v.replace("-", ""))
    check(spark, values, fn.dash_key("v", F.lit(None).cast("string")), lambda v: f"{v}_NA".replace("_", "-"))


def test_item_classes(spark):
    values = texts("01aBZ-", longest=7)
    check(spark, values, fn.is_raw_material("v"), lambda v: bool(re.fullmatch("[0-9]+", v)))
    check(spark, values, fn.is_finished_good("v"), lambda v: bool(re.search("[A-Za-z]{3}\\Z", v)))
