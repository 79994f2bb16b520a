import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from shelfledger.operators import aggregates, columns, lookups, quality, rolling, unions


def test_lookup_keeps_fan_out_and_misses(spark, rows):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    dim = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "n")], "code string, name string")
    got = rows(lookups.lookup(fact, dim, [("k", "code")]))
    assert got == sorted([("a", 1, "x"), ("a", 1, "y"), ("b", 2, None), (None, 3, None)], key=repr)
    with pytest.raises(ValueError, match="duplicate key"):
        lookups.lookup(fact, dim, [("k", "code")], unique=True)
    lookups.assert_unique(dim, ["code", "name"])


def test_hierarchy_trims_only_when_asked(spark):
    items = spark.createDataFrame([("1", "10", "1001", "c1"), ("2", "90", "9001", "c2")], "itemcode string, dept string, subdept string, category string")
    levels = spark.createDataFrame(
        [("10", "D10", "1001", "S", "c1", "C1"), (" 90 ", "D90", "9001", "S9", "c2", "C2"), ("10", "other", "1001", "S", "c1", "C1")],
        "dept string, deptdesc string, subdept string, subdeptdesc string, category string, categorydesc string")
    both = lookups.item_hierarchy(items, levels)
    assert sorted(r.deptdesc for r in both.collect()) == ["D10", "D90", "other"]
    exact = lookups.item_hierarchy(items, levels, trim_keys=False)
    assert sorted(r.deptdesc for r in exact.collect()) == ["D10", "other"]


def test_shifted_and_prefix_joins(spark, rows):
    stock = spark.createDataFrame([(date(2025, 3, 1), "b"), (date(2025, 3, 3), "b")], "extract_day date, branch string")
    sold = spark.createDataFrame([(date(2025, 2, 28), "b", 7.0)], "bizdate date, location string, qty double")
    got = rows(lookups.join_shifted(stock, sold, [("branch", "location")], ("extract_day", "bizdate"), 1))
    assert got == [(date(2025, 3, 1), "b", 7.0), (date(2025, 3, 3), "b", None)]
    a = spark.createDataFrame([("1001",), ("1002",)], "loc string")
    b = spark.createDataFrame([("1001-Shop", 1)], "to string, v int")
    assert rows(lookups.join_prefix(a, b, ("loc", "to"), 4)) == [("1001", "1001-Shop", 1), ("1002", None, None)]


def test_left_join_suffix(spark, rows):
    a = spark.createDataFrame([("1", "n1", "b1")], "site string, site_name string, banner string")
    b = spark.createDataFrame([("1", "n2", "B2"), ("1", "n3", "B3")], "site string, site_name string, Banner string")
    out = lookups.left_join_suffix(a, b, "site", ("_x", "_y"))
    assert out.columns == ["site", "site_name_x", "banner", "site_name_y", "Banner"]
    assert rows(out) == [("1", "n1", "b1", "n2", "B2"), ("1", "n1", "b1", "n3", "B3")]


def test_vendors(spark, rows):
    vendor = spark.createDataFrame(
        [(1, " S ", 2, "A", " V1", "N "), (1, " S ", 2, "A", " V1", "N "), (1, "S", 3, "B", "#", "none"), (1, "S", 4, "B", None, "none")],
        "site_key int, site string, article_key int, article string, primary_vendor_key string, primary_vendor string")
    assert rows(lookups.current_vendor(vendor)) == [("1", "S", "2", "A", "V1", "N")]
    stock = spark.createDataFrame([("i", "b", "S1"), ("i", "b", "S2"), ("i", "c", "S3")], "itemcode string, branch string, ib_sup_code string")
    names = spark.createDataFrame([("S1", "one")], "code string, name string")
    first = spark.createDataFrame([("S1", 0), ("S2", 1), ("S3", 0)], "code string, priority_vendor int")
    assert rows(lookups.priority_vendor(stock, names, first)) == sorted([("i", "b", "S1", "one", 0), ("i", "c", None, None, 0)], key=repr)


def test_first_by_priority_is_cut_before_the_shuffle(spark):
    df = spark.range(10_000).select((F.col("id") % 3).alias("k"), (9_999 - F.col("id")).alias("v"))
    out = aggregates.first_by_priority(df, ["k"], ["v"])
    assert out._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert sorted(tuple(r) for r in out.collect()) == [(0, 0), (1, 2), (2, 1)]


def _brute(series, days):
    return {
        (k, d): sum(q for (k2, d2), q in series.items() if k2 == k and timedelta(0) <= d - d2 < timedelta(days)) / days
        for k, d in series
    }


def test_rolling_average_against_brute_force(spark):
    rng = random.Random(7)
    start = date(2024, 1, 1)
    series = {(k, start + timedelta(rng.randrange(200))): float(rng.randrange(50)) for k in "abc" for _ in range(60)}
    df = spark.createDataFrame([(k, d, q) for (k, d), q in series.items()], "k string, d date, q double")
    got = rolling.rolling_daily_average(df, ["k"], "d", "q", [30, 90])
    for n in (30, 90):
        assert {(r.k, r.d): r[f"ads_rl{n}"] for r in got.collect()} == pytest.approx(_brute(series, n))
    day = sorted(d for _, d in series)[-20]
    one = rolling.rolling_daily_average(df, ["k"], "d", "q", [30, 90], as_of=str(day))
    key = lambda r: (r.k, r.q, r.ads_rl30, r.ads_rl90)
    assert sorted(map(key, one.collect())) == sorted(map(key, got.filter(F.col("d") == F.lit(day)).collect()))


def test_union_widens_and_checks_width(spark):
    one = spark.range(1).select(*[F.lit(1).alias(c) for c in unions.SALES_COLUMNS])
    two = spark.range(1).select(*[F.lit(1.5).alias(f"x{i}") for i in range(len(unions.SALES_COLUMNS))])
    out = unions.union_sales(one, two)
    assert out.columns == unions.SALES_COLUMNS and len(out.columns) == 37
    assert sorted(r.Qty for r in out.collect()) == [1.0, 1.5]
    with pytest.raises(ValueError):
        unions.union_sales(one, two.drop("x0"))


def test_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["Total Qty-Sales ", "B"])
    assert columns.snake_case_columns(df).columns == ["total_qty_sales", "b"]
    assert columns.with_prefix(df, "P_").columns == ["P_Total Qty-Sales ", "P_B"]
    target = StructType([StructField("b", DoubleType()), StructField("c", StringType()), StructField("d", LongType())])
    assert [tuple(r) for r in columns.align_to(df, target).collect()] == [(2.0, None, None)]


def test_reconcile_finds_one_sided_days(spark):
    day = lambda n: date(2025, 1, n)
    expected = spark.createDataFrame([(day(1), 1.001), (day(2), 2.0), (day(3), 3.0), (day(5), None)], "date date, m double")
    actual = spark.createDataFrame([(day(1), 1.004), (day(2), 2.5), (day(4), 4.0), (day(5), None)], "date date, m double")
    got = quality.reconcile(expected, actual, "date", ["m"]).orderBy("date").collect()
    assert [tuple(r) for r in got] == [(day(2), 2.0, 2.5, True), (day(3), 3.0, None, True), (day(4), None, 4.0, True)]


def test_missing_keys(spark, rows):
    day = lambda n: date(2025, 1, n)
    actual = spark.createDataFrame([("a", day(1)), ("a", day(1)), ("a", day(9)), ("c", day(2))], "location string, date date")
    dates = spark.createDataFrame([(day(1),), (day(2),), (day(2),)], "date date")
    locations = spark.createDataFrame([("a",), ("b",), ("b",)], "location string")
    out = quality.missing_keys(actual, dates, locations)
    assert rows(out) == [(day(1), "b"), (day(2), "a"), (day(2), "b")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_duplicates(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", None), ("b", None)], "s string, n int")
    assert rows(quality.duplicate_counts(df, [["s"], ["s", "n"]])) == [("s", 3), ("s,n", 2)]
    assert rows(quality.duplicate_counts(df.filter("false"), [["s"]])) == [("s", 0)]
    assert rows(quality.non_unique(df, ["s", "n"])) == sorted([("a", 1, 2), ("b", None, 2)], key=repr)
    loaded = spark.createDataFrame([("a", 1.0), ("b", None)], "s string, q double")
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "s string")
    assert rows(quality.verify_load(wanted, loaded, ["s"], "q")) == [
        ("a", "Success"), ("b", "Verification failed"), ("c", "Verification failed")]
