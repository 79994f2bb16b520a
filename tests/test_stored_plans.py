"""Stored and incremental forms of reports against the reports computed whole."""

import os
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from sampledata.queries import _ByName
from sampledata.tables import RetailTables
from shelfledger.operators import quality, receipts
from shelfledger.plans import order_store, rolling_sales, rolling_state, sales, sales_store, supply_chain
from shelfledger.sources import versions

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="sample data not present")


@pytest.fixture(scope="module")
def retail(spark):
    return _ByName(RetailTables(spark, DATA))


def same(a, b):
    assert a.columns == b.columns
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_orders_are_joined_without_a_shuffle_by_order_number(spark, retail, tmp_path):
    docs = order_store.store(retail, "kept", 8, str(tmp_path))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for report in (lambda d: supply_chain.po_gr(retail, "1998-06-30", d), lambda d: supply_chain.po_gr_dc(retail, d)):
            plan = plan_of(report(docs))
            exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
            assert not [x for x in exchanges if "RefNo" in x] and "SortMergeJoin" in plan
            assert any("RefNo" in x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan_of(report(None))))
            assert same(report(docs), report(None))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def _days(spark, n):
    """Stock and sales of three items at two branches over ``n`` days, with gaps and days without sales."""
    start, stock, sold = date(2024, 1, 1), [], []
    for k in range(n):
        d = start + timedelta(days=k)
        for b in ("1001", "1002"):
            for i in ("i1", "i2", "i3"):
                if (k * 7 + len(b + i) + int(i[1]) * 3) % 4 and not (i == "i3" and k > 20):
                    stock.append((d + timedelta(days=1), b, i, 1.5))
                if (k + int(i[1])) % 3 == 0:
                    sold += [(d, b, i, k % 5 + 0.25), (d, b, i, 1.0)]
    make = spark.createDataFrame
    return start, {
        "stock_daily": make(stock, "extract_day date, branch string, itemcode string, avgdailysales double"),
        "pos_group": make(sold, "bizdate date, location string, itemcode string, qty double").withColumn("qty", F.col("qty").cast("decimal(18,4)")),
        "item": make([("i1", "10", "One"), ("i2", "20", "Two")], "itemcode string, dept string, description string"),
        "branch": make([("1001", "Giant Hyper")], "branch_code string, banner string"),
    }


def test_a_hundred_days_added_one_by_one(spark):
    """The state of each day is the one before it, plus the day, less the days that leave the spans."""
    start, tables = _days(spark, 100)
    whole = {(r.Location, r.Itemcode, r.BizDate): (r.Qty, r.ADS_RL30, r.ADS_RL90) for r in rolling_sales.rolling_sales(tables).collect()}
    every = rolling_state._sales_of(tables, start - timedelta(days=200), start + timedelta(days=200)).select("BizDate", "Location", "Itemcode", "Qty").cache()
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        state, schema = {}, "Location string, Itemcode string, sum30 decimal(38,4), rows30 bigint, sum90 decimal(38,4), rows90 bigint"
        seen = 0
        for k in range(100):
            day = start + timedelta(days=k)
            of = lambda gone: every.filter(F.col("BizDate") == day - timedelta(days=gone))
            before = spark.createDataFrame([(*key, *v) for key, v in state.items()], schema)
            after = rolling_state.advanced(before, [
                rolling_state._change(of(0), 1, (30, 90)), rolling_state._change(of(30), -1, (30,)), rolling_state._change(of(90), -1, (90,))])
            state = {(r.Location, r.Itemcode): tuple(r)[2:] for r in after.collect()}
            for (loc, item, d), (_, a30, a90) in whole.items():
                if d == day:
                    seen += 1
                    s30, _, s90, _ = state[loc, item]
                    assert abs(s30 / 30 - a30) < 1e-5 and abs(s90 / 90 - a90) < 1e-5
        assert seen == len(whole)
        # A key without a row for 90 days is forgotten; one with rows stays, also without sales.
        assert ("1001", "i3") in state
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        every.unpersist()


def test_stored_days_equal_the_whole_computation(spark, tmp_path):
    start, tables = _days(spark, 130)
    path, whole = str(tmp_path / "rolling"), rolling_sales.rolling_sales(tables)
    day = lambda k: start + timedelta(days=k)
    # From nothing, by one day, over a gap longer than the shorter span, a rerun, and to the end.
    for k in (94, 95, 96, 96, 129):
        got = rolling_state.advance(spark, path, tables, day(k))
        assert same(got, whole.filter(F.col("BizDate") == day(k)))
    assert rolling_state.stored_days(spark, path) == [day(k) for k in (94, 95, 96, 129)]
    extract = rolling_sales.daily_extract(tables, day(97), "1", rolled=rolling_state.read(spark, path))
    assert same(extract, rolling_sales.daily_extract(tables, day(97), "1"))


def test_old_states_are_dropped(spark, tmp_path):
    start, tables = _days(spark, 20)
    path = str(tmp_path / "rolling")
    for k in range(rolling_state.KEPT_DAYS + 2):
        rolling_state.advance(spark, path, tables, start + timedelta(days=k))
    days = rolling_state.stored_days(spark, path)
    assert len(days) == rolling_state.KEPT_DAYS and days[-1] == start + timedelta(days=rolling_state.KEPT_DAYS + 1)


def test_a_late_day_rewrites_its_period_only(spark, retail, tmp_path):
    feed, path = str(tmp_path / "srp"), str(tmp_path / "view")
    srp = retail["pos_srp"]
    late = date(1998, 8, 14)
    month = lambda df: df.withColumn("month", F.trunc("date", "MONTH"))
    versions.reload(month(srp.filter(F.col("date") != late)), feed, ["month"])
    tables = {n: retail[n] for n in ("pos_panda", "pos_sap", "item", "hierarchy", "item_cost", "budget", "vendor", "branch")}
    tables["pos_srp"] = versions.read(spark, feed).drop("month")
    sales_store.refresh(spark, tables, path, length="QUARTER")
    before = {r[0]: r[1] for r in versions.partitions(spark, path).collect()}
    since = versions.state(spark, feed).number
    versions.reload(month(srp.filter((F.year("date") == 1998) & (F.month("date") == 8))), feed, ["month"])
    tables["pos_srp"] = versions.read(spark, feed).drop("month")
    changed = sales_store.changed_days(spark, feed, "month", since)
    assert [r.day for r in changed.collect()] == [date(1998, 8, 1)]
    assert sales_store.refresh(spark, tables, path, changed, "QUARTER") == 1
    after = {r[0]: r[1] for r in versions.partitions(spark, path).collect()}
    assert {k for k in after if after[k] != before.get(k)} == {date(1998, 7, 1)} and set(before) == set(after)
    assert same(sales_store.read(spark, path), sales.unified_sales(retail))


def test_changed_periods_reach_the_scans(spark, retail, tmp_path):
    retail["pos_panda"].write.parquet(str(tmp_path / "panda"))
    tables = {n: retail[n] for n in ("pos_srp", "pos_sap", "item", "hierarchy", "item_cost", "budget", "vendor", "branch")}
    tables["pos_panda"] = spark.read.parquet(str(tmp_path / "panda"))
    first, last = sales_store._spans([date(1998, 1, 1), date(1998, 2, 1), date(1999, 3, 1)], "MONTH")
    assert first == (date(1998, 1, 1), date(1998, 2, 28)) and last == (date(1999, 3, 1), date(1999, 3, 31))
    view = sales.unified_sales(tables).filter(F.col("BizDate").between(*first) | F.col("BizDate").between(*last))
    assert "GreaterThanOrEqual(bizdate,1998-01-01)" in plan_of(view)


def test_an_emptied_period_and_no_change(spark, retail, tmp_path):
    path = str(tmp_path / "view")
    tables = {n: retail[n] for n in ("pos_panda", "pos_srp", "pos_sap", "item", "hierarchy", "item_cost", "budget", "vendor", "branch")}
    sales_store.refresh(spark, tables, path, length="QUARTER")
    n = versions.partitions(spark, path).count()
    for name, day in (("pos_panda", "bizdate"), ("pos_srp", "date"), ("pos_sap", "yearmonthday")):
        tables[name] = tables[name].filter(F.col(day) >= date(1998, 1, 1))
    gone = spark.createDataFrame([(date(1997, 12, 5),), (None,)], "day date")
    assert sales_store.refresh(spark, tables, path, gone, "QUARTER") == 1
    assert versions.partitions(spark, path).count() == n - 1
    assert sales_store.refresh(spark, tables, path, gone.filter("day IS NULL"), "QUARTER") == 0
    with pytest.raises(ValueError):
        sales_store.refresh(spark, tables, path, gone, "YEAR")


def test_receipts_at_every_grain(spark, retail):
    lines = retail["pos_panda"].select("bizdate", "location", "dept", F.concat(F.lit("R-"), "refno").alias("refno"))
    lines = lines.union(lines.limit(3).select("bizdate", "location", "dept", F.lit(None).cast("string")))
    numbers = receipts.receipt_numbers(lines, "refno", ["bizdate", "location"])
    n = lines.select(F.count_distinct("refno")).first()[0]
    assert numbers.agg(F.min("_receipt_no"), F.max("_receipt_no"), F.count_distinct("_receipt_no")).first()[:] == (1, n, n)
    fine = receipts.receipt_bitmaps(lines.join(numbers, "refno", "left"), ["bizdate", "location", "dept"])
    fine = fine.withColumn("month", F.trunc("bizdate", "MONTH"))
    for keys in (["month", "dept"], ["location"], ["bizdate", "location"], []):
        got = receipts.receipt_counts(fine, keys, "n")
        want = lines.filter("refno is not null").withColumn("month", F.trunc("bizdate", "MONTH")).groupBy(*keys).agg(F.count_distinct("refno").alias("n"))
        assert same(got, want)
    more = lines.limit(5).withColumn("refno", F.concat(F.lit("new"), F.monotonically_increasing_id().cast("string")))
    longer = receipts.receipt_numbers(more, "refno", ["bizdate"], numbers)
    assert longer.count() == n + 5 and longer.join(numbers, ["refno", "_receipt_no"]).count() == n
    assert longer.agg(F.max("_receipt_no")).first()[0] == n + 5


def test_missing_days_by_bits(spark):
    days = [date(1969, 12, 28) + timedelta(days=k) for k in range(140)] + [date(2030, 1, 1)]
    have = {("a", d) for k, d in enumerate(days) if k % 3} | {("b", days[0]), (None, days[1])}
    actual = spark.createDataFrame([*have, *have, ("a", None)], "location string, date date")
    dates = spark.createDataFrame([(d,) for d in [*days, days[0], None]], "date date")
    places = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "location string")
    df = quality.missing_keys(actual, dates, places)
    got = sorted((r.location, r.date) for r in df.collect())
    assert got == sorted((p, d) for p in "abc" for d in days if (p, d) not in have)
    plan = plan_of(df)
    assert "collect_set" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert quality.missing_keys(actual.limit(0), dates.limit(0), places).collect() == []


def test_a_hot_order_number(spark, retail):
    """A third of the lines on one order: dealt by order number alone or by all keys, joins give the same rows."""
    hot = {n: retail[n] for n in ("po_main", "po_child", "gr_main", "gr_child", "item", "hierarchy", "branch", "item_branch_stock")}
    number = lambda c: F.when(F.abs(F.hash(c)) % 3 == 0, F.lit("PO1")).otherwise(F.col(c))
    hot["po_child"] = hot["po_child"].withColumn("refno", number("refno"))
    hot["gr_child"] = hot["gr_child"].withColumn("porefno", number("porefno"))
    key, limit = "spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.autoBroadcastJoinThreshold"
    before = {k: spark.conf.get(k) for k in (key, limit, "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    counts = []
    try:
        spark.conf.set(limit, "-1")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20k")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
        for value in ("false", "true"):
            spark.conf.set(key, value)
            df = supply_chain.po_gr(hot, "1998-06-30")
            counts.append(df.groupBy(F.xxhash64(*[f"`{c}`" for c in df.columns]).alias("h")).count().agg(F.sum("count"), F.sum(F.col("h").cast("decimal(38,0)") * F.col("count"))).first()[:])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert counts[0] == counts[1] and counts[0][0] > 1000
