"""What is shuffled: wide rows by one key only, whatever the session's settings."""

import re
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from sampledata.queries import _ByName, all_queries
from sampledata.tables import RetailTables
from shelfledger.operators import lookups, receipts
from shelfledger.plans import adjustments, order_store, sales, supply_chain
from shelfledger.sources import versions

DATA = "/root/testdata/sf0.001"
COPARTITION, LIMIT = "spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def strange(spark):
    """A session without the library's settings, in which nothing is broadcast."""
    before = {k: spark.conf.get(k) for k in (COPARTITION, LIMIT)}
    spark.conf.set(COPARTITION, "true")
    spark.conf.set(LIMIT, "-1")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+", "", x) for x in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]


@pytest.mark.parametrize("name", ["rpt_po_gr", "rpt_po_gr_dc"])
def test_order_lines_are_shuffled_by_order_number_alone(strange, name):
    found = shuffles(all_queries()[name](strange, DATA))
    assert not [x for x in found if "," in x and ("POM_RefNo" in x or "POC_RefNo" in x or "PORefNo" in x)]
    assert "POM_Location" not in [x for x in found if x != "POM_Location"] and found.count("POM_Location") == 1


@pytest.mark.parametrize("name", ["rpt_possales_panda", "rpt_possales_srp", "rpt_possales_sap", "rpt_possales_union", "set_union_all"])
def test_a_feed_is_shuffled_by_item_once(strange, name):
    found = shuffles(all_queries()[name](strange, DATA))
    items = {"code", "itemcode", "plu_number"}
    assert items & set(found) and not [x for x in found if "," in x and items & set(x.split(", "))]


def test_receipts_by_order_are_those_that_name_one(spark, rows):
    main = [c for c in supply_chain.GR_HEADER]
    heads = [("G1", "first"), ("G1", "again"), ("G2", "two"), (None, "none"), ("G4", "unused")]
    lines = [("G1", "P1", 1), ("G1", "P1", 1), ("G1", "P2", 2), ("G2", None, 1), (None, "P1", 1), ("G3", "P3", 1), ("G2", "P1", 9)]
    tables = {
        "gr_main": spark.createDataFrame([(*h, *["x"] * (len(main) - 2)) for h in heads], ", ".join(f"{c} string" for c in ["refno", "name", *[c for c in main if c not in ("refno", "name")]])),
        "gr_child": spark.createDataFrame(lines, "refno string, porefno string, line int").select(
            "*", *[F.lit("y").alias(c) for c in supply_chain.GR_LINE if c not in ("refno", "porefno", "line")]),
    }
    got, want = supply_chain.receipts_by_order(tables), supply_chain.receipts(tables).filter("GRC_PORefNo IS NOT NULL")
    assert rows(got.select(*want.columns)) == rows(want) and got.count() == 7


def test_vendors_are_dealt_before_they_are_made_distinct(spark, rows):
    row = (1, " Site", 7, "Item ", " V1", "Vendor ")
    df = spark.createDataFrame([row, row, (1, "Site", 7, "Item", "V1", "Vendor"), (*row[:4], "#", "x"), (None, None, None, None, "V2", None)],
                               "site_key int, site string, article_key int, article string, primary_vendor_key string, primary_vendor string")
    got = lookups.current_vendor(df)
    assert shuffles(got) == ["Itemcode"]
    assert rows(got) == sorted([("1", "Site", "7", "Item", "V1", "Vendor")] * 2 + [(None, None, None, None, "V2", None)], key=repr)


def test_adjustments_meet_their_labels_last(spark):
    """The hierarchy is few rows out of many, so its estimated size is above the limit and its own below."""
    levels = spark.range(100_000).select(*[(F.col("id") % 3).cast("string").alias(c) for c in ("category", "group_desc", "deptdesc", "subdeptdesc", "categorydesc")]).distinct()
    texts = ("refno", "location", "dept", "subdept", "category", "itemcode", "description", "adjtype", "um")
    lines = spark.range(9_000).select(*[(F.col("id") % 5).cast("string").alias(c) for c in texts], *[F.lit(1.0).alias(c) for c in ("qty", "unitprice", "totalprice")])
    main = spark.createDataFrame([("1", date(2024, 1, 1), "r"), ("2", date(2024, 1, 2), "r")], "refno string, docdate date, reason string")
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, "100k")
    try:
        df = adjustments.adjustments({"adjust_main": main, "adjust_child": lines, "hierarchy": levels})
        assert not [x for x in shuffles(df) if "category" in x] and df.count() == 3_600
    finally:
        spark.conf.set(LIMIT, before)


def test_bitmaps_are_built_once(spark, rows):
    lines = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("b", None)], "site string, _receipt_no int")
    fine = receipts.kept(receipts.receipt_bitmaps(lines, ["site"]))
    got = receipts.receipt_counts(fine, ["site"])
    assert "bitmap_construct_agg" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == [("a", 2), ("b", 1)] and receipts.receipt_counts(fine, []).first()[0] == 2


def exchanges(df):
    """(keys, number of columns) of each shuffle of the plan."""
    found = []

    def walk(node):
        if node.nodeName() == "Exchange":
            keys = re.search(r"hashpartitioning\((.*), \d+\)", node.outputPartitioning().toString())
            found.append((re.sub(r"#\d+", "", keys[1]) if keys else "", node.output().size()))
        below = node.initialPlan() if node.nodeName() == "AdaptiveSparkPlan" else None
        for child in [below] if below is not None else [node.children().apply(i) for i in range(node.children().size())]:
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return found


@pytest.fixture
def retail(spark):
    return _ByName(RetailTables(spark, DATA))


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}


def test_order_lines_do_not_go_to_their_items(strange, retail):
    for report in (supply_chain.po_gr(retail, "1998-06-30"), supply_chain.po_gr_dc(retail)):
        wide = [keys for keys, n in exchanges(report) if n > 12]
        assert wide and not [k for k in wide if "tem" in k]


def test_stored_orders_do_not_go_to_the_stock(strange, retail, tmp_path):
    docs = order_store.store(retail, "apart", 8, str(tmp_path))
    assert docs.buckets == 8
    for report in (supply_chain.po_gr(retail, "1998-06-30", docs), supply_chain.po_gr_dc(retail, docs)):
        found = exchanges(report)
        assert found and not [x for x in found if x[1] > 4]


def test_known_orders_are_the_lines_with_labels_and_averages(spark, rows):
    def made(columns, values):
        names = list(columns)
        return spark.createDataFrame([tuple(v.get(c) for c in names) for v in values], ", ".join(f"{c} string" for c in names))

    tables = {
        "po_main": made(supply_chain.PO_HEADER, [
            {"refno": "P1", "location": "B1"}, {"refno": "P1", "location": "B2"}, {"refno": "P2"}, {"refno": "P3", "location": "B9"}, {"location": "B1"}]),
        "po_child": made(supply_chain.PO_LINE, [
            {"refno": "P1", "itemcode": "i1"}, {"refno": "P1", "itemcode": "i1"}, {"refno": "P1", "itemcode": "i2"}, {"refno": "P1"},
            {"refno": "P2", "itemcode": "i1"}, {"refno": "P3", "itemcode": "i9"}, {"itemcode": "i1"}]),
        "item": made(["itemcode", "dept", "subdept", "category"], [
            {"itemcode": i, "dept": "1", "subdept": "2", "category": "3"} for i in ("i1", "i2", "i2", None)]),
        "hierarchy": made(["dept", "deptdesc", "subdept", "subdeptdesc", "category", "categorydesc"], [
            {"dept": "1", "deptdesc": "D", "subdept": "2", "subdeptdesc": "S", "category": "3", "categorydesc": "C"}]),
        "branch": made(["branch_code", "branch_name", "banner"], [{"branch_code": "B1", "branch_name": "One"}]),
        "item_branch_stock": made(["itemcode", "branch", "ads"], [
            {"itemcode": "i1", "branch": "B1", "ads": "5"}, {"itemcode": "i1", "branch": "B1", "ads": "6"}, {"itemcode": "i1", "ads": "7"}]),
    }
    got = supply_chain.known_orders(tables, averages=True).select("POM_RefNo", "POM_Location", "POC_Itemcode", "Dept", "POM_branch", "IM_BS_ads")
    label = "1-D"
    assert rows(got) == sorted([
        *[("P1", "B1", "i1", label, "One", a) for a in ("5", "6")] * 2, *[("P1", "B2", "i1", label, None, None)] * 2,
        *[("P1", "B1", "i2", label, "One", None)] * 2, *[("P1", "B2", "i2", label, None, None)] * 2,
        ("P2", None, "i1", label, None, None)], key=repr)


@pytest.mark.parametrize("filtered", [True, False])
def test_rows_of_the_view_do_not_go_to_the_budgets(strange, retail, filtered):
    """But for receipt lines without an item code, a part of their own that is empty in the sample."""
    found = exchanges(sales.unified_sales(retail, filtered=filtered))
    assert len([x for x in found if "subdept" in x[0] and "," in x[0] and x[1] > 6]) == 1


def test_a_line_without_a_code_has_the_budget_of_its_sub_department(spark, retail):
    """Budgets are not of items; those of two rows count twice, as before."""
    day, texts = date(2024, 1, 5), ("site", "code", "dept", "subdept", "category", "description", "refno")
    lines = spark.createDataFrame(
        [(day, "1001", c, "10", s, "1001AA", "x", "r1", 2) for c, s in ((None, "1001"), (None, None), ("i1", "1001"), ("i1", "1002"), ("i1", "1009"))],
        "day date, " + ", ".join(f"{c} string" for c in texts) + ", n int")
    figures = ("qty", "sumgrosssales", "amount_after_tax", "sumdisc", "amount", "cost")
    tables = {n: retail[n] for n in ("item", "hierarchy", "item_cost", "vendor", "branch")}
    tables["pos_panda"] = lines.withColumnsRenamed({"day": "bizdate", "site": "location", "code": "itemcode"}).withColumns(
        {**{c: F.col("n").cast("decimal(12,2)") for c in figures}, "consign": F.lit(0)}).drop("n")
    tables["budget"] = spark.createDataFrame(
        [("20240105", "1001", "1001", 7), ("20240105", "1001", "1002", 8), ("20240105", "1001", "1002", 8), ("20240105", "1002", "1009", 9)],
        "date string, site string, category string, sales_budget int").withColumn("sales_budget", F.col("sales_budget").cast("decimal(18,4)"))
    for ahead in (False, True):
        view = sales.panda_sales(tables, sales.Lookups(tables, ahead))
        got = [(r.Itemcode, int(r.Budget), int(r.Qty)) for r in view.collect()]
        assert sorted(got, key=repr) == sorted([("i1", 7, 2), ("i1", 8, 4), ("i1", 0, 2), (None, 7, 2), (None, 0, 2)], key=repr)


def test_writes_leave_no_shuffle_behind(strange, retail, tmp_path):
    def left():
        return {f for f in shuffle_files(strange) - before if f.endswith(".data")}

    before = shuffle_files(strange)
    order_store.store(retail, "freed", 4, str(tmp_path / "orders"))
    rows = strange.range(100).select((F.col("id") % 3).alias("k"), "id")
    versions.reload([rows.repartition("id"), rows.repartition("k")], str(tmp_path / "table"), ["k"])
    kept = lookups.staged(rows.repartition("id"))
    until = time.time() + 20  # they are removed in the background
    while left() and time.time() < until:
        time.sleep(0.2)
    assert not left()
    assert kept.count() == 100 and versions.read(strange, str(tmp_path / "table")).count() == 200
    with pytest.raises(ValueError):
        versions.reload([rows, rows.withColumn("id", F.lit("x"))], str(tmp_path / "table"), ["k"])
