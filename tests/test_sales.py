"""Fan-out, misses and NULLs of the sales view on small literal tables."""

from datetime import date
from decimal import Decimal

import pytest

from shelfledger.plans import commercial, landlord, rolling_sales, sales

D1, D2 = date(2024, 12, 30), date(2025, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    return {
        "pos_panda": make(
            [(D1, "1001", "i1", "Item", "10", "1001", "1001A", "r1", 2.0, 20.0, 22.0, 1.0, 19.0, 5.0, 0),
             (D1, "1001", "i1", "Item", "10", "1001", "1001A", "r1", 1.0, 10.0, 11.0, 0.0, 10.0, 2.0, 0),
             (D1, "1001", "i1", "Item", "10", "1001", "1001A", "r2", 1.0, 10.0, 11.0, 0.0, 10.0, 2.0, 1),
             (D2, "1009", "zz", "Lost", None, None, None, "r3", 1.0, 5.0, 5.0, 0.0, 5.0, 1.0, 1)],
            "bizdate date, location string, itemcode string, description string, dept string, subdept string, category string,"
            "refno string, qty double, sumgrosssales double, amount_after_tax double, sumdisc double, amount double, cost double, consign int"),
        "pos_srp": make(
            [(D1, "1001", "i1", "PLU", 1.0, 5.0, None, 9.0, "s1"), (D2, "1001", "zz", "PLU", 1.0, 5.0, 1.0, None, "s2")],
            "date date, branch_code string, plu_number string, descriptor string, quantity double, item_paid_price double,"
            "discount double, staff_discount double, receipt_number string"),
        "pos_sap": make(
            [(D1, 1001, 77, 1.0, 10.0, 11.0, 1.0, 4.0, 6.0, 1.0, 10.0, 0.0, 0.0)],
            "yearmonthday date, site int, article int, sales_qty_sales_uom double, sales_exclude_tax double, sales_include_tax double,"
            "promotion_sales_discount_value double, cogs_l3 double, scan_margin_l4 double, outright_sales_qty_base_uom double,"
            "outright_sales_exclude_tax double, consignment_sales_qty_base_uom double, consignment_sales_exclude_tax double"),
        "item": make(
            [("i1", "i1", "Item", "10", "1001", "1001A", 0, 1.0), ("77", "i1", "Seven", "70", "7001", "7001A", 1, 1.0)],
            "itemcode string, itemlink string, description string, dept string, subdept string, category string, consign int, costmarginvalue double"),
        "hierarchy": make(
            [("10 ", "Dry", "1001", "Rice", "1001A", "Long"), ("70", "Serv", "7001", "Call", "7001A", "Card")],
            "dept string, deptdesc string, subdept string, subdeptdesc string, category string, categorydesc string"),
        "item_cost": make(
            [("i1", "1001", 1.0, 2.0), ("i1", "1001", 1.0, 2.0)], "itemcode string, branch string, fifocost double, lastcost double"),
        "budget": make(
            [("20241230", "1001", "1001", 100.0), ("20241230", "1001", "1001", 100.0), ("20241230", "1001", "1001", 300.0)],
            "date string, site string, category string, sales_budget double"),
        "vendor": make(
            [(1001, "S", 77, "a", "V", "N"), (1001, "S", 77, "b", "V", "N"), (1001, "S", 5, "a", "#", "-")],
            "site_key int, site string, article_key int, article string, primary_vendor_key string, primary_vendor string"),
        "branch": make([("1001", "Shop", "Giant Hyper")], "branch_code string, branch_name string, banner string"),
    }


def test_panda(tables):
    got = sales.panda_sales(tables).collect()
    assert len(got) == 5
    # the budget's two equal rows double a day's figures, its other amount is a row of its own
    out = {r.Budget: r for r in got if r.BizDate == D1 and r.Out_Qty}
    assert {b: (r.Qty, r.NetSales_ext_Tax, r.ScanMargin, r.TransCount, r.AvgBasket) for b, r in out.items()} == {
        100.0: (6.0, 58.0, 44.0, 1, 58.0), 300.0: (3.0, 29.0, 22.0, 1, 29.0)}
    row = out[300.0]
    assert (row.Division, row.Dept, row.Category, row.Parent_Item, row.LastCost) == ("1 - GROCERY", "10-Dry", "1001A-Long", True, 2.0)
    assert (row.WeekYear, row.Wk, row["Calendar Day Week"], row.Vendor) == ("53.2024", "Wk53", "01.Mon", None)
    lost = next(r for r in got if r.BizDate == D2)
    assert (lost.Division, lost.Dept, lost.Banner, lost.Budget, lost.Parent_Item) == ("9 - OTHER", None, None, 0.0, False)
    assert lost.Con_Qty == 1.0 and lost.Out_Qty == 0.0


def test_srp_net_price_is_clamped_but_margin_is_not(tables):
    got = {r.description + r.WeekYear + str(r.Budget): r for r in sales.srp_sales(tables).collect()}
    hot, lost = got["PLU53.2024300.0"], got["PLU1.20250.0"]
    assert (hot.Discount, hot.NetSales_ext_Tax, hot.ScanMargin, hot.Out_Qty) == (9.0, 0.0, -4.0, 1.0)
    assert (lost.NetSales_ext_Tax, lost.ScanMargin, lost.Out_Qty, lost.Con_Qty, lost.Division) == (4.0, 4.0, 0.0, 0.0, "9 - OTHER")
    assert lost.Parent_Item is None and lost.POSType == "SRP"


def test_sap_vendor_copies_double_the_sums(tables):
    (row,) = sales.sap_sales(tables).collect()
    assert (row.Qty, row.GrossSales_ext_Tax, row.Vendor, row.TransCount, row.Location) == (2.0, 22.0, "V-N", 0, "1001")


def test_union_pushes_the_date_filter_to_every_feed(tables, spark, tmp_path):
    stored = dict(tables)
    for name in ("pos_panda", "pos_srp", "pos_sap"):
        tables[name].write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    view = sales.unified_sales(stored).filter("BizDate = DATE'2024-12-30'")
    assert view.count() == 7
    plan = view._jdf.queryExecution().executedPlan().toString()
    for day in ("bizdate", "date", "yearmonthday"):
        assert f"EqualTo({day},2024-12-30)" in plan


def test_commercial_views(tables, spark):
    view = sales.unified_sales(tables)
    assert commercial.commercial(view, "1", "day", "2025-01-15").count() == 6
    assert commercial.commercial(view, "1", "day", "2025-02-15").count() == 0
    assert commercial.commercial(view, "1", "week", "2025-02-15").count() == 6
    assert commercial.commercial(view, "7", "month", "2030-01-01").count() == 1
    with pytest.raises(ValueError):
        commercial.horizon_filter("decade", "2025-01-01")
    made = commercial.create_views(view, ["vw_d1_day", "vw_d7_month"], "2025-01-15")
    assert made == ["vw_d1_day_tmp", "vw_d7_month_tmp"]
    assert [spark.table(v).count() for v in made] == [6, 1]


def test_division_is_cut_before_anything_is_summed(tables):
    view = sales.unified_sales(tables)
    for division in ("1", "7"):
        cut = commercial.division_sales(tables, division, "month", "2030-01-01")
        assert sorted(map(repr, cut.collect())) == sorted(map(repr, commercial.commercial(view, division, "month", "2030-01-01").collect()))
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Aggregate"):]
    assert plan.count("LeftSemi") == 2 and below.count("StartsWith(dept") >= 3


def test_stored_view(tables, spark):
    sales.unified_sales(tables).toDF(*[f"c{i}" if i not in (6, 11) else ("BizDate", "Dept")[i == 11] for i in range(37)]).write.mode("overwrite").saveAsTable("stored_sales")
    for horizon, rows in (("month", 1), ("day", 0), ("week", 0)):
        commercial.create_stored_view(spark, f"stored_{horizon}", "stored_sales", "7", horizon)
        assert spark.table(f"stored_{horizon}").count() == rows
    with pytest.raises(ValueError):
        commercial.create_stored_view(spark, "v", "stored_sales", "7'", "month")


def test_landlord_leaves_out_unknown_and_excluded_items(tables):
    (row,) = landlord.landlord_eod(tables, "1001", "SHOP", D1).collect()
    assert (row.EOD_ID, row.EOD_DATE, row.TOTAL_SALES, row.GROSS_SALES, row.TRAN_COUNT) == ("SHOP_20241230", "30-12-2024", 39.0, 40.0, 2)
    assert landlord.landlord_eod(tables, "1009", "SHOP").count() == 0
    assert landlord.landlord_eod(tables, "1001", "SHOP", excluded=("1",)).count() == 0


def test_rolling_sales_stand_without_a_sale(spark):
    make = spark.createDataFrame
    tables = {
        "stock_daily": make(
            [(date(2025, 1, 2), "1001", "i1", 2.0), (date(2025, 1, 2), "1001", "i1", 2.0), (date(2025, 2, 5), "1001", "i1", 2.0), (date(2025, 1, 3), "1001", "i2", 1.0)],
            "extract_day date, branch string, itemcode string, avgdailysales double"),
        "pos_group": make([(date(2025, 1, 1), "1001", "i1", 45.0), (date(2025, 1, 1), "1001", "i1", 45.0)], "bizdate date, location string, itemcode string, qty double"),
        "item": make([("i1", "30", "One")], "itemcode string, dept string, description string"),
        "branch": make([("1001", "x")], "branch_code string, banner string"),
    }
    got = {(str(r.BizDate), r.Itemcode): r for r in rolling_sales.rolling_sales(tables).collect()}
    assert len(got) == 3
    first, later, none = got["2025-01-01", "i1"], got["2025-02-04", "i1"], got["2025-01-02", "i2"]
    assert (first.Qty, first.ADS_RL30, first.ADS_RL90) == (90.0, 3.0, 1.0)
    assert (later.Qty, later.ADS_RL30, later.ADS_RL90) == (0.0, 0.0, 1.0)
    assert (none.Qty, none.Division, none.Dept) == (0.0, "9 - OTHER", None)
    extract = rolling_sales.daily_extract(tables, "2025-02-05", "3").collect()
    assert [(r.Itemcode, r.ADS_RL90) for r in extract] == [("i1", 1.0)]
