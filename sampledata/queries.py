"""One checked query per operator, over the whole sample tables.

Results are brought to plain types (``plain``), so that they compare with ``oracle.py``.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampledata import drops
from sampledata.tables import RetailTables
from shelfledger.functions import calendar, classify, horizons, measures
from shelfledger.operators import aggregates, columns, lookups, quality, receipts, rolling, unions
from shelfledger.plans import (
    adjustments, commercial, landlord, order_store, pos_ingest, rolling_sales, rolling_state, sales, sales_store, scripts,
    stock, store_list, supply_chain,
)
from shelfledger.session import scratch_path
from shelfledger.sources import export, pos_files, versions

AS_OF = "2001-06-30"
STOCK_DAYS = ["2000-03-15", "1999-11-03", "1998-07-21", "1997-02-10", "1996-05-05", "1995-12-30"]
STATUS_AS_OF = "1998-06-30"
SITE = "1005"
LATE_QUARTERS = ("1997-04-01", "1999-10-01")

Query = Callable[[RetailTables], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


class _ByName:
    """Mapping view of the retail tables, as the reports take it."""

    def __init__(self, t: RetailTables):
        self._t = t

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self._t, name)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, whole numbers as bigint, dates and booleans as text."""

    def cast(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return c.cast("bigint").alias(f.name)
        if isinstance(f.dataType, (T.DateType, T.BooleanType, T.NullType)):
            return c.cast("string").alias(f.name)
        return c

    return df.select(*[cast(f) for f in df.schema.fields])


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: plain(fn(RetailTables(spark, sf_dir)))

    return {name: bind(fn) for name, fn in QUERIES.items()}


# ---- sources ----


@query
def src_csv_thousands(t):
    rows = pos_files.read_pos_csv(t.spark, drops.flat_drop(t), drops.NUMERIC)
    return rows.select(*drops.COLUMNS)


@query
def src_tree_union(t):
    rows = pos_files.read_csv_tree(t.spark, drops.tree_drop(t) + "/new", drops.COLUMNS + ["remarks"], drops.NUMERIC)
    return rows.select(*drops.COLUMNS, "remarks")


@query
def src_filename_cols(t):
    rows = pos_files.read_csv_tree(t.spark, drops.tree_drop(t) + "/new", drops.COLUMNS, drops.NUMERIC)
    return pos_files.with_filename_columns(rows).select("location", "date", "plu_number", "total_qty_sales")


@query
def src_latest_file(t):
    rows = pos_ingest.read_drop(t.spark, drops.tree_drop(t), drops.COLUMNS, drops.NUMERIC, latest_only=True)
    return rows.groupBy("location", "date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("total_qty_sales").alias("total_qty_sales"),
        F.sum("total_margin").alias("total_margin"),
    )


@query
def src_bad_rows(t):
    rows = pos_files.read_pos_csv(t.spark, drops.flat_drop(t), drops.NUMERIC)
    return pos_files.reject_counts(rows, ["plu_number"])


# ---- sinks: written, read back ----


def _file_totals(t) -> DataFrame:
    return t.pos_srp.groupBy(drops.location_of("branch_code").alias("location"), "date").agg(
        F.sum("quantity").alias("total_qty_sales"), F.sum("item_paid_price").alias("total_sales")
    )


def _stored(t, path: str) -> DataFrame:
    return t.spark.read.parquet(path).withColumns(
        {"location": F.col("location").cast("string"), "date": F.col("date").cast("date")}
    )


@query
def snk_replace_by_location(t):
    """A wrong load of everything, then the right one over it."""
    path, totals = scratch_path(t.spark, "by-location"), _file_totals(t)
    versions.reload(totals.withColumn("total_sales", -F.col("total_sales")), path, ["location"])
    versions.reload(totals, path, ["location"])
    return versions.read(t.spark, path)


@query
def snk_append_aligned(t):
    """Rows with a column too many and one missing, appended to what is there."""
    path, totals = scratch_path(t.spark, "aligned"), _file_totals(t)
    totals.write.partitionBy("location").parquet(path)
    odd = totals.withColumn("Remarks", F.lit("late")).drop("total_sales")
    export.append_aligned(odd, path, totals.schema, ["location"])
    return _stored(t, path).select("location", "date", "total_qty_sales", "total_sales")


@query
def snk_reload_partition(t):
    """Everything loaded, then the first and third quarters loaded again twice with doubled sales, and
    the second quarters reloaded without rows."""
    path, totals = scratch_path(t.spark, "days"), _file_totals(t)
    periods = totals.groupBy("location", F.trunc("date", "QUARTER").alias("date")).agg(
        F.sum("total_qty_sales").alias("total_qty_sales"), F.sum("total_sales").alias("total_sales")
    )
    keys = ["location", "date"]
    versions.reload(periods, path, keys)
    again = periods.filter(F.quarter("date") % 2 == 1).withColumn("total_sales", F.col("total_sales") * 2)
    versions.reload(again, path, keys)
    versions.reload(again, path, keys, periods.filter(F.quarter("date") <= 2))
    return versions.read(t.spark, path)


SLICE = 5000


def _slice_input(t) -> DataFrame:
    """Has runs of equal rows."""
    return t.pos_srp.select("branch_code", "date", "quantity")


@query
def snk_sliced_csv(t):
    path = scratch_path(t.spark, "slices")
    export.write_slices(_slice_input(t), path, SLICE, ["branch_code", "date"])
    return t.spark.read.option("header", True).schema(
        "branch_code string, date date, quantity double, file_ver int"
    ).csv(path)


@query
def snk_txt_slices(t):
    path = scratch_path(t.spark, "slices-txt")
    export.write_slices(_slice_input(t), path, SLICE, ["date", "branch_code"], suffix=".txt")
    rows = t.spark.read.option("header", True).option("pathGlobFilter", "*.txt").schema(
        "branch_code string, date date, quantity double, file_ver int"
    ).csv(path)
    return rows


@query
def snk_fixed_width(t):
    path = scratch_path(t.spark, "fixed")
    rows = t.pos_srp.select("branch_code", "plu_number", "date", F.col("quantity").cast("int").alias("quantity"))
    export.write_fixed_width(rows, path, SLICE, ["date", "branch_code", "plu_number", "quantity"])
    return t.spark.read.text(path).select("file_ver", F.col("value").alias("line"))


@query
def snk_create_view(t):
    """Session views of two divisions over stored sales, and a catalog view of a third."""
    path = scratch_path(t.spark, "sales")
    sales.unified_sales(_ByName(t)).select("Dept", "BizDate", "Qty").write.parquet(path)
    stored = t.spark.read.parquet(path)
    views = [t.spark.table(v) for v in commercial.create_views(stored, ["vw_d1_day", "vw_d2_week"], AS_OF)]
    commercial.create_stored_view(t.spark, "vw_d3_month", f"parquet.`{path}`", "3", "month")
    return reduce(DataFrame.unionAll, [*views, t.spark.table("vw_d3_month")]).groupBy("Dept").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("Qty").alias("Qty")
    )


def _script_folder(t) -> str:
    """Two scripts with parameters, written where Spark reads them; the table is a session view."""
    t.item.createOrReplaceTempView("script_items")
    folder = scratch_path(t.spark, "scripts")
    texts = {
        "by_dept": "SELECT dept, count(*) AS n_items FROM script_items WHERE dept LIKE :prefix GROUP BY dept",
        "dearest": "SELECT dept, max(fifocost) AS fifocost FROM script_items WHERE dept LIKE :prefix GROUP BY dept",
    }
    for name, text in texts.items():
        system, path = export._hadoop(t.spark, f"{folder}/{name}.sql")
        stream = system.create(path)
        stream.write(bytearray(text.encode()))
        stream.close()
    return folder


@query
def src_script_params(t):
    t.item.createOrReplaceTempView("script_items")
    text = "SELECT itemcode, dept, fifocost FROM script_items WHERE dept LIKE :prefix AND fifocost >= :least"
    return scripts.run_script(t.spark, text, prefix="3%", least=10)


@query
def src_script_folder(t):
    reports = scripts.run_folder(t.spark, _script_folder(t), prefix="2%")
    return reports["by_dept"].join(reports["dearest"], "dept")


@query
def snk_calendar_path(t):
    """Departments exported for a day, twice; the second run replaces the first."""
    path = scratch_path(t.spark, "calendar")
    rows = t.pos_panda.groupBy(F.col("dept").alias("Dept"), "itemcode").agg(F.sum("qty").alias("qty"))
    rows = rows.filter(classify.export_division(F.col("Dept")).isNotNull())
    export.write_calendar_path(rows.withColumn("qty", -F.col("qty")), path, AS_OF)
    export.write_calendar_path(rows, path, AS_OF)
    return t.spark.read.option("header", True).schema(
        "Dept string, itemcode string, qty double, year int, month string, division string"
    ).csv(path)


# ---- projections, filters ----


@query
def prj_snake_case(t):
    odd = drops.file_rows(t).select(*drops.HEADER).withColumnRenamed("Descriptor", " Item-Descriptor ")
    return columns.snake_case_columns(odd)


@query
def flt_like_prefix(t):
    return t.item.filter(horizons.dept_starts_with(F.col("dept"), "1", "3")).select("itemcode", "dept")


@query
def flt_not_like(t):
    dept = F.when(F.col("consign") == 0, F.col("dept"))
    rows = t.item.withColumn("dept", dept)
    return rows.filter(~F.col("dept").startswith("7") & ~F.col("dept").startswith("8")).select("itemcode", "dept")


@query
def flt_yesterday(t):
    day = F.to_date(F.lit(STATUS_AS_OF))
    return t.pos_all.filter(horizons.yesterday(F.col("bizdate"), day)).select("bizdate", "location", "itemcode", "qty")


@query
def flt_prev_year_to_date(t):
    rows = t.pos_panda.filter(horizons.previous_year_to_date(F.col("bizdate"), AS_OF))
    return rows.groupBy("bizdate").agg(F.sum("qty").alias("qty"))


@query
def flt_prev_month_to_date(t):
    rows = t.pos_panda.filter(horizons.previous_month_to_date(F.col("bizdate"), AS_OF))
    return rows.groupBy("bizdate").agg(F.sum("qty").alias("qty"))


# ---- joins ----


@query
def join_header_lines(t):
    lines = t.po_child.withColumnRenamed("refno", "line_refno")
    return lookups.header_lines(t.po_main, lines, ("refno", "line_refno")).select(
        "refno", "podate", "line", "itemcode", "qty", "totalprice"
    )


@query
def join_item_hierarchy(t):
    items = t.item.select("itemcode", "dept", "subdept", "category")
    return lookups.item_hierarchy(items, t.hierarchy).select(
        "itemcode", "dept", "deptdesc", "subdept", "subdeptdesc", "category", "categorydesc"
    )


@query
def join_left_composite(t):
    sold = t.pos_panda.select("bizdate", "location", "itemcode", "qty")
    cost = t.item_cost.select(F.col("itemcode").alias("c_item"), "branch", "fifocost", "lastcost")
    return lookups.lookup(sold, cost, [("itemcode", "c_item"), ("location", "branch")])


@query
def join_shifted_date(t):
    stock_days = t.stock_daily.select("extract_day", "branch", "itemcode", "qoh")
    sold = t.pos_group.groupBy("bizdate", "location", F.col("itemcode").alias("sold_item")).agg(F.sum("qty").alias("qty"))
    return lookups.join_shifted(
        stock_days, sold, [("branch", "location"), ("itemcode", "sold_item")], ("extract_day", "bizdate"), 1
    )


@query
def join_code_prefix(t):
    ft = t.po_alloc_ft.select("all_ft_po_refno", "all_ft_po_line", "all_ft_loc_code", "all_ft_itemcode")
    req = supply_chain.requests(_ByName(t)).select("DCR_cross_ref", "DCR_LocTo", "DCRC_Itemcode", "DCRC_Qty")
    return lookups.join_prefix(
        ft, req, ("all_ft_loc_code", "DCR_LocTo"), 4,
        [("all_ft_po_refno", "DCR_cross_ref"), ("all_ft_itemcode", "DCRC_Itemcode")],
    ).select("all_ft_po_refno", "all_ft_po_line", "all_ft_loc_code", "DCR_LocTo", "DCRC_Qty")


@query
def join_left_suffix(t):
    return lookups.left_join_suffix(t.store_list, t.location_list, "site", ("_excel", "_sheet"))


# ---- aggregates ----


@query
def agg_sum_measures(t):
    return t.pos_panda.groupBy("bizdate", "location").agg(
        F.sum("qty").alias("Qty"), F.sum("sumgrosssales").alias("GrossSales"),
        F.sum("amount_after_tax").alias("Sales_with_Tax"), F.sum("sumdisc").alias("Discount"),
        F.sum("amount").alias("NetSales"), F.sum("cost").alias("Cost"),
        (F.sum("amount") - F.sum("cost")).alias("ScanMargin"),
    )


@query
def agg_distinct_receipts(t):
    return t.pos_panda.groupBy("location").agg(F.count_distinct("refno").alias("TransCount"))


@query
def agg_consign_split(t):
    return t.pos_panda.groupBy("location", "dept").agg(
        *measures.consign_split(F.col("consign"), F.col("qty"), F.col("amount"))
    )


@query
def agg_avg_basket(t):
    return t.pos_panda.groupBy("location").agg(
        measures.safe_ratio(F.sum("amount"), F.count_distinct("refno")).alias("AvgBasket")
    )


@query
def agg_receipt_grains(t):
    """Receipts and average basket by location and month and by department, all from one set of bitmaps."""
    lines = t.pos_panda.select("bizdate", "location", "dept", "refno", "amount")
    numbers = receipts.receipt_numbers(lines, "refno", ["bizdate", "location"])
    keys = ["bizdate", "location", "dept"]
    fine = receipts.kept(receipts.receipt_bitmaps(lines.join(numbers, "refno", "left"), keys))
    fine = fine.withColumn("month", F.trunc("bizdate", "MONTH"))
    sums = lines.groupBy(*keys).agg(F.sum("amount").alias("amount")).withColumn("month", F.trunc("bizdate", "MONTH"))

    def grain(*by: str) -> DataFrame:
        both = receipts.receipt_counts(fine, by).join(sums.groupBy(*by).agg(F.sum("amount").alias("amount")), list(by))
        have = lambda c: F.col(c) if c in by else F.lit(None)
        return both.select(
            *[have(c).cast("date" if c == "month" else "string").alias(c) for c in ("month", "location", "dept")],
            "TransCount", measures.safe_ratio(F.col("amount"), F.col("TransCount")).alias("AvgBasket"),
        )

    return grain("month", "location").unionByName(grain("dept"))


@query
def agg_net_clamp(t):
    sums = [F.sum(c) for c in ("item_paid_price", "discount", "staff_discount")]
    return t.pos_srp.groupBy("date", "branch_code", "plu_number").agg(
        measures.total_discount(*sums[1:]).alias("Discount"), measures.net_price(*sums).alias("NetPrice")
    )


@query
def agg_zero_filled(t):
    sold = t.pos_group.select("bizdate", "location", F.col("itemcode").alias("sold_item"), "qty")
    rows = lookups.join_shifted(
        t.stock_daily.select("extract_day", "branch", "itemcode"), sold,
        [("branch", "location"), ("itemcode", "sold_item")], ("extract_day", "bizdate"), 1,
    )
    return rows.groupBy("branch", "itemcode", "extract_day").agg(measures.zero_sum(F.col("qty")).alias("qty"))


@query
def agg_daily_totals(t):
    return aggregates.daily_totals(t.pos_srp, "date", ["quantity", "item_paid_price", "discount"])


@query
def agg_dedup_first(t):
    rows = t.pos_srp.select("branch_code", "plu_number", "date", "receipt_number", "quantity")
    return aggregates.first_by_priority(rows, ["branch_code", "plu_number"], ["date", "receipt_number"])


# ---- windows ----


def _rolling(t, days: int) -> DataFrame:
    daily = t.pos_all.groupBy("location", "itemcode", "bizdate").agg(F.sum("qty").alias("qty"))
    return rolling.rolling_daily_average(daily, ["location", "itemcode"], "bizdate", "qty", days)


@query
def win_ads_30(t):
    return _rolling(t, 30)


@query
def win_ads_90(t):
    return _rolling(t, 90)


# ---- unions ----


@query
def set_union_all(t):
    names = _ByName(t)
    feeds = [feed(names) for feed in (sales.panda_sales, sales.srp_sales, sales.sap_sales)]
    return unions.union_sales(*feeds).groupBy("POSType", "BizDate").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("Qty").alias("Qty"), F.sum("TransCount").alias("TransCount"),
        F.count("Parent_Item").alias("n_parent_known"),
    )


@query
def set_union_by_name(t):
    return unions.union_by_name(t.store_list, t.location_list)


# ---- calendar ----


def _days(t) -> DataFrame:
    lines = t.raw("lineitem").select(F.to_date("l_shipdate").alias("d"))
    return lines.union(t.raw("orders").select(F.to_date("o_orderdate"))).distinct()


D = F.col


@query
def cal_labels(t):
    d = D("d")
    return _days(t).select(
        "d", calendar.calendar_year(d).alias("y"), calendar.calendar_month(d).alias("m"),
        calendar.calendar_day_month(d).alias("dm"), calendar.month_label(d).alias("label"),
    )


@query
def cal_week_year(t):
    d = D("d")
    return _days(t).select(
        "d", calendar.week_monday(d).alias("week_monday"), calendar.week_year(d).alias("WeekYear"), calendar.wk(d).alias("Wk")
    )


@query
def cal_day_week(t):
    return _days(t).select("d", calendar.calendar_day_week(D("d")).alias("day_week"))


@query
def cal_delivery(t):
    d = D("d")
    return _days(t).select(
        "d", calendar.delivery_month(d).alias("DeliveryMonth"), calendar.calendar_wk_num(d).alias("Calendar_WkNum")
    )


@query
def cal_parse(t):
    return t.budget.select("site", "category", "date", F.to_date("date", "yyyyMMdd").alias("parsed"), "sales_budget")


@query
def cal_dimension(t):
    return calendar.calendar_dim(t.pos_panda, "bizdate")


# ---- classifications ----


@query
def cls_division(t):
    rows = t.item.withColumn("d", F.when(F.col("consign") == 0, F.col("dept")))
    return rows.select("itemcode", classify.division(D("d")).alias("Division"), classify.export_division(D("d")).alias("Export"))


@query
def cls_order_type(t):
    return t.po_main.select("refno", classify.order_type(D("order_type")).alias("OrderType"))


def _po_receipts(t) -> DataFrame:
    names = _ByName(t)
    po, gr = supply_chain.order_lines(names), supply_chain.receipts(names)
    return po.join(
        gr,
        (po["POM_RefNo"] == gr["GRC_PORefNo"]) & (po["POC_Itemcode"] == gr["GRC_Itemcode"])
        & (po["POC_PriceType"] == gr["GRC_Price_Type"]),
        "left",
    )


@query
def cls_delivery_status(t):
    status = classify.delivery_status(
        D("GRC_Qty"), D("GRC_POQty"), D("POC_Qty"), D("POM_ExpiryDate"), horizons.as_date(STATUS_AS_OF)
    )
    return _po_receipts(t).select("POM_RefNo", "POC_Line", "POC_Itemcode", "GRC_Line", status.alias("Delivery_Status"))


@query
def cls_adjust_sign(t):
    kind = D("adjtype")
    return t.adjust_child.select(
        "refno", "itemcode", "adjtype", classify.signed(kind, D("qty")).alias("qty"),
        classify.signed(kind, D("unitprice")).alias("unitprice"), classify.signed(kind, D("totalprice")).alias("totalprice"),
    )


@query
def cls_final_value(t):
    return _po_receipts(t).select(
        "POM_RefNo", "POC_Line", "POC_Itemcode", "GRC_Line",
        classify.non_ibt(D("GRM_IBT"), D("GRC_TotalPrice")).alias("gr_value"),
        classify.non_ibt(D("POM_IBT"), D("POC_TotalPrice")).alias("po_value"),
    )


@query
def cls_completion(t):
    return _po_receipts(t).select(
        "POM_RefNo", "POC_Line", "POC_Itemcode", "GRC_Line",
        classify.completion(D("GRC_Qty"), D("POC_Qty")).alias("completion"),
        classify.completion(D("GRC_Qty"), D("POC_Qty") - D("POC_Qty")).alias("nothing_ordered"),
    )


@query
def cls_parent_item(t):
    link = F.when(D("consign") == 0, D("itemlink"))
    return t.item.select("itemcode", classify.is_parent(link, D("itemcode")).alias("Parent_Item"))


@query
def cls_banner(t):
    return t.location_list.select("site", "site_name", classify.normalise_banner(D("banner"), D("site_name")).alias("banner"))


@query
def cls_code_label(t):
    desc = F.when(D("consign") == 0, D("description"))
    return t.item.select("itemcode", classify.code_label(D("itemcode"), desc).alias("label"))


@query
def cls_vendor(t):
    return lookups.current_vendor(t.vendor)


@query
def cls_priority_vendor(t):
    return lookups.priority_vendor(t.item_branch_stock, t.supplier_code, t.item_supplier)


# ---- built-in functions as the reports use them ----


@query
def fn_string(t):
    week = calendar.week_year(D("docdate"))
    return t.adjust_main.select(
        "refno", F.concat(F.lit("Yr"), F.year("docdate")).alias("concat_int"),
        F.trim(F.concat(F.lit("  "), D("reason"), F.lit(" "))).alias("trimmed"),
        F.lpad(D("refno"), 4, "0").alias("padded"), F.split(week, "[.]")[0].alias("week"),
        F.substring("reason", 1, 4).alias("head"),
    )


@query
def fn_math(t):
    x = D("totalprice") * F.lit("0.125").cast("decimal(3,3)")
    return t.adjust_child.groupBy("refno", "itemcode", "totalprice").count().select(
        "refno", "itemcode", F.round(x, 2).alias("half_up"), F.bround(x, 2).alias("half_even"),
        F.expr("mod(cast(refno as bigint), 7)").alias("modulo"),
    )


@query
def fn_null(t):
    return t.pos_srp.select(
        "receipt_number", "plu_number", F.coalesce("staff_discount", F.lit(0)).alias("staff"),
        F.expr("ifnull(staff_discount, discount)").alias("either"),
    )


# ---- data quality ----


@query
def dq_reconcile(t):
    expected = t.expected_totals.withColumnRenamed("total_sales_qty", "total_qty_sales")
    actual = t.pos_srp.groupBy("date").agg(
        F.sum("quantity").alias("total_qty_sales"), F.sum("item_paid_price").alias("total_sales"),
        F.sum("discount").alias("total_margin"),
    )
    return quality.reconcile(expected, actual, "date", ["total_qty_sales", "total_sales", "total_margin"])


def _located(t) -> DataFrame:
    return t.pos_srp.select(drops.location_of("branch_code").alias("location"), "date", "quantity")


@query
def dq_missing_keys(t):
    dates = t.pos_panda.select(F.col("bizdate").alias("date"))
    locations = t.branch.select(drops.location_of("branch_code").alias("location"))
    return quality.missing_keys(_located(t), dates, locations)


@query
def dq_verify_load(t):
    wanted = t.pos_panda.select(drops.location_of("location").alias("location"), F.col("bizdate").alias("date")).distinct()
    return quality.verify_load(wanted, _located(t), ["location", "date"], "quantity")


@query
def dq_duplicates(t):
    keys = ["branch_code", "plu_number", "date"]
    return quality.duplicate_counts(t.pos_srp, [keys[:1], keys[:2], keys])


@query
def dq_nonunique(t):
    return quality.non_unique(t.pos_srp, ["plu_number", "branch_code"])


# ---- reports ----


@query
def rpt_possales_panda(t):
    return sales.panda_sales(_ByName(t))


@query
def rpt_possales_srp(t):
    return unions.union_sales(sales.srp_sales(_ByName(t)))


@query
def rpt_possales_sap(t):
    return unions.union_sales(sales.sap_sales(_ByName(t)))


@query
def rpt_possales_union(t):
    return sales.unified_sales(_ByName(t))


@query
def rpt_possales_stored(t):
    """The view stored by quarter while the sap feed lacks two quarters, then refreshed for their days alone."""
    path, names = scratch_path(t.spark, "view"), _ByName(t)
    late = F.trunc("yearmonthday", "QUARTER").isin(*[datetime.date.fromisoformat(d) for d in LATE_QUARTERS])
    tables = {n: names[n] for n in ("pos_panda", "pos_srp", "pos_sap", "item", "hierarchy", "item_cost", "budget", "vendor", "branch")}
    sales_store.refresh(t.spark, tables | {"pos_sap": t.pos_sap.filter(~late)}, path, length="QUARTER")
    days = t.pos_sap.filter(late).select(F.col("yearmonthday").alias("day")).distinct()
    sales_store.refresh(t.spark, tables, path, days, "QUARTER")
    return sales_store.read(t.spark, path)


@query
def rpt_rolling_stored(t):
    """Three days added one by one to the sums of the day before."""
    path, last = scratch_path(t.spark, "rolling"), datetime.date.fromisoformat(AS_OF)
    for back in (4, 3, 2, 1):
        rolling_state.advance(t.spark, path, _ByName(t), last - datetime.timedelta(days=back))
    return rolling_state.read(t.spark, path)


@query
def rpt_rolling_ads(t):
    return rolling_sales.rolling_sales(_ByName(t))


@query
def rpt_adjustments(t):
    return adjustments.adjustments(_ByName(t))


@query
def rpt_po_gr(t):
    return supply_chain.po_gr(_ByName(t), STATUS_AS_OF)


@query
def rpt_po_gr_dc(t):
    return supply_chain.po_gr_dc(_ByName(t))


@query
def rpt_po_gr_stored(t):
    """Orders, receipts and allocations stored in buckets of the order number, then reported."""
    path = scratch_path(t.spark, "orders")
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    docs = order_store.store(_ByName(t), path.rsplit("/", 1)[1].replace("-", "_"), buckets, path)
    return supply_chain.po_gr(_ByName(t), STATUS_AS_OF, docs)


@query
def rpt_po_gr_dc_stored(t):
    path = scratch_path(t.spark, "orders")
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    docs = order_store.store(_ByName(t), path.rsplit("/", 1)[1].replace("-", "_"), buckets, path)
    return supply_chain.po_gr_dc(_ByName(t), docs)


@query
def rpt_itemmaster_stock(t):
    return stock.itemmaster_stock(_ByName(t), "Hyper", active=True)


@query
def rpt_itemmaster_inactive(t):
    return stock.itemmaster_stock(_ByName(t), "Mini", active=False)


@query
def rpt_stock_take(t):
    takes = [stock.stock_take(_ByName(t), "Super", day) for day in STOCK_DAYS]
    return reduce(DataFrame.unionAll, takes)


@query
def rpt_landlord_eod(t):
    return landlord.landlord_eod(_ByName(t), SITE, "CORNER")


@query
def rpt_daily_extract(t):
    return rolling_sales.daily_extract(_ByName(t), AS_OF, *"123456")


@query
def rpt_commercial_day(t):
    return commercial.division_sales(_ByName(t), "1", "day", AS_OF)


@query
def rpt_commercial_week(t):
    return commercial.division_sales(_ByName(t), "2", "week", AS_OF)


@query
def rpt_commercial_month(t):
    return commercial.division_sales(_ByName(t), "3", "month", AS_OF)


@query
def rpt_store_list(t):
    return store_list.consolidate(t.store_list, t.location_list)


@query
def rpt_store_list_combined(t):
    return store_list.combined(t.store_list, t.location_list)


@query
def rpt_pos_ingest(t):
    """A load with a day too many at every location, then the drop, which does not have that day."""
    target = scratch_path(t.spark, "ingested")
    stale = t.pos_srp.select(
        *[F.lit("0").cast("string" if c not in drops.NUMERIC else pos_files.NUMBER).alias(c) for c in drops.COLUMNS],
        drops.location_of("branch_code").alias("location"), F.lit("1900-01-01").cast("date").alias("date"),
    ).distinct()
    versions.reload(stale, target, pos_ingest.KEYS)
    pos_ingest.ingest(t.spark, drops.tree_drop(t), target, drops.COLUMNS, drops.NUMERIC)
    return versions.read(t.spark, target)


@query
def rpt_backfill(t):
    """Only the outdated first-quarter files are loaded; whatever is missing is then repaired."""
    root, target = drops.tree_drop(t), scratch_path(t.spark, "repaired")
    pos_ingest.ingest(t.spark, root + "/old", target, drops.COLUMNS, drops.NUMERIC)
    dates = t.pos_srp.select(F.trunc("date", "QUARTER").alias("date"))
    locations = t.pos_srp.select(drops.location_of("branch_code").alias("location"))
    missing = quality.missing_keys(versions.read(t.spark, target), dates, locations)
    status = pos_ingest.backfill(
        t.spark, root + "/new", target, missing, drops.COLUMNS, drops.NUMERIC, "total_qty_sales"
    )
    totals = versions.read(t.spark, target).groupBy("location", "date").agg(F.sum("total_qty_sales").alias("total_qty_sales"))
    return totals.join(status, ["location", "date"], "left")
