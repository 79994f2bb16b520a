"""The retail tables, derived from the driver's star-schema parquet files.

Every table is a lazy expression over whole input tables; ``oracle.py`` holds the same
expressions in SQL. Rules such as ``% 50`` below give rows odd values (misses, duplicates,
NULLs). Some leave rows out on purpose, so that joins miss: each feed has the lines of one return
flag, and allocations, requests, receipts, budgets and costs lack some keys.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def money(c: str) -> Column:
    return F.col(c).cast("decimal(12,2)")


def rate(c: str) -> Column:
    return F.col(c).cast("decimal(4,2)")


def dec(value: str) -> Column:
    whole, _, part = value.partition(".")
    return F.lit(value).cast(f"decimal({len(whole.lstrip('0')) + len(part)},{len(part)})")


def branch_of(key: str) -> Column:
    return text(F.col(key) + 1000)


class RetailTables:
    """One attribute per retail table."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def _lines(self) -> DataFrame:
        return self._priced(self.raw("lineitem"))

    @staticmethod
    def _priced(lines: DataFrame) -> DataFrame:
        ext, disc, tax = money("l_extendedprice"), rate("l_discount"), rate("l_tax")
        return lines.select(
            "*",
            F.to_date("l_shipdate").alias("day"),
            ext.alias("ext"),
            (ext * disc).alias("disc_amount"),
            (ext * (1 - disc)).alias("net"),
            (ext * (1 - disc) * (1 + tax)).alias("net_tax"),
        )

    @cached_property
    def item(self) -> DataFrame:
        dept = F.concat(text(F.col("p_partkey") % 9 + 1), F.lit("0"))
        subdept = F.concat(dept, F.lpad(F.substring("p_brand", 7, 2), 2, "0"))
        retail = money("p_retailprice")
        return self.raw("part").select(
            text("p_partkey").alias("itemcode"),
            text(F.col("p_partkey") - F.col("p_partkey") % 4).alias("itemlink"),
            F.col("p_name").alias("description"),
            dept.alias("dept"),
            subdept.alias("subdept"),
            F.concat(subdept, F.substring("p_type", 1, 2)).alias("category"),
            F.when(F.col("p_size") % 5 == 0, 1).otherwise(0).alias("consign"),
            (F.col("p_size") % 3).alias("costmarginvalue"),
            (retail * dec("0.70")).alias("averagecost"),
            (retail * dec("0.68")).alias("fifocost"),
            (retail * dec("0.72")).alias("lastcost"),
        )

    @cached_property
    def hierarchy(self) -> DataFrame:
        """Codes of department 90 carry blanks, so only trimmed joins find them."""
        spaced = F.col("dept") == "90"
        return (
            self.item.select("dept", "subdept", "category")
            .distinct()
            .select(
                F.when(spaced, F.concat("dept", F.lit(" "))).otherwise(F.col("dept")).alias("dept"),
                F.concat(F.lit("D"), "dept").alias("deptdesc"),
                F.when(spaced, F.concat(F.lit(" "), "subdept")).otherwise(F.col("subdept")).alias("subdept"),
                F.concat(F.lit("S"), "subdept").alias("subdeptdesc"),
                F.when(spaced, F.concat("category", F.lit(" "))).otherwise(F.col("category")).alias("category"),
                F.concat(F.lit("C"), "category").alias("categorydesc"),
                F.concat(F.lit("G"), F.substring("dept", 1, 1)).alias("group_desc"),
            )
        )

    @cached_property
    def _suppliers(self) -> DataFrame:
        region = F.col("n_regionkey")
        banner = (
            F.when(region == 0, "Giant Hyper").when(region == 1, "Giant Super")
            .when(region == 2, "Upscale").when(region == 3, "Giant Mini")
            .otherwise("Distribution Centre")
        )
        nation = self.raw("nation")
        supplier = self.raw("supplier")
        return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).withColumn("banner", banner)

    @cached_property
    def branch(self) -> DataFrame:
        return self._suppliers.select(
            branch_of("s_suppkey").alias("branch_code"), F.col("s_name").alias("branch_name"), "banner"
        )

    @cached_property
    def _item_lines(self) -> DataFrame:
        """Line items with the hierarchy codes of their item."""
        lines, item = self._lines, self.item.drop("fifocost", "lastcost", "averagecost")
        return lines.withColumn("_code", text("l_partkey")).join(item, F.col("_code") == item.itemcode)

    @cached_property
    def pos_panda(self) -> DataFrame:
        return self._item_lines.filter("l_returnflag = 'A'").select(
            F.col("day").alias("bizdate"), branch_of("l_suppkey").alias("location"), "itemcode",
            "description", "dept", "subdept", "category", text("l_orderkey").alias("refno"),
            F.col("l_quantity").alias("qty"), F.col("ext").alias("sumgrosssales"),
            F.col("net_tax").alias("amount_after_tax"), F.col("disc_amount").alias("sumdisc"),
            F.col("net").alias("amount"), (F.col("ext") * dec("0.75")).alias("cost"), "consign",
        )

    @cached_property
    def pos_group(self) -> DataFrame:
        """Panda sales by item group; gives the rolling windows long series."""
        return self._lines.filter("l_returnflag = 'A'").select(
            F.col("day").alias("bizdate"), branch_of("l_suppkey").alias("location"),
            text(F.col("l_partkey") % 9).alias("itemcode"), F.col("l_quantity").alias("qty"),
        )

    @cached_property
    def pos_all(self) -> DataFrame:
        """All lines by item group."""
        return self._lines.select(
            F.col("day").alias("bizdate"), branch_of("l_suppkey").alias("location"),
            text(F.col("l_partkey") % 9).alias("itemcode"), F.col("l_quantity").alias("qty"),
        )

    @cached_property
    def pos_srp(self) -> DataFrame:
        part, line, ext = F.col("l_partkey"), F.col("l_linenumber"), F.col("ext")
        staff = F.when(line == 6, ext * dec("1.50")).when(line % 2 == 0, ext * dec("0.01"))
        return self._lines.filter("l_returnflag = 'N'").select(
            F.col("day").alias("date"), branch_of("l_suppkey").alias("branch_code"),
            F.when(part % 50 == 49, F.concat(F.lit("X"), text(part))).otherwise(text(part)).alias("plu_number"),
            F.concat(F.lit("PLU "), text(part)).alias("descriptor"),
            F.col("l_quantity").alias("quantity"), ext.alias("item_paid_price"),
            F.col("disc_amount").alias("discount"), staff.alias("staff_discount"),
            text("l_orderkey").alias("receipt_number"),
        )

    @cached_property
    def pos_sap(self) -> DataFrame:
        """Lines are shuffled as they are read: sums of lines, nearly as many, would be three times as wide."""
        consigned = F.col("l_partkey") % 5 == 0
        keys = {
            "yearmonthday": F.to_date("l_shipdate"),
            "site": (F.col("l_suppkey") + 1000).cast("int"),
            "article": F.col("l_partkey").cast("int"),
        }
        lines = self.raw("lineitem").filter("l_returnflag = 'R'").withColumns(keys).repartition(*keys)

        def total(x: Column, where: Column | None = None) -> Column:
            return F.sum(x if where is None else F.when(where, x).otherwise(F.lit(0)))

        qty, net = F.col("l_quantity"), F.col("net")
        return (
            self._priced(lines)
            .groupBy(*keys)
            .agg(
                total(qty).alias("sales_qty_sales_uom"),
                total(net).alias("sales_exclude_tax"),
                total(F.col("net_tax")).alias("sales_include_tax"),
                total(F.col("disc_amount")).alias("promotion_sales_discount_value"),
                total(F.col("ext") * dec("0.75")).alias("cogs_l3"),
                total(net - F.col("ext") * dec("0.75")).alias("scan_margin_l4"),
                total(qty, ~consigned).alias("outright_sales_qty_base_uom"),
                total(net, ~consigned).alias("outright_sales_exclude_tax"),
                total(qty, consigned).alias("consignment_sales_qty_base_uom"),
                total(net, consigned).alias("consignment_sales_exclude_tax"),
            )
        )

    @cached_property
    def budget(self) -> DataFrame:
        """Day budgets per site and sub-department.

        Every third (site, day) has none, some rows come twice, some with a second amount.
        """
        ending, amount = F.col("l_suppkey") % 10, F.col("sales_budget")
        rows = (
            F.when(ending == 3, F.array(amount, amount))
            .when(ending == 7, F.array(amount, amount + 1))
            .otherwise(F.array(amount))
        )
        return (
            self._item_lines.filter((F.col("l_suppkey") + F.unix_date("day")) % 3 != 0)
            .repartition("day", "l_suppkey", "subdept")
            .groupBy("day", "l_suppkey", "subdept")
            .agg(F.sum("ext").alias("sales_budget"))
            .select(
                F.date_format("day", "yyyyMMdd").alias("date"), branch_of("l_suppkey").alias("site"),
                F.col("subdept").alias("category"), F.explode(rows).alias("sales_budget"),
            )
        )

    @cached_property
    def _item_sites(self) -> DataFrame:
        return self.raw("lineitem").select("l_partkey", "l_suppkey").distinct()

    @cached_property
    def item_cost(self) -> DataFrame:
        last = (F.col("l_partkey") % 90 + F.col("l_suppkey") % 7).cast("decimal(12,2)")
        more = (last + 1).cast("decimal(12,2)")
        lasts = F.when(F.col("l_suppkey") % 10 == 5, F.array(last, last, more)).otherwise(F.array(last))
        return self._item_sites.filter("l_partkey % 4 <> 0").select(
            text("l_partkey").alias("itemcode"), branch_of("l_suppkey").alias("branch"),
            ((F.col("l_partkey") % 80) + dec("0.50")).cast("decimal(12,2)").alias("fifocost"),
            F.explode(lasts).alias("lastcost"),
        )

    @cached_property
    def vendor(self) -> DataFrame:
        part = F.col("l_partkey")
        name = F.concat(F.lit("Item "), text(part))
        names = F.when(part % 20 == 7, F.array(name, F.concat(name, F.lit(" B")))).otherwise(F.array(name))
        return self._item_sites.select(
            (F.col("l_suppkey") + 1000).cast("int").alias("site_key"),
            F.concat(F.lit("Branch "), text("l_suppkey")).alias("site"),
            part.cast("int").alias("article_key"), F.explode(names).alias("article"),
            F.when(part % 10 == 0, "#").otherwise(F.concat(F.lit(" V"), text(part % 40))).alias("primary_vendor_key"),
            F.concat(F.lit("Vendor "), text(part % 40), F.lit(" ")).alias("primary_vendor"),
        )

    @cached_property
    def item_branch_stock(self) -> DataFrame:
        part, site = F.col("l_partkey"), F.col("l_suppkey")
        return self._item_sites.select(
            text(part).alias("itemcode"), branch_of("l_suppkey").alias("branch"),
            ((part * 7 + site) % 200).cast("double").alias("qoh"),
            ((part + site) % 3).cast("int").alias("ib_status"),
            ((part % 13) / 4).alias("ads"), F.concat(F.lit("S"), text(site)).alias("ib_sup_code"),
        )

    @cached_property
    def supplier_code(self) -> DataFrame:
        return self.raw("supplier").select(
            F.concat(F.lit("S"), text("s_suppkey")).alias("code"), F.col("s_name").alias("name")
        )

    @cached_property
    def item_supplier(self) -> DataFrame:
        return self.raw("supplier").select(
            F.concat(F.lit("S"), text("s_suppkey")).alias("code"),
            (F.col("s_suppkey") % 3).cast("int").alias("priority_vendor"),
        )

    @cached_property
    def stock_daily(self) -> DataFrame:
        group = F.col("item_group")
        dept = F.concat(text(group + 1), F.lit("0"))
        return (
            self._lines.select("day", "l_suppkey", (F.col("l_partkey") % 9).alias("item_group"))
            .distinct()
            .select(
                F.date_add("day", 1).alias("extract_day"), branch_of("l_suppkey").alias("branch"),
                text(group).alias("itemcode"), F.concat(F.lit("Group "), text(group)).alias("description"),
                dept.alias("dept"), F.concat(F.lit("D"), dept).alias("deptdesc"),
                F.concat(dept, F.lit("01")).alias("subdept"), F.concat(F.lit("S"), dept, F.lit("01")).alias("subdeptdesc"),
                F.concat(dept, F.lit("01AA")).alias("category"), F.concat(F.lit("C"), dept, F.lit("01AA")).alias("categorydesc"),
                ((group * 11 + F.col("l_suppkey")) % 100).cast("double").alias("qoh"),
                (group + dec("0.25")).cast("decimal(12,2)").alias("lastcost"),
                ((group + 1) * 0.25).alias("avgdailysales"),
            )
        )

    @cached_property
    def adjust_main(self) -> DataFrame:
        return self.raw("orders").select(
            text("o_orderkey").alias("refno"), F.to_date("o_orderdate").alias("docdate"),
            F.col("o_orderpriority").alias("reason"),
        )

    @cached_property
    def adjust_child(self) -> DataFrame:
        return self._item_lines.select(
            text("l_orderkey").alias("refno"), branch_of("l_suppkey").alias("location"), "dept", "subdept",
            "category", "itemcode", "description",
            F.when(F.col("l_returnflag") == "R", "OUT").otherwise("IN").alias("adjtype"),
            F.lit("EA").alias("um"), F.col("l_quantity").alias("qty"),
            (F.col("ext") * dec("0.02")).alias("unitprice"), F.col("ext").alias("totalprice"),
        )

    @cached_property
    def po_main(self) -> DataFrame:
        day, key = F.to_date("o_orderdate"), F.col("o_orderkey")
        priority = F.substring("o_orderpriority", 1, 1)
        kind = F.when(priority == "1", 0).when(priority == "2", 1).when(priority == "3", 9).when(priority == "4", 99).otherwise(5)
        return self.raw("orders").select(
            F.concat(F.lit("PO"), text(key)).alias("refno"), day.alias("podate"),
            F.date_add(day, 7).alias("deliverdate"),
            F.when(key % 97 != 0, F.date_add(day, 21)).alias("expiry_date"),
            F.col("o_orderstatus").alias("billstatus"),
            F.concat(F.lit("U"), text(F.col("o_custkey") % 10)).alias("issuedby"),
            text(key % 100 + 1000).alias("location"),
            F.concat(F.lit("S"), text(F.col("o_custkey") % 50)).alias("scode"),
            F.concat(F.lit("Source "), text(F.col("o_custkey") % 50)).alias("sname"),
            F.col("o_orderpriority").alias("remark"),
            (key % 2).cast("int").alias("cancel"), (key % 3).cast("int").alias("closed"),
            (key % 5).cast("int").alias("completed"), money("o_totalprice").alias("total"),
            F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("ibt"), kind.alias("order_type"),
        )

    @cached_property
    def po_child(self) -> DataFrame:
        return self._lines.select(
            F.concat(F.lit("PO"), text("l_orderkey")).alias("refno"), F.col("l_linenumber").alias("line"),
            F.lit("N").alias("entrytype"), F.col("l_returnflag").alias("pricetype"),
            text("l_partkey").alias("itemcode"), F.concat(F.lit("Item "), text("l_partkey")).alias("description"),
            F.lit("EA").alias("um"), F.col("l_quantity").alias("qty"), F.lit(12.0).alias("bulkqty"),
            F.lit("CTN").alias("umbulk"), (F.col("l_quantity") / 4).alias("bqty"),
            (F.col("ext") * dec("0.02")).alias("unitprice"), F.col("ext").alias("totalprice"),
        )

    @cached_property
    def gr_main(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.raw("orders").select(
            F.concat(F.lit("GR"), text(key)).alias("refno"), text(key % 100 + 1000).alias("location"),
            F.concat(F.lit("DO"), text(key)).alias("dono"), F.concat(F.lit("INV"), text(key)).alias("invno"),
            F.date_add(F.to_date("o_orderdate"), 10).alias("docdate"),
            F.concat(F.lit("S"), text(F.col("o_custkey") % 50)).alias("code"),
            F.concat(F.lit("Source "), text(F.col("o_custkey") % 50)).alias("name"),
            F.concat(F.lit("R"), text(key % 7)).alias("receivedby"), F.col("o_orderpriority").alias("remark"),
            money("o_totalprice").alias("total"),
            F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("ibt"),
        )

    @cached_property
    def gr_child(self) -> DataFrame:
        """Receipts of the shipped lines: as ordered, half of it, or one too many."""
        qty, turn = F.col("l_quantity"), F.col("l_linenumber") % 3
        return self._lines.filter("l_linestatus = 'F'").select(
            F.concat(F.lit("GR"), text("l_orderkey")).alias("refno"),
            F.concat(F.lit("PO"), text("l_orderkey")).alias("porefno"), F.col("l_linenumber").alias("line"),
            text("l_partkey").alias("itemcode"), F.concat(F.lit("Item "), text("l_partkey")).alias("description"),
            F.when(turn == 0, qty).when(turn == 1, qty / 2).otherwise(qty + 1).alias("qty"),
            qty.alias("poqty"), F.lit(12.0).alias("bulkqty"), F.lit("CTN").alias("umbulk"),
            (qty / 4).alias("bqty"), (F.col("ext") * dec("0.02")).alias("unitprice"),
            F.col("ext").alias("totalprice"), F.col("l_returnflag").alias("pricetype"),
        )

    @cached_property
    def po_alloc_ft(self) -> DataFrame:
        return self._lines.filter("l_returnflag = 'N'").select(
            F.concat(F.lit("PO"), text("l_orderkey")).alias("all_ft_po_refno"),
            F.col("l_linenumber").alias("all_ft_po_line"), branch_of("l_suppkey").alias("all_ft_loc_code"),
            text("l_partkey").alias("all_ft_itemcode"), F.col("l_quantity").alias("all_ft_qty"),
            (F.col("l_quantity") / 4).alias("all_ft_case_qty"),
            F.concat(F.lit("X"), text("l_orderkey")).alias("all_ft_cross_ref"),
        )

    @cached_property
    def dc_req(self) -> DataFrame:
        key, site = text("l_orderkey"), text("l_suppkey")
        return (
            self.raw("lineitem").filter("l_returnflag = 'N'").groupBy("l_orderkey", "l_suppkey")
            .agg(F.to_date(F.min("l_shipdate")).alias("day"))
            .select(
                F.concat(key, F.lit("-"), site).alias("trans_guid"), F.concat(F.lit("DC"), key).alias("refno"),
                F.lit("REQ").alias("trans_type"), F.col("day").alias("docdate"),
                F.date_add("day", 3).alias("deliverdate"), F.lit("9000").alias("locfrom"),
                F.lit("Central DC").alias("locfromname"), branch_of("l_suppkey").alias("locto"),
                F.concat(F.lit("Branch "), site).alias("loctoname"),
                F.concat(F.lit("PO"), key).alias("cross_ref"),
                (F.col("l_orderkey") % 2).cast("int").alias("ibt"), (F.col("l_orderkey") % 4).cast("int").alias("ibt_status"),
            )
        )

    @cached_property
    def dc_req_child(self) -> DataFrame:
        qty = F.col("l_quantity")
        return self._lines.filter("l_returnflag = 'N'").select(
            F.concat(text("l_orderkey"), F.lit("-"), text("l_suppkey")).alias("trans_guid"),
            F.col("l_linenumber").alias("line"), text("l_partkey").alias("itemcode"),
            F.concat(F.lit("Item "), text("l_partkey")).alias("description"), F.lit(12.0).alias("bulksize"),
            F.lit("CTN").alias("bulkum"), qty.alias("qty"), (qty / 2).alias("qty_outstanding"),
            (qty - 1).alias("qty_actual"), (qty + 1).alias("qty_amend"), F.lit(6.0).alias("packsize"),
            (F.col("ext") * dec("0.02")).alias("unitprice"), F.col("ext").alias("netamount"),
        )

    @cached_property
    def location_list(self) -> DataFrame:
        """Raw site sheet; each distribution centre is listed a second time under another name."""
        key = F.col("s_suppkey")
        name = F.concat(
            F.lit("Giant "), F.col("s_name"), F.when(key % 4 == 1, " TMC").otherwise(""),
            F.when(key % 3 == 0, " DC").otherwise(""), F.when(key % 2 == 0, " Mini").otherwise(""),
        )
        centre = F.col("banner") == "Distribution Centre"
        names = F.when(centre, F.array(name, F.concat(name, F.lit(" ANNEX")))).otherwise(F.array(name))
        return self._suppliers.select(
            branch_of("s_suppkey").alias("site"), F.explode(names).alias("site_name"),
            F.concat(F.lit("Road "), text(key)).alias("branch_add"), "banner",
        )

    @cached_property
    def store_list(self) -> DataFrame:
        """Curated store sheet; covers part of the raw sites and sites the raw sheet lacks."""
        key = F.col("s_suppkey")
        return self._suppliers.select(
            text(key * 2 + 1000).alias("site"), F.concat(F.lit("Store "), text(key)).alias("site_name"),
            F.lit("02.HYPERMARKET").alias("banner"), F.col("n_name").alias("area"),
            F.when(key % 7 == 0, "closed").alias("remarks_closed_store"),
        )

    @cached_property
    def expected_totals(self) -> DataFrame:
        """Daily totals as someone else noted them: one off on the 13th, none on the 29th."""
        off = F.when(F.dayofmonth("date") == 13, 1).otherwise(0)
        return (
            self.pos_srp.groupBy("date")
            .agg(F.sum("quantity").alias("q"), F.sum("item_paid_price").alias("s"), F.sum("discount").alias("m"))
            .filter(F.dayofmonth("date") != 29)
            .select("date", (F.col("q") + off).alias("total_sales_qty"), F.col("s").alias("total_sales"), F.col("m").alias("total_margin"))
        )
