"""The same tables and queries in SQL, as DuckDB runs it on the driver's parquet files.

The statements sum after the joins, as the queries are usually written; they share no code and
no shortcut with the Spark side.
"""

from __future__ import annotations

import re

# ---- sample tables, see tables.py ----

TABLES = {
    "lines": """
        SELECT *, CAST(l_shipdate AS DATE) AS day, CAST(l_extendedprice AS DECIMAL(12,2)) AS ext,
               CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS disc_amount,
               CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS net,
               CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                   * (1 + CAST(l_tax AS DECIMAL(4,2))) AS net_tax,
               CAST(l_suppkey + 1000 AS VARCHAR) AS site_code
        FROM lineitem""",
    "item": """
        SELECT CAST(p_partkey AS VARCHAR) AS itemcode, CAST(p_partkey - p_partkey % 4 AS VARCHAR) AS itemlink,
               p_name AS description, dept, dept || brand AS subdept, dept || brand || p_type[1:2] AS category,
               CASE WHEN p_size % 5 = 0 THEN 1 ELSE 0 END AS consign, p_size % 3 AS costmarginvalue,
               retail * 0.70 AS averagecost, retail * 0.68 AS fifocost, retail * 0.72 AS lastcost
        FROM (SELECT *, CAST(p_partkey % 9 + 1 AS VARCHAR) || '0' AS dept,
                     lpad(substr(p_brand, 7, 2), 2, '0') AS brand, CAST(p_retailprice AS DECIMAL(12,2)) AS retail
              FROM part)""",
    "hierarchy": """
        SELECT CASE WHEN dept = '90' THEN dept || ' ' ELSE dept END AS dept, 'D' || dept AS deptdesc,
               CASE WHEN dept = '90' THEN ' ' || subdept ELSE subdept END AS subdept, 'S' || subdept AS subdeptdesc,
               CASE WHEN dept = '90' THEN category || ' ' ELSE category END AS category, 'C' || category AS categorydesc,
               'G' || dept[1:1] AS group_desc
        FROM (SELECT DISTINCT dept, subdept, category FROM item)""",
    "sites": """
        SELECT *, CAST(s_suppkey + 1000 AS VARCHAR) AS code,
               CASE n_regionkey WHEN 0 THEN 'Giant Hyper' WHEN 1 THEN 'Giant Super' WHEN 2 THEN 'Upscale'
                    WHEN 3 THEN 'Giant Mini' ELSE 'Distribution Centre' END AS banner
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "branch": "SELECT code AS branch_code, s_name AS branch_name, banner FROM sites",
    "item_lines": """
        SELECT l.*, i.itemcode, i.description, i.dept, i.subdept, i.category, i.consign
        FROM lines l JOIN item i ON CAST(l.l_partkey AS VARCHAR) = i.itemcode""",
    "pos_panda": """
        SELECT day AS bizdate, site_code AS location, itemcode, description, dept, subdept, category,
               CAST(l_orderkey AS VARCHAR) AS refno, l_quantity AS qty, ext AS sumgrosssales,
               net_tax AS amount_after_tax, disc_amount AS sumdisc, net AS amount, ext * 0.75 AS cost, consign
        FROM item_lines WHERE l_returnflag = 'A'""",
    "pos_group": """
        SELECT day AS bizdate, site_code AS location, CAST(l_partkey % 9 AS VARCHAR) AS itemcode, l_quantity AS qty
        FROM lines WHERE l_returnflag = 'A'""",
    "pos_all": """
        SELECT day AS bizdate, site_code AS location, CAST(l_partkey % 9 AS VARCHAR) AS itemcode, l_quantity AS qty FROM lines""",
    "pos_srp": """
        SELECT day AS date, site_code AS branch_code,
               CASE WHEN l_partkey % 50 = 49 THEN 'X' ELSE '' END || CAST(l_partkey AS VARCHAR) AS plu_number,
               'PLU ' || CAST(l_partkey AS VARCHAR) AS descriptor, l_quantity AS quantity, ext AS item_paid_price,
               disc_amount AS discount,
               CASE WHEN l_linenumber = 6 THEN ext * 1.50 WHEN l_linenumber % 2 = 0 THEN ext * 0.01 END AS staff_discount,
               CAST(l_orderkey AS VARCHAR) AS receipt_number,
               CAST((l_suppkey + 1000) % 6 + 1216 AS VARCHAR) AS loc
        FROM lines WHERE l_returnflag = 'N'""",
    "pos_sap": """
        SELECT day AS yearmonthday, CAST(l_suppkey + 1000 AS INT) AS site, CAST(l_partkey AS INT) AS article,
               sum(l_quantity) AS sales_qty_sales_uom, sum(net) AS sales_exclude_tax, sum(net_tax) AS sales_include_tax,
               sum(disc_amount) AS promotion_sales_discount_value, sum(ext * 0.75) AS cogs_l3,
               sum(net - ext * 0.75) AS scan_margin_l4,
               sum(CASE WHEN l_partkey % 5 <> 0 THEN l_quantity ELSE 0 END) AS outright_sales_qty_base_uom,
               sum(CASE WHEN l_partkey % 5 <> 0 THEN net ELSE 0 END) AS outright_sales_exclude_tax,
               sum(CASE WHEN l_partkey % 5 = 0 THEN l_quantity ELSE 0 END) AS consignment_sales_qty_base_uom,
               sum(CASE WHEN l_partkey % 5 = 0 THEN net ELSE 0 END) AS consignment_sales_exclude_tax
        FROM lines WHERE l_returnflag = 'R' GROUP BY day, l_suppkey, l_partkey""",
    "budget_base": """
        SELECT l_suppkey, strftime(day, '%Y%m%d') AS date, site_code AS site, subdept AS category, sum(ext) AS sales_budget
        FROM item_lines WHERE (l_suppkey + (day - DATE '1970-01-01')) % 3 <> 0
        GROUP BY l_suppkey, day, site_code, subdept""",
    "budget": """
        SELECT date, site, category, sales_budget FROM budget_base
        UNION ALL SELECT date, site, category, sales_budget FROM budget_base WHERE l_suppkey % 10 = 3
        UNION ALL SELECT date, site, category, sales_budget + 1 FROM budget_base WHERE l_suppkey % 10 = 7""",
    "item_sites": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
    "cost_base": """
        SELECT CAST(l_partkey AS VARCHAR) AS itemcode, CAST(l_suppkey + 1000 AS VARCHAR) AS branch, l_suppkey,
               CAST(l_partkey % 80 + 0.50 AS DECIMAL(12,2)) AS fifocost,
               CAST(l_partkey % 90 + l_suppkey % 7 AS DECIMAL(12,2)) AS lastcost
        FROM item_sites WHERE l_partkey % 4 <> 0""",
    "item_cost": """
        SELECT itemcode, branch, fifocost, lastcost FROM cost_base
        UNION ALL SELECT itemcode, branch, fifocost, lastcost FROM cost_base WHERE l_suppkey % 10 = 5
        UNION ALL SELECT itemcode, branch, fifocost, lastcost + 1 FROM cost_base WHERE l_suppkey % 10 = 5""",
    "vendor_base": """
        SELECT l_partkey, CAST(l_suppkey + 1000 AS INT) AS site_key, 'Branch ' || CAST(l_suppkey AS VARCHAR) AS site,
               CAST(l_partkey AS INT) AS article_key, 'Item ' || CAST(l_partkey AS VARCHAR) AS article,
               CASE WHEN l_partkey % 10 = 0 THEN '#' ELSE ' V' || CAST(l_partkey % 40 AS VARCHAR) END AS primary_vendor_key,
               'Vendor ' || CAST(l_partkey % 40 AS VARCHAR) || ' ' AS primary_vendor
        FROM item_sites""",
    "vendor": """
        SELECT site_key, site, article_key, article, primary_vendor_key, primary_vendor FROM vendor_base
        UNION ALL SELECT site_key, site, article_key, article || ' B', primary_vendor_key, primary_vendor
        FROM vendor_base WHERE l_partkey % 20 = 7""",
    "item_branch_stock": """
        SELECT CAST(l_partkey AS VARCHAR) AS itemcode, CAST(l_suppkey + 1000 AS VARCHAR) AS branch,
               CAST((l_partkey * 7 + l_suppkey) % 200 AS DOUBLE) AS qoh, (l_partkey + l_suppkey) % 3 AS ib_status,
               (l_partkey % 13) / 4.0 AS ads, 'S' || CAST(l_suppkey AS VARCHAR) AS ib_sup_code
        FROM item_sites""",
    "supplier_code": "SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS code, s_name AS name FROM supplier",
    "item_supplier": "SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS code, s_suppkey % 3 AS priority_vendor FROM supplier",
    "stock_daily": """
        SELECT day + 1 AS extract_day, site_code AS branch, CAST(g AS VARCHAR) AS itemcode,
               'Group ' || CAST(g AS VARCHAR) AS description, dept, 'D' || dept AS deptdesc, dept || '01' AS subdept,
               'S' || dept || '01' AS subdeptdesc, dept || '01AA' AS category, 'C' || dept || '01AA' AS categorydesc,
               CAST((g * 11 + l_suppkey) % 100 AS DOUBLE) AS qoh, g + 0.25 AS lastcost, (g + 1) * 0.25 AS avgdailysales
        FROM (SELECT DISTINCT day, l_suppkey, site_code, l_partkey % 9 AS g, CAST(l_partkey % 9 + 1 AS VARCHAR) || '0' AS dept FROM lines)""",
    "adjust_main": "SELECT CAST(o_orderkey AS VARCHAR) AS refno, CAST(o_orderdate AS DATE) AS docdate, o_orderpriority AS reason FROM orders",
    "adjust_child": """
        SELECT CAST(l_orderkey AS VARCHAR) AS refno, site_code AS location, dept, subdept, category, itemcode, description,
               CASE WHEN l_returnflag = 'R' THEN 'OUT' ELSE 'IN' END AS adjtype, 'EA' AS um, l_quantity AS qty,
               ext * 0.02 AS unitprice, ext AS totalprice
        FROM item_lines""",
    "po_main": """
        SELECT 'PO' || CAST(o_orderkey AS VARCHAR) AS refno, CAST(o_orderdate AS DATE) AS podate,
               CAST(o_orderdate AS DATE) + 7 AS deliverdate,
               CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) + 21 END AS expiry_date,
               o_orderstatus AS billstatus, 'U' || CAST(o_custkey % 10 AS VARCHAR) AS issuedby,
               CAST(o_orderkey % 100 + 1000 AS VARCHAR) AS location, 'S' || CAST(o_custkey % 50 AS VARCHAR) AS scode,
               'Source ' || CAST(o_custkey % 50 AS VARCHAR) AS sname, o_orderpriority AS remark,
               o_orderkey % 2 AS cancel, o_orderkey % 3 AS closed, o_orderkey % 5 AS completed,
               CAST(o_totalprice AS DECIMAL(12,2)) AS total, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS ibt,
               CASE o_orderpriority[1:1] WHEN '1' THEN 0 WHEN '2' THEN 1 WHEN '3' THEN 9 WHEN '4' THEN 99 ELSE 5 END AS order_type
        FROM orders""",
    "po_child": """
        SELECT 'PO' || CAST(l_orderkey AS VARCHAR) AS refno, l_linenumber AS line, 'N' AS entrytype, l_returnflag AS pricetype,
               CAST(l_partkey AS VARCHAR) AS itemcode, 'Item ' || CAST(l_partkey AS VARCHAR) AS description, 'EA' AS um,
               l_quantity AS qty, 12.0 AS bulkqty, 'CTN' AS umbulk, l_quantity / 4 AS bqty, ext * 0.02 AS unitprice, ext AS totalprice
        FROM lines""",
    "gr_main": """
        SELECT 'GR' || CAST(o_orderkey AS VARCHAR) AS refno, CAST(o_orderkey % 100 + 1000 AS VARCHAR) AS location,
               'DO' || CAST(o_orderkey AS VARCHAR) AS dono, 'INV' || CAST(o_orderkey AS VARCHAR) AS invno,
               CAST(o_orderdate AS DATE) + 10 AS docdate, 'S' || CAST(o_custkey % 50 AS VARCHAR) AS code,
               'Source ' || CAST(o_custkey % 50 AS VARCHAR) AS name, 'R' || CAST(o_orderkey % 7 AS VARCHAR) AS receivedby,
               o_orderpriority AS remark, CAST(o_totalprice AS DECIMAL(12,2)) AS total,
               CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS ibt
        FROM orders""",
    "gr_child": """
        SELECT 'GR' || CAST(l_orderkey AS VARCHAR) AS refno, 'PO' || CAST(l_orderkey AS VARCHAR) AS porefno,
               l_linenumber AS line, CAST(l_partkey AS VARCHAR) AS itemcode, 'Item ' || CAST(l_partkey AS VARCHAR) AS description,
               CASE l_linenumber % 3 WHEN 0 THEN l_quantity WHEN 1 THEN l_quantity / 2 ELSE l_quantity + 1 END AS qty,
               l_quantity AS poqty, 12.0 AS bulkqty, 'CTN' AS umbulk, l_quantity / 4 AS bqty, ext * 0.02 AS unitprice,
               ext AS totalprice, l_returnflag AS pricetype
        FROM lines WHERE l_linestatus = 'F'""",
    "po_alloc_ft": """
        SELECT 'PO' || CAST(l_orderkey AS VARCHAR) AS all_ft_po_refno, l_linenumber AS all_ft_po_line,
               site_code AS all_ft_loc_code, CAST(l_partkey AS VARCHAR) AS all_ft_itemcode, l_quantity AS all_ft_qty,
               l_quantity / 4 AS all_ft_case_qty, 'X' || CAST(l_orderkey AS VARCHAR) AS all_ft_cross_ref
        FROM lines WHERE l_returnflag = 'N'""",
    "dc_req": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS trans_guid,
               'DC' || CAST(l_orderkey AS VARCHAR) AS refno, min(day) AS docdate, '9000' AS locfrom, 'Central DC' AS locfromname,
               site_code AS locto, 'Branch ' || CAST(l_suppkey AS VARCHAR) AS loctoname,
               'PO' || CAST(l_orderkey AS VARCHAR) AS cross_ref, l_orderkey % 2 AS ibt, l_orderkey % 4 AS ibt_status
        FROM lines WHERE l_returnflag = 'N' GROUP BY l_orderkey, l_suppkey, site_code""",
    "dc_req_child": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS trans_guid, l_linenumber AS line,
               CAST(l_partkey AS VARCHAR) AS itemcode, 'Item ' || CAST(l_partkey AS VARCHAR) AS description, 12.0 AS bulksize,
               'CTN' AS bulkum, l_quantity AS qty, l_quantity / 2 AS qty_outstanding, l_quantity - 1 AS qty_actual,
               l_quantity + 1 AS qty_amend, 6.0 AS packsize, ext * 0.02 AS unitprice, ext AS netamount
        FROM lines WHERE l_returnflag = 'N'""",
    "location_base": """
        SELECT code AS site, 'Giant ' || s_name || CASE WHEN s_suppkey % 4 = 1 THEN ' TMC' ELSE '' END
                   || CASE WHEN s_suppkey % 3 = 0 THEN ' DC' ELSE '' END
                   || CASE WHEN s_suppkey % 2 = 0 THEN ' Mini' ELSE '' END AS site_name,
               'Road ' || CAST(s_suppkey AS VARCHAR) AS branch_add, banner
        FROM sites""",
    "location_list": """
        SELECT * FROM location_base
        UNION ALL SELECT site, site_name || ' ANNEX', branch_add, banner FROM location_base WHERE banner = 'Distribution Centre'""",
    "store_list": """
        SELECT CAST(s_suppkey * 2 + 1000 AS VARCHAR) AS site, 'Store ' || CAST(s_suppkey AS VARCHAR) AS site_name,
               '02.HYPERMARKET' AS banner, n_name AS area, CASE WHEN s_suppkey % 7 = 0 THEN 'closed' END AS remarks_closed_store
        FROM sites""",
    "normal_banner": """
        SELECT site, site_name, branch_add, CASE
            WHEN banner = 'Giant Super' AND site_name NOT LIKE '%TMC%' THEN '02.SUPERMARKET'
            WHEN banner = 'Giant Super' THEN '02. TMC - SUPERMARKET'
            WHEN banner = 'Giant Hyper' AND site_name NOT LIKE '%TMC%' THEN '02.HYPERMARKET'
            WHEN banner = 'Giant Hyper' THEN '02. TMC - HYPERMARKET'
            WHEN banner = 'Upscale' OR banner = 'UPSCALE' THEN '03.UPSCALE'
            WHEN banner IN ('Giant Mini', 'Distribution Centre') AND site_name LIKE '%DC%' AND site_name LIKE '%Mini%'
                THEN '07.DISTRIBUTION CENTRE - GIANT MINI'
            WHEN banner = 'Giant Mini' THEN '04.GIANT MINI'
            WHEN banner = 'Distribution Centre' THEN '06.DISTRIBUTION CENTRE - GIANT'
            WHEN banner = 'HQ' THEN '' ELSE banner END AS banner
        FROM location_list""",
    "both_sheets": """
        SELECT site, site_name, banner, area, remarks_closed_store, 0 AS src FROM store_list
        UNION ALL SELECT site, site_name, banner, NULL, NULL, 1 FROM normal_banner""",
    "expected_totals": """
        SELECT date, sum(quantity) + CASE WHEN day(date) = 13 THEN 1 ELSE 0 END AS total_qty_sales,
               sum(item_paid_price) AS total_sales, sum(discount) AS total_margin
        FROM pos_srp WHERE day(date) <> 29 GROUP BY date""",
    "file_rows": """
        SELECT plu_number, descriptor, quantity AS total_qty_sales,
               CASE WHEN CAST(receipt_number AS BIGINT) % 41 = 0 THEN NULL ELSE item_paid_price END AS total_sales,
               quantity * 125 AS total_margin, loc AS location, CAST(date_trunc('quarter', date) AS DATE) AS date
        FROM pos_srp""",
    "days": "SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem UNION SELECT CAST(o_orderdate AS DATE) FROM orders",
    # ---- lookups and documents of the reports ----
    "h_im": """
        SELECT i.itemcode, i.itemlink, i.description, i.dept, hd.deptdesc, i.subdept, hs.subdeptdesc, i.category,
               hc.categorydesc, i.consign, i.costmarginvalue
        FROM item i
        JOIN (SELECT DISTINCT dept, deptdesc FROM hierarchy) hd ON trim(i.dept) = trim(hd.dept)
        JOIN (SELECT DISTINCT subdept, subdeptdesc FROM hierarchy) hs ON trim(i.subdept) = trim(hs.subdept)
        JOIN (SELECT DISTINCT category, categorydesc FROM hierarchy) hc ON trim(i.category) = trim(hc.category)""",
    "item_labels": """
        SELECT i.itemcode, i.dept || '-' || hd.deptdesc AS Dept, i.subdept || '-' || hs.subdeptdesc AS SubDept,
               i.category || '-' || hc.categorydesc AS Category
        FROM item i
        JOIN (SELECT DISTINCT dept, deptdesc FROM hierarchy) hd ON i.dept = hd.dept
        JOIN (SELECT DISTINCT subdept, subdeptdesc FROM hierarchy) hs ON i.subdept = hs.subdept
        JOIN (SELECT DISTINCT category, categorydesc FROM hierarchy) hc ON i.category = hc.category""",
    "costs": "SELECT DISTINCT itemcode, branch, fifocost, lastcost FROM item_cost",
    "budgets": "SELECT strptime(date, '%Y%m%d')::DATE AS day, site, category, sales_budget FROM budget",
    "vendors": """
        SELECT trim(CAST(site_key AS VARCHAR)) AS "Location", trim(site) AS "Location_Name",
               trim(CAST(article_key AS VARCHAR)) AS "Itemcode", trim(article) AS "Description",
               trim(primary_vendor_key) AS "Code", trim(primary_vendor) AS "Name"
        FROM (SELECT DISTINCT * FROM vendor) WHERE primary_vendor_key <> '#'""",
    "po": """
        SELECT m.refno AS m_refno, m.* EXCLUDE (refno), c.line, c.entrytype, c.pricetype, c.itemcode, c.description, c.um,
               c.qty, c.bulkqty, c.umbulk, c.bqty, c.unitprice, c.totalprice
        FROM po_main m JOIN po_child c ON m.refno = c.refno""",
    "gr": """
        SELECT m.refno AS g_refno, m.location AS g_location, m.dono, m.invno, m.docdate AS g_docdate, m.code AS g_code,
               m.name AS g_name, m.receivedby, m.remark AS g_remark, m.total AS g_total, m.ibt AS g_ibt, c.porefno,
               c.line AS g_line, c.itemcode AS g_itemcode, c.description AS g_desc, c.qty AS g_qty, c.poqty, c.bulkqty AS g_bulkqty,
               c.umbulk AS g_umbulk, c.bqty AS g_bqty, c.unitprice AS g_unitprice, c.totalprice AS g_totalprice, c.pricetype AS g_pricetype
        FROM gr_main m JOIN gr_child c ON m.refno = c.refno""",
    "po_gr": """
        SELECT * FROM po LEFT JOIN gr ON m_refno = porefno AND itemcode = g_itemcode AND pricetype = g_pricetype""",
    "dcr": """
        SELECT h.refno AS d_refno, h.docdate AS d_docdate, h.locfrom || '-' || h.locfromname AS d_from,
               h.locto || '-' || h.loctoname AS d_to, h.cross_ref, h.ibt AS d_ibt, h.ibt_status AS d_ibt_status, c.line AS d_line,
               c.itemcode AS d_itemcode, c.description AS d_desc, c.qty_outstanding, c.qty AS d_qty, c.qty_actual, c.qty_amend,
               c.bulksize, c.bulkum, c.packsize, c.unitprice AS d_unitprice, c.netamount
        FROM dc_req h JOIN dc_req_child c ON h.trans_guid = c.trans_guid""",
}


def _known(text: str) -> list[str]:
    return [name for name in TABLES if re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", text)]


def sql(body: str) -> str:
    """``body`` with the sample tables it uses, in order, as common table expressions."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in _known(text):
            if name not in ordered:
                need(TABLES[name])
                ordered.append(name)

    need(body)
    ctes = ",\n".join(f"{name} AS ({TABLES[name]})" for name in ordered)
    return f"WITH {ctes}\n{body}" if ordered else body


# ---- expressions ----


def dbl(x: str, name: str) -> str:
    return f'CAST({x} AS DOUBLE) AS "{name}"'


def big(x: str, name: str) -> str:
    return f'CAST({x} AS BIGINT) AS "{name}"'


def txt(x: str, name: str) -> str:
    return f'CAST({x} AS VARCHAR) AS "{name}"'


def division(x: str) -> str:
    return (
        f"CASE WHEN {x} LIKE '1%' THEN '1 - GROCERY' WHEN {x} LIKE '2%' THEN '2 - FRESH' "
        f"WHEN {x} LIKE '3%' THEN '3 - PERISHABLE' WHEN {x} LIKE '4%' THEN '4 - NON FOODS' "
        f"WHEN {x} LIKE '5%' THEN '5 - HEALTH & BEA' WHEN {x} LIKE '6%' THEN '6 - GMS' "
        f"WHEN {x} LIKE '7%' THEN '7 - SERVICES' WHEN {x} LIKE '8%' THEN '8 - NON TRADE' ELSE '9 - OTHER' END"
    )


EXPORT = (
    "CASE {x}[1:1] WHEN '1' THEN '1 - GROCERY' WHEN '2' THEN '2 - FRESH' WHEN '3' THEN '3 - PERISHABLES' "
    "WHEN '4' THEN '4 - NON FOODS' WHEN '5' THEN '5 - HEALTH & BEAUTY' WHEN '6' THEN '6 - GMS' END"
)


def week(d: str) -> str:
    first = f"CASE WHEN strftime(date_trunc('year', {d}), '%a') = 'Mon' THEN 0 ELSE 1 END"
    return f"CAST(CAST(strftime({d}, '%W') AS INT) + {first} AS VARCHAR)"


def week_year(d: str) -> str:
    return f"{week(d)} || '.' || strftime({d}, '%Y')"


def wk(d: str) -> str:
    return f"'Wk' || lpad({week(d)}, 2, '0')"


def day_week(d: str) -> str:
    return f"'0' || strftime({d}, '%u') || '.' || strftime({d}, '%a')"


def wk_num(d: str) -> str:
    return f"'Wk' || strftime(date_trunc('week', {d}), '%U')"


def calendar(d: str, leave_out: str = "") -> str:
    labels = {
        "Calendar Year": f"'Yr' || strftime({d}, '%Y')",
        "Calendar Month": f"strftime({d}, '%m. %b')",
        "WeekYear": week_year(d),
        "Wk": wk(d),
        "Calendar Day Month": f"strftime({d}, '%m. %d')",
        "Calendar Day Week": day_week(d),
    }
    return ", ".join(f'{x} AS "{name}"' for name, x in labels.items() if name != leave_out)


STATUS = """CASE WHEN g_qty > poqty OR ifnull(g_qty, 0) > ifnull(qty, 0) THEN 'Over Delivery'
    WHEN g_qty = poqty OR ifnull(g_qty, 0) = ifnull(qty, 0) THEN 'Full Delivery'
    WHEN DATE '1998-06-30' <= expiry_date AND (g_qty < poqty OR ifnull(g_qty, 0) < ifnull(qty, 0)) AND ifnull(g_qty, 0) > 0 THEN 'Partial Delivery'
    WHEN DATE '1998-06-30' <= expiry_date AND ifnull(g_qty, 0) = 0 THEN 'No Delivery'
    WHEN DATE '1998-06-30' > expiry_date AND ifnull(g_qty, 0) >= 0 THEN 'Expired' ELSE 'Others' END"""
ORDER_TYPE = """CASE order_type WHEN 0 THEN '00-DSP/Con' WHEN 1 THEN '01-Flow-through'
    WHEN 9 THEN '09-NT-DSP' WHEN 99 THEN '99-NT' END"""

PANDA = f"""
    SELECT {calendar('p.bizdate')}, {txt('p.bizdate', 'BizDate')}, b.banner AS "Banner", p.location AS "Location",
        b.branch_name AS "Branch_Name", {division('p.dept')} AS "Division", p.dept || '-' || h.deptdesc AS "Dept",
        p.subdept || '-' || h.subdeptdesc AS "SubDept", p.category || '-' || h.categorydesc AS "Category",
        p.itemcode AS "Itemcode", p.description AS "description", h.itemlink AS "ItemLink",
        v."Code" || '-' || v."Name" AS "Vendor", {dbl('sum(p.qty)', 'Qty')}, {dbl('sum(p.sumgrosssales)', 'GrossSales_ext_Tax')},
        {dbl('sum(p.amount_after_tax)', 'Sales_with_Tax')}, {dbl('sum(p.sumdisc)', 'Discount')},
        {dbl('sum(p.amount)', 'NetSales_ext_Tax')}, {dbl('sum(p.cost)', 'Cost')}, {dbl('sum(p.amount) - sum(p.cost)', 'ScanMargin')},
        {big('count(DISTINCT p.refno)', 'TransCount')},
        CAST(sum(p.amount) AS DOUBLE) / count(DISTINCT p.refno) AS "AvgBasket",
        {dbl('sum(CASE WHEN p.consign = 0 THEN p.qty ELSE 0 END)', 'Out_Qty')},
        {dbl('sum(CASE WHEN p.consign = 0 THEN p.amount ELSE 0 END)', 'Out_NS_E_T')},
        {dbl('sum(CASE WHEN p.consign = 1 THEN p.qty ELSE 0 END)', 'Con_Qty')},
        {dbl('sum(CASE WHEN p.consign = 1 THEN p.amount ELSE 0 END)', 'Con_NS_E_T')},
        {dbl('sum(p.amount)', 'NS_E_T')}, {dbl('c.lastcost', 'LastCost')}, {dbl('c.fifocost', 'FIFOCost')},
        {dbl('ifnull(g.sales_budget, 0)', 'Budget')},
        CASE WHEN h.itemlink = p.itemcode THEN 'true' ELSE 'false' END AS "Parent_Item", 'Panda' AS "POSType"
    FROM pos_panda p LEFT JOIN h_im h ON p.itemcode = h.itemcode
    LEFT JOIN costs c ON p.itemcode = c.itemcode AND p.location = c.branch
    LEFT JOIN budgets g ON g.day = p.bizdate AND g.site = p.location AND p.subdept = g.category
    LEFT JOIN vendors v ON p.location = v."Location" AND p.itemcode = v."Itemcode"
    LEFT JOIN branch b ON p.location = b.branch_code
    GROUP BY p.bizdate, b.banner, p.location, b.branch_name, p.dept, h.deptdesc, p.subdept, h.subdeptdesc, p.category,
        h.categorydesc, h.itemlink, p.itemcode, p.description, v."Code", v."Name", p.consign, h.costmarginvalue,
        c.lastcost, c.fifocost, g.sales_budget"""

DISCOUNT = "ifnull(sum(p.discount), 0) + ifnull(sum(p.staff_discount), 0)"
SRP = f"""
    SELECT {calendar('p.date')}, {txt('p.date', 'BizDate')}, b.banner AS "Banner", p.branch_code AS "Location",
        b.branch_name AS "Branch_Name", {division('h.dept')} AS "Division", h.dept || '-' || h.deptdesc AS "Dept",
        h.subdept || '-' || h.subdeptdesc AS "SubDept", h.category || '-' || h.categorydesc AS "Category",
        p.plu_number AS "Itemcode", p.descriptor AS "description", h.itemlink AS "ItemLink",
        v."Code" || '-' || v."Name" AS "Vendor", {dbl('sum(p.quantity)', 'Qty')}, {dbl('sum(p.item_paid_price)', 'GrossSales_ext_Tax')},
        {dbl('0', 'Sales_with_Tax')}, {dbl(DISCOUNT, 'Discount')},
        {dbl(f'greatest(ifnull(sum(p.item_paid_price), 0) - ({DISCOUNT}), 0)', 'NetSales_ext_Tax')}, {dbl('0', 'Cost')},
        {dbl(f'ifnull(sum(p.item_paid_price), 0) - ({DISCOUNT})', 'ScanMargin')},
        {big('count(DISTINCT p.receipt_number)', 'TransCount')},
        CAST(sum(p.item_paid_price) AS DOUBLE) / count(DISTINCT p.receipt_number) AS "AvgBasket",
        {dbl('sum(CASE WHEN h.consign = 0 THEN p.quantity ELSE 0 END)', 'Out_Qty')},
        {dbl('sum(CASE WHEN h.consign = 0 THEN p.item_paid_price ELSE 0 END)', 'Out_NS_E_T')},
        {dbl('sum(CASE WHEN h.consign = 1 THEN p.quantity ELSE 0 END)', 'Con_Qty')},
        {dbl('sum(CASE WHEN h.consign = 1 THEN p.item_paid_price ELSE 0 END)', 'Con_NS_E_T')},
        {dbl('sum(p.item_paid_price)', 'NS_E_T')}, {dbl('0', 'LastCost')}, {dbl('0', 'FIFOCost')},
        {dbl('ifnull(g.sales_budget, 0)', 'Budget')}, CAST(NULL AS VARCHAR) AS "Parent_Item", 'SRP' AS "POSType"
    FROM pos_srp p LEFT JOIN h_im h ON p.plu_number = h.itemcode
    LEFT JOIN budgets g ON g.day = p.date AND g.site = p.branch_code AND h.subdept = g.category
    LEFT JOIN vendors v ON p.branch_code = v."Location" AND p.plu_number = v."Itemcode"
    LEFT JOIN branch b ON p.branch_code = b.branch_code
    GROUP BY p.date, b.banner, p.branch_code, b.branch_name, h.dept, h.deptdesc, h.subdept, h.subdeptdesc, h.category,
        h.categorydesc, h.itemlink, p.plu_number, p.descriptor, v."Code", v."Name", h.consign, g.sales_budget"""

SAP = f"""
    SELECT {calendar('p.yearmonthday')}, {txt('p.yearmonthday', 'BizDate')}, b.banner AS "Banner", {txt('p.site', 'Location')},
        b.branch_name AS "Branch_Name", {division('h.dept')} AS "Division", h.dept || '-' || h.deptdesc AS "Dept",
        h.subdept || '-' || h.subdeptdesc AS "SubDept", h.category || '-' || h.categorydesc AS "Category",
        {txt('p.article', 'Itemcode')}, h.description AS "description", h.itemlink AS "ItemLink",
        v."Code" || '-' || v."Name" AS "Vendor", {dbl('sum(p.sales_qty_sales_uom)', 'Qty')},
        {dbl('sum(p.sales_exclude_tax + p.promotion_sales_discount_value)', 'GrossSales_ext_Tax')},
        {dbl('sum(p.sales_include_tax)', 'Sales_with_Tax')}, {dbl('sum(p.promotion_sales_discount_value)', 'Discount')},
        {dbl('sum(p.sales_exclude_tax)', 'NetSales_ext_Tax')}, {dbl('sum(p.cogs_l3)', 'Cost')}, {dbl('sum(p.scan_margin_l4)', 'ScanMargin')},
        {big('0', 'TransCount')}, {dbl('0', 'AvgBasket')}, {dbl('sum(p.outright_sales_qty_base_uom)', 'Out_Qty')},
        {dbl('sum(p.outright_sales_exclude_tax)', 'Out_NS_E_T')}, {dbl('sum(p.consignment_sales_qty_base_uom)', 'Con_Qty')},
        {dbl('sum(p.consignment_sales_exclude_tax)', 'Con_NS_E_T')}, {dbl('sum(p.sales_exclude_tax)', 'NS_E_T')},
        {dbl('0', 'LastCost')}, {dbl('0', 'FIFOCost')}, {dbl('ifnull(g.sales_budget, 0)', 'Budget')},
        CAST(NULL AS VARCHAR) AS "Parent_Item", 'SAP' AS "POSType"
    FROM pos_sap p LEFT JOIN h_im h ON CAST(p.article AS VARCHAR) = h.itemcode
    LEFT JOIN budgets g ON p.yearmonthday = g.day AND CAST(p.site AS VARCHAR) = g.site AND h.subdept = g.category
    LEFT JOIN vendors v ON CAST(p.site AS VARCHAR) = v."Location" AND CAST(p.article AS VARCHAR) = v."Itemcode"
    LEFT JOIN branch b ON CAST(p.site AS VARCHAR) = b.branch_code
    GROUP BY p.yearmonthday, b.banner, p.site, b.branch_name, p.article, h.dept, h.deptdesc, h.subdept, h.subdeptdesc,
        h.category, h.categorydesc, h.description, h.itemlink, v."Code", v."Name", g.sales_budget"""

UNION = f"{PANDA} UNION ALL {SRP} UNION ALL {SAP}"

ROLLING = f"""
    SELECT {calendar('bizdate', 'Calendar Day Month')}, bizdate, branch, {division('dept')} AS division, dept, itemcode, description, banner,
        qty, avgdailysales,
        sum(qty) OVER (PARTITION BY branch, itemcode ORDER BY bizdate RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) / 30 AS a30,
        sum(qty) OVER (PARTITION BY branch, itemcode ORDER BY bizdate RANGE BETWEEN INTERVAL 89 DAYS PRECEDING AND CURRENT ROW) / 90 AS a90
    FROM (SELECT s.extract_day - 1 AS bizdate, i.dept, s.itemcode, i.description, s.branch, b.banner,
                 coalesce(sum(p.qty), 0) AS qty, s.avgdailysales
          FROM (SELECT DISTINCT extract_day, branch, itemcode, avgdailysales FROM stock_daily) s
          LEFT JOIN branch b ON s.branch = b.branch_code
          LEFT JOIN item i ON s.itemcode = i.itemcode
          LEFT JOIN pos_group p ON s.extract_day - 1 = p.bizdate AND s.itemcode = p.itemcode AND s.branch = p.location
          GROUP BY s.extract_day, p.bizdate, i.dept, s.itemcode, i.description, s.branch, b.banner, s.avgdailysales)"""


def rolled(where: str = "TRUE") -> str:
    return f"""
    SELECT "Calendar Year", "Calendar Month", "WeekYear", "Wk", "Calendar Day Week", {txt('bizdate', 'BizDate')}, branch AS "Location",
        division AS "Division", dept AS "Dept", itemcode AS "Itemcode", description AS "Description", banner AS "Banner",
        {dbl('qty', 'Qty')}, {dbl('avgdailysales', 'AvgDailySales')}, {dbl('a30', 'ADS_RL30')}, {dbl('a90', 'ADS_RL90')}
    FROM ({ROLLING}) WHERE {where}"""


PO_LABELS = f"""{calendar('podate', 'Wk')}, {txt('podate', 'POM_PODate')}, {txt('deliverdate', 'POM_DeliveryDate')},
    strftime(deliverdate, '%m.%b') AS "DeliveryMonth", {wk_num('deliverdate')} AS "Calendar_WkNum",
    {day_week('deliverdate')} AS "Day_Week", {txt('expiry_date', 'POM_ExpiryDate')}, billstatus AS "POM_BillStatus",
    issuedby AS "POM_IssuedBy", scode AS "POM_SCode", sname AS "POM_SName", remark AS "POM_Remark", {big('ibt', 'POM_IBT')},
    {ORDER_TYPE} AS "POM_OrderType", {big('cancel', 'POM_Cancel')}, {big('closed', 'POM_Closed')}, {big('completed', 'POM_Completed')},
    {dbl('total', 'POM_Total')}, {big('line', 'POC_Line')}, entrytype AS "POC_EntryType", pricetype AS "POC_PriceType",
    x.itemcode AS "POC_Itemcode", il.Dept AS "Dept", il.SubDept AS "SubDept", il.Category AS "Category",
    x.description AS "POC_Desc", um AS "POC_UM", {dbl('qty', 'POC_Qty')}, {dbl('bulkqty', 'POC_BulkQty')}, umbulk AS "POC_UMBulk",
    {dbl('bqty', 'POC_BQty')}, {dbl('unitprice', 'POC_UnitPrice')}, {dbl('s.ads', 'IM_BS_ads')}, {dbl('totalprice', 'POC_TotalPrice')},
    m_refno AS "POM_RefNo", g_refno AS "GRM_RefNo", g_location AS "GRM_Location", {txt('g_docdate', 'GRM_DocDate')},
    g_code AS "GRM_Code", {big('g_line', 'GRC_Line')}, g_itemcode AS "GRC_Itemcode", g_desc AS "GRC_Desc", {dbl('g_qty', 'GRC_Qty')},
    {dbl('poqty', 'GRC_POQty')}, {dbl('g_bulkqty', 'GRC_BulkQty')}, g_umbulk AS "GRC_UMBulk", {dbl('g_bqty', 'GRC_BQty')},
    {dbl('g_unitprice', 'GRC_UnitPrice')}, {dbl('g_totalprice', 'GRC_TotalPrice')}"""

FILE_TOTALS = "SELECT loc AS location, date, sum(quantity) AS q, sum(item_paid_price) AS s FROM pos_srp GROUP BY loc, date"
ADJUSTED = "CASE WHEN b.adjtype = 'OUT' THEN b.{x} * -1 ELSE b.{x} END"


def horizon(division: str, since: str) -> str:
    return f"SELECT * FROM ({UNION}) WHERE \"Dept\" LIKE '{division}%' AND {since}"


def itemmaster(banner: str, status: str) -> str:
    return f"""
    SELECT b.banner AS "Banner", s.branch, b.branch_name, {division('i.dept')} AS "Division", i.dept AS "Dept", i.subdept AS "SubDept",
        i.itemcode AS "Itemcode", i.description AS "Description", {dbl('i.averagecost', 'AverageCost')}, {dbl('s.qoh', 'QOH')},
        {dbl('i.fifocost', 'FIFOCOST')}, {dbl('i.lastcost', 'LastCost')}, {big('s.ib_status', 'ib_status')}
    FROM item i LEFT JOIN item_branch_stock s ON i.itemcode = s.itemcode LEFT JOIN branch b ON s.branch = b.branch_code
    WHERE (i.dept LIKE '1%' OR i.dept LIKE '3%') AND {status} AND b.banner LIKE '%{banner}%'"""


def slices(order: str) -> str:
    return f"""SELECT branch_code, {txt('date', 'date')}, quantity,
    CAST((row_number() OVER (ORDER BY {order}, quantity) - 1) // 5000 + 1 AS BIGINT) AS file_ver FROM pos_srp"""


def all_sql() -> dict[str, str]:
    bodies = {
        "src_csv_thousands": f"""SELECT plu_number, descriptor, {dbl('total_qty_sales', 'total_qty_sales')},
            {dbl('total_sales', 'total_sales')}, {dbl('total_margin', 'total_margin')} FROM file_rows""",
        "src_tree_union": f"""SELECT plu_number, descriptor, {dbl('total_qty_sales', 'total_qty_sales')},
            {dbl('total_sales', 'total_sales')}, {dbl('total_margin', 'total_margin')},
            CASE WHEN quarter(date) % 2 = 0 THEN 'checked' END AS remarks FROM file_rows""",
        "src_filename_cols": f"SELECT location, {txt('date', 'date')}, plu_number, {dbl('total_qty_sales', 'total_qty_sales')} FROM file_rows",
        "src_latest_file": f"""SELECT location, {txt('date', 'date')}, count(*) AS n_rows, {dbl('sum(total_qty_sales)', 'total_qty_sales')},
            {dbl('sum(total_margin)', 'total_margin')} FROM file_rows GROUP BY location, date""",
        "src_bad_rows": """SELECT plu_number, count(*) AS rows_read, count(*) - count(total_sales) AS rows_rejected
            FROM file_rows GROUP BY plu_number""",
        "snk_replace_by_location": f"SELECT location, {txt('date', 'date')}, {dbl('q', 'total_qty_sales')}, {dbl('s', 'total_sales')} FROM ({FILE_TOTALS})",
        "snk_append_aligned": f"""SELECT location, {txt('date', 'date')}, {dbl('q', 'total_qty_sales')}, {dbl('s', 'total_sales')} FROM ({FILE_TOTALS})
            UNION ALL SELECT location, CAST(date AS VARCHAR), CAST(q AS DOUBLE), NULL FROM ({FILE_TOTALS})""",
        "snk_reload_partition": f"""SELECT loc AS location, {txt("CAST(date_trunc('quarter', date) AS DATE)", 'date')}, {dbl('sum(quantity)', 'total_qty_sales')},
            {dbl("sum(item_paid_price) * CASE WHEN quarter(date_trunc('quarter', date)) % 2 = 1 THEN 2 ELSE 1 END", 'total_sales')}
            FROM pos_srp WHERE quarter(date) <> 2 GROUP BY loc, date_trunc('quarter', date)""",
        "snk_create_view": f"""SELECT "Dept", count(*) AS n_rows, sum("Qty") AS "Qty" FROM ({UNION})
            WHERE ("Dept" LIKE '1%' AND "BizDate" BETWEEN '2001-05-01' AND '2001-06-30')
                OR ("Dept" LIKE '2%' AND "BizDate" BETWEEN '2000-01-01' AND '2001-06-30') OR "Dept" LIKE '3%' GROUP BY "Dept" """,
        "src_script_params": f"SELECT itemcode, dept, {dbl('fifocost', 'fifocost')} FROM item WHERE dept LIKE '3%' AND fifocost >= 10",
        "src_script_folder": f"SELECT dept, count(*) AS n_items, {dbl('max(fifocost)', 'fifocost')} FROM item WHERE dept LIKE '2%' GROUP BY dept",
        "snk_sliced_csv": slices("branch_code, date"),
        "snk_txt_slices": slices("date, branch_code"),
        "snk_fixed_width": """
            WITH rows AS (SELECT branch_code, plu_number, CAST(date AS VARCHAR) AS date, CAST(CAST(quantity AS INT) AS VARCHAR) AS quantity,
                CAST((row_number() OVER (ORDER BY date, branch_code, plu_number, quantity) - 1) // 5000 + 1 AS BIGINT) AS file_ver FROM pos_srp),
            w AS (SELECT file_ver, greatest(max(length(branch_code)), 11) AS a, greatest(max(length(plu_number)), 10) AS b,
                greatest(max(length(date)), 4) AS c, greatest(max(length(quantity)), 8) AS d FROM rows GROUP BY file_ver)
            SELECT file_ver, lpad('branch_code', a::INT, ' ') || ' ' || lpad('plu_number', b::INT, ' ') || ' ' || lpad('date', c::INT, ' ')
                || ' ' || lpad('quantity', d::INT, ' ') AS line FROM w
            UNION ALL SELECT file_ver, lpad(branch_code, a::INT, ' ') || ' ' || lpad(plu_number, b::INT, ' ') || ' ' || lpad(date, c::INT, ' ')
                || ' ' || lpad(quantity, d::INT, ' ') FROM rows JOIN w USING (file_ver)""",
        "snk_calendar_path": f"""SELECT dept AS "Dept", itemcode, sum(qty) AS qty, CAST(2001 AS BIGINT) AS year, 'June' AS month,
            {EXPORT.format(x='dept')} AS division FROM pos_panda WHERE dept < '7' GROUP BY dept, itemcode""",
        "prj_snake_case": """SELECT plu_number, descriptor AS item_descriptor, format('{:,.1f}', quantity) AS total_qty_sales,
            CASE WHEN CAST(receipt_number AS BIGINT) % 41 = 0 THEN 'n/a' ELSE format('{:,.2f}', CAST(item_paid_price AS DOUBLE)) END AS total_sales,
            format('{:,.2f}', quantity * 125) AS total_margin FROM pos_srp""",
        "flt_like_prefix": "SELECT itemcode, dept FROM item WHERE dept LIKE '1%' OR dept LIKE '3%'",
        "flt_not_like": """SELECT itemcode, dept FROM (SELECT itemcode, CASE WHEN consign = 0 THEN dept END AS dept FROM item) i
            WHERE dept NOT LIKE '7%' AND dept NOT LIKE '8%'""",
        "flt_yesterday": f"SELECT {txt('bizdate', 'bizdate')}, location, itemcode, qty FROM pos_all WHERE bizdate = DATE '1998-06-29'",
        "flt_prev_year_to_date": f"""SELECT {txt('bizdate', 'bizdate')}, sum(qty) AS qty FROM pos_panda
            WHERE bizdate BETWEEN DATE '2000-01-01' AND DATE '2001-06-30' GROUP BY bizdate""",
        "flt_prev_month_to_date": f"""SELECT {txt('bizdate', 'bizdate')}, sum(qty) AS qty FROM pos_panda
            WHERE bizdate BETWEEN DATE '2001-05-01' AND DATE '2001-06-30' GROUP BY bizdate""",
        "join_header_lines": f"""SELECT m.refno, {txt('podate', 'podate')}, {big('line', 'line')}, itemcode, qty, {dbl('totalprice', 'totalprice')}
            FROM po_main m JOIN po_child c ON m.refno = c.refno""",
        "join_item_hierarchy": "SELECT itemcode, dept, deptdesc, subdept, subdeptdesc, category, categorydesc FROM h_im",
        "join_left_composite": f"""SELECT {txt('p.bizdate', 'bizdate')}, p.location, p.itemcode, p.qty, {dbl('c.fifocost', 'fifocost')},
            {dbl('c.lastcost', 'lastcost')} FROM pos_panda p LEFT JOIN item_cost c ON p.itemcode = c.itemcode AND p.location = c.branch""",
        "join_shifted_date": f"""SELECT {txt('s.extract_day', 'extract_day')}, s.branch, s.itemcode, s.qoh, p.qty
            FROM stock_daily s LEFT JOIN (SELECT bizdate, location, itemcode, sum(qty) AS qty FROM pos_group GROUP BY ALL) p
            ON s.extract_day - 1 = p.bizdate AND s.branch = p.location AND s.itemcode = p.itemcode""",
        "join_code_prefix": f"""SELECT all_ft_po_refno, {big('all_ft_po_line', 'all_ft_po_line')}, all_ft_loc_code, d_to AS "DCR_LocTo", d_qty AS "DCRC_Qty"
            FROM po_alloc_ft LEFT JOIN dcr ON all_ft_po_refno = cross_ref AND all_ft_itemcode = d_itemcode AND all_ft_loc_code = left(d_to, 4)""",
        "join_left_suffix": """SELECT s.site, s.site_name AS site_name_excel, s.banner AS banner_excel, area, remarks_closed_store,
            l.site_name AS site_name_sheet, branch_add, l.banner AS banner_sheet FROM store_list s LEFT JOIN location_list l ON s.site = l.site""",
        "agg_sum_measures": f"""SELECT {txt('bizdate', 'bizdate')}, location, {dbl('sum(qty)', 'Qty')}, {dbl('sum(sumgrosssales)', 'GrossSales')},
            {dbl('sum(amount_after_tax)', 'Sales_with_Tax')}, {dbl('sum(sumdisc)', 'Discount')}, {dbl('sum(amount)', 'NetSales')},
            {dbl('sum(cost)', 'Cost')}, {dbl('sum(amount) - sum(cost)', 'ScanMargin')} FROM pos_panda GROUP BY bizdate, location""",
        "agg_distinct_receipts": 'SELECT location, count(DISTINCT refno) AS "TransCount" FROM pos_panda GROUP BY location',
        "agg_consign_split": f"""SELECT location, dept, {dbl('sum(CASE WHEN consign = 0 THEN qty ELSE 0 END)', 'Out_Qty')},
            {dbl('sum(CASE WHEN consign = 0 THEN amount ELSE 0 END)', 'Out_NS_E_T')}, {dbl('sum(CASE WHEN consign = 1 THEN qty ELSE 0 END)', 'Con_Qty')},
            {dbl('sum(CASE WHEN consign = 1 THEN amount ELSE 0 END)', 'Con_NS_E_T')} FROM pos_panda GROUP BY location, dept""",
        "agg_avg_basket": 'SELECT location, CAST(sum(amount) AS DOUBLE) / count(DISTINCT refno) AS "AvgBasket" FROM pos_panda GROUP BY location',
        "agg_receipt_grains": """SELECT CAST(CAST(date_trunc('month', bizdate) AS DATE) AS VARCHAR) AS month, location, NULL AS dept,
            count(DISTINCT refno) AS "TransCount", CAST(sum(amount) AS DOUBLE) / count(DISTINCT refno) AS "AvgBasket"
            FROM pos_panda GROUP BY date_trunc('month', bizdate), location
            UNION ALL SELECT NULL, NULL, dept, count(DISTINCT refno), CAST(sum(amount) AS DOUBLE) / count(DISTINCT refno) FROM pos_panda GROUP BY dept""",
        "agg_net_clamp": f"""SELECT {txt('date', 'date')}, branch_code, plu_number, {dbl(DISCOUNT, 'Discount')},
            {dbl(f'greatest(ifnull(sum(p.item_paid_price), 0) - ({DISCOUNT}), 0)', 'NetPrice')} FROM pos_srp p GROUP BY date, branch_code, plu_number""",
        "agg_zero_filled": f"""SELECT s.branch, s.itemcode, {txt('s.extract_day', 'extract_day')}, coalesce(sum(p.qty), 0) AS qty
            FROM stock_daily s LEFT JOIN pos_group p ON s.extract_day - 1 = p.bizdate AND s.branch = p.location AND s.itemcode = p.itemcode
            GROUP BY s.branch, s.itemcode, s.extract_day""",
        "agg_daily_totals": f"""SELECT {txt('date', 'date')}, sum(quantity) AS quantity, {dbl('sum(item_paid_price)', 'item_paid_price')},
            {dbl('sum(discount)', 'discount')} FROM pos_srp GROUP BY date""",
        "agg_dedup_first": f"""SELECT branch_code, plu_number, {txt('date', 'date')}, receipt_number, quantity FROM pos_srp
            QUALIFY row_number() OVER (PARTITION BY branch_code, plu_number ORDER BY date, receipt_number, quantity) = 1""",
        **{
            f"win_ads_{n}": f"""SELECT location, itemcode, {txt('bizdate', 'bizdate')}, qty, sum(qty) OVER (PARTITION BY location, itemcode
            ORDER BY bizdate RANGE BETWEEN INTERVAL {n - 1} DAYS PRECEDING AND CURRENT ROW) / {n} AS ads_rl{n}
            FROM (SELECT location, itemcode, bizdate, sum(qty) AS qty FROM pos_all GROUP BY ALL)"""
            for n in (30, 90)
        },
        "set_union_all": f"""SELECT "POSType", "BizDate", count(*) AS n_rows, sum("Qty") AS "Qty", CAST(sum("TransCount") AS BIGINT) AS "TransCount",
            count("Parent_Item") AS n_parent_known FROM ({UNION}) GROUP BY "POSType", "BizDate" """,
        "set_union_by_name": "SELECT * FROM store_list UNION ALL BY NAME SELECT * FROM location_list",
        "cal_labels": f"""SELECT {txt('d', 'd')}, 'Yr' || strftime(d, '%Y') AS y, strftime(d, '%m. %b') AS m, strftime(d, '%m. %d') AS dm,
            strftime(d, '%b %Y') AS label FROM days""",
        "cal_week_year": f"""SELECT {txt('d', 'd')}, CAST(strftime(d, '%W') AS BIGINT) AS week_monday, {week_year('d')} AS "WeekYear", {wk('d')} AS "Wk" FROM days""",
        "cal_day_week": f"SELECT {txt('d', 'd')}, {day_week('d')} AS day_week FROM days",
        "cal_delivery": f"""SELECT {txt('d', 'd')}, strftime(d, '%m.%b') AS "DeliveryMonth", {wk_num('d')} AS "Calendar_WkNum" FROM days""",
        "cal_parse": f"SELECT site, category, date, {txt('strptime(date, ' + chr(39) + '%Y%m%d' + chr(39) + ')::DATE', 'parsed')}, {dbl('sales_budget', 'sales_budget')} FROM budget",
        "cal_dimension": f"""SELECT DISTINCT {txt('bizdate', 'bizdate')}, strftime(bizdate, '%b %Y') AS "Month", {week_year('bizdate')} AS "WeekYear",
            {wk('bizdate')} AS "Wk", {day_week('bizdate')} AS "Calendar Day Week" FROM pos_panda""",
        "cls_division": f"""SELECT itemcode, {division('d')} AS "Division", {EXPORT.format(x='d')} AS "Export"
            FROM (SELECT itemcode, CASE WHEN consign = 0 THEN dept END AS d FROM item)""",
        "cls_order_type": f'SELECT refno, {ORDER_TYPE} AS "OrderType" FROM po_main',
        "cls_delivery_status": f"""SELECT m_refno AS "POM_RefNo", {big('line', 'POC_Line')}, itemcode AS "POC_Itemcode", {big('g_line', 'GRC_Line')},
            {STATUS} AS "Delivery_Status" FROM po_gr""",
        "cls_adjust_sign": f"""SELECT refno, itemcode, adjtype, {ADJUSTED.format(x='qty')} AS qty, {dbl(ADJUSTED.format(x='unitprice'), 'unitprice')},
            {dbl(ADJUSTED.format(x='totalprice'), 'totalprice')} FROM adjust_child b""",
        "cls_final_value": f"""SELECT m_refno AS "POM_RefNo", {big('line', 'POC_Line')}, itemcode AS "POC_Itemcode", {big('g_line', 'GRC_Line')},
            {dbl('CASE WHEN g_ibt = 0 THEN g_totalprice ELSE 0 END', 'gr_value')}, {dbl('CASE WHEN ibt = 0 THEN totalprice ELSE 0 END', 'po_value')} FROM po_gr""",
        "cls_completion": f"""SELECT m_refno AS "POM_RefNo", {big('line', 'POC_Line')}, itemcode AS "POC_Itemcode", {big('g_line', 'GRC_Line')},
            ifnull(g_qty, 0) / nullif(ifnull(qty, 0), 0) AS completion, CAST(NULL AS DOUBLE) AS nothing_ordered FROM po_gr""",
        "cls_parent_item": """SELECT itemcode, CASE WHEN link = itemcode THEN 'true' ELSE 'false' END AS "Parent_Item"
            FROM (SELECT itemcode, CASE WHEN consign = 0 THEN itemlink END AS link FROM item)""",
        "cls_banner": "SELECT site, site_name, banner FROM normal_banner",
        "cls_code_label": "SELECT itemcode, itemcode || '-' || CASE WHEN consign = 0 THEN description END AS label FROM item",
        "cls_vendor": "SELECT * FROM vendors",
        "cls_priority_vendor": f"""SELECT DISTINCT s.itemcode AS "Itemcode", s.branch AS "Location", v.code AS "Code", v.name AS "Name",
            {big('k.priority_vendor', 'priority_vendor')} FROM item_branch_stock s LEFT JOIN supplier_code v ON s.ib_sup_code = v.code
            LEFT JOIN item_supplier k ON s.ib_sup_code = k.code WHERE k.priority_vendor = 0""",
        "fn_string": f"""SELECT refno, 'Yr' || CAST(year(docdate) AS VARCHAR) AS concat_int, trim('  ' || reason || ' ') AS trimmed,
            lpad(refno, 4, '0') AS padded, {week('docdate')} AS week, left(reason, 4) AS head FROM adjust_main""",
        "fn_math": f"""SELECT refno, itemcode, {dbl('floor(x * 100 + 0.5) / 100', 'half_up')}, {dbl('round_even(x, 2)', 'half_even')},
            CAST(refno AS BIGINT) % 7 AS modulo
            FROM (SELECT DISTINCT refno, itemcode, totalprice * 0.125 AS x FROM adjust_child)""",
        "fn_null": f"""SELECT receipt_number, plu_number, {dbl('coalesce(staff_discount, 0)', 'staff')}, {dbl('ifnull(staff_discount, discount)', 'either')} FROM pos_srp""",
        "dq_reconcile": f"""SELECT {txt('coalesce(e.date, a.date)', 'date')}, {dbl('round(e.total_qty_sales, 2)', 'expected_total_qty_sales')},
            {dbl('round(a.q, 2)', 'cur_total_qty_sales')}, {dbl('round(e.total_sales, 2)', 'expected_total_sales')}, {dbl('round(a.s, 2)', 'cur_total_sales')},
            {dbl('round(e.total_margin, 2)', 'expected_total_margin')}, {dbl('round(a.m, 2)', 'cur_total_margin')}, 'true' AS different
            FROM expected_totals e FULL JOIN (SELECT date, sum(quantity) AS q, sum(item_paid_price) AS s, sum(discount) AS m FROM pos_srp GROUP BY date) a
            ON e.date = a.date WHERE round(e.total_qty_sales, 2) IS DISTINCT FROM round(a.q, 2)
            OR round(e.total_sales, 2) IS DISTINCT FROM round(a.s, 2) OR round(e.total_margin, 2) IS DISTINCT FROM round(a.m, 2)""",
        "dq_missing_keys": f"""SELECT {txt('d.date', 'date')}, l.location
            FROM (SELECT DISTINCT bizdate AS date FROM pos_panda) d
            CROSS JOIN (SELECT DISTINCT CAST(CAST(branch_code AS INT) % 6 + 1216 AS VARCHAR) AS location FROM branch) l
            WHERE NOT EXISTS (SELECT 1 FROM pos_srp p WHERE p.date = d.date AND p.loc = l.location)""",
        "dq_verify_load": f"""SELECT w.location, {txt('w.date', 'date')}, CASE WHEN a.q IS NULL THEN 'Verification failed' ELSE 'Success' END AS status
            FROM (SELECT DISTINCT CAST(CAST(location AS INT) % 6 + 1216 AS VARCHAR) AS location, bizdate AS date FROM pos_panda) w
            LEFT JOIN (SELECT loc, date, sum(quantity) AS q FROM pos_srp GROUP BY loc, date) a ON a.loc = w.location AND a.date = w.date""",
        "dq_duplicates": """SELECT 'branch_code' AS key_set, count(*) - count(DISTINCT branch_code) AS duplicates FROM pos_srp
            UNION ALL SELECT 'branch_code,plu_number', count(*) - count(DISTINCT (branch_code, plu_number)) FROM pos_srp
            UNION ALL SELECT 'branch_code,plu_number,date', count(*) - count(DISTINCT (branch_code, plu_number, date)) FROM pos_srp""",
        "dq_nonunique": 'SELECT plu_number, branch_code, count(*) AS "rows" FROM pos_srp GROUP BY plu_number, branch_code HAVING count(*) <> 1',
        "rpt_possales_panda": PANDA,
        "rpt_possales_srp": SRP,
        "rpt_possales_sap": SAP,
        "rpt_possales_union": UNION,
        "rpt_possales_stored": UNION,
        "rpt_rolling_stored": rolled("bizdate BETWEEN DATE '2001-06-26' AND DATE '2001-06-29'"),
        "rpt_rolling_ads": rolled(),
        "rpt_adjustments": f"""SELECT {calendar('a.docdate')}, {txt('a.docdate', 'Date')}, b.location AS "Location", c.group_desc AS "Division",
            b.dept || '-' || c.deptdesc AS "Dept", b.subdept || '-' || c.subdeptdesc AS "SubDept", b.category || '-' || c.categorydesc AS "Category",
            b.itemcode AS "Itemcode", b.description AS "Description", b.adjtype AS "AdjType", a.reason AS "Reason", a.refno AS "RefNo",
            b.um AS sales_unit_uom, {dbl(ADJUSTED.format(x='qty'), 'Qty')}, {dbl(ADJUSTED.format(x='unitprice'), 'UnitPrice')},
            {dbl(ADJUSTED.format(x='totalprice'), 'TotalPrice')}
            FROM adjust_main a LEFT JOIN adjust_child b ON a.refno = b.refno JOIN hierarchy c ON b.category = c.category""",
        "rpt_po_gr": f"""SELECT {PO_LABELS}, x.location AS "POM_Location", b.banner AS "Banner", dono AS "GRM_DONo", invno AS "GRM_InvNo",
            g_name AS "GRM_Name", receivedby AS "GRM_ReceivedBy", g_remark AS "GRM_Remark", {dbl('g_total', 'GRM_Total')}, {big('g_ibt', 'GRM_IBT')},
            {dbl('CASE WHEN g_ibt = 0 THEN g_totalprice ELSE 0 END', 'Final GR Value')}, {dbl('CASE WHEN ibt = 0 THEN totalprice ELSE 0 END', 'Final PO Value')},
            {STATUS} AS "Delivery_Status", ifnull(g_qty, 0) / nullif(ifnull(qty, 0), 0) AS "Completion_Percentage"
            FROM po_gr x JOIN item_labels il ON x.itemcode = il.itemcode LEFT JOIN branch b ON x.location = b.branch_code
            LEFT JOIN item_branch_stock s ON x.itemcode = s.itemcode AND x.location = s.branch""",
        "rpt_po_gr_dc": f"""SELECT {PO_LABELS}, x.location || ' - ' || bp.branch_name AS "POM_Location", bp.banner AS "POM_Banner",
            ft.all_ft_loc_code || ' - ' || bf.branch_name AS "POCFT_Location", bf.banner AS "POCFT_Banner", ft.all_ft_cross_ref AS "POCFT_CrossRef",
            ft.all_ft_qty AS "POCFT_Qty", ft.all_ft_case_qty AS "POCFT_CaseQty", porefno AS "GRC_PORefNo", d_refno AS "DCR_RefNo",
            {big('d_ibt', 'DCR_IBT')}, {big('d_ibt_status', 'DCR_IBT_Status')}, d_to AS "DCR_LocTo", {txt('d_docdate', 'DCR_DocDate')}, d_from AS "DCR_LocFrom",
            {big('d_line', 'DCRC_line')}, d_itemcode AS "DCRC_Itemcode", d_desc AS "DCRC_Description", qty_outstanding AS "DCRC_Qty_Outstanding",
            d_qty AS "DCRC_Qty", qty_actual AS "DCRC_Actual_Qty", qty_amend AS "DCRC_Amend_Qty", {dbl('bulksize', 'DCRC_BulkSize')}, bulkum AS "DCRC_BulkUM",
            {dbl('packsize', 'DCRC_PackSize')}, {dbl('d_unitprice', 'DCRC_UnitPrice')}, {dbl('netamount', 'DCRC_NetAmount')}
            FROM po x LEFT JOIN po_alloc_ft ft ON x.m_refno = ft.all_ft_po_refno AND x.line = ft.all_ft_po_line AND x.itemcode = ft.all_ft_itemcode
            LEFT JOIN gr ON x.m_refno = porefno AND x.itemcode = g_itemcode AND x.pricetype = g_pricetype
            LEFT JOIN dcr ON ft.all_ft_po_refno = cross_ref AND ft.all_ft_itemcode = d_itemcode AND ft.all_ft_loc_code = left(d_to, 4)
            JOIN item_labels il ON x.itemcode = il.itemcode LEFT JOIN branch bp ON x.location = bp.branch_code
            LEFT JOIN branch bf ON ft.all_ft_loc_code = bf.branch_code
            LEFT JOIN item_branch_stock s ON x.itemcode = s.itemcode AND x.location = s.branch""",
        "rpt_itemmaster_stock": itemmaster("Hyper", "s.ib_status = 0"),
        "rpt_itemmaster_inactive": itemmaster("Mini", "s.ib_status <> 0"),
        "rpt_stock_take": f"""SELECT CAST(s.extract_day - 1 AS VARCHAR) AS "BizDate", s.branch, b.branch_name, {division('s.dept')} AS "Division", s.dept AS "Dept", s.deptdesc,
            s.subdept AS "Subdept", s.subdeptdesc AS "Subdeptdesc", s.category AS "Category", s.categorydesc AS "Categorydesc", s.itemcode AS "Itemcode",
            s.description AS "Description", s.qoh AS "QOH", {dbl('s.lastcost', 'LastCost')}
            FROM stock_daily s LEFT JOIN branch b ON s.branch = b.branch_code WHERE CAST(s.extract_day AS VARCHAR) IN ('2000-03-15', '1999-11-03', '1998-07-21', '1997-02-10', '1996-05-05', '1995-12-30') AND b.banner LIKE '%Super%'""",
        "rpt_landlord_eod": f"""SELECT 'CORNER_' || strftime(p.bizdate, '%Y%m%d') AS "EOD_ID", 'CORNER' AS "OUTLET_NAME", 'CORNER_001' AS "POS_NAME",
            strftime(p.bizdate, '%d-%m-%Y') AS "EOD_DATE", {dbl('round(sum(p.amount), 2)', 'TOTAL_SALES')}, {dbl('round(sum(p.amount) + sum(p.sumdisc), 2)', 'GROSS_SALES')},
            count(DISTINCT p.refno) AS "TRAN_COUNT", {big('0', 'VOID_TRAN_COUNT')}, {dbl('0', 'SERVICE_CHARGE')}, {dbl('round(sum(p.sumdisc), 2)', 'DISCOUNT_AMT')},
            {dbl('0', 'VAT_TAX_AMT')}, {dbl('0', 'SVC_TAX_AMT')}, {dbl('0', 'ROUNDING_ADJ')}
            FROM pos_panda p LEFT JOIN item i ON p.itemcode = i.itemcode
            WHERE i.dept NOT LIKE '7%' AND i.dept NOT LIKE '8%' AND p.location = '1005' GROUP BY p.bizdate, p.location""",
        "rpt_daily_extract": rolled("bizdate = DATE '2001-06-29' AND dept < '7'"),
        "rpt_commercial_day": horizon("1", "\"BizDate\" BETWEEN '2001-05-01' AND '2001-06-30'"),
        "rpt_commercial_week": horizon("2", "\"BizDate\" BETWEEN '2000-01-01' AND '2001-06-30'"),
        "rpt_commercial_month": horizon("3", "TRUE"),
        "rpt_store_list": """
            SELECT a.site, a.site_name AS site_name_excel, a.area, l.branch_add, a.banner, l.banner AS "Banner_old", a.remarks_closed_store
            FROM (SELECT * FROM both_sheets QUALIFY row_number() OVER (PARTITION BY site ORDER BY src, site_name, banner) = 1) a
            LEFT JOIN location_list l ON a.site = l.site""",
        "rpt_store_list_combined": """
            SELECT site, site_name, banner, area, remarks_closed_store FROM both_sheets
            QUALIFY row_number() OVER (PARTITION BY site, site_name, banner ORDER BY src) = 1""",
        "rpt_pos_ingest": f"""SELECT plu_number, descriptor, {dbl('total_qty_sales', 'total_qty_sales')}, {dbl('total_sales', 'total_sales')},
            {dbl('total_margin', 'total_margin')}, location, {txt('date', 'date')} FROM (SELECT * FROM file_rows
            UNION ALL SELECT plu_number, descriptor, 1000.5, total_sales, total_margin, location, date FROM file_rows WHERE month(date) = 1) f""",
        "rpt_backfill": f"""SELECT location, {txt('date', 'date')}, CAST(sum(CASE WHEN month(date) = 1 THEN 1000.5 ELSE total_qty_sales END) AS DOUBLE) AS total_qty_sales,
            CASE WHEN month(date) <> 1 THEN 'Success' END AS status FROM file_rows GROUP BY location, date""",
    }
    bodies |= {f"{name}_stored": bodies[name] for name in ("rpt_po_gr", "rpt_po_gr_dc")}
    return {name: sql(body) if not body.lstrip().startswith("WITH") else _nested(body) for name, body in bodies.items()}


def _nested(body: str) -> str:
    """A body with common table expressions of its own, put behind the sample tables'."""
    head = sql(body)
    return head.replace("\n" + body, ",\n" + body.lstrip()[len("WITH"):])
