"""Business classifications as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Division label by the first digit of a department code.
DIVISIONS = {
    "1": "1 - GROCERY",
    "2": "2 - FRESH",
    "3": "3 - PERISHABLE",
    "4": "4 - NON FOODS",
    "5": "5 - HEALTH & BEA",
    "6": "6 - GMS",
    "7": "7 - SERVICES",
    "8": "8 - NON TRADE",
}
OTHER_DIVISION = "9 - OTHER"

# Folder label of an exported division; two labels differ from DIVISIONS.
EXPORT_DIVISIONS = {
    "1": "1 - GROCERY",
    "2": "2 - FRESH",
    "3": "3 - PERISHABLES",
    "4": "4 - NON FOODS",
    "5": "5 - HEALTH & BEAUTY",
    "6": "6 - GMS",
}

# Purchase order type label by code.
ORDER_TYPES = {0: "00-DSP/Con", 1: "01-Flow-through", 9: "09-NT-DSP", 99: "99-NT"}

# Store-list banner names.
SUPERMARKET = "02.SUPERMARKET"
SUPERMARKET_TMC = "02. TMC - SUPERMARKET"
HYPERMARKET = "02.HYPERMARKET"
HYPERMARKET_TMC = "02. TMC - HYPERMARKET"
UPSCALE = "03.UPSCALE"
MINI = "04.GIANT MINI"
DC_MAIN = "06.DISTRIBUTION CENTRE - GIANT"
DC_MINI = "07.DISTRIBUTION CENTRE - GIANT MINI"


def _labels(key: Column, table: dict) -> Column:
    """Label of ``key`` in a small fixed table, NULL when absent."""
    chain = None
    for code, label in table.items():
        chain = F.when(key == code, label) if chain is None else chain.when(key == code, label)
    return chain


def division(dept: Column) -> Column:
    """Division by the first digit; anything else, NULL included, is ``9 - OTHER``."""
    return F.coalesce(_labels(F.substring(dept, 1, 1), DIVISIONS), F.lit(OTHER_DIVISION))


def export_division(dept: Column) -> Column:
    """Folder label of a division; NULL for divisions that are not exported."""
    return _labels(F.substring(dept, 1, 1), EXPORT_DIVISIONS)


def order_type(code: Column) -> Column:
    return _labels(code, ORDER_TYPES)


def delivery_status(
    gr_qty: Column, gr_po_qty: Column, po_qty: Column, expiry: Column, as_of: Column
) -> Column:
    """Delivery state of an order line.

    The received quantity is held against both the quantity noted on the receipt and the
    quantity on the order, a missing quantity counting as 0 in the latter. Whatever is neither
    over nor full is short, so the remaining classes follow from the expiry date and from
    whether anything has arrived. A line with no expiry date is ``Others``.
    """
    got = F.coalesce(gr_qty, F.lit(0))
    ordered = F.coalesce(po_qty, F.lit(0))
    still_open = as_of <= expiry
    return (
        F.when((gr_qty > gr_po_qty) | (got > ordered), "Over Delivery")
        .when((gr_qty == gr_po_qty) | (got == ordered), "Full Delivery")
        .when(still_open & (got > 0), "Partial Delivery")
        .when(still_open & (got == 0), "No Delivery")
        .when(as_of > expiry, "Expired")
        .otherwise("Others")
    )


def signed(adj_type: Column, x: Column) -> Column:
    """Negative for outgoing adjustments."""
    return F.when(adj_type == "OUT", -x).otherwise(x)


def non_ibt(ibt: Column, x: Column) -> Column:
    """The value of documents that are not inter-branch transfers, else 0."""
    return F.when(ibt == 0, x).otherwise(F.lit(0))


def completion(gr_qty: Column, po_qty: Column) -> Column:
    """Received share of the ordered quantity; NULL where nothing was ordered."""
    zero = F.lit(0)
    return F.try_divide(F.coalesce(gr_qty, zero), F.coalesce(po_qty, zero))


def is_parent(link: Column, code: Column) -> Column:
    return F.coalesce(link == code, F.lit(False))


def code_label(code: Column, desc: Column, sep: str = "-") -> Column:
    """``code-desc``; NULL if either side is NULL."""
    return F.concat(code, F.lit(sep), desc)


def normalise_banner(banner: Column, site_name: Column) -> Column:
    """Store-list banner from a raw banner and the site's name.

    A missing site name counts as naming neither a TMC site nor a mini-market DC.
    """
    name = F.coalesce(site_name, F.lit(""))
    tmc = name.contains("TMC")
    mini_dc = name.contains("DC") & name.contains("Mini")
    return (
        F.when(banner == "Giant Super", F.when(tmc, SUPERMARKET_TMC).otherwise(SUPERMARKET))
        .when(banner == "Giant Hyper", F.when(tmc, HYPERMARKET_TMC).otherwise(HYPERMARKET))
        .when(banner.isin("Upscale", "UPSCALE"), UPSCALE)
        .when(banner == "Giant Mini", F.when(mini_dc, DC_MINI).otherwise(MINI))
        .when(banner == "Distribution Centre", F.when(mini_dc, DC_MINI).otherwise(DC_MAIN))
        .when(banner == "HQ", "")
        .otherwise(banner)
    )
