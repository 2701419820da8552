"""Account revenue, last transaction, deciles and sales history.

Transactions are summed per billing key before they meet the account table,
so an account with very many invoices is combined map-side and never forms a
hot join key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from linkledger.config import Settings, r60_window
from linkledger.functions import lists
from linkledger.functions.columns import lit, money, total
from linkledger.operators.ranking import Stage, equal_count_tile, in_global_order, ranges, share_tile

STREAMS = ("goods", "parts", "service", "rental")


def exprs(*texts: str) -> list[Column]:
    return [F.expr(t) for t in texts]


def in_window(when: str, start: dt.date, end: dt.date) -> str:
    """Both bounds are dates; a time on the last day is past its midnight and stays out."""
    return f"{when} BETWEEN {lit(start)} AND {lit(end)}"


def in_years(when: str, first: int, last: int) -> str:
    """Calendar years as a range on the bare column, so that the scan can prune."""
    return f"{when} >= {lit(dt.date(first, 1, 1))} AND {when} < {lit(dt.date(last + 1, 1, 1))}"


def billed(invoice: DataFrame) -> DataFrame:
    return invoice.filter("invo_type IN ('C', 'I')")


def _added(*names: str) -> str:
    return " + ".join(money(n) for n in names)


# Amounts of an invoice by stream; null where the invoice is of another module.
PARTS = f"CASE WHEN module_type = 'I' THEN {_added('parts_sale')} END"
PARTS_COST = f"CASE WHEN module_type = 'I' THEN {_added('parts_cost')} END"
SERVICE = f"CASE WHEN module_type = 'W' THEN {_added('parts_sale', 'labour_sale', 'sublet_sale', 'other_sale')} END"
SERVICE_COST = f"CASE WHEN module_type = 'W' THEN {_added('parts_cost', 'labour_cost', 'sublet_cost')} END"
INVOICE_DAY = "cast(invo_datetime AS date)"


def rentals(invoice: DataFrame, rental: DataFrame) -> DataFrame:
    """Invoices with rental lines and their rental sums.

    Kept apart from parts and service: those are summed straight from the scan,
    and only three narrow columns of invoices are shuffled to meet the rentals.
    """
    per_invoice = rental.groupBy(F.col("invoice_no").alias("document_no")).agg(*exprs(
        f"sum({money('rental_value')}) AS rental", f"sum({money('depr_book_value')}) AS rental_cost",
    ))
    return billed(invoice).select("document_no", "bill_to_acc", "invo_datetime").join(per_invoice, "document_no")


def unit_amounts(unit_sale: DataFrame, unit_accessory: DataFrame, *extra_keys: str) -> DataFrame:
    """Sale and cost of each unit to each owner; accessories count once per unit."""
    return _with_accessories(unit_sale, unit_accessory, extra_keys, {"goods": money("sales_value")}, (
        f"sum({_added(*lists.UNIT_COSTS)}) AS goods_cost", "count(unit_no) AS units"))


def _with_accessories(unit_sale, unit_accessory, extra_keys, sales: dict[str, str], others) -> DataFrame:
    """``others`` and the sums of ``sales`` of each unit to each owner, its accessories added to every sum.

    Both sides are summed before they are joined, so neither brings a hot unit.
    """
    units = unit_sale.groupBy("unit_no", "owner_code", *exprs(*extra_keys)).agg(*exprs(
        *(f"sum({amount}) AS {name}" for name, amount in sales.items()), *others))
    accessories = unit_accessory.groupBy("unit_no").agg(F.expr(f"sum({money('sale_value')}) AS _accessories"))
    # Without a sale in the window the sum is null, and so is the whole amount.
    return units.join(accessories, "unit_no", "left").selectExpr(
        *(c for c in units.columns if c not in sales),
        *(f"cast({name} + coalesce(_accessories, 0) AS decimal(18,2)) AS {name}" for name in sales))


def _owner(units: DataFrame, *keys: str):
    return units.groupBy(F.col("owner_code").alias("contact_code"), *keys)


def _biller(invoices: DataFrame, *keys: str):
    return invoices.groupBy(F.col("bill_to_acc").alias("account_no"), *exprs(*keys))


def per_account(account: DataFrame, by_owner: DataFrame, *by_biller: DataFrame) -> DataFrame:
    """Rows summed per owner code and per billing number, brought to account numbers."""
    billing = by_biller[0]
    for rows in by_biller[1:]:
        billing = billing.unionByName(rows, allowMissingColumns=True)
    owned = account.select("account_no", "contact_code").join(by_owner, "contact_code").drop("contact_code")
    return owned.unionByName(account.select("account_no").join(billing, "account_no"), allowMissingColumns=True)


def account_revenue(account, unit_sale, unit_accessory, invoice, rental, start: dt.date, end: dt.date) -> DataFrame:
    """Revenue per account in a window, by stream and in total."""
    units = unit_amounts(unit_sale.filter(in_window("sales_date", start, end)), unit_accessory)
    invoices = billed(invoice).filter(in_window("invo_datetime", start, end))
    rows = per_account(
        account,
        _owner(units).agg(F.expr(f"{total('goods')} AS goods")),
        _biller(invoices).agg(*exprs(f"{total(PARTS)} AS parts", f"{total(SERVICE)} AS service")),
        _biller(rentals(invoices, rental)).agg(F.expr(f"{total('rental')} AS rental")),
    )
    summed = rows.groupBy("account_no").agg(*exprs(*(f"coalesce({total(s)}, 0) AS {s}" for s in STREAMS)))
    return summed.selectExpr("*", f"cast({' + '.join(STREAMS)} AS decimal(18,2)) AS total_revenue")


def last_transaction(account, unit_sale, invoice, rental) -> DataFrame:
    """Latest unit, parts, service or rental date per account."""
    used = billed(invoice).filter("module_type IN ('I', 'W') AND invo_datetime IS NOT NULL")
    invoice_day = F.expr(f"max({INVOICE_DAY}) AS day")
    rows = per_account(
        account,
        _owner(unit_sale.filter("sales_date IS NOT NULL")).agg(F.expr("max(cast(sales_date AS date)) AS day")),
        _biller(used).agg(invoice_day),
        _biller(rentals(invoice, rental)).agg(invoice_day),
    )
    return rows.groupBy("account_no").agg(F.max("day").alias("last_tx_date"))


def account_standing(account, unit_sale, unit_accessory, invoice, rental, as_of: dt.date) -> DataFrame:
    """Window revenue and last date of every account, both from the same aggregates."""
    return account_standings(account, unit_sale, unit_accessory, invoice, rental, [r60_window(as_of)]).selectExpr(
        "account_no", "revenue_0 AS total_revenue", "last_tx_date")


def account_standings(account, unit_sale, unit_accessory, invoice, rental, windows: list[tuple[dt.date, dt.date]]) -> DataFrame:
    """The revenue of every account in each window, as ``revenue_0`` and so on, and its last date. The transactions are
    read, joined and summed once, whatever the number of windows."""
    numbers = range(len(windows))
    sold, recent = ([in_window(when, *w) for w in windows] for when in ("sales_date", "invo_datetime"))
    units = _with_accessories(
        unit_sale, unit_accessory, (),
        {f"goods_{i}": f"CASE WHEN {sold[i]} THEN {money('sales_value')} END" for i in numbers},
        ["max(cast(sales_date AS date)) AS day"])
    rows = per_account(
        account,
        _owner(units).agg(*exprs(*(f"{total(f'goods_{i}')} AS revenue_{i}" for i in numbers), "max(day) AS day")),
        _biller(billed(invoice)).agg(*exprs(
            *(total(f"CASE WHEN {recent[i]} THEN coalesce({PARTS}, {SERVICE}, 0) END") + f" AS revenue_{i}" for i in numbers),
            f"max(CASE WHEN module_type IN ('I', 'W') THEN {INVOICE_DAY} END) AS day",
        )),
        _biller(rentals(invoice, rental)).agg(*exprs(
            *(total(f"CASE WHEN {recent[i]} THEN rental END") + f" AS revenue_{i}" for i in numbers),
            f"max({INVOICE_DAY}) AS day",
        )),
    )
    return rows.groupBy("account_no").agg(
        *exprs(*(f"{total(f'revenue_{i}')} AS revenue_{i}" for i in numbers), "max(day) AS last_tx_date")
    )


def with_sales_decile(revenue: DataFrame, stage: Stage, method: str = "share") -> DataFrame:
    """Add ``raw_decile``; accounts without positive revenue keep null.

    Those accounts sort last and add nothing to the running sum, so one global
    order serves them all and no account is dropped.
    """
    earned = "CASE WHEN total_revenue > 0 THEN total_revenue END"
    ordered = in_global_order(revenue, ["total_revenue DESC", "account_no"], stage, earned)
    tile = share_tile("running", "overall") if method == "share" else equal_count_tile("position", "valued")
    return ordered.selectExpr(*revenue.columns, f"CASE WHEN total_revenue > 0 THEN {tile} END AS raw_decile")


DECILE_LABEL = "coalesce(concat('D', cast(raw_decile AS string)), 'Unranked')"


def sales_by_decile(ranked: DataFrame) -> DataFrame:
    return (
        ranked.groupBy("raw_decile")
        .agg(*exprs("count(*) AS customer_count", f"{total('total_revenue')} AS total_revenue"))
        .orderBy(F.col("raw_decile").asc_nulls_last())
        .selectExpr(f"{DECILE_LABEL} AS sales_decile", "customer_count", "total_revenue")
    )


def account_sales_history(account, unit_sale, unit_accessory, invoice, rental, first: int, last: int) -> DataFrame:
    """Revenue, cost and units per account and month.

    The streams are summed before, so a month of an account has few rows and combining these map-side would only hold
    them in the tasks that join. They are dealt to all partitions first, which Spark must not merge: the sums of a
    partition are held at once.
    """
    month_of = lambda c: (f"year({c}) AS year", f"month({c}) AS month")
    units = unit_amounts(unit_sale.filter(in_years("sales_date", first, last)), unit_accessory, *month_of("sales_date"))
    invoices = billed(invoice).filter(in_years("invo_datetime", first, last))
    sold = ("goods", "goods_cost")
    rented = ("rental", "rental_cost")
    worked = {"parts": PARTS, "parts_cost": PARTS_COST, "service": SERVICE, "service_cost": SERVICE_COST}
    rows = per_account(
        account,
        _owner(units, "year", "month").agg(*exprs(*(f"{total(c)} AS {c}" for c in sold), "sum(units) AS units")),
        _biller(invoices, *month_of("invo_datetime")).agg(*exprs(*(f"{total(x)} AS {c}" for c, x in worked.items()))),
        _biller(rentals(invoices, rental), *month_of("invo_datetime")).agg(*exprs(*(f"{total(c)} AS {c}" for c in rented))),
    )
    keys = ("account_no", "year", "month")
    return rows.repartition(ranges(rows), *keys).groupBy(*keys).agg(*exprs(
        *(f"coalesce({total(c)}, 0) AS {c}" for c in (*sold, *worked, *rented)), "coalesce(sum(units), 0) AS units",
    )).orderBy(F.desc("year"), F.desc("month"), "account_no")


def last_goods_date(unit_sale: DataFrame) -> DataFrame:
    return _owner(unit_sale).agg(F.expr("max(cast(sales_date AS date)) AS last_goods_date"))


def last_invoice_date(invoice: DataFrame, name: str) -> DataFrame:
    return invoice.groupBy("bill_to_acc").agg(F.expr(f"max(cast(invo_datetime AS date)) AS {name}"))


def last_parts_date(invoice: DataFrame) -> DataFrame:
    return last_invoice_date(billed(invoice).filter("module_type = 'I'"), "last_parts_date")


def last_service_date(invoice: DataFrame) -> DataFrame:
    return last_invoice_date(billed(invoice).filter("module_type = 'W'"), "last_service_date")


def last_rental_date(invoice: DataFrame, rental: DataFrame) -> DataFrame:
    """Only invoices that have a rental line."""
    keys = rental.select(F.col("invoice_no").alias("document_no"))
    return last_invoice_date(billed(invoice).join(keys, "document_no", "left_semi"), "last_rental_date")


def account_sales_decile(active: DataFrame, ranked: DataFrame, settings: Settings) -> DataFrame:
    """Decile of each active contact with the window it was measured in."""
    start, end = r60_window(settings.as_of)
    return (
        active.select("contact_code", "contact_type", "account_no")
        .join(ranked.filter("raw_decile IS NOT NULL"), "account_no", "left")
        .selectExpr(
            "contact_code", "contact_type", "account_no",
            "cast(coalesce(total_revenue, 0) AS decimal(18,2)) AS total_revenue_r60",
            f"{DECILE_LABEL} AS sales_decile", f"{lit(start)} AS r60_start", f"{lit(end)} AS r60_end",
        )
        .orderBy(F.desc("total_revenue_r60"), "contact_code")
    )
