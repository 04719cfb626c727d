"""The fact tables."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.constants import LINEAGE
from starloom.operators.dedup import dedup_by, latest_per_key
from starloom.operators.incremental import fact_window
from starloom.operators.keys import number_parts, number_rows
from starloom.operators.temporal import (
    Lookup,
    as_of_join,
    earliest_parts,
    latest_version,
    lookup_methods,
    packed_versions,
    version_at,
    versions_between,
)
from starloom.sources.staging import SMALL, recorded, release, stage, stage_parts, with_scratch

PART_DOCUMENTS = 1_000_000  # headers whose lines are placed at a time
PARTS = 8  # but no more parts than that, since each reads headers and lines once more


@dataclass(frozen=True)
class Role:
    """One dimension lookup: ``fact.ref`` against ``dim.member`` gives ``out`` from ``key``."""

    out: str
    ref: str
    dim: DataFrame
    member: str
    key: str
    earliest: bool = True


def _look_up(
    staging: DataFrame, roles: list[Role], at: str, methods: dict[str, Lookup], row: str | None = None
) -> DataFrame:
    """Add the key, member and start of the version of each role in force at ``at``.

    With a ``row`` key, a history too large to send around is looked up with
    narrow rows (key, member, time); what they found is joined back by the
    key, so full rows are shuffled once for all such roles.
    """
    whole, narrow = staging, []
    for role in roles:
        take = {role.out: role.key, f"_m{role.out}": role.member, f"_s{role.out}": "ValidFrom"}
        options = {"how": "left", "closed": "right", "method": methods[role.key]}
        on = [(role.ref, role.member)]
        if row is None or methods[role.key].method == "broadcast":
            staging = as_of_join(staging, role.dim, on, at, take, **options)
        else:
            asked = whole.select(row, role.ref, at)
            narrow.append(as_of_join(asked, role.dim, on, at, take, **options).select(row, *take))
    for found in narrow:
        staging = staging.join(found, row)
    return staging


def _methods(roles: list[Role]) -> dict[str, Lookup]:
    # Several roles of one dimension share its measurement.
    return lookup_methods({r.key: (r.dim, [r.member], [r.key, "ValidFrom", "ValidTo"]) for r in roles})


class _Packs:
    """Histories too large to send around of which no id has many versions, packed by id and written once.

    A header carries the few versions that may be in force at the times of its
    lines, so these roles move no line.
    """

    def __init__(self, roles: list[Role], methods: dict[str, Lookup]):
        self.roles = {r.out: r for r in roles if methods[r.key].method == "merge" and methods[r.key].shallow}
        self._written: dict[str, DataFrame] = {}

    def attach(self, df: DataFrame, bounded: bool = False, **refs: str) -> DataFrame:
        """Add ``_v`` and its name for each packed role among ``refs``, looked up by that column.

        Of ``bounded`` headers at once those ``between`` leaves, so later joins move no others.
        """
        for out, ref in refs.items():
            role = self.roles.get(out)
            if role is None:
                continue
            if role.key not in self._written:
                self._written[role.key] = stage(packed_versions(role.dim, role.member, [role.key], "_versions"), "packed-versions", **SMALL)
            packed = self._written[role.key].select(F.col(role.member).alias("_id"), F.col("_versions").alias(f"_v{out}"))
            df = df.join(packed, F.col(ref) == F.col("_id"), "left").drop("_id")
            df = self.between(df, [f"_v{out}"]) if bounded else df
        return df

    def carried(self, df: DataFrame) -> list[str]:
        return [f"_v{out}" for out in self.roles if f"_v{out}" in df.columns]

    def members(self) -> dict[str, Column]:
        """By ``_m`` and its name, the member of each carried role: where a version was found, what was asked for."""
        kinds = {r.out: r.dim.schema[r.member].dataType for r in self.roles.values()}
        return {f"_m{o}": F.when(F.col(f"_s{o}").isNotNull(), F.col(r.ref)).cast(kinds[o]) for o, r in self.roles.items()}

    def bounded(self, header: DataFrame, lines: DataFrame, document: str) -> DataFrame:
        """Headers with ``_until``, the latest time of their lines; without packed roles as they are."""
        if not self.roles:
            return header
        last = lines.groupBy(F.col(document).alias("_document")).agg(F.max("LastEditedWhen").alias("_until"))
        return header.join(last, F.col(document) == F.col("_document"), "inner").drop("_document")

    def between(self, header: DataFrame, carried: list[str] | None = None) -> DataFrame:
        """Of the versions ``carried`` (all) those that may be in force from a header's own time to ``_until``."""
        low, high = F.col("LastEditedWhen"), F.greatest("LastEditedWhen", "_until")
        return header.withColumns({v: versions_between(F.col(v), low, high) for v in carried or self.carried(header)})

    def resolve(self, lines: DataFrame, at: str) -> DataFrame:
        """The key and start of the version of each carried role in force at ``at``; ``members`` has its member."""
        carried = [out for out in self.roles if f"_v{out}" in lines.columns]
        lines = lines.withColumns({f"_v{out}": version_at(F.col(f"_v{out}"), F.col(at)) for out in carried})
        for out in carried:
            found = F.col(f"_v{out}")
            lines = lines.withColumns({out: found[self.roles[out].key], f"_s{out}": found["_from"]})
        return lines.drop(*[f"_v{out}" for out in carried])


def _in_parts(header: DataFrame, lines: DataFrame, document: str) -> list[tuple[DataFrame, DataFrame]]:
    """Headers with their lines in ranges of documents, in their order, of ``PART_DOCUMENTS`` or as many more as ``PARTS`` asks.

    What is shuffled for one range is gone before the next one begins, so joins and
    numbering of many lines take little more disk than the written lines.
    """
    if not isinstance(header.schema[document].dataType, T.NumericType):
        return [(header, lines)]
    parts = min(PARTS, math.ceil(header.count() / PART_DOCUMENTS))
    steps = [n / parts for n in range(1, parts)]
    cuts = sorted(set(header.agg(F.percentile_approx(document, steps, 10_000)).first()[0] or [])) if steps else []
    if not cuts:
        return [(header, lines)]
    of = F.col(document)
    ranges = [of <= cuts[0], *[(of > low) & (of <= high) for low, high in zip(cuts, cuts[1:])], of > cuts[-1]]
    return [(header.where(r), lines.where(r)) for r in ranges]


def _once(df: DataFrame, label: str, parts: list) -> DataFrame:
    """``df``, which all ``parts`` join: written if there are several, so that Spark also knows its size."""
    return df if len(parts) == 1 else stage(df, label, **SMALL)


def _finish(
    parts: list[DataFrame],
    roles: list[Role],
    methods: dict[str, Lookup],
    members: dict[str, Column],
    derived: dict[str, Column],
    written: list[str],
    others: list[str],
    document: str,
    grain: str,
    earliest_key: bool,
    columns: list[str],
    key: str,
    offset: int,
    key_type: str,
) -> DataFrame:
    """Bring the lines, ``parts`` in the order of their documents, to the grain, number them, look the other dimensions up.

    A lookup adds no rows, so numbering comes before those that move no line: it sorts
    and writes the lines, narrow, without the ``derived`` columns and those that only the
    order needs, and the lookups run
    once, in the plan of the result.  Lines equal in the order are told apart by a hash of the columns
    ``written``.  Only the item grain needs its item key before.  ``members`` are those of roles looked up already.
    """
    if grain not in ("line", "item"):
        raise ValueError("grain must be 'line' or 'item'")
    order = ["_line", "_item", "Quantity", "UnitPrice", "TaxRate", "_at"]
    members = {m: column for m, column in members.items() if f"_s{m[2:]}" in parts[0].columns}
    early = [r for r in roles if r.earliest] if earliest_key else []

    def known_before(staging: DataFrame, roles: list[Role]) -> DataFrame:
        return _look_up(staging, [r for r in roles if r.out not in staging.columns], "_at", methods)

    if grain == "item":
        parts = [known_before(part, [r for r in roles if r.out == "StockItemKey"]) for part in parts]
        written = [*written, "StockItemKey", "_mStockItemKey", "_sStockItemKey"]
    contents = {**members, **derived}
    if grain == "item":
        tie = F.xxhash64(*[contents.get(c, F.col(c)) for c in written if c not in (document, "StockItemKey")])
        parts = [dedup_by(part, [document, "StockItemKey"], [*order, tie]) for part in parts]
    if earliest_key:
        parts = [known_before(part, [r for r in roles if methods[r.key].method == "broadcast"]) for part in parts]
    open_roles = [r for r in roles if r.out not in parts[0].columns]
    asked = {r.ref for r in [*open_roles, *[r for r in early if f"_m{r.out}" in members]]}
    unused = ({"_line", "_at"} if not open_roles else {"_line"}) | ({r.ref for r in roles} - asked)
    unused |= {f"{x}{r.out}" for r in roles if r not in early for x in ("_m", "_s")}
    tie = F.xxhash64(*[contents.get(c, F.col(c)) for c in written])
    keep = [c for c in parts[0].columns if c not in unused]
    with recorded() as made:
        lines = number_parts(parts, [document, *order, tie], key, offset, key_type=key_type, keep=keep)
    found = _look_up(lines, open_roles, "_at", methods, key)
    if early:
        found = found.withColumns({f"_m{r.out}": members[f"_m{r.out}"] for r in early if f"_m{r.out}" in members})
        internal = {"_at"} | {r.ref for r in roles} | {f"{x}{r.out}" for r in roles for x in ("_m", "_s")}
        rest = [c for c in found.columns if c not in internal]
        firsts = [(r.out, f"_m{r.out}", f"_s{r.out}") for r in early]
        with recorded() as made_after:
            # Numbering wrote the lines, if no look-up was left.
            found = stage(found, "found-versions", **SMALL) if open_roles else found
            settled = earliest_parts(found, firsts, rest, row=key, parts=_key_ranges(lines, key, offset, len(parts)))
        if len(settled) == 1:
            found = settled[0]
        else:
            found = stage_parts(settled, "earliest", **SMALL)
            release(found.sparkSession, [*made, *made_after])
    known = {out: F.coalesce(F.col(out), F.lit(0)) for out in [*[r.out for r in roles], *others]}
    return found.withColumns({**derived, **known}).select(key, *columns)


def _key_ranges(lines: DataFrame, key: str, offset: int, parts: int) -> list[Column] | None:
    """Conditions that cut numbered lines into ``parts`` of equally many."""
    if parts == 1:
        return None
    rows, of = lines.count(), F.col(key)
    cuts = [offset + rows * n // parts for n in range(parts + 1)]
    return [(of >= low) & (of < high) for low, high in zip(cuts, cuts[1:])]


def _with_scratch(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A builder whose frame knows the tables that were staged for it, see ``last_use``."""

    @wraps(build)
    def built(*args, **options):
        with recorded() as made:
            df = build(*args, **options)
        return with_scratch(df, made)

    return built


@_with_scratch
def order(
    sales_orders: DataFrame,
    order_lines: DataFrame,
    package_types: DataFrame,
    customers: DataFrame,
    dimension_city: DataFrame,
    dimension_customer: DataFrame,
    dimension_stock_item: DataFrame,
    dimension_employee: DataFrame,
    since=None,
    to=None,
    offset: int = 0,
    grain: str = "line",
    earliest_key: bool = False,
    key_type: str = "int",
) -> DataFrame:
    """Order lines with the dimension versions in force when they were last modified.

    Customers and package types are histories without a time in this join; the
    newest version of each is taken, so no line is repeated.  ``grain="line"``
    keeps every line.  ``grain="item"`` keeps one row per (order, stock item
    key), where items without a version count as one; the fact's merge keys
    need that.  ``earliest_key`` replaces each as-of key by the smallest key of
    the same member seen up to that version.  Beyond two thousand million rows
    take ``key_type="bigint"``.
    """
    parts = _in_parts(fact_window(sales_orders, since, to), order_lines, "OrderID")
    package = latest_version(package_types.select("PackageTypeID", "PackageTypeName", "ValidFrom"), "PackageTypeID")
    package = _once(package, "packages", parts)
    buyer = latest_version(customers.select("CustomerID", "DeliveryCityID", "ValidFrom"), "CustomerID")
    price = F.col("Quantity") * F.col("UnitPrice")
    net, tax = F.round(price, 2), F.round(price * F.col("TaxRate") / 100, 2)
    roles = [
        Role("CityKey", "_city", dimension_city, "WWICityID", "CityKey"),
        Role("CustomerKey", "_customer", dimension_customer, "WWICustomerID", "CustomerKey"),
        Role("StockItemKey", "_item", dimension_stock_item, "WWIStockItemID", "StockItemKey"),
        Role("SalespersonKey", "_seller", dimension_employee, "WWIEmployeeID", "EmployeeKey"),
        Role("PickerKey", "_picker", dimension_employee, "WWIEmployeeID", "EmployeeKey"),
    ]
    methods = _methods(roles)
    packs = _Packs(roles, methods)
    buyer = packs.attach(buyer, CustomerKey="CustomerID", CityKey="DeliveryCityID").withColumnRenamed("CustomerID", "_buyer")
    buyer = _once(buyer.drop("ValidFrom"), "buyers", parts)

    def joined(header: DataFrame, lines: DataFrame) -> DataFrame:
        header = packs.bounded(header, lines, "OrderID").join(buyer, F.col("CustomerID") == F.col("_buyer"), "inner")
        header = packs.attach(packs.between(header), True, SalespersonKey="SalespersonPersonID", PickerKey="PickedByPersonID")
        both = header.alias("h").join(lines.alias("l"), F.col("h.OrderID") == F.col("l.OrderID"), "inner")
        both = both.select(
            F.col("h.OrderDate").cast("date").alias("OrderDateKey"),
            F.col("l.PickingCompletedWhen").cast("date").alias("PickedDateKey"),
            F.col("h.OrderID").alias("WWIOrderID"),
            F.col("h.BackorderOrderID").alias("WWIBackorderID"),
            "l.Description",
            F.col("l.PackageTypeID").alias("_package"),
            "l.Quantity",
            "l.UnitPrice",
            "l.TaxRate",
            F.col("h.LoadDatetime").alias("RawDataLoadDatetime"),
            F.col("l.OrderLineID").alias("_line"),
            F.col("h.DeliveryCityID").alias("_city"),
            F.col("h.CustomerID").alias("_customer"),
            F.col("l.StockItemID").alias("_item"),
            F.col("h.SalespersonPersonID").alias("_seller"),
            F.col("h.PickedByPersonID").alias("_picker"),
            F.when(F.col("l.LastEditedWhen") > F.col("h.LastEditedWhen"), F.col("l.LastEditedWhen"))
            .otherwise(F.col("h.LastEditedWhen"))
            .alias("_at"),
            *packs.carried(header),
        )
        # What the header carried is resolved before the lines move on to their items.
        both = packs.resolve(both, "_at").join(package.alias("p"), F.col("_package") == F.col("p.PackageTypeID"), "inner")
        both = both.withColumn("Package", F.col("p.PackageTypeName")).drop("_package", *package.columns)
        return packs.resolve(packs.attach(both, StockItemKey="_item"), "_at")

    written = [
        "OrderDateKey", "PickedDateKey", "WWIOrderID", "WWIBackorderID", "Description", "Package", "Quantity", "UnitPrice",
        "TaxRate", "TotalExcludingTax", "TaxAmount", "TotalIncludingTax", "LineageKey", "RawDataLoadDatetime", "_line",
        "_city", "_customer", "_item", "_seller", "_picker", "_at",
    ]
    derived = {"TotalExcludingTax": net, "TaxAmount": tax, "TotalIncludingTax": net + tax, "LineageKey": F.lit(LINEAGE["order"])}
    columns = [
        "CityKey", "CustomerKey", "StockItemKey", "OrderDateKey", "PickedDateKey", "SalespersonKey", "PickerKey",
        "WWIOrderID", "WWIBackorderID", "Description", "Package", "Quantity", "UnitPrice", "TaxRate",
        "TotalExcludingTax", "TaxAmount", "TotalIncludingTax", "LineageKey", "RawDataLoadDatetime",
    ]
    return _finish(
        [joined(*part) for part in parts], roles, methods, packs.members(), derived, written, [], "WWIOrderID",
        grain, earliest_key, columns, "OrderKey", offset, key_type,
    )


@_with_scratch
def sale(
    invoices: DataFrame,
    invoice_lines: DataFrame,
    customers: DataFrame,
    stock_items: DataFrame,
    package_types: DataFrame,
    dimension_employee: DataFrame,
    dimension_city: DataFrame,
    dimension_customer: DataFrame,
    dimension_stock_item: DataFrame,
    since=None,
    to=None,
    offset: int = 0,
    grain: str = "line",
    earliest_key: bool = False,
    key_type: str = "int",
) -> DataFrame:
    """Invoice lines; as ``order``, but the city is looked up without a time: its first version."""
    parts = _in_parts(fact_window(invoices, since, to), invoice_lines, "InvoiceID")
    package = latest_version(package_types.select("PackageTypeID", "PackageTypeName", "ValidFrom"), "PackageTypeID")
    package = _once(package, "packages", parts)
    buyer = latest_version(customers.select("CustomerID", "DeliveryCityID", "ValidFrom"), "CustomerID")
    item = latest_version(stock_items.select("StockItemID", "IsChillerStock", "ValidFrom"), "StockItemID")
    item = _once(item.select(F.col("StockItemID").alias("_sold"), F.col("IsChillerStock").alias("_chiller")), "items", parts)
    cities = dimension_city.groupBy("WWICityID").agg(F.min("CityKey").alias("CityKey"))

    def quantity_if(condition):
        return F.when(condition, F.col("Quantity")).otherwise(0)

    roles = [
        Role("CustomerKey", "_customer", dimension_customer, "WWICustomerID", "CustomerKey"),
        Role("BillToCustomerKey", "_bill_to", dimension_customer, "WWICustomerID", "CustomerKey"),
        Role("StockItemKey", "_item", dimension_stock_item, "WWIStockItemID", "StockItemKey"),
        Role("SalespersonKey", "_seller", dimension_employee, "WWIEmployeeID", "EmployeeKey", earliest=False),
    ]
    methods = _methods(roles)
    packs = _Packs(roles, methods)
    known = _once(buyer.select(F.col("CustomerID").alias("_known")), "known-buyers", parts)
    placed = buyer.drop("ValidFrom").join(cities, F.col("DeliveryCityID") == F.col("WWICityID"), "left")
    placed = packs.attach(placed, CustomerKey="CustomerID").withColumnRenamed("CustomerID", "_buyer")
    placed = _once(placed, "buyers", parts)

    def joined(header: DataFrame, lines: DataFrame) -> DataFrame:
        header = packs.bounded(header, lines, "InvoiceID").join(placed, F.col("CustomerID") == F.col("_buyer"), "inner")
        header = packs.between(header).join(known, F.col("BillToCustomerID") == F.col("_known"), "left_semi")
        header = packs.attach(header, True, BillToCustomerKey="BillToCustomerID", SalespersonKey="SalespersonPersonID")
        both = header.alias("h").join(lines.alias("l"), F.col("h.InvoiceID") == F.col("l.InvoiceID"), "inner")
        both = both.select(
            F.col("h.InvoiceDate").cast("date").alias("InvoiceDateKey"),
            F.col("h.ConfirmedDeliveryTime").cast("date").alias("DeliveryDateKey"),
            F.col("h.InvoiceID").alias("WWIInvoiceID"),
            "l.Description",
            F.col("l.PackageTypeID").alias("_package"),
            "l.Quantity",
            "l.UnitPrice",
            "l.TaxRate",
            "l.TaxAmount",
            F.col("l.LineProfit").alias("Profit"),
            F.col("l.ExtendedPrice").alias("TotalIncludingTax"),
            F.col("h.LoadDatetime").alias("RawDataLoadDatetime"),
            "h.CityKey",
            F.col("l.InvoiceLineID").alias("_line"),
            F.col("h.CustomerID").alias("_customer"),
            F.col("h.BillToCustomerID").alias("_bill_to"),
            F.col("l.StockItemID").alias("_item"),
            F.col("h.SalespersonPersonID").alias("_seller"),
            F.when(F.col("l.LastEditedWhen") > F.col("h.LastEditedWhen"), F.col("l.LastEditedWhen"))
            .otherwise(F.col("h.LastEditedWhen"))
            .alias("_at"),
            *packs.carried(header),
        )
        # What the header carried is resolved before the lines move on to their items.
        both = packs.resolve(both, "_at").join(package.alias("p"), F.col("_package") == F.col("p.PackageTypeID"), "inner")
        both = both.withColumn("Package", F.col("p.PackageTypeName")).drop("_package", *package.columns)
        both = both.join(item, F.col("_item") == F.col("_sold"), "inner").drop("_sold")
        return packs.resolve(packs.attach(both, StockItemKey="_item"), "_at")

    written = [
        "InvoiceDateKey", "DeliveryDateKey", "WWIInvoiceID", "Description", "Package", "Quantity", "UnitPrice", "TaxRate",
        "TotalExcludingTax", "TaxAmount", "Profit", "TotalIncludingTax", "TotalDryItems", "TotalChillerItems", "LineageKey",
        "RawDataLoadDatetime", "CityKey", "_line", "_customer", "_bill_to", "_item", "_seller", "_at",
    ]
    derived = {
        "TotalExcludingTax": F.col("TotalIncludingTax") - F.col("TaxAmount"),
        "TotalDryItems": quantity_if(~F.col("_chiller")),
        "TotalChillerItems": quantity_if(F.col("_chiller")),
        "LineageKey": F.lit(LINEAGE["sale"]),
    }
    columns = [
        "CityKey", "CustomerKey", "BillToCustomerKey", "StockItemKey", "InvoiceDateKey", "DeliveryDateKey",
        "SalespersonKey", "WWIInvoiceID", "Description", "Package", "Quantity", "UnitPrice", "TaxRate",
        "TotalExcludingTax", "TaxAmount", "Profit", "TotalIncludingTax", "TotalDryItems", "TotalChillerItems",
        "LineageKey", "RawDataLoadDatetime",
    ]
    return _finish(
        [joined(*part) for part in parts], roles, methods, packs.members(), derived, written, ["CityKey"], "WWIInvoiceID",
        grain, earliest_key, columns, "SaleKey", offset, key_type,
    )


def stock_holding(
    stock_item_holdings: DataFrame, dimension_stock_item: DataFrame, since=None, to=None, offset: int = 0
) -> DataFrame:
    """The latest holding of each item with the item's latest version."""
    holdings = fact_window(stock_item_holdings, since, to)
    holdings = latest_per_key(holdings, "StockItemID", "LoadDatetime")
    items = latest_per_key(
        dimension_stock_item.select("WWIStockItemID", "StockItemKey", "ValidTo"), "WWIStockItemID", ["ValidTo", "StockItemKey"]
    )
    staging = holdings.join(items, F.col("StockItemID") == F.col("WWIStockItemID"), "left").select(
        F.coalesce("StockItemKey", F.lit(0)).alias("StockItemKey"),
        "QuantityOnHand",
        "BinLocation",
        "LastStocktakeQuantity",
        "LastCostPrice",
        "ReorderLevel",
        "TargetStockLevel",
        F.lit(LINEAGE["stock_holding"]).alias("LineageKey"),
        F.col("LoadDatetime").alias("RawDataLoadDatetime"),
        "StockItemID",
    )
    return number_rows(staging, ["StockItemKey", "StockItemID"], "StockHoldingKey", offset).drop("StockItemID")
