"""Build and save the whole star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.constants import DIMENSIONS, FACTS, TARGETS
from starloom.operators.incremental import key_offset, since_date
from starloom.operators.sizes import stage_history
from starloom.plans import dimensions, facts
from starloom.plans.calendar import calendar
from starloom.sources.sinks import save
from starloom.sources.staging import recorded, release, written

# Source tables each target is built from, in the order of the builder's arguments.
DIMENSION_INPUTS = {
    "city": ["application_cities", "application_countries", "application_stateprovinces"],
    "employee": ["application_people"],
    "customer": ["sales_customers", "sales_customercategories", "sales_buyinggroups", "application_people"],
    "stock_item": [
        "warehouse_colors",
        "warehouse_stockgroups",
        "warehouse_stockitems",
        "warehouse_stockitemstockgroups",
        "warehouse_packagetypes",
    ],
    "transaction_type": ["application_transactiontypes"],
    "supplier": ["purchasing_suppliers", "purchasing_suppliercategories", "application_people"],
    "payment_method": ["application_paymentmethods"],
}
# The natural id of each dimension.
MEMBERS = {
    "city": "WWICityID",
    "employee": "WWIEmployeeID",
    "customer": "WWICustomerID",
    "stock_item": "WWIStockItemID",
    "transaction_type": "WWITransactionTypeID",
    "supplier": "WWISupplierID",
    "payment_method": "WWIPaymentMethodID",
}
FACT_INPUTS = {
    "sale": (
        ["sales_invoices", "sales_invoicelines", "sales_customers", "warehouse_stockitems", "warehouse_packagetypes"],
        ["employee", "city", "customer", "stock_item"],
    ),
    "stock_holding": (["warehouse_stockitemholdings"], ["stock_item"]),
    "order": (
        ["sales_orders", "sales_orderlines", "warehouse_packagetypes", "sales_customers"],
        ["city", "customer", "stock_item", "employee"],
    ),
}


def build_dimensions(sources: dict[str, DataFrame], to=None, names=DIMENSIONS) -> dict[str, DataFrame]:
    """The dimensions, each written once.

    The facts read the written tables: a dimension is not computed again per
    lookup, and its sizes are known from the write when a join is planned.
    Columns that are never null are declared so again.
    """
    built = {}
    for name in names:
        inputs = [sources[s] for s in DIMENSION_INPUTS[name]]
        with recorded() as made:
            table = getattr(dimensions, name)(*inputs, to=to)
        built[name] = stage_history(table, f"dimension-{name}", MEMBERS[name], keep_not_null=True)
        release(table.sparkSession, made)
    return built


def build_facts(
    sources: dict[str, DataFrame],
    dims: dict[str, DataFrame],
    to=None,
    targets: dict[str, DataFrame] | None = None,
    names=FACTS,
    **options,
) -> dict[str, DataFrame]:
    """The facts; with ``to``, only what was loaded since the newest row of each target.

    The default grain is ``item``, the one the facts' merge keys identify.
    """
    built = {}
    for name in names:
        inputs, needed = FACT_INPUTS[name]
        target = (targets or {}).get(name)
        window = {}
        if to is not None:
            window = {"since": since_date(target), "to": to, "offset": key_offset(target, TARGETS[name][1])}
        extra = {} if name == "stock_holding" else {"grain": "item", **options}
        build = getattr(facts, name)
        built[name] = build(*[sources[s] for s in inputs], *[dims[d] for d in needed], **window, **extra)
    return built


def build_star(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    start,
    as_of,
    to=None,
    targets: dict[str, DataFrame] | None = None,
    **options,
) -> dict[str, DataFrame]:
    """All target tables: seven dimensions, the calendar, three facts."""
    dims = build_dimensions(sources, to)
    days = {"calendar": calendar(spark, start, as_of)}
    return {**dims, **days, **build_facts(sources, dims, to, targets, **options)}


def save_star(
    star: dict[str, DataFrame], schema: str, to=None, rekey: bool = False, buckets: int | None = None
) -> None:
    """Dimensions are overwritten; facts are merged when loaded up to ``to``, else overwritten.

    Facts that a merge creates with ``buckets`` are kept in that many partitions
    by their merge keys; later merges rewrite the touched ones only.
    """
    for name, table in star.items():
        target, key, merge_keys = TARGETS[name]
        if name in FACTS and to is not None:
            kept = {*merge_keys} | (set() if rekey else {key})
            update = [c for c in table.columns if c not in kept]
            # Written once: the merge counts its source before it joins it.
            table = written(table, f"fact-{name}")
            save(table, f"{schema}.{target}", "merge", merge_keys, update_cols=update, buckets=buckets)
        else:
            save(table, f"{schema}.{target}", "overwrite")
