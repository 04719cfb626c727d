"""The registered queries: each takes (spark, folder of the test tables) and returns a DataFrame.

Next to each Spark query stands the SQL the oracle runs on the same tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.constants import TARGETS
from starloom.operators.checks import (
    ambiguous_names,
    invalid_intervals,
    key_range,
    star_diff,
    star_equal,
    table_diff,
)
from starloom.operators.dedup import dedup_by, keep_max_rows, latest_per_key
from starloom.operators.incremental import (
    high_water_mark,
    key_offset,
    next_key,
    since_date,
    since_of,
    stamp,
    temporal_union,
    window_filter,
)
from starloom.operators.keys import number_rows, with_unknown_member
from starloom.operators.merge import fact_merge, merge_all, merge_keep_stamp
from starloom.operators.sizes import stage_history
from starloom.operators.temporal import (
    as_of_join,
    close_out,
    earliest_keys,
    intersect_join,
    overlap_join,
    pit_lookup,
    running_min,
    version_timeline,
)
from starloom.plans import dimensions, facts, reports
from starloom.plans.calendar import calendar_between
from starloom.plans.increments import update_dimension
from starloom.plans.loads import begin_load, load_fact, loaded_rows
from starloom.plans.raw_load import load_regular, load_temporal
from starloom.plans.star import build_dimensions, build_facts, build_star, save_star
from starloom.sources.changes import read_changes
from starloom.sources.sinks import append, export_sample, merge_into, overwrite, overwrite_path
from starloom.sources.staging import last_use, recorded, release, stage, stage_last, staging_path
from starloom.sources.tables import ensure_table, extract_columns, read_table, read_tsv
from starloom.streaming.cdc import (
    changes,
    checked_changes,
    latest_images,
    read_refused,
    schema_from_ddl,
    upsert_messages,
    upsert_stream,
)
from workload import sql
from workload.sources import BEGIN, LOAD_TO, OPEN_END, Sources, money, saved
from workload.sql import FAR, with_

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None, extra: dict[str, str] | None = None):
    def register(build: Callable[[Sources], DataFrame]):
        name = build.__name__.rstrip("_")  # an operator of that name may be imported here
        QUERIES[name] = lambda spark, folder: build(Sources(spark, folder))
        if oracle is not None:
            ORACLE[name] = with_(oracle, extra)
        return build

    return register


# ---------------------------------------------------------------------------
# The star, built once per session and folder and then read like any saved table
# ---------------------------------------------------------------------------

def _dims(src: Sources, *names: str) -> list[DataFrame]:
    def one(name):
        if name == "stock_item":
            with recorded() as made:
                items = _stock_items(src)
            staged = stage_history(items, "dimension-stock_item", "WWIStockItemID")
            release(src.spark, made)
            return staged
        return build_dimensions(src, LOAD_TO, [name])[name]

    return [saved(src, n, lambda n=n: one(n)) for n in names]


def _stock_items(src: Sources, **options) -> DataFrame:
    return dimensions.stock_item(
        src.warehouse_colors,
        src.warehouse_stockgroups,
        src.warehouse_stockitems,
        src.warehouse_stockitemstockgroups,
        src.warehouse_packagetypes,
        to=LOAD_TO,
        end_of_time="2038-01-19 03:14:07.999999",
        **options,
    )


def _sales(src: Sources, **options) -> DataFrame:
    return facts.sale(
        src.sales_invoices,
        src.sales_invoicelines,
        src.sales_customers,
        src.warehouse_stockitems,
        src.warehouse_packagetypes,
        *_dims(src, "employee", "city", "customer", "stock_item"),
        **options,
    )


def _orders(src: Sources, headers: DataFrame | None = None, **options) -> DataFrame:
    return facts.order(
        headers if headers is not None else src.sales_orders,
        src.sales_orderlines,
        src.warehouse_packagetypes,
        src.sales_customers,
        *_dims(src, "city", "customer", "stock_item", "employee"),
        **options,
    )


def _saved_sales(src: Sources) -> DataFrame:
    return saved(src, "sale", lambda: stage_last(_sales(src), "fact-sale"))


# ---------------------------------------------------------------------------
# Facts
# ---------------------------------------------------------------------------


@query(sql.sale_fact("sale_found"))
def sale_fact(src):
    return _sales(src)


@query(sql.sale_fact("sale_single", earliest=True))
def sale_fact_by_item(src):
    return _sales(src, grain="item", earliest_key=True)


@query(sql.order_fact("order_found"))
def order_fact(src):
    return _orders(src)


@query(sql.order_fact("order_single", earliest=True))
def order_fact_by_item(src):
    return _orders(src, grain="item", earliest_key=True)


@query(
    """
    SELECT CAST(row_number() OVER (ORDER BY coalesce(d.k, 0), h.item) - 1 AS INTEGER) AS "StockHoldingKey",
           coalesce(d.k, 0) AS "StockItemKey", h.on_hand AS "QuantityOnHand", 'L-' || (h.part % 10) AS "BinLocation",
           h.n AS "LastStocktakeQuantity", h.cost AS "LastCostPrice", p_size AS "ReorderLevel",
           p_size * 10 AS "TargetStockLevel", 12 AS "LineageKey", h.loaded AS "RawDataLoadDatetime"
    FROM (SELECT l_partkey AS part, l_partkey + 1 AS item, CAST(sum(CAST(l_quantity AS INTEGER)) AS INTEGER) AS on_hand,
                 CAST(count(*) AS INTEGER) AS n, max(CAST(l_extendedprice AS DECIMAL(18,2))) AS cost,
                 max(l_shipdate + INTERVAL 18 YEAR) AS loaded FROM lineitem GROUP BY l_partkey) h
    JOIN part ON p_partkey = h.part
    LEFT JOIN (SELECT "WWIStockItemID" AS i, arg_max("StockItemKey", "ValidTo") AS k FROM dim_item GROUP BY 1) d
           ON d.i = h.item
    """
)
def stock_holding_latest(src):
    return facts.stock_holding(src.warehouse_stockitemholdings, *_dims(src, "stock_item"))


_T1, _T2 = "2016-01-01 00:00:00", "2017-01-01 00:00:00"


@query(
    """
    SELECT * FROM first_load
    UNION ALL
    SELECT CAST("OrderKey" + 1 + (SELECT max("OrderKey") FROM first_load) AS INTEGER) AS "OrderKey",
           * EXCLUDE ("OrderKey") FROM second_load
    """,
    {
        "first_found": f"SELECT * FROM order_single WHERE loaded <= TIMESTAMP '{_T1}'",
        "second_found": f"SELECT * FROM order_single WHERE loaded > TIMESTAMP '{_T1}' AND loaded <= TIMESTAMP '{_T2}'",
        "first_load": sql.order_fact("first_found"),
        "second_load": sql.order_fact("second_found"),
    },
)
def order_fact_incremental(src):
    """Two loads of the order fact: the second starts where the first one's rows end."""
    dims = dict(
        zip(
            ["city", "customer", "stock_item", "employee"],
            _dims(src, "city", "customer", "stock_item", "employee"),
        )
    )
    first = stage_last(build_facts(src, dims, to=_T1, names=["order"])["order"], "fact-order")
    second = build_facts(src, dims, to=_T2, targets={"order": first}, names=["order"])["order"]
    return fact_merge(first, stage_last(second, "fact-order"), ["StockItemKey", "WWIOrderID"], "OrderKey")


@query(
    """
    SELECT * FROM first_load
    UNION ALL
    SELECT CAST("OrderKey" + 1 + (SELECT max("OrderKey") FROM first_load) AS INTEGER) AS "OrderKey",
           * EXCLUDE ("OrderKey") FROM second_load
    """,
    {
        "first_found": f"SELECT * FROM order_single WHERE loaded <= TIMESTAMP '{_T1}'",
        "second_found": f"SELECT * FROM order_single WHERE loaded > TIMESTAMP '{_T1}' AND loaded <= TIMESTAMP '{_T2}'",
        "first_load": sql.order_fact("first_found"),
        "second_load": sql.order_fact("second_found"),
    },
)
def order_fact_resumed(src):
    """The second load breaks off when a part of it is merged; the next run goes on from the written copy."""
    dims = dict(zip(["city", "customer", "stock_item", "employee"], _dims(src, "city", "customer", "stock_item", "employee")))
    schema, root, ledger = f"resumed_{uuid.uuid4().hex}", staging_path(src.spark, "facts"), staging_path(src.spark, "ledger")
    src.spark.sql(f"CREATE DATABASE {schema}")
    options = {"root": root, "ledger": ledger, "buckets": 4}
    first = load_fact(src.spark, "order", src, dims, schema, _T1, **options)
    since, offset = since_date(first), key_offset(first, "OrderKey")
    rows = build_facts(src, dims, _T2, {"order": first}, ["order"])["order"]
    entry = begin_load(src.spark, rows, schema, "fact_order", since, _T2, offset, ledger)
    last_use(rows)
    part = loaded_rows(src.spark, entry).where("WWIOrderID % 3 = 0")
    merge_into(src.spark, f"{schema}.fact_order", part, ["StockItemKey", "WWIOrderID"], root=root)
    return load_fact(src.spark, "order", src, dims, schema, _T2, **options)


@query(
    """
    SELECT 'city' AS target, count(*) AS n_rows, CAST(max("CityKey") AS INTEGER) AS last_key FROM dim_city
    UNION ALL SELECT 'customer', count(*), CAST(max("CustomerKey") AS INTEGER) FROM dim_customer
    UNION ALL SELECT 'employee', count(*), CAST(max("EmployeeKey") AS INTEGER) FROM dim_employee
    UNION ALL SELECT 'stock_item', count(*), CAST(max("StockItemKey") AS INTEGER) FROM dim_item
    UNION ALL SELECT 'supplier', count(*), CAST(max("SupplierKey") AS INTEGER) FROM dim_supplier
    UNION ALL SELECT 'sale', count(*), CAST(max("SaleKey") AS INTEGER) FROM fact_sale
    """
)
def star_summary(src):
    """Rows and last key of the main tables of the star."""
    keys = {
        "city": "CityKey",
        "customer": "CustomerKey",
        "employee": "EmployeeKey",
        "stock_item": "StockItemKey",
        "supplier": "SupplierKey",
        "sale": "SaleKey",
    }
    out = None
    for name, key in keys.items():
        table = _saved_sales(src) if name == "sale" else _dims(src, name)[0]
        row = table.agg(F.count(F.lit(1)).alias("n_rows"), F.max(key).alias("last_key"))
        row = row.select(F.lit(name).alias("target"), "n_rows", "last_key")
        out = row if out is None else out.unionAll(row)
    return out


_KEYED = {
    "city": ("dim_city", "CityKey"),
    "employee": ("dim_employee", "EmployeeKey"),
    "customer": ("dim_customer", "CustomerKey"),
    "stock_item": ("dim_item", "StockItemKey"),
    "supplier": ("dim_supplier", "SupplierKey"),
}
_AS_OF = "2018-06-01"


@query(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS target, count(*) AS n_rows, CAST(max("{key}") AS INTEGER) AS last_key FROM {table}"""
        for name, (table, key) in _KEYED.items()
    )
    + f"""
    UNION ALL SELECT 'payment_method', count(DISTINCT o_orderpriority) + 1, CAST(count(DISTINCT o_orderpriority) AS INTEGER)
    FROM orders
    UNION ALL SELECT 'transaction_type', count(*) + 1, CAST(count(*) AS INTEGER)
    FROM (SELECT DISTINCT event_type, CAST(ts AS DATE) FROM events
          GROUP BY event_type, CAST(ts AS DATE), user_id % 2 HAVING max(ts) <= {sql.LOAD_TO})
    UNION ALL SELECT 'calendar', CAST(last_day(DATE '{_AS_OF}') + INTERVAL 12 MONTH AS DATE) - DATE '2013-01-01', NULL
    UNION ALL SELECT 'sale', count(*), CAST(nullif(count(*), 0) - 1 AS INTEGER) FROM sale_single WHERE loaded <= {sql.LOAD_TO}
    UNION ALL SELECT 'order', count(*), CAST(nullif(count(*), 0) - 1 AS INTEGER) FROM order_single WHERE loaded <= {sql.LOAD_TO}
    UNION ALL SELECT 'stock_holding', count(*), CAST(nullif(count(*), 0) - 1 AS INTEGER)
    FROM (SELECT l_partkey FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_partkey
          HAVING max(l_shipdate + INTERVAL 18 YEAR) <= {sql.LOAD_TO})
    """
)
def star_build(src):
    """All targets built and saved, read back by name and compared with what was built."""
    schema = f"star_{uuid.uuid4().hex}"
    src.spark.sql(f"CREATE DATABASE {schema}")
    star = build_star(src.spark, src, "2013-01-01", _AS_OF, to=LOAD_TO)
    star = {name: stage_last(table, f"star-{name}") for name, table in star.items()}
    save_star(star, schema, to=LOAD_TO)
    back = {name: read_table(src.spark, f"{schema}.{TARGETS[name][0]}") for name in star}
    star_equal(back, star)
    out = None
    for name, table in back.items():
        key = TARGETS[name][1]
        last = F.max(key) if key else F.lit(None)
        row = table.agg(F.count(F.lit(1)).alias("n_rows"), last.cast("int").alias("last_key"))
        row = row.select(F.lit(name).alias("target"), "n_rows", "last_key")
        out = row if out is None else out.unionAll(row)
    return out


@query(
    """
    SELECT 'customer' AS target, 'expected' AS only_in, CAST(count(*) AS BIGINT) AS n_rows
    FROM dim_customer WHERE "CustomerKey" % 7 = 3 HAVING count(*) > 0
    UNION ALL SELECT 'stock_item', 'actual', CAST(count(*) AS BIGINT) FROM dim_item
    """
)
def star_check(src):
    """Lost customers and repeated items are reported, equal tables are not."""
    names = ["city", "employee", "customer", "stock_item", "supplier"]
    expected = dict(zip(names, _dims(src, *names)))
    items = expected["stock_item"]
    actual = {
        **expected,
        "customer": expected["customer"].where("CustomerKey % 7 <> 3"),
        "stock_item": items.unionByName(items),
    }
    return star_diff(actual, expected)


# ---------------------------------------------------------------------------
# Dimensions and calendar
# ---------------------------------------------------------------------------


@query("SELECT * FROM dim_city")
def city_dimension(src):
    return dimensions.city(
        src.application_cities, src.application_countries, src.application_stateprovinces, to=LOAD_TO
    )


@query("SELECT * FROM dim_customer")
def customer_dimension(src):
    return dimensions.customer(
        src.sales_customers, src.sales_customercategories, src.sales_buyinggroups, src.application_people, to=LOAD_TO
    )


def _in_two_loads(src, name: str) -> DataFrame:
    """A dimension built up to a time in the middle, then brought up to date; without its keys, which follow the loads."""
    schema, root = f"loads_{uuid.uuid4().hex}", staging_path(src.spark, "loads")
    src.spark.sql(f"CREATE DATABASE {schema}")
    for to in (_T2, LOAD_TO):
        update_dimension(src.spark, name, src, schema, to, root=root, buckets=4)
    target, key, _ = TARGETS[name]
    return read_table(src.spark, f"{schema}.{target}").drop(key)


@query('SELECT * EXCLUDE ("CityKey") FROM dim_city')
def city_dimension_two_loads(src):
    return _in_two_loads(src, "city")


@query('SELECT * EXCLUDE ("CustomerKey") FROM dim_customer')
def customer_dimension_two_loads(src):
    return _in_two_loads(src, "customer")


@query('SELECT * EXCLUDE ("EmployeeKey") FROM dim_employee')
def employee_dimension_two_loads(src):
    return _in_two_loads(src, "employee")


@query('SELECT * EXCLUDE ("SupplierKey") FROM dim_supplier')
def supplier_dimension_two_loads(src):
    return _in_two_loads(src, "supplier")


@query("SELECT * FROM dim_employee")
def employee_dimension(src):
    return dimensions.employee(src.application_people, to=LOAD_TO)


@query("SELECT * FROM dim_item")
def stock_item_dimension(src):
    return _stock_items(src)


@query("SELECT * FROM dim_item_by_group")
def stock_item_dimension_by_group(src):
    return _stock_items(src, strict_reference=True)


@query("SELECT * FROM dim_supplier")
def supplier_dimension(src):
    return dimensions.supplier(
        src.purchasing_suppliers, src.purchasing_suppliercategories, src.application_people, to=LOAD_TO
    )


@query(
    f"""
    SELECT CAST(row_number() OVER (ORDER BY min(o_orderdate), o_orderpriority) AS INTEGER) AS "PaymentMethodKey",
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS "WWIPaymentMethodID",
           substr(o_orderpriority, 3) AS "PaymentMethod", min(o_orderdate) + INTERVAL 18 YEAR AS "ValidFrom",
           {sql.OPEN} AS "ValidTo", 4 AS "LineageKey" FROM orders GROUP BY o_orderpriority
    UNION ALL SELECT 0, 0, 'Unknown', {sql.BEGIN}, {FAR}, 0
    """
)
def payment_method_dimension(src):
    return dimensions.payment_method(src.application_paymentmethods)


@query(
    f"""
    SELECT CAST(row_number() OVER (ORDER BY "ValidFrom", id) AS INTEGER) AS "TransactionTypeKey",
           id AS "WWITransactionTypeID", event_type AS "TransactionType", "ValidFrom", max("ValidTo") AS "ValidTo",
           7 AS "LineageKey"
    FROM (SELECT ascii(event_type) AS id, event_type, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS "ValidFrom",
                 max(ts) AS "ValidTo"
          FROM events GROUP BY 1, 2, 3, user_id % 2)
    WHERE "ValidTo" <= TIMESTAMP '2024-01-20 00:00:00'
    GROUP BY id, event_type, "ValidFrom"
    UNION ALL SELECT 0, 0, 'Unknown', {sql.BEGIN}, {FAR}, 0
    """
)
def transaction_type_dimension(src):
    return dimensions.transaction_type(src.application_transactiontypes, to="2024-01-20 00:00:00")


@query(
    """
    SELECT CAST(d AS DATE) AS "Date", CAST(day(d) AS INTEGER) AS "DayNumber", CAST(day(d) AS INTEGER) AS "Day",
           monthname(d) AS "Month", left(monthname(d), 3) AS "ShortMonth",
           CAST(month(d) AS INTEGER) AS "CalendarMonthNumber",
           'CY' || year(d) || '-' || left(monthname(d), 3) AS "CalendarMonthLabel",
           CAST(year(d) AS INTEGER) AS "CalendarYear", 'CY' || year(d) AS "CalendarYearLabel",
           CAST(month(d + INTERVAL 2 MONTH) AS INTEGER) AS "FiscalMonthNumber",
           'FY' || year(d + INTERVAL 2 MONTH) || '-' || left(monthname(d), 3) AS "FiscalMonthLabel",
           CAST(year(d + INTERVAL 2 MONTH) AS INTEGER) AS "FiscalYear",
           'FY' || year(d + INTERVAL 2 MONTH) AS "FiscalYearLabel", CAST(weekofyear(d) AS INTEGER) AS "ISOWeekNumber",
           coalesce(n, 0) AS n_orders
    FROM (SELECT unnest(generate_series(min(o_orderdate), last_day(last_day(max(o_orderdate)) + INTERVAL 12 MONTH)
                 - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM orders)
    LEFT JOIN (SELECT o_orderdate AS od, count(*) AS n FROM orders GROUP BY 1) ON od = d
    """
)
def calendar(src):
    """The calendar from the first order to a year after the last, with the orders of each day."""
    days = src.read("orders").select(F.col("o_orderdate").cast("date").alias("Date"))
    bounds = days.agg(F.min("Date").alias("start"), F.max("Date").alias("as_of"))
    counts = days.groupBy("Date").agg(F.count(F.lit(1)).alias("n_orders"))
    return calendar_between(bounds).join(counts, "Date", "left").fillna({"n_orders": 0})


# ---------------------------------------------------------------------------
# Keys, dedup
# ---------------------------------------------------------------------------


@query(
    """
    SELECT CAST(row_number() OVER (ORDER BY c_nationkey, c_custkey) AS INTEGER) AS "CustomerKey", * FROM customer
    """
)
def surrogate_keys(src):
    return number_rows(src.read("customer"), ["c_nationkey", "c_custkey"], "CustomerKey", 1)


@query(
    """
    SELECT CAST(row_number() OVER (ORDER BY l_returnflag, l_orderkey, l_linenumber, l_partkey, l_quantity,
                l_extendedprice) + 99 AS INTEGER) AS "LineKey", l_returnflag, l_orderkey, l_linenumber, l_partkey,
           l_quantity, l_extendedprice FROM lineitem
    """
)
def surrogate_keys_hot(src):
    """Three values lead the order of all lines; the columns after them split each one."""
    columns = ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    return number_rows(src.read("lineitem").select(*columns), columns, "LineKey", 100, key_first=False)


@query(
    f"""
    SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS INTEGER) AS "PartKey", p_partkey, p_name,
           {sql.BEGIN} AS "ValidFrom", {sql.OPEN} AS "ValidTo" FROM part
    UNION ALL SELECT 0, -1, 'Unknown', {sql.BEGIN}, {FAR}
    """
)
def unknown_member(src):
    parts = src.read("part").select(
        "p_partkey",
        "p_name",
        F.lit(BEGIN).cast("timestamp_ntz").alias("ValidFrom"),
        F.lit(OPEN_END).cast("timestamp_ntz").alias("ValidTo"),
    )
    keyed = number_rows(parts, "p_partkey", "PartKey", 1)
    return with_unknown_member(
        keyed, "PartKey", {"p_partkey": -1, "p_name": "Unknown"}, BEGIN, "2038-01-19 03:14:07.999999"
    )


@query(
    """
    SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS nth FROM lineitem) WHERE nth = 1
    """
)
def dedup_lines(src):
    return dedup_by(
        src.read("lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    )


@query("SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(src):
    return src.read("lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query(
    """
    SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth FROM orders) WHERE nth = 1
    """
)
def latest_order(src):
    return latest_per_key(src.read("orders"), "o_custkey", ["o_orderdate", "o_orderkey"])


@query(
    """
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity FROM lineitem l
    JOIN (SELECT l_orderkey, max(l_linenumber) AS last FROM lineitem GROUP BY 1) m
      ON m.l_orderkey = l.l_orderkey AND l.l_linenumber = m.last
    """
)
def last_lines(src):
    lines = src.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return keep_max_rows(lines, "l_orderkey", "l_linenumber")


# ---------------------------------------------------------------------------
# Temporal algebra on user histories
# ---------------------------------------------------------------------------


@query("SELECT event_id, user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS \"ValidTo\" FROM events")
def version_timeline_(src):
    return version_timeline(src.events.select("event_id", "user_id", "ts"), "user_id", "ts")


# Seven of ten events belong to one id, and all of them to one day.
_ONE_DAY = """SELECT event_id, CASE WHEN event_id % 10 < 7 THEN 0 ELSE user_id END AS k,
                      TIMESTAMP '2024-01-01' + to_microseconds(event_id * 100) AS "at" FROM events"""


def _one_day(src) -> DataFrame:
    owner = F.when(F.col("event_id") % 10 < 7, F.lit(0)).otherwise(F.col("user_id")).cast("long").alias("k")
    at = F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, event_id * 100 / 1000000.0)")
    return src.events.select("event_id", owner, at.alias("at"))


@query(
    f"""
    SELECT event_id, CAST(k AS BIGINT) AS k, "at", lead("at") OVER (PARTITION BY k ORDER BY "at") AS "ValidTo"
    FROM ({_ONE_DAY})
    """
)
def version_timeline_hot(src):
    """An id with most of the rows, all within a day, cut into slices of about equally many rows."""
    return version_timeline(_one_day(src), "k", "at", hot_rows=500)


@query(
    f"""
    SELECT event_id, CAST(k AS BIGINT) AS k, "at", CAST(min(event_id % 1000) OVER (PARTITION BY k ORDER BY "at") AS BIGINT) AS earliest
    FROM ({_ONE_DAY})
    """
)
def earliest_key_hot(src):
    rows = _one_day(src).withColumn("key", (F.col("event_id") % 1000).cast("long"))
    return running_min(rows, "k", "at", "key", "earliest", hot_rows=500).drop("key")


_CLOSE = "TIMESTAMP '2024-01-30 00:00:00'"


@query(
    f"""
    SELECT event_id, CAST(k AS BIGINT) AS k, "at" AS "ValidFrom", CASE WHEN nth > 1 THEN "end" ELSE {FAR} END AS "ValidTo"
    FROM (SELECT *, "at" + INTERVAL 60 DAY AS "end", row_number() OVER (PARTITION BY k ORDER BY "at" DESC) AS nth FROM ({_ONE_DAY}))
    """
)
def close_out_hot(src):
    spans = _one_day(src).withColumn("ValidTo", F.expr("at + INTERVAL 60 DAY")).withColumnRenamed("at", "ValidFrom")
    return close_out(spans, "k", "2024-01-30 00:00:00", hot_rows=500)


@query(
    f"""
    SELECT event_id, user_id, ts AS "ValidFrom",
           CASE WHEN nth > 1 THEN "end" WHEN "end" > {_CLOSE} THEN {FAR} ELSE "end" END AS "ValidTo"
    FROM (SELECT *, ts + INTERVAL 1 DAY AS "end", row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS nth
          FROM events)
    """
)
def close_out_(src):
    spans = src.events.select(
        "event_id", "user_id", F.col("ts").alias("ValidFrom"), F.expr("ts + INTERVAL 1 DAY").alias("ValidTo")
    )
    return close_out(spans, "user_id", "2024-01-30 00:00:00")


def _as_of_sql(start: str, end: str, kind: str) -> str:
    return f"""
    SELECT e.event_id, e.user_id, e.ts AS at, CAST(e.value AS DECIMAL(18,2)) AS value,
           v.event_id AS version_id, v.event_type AS state
    FROM events e {kind} JOIN user_versions v ON v.user_id = e.user_id AND v."ValidFrom" {start} e.ts
         AND e.ts {end} v."ValidTo"
    WHERE e.event_type = 'purchase'
    """


_STATE = {"version_id": "event_id", "state": "event_type"}


@query(_as_of_sql("<=", "<", ""))
def as_of_left(src):
    return as_of_join(src.purchases, src.user_versions, "user_id", "at", _STATE)


@query(_as_of_sql("<", "<=", ""))
def as_of_right(src):
    return as_of_join(src.purchases, src.user_versions, "user_id", "at", _STATE, closed="right")


@query(_as_of_sql("<=", "<", "LEFT"))
def as_of_optional(src):
    return as_of_join(src.purchases, src.user_versions, "user_id", "at", _STATE, how="left")


@query(_as_of_sql("<=", "<", "LEFT"))
def as_of_merge(src):
    """The lookup as for histories too large to send around, every user split by day."""
    return as_of_join(
        src.purchases, src.user_versions, "user_id", "at", _STATE, how="left", method="merge", hot_rows=10
    )


_SPANS = {
    "spans": """SELECT event_id, user_id, event_type, ts AS vf, ts + to_days(CAST(event_id % 5 * 4 + 1 AS INTEGER)) AS vt
                FROM events WHERE event_type <> 'purchase'"""
}


def _long_spans(src) -> DataFrame:
    """Versions of one to seventeen days each, so that those of a user overlap."""
    end = F.expr("ts + make_dt_interval(cast(event_id % 5 * 4 + 1 AS int))")
    return src.events.where("event_type <> 'purchase'").select(
        "event_id", "user_id", "event_type", F.col("ts").alias("ValidFrom"), end.alias("ValidTo")
    )


@query(
    """
    SELECT * EXCLUDE (nth) FROM (
        SELECT e.event_id, e.user_id, e.ts AS at, CAST(e.value AS DECIMAL(18,2)) AS value,
               v.event_id AS version_id, v.event_type AS state,
               row_number() OVER (PARTITION BY e.event_id ORDER BY v.vf DESC, v.vt DESC, v.event_id DESC) AS nth
        FROM events e LEFT JOIN spans v ON v.user_id = e.user_id AND v.vf < e.ts AND e.ts <= v.vt
        WHERE e.event_type = 'purchase')
    WHERE nth = 1
    """,
    _SPANS,
)
def as_of_overlapping(src):
    """Of overlapping versions the one in force that started last."""
    return as_of_join(
        src.purchases, _long_spans(src), "user_id", "at", _STATE, how="left", closed="right", method="merge"
    )


@query(
    """
    SELECT e.event_id, e.user_id, e.ts AS at, CAST(e.value AS DECIMAL(18,2)) AS value,
           v.event_id AS version_id, v.event_type AS state
    FROM events e JOIN spans v ON v.user_id = e.user_id AND v.vf <= e.ts AND e.ts < v.vt
    WHERE e.event_type = 'purchase'
    """,
    _SPANS,
)
def as_of_every_match(src):
    """All versions in force, found as for large histories."""
    return as_of_join(src.purchases, _long_spans(src), "user_id", "at", _STATE, method="merge", matches="all")


@query(
    """
    SELECT *, CASE WHEN k IS NULL THEN 0 ELSE min(k) OVER (PARTITION BY user_id ORDER BY vf) END AS version_key
    FROM (SELECT e.event_id, e.user_id, e.ts AS at, CAST(e.value AS DECIMAL(18,2)) AS value, v.event_id AS k,
                 v."ValidFrom" AS vf
          FROM events e LEFT JOIN user_versions v ON v.user_id = e.user_id AND v."ValidFrom" < e.ts
               AND e.ts <= v."ValidTo" WHERE e.event_type = 'purchase')
    """.replace("SELECT *, CASE", 'SELECT event_id, user_id, "at", value, CASE')
)
def earliest_key_lookup(src):
    return pit_lookup(
        src.purchases, src.user_versions, "user_id", "at", "event_id", "version_key", earliest_key=True
    )


@query(
    """
    SELECT a.event_id, a.user_id, a.event_type, a.vf AS "ValidFrom", a.vt AS "ValidTo", b.event_id AS other_id,
           b.event_type AS other
    FROM history_a a JOIN history_b b ON a.user_id = b.user_id AND a.vf <= b.vt AND b.vf <= a.vt
    """
)
def overlap_join_(src):
    return overlap_join(
        src.user_history(["view", "click"]),
        src.user_history(["signup", "error"]),
        "user_id",
        {"other_id": "event_id", "other": "event_type"},
    )


@query(
    """
    SELECT a.event_id, a.user_id, a.event_type, greatest(a.vf, b.vf) AS "ValidFrom", least(a.vt, b.vt) AS "ValidTo",
           b.event_id AS other_id
    FROM history_a a JOIN history_b b ON a.user_id = b.user_id AND greatest(a.vf, b.vf) < least(a.vt, b.vt)
    """
)
def intersect_join_(src):
    """Binned by day, as for ids with very many versions."""
    return intersect_join(
        src.user_history(["view", "click"]),
        src.user_history(["signup", "error"]),
        "user_id",
        {"other_id": "event_id"},
        method="merge",
        bin_unit="day",
    )


def _most_in_one(src, kinds: list[str]) -> DataFrame:
    """Versions of a few ids, most of them one id's, made by some event types only."""
    owner = F.when(F.col("event_id") % 10 < 7, F.lit(0)).otherwise(F.col("user_id") % 5 + 1).cast("long")
    states = src.events.where(F.col("event_type").isin(kinds)).select("event_id", owner.alias("k"), F.col("ts").alias("ValidFrom"))
    return version_timeline(states, "k", "ValidFrom", default_end=OPEN_END)


def _most_in_one_sql(kinds: str) -> str:
    return f"""
    SELECT event_id, CAST(k AS BIGINT) AS k, ts AS vf, coalesce(lead(ts) OVER (PARTITION BY k ORDER BY ts), {sql.OPEN}) AS vt
    FROM (SELECT *, CASE WHEN event_id % 10 < 7 THEN 0 ELSE user_id % 5 + 1 END AS k FROM events) WHERE event_type IN ({kinds})
    """


@query(
    """
    SELECT a.event_id, a.k, greatest(a.vf, b.vf) AS "ValidFrom", least(a.vt, b.vt) AS "ValidTo", b.event_id AS other_id
    FROM most_a a JOIN most_b b ON a.k = b.k AND greatest(a.vf, b.vf) < least(a.vt, b.vt)
    """,
    {"most_a": _most_in_one_sql("'view', 'click'"), "most_b": _most_in_one_sql("'signup', 'error'")},
)
def intersect_join_hot(src):
    """One id has most versions: the nodes of its tree that many rows share are cut into parts."""
    return intersect_join(
        _most_in_one(src, ["view", "click"]),
        _most_in_one(src, ["signup", "error"]),
        "k",
        {"other_id": "event_id"},
        method="merge",
        bin_unit="month",
        hot_rows=300,
    )


@query(
    """
    SELECT event_id, CAST(min(key) OVER (PARTITION BY k ORDER BY since) AS BIGINT) AS key
    FROM (SELECT event_id, CASE WHEN event_id % 10 < 8 THEN 0 ELSE user_id % 7 END AS k,
                 CASE WHEN event_id % 10 < 6 THEN 5 ELSE event_id % 40 END AS since, (event_id * 7919) % 1009 AS key FROM events)
    """
)
def earliest_key_hot_version(src):
    """Most rows found one version of one member; its minimum is attached without moving them."""
    n = F.col("event_id")
    rows = src.events.select(
        "event_id",
        F.when(n % 10 < 8, 0).otherwise(F.col("user_id") % 7).cast("long").alias("k"),
        F.when(n % 10 < 6, 5).otherwise(n % 40).cast("long").alias("since"),
        (n * 7919 % 1009).cast("long").alias("key"),
    )
    return earliest_keys(rows, [("key", "k", "since")], hot_rows=500).select("event_id", "key")


def _uneven_sql(table: str) -> str:
    return f"""
    SELECT event_id, user_id, event_type, CASE WHEN event_id % 11 = 0 THEN vt ELSE vf END AS vf,
           CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 11 = 0 THEN vf ELSE vt END AS vt
    FROM {table}
    """


_UNEVEN = """
    SELECT a.event_id, a.user_id, a.event_type, a.vf AS "ValidFrom", a.vt AS "ValidTo", b.event_id AS other_id
    FROM uneven_a a JOIN uneven_b b ON a.user_id = b.user_id AND a.vf <= b.vt AND b.vf <= a.vt
"""
_UNEVEN_PARTS = {"uneven_a": _uneven_sql("history_a"), "uneven_b": _uneven_sql("history_b")}


def _uneven(src, kinds: list[str]) -> DataFrame:
    """A user's versions, some inverted, some without an end."""
    inverted, endless = F.col("event_id") % 11 == 0, F.col("event_id") % 13 == 0
    start = F.when(inverted, F.col("ValidTo")).otherwise(F.col("ValidFrom"))
    end = F.when(endless, None).when(inverted, F.col("ValidFrom")).otherwise(F.col("ValidTo"))
    return src.user_history(kinds).select("event_id", "user_id", "event_type", start.alias("ValidFrom"), end.alias("ValidTo"))


def _uneven_overlap(src, method: str) -> DataFrame:
    left, right = _uneven(src, ["view", "click"]), _uneven(src, ["signup", "error"])
    return overlap_join(left, right, "user_id", {"other_id": "event_id"}, method=method, bin_unit="day")


@query(_UNEVEN, _UNEVEN_PARTS)
def overlap_join_plain(src):
    return _uneven_overlap(src, "join")


@query(_UNEVEN, _UNEVEN_PARTS)
def overlap_join_broadcast(src):
    return _uneven_overlap(src, "broadcast")


@query(_UNEVEN, _UNEVEN_PARTS)
def overlap_join_merge(src):
    return _uneven_overlap(src, "merge")


# ---------------------------------------------------------------------------
# Incremental loading
# ---------------------------------------------------------------------------

_SINCE, _TO = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
_PARTS = {
    "now_part": """SELECT * FROM user_versions WHERE "ValidFrom" <= TIMESTAMP '2024-01-15 00:00:00'
                   AND "ValidTo" > TIMESTAMP '2024-01-12 00:00:00'""",
    "old_part": """SELECT * FROM user_versions WHERE "ValidFrom" < TIMESTAMP '2024-01-13 00:00:00'""",
}


def _current_and_archive(src):
    versions = src.user_versions
    ts = {d: F.lit(f"2024-01-{d} 00:00:00").cast("timestamp_ntz") for d in (12, 13, 15)}
    current = versions.where((F.col("ValidFrom") <= ts[15]) & (F.col("ValidTo") > ts[12]))
    return current, versions.where(F.col("ValidFrom") < ts[13])


@query(
    f"""
    SELECT * FROM now_part WHERE "ValidFrom" <= TIMESTAMP '{_TO}'
    UNION ALL SELECT * FROM old_part WHERE "ValidTo" <= TIMESTAMP '{_TO}' OR "ValidFrom" <= TIMESTAMP '{_TO}'
    """,
    _PARTS,
)
def temporal_union_initial(src):
    return temporal_union(*_current_and_archive(src), to=_TO)


@query(
    f"""
    SELECT * FROM now_part WHERE "ValidFrom" > TIMESTAMP '{_SINCE}' AND "ValidFrom" <= TIMESTAMP '{_TO}'
    UNION SELECT * FROM old_part WHERE ("ValidTo" > TIMESTAMP '{_SINCE}' AND "ValidTo" <= TIMESTAMP '{_TO}')
       OR ("ValidFrom" > TIMESTAMP '{_SINCE}' AND "ValidFrom" <= TIMESTAMP '{_TO}')
    """,
    _PARTS,
)
def temporal_union_incremental(src):
    return temporal_union(*_current_and_archive(src), since=_SINCE, to=_TO)


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE o_orderdate > TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1999-06-30'
    """
)
def window_filter_(src):
    rows = window_filter(src.read("orders"), "o_orderdate", "1997-01-01 00:00:00", "1999-06-30 00:00:00")
    return rows.select("o_orderkey", "o_custkey", "o_orderdate")


@query(
    """
    SELECT max(o_orderdate) AS high_water, max(o_orderdate) AS since, TIMESTAMP '1900-01-01' AS since_empty,
           max(o_orderkey) + 1 AS next_key, CAST(1 AS BIGINT) AS next_key_empty FROM orders
    """
)
def watermarks(src):
    """Where the next load of a table begins, and of an empty one: one aggregate for all."""
    none = F.col("o_orderkey") < 0
    return src.read("orders").agg(
        F.max("o_orderdate").alias("high_water"),
        since_of("o_orderdate").alias("since"),
        since_of(F.when(none, F.col("o_orderdate"))).alias("since_empty"),
        next_key("o_orderkey").alias("next_key"),
        next_key(F.when(none, F.col("o_orderkey"))).alias("next_key_empty"),
    )


_L1, _L2 = "1998-01-01 00:00:00", "2000-01-01 00:00:00"


@query(
    f"""
    SELECT o_orderkey, CAST(price + CASE WHEN again THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS price, edited + CASE WHEN again THEN
           INTERVAL 400 DAY ELSE INTERVAL 0 DAY END AS "LastEditedWhen",
           CASE WHEN again OR edited > TIMESTAMP '{_L1}' THEN TIMESTAMP '{_L2}' ELSE TIMESTAMP '{_L1}' END AS "LoadDatetime"
    FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderdate AS edited,
                 o_orderkey % 10 = 0 AND o_orderdate + INTERVAL 400 DAY > TIMESTAMP '{_L1}'
                 AND o_orderdate + INTERVAL 400 DAY <= TIMESTAMP '{_L2}' AS again FROM orders)
    WHERE edited <= TIMESTAMP '{_L1}' OR again OR (o_orderkey % 10 <> 0 AND edited <= TIMESTAMP '{_L2}')
    """
)
def raw_regular_load(src):
    """Two loads of a mutable table; a tenth of its rows is edited between them."""
    source = src.read("orders").select(
        "o_orderkey",
        money("o_totalprice").alias("price"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("LastEditedWhen"),
    )
    edited = F.col("o_orderkey") % 10 == 0
    later = source.withColumns(
        {
            "price": F.when(edited, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(18,2)"),
            "LastEditedWhen": F.when(edited, F.expr("LastEditedWhen + INTERVAL 400 DAYS")).otherwise(
                F.col("LastEditedWhen")
            ),
        }
    )
    empty = _ntz_stamp(stamp(source.where("false"), _L1))
    first = stage(_ntz_stamp(load_regular(empty, source, "o_orderkey", _L1)), "raw-orders")
    return load_regular(first, later, "o_orderkey", _L2)


def _ntz_stamp(df):
    return df.withColumn("LoadDatetime", F.col("LoadDatetime").cast("timestamp_ntz"))


@query(
    f"""
    SELECT event_id, user_id, event_type, value, "ValidFrom",
           CASE WHEN "ValidTo" <= TIMESTAMP '{_TO}' THEN "ValidTo" ELSE {sql.OPEN} END AS "ValidTo",
           CASE WHEN "ValidFrom" <= TIMESTAMP '{_SINCE}' THEN TIMESTAMP '{_SINCE}' ELSE TIMESTAMP '{_TO}' END
           AS "LoadDatetime"
    FROM user_versions WHERE "ValidFrom" <= TIMESTAMP '{_TO}'
    """
)
def raw_temporal_load(src):
    """Two loads of a versioned table: known versions are closed and keep their first load stamp."""

    def known(at):
        ts, end = F.lit(at).cast("timestamp_ntz"), F.lit(OPEN_END).cast("timestamp_ntz")
        seen = src.user_versions.where(F.col("ValidFrom") <= ts)
        seen = seen.withColumn("ValidTo", F.when(F.col("ValidTo") <= ts, F.col("ValidTo")).otherwise(end))
        return seen.where(F.col("ValidTo") == end), seen.where(F.col("ValidTo") < end)

    empty = _ntz_stamp(stamp(src.user_versions.where("false"), _SINCE))
    first = stage(_ntz_stamp(load_temporal(empty, *known(_SINCE), "event_id", _SINCE)), "raw-versions")
    return load_temporal(first, *known(_TO), "event_id", _TO)


# ---------------------------------------------------------------------------
# Merge
# ---------------------------------------------------------------------------


def _slices(src):
    """(target, source): orders before 1999, and orders from 1998 on at a higher price."""
    orders = src.read("orders").select(
        (F.col("o_orderkey") + 1).alias("key"),
        "o_orderkey",
        money("o_totalprice").alias("price"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("LoadDatetime"),
    )

    def day(text):
        return F.lit(text).cast("timestamp_ntz")

    target = orders.where(F.col("LoadDatetime") < day("1999-01-01"))
    source = orders.where(F.col("LoadDatetime") >= day("1998-01-01")).withColumns(
        {
            "key": F.col("key") + 1_000_000,
            "price": (F.col("price") + 10).cast("decimal(18,2)"),
            "LoadDatetime": day("2002-01-01"),
        }
    )
    return target, source


def _merged_sql(key: str, stamp_: str) -> str:
    return f"""
    SELECT CASE WHEN new THEN o_orderkey + 1000001 WHEN hit THEN {key} ELSE o_orderkey + 1 END AS key, o_orderkey,
           CAST(CASE WHEN hit OR new THEN price + 10 ELSE price END AS DECIMAL(18,2)) AS price,
           CASE WHEN new THEN TIMESTAMP '2002-01-01' WHEN hit THEN {stamp_} ELSE o_orderdate END AS "LoadDatetime"
    FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderdate,
                 o_orderdate >= TIMESTAMP '1999-01-01' AS new,
                 o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' AS hit FROM orders)
    """


@query(_merged_sql("o_orderkey + 1000001", "TIMESTAMP '2002-01-01'"))
def merge_all_(src):
    return merge_all(*_slices(src), "o_orderkey")


@query(_merged_sql("o_orderkey + 1000001", "TIMESTAMP '2002-01-01'"))
def merge_all_outer(src):
    """The same, as for a source too large to send around."""
    return merge_all(*_slices(src), "o_orderkey", method="outer")


@query(_merged_sql("o_orderkey + 1000001", "o_orderdate"))
def merge_keep_stamp_(src):
    return merge_keep_stamp(*_slices(src), "o_orderkey")


@query(_merged_sql("o_orderkey + 1", "TIMESTAMP '2002-01-01'"))
def merge_facts(src):
    return fact_merge(*_slices(src), "o_orderkey", "key")


# ---------------------------------------------------------------------------
# Sources and sinks
# ---------------------------------------------------------------------------


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, l_returnflag
    FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, price LIMIT 100
    """
)
def sample_export(src):
    lines = src.read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", money("l_extendedprice").alias("price"), "l_returnflag"
    )
    path = staging_path(src.spark, "sample")
    export_sample(lines, path, ["l_orderkey", "l_linenumber", "l_partkey", "price"], 100)
    return read_tsv(src.spark, path, lines.schema)


@query("SELECT p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size FROM part")
def declared_projection(src):
    return extract_columns(src.read("part"), ["p_partkey", "p_name", "p_size"], as_text=["p_size"])


@query(_merged_sql("o_orderkey + 1000001", "o_orderdate"))
def table_upsert(src):
    """Overwrite, append and merge of a catalog table, read back by name."""
    target, source = _slices(src)
    name = f"upsert_{uuid.uuid4().hex}"
    early = F.col("o_orderkey") % 2 == 0
    overwrite(target.where(early), name)
    append(target.where(~early), name)
    merge_into(src.spark, name, source, "o_orderkey", ["key", "price"])
    return read_table(src.spark, name)


@query(_merged_sql("o_orderkey + 1000001", "o_orderdate"))
def merge_partitions(src):
    """A table kept in partitions by key, merged in two loads that each touch some of the partitions."""
    target, source = _slices(src)
    name = f"buckets_{uuid.uuid4().hex}"
    merge_into(src.spark, name, target, "o_orderkey", buckets=16)
    even = F.pmod(F.xxhash64("o_orderkey"), F.lit(2)) == 0
    for load in (source.where(even), source.where(~even)):
        merge_into(src.spark, name, load, "o_orderkey", ["key", "price"])
    return read_table(src.spark, name)


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def overwrite_by_path(src):
    """A folder written twice holds the second table alone."""
    orders, root = src.read("orders"), staging_path(src.spark, "root")
    overwrite_path(orders.select("o_orderkey", "o_custkey"), root, "Sales_Orders")
    path = overwrite_path(orders.select("o_orderkey", "o_orderstatus"), root, "Sales_Orders")
    return src.spark.read.parquet(path)


@query("SELECT p_partkey, p_name FROM part")
def empty_table_filled(src):
    """A table created empty from a declared schema, then filled twice over without being made anew."""
    parts, name = src.read("part").select("p_partkey", "p_name"), f"declared_{uuid.uuid4().hex}"
    half = F.col("p_partkey") % 2 == 0
    for rows in (parts.where(half), parts.where(~half)):
        ensure_table(src.spark, name, parts.schema)
        append(rows, name)
    return read_table(src.spark, name)


# ---------------------------------------------------------------------------
# Change data capture
# ---------------------------------------------------------------------------

_ROW = "user_id bigint, event_id bigint, event_type string, value decimal(18,2), ts timestamp_ntz, day date"


def _messages(src, tie_hours: bool, where: str = "true") -> DataFrame:
    """Every event as a change message; a tenth are deletes, some have no operation."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    row = F.to_json(
        F.struct(
            "user_id",
            "event_id",
            "event_type",
            "value",
            ms.alias("ts"),
            F.unix_date(F.col("ts").cast("date")).alias("day"),
        )
    )
    op = F.when(F.col("event_id") % 101 == 0, F.lit(None)).when(F.col("event_id") % 10 == 0, "d")
    op = op.when(F.col("event_id") % 2 == 0, "u").otherwise("c")
    return src.events.where(where).select(_envelope(row, op, ms - ms % 3_600_000 if tie_hours else ms).alias("value"))


def _envelope(row, op, ms):
    """A change message as text: an image, its operation, and its position by time and event."""
    deleted = F.col("event_id") % 10 == 0
    source = F.struct(
        ms.alias("ts_ms"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("commit_lsn"),
        F.lit("events").alias("table"),
    )
    payload = F.struct(
        F.when(~deleted, row).alias("after"), F.when(deleted, row).alias("before"), op.alias("op"), source.alias("source")
    )
    return F.to_json(F.struct(payload.alias("payload")))


_IMAGES = """
    SELECT user_id, event_id, event_type, CAST(value AS DECIMAL(18,2)) AS value,
           date_trunc('milliseconds', ts) AS ts, CAST(ts AS DATE) AS day
    FROM events WHERE event_id % 101 <> 0 AND event_id % 10 <> 0
"""


@query(f"SELECT *, CASE WHEN event_id % 2 = 0 THEN 'u' ELSE 'c' END AS op FROM ({_IMAGES})")
def cdc_parse(src):
    return changes(_messages(src, False), _ROW).drop("EventTime", "commit_lsn", "change_lsn", "event_serial_no")


_LATEST = f"""
    SELECT user_id, event_id, event_type, value, ts, day FROM (SELECT *, row_number() OVER (PARTITION BY user_id
        ORDER BY event_id DESC) AS nth FROM ({_IMAGES})) WHERE nth = 1
"""


@query(_LATEST)
def cdc_latest(src):
    """Many images of a user share their event hour; the log position decides."""
    latest = latest_images(changes(_messages(src, True), _ROW), "user_id")
    return latest.select("user_id", "event_id", "event_type", "value", "ts", "day")


@query(_LATEST)
def cdc_stream_upsert(src):
    """The messages as files, read as a stream in several batches and merged by user."""
    folder, name = staging_path(src.spark, "messages"), f"cdc_{uuid.uuid4().hex}"
    _messages(src, False).repartition(3).write.text(folder)
    stream = read_changes(src.spark, "text", {"maxFilesPerTrigger": "1"}, path=folder)
    running = upsert_stream(
        changes(stream, _ROW),
        name,
        "user_id",
        staging_path(src.spark, "checkpoint"),
        time_guard=True,
    )
    running.awaitTermination()
    return read_table(src.spark, name).select("user_id", "event_id", "event_type", "value", "ts", "day")


@query(_LATEST)
def cdc_two_streams(src):
    """Two streams with checkpoints of their own into one table kept in buckets: neither batch 0 is taken for the other's."""
    name, messages = f"cdc_{uuid.uuid4().hex}", _messages(src, False)
    first = F.xxhash64("value") % 2 == 0
    for part in (first, ~first):
        folder = staging_path(src.spark, "messages")
        messages.where(part).write.text(folder)
        stream = read_changes(src.spark, "text", {}, path=folder)
        checkpoint = staging_path(src.spark, "checkpoint")
        upsert_stream(changes(stream, _ROW), name, "user_id", checkpoint, time_guard=True, buckets=4).awaitTermination()
    return read_table(src.spark, name).select("user_id", "event_id", "event_type", "value", "ts", "day")


@query(f"SELECT kept_in, l.* FROM ({_LATEST}) AS l CROSS JOIN (VALUES ('buckets'), ('snapshots')) AS t(kept_in)")
def cdc_streams_together(src):
    """Streams that run at once and write one table: each micro-batch keeps what the others merged meanwhile."""
    tables = []
    for kept_in, buckets in (("buckets", 4), ("snapshots", 0)):
        name, running = f"cdc_{uuid.uuid4().hex}", []
        for part in range(3):
            folder = staging_path(src.spark, "messages")
            _messages(src, False, f"event_id % 3 = {part}").repartition(2).write.text(folder)
            stream = read_changes(src.spark, "text", {"maxFilesPerTrigger": "1"}, path=folder)
            checkpoint = staging_path(src.spark, "checkpoint")
            running.append(upsert_stream(changes(stream, _ROW), name, "user_id", checkpoint, time_guard=True, buckets=buckets))
        for one in running:
            one.awaitTermination()
        table = read_table(src.spark, name).select("user_id", "event_id", "event_type", "value", "ts", "day")
        tables.append(table.select(F.lit(kept_in).alias("kept_in"), "*"))
    return tables[0].unionByName(tables[1])


@query(
    """
    SELECT user_id, event_id, event_type, value, ts, day FROM (SELECT *, row_number() OVER (PARTITION BY user_id
        ORDER BY date_trunc('hour', ts) DESC, event_id DESC) AS nth FROM (%s)) WHERE nth = 1
    """
    % _IMAGES
)
def cdc_late_position(src):
    """The later half of each hour's changes comes first; at equal times the position in the log keeps it."""
    name, folder, checkpoint = f"cdc_{uuid.uuid4().hex}", staging_path(src.spark, "messages"), staging_path(src.spark, "checkpoint")
    for half in ("minute(ts) >= 30", "minute(ts) < 30"):
        _messages(src, True, half).write.mode("append").text(folder)
        stream = read_changes(src.spark, "text", {}, path=folder)
        upsert_stream(changes(stream, _ROW), name, "user_id", checkpoint, time_guard=True).awaitTermination()
    return read_table(src.spark, name).select("user_id", "event_id", "event_type", "value", "ts", "day")


@query(
    """
    SELECT outcome, count(*) AS messages FROM (SELECT CASE WHEN event_id % 23 = 0 THEN 'envelope not readable'
        WHEN event_id % 101 = 0 THEN 'no operation' WHEN event_id % 13 = 0 THEN 'unknown operation'
        WHEN event_id % 29 = 0 THEN 'no row image' WHEN event_id % 19 = 0 THEN 'row image not readable'
        WHEN event_id % 17 = 0 THEN 'no key' ELSE 'merged' END AS outcome FROM events) GROUP BY 1
    """
)
def cdc_refused(src):
    """Damaged messages: those that can be applied are merged, the others kept with the reason; together they are all."""
    n = F.col("event_id")
    row = F.when(n % 29 != 0, F.when(n % 19 == 0, F.expr("substr(r, 1, length(r) - 3)")).otherwise(F.col("r")))
    op = F.when(n % 101 != 0, F.when(n % 13 == 0, "t").when(n % 10 == 0, "d").otherwise("c"))
    events = src.events.withColumn("r", F.to_json(F.struct(F.when(n % 17 != 0, n).alias("event_id"), "user_id", "event_type")))
    whole = _envelope(row, op, F.unix_millis(F.col("ts").cast("timestamp")))
    cut = F.when(n % 23 == 0, F.substring(whole, 2, 1000)).otherwise(whole)
    folder, name = staging_path(src.spark, "messages"), f"cdc_{uuid.uuid4().hex}"
    events.select(cut.alias("value")).repartition(2).write.text(folder)
    stream = read_changes(src.spark, "text", {"maxFilesPerTrigger": "1"}, path=folder)
    checked = checked_changes(stream, "event_id bigint, user_id bigint, event_type string", "event_id")
    kept_apart = staging_path(src.spark, "refused")
    upsert_stream(
        checked, name, "event_id", staging_path(src.spark, "checkpoint"), deletes="apply", refused_to=kept_apart
    ).awaitTermination()
    merged = read_table(src.spark, name).select(F.lit("merged").alias("outcome"))
    both = merged.unionAll(read_refused(src.spark, name, kept_apart).select("_reason"))
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("messages"))


@query(
    """
    SELECT event_id, user_id, event_type, CASE WHEN event_id % 2 = 1 THEN CAST(value AS DECIMAL(18,2)) END AS value
    FROM events WHERE event_id % 101 <> 0 AND event_id % 10 <> 0
    """
)
def cdc_schema_change(src):
    """The source declares a wider id and one more column between two batches; the table follows."""
    spark, name = src.spark, f"cdc_{uuid.uuid4().hex}"
    declarations, folder, checkpoint = (staging_path(spark, k) for k in ("declarations", "messages", "checkpoint"))
    n = F.col("event_id")
    columns = [("event_id", "int"), ("user_id", "bigint"), ("event_type", "nvarchar")]
    for load in range(2):
        if load:
            columns = [("event_id", "bigint"), *columns[1:], ("value", "decimal")]
        listed = F.array(*[
            F.struct(F.lit(c).alias("name"), F.lit(k).alias("typeName"), F.lit(18).alias("length"), F.lit(2).alias("scale"))
            for c, k in columns
        ])
        table = F.struct(F.struct(F.array(F.lit("event_id")).alias("primaryKeyColumnNames"), listed.alias("columns")).alias("table"))
        source = F.struct(F.lit("Web").alias("schema"), F.lit("Events").alias("table"), F.lit(load).alias("ts_ms"))
        payload = F.struct(source.alias("source"), F.array(table).alias("tableChanges"))
        spark.range(1).select(F.to_json(F.struct(payload.alias("payload")))).write.mode("append").text(declarations)
        image = F.to_json(F.struct(*[c for c, _ in columns]))
        op = F.when(n % 101 != 0, F.when(n % 10 == 0, "d").otherwise("c"))
        half = src.events.where(n % 2 == load)
        half.select(_envelope(image, op, F.unix_millis(F.col("ts").cast("timestamp"))).alias("value")).write.mode("append").text(folder)
        upsert_messages(
            read_changes(spark, "text", {}, path=folder),
            name,
            lambda: schema_from_ddl(spark.read.text(declarations)),
            checkpoint,
            table="Web_Events",
        ).awaitTermination()
    return read_table(spark, name).select("event_id", "user_id", "event_type", "value")


@query(
    """
    SELECT table_name, CAST(position AS INTEGER) AS position, column_name, spark_type,
           column_name = 'Id' AS is_key
    FROM (SELECT 'Sales_Orders' || substr(o_orderpriority, 1, 1) AS t, o_orderkey AS k, o_orderstatus AS s,
                 row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth
          FROM orders) o,
         LATERAL (VALUES (t, 0, 'Id', 'int'), (t, 1, 'Amount', 'decimal(18,' || (k % 4) || ')'),
                         (t, 2, 'Status' || s, CASE k % 3 WHEN 0 THEN 'boolean' WHEN 1 THEN 'string' ELSE 'timestamp' END),
                         (t, 3, 'LoadDatetime', 'timestamp'),
                         ('Archive' || t, 0, 'Id', 'bigint'), ('Archive' || t, 1, 'Paid' || (k % 2), 'decimal(19,4)'),
                         ('Archive' || t, 2, 'LoadDatetime', 'timestamp')) AS c(table_name, position, column_name, spark_type)
    WHERE nth = 1
    """
)
def ddl_schema(src):
    """Every order declares two tables anew in one message; the last declaration of each table counts."""
    key = F.col("o_orderkey")

    def column(name, kind, length=None, scale=None):
        return F.struct(
            name.alias("name"),
            kind.alias("typeName"),
            F.lit(length).cast("int").alias("length"),
            (scale if scale is not None else F.lit(None)).cast("int").alias("scale"),
        )

    def change(schema, columns):
        keyed = F.struct(F.array(F.lit("Id")).alias("primaryKeyColumnNames"), F.array(*columns).alias("columns"))
        name = F.concat(F.lit(f'"wide"."{schema}"."Orders'), F.substring("o_orderpriority", 1, 1), F.lit('"'))
        return F.struct(name.alias("id"), keyed.alias("table"))

    status = F.when(key % 3 == 0, "bit").when(key % 3 == 1, "nvarchar").otherwise("datetime2")
    now = change(
        "Sales",
        [
            column(F.lit("Id"), F.lit("int")),
            column(F.lit("Amount"), F.lit("decimal"), 18, key % 4),
            column(F.concat(F.lit("Status"), "o_orderstatus"), status),
        ],
    )
    paid = F.concat(F.lit("Paid"), (key % 2).cast("string"))
    archive = change("ArchiveSales", [column(F.lit("Id"), F.lit("bigint")), column(paid, F.lit("money"))])
    source = F.struct(
        F.lit("Sales").alias("schema"),
        F.concat(F.lit("Orders"), F.substring("o_orderpriority", 1, 1)).alias("table"),
        F.unix_millis(F.col("o_at").cast("timestamp")).alias("ts_ms"),
        F.lpad(key.cast("string"), 12, "0").alias("commit_lsn"),
    )
    payload = F.struct(source.alias("source"), F.array(now, archive).alias("tableChanges"))
    return schema_from_ddl(src.orders.select(F.to_json(F.struct(payload.alias("payload"))).alias("value")))


# ---------------------------------------------------------------------------
# Reports
# ---------------------------------------------------------------------------

_AMOUNT = '"UnitPrice" * "Quantity"'


def _dec(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(38,2))"


def _wide(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("decimal(38,2)") for c in columns})


ORACLE_REPORTS = {
    "r_daily": f'SELECT "InvoiceDateKey" AS order_date, {_dec(f"sum({_AMOUNT})")} AS total_sales FROM fact_sale GROUP BY 1',
    "r_items": """
        SELECT d."StockItem", CAST(sum(f."Quantity") AS BIGINT) AS total_quantity_sold
        FROM fact_sale f JOIN dim_item d ON f."StockItemKey" = d."StockItemKey" GROUP BY 1
        ORDER BY total_quantity_sold, d."StockItem" LIMIT 10""",
    "r_places": f"""
        SELECT c."City" AS "CityName", c."StateProvince" AS "State", c."Location", c."Latitude", c."Longitude",
               {_dec(f"sum({_AMOUNT})")} AS total_sales
        FROM fact_sale f JOIN dim_city c ON f."CityKey" = c."CityKey" GROUP BY 1, 2, 3, 4, 5
        ORDER BY total_sales DESC, "CityName", "State", c."Location" LIMIT 50""",
    "r_best": f"""
        SELECT month, "Employee", total_sales FROM (
            SELECT strftime(f."InvoiceDateKey", '%Y-%m') AS month, e."Employee", {_dec(f"sum({_AMOUNT})")} AS total_sales,
                   row_number() OVER (PARTITION BY strftime(f."InvoiceDateKey", '%Y-%m')
                                      ORDER BY sum({_AMOUNT}) DESC, e."Employee") AS rank
            FROM fact_sale f JOIN dim_employee e ON f."SalespersonKey" = e."EmployeeKey" GROUP BY 1, 2)
        WHERE rank = 1""",
}


@query("SELECT * FROM r_daily", ORACLE_REPORTS)
def daily_sales(src):
    return _wide(reports.daily_sales(_saved_sales(src)), "total_sales")


@query("SELECT * FROM r_items", ORACLE_REPORTS)
def item_ranking(src):
    return reports.item_ranking(_saved_sales(src), *_dims(src, "stock_item"))


@query(
    """
    SELECT d."StockItem", CAST(sum(f."Quantity") AS BIGINT) AS total_quantity_sold
    FROM fact_sale f JOIN dim_item d ON f."StockItemKey" = d."StockItemKey" GROUP BY 1
    ORDER BY total_quantity_sold DESC, d."StockItem" LIMIT 25
    """
)
def item_ranking_best(src):
    return reports.item_ranking(_saved_sales(src), *_dims(src, "stock_item"), n=25, ascending=False)


@query("SELECT * FROM r_places", ORACLE_REPORTS)
def sales_by_place(src):
    return _wide(reports.sales_by_place(_saved_sales(src), *_dims(src, "city")), "total_sales")


@query("SELECT * FROM r_best", ORACLE_REPORTS)
def best_per_month(src):
    return _wide(reports.best_per_month(_saved_sales(src), *_dims(src, "employee")), "total_sales")


@query(
    f"""
    SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, total_sales, {_dec("total_sales")} AS avg_total_sales
    FROM r_daily GROUP BY 1, 2
    """,
    ORACLE_REPORTS,
)
def monthly_heat(src):
    return _wide(reports.monthly_heat(_saved_sales(src)), "total_sales", "avg_total_sales")


@query(
    f"""SELECT "Latitude", "Longitude", {_dec("sum(total_sales)")} AS total_sales FROM r_places GROUP BY 1, 2""",
    ORACLE_REPORTS,
)
def map_points(src):
    return _wide(reports.map_points(_saved_sales(src), *_dims(src, "city")), "total_sales")


@query("SELECT * FROM r_items", ORACLE_REPORTS)
def item_series(src):
    return reports.item_series(_saved_sales(src), *_dims(src, "stock_item"))


@query(f"""SELECT "Employee", {_dec("sum(total_sales)")} AS total_sales FROM r_best GROUP BY 1""", ORACLE_REPORTS)
def seller_totals(src):
    return _wide(reports.seller_totals(_saved_sales(src), *_dims(src, "employee")), "total_sales")


@query("SELECT * FROM r_best", ORACLE_REPORTS)
def month_seller(src):
    return _wide(reports.month_seller(_saved_sales(src), *_dims(src, "employee")), "total_sales")


# ---------------------------------------------------------------------------
# Checks
# ---------------------------------------------------------------------------


@query(
    """
    SELECT CASE WHEN n > 0 THEN 'actual' ELSE 'expected' END AS only_in, CAST(abs(n) AS BIGINT) AS copies, l_orderkey,
           l_linenumber, l_returnflag
    FROM (SELECT l_orderkey, l_linenumber, l_returnflag, sum(s) AS n
          FROM (SELECT l_orderkey, l_linenumber, l_returnflag, 1 AS s FROM lineitem
                UNION ALL
                SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 100 = 0 THEN 'X' ELSE l_returnflag END, -1
                FROM lineitem WHERE l_orderkey % 101 <> 0)
          GROUP BY 1, 2, 3) WHERE n <> 0
    """
)
def table_diff_(src):
    lines = src.read("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    changed = lines.where("l_orderkey % 101 <> 0").withColumn(
        "l_returnflag", F.when(F.col("l_orderkey") % 100 == 0, "X").otherwise(F.col("l_returnflag"))
    )
    return table_diff(lines, changed)


@query(
    """
    SELECT min("SaleKey") AS first_key, max("SaleKey") AS last_key, count(*) AS n_rows,
           count(DISTINCT "SaleKey") AS n_keys,
           count(*) = count(DISTINCT "SaleKey") AND max("SaleKey") - min("SaleKey") + 1 = count(*) AS contiguous
    FROM fact_sale
    """
)
def key_check(src):
    return key_range(_saved_sales(src), "SaleKey")


@query("SELECT p_name, count(DISTINCT p_partkey) AS n_ids FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) > 1")
def name_check(src):
    return ambiguous_names(src.read("part"), "p_partkey", "p_name")


@query(
    """
    SELECT o_orderkey, l_linenumber, o_orderdate AS "ValidFrom", l_shipdate AS "ValidTo"
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_shipdate <= o_orderdate
    """
)
def interval_check(src):
    spans = (
        src.read("orders")
        .join(src.read("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "o_orderkey", "l_linenumber", F.col("o_orderdate").alias("ValidFrom"), F.col("l_shipdate").alias("ValidTo")
        )
    )
    return invalid_intervals(spans)
