"""Dimensions, facts and reports on a small hand-made warehouse."""

import datetime as dt
import random
import uuid
from collections import Counter
from decimal import Decimal as dec

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators import sizes, temporal
from starloom.operators.checks import intervals_valid, keys_contiguous, name_identifies_id, tables_equal
from starloom.plans import dimensions, facts, reports
from starloom.plans.calendar import calendar
from starloom.plans.star import build_dimensions, build_facts, build_star, save_star
from starloom.sources.tables import read_table

D = dt.datetime
START, FAR, TO = D(2013, 1, 1), D(2038, 1, 19, 3, 14, 7, 999999), D(2020, 1, 1)
OPEN = D(2099, 12, 31)
LOAD = D(2013, 1, 2)
VALID = "ValidFrom timestamp, ValidTo timestamp, LoadDatetime timestamp"


@pytest.fixture(scope="module")
def src(spark):
    def table(ddl, rows):
        return spark.createDataFrame(rows, ddl)

    def dated(ddl, rows):
        return table(f"{ddl}, {VALID}", [(*r[:-2], *r[-2:], r[-2] + dt.timedelta(days=1)) for r in rows])

    mid = D(2016, 1, 1)
    return {
        "application_cities": dated(
            "CityID int, CityName string, StateProvinceID int, Location string, LatestRecordedPopulation bigint",
            [
                (1, "Abbott", 10, "POINT (-97.5 31.25)", None, START, D(2015, 1, 1)),
                (1, "Abbott", 10, "POINT (-97.5 31.25)", 500, D(2015, 1, 1), OPEN),
                (2, "Nowhere", 10, None, 7, START, D(2014, 6, 1)),
                (3, "Orphan", 99, None, 7, START, OPEN),
            ],
        ),
        "application_stateprovinces": dated(
            "StateProvinceID int, StateProvinceName string, CountryID int, SalesTerritory string",
            [(10, "Texas", 100, "South", START, mid), (10, "Texas", 100, "Southwest", mid, OPEN)],
        ),
        "application_countries": dated(
            "CountryID int, CountryName string, Continent string, Region string, Subregion string",
            [(100, "United States", "North America", "Americas", "Northern America", START, OPEN)],
        ),
        "application_people": dated(
            "PersonID int, FullName string, PreferredName string, IsEmployee boolean, IsSalesperson boolean, Photo string",
            [
                (1, "Kayla", "Kay", True, True, None, START, D(2017, 1, 1)),
                (1, "Kayla B", "Kay", True, True, None, D(2017, 1, 1), OPEN),
                (2, "Hudson", "Hud", True, False, None, START, OPEN),
                (2, "Hudson", "Hud", True, False, None, D(2014, 1, 1), D(2014, 1, 1)),
                (3, "Contact", "Con", False, False, None, START, D(2018, 5, 5)),
                (3, "Contact Two", "Con", False, False, None, D(2018, 5, 5), OPEN),
            ],
        ),
        "sales_customers": dated(
            "CustomerID int, CustomerName string, BillToCustomerID int, CustomerCategoryID int, BuyingGroupID int, "
            "PrimaryContactPersonID int, DeliveryCityID int, DeliveryPostalCode string",
            [
                (1, "Tailspin", 1, 5, 7, 3, 1, "90410", START, D(2019, 3, 3)),
                (1, "Tailspin Toys", 1, 5, 7, 3, 1, "90410", D(2019, 3, 3), OPEN),
                (2, "Wingtip", 1, 5, 7, 3, 2, "90669", START, OPEN),
                (3, "Groupless", 1, 5, None, 3, 2, "90777", START, OPEN),
            ],
        ),
        "sales_customercategories": dated(
            "CustomerCategoryID int, CustomerCategoryName string",
            [(5, "Novelty", START, D(2015, 5, 1)), (5, "Novelty Shop", D(2015, 5, 1), OPEN)],
        ),
        "sales_buyinggroups": dated("BuyingGroupID int, BuyingGroupName string", [(7, "Toys", START, OPEN)]),
        "warehouse_colors": dated("ColorID int, ColorName string", [(1, "Red", START, OPEN)]),
        "warehouse_packagetypes": dated(
            "PackageTypeID int, PackageTypeName string", [(1, "Each", START, OPEN), (2, "Box", START, mid), (2, "Carton", mid, OPEN)]
        ),
        "warehouse_stockgroups": table(
            f"StockGroupID int, StockGroupName string, LastEditedBy int, {VALID}",
            [(1, "Mugs", 1, START, OPEN, LOAD), (2, "Toys", 1, START, OPEN, LOAD)],
        ),
        "warehouse_stockitemstockgroups": table(
            "StockItemStockGroupID int, StockItemID int, StockGroupID int, LastEditedWhen timestamp, LoadDatetime timestamp",
            [(1, 1, 1, START, LOAD), (2, 1, 2, START, LOAD), (3, 2, 1, START, LOAD), (4, 2, 2, D(2013, 1, 9), LOAD)],
        ),
        "warehouse_stockitems": dated(
            "StockItemID int, StockItemName string, ColorID int, UnitPackageID int, OuterPackageID int, Brand string, "
            "Size string, LeadTimeDays int, QuantityPerOuter int, IsChillerStock boolean, Barcode string, "
            "TaxRate decimal(18,3), UnitPrice decimal(18,2), RecommendedRetailPrice decimal(18,2), "
            "TypicalWeightPerUnit decimal(18,3), Photo string",
            [
                (1, "Mug", 1, 1, 2, None, "S", 5, 10, False, None, dec(15), dec(13), dec(20), dec(1), None, START, D(2018, 1, 1)),
                (1, "Mug", 1, 1, 2, None, "S", 5, 10, False, None, dec(15), dec(14), dec(20), dec(1), None, D(2018, 1, 1), OPEN),
                (2, "Choc", None, 1, 1, "Northwind", None, 5, 10, True, "b", dec(10), dec(8), dec(12), dec(1), None, START, OPEN),
            ],
        ),
        "application_transactiontypes": dated(
            "TransactionTypeID int, TransactionTypeName string",
            [(1, "Invoice", START, OPEN), (1, "Invoice", START, D(2015, 1, 1)), (2, "Credit", START, OPEN)],
        ),
        "application_paymentmethods": dated("PaymentMethodID int, PaymentMethodName string", [(1, "Cash", START, OPEN)]),
        "purchasing_suppliers": dated(
            "SupplierID int, SupplierName string, SupplierCategoryID int, PrimaryContactPersonID int, "
            "SupplierReference string, PaymentDays int, DeliveryPostalCode string",
            [(1, "Supplier1", 1, 1, "Ref1", 30, "12345", D(2014, 1, 1), D(2016, 1, 1))],
        ),
        "purchasing_suppliercategories": dated(
            "SupplierCategoryID int, SupplierCategoryName string", [(1, "Category 1", D(2016, 1, 1), OPEN)]
        ),
        "warehouse_stockitemholdings": table(
            "StockItemID int, QuantityOnHand int, BinLocation string, LastStocktakeQuantity int, "
            "LastCostPrice decimal(18,2), ReorderLevel int, TargetStockLevel int, LoadDatetime timestamp",
            [(2, 5, "L-1", 4, dec(1), 1, 9, LOAD), (9, 6, "L-2", 4, dec(1), 1, 9, LOAD), (1, 7, "L-3", 4, dec(1), 1, 9, LOAD)],
        ),
        "sales_orders": table(
            "OrderID int, CustomerID int, SalespersonPersonID int, PickedByPersonID int, BackorderOrderID int, "
            "OrderDate date, LastEditedWhen timestamp, LoadDatetime timestamp",
            [
                (1, 1, 1, 2, None, dt.date(2014, 3, 1), D(2014, 3, 1, 12), D(2014, 4, 1)),
                (2, 2, 1, None, 1, dt.date(2018, 3, 1), D(2018, 3, 1, 12), D(2018, 4, 1)),
                (3, 8, 1, None, 1, dt.date(2018, 3, 1), D(2018, 3, 1, 12), D(2018, 4, 1)),
            ],
        ),
        "sales_orderlines": spark.createDataFrame(
            [
                (11, 1, 1, "Mug", 1, 3, "13", "15", D(2014, 3, 2), D(2014, 3, 2)),
                (12, 1, 77, "Lost", 1, 1, "1", "15", None, D(2014, 3, 2)),
                (13, 1, 78, "Lost too", 1, 1, "1", "15", None, D(2014, 3, 2)),
                (14, 2, 1, "Mug", 2, 7, "13.33", "15.555", D(2018, 3, 2), D(2018, 2, 1)),
                (15, 2, 2, "Choc", 1, 1, "8", "10", D(2018, 3, 2), D(2013, 1, 1)),
            ],
            "OrderLineID int, OrderID int, StockItemID int, Description string, PackageTypeID int, Quantity int, "
            "p string, t string, PickingCompletedWhen timestamp, LastEditedWhen timestamp",
        ).selectExpr("*", "CAST(p AS decimal(18,2)) AS UnitPrice", "CAST(t AS decimal(18,3)) AS TaxRate").drop("p", "t"),
        "sales_invoices": table(
            "InvoiceID int, CustomerID int, BillToCustomerID int, SalespersonPersonID int, InvoiceDate date, "
            "ConfirmedDeliveryTime timestamp, LastEditedWhen timestamp, LoadDatetime timestamp",
            [
                (1, 1, 1, 1, dt.date(2014, 3, 1), D(2014, 3, 3, 8), D(2014, 3, 1, 12), D(2014, 4, 1)),
                (2, 2, 1, 2, dt.date(2018, 3, 1), None, D(2018, 3, 1, 12), D(2018, 4, 1)),
            ],
        ),
        "sales_invoicelines": spark.createDataFrame(
            [
                (21, 1, 1, "Mug", 1, 3, "13", "15", "5.85", "20", "44.85", D(2014, 3, 2)),
                (22, 1, 2, "Choc", 1, 10, "8", "10", "8", "30", "88", D(2014, 3, 2)),
                (23, 2, 2, "Choc", 2, 1, "8", "10", "0.8", "3", "8.8", D(2018, 3, 2)),
                (24, 2, 77, "Lost", 2, 1, "8", "10", "0.8", "3", "8.8", D(2018, 3, 2)),
            ],
            "InvoiceLineID int, InvoiceID int, StockItemID int, Description string, PackageTypeID int, Quantity int, "
            "a string, b string, c string, d string, e string, LastEditedWhen timestamp",
        ).selectExpr(
            "*", "CAST(a AS decimal(18,2)) UnitPrice", "CAST(b AS decimal(18,3)) TaxRate", "CAST(c AS decimal(18,2)) TaxAmount",
            "CAST(d AS decimal(18,2)) LineProfit", "CAST(e AS decimal(18,2)) ExtendedPrice",
        ).drop("a", "b", "c", "d", "e"),
    }


@pytest.fixture(scope="module")
def dims(src):
    return build_dimensions(src, TO)


def by_key(df, key):
    return df.orderBy(key).collect()


def schema_of(df):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else '!'}" for f in df.schema.fields)


# The target schemas, ! for columns that are never null.
CITY = (
    "CityKey int!, WWICityID int, City string, StateProvince string, Country string, Continent string, "
    "SalesTerritory string, Region string, Subregion string, Location string, LatestRecordedPopulation bigint!, "
    "ValidFrom timestamp, ValidTo timestamp, LineageKey int!, Longitude double, Latitude double"
)
CUSTOMER = (
    "CustomerKey int!, WWICustomerID int, Customer string, BillToCustomer string, Category string, "
    "BuyingGroup string, PrimaryContact string, PostalCode string, ValidFrom timestamp, ValidTo timestamp, LineageKey int!"
)
EMPLOYEE = (
    "EmployeeKey int!, WWIEmployeeID int, Employee string, PreferredName string, IsSalesperson boolean, "
    "Photo string, ValidFrom timestamp, ValidTo timestamp, LineageKey int!"
)
STOCK_ITEM = (
    "StockItemKey int!, WWIStockItemID int, StockItem string, Color string!, SellingPackage string, "
    "BuyingPackage string, Brand string!, Size string!, LeadTimeDays int, QuantityPerOuter int, IsChillerStock boolean, "
    "Barcode string!, TaxRate decimal(18,3), UnitPrice decimal(18,2), RecommendedRetailPrice decimal(18,2), "
    "TypicalWeightPerUnit decimal(18,3), Photo string, ValidFrom timestamp, ValidTo timestamp, LineageKey int!"
)
SALE = (
    "SaleKey int!, CityKey int!, CustomerKey int!, BillToCustomerKey int!, StockItemKey int!, InvoiceDateKey date, "
    "DeliveryDateKey date, SalespersonKey int!, WWIInvoiceID int, Description string, Package string, Quantity int, "
    "UnitPrice decimal(18,2), TaxRate decimal(18,3), TotalExcludingTax decimal(19,2), TaxAmount decimal(18,2), "
    "Profit decimal(18,2), TotalIncludingTax decimal(18,2), TotalDryItems int, TotalChillerItems int, LineageKey int!, "
    "RawDataLoadDatetime timestamp"
)
ORDER = (
    "OrderKey int!, CityKey int!, CustomerKey int!, StockItemKey int!, OrderDateKey date, PickedDateKey date, "
    "SalespersonKey int!, PickerKey int!, WWIOrderID int, WWIBackorderID int, Description string, Package string, "
    "Quantity int, UnitPrice decimal(18,2), TaxRate decimal(18,3), TotalExcludingTax decimal(30,2), "
    "TaxAmount decimal(35,2), TotalIncludingTax decimal(36,2), LineageKey int!, RawDataLoadDatetime timestamp"
)


def test_city(src):
    out = dimensions.city(
        src["application_cities"], src["application_countries"], src["application_stateprovinces"], to=TO
    )
    assert schema_of(out) == CITY
    rows = by_key(out, "CityKey")
    assert tuple(rows[0]) == (
        0, 0, "Unknown", "N/A", "N/A", "N/A", "N/A", "N/A", "N/A", None, 0, START, FAR, 0, 0.0, 0.0
    )
    got = [(r.WWICityID, r.SalesTerritory, r.LatestRecordedPopulation, r.ValidFrom, r.ValidTo) for r in rows[1:]]
    assert got == [
        (1, "South", 0, START, D(2015, 1, 1)),
        (2, "South", 7, START, D(2014, 6, 1)),
        (1, "South", 500, D(2015, 1, 1), D(2016, 1, 1)),
        (1, "Southwest", 500, D(2016, 1, 1), FAR),
    ]
    assert (rows[1].Longitude, rows[1].Latitude, rows[2].Longitude) == (-97.5, 31.25, None)
    assert keys_contiguous(out, "CityKey") and intervals_valid(out) and name_identifies_id(out, "WWICityID", "City")


def test_city_loaded_up_to(src):
    early = dimensions.city(
        src["application_cities"], src["application_countries"], src["application_stateprovinces"], to=D(2014, 1, 1)
    )
    assert [r.ValidFrom for r in by_key(early, "CityKey")] == [START, START, START]
    later = dimensions.city(
        src["application_cities"], src["application_countries"], src["application_stateprovinces"], to=TO, offset=40
    )
    assert [r.CityKey for r in by_key(later, "CityKey")] == [40, 41, 42, 43]


def test_customer(src):
    args = [src[n] for n in ("sales_customers", "sales_customercategories", "sales_buyinggroups", "application_people")]
    out = dimensions.customer(*args, to=TO)
    assert schema_of(out) == CUSTOMER
    rows = by_key(out, "CustomerKey")
    assert tuple(rows[0]) == (0, 0, "Unknown", "N/A", "N/A", "N/A", "N/A", "N/A", START, FAR, 0)
    got = [(r.WWICustomerID, r.Customer, r.Category, r.PrimaryContact, r.ValidFrom, r.ValidTo) for r in rows[1:]]
    c15, p18, c19 = D(2015, 5, 1), D(2018, 5, 5), D(2019, 3, 3)
    assert got == [
        (1, "Tailspin", "Novelty", "Contact", START, c15),
        (2, "Wingtip", "Novelty", "Contact", START, c15),
        (1, "Tailspin", "Novelty Shop", "Contact", c15, p18),
        (2, "Wingtip", "Novelty Shop", "Contact", c15, p18),
        (1, "Tailspin", "Novelty Shop", "Contact Two", p18, c19),
        (2, "Wingtip", "Novelty Shop", "Contact Two", p18, FAR),
        (1, "Tailspin Toys", "Novelty Shop", "Contact Two", c19, FAR),
    ]
    assert keys_contiguous(out, "CustomerKey") and intervals_valid(out)
    with_groupless = dimensions.customer(*args, to=TO, buying_group_how="left")
    names = {(r.Customer, r.BuyingGroup) for r in with_groupless.collect()}
    assert ("Groupless", None) in names


def test_customer_start_shared_by_two_feeds(src, spark):
    moved = src["application_people"].withColumns(
        {c: F.when(F.col(c) == D(2018, 5, 5), F.lit(D(2015, 5, 1))).otherwise(F.col(c)) for c in ("ValidFrom", "ValidTo")}
    )
    args = [src[n] for n in ("sales_customers", "sales_customercategories", "sales_buyinggroups")]
    out = dimensions.customer(*args, moved, to=TO)
    assert intervals_valid(out)
    shared = out.where(F.col("ValidFrom") == D(2015, 5, 1)).collect()
    assert {(r.WWICustomerID, r.Category, r.PrimaryContact) for r in shared} == {
        (1, "Novelty Shop", "Contact Two"),
        (2, "Novelty Shop", "Contact Two"),
    }


def _customers_of(spark, src, seed=7):
    """Customers whose references, times and duplicates lie in all ways to each other, NULLs among them."""
    rng = random.Random(seed)

    def day():
        return D(2014, 1, 1) + dt.timedelta(days=30 * rng.randint(0, 8))

    def some(schema, n, *values):
        rows = [(*[v() for v in values], day(), rng.choice([day(), FAR, None]), day()) for _ in range(n)]
        return spark.createDataFrame(rows, f"{schema}, ValidFrom timestamp, ValidTo timestamp, LoadDatetime timestamp")

    def ref():
        return rng.choice([1, 1, 2, 3, None])

    def name():
        return rng.choice(["a", "b", "c", None])

    schema = "CustomerID int, CustomerName string, DeliveryPostalCode string, BillToCustomerID int, CustomerCategoryID int"
    customers = some(f"{schema}, BuyingGroupID int, PrimaryContactPersonID int", 60, ref, name, name, ref, ref, ref, ref)
    sides = [("CustomerCategoryID", "CustomerCategoryName"), ("BuyingGroupID", "BuyingGroupName"), ("PersonID", "FullName")]
    return [customers, *[some(f"{i} int, {n} string", 14, ref, name) for i, n in sides]]


def test_customer_by_packed_histories_equals_the_joins(spark, src):
    args = _customers_of(spark, src)
    customers, roles = args[0], [
        (None, "_bill_to", args[0], "CustomerID", "CustomerName", "BillToCustomer"),
        (1, "_category", args[1], "CustomerCategoryID", "CustomerCategoryName", "Category"),
        (2, "_group", args[2], "BuyingGroupID", "BuyingGroupName", "BuyingGroup"),
        (3, "_contact", args[3], "PersonID", "FullName", "PrimaryContact"),
    ]
    methods = {role[1]: temporal.Lookup("broadcast", False, True) for role in roles}
    packed = dimensions._customer_packed(customers, roles, methods, "left")
    joined = dimensions._customer_joined(customers, roles, methods, "left")
    assert packed.columns == joined.columns
    packed, joined = packed.collect(), joined.collect()
    assert packed and Counter(packed) == Counter(joined)


def test_rows_of_a_customer_are_brought_together_once(spark, src, monkeypatch):
    args = _customers_of(spark, src)
    written = []
    monkeypatch.setattr(dimensions, "stage_counted", lambda df, label, *a: written.append(label) or sizes.stage_counted(df, label, *a))
    out = dimensions.customer(*args, to=D(2014, 9, 1), offset=None)
    # They were sorted for the dedup before they moved, written and sorted again; fat rows were looked up by sorts.
    plan = out._jdf.queryExecution().executedPlan().toString()
    by_customer = [line for line in plan.splitlines() if "Exchange hashpartitioning(WWICustomerID" in line]
    assert not written and len(by_customer) == 1 and "ValidFrom" not in by_customer[0].split(", 3")[0]


def test_spread_bounds_the_rows_of_a_task(spark, monkeypatch):
    monkeypatch.setattr(sizes, "TASK_ROWS", 100)
    frame = spark.range(1000).select(F.col("id"))
    assert sizes.spread(frame, "id", 1000).rdd.getNumPartitions() == 10
    assert sizes.spread(frame, "id", 200).rdd.getNumPartitions() <= 3 and sizes.spread(frame, "id", None).count() == 1000


def test_employee(src):
    people = src["application_people"]
    out = dimensions.employee(people, to=TO)
    assert schema_of(out) == EMPLOYEE
    rows = by_key(out, "EmployeeKey")
    assert tuple(rows[0]) == (0, 0, "Unknown", "N/A", False, None, START, FAR, 0)
    assert [(r.Employee, r.ValidTo) for r in rows[1:]] == [("Kayla", D(2017, 1, 1)), ("Hudson", FAR), ("Kayla B", FAR)]
    assert all(r.ValidTo == FAR for r in dimensions.employee(people).collect())
    assert dimensions.employee(people, to=D(2012, 12, 31)).count() == 0


def test_stock_item(src):
    args = [
        src[f"warehouse_{n}"] for n in ("colors", "stockgroups", "stockitems", "stockitemstockgroups", "packagetypes")
    ]
    out = dimensions.stock_item(*args, to=TO)
    assert schema_of(out) == STOCK_ITEM
    rows = by_key(out, "StockItemKey")
    assert tuple(rows[0])[:12] == (0, 0, "Unknown", "N/A", "N/A", "N/A", "N/A", "N/A", 0, 0, False, "N/A")
    got = [(r.StockItem, r.Color, r.BuyingPackage, r.Brand, r.Size, r.ValidFrom, r.ValidTo) for r in rows[1:]]
    end = D(9999, 12, 31, 23, 59, 59)
    assert got == [
        ("Mug", "Red", "Box", "N/A", "S", START, D(2018, 1, 1)),
        ("Choc", "N/A", "Each", "Northwind", "N/A", START, end),
        ("Mug", "Red", "Carton", "N/A", "S", D(2018, 1, 1), end),
    ]
    # item 2 has a last group at each of two edit times
    strict = dimensions.stock_item(*args, to=TO, strict_reference=True)
    assert strict.where("WWIStockItemID = 2").count() == 2 and strict.where("WWIStockItemID = 1").count() == 2


def test_supplier_touching_category_counts(src):
    out = dimensions.supplier(
        src["purchasing_suppliers"], src["purchasing_suppliercategories"], src["application_people"], to=D(2025, 1, 1)
    )
    rows = by_key(out, "SupplierKey")
    assert rows[0].Supplier == "Unknown" and rows[0].PaymentDays == 0
    assert tuple(rows[1]) == (
        1, 1, "Supplier1", "Category 1", "Kayla", "Ref1", 30, "12345", D(2014, 1, 1), D(2016, 1, 1), 6
    )
    assert len(rows) == 2


def test_small_dimensions(src):
    kinds = by_key(dimensions.transaction_type(src["application_transactiontypes"]), "TransactionTypeKey")
    assert [(r.TransactionTypeKey, r.TransactionType) for r in kinds] == [(0, "Unknown"), (1, "Invoice"), (2, "Credit")]
    assert kinds[1].ValidTo == OPEN and kinds[1].LineageKey == 7
    methods = by_key(dimensions.payment_method(src["application_paymentmethods"]), "PaymentMethodKey")
    assert [(r.PaymentMethod, r.LineageKey) for r in methods] == [("Unknown", 0), ("Cash", 4)]


def test_calendar(spark):
    days = calendar(spark, "2000-01-01", "2001-02-10")
    assert schema_of(days).replace("!", "") == (
        "Date date, DayNumber int, Day int, Month string, ShortMonth string, CalendarMonthNumber int, "
        "CalendarMonthLabel string, CalendarYear int, CalendarYearLabel string, FiscalMonthNumber int, "
        "FiscalMonthLabel string, FiscalYear int, FiscalYearLabel string, ISOWeekNumber int"
    )
    first, last = days.orderBy("Date").first(), days.orderBy(F.desc("Date")).first()
    assert tuple(first) == (
        dt.date(2000, 1, 1), 1, 1, "January", "Jan", 1, "CY2000-Jan", 2000, "CY2000", 3, "FY2000-Jan", 2000, "FY2000", 52
    )
    assert last.Date == dt.date(2002, 2, 27)
    november = days.where("Date = '2000-11-01'").first()
    assert (november.FiscalMonthNumber, november.FiscalYear, november.FiscalMonthLabel) == (1, 2001, "FY2001-Nov")


def order_args(src, dims):
    tables = [src[n] for n in ("sales_orders", "sales_orderlines", "warehouse_packagetypes", "sales_customers")]
    return [*tables, *[dims[d] for d in ("city", "customer", "stock_item", "employee")]]


def test_order_fact(src, dims):
    out = facts.order(*order_args(src, dims))
    assert schema_of(out) == ORDER
    rows = by_key(out, "OrderKey")
    assert [r.Description for r in rows] == ["Mug", "Lost", "Lost too", "Mug", "Choc"]
    mug, choc = rows[3], rows[4]
    assert (float(mug.TotalExcludingTax), float(mug.TaxAmount), float(mug.TotalIncludingTax)) == (93.31, 14.51, 107.82)
    assert mug.Package == "Carton" and mug.PickerKey == 0 and mug.WWIBackorderID == 1
    by = {k: {r[k]: r for r in dims[d].collect()} for d, k in (("stock_item", "StockItemKey"), ("customer", "CustomerKey"), ("employee", "EmployeeKey"), ("city", "CityKey"))}
    assert by["StockItemKey"][mug.StockItemKey].ValidFrom == D(2018, 1, 1)
    assert by["StockItemKey"][rows[0].StockItemKey].ValidFrom == START
    assert by["CustomerKey"][mug.CustomerKey].ValidFrom == D(2015, 5, 1)
    assert by["EmployeeKey"][mug.SalespersonKey].Employee == "Kayla B"
    assert by["EmployeeKey"][rows[0].PickerKey].Employee == "Hudson"
    assert by["CityKey"][rows[0].CityKey].City == "Abbott" and mug.CityKey == 0  # closed city
    assert choc.StockItemKey > 0 and rows[1].StockItemKey == 0
    assert keys_contiguous(out, "OrderKey")


def test_order_fact_grain_and_earliest_key(src, dims):
    out = facts.order(*order_args(src, dims), grain="item", earliest_key=True)
    rows = by_key(out, "OrderKey")
    assert [r.Description for r in rows] == ["Mug", "Lost", "Mug", "Choc"]
    assert rows[2].StockItemKey == rows[0].StockItemKey  # the earliest version seen
    assert rows[2].SalespersonKey == rows[0].SalespersonKey
    with pytest.raises(ValueError):
        facts.order(*order_args(src, dims), grain="order")


def test_order_fact_window(src, dims):
    part = facts.order(*order_args(src, dims), since=D(2015, 1, 1), to=TO, offset=10)
    assert [(r.OrderKey, r.WWIOrderID) for r in by_key(part, "OrderKey")] == [(10, 2), (11, 2)]
    assert facts.order(*order_args(src, dims), since=D(2015, 1, 1)).count() == 5


def test_sale_fact(src, dims):
    sources = ("sales_invoices", "sales_invoicelines", "sales_customers", "warehouse_stockitems", "warehouse_packagetypes")
    out = facts.sale(*[src[n] for n in sources], *[dims[d] for d in ("employee", "city", "customer", "stock_item")])
    assert schema_of(out) == SALE
    rows = by_key(out, "SaleKey")
    assert [(r.Description, r.TotalDryItems, r.TotalChillerItems) for r in rows] == [("Mug", 3, 0), ("Choc", 0, 10), ("Choc", 0, 1)]
    assert float(rows[0].TotalExcludingTax) == 39.0 and rows[0].DeliveryDateKey == dt.date(2014, 3, 3)
    first_nowhere = dims["city"].where("City = 'Nowhere'").first().CityKey
    assert rows[2].CityKey == first_nowhere  # looked up without a time
    payer = dims["customer"].where(F.col("CustomerKey") == rows[2].BillToCustomerKey).first()
    assert payer.WWICustomerID == 1


@pytest.mark.parametrize("options", [{}, {"grain": "item", "earliest_key": True}])
def test_facts_with_histories_too_large_to_send_around(src, dims, monkeypatch, options):
    want = by_key(facts.order(*order_args(src, dims), **options), "OrderKey")
    monkeypatch.setattr(temporal, "BROADCAST_ROWS", 0)
    out = facts.order(*order_args(src, dims), key_type="bigint", **options)
    assert by_key(out, "OrderKey") == want and out.schema["OrderKey"].dataType.simpleString() == "bigint"


def test_stock_holding(src, dims):
    out = facts.stock_holding(src["warehouse_stockitemholdings"], dims["stock_item"])
    rows = by_key(out, "StockHoldingKey")
    latest = dims["stock_item"].where("WWIStockItemID = 1").orderBy(F.desc("ValidTo")).first().StockItemKey
    assert [(r.StockHoldingKey, r.BinLocation) for r in rows] == [(0, "L-2"), (1, "L-1"), (2, "L-3")]
    assert rows[0].StockItemKey == 0 and rows[2].StockItemKey == latest and rows[0].LineageKey == 12


def test_star_is_saved_and_merged(src, spark):
    schema = f"star_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema}")
    # loads up to 2015 hold the first order only
    first = build_star(spark, src, "2013-01-01", "2015-01-01", to=D(2015, 1, 1))
    assert len(first) == 11
    save_star(first, schema, to=D(2015, 1, 1))
    orders = read_table(spark, f"{schema}.fact_order")
    assert [r.OrderKey for r in by_key(orders, "OrderKey")] == [0, 1]
    targets = {
        n: read_table(spark, f"{schema}.fact_{t}")
        for n, t in (("order", "order"), ("sale", "sale"), ("stock_holding", "stockholding"))
    }
    second = build_star(spark, src, "2013-01-01", "2015-01-01", to=TO, targets=targets)
    save_star(second, schema, to=TO)
    orders = read_table(spark, f"{schema}.fact_order")
    assert [(r.OrderKey, r.WWIOrderID) for r in by_key(orders, "OrderKey")] == [(0, 1), (1, 1), (2, 2), (3, 2)]
    assert read_table(spark, f"{schema}.dimension_date").count() == second["calendar"].count()


def test_full_build_equals_itself(src, dims):
    again = build_dimensions(src, TO, ["customer"])["customer"]
    assert tables_equal(again, dims["customer"])
    assert isinstance(again.schema["ValidTo"].dataType, T.TimestampType)
    one = build_facts(src, dims, names=["sale"])["sale"]
    assert tables_equal(one, build_facts(src, dims, names=["sale"])["sale"])


def test_reports(spark):
    sales = spark.createDataFrame(
        [
            (dt.date(2020, 1, 1), 1, 1, 1, 10, 2), (dt.date(2020, 1, 1), 2, 1, 2, 5, 1), (dt.date(2020, 1, 9), 1, 2, 2, 20, 1),
            (dt.date(2020, 2, 1), 3, 2, 1, 1, 1), (dt.date(2020, 2, 2), 3, 2, 2, 1, 1),
        ],
        "InvoiceDateKey date, StockItemKey int, CityKey int, SalespersonKey int, UnitPrice int, Quantity int",
    )
    items = spark.createDataFrame([(1, "Mug"), (3, "Mug"), (2, "Bag")], "StockItemKey int, StockItem string")
    cities = spark.createDataFrame(
        [(1, "A", "S", "p", 1.0, 2.0), (2, "B", "S", "q", 1.0, 2.0)],
        "CityKey int, City string, StateProvince string, Location string, Latitude double, Longitude double",
    )
    people = spark.createDataFrame([(1, "Ann"), (2, "Bob")], "EmployeeKey int, Employee string")

    def t(df):
        return [tuple(r) for r in df.collect()]

    assert t(reports.daily_sales(sales))[0] == (dt.date(2020, 1, 1), 25)
    assert t(reports.item_ranking(sales, items)) == [("Bag", 1), ("Mug", 5)]
    assert t(reports.item_ranking(sales, items, 1, ascending=False)) == [("Mug", 5)]
    assert [(r[0], r[-1]) for r in t(reports.sales_by_place(sales, cities))] == [("A", 25), ("B", 22)]
    assert t(reports.map_points(sales, cities)) == [(1.0, 2.0, 47)]
    assert t(reports.best_per_month(sales, people)) == [("2020-01", "Bob", 25), ("2020-02", "Ann", 1)]
    assert sorted(t(reports.seller_totals(sales, people))) == [("Ann", 1), ("Bob", 25)]
    assert len(t(reports.month_seller(sales, people))) == 2
    assert sorted(t(reports.item_series(sales, items))) == [("Bag", 1), ("Mug", 5)]
    heat = sorted(t(reports.monthly_heat(sales)))
    assert heat == [(dt.date(2020, 1, 1), 20, 20.0), (dt.date(2020, 1, 1), 25, 25.0), (dt.date(2020, 2, 1), 1, 1.0)]
