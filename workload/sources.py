"""The operational tables of the warehouse, derived from the test tables.

Nothing here is made up row by row: histories come from the yearly first order
or shipment of a customer, supplier or part, so every derived table grows with
the tables it is read from.  Dates are moved 18 years on, which puts the first
order on the warehouse's first day.  ``workload/sql.py`` derives the same
tables for the oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.temporal import version_timeline
from starloom.sources.staging import stage, unrecorded

BEGIN = "2013-01-01 00:00:00"
OPEN_END = "2099-12-31 00:00:00"
LOAD_TO = "2018-06-01 00:00:00"


def _ts(text):
    return F.lit(text).cast("timestamp_ntz")


def money(column):
    return F.col(column).cast("decimal(18,2)")


_saved: dict[tuple, DataFrame] = {}


def saved(tables: Tables, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table written once per session and folder, then read like any saved table."""
    key = (tables.spark.sparkContext.applicationId, tables.folder, name)
    if key not in _saved:
        with unrecorded():  # it outlives the query that asked first
            _saved[key] = build()
    return _saved[key]


class Tables:
    """The test tables of one scale, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def orders(self):
        moved = F.expr("CAST(o_orderdate AS timestamp_ntz) + INTERVAL 18 YEARS")
        return self.read("orders").withColumn("o_at", moved)

    @cached_property
    def lineitem(self):
        moved = F.expr("CAST(l_shipdate AS timestamp_ntz) + INTERVAL 18 YEARS")
        return self.read("lineitem").withColumn("l_at", moved)

    @cached_property
    def events(self):
        return self.read("events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


class Sources(Tables):
    """Raw tables by the names the star reads."""

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    def _yearly(self, members: DataFrame, member: str, facts: DataFrame, ref: str, at: str) -> DataFrame:
        """(member, ValidFrom, ValidTo, n): one version at the beginning, one per year with activity."""

        def build():
            first = members.select(F.col(member).alias("m"), _ts(BEGIN).alias("ValidFrom"), F.lit(0).alias("n"))
            years = facts.groupBy(F.col(ref).alias("m"), F.year(at).alias("y")).agg(
                F.min(at).alias("ValidFrom"), F.count(F.lit(1)).cast("int").alias("n")
            )
            starts = first.unionByName(years.where(F.col("ValidFrom") > _ts(BEGIN)).drop("y"))
            spans = version_timeline(starts, "m", "ValidFrom", default_end=OPEN_END)
            return stage(spans.withColumn("LoadDatetime", F.expr("ValidFrom + INTERVAL 1 DAY")), f"{member}-years")

        return saved(self, f"{member}-years", build)

    @cached_property
    def customer_years(self):
        return self._yearly(self.read("customer"), "c_custkey", self.orders, "o_custkey", "o_at")

    @cached_property
    def supplier_years(self):
        return self._yearly(self.read("supplier"), "s_suppkey", self.lineitem, "l_suppkey", "l_at")

    @cached_property
    def part_years(self):
        return self._yearly(self.read("part"), "p_partkey", self.lineitem, "l_partkey", "l_at")

    def _dated(self, df: DataFrame, cuts: list[str]) -> DataFrame:
        """One version per cut, numbered 1, 2, ... in ``version``."""
        ends = cuts[1:] + [OPEN_END]
        spans = F.array(
            *[
                F.struct(F.lit(i + 1).alias("version"), _ts(a).alias("ValidFrom"), _ts(b).alias("ValidTo"))
                for i, (a, b) in enumerate(zip(cuts, ends))
            ]
        )
        return df.select("*", F.inline(spans)).withColumn("LoadDatetime", F.expr("ValidFrom + INTERVAL 1 DAY"))

    VALIDITY = ("ValidFrom", "ValidTo", "LoadDatetime")

    @cached_property
    def application_cities(self):
        key = F.col("c_custkey")
        lon, lat = F.col("c_nationkey") - 12, key % 90
        return self.customer_years.join(self.read("customer"), F.col("m") == key).select(
            (key + 1).cast("int").alias("CityID"),
            F.col("c_name").alias("CityName"),
            (F.col("c_nationkey") + 1).alias("StateProvinceID"),
            F.concat(F.lit("POINT ("), lon, F.lit(".5 "), lat, F.lit(".25)")).alias("Location"),
            F.when(key % 7 != 0, F.col("n") * 1000 + key).alias("LatestRecordedPopulation"),
            *self.VALIDITY,
        )

    @cached_property
    def application_stateprovinces(self):
        return self._dated(self.read("nation"), [BEGIN, "2016-01-01 00:00:00"]).select(
            (F.col("n_nationkey") + 1).alias("StateProvinceID"),
            F.col("n_name").alias("StateProvinceName"),
            (F.col("n_regionkey") + 1).alias("CountryID"),
            F.concat(F.lit("T"), F.col("n_nationkey") % 4, F.lit("-"), F.col("version")).alias("SalesTerritory"),
            *self.VALIDITY,
        )

    @cached_property
    def application_countries(self):
        return self._dated(self.read("region"), [BEGIN, "2017-07-01 00:00:00"]).select(
            (F.col("r_regionkey") + 1).alias("CountryID"),
            F.col("r_name").alias("CountryName"),
            F.col("r_name").alias("Continent"),
            F.concat(F.lit("R"), F.col("r_regionkey")).alias("Region"),
            F.concat(F.lit("S"), F.col("version")).alias("Subregion"),
            *self.VALIDITY,
        )

    @cached_property
    def sales_customers(self):
        key = F.col("c_custkey")
        return self.customer_years.join(self.read("customer"), F.col("m") == key).select(
            (key + 1).cast("int").alias("CustomerID"),
            F.concat("c_name", F.lit(" v"), F.col("n")).alias("CustomerName"),
            (key - key % 10 + 1).cast("int").alias("BillToCustomerID"),
            F.ascii("c_mktsegment").alias("CustomerCategoryID"),
            F.when(key % 11 != 0, F.col("c_nationkey") % 3 + 1).alias("BuyingGroupID"),
            F.expr("c_custkey div 15 + 1").cast("int").alias("PrimaryContactPersonID"),
            (key + 1).cast("int").alias("DeliveryCityID"),
            (F.col("n") + 90000).cast("string").alias("DeliveryPostalCode"),
            *self.VALIDITY,
        )

    @cached_property
    def sales_customercategories(self):
        segments = self.read("customer").select("c_mktsegment").distinct()
        return self._dated(segments, [BEGIN, "2015-03-01 00:00:00", "2017-06-15 00:00:00"]).select(
            F.ascii("c_mktsegment").alias("CustomerCategoryID"),
            F.concat("c_mktsegment", F.lit(" v"), F.col("version")).alias("CustomerCategoryName"),
            *self.VALIDITY,
        )

    @cached_property
    def sales_buyinggroups(self):
        groups = self.read("customer").select((F.col("c_nationkey") % 3 + 1).alias("g")).distinct()
        return self._dated(groups, [BEGIN, "2016-02-29 00:00:00"]).select(
            F.col("g").alias("BuyingGroupID"),
            F.concat(F.lit("Group "), "g", F.lit(" v"), F.col("version")).alias("BuyingGroupName"),
            *self.VALIDITY,
        )

    @cached_property
    def application_people(self):
        key = F.col("s_suppkey")
        people = self.supplier_years.join(self.read("supplier"), F.col("m") == key)
        # every fifth person also has a version of no length
        moment = _ts("2014-05-05 00:00:00")
        empty = people.where((key % 5 == 0) & (F.col("ValidFrom") == _ts(BEGIN))).withColumns(
            {"ValidFrom": moment, "ValidTo": moment}
        )
        return people.unionByName(empty).select(
            (key + 1).cast("int").alias("PersonID"),
            F.concat("s_name", F.lit(" v"), F.col("n")).alias("FullName"),
            F.col("s_name").alias("PreferredName"),
            (key % 3 != 0).alias("IsEmployee"),
            (key % 2 == 0).alias("IsSalesperson"),
            F.lit(None).cast("string").alias("Photo"),
            *self.VALIDITY,
        )

    @cached_property
    def warehouse_colors(self):
        brands = self.read("part").select("p_brand").distinct()
        return self._dated(brands, [BEGIN, "2016-01-01 00:00:00"]).select(
            F.substring("p_brand", 7, 3).cast("int").alias("ColorID"),
            F.concat("p_brand", F.lit(" v"), F.col("version")).alias("ColorName"),
            *self.VALIDITY,
        )

    @cached_property
    def warehouse_packagetypes(self):
        kinds = self.read("orders").select("o_orderpriority").distinct()
        return self._dated(kinds, [BEGIN, "2015-07-01 00:00:00"]).select(
            F.substring("o_orderpriority", 1, 1).cast("int").alias("PackageTypeID"),
            F.concat(F.substring("o_orderpriority", 3, 50), F.lit(" v"), F.col("version")).alias("PackageTypeName"),
            *self.VALIDITY,
        )

    @cached_property
    def warehouse_stockgroups(self):
        kinds = self.read("part").select("p_type").distinct()
        return self._dated(kinds, [BEGIN]).select(
            F.ascii(F.substring("p_type", 2, 1)).alias("StockGroupID"),
            F.col("p_type").alias("StockGroupName"),
            F.lit(1).alias("LastEditedBy"),
            *self.VALIDITY,
        )

    @cached_property
    def warehouse_stockitemstockgroups(self):
        key, k = F.col("p_partkey"), F.col("k")
        links = self.read("part").withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
        late = (k == 2) & (key % 2 == 1)
        return links.select(
            (key * 2 + k).cast("int").alias("StockItemStockGroupID"),
            (key + 1).cast("int").alias("StockItemID"),
            F.when(k == 1, F.ascii(F.substring("p_type", 2, 1))).otherwise(84).alias("StockGroupID"),
            F.when(late, _ts("2013-01-02 00:00:00")).otherwise(_ts(BEGIN)).alias("LastEditedWhen"),
            _ts(BEGIN).alias("LoadDatetime"),
        )

    @cached_property
    def warehouse_stockitems(self):
        key = F.col("p_partkey")
        return self.part_years.join(self.read("part"), F.col("m") == key).select(
            (key + 1).cast("int").alias("StockItemID"),
            F.concat("p_name", F.lit(" "), key).alias("StockItemName"),
            F.when(key % 6 != 0, F.substring("p_brand", 7, 3).cast("int")).alias("ColorID"),
            (F.col("p_size") % 5 + 1).alias("UnitPackageID"),
            (key % 5 + 1).cast("int").alias("OuterPackageID"),
            F.when(key % 4 != 0, F.col("p_brand")).alias("Brand"),
            F.when(key % 9 != 0, F.col("p_size").cast("string")).alias("Size"),
            F.col("p_size").alias("LeadTimeDays"),
            (F.col("p_size") % 12 + 1).alias("QuantityPerOuter"),
            (F.col("p_type") == "ECONOMY").alias("IsChillerStock"),
            F.when(key % 8 == 0, F.concat(F.lit("B"), key)).alias("Barcode"),
            F.lit("15").cast("decimal(18,3)").alias("TaxRate"),
            (money("p_retailprice") + F.col("n")).cast("decimal(18,2)").alias("UnitPrice"),
            money("p_retailprice").alias("RecommendedRetailPrice"),
            F.col("p_size").cast("decimal(18,3)").alias("TypicalWeightPerUnit"),
            F.lit(None).cast("string").alias("Photo"),
            *self.VALIDITY,
        )

    @cached_property
    def purchasing_suppliers(self):
        key = F.col("s_suppkey")
        return self.supplier_years.join(self.read("supplier"), F.col("m") == key).select(
            (key + 1).cast("int").alias("SupplierID"),
            F.col("s_name").alias("SupplierName"),
            (F.col("s_nationkey") % 5 + 1).alias("SupplierCategoryID"),
            (key + 1).cast("int").alias("PrimaryContactPersonID"),
            F.concat(F.lit("REF"), key).alias("SupplierReference"),
            F.col("n").alias("PaymentDays"),
            F.concat(F.lit("P"), F.col("s_nationkey")).alias("DeliveryPostalCode"),
            *self.VALIDITY,
        )

    @cached_property
    def purchasing_suppliercategories(self):
        kinds = self.read("supplier").select((F.col("s_nationkey") % 5 + 1).alias("k")).distinct()
        return self._dated(kinds, [BEGIN, "2016-06-01 00:00:00"]).select(
            F.col("k").alias("SupplierCategoryID"),
            F.concat(F.lit("Category "), "k", F.lit(" v"), F.col("version")).alias("SupplierCategoryName"),
            *self.VALIDITY,
        )

    @cached_property
    def application_paymentmethods(self):
        first = self.orders.groupBy("o_orderpriority").agg(F.min("o_at").alias("ValidFrom"))
        return first.select(
            F.substring("o_orderpriority", 1, 1).cast("int").alias("PaymentMethodID"),
            F.substring("o_orderpriority", 3, 50).alias("PaymentMethodName"),
            "ValidFrom",
            _ts(OPEN_END).alias("ValidTo"),
            F.expr("ValidFrom + INTERVAL 1 DAY").alias("LoadDatetime"),
        )

    @cached_property
    def application_transactiontypes(self):
        """A version per event type and day, twice on most days with different ends."""
        day = F.col("ts").cast("date")
        spans = self.events.groupBy("event_type", day.alias("d"), (F.col("user_id") % 2).alias("half")).agg(
            F.max("ts").alias("ValidTo")
        )
        return spans.select(
            F.ascii("event_type").alias("TransactionTypeID"),
            F.col("event_type").alias("TransactionTypeName"),
            F.col("d").cast("timestamp_ntz").alias("ValidFrom"),
            "ValidTo",
            F.col("ValidTo").alias("LoadDatetime"),
        )

    @cached_property
    def warehouse_stockitemholdings(self):
        held = self.lineitem.groupBy("l_partkey").agg(
            F.sum(F.col("l_quantity").cast("int")).cast("int").alias("QuantityOnHand"),
            F.count(F.lit(1)).cast("int").alias("LastStocktakeQuantity"),
            F.max(money("l_extendedprice")).alias("LastCostPrice"),
            F.max("l_at").alias("LoadDatetime"),
        )
        key = F.col("p_partkey")
        return held.join(self.read("part"), F.col("l_partkey") == key).select(
            (key + 1).cast("int").alias("StockItemID"),
            "QuantityOnHand",
            F.concat(F.lit("L-"), key % 10).alias("BinLocation"),
            "LastStocktakeQuantity",
            "LastCostPrice",
            F.col("p_size").alias("ReorderLevel"),
            (F.col("p_size") * 10).alias("TargetStockLevel"),
            "LoadDatetime",
        )

    @cached_property
    def _headers(self):
        return self.orders.withColumns(
            {
                "LastEditedWhen": F.expr("o_at + INTERVAL 12 HOURS"),
                "LoadDatetime": F.expr("CAST(trunc(o_at, 'MM') AS timestamp_ntz) + INTERVAL 1 MONTH"),
                # references reach every member, however many there are
                "SalespersonPersonID": F.expr("o_custkey div 45 * 3 + 2").cast("int"),
                "CustomerID": (F.col("o_custkey") + 1).cast("int"),
            }
        )

    @cached_property
    def _lines(self):
        part = F.col("l_partkey")
        return self.lineitem.select(
            F.col("l_orderkey"),
            F.col("l_linenumber"),
            # every fiftieth part is not in the item history
            F.when(part % 50 == 0, part + 10_000_000).otherwise(part + 1).cast("int").alias("StockItemID"),
            F.concat(F.lit("Part "), part).alias("Description"),
            (F.col("l_linenumber") % 5 + 1).alias("PackageTypeID"),
            F.col("l_quantity").cast("int").alias("Quantity"),
            money("l_extendedprice").alias("UnitPrice"),
            (money("l_tax") * 100).cast("decimal(18,3)").alias("TaxRate"),
            money("l_tax").alias("tax"),
            money("l_discount").alias("discount"),
            "l_at",
        )

    @cached_property
    def sales_orders(self):
        key = F.col("o_orderkey")
        return self._headers.select(
            (key + 1).cast("int").alias("OrderID"),
            "CustomerID",
            "SalespersonPersonID",
            F.when(key % 5 != 0, F.expr("o_custkey div 15 + 1")).cast("int").alias("PickedByPersonID"),
            F.when(F.col("o_orderstatus") == "P", key).cast("int").alias("BackorderOrderID"),
            F.col("o_at").cast("date").alias("OrderDate"),
            "LastEditedWhen",
            "LoadDatetime",
        )

    @cached_property
    def sales_orderlines(self):
        return self._lines.select(
            F.col("l_linenumber").alias("OrderLineID"),
            (F.col("l_orderkey") + 1).cast("int").alias("OrderID"),
            "StockItemID",
            "Description",
            "PackageTypeID",
            "Quantity",
            "UnitPrice",
            "TaxRate",
            F.col("l_at").alias("PickingCompletedWhen"),
            F.col("l_at").alias("LastEditedWhen"),
        )

    @cached_property
    def sales_invoices(self):
        cust = F.col("o_custkey")
        return self._headers.select(
            (F.col("o_orderkey") + 1).cast("int").alias("InvoiceID"),
            "CustomerID",
            (cust - cust % 10 + 1).cast("int").alias("BillToCustomerID"),
            "SalespersonPersonID",
            F.col("o_at").cast("date").alias("InvoiceDate"),
            F.when(F.col("o_orderstatus") != "P", F.expr("o_at + INTERVAL 2 DAYS")).alias("ConfirmedDeliveryTime"),
            "LastEditedWhen",
            "LoadDatetime",
        )

    @cached_property
    def sales_invoicelines(self):
        return self._lines.select(
            F.col("l_linenumber").alias("InvoiceLineID"),
            (F.col("l_orderkey") + 1).cast("int").alias("InvoiceID"),
            "StockItemID",
            "Description",
            "PackageTypeID",
            "Quantity",
            "UnitPrice",
            "TaxRate",
            (F.col("tax") * F.col("Quantity")).cast("decimal(18,2)").alias("TaxAmount"),
            (F.col("discount") * 10).cast("decimal(18,2)").alias("LineProfit"),
            F.col("UnitPrice").alias("ExtendedPrice"),
            F.col("l_at").alias("LastEditedWhen"),
        )

    # User histories: every event starts a version of its user.

    @cached_property
    def user_versions(self):
        """(user_id, event_type, value, ValidFrom, ValidTo) without the purchases."""
        states = self.events.where("event_type <> 'purchase'").select(
            "event_id", "user_id", "event_type", money("value").alias("value"), F.col("ts").alias("ValidFrom")
        )
        return version_timeline(states, "user_id", "ValidFrom", default_end=OPEN_END)

    @cached_property
    def purchases(self):
        return self.events.where("event_type = 'purchase'").select(
            "event_id", "user_id", F.col("ts").alias("at"), money("value").alias("value")
        )

    def user_history(self, kinds: list[str]) -> DataFrame:
        """A user's versions made by some event types only."""
        states = self.events.where(F.col("event_type").isin(kinds)).select(
            "event_id", "user_id", "event_type", F.col("ts").alias("ValidFrom")
        )
        return version_timeline(states, "user_id", "ValidFrom", default_end=OPEN_END)
