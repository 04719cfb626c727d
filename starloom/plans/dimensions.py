"""The slowly changing dimensions.

All builders take the raw histories, then ``to`` (load time up to which rows
count) and ``offset`` (first key; 0 starts a new dimension with its unknown
member, ``None`` leaves the rows without keys).  ``only``, a frame whose first
column has natural ids, restricts a build to the versions of these members.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.constants import LINEAGE, STOCK_ITEM_VALID_TO, VALID_FROM, VALID_TO
from starloom.functions import literal_like, wkt_point
from starloom.operators.dedup import dedup_by, keep_max_rows
from starloom.operators.hot import HOT_ROWS
from starloom.operators.incremental import as_of_load
from starloom.operators.keys import dimension_keys
from starloom.operators.sizes import bounded, bounded_ids, known_most, known_rows, spread, stage_counted, stage_history
from starloom.operators.temporal import (
    as_of_join,
    close_out,
    intersect_join,
    lookup_methods,
    overlap_join,
    version_at,
    version_timeline,
)
from starloom.sources.staging import stage


def _lineage(table: str):
    return F.lit(LINEAGE[table]).alias("LineageKey")


def _members(df: DataFrame, natural_id: str, only: DataFrame | None) -> DataFrame:
    if only is None:
        return df
    return df.join(only.select(F.col(only.columns[0]).alias(natural_id)), natural_id, "left_semi").select(*df.columns)


def _keyed(df: DataFrame, natural_id: str, key: str, offset: int | None, defaults: dict, also=()) -> DataFrame:
    """Number versions by start, then natural id, end and the columns in ``also``."""
    if offset is None:
        return df
    defaults = {natural_id: 0, "LineageKey": 0, **defaults}
    order = ["ValidFrom", natural_id, "ValidTo", *also]
    return dimension_keys(df, order, key, offset, defaults, VALID_FROM, VALID_TO)


def _unknown(first: str, *others: str) -> dict:
    return {first: "Unknown", **dict.fromkeys(others, "N/A")}


def city(
    cities: DataFrame,
    countries: DataFrame,
    state_provinces: DataFrame,
    to=None,
    offset: int | None = 0,
    strict_reference: bool = False,
    only: DataFrame | None = None,
) -> DataFrame:
    """A version wherever city, state and country versions coincide, for as long as they do."""
    states = as_of_load(state_provinces, to).withColumn("_state_from", F.col("ValidFrom"))
    nations = as_of_load(countries, to).withColumn("_country_from", F.col("ValidFrom"))
    staging = as_of_load(_members(cities, "CityID", only), to).withColumn("_city_from", F.col("ValidFrom"))
    methods = lookup_methods(
        {
            "state": (states, ["StateProvinceID"], ["StateProvinceName", "SalesTerritory"]),
            "country": (nations, ["CountryID"], ["CountryName", "Continent", "Region", "Subregion"]),
        }
    )
    staging = intersect_join(
        staging,
        states,
        "StateProvinceID",
        {
            "StateProvince": "StateProvinceName",
            "SalesTerritory": "SalesTerritory",
            "_country": "CountryID",
            "_state_from": "_state_from",
        },
        method=methods["state"],
    )
    staging = intersect_join(
        staging,
        nations,
        [("_country", "CountryID")],
        {
            "Country": "CountryName",
            "Continent": "Continent",
            "Region": "Region",
            "Subregion": "Subregion",
            "_country_from": "_country_from",
        },
        method=methods["country"],
    )
    staging = dedup_by(
        staging, ["CityID", "_city_from", "_state_from", "_country_from"], ["ValidFrom", "ValidTo", "LoadDatetime"]
    )
    longitude, latitude = wkt_point(F.col("Location"))
    staging = staging.select(
        F.col("CityID").alias("WWICityID"),
        F.col("CityName").alias("City"),
        "StateProvince",
        "Country",
        "Continent",
        "SalesTerritory",
        "Region",
        "Subregion",
        "Location",
        F.coalesce("LatestRecordedPopulation", F.lit(0)).alias("LatestRecordedPopulation"),
        "ValidFrom",
        "ValidTo",
        _lineage("city"),
        longitude.alias("Longitude"),
        latitude.alias("Latitude"),
    )
    staging = close_out(stage_counted(staging, "city-versions", True), "WWICityID", to, strict_reference=strict_reference)
    defaults = _unknown(
        "City", "StateProvince", "Country", "Continent", "SalesTerritory", "Region", "Subregion"
    ) | {"LatestRecordedPopulation": 0, "Longitude": 0.0, "Latitude": 0.0}
    return _keyed(staging, "WWICityID", "CityKey", offset, defaults)


_CUSTOMER_COLUMNS = {
    "WWICustomerID": "CustomerID",
    "Customer": "CustomerName",
    "PostalCode": "DeliveryPostalCode",
    "_bill_to": "BillToCustomerID",
    "_category": "CustomerCategoryID",
    "_group": "BuyingGroupID",
    "_contact": "PrimaryContactPersonID",
}


def _customer_base(customers: DataFrame) -> DataFrame:
    names = [F.col(source).alias(name) for name, source in _CUSTOMER_COLUMNS.items()]
    return customers.select(*names, "ValidFrom", "ValidTo", "LoadDatetime")


def _customer_feeds(customers, categories, groups, people, methods) -> DataFrame:
    """One row per change that starts a customer version, with the customer as it was then.

    ``_feed`` tells whose change it is; for the three side feeds ``_own`` holds
    the changed name.  A side change touches every customer that referred to it
    at that time.
    """
    base = _customer_base(customers)
    own = base.withColumns({"_feed": F.lit(0), "_own": F.lit(None).cast("string")})
    sides = [
        (1, "_category", categories, "CustomerCategoryID", "CustomerCategoryName"),
        (2, "_group", groups, "BuyingGroupID", "BuyingGroupName"),
        (3, "_contact", people.where("ValidFrom <> ValidTo"), "PersonID", "FullName"),
    ]
    feeds = own
    for number, ref, side, side_id, name in sides:
        changes = side.where(F.col("ValidFrom") != literal_like(side, "ValidFrom", VALID_FROM))
        touched = overlap_join(
            base.drop("LoadDatetime"),
            changes,
            [(ref, side_id)],
            {"_at": "ValidFrom", "_end": "ValidTo", "LoadDatetime": "LoadDatetime", "_own": name},
            right_valid=("ValidFrom", "ValidFrom"),
            method=methods[ref],
        ).where(F.col("_at") < F.col("ValidTo"))
        touched = touched.withColumns({"ValidFrom": F.col("_at"), "ValidTo": F.col("_end"), "_feed": F.lit(number)})
        feeds = feeds.unionByName(touched.drop("_at", "_end"))
    return feeds


def _mine(feed: int | None) -> Column:
    """Whether a row was started by a change of this feed's side."""
    return F.col("_feed") == F.lit(feed) if feed else F.lit(False)


def _found(role, buying_group_how: str) -> Column:
    feed, ref, *_ = role
    found = _mine(feed) | F.col(f"_found{ref}").isNotNull()
    return found | F.col(ref).isNull() if feed == 2 and buying_group_how == "left" else found


def _customer_joined(customers: DataFrame, roles, methods, buying_group_how: str) -> DataFrame:
    """The rows of ``_customer_feeds`` with what was in force at their start, one look-up per reference."""
    staging = _customer_feeds(customers, *[history for feed, _, history, *_ in roles if feed], methods)
    complete = F.lit(True)
    for role in roles:
        feed, ref, history, member_id, name, out = role
        take = {f"_found{ref}": member_id, out: name}
        staging = as_of_join(staging, history, [(ref, member_id)], "ValidFrom", take, "left", method=methods[ref])
        staging = staging.withColumn(out, F.when(_mine(feed), F.col("_own")).otherwise(F.col(out)))
        complete = complete & _found(role, buying_group_how)
    return staging.where(complete)


def _customer_packed(customers: DataFrame, roles, methods, buying_group_how: str) -> DataFrame:
    """The rows of ``_customer_feeds`` with what was in force at their start, where no id has many versions.

    A customer version carries the versions of what it refers to that may be in force or
    start while it lasts.  The rows that changes add are made from them, and looked up, where
    the version lies: each reference moves the customer's own versions once, not
    the rows of all feeds, and a small history none.
    """
    rows = _customer_base(customers)
    start, end, last = F.col("ValidFrom"), F.col("ValidTo"), F.greatest("ValidFrom", "ValidTo")
    own = F.struct("ValidFrom", "ValidTo", "LoadDatetime", F.lit(0).alias("_feed"), F.lit(None).cast("string").alias("_own"))
    feeds = [F.array(own)]
    for feed, ref, history, member_id, name, _ in roles:
        version = [F.col("ValidFrom").alias("_from"), F.col("ValidTo").alias("_to"), F.col(name).alias("_name")]
        version += [F.col("LoadDatetime").alias("_load")] if feed else []
        known = history.where(F.col(member_id).isNotNull()) if feed else history.where("ValidFrom < ValidTo")
        packed = known.groupBy(F.col(member_id).alias("_id")).agg(F.collect_list(F.struct(*version)).alias(f"_v{ref}"))
        if methods[ref].method == "broadcast":
            packed = F.broadcast(packed)
        # Without any version of what it refers to no row is complete.
        optional = feed == 2 and buying_group_how == "left"
        rows = rows.join(packed, F.col(ref) == F.col("_id"), "left" if optional else "inner").drop("_id")

        def starts(v):
            return (v["_from"] >= start) & (v["_from"] < end)

        held = F.filter(f"_v{ref}", lambda v: ((v["_to"] > start) & (v["_from"] <= last)) | starts(v))
        rows = rows.withColumn(f"_v{ref}", F.coalesce(held, F.array().cast(rows.schema[f"_v{ref}"].dataType)) if optional else held)
        if not feed:
            continue
        begin = literal_like(history, "ValidFrom", VALID_FROM)

        def counts(v):
            started = starts(v) & (v["_from"] != begin)
            return started & (v["_from"] != v["_to"]) if feed == 3 else started

        def change(v):
            columns = {"ValidFrom": "_from", "ValidTo": "_to", "LoadDatetime": "_load"}
            return F.struct(*[v[c].alias(n) for n, c in columns.items()], F.lit(feed).alias("_feed"), v["_name"].alias("_own"))

        feeds.append(F.transform(F.filter(f"_v{ref}", counts), change))
    carried = [f"_v{ref}" for _, ref, *_ in roles]
    rows = rows.select(*_CUSTOMER_COLUMNS, *carried, F.inline(F.concat(*feeds)))
    rows = rows.withColumns({v: version_at(F.col(v), F.col("ValidFrom"), "left") for v in carried})
    shown = [*_CUSTOMER_COLUMNS, "ValidFrom", "ValidTo", "LoadDatetime", "_feed", "_own"]
    for feed, ref, history, member_id, _, out in roles:
        hit, kind = F.col(f"_v{ref}"), history.schema[member_id].dataType
        name = F.when(_mine(feed), F.col("_own")).otherwise(hit["_name"])
        rows = rows.withColumns({f"_found{ref}": F.when(hit.isNotNull(), F.col(ref)).cast(kind), out: name})
        shown += [f"_found{ref}", out]
    return rows.where(reduce(lambda a, b: a & b, [_found(role, buying_group_how) for role in roles])).select(*shown)


def customer(
    customers: DataFrame,
    customer_categories: DataFrame,
    buying_groups: DataFrame,
    people: DataFrame,
    to=None,
    offset: int | None = 0,
    buying_group_how: str = "inner",
    strict_reference: bool = False,
    only: DataFrame | None = None,
) -> DataFrame:
    """Customer versions started by changes of the customer, its category, its group or its contact.

    The four feeds are united before the lookups, so each history is searched
    once.  A customer without a buying group has no version; with
    ``buying_group_how="left"`` it has, with a NULL group.  One version is kept
    per (customer, start): the customer's own change first, then category,
    group, contact.  ``strict_reference`` computes the ends before that dedup
    (equal starts then leave empty versions) and closes newest versions as
    ``close_out`` describes.
    """
    # Written once, narrow: the feeds and the look-up of bill-to customers read it five times.
    used = ["CustomerID", "CustomerName", "DeliveryPostalCode", "BillToCustomerID", "CustomerCategoryID", "BuyingGroupID"]
    used += ["PrimaryContactPersonID", "ValidFrom", "ValidTo", "LoadDatetime"]
    customers = stage_history(customers.select(*used), "customers", "CustomerID", keep_not_null=True)
    roles = [
        (None, "_bill_to", customers, "CustomerID", "CustomerName", "BillToCustomer"),
        (1, "_category", customer_categories, "CustomerCategoryID", "CustomerCategoryName", "Category"),
        (2, "_group", buying_groups, "BuyingGroupID", "BuyingGroupName", "BuyingGroup"),
        (3, "_contact", people, "PersonID", "FullName", "PrimaryContact"),
    ]
    methods = lookup_methods({ref: (history, [member_id], [name]) for _, ref, history, member_id, name, _ in roles})
    most = None
    if all(method.shallow for method in methods.values()):
        staging = _customer_packed(_members(customers, "CustomerID", only), roles, methods, buying_group_how)
        # A version of the customer's own meets each change of what it refers to once at most.
        most, sides = known_most(customers, "CustomerID"), [(ref, h, i) for feed, ref, h, i, *_ in roles if feed]
        if most is not None:
            most *= 1 + sum(max(methods[ref].most, known_most(h, i) or 0) for ref, h, i in sides)
    else:
        staging = _customer_joined(_members(customers, "CustomerID", only), roles, methods, buying_group_how)
    staging = staging.withColumn("_raw_to", F.col("ValidTo"))

    def ended(df):
        return version_timeline(df, "WWICustomerID", "ValidFrom")

    def single(df, *tie):
        return dedup_by(df, ["WWICustomerID", "ValidFrom"], ["_feed", F.col("LoadDatetime").desc(), *tie])

    if most is not None and most <= HOT_ROWS and not strict_reference:
        # No customer can be hot: rows of a customer are brought together once, narrow, for all windows below.
        tie = F.xxhash64(*[c for c in staging.columns if c not in ("WWICustomerID", "ValidFrom")])
        unused = ["_bill_to", "_category", "_group", "_contact", "_own", *[f"_found{ref}" for _, ref, *_ in roles], "_raw_to"]
        staging = spread(staging.withColumn("_tie", tie).drop(*unused), "WWICustomerID", known_rows(customers))
        staging = single(staging, "_tie").withColumn("_raw_to", F.col("ValidTo"))
        staging = ended(bounded_ids(staging, "WWICustomerID", most))
    # Written once: the windows below look for hot customers before they run.
    elif strict_reference:
        versions = ended(stage_counted(staging, "customer-versions"))
        staging = bounded(single(versions), known_rows(versions))
    else:
        staging = ended(stage_counted(single(staging), "customer-versions"))
    staging = bounded_ids(bounded(as_of_load(staging, to), known_rows(staging)), "WWICustomerID", most)
    staging = close_out(staging, "WWICustomerID", to, newest_to="_raw_to", strict_reference=strict_reference)
    staging = staging.select(
        "WWICustomerID",
        "Customer",
        "BillToCustomer",
        "Category",
        "BuyingGroup",
        "PrimaryContact",
        "PostalCode",
        "ValidFrom",
        "ValidTo",
        _lineage("customer"),
    )
    defaults = _unknown("Customer", "BillToCustomer", "Category", "BuyingGroup", "PrimaryContact", "PostalCode")
    return _keyed(staging, "WWICustomerID", "CustomerKey", offset, defaults)


def employee(people: DataFrame, to=None, offset: int | None = 0, only: DataFrame | None = None) -> DataFrame:
    """Versions of the people that are employees; no unknown member without any employee."""
    staff = as_of_load(_members(people, "PersonID", only), to).where("IsEmployee AND ValidFrom <> ValidTo")
    staff = dedup_by(staff, ["PersonID", "ValidFrom"], [F.col("ValidTo").desc()])
    open_end = literal_like(people, "ValidTo", VALID_TO)
    ends = open_end if to is None else F.when(
        F.col("ValidTo") < literal_like(people, "ValidTo", to), F.col("ValidTo")
    ).otherwise(open_end)
    staff = staff.select(
        F.col("PersonID").alias("WWIEmployeeID"),
        F.col("FullName").alias("Employee"),
        "PreferredName",
        "IsSalesperson",
        "Photo",
        "ValidFrom",
        ends.alias("ValidTo"),
        _lineage("employee"),
    )
    defaults = _unknown("Employee", "PreferredName") | {"IsSalesperson": False}
    keyed = _keyed(staff, "WWIEmployeeID", "EmployeeKey", offset, defaults)
    if offset is None or offset:
        return keyed
    known = keyed.where("EmployeeKey > 0")
    return known if known.isEmpty() else keyed


def last_stock_groups(stock_groups: DataFrame, stock_item_stock_groups: DataFrame) -> DataFrame:
    """Group versions of each item, of the last link made at each edit time."""
    links = keep_max_rows(
        stock_groups.drop("LastEditedBy", "LoadDatetime").join(
            stock_item_stock_groups.drop("LoadDatetime"), "StockGroupID", "inner"
        ),
        ["StockItemID", "LastEditedWhen"],
        "StockItemStockGroupID",
    )
    return links


def stock_item(
    colors: DataFrame,
    stock_groups: DataFrame,
    stock_items: DataFrame,
    stock_item_stock_groups: DataFrame,
    package_types: DataFrame,
    to=None,
    offset: int | None = 0,
    end_of_time=STOCK_ITEM_VALID_TO,
    strict_reference: bool = False,
    only: DataFrame | None = None,
) -> DataFrame:
    """Item versions with colour and package names as of their start.

    No group attribute is part of the dimension.  ``strict_reference`` still
    joins the item's last groups, which repeats a version per group in force.
    """
    staging = _members(stock_items, "StockItemID", only)
    methods = lookup_methods(
        {
            "package": (package_types, ["PackageTypeID"], ["PackageTypeName"]),
            "color": (colors, ["ColorID"], ["ColorName"]),
        }
    )
    for ref, out in (("UnitPackageID", "SellingPackage"), ("OuterPackageID", "BuyingPackage")):
        staging = as_of_join(
            staging,
            package_types,
            [(ref, "PackageTypeID")],
            "ValidFrom",
            {out: "PackageTypeName"},
            "inner",
            method=methods["package"],
        )
    staging = as_of_join(
        staging, colors, "ColorID", "ValidFrom", {"Color": "ColorName"}, "left", method=methods["color"]
    )
    if strict_reference:
        groups = last_stock_groups(as_of_load(stock_groups, to), stock_item_stock_groups)
        staging = as_of_join(
            staging, groups, "StockItemID", "ValidFrom", {"_group": "StockGroupName"}, "left", matches="all"
        )
    staging = as_of_load(staging, to)

    def text(name):
        return F.coalesce(F.col(name), F.lit("N/A")).alias(name)

    staging = staging.select(
        F.col("StockItemID").alias("WWIStockItemID"),
        F.col("StockItemName").alias("StockItem"),
        text("Color"),
        "SellingPackage",
        "BuyingPackage",
        text("Brand"),
        text("Size"),
        "LeadTimeDays",
        "QuantityPerOuter",
        "IsChillerStock",
        text("Barcode"),
        F.col("TaxRate").cast("decimal(18,3)").alias("TaxRate"),
        F.col("UnitPrice").cast("decimal(18,2)").alias("UnitPrice"),
        F.col("RecommendedRetailPrice").cast("decimal(18,2)").alias("RecommendedRetailPrice"),
        F.col("TypicalWeightPerUnit").cast("decimal(18,3)").alias("TypicalWeightPerUnit"),
        "Photo",
        "ValidFrom",
    )
    staging = stage_counted(staging, "stock-item-versions", True)
    staging = version_timeline(staging, "WWIStockItemID", "ValidFrom", default_end=end_of_time)
    staging = staging.withColumn("LineageKey", _lineage("stock_item"))
    defaults = _unknown("StockItem", "Color", "SellingPackage", "BuyingPackage", "Brand", "Size", "Barcode") | {
        "LeadTimeDays": 0,
        "QuantityPerOuter": 0,
        "IsChillerStock": False,
        "TaxRate": 0,
        "UnitPrice": 0,
        "RecommendedRetailPrice": 0,
        "TypicalWeightPerUnit": 0,
    }
    return _keyed(staging, "WWIStockItemID", "StockItemKey", offset, defaults)


def supplier(
    suppliers: DataFrame,
    supplier_categories: DataFrame,
    people: DataFrame,
    to=None,
    offset: int | None = 0,
    only: DataFrame | None = None,
) -> DataFrame:
    """Supplier versions with every category and contact version they overlap."""
    categories, contacts = as_of_load(supplier_categories, to), as_of_load(people, to)
    methods = lookup_methods(
        {
            "category": (categories, ["SupplierCategoryID"], ["SupplierCategoryName"]),
            "contact": (contacts, ["PersonID"], ["FullName"]),
        }
    )
    staging = overlap_join(
        as_of_load(_members(suppliers, "SupplierID", only), to),
        categories,
        "SupplierCategoryID",
        {"Category": "SupplierCategoryName"},
        method=methods["category"],
    )
    staging = overlap_join(
        staging,
        contacts,
        [("PrimaryContactPersonID", "PersonID")],
        {"PrimaryContact": "FullName"},
        method=methods["contact"],
    )
    staging = staging.select(
        F.col("SupplierID").alias("WWISupplierID"),
        F.col("SupplierName").alias("Supplier"),
        "Category",
        "PrimaryContact",
        "SupplierReference",
        "PaymentDays",
        F.col("DeliveryPostalCode").alias("PostalCode"),
        "ValidFrom",
        "ValidTo",
        _lineage("supplier"),
    ).distinct()
    defaults = _unknown("Supplier", "Category", "PrimaryContact", "SupplierReference", "PostalCode")
    defaults |= {"PaymentDays": 0}
    return _keyed(staging, "WWISupplierID", "SupplierKey", offset, defaults, ["Category", "PrimaryContact"])


def payment_method(
    payment_methods: DataFrame, to=None, offset: int | None = 0, only: DataFrame | None = None
) -> DataFrame:
    staging = as_of_load(_members(payment_methods, "PaymentMethodID", only), to).select(
        F.col("PaymentMethodID").alias("WWIPaymentMethodID"),
        F.col("PaymentMethodName").alias("PaymentMethod"),
        "ValidFrom",
        "ValidTo",
        _lineage("payment_method"),
    )
    return _keyed(staging, "WWIPaymentMethodID", "PaymentMethodKey", offset, _unknown("PaymentMethod"))


def transaction_type(
    transaction_types: DataFrame, to=None, offset: int | None = 0, only: DataFrame | None = None
) -> DataFrame:
    staging = as_of_load(_members(transaction_types, "TransactionTypeID", only), to)
    staging = dedup_by(staging, ["TransactionTypeID", "ValidFrom"], [F.col("ValidTo").desc()]).select(
        F.col("TransactionTypeID").alias("WWITransactionTypeID"),
        F.col("TransactionTypeName").alias("TransactionType"),
        "ValidFrom",
        "ValidTo",
        _lineage("transaction_type"),
    )
    return _keyed(staging, "WWITransactionTypeID", "TransactionTypeKey", offset, _unknown("TransactionType"))
