"""Dimensions after several loads equal those built at once, and keep what no load touched."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from starloom.constants import TARGETS
from starloom.plans import dimensions, increments
from starloom.plans.star import DIMENSION_INPUTS, MEMBERS
from starloom.sources import sinks
from starloom.sources.tables import read_table

START, OPEN = dt.datetime(2015, 1, 1), dt.datetime(2038, 1, 19, 3, 14, 7, 999999)
LOADS = [dt.datetime(2016, 1, 1), dt.datetime(2017, 1, 1), dt.datetime(2018, 1, 1)]
SCHEMAS = {
    "application_cities": "CityID int, CityName string, StateProvinceID int, Location string, LatestRecordedPopulation bigint",
    "application_stateprovinces": "StateProvinceID int, StateProvinceName string, CountryID int, SalesTerritory string",
    "application_countries": "CountryID int, CountryName string, Continent string, Region string, Subregion string",
    "application_people": "PersonID int, FullName string, PreferredName string, IsEmployee boolean, IsSalesperson boolean, Photo string",
    "sales_customers": "CustomerID int, CustomerName string, BillToCustomerID int, CustomerCategoryID int, BuyingGroupID int, "
    "PrimaryContactPersonID int, DeliveryPostalCode string",
    "sales_customercategories": "CustomerCategoryID int, CustomerCategoryName string",
    "sales_buyinggroups": "BuyingGroupID int, BuyingGroupName string",
    "purchasing_suppliers": "SupplierID int, SupplierName string, SupplierCategoryID int, PrimaryContactPersonID int, "
    "SupplierReference string, PaymentDays int, DeliveryPostalCode string",
    "purchasing_suppliercategories": "SupplierCategoryID int, SupplierCategoryName string",
}


def histories():
    """Versions of every source: (values, from, to), without gaps, a few of them after the first load."""
    rng = random.Random(7)

    def spans(often):
        cuts = sorted({START, *(START + dt.timedelta(days=rng.randrange(1, 1_300)) for _ in range(rng.choice([0, 0, 1]) if often else 0))})
        ends = [*cuts[1:], OPEN if rng.random() < 0.8 or not often else START + dt.timedelta(days=1_400 - rng.randrange(600))]
        return [(a, b) for a, b in zip(cuts, ends) if a < b]

    def table(ids, values, often=True):
        return [((i, *values(i, n)), a, b) for i in ids for n, (a, b) in enumerate(spans(often))]

    return {
        "application_cities": table(range(1, 40), lambda i, n: (f"city {i} {n}", 1 + i % 9, f"POINT ({i} {n})", i * n)),
        "application_stateprovinces": table(range(1, 10), lambda i, n: (f"state {i} {n}", 1 + i % 3, f"area {n}")),
        "application_countries": table(range(1, 4), lambda i, n: (f"country {i} {n}", "c", "r", "s")),
        "application_people": table(range(1, 12), lambda i, n: (f"person {i} {n}", f"p{n}", i % 2 == 0, True, None)),
        "sales_customers": table(range(1, 60), lambda i, n: (f"customer {i} {n}", 1 + i % 7, 1 + i % 5, 1 + i % 4, 1 + i % 11, f"{i}")),
        "sales_customercategories": table(range(1, 6), lambda i, n: (f"category {i} {n}",)),
        "sales_buyinggroups": table(range(1, 5), lambda i, n: (f"group {i} {n}",), often=False),
        "purchasing_suppliers": table(range(1, 30), lambda i, n: (f"supplier {i} {n}", 1 + i % 4, 1 + i % 11, "r", n, f"{i}")),
        "purchasing_suppliercategories": table(range(1, 5), lambda i, n: (f"kind {i} {n}",)),
    }


def raw(spark, t):
    """The sources as loaded by ``t``: later versions are unknown, an end after ``t`` too; the stamp is that of the first load."""
    out = {}
    for name, rows in histories().items():
        known = [(*values, a, b if b <= t else OPEN, min(x for x in LOADS if x >= a)) for values, a, b in rows if a <= t]
        out[name] = spark.createDataFrame(known, f"{SCHEMAS[name]}, ValidFrom timestamp, ValidTo timestamp, LoadDatetime timestamp")
    return out


@pytest.mark.parametrize("name", ["customer", "city", "supplier", "employee"])
def test_loads_one_by_one_equal_one_load(spark, tmp_path, name):
    schema = f"inc_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema}")
    target, key, _ = TARGETS[name]
    table, member = f"{schema}.{target}", MEMBERS[name]
    same = [member, "ValidFrom", *increments.ALSO.get(name, [])]
    before, moved = {}, 0
    for n, t in enumerate(LOADS):
        sources = raw(spark, t)
        files = set(spark.read.table(table).inputFiles()) if n else set()
        increments.update_dimension(spark, name, sources, schema, t, root=str(tmp_path), buckets=32)
        saved = read_table(spark, table)
        rows = [r.asDict() for r in saved.collect()]
        whole = getattr(dimensions, name)(*[sources[s] for s in DIMENSION_INPUTS[name]], to=t).collect()
        content = lambda r: tuple(sorted((k, str(v)) for k, v in r.items() if k != key))
        assert sorted(map(content, rows)) == sorted(content(r.asDict()) for r in whole)
        keys = {tuple(r[c] for c in same): r[key] for r in rows}
        assert len(set(keys.values())) == len(keys) == len(rows)
        assert all(keys[version] == k for version, k in before.items() if version in keys)
        new = sorted(k for version, k in keys.items() if version not in before)
        if n and new:
            assert new == list(range(max(before.values()) + 1, max(before.values()) + 1 + len(new)))
        if n:
            touched = {r.id for r in increments.touched_members(name, sources, LOADS[n - 1], t).collect()}
            moved += len(touched)
            # files without a touched member are the same as before
            after = {r.file: set(r.ids) for r in spark.read.table(table).groupBy(F.input_file_name().alias("file")).agg(F.collect_set(member).alias("ids")).collect()}
            assert all(f in files for f, ids in after.items() if not ids & touched and len(touched) < 8)
        before = keys
    assert moved and sinks.table_property(spark, table, increments.LOADED) == str(LOADS[-1])


def test_a_corrected_past_takes_versions_away(spark, tmp_path):
    schema = f"inc_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema}")
    kind = "PaymentMethodID int, PaymentMethodName string, ValidFrom timestamp, ValidTo timestamp, LoadDatetime timestamp"
    a, b = dt.datetime(2015, 5, 5), dt.datetime(2016, 6, 6)
    first = spark.createDataFrame([(1, "Cash", START, a, LOADS[0]), (1, "Notes", a, OPEN, LOADS[0]), (2, "Card", START, OPEN, LOADS[0])], kind)
    second = spark.createDataFrame([(1, "Cash", START, b, LOADS[1]), (1, "Coins", b, OPEN, LOADS[1]), (2, "Card", START, OPEN, LOADS[0])], kind)
    for t, rows in zip(LOADS, (first, second, second)):
        increments.update_dimension(spark, "payment_method", {"application_paymentmethods": rows}, schema, t, root=str(tmp_path))
    saved = read_table(spark, f"{schema}.dimension_paymentmethod").collect()
    assert {(r.WWIPaymentMethodID, r.PaymentMethod): r.PaymentMethodKey for r in saved} == {
        (0, "Unknown"): 0, (1, "Cash"): 1, (2, "Card"): 2, (1, "Coins"): 4,
    }


def test_a_dimension_without_members_starts_again(spark, tmp_path):
    schema = f"inc_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema}")
    sources = raw(spark, LOADS[0])
    nobody = {"application_people": sources["application_people"].where("NOT IsEmployee")}
    tables = increments.update_dimensions(spark, nobody, schema, LOADS[0], names=["employee"], root=str(tmp_path))
    assert tables["employee"].count() == 0
    tables = increments.update_dimensions(spark, sources, schema, LOADS[0], names=["employee"], root=str(tmp_path))
    assert tables["employee"].where("EmployeeKey = 0").count() == 1 and tables["employee"].count() > 1


@pytest.mark.parametrize("buckets", [None, 4])
def test_replacing_keys(spark, tmp_path, buckets):
    name = f"t_{uuid.uuid4().hex}"
    rows = lambda *r: spark.createDataFrame(list(r), "id int, v string")
    sinks.merge_into(spark, name, rows((1, "a"), (1, "b"), (2, "c"), (3, "d")), "id", root=str(tmp_path), buckets=buckets, replaced=rows())
    sinks.merge_into(spark, name, rows((1, "x"), (4, "new"), (4, "newer")), "id", root=str(tmp_path), replaced=rows((1, ""), (3, "")), mark={"starloom.loaded": "2"})
    got = sorted(tuple(r) for r in read_table(spark, name).collect())
    assert got == [(1, "x"), (2, "c"), (4, "new"), (4, "newer")]
    assert sinks.table_property(spark, name, "starloom.loaded") == "2"
