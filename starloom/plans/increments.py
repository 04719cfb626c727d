"""Dimensions brought up to date by the members a load touches.

A load changes few members.  Those whose own rows or whose referred-to rows were
loaded, or ended, since the last one are found by following the references;
only their versions are built anew and put in the place of the old ones.  All
others keep their rows, their keys and, in a table kept in buckets, mostly their
files.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.constants import DIMENSIONS, TARGETS
from starloom.functions import literal_like
from starloom.operators.incremental import between, key_offset
from starloom.operators.keys import number_rows
from starloom.plans import dimensions
from starloom.plans.star import DIMENSION_INPUTS, MEMBERS
from starloom.sources.sinks import merge_into, table_property
from starloom.sources.staging import stage
from starloom.sources.tables import read_table

LOADED = "starloom.loaded"  # load time up to which a dimension is built
DIMENSION_BUCKETS = 16


class Reference(NamedTuple):
    """A column that names a row of another source."""

    column: str
    source: str
    id: str
    references: tuple = ()


_PERSON = "application_people"
# The source each dimension has its members from, their id there, and what they refer to.
SOURCES: dict[str, tuple[str, str, tuple[Reference, ...]]] = {
    "city": (
        "application_cities",
        "CityID",
        (
            Reference(
                "StateProvinceID",
                "application_stateprovinces",
                "StateProvinceID",
                (Reference("CountryID", "application_countries", "CountryID"),),
            ),
        ),
    ),
    "employee": (_PERSON, "PersonID", ()),
    "customer": (
        "sales_customers",
        "CustomerID",
        (
            Reference("BillToCustomerID", "sales_customers", "CustomerID"),
            Reference("CustomerCategoryID", "sales_customercategories", "CustomerCategoryID"),
            Reference("BuyingGroupID", "sales_buyinggroups", "BuyingGroupID"),
            Reference("PrimaryContactPersonID", _PERSON, "PersonID"),
        ),
    ),
    "stock_item": (
        "warehouse_stockitems",
        "StockItemID",
        (
            Reference("ColorID", "warehouse_colors", "ColorID"),
            Reference("UnitPackageID", "warehouse_packagetypes", "PackageTypeID"),
            Reference("OuterPackageID", "warehouse_packagetypes", "PackageTypeID"),
        ),
    ),
    "transaction_type": ("application_transactiontypes", "TransactionTypeID", ()),
    "supplier": (
        "purchasing_suppliers",
        "SupplierID",
        (
            Reference("SupplierCategoryID", "purchasing_suppliercategories", "SupplierCategoryID"),
            Reference("PrimaryContactPersonID", _PERSON, "PersonID"),
        ),
    ),
    "payment_method": ("application_paymentmethods", "PaymentMethodID", ()),
}
# What tells versions of a member apart besides their start.
ALSO = {"supplier": ["Category", "PrimaryContact"]}


def _changed(source: DataFrame, since, to) -> DataFrame:
    """Rows loaded after ``since``, and versions that ended between the loads: these were still open at the last one."""
    changed = between(source, "LoadDatetime", since, to)
    if "ValidTo" in source.columns:
        low, high = (literal_like(source, "ValidTo", t) for t in (since, to))
        changed = changed | F.col("ValidTo").between(low, high)
    return source.where(changed)


def _touched(sources: dict[str, DataFrame], source: str, member: str, references, since, to) -> DataFrame:
    rows = sources[source]
    parts = [_changed(rows, since, to).select(F.col(member).alias("id"))]
    for r in references:
        other = _touched(sources, r.source, r.id, r.references, since, to).withColumnRenamed("id", r.column)
        parts.append(rows.select(F.col(member).alias("id"), r.column).join(other, r.column, "left_semi").select("id"))
    return reduce(lambda a, b: a.unionAll(b), parts).where("id IS NOT NULL").distinct()


def touched_members(name: str, sources: dict[str, DataFrame], since, to) -> DataFrame:
    """``id`` of the members of a dimension whose versions a load in ``(since, to]`` may have changed.

    A member is touched by a change of its own rows and by one of any row that
    one of its versions refers to, directly or through another source.  Each
    reference is a semi-join on narrow columns.
    """
    source, member, references = SOURCES[name]
    return _touched(sources, source, member, references, since, to)


def changed_versions(
    name: str, sources: dict[str, DataFrame], saved: DataFrame, touched: DataFrame, to, **options
) -> DataFrame:
    """All versions of the ``touched`` members as of ``to``, with keys.

    A version that ``saved`` has, by member, start and ``ALSO``, keeps its key; the
    others are numbered from the largest key on.
    """
    _, key, _ = TARGETS[name]
    member = MEMBERS[name]
    build = getattr(dimensions, name)
    rows = build(*[sources[s] for s in DIMENSION_INPUTS[name]], to=to, offset=None, only=touched, **options)
    same = [member, "ValidFrom", *ALSO.get(name, [])]
    # Should sources overlap, equal versions can repeat: the first of them is the known one.
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("ValidTo", F.xxhash64(*rows.columns)))
    rows = stage(rows.withColumn("_nth", nth), f"{name}-versions")
    known = saved.join(touched.withColumnRenamed("id", member), member, "left_semi").groupBy(*same).agg(F.min(key).alias(key))
    known = known.select(*[F.col(c).alias(f"_old_{c}") for c in same], key)
    matches = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in same]) & (F.col("_nth") == 1)
    joined = stage(rows.join(known, matches, "left").select(*rows.columns, key), f"{name}-keyed").drop("_nth")
    order = ["ValidFrom", member, "ValidTo", *ALSO.get(name, [])]
    new = number_rows(joined.where(F.col(key).isNull()).drop(key), order, key, key_offset(saved, key))
    return joined.where(F.col(key).isNotNull()).unionByName(new).select(*saved.columns)


def update_dimension(
    spark: SparkSession,
    name: str,
    sources: dict[str, DataFrame],
    target_schema: str,
    to,
    root: str | None = None,
    buckets: int = DIMENSION_BUCKETS,
    **options,
) -> None:
    """Bring a saved dimension up to ``to``; one that is missing is built whole and kept in ``buckets`` by member.

    The table remembers the load time it was built up to, and a load reads from
    there on.  Versions that no longer exist, because a source was corrected in
    its past, go; a fact that has their key finds no member then.  A load that
    broke off is repeated from the same mark.
    """
    target, key, _ = TARGETS[name]
    table, member, mark = f"{target_schema}.{target}", MEMBERS[name], {LOADED: str(to)}
    exists = spark.catalog.tableExists(table)
    if not exists or read_table(spark, table).isEmpty():
        build = getattr(dimensions, name)
        whole = stage(build(*[sources[s] for s in DIMENSION_INPUTS[name]], to=to, **options), f"dimension-{name}")
        made = {} if exists else {"buckets": buckets}
        merge_into(spark, table, whole, [member], root=root, replaced=whole.select(member), mark=mark, **made)
        return
    since = table_property(spark, table, LOADED)
    if since is None:
        raise ValueError(f"{table} does not say up to when it was loaded")
    saved = read_table(spark, table)
    touched = stage(touched_members(name, sources, since, to), f"{name}-touched")
    rows = stage(changed_versions(name, sources, saved, touched, to, **options), f"{name}-changed")
    replaced = touched.withColumnRenamed("id", member)
    merge_into(spark, table, rows, [member], root=root, replaced=replaced, mark=mark)


def update_dimensions(
    spark: SparkSession, sources: dict[str, DataFrame], target_schema: str, to, names=DIMENSIONS, **options
) -> dict[str, DataFrame]:
    """``update_dimension`` for each dimension; the saved tables, as ``build_facts`` takes them."""
    for name in names:
        update_dimension(spark, name, sources, target_schema, to, **options)
    return {name: read_table(spark, f"{target_schema}.{TARGETS[name][0]}") for name in names}
