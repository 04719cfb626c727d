"""Data checks, each a DataFrame or a boolean computed on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import as_names
from starloom.sources.staging import no_shuffle_left


def _signed(actual: DataFrame, expected: DataFrame) -> DataFrame:
    return actual.withColumn("_n", F.lit(1)).unionByName(expected.withColumn("_n", F.lit(-1)))


def _side():
    return F.when(F.col("_net") > 0, "actual").otherwise("expected").alias("only_in")


def table_diff(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows in which two tables differ as bags, with the number of surplus copies on either side.

    One aggregation over the union of both, so no row is compared with another.
    """
    columns = actual.columns
    net = _signed(actual, expected).groupBy(*columns).agg(F.sum("_n").alias("_net")).where("_net <> 0")
    return net.select(_side(), F.abs("_net").alias("copies"), *columns)


def _diff_counts(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """``only_in`` and ``copies`` of ``table_diff``, without the rows.

    Rows are told apart by 128 bits of two hashes, which also cover which columns are NULL, so
    that many times less is moved than whole rows.  Nested columns, of which a hash does not say where they are NULL,
    are compared whole.
    """
    columns, signed = actual.columns, _signed(actual, expected)
    nested = any(isinstance(signed.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for c in columns)
    if nested:
        return table_diff(actual, expected).select("only_in", "copies")
    values = [F.col(c) for c in columns] + [F.col(c).isNull() for c in columns]
    one, two = F.xxhash64(*values).alias("_h1"), F.xxhash64(F.lit(1), *values).alias("_h2")
    net = signed.select(one, two, "_n").groupBy("_h1", "_h2").agg(F.sum("_n").alias("_net")).where("_net <> 0")
    return net.select(_side(), F.abs("_net").alias("copies"))


def tables_equal(actual: DataFrame, expected: DataFrame) -> bool:
    if set(actual.columns) != set(expected.columns):
        return False
    with no_shuffle_left(actual.sparkSession):
        return _diff_counts(actual, expected).isEmpty()


class StarMismatch(Exception):
    """A target table is not what was expected."""


def star_equal(actual: dict[str, DataFrame], expected: dict[str, DataFrame]) -> bool:
    """Compare all tables of a star; the first differing one is named in the error."""
    for name, table in expected.items():
        if name not in actual or not tables_equal(actual[name], table):
            raise StarMismatch(name)
    return True


def star_diff(actual: dict[str, DataFrame], expected: dict[str, DataFrame]) -> DataFrame:
    """Per differing table of a star and side, the number of surplus rows; a missing table counts as empty."""
    out = None
    for name, table in expected.items():
        diff = _diff_counts(actual.get(name, table.limit(0)), table)
        one = diff.groupBy("only_in").agg(F.sum("copies").alias("n_rows"))
        one = one.select(F.lit(name).alias("target"), "only_in", "n_rows")
        out = one if out is None else out.unionAll(one)
    return out


def key_range(df: DataFrame, key: str) -> DataFrame:
    """One row: first key, last key, rows, distinct keys, and whether they are gap-free."""
    # Counting per key first keeps the distinct count exact with map-side combining.
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    summary = per_key.agg(
        F.min(key).alias("first_key"),
        F.max(key).alias("last_key"),
        F.sum("_n").alias("n_rows"),
        F.count(key).alias("n_keys"),
    )
    dense = (F.col("n_rows") == F.col("n_keys")) & (F.col("last_key") - F.col("first_key") + 1 == F.col("n_rows"))
    return summary.withColumn("contiguous", dense)


def keys_contiguous(df: DataFrame, key: str, first: int = 0) -> bool:
    row = key_range(df, key).first()
    return row.n_rows is None or bool(row.contiguous and row.first_key == first)


def ambiguous_names(df: DataFrame, id_col: str, names) -> DataFrame:
    """Names that more than one id bears."""
    names = as_names(names)
    return df.select(*names, id_col).distinct().groupBy(*names).agg(F.count(id_col).alias("n_ids")).where("n_ids > 1")


def name_identifies_id(df: DataFrame, id_col: str, names) -> bool:
    return ambiguous_names(df, id_col, names).isEmpty()


def invalid_intervals(df: DataFrame, valid_from: str = "ValidFrom", valid_to: str = "ValidTo") -> DataFrame:
    return df.where(F.col(valid_to) <= F.col(valid_from))


def intervals_valid(df: DataFrame, valid_from: str = "ValidFrom", valid_to: str = "ValidTo") -> bool:
    return invalid_intervals(df, valid_from, valid_to).isEmpty()
