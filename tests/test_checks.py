"""Comparison of tables by narrow digests, and tables that are not written twice."""

import uuid

from pyspark.sql import functions as F

from starloom.operators.checks import star_diff, tables_equal
from starloom.sources.staging import stage, written


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_counts_of_differences_move_no_whole_rows(spark):
    rows = [(1, "x", None), (1, None, "x"), (2, "x", "y"), (2, "x", "y"), (None, None, None)]
    table = spark.createDataFrame(rows, "a int, b string, c string")
    moved = spark.createDataFrame([(1, "x", None), (1, "x", None), *rows[2:]], "a int, b string, c string")
    diff = star_diff({"t": moved, "same": table}, {"t": table, "same": table, "lost": table})
    got = sorted((r.target, r.only_in, r.n_rows) for r in diff.collect())
    assert got == [("lost", "expected", 5), ("t", "actual", 1), ("t", "expected", 1)]
    assert tables_equal(table, table) and not tables_equal(table, moved) and not tables_equal(table, table.dropDuplicates())
    assert "Aggregate [_h1" in _plan(star_diff({"t": moved}, {"t": table}))
    nested = table.select(F.array("b", "c").alias("v"))
    assert not tables_equal(nested.limit(1), nested.where("false")) and tables_equal(nested, nested)
    assert not tables_equal(table.where("a = 1 AND b IS NULL").select(F.array("b", "c").alias("v")), table.where("a = 1 AND c IS NULL").select(F.array("b", "c").alias("v")))


def test_a_written_table_is_not_written_again(spark):
    staged = stage(spark.range(3), f"once-{uuid.uuid4().hex}")
    assert written(staged, "again") is staged
    other = written(staged.where("id > 0"), "again")
    assert other.count() == 2 and written(other, "again") is other
