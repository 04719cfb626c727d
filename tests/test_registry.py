import duckdb
import pytest

import __spark_entry__ as entry

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
FOLDER = "/root/testdata/sf0.001"


def test_every_oracle_belongs_to_a_query_and_plans():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    assert set(entry.oracle_sql()) <= set(entry.queries())
    for name, text in entry.oracle_sql().items():
        con.execute(f"EXPLAIN {text}")


@pytest.mark.parametrize("name", ["surrogate_keys", "as_of_left", "merge_facts", "cdc_latest"])
def test_queries_run(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    expected = sorted(tuple(str(v) for v in r) for r in cursor.fetchall())
    assert sorted(tuple(str(r[c]) for c in columns) for r in df.collect()) == expected
