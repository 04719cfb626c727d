import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators.hot import find_hot, with_slices
from starloom.operators.temporal import (
    as_of_join,
    close_out,
    intersect_join,
    lookup_methods,
    overlap_join,
    pit_lookup,
    running_min,
    version_timeline,
)

T0 = dt.datetime(2020, 1, 1)
SCHEMA = "id int, ValidFrom timestamp, ValidTo timestamp, v int"


def day(n):
    return None if n is None else T0 + dt.timedelta(days=n)


def versions(spark, rows):
    return spark.createDataFrame([(i, day(a), day(b), v) for i, a, b, v in rows], SCHEMA)


def random_history(rng, ids, span=60):
    rows, v = [], 0
    for i in ids:
        cuts = sorted(rng.sample(range(span), rng.randint(2, 12)))
        for a, b in zip(cuts, cuts[1:]):
            v += 1
            if rng.random() < 0.8:  # leave gaps
                rows.append((i, a, b, v))
            if rng.random() < 0.2:  # versions of no length must never be found
                rows.append((i, a, a, -v))
    return rows


@pytest.mark.parametrize("hot_rows", [1_000_000, 3])
def test_timeline_closes_at_next_version(spark, hot_rows):
    rng = random.Random(1)
    rows = [(i, d) for i in range(6) for d in sorted(rng.sample(range(400), 12 if i else 40))]
    events = spark.createDataFrame([(i, day(d)) for i, d in rows], "id int, at timestamp")
    out = version_timeline(events, "id", "at", default_end="2099-01-01 00:00:00", hot_rows=hot_rows)
    got = sorted((r.id, r.at, r.ValidTo) for r in out.collect())
    expected = []
    for i in range(6):
        days = [day(d) for j, d in rows if j == i]
        expected += [(i, a, b) for a, b in zip(days, days[1:] + [dt.datetime(2099, 1, 1)])]
    assert got == sorted(expected)


def test_timeline_default_end_is_null(spark):
    out = version_timeline(versions(spark, [(1, 0, 1, 1)]), "id", "ValidFrom").collect()
    assert out[0].ValidTo is None


def test_timeline_with_null_start(spark):
    events = spark.createDataFrame([(1, None), (1, day(3)), (1, day(5))], "id int, at timestamp")
    for hot in (100, 1):
        got = {r.at: r.ValidTo for r in version_timeline(events, "id", "at", hot_rows=hot).collect()}
        assert got == {None: day(3), day(3): day(5), day(5): None}


@pytest.mark.parametrize("hot_rows", [1_000_000, 1])
def test_close_out(spark, hot_rows):
    df = versions(spark, [(1, 0, 5, 1), (1, 5, 50, 2), (2, 0, 7, 3), (3, 0, 10, 4)])
    to, end = str(day(10)), "2038-01-19 03:14:07.999999"
    far = dt.datetime.fromisoformat(end)
    got = {r.v: r.ValidTo for r in close_out(df, "id", to, end, hot_rows=hot_rows).collect()}
    assert got == {1: day(5), 2: far, 3: day(7), 4: day(10)}
    strict = {r.v: r.ValidTo for r in close_out(df, "id", to, end, strict_reference=True).collect()}
    assert strict == {1: day(5), 2: far, 3: day(7), 4: None}
    open_ended = {r.v: r.ValidTo for r in close_out(df, "id", None, end).collect()}
    assert open_ended == {1: day(5), 2: far, 3: far, 4: far}
    assert {r.v for r in close_out(df, "id", None, end, strict_reference=True).collect() if r.ValidTo is None} == {2, 3, 4}


@pytest.mark.parametrize("closed", ["left", "right"])
@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("method,hot_rows", [("auto", 9), ("join", 9), ("merge", 1_000_000), ("merge", 5)])
def test_as_of_join_against_brute_force(spark, closed, how, method, hot_rows):
    rng = random.Random(7)
    history = random_history(rng, range(8))
    # id 0 is asked for most often, often at one instant; ids 8 and 9 have no history
    asks = [(n, rng.choice([0, 0, 0, rng.randint(0, 9)]), rng.choice([30, rng.randint(-2, 62)])) for n in range(300)]
    asks += [(900, None, 5), (901, 1, None)]
    left = spark.createDataFrame([(n, i, day(d)) for n, i, d in asks], "n int, who int, at timestamp")
    out = as_of_join(
        left, versions(spark, history), [("who", "id")], "at", {"found": "v"}, how, closed,
        method=method, hot_rows=hot_rows,
    )
    assert out.columns == ["n", "who", "at", "found"]

    def match(i, d):
        if i is None or d is None:
            return []
        return [v for j, a, b, v in history if j == i and (a <= d < b if closed == "left" else a < d <= b)]

    expected = []
    for n, i, d in asks:
        hits = match(i, d)
        assert len(hits) <= 1
        if hits or how == "left":
            expected.append((n, hits[0] if hits else None))
    got = [(r.n, r.found) for r in out.collect()]
    assert sorted(got, key=lambda x: x[0]) == expected


@pytest.mark.parametrize("closed", ["left", "right"])
def test_overlapping_versions_alike_in_every_method(spark, closed):
    """The version in force that started last, or all of them; none is lost to a shorter one inside it."""
    history = [(1, 0, 20, 1), (1, 5, 10, 2), (1, 5, 12, 3), (1, 30, 40, 4), (1, 35, 35, 5), (2, 0, 9, 6), (2, 3, 5, 7)]
    asks = [(k, n) for k in (1, 2, 3) for n in range(-1, 42)]
    dim = versions(spark, history)
    fact = spark.createDataFrame([(k, day(n)) for k, n in [*asks, (1, 7)]], "id int, at timestamp")

    def held(k, n):
        inside = [(a, b, v) for i, a, b, v in history if i == k and a < b and (a <= n < b if closed == "left" else a < n <= b)]
        return [v for _, _, v in sorted(inside)]

    for method in ("auto", "broadcast", "merge", "join"):
        rows = as_of_join(fact, dim, "id", "at", {"f": "v"}, "left", closed, method=method).collect()
        last = [(k, day(n), (held(k, n) or [0])[-1]) for k, n in [*asks, (1, 7)]]
        assert sorted((r.id, r.at, r.f or 0) for r in rows) == sorted(last)
        rows = as_of_join(fact, dim, "id", "at", {"f": "v"}, "inner", closed, method=method, matches="all").collect()
        every = [(k, day(n), v) for k, n in [*asks, (1, 7)] for v in held(k, n)]
        assert sorted((r.id, r.at, r.f) for r in rows) == sorted(every)


def test_pit_lookup_default_and_earliest(spark):
    dim = versions(spark, [(1, 0, 10, 11), (1, 10, 20, 12), (1, 20, 30, 13)])
    fact = spark.createDataFrame([(1, day(15)), (1, day(25)), (2, day(1)), (1, day(99))], "who int, at timestamp")
    got = sorted((r.at, r.k) for r in pit_lookup(fact, dim, [("who", "id")], "at", "v", "k").collect())
    assert got == [(day(1), 0), (day(15), 12), (day(25), 13), (day(99), 0)]
    got = sorted((r.at, r.k) for r in pit_lookup(fact, dim, [("who", "id")], "at", "v", "k", earliest_key=True).collect())
    assert got == [(day(1), 0), (day(15), 12), (day(25), 12), (day(99), 0)]


@pytest.mark.parametrize("hot_rows", [1_000_000, 4])
def test_running_min(spark, hot_rows):
    rng = random.Random(5)
    rows = [(i, d, rng.randint(0, 99)) for i in range(4) for d in rng.sample(range(200), 30 if i == 0 else 3)]
    df = spark.createDataFrame([(i, day(d), v) for i, d, v in rows], "id int, at timestamp, v int")
    got = sorted((r.id, r.at, r.m) for r in running_min(df, "id", "at", "v", "m", hot_rows).collect())
    assert got == sorted((i, day(d), min(w for j, e, w in rows if j == i and e <= d)) for i, d, _ in rows)


@pytest.mark.parametrize("method,bin_unit", [("join", "day"), ("auto", "day"), ("merge", "week"), ("merge", "month")])
def test_overlap_and_intersection_against_brute_force(spark, method, bin_unit):
    rng = random.Random(3)
    a, b = random_history(rng, range(5)), random_history(rng, range(1, 6))
    b.append((2, 0, 40_000, 999))  # open end
    left, right = versions(spark, a), versions(spark, b)
    got = sorted((r.v, r.w) for r in overlap_join(left, right, "id", {"w": "v"}, method=method, bin_unit=bin_unit).collect())
    want = [(x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2]]
    assert got == sorted(want)
    got = sorted(
        (r.v, r.w, r.ValidFrom, r.ValidTo)
        for r in intersect_join(left, right, "id", {"w": "v"}, method=method, bin_unit=bin_unit).collect()
    )
    want = [
        (x[3], y[3], day(max(x[1], y[1])), day(min(x[2], y[2])))
        for x in a
        for y in b
        if x[0] == y[0] and max(x[1], y[1]) < min(x[2], y[2])
    ]
    assert got == sorted(want)


def test_lookup_method_rests_on_measured_size(spark):
    small = spark.range(100).selectExpr("id", "'name' AS n")
    deep = spark.range(2_000).selectExpr("id % 1 AS id", "'name' AS n")
    wide = spark.range(300).selectExpr("id", "repeat('x', 1000000) AS n")
    start, end = F.col("id").cast("timestamp"), (F.col("id") + 1).cast("timestamp")
    small, deep, wide = (df.withColumns({"ValidFrom": start, "ValidTo": end}) for df in (small, deep, wide))
    methods = lookup_methods({"s": (small, ["id"], ["n"]), "d": (deep, ["id"], ["n"]), "w": (wide, ["id"], ["n"])})
    assert methods == {"s": ("broadcast", True), "d": ("merge", False), "w": ("merge", True)}
    assert lookup_methods({"w": (wide, ["id"], [])})["w"] == ("broadcast", True)
    nested = versions(spark, [(1, 0, 9, 1), (1, 3, 4, 2), (2, 0, 1, 3)])
    assert not lookup_methods({"n": (nested, ["id"], ["v"])})["n"].disjoint


def test_works_on_timestamps_without_zone(spark):
    dim = versions(spark, [(1, 0, 10, 11)]).withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("ValidFrom", "ValidTo")}
    )
    fact = spark.createDataFrame([(1, day(5))], "who int, at timestamp").withColumn("at", F.col("at").cast("timestamp_ntz"))
    for method in ("broadcast", "merge"):
        rows = pit_lookup(fact, dim, [("who", "id")], "at", "v", "k", method=method, hot_rows=0).collect()
        assert rows[0].k == 11
    assert close_out(dim, "id", None).schema["ValidTo"].dataType.simpleString() == "timestamp_ntz"


@pytest.mark.parametrize("method", ["broadcast", "join", "merge"])
def test_overlap_is_the_same_predicate_in_every_method(spark, method):
    d = lambda month, day: dt.datetime(2020, month, day)
    left = spark.createDataFrame(
        [(1, d(1, 20), d(1, 10)), (1, d(3, 1), d(3, 5)), (1, d(5, 1), None), (2, d(1, 1), d(12, 31))],
        "id int, ValidFrom timestamp_ntz, ValidTo timestamp_ntz",
    )
    right = spark.createDataFrame(
        [(1, d(1, 1), d(3, 1), "a"), (1, d(3, 4), d(3, 2), "b"), (2, d(6, 1), d(6, 1), "c")],
        "id int, ValidFrom timestamp_ntz, ValidTo timestamp_ntz, name string",
    )
    got = overlap_join(left, right, "id", {"name": "name"}, method=method).collect()
    assert sorted((r.ValidFrom, r.name) for r in got) == [
        (d(1, 1), "c"), (d(1, 20), "a"), (d(3, 1), "a"),
    ] + [(d(3, 1), "b")] * (d(3, 1) <= d(3, 2) and d(3, 4) <= d(3, 5))


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/Los_Angeles"])
def test_local_times_do_not_pass_through_the_process_zone(spark, monkeypatch, zone):
    import time

    from starloom.operators.incremental import between, high_water_mark

    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        rows = spark.sql("SELECT explode(array(timestamp_ntz'2020-01-01 00:00:00', timestamp_ntz'2020-01-02 05:00:00')) AS t")
        top = high_water_mark(rows, "t")
        assert rows.where(between(rows, "t", None, top)).count() == 2
        assert rows.where(between(rows, "t", top, None)).count() == 0
    finally:
        monkeypatch.undo()
        time.tzset()


def test_hot_ids_are_cut_by_rows_wherever_in_time_they_lie(spark):
    """All versions of an id within one day, a third of them at one instant, some without a time."""
    at = "CASE WHEN id % 3 = 0 THEN timestamp '2020-01-01 05:00:00' WHEN id % 101 = 0 THEN NULL ELSE timestamp_seconds(1577836800 + id) END"
    rows = spark.range(3_000).selectExpr("id", "CAST(id % 2 AS int) AS k", f"{at} AS at").where("k = 0 OR id < 40")
    hot = find_hot(rows, ["k"], "at", 100)
    sliced = with_slices(rows, hot, ["k"], "at")
    assert [r.k for r in hot.collect()] == [0] and sliced.where("k = 1 AND _slice IS NOT NULL").count() == 0
    sizes = sliced.where("k = 0").groupBy("_slice").agg(F.count("*").alias("n"), F.min("at").alias("a"), F.max("at").alias("b"))
    sizes = sizes.orderBy("_slice").collect()
    assert sum(r.n for r in sizes) == 1_500 and sorted(r.n for r in sizes)[-2] <= 110 and sizes[0]._slice == -1
    assert all(x.b < y.a for x, y in zip(sizes[1:], sizes[2:]))
    closed = version_timeline(rows.dropDuplicates(["k", "at"]), "k", "at", hot_rows=100)
    assert sorted(map(str, closed.collect())) == sorted(map(str, version_timeline(rows.dropDuplicates(["k", "at"]), "k", "at").collect()))
