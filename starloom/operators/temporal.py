"""Temporal algebra over versions: rows with a natural id and a validity interval."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.constants import VALID_TO
from starloom.functions import as_names, literal_like, pairs, row_bytes
from starloom.operators.dedup import dedup_by
from starloom.operators.hot import HOT_ROWS, attach_per_key, find_hot, may_broadcast, with_slices
from starloom.operators.sizes import bounded, known_history, known_rows, stage_counted
from starloom.sources.staging import stage

BROADCAST_ROWS = 1_000_000  # versions that may be sent to every executor
BROADCAST_BYTES = 256 << 20  # and their size
SCAN_VERSIONS = 1_000  # versions of one id that one lookup may compare


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


# --------------------------------------------------------------------------
# Next version, timelines, close-out
# --------------------------------------------------------------------------


def _lead(at: str, *partition) -> Column:
    window = Window.partitionBy(*partition).orderBy(F.col(at).asc_nulls_first())
    return F.lead(F.struct(F.col(at).alias("at"))).over(window)


def with_next(df: DataFrame, keys, at: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``_next``: a struct with the following ``at`` of the key, NULL on the newest row.

    If some keys are hot, their rows are windowed per time slice; each slice
    also gets one marker row holding the first time of the next slice.
    """
    keys = as_names(keys)
    hot = find_hot(df, keys, at, hot_rows)
    if hot is None:
        return df.withColumn("_next", _lead(at, *keys))
    sliced = with_slices(df, hot, keys, at)
    firsts = sliced.where("_slice IS NOT NULL").groupBy(*keys, "_slice").agg(F.min(at).alias("_first"))
    following = F.lead(F.struct("_first")).over(Window.partitionBy(*keys).orderBy("_slice"))
    marks = firsts.withColumn("_follow", following).where("_follow IS NOT NULL")
    marks = marks.select(*keys, "_slice", F.col("_follow._first").alias(at), F.lit(True).alias("_mark"))
    rows = sliced.withColumn("_mark", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    # A marker's time is later than every row's of its slice.
    return rows.withColumn("_next", _lead(at, *keys, "_slice")).where("NOT _mark").select(*df.columns, "_next")


def version_timeline(
    events: DataFrame,
    id_col,
    at: str,
    valid_to: str = "ValidTo",
    default_end=None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Close each version at the start of the next one of the same id.

    The newest version ends at ``default_end`` (NULL by default).  Rows of one
    id should differ in ``at``; dedup first, or equal times give empty intervals.
    """
    end = F.when(F.col("_next").isNotNull(), F.col("_next.at")).otherwise(literal_like(events, at, default_end))
    timeline = with_next(events, id_col, at, hot_rows).withColumn(valid_to, end).drop("_next")
    return bounded(timeline, known_rows(events))


def close_out(
    df: DataFrame,
    id_col,
    to,
    end=VALID_TO,
    valid_from: str = "ValidFrom",
    valid_to: str = "ValidTo",
    newest_to: str | None = None,
    strict_reference: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Settle the end of the newest version of each id as known at load time ``to``.

    Still valid after ``to``: the end of time.  Closed by ``to``: its own end,
    taken from ``newest_to`` if that is another column.  Older versions keep
    theirs.  ``strict_reference`` leaves NULL where the newest version ends
    exactly at ``to`` and where ``to`` is not given.
    """
    own = F.col(newest_to or valid_to)
    far = literal_like(df, valid_to, end)
    if to is None:
        newest = F.lit(None).cast(df.schema[valid_to].dataType) if strict_reference else far
    else:
        load = literal_like(df, valid_to, to)
        newest = F.when(own > load, far).when((own < load) if strict_reference else (own <= load), own)
    closed = F.when(F.col("_next").isNull(), newest).otherwise(F.col(valid_to))
    return with_next(df, id_col, valid_from, hot_rows).withColumn(valid_to, closed).drop("_next")


# --------------------------------------------------------------------------
# Point-in-time lookups
# --------------------------------------------------------------------------


def _contains(at: Column, start: Column, end: Column, closed: str) -> Column:
    if closed == "left":
        return (start <= at) & (at < end)
    if closed == "right":
        return (start < at) & (at <= end)
    raise ValueError("closed must be 'left' or 'right'")


class _Choice(NamedTuple):
    method: str
    disjoint: bool


class Lookup(_Choice):
    """How a history is best looked up, and whether versions of an id overlap in it.

    ``shallow`` says that no id has more than ``SCAN_VERSIONS`` versions; ``most`` is
    their number, where it was counted.
    """

    def __new__(cls, method: str, disjoint: bool, shallow: bool = False, most: int | None = None):
        made = super().__new__(cls, method, disjoint)
        made.shallow, made.most = shallow, most
        return made


def _lookup(rows, size, most, disjoint: bool) -> Lookup:
    small = (rows or 0) <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES
    shallow = (most or 0) <= SCAN_VERSIONS
    return Lookup("broadcast" if small and shallow else "merge", disjoint, shallow, most or 0)


def lookup_methods(
    histories: dict[str, tuple[DataFrame, list[str], list[str]]], valid: tuple[str, str] = ("ValidFrom", "ValidTo")
) -> dict[str, Lookup]:
    """``broadcast`` for each history that is small and shallow, else ``merge``.

    A history comes with its key columns and the columns taken from it.  What
    ``stage_history`` counted when it wrote a history is taken from there.  For all
    others one job counts rows, bytes and the versions per id, so the
    choice rests on measured sizes and not on estimates.  Versions of an id
    overlap somewhere if one that is not empty ends after the next one starts.
    """
    start, end = valid
    measured, found = None, {}
    for name, (history, keys, take) in histories.items():
        known = known_history(history, keys, valid)
        if known is not None and (known.bytes <= BROADCAST_BYTES or known.rows > BROADCAST_ROWS):
            found[name] = _lookup(known.rows, known.bytes, known.most, known.disjoint)
            continue
        ids = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
        narrow = history.select(
            *ids, row_bytes(history, [*keys, *take]).alias("_size"), F.col(start).alias("_from"), F.col(end).alias("_to")
        )
        by_id = [f"_k{i}" for i in range(len(keys))]
        real = F.col("_from") < F.col("_to")
        following = F.lead("_from").over(Window.partitionBy(*by_id, real).orderBy("_from"))
        versions = (
            narrow.withColumn("_meets", F.coalesce(real & (following < F.col("_to")), F.lit(False)))
            .groupBy(*by_id)
            .agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_bytes"), F.max("_meets").alias("_meets"))
        )
        row = versions.agg(F.sum("_n"), F.sum("_bytes"), F.max("_n"), F.max("_meets")).select(F.lit(name), "*")
        measured = row if measured is None else measured.unionAll(row)
    for name, *sizes, meets in measured.collect() if measured is not None else []:  # one row per history
        found[name] = _lookup(*sizes, not meets)
    return found


def lookup_method(history: DataFrame, keys: list[str], take: list[str], valid=("ValidFrom", "ValidTo")) -> Lookup:
    return lookup_methods({"it": (history, keys, take)}, valid)["it"]


def as_of_join(
    left: DataFrame,
    history: DataFrame,
    on,
    at: str,
    take: dict[str, str],
    how: str = "inner",
    closed: str = "left",
    valid_from: str = "ValidFrom",
    valid_to: str = "ValidTo",
    method: str | Lookup = "auto",
    hot_rows: int = HOT_ROWS,
    matches: str = "last",
    disjoint: bool | None = None,
) -> DataFrame:
    """Add columns of the version of ``history`` in force at ``left[at]``.

    ``on`` pairs the key columns; ``take`` maps new column names to history
    columns.  ``closed="left"`` means ``from <= at < to``, ``"right"`` means
    ``from < at <= to``; the two are used in different places on purpose.
    ``how`` is ``inner`` or ``left``.

    Should versions of an id overlap, ``matches="last"`` takes the one in force
    that started last (ties by end, then by the columns taken) and adds no
    rows; ``"all"`` returns a row for every version in force.  ``disjoint`` says
    that no versions overlap; where it is not given it is measured.

    Methods: ``broadcast`` sends the history to all executors, if it has been
    counted and found small, as ``auto`` does too, and is ``merge`` otherwise; ``merge`` sorts rows and versions of a
    key together and carries the last version along, which stays linear however
    many versions an id has and splits hot ids; ``join`` is the plain equi-join
    with a range condition.  All give the same rows.  What ``lookup_methods``
    returns for a history can be given as ``method``.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    keys = pairs(on)
    clash = set(take) & set(left.columns)
    if clash:
        raise ValueError(f"columns already present: {sorted(clash)}")
    versions = history.where(F.col(valid_from) < F.col(valid_to)).select(
        *[F.col(h).alias(f"_k{i}") for i, (_, h) in enumerate(keys)],
        F.col(valid_from).alias("_from"),
        F.col(valid_to).alias("_to"),
        *[F.col(source).alias(name) for name, source in take.items()],
    )
    if matches not in ("last", "all"):
        raise ValueError("matches must be 'last' or 'all'")
    shallow = False
    if isinstance(method, Lookup):
        shallow = method.shallow
        method, disjoint = method
    if method in ("auto", "broadcast") or disjoint is None:
        measured = lookup_method(history, [h for _, h in keys], list(take.values()), (valid_from, valid_to))
        method = measured.method if method in ("auto", "broadcast") else method
        disjoint = measured.disjoint if disjoint is None else disjoint
        shallow = measured.shallow
    ks = [f"_k{i}" for i in range(len(keys))]
    if not disjoint and matches == "last":
        # Written once: a look-up that searches for hot ids reads it twice.
        versions = stage_counted(_flatten(versions, ks, list(take), shallow), "flat-versions")
    if not disjoint and matches == "all" and method == "merge":
        if not shallow:
            return _every_match(left, versions, keys, at, list(take), how, closed)
        method = "join"
    if method in ("broadcast", "join"):
        if method == "broadcast":
            versions = F.broadcast(versions)
        same = [F.col(name) == F.col(f"_k{i}") for i, (name, _) in enumerate(keys)]
        matched = left.join(versions, _all([*same, _contains(F.col(at), F.col("_from"), F.col("_to"), closed)]), how)
        return matched.select(*left.columns, *take)
    return _merge_lookup(left, versions, keys, at, list(take), how, closed, hot_rows)


def packed_versions(history: DataFrame, member: str, take: list[str], out: str, valid=("ValidFrom", "ValidTo")) -> DataFrame:
    """One row per id: ``member`` and ``out``, an array of its versions that are not empty.

    For histories of which no id has more than ``SCAN_VERSIONS`` versions: rows that
    have many look-ups at different times carry the array, see ``version_at``.
    """
    start, end = valid
    real = history.where((F.col(start) < F.col(end)) & F.col(member).isNotNull())
    version = F.struct(F.col(start).alias("_from"), F.col(end).alias("_to"), *take)
    return real.groupBy(member).agg(F.collect_list(version).alias(out))


def versions_between(versions: Column, low: Column, high: Column) -> Column:
    """Of packed versions those that may be in force (from < at <= to) at a time from ``low`` to ``high``."""
    return F.filter(versions, lambda v: (v["_to"] >= low) & (v["_from"] < high))


def version_at(versions: Column, at: Column, closed: str = "right") -> Column:
    """Of packed versions the one in force that started last, as ``as_of_join`` takes it; NULL where none is."""
    return F.array_max(F.filter(versions, lambda v: _contains(at, v["_from"], v["_to"], closed)))


def _in_force(points: DataFrame, versions: DataFrame, ks: list[str], closed: str) -> DataFrame:
    """Every point (``ks``, ``_t``) with every version in force then, met in a binary tree over days."""
    start, end = (_bin_number(F.col(c), "day") for c in ("_from", "_to"))
    first, last, longest = (v or 0 for v in versions.agg(F.min(start), F.max(end), F.max(end - start)).first())
    levels = (longest + 1).bit_length() - 1  # no version covers a larger node

    def bin_of(column: str) -> Column:
        return F.greatest(F.least(_bin_number(F.col(column), "day"), F.lit(last)), F.lit(first)) - F.lit(first)

    asked = points.select(*ks, "_t", F.explode(_above(bin_of("_t"), levels)).alias("_bin"))
    held = versions.withColumn("_bin", F.explode(_cover(bin_of("_from"), bin_of("_to"), levels)))
    return asked.join(held, [*ks, "_bin"]).where(_contains(F.col("_t"), F.col("_from"), F.col("_to"), closed)).drop("_bin")


def _flatten(versions: DataFrame, ks: list[str], take: list[str], shallow: bool) -> DataFrame:
    """Versions without overlap: between two neighbouring bounds of an id, the one in force that started last.

    The few versions of an id of a ``shallow`` history meet its bounds in one
    equi-join after one shuffle, others in a tree.
    """
    if shallow:
        held = versions.dropna(subset=ks).repartition(*ks)
        bounds = held.select(*ks, F.explode(F.array("_from", "_to")).alias("_t")).distinct()
        bounds = bounds.withColumn("_until", F.lead("_t").over(Window.partitionBy(*ks).orderBy("_t")))
        in_force = _contains(F.col("_t"), F.col("_from"), F.col("_to"), "left")
        met = bounds.join(held, ks).where(in_force).groupBy(*ks, "_t", "_until")
        won = met.agg(F.max(F.struct("_from", "_to", *take)).alias("_won"))
        return won.select(*ks, F.col("_t").alias("_from"), F.col("_until").alias("_to"), *[F.col(f"_won.{n}") for n in take])
    bounds = versions.select(*ks, F.col("_from").alias("_t")).union(versions.select(*ks, F.col("_to").alias("_t"))).distinct()
    winner = F.max(F.struct("_from", "_to", *take)).alias("_won")
    won = _in_force(bounds, versions, ks, "left").groupBy(*ks, "_t").agg(winner)
    until = F.lead("_t").over(Window.partitionBy(*ks).orderBy("_t"))
    # The bound after the last version has no winner but ends the piece before it.
    pieces = bounds.withColumn("_until", until).join(won, [*ks, "_t"])
    return pieces.select(*ks, F.col("_t").alias("_from"), F.col("_until").alias("_to"), *[F.col(f"_won.{n}") for n in take])


def _every_match(left, versions, keys, at, take, how, closed):
    """Distinct (id, time) pairs meet the versions; the rows are joined back to what their pair found."""
    ks = [f"_k{i}" for i in range(len(keys))]
    types = {n: versions.schema[n].dataType for n in [*ks, "_from"]}
    asked = [F.col(name).cast(types[k]) for (name, _), k in zip(keys, ks)] + [F.col(at).cast(types["_from"])]
    points = left.select(*[c.alias(n) for c, n in zip(asked, [*ks, "_t"])]).dropna().distinct()
    found = _in_force(points, versions, ks, closed)
    return left.join(found, _all([c == F.col(n) for c, n in zip(asked, [*ks, "_t"])]), how).select(*left.columns, *take)


def _merge_lookup(left, versions, keys, at, take, how, closed, hot_rows):
    ks = [f"_k{i}" for i in range(len(keys))]
    findable = _all([F.col(name).isNotNull() for name, _ in keys] + [F.col(at).isNotNull()])
    types = {n: versions.schema[n].dataType for n in [*ks, "_from"]}
    # At equal times a half-open-left interval has started already, a half-open-right one has not.
    version_rank, row_rank = (0, 1) if closed == "left" else (1, 0)
    rows = left.where(findable).select(
        *[F.col(name).cast(types[k]).alias(k) for (name, _), k in zip(keys, ks)],
        F.col(at).cast(types["_from"]).alias("_t"),
        F.lit(row_rank).alias("_rank"),
        F.struct(*left.columns).alias("_row"),
    )
    starts = versions.select(
        *ks,
        F.col("_from").alias("_t"),
        F.lit(version_rank).alias("_rank"),
        F.struct("_to", *take).alias("_version"),
    )
    hot = find_hot(rows.select(*ks, "_t").unionAll(starts.select(*ks, "_t")), ks, "_t", hot_rows)
    if hot is None:
        groups, both = ks, rows.unionByName(starts, allowMissingColumns=True)
    else:
        groups, both = [*ks, "_slice", "_salt"], _split_hot(rows, starts, hot, ks, hot_rows)

    so_far = (
        Window.partitionBy(*groups)
        .orderBy("_t", "_rank", "_version._to", *[f"_version.{n}" for n in take])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = both.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far)).where("_row IS NOT NULL")
    in_force = F.col("_t") < F.col("_version._to") if closed == "left" else F.col("_t") <= F.col("_version._to")
    if how == "inner":
        return found.where(in_force).select("_row.*", *[F.col(f"_version.{n}") for n in take])
    matched = found.select("_row.*", *[F.when(in_force, F.col(f"_version.{n}")).alias(n) for n in take])
    absent = left.where(~findable).select(
        *left.columns, *[F.lit(None).cast(versions.schema[n].dataType).alias(n) for n in take]
    )
    return matched.unionAll(absent)


def _split_hot(rows: DataFrame, starts: DataFrame, hot: DataFrame, ks: list[str], hot_rows: int) -> DataFrame:
    """Rows and versions with the groups of hot keys cut by time slice and salt.

    Each slice a hot key is asked for in also gets the version in force when it
    begins: the last one of an earlier slice.  A slice that still has too many
    rows, at one instant say, is spread over as many salts as its rows call for;
    its versions are repeated in each.
    """
    rows = with_slices(rows, hot, ks, "_t")
    starts = with_slices(starts, hot, ks, "_t")
    last = (
        starts.where("_slice IS NOT NULL")
        .groupBy(*ks, "_slice")
        .agg(F.max_by(F.struct("_t", "_rank", "_version"), F.struct("_t", F.col("_version._to"))).alias("_last"))
    )
    asked = F.ceil(F.count(F.lit(1)) / F.lit(max(hot_rows, 1))).cast("int").alias("_salts")
    used = stage(rows.where("_slice IS NOT NULL").groupBy(*ks, "_slice").agg(asked), "hot-slices")
    earlier = Window.partitionBy(*ks).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        used.drop("_salts")
        .unionByName(last, allowMissingColumns=True)
        .groupBy(*ks, "_slice")
        .agg(F.first("_last", ignorenulls=True).alias("_last"))
        .withColumn("_last", F.last("_last", ignorenulls=True).over(earlier))
        .where("_last IS NOT NULL")
        .select(*ks, "_last._t", "_last._rank", "_last._version", "_slice")
    )
    split, salts = used.where("_salts > 1"), F.coalesce("_salts", F.lit(1))
    salt = F.pmod(F.xxhash64("_row"), salts).cast("int")
    salted = starts.unionByName(carried).join(split, [*ks, "_slice"], "left")
    salted = salted.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    rows = rows.join(split, [*ks, "_slice"], "left").withColumn("_salt", salt).drop("_salts")
    return rows.unionByName(salted, allowMissingColumns=True)


def pit_lookup(
    fact: DataFrame,
    dim: DataFrame,
    on,
    at: str,
    key: str,
    out: str | None = None,
    default: int | None = 0,
    closed: str = "right",
    earliest_key: bool = False,
    **options,
) -> DataFrame:
    """Surrogate key of the dimension version in force at ``fact[at]``, ``default`` where none is.

    ``earliest_key`` returns instead the smallest key among the versions of the
    same id that the fact rows matched up to that version's start.  It is
    computed on the matched versions, not on the fact rows.
    """
    out = out or key
    take = {out: key}
    if earliest_key:
        take |= {"_member": pairs(on)[0][1], "_since": "ValidFrom"}
    found = as_of_join(fact, dim, on, at, take, "left", closed, **options)
    if earliest_key:
        found = earliest_keys(found, [(out, "_member", "_since")]).drop("_member", "_since")
    return found if default is None else found.withColumn(out, F.coalesce(out, F.lit(default)))


def earliest_keys(
    found: DataFrame,
    roles: list[tuple[str, str, str]],
    hot_rows: int = HOT_ROWS,
    row: str | None = None,
    written: bool = False,
) -> DataFrame:
    """For each (key, member, since): replace the key by its running minimum per member, in order of ``since``.

    Rows of one version share the result, so the running minimum runs over the
    distinct versions (aggregated map-side) and is attached to the rows, also where
    most of them have one version.  ``found`` is written first, since each role
    reads it once more, unless it is ``written`` already.  With a ``row`` key, minima too
    many to send around are attached to narrow rows (key, member, since) and joined
    back by the key, so full rows are shuffled once for all such roles.
    """
    found = found if written else stage(found, "found-versions")
    return earliest_parts(found, roles, found.columns, hot_rows, row)[0]


def earliest_parts(
    found: DataFrame,
    roles: list[tuple[str, str, str]],
    keep: list[str],
    hot_rows: int = HOT_ROWS,
    row: str | None = None,
    parts: list[Column] | None = None,
) -> list[DataFrame]:
    """``earliest_keys`` of the written ``found``, its columns ``keep``, as one frame.

    Where minima are joined back by the ``row`` key, it is a frame for each of the conditions ``parts``, of which a
    row meets one: written one after the other they take the disk of one part's shuffles.
    """
    firsts, broadcasts = [], []
    for i, (key, member, since) in enumerate(roles):
        hit = F.col(key).isNotNull()
        used = found.where(hit).groupBy(member, since).agg(F.min(key).alias("_key"), F.count(F.lit(1)).alias("_rows"))
        m, s, first = f"_em{i}", f"_es{i}", f"_earliest{i}"
        least = running_min(used, member, since, "_key", first, hot_rows)
        firsts.append(stage_counted(least.select(F.col(member).alias(m), F.col(since).alias(s), first, "_rows"), "per-key"))
        broadcasts.append(row is None or may_broadcast(firsts[-1]))

    def settled(rows: DataFrame) -> DataFrame:
        joined, narrow = rows, []
        for i, (key, member, since) in enumerate(roles):
            hit, on = F.col(key).isNotNull(), [(member, f"_em{i}"), (since, f"_es{i}")]
            if broadcasts[i]:
                joined = attach_per_key(joined, firsts[i], on, "_rows", "left", hot_rows)
            else:
                asked = rows.where(hit).select(row, member, since)
                narrow.append(attach_per_key(asked, firsts[i], on, "_rows", "inner", hot_rows).select(row, f"_earliest{i}"))
        for attached in narrow:
            joined = joined.join(attached, row, "left")
        first = {key: F.when(F.col(key).isNotNull(), F.col(f"_earliest{i}")) for i, (key, _, _) in enumerate(roles)}
        return joined.withColumns(first).select(*keep)

    if parts and not all(broadcasts):
        return [settled(found.where(part)) for part in parts]
    return [settled(found)]


def running_min(
    df: DataFrame, member: str, at: str, value: str, out: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the smallest ``value`` of a member up to ``at``; hot members are cut into time slices."""
    hot = find_hot(df, [member], at, hot_rows)
    if hot is None:
        return df.withColumn(out, F.min(value).over(Window.partitionBy(member).orderBy(at)))
    sliced = with_slices(df, hot, [member], at)
    earlier = Window.partitionBy("_m").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = (
        sliced.where("_slice IS NOT NULL")
        .groupBy(F.col(member).alias("_m"), F.col("_slice").alias("_s"))
        .agg(F.min(value).alias("_min"))
        .withColumn("_before", F.min("_min").over(earlier))
    )
    within = F.min(value).over(Window.partitionBy(member, "_slice").orderBy(at))
    joined = sliced.withColumn("_within", within).join(
        per_slice, (F.col(member) == F.col("_m")) & (F.col("_slice") == F.col("_s")), "left"
    )
    return joined.withColumn(out, F.least("_within", "_before")).select(*df.columns, out)


# --------------------------------------------------------------------------
# Interval joins
# --------------------------------------------------------------------------


def _bin_number(column, unit: str):
    """Number of the ``unit`` a time or date lies in; never falls as time goes on."""
    day = F.unix_date(column.cast("date")).cast("long")
    if unit == "day":
        return day
    if unit == "week":
        return F.floor(day / 7)
    year = F.year(column).cast("long")
    if unit == "month":
        return year * 12 + F.month(column)
    if unit == "year":
        return year
    raise ValueError(f"bins are days, weeks, months or years, not {unit!r}")


def _above(at, levels: int):
    """The nodes above bin ``at``, itself included: one per level of a binary tree over the bins."""
    return F.array(*[F.shiftright(at, n) * 64 + n for n in range(levels + 1)])


def _cover(first, last, levels: int):
    """The fewest nodes whose bins are ``first`` to ``last``: two per level at most."""
    nodes = []
    for n in range(levels + 1):
        low, high = F.shiftright(first + (2**n - 1), n), F.shiftright(last + 1, n)
        some = low < high
        nodes.append(F.when(some & (low % 2 == 1), low * 64 + n))
        nodes.append(F.when(some & (high % 2 == 1), (high - 1) * 64 + n))
    return F.array_compact(F.array(*nodes))


def _ticks(at: Column, kind: T.DataType) -> Column:
    """Microseconds to a time or date of type ``kind``; grows with time."""
    if isinstance(kind, T.DateType):
        return F.unix_date(at).cast("long") * 86_400_000_000
    if isinstance(kind, T.TimestampNTZType):
        since = at - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return (since.cast("decimal(24,6)") * 1_000_000).cast("long")
    return F.unix_micros(at.cast("timestamp"))


def _overlapping(left, right, keys, l_valid, r_valid, bin_unit, hot_rows, touching):
    """Pairs of ``left`` and ``right`` (columns already distinct) whose closed intervals meet.

    ``keys`` pairs the id columns.  Without ``touching``, intervals of no length, which
    have no time in common with any, are left out.
    """
    (lf, lt), (rf, rt) = l_valid, r_valid
    if not touching:
        left, right = left.where(F.col(lf) < F.col(lt)), right.where(F.col(rf) < F.col(rt))
    same = [F.col(a) == F.col(b) for a, b in keys]
    meets = (F.col(lf) <= F.col(rt)) & (F.col(rf) <= F.col(lt))
    if bin_unit is None:
        return left.join(right, _all([*same, meets]), "inner")
    # Intervals that end before they start cover no bins; they are few and joined by the predicate alone.
    odd_left, odd_right = left.where(F.col(lf) > F.col(lt)), right.where(F.col(rf) > F.col(rt))
    straight, r_straight = left.where(F.col(lf) <= F.col(lt)), right.where(F.col(rf) <= F.col(rt))
    odd = odd_left.join(right, _all([*same, meets]), "inner").unionAll(
        straight.join(odd_right, _all([*same, meets]), "inner")
    )
    # Two intervals meet when one holds the other's start.  No start is later than
    # the last one, so an open interval is covered up to there only.  The same
    # job counts the rows of each id, which no tree node of it can exceed.
    ids = [f"_i{n}" for n in range(len(keys))]
    starts = straight.select(
        *[F.col(a).alias(i) for (a, _), i in zip(keys, ids)], _bin_number(F.col(lf), bin_unit).alias("b"), F.lit(0).alias("side")
    ).unionAll(
        r_straight.select(
            *[F.col(b).alias(i) for (_, b), i in zip(keys, ids)], _bin_number(F.col(rf), bin_unit).alias("b"), F.lit(1).alias("side")
        )
    )
    per_id = starts.groupBy(*ids).agg(
        F.min("b").alias("low"), F.max("b").alias("high"), F.sum("side").alias("right"), F.count(F.lit(1)).alias("all")
    )
    most = F.max(F.greatest(F.col("right"), F.col("all") - F.col("right")))
    base, final, most = (v or 0 for v in per_id.agg(F.min("low"), F.max("high"), most).first())
    levels = (final - base).bit_length()
    columns = [*left.columns, *right.columns]
    fine = None
    if most > hot_rows:
        # Most rows of such an id may lie in one bin: its time is cut more finely, by its number of rows.
        fine, straight, r_straight = _in_fine_bins(straight, r_straight, keys, (lf, lt), (rf, rt), hot_rows)

    def bin_of(column):
        return F.least(_bin_number(F.col(column), bin_unit), F.lit(final)) - F.lit(base)

    def spans(df, start, end, name):
        return df.withColumn(name, F.explode(_cover(bin_of(start), bin_of(end), levels)))

    def points(df, start, name):
        return df.withColumn(name, F.explode(_above(bin_of(start), levels)))

    # A bin has one node above it in a cover, if any, so a pair is found once.
    l_keys, r_keys = [a for a, _ in keys] + ["_lbin"], [b for _, b in keys] + ["_rbin"]
    started = (F.col(rf) >= F.col(lf)) & (F.col(rf) <= F.col(lt))
    running = (F.col(lf) > F.col(rf)) & (F.col(lf) <= F.col(rt))
    parts = [
        _meet(spans(straight, lf, lt, "_lbin"), points(r_straight, rf, "_rbin"), l_keys, r_keys, started, None),
        _meet(points(straight, lf, "_lbin"), spans(r_straight, rf, rt, "_rbin"), l_keys, r_keys, running, None),
    ]
    if fine is not None:
        l_spans, r_points, l_points, r_spans = fine
        parts += [
            _meet(l_spans, r_points, l_keys, r_keys, started, hot_rows),
            _meet(l_points, r_spans, l_keys, r_keys, running, hot_rows),
        ]
    return reduce(DataFrame.unionAll, [*[p.select(*columns) for p in parts], odd])


FINE_BINS = 16  # bins of a hot id for each ``hot_rows`` rows of it


def _in_fine_bins(left, right, keys, l_valid, r_valid, hot_rows):
    """The rows of hot ids under nodes of a tree over bins of their own, then ``left`` and ``right`` without them.

    A hot id has more than ``hot_rows`` rows of a side.  Its time, from the first start to
    the last, is cut into bins of a power of two microseconds, so many that a bin holds a
    fraction of ``hot_rows`` rows wherever they are spread evenly.  Starts are copied no
    higher up the tree than the longest interval of the other side reaches.
    """
    (lf, lt), (rf, rt) = l_valid, r_valid
    kinds = [d.schema[c].dataType for d, c in ((left, lf), (left, lt), (right, rf), (right, rt))]
    kind = kinds[0] if len({k.typeName() for k in kinds}) == 1 else T.TimestampType()
    ids = [f"_h{n}" for n in range(len(keys))]

    def at(column):
        return _ticks(F.col(column), kind)

    starts = [
        d.select(*[F.col(k).alias(i) for k, i in zip(names, ids)], at(c).alias("_t"), F.lit(side).alias("_side"))
        for d, names, c, side in ((left, [a for a, _ in keys], lf, 0), (right, [b for _, b in keys], rf, 1))
    ]
    per_id = starts[0].unionAll(starts[1]).dropna(subset=ids).groupBy(*ids).agg(
        F.min("_t").alias("_low"), F.max("_t").alias("_high"), F.sum("_side").alias("_n1"), F.sum(1 - F.col("_side")).alias("_n0")
    )
    rows = F.greatest("_n0", "_n1")
    deep = F.ceil(F.log2(rows * FINE_BINS / F.lit(max(hot_rows, 1))))
    shift = F.greatest(F.lit(0), F.ceil(F.log2(F.col("_high") - F.col("_low") + 1)) - deep).cast("int")
    hot = stage(per_id.where(rows > hot_rows).select(*ids, "_low", "_high", shift.alias("_shift")), "hot-ids")

    def same(names):
        return _all([F.col(k) == F.col(i) for k, i in zip(names, ids)])

    def placed(df, names, start, end):
        def bin_of(t):
            return F.expr(f"shiftright({t} - _low, _shift)")

        marked = df.join(hot, same(names)).withColumns({"_start": at(start), "_end": F.least(at(end), "_high")})
        return marked.select(*df.columns, bin_of("_start").alias("_first"), bin_of("_end").alias("_last"))

    one, two = placed(left, [a for a, _ in keys], lf, lt), placed(right, [b for _, b in keys], rf, rt)
    sizes = [d.agg(F.max(F.col("_last") - F.col("_first"))).select(F.lit(n).alias("n"), "*") for n, d in enumerate((one, two))]
    longest = {n: size or 0 for n, size in sizes[0].unionAll(sizes[1]).collect()}  # one row per side

    def under(df, nodes, name):
        return df.withColumn(name, F.explode(nodes)).drop("_first", "_last")

    tops = [(longest[n] + 1).bit_length() - 1 for n in (0, 1)]
    first, last = F.col("_first"), F.col("_last")
    fine = (
        under(one, _cover(first, last, tops[0]), "_lbin"),
        under(two, _above(first, tops[0]), "_rbin"),
        under(one, _above(first, tops[1]), "_lbin"),
        under(two, _cover(first, last, tops[1]), "_rbin"),
    )
    cold = [d.join(hot, same(names), "left_anti") for d, names in ((left, [a for a, _ in keys]), (right, [b for _, b in keys]))]
    return fine, *cold


def _meet(left, right, l_keys, r_keys, condition, hot_rows):
    """Join on an id and a tree node; nodes above ``hot_rows`` rows of a side are cut into parts of about as many.

    The rows of a part are dealt by a hash of their contents and those of the other
    side repeated for each part, so every pair still meets once.  With
    ``hot_rows=None`` no node can have that many.
    """
    on = [F.col(a) == F.col(b) for a, b in zip(l_keys, r_keys)]
    if hot_rows is None:
        return left.join(right, _all([*on, condition]), "inner")
    names = [f"_n{i}" for i in range(len(l_keys))]

    def parts(df, keys, name):
        counted = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("_rows"))
        return counted.where(F.col("_rows") > hot_rows).select(*names, F.ceil(F.col("_rows") / hot_rows).cast("int").alias(name))

    hot = parts(left, l_keys, "_lparts").unionByName(parts(right, r_keys, "_rparts"), allowMissingColumns=True)
    # One row per hot node: its size tells Catalyst whether to send it around.
    hot = stage(hot.groupBy(*names).agg(*[F.coalesce(F.max(c), F.lit(1)).alias(c) for c in ("_lparts", "_rparts")]), "hot-nodes")

    def dealt(df, keys, own, other, part, copy):
        marked = df.join(hot, _all([F.col(k) == F.col(n) for k, n in zip(keys, names)]), "left")
        mine, theirs = (F.coalesce(F.col(c), F.lit(1)) for c in (own, other))
        number = F.pmod(F.xxhash64(*df.columns), mine).cast("int")
        copies = F.explode(F.sequence(F.lit(0), theirs - 1))
        return marked.select(*df.columns, number.alias(part), copies.alias(copy))

    one = dealt(left, l_keys, "_lparts", "_rparts", "_lpart", "_lcopy")
    two = dealt(right, r_keys, "_rparts", "_lparts", "_rpart", "_rcopy")
    whole = [*on, F.col("_lpart") == F.col("_rcopy"), F.col("_lcopy") == F.col("_rpart"), condition]
    return one.join(two, _all(whole), "inner").drop("_lpart", "_lcopy", "_rpart", "_rcopy")


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    on,
    take: dict[str, str],
    valid: tuple[str, str] = ("ValidFrom", "ValidTo"),
    right_valid: tuple[str, str] | None = None,
    method: str | Lookup = "auto",
    bin_unit: str = "month",
    hot_rows: int = HOT_ROWS,
    touching: bool = True,
) -> DataFrame:
    """Inner join of versions whose intervals overlap; touching ends count.

    ``touching=False`` leaves out intervals of no length; ends of others still touch.

    ``broadcast`` sends the right side to all executors, if it has been counted and
    found small, as ``auto`` does too.  ``merge`` matches the starts of each side to
    the intervals of the other, which a binary tree over bins of ``bin_unit``
    (day, week, month, year) covers: an interval or a start is copied a few times
    per level, so copies grow with the logarithm of the time spanned, and an id
    with very many versions compares those that meet or share a bin.  An id with more
    than ``hot_rows`` rows has bins of its own, the finer the more rows it has; a node
    that still has more is cut into parts.  ``join``
    leaves it to Spark: one equi-join, which ``auto`` takes for a large history
    of which no id has more than ``SCAN_VERSIONS`` versions.
    """
    keys = pairs(on)
    r_from, r_to = right_valid or valid
    side = right.select(
        *[F.col(r).alias(f"_r{i}") for i, (_, r) in enumerate(keys)],
        F.col(r_from).alias("_rfrom"),
        F.col(r_to).alias("_rto"),
        *[F.col(source).alias(name) for name, source in take.items()],
    )
    if method in ("auto", "broadcast"):
        method = lookup_method(right, [r for _, r in keys], list(take.values()), (r_from, r_to))
    if isinstance(method, Lookup):
        method = "join" if method.method == "merge" and method.shallow else method.method
    if method == "broadcast":
        side = F.broadcast(side)
    bins = bin_unit if method == "merge" else None
    ids = [(a, f"_r{i}") for i, (a, _) in enumerate(keys)]
    return _overlapping(left, side, ids, valid, ("_rfrom", "_rto"), bins, hot_rows, touching).select(*left.columns, *take)


def intersect_join(
    left: DataFrame,
    right: DataFrame,
    on,
    take: dict[str, str],
    valid: tuple[str, str] = ("ValidFrom", "ValidTo"),
    right_valid: tuple[str, str] | None = None,
    **options,
) -> DataFrame:
    """Join on the key and narrow validity to the common part; empty parts go.

    Apply it repeatedly to intersect more than two histories.  ``options`` are
    those of ``overlap_join``.
    """
    start, end = valid
    r_from, r_to = right_valid or valid
    paired = overlap_join(
        left, right, on, {**take, "_rf": r_from, "_rt": r_to}, valid=valid, right_valid=right_valid, touching=False, **options
    )
    common = paired.withColumns({start: F.greatest(start, "_rf"), end: F.least(end, "_rt")})
    return common.where(F.col(end) > F.col(start)).drop("_rf", "_rt")


def latest_version(df: DataFrame, id_col, valid_from: str = "ValidFrom") -> DataFrame:
    """The newest version of each id."""
    return dedup_by(df, id_col, [F.col(valid_from).desc_nulls_last()])
