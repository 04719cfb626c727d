"""Exact deduplication over an index of live digests.

The index is a table of buckets cut from the front of the digests.  A bucket
has a cuckoo filter, which answers most look-ups without the keys and forgets
deleted ones, and the stored keys, against which every hit is verified and from
which a filter that overflows is built anew at twice the size.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.sources.staging import stage

BUCKET_KEYS = 8_192  # keys of a bucket, on average
COMBINED = 100_000  # digests a task holds while it combines copies
_SLOTS = 4
_KICKS = 500
_FILTER, _KEY, _DELETE, _INSERT = range(4)
_ROW = "bucket long, kind int, digest binary, length long, doc_id long, row long, copies long, filter binary"
_STATE = _ROW + ", false_hits long, resizes long"


class CuckooFilter:
    """Approximate multiset of 64-bit hashes: no wrong "no", rarely a wrong "yes", and deletion.

    A hash has a fingerprint and two buckets of four slots, each found from the
    other by the fingerprint alone.  ``insert`` returns False when no slot came
    free; one fingerprint is then homeless and the filter has to be built anew.
    """

    def __init__(self, capacity: int = 256, fingerprint_bits: int = 16, table: bytes | None = None):
        self.bits = fingerprint_bits
        slots = _SLOTS << max(0, math.ceil(math.log2(max(1, capacity / 0.9 / _SLOTS))))
        self.table = array("H", table if table else bytes(2 * slots))
        self.mask = len(self.table) // _SLOTS - 1

    def _places(self, hashed: int) -> tuple[int, int, int]:
        mark = (hashed >> 48) % ((1 << self.bits) - 1) + 1
        first = hashed & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, place: int, mark: int) -> int:
        return place ^ (mark * 0x5BD1E995 & self.mask)

    def __contains__(self, hashed: int) -> bool:
        mark, *places = self._places(hashed)
        return any(mark in self.table[_SLOTS * p : _SLOTS * p + _SLOTS] for p in places)

    def _put(self, mark: int, place: int) -> bool:
        for slot in range(_SLOTS * place, _SLOTS * place + _SLOTS):
            if not self.table[slot]:
                self.table[slot] = mark
                return True
        return False

    def insert(self, hashed: int) -> bool:
        mark, first, second = self._places(hashed)
        if self._put(mark, first) or self._put(mark, second):
            return True
        place = second
        for kick in range(_KICKS):
            slot = _SLOTS * place + (kick + mark) % _SLOTS
            mark, self.table[slot] = self.table[slot], mark
            place = self._other(place, mark)
            if self._put(mark, place):
                return True
        return False

    def delete(self, hashed: int) -> bool:
        """Take one such fingerprint out; only for hashes that are known to be in."""
        mark, *places = self._places(hashed)
        for p in places:
            for slot in range(_SLOTS * p, _SLOTS * p + _SLOTS):
                if self.table[slot] == mark:
                    self.table[slot] = 0
                    return True
        return False


def _rank(doc_id: int | None, row: int) -> tuple[bool, int, int]:
    """Order in which documents of a text stay: the largest id, a missing one last, then the last row."""
    return doc_id is not None, doc_id or 0, row


class Bucket:
    """Filter and stored keys of one bucket, while a task works on it."""

    def __init__(self, fingerprint_bits: int = 16):
        self.filter = CuckooFilter(fingerprint_bits=fingerprint_bits)
        self.ready = True  # the filter holds the stored keys
        self.keys: dict[bytes, tuple[int, int | None, int, int]] = {}  # length, doc_id, row, copies
        self.false_hits = self.resizes = 0

    @staticmethod
    def hashed(digest: bytes) -> int:
        return int.from_bytes(digest[8:16], "little")

    def load_filter(self, table: bytes) -> None:
        self.filter = CuckooFilter(fingerprint_bits=self.filter.bits, table=table)

    def load_key(self, digest: bytes, length: int, doc_id: int | None, row: int, copies: int, filtered: bool) -> None:
        self.keys[digest] = length, doc_id, row, copies
        self.ready = filtered

    def _resize(self) -> None:
        """The filter anew from the stored keys, twice as large until they fit."""
        capacity = max(256, len(self.filter.table))
        while True:
            self.filter = CuckooFilter(capacity, self.filter.bits)
            if all(self.filter.insert(self.hashed(d)) for d in self.keys):
                self.ready = True
                return
            capacity *= 2

    def insert(self, digest: bytes, length: int, doc_id: int | None, row: int, copies: int) -> None:
        if not self.ready:
            self._resize()
        hashed = self.hashed(digest)
        if hashed in self.filter:
            known = self.keys.get(digest)
            if known and known[0] == length:
                top = max((known[1:3], (doc_id, row)), key=lambda t: _rank(*t))
                self.keys[digest] = length, *top, known[3] + copies
                return
            self.false_hits += 1
        self.keys[digest] = length, doc_id, row, copies
        if not self.filter.insert(hashed):
            self.resizes += 1
            self._resize()

    def delete(self, digest: bytes, length: int, doc_id: int | None) -> None:
        """Forget a digest if ``doc_id`` is its live document."""
        if not self.ready:
            self._resize()
        hashed = self.hashed(digest)
        if hashed in self.filter:
            known = self.keys.get(digest)
            if known and known[:2] == (length, doc_id):
                del self.keys[digest]
                self.filter.delete(hashed)
            elif not known:
                self.false_hits += 1


def digests(docs: DataFrame) -> DataFrame:
    """``digest, length, doc_id, row`` of every document, written; ``row`` tells repeated rows apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return stage(
        docs.select(
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.octet_length(text).cast("long").alias("length"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text that a task met, so that frequent texts are few rows in the shuffle."""
    met: dict[tuple[bytes, int], list] = {}

    def flush() -> pa.RecordBatch:
        columns = [[k[0] for k in met], [k[1] for k in met], *([v[c] for v in met.values()] for c in range(3))]
        kinds = [pa.binary(), *[pa.int64()] * 4]
        names = ["digest", "length", "doc_id", "row", "copies"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        for digest, length, doc_id, row in zip(*(batch.column(c).to_pylist() for c in ("digest", "length", "doc_id", "row")), strict=True):
            known = met.get((digest, length))
            if known is None:
                met[digest, length] = [doc_id, row, 1]
            else:
                known[2] += 1
                if _rank(doc_id, row) > _rank(known[0], known[1]):
                    known[:2] = doc_id, row
        if len(met) >= COMBINED:
            yield flush()
            met.clear()
    if met:
        yield flush()


class LiveIndex:
    """The live documents of a corpus, one per text, in buckets; every update is a new written version.

    ``bits`` front bits of a digest name its bucket.  Versions stay in the shared
    folder until its own retention removes them, so a job that lost its
    executors, or its driver, goes on from the last one.
    """

    def __init__(self, spark: SparkSession, state: DataFrame | None = None, bits: int = 0, fingerprint_bits: int = 16):
        self.spark, self.bits, self.fingerprint_bits = spark, bits, fingerprint_bits
        self.state = state if state is not None else spark.createDataFrame([], _STATE)

    def live(self) -> DataFrame:
        """``digest, length, doc_id, row, copies`` of each live text."""
        return self.state.where(F.col("kind") == _KEY).select("digest", "length", "doc_id", "row", "copies")

    def statistics(self) -> DataFrame:
        """``bucket, slots, false_hits, resizes`` of the last update."""
        kept = self.state.where(F.col("kind") == _FILTER)
        return kept.select("bucket", (F.octet_length("filter") / 2).cast("long").alias("slots"), "false_hits", "resizes")

    def update(self, inserts: DataFrame | None = None, deletes: DataFrame | None = None) -> LiveIndex:
        """The index after deleting, then inserting the rows of ``digests``.

        A deleted document that is live makes its text unknown again; copies that
        went before it do not come back.  One that is not live changes nothing.
        Of an inserted text that is live already the document with the larger id
        stays, and ``copies`` adds up.
        """
        added = inserts.mapInArrow(_combine, "digest binary, length long, doc_id long, row long, copies long") if inserts is not None else None
        rows = self.live().count() + (inserts.count() if inserts is not None else 0)
        bits = max(self.bits, math.ceil(math.log2(max(1, rows / BUCKET_KEYS))))
        front = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
        bucket = F.shiftright(front, 32 - bits)

        parts = [self.live().select(bucket.alias("bucket"), F.lit(_KEY).alias("kind"), "digest", "length", "doc_id", "row", "copies", F.lit(None).cast("binary").alias("filter"))]
        if bits == self.bits:
            parts.append(self.state.where(F.col("kind") == _FILTER).select(*[c.split()[0] for c in _ROW.split(", ")]))
        empty = [F.lit(None).cast("binary").alias("filter")]
        if deletes is not None:
            parts.append(deletes.select(bucket.alias("bucket"), F.lit(_DELETE).alias("kind"), "digest", "length", "doc_id", "row", F.lit(1).cast("long").alias("copies"), *empty))
        if added is not None:
            parts.append(added.select(bucket.alias("bucket"), F.lit(_INSERT).alias("kind"), "digest", "length", "doc_id", "row", "copies", *empty))
        changes = parts[0]
        for part in parts[1:]:
            changes = changes.unionByName(part)
        fingerprint_bits = self.fingerprint_bits

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, now = None, Bucket(fingerprint_bits)
            filtered = False
            for batch in batches:
                columns = (batch.column(c.split()[0]).to_pylist() for c in _ROW.split(", "))
                for bucket, kind, digest, length, doc_id, row, copies, table in zip(*columns, strict=True):
                    if bucket != number:
                        if number is not None:
                            yield from _saved(number, now)
                        number, now, filtered = bucket, Bucket(fingerprint_bits), False
                    if kind == _FILTER:
                        now.load_filter(table)
                        filtered = True
                    elif kind == _KEY:
                        now.load_key(digest, length, doc_id, row, copies, filtered)
                    elif kind == _DELETE:
                        now.delete(digest, length, doc_id)
                    else:
                        now.insert(digest, length, doc_id, row, copies)
            if number is not None:
                yield from _saved(number, now)

        dealt = changes.repartition("bucket").sortWithinPartitions("bucket", "kind")
        return LiveIndex(self.spark, stage(dealt.mapInArrow(work, _STATE), "live-index"), bits, fingerprint_bits)


def _saved(number: int, bucket: Bucket) -> Iterator[pa.RecordBatch]:
    if not bucket.ready:
        bucket._resize()
    keys = list(bucket.keys.items())
    rows = [(number, _FILTER, None, None, None, None, None, bucket.filter.table.tobytes(), bucket.false_hits, bucket.resizes)]
    rows += [(number, _KEY, digest, *known, None, None, None) for digest, known in keys]
    kinds = [pa.int64(), pa.int32(), pa.binary(), *[pa.int64()] * 4, pa.binary(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in _STATE.split(", ")]
    for low in range(0, len(rows), 20_000):
        part = zip(*rows[low : low + 20_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(part, kinds, strict=True)], names=names)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs``.

    Texts are equal when identical, a missing one counts as empty.  Of equal
    texts the row with the largest id stays, a row without id only if no other
    has one; of rows that repeat an id and a text exactly one stays.  Texts are
    told apart by SHA-256 and length.  Other columns are ignored; no rows give
    no rows.

    Copies are combined in the task that reads them, so a text with a third of
    all rows reaches its bucket as a few rows.  The decision is joined back by
    digest; texts without copies need no partner there.
    """
    rows = digests(docs)
    index = LiveIndex(docs.sparkSession).update(inserts=rows)
    groups = index.live().where("copies > 1").select(
        "digest", "length", F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "copies"
    )
    single = F.col("copies").isNull()
    return rows.join(groups, ["digest", "length"], "left").select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("_id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col("row") == F.col("_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
