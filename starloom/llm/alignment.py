"""Alignment of two tokenizers over a corpus, with counts of the id pairs that meet.

Documents are encoded once and their ids written.  A first pass aligns them
and counts, in each task, in how many of its documents a pair of ids is linked.
The distinct pairs get a minimal perfect hash, so that counts are dense vectors
without keys, summed up a tree.  The pairs themselves stand in the order of the
hash and verify every look-up.  A second pass aligns the documents again and
looks the counts up.
"""

from __future__ import annotations

import itertools
import json
import math
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.sources.staging import stage

UNITS = 300_000  # units of text a Python worker remembers
PAIRS_AT_ONCE = 4_000_000  # pairs whose counts are sent around together, 17 bytes each
_BYTES = 4_000_000  # of text aligned at a time
_HELD = 2_000_000  # pair counts a task holds before it returns them
_BUCKET = 1 << 16  # pairs hashed by one task
_CHUNK = 1 << 17  # counts a row of a vector
_FAN = 8  # vectors summed by one task
_LOAD = 2.0  # bits a pair at each level of the hash
_ENCODED = "doc_id long, a binary, b binary"
_COUNTED = "a long, b long, n long"
_HASHED = "bucket int, sizes binary, bits binary, pairs binary"
_VECTOR = "chunk int, node int, counts binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
# Fixed value: the pattern by which byte-level vocabularies split texts.
_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Tokenizers:
    """Ids of texts in both vocabularies, as bytes.

    The byte-level side merges by rank, as its vocabulary is in the order of its
    merges (else its own library encodes).  The other side is encoded by units: a
    unit begins with a space or line feed that follows no white space and goes on
    up to the next one.  No piece has a space after another character or a line
    feed, so no token crosses such a place, and the ids of a text are those of
    its units, ``UNITS`` of which are remembered.  Where a vocabulary does not
    promise this, texts are encoded whole.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = _byte_alphabet()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(alphabet.get(c, 63) for c in t) for t in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.sizes = [np.array([len(t) for t in side], np.int64) for side in (self.bytes_a, self.bytes_b)]
        self.kinds = ["<u2" if len(side) <= 1 << 16 else "<u4" for side in (self.bytes_a, self.bytes_b)]
        self.ranked = self._by_rank(path_a)
        self.splits = not any(re.search("[^▁]▁|\n", p) for p in pieces)
        self.unit = re.compile(r"[ \n]\s*\S*(?:[^\S \n]\s*\S*)*")
        self.ahead = len(self.b.encode("a"))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes] = {}
        self.spoilt: set[str] = set()  # units whose token bytes are not those of the text

    def _by_rank(self, path: str):
        """The byte-level side as ranks, if its merges are in the order of its ids and it splits texts in the usual way."""
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        split, model = told.get("pre_tokenizer") or {}, told["model"]
        usual = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        if not usual or told.get("normalizer") or model.get("type") != "BPE":
            return None
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(set(merged)):
            return None
        import tiktoken

        special = {t["id"] for t in told.get("added_tokens", [])}
        ranks = {self.bytes_a[i]: i for i in model["vocab"].values() if i not in special}
        return tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def _ids_a(self, text: str) -> bytes:
        if self.ranked:
            return np.array(self.ranked.encode_ordinary(" " + text), self.kinds[0]).tobytes()
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        whole = b"".join([self.bytes_a[i] for i in ids]) == (" " + text).encode()
        return np.array(ids if whole else [], self.kinds[0]).tobytes()

    def _ids_b(self, text: str) -> bytes:
        """Ids of a text encoded whole; none where its bytes are not those of the text."""
        ids = self.b.encode(text)
        whole = b"".join([self.bytes_b[i] for i in ids]) == (" " + text).encode()
        return np.array(ids if whole else [], self.kinds[1]).tobytes()

    def learn(self, units: set[str]) -> None:
        """Encode the units that are new."""
        new = [u for u in units if u not in self.known]
        # A letter in front takes the place of the text before; its ids are cut off again.
        coded = [ids[self.ahead :] for ids in self.b.encode(["a" + u for u in new], num_threads=1)]
        flat = np.fromiter(itertools.chain.from_iterable(coded), np.int64)
        packed, size, at = flat.astype(self.kinds[1]).tobytes(), np.dtype(self.kinds[1]).itemsize, 0
        joined, place = b"".join([self.bytes_b[i] for i in flat.tolist()]), 0
        upto = np.concatenate([[0], np.cumsum(self.sizes[1][flat])])
        ends = upto[np.cumsum([len(ids) for ids in coded], dtype=np.int64)].tolist() if new else []
        for unit, ids, end in zip(new, coded, ends, strict=True):
            self.known[unit] = packed[size * at : size * (at + len(ids))]
            if joined[place:end] != unit.encode():
                self.spoilt.add(unit)
            at, place = at + len(ids), end

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[bytes]]:
        """Ids of both sides of each text; none where the bytes of a side are not those of a space and the text."""
        split = [self.unit.findall(" " + t) if t and self.splits else [] for t in texts]
        self.learn(set().union(*split))
        a, b = [], []
        for text, units in zip(texts, split, strict=True):
            if not text:
                one = other = b""
            else:
                one = self._ids_a(text)
                known = units and self.spoilt.isdisjoint(units)
                other = b"".join(map(self.known.__getitem__, units)) if known else self._ids_b(text)
            a.append(one if one and other else b"")
            b.append(other if one and other else b"")
        if len(self.known) > UNITS:
            self.forget()
        return a, b


_tokenizers: dict[tuple[str, str], Tokenizers] = {}


def _of_worker(path_a: str, path_b: str) -> Tokenizers:
    """The tokenizers of this Python worker, which keep what they met in earlier tasks."""
    if (path_a, path_b) not in _tokenizers:
        _tokenizers[path_a, path_b] = Tokenizers(path_a, path_b)
    return _tokenizers[path_a, path_b]


def _blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``_BYTES`` bytes."""
    first = total = 0
    for k, size in enumerate(sizes):
        total += size
        if total > _BYTES or k + 1 == len(sizes):
            yield first, k + 1
            first, total = k + 1, 0


def encode(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, a, b`` of every document, written: its ids on both sides, or none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _of_worker(path_a, path_b)
        for batch in batches:
            texts = batch.column("text")
            for low, high in _blocks(_lengths(texts)):
                a, b = tokenizers.encode(texts.slice(low, high - low).to_pylist())
                ids = batch.column("doc_id").slice(low, high - low)
                yield pa.RecordBatch.from_arrays([ids, pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["doc_id", "a", "b"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(rows.mapInArrow(work, _ENCODED), "ids", compression="zstd")


def _lengths(column: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


class Aligned:
    """Documents of a block aligned as one stream: each has the same bytes on both sides.

    The places where a token of either side ends cut the stream into stretches,
    and a stretch is the overlap of exactly one token of each side: a link.
    """

    def __init__(self, a: list[bytes], b: list[bytes], tokenizers: Tokenizers):
        sides = [np.frombuffer(b"".join(ids), kind).astype(np.int64) for ids, kind in zip((a, b), tokenizers.kinds, strict=True)]
        self.a, self.b = sides
        self.tokens = [
            np.array([len(i) for i in ids], np.int64) // np.dtype(kind).itemsize for ids, kind in zip((a, b), tokenizers.kinds, strict=True)
        ]
        ends = [np.cumsum(size[ids]) for size, ids in zip(tokenizers.sizes, sides, strict=True)]
        total = int(ends[0][-1]) if len(ends[0]) else 0
        marks = [np.zeros(total + 1, bool) for _ in ends]
        for mark, end in zip(marks, ends, strict=True):
            mark[end] = True
        self.stretch = np.flatnonzero(marks[0] | marks[1])
        before = [np.cumsum(mark, dtype=np.int32) for mark in marks]
        self.link_a, self.link_b = (ids[n[self.stretch - 1]] for ids, n in zip(sides, before, strict=True))
        shared = np.cumsum(marks[0] & marks[1], dtype=np.int32)
        self.group_a, self.group_b = (shared[end - 1] for end in ends)
        # Documents without tokens have no bytes, hence the same end as the one before.
        self.upto = np.concatenate([[0], ends[0]])[np.cumsum(self.tokens[0])]
        self.links = np.searchsorted(self.stretch, self.upto, "right")
        self.groups = shared[self.upto] if total else np.zeros(len(a), np.int64)

    def per_document(self, upto: np.ndarray) -> np.ndarray:
        return np.diff(upto, prepend=0)

    def document_of_links(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.links)), self.per_document(self.links))

    def text(self, digits: np.ndarray, width: np.ndarray) -> list[str]:
        """Groups of each document as text: decimal ids, ``,`` between those of a side, ``|`` and ``;`` after sides.

        ``digits`` has the ids in ASCII, one a row, ``width`` their lengths.
        """
        ids = np.concatenate([self.a, self.b])
        group = np.concatenate([self.group_a, self.group_b])
        side = np.repeat(np.array([0, 1], np.int8), [len(self.a), len(self.b)])
        order = np.argsort(group.astype(np.int64) * 2 + side, kind="stable")
        ids, group, side = ids[order], group[order], side[order]
        rows, size = digits[ids], width[ids]
        after = np.full(len(ids), ord(","), np.uint8)
        last = np.flatnonzero(np.diff(group * 2 + side, append=-1))
        after[last] = np.where(side[last] == 0, ord("|"), ord(";"))
        rows[np.arange(len(ids)), size] = after
        flat = rows[np.arange(rows.shape[1]) <= size[:, None]].tobytes()
        ends = np.concatenate([[0], np.cumsum(size + 1)])[np.cumsum(self.tokens[0] + self.tokens[1])].tolist()
        return [flat[low : max(low, high - 1)].decode() for low, high in zip([0, *ends], ends, strict=False)]


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of the numbers below ``n``, left-aligned with a byte to spare, and their lengths."""
    texts = [str(k).encode() for k in range(n)]
    wide = max(map(len, texts)) + 1
    return np.frombuffer(b"".join(t.ljust(wide) for t in texts), np.uint8).reshape(n, wide), np.array([len(t) for t in texts], np.int64)


def _aligned(batch: pa.RecordBatch, tokenizers: Tokenizers) -> Iterator[tuple[int, Aligned]]:
    """First row and alignment of runs of rows."""
    a, b = batch.column("a"), batch.column("b")
    for low, high in _blocks([2 * n for n in _lengths(a)]):
        yield low, Aligned(a.slice(low, high - low).to_pylist(), b.slice(low, high - low).to_pylist(), tokenizers)


def count_pairs(encoded: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """First pass: ``a, b, n``, pairs of ids linked in ``n`` documents of a task, written; a task may repeat a pair."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _of_worker(path_a, path_b)
        base = len(tokenizers.bytes_b)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            pairs, place = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            return pairs, np.bincount(place, np.concatenate([n for _, n in held]), len(pairs)).astype(np.int64)

        def rows(pairs: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for low in range(0, len(pairs), 100_000):
                p = pairs[low : low + 100_000]
                columns = [pa.array(p // base), pa.array(p % base), pa.array(n[low : low + 100_000])]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n"])

        for batch in batches:
            for _, block in _aligned(batch, tokenizers):
                in_document = block.document_of_links() * (len(tokenizers.bytes_a) * base) + block.link_a * base + block.link_b
                pairs = np.unique(in_document) % (len(tokenizers.bytes_a) * base)
                held.append(np.unique(pairs, return_counts=True))
                if sum(len(p) for p, _ in held) > _HELD:
                    held = [merged()]
                    if len(held[0][0]) > _HELD // 2:
                        yield from rows(*held.pop())
        if held:
            yield from rows(*merged())

    return stage(encoded.mapInArrow(count, _COUNTED), "pairs")


# Minimal perfect hash: levels of bits, on each of which the pairs alone at their bit stay.


def _mix(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """Hash of pairs for a level, as unsigned 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (a.astype(np.uint64) << np.uint64(32)) ^ b.astype(np.uint64)
        x += np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _bucket_number(a: np.ndarray, b: np.ndarray, buckets: int) -> np.ndarray:
    x = a * 1_000_003 + b * 7_919
    return (x ^ (x >> 15)) % buckets


def _bucket_column(buckets: int) -> F.Column:
    x = F.col("a") * 1_000_003 + F.col("b") * 7_919
    return F.pmod(x.bitwiseXOR(F.shiftright(x, 15)), F.lit(buckets)).cast("int")


def hash_bucket(a: np.ndarray, b: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Words per level, bits, and the order of the pairs, of a minimal perfect hash of distinct pairs."""
    sizes, words, order = [], [], []
    left = np.arange(len(a))
    while len(left):
        n = max(1, math.ceil(_LOAD * len(left) / 64))
        at = (_mix(a[left], b[left], len(sizes)) % np.uint64(64 * n)).astype(np.int64)
        alone = np.bincount(at, minlength=64 * n) == 1
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        sizes.append(n)
        stays = alone[at]
        order.append(left[stays][np.argsort(at[stays])])
        left = left[~stays]
        if len(sizes) > 200:
            raise ValueError("pairs to hash are not distinct")
    return sizes, np.concatenate(words) if words else np.zeros(0, np.uint64), np.concatenate(order) if order else left


class PairHash:
    """The number of a pair, from 0 without gaps, for the pairs it was built of."""

    def __init__(self, buckets: list[tuple[list[int], np.ndarray]]):
        self.buckets = len(buckets)
        levels = max((len(s) for s, _ in buckets), default=0)
        self.size = np.zeros((self.buckets, levels + 1), np.int64)  # words; 0: no such level
        for k, (sizes, _) in enumerate(buckets):
            self.size[k, : len(sizes)] = sizes
        flat = np.cumsum(self.size.ravel())
        self.begin = (flat - self.size.ravel()).reshape(self.size.shape)
        self.words = np.concatenate([w for _, w in buckets] or [np.zeros(0, np.uint64)])
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of each pair; of a pair outside any number, or -1."""
        out = np.full(len(a), -1, np.int64)
        left = np.arange(len(a)) if self.buckets else np.zeros(0, np.int64)
        bucket = _bucket_number(a, b, max(1, self.buckets))
        for level in range(self.size.shape[1]):
            size = self.size[bucket[left], level]
            left, size = left[size > 0], size[size > 0]
            if not len(left):
                break
            at = (_mix(a[left], b[left], level) % (64 * size).astype(np.uint64)).astype(np.int64)
            word = self.begin[bucket[left], level] + at // 64
            bit = (at % 64).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            lower = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (self.before[word] + np.bitwise_count(lower))[hit]
            left = left[~hit]
        return out


class PairCounts:
    """Documents per pair of ids, by perfect hash, verified by the pairs; and the highest count of each A id."""

    def __init__(self, hashed: PairHash, a: np.ndarray, b: np.ndarray, counts: np.ndarray):
        self.hashed, self.a, self.b, self.counts = hashed, a.astype(np.int32), b.astype(np.int32), counts
        self.best = np.zeros(int(a.max()) + 1 if len(a) else 1, np.int64)
        np.maximum.at(self.best, a, counts)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each pair (0: not counted), and whether none of its A id is higher."""
        k = self.hashed.numbers(a, b)
        if not len(self.counts):
            return np.zeros(len(a), np.int64), np.zeros(len(a), bool)
        there = (k >= 0) & (self.a[k] == a) & (self.b[k] == b)
        count = np.where(there, self.counts[k], 0)
        return count, there & (count == self.best[np.minimum(a, len(self.best) - 1)])


def _slices(pairs: DataFrame, at_once: int) -> list[tuple[int, int, int]]:
    """Ranges of A ids, with the number of their pairs, each of about ``at_once`` pairs at most.

    One row per A id comes to the driver: the vocabulary bounds it.
    """
    sizes = sorted((r.a, r.n) for r in pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).collect())
    out: list[tuple[int, int, int]] = []
    for a, n in sizes:
        if out and out[-1][2] + n <= at_once:
            out[-1] = (out[-1][0], a, out[-1][2] + n)
        else:
            out.append((a, a, n))
    return out


def _counts(counted: DataFrame, pairs: DataFrame, low: int, high: int, n: int) -> PairCounts:
    """Counts of the pairs with A ids from ``low`` to ``high``, ``n`` of them."""
    spark = counted.sparkSession
    buckets = max(1, math.ceil(n / _BUCKET))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = frame["a"].to_numpy(), frame["b"].to_numpy()
        sizes, words, order = hash_bucket(a, b)
        both = np.stack([a[order], b[order]]).astype("<i4").tobytes()
        return pd.DataFrame({
            "bucket": frame["_bucket"].iloc[:1], "sizes": [np.array(sizes, "<i4").tobytes()],
            "bits": [words.tobytes()], "pairs": [both],
        })

    mine = F.col("a").between(low, high)
    built = {
        r.bucket: r
        for r in pairs.where(mine).withColumn("_bucket", _bucket_column(buckets)).groupBy("_bucket").applyInPandas(build, _HASHED).collect()
    }
    levels = [
        (np.frombuffer(built[k].sizes, "<i4").tolist(), np.frombuffer(built[k].bits, np.uint64)) if k in built else ([], np.zeros(0, np.uint64))
        for k in range(buckets)
    ]
    hashed = PairHash(levels)
    both = [np.frombuffer(built[k].pairs, "<i4").reshape(2, -1) for k in sorted(built)]
    a, b = (np.concatenate([x[side] for x in both]).astype(np.int64) for side in (0, 1))
    sent = spark.sparkContext.broadcast(hashed)

    # A leaf adds up at least as many counts as its vector is long, so vectors are no larger than what they sum.
    rows = counted.where(mine).count()
    leaves = max(1, math.ceil(rows / max(1 << 18, n)))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(n, np.int64)
        for batch in batches:
            np.add.at(total, sent.value.numbers(batch["a"].to_numpy(), batch["b"].to_numpy()), batch["n"].to_numpy())
        for k in range(0, n, _CHUNK):
            part = total[k : k + _CHUNK]
            if part.any():
                yield pd.DataFrame({"chunk": [k // _CHUNK], "counts": [part.tobytes()]})

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in frame["counts"])
        return pd.DataFrame({"chunk": frame["chunk"].iloc[:1], "node": frame["node"].iloc[:1] // _FAN, "counts": [total.tobytes()]})

    vectors = counted.where(mine).coalesce(leaves).mapInPandas(add, "chunk int, counts binary")
    vectors = vectors.select("chunk", F.spark_partition_id().alias("node"), "counts")
    nodes = leaves
    while nodes > 1:
        vectors = vectors.withColumn("_above", F.expr(f"node div {_FAN}")).groupBy("chunk", "_above").applyInPandas(merge, _VECTOR)
        nodes = math.ceil(nodes / _FAN)
    counts = np.zeros(n, np.int64)
    for r in vectors.collect():
        part = np.frombuffer(r.counts, np.int64)
        counts[r.chunk * _CHUNK : r.chunk * _CHUNK + len(part)] += part
    sent.unpersist()
    return PairCounts(hashed, a, b, counts)


def _measure(rows: DataFrame, path_a: str, path_b: str, counts: PairCounts, first: bool, last: bool) -> DataFrame:
    """Second pass over encoded documents, which after the first slice have ``n_best, count_sum`` so far."""
    sent = rows.sparkSession.sparkContext.broadcast(counts)
    schema = RESULT if last else f"{_ENCODED}, n_best long, count_sum long"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _of_worker(path_a, path_b)
        base = len(tokenizers.bytes_b)
        digits, width = _digits(max(len(tokenizers.bytes_a), base))
        for batch in batches:
            for low, block in _aligned(batch, tokenizers):
                part = batch.slice(low, len(block.links))
                pairs, place = np.unique(block.link_a * base + block.link_b, return_inverse=True)
                count, best = sent.value.look_up(pairs // base, pairs % base)
                upto = [np.concatenate([[0], np.cumsum(found[place], dtype=np.int64)])[block.links] for found in (best, count)]
                sums = [block.per_document(u) for u in upto]
                if not first:
                    sums = [s + part.column(c).to_numpy(zero_copy_only=False) for s, c in zip(sums, ("n_best", "count_sum"), strict=True)]
                if last:
                    numbers = [*block.tokens, block.per_document(block.groups), block.per_document(block.links), *sums]
                    names = [c.split()[0] for c in RESULT.split(", ")]
                    text = pa.array(block.text(digits, width), pa.string())
                    columns = [part.column("doc_id"), *[pa.array(n.astype(np.int64)) for n in numbers], text]
                else:
                    names = ["doc_id", "a", "b", "n_best", "count_sum"]
                    columns = [*[part.column(c) for c in names[:3]], *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(measure, schema)


def align_documents(docs: DataFrame, path_a: str, path_b: str, pairs_at_once: int = PAIRS_AT_ONCE) -> DataFrame:
    """``RESULT`` per row of ``docs``: how tokenizers A (byte-level) and B (pieces) cut the text, and how common its links are.

    Both encode one space and the text, without special tokens.  ``groups`` is
    the alignment: ids of A, ``|`` and ids of B of each stretch between
    byte offsets where tokens of both end, joined by ``;``.  A link is a pair of
    token occurrences that share bytes; its count is the number of documents in
    which its ids are linked.  ``n_best`` links have the highest count of their
    A id, ``count_sum`` adds up the counts of all links.

    A text that is missing, empty, or not the joined bytes of its tokens on
    both sides has no tokens: zeros and empty groups.  Repeated rows and ids
    count as often as they occur, a missing id is kept, other columns are
    ignored; no rows give no rows.

    Counts of ``pairs_at_once`` pairs are broadcast at a time, 68 MB at the
    default.  Where the corpus has more, ranges of A ids follow each other, each
    with a pass of its own over the written ids.  The number of distinct
    pairs is bounded by the vocabularies, not by the documents.
    """
    rows = encode(docs, path_a, path_b)
    counted = count_pairs(rows, path_a, path_b)
    pairs = stage(counted.select("a", "b").distinct(), "distinct-pairs")
    slices = _slices(pairs, pairs_at_once) or [(0, 0, 0)]
    for k, (low, high, n) in enumerate(slices):
        if n:
            counts = _counts(counted, pairs, low, high, n)
        else:
            counts = PairCounts(PairHash([]), *[np.zeros(0, np.int64)] * 3)
        last = k + 1 == len(slices)
        rows = _measure(rows, path_a, path_b, counts, k == 0, last)
        if not last:
            rows = stage(rows, "measured")
    return rows
