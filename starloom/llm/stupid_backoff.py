"""Stupid-backoff scores of documents from bigram counts of all other documents."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import word_hash, words_of
from starloom.sources.staging import stage

ALPHA = 0.4
VOCABULARY = 1e-5  # share of all tokens that a word of the vocabulary, which is broadcast, has
HEAD = 1e-3  # share of a head word; bigrams of two head words (or the unknown one) are counted apart
LEAST = 2  # occurrences of a word of the vocabulary
BUCKET_ROWS = 2_000_000
_CHUNK = 500_000
_FLUSH = 400_000
_SENT = "bucket int, chunk long, rids binary, keys binary, doc binary, n binary, own binary, other binary, side binary"
_UNIT = 1e6  # log scores are summed in whole millionths, so that sums do not depend on order


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: Counter = Counter()

    def counts() -> pd.DataFrame:
        return pd.DataFrame({"word": list(seen), "n": np.fromiter(seen.values(), np.int64, len(seen))})

    for batch in batches:
        for text in batch["text"]:
            seen.update(words_of(text))
            if len(seen) > _FLUSH:
                yield counts()
                seen.clear()
    yield counts()


class Vocabulary:
    """Word numbers by falling frequency from 1, and the counts of all.

    Other words are 0, one unknown word, or, if ``whole``, negative numbers by
    their hashes; 0 is then no word.
    """

    def __init__(self, words: list[tuple[str, int]], total: int, whole: bool = False):
        self.whole = whole
        words = sorted(words, key=lambda w: (-w[1], w[0]))
        self.number = {w: k for k, (w, _) in enumerate(words, 1)}
        self.counts = np.array([total - sum(n for _, n in words), *(n for _, n in words)], np.int64)
        self.total = total
        self.head = 1 + sum(n >= HEAD * total for _, n in words)  # numbers below this are head words

    def ids(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        if self.whole:
            get = self.number.get
            return np.fromiter((get(w) or ~(word_hash(w) >> 1) for w in words), np.int64, len(words))
        return np.fromiter(map(self.number.get, words, repeat(0)), np.int64, len(words))

    def is_head(self, ids: np.ndarray) -> np.ndarray:
        return (ids >= 0) & (ids < self.head)

    def log_scores(self, v, w, others, own_v, own_w) -> np.ndarray:
        """ln S(w | v) in millionths, from counts without the document itself."""
        seen = others > 0
        high = np.log(np.where(seen, others, 1)) - np.log(np.maximum(self.counts[v] - own_v, 1))
        return np.round(_UNIT * np.where(seen, high, math.log(ALPHA) + self.log_unigram(w, own_w))).astype(np.int64)

    def log_unigram(self, w, own_w) -> np.ndarray:
        """ln of the share of a word in all tokens; ALPHA of one occurrence if no other document has it."""
        return self.log_share(self.counts[w] - own_w)

    def log_share(self, others) -> np.ndarray:
        return np.log(np.where(others > 0, others, ALPHA)) - math.log(max(self.total, 1))

    def log_tail_scores(self, tail, other, side, n, own_tail, own_other) -> tuple[np.ndarray, np.ndarray]:
        """Scores in millionths, and bigrams seen elsewhere, of all entries of some words outside the vocabulary.

        Every occurrence of such a word is the left side (0) of one entry, so
        the entries hold its count too.  A bigram of two such words has an entry
        with each: the left word's has the score if it is seen, the right word's
        if it is not.
        """
        _, word = np.unique(tail, return_inverse=True)
        left = side == 0
        rest = np.bincount(word, weights=np.where(left, n, 0)).astype(np.int64)[word] - own_tail
        _, pair = np.unique(_pair(tail, other) ^ side.astype(np.int64), return_inverse=True)
        others = np.bincount(pair, weights=n).astype(np.int64)[pair] - n
        seen, known = others > 0, other > 0
        partner = self.counts[np.where(known, other, 0)] - own_other
        high = np.log(np.where(seen, others, 1)) - np.log(np.maximum(np.where(left, rest, partner), 1))
        low = math.log(ALPHA) + self.log_share(np.where(left, partner, rest))
        score = np.where(seen, np.where(left | known, high, 0), np.where(~left | known, low, 0))
        # 0 on the left is the start of a text, on the right its end.
        score = np.where(other == 0, np.where(left, 0, self.log_share(rest)), score)
        return np.round(_UNIT * score).astype(np.int64) * n, np.where(seen & ((other != 0) & left | known), n, 0)


def vocabulary(docs: DataFrame, whole: bool = False) -> Vocabulary:
    """The words with at least ``VOCABULARY`` of all tokens: at most 1 / VOCABULARY of them, at any size."""
    counted = docs.select("text").mapInPandas(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = stage(counted, "words")
    total = counted.agg(F.sum("n")).first()[0] or 0
    common = counted.where(F.col("n") >= max(LEAST, math.ceil(VOCABULARY * total)))
    return Vocabulary([(r.word, r.n) for r in common.collect()], total, whole)


def bigrams(ids: np.ndarray):
    """Distinct bigrams of the vocabulary as numbers, their counts, and the counts of both words in the document."""
    known = (ids[:-1] >= 0) & (ids[1:] >= 0)
    keys, n = np.unique((ids[:-1][known] << 32) | ids[1:][known], return_counts=True)
    words, often = np.unique(ids, return_counts=True)
    own_v = often[np.searchsorted(words, keys >> 32)]
    own_w = often[np.searchsorted(words, keys & 0xFFFFFFFF)]
    return keys, n, own_v, own_w


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit hashes of ordered pairs, even numbers."""
    x = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x = (x + right.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return (x << np.uint64(1)).astype(np.int64)


def tail_entries(ids: np.ndarray):
    """Entries of the negative words of a text: word, other word or 0, side, count, counts of both in the text."""
    v, w = np.concatenate([[0], ids]), np.concatenate([ids, [0]])
    used = (v < 0) | (w < 0)
    v, w = v[used], w[used]
    _, first, n = np.unique(_pair(v, w), return_index=True, return_counts=True)
    v, w = v[first], w[first]
    words, often = np.unique(ids, return_counts=True)
    own = lambda x: np.where(x == 0, 0, often[np.minimum(np.searchsorted(words, x), len(words) - 1)])
    left, right = v < 0, w < 0
    tail, other = np.concatenate([v[left], w[right]]), np.concatenate([w[left], v[right]])
    side = np.repeat(np.array([0, 1], np.uint8), [left.sum(), right.sum()])
    return tail, other, side, np.concatenate([n[left], n[right]]), own(tail), own(other)


def _pack(packer, numbers: np.ndarray) -> bytes:
    return packer.compress(np.ascontiguousarray(numbers).tobytes())


def _mix(keys: np.ndarray) -> np.ndarray:
    x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)


def score_documents(docs: DataFrame, whole: bool = False) -> DataFrame:
    """Stupid-backoff log scores of every document under a bigram model of all the others.

    S(w | v) = c(v w) / c(v) if other documents have the bigram, else
    ALPHA * c(w) / N, and ALPHA ** 2 / N if they lack the word too; the first
    word has c(w) / N.  All counts leave the scored document out, but N, the
    number of all tokens.

    With ``whole`` every word has counts of its own, however rare; otherwise the
    words outside the vocabulary count as one.

    1. Words are counted over all documents.  Those with a fixed share of the
       tokens are the vocabulary, whose size that share bounds; it is broadcast.
       The other words' counts stay in the buckets: a bigram with one goes to the
       bucket of that word's hash (of both, if both are such words), where all
       its occurrences meet.
    2. Bigrams of two head words, the only ones that can hold more than HEAD of
       all bigrams, are summed where they are read; their table has at most
       (1 / HEAD + 1) ** 2 numbers and is broadcast.
    3. Every task explodes its documents into the other distinct bigrams with
       their counts and sends them, packed by chunks of documents, to the bucket
       of the bigram's hash.  A bigram has one entry per document.
    4. A bucket sums its counts, joins them to its entries and returns partial
       scores, packed by chunk.  Head bigrams are scored where the document is.
    5. Partial scores, whole millionths, are summed per document.

    A missing text is empty and has score 0 and mean 0.  A row repeated with
    its id and text is a document of its own and gets the same score.  Rows
    without id are scored too.  Other columns are ignored.  No documents, no rows.

    Returns ``doc_id, n_tokens, log_score, mean_log_score, seen_share``.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("rid", F.xxhash64("doc_id", "text"))
    spark = docs.sparkSession
    words = vocabulary(rows, whole)
    buckets = max(math.ceil(words.total / BUCKET_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    shared = spark.sparkContext.broadcast(words)

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = shared.value
        head = np.zeros((v.head, v.head), np.int64)
        for batch in batches:
            for text in batch["text"]:
                ids = v.ids(text)
                both = v.is_head(ids[:-1]) & v.is_head(ids[1:])
                np.add.at(head, (ids[:-1][both], ids[1:][both]), 1)
        left, right = np.nonzero(head)
        yield pd.DataFrame({"key": (left << 32) | right, "n": head[left, right]})

    common = rows.select("text").mapInPandas(heads, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    table = np.zeros((words.head, words.head), np.int64)
    for r in common.collect():  # at most words.head ** 2 rows
        table[r.key >> 32, r.key & 0xFFFFFFFF] = r.n

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v, packer = shared.value, zstandard.ZstdCompressor(level=1)
        held, size = [], 0

        def chunk() -> pd.DataFrame:
            rid = np.array([h[0] for h in held], np.int64)
            name = xxhash.xxh64_intdigest(rid.tobytes()) >> 1
            doc = np.repeat(np.arange(len(held), dtype=np.uint32), [len(h[1]) for h in held])
            keys, n, own_v, own_w = (np.concatenate([h[k] for h in held]) for k in range(1, 5))
            place = (_mix(keys) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((keys, place))
            place, keys, doc = place[order], keys[order], doc[order]
            counts = np.stack([n[order], own_v[order], own_w[order]]).astype(np.uint32)
            cuts = np.flatnonzero(np.diff(place)) + 1
            # The ids of the chunk's documents go along once; elsewhere a document is its number in the chunk.
            out = [(name % buckets, name, rid.tobytes(), *[None] * 6)]
            for low, high in zip([0, *cuts], [*cuts, len(place)], strict=True) if len(place) else ():
                step = np.diff(keys[low:high], prepend=0)
                out.append((
                    int(place[low]), name, None, _pack(packer, step), _pack(packer, doc[low:high]),
                    _pack(packer, counts[0, low:high]), _pack(packer, counts[1:, low:high]), None, None,
                ))
            doc = np.repeat(np.arange(len(held), dtype=np.uint32), [len(h[5]) for h in held])
            tail, other, side, n, own_t, own_o = (np.concatenate([h[k] for h in held]) for k in range(5, 11))
            place = (_mix(tail) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((doc, tail, place))
            place, tail, doc, other, side = place[order], tail[order], doc[order], other[order], side[order]
            counts = np.stack([n[order], own_t[order], own_o[order]]).astype(np.uint32)
            cuts = np.flatnonzero(np.diff(place)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(place)], strict=True) if len(place) else ():
                out.append((
                    int(place[low]), name, None, _pack(packer, np.diff(tail[low:high], prepend=0)), _pack(packer, doc[low:high]),
                    _pack(packer, counts[0, low:high]), _pack(packer, counts[1:, low:high]),
                    _pack(packer, other[low:high]), _pack(packer, side[low:high]),
                ))
            return pd.DataFrame(out, columns=[c.split()[0] for c in _SENT.split(", ")])

        for batch in batches:
            for rid, text in zip(batch["rid"], batch["text"], strict=True):
                ids = v.ids(text)
                keys, n, own_v, own_w = bigrams(ids)
                rest = ((keys >> 32) >= v.head) | ((keys & 0xFFFFFFFF) >= v.head)
                tail = tail_entries(ids)
                if rest.any() or len(tail[0]):
                    held.append((rid, keys[rest], n[rest], own_v[rest], own_w[rest], *tail))
                    size += int(rest.sum()) + len(tail[0])
                if size >= _CHUNK:
                    yield chunk()
                    held, size = [], 0
        if held:
            yield chunk()

    sent = rows.select("rid", "text").mapInPandas(explode, _SENT)
    shared_table = spark.sparkContext.broadcast(table)

    def bucket(frame: pd.DataFrame) -> pd.DataFrame:
        v, opener, packer = shared.value, zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        get = lambda data, kind: np.frombuffer(opener.decompress(data), kind)
        out = [(r.chunk, r.rids, None, None, None) for r in frame.itertuples(index=False) if r.rids is not None]

        def send(parts, score, seen) -> None:
            low = 0
            for r in parts:
                doc = get(r.doc, np.uint32)
                used, place = np.unique(doc, return_inverse=True)
                sums = np.zeros((2, len(used)), np.int64)
                np.add.at(sums[0], place, score[low : low + len(doc)])
                np.add.at(sums[1], place, seen[low : low + len(doc)])
                low += len(doc)
                out.append((r.chunk, None, _pack(packer, np.diff(used, prepend=np.uint32(0))), _pack(packer, sums[0]), _pack(packer, sums[1])))

        parts = [r for r in frame.itertuples(index=False) if r.rids is None and r.other is None]
        if parts:
            keys = np.concatenate([np.cumsum(get(r.keys, np.int64)) for r in parts])
            n = np.concatenate([get(r.n, np.uint32) for r in parts]).astype(np.int64)
            _, place = np.unique(keys, return_inverse=True)
            others = np.bincount(place, weights=n).astype(np.int64)[place] - n
            del place
            own = np.concatenate([get(r.own, np.uint32).reshape(2, -1) for r in parts], axis=1)
            score = v.log_scores(keys >> 32, keys & 0xFFFFFFFF, others, own[0], own[1]) * n
            seen = np.where(others > 0, n, 0)
            send(parts, score, seen)
        parts = [r for r in frame.itertuples(index=False) if r.other is not None]
        if parts:
            tail = np.concatenate([np.cumsum(get(r.keys, np.int64)) for r in parts])
            n = np.concatenate([get(r.n, np.uint32) for r in parts]).astype(np.int64)
            own = np.concatenate([get(r.own, np.uint32).reshape(2, -1) for r in parts], axis=1).astype(np.int64)
            other = np.concatenate([get(r.other, np.int64) for r in parts])
            side = np.concatenate([get(r.side, np.uint8) for r in parts])
            send(parts, *v.log_tail_scores(tail, other, side, n, own[0], own[1]))
        return pd.DataFrame(out, columns=["chunk", "rids", "doc", "score", "seen"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        opener = zstandard.ZstdDecompressor()
        get = lambda data, kind: np.frombuffer(opener.decompress(data), kind)
        rid = np.frombuffer(next(r for r in frame["rids"] if r is not None), np.int64)
        sums = np.zeros((2, len(rid)), np.int64)
        for r in frame.itertuples(index=False):
            if r.rids is None:
                doc = np.cumsum(get(r.doc, np.uint32))
                sums[0, doc] += get(r.score, np.int64)
                sums[1, doc] += get(r.seen, np.int64)
        return pd.DataFrame({"rid": rid, "score": sums[0], "seen": sums[1]})

    partial = sent.groupBy("bucket").applyInPandas(bucket, "chunk long, rids binary, doc binary, score binary, seen binary")
    tail = partial.groupBy("chunk").applyInPandas(merge, "rid long, score long, seen long")

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v, counts = shared.value, shared_table.value
        for batch in batches:
            out = []
            for text in batch["text"]:
                ids = v.ids(text)
                if not len(ids):
                    out.append((0, 0, 0))
                    continue
                keys, n, own_v, own_w = bigrams(ids)
                left, right = keys >> 32, keys & 0xFFFFFFFF
                both = v.is_head(left) & v.is_head(right)
                left, right, n = left[both], right[both], n[both]
                others = counts[left, right] - n
                score = v.log_scores(left, right, others, own_v[both], own_w[both]) * n
                # The buckets score a first word outside the vocabulary.
                start = int(np.round(_UNIT * v.log_unigram(ids[:1], (ids == ids[0]).sum())[0])) if ids[0] >= 0 else 0
                out.append((len(ids), int(score.sum()) + start, int((n * (others > 0)).sum())))
            made = pd.DataFrame(out, columns=["n_tokens", "score", "seen"])
            yield made.assign(rid=batch["rid"].to_numpy(), doc_id=batch["doc_id"].astype("Int64").array)

    # Ids as text: a nullable number would pass through a double.
    own = rows.select(F.col("doc_id").cast("string"), "text", "rid").mapInPandas(
        local, "n_tokens long, score long, seen long, rid long, doc_id long"
    )
    own = stage(own, "heads")
    sums = tail.groupBy("rid").agg(F.sum("score").alias("t_score"), F.sum("seen").alias("t_seen"))
    same = own.groupBy("rid").agg(F.count(F.lit(1)).alias("times"))
    # Rows equal in id and text share a sum.
    sums = sums.join(same.where("times > 1"), "rid", "left").select(
        "rid",
        F.expr("t_score div coalesce(times, 1)").alias("t_score"),
        F.expr("t_seen div coalesce(times, 1)").alias("t_seen"),
    )
    whole = own.join(sums, "rid", "left")
    score = (F.col("score") + F.coalesce("t_score", F.lit(0))) / F.lit(_UNIT)
    pairs = F.col("n_tokens") - 1
    return whole.select(
        "doc_id",
        "n_tokens",
        score.alias("log_score"),
        F.when(F.col("n_tokens") > 0, score / F.col("n_tokens")).otherwise(0.0).alias("mean_log_score"),
        F.when(pairs > 0, (F.col("seen") + F.coalesce("t_seen", F.lit(0))) / pairs).otherwise(0.0).alias("seen_share"),
    )
