"""I-Match fingerprints: terms of a document-frequency band, hashed over randomised lexicons."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import word_hash, words_of

RAREST, COMMONEST = 1e-3, 0.1  # share of documents that a term of the lexicon is in
LEAST_DOCS = 2
RATES = (2, 4, 6, 8, 10)  # a lexicon of rate r keeps a term with probability 2 ** -r
LEXICONS = 12  # lexicons of each rate
WIDTH = 6  # hexadecimal digits of a lexicon's hash
WHOLE = 16  # of the hash over the whole lexicon, in front
EMPTY = "-" * WIDTH
_FLUSH = 400_000
_SENT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def term_hashes(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the terms of a whole text."""
    terms = set(words_of(text))
    return np.sort(np.fromiter(map(word_hash, terms), np.uint64, len(terms)))


def _count_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: Counter = Counter()

    def counts() -> pd.DataFrame:
        hashes = np.fromiter(map(word_hash, seen), np.uint64, len(seen))
        return pd.DataFrame({"term": hashes.view(np.int64), "docs": np.fromiter(seen.values(), np.int64, len(seen))})

    for batch in batches:
        for text in batch["text"]:
            seen.update(set(words_of(text)))
            if len(seen) > _FLUSH:
                yield counts()
                seen.clear()
    yield counts()


def lexicon(docs: DataFrame) -> np.ndarray:
    """Hashes of the terms whose inverse document frequency is within the band, over all documents.

    A document with d distinct terms adds d to all document frequencies, so at
    most (mean of d) / RAREST terms are this frequent, however many documents
    there are: that bounds what comes to the driver and what is broadcast.
    """
    counted = docs.select("text").mapInPandas(_count_terms, "term long, docs long")
    total = docs.count()
    found = counted.groupBy("term").agg(F.sum("docs").alias("docs"))
    band = found.where((F.col("docs") >= max(LEAST_DOCS, RAREST * total)) & (F.col("docs") <= max(LEAST_DOCS, COMMONEST * total)))
    return np.sort(band.select("term").toPandas()["term"].to_numpy(np.int64).view(np.uint64))


class Fingerprints:
    """Fingerprints over a fixed lexicon."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        self.member = np.zeros((len(terms), len(RATES) * LEXICONS), bool)
        for k in range(self.member.shape[1]):
            mixed = (terms ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(31)
            mixed *= np.uint64(0x94D049BB133111EB)
            self.member[:, k] = mixed >> np.uint64(64 - RATES[k // LEXICONS]) == 0

    def of(self, text: str | None) -> str:
        """The hash over all lexicon terms of a text, then one per random lexicon ("------" if it has none).

        A text without lexicon terms has the hash over all its terms instead.
        """
        hashes = term_hashes(text)
        at = np.searchsorted(self.terms, hashes)
        at[at == len(self.terms)] = 0
        at = at[self.terms[at] == hashes] if len(self.terms) else at[:0]
        whole = xxhash.xxh64_hexdigest((self.terms[at] if len(at) else hashes).tobytes())
        member, kept, parts = self.member[at], self.terms[at], []
        some = member.any(axis=0)
        for k in range(member.shape[1]):
            parts.append(xxhash.xxh64_hexdigest(kept[member[:, k]].tobytes())[:WIDTH] if some[k] else EMPTY)
        return whole + "".join(parts)


def likeness(a: str, b: str) -> float:
    """Share of equal lexicon hashes, 0 to 1.

    Lexicons that are empty in both do not count.  A sparse lexicon stands for
    more of the terms it was drawn from and counts as many times more.
    """
    if a[:WHOLE] == b[:WHOLE]:
        return 1.0
    same = some = 0
    for k in range(len(RATES) * LEXICONS):
        x, y = (t[WHOLE + k * WIDTH : WHOLE + (k + 1) * WIDTH] for t in (a, b))
        if x != EMPTY or y != EMPTY:
            some += 1 << RATES[k // LEXICONS]
            same += (x == y) << RATES[k // LEXICONS]
    return same / some if some else 0.0


def edited_text(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first ones of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with the document after it.

    Documents are put into blocks of neighbouring ids, cut at about as many
    quantiles of the id as there are input partitions (the same order of
    driver memory as Spark's range partitioner).  The first document of a
    block also goes to the end of the block before it, so every document meets
    its successor; a task streams over its sorted rows and holds two of them.

    A missing text is empty.  Rows without id come first.  Repeated ids are
    ordered by a hash of the text.  The only document follows itself.  Other
    columns of ``docs`` are ignored.  No documents, no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    at = F.coalesce("doc_id", F.lit(-(1 << 63)))
    parts = 2 * rows.rdd.getNumPartitions()
    low, cuts = rows.select(at.alias("at")).agg(
        F.min("at"), F.percentile_approx("at", [k / parts for k in range(1, parts)] or [0.5], 20 * parts + 1_000)
    ).first()
    bounds = np.array(sorted({c for c in cuts or [] if c != low}), np.int64)
    shared = spark.sparkContext.broadcast((lexicon(rows), bounds))

    @F.pandas_udf("array<long>")
    def blocks(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        edges = shared.value[1]
        for one in ids:
            own = np.searchsorted(edges, one.to_numpy(np.int64), side="right")
            first = np.zeros(len(one), bool)
            first[own > 0] = edges[own[own > 0] - 1] == one.to_numpy(np.int64)[own > 0]
            head = one.to_numpy(np.int64) == low
            # Block 2 b holds block b; the extra copy has the odd number after the block it ends.
            yield pd.Series(
                [[2 * b, 2 * b - 1] if f else [2 * b, 2 * len(edges) + 1] if h else [2 * b] for b, f, h in zip(own, first, head, strict=True)]
            )

    dealt = rows.withColumn("at", at).withColumn("place", F.explode(blocks("at"))).withColumn("block", F.shiftright("place", 1))
    order = ["block", "place", "at", "tie"]
    placed = dealt.withColumn("tie", F.xxhash64("text")).repartition(max(1, len(bounds) + 1), "block").sortWithinPartitions(*order)

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        prints = Fingerprints(shared.value[0])
        last = None  # block, extra copy, id, text, fingerprint
        out: list[tuple] = []
        for batch in batches:
            for doc_id, text, block, place in batch.itertuples(index=False):
                extra = place & 1
                if last is None or last[0] != block or not last[1]:
                    own = prints.of(text)
                    if last is not None and last[0] == block:
                        out.append(pair(prints, last, text, own))
                    last = (block, extra, doc_id, text, own)
            yield frame(out)
            out = []
        yield frame(out)

    def pair(prints: Fingerprints, last: tuple, text: str, own: str) -> tuple:
        edited = edited_text(last[3], text)
        print_ = prints.of(edited)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        doc_id = None if pd.isna(last[2]) else int(last[2])
        return doc_id, len(last[3]), sha, last[4], print_, likeness(last[4], print_), likeness(last[4], own)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        made = pd.DataFrame(rows, columns=[c.split()[0] for c in _SENT.split(", ")], dtype=object)
        kinds = {"n_chars": "int64", "near_edited": "float64", "near_next": "float64"}
        return made.astype(kinds).assign(doc_id=made["doc_id"].astype("Int64").array)

    # Ids as text: a nullable number would pass through a double.
    return placed.select(F.col("doc_id").cast("string"), "text", "block", "place").mapInPandas(stream, _SENT)
