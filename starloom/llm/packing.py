"""Mixture-controlled packing of token ids into fixed windows by deficit round-robin."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.sources.staging import stage

WINDOW = 2_048
LEAST_RUN = 64  # tokens of a queue that a window holds at least, so that its text can be read
END = 1  # id after every document
QUEUES = 16_384  # sources with queues of their own, those with the most tokens; others share
SHARED_QUEUES = 64
_RESOLUTION = 1 << 20  # integer weights add up to about this
_CACHE = 600_000
_DOCS = 1_000  # documents cut at a time
_STAGED = "part int, source string, doc_id long, at long, tokens long, ids binary"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


_PLAIN = re.compile(r"^([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)$", re.MULTILINE)  # letters, and marks but apostrophes
_MARK = "\x01"


class Encoder:
    """Token ids of whole texts, without special tokens added.

    The tokenizer splits at white space, so a text's ids are those of its
    pieces between spaces and line feeds, one after the other.  Pieces are kept
    in a dictionary of bounded size.  New ones that are a plain word, with
    a tail of punctuation or none, are encoded all at once by the rank of their
    merges, if the vocabulary is in the order of its merges: a mark behind each
    word and tail stands for the end of word and is merged first.  Others go to
    the tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.ranked, self.ends = self._by_rank(path)
        self.known: dict[str, bytes] = {}

    def _by_rank(self, path: str):
        """Merges as ranks, and which ids end a word; nothing for a vocabulary of another kind."""
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, steps = told["model"], [n.get("type") for n in (told.get("normalizer") or {}).get("normalizers", [])]
        suffix = model.get("end_of_word_suffix")
        if model.get("type") != "BPE" or not suffix or steps != ["NFC", "Replace", "Lowercase"]:
            return None, None
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(set(merged)):
            return None, None
        import tiktoken

        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        alphabet = {chr(b): b for b in plain}
        alphabet |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        special, ranks = {t["id"] for t in told.get("added_tokens", [])}, {}
        for token, i in model["vocab"].items():
            if i in special:
                continue
            whole = bytes(alphabet[c] for c in token.removesuffix(suffix)) if len(token) > len(suffix) else bytes(alphabet[c] for c in token)
            ranks[whole + (_MARK.encode() if token.endswith(suffix) and len(token) > len(suffix) else b"")] = i
        if len(ranks) != sum(i not in special for i in model["vocab"].values()) or any(ranks.get(bytes([b]), 256) > 255 for b in range(256)):
            return None, None
        ends = np.zeros(max(model["vocab"].values()) + 1, bool)
        ends[[i for w, i in ranks.items() if len(w) > 1 and w.endswith(_MARK.encode())]] = True
        return tiktoken.Encoding("ranks", pat_str=f"[^{_MARK}]+{_MARK}", mergeable_ranks=ranks, special_tokens={}), ends

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as unsigned little-endian numbers of ``kind``."""
        split = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        new = set().union(*split).difference(self.known)
        if new:
            if len(self.known) > _CACHE:
                self.known.clear()
                new = set().union(*split)
            self._learn(list(new))
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in split]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def _learn(self, pieces: list[str]) -> None:
        parts = _PLAIN.findall("\n".join(pieces)) if self.ranked else []
        if parts:
            marked = "".join([f"{word}{_MARK}{tail}{_MARK}" if tail else f"{word}{_MARK}" for word, tail in parts]).lower()
            flat = np.array(self.ranked.encode_ordinary(marked), np.int64)
            # A piece ends with its last word end.
            last = np.cumsum([2 if tail else 1 for _, tail in parts]) - 1
            upto = ((np.flatnonzero(self.ends[flat])[last] + 1) * np.dtype(self.kind).itemsize).tolist()
            packed = flat.astype(self.kind).tobytes()
            self.known.update({word + tail: packed[low:high] for (word, tail), low, high in zip(parts, [0, *upto], upto)})
        rest = [p for p in pieces if p not in self.known]
        for p, one in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.known[p] = np.array(one.ids, self.kind).tobytes()


def tokenize(docs: DataFrame, path: str) -> DataFrame:
    """Written ids of every document, in queues by source: ``_STAGED``.

    ``part`` is the task that made a row and ``at`` the number of tokens of the
    same source before it there.  Both are written with the ids, so the queues
    do not depend on how a later job splits its input.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, part, upto = Encoder(path), TaskContext.get().partitionId(), {}
        end = np.array([END], encoder.kind).tobytes()
        size = np.dtype(encoder.kind).itemsize
        for batch in (b.iloc[k : k + _DOCS] for b in batches for k in range(0, len(b), _DOCS)):
            ids = [i + end for i in encoder.encode_all(list(batch["text"]))]
            tokens = [len(i) // size for i in ids]
            at = []
            for source, n in zip(batch["source"], tokens, strict=True):
                at.append(upto.get(source, 0))
                upto[source] = at[-1] + n
            yield pd.DataFrame({
                "part": part, "source": batch["source"], "doc_id": batch["doc_id"].astype("Int64").array,
                "at": at, "tokens": tokens, "ids": ids,
            })

    rows = docs.select(
        # Ids as text: a nullable number would pass through a double.
        F.col("doc_id").cast("long").cast("string").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    return stage(rows.mapInPandas(encode, _STAGED), "ids")


class Line:
    """One line of tokens that the queues are served onto.

    Every queue has tokens and an integer weight and is served ``quantum`` tokens
    at a time.  Quantum c is due at 2 (c + phase) quantum / weight, when the
    queue's deficit since its last one has grown to a quantum; ties go by queue.
    The number of tokens before a quantum follows from counting for every queue how
    many were due earlier: the deficits at any place are known without serving
    what comes before, and partitions need nothing from each other.  An empty
    queue is counted as such, and the others fill its place.  Each window's tokens
    are put together queue by queue, so a queue has one run in a window.
    Due times are doubles, correctly rounded, hence equal in every task.
    """

    def __init__(self, tokens: np.ndarray, weights: np.ndarray, window: int = WINDOW, quantum: int = 1):
        self.tokens, self.weights, self.window = tokens.astype(np.int64), weights.astype(np.float64), window
        self.total, self.quantum, self.phase = int(self.tokens.sum()), quantum, np.full(len(tokens), 0.5)
        if quantum > 1:
            # Spread evenly, so that queues of like weight do not come due at once: multiples of the
            # golden ratio in 64ths, which doubles hold exactly, in the order of the weights.
            rank = np.empty(len(tokens))
            rank[np.lexsort((np.arange(len(tokens)), self.weights))] = np.arange(len(tokens))
            self.phase = (np.floor(rank * 0.6180339887498949 % 1 * 64) + 0.5) / 64
        self.rows = max(8, (1 << 18) // max(len(tokens), 1))
        self.known: dict[int, np.ndarray] = {}

    def due(self, time: np.ndarray) -> np.ndarray:
        """Tokens of every queue due at or before each time, one row per time."""
        n = np.maximum(np.floor(time[:, None] * self.weights / (2 * self.quantum) - self.phase + 1), 0)
        n += 2 * (n + self.phase) * self.quantum / self.weights <= time[:, None]
        n -= 2 * (n - 1 + self.phase) * self.quantum / self.weights > time[:, None]
        return np.minimum(np.maximum(n, 0).astype(np.int64) * self.quantum, self.tokens)

    def place(self, queue: np.ndarray, number: np.ndarray) -> np.ndarray:
        """How many tokens are before token ``number`` of ``queue`` (arrays)."""
        out = np.empty(len(queue), np.int64)
        index = np.arange(len(self.tokens))
        for low in range(0, len(queue), self.rows):
            q, c = queue[low : low + self.rows], number[low : low + self.rows]
            time = 2 * (c // self.quantum + self.phase[q]) * self.quantum / self.weights[q]
            before = np.where(index < q[:, None], self.due(time), self.due(np.nextafter(time, -1)))
            before[np.arange(len(q)), q] = c
            out[low : low + self.rows] = before.sum(axis=1)
        return out

    def borders(self, first: int) -> np.ndarray:
        """Tokens of every queue before windows ``first`` to ``first + rows``, one row per window."""
        before = np.minimum((first + np.arange(self.rows + 1)) * self.window, self.total)
        # The bits of positive doubles are in their order: the last time with no more tokens due than these.
        low = np.zeros(len(before), np.int64)
        latest = 2 * (self.tokens + self.quantum) / self.weights
        high = np.full(len(before), np.float64(latest.max() + 1).view(np.int64))
        while (high - low > 1).any():
            middle = low + (high - low) // 2
            fits = self.due(middle.view(np.float64)).sum(axis=1) <= before
            low, high = np.where(fits, middle, low), np.where(fits, high, middle)
        counts = self.due(low.view(np.float64))
        # Those due at one time come by queue; the border may cut the last quantum.
        more = np.cumsum(self.due(high.view(np.float64)) - counts, axis=1)
        more = np.minimum(more, (before - counts.sum(axis=1))[:, None])
        return counts + np.diff(more, axis=1, prepend=0)

    def windows(self, number: np.ndarray, queue: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First token of a queue in a window, the first after it, and where in the window they begin."""
        low, high, offset = (np.empty(len(number), np.int64) for _ in range(3))
        block = number // self.rows
        for b in np.unique(block).tolist():
            if b not in self.known:
                if len(self.known) >= 8:
                    self.known.pop(next(iter(self.known)))
                self.known[b] = self.borders(b * self.rows)
            here, border = np.flatnonzero(block == b), self.known[b]
            k, q = number[here] - b * self.rows, queue[here]
            size = np.diff(border, axis=0)
            low[here], high[here] = border[k, q], border[k + 1, q]
            offset[here] = (np.cumsum(size, axis=1) - size)[k, q]
        return low, high, offset

    def pieces(self, queue: np.ndarray, at: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, ...]:
        """Row numbers, starts in the document, lengths and places on the line of all pieces of documents (arrays)."""
        first, last = self.place(queue, at) // self.window, self.place(queue, at + tokens - 1) // self.window
        many = last - first + 1
        row = np.repeat(np.arange(len(queue)), many)
        number = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        low, high, offset = self.windows(number, queue[row])
        begin, end = np.maximum(low, at[row]), np.minimum(high, (at + tokens)[row])
        used = end > begin
        place = number * self.window + offset + begin - low
        return row[used], (begin - at[row])[used], (end - begin)[used], place[used]


class Mixture:
    """The line of all queues: large ones token by token, small ones by runs.

    A queue whose share of a window is at least ``run`` tokens is served token by
    token, so it has its share in every window.  The others together are one more
    such queue, and on the line inside it they are served ``run`` tokens at a
    time: a small queue is passed over until its deficit is worth a run, and the rest is
    carried into later windows, while the large ones notice nothing.
    """

    def __init__(self, tokens: np.ndarray, weights: np.ndarray, window: int = WINDOW, run: int = LEAST_RUN):
        self.run = max(1, min(run, window))
        self.small = weights * window < self.run * weights.sum()
        large = ~self.small
        more = [tokens[self.small].sum()] if self.small.any() else []
        self.line = Line(np.append(tokens[large], more), np.append(weights[large], [weights[self.small].sum()][: len(more)]), window)
        self.inner = Line(tokens[self.small], weights[self.small], window, self.run)
        self.number = np.where(large, np.cumsum(large) - 1, np.cumsum(self.small) - 1)  # in its line
        self.total = self.line.total

    def pieces(self, queue: np.ndarray, at: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, ...]:
        """Row numbers, starts in the document, lengths and places on the line of all pieces of documents (arrays).

        A document is ``tokens`` of its ``queue`` from ``at`` on.
        """
        small = self.small[queue]
        big = np.flatnonzero(~small)
        row, start, length, place = self.line.pieces(self.number[queue[big]], at[big], tokens[big])
        row = big[row]
        few = np.flatnonzero(small)
        if not len(few):
            return row, start, length, place
        # Parts of a document in each run, then their pieces in the windows.
        first, last = at[few] // self.run, (at[few] + tokens[few] - 1) // self.run
        many = last - first + 1
        of = np.repeat(np.arange(len(few)), many)
        run = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        begin = np.maximum(run * self.run, at[few][of])
        end = np.minimum((run + 1) * self.run, (at[few] + tokens[few])[of])
        inside = self.inner.place(self.number[queue[few]][of], begin)
        together = np.full(len(of), len(self.line.tokens) - 1)
        part, offset, size, there = self.line.pieces(together, inside, end - begin)
        more = few[of[part]], (begin - at[few][of])[part] + offset, size, there
        return tuple(np.concatenate(pair) for pair in zip((row, start, length, place), more, strict=True))


def integer_weights(shares: np.ndarray) -> np.ndarray:
    """Positive whole weights close to the shares."""
    return np.maximum(1, np.round(shares / shares.sum() * _RESOLUTION)).astype(np.int64)


def pack(
    docs: DataFrame, path: str, shares: dict[str, float] | None = None, window: int = WINDOW, run: int = LEAST_RUN
) -> DataFrame:
    """Pieces of all documents, placed in windows of ``window`` ids.

    The ``QUEUES`` sources with the most tokens and those named in ``shares``
    have a queue of their own, others share ``SHARED_QUEUES``.  ``shares`` gives
    the target proportions by source (others by their tokens); without it the
    targets are the tokens' shares.  A source with ``run`` tokens or more of a
    window to its share has them in every window, within a few tokens; one with
    less is served ``run`` tokens at a time, as soon as its deficit calls for
    them, and stays within a run of its target over any number of windows.  All
    documents are packed: once a queue is empty the others go on in proportion.
    Only the last window is padded.

    A missing text is empty and has the end id alone, a missing source is "".
    Repeated rows and ids are packed as often as they occur.  Other columns of
    ``docs`` are ignored.  No documents, no rows.

    Returns ``_PIECES`` per piece; ``ids_crc32`` is over unsigned 32-bit little-endian ids.
    """
    staged = tokenize(docs, path)
    sums = stage(staged.groupBy("part", "source").agg(F.sum("tokens").alias("tokens")), "queues")
    by_source = sums.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    most = by_source.orderBy(F.desc("tokens"), "source").limit(QUEUES).select("source").withColumn("own", F.lit(True))
    shared_name = F.concat(F.lit("\u0000rest "), F.pmod(F.xxhash64("source"), F.lit(SHARED_QUEUES)).cast("string"))
    own = F.col("own").isNotNull() | F.col("source").isin(list(shares or {}))
    queued = by_source.join(most, "source", "left").select(
        "source",
        F.when(own, F.concat(F.lit("="), F.col("source"))).otherwise(shared_name).alias("queue"),
        "tokens",
    )
    # At most QUEUES + SHARED_QUEUES rows, and those named.
    found = queued.groupBy("queue").agg(F.sum("tokens").alias("tokens")).orderBy("queue").collect()
    if not found:
        return staged.sparkSession.createDataFrame([], _PIECES)
    tokens = np.array([r.tokens for r in found], np.int64)
    wanted = np.array([(shares or {}).get(r.queue[1:], r.tokens / total) if r.queue[0] == "=" else r.tokens / total for r in found], float)
    weights = integer_weights(wanted)
    numbers = {r.queue: k for k, r in enumerate(found)}

    names = queued.select("source", "queue")
    earlier = Window.partitionBy("queue").orderBy("source", "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage(
        sums.join(names, "source").select(
            "part", "source", "queue", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base")
        ),
        "bases",
    )
    placed = staged.join(bases, ["part", "source"]).select(
        F.col("doc_id").cast("string"), "queue", (F.col("base") + F.col("at")).alias("at"), "tokens", "ids"
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        line = Mixture(tokens, weights, window, run)
        for batch in (b.iloc[k : k + _DOCS] for b in batches for k in range(0, len(b), _DOCS)):
            queue = batch["queue"].map(numbers).to_numpy(np.int64)
            size = batch["tokens"].to_numpy(np.int64)
            row, start, length, place = line.pieces(queue, batch["at"].to_numpy(np.int64), size)
            wide = [
                memoryview(np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4").tobytes())
                for ids, n in zip(batch["ids"], size.tolist(), strict=True)
            ]
            crc = [zlib.crc32(wide[r][4 * s : 4 * (s + k)]) for r, s, k in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64").array[row],
                "start": start,
                "length": length,
                "ids_crc32": crc,
                "doc_tokens": size[row],
                "sequence_id": place // window,
                "offset": place % window,
            })

    return placed.mapInPandas(cut, _PIECES)
