"""Toxicity grades: cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import word_hash, words_of
from starloom.sources.staging import stage

PREFIXES = (4, 5, 6, 7)  # characters of the word beginnings that are features besides the words
BITS = 22  # features are chosen among 2 ** BITS buckets of terms, then kept apart by their whole hashes
SAMPLE = 10_000  # labelled documents that a model is fitted on, at most
GRADES = 4  # 0 clean, 1 to 3 toxic
LEAST_Z = 6.0  # a term is a feature if its share of toxic documents is this far from the base rate
LEAST_DOCS = 5
RESULT = "expected_severity double, p_toxic double, grade int, rejected boolean"


@dataclass
class Model:
    terms: np.ndarray  # sorted hashes of the features
    weights: np.ndarray  # by feature, shared by all thresholds
    thresholds: np.ndarray  # ascending, one fewer than grades

    def score(self, text: str | None) -> float:
        at, value = features(text)
        if not len(self.terms):
            return 0.0
        place = np.minimum(np.searchsorted(self.terms, at), len(self.terms) - 1)
        hit = self.terms[place] == at
        return float((self.weights[place[hit]] * value[hit]).sum())

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... by row."""
        return _logistic(scores[:, None] - self.thresholds[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the words of a whole text and their beginnings, and 1 + ln(count)."""
    terms = Counter(words_of(text))
    for word, count in list(terms.items()):
        for size in PREFIXES:
            if len(word) <= size:
                break
            terms["^" + word[:size]] += count
    at = np.fromiter(map(word_hash, terms), np.uint64, len(terms))
    order = np.argsort(at)
    return at[order], 1 + np.log(np.fromiter(terms.values(), np.float64, len(terms)))[order]


def _statistics(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    docs, bad = np.zeros(1 << BITS, np.int32), np.zeros(1 << BITS, np.int32)
    for batch in batches:
        for toxic, text in zip(batch["toxic"], batch["text"], strict=True):
            at = np.unique(features(text)[0] >> np.uint64(64 - BITS)).astype(np.int64)
            docs[at] += 1
            bad[at] += int(toxic > 0)
    at = np.flatnonzero(docs)
    yield pd.DataFrame({"bucket": at, "docs": docs[at].astype(np.int64), "bad": bad[at].astype(np.int64)})


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> list:
    """Labels and chosen features of at most ``rows`` labelled documents, the first by a hash of their id.

    An id counts once, however many rows repeat it: of several texts the one
    with the least hash is taken, a missing one counts as empty.  Several labels of an id count as toxic if one is; labels or ids that are
    missing are left out, as are labels without a document.  Which terms are
    far from the base rate is found by an aggregate over the sample; only
    their values come to the driver.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .join(texts.select("doc_id"), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # At most ``rows`` pairs of numbers are broadcast.
    met = texts.join(F.broadcast(stage(known, "labelled")), "doc_id")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    one = met.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min(F.struct(F.xxhash64(text), text.alias("text"))).alias("_one"))
    joined = stage(one.select("toxic", "_one.text"), "labelled-texts")
    total, base = joined.agg(F.count(F.lit(1)), F.avg((F.col("toxic") > 0).cast("double"))).first()
    if not total or base in (0.0, 1.0):
        return []
    counted = joined.mapInPandas(_statistics, "bucket long, docs long, bad long").groupBy("bucket")
    sums = counted.agg(F.sum("docs").alias("docs"), F.sum("bad").alias("bad"))
    z = (F.col("bad") - F.col("docs") * base) / F.sqrt(F.col("docs") * base * (1 - base))
    far = sums.where((F.col("docs") >= LEAST_DOCS) & (F.abs(z) >= LEAST_Z)).select("bucket")
    chosen = np.zeros(1 << BITS, bool)  # bounds what is collected and broadcast
    chosen[[r.bucket for r in far.collect()]] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.flatnonzero(chosen))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep = np.zeros(1 << BITS, bool)
        keep[shared.value] = True
        for batch in batches:
            made = []
            for text in batch["text"]:
                at, value = features(text)
                used = keep[at >> np.uint64(64 - BITS)]
                made.append((at[used].tobytes(), value[used].astype(np.float32).tobytes()))
            yield pd.DataFrame(made, columns=["at", "value"]).assign(toxic=batch["toxic"].to_numpy())

    return joined.mapInPandas(vectors, "at binary, value binary, toxic int").collect()


def fit(sample: list, rounds: int = 400) -> Model:
    """Fit weights and thresholds on labelled vectors.

    Labels say toxic or not.  The severity of a toxic document is the tercile,
    among the toxic ones, of its summed feature values over terms that nearly
    only toxic documents have: grades 1 to 3.  Terms far from the base rate
    are the features; the rest has weight 0.  The likelihood of the
    proportional-odds model with a quadratic penalty is maximised by full-batch
    steps with momentum from a fixed start, so equal samples give equal models.

    Without a toxic or without a clean document the model predicts grade 0.
    """
    never = Model(np.empty(0, np.uint64), np.empty(0), np.full(GRADES - 1, 30.0) + np.arange(GRADES - 1))
    toxic = np.array([r.toxic > 0 for r in sample], bool)
    if not toxic.any() or toxic.all():
        return never
    # A fixed order: sums of the fit do not depend on how the sample was read.
    order = sorted(range(len(sample)), key=lambda k: (bytes(sample[k].at), bytes(sample[k].value), sample[k].toxic))
    sample, toxic = [sample[k] for k in order], toxic[order]
    at = [np.frombuffer(r.at, np.uint64) for r in sample]
    value = np.concatenate([np.frombuffer(r.value, np.float32) for r in sample]).astype(np.float64)
    row = np.repeat(np.arange(len(sample)), [len(a) for a in at])
    terms, col = np.unique(np.concatenate(at), return_inverse=True)
    base = toxic.mean()
    docs = np.bincount(col, minlength=len(terms))
    bad = np.bincount(col, weights=toxic[row], minlength=len(terms))
    z = (bad - docs * base) / np.sqrt(np.maximum(docs, 1) * base * (1 - base))
    chosen = np.flatnonzero((np.abs(z) >= LEAST_Z) & (docs >= LEAST_DOCS))
    if not len(chosen):
        return never
    signs = np.zeros(len(terms), bool)
    signs[chosen[bad[chosen] >= 0.9 * docs[chosen]]] = True
    strength = np.bincount(row, weights=value * signs[col], minlength=len(sample))
    cuts = np.quantile(strength[toxic], [1 / 3, 2 / 3])
    grade = np.where(toxic, 1 + (strength > cuts[0]) + (strength > cuts[1]), 0)

    place = np.full(len(terms), -1)
    place[chosen] = np.arange(len(chosen))
    used = place[col] >= 0
    col, row, value = place[col[used]], row[used], value[used]
    n = len(sample)
    weights, theta, gaps = np.zeros(len(chosen)), 2.0, np.zeros(GRADES - 2)
    state = np.concatenate([weights, [theta], gaps])
    first, second = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, rounds + 1):
        weights, theta, gaps = state[: len(chosen)], state[len(chosen)], state[len(chosen) + 1 :]
        thresholds = theta + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        score = np.bincount(row, weights=value * weights[col], minlength=n)
        p = _logistic(score[:, None] - thresholds[None, :])
        # P(grade = k) = p[k - 1] - p[k], with p[-1] = 1 and p[last] = 0.
        edges = np.concatenate([np.ones((n, 1)), p, np.zeros((n, 1))], axis=1)
        own = np.maximum(edges[np.arange(n), grade] - edges[np.arange(n), grade + 1], 1e-12)
        slope = p * (1 - p)
        upper = np.where(np.arange(1, GRADES)[None, :] == grade[:, None], slope, 0)
        lower = np.where(np.arange(1, GRADES)[None, :] == grade[:, None] + 1, slope, 0)
        by_threshold = -(upper - lower) / own[:, None]  # gradient of the log likelihood
        by_score = -by_threshold.sum(axis=1)
        up = np.bincount(col, weights=value * by_score[row], minlength=len(chosen)) / n - 1e-4 * weights
        per = by_threshold.sum(axis=0) / n
        up_gaps = np.array([per[k + 1 :].sum() * np.exp(gaps[k]) for k in range(len(gaps))])
        slope_all = np.concatenate([up, [per.sum()], up_gaps])
        first = 0.9 * first + 0.1 * slope_all
        second = 0.999 * second + 0.001 * slope_all**2
        state = state + 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    gaps = state[len(chosen) + 1 :]
    return Model(terms[chosen], state[: len(chosen)], state[len(chosen)] + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def severity(spark, model: Model, text: Column, cut: float = 0.25) -> Column:
    """``RESULT`` of a text column: expected grade, P(toxic), likeliest grade, and P(toxic) >= ``cut``.

    A missing text is empty; a text without words has the score of no features.
    """
    shared = spark.sparkContext.broadcast(model)  # at most 2 ** BITS buckets of features

    @F.pandas_udf(RESULT)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            p = shared.value.at_least(np.array([shared.value.score(one) for one in texts]).reshape(-1))
            edges = np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], axis=1)
            yield pd.DataFrame({
                "expected_severity": p.sum(axis=1),
                "p_toxic": p[:, 0],
                "grade": (edges[:, :-1] - edges[:, 1:]).argmax(axis=1).astype("int32"),
                "rejected": p[:, 0] >= cut,
            })

    return score(text)


def toxicity_model(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Model:
    return fit(labelled_sample(docs, labels, rows))
