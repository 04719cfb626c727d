"""Every pipeline stage against its operator or brute force, on odd rows and a small table."""

import collections
import hashlib
import re
import zlib

import corpus_pipeline
import numpy as np
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm import mixing, toxicity
from starloom.llm.jaccard_join import shingles_of
from starloom.llm.queries import word_bpe

FOLDER = "/root/testdata/sf0.01"


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.toxicity_model(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    graded = docs.select("doc_id", toxicity.severity(spark, model, F.col("text"))["rejected"].alias("r")).collect()
    clean = corpus_pipeline.drop_toxic(spark, docs, FOLDER)
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {r.doc_id for r in graded if not r.r}

    single = corpus_pipeline.drop_near_copies(spark, clean, FOLDER)
    rows = clean.select("doc_id", "text").orderBy("doc_id").collect()
    sets = [(r.doc_id, set(shingles_of(r.text).tolist())) for r in rows]
    root = {d: d for d, _ in sets}
    by_shingle = {}
    for d, s in sets:
        near = {e for h in s for e in by_shingle.get(h, ())}
        for e, t in sets[: len(sets)] if near else []:
            if e in near and len(s & t) >= 0.8 * len(s | t):
                a, b = sorted((root[d], root[e]))
                root = {k: a if v == b else v for k, v in root.items()}
        for h in s:
            by_shingle.setdefault(h, []).append(d)
    assert {r.doc_id for r in single.select("doc_id").collect()} == set(root.values())

    mixed = corpus_pipeline.mix_sources(spark, single, FOLDER)
    assert mixed.columns == docs.columns and 0 < mixed.count() < single.count()
    packed = corpus_pipeline.pack_documents(spark, mixed, FOLDER)
    assert packed.select("doc_id").distinct().count() == mixed.count()


def test_mixing_stage_by_definition(spark):
    """Raking, clipping and the draw of every document in plain Python."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs.collect()

    def topic(t):
        marks = [("licence", "Licensed under" in t or "Copyright" in t), ("table", " | " in t), ("contact", "@" in t), ("long prose", len(t) >= 2_000)]
        return next((name for name, met in marks if met), "short prose")

    cell_of = [(r.source or "", r.lang or "", topic(r.text or "")) for r in rows]
    size_of = [len(re.findall(r"[^ \t\n\r]+", r.text or "")) for r in rows]
    cells = collections.Counter()
    for c, n in zip(cell_of, size_of):
        cells[c] += n
    cells = {c: n for c, n in cells.items() if n}
    weight = dict.fromkeys(cells, 1.0)
    targets = []
    for d, power in enumerate(mixing.DIMENSIONS.values()):
        sums = collections.Counter()
        for c, n in cells.items():
            sums[c[d]] += n
        whole = sum(n**power for n in sums.values())
        targets.append({v: n**power / whole for v, n in sums.items()})
    for _ in range(100):
        for d, target in enumerate(targets):
            now = collections.Counter()
            for c, n in cells.items():
                now[c[d]] += n * weight[c]
            weight = {c: w * target[c[d]] / now[c[d]] for c, w in weight.items()}
    total, low, high = sum(cells.values()), 0.0, 1e15
    for _ in range(300):  # the scale that keeps the share, by bisection
        middle = (low + high) / 2
        low, high = (middle, high) if sum(n * min(1, weight[c] * middle) for c, n in cells.items()) < mixing.KEEP * total else (low, middle)
    drawn, close = set(), set()
    for r, c, n in zip(rows, cell_of, size_of):
        signed = int(np.uint64(xxhash.xxh64_intdigest((r.text or "").encode(), seed=42)).astype(np.int64))
        x = int(hashlib.md5(f"mix{signed} {r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        chance = min(1, weight[c] * high) if n else 1.0
        (drawn if x < chance else set()).add(r.doc_id)
        if abs(x - chance) < 1e-6:
            close.add(r.doc_id)
    got = {r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, FOLDER).select("doc_id").collect()}
    assert len(close) < 3 and got - close == drawn - close


def test_packing_stage_holds_every_id_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    table = Tokenizer.from_file(word_bpe())
    ids = {r.doc_id: np.array(table.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4") for r in docs.collect()}
    pieces = corpus_pipeline.pack_documents(spark, docs, FOLDER).toPandas().sort_values(["sequence_id", "offset"])
    line = pieces.sequence_id * 2_048 + pieces.offset
    assert line.tolist() == [0, *np.cumsum(pieces.length)[:-1]] and pieces.length.sum() == sum(map(len, ids.values()))
    assert ((pieces.offset + pieces.length) <= 2_048).all()
    for doc, part in pieces.sort_values("start").groupby("doc_id"):
        assert part.start.tolist() == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() == len(ids[doc])
    assert all(p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes()) for p in pieces.itertuples())


def test_odd_rows_pass_through(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (None, None, "x"), (None, None, "x"), (2, None, "x"), (3, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _severity string").withColumn("lang", F.lit(None).cast("string"))
    docs = docs.withColumn("source", F.lit(None).cast("string")).withColumn("_text_hash", F.lit(1)).withColumn("_mix_tokens", F.lit(1))
    clean = corpus_pipeline.drop_toxic(spark, docs, FOLDER)
    assert clean.columns == docs.columns and clean.count() == 6
    single = corpus_pipeline.drop_near_copies(spark, clean, FOLDER)
    assert sorted(r.doc_id or 0 for r in single.collect()) == [0, 0, 1, 2]
    mixed = corpus_pipeline.mix_sources(spark, single, FOLDER)
    assert mixed.columns == docs.columns
    assert corpus_pipeline.pack_documents(spark, docs.where("doc_id < 0"), FOLDER).count() == 0
    assert corpus_pipeline.drop_near_copies(spark, docs.where("doc_id < 0"), FOLDER).count() == 0
