"""The training-data operators against brute force, on small tables with every odd case."""

import collections
import hashlib
import io
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import chat, components, imatch, jaccard_join, mixing, packing, queries, rp_forest, sharding, stupid_backoff, toxicity, warc
from starloom.llm.common import words_of

FOLDER = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed, n):
    pick = np.random.RandomState(seed).randint(0, len(WORDS), n)
    return " ".join(WORDS[k] + str(k * seed % 7) for k in pick)


LONG = prose(1, 5_000)
DOCS = [
    (1, LONG, "en", "a"), (2, LONG + " extra", "en", "a"), (3, prose(2, 60), "de", "b"), (4, prose(2, 60), "de", None),
    (4, prose(2, 60), "de", None), (5, "", None, "b"), (6, None, "en", "b"), (7, "one two", "en", "c"), (8, "One, two!", "en", "c"),
    (9, prose(3, 80), "en", "a"), (None, "no id", "en", "a"), (1 << 60, prose(4, 9), "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, "clash", 1) for r in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _block string, n_links int").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id = -99")


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (20, 10), (10, 20), (7, 7), (None, 1)], "a long, b long")
    got = {r.id: r.root for r in components.connected_components(edges).collect()}
    assert got == {3: 3, 4: 3, 5: 3, 9: 3, 10: 10, 20: 10}


def test_the_labelled_sample_is_bounded_in_rows(spark):
    rows = [(k % 7 if k < 2_000 else k, f"text {k}" if k % 3 else None) for k in range(2_050)]
    labels = spark.createDataFrame([(k, k % 2) for k in [*range(7), *range(2_000, 2_050)] * 2], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert len(toxicity.labelled_sample(docs, labels, rows=4)) <= 4
    whole = toxicity.labelled_sample(docs, labels)
    assert len(whole) == 57
    key = lambda r: (bytes(r.at), bytes(r.value), r.toxic)
    again = toxicity.labelled_sample(docs.repartition(3), labels)
    assert sorted(map(key, whole)) == sorted(map(key, again))


def test_toxicity_on_held_out_labels(spark):
    docs, labels = (queries.table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    model = toxicity.toxicity_model(docs.select("doc_id", "text"), labels.where("doc_id % 2 = 0"))
    held = docs.where("doc_id % 2 = 1").join(labels, "doc_id").select("toxic", toxicity.severity(spark, model, F.col("text")).alias("s"))
    rows = held.select("toxic", "s.*").collect()
    bad, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert sum(r.rejected for r in bad) >= 0.9 * len(bad)
    assert sum(r.rejected for r in clean) <= 0.01 * len(clean)
    assert np.mean([r.expected_severity for r in bad]) > 1 > 0.1 > np.mean([r.expected_severity for r in clean])
    assert list(model.thresholds) == sorted(model.thresholds)


def test_toxicity_without_labels(spark, docs, none):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.toxicity_model(docs.select("doc_id", "text"), labels)
    rows = docs.select("doc_id", toxicity.severity(spark, model, F.col("text")).alias("s")).select("s.*").collect()
    assert len(rows) == len(DOCS) and not any(r.rejected for r in rows)
    assert none.select(toxicity.severity(spark, model, F.col("text")).alias("s")).count() == 0


def test_backoff_scores(docs, none):
    rows = sorted((r.doc_id or 0, r.n_tokens, round(r.log_score, 3)) for r in stupid_backoff.score_documents(docs).collect())
    words = [words_of(t) for _, t, *_ in DOCS]
    total = collections.Counter(w for x in words for w in x)
    n = sum(total.values())
    known = {w for w, k in total.items() if k >= max(2, math.ceil(1e-5 * n))}
    words = [[w if w in known else None for w in x] for x in words]
    total, pairs = collections.Counter(w for x in words for w in x), collections.Counter(b for x in words for b in zip(x, x[1:]))
    expected = []
    for (doc, *_), x in zip(DOCS, words):
        own, own2 = collections.Counter(x), collections.Counter(zip(x, x[1:]))
        one = lambda w: (total[w] - own[w] or 0.4) / n  # noqa: B023, E731
        score = math.log(one(x[0])) if x else 0.0
        for v, w in zip(x, x[1:]):
            c = pairs[v, w] - own2[v, w]
            score += math.log(c / (total[v] - own[v])) if c else math.log(0.4 * one(w))
        expected.append((doc or 0, len(x), score))
    for (a, b, c), (d, e, f) in zip(rows, sorted(expected)):
        assert (a, b) == (d, e) and c == pytest.approx(f, abs=0.02)
    assert stupid_backoff.score_documents(none).count() == 0


def test_backoff_counts_every_word(spark, monkeypatch, docs, none):
    """The query's scores equal brute force over all words; words that no other document has score below prose."""
    monkeypatch.setattr(stupid_backoff, "VOCABULARY", 5e-3)
    monkeypatch.setattr(stupid_backoff, "HEAD", 5e-2)
    odd = [(*d[:2],) for d in DOCS] + [(50 + k, prose(k % 5, 40 + k) + f" rare{k % 4} rarer{k} rare{k % 3} tail{k % 2}") for k in range(12)]
    odd += [(70, " ".join(f"gibberish{k}" for k in range(50))), (71, "solitary"), (72, "rare1 rare1 rare1 rare2"), (73, "rare1")]
    frame = spark.createDataFrame(odd, "doc_id long, text string").repartition(3)
    words = [words_of(t) for _, t in odd]
    total, pairs = collections.Counter(w for x in words for w in x), collections.Counter(b for x in words for b in zip(x, x[1:]))
    n, expected = sum(total.values()), []
    for (doc, _), x in zip(odd, words):
        own, own2 = collections.Counter(x), collections.Counter(zip(x, x[1:]))
        one = lambda w: (total[w] - own[w] or 0.4) / n  # noqa: B023, E731
        score, seen = math.log(one(x[0])) if x else 0.0, 0
        for v, w in zip(x, x[1:]):
            c = pairs[v, w] - own2[v, w]
            seen += c > 0
            score += math.log(c / (total[v] - own[v])) if c else math.log(0.4 * one(w))
        expected.append((doc or 0, len(x), score, seen / max(len(x) - 1, 1)))
    rows = {(r.doc_id or 0): r for r in stupid_backoff.score_documents(frame, whole=True).collect()}
    assert len(rows) == len({d or 0 for d, _ in odd})
    for doc, size, score, seen in expected:
        assert rows[doc].n_tokens == size and rows[doc].seen_share == pytest.approx(seen)
        assert rows[doc].log_score == pytest.approx(score, abs=0.02)
    assert rows[70].mean_log_score < min(r.mean_log_score for d, r in rows.items() if 50 <= d < 62)
    assert stupid_backoff.score_documents(none, whole=True).count() == 0


def test_raked_marginals_meet_their_targets(spark, docs, none):
    many = queries.table(spark, FOLDER, "documents")
    mixed = mixing.mix(many.select("doc_id", "source", "lang", "text")).toPandas()
    mixed["share"] = mixed["_mix_tokens"] * mixed["_mix_weight"]
    for name, power in mixing.DIMENSIONS.items():
        tokens = mixed.groupby(f"_mix_{name}")["_mix_tokens"].sum() ** power
        assert np.allclose(mixed.groupby(f"_mix_{name}")["share"].sum(), tokens / tokens.sum(), atol=1e-6)
    assert mixed["_mix_probability"].between(0, 1).all() and 0 < mixed["_mix_kept"].mean() < 1
    odd = mixing.mix(docs)
    assert odd.count() == len(DOCS) and set(docs.columns) <= set(odd.columns)
    assert all(r["_mix_kept"] for r in odd.where("_mix_tokens = 0").collect())
    assert mixing.mix(none).count() == 0


def test_one_odd_document_takes_nothing_from_the_others(spark):
    many = queries.table(spark, FOLDER, "documents").select("doc_id", "source", "lang", "text")
    odd = spark.createDataFrame([(-1, "a new source", "a new language", "one two three four five")], many.schema)
    tokens = F.sum(F.col("_mix_tokens") * F.col("_mix_probability")) / F.sum("_mix_tokens")
    for docs in (many, many.union(odd)):
        mixed = mixing.mix(docs, clip=True)
        assert mixed.agg(tokens).first()[0] == pytest.approx(mixing.KEEP, abs=1e-6)
    assert mixed.where("doc_id = -1").first()["_mix_probability"] == 1.0
    parts = [F.col(f"_mix_{c}").alias(c) for c in ("source", "lang", "topic", "tokens")]
    cells = mixing.mixing_cells(mixed.select(*parts), clip=True).toPandas()
    free = cells[cells.probability < 1]
    assert np.allclose(free.probability / free.weight, (free.probability / free.weight).iloc[0])
    assert cells.unmet.sum() == pytest.approx(0, abs=1e-6) and cells.unmet[cells.source == "a new source"].item() > 0
    nameless = many.withColumn("doc_id", F.lit(None).cast("long")).limit(150).withColumn("source", F.lit("s")).withColumn("lang", F.lit("l"))
    drawn = mixing.mix(nameless, clip=True).groupBy("_mix_topic", "_mix_probability").agg(F.countDistinct("_mix_kept").alias("n"), F.count("*").alias("rows"))
    assert all(r.n == 2 for r in drawn.collect() if r.rows > 50 and r["_mix_probability"] < 0.95)


def test_fingerprints(docs, none):
    found = imatch.fingerprint_documents(docs).collect()
    rows = {(r.doc_id, r.n_chars): r for r in found}
    order = sorted(DOCS, key=lambda d: -1 if d[0] is None else d[0])
    expected = []
    for k, (doc, text, *_) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        expected.append((doc or 0, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((r.doc_id or 0, r.n_chars, r.edited_sha256) for r in found) == sorted(expected)
    assert rows[3, len(prose(2, 60))].fingerprint == rows[4, len(prose(2, 60))].fingerprint
    assert rows[1 << 60, len(prose(4, 9))].doc_id == 1 << 60
    assert rows[1, len(LONG)].near_next > 0.9 and all(0 <= r.near_edited <= 1 for r in rows.values())
    assert imatch.fingerprint_documents(none).count() == 0
    assert imatch.fingerprint_documents(docs.where("doc_id = 9")).first().near_next == 1.0


def test_fingerprints_by_definition(spark):
    """Every fingerprint and likeness of a table, by sets and plain integers."""
    import xxhash

    rows = sorted((r.doc_id, r.text or "") for r in queries.table(spark, FOLDER, "documents").collect())
    terms = [{xxhash.xxh64_intdigest(w) for w in words_of(t)} for _, t in rows]
    often = collections.Counter(h for one in terms for h in one)
    least, most = max(2, 1e-3 * len(rows)), max(2, 0.1 * len(rows))
    band, top = {h for h, n in often.items() if least <= n <= most}, 1 << 64
    rates = [r for r in imatch.RATES for _ in range(imatch.LEXICONS)]

    def kept(h, k):
        x = (h ^ 0x9E3779B97F4A7C15 * (k + 1) % top) * 0xBF58476D1CE4E5B9 % top
        return ((x ^ x >> 31) * 0x94D049BB133111EB % top) >> (64 - rates[k]) == 0

    chosen = {h: [k for k in range(len(rates)) if kept(h, k)] for h in band}

    def fingerprint(text):
        own = {xxhash.xxh64_intdigest(w) for w in words_of(text)}
        pack = lambda hashes: b"".join(h.to_bytes(8, "little") for h in sorted(hashes))
        lexicons = [[] for _ in rates]
        for h in own & band:
            for k in chosen[h]:
                lexicons[k].append(h)
        return [xxhash.xxh64_hexdigest(pack(own & band or own)), *[xxhash.xxh64_hexdigest(pack(x))[:6] if x else "------" for x in lexicons]]

    def alike(a, b):
        if a[0] == b[0]:
            return 1.0
        used = [(2**r, x == y) for r, x, y in zip(rates, a[1:], b[1:]) if (x, y) != ("------", "------")]
        return sum(w for w, same in used if same) / sum(w for w, _ in used) if used else 0.0

    got = {r.doc_id: r for r in imatch.fingerprint_documents(queries.table(spark, FOLDER, "documents")).collect()}
    prints = [fingerprint(t) for _, t in rows]
    for k, (doc, text) in enumerate(rows):
        after = (k + 1) % len(rows)
        edited = fingerprint(text[: len(text) - len(text) // 2] + rows[after][1][: len(text) // 2])
        r = got[doc]
        assert (r.fingerprint, r.edited_fingerprint) == ("".join(prints[k]), "".join(edited))
        assert (r.near_edited, r.near_next) == pytest.approx((alike(prints[k], edited), alike(prints[k], prints[after])))


def test_jaccard_join(spark, docs, none):
    assert jaccard_join.jaccard_join(none).count() == 0
    got = {r.doc_id: (r.class_id, r.n_links, r.kept) for r in jaccard_join.jaccard_join(docs).collect()}
    assert got[1] == (1, 1, True) and got[2] == (1, 1, False)
    assert got[3] == (3, 2, True) and got[4] == (3, 2, False)
    assert got[5] == (5, 1, True) and got[6] == (5, 1, False)
    assert got[7] == (7, 1, True) and got[8] == (7, 1, False)
    assert got[9] == (9, 0, True) and got[None] == (None, 0, True) and got[1 << 60] == (1 << 60, 0, True)


def test_jaccard_join_finds_every_link_of_a_table(spark):
    docs = queries.table(spark, FOLDER, "documents")
    rows = docs.select("doc_id", "text").collect()
    sets = {r.doc_id: set(jaccard_join.shingles_of(r.text).tolist()) for r in rows}
    links = collections.Counter()
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            links[a] += a != b and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both)
    assert {r.doc_id: r.n_links for r in jaccard_join.jaccard_join(docs).collect()} == dict(links)


def test_a_group_of_copies_hides_no_lonely_pair(spark):
    """100 texts at 0.9 and more with each other, and 400 pairs at exactly 0.8 that share nothing with others."""
    texts = {}
    for k in range(400):
        words = [f"w{k}x{j}" for j in range(104)]
        texts[2 * k], texts[2 * k + 1] = " ".join(words[:94]), " ".join(words[:84] + words[94:])
    common = [f"c{j}" for j in range(400)]
    texts.update({1_000 + k: " ".join([*common[: 2 * k], f"own{k}", *common[2 * k + 1 :]]) for k in range(100)})
    signs = {k: jaccard_join.signature(jaccard_join.shingles_of(t)) for k, t in texts.items()}
    assert not all((signs[2 * k] == signs[2 * k + 1]).all(axis=1).any() for k in range(400))  # the longest prefixes lose some
    got = {r.doc_id: r for r in jaccard_join.jaccard_join(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert sum(got[2 * k + 1].class_id != 2 * k for k in range(400)) == 0
    assert all(got[1_000 + k].n_links == 99 for k in range(100))


def test_texts_with_a_common_passage_are_no_candidates(spark, monkeypatch):
    """A passage that is a quarter of 1,500 texts makes them share nodes; only the two true copies are verified."""
    common = " ".join(f"licence{j}" for j in range(40))
    texts = {k: f"{common} " + " ".join(f"w{k}x{j}" for j in range(70)) for k in range(1_500)}
    texts[5_000] = texts[7] + " tail"
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    signed = [jaccard_join.signature(jaccard_join.shingles_of(t)) for t in texts.values()]
    keys = collections.Counter((k, tuple(s[k][:3])) for s in signed for k in range(jaccard_join.TREES))
    assert max(keys.values()) > jaccard_join.SMALL_NODE
    seen = []
    whole = jaccard_join.compare_groups
    monkeypatch.setattr(jaccard_join, "compare_groups", lambda items, *a: (seen.append(items), whole(items, *a))[1])
    got = {r.doc_id: r for r in jaccard_join.jaccard_join(frame).collect()}
    assert seen[-1].count() == 2  # verified on their shingles
    assert got[5_000].class_id == 7 and sum(r.n_links for r in got.values()) == 2


def test_screening_keeps_all_pairs_at_the_threshold():
    assert jaccard_join.depths(0.8, 0.999) == [5, 4, 3] and jaccard_join.depths(0.8, 0.99) == [5] and jaccard_join.depths(0.3, 0.999)[-1] == 1
    n, least = jaccard_join.TREES * jaccard_join.LEVELS, jaccard_join.least_agreement(0.8)
    miss = sum(math.comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(least))
    assert miss < 1e-5 and least > 0.5 * n


def test_near_vectors(spark):
    rng = np.random.RandomState(3)
    base = rng.normal(size=(40, 16))
    points = [(k, (base[k % 40] + rng.normal(scale=0.12, size=16)).tolist(), k % 2) for k in range(800)]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [1.0, None], 0), (904, [1.0] * 16, None),
           (905, [2.0] * 3, 0), (906, [4.0] * 3, 0), (907, [], 0), (908, [1e200] * 16, 1), (909, [1e200] * 16, 1)]
    frame = spark.createDataFrame([(i, v, label, "x") for i, v, label in points + odd], "vec_id long, embedding array<double>, label int, item string")
    got = {r.vec_id: (r.component_id, r.n_links) for r in rp_forest.near_vectors(frame).collect()}
    unit = np.array([p[1] for p in points])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([p[2] for p in points])
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    exact = sum(got[k][1] == near[k].sum() for k in range(800))
    assert exact >= 0.99 * 800 and near.sum() > 2_000 and all(got[k][1] <= near[k].sum() for k in range(800))
    assert [got[k] for k in (900, 901, 902, 903, 904, 907)] == [(k, 0) for k in (900, 901, 902, 903, 904, 907)]
    assert got[905] == got[906] == (905, 1) and got[908] == got[909] == (908, 1)
    assert rp_forest.near_vectors(frame.where("vec_id < 0")).count() == 0


def test_forest_spills_below_its_sample():
    """Pairs of cosine 0.93 stay together at levels that the sample is too small to cut."""
    rng = np.random.RandomState(8)
    first, other = (rp_forest.unit(rng.normal(size=(1_500, 64))) for _ in range(2))
    other = rp_forest.unit(other - (other * first).sum(axis=1, keepdims=True) * first)
    second = 0.93 * first + math.sqrt(1 - 0.93**2) * other
    parted, found = [], np.zeros(len(first), bool)
    for seed in range(10):
        tree = rp_forest.plant(rp_forest.unit(rng.normal(size=(500, 64))), 16, seed)
        a, b = ({*zip(*(x.tolist() for x in rp_forest.leaves(tree, v)))} for v in (first, second))
        together = np.isin(np.arange(len(first)), [row for row, _ in a & b])
        parted.append(1 - together.mean() ** (1 / 16))
        found |= together
    assert np.mean(parted) < 0.05 and found.mean() > 0.99


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "http://a/ b\r\nX: 1", "<p>ä</p>"), (2, None, "<p>ä</p>"), (3, "u", None), (4, "u", ""), (4, "u", ""), (None, "u", ""), (5, "u", "y" * 200_000)],
        "page_id long, url string, html string",
    ).withColumn("payload", F.lit("clash"))
    got = {(r.page_id, r.payload_bytes): (r.record_type, r.refers_to) for r in warc.read_archives(warc.write_archives(pages)).collect()}
    assert got == {
        (1, 9): ("response", None), (2, 9): ("revisit", 1), (3, 0): ("response", None), (4, 0): ("revisit", 3),
        (None, 0): ("response", None), (5, 200_000): ("response", None),
    }
    small = warc.read_archives(warc.write_archives(pages, least_bytes=1)).where("page_id = 4").collect()
    assert [r.record_type for r in small] == ["response", "response"]
    assert warc.read_archives(warc.write_archives(pages.where("page_id < 0"))).count() == 0


def test_warc_reader_refuses_damage():
    good = warc.record_bytes(1, "u", b"abc") + warc.record_bytes(2, "u", b"")
    assert [r["page_id"] for r in warc.read_records(io.BytesIO(good))] == [1, 2]
    with pytest.raises((ValueError, zlib.error)):
        list(warc.read_records(io.BytesIO(good[:-9])))
    plain = zlib.decompress(warc.record_bytes(1, "u", b"abc"), 31).replace(b"abc", b"abd")
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_records(io.BytesIO(packer.compress(plain) + packer.flush())))


def test_shards(spark, docs, none):
    many = queries.table(spark, FOLDER, "documents")
    rows = sharding.shard_by_bytes(many).orderBy("doc_id").collect()
    assert [r.shard for r in rows] == sorted(r.shard for r in rows)
    texts = {r.doc_id: r.text.encode() for r in many.select("doc_id", "text").collect()}
    assert all(r.size == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)
    sums, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        sums[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(s == list(range(len(s))) for s in slots.values()) and set(sums) == set(range(8))
    assert max(sums.values()) - min(sums.values()) <= 2 * max(r.size for r in rows)
    assert sharding.shard_by_bytes(docs, 3).count() == len(DOCS) and sharding.shard_by_bytes(none).count() == 0


def test_packing_covers_every_id_once(spark, docs, none):
    from tokenizers import Tokenizer

    path = queries.word_bpe()
    table = Tokenizer.from_file(path)
    texts = [*(t or "" for _, t, *_ in DOCS), "it's <|endoftext|>mixed.Case, naïve x\t9 ΣΑΣ é!?"]
    encoder = packing.Encoder(path)
    for t in texts:
        assert np.frombuffer(encoder.encode(t), encoder.kind).tolist() == table.encode(t, add_special_tokens=False).ids
    many = queries.table(spark, FOLDER, "documents")
    pieces = packing.pack(many, path).toPandas()
    source = {r.doc_id: (r.source, r.text) for r in many.collect()}
    ids = {d: np.array(table.encode(t, add_special_tokens=False).ids + [1], "<u4") for d, (_, t) in source.items()}
    for doc, part in pieces.sort_values("start").groupby("doc_id"):
        assert part.start.tolist() == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() == len(ids[doc])
    for p in pieces.itertuples():
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes()) and p.doc_tokens == len(ids[p.doc_id])
    full = pieces.sort_values(["sequence_id", "offset"])
    line = full.sequence_id * 2048 + full.offset
    assert line.tolist() == [0, *np.cumsum(full.length)[:-1]]  # gapless from the first to the last window
    share = full.assign(s=[source[d][0] for d in full.doc_id]).groupby(["sequence_id", "s"]).length.sum().unstack(fill_value=0)
    target = share.sum() / share.sum().sum() * 2048
    assert ((share.iloc[:-1] - target).abs() <= 2 * packing.LEAST_RUN).all().all()
    odd = packing.pack(docs, path, shares={"a": 5.0})
    assert odd.select(F.sum("length")).first()[0] == sum(len(table.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in DOCS)
    assert packing.pack(none, path).count() == 0


def test_every_window_has_the_target_mixture():
    """Two hundred queues, then some that run out: a few tokens off target, nothing lost, nothing twice."""
    rng = np.random.RandomState(4)
    tokens = rng.randint(30_000, 60_000, 200)
    for weights in (packing.integer_weights(tokens / tokens.sum()), packing.integer_weights(rng.rand(200) + 0.05)):
        line = packing.Line(tokens, weights, 2_048)
        borders = np.concatenate([line.borders(k)[:-1] for k in range(0, line.total // 2_048 + 2, line.rows)] + [tokens[None]])
        counts = np.diff(borders, axis=0)
        assert (counts >= 0).all() and (borders.sum(axis=1) == np.minimum(np.arange(len(borders)) * 2_048, line.total)).all()
        full = int((borders < tokens).all(axis=1).sum()) - 1  # windows before the first queue runs out
        assert full > 100 and np.abs(counts[:full] - 2_048 * weights / weights.sum()).max() <= 4
    queue, at = np.repeat(np.arange(200), 100), np.concatenate([np.linspace(0, t, 101).astype(int)[:-1] for t in tokens])
    size = np.concatenate([np.diff(np.linspace(0, t, 101).astype(int)) for t in tokens])
    row, start, length, place = line.pieces(queue, at, size)
    order = np.argsort(place)
    assert (place[order] == np.cumsum(length[order]) - length[order]).all() and length.sum() == line.total
    assert (np.bincount(row, weights=length) == size).all() and (place // 2_048 == (place + length - 1) // 2_048).all()


def placed(mixture, tokens, docs=40):
    """Tokens of each queue in each window when its tokens come as ``docs`` documents; every token lies somewhere, once."""
    cuts = [np.linspace(0, t, docs + 1).astype(int) for t in tokens]
    queue = np.repeat(np.arange(len(tokens)), docs)
    at, size = np.concatenate([c[:-1] for c in cuts]), np.concatenate([np.diff(c) for c in cuts])
    row, start, length, place = mixture.pieces(queue, at, size)
    order = np.argsort(place)
    assert (place[order] == np.cumsum(length[order]) - length[order]).all() and length.sum() == mixture.total
    assert (np.bincount(row, weights=length, minlength=len(size)) == size).all() and (place // 2_048 == (place + length - 1) // 2_048).all()
    within = np.lexsort((start, row))
    new = np.diff(row[within], prepend=-1) > 0
    assert (start[within][new] == 0).all() and (start[within][1:] == (start + length)[within][:-1])[~new[1:]].all()
    counts = np.zeros((mixture.total // 2_048 + 1, len(tokens)), int)
    np.add.at(counts, (place // 2_048, queue[row]), length)
    return counts


def test_small_queues_wait_for_a_run():
    """A least run of each small queue at a time; over eight windows no queue is a run off its target."""
    rng = np.random.RandomState(4)
    for tokens, mean in [
        (rng.randint(30_000, 60_000, 200), 64),
        (rng.randint(300_000, 600_000, 20), 64),
        (np.r_[rng.randint(300_000, 900_000, 8), rng.randint(3_000, 20_000, 150)], 50),
    ]:
        for weights in (packing.integer_weights(tokens / tokens.sum()), packing.integer_weights(rng.rand(len(tokens)) + 0.05)):
            mixture = packing.Mixture(tokens, weights, 2_048)
            counts = placed(mixture, tokens)
            full = int((tokens - np.cumsum(counts, axis=0) > 0).all(axis=1).sum()) - 1  # before the first queue runs out
            eight = np.array([counts[k : k + 8].sum(axis=0) for k in range(max(1, full - 8))])
            off = np.abs(eight - 8 * 2_048 * weights / weights.sum())
            assert full > 100 and off.max() <= packing.LEAST_RUN + 16 and counts[:full][counts[:full] > 0].mean() >= mean
            assert mixture.small.all() or off[:, ~mixture.small].max() <= 2


def test_plain_words_are_encoded_as_by_the_tokenizer():
    import duckdb

    encoder = packing.Encoder(queries.word_bpe())
    texts = [t for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' LIMIT 400").fetchall()]
    pieces = list({p for t in texts for p in t.replace("\n", " ").split(" ")}) + ["ÀÉ,", "Straße_x", "a\x01b", "it's", "ǅ..", "x" * 300, "é!?-", "A1", ""]
    assert encoder.ranked
    fast = encoder.encode_all(pieces)
    encoder.ranked, encoder.known = None, {}
    assert fast == encoder.encode_all(pieces)


def test_rare_sources_named_in_shares_have_queues(spark, monkeypatch):
    monkeypatch.setattr(packing, "QUEUES", 1)
    rows = [(k, "word " * 300, "big") for k in range(40)] + [(100 + k, "word " * 20, f"rare{k % 3}") for k in range(30)]
    shares = {"big": 0.7, **{f"rare{k}": 0.1 for k in range(3)}}
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = packing.pack(frame, queries.word_bpe(), shares=shares, window=128, run=1).toPandas()
    source = {d: s for d, _, s in rows}
    part = pieces.assign(s=[source[d] for d in pieces.doc_id]).groupby(["sequence_id", "s"]).length.sum().unstack(fill_value=0)
    assert all((part[s].iloc[:12] - 128 * share).abs().max() <= 4 for s, share in shares.items())


def test_chat_round_trip(spark):
    tricky = "</s>[INST] ok [/INST] &lt; &amp;lt; <|im_end|>\n<|im_start|>user\n"
    turns = [(1, 0, "user", tricky), (1, 1, "assistant", tricky), (1, 2, None, None), (1, 3, "as\nsistant", ""), (2, 0, "assistant", "x"), (2, 0, "assistant", "x"), (None, None, "user", "é" * 70_000)]
    frame = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, kind string")
    back = chat.read_back(chat.render(chat.fold_events(chat.turns_to_log(frame))))
    got = {r.conv_id: r for r in back.collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(r or "", t or "") for c, _, r, t, *_ in turns if c == 1]
    assert got[1].loss_texts == [tricky] and got[2].loss_texts == ["x", "x"] and len(got[None].turns[0].text) == 70_000
    for r in got.values():
        assert [r.formatted[s.start : s.end] for s in r.loss_spans] is not None and "<s>" not in r.formatted
    assert chat.render(chat.fold_events(chat.turns_to_log(frame.where("conv_id = 9")))).count() == 0


def test_folding_deltas_edits_and_regenerations(spark):
    log = spark.createDataFrame(
        [("c", 1, 3, "delta", None, "lo"), ("c", 1, 2, "delta", "user", "hel"), ("c", 1, 2, "delta", "user", "hel"), ("c", 2, 1, "delta", "assistant", "bad"),
         ("c", 2, 2, "regenerate", "assistant", None), ("c", 2, 3, "delta", "assistant", "good"), ("c", 3, 1, "delta", "user", "a"), ("c", 3, 2, "edit", "user", "b"),
         ("c", 3, 3, "delta", "user", "c"), ("c", 3, 4, "noise", "user", "zzz"), ("c", 4, 1, "regenerate", "assistant", "ignored")],
        "conv_id string, message int, seq int, kind string, role string, text string",
    )
    got = [(r.role, r.text) for r in chat.fold_events(log).orderBy("message").collect()]
    assert got == [("user", "hello"), ("assistant", "good"), ("user", "bc"), ("assistant", "")]


def test_likelihood_of_the_search():
    assert jaccard_join.found_at(3, 0.8) > 0.999 and jaccard_join.found_at(5, 0.8) > 0.99
