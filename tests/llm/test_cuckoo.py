"""The index of live digests against plain dictionaries."""

import collections
import hashlib
import random

from pyspark.sql import functions as F

from starloom.llm import cuckoo, queries

SCHEMA = "doc_id long, text string, _row string, copies int"


def wanted(rows):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    keep = {t: max(ids, key=lambda i: (i is not None, i or 0)) for t, ids in groups.items()}
    return sorted(
        ((d, keep[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows), key=str
    )


def test_exact_dedup(spark):
    pick = random.Random(5)
    rows = [(k, f"text {pick.randrange(400)}") for k in range(1_500)] + [(2_000 + k, "hot") for k in range(900)]
    rows += [(3_000, None), (3_001, ""), (None, "hot"), (None, "only without id"), (None, "only without id"), (7, "again"), (7, "again"), (3_002, "z" * 300_000)]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    got = cuckoo.exact_dedup(frame).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == wanted(rows)
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len({t or "" for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert cuckoo.exact_dedup(frame.where("doc_id = -1")).count() == 0


def test_filter_against_a_multiset():
    pick, filter_, live = random.Random(1), cuckoo.CuckooFilter(4_000), []
    for step in range(6_000):
        if live and (step % 3 == 2):
            assert filter_.delete(live.pop(pick.randrange(len(live))))
        else:
            live.append(pick.getrandbits(64))
            assert filter_.insert(live[-1])
    assert all(h in filter_ for h in live)
    assert sum(pick.getrandbits(64) in filter_ for _ in range(20_000)) < 40
    while live:
        assert filter_.delete(live.pop())
    assert not any(filter_.table)


def test_overflow_and_false_hits_in_a_bucket():
    bucket, keys = cuckoo.Bucket(fingerprint_bits=4), {}
    for k in range(3_000):
        digest = hashlib.sha256(str(k % 2_000).encode()).digest()
        bucket.insert(digest, 1, k, k, 1)
        keys[digest] = (1, k, k, keys[digest][3] + 1 if digest in keys else 1)
        if k % 7 == 0:
            bucket.delete(digest, 1, k - 1)  # not the live one
            bucket.delete(digest, 1, k)
            del keys[digest]
    assert bucket.keys == keys and bucket.resizes > 2 and bucket.false_hits > 100
    assert all(bucket.hashed(d) in bucket.filter for d in keys)


def test_updates_over_versions(spark, monkeypatch):
    monkeypatch.setattr(cuckoo, "BUCKET_KEYS", 50)
    pick, index, live = random.Random(3), cuckoo.LiveIndex(spark, fingerprint_bits=6), {}
    for load in range(4):
        added = [(1_000 * load + k, f"t{pick.randrange(150 * (load + 1))}") for k in range(200)]
        gone = [pick.choice(sorted(live.items())) for _ in range(30)] if live else []
        gone = [(doc_id if k % 3 else -1, text) for k, (text, (doc_id, _)) in enumerate(gone)]
        frames = [cuckoo.digests(spark.createDataFrame(r or [(None, None)], "doc_id long, text string").where("text IS NOT NULL")) for r in (added, gone)]
        index = index.update(inserts=frames[0], deletes=frames[1])
        for doc_id, text in gone:
            if live.get(text, (None,))[0] == doc_id:
                del live[text]
        for doc_id, text in added:
            known = live.get(text, (-1, 0))
            live[text] = max(known[0], doc_id), known[1] + 1
        got = {bytes(r.digest): (r.doc_id, r.copies) for r in index.live().collect()}
        assert got == {hashlib.sha256(t.encode()).digest(): v for t, v in live.items()}
    assert index.bits > 2
    again = index.update()
    assert again.live().exceptAll(index.live()).count() == 0
    assert again.statistics().agg(F.sum("slots")).first()[0] >= index.live().count()


def test_registered(spark):
    assert "op12_cuckoo_dedup" in queries.QUERIES and "op12_cuckoo_dedup" in queries.ORACLE
