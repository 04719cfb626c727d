"""Alignment of tokenizers against whole texts encoded at once and all pairs of tokens."""

import collections

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from starloom.llm import alignment, queries

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", "  lead", "trail  ", " ", "\n", "a\n\nb", "a \n b\t\tc  d", "x<|endoftext|>y </s> <s>[INST]", "▁under▁", "naïve café  x y",
    "😀 emoji 👩‍👩‍👧", "tab\tsep \r\n win", "\x1c ctrl !\x1c z", "it's I'LL we've", "中文 字符 测试", "\x00nul", "a" * 500, "é combining ́x",
    None, "word", "word", "end  line \n", "x 　 y", " \n \n", "!\n!\n\n?",
]


def spans(tokens):
    ends = np.cumsum([len(t) for t in tokens]).tolist()
    return list(zip([0, *ends], ends, strict=False))


def brute(rows):
    """The result of ``align_documents`` by its definition."""
    byte_level, pieces = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    byte_level.encode_special_tokens = True
    alphabet, cut = alignment._byte_alphabet(), []
    for _, text in rows:
        cut.append(None)
        if not text:
            continue
        a, b = byte_level.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        bytes_a = [bytes(alphabet[c] for c in byte_level.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(pieces.id_to_piece(i)[1:-1], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            at_a, at_b = spans(bytes_a), spans(bytes_b)
            links = [(a[i], b[j]) for i, x in enumerate(at_a) for j, y in enumerate(at_b) if max(x[0], y[0]) < min(x[1], y[1])]
            cuts = sorted({y for _, y in at_a} & {y for _, y in at_b})
            groups = [
                "|".join(",".join(str(t) for t, (x, y) in zip(ids, at, strict=True) if low <= x and y <= high) for ids, at in ((a, at_a), (b, at_b)))
                for low, high in zip([0, *cuts], cuts, strict=False)
            ]
            cut[-1] = (len(a), len(b), len(cuts), links, ";".join(groups))
    counts, best = collections.Counter(p for c in cut if c for p in set(c[3])), collections.Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return sorted(
        (
            (d, *c[:3], len(c[3]), sum(counts[p] == best[p[0]] for p in c[3]), sum(counts[p] for p in c[3]), c[4]) if c else (d, *[0] * 6, "")
            for (d, _), c in zip(rows, cut, strict=True)
        ),
        key=str,
    )


@pytest.fixture(scope="module")
def rows(spark):
    some = queries.table(spark, "/root/testdata/sf0.001", "documents").where("length(text) < 1500").collect()
    return [(r.doc_id, r.text) for r in some] + [(-k if k % 5 else None, t) for k, t in enumerate(ODD)]


@pytest.mark.parametrize("at_once", [alignment.PAIRS_AT_ONCE, 1_500])
def test_alignment(spark, rows, at_once):
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, groups string, n_a int").repartition(4)
    got = alignment.align_documents(frame, *PATHS, pairs_at_once=at_once).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_documents(none, *PATHS).count() == 0


def test_forgetting_units_changes_nothing(rows, monkeypatch):
    texts = [t for _, t in rows]
    tokenizers = alignment.Tokenizers(*PATHS)
    assert tokenizers.splits
    whole = tokenizers.encode(texts)
    monkeypatch.setattr(alignment, "UNITS", 0)
    one_by_one = [tokenizers.encode([t]) for t in texts]
    assert [a for (a,), _ in one_by_one] == whole[0] and [b for _, (b,) in one_by_one] == whole[1]
    assert tokenizers.ranked
    tokenizers.splits, tokenizers.ranked = False, None
    assert tokenizers.encode(texts) == whole


def test_ranks_are_the_merges():
    import duckdb

    texts = [t for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' WHERE text <> ''").fetchall()] + [t for t in ODD if t]
    tokenizers = alignment.Tokenizers(*PATHS)
    fast, tokenizers.ranked = [tokenizers._ids_a(t) for t in texts], None
    assert fast == [tokenizers._ids_a(t) for t in texts]


def test_perfect_hash():
    pick = np.random.RandomState(0)
    pairs = np.unique(pick.randint(0, 30_000, (50_000, 2)), axis=0)
    a, b = pairs[:, 0], pairs[:, 1]
    buckets = 5
    where = alignment._bucket_number(a, b, buckets)
    built = [(k, *alignment.hash_bucket(a[where == k], b[where == k])) for k in range(buckets)]
    hashed = alignment.PairHash([(sizes, words) for _, sizes, words, _ in built])
    numbers = hashed.numbers(a, b)
    assert sorted(numbers.tolist()) == list(range(len(pairs)))
    order = np.concatenate([np.flatnonzero(where == k)[o] for k, _, _, o in built])
    assert (numbers[order] == np.arange(len(pairs))).all()
    counts = alignment.PairCounts(hashed, a[order], b[order], np.arange(len(pairs)))
    found, _ = counts.look_up(a, b)
    assert (found[order] == np.arange(len(pairs))).all()
    assert not counts.look_up(a + 40_000, b)[0].any()  # verified: pairs outside have no count
