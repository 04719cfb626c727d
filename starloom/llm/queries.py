"""The registered queries of this folder, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import alignment, chat, cuckoo, imatch, jaccard_join, mixing, packing, rp_forest, sharding, stupid_backoff, toxicity, turn_repair, warc
from starloom.llm.common import table


def word_bpe() -> str:
    """The public word-piece vocabulary that the packing query fixes."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Expected severity of every document, from a model of the labelled ones."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.toxicity_model(docs, table(spark, folder, "labels"))
    graded = docs.select("doc_id", toxicity.severity(spark, model, F.col("text")).alias("_s"))
    return graded.select("doc_id", "_s.*")


def op2_stupid_backoff(spark: SparkSession, folder: str) -> DataFrame:
    """Stupid-backoff scores of every document, every word counted."""
    return stupid_backoff.score_documents(table(spark, folder, "documents"), whole=True)


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its calibrated weight, probability and decision."""
    mixed = mixing.mix(table(spark, folder, "documents").select("doc_id", "source", "lang", "text"))
    names = ["source", "lang", "topic", "tokens"]
    return mixed.select(
        "doc_id",
        *[F.col(f"_mix_{c}").alias(c) for c in names],
        (F.round(F.col("_mix_weight") * 1e9, 3)).alias("weight"),
        F.round("_mix_probability", 6).alias("probability"),
        F.col("_mix_kept").alias("kept"),
    )


def op4_imatch(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every text and its edited text."""
    return imatch.fingerprint_documents(table(spark, folder, "documents"))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Near duplicates among all documents."""
    joined = jaccard_join.jaccard_join(table(spark, folder, "documents"))
    return joined.select("doc_id", "class_id", "n_links", "kept")


def op6_rp_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Near duplicates among all embeddings of a label."""
    return rp_forest.near_vectors(table(spark, folder, "embeddings"))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Write a record per page, read the archives back."""
    manifest = warc.write_archives(table(spark, folder, "pages").select("page_id", "url", "html"))
    return warc.read_archives(manifest)


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Eight contiguous shards of nearly equal bytes."""
    shards = sharding.shard_by_bytes(table(spark, folder, "documents"))
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed to the mixture of their sources."""
    return packing.pack(table(spark, folder, "documents"), word_bpe())


def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations folded from their logs, rendered, and read back."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    log = chat.turns_to_log(turns.unionByName(extra))
    back = chat.read_back(chat.render(chat.fold_events(log)))
    turn = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turn, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def damaged_turns(turns: DataFrame) -> DataFrame:
    """Conversations as op 11 damages them: by a checksum of conversation and turn."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    hit = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return (
        turns.select(
            "conv_id",
            "turn",
            F.when(hit == 4, "user").otherwise(role).alias("role"),
            F.when(hit == 1, "").when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("_times"),
        )
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_times"))))
        .drop("_times", "_copy")
    )


def op11_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged conversations, repaired at least cost."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    repaired = turn_repair.summarize(turn_repair.repair(damaged_turns(turns)), ordered=True)
    every = turns.select(F.col("conv_id").alias("_id")).distinct()
    found = every.join(repaired, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        F.col("_id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12_cuckoo_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Exact copies among all documents; the largest id of a text stays."""
    return cuckoo.exact_dedup(table(spark, folder, "documents"))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """How two public tokenizers cut every document, and how common their links are."""
    import public_tokenizers

    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    aligned = alignment.align_documents(table(spark, folder, "documents"), *paths)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return aligned.select(*[c for c in aligned.columns if c != "groups"], digest.alias("groups_sha256"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_stupid_backoff": op2_stupid_backoff,
    "op3_mixing": op3_mixing,
    "op4_imatch": op4_imatch,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_rp_forest": op6_rp_forest,
    "op7_warc": op7_warc,
    "op8_sharding": op8_sharding,
    "op9_packing": op9_packing,
    "op10_chat": op10_chat,
    "op11_turn_repair": op11_turn_repair,
    "op12_cuckoo_dedup": op12_cuckoo_dedup,
    "op13_alignment": op13_alignment,
}

_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_ESCAPED = "coalesce(text, '')"
for _old, _new in [(e, "&amp;" + e[1:]) for e in ("&amp;", "&lt;", "&#91;", "&#10;")] + [
    (c, {"<": "&lt;", "[": "&#91;"}[c[0]] + c[1:]) for c in chat.CONTROL
]:
    _ESCAPED = f"replace({_ESCAPED}, '{_old}', '{_new}')"



def _add(best: str, cost: str, letter: str) -> str:
    """SQL of cost and letters, the cost first in nine digits so that texts compare as both do, after one edit before."""
    return f"lpad((substr({best}, 1, 9)::INT + {cost})::VARCHAR, 9, '0') || '{letter}' || substr({best}, 10)"


# The best ways on from each state (nothing said, system, user, assistant) before a row, without inserts in front.
_CALLS = {0: 2, 1: 2, 2: 3, 3: 2}
_STEP = ", ".join(
    f"least({_add(f'f{q}', '4', 'D')}, CASE WHEN fault IN (0, 3) AND "
    f"{'said IN (1, 2)' if q == 0 else f'said = {_CALLS[q]}'} THEN "
    f"{_add('[f0, f1, f2, f3][said + 1]', 'extra', 'K')} ELSE 'z' END, "
    f"CASE WHEN fault IN (0, 3) THEN {_add(f'f{_CALLS[q]}', '3 + extra', 'R')} ELSE 'z' END) AS g{q}"
    for q in range(4)
)

ORACLE = {
    # Sixty rounds of the three dimensions, one dimension a step.
    "op3_mixing": """
WITH RECURSIVE named AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
    CASE WHEN contains(text, 'Licensed under') OR contains(text, 'Copyright') THEN 'licence'
      WHEN contains(text, ' | ') THEN 'table' WHEN contains(text, '@') THEN 'contact'
      WHEN length(text) >= 2000 THEN 'long prose' ELSE 'short prose' END AS topic,
    coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r]+')), 0)::BIGINT AS tokens
  FROM documents
), cells AS (
  SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM named GROUP BY ALL HAVING sum(tokens) > 0
), s AS (
  SELECT source, pow(sum(tokens), 0.9) / sum(pow(sum(tokens), 0.9)) OVER () AS share FROM cells GROUP BY source
), l AS (
  SELECT lang, pow(sum(tokens), 0.9) / sum(pow(sum(tokens), 0.9)) OVER () AS share FROM cells GROUP BY lang
), t AS (
  SELECT topic, pow(sum(tokens), 0.9) / sum(pow(sum(tokens), 0.9)) OVER () AS share FROM cells GROUP BY topic
), rake AS (
  SELECT 0 AS step, c.*, s.share AS s, l.share AS l, t.share AS t, 1.0::DOUBLE AS weight
  FROM cells c JOIN s USING (source) JOIN l USING (lang) JOIN t USING (topic)
  UNION ALL
  SELECT step + 1, source, lang, topic, tokens, s, l, t, weight * CASE step % 3
      WHEN 0 THEN s / sum(tokens * weight) OVER (PARTITION BY source)
      WHEN 1 THEN l / sum(tokens * weight) OVER (PARTITION BY lang)
      ELSE t / sum(tokens * weight) OVER (PARTITION BY topic) END
  FROM rake WHERE step < 180
), raked AS (
  SELECT source, lang, topic, weight,
    least(1.0, weight * least(0.9 * sum(tokens) OVER (), 1 / max(weight) OVER ())) AS probability
  FROM rake WHERE step = 180
), m AS (
  SELECT n.*, CASE WHEN n.tokens > 0 THEN weight ELSE 0.0 END AS weight,
    CASE WHEN n.tokens > 0 THEN probability ELSE 1.0 END AS probability
  FROM named n LEFT JOIN raked USING (source, lang, topic)
)
SELECT doc_id, source, lang, topic, tokens, round(weight * 1e9, 3) AS weight, round(probability, 6) AS probability,
  ('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0 < probability AS kept
FROM m
""",
    "op7_warc": f"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM p
), b AS (
  SELECT *, list_aggregate(flatten(list_transform(range(8), lambda g: list_transform(range(4), lambda k:
    substr('{_DIGITS}', 1 + ((('0x' || substr(hex, 1 + 5 * g::INT, 5))::BIGINT >> (15 - 5 * k::INT)) & 31)::INT, 1)
  ))), 'string_agg', '') AS payload_digest FROM d
), g AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first FROM b
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to, true AS verified
FROM g
""",
    "op8_sharding": """
WITH RECURSIVE crc_table(n, k, c) AS (
  SELECT n, 0, n FROM (SELECT unnest(range(256)) AS n)
  UNION ALL
  SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_table WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY n) AS t FROM crc_table WHERE k = 8
), d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc
), p AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto,
    sum(size) OVER () AS whole FROM d
), s AS (
  SELECT *, least((2 * upto - size) * 8 // (2 * whole), 7)::INT AS shard FROM p
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, NULL::INT AS grown_shard
FROM s
""",
    "op10_chat": f"""
WITH t AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, {_ESCAPED} AS body FROM t
), c AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(coalesce(text, ''), '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length(coalesce(role, '')) + length(body) + {len(chat.OPEN) + 1 + len(chat.CLOSE)})::BIGINT AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars FROM c
""",
    "op11_turn_repair": f"""
WITH RECURSIVE crc_table(n, k, c) AS (
  SELECT n, 0, n FROM (SELECT unnest(range(256)) AS n)
  UNION ALL
  SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_table WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY n) AS t FROM crc_table WHERE k = 8
), source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(
      coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS hit
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE hit WHEN 4 THEN 'user' ELSE role END AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM source
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    strpos('sua', substr(role, 1, 1)) * (role <> '')::INT AS said
  FROM damaged
), r AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault,
    lead(said) OVER (PARTITION BY conv_id ORDER BY i) AS following
  FROM numbered
), stats AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (following IS NOT NULL AND (said, following) NOT IN ((1, 2), (2, 3), (3, 2))) AS illegal
  FROM r GROUP BY conv_id
), dp AS (
  SELECT conv_id, n + 1 AS i, lpad('0', 9, '0') AS f0, lpad('6', 9, '0') || 'II' AS f1, lpad('3', 9, '0') || 'I' AS f2,
    lpad('0', 9, '0') AS f3
  FROM stats
  UNION ALL
  SELECT conv_id, i, least(g0, {_add('u', '3', 'I')}), least(g1, {_add('u', '3', 'I')}), u, least(g3, {_add('g2', '3', 'I')})
  FROM (SELECT *, least(g2, {_add('g3', '3', 'I')}) AS u FROM (
    SELECT conv_id, i, {_STEP} FROM (
      SELECT dp.*, r.i, r.said, r.fault, CASE r.fault WHEN 3 THEN 3 ELSE 0 END AS extra
      FROM (SELECT conv_id, i - 1 AS before, f0, f1, f2, f3 FROM dp) dp
      JOIN r ON dp.conv_id IS NOT DISTINCT FROM r.conv_id AND dp.before = r.i)))
), found AS (
  SELECT conv_id, substr(f0, 1, 9)::BIGINT AS cost, substr(f0, 10) AS audit FROM dp WHERE i = 1
), letters AS (
  SELECT conv_id, k, substr(audit, k, 1) AS letter, length(replace(substr(audit, 1, k), 'I', '')) AS i,
    length(replace(substr(audit, 1, k), 'D', '')) AS place, length(replace(audit, 'D', '')) AS places
  FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS k FROM found)
), lines AS (
  SELECT l.conv_id, k, CASE letter WHEN 'K' THEN r.role WHEN 'D' THEN NULL
      ELSE CASE WHEN (places - place) % 2 = 0 THEN 'assistant' ELSE 'user' END END || ':'
    || CASE letter WHEN 'I' THEN '' ELSE r.text END AS line
  FROM letters l LEFT JOIN r ON l.conv_id IS NOT DISTINCT FROM r.conv_id AND l.i = r.i
), repaired AS (
  SELECT conv_id, string_agg(line, chr(10) ORDER BY k) AS body FROM lines GROUP BY conv_id
), ids AS (
  SELECT DISTINCT conv_id AS id FROM conversations
)
SELECT id AS conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM ids LEFT JOIN stats ON id IS NOT DISTINCT FROM stats.conv_id
  LEFT JOIN found ON id IS NOT DISTINCT FROM found.conv_id LEFT JOIN repaired ON id IS NOT DISTINCT FROM repaired.conv_id
""",
    "op12_cuckoo_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""",
}
