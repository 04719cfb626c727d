"""A corpus pipeline: documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns
of ``documents``.  Between stages the rows are written to the shared folder and
read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import jaccard_join, mixing, packing, toxicity
from starloom.llm.common import free_name, table
from starloom.llm.queries import word_bpe
from starloom.sources.staging import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that the severity model rejects go, all others stay as they are.

    The model is fitted on the labels that belong to ``docs``; without labels of
    both kinds nothing goes.  A missing or empty text has no terms and stays, as do
    rows without id; repeated rows are graded alike.  No rows, no rows.
    """
    model = toxicity.toxicity_model(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    name = free_name(docs, "_severity")
    graded = docs.withColumn(name, toxicity.severity(spark, model, F.col("text")))
    return graded.where(~F.col(name)["rejected"]).drop(name)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of near copies the document with the smallest id stays.

    Rows that repeat an id and its text leave one row.  Rows without id stay.
    """
    found = jaccard_join.jaccard_join(docs)
    name = free_name(docs, "_text_hash")
    kept = found.where("kept AND doc_id IS NOT NULL").select("doc_id", F.col("text_hash").alias(name)).distinct()
    hashed = docs.withColumn(name, F.xxhash64(F.col("text").cast("string")))
    named = hashed.where("doc_id IS NOT NULL").join(kept, ["doc_id", name], "left_semi").dropDuplicates(["doc_id", name])
    return named.unionByName(hashed.where("doc_id IS NULL")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents drawn to the target marginals; small cells that cannot meet theirs are kept whole.

    Documents without tokens (a missing or empty text) stay.  A missing source or
    language is a value of its own.  Rows equal in id and text are drawn together.
    Columns with the names used here are left as they are.  No rows, no rows.
    """
    prefix = "_mix_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    return mixing.mix(docs, prefix=prefix, clip=True).where(F.col(f"{prefix}kept")).select(*docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: pieces of all documents in windows of 2,048 ids.

    A missing or empty text is one end id, a missing source is a source of its own;
    repeated rows are packed as often as they occur.  No rows, no pieces.
    """
    return packing.pack(docs, word_bpe())


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_documents),
]

ORACLE_SQL = None  # models, MinHash and a tokenizer are beyond SQL; tests/llm/test_pipeline.py compares by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
