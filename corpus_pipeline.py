"""A training corpus from ``documents``: toxic documents go, one of each near-duplicate group stays,
live-looking secrets are masked, sources are mixed to their weights, and the rest is encoded.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents.  Between two stages the result is written to the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift.llm import bpe, mixing, secret_scan, setsketch, toxicity
from threadsift.llm.queries import table
from threadsift.llm.text import written
from threadsift.session import bounded_batches

#: word shingles and similarity of the near-duplicate stage
SHINGLE, NUM, DEN = 5, 80, 100


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents predicted toxic go."""
    bounded_batches(spark)
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the document of smallest doc_id of each group stays (and rows without doc_id)."""
    bounded_batches(spark)
    groups = setsketch.near_groups(docs, SHINGLE, NUM, DEN)
    gone = written(groups.filter(~F.col("kept")).select("doc_id").distinct(), "near-copies")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: live-looking secrets are masked, the documents stay."""
    repo = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    out = secret_scan.redacted(docs, F.col("source"), repo)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: sources at their target weights; a row per epoch."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: ids of every text, with digests of the ids and of the bytes decoded from them."""
    bounded_batches(spark)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, ["lang", "source", "n_chars"])


STAGES = [("toxicity", toxic_out), ("near_dedup", near_dedup), ("secrets", mask_secrets), ("mix", mix_sources), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs


#: a fitted classifier, sketches and BPE have no SQL; the tests hold run() against brute force
ORACLE_SQL = None
