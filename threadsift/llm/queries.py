"""The thin queries of the thirteen operators over the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from threadsift.llm import bpe, importance, jaccard_join, mixing, ordermin, periodic, pii, secret_scan, setsketch, sliced_search, tokenio, toxicity, weaksup
from threadsift.session import bounded_batches, checkpoint_path

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            bounded_batches(spark)
            return fn(spark, sf_dir)
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op4_setsketch_dedup")
def op4(spark, sf_dir):
    """Near-duplicate groups on 2-word shingles, Jaccard 0.8 or more."""
    return setsketch.near_groups(table(spark, sf_dir, "documents"), w=2, num=80, den=100)


@query("op2_byte_bpe")
def op2(spark, sf_dir):
    """Byte-level BPE ids of every text, and the bytes decoded from them."""
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op7_token_files")
def op7(spark, sf_dir):
    """Token-id files written in doc_id order and read back."""
    path = checkpoint_path(spark, "token-files")
    tokenio.write_blocks(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, path)
    return tokenio.read_blocks(spark, path)


@query("op1_pii", pii.ORACLE)
def op1(spark, sf_dir):
    """Personal data in every text: confirmed spans of base and added kinds."""
    return pii.digest(table(spark, sf_dir, "documents"))


@query("op9_secrets", secret_scan.ORACLE)
def op9(spark, sf_dir):
    """Secrets in every text, live-looking or widely copied by corpus-wide ownership."""
    return secret_scan.digest(table(spark, sf_dir, "documents"))


@query("op6_source_mix", mixing.ORACLE)
def op6(spark, sf_dir):
    """Words of each document that a mix of the sources at target weights takes."""
    return mixing.mix(table(spark, sf_dir, "documents"), ["doc_id"])


@query("op5_quality_rules")
def op5(spark, sf_dir):
    """Weakly supervised quality: counts, base test and posterior verdict of every text."""
    return weaksup.digest(table(spark, sf_dir, "documents"))


@query("op8_order_minhash")
def op8(spark, sf_dir):
    """Order MinHash fingerprints of every text, its edited version and the next document."""
    return ordermin.neighbours(table(spark, sf_dir, "documents"))


@query("op10_toxicity")
def op10(spark, sf_dir):
    """Toxicity score of every text, learned from positive and unlabelled rows."""
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_importance")
def op3(spark, sf_dir):
    """Documents drawn by importance weight towards labelled good text."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_jaccard_join")
def op11(spark, sf_dir):
    """Documents linked on 3-word shingles, Jaccard 0.9 or more, by prefixes under several token orders."""
    return jaccard_join.linked_groups(table(spark, sf_dir, "documents"), w=3, num=90, den=100)


@query("op12_sliced_search", sliced_search.ORACLE)
def op12(spark, sf_dir):
    """The ten best documents for each benchmark item."""
    return sliced_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


@query("op13_periodic_runs")
def op13(spark, sf_dir):
    """Periodic runs of words in every text, and the text without their repeats."""
    return periodic.digest(table(spark, sf_dir, "documents"))
