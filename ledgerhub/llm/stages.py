"""Stages of the corpus pipeline: each applies one operator to all documents that are left.

A stage takes (spark, docs, sf_dir). All but the last return the columns of documents; ``docs`` may
have more columns, which are dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerhub.llm import bpe, jaccard, langid, mixing, quality
from ledgerhub.llm.common import long_rows, written_once
from ledgerhub.llm.queries import DOMAIN_SQL, MIX_SEED, MIX_WEIGHTS
from ledgerhub.sizing import broadcast_within

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; a null lang becomes the one found.

    Learns from the labelled ones of ``docs``, leaving out the held-out fold.
    """
    long_rows(spark)
    docs = docs.select(*DOCUMENT)
    found = langid.identify(docs, langid.fit(docs.where(~langid.held_out()))).where("not rejected")
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*DOCUMENT)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the limits of their language and source."""
    docs = docs.select(*DOCUMENT)
    return quality.passing(docs).select(*DOCUMENT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id; rows without id all stay.

    Null and empty texts are no duplicates of anything. Rows that repeat an id stay or go together.
    """
    long_rows(spark)
    docs = docs.select(*DOCUMENT)
    found = jaccard.classes(docs)
    others = written_once(found.where("component_id < doc_id").select("doc_id").distinct(), "stage-others")
    return docs.join(broadcast_within(others), "doc_id", "left_anti").select(*DOCUMENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget uses them; a document used twice is two rows.

    Null and empty texts have no words, so they use no budget and come and go with their source's epochs. Null
    languages and sources are '' in the tree. Rows that repeat an id are used together.
    """
    docs = docs.select(*DOCUMENT)
    return mixing.mix(docs, F.expr(DOMAIN_SQL), MIX_WEIGHTS, seed=MIX_SEED).select(*DOCUMENT)


def bpe_coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and token ids, and whether decoding gave the text back, of every row.

    A null text counts as '' and has no tokens.
    """
    long_rows(spark)
    tables = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    coded = bpe.round_trip(docs.select(*DOCUMENT), tables)
    same = F.col("decoded_text") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "lang", "source", "n_tokens", "token_ids", same.alias("round_trip"))
