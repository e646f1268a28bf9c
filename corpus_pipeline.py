"""A corpus, stage by stage: documents in, packed training sequences out.

Every stage but the last returns documents with the columns they came with.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.llm import language, neardup, packing, secret_scan, suffix
from oreworks.llm.queries import CAPACITY, END_ID, table
from oreworks.llm.shipping import ship
from oreworks.llm.storage import cut

#: Repeated strings of so many bytes (some fifty tokens) go, but for the first copy.
REPEATED_BYTES = 200


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter and those like none of the languages."""
    ship(spark)
    return language.recognised(docs, language.learn(docs))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id; of rows that repeat an id and
    a text, one. Groups none of whose rows has an id stay."""
    ship(spark)
    key = lambda copy: {"_key1": F.xxhash64("doc_id", copy), "_key2": copy}
    found = neardup.near_duplicates(docs)
    kept = found.where("kept").withColumns(key(F.col("copy"))).select("_key1", "_key2")
    rows = docs.withColumns(key(F.xxhash64(F.col("text").cast("string"))))
    return rows.join(kept, ["_key1", "_key2"], "left_semi").dropDuplicates(["_key1", "_key2"]).select(*docs.columns)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated passages out of the texts, but for their first copy."""
    ship(spark)
    return suffix.shortened(suffix.removals(docs, REPEATED_BYTES, keep_first=True))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the texts."""
    ship(spark)
    return secret_scan.redacted(docs, secret_scan.train(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    ship(spark)
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY, END_ID), CAPACITY)


STAGES = [
    ("language ID", identify),
    ("MinHash near-dedup", deduplicate),
    ("suffix-array dedup", remove_repeats),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack),
]

#: Learned models, signatures and tokenizers are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; what a stage returns is cut from its lineage."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, cut(docs) if number else docs, sf_dir)
    return docs
