"""The corpus pipeline: quality rules, near-duplicate removal, secret masking, mixing, byte-level BPE.

Stages take documents of any size and any ids, null and repeated ones too, and empty tables; columns other than those of
`documents` are left out. What each makes of null, empty and equal rows stands with it. Every stage is tested against a plain
version over whole tables with very long, empty and repeated texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.llm import bpe_sql, minhash, mixing, quality, secrets
from shelfline.llm.frames import stored, table
from shelfline.llm.queries import MULTI

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and the n-gram verdict. Null, empty and short texts don't; equal rows are
    judged alike and all stay or go."""
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    return quality.judge(docs, quality.log_ratios(docs, trusted)).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, null after all others, then with
    the smallest hash of the text. Documents are told apart by text, so ids may repeat or be missing."""
    return minhash.one_of_each(docs.select(*COLUMNS))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets masked; null and empty texts stay as they are. Equal texts are scanned once."""
    found = secrets.scan(docs, secrets.ledger_of(spark))
    masked = found.withColumn("text", secrets.masked("text", F.col("findings")))
    return masked.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row for each time that words of a document are taken. Null, empty and wordless texts
    have none; of equal rows each is a document of its own. A null source is a source."""
    mixed = mixing.mixed_texts(docs.select(*COLUMNS))
    return mixed.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, checked by decoding them again; null and empty texts have none. A row each, repeated ones
    too."""
    coded = bpe_sql.round_trip(docs.select(*COLUMNS), public_tokenizers.path(MULTI))
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    checked = F.when(same, F.col("ids")).otherwise(F.raise_error(F.lit("a text doesn't survive encoding")))
    return coded.select("doc_id", "lang", "source", checked.alias("ids"), F.size("ids").cast("bigint").alias("n_tokens"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix", mix),
    ("encode", encode),
]

#: Encoding can't be said in SQL: tests/llm/test_plain_pipeline.py holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
