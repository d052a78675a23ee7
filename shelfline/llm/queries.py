"""The registered queries of this package: each applies its operator to a whole table of `sf_dir`."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.llm import (
    alignment, bpe_sql, minhash, mixing, quality, rabitq, secrets, sharding, substrings, token_count, toxicity,
    url_templates, vector_codes,
)
from shelfline.llm.frames import stored, table

MULTI = "byte_bpe_multi_50k.tiktoken"
SINGLE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
#: The rules of the page query.
URL_RULES = (
    url_templates.Rule("block", "net/"),
    url_templates.Rule("allow", "example.net/en/"),
    url_templates.Rule("block", "example.com/de/"),
    url_templates.Rule("allow", "org/fr/"),
)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_sql.round_trip(docs, public_tokenizers.path(MULTI))
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(fold != 2))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op3_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.ledger_of(spark))
    base = F.filter("findings", lambda f: f["rule"] < len(secrets.BASE))
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id", *[count(rule.kind).alias(f"n_{rule.kind}") for rule in secrets.BASE],
        F.sha2(secrets.told(base).cast("binary"), 256).alias("base_sha256"), secrets.told(F.col("findings")).alias("spans"))


def op4_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    judged = quality.judge(docs, quality.log_ratios(docs, trusted))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ratio")


def op5_binary_code_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_heap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_count.budget(docs, public_tokenizers.path(SINGLE))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op7_block_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_radix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    # The size is taken before, so that the last join carries no text.
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text", size.alias("n_bytes")))
    return cut.select(
        "doc_id", "n_bytes", substrings.size_of("removed").alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_bytes") - substrings.size_of("removed")).alias("n_kept"),
        F.array_join(F.transform("removed", lambda r: F.concat_ws(":", *[r[c].cast("string") for c in ("start", "end")])), ",").alias("removed"))


def op10_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_templates.judge(pages, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template")


def op11_fragment_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = public_tokenizers.path(SINGLE), public_tokenizers.path(PIECES)
    # Both the counts and the documents' sums read it.
    rows = stored(alignment.linked(docs, *paths, keep=["doc_id"]), "linked")
    found = alignment.scored(rows, alignment.shared_counts(alignment.link_counts(rows)))
    return found.select(
        "row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_sliced_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"), keep=["vec_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_byte_bpe, op2_counterfactual_toxicity, op3_secret_ledger, op4_ngram_quality, op5_binary_code_vectors,
        op6_heap_token_counts, op7_block_mix, op8_hyperminhash, op9_radix_repeats, op10_url_templates,
        op11_fragment_alignment, op12_interleaved_shards, op13_sliced_codes,
    )
}
