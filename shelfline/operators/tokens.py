"""Token counts over a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfline.functions.text import STOP_WORDS, tokens


def token_counts(
    df: DataFrame, col: str, stop_words: list[str] = STOP_WORDS, min_bytes: int = 2,
    letters_only: bool = False,
) -> DataFrame:
    """word, word_count over whole texts.

    Words are filtered before the group by and counted map-side, so a word that fills a third of
    the corpus crosses the network as one partial count per task.
    """
    word = F.col("word")
    keep = (F.octet_length(word) >= min_bytes) & ~word.isin(stop_words)
    return (
        df.filter(F.col(col).isNotNull())
        .select(F.explode(tokens(F.col(col), letters_only)).alias("word"))
        .filter(keep)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("word_count"))
    )
