"""Quality rules: fixed limits on a text's shape, and a hashed n-gram log-likelihood ratio.

Tokens are runs of letters and digits, or runs of other signs. Their uni- and bigrams are hashed into BUCKETS
counts, once over a trusted target and once over the raw corpus, every document included. A document's score
is the sum of log(p_target / p_raw) over its n-grams divided by their number; the verdict compares it with a
fixed threshold. All of it is built-in DataFrame functions.

Only the BUCKETS weights leave the executors, whatever the corpus: one row, read as a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.llm.frames import let, unused, words_of

#: Number of hashed n-gram counts. 1 << 14 doubles are 128 KB.
BUCKETS = 1 << 14
#: Documents whose mean log ratio is below this are rejected.
THRESHOLD = -0.25
TOKENS = r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}\s]+"
SIGNS = r"[#*$%&|<>]"
MIN_WORDS = 50


def ngram_buckets(text: str = "text", buckets: int = BUCKETS) -> Column:
    """The bucket of each token and of each pair of neighbouring tokens; null and empty texts have none."""
    tokens = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(TOKENS), F.lit(0))
    hashes = F.transform(tokens, lambda t: F.xxhash64(t))

    def grams(h: Column) -> Column:
        single = F.transform(h, lambda x: F.pmod(x, F.lit(buckets)).cast("int"))
        pairs = F.zip_with(h, F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0))),
                           lambda a, b: F.when(b.isNotNull(), F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int")))
        return F.concat(single, F.slice(pairs, 1, F.greatest(F.size(h) - 1, F.lit(0))))

    return let(hashes, grams)


def log_ratios(documents: DataFrame, trusted: DataFrame, text: str = "text", key: str = "doc_id",
               buckets: int = BUCKETS) -> DataFrame:
    """One row, `weights`: log(p_target / p_raw) of every bucket, add-one smoothed, in order of bucket.

    `trusted` lists the keys of the target documents; repeated or null keys change nothing. Without any
    trusted document every weight is 0.
    """
    target = trusted.select(F.col(key).alias("_key")).filter("_key IS NOT NULL").distinct()
    target = target.withColumn("_target", F.lit(True))
    # Labels grow with the corpus, so the join is a merge at every size rather than a broadcast at some.
    marked = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(
        target.hint("merge"), "_key", "left")
    counts = (
        marked.select("_target", F.explode(ngram_buckets("_text", buckets)).alias("bucket"))
        .groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("_target").alias("target"))
    )
    every = documents.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    counts = every.join(counts, "bucket", "left").fillna(0)
    # At most `buckets` rows come together here.
    one = counts.agg(
        F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"),
        F.array_sort(F.collect_list(F.struct("bucket", "raw", "target"))).alias("counts"),
    )
    ratio = lambda c: (
        F.log((c["target"] + 1) / (F.col("n_target") + buckets)) - F.log((c["raw"] + 1) / (F.col("n_raw") + buckets))
    )
    weight = lambda c: F.when(F.col("n_target") > 0, ratio(c)).otherwise(F.lit(0.0))
    return one.select(F.transform("counts", weight).alias("weights"))


def shape(text: str = "text", words_as: str = "_counted") -> dict[str, Column]:
    """Counts of words and repetition in each whole text, all 0 for null and empty texts; those of words as one struct."""
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike(r"[^ \x09-\x0D]"))

    def repeated(words: Column) -> Column:
        """Words in 3-word windows that occur twice or more."""
        last = F.size(words) - 2
        places = F.sequence(F.lit(1), last)
        window = lambda i: F.array(*[F.element_at(words, i + k) for k in range(3)])
        hashed = F.transform(places, lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(3)]))
        # Exact, for texts in which some window's hash recurs: sorted by content, equal windows are neighbours. No null is
        # sorted, so this is array_sort without its comparing expression, which is evaluated for every pair.
        ranked = F.sort_array(F.transform(places, lambda i: F.struct(window(i).alias("w"), i.alias("i"))))

        def covered(s: Column) -> Column:
            same = lambda j: F.get(s, j)["w"] == F.get(s, j + 1)["w"]
            starts = F.sort_array(F.filter(
                F.transform(F.sequence(F.lit(0), last - 1), lambda j: F.when(
                    F.coalesce(same(j), F.lit(False)) | F.coalesce(same(j - 1), F.lit(False)), F.get(s, j)["i"])),
                lambda i: i.isNotNull()))
            added = lambda q: F.transform(
                F.sequence(F.lit(0), F.size(q) - 1),
                lambda j: F.when(j == 0, F.lit(3)).otherwise(F.least(F.lit(3), F.get(q, j) - F.get(q, j - 1))))
            return let(starts, lambda q: F.when(
                F.size(q) > 0, F.aggregate(added(q), F.lit(0), lambda a, x: a + x)).otherwise(F.lit(0)))

        recurs = let(hashed, lambda h: F.size(F.array_distinct(h)) < F.size(h))
        return F.when(last < 2, F.lit(0)).when(recurs, let(ranked, covered)).otherwise(F.lit(0))

    words = words_of(text)
    counted = let(words, lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        repeated(w).cast("bigint").alias("n_repeat_words"),
    ))
    return {
        words_as: counted,
        "n_symbols": F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(SIGNS)).cast("bigint"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
    }


def judge(df: DataFrame, weights: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds the counts of `shape`, base_failed, log_ratio (null without n-grams) and kept to each document.

    A document is kept if it passes the base limits and its log_ratio is at least `threshold`. Null and
    empty texts fail the base limits. Input columns and repeated rows stay; columns already named like a
    result are replaced. Very long texts are counted whole, in one row. An empty table gives an empty table.
    """
    held, words, mean_ratio = unused(df, "_weights", "_counted", "_score")
    mean = lambda b: F.when(F.size(b) > 0, F.aggregate(
        b, F.lit(0.0), lambda a, i: a + F.get(held, i)) / F.size(b))
    scored = df.withColumn(held, weights.scalar()).withColumns({**shape(text, words), mean_ratio: let(ngram_buckets(text), mean)})
    # One expression over the struct: a filter on the verdict that is pushed below would split words once for each field it names.
    failed = let(F.col(words), lambda c: (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"]))
    added = {c: F.col(f"{words}.{c}") for c in ("n_words", "word_chars", "n_repeat_words")}
    return (
        scored.withColumns({**added, "log_ratio": F.col(mean_ratio)})
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("log_ratio") >= threshold, F.lit(False)))
        .drop(words, mean_ratio, held)
    )
