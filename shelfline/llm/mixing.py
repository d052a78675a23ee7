"""Mixing sources to target weights by fixed-length blocks, multinomial draws and index permutations.

The words of a source, document after document, are cut into blocks of equal length, at most BLOCK words, and at
least PIECES blocks if the source has as many words. A source expects as many slots as its target has blocks, and
gets the whole number below or above by one draw on the fraction: then it is within a block of its target, however
small it is and however many there are.

The output is made of shards of about SHARD slots. Every slot of a source falls on one of them by a draw, so the counts of a
source over the shards are multinomial; as its slots are given, no draw takes it off its target. (Draws of a source
for every slot of a shard, which fix the shards' sizes instead, left out a third of all small sources.) A source's slots,
numbered over all shards, map to blocks through a pseudorandom permutation of the block indices (swap-or-not rounds), one
pass after the other, so each block is taken either k or k + 1 times. Blocks are then joined by index.

Everything random is integer arithmetic on shard, slot and index numbers, so a rerun gives the same mix, and
SQL can restate it. All this goes by sizes and hashes; texts are shuffled once, where the mix itself is asked
for. Hot sources are spread: offsets are summed in two levels, and blocks and slots meet on (source, block). The table of
sources, one row each, is put in order in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.llm.frames import let, running_total, stored, words_of
from shelfline.llm.sharding import mark

BLOCK = 128
SHARD = 4096
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
ROUNDS = 16
CHUNKS = 4096
#: Blocks of a source that is small, if it has as many words.
PIECES = 32
#: A Mersenne prime; the square of a value below it fits a long.
PRIME = 2147483647


def scramble(value: Column) -> Column:
    """A number below PRIME from a non-negative long, by a line and a square, twice, modulo PRIME."""
    x = (value % PRIME * 1103515245 + 12345) % PRIME
    x = (x * x % PRIME + 214013) % PRIME
    return x * x % PRIME


def permuted(df: DataFrame, index: str, n: str, key: str, out: str) -> DataFrame:
    """Adds the place of `index` under a permutation of 0 .. n - 1 chosen by `key`: in each round, an
    index and its mirror image about a round key change places or not, by a bit that both share."""
    rounds = F.sequence(F.lit(1), F.lit(ROUNDS)).cast("array<bigint>")

    def step(x: Column, r: Column) -> Column:
        turn = (F.col(key).cast("bigint") * 69621 + r * 48271) * 16807 % PRIME
        other = F.pmod(turn * turn - x, F.col(n))
        bit = F.shiftright(scramble(F.greatest(x, other) + turn), 9) % 2
        return F.when(bit == 1, other).otherwise(x)

    return df.withColumn(out, F.aggregate(rounds, F.col(index).cast("bigint"), step))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds rank, weight and target to a table (source, source_size).

    Sources in code point order, null last, get the weights in turn and share `share` times all sizes by
    them. A target stops at `most` times its source's size and the excess goes to the others by weight.
    The fixed point is min(most * size, level * weight): with sources in order of size by weight, a source
    is full if the level that fills all before it and shares the rest exceeds its own limit.
    """
    in_order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("rank", F.row_number().over(in_order) - 1)
    ranked = ranked.withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    everything = Window.orderBy(F.col("source_size") / F.col("weight"), "rank").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        F.sum("source_size").over(everything) * share - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    leveled = ranked.withColumn("_level", level)
    # The first source that isn't filled fixes the level.
    open_level = F.when(F.col("_level") * F.col("weight") <= most * F.col("source_size"), F.col("_level"))
    final = F.first(open_level, ignorenulls=True).over(everything)
    limit = (most * F.col("source_size")).cast("double")
    return leveled.withColumn("_final", final).withColumn(
        "target", F.coalesce(F.least(limit, F.col("_final") * F.col("weight")), limit)
    ).drop("_level", "_final")


def blocks_of(size: Column, block: int) -> Column:
    """The number of blocks of a source of `size` words."""
    return F.greatest(F.ceil(size / F.lit(block)).cast("bigint"), F.least(size, F.lit(PIECES))).cast("bigint")


def block_start(index: Column, size: Column, block: int) -> Column:
    """The first word of a block. Blocks differ by a word at most, the longer ones come first."""
    n = blocks_of(size, block)
    return index * F.floor(size / n).cast("bigint") + F.least(index, size % n)


def block_at(word: Column, size: Column, block: int) -> Column:
    """The index of the block that holds a word."""
    n = blocks_of(size, block)
    short, longer = F.floor(size / n).cast("bigint"), size % n
    beyond = word - longer * (short + 1)
    return F.when(beyond < 0, F.floor(word / (short + 1))).otherwise(longer + F.floor(beyond / short)).cast("bigint")


def slot_counts(plan: DataFrame, block: int, most: int) -> DataFrame:
    """Rows (rank, n_blocks, n): the slots of each source that has any."""
    n = blocks_of(F.col("source_size"), block)
    # A draw by rank decides on the fraction, as whole numbers.
    expected = F.col("target") / F.col("source_size") * n
    part = F.round((expected - F.floor(expected)) * 1_000_000).cast("bigint")
    drawn = (scramble(F.col("rank").cast("bigint") * 1_000_003 + 1) % 1_000_000 < part).cast("bigint")
    return plan.filter("target > 0").select(
        "rank", n.alias("n_blocks"), F.least(F.floor(expected).cast("bigint") + drawn, n * most).alias("n")).filter("n > 0")


def shard_counts(counts: DataFrame, shard: int) -> DataFrame:
    """Rows (rank, n_blocks, shard, n): how many slots of a source each output shard gets, by a draw for each slot."""
    width = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_shards = counts.agg(F.ceil(F.sum("n") / F.lit(shard)).cast("bigint")).scalar()
    # In stretches, so that the draws of a large source are made by many tasks.
    stretches = counts.select("*", F.explode(F.expr(f"sequence(0L, (n - 1) div {SHARD})")).alias("stretch"))
    draws = stretches.repartition(width, "rank", "stretch").select("rank", "n_blocks", F.explode(F.expr(
        f"sequence(stretch * {SHARD}, least(n, (stretch + 1) * {SHARD}) - 1)")).alias("draw"))
    fallen = scramble(F.col("rank").cast("bigint") * 1_000_003 + F.col("draw") + 2) % n_shards
    return draws.groupBy("rank", "n_blocks", fallen.alias("shard")).agg(F.count(F.lit(1)).alias("n"))


def slots(plan: DataFrame, block: int, shard: int, most: int) -> DataFrame:
    """Rows (rank, index, times): how often the mix takes each block that it takes."""
    width = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = stored(shard_counts(slot_counts(plan, block, most), shard), "shards")
    numbered = running_total(counts, ["rank"], F.floor(F.col("shard") / F.lit(CHUNKS)), [F.col("shard")], "n", "first")
    # A few bytes a row become many slots: a fixed number of partitions, which isn't merged for small bytes.
    each = numbered.repartition(width, "rank", "shard").select(
        "rank", "n_blocks", F.explode(F.expr("sequence(first, first + n - 1)")).alias("slot"))
    mapped = permuted(each.withColumn("_place", F.col("slot") % F.col("n_blocks")), "_place", "n_blocks", "rank", "index")
    return mapped.groupBy("rank", "index").agg(F.count(F.lit(1)).alias("times"))


def _chunk(df: DataFrame, key: str) -> Column:
    """Spreads the documents of a source: consecutive whole-number keys go to different chunks."""
    whole = dict(df.dtypes)[key] in ("bigint", "int", "smallint", "tinyint")
    return F.coalesce(F.pmod(F.col(key).cast("bigint") if whole else F.xxhash64(key), F.lit(CHUNKS)), F.lit(0))


def _mixed(df: DataFrame, key: str, text: str, source: str, block: int, shard: int, weights: tuple[int, ...],
           share: float, most: int, mark: Column, carry: bool) -> DataFrame:
    """Rows of the mix: key, source, mark, size, source_size, target, start, taken, and with `carry` the blocks that the mix
    takes of it. `mark` tells rows with equal keys apart."""
    rows = stored(df.select(
        F.col(key).alias("key"), F.col(source).alias("source"), F.size(words_of(text)).cast("bigint").alias("size"),
        mark.alias("mark")), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stored(targets(sizes, weights, share, most), "targets")
    placed = running_total(
        rows, ["source"], _chunk(rows, "key"), [F.col("key").asc_nulls_first(), F.col("size"), F.col("mark")], "size", "start")
    known = stored(placed.join(plan.alias("p"), placed["source"].eqNullSafe(F.col("p.source"))).select(
        placed["key"], placed["source"], "mark", "size", "start", "rank", "source_size", "target"), "places")
    all_words = F.col("source_size")
    parts = known.filter("size > 0").select("rank", "start", "size", "source_size", F.explode(F.sequence(
        block_at(F.col("start"), all_words, block),
        block_at(F.col("start") + F.col("size") - 1, all_words, block))).alias("index"))
    overlap = F.least(F.col("start") + F.col("size"), block_start(F.col("index") + 1, all_words, block)) - F.greatest(
        F.col("start"), block_start(F.col("index"), all_words, block))
    # A document is a stretch of its source: (rank, start) is its own, also among repeated rows. Both sides grow with the
    # corpus, so the joins are merges at every size.
    taken = (
        parts.select("rank", "start", "index", overlap.alias("n"))
        .join(slots(plan, block, shard, most).hint("merge"), ["rank", "index"])
        .groupBy(F.col("rank").alias("_rank"), F.col("start").alias("_first")).agg(
            F.sum(F.col("n") * F.col("times")).alias("taken"),
            *[F.array_sort(F.collect_list(F.struct("index", "times"))).alias("blocks")] * carry)
    )
    keyed = known.withColumn("_start", F.when(F.col("size") > 0, F.col("start")))
    same = (F.col("rank") == F.col("_rank")) & (F.col("_start") == F.col("_first"))
    return keyed.join(taken.hint("merge"), same, "left").select(
        "key", "source", "mark", "size", "source_size", "target", "start",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), *["blocks"] * carry)


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        block: int = BLOCK, shard: int = SHARD, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
        most: int = MOST) -> DataFrame:
    """One row per input row: key, source, size, source_size, target and taken, the words that the mix takes
    from the document, repeats counted.

    Size is the number of words of the whole text, however long; null and empty texts have 0 and nothing taken. A null
    source is a source like any other. Repeated rows and repeated or null keys are documents of their own. Other columns are
    not carried, so their names can't clash. An empty table gives an empty table.
    """
    out = _mixed(df, key, text, source, block, shard, weights, share, most, F.xxhash64(F.col(text)), False)
    return out.select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", "taken")


def mixed_texts(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                block: int = BLOCK, shard: int = SHARD, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                most: int = MOST) -> DataFrame:
    """The mix itself, with the columns of the input: one row for each time that words of a document are
    taken, at most `most`.

    The first row of a document has the words that the mix takes once or more, the second those that it
    takes twice, and so on. A text that is taken whole stays as it is; of others the taken words are joined
    by spaces. Documents of which nothing is taken, null and empty texts among them, are left out. Rows that are equal in all
    columns meet their texts as one row; an empty table gives an empty table.
    """
    others = [c for c in df.columns if c not in (key, text, source)]
    whole = mark([(source, True), (key, True), *((c, False) for c in others), (text, True)])
    out = _mixed(df, key, text, source, block, shard, weights, share, most, whole, True).filter("taken > 0")
    rounds = F.sequence(F.lit(1), F.aggregate("blocks", F.lit(0).cast("bigint"), lambda a, b: F.greatest(a, b["times"])).cast("int"))
    each = out.select("mark", "size", "source_size", "start", "blocks", F.explode(rounds).alias("round"))
    # Dealt by the mark first, so that only the joining side sorts texts.
    once = df.select(whole.alias("mark"), F.struct("*").alias("row")).repartition("mark").groupBy("mark").agg(F.first("row").alias("row"))
    each = each.join(once.hint("merge"), "mark")
    body = F.col(f"row.`{text}`")

    def cut(words: Column) -> Column:
        at = lambda index: block_start(index, F.col("source_size"), block) - F.col("start")
        first = lambda b: F.greatest(at(b["index"]), F.lit(0))
        last = lambda b: F.least(at(b["index"] + 1), F.col("size"))
        some = F.filter("blocks", lambda b: b["times"] >= F.col("round"))
        taken = F.flatten(F.transform(some, lambda b: F.slice(words, (first(b) + 1).cast("int"), (last(b) - first(b)).cast("int"))))
        return let(taken, lambda t: F.when(F.size(t) == F.col("size"), body).otherwise(F.array_join(t, " ")))

    made = each.withColumn("_text", let(words_of(body), cut))
    return made.select(*[F.col("_text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in df.columns])
