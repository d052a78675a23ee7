"""Shards by proportional stratified interleaving.

Within each source, rows are put in a seeded order and ranked. Row r of a source with n rows has the fractional rank
(r + u) / n, where u in (0, 1) is the source's own, by a hash: else sources of one row would all meet at 1/2. All rows are put in
order of it, so that any stretch of that order holds each source in proportion, to within a row, and the
order is cut into shards whose counts differ by one at most.

No source, and not the whole, is put in order by one task. Both orders are summed in two levels: the seeded order is
that of an MD5 of the row, whose first digits deal a source evenly into chunks; fractional ranks of every source are even
in (0, 1), and so are stretches of them. Rows that are equal in all columns can't be told apart by any hash: they are one row
with a count until their ranks are known. Texts go into the hash where they are read; no text is shuffled by `plan`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.llm.frames import running_total, stored

SHARDS = 40
SEED = 7
#: Hexadecimal digits of the hash that deal the rows of a source: 4,096 chunks.
DIGITS = 3
#: Stretches of the fractional rank.
STRETCHES = 1 << 14
#: Equal rows that one row is multiplied to at a time.
COPIES = 1 << 12
#: Bytes that a row costs besides its text.
OVERHEAD = 16


def mark(columns: list[tuple[str, bool]], seed: int = SEED) -> Column:
    """An MD5 of the seed and the given columns, as hexadecimal digits: columns marked true as text, others as JSON."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) if t else F.to_json(F.struct(c)) for c, t in columns]
    return F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *parts).cast("binary"))


def phase(source: Column, seed: int = SEED) -> Column:
    """A number between 0 and 1 for each source."""
    digits = F.substring(F.md5(F.concat_ws("\x1f", F.lit(str(seed)), source.cast("string")).cast("binary")), 1, 8)
    return (F.conv(digits, 16, 10).cast("bigint") + 0.5) / float(1 << 32)


def _marked(df: DataFrame, key: str, text: str, source: str, seed: int) -> Column:
    others = [c for c in df.columns if c not in (key, text, source)]
    return mark([(source, True), (key, True), *((c, False) for c in others), (text, True)], seed)


def plan(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", shards: int = SHARDS,
         seed: int = SEED) -> DataFrame:
    """One row per input row: key, source, size, text_crc32, mark, shard and slot, the place in its shard.

    Size is the number of UTF-8 bytes plus OVERHEAD; a null text counts as an empty one. A null source is a
    source like any other. Rows that are equal in all columns get places of their own, any of them either.
    Equal fractional ranks go by source in code point order, null last. Without rows there are no shards; with fewer rows
    than shards some shards stay empty. Other columns take part in the hash and aren't carried, so their names can't clash.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = df.select(
        F.col(source).alias("source"), F.col(key).alias("key"), _marked(df, key, text, source, seed).alias("mark"),
        (F.octet_length(body) + OVERHEAD).cast("bigint").alias("size"), F.crc32(body.cast("binary")).alias("crc"))
    distinct = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    each = _multiplied(stored(distinct, "rows")).withColumn("one", F.lit(1))
    own = F.md5(F.concat_ws(":", "mark", F.col("copy").cast("string")).cast("binary"))
    each = each.withColumn("order", own).drop("copies", "copy")
    ranked = running_total(each, ["source"], F.substring("order", 1, DIGITS), [F.col("order")], "one", "rank")
    totals = each.groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("source", "_source")
    known = ranked.join(totals, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    known = known.withColumn("fraction", (F.col("rank") + phase(F.col("source"), seed)) / F.col("n"))
    stretch = F.floor(F.col("fraction") * STRETCHES)
    # A source has each fraction once.
    placed = running_total(known, [], stretch, [F.col("fraction"), F.col("source").asc_nulls_last()], "one", "place")
    n = totals.agg(F.sum("n")).first()[0] or 0
    shard = F.expr(f"place * {shards} div {max(n, 1)}")
    start = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select(
        F.col("key").alias(key), F.col("source").alias(source), "size", F.col("crc").alias("text_crc32"), "mark",
        F.col("shard").cast("int").alias("shard"), (F.col("place") - start).alias("slot"))


def _multiplied(rows: DataFrame) -> DataFrame:
    """A row for each of `copies`, numbered from 0; many copies of a row are made by many tasks."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few, many = rows.filter(f"copies <= {COPIES}"), rows.filter(f"copies > {COPIES}")
    made = few.select("*", F.explode(F.expr("sequence(0L, copies - 1)")).alias("copy"))
    dealt = many.select("*", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")).alias("part"))
    more = dealt.repartition(width, "mark", "part").select("*", F.explode(F.expr(
        f"sequence(part * {COPIES}, least(copies, (part + 1) * {COPIES}) - 1)")).alias("copy"))
    return made.unionByName(more.drop("part"))


def sharded(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", shards: int = SHARDS,
            seed: int = SEED) -> DataFrame:
    """The input rows with their shard and slot, replacing columns named so. Each different row is shuffled once, however many
    copies of it there are."""
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    rows = df.select(*kept)
    whole = rows.select(_marked(rows, key, text, source, seed).alias("mark"), F.struct("*").alias("row"))
    once = whole.groupBy("mark").agg(F.first("row").alias("row"))
    places = plan(rows, key, text, source, shards, seed).select("mark", "shard", "slot")
    return places.join(once, "mark").select(*[F.col(f"row.`{c}`").alias(c) for c in kept], "shard", "slot")
