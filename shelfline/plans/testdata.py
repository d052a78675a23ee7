"""Stand-ins for the catalogue, its landing files and its commit log, derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shelfline.operators.replication import ADDED, DELETED
from shelfline.session import run_dir
from shelfline.sources.landing import entry_pages, write_pages
from shelfline.sources.listing import footers, list_files
from shelfline.sources.sinks import publish_partitions
from shelfline.sources.snapshots import EXISTING
from shelfline.sources.tables import read_published, read_table

PAGE_ENTRIES = 500


def _year_start(year: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-01-01"))


def catalog_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped catalogue, one row per (appid, dt): parts are the entries, line items per
    shipping year their reviews. Unused columns are pruned down to the line-item scan."""
    suppliers = read_table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    kept = F.col("l_partkey") % 97 != 0
    returned = F.col("l_returnflag") == "R"
    # Line items come in order of their orders, so a task meets few of them twice under a part and year: combining them
    # before a shuffle would fill its memory and ship as many rows. One shuffle by part serves the counts and the join.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_year = (
        read_table(spark, sf_dir, "lineitem")
        .withColumn("yr", F.year("l_shipdate"))
        .repartition(width, "l_partkey")
        .groupBy("l_partkey", "yr")
        .agg(
            F.sum(F.when(kept & ~returned, 1).otherwise(0)).alias("positive"),
            F.sum(F.when(kept & returned, 1).otherwise(0)).alias("negative"),
            (F.sum("l_quantity") * 10).cast("bigint").alias("average_forever"),
            F.sum(F.when(F.col("l_linenumber") == 1, F.col("l_quantity")).otherwise(0.0))
            .cast("bigint").alias("average_2weeks"),
            F.countDistinct("l_orderkey").alias("ccu"),
            F.max("l_shipdate").alias("ingestion_timestamp"),
        )
    )
    key = F.col("p_partkey")
    suffix = (
        F.when(key % 5 == 0, ", llc").when(key % 5 == 1, ", co., ltd.").when(key % 5 == 2, ", inc.")
        .when(key % 5 == 3, ", incredible works").otherwise("")
    )
    first = F.concat(F.lit("supplier#"), (key % suppliers).cast("string"), suffix)
    second = F.concat(F.lit("supplier#"), ((key * 7 + 3) % suppliers).cast("string"))
    brand_tail = (
        F.when(F.col("p_size") % 3 == 0, ", corp.").when(F.col("p_size") % 3 == 1, ", brand#0")
        .otherwise("")
    )
    hours = F.col("average_forever")
    parts = read_table(spark, sf_dir, "part")
    return per_year.join(parts, F.col("l_partkey") == key).select(
        key.alias("appid"),
        F.lower("p_name").alias("game_title"),
        F.when(key % 41 == 0, F.lit(None)).when(key % 43 == 0, F.lit(""))
        .otherwise(F.concat_ws(", ", first, second)).alias("developer"),
        F.lower(F.concat("p_brand", brand_tail)).alias("publisher"),
        F.lit(None).cast("string").alias("score_rank"),
        "positive", "negative",
        F.lit(0).cast("bigint").alias("userscore"),
        F.when(hours < 500, "0 .. 20,000").when(hours < 1000, "20,000 .. 50,000")
        .when(hours < 1500, "200,000 .. 500,000").otherwise("1,000,000 .. 2,000,000").alias("owners"),
        "average_forever", "average_2weeks",
        F.lit(0).cast("bigint").alias("median_forever"),
        F.lit(0).cast("bigint").alias("median_2weeks"),
        "ccu",
        F.lit(None).cast("string").alias("price"),
        F.when(key % 10 == 0, "0").when(key % 37 == 0, "12.5").when(key % 31 == 0, F.lit(None))
        .otherwise((F.col("p_size") * 100 - 1).cast("string")).alias("initialprice"),
        F.lit("0").alias("discount"),
        F.lit("seed").alias("run_id"),
        "ingestion_timestamp",
        _year_start(F.col("yr")).alias("dt"),
    )


# Folders written by this application, so that several queries read one copy.
_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = run_dir(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def published_catalog(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The catalogue as a published, dt-partitioned table, and its path."""
    daily = catalog_daily(spark, sf_dir)
    path = _once(spark, sf_dir, "catalog", lambda p: publish_partitions(daily, p, sort_by="appid"))
    return read_published(spark, path, daily.schema), path


def landing_entries(daily: DataFrame) -> DataFrame:
    """Catalogue rows with their page. Every entry also appears, outdated, one page earlier."""
    page = F.floor(F.col("appid") / PAGE_ENTRIES).cast("int")
    current = F.struct(page.alias("page"), F.lit(False).alias("outdated"))
    earlier = F.struct((page - 1).alias("page"), F.lit(True).alias("outdated"))
    copies = F.when(page > 0, F.array(current, earlier)).otherwise(F.array(current))
    placed = daily.withColumn("copy", F.explode(copies))
    outdated = F.col("copy.outdated")
    return placed.select(
        "appid",
        F.when(outdated, "outdated").otherwise(F.upper("game_title")).alias("name"),
        "developer", "publisher", "score_rank",
        F.when(outdated, 0).otherwise(F.col("positive")).alias("positive"),
        "negative", "userscore", "owners", "average_forever", "average_2weeks", "median_forever",
        "median_2weeks", "ccu", "price", "initialprice", "discount", "dt", "copy.page",
    )


def landing_path(spark: SparkSession, sf_dir: str) -> str:
    """Landing files of the catalogue: request=all/dt=.../page=NNNN.json.gz. Plain ones are several times the tables' size."""
    def write(path: str) -> None:
        write_pages(entry_pages(landing_entries(catalog_daily(spark, sf_dir))), path, zipped=True)

    return _once(spark, sf_dir, "landing", write) + "/request=all"


def snapshot_id(year: Column) -> Column:
    """Ids that do not grow with time."""
    return year * 7919 % 1009


def commit_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Snapshots (a commit per order year) and file entries (a file per order month; December
    files are deletions)."""
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("at"), F.year("o_orderdate").cast("bigint").alias("yr")
    )
    snapshots = orders.groupBy("yr").agg(F.max("at").alias("committed_at")).select(
        snapshot_id(F.col("yr")).alias("snapshot_id"), "committed_at",
        F.lit("overwrite").alias("operation"),
    )
    months = orders.groupBy("yr", F.date_format("at", "yyyy-MM-01").alias("dt")).agg(
        F.count(F.lit(1)).alias("record_count")
    )
    entries = months.select(
        F.when(F.col("dt").substr(6, 2) == "12", 2).otherwise(1).alias("status"),
        snapshot_id(F.col("yr")).alias("snapshot_id"),
        F.struct(F.struct("dt").alias("partition"), "record_count").alias("data_file"),
    )
    return snapshots, entries


#: Ids of an abandoned branch are so much larger.
DRAFT = 5000


def versioned_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, str, StructType]:
    """Orders as files of a commit per year, with the log of a system that keeps them: (snapshots, entries, folder, schema).

    A commit adds a file for each month of its year and rewrites the January before, without its open orders. The
    year before the last was first committed on a branch that the table didn't keep.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("at"), F.year("o_orderdate").cast("bigint").alias("yr"),
        F.date_format("o_orderdate", "yyyy-MM-01").alias("dt"))
    years = orders.groupBy("yr").agg(F.max("at").alias("committed_at"))
    last = years.agg(F.max("yr")).first()[0]
    first = years.agg(F.min("yr")).first()[0]
    january = F.col("dt").substr(6, 2) == "01"
    kept = ["o_orderkey", "o_orderstatus", "dt"]

    def write(path: str) -> None:
        parts = [
            orders.select(*kept, snapshot_id(F.col("yr")).alias("commit")),
            orders.filter(january & (F.col("yr") < last) & (F.col("o_orderstatus") != "O")).select(
                *kept, snapshot_id(F.col("yr") + 1).alias("commit")),
            orders.filter(F.col("yr") == last - 1).select(*kept, (snapshot_id(F.col("yr")) + DRAFT).alias("commit")),
        ]
        every = parts[0].unionByName(parts[1]).unionByName(parts[2])
        every.hint("rebalance", "commit", "dt").write.partitionBy("commit", "dt").parquet(path)

    path = _once(spark, sf_dir, "orders", write)

    def write_log(log: str) -> None:
        line = years.select(
            snapshot_id(F.col("yr")).alias("snapshot_id"),
            F.when(F.col("yr") > first, snapshot_id(F.col("yr") - 1)).alias("parent_id"), "committed_at",
            F.when(F.col("yr") > first, "overwrite").otherwise("append").alias("operation"))
        draft = years.filter(F.col("yr") == last - 1).select(
            (snapshot_id(F.col("yr")) + DRAFT).alias("snapshot_id"), snapshot_id(F.col("yr") - 1).alias("parent_id"),
            (F.col("committed_at") - F.expr("INTERVAL 1 HOUR")).alias("committed_at"), F.lit("append").alias("operation"))
        files = footers(list_files(spark, path)).select(
            F.regexp_extract("file_path", r"commit=(\d+)", 1).cast("bigint").alias("commit"),
            F.substring("dt", 1, 4).cast("bigint").alias("yr"), "dt",
            F.struct(
                "file_path", F.struct("dt").alias("partition"), F.col("n_rows").alias("record_count"),
                F.col("n_bytes").alias("file_size_in_bytes")).alias("data_file"))
        own = F.col("commit") == snapshot_id(F.col("yr"))
        next_commit = snapshot_id(F.col("yr") + 1)
        entries = files.select(F.lit(ADDED).alias("status"), F.col("commit").alias("snapshot_id"), "data_file")
        followed = files.filter(own & (F.col("yr") < last))
        entries = entries.unionByName(followed.filter(january).select(
            F.lit(DELETED).alias("status"), next_commit.alias("snapshot_id"), "data_file"))
        entries = entries.unionByName(followed.filter(~january).select(
            F.lit(EXISTING).alias("status"), next_commit.alias("snapshot_id"), "data_file"))
        line.unionByName(draft).write.parquet(f"{log}/snapshots")
        entries.write.parquet(f"{log}/entries")

    log = _once(spark, sf_dir, "orders-log", write_log)
    snapshots, entries = (spark.read.parquet(f"{log}/{name}") for name in ("snapshots", "entries"))
    return snapshots, entries, path, orders.select(*kept).schema
