"""Named queries over the test tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.functions.scoring import (
    int_or_zero, range_high, range_label, range_low,
)
from shelfline.operators import modelling, quality, replication
from shelfline.operators.distinct import distinct_counts, distinct_states
from shelfline.operators.entities import entity_dimension, entity_mart, mart_for_entities
from shelfline.operators.latest import last_written, latest_by, upsert
from shelfline.operators.ranking import as_of
from shelfline.operators.tokens import token_counts
from shelfline.plans import build, catalog
from shelfline.plans.testdata import (
    catalog_daily, commit_log, landing_path, published_catalog, snapshot_id, versioned_orders,
)
from shelfline.session import materialize, run_dir
from shelfline.sources import arrow_sink, files, listing, merge, serving, sinks, snapshots, tables
from shelfline.sources.checked import GateError
from shelfline.sources.landing import (
    BRONZE_SCHEMA, bronze_rows, build_silver, ingest_bronze, read_landing, silver_rows,
)
from shelfline.sources.tables import read_published, read_table
from shelfline.streaming.landing_stream import ingest_new_pages

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.stage(catalog_daily(spark, sf_dir))


def _games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.games_mart(_staged(spark, sf_dir))


def _unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging with one row per GAME_KEY, whatever the catalogue holds: entity marts may count rows."""
    return catalog.stage(catalog_daily(spark, sf_dir), versioned=True)


def _mart(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return catalog.entity_model(_unique(spark, sf_dir), entity, unique_input=True)


# --- staging, marts, rankings ------------------------------------------------------------------


@query
def stg_games(spark, sf_dir):
    return catalog.stage(catalog_daily(spark, sf_dir), versioned=True)


@query
def review_metrics(spark, sf_dir):
    return _games(spark, sf_dir)


@query
def entity_explode(spark, sf_dir):
    return catalog.exploded(_staged(spark, sf_dir), "developer")


@query
def entity_explode_publishers(spark, sf_dir):
    return catalog.exploded(_unique(spark, sf_dir), "publisher", unique_input=True)


@query
def entity_explode_strict(spark, sf_dir):
    return catalog.exploded(_staged(spark, sf_dir), "developer", mode="strict")


@query
def developers_mart(spark, sf_dir):
    return _mart(spark, sf_dir, "developer")


@query
def publishers_mart(spark, sf_dir):
    return catalog.entity_model(_staged(spark, sf_dir), "publisher")


@query
def developers_mart_full_list(spark, sf_dir):
    """Every listed developer, measures only from reviewed games."""
    staged = _unique(spark, sf_dir)
    listed = catalog.exploded(staged, "developer", unique_input=True)
    reviewed = staged.filter("positive + negative > 0")
    mart = catalog.entity_model(reviewed, "developer", unique_input=True)
    return mart_for_entities(listed, mart, "developer", "partition_date")


@query
def developers_all_time(spark, sf_dir):
    """Games of a developer over all dates, from states stored by date; a date written twice and repeated rows count once."""
    rows = catalog.exploded(_staged(spark, sf_dir), "developer", unique_input=True)
    path = run_dir(spark, "states")
    repeated = rows.unionByName(rows.filter("app_id % 3 = 0"))
    states = distinct_states(repeated, ["developer", "partition_date"], "app_id")
    sinks.publish_partitions(states, path, "partition_date")
    sinks.publish_partitions(states.filter("partition_date = '1996-01-01'"), path, "partition_date")
    stored = read_published(spark, path, states.schema, part="partition_date")
    dates = stored.groupBy("developer").agg(F.countDistinct("partition_date").alias("n_dates"))
    return distinct_counts(stored, ["developer"], "num_games").join(dates, "developer")


@query
def developer_rankings(spark, sf_dir):
    return catalog.entity_rankings(_mart(spark, sf_dir, "developer"), "developer")


@query
def publisher_rankings(spark, sf_dir):
    return catalog.entity_rankings(_mart(spark, sf_dir, "publisher"), "publisher")


@query
def developer_rankings_latest(spark, sf_dir):
    """The date is part of the mart's grain, so it is chosen before the aggregation."""
    newest = as_of(_unique(spark, sf_dir), "partition_date", "latest")
    return catalog.entity_rankings(catalog.entity_model(newest, "developer", unique_input=True), "developer")


@query
def top_games_ranked(spark, sf_dir):
    return catalog.top_games(_games(spark, sf_dir))


@query
def worst_games_ranked(spark, sf_dir):
    return catalog.worst_games(_games(spark, sf_dir))


@query
def top_games_chart(spark, sf_dir):
    columns = ["game_title", "positive", "approval_pct", "wilson_score"]
    return catalog.chart_order(catalog.top_games(_games(spark, sf_dir)), columns, 50)


@query
def worst_games_chart(spark, sf_dir):
    return catalog.chart_order(catalog.worst_games(_games(spark, sf_dir)), ["game_title", "negative"], 10)


@query
def title_words(spark, sf_dir):
    return catalog.title_words(_staged(spark, sf_dir))


@query
def title_words_letters(spark, sf_dir):
    """Words of publisher names, whose digits separate here instead of staying."""
    return token_counts(_staged(spark, sf_dir), "publisher", letters_only=True)


@query
def document_words(spark, sf_dir):
    texts = read_table(spark, sf_dir, "documents").select("text")
    return token_counts(texts, "text")


@query
def document_words_letters(spark, sf_dir):
    texts = read_table(spark, sf_dir, "documents").select("text")
    return token_counts(texts, "text", letters_only=True)


@query
def word_cloud_200(spark, sf_dir):
    return catalog.word_cloud(document_words(spark, sf_dir))


# --- tiers and reports -------------------------------------------------------------------------


def _rounded(df: DataFrame, columns: list[str], scale: int = 6) -> DataFrame:
    """Averages of doubles depend on summation order in their last digits."""
    return df.withColumns({c: F.round(c, scale) for c in columns})


@query
def tier_labels(spark, sf_dir):
    owners = F.col("owners")
    return catalog_daily(spark, sf_dir).select(
        "appid", "dt", "owners", range_low(owners).alias("lo"), range_high(owners).alias("hi"),
        range_label(owners).alias("label"),
    )


@query
def price_parse(spark, sf_dir):
    cents = int_or_zero(F.col("initialprice")).cast("bigint")
    return catalog_daily(spark, sf_dir).select("appid", "dt", "initialprice", cents.alias("cents"))


@query
def tier_profile(spark, sf_dir):
    ladder = catalog.tier_ladder(_staged(spark, sf_dir))
    return _rounded(ladder, [*catalog.LADDER, "avg_2w_hrs"]).orderBy("lo")


@query
def tier_index(spark, sf_dir):
    index = catalog.tier_index(catalog.tier_ladder(_staged(spark, sf_dir)))
    columns = [f"{m}_idx" for m in catalog.LADDER]
    return _rounded(index.select("owners", "lo", "label", *columns), columns).orderBy("lo")


@query
def tier_retention(spark, sf_dir):
    kept = catalog.tier_retention(catalog.tier_ladder(_staged(spark, sf_dir)), threshold=0.1)
    columns = ["avg_playtime_hrs", "avg_2w_hrs"]
    return _rounded(kept.select("owners", "lo", "label", *columns), columns).orderBy("lo")


@query
def scatter_points(spark, sf_dir):
    points = catalog.scatter_points(_staged(spark, sf_dir), min_reviews=3)
    return _rounded(points, ["playtime_hrs", "approval"])


def _power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.dev_power(_staged(spark, sf_dir), min_games=5, min_reviews=50)


@query
def dev_power(spark, sf_dir):
    return _rounded(_power(spark, sf_dir), ["avg_approval"])


@query
def fans_vs_critics(spark, sf_dir):
    return catalog.fans_vs_critics(_power(spark, sf_dir))


# --- latest version, dimensions ----------------------------------------------------------------


@query
def latest_by_key(spark, sf_dir):
    return latest_by(read_table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", ("event_id",))


@query
def dedup_latest(spark, sf_dir):
    return latest_by(read_table(spark, sf_dir, "events"), ["user_id"], "ts", ("event_id",))


@query
def latest_bucketed(spark, sf_dir):
    """The same from a serving table bucketed by user, filled by two loads."""
    events = read_table(spark, sf_dir, "events")
    path = run_dir(spark, "serving")
    name = "serving_" + path.rsplit("-", 1)[1]
    for load in (0, 1):
        serving.append_bucketed(events.filter(F.col("event_id") % 2 == load), name, ["user_id"], 8, ["user_id", "ts"], path)
    return serving.newest_versions(spark, name, ["user_id"], "ts", ("event_id",))


@query
def last_written_by_key(spark, sf_dir):
    return last_written(read_table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey")


@query
def entity_dim(spark, sf_dir):
    listed = catalog.exploded(_unique(spark, sf_dir), "developer", unique_input=True)
    return entity_dimension(listed, "developer", "partition_date", "developer_id")


@query
def entity_dim_publishers(spark, sf_dir):
    listed = catalog.exploded(_unique(spark, sf_dir), "publisher", unique_input=True)
    return entity_dimension(listed, "publisher", "partition_date", "publisher_id")


# --- scans and sinks ---------------------------------------------------------------------------

SCANNED = ["appid", "game_title", "positive", "negative", "dt"]


@query
def scan_partition(spark, sf_dir):
    silver, path = published_catalog(spark, sf_dir)
    return tables.scan_partitions(silver, files.latest_partition(spark, path)).select(*SCANNED)


@query
def scan_changed(spark, sf_dir):
    """Partitions named by another table: the order years with the most orders on one side of it."""
    silver, _ = published_catalog(spark, sf_dir)
    orders = read_table(spark, sf_dir, "orders")
    busy = (
        orders.groupBy(F.concat(F.year("o_orderdate"), F.lit("-01-01")).alias("dt"))
        .agg(F.count_if(F.col("o_orderstatus") == "F").alias("done"),
             F.count_if(F.col("o_orderstatus") == "O").alias("open"))
        .filter("done > open")
    )
    return tables.scan_partitions(silver, busy).select(*SCANNED)


@query
def scan_glob(spark, sf_dir):
    silver, path = published_catalog(spark, sf_dir)
    return tables.scan_glob(spark, path, "dt=199*", silver.schema).select(*SCANNED)


@query
def partition_list(spark, sf_dir):
    return listing.listed_partitions(listing.list_files(spark, published_catalog(spark, sf_dir)[1])).select("dt")


@query
def latest_partition(spark, sf_dir):
    return listing.newest_partition(listing.list_files(spark, published_catalog(spark, sf_dir)[1]))


@query
def publish_partitions(spark, sf_dir):
    """Everything published with a wrong ccu, then the newer half twice with the right one."""
    daily, _ = published_catalog(spark, sf_dir)
    path = run_dir(spark, "publish")
    sinks.publish_partitions(daily.withColumn("ccu", F.lit(-1).cast("bigint")), path)
    newer = daily.filter("dt >= '1998-01-01'")
    for _ in range(2):
        sinks.publish_partitions(newer, path)
    return read_published(spark, path, daily.schema).select("appid", "ccu", "dt")


@query
def publish_table(spark, sf_dir):
    """The same through a catalog table: created when absent, then partitions replaced."""
    daily = published_catalog(spark, sf_dir)[0].select("appid", "ccu", "dt")
    path = run_dir(spark, "table")
    name = "published_" + path.rsplit("-", 1)[1]
    sinks.publish_table(daily.withColumn("ccu", F.lit(-1).cast("bigint")), name, location=path)
    sinks.publish_table(daily.filter("dt >= '1998-01-01'"), name)
    return spark.table(name)


@query
def verify_counts(spark, sf_dir):
    daily = catalog_daily(spark, sf_dir)
    silver, _ = published_catalog(spark, sf_dir)
    # The check and the result are the same few rows: the first to need them counts, the other reads what it kept.
    report = sinks.count_report(daily, silver).cache()
    sinks.verify_counts(daily, silver)
    return report


@query
def partition_sink(spark, sf_dir):
    """Rows handed to the batch sink, read back and compared with the sink's own counter."""
    rows = published_catalog(spark, sf_dir)[0].select("appid", "positive", "negative", "dt")
    path = run_dir(spark, "sink")
    written = arrow_sink.write_staged(rows, path, batch_rows=1000)
    landed = arrow_sink.read_staged(spark, path, rows.schema)
    counted = landed.groupBy("dt").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("positive").alias("positive")
    )
    return counted.withColumn("sink_total", F.lit(written).cast("bigint"))


@query
def partition_stats(spark, sf_dir):
    """Rows per partition, and whether its files exist and hold anything: how many files and bytes
    there are is the writer's choice."""
    stats = tables.partition_stats(published_catalog(spark, sf_dir)[0])
    return stats.select(
        "dt", "record_count", (F.col("file_count") >= 1).alias("has_files"), (F.col("total_bytes") > 0).alias("has_bytes"))


@query
def partition_records(spark, sf_dir):
    stats = listing.file_stats(listing.list_files(spark, published_catalog(spark, sf_dir)[1]))
    return stats.select("dt", "record_count")


@query
def list_tables(spark, sf_dir):
    """The tables of a session, with their columns and rows."""
    names = {path.rsplit("/", 1)[1].removesuffix(".parquet") for path in files.list_names(spark, sf_dir)}
    for name in sorted(names):
        read_table(spark, sf_dir, name).createOrReplaceTempView(f"listed_{name}")
    return tables.list_tables(spark, "listed_*").withColumn("table_name", F.expr("substring(table_name, 8)"))


@query
def describe_table(spark, sf_dir):
    return tables.describe(read_table(spark, sf_dir, "lineitem"))


@query
def json_introspect(spark, sf_dir):
    return tables.json_keys(read_table(spark, sf_dir, "events"), "props")


@query
def json_map_explode(spark, sf_dir):
    return tables.json_entries(read_table(spark, sf_dir, "events"), "props", ["event_id"])


@query
def json_array_unnest(spark, sf_dir):
    """Event documents that carry an array, unnested to a row per element."""
    documents = read_table(spark, sf_dir, "events").select(
        "event_id",
        F.to_json(F.struct(F.array("user_id", F.length("event_type")).alias("facts"))).alias("doc"),
    )
    return tables.json_elements(documents, "doc", "facts", "bigint", ["event_id"], "fact")


@query
def array_unnest(spark, sf_dir):
    """Components of stored arrays as rows, with their place."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return tables.array_elements(vectors, "embedding", ["vec_id"], "component").withColumn(
        "component", F.col("component").cast("double"))


# --- landing, bronze, silver -------------------------------------------------------------------


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    path = run_dir(spark, "bronze")
    ingest_bronze(spark, landing_path(spark, sf_dir), path, "catalog", "run-1")
    return path


@query
def bronze_ingest(spark, sf_dir):
    bronze = read_published(spark, _ingested(spark, sf_dir), BRONZE_SCHEMA)
    return bronze.select(
        "dt", F.col("page").cast("bigint").alias("page"), "source", "run_id",
        F.size(F.json_object_keys("payload")).cast("bigint").alias("n_entries"),
        (F.col("ingestion_date") == F.to_date("ingestion_timestamp")).alias("dated"),
    )


SILVER_CHECKED = ["appid", "positive", "negative", "average_forever", "average_2weeks", "ccu"]


@query
def silver_games(spark, sf_dir):
    bronze = _ingested(spark, sf_dir)
    path = run_dir(spark, "silver")
    build_silver(spark, bronze, path)
    schema = silver_rows(read_published(spark, bronze, BRONZE_SCHEMA)).schema
    silver = read_published(spark, path, schema)
    return silver.select(
        *[F.col(c).cast("bigint").alias(c) for c in SILVER_CHECKED],
        "game_title", "developer", "publisher", "score_rank", "owners", "initialprice", "run_id", "dt",
    )


@query
def page_gaps(spark, sf_dir):
    pages = read_landing(spark, landing_path(spark, sf_dir))
    return quality.page_report(bronze_rows(pages, "catalog", "run-1"))


@query
def landing_stream(spark, sf_dir):
    path = run_dir(spark, "stream")
    landing = landing_path(spark, sf_dir)
    ingest_new_pages(spark, landing, f"{path}/bronze", f"{path}/progress", "catalog", "run-1")
    return quality.page_report(read_published(spark, f"{path}/bronze", BRONZE_SCHEMA))


# --- replication -------------------------------------------------------------------------------

SINCE = 1997 * 7919 % 1009  # id of the commit of 1997


@query
def latest_snapshot(spark, sf_dir):
    return replication.latest_snapshot(commit_log(spark, sf_dir)[0])


@query
def changed_partitions(spark, sf_dir):
    return replication.changed_partitions(*commit_log(spark, sf_dir), since=SINCE)


@query
def replication_plan(spark, sf_dir):
    """Every branch of the decision, as (scenario, mode, dt)."""
    snapshots, entries = commit_log(spark, sf_dir)
    live = entries.select("data_file.partition.dt")
    newest = replication.newest_snapshot_id(snapshots)
    scenarios = {
        "no_state": {"last": None},
        "up_to_date": {"last": newest},
        "behind": {"last": SINCE},
        "expired_state": {"last": -1},
        "full_load": {"last": newest, "full_load": True},
        "override": {"last": newest, "from_snapshot": SINCE},
    }
    planned = {}
    for name, settings in scenarios.items():
        plan = replication.replication_plan(snapshots, entries, live, target=newest, **settings)
        planned[name] = plan.partitions.withColumn("mode", F.lit(plan.mode))
    return modelling.union_sources(planned, "scenario")


@query
def replication_state(spark, sf_dir):
    """A state log derived from orders: one table per priority, an update per order."""
    log = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("table_name"),
        F.col("o_orderkey").alias("last_snapshot_id"),
        F.col("o_orderdate").alias("updated_at"),
    )
    return replication.latest_state(log)


def _log(spark: SparkSession, commits: list[tuple[int, str, DataFrame, int]]):
    """Commit log of a few published batches: (snapshot id, time, table, status)."""
    snapshots = spark.createDataFrame(
        [(i, datetime.fromisoformat(at)) for i, at, _, _ in commits],
        "snapshot_id bigint, committed_at timestamp",
    )
    entries = [
        tables.partition_list(df).select(
            F.lit(status).alias("status"), F.lit(i).cast("bigint").alias("snapshot_id"),
            F.struct(F.struct("dt").alias("partition")).alias("data_file"),
        )
        for i, _, df, status in commits
    ]
    merged = entries[0]
    for more in entries[1:]:
        merged = merged.unionByName(more)
    return snapshots, merged


@query
def replicate_table(spark, sf_dir):
    """Full load of an early state, then one incremental run over a rewrite, an append and a
    deletion. The target must equal the catalogue."""
    daily = published_catalog(spark, sf_dir)[0].select("appid", "game_title", "positive", "negative", "dt")
    base = run_dir(spark, "replicate")
    source, state = f"{base}/source", f"{base}/state"
    target = sinks.PathTarget(spark, f"{base}/target")

    outdated = daily.filter("dt = '1996-01-01'").withColumn("positive", F.lit(-1).cast("bigint"))
    doomed = daily.filter("dt = '1997-01-01'").withColumn("dt", F.lit("1900-01-01"))
    early = daily.filter("dt NOT IN ('1996-01-01', '1999-01-01')").unionByName(outdated).unionByName(doomed)
    sinks.publish_partitions(early, source)

    live = replication.PathSource(spark, source, daily.schema)
    first = [(900, "2026-01-01", early, replication.ADDED)]
    replication.replicate(spark, live, target, state, "catalog", *_log(spark, first))

    newer = daily.filter("dt IN ('1996-01-01', '1999-01-01')")
    sinks.publish_partitions(newer, source)
    files.drop_partitions(spark, source, ["1900-01-01"])
    later = first + [
        (17, "2026-01-02", newer, replication.ADDED),
        (350, "2026-01-03", doomed, replication.DELETED),
    ]
    replication.replicate(spark, live, target, state, "catalog", *_log(spark, later))
    return read_published(spark, target.path, daily.schema)


@query
def replicate_list(spark, sf_dir):
    """Two tables in turn, of which one's source is gone: the other is copied all the same, and the failure is named."""
    daily = published_catalog(spark, sf_dir)[0].select("appid", "positive", "dt")
    base = run_dir(spark, "list")
    sinks.publish_partitions(daily, f"{base}/present")
    log = _log(spark, [(1, "2026-01-01", daily, replication.ADDED)])

    def job(table: str):
        source = replication.PathSource(spark, f"{base}/{table}", daily.schema)
        return lambda: replication.replicate(
            spark, source, sinks.PathTarget(spark, f"{base}/copy-{table}"), f"{base}/state", table, *log)

    try:
        replication.replicate_tables({"absent": job("absent"), "present": job("present")})
    except RuntimeError as error:
        failed = str(error)
    state = replication.latest_state(replication.read_state(spark, f"{base}/state")).collect()  # a row a table
    copied = sinks.partition_counts(read_published(spark, f"{base}/copy-present", daily.schema))
    return copied.withColumns({
        "replicated": F.lit(",".join(r.table_name for r in state)),
        "last_snapshot_id": F.lit(state[0].last_snapshot_id).cast("bigint"), "failed": F.lit(failed)})


@query
def changed_by_mtime(spark, sf_dir):
    """Partitions with files younger than the recorded state, after the newest was republished."""
    daily = published_catalog(spark, sf_dir)[0].select("appid", "positive", "dt")
    path = run_dir(spark, "mtime")
    sinks.publish_partitions(daily, path)
    seen = listing.list_files(spark, path).agg(F.max("modified_at")).first()[0]
    sinks.publish_partitions(daily.filter(F.col("dt") == files.latest_partition(spark, path)), path)
    modified = listing.listed_partitions(listing.list_files(spark, path))
    return replication.partitions_modified_since(modified, seen)


# --- a commit log that another system keeps ----------------------------------------------------


@query
def snapshot_history(spark, sf_dir):
    return snapshots.history(versioned_orders(spark, sf_dir)[0])


@query
def live_files(spark, sf_dir):
    """The files of the newest snapshot, what the log says of them and what their footers say."""
    log, entries, _, _ = versioned_orders(spark, sf_dir)
    live = listing.footers(snapshots.live_files(log, entries))
    return live.groupBy("dt", "added_by").agg(
        F.sum("record_count").alias("record_count"), F.sum("n_rows").alias("footer_rows"),
        F.min(F.col("n_bytes") > 0).alias("has_bytes"))


def _commit(year: int) -> int:
    return year * 7919 % 1009


@query
def read_as_of(spark, sf_dir):
    log, entries, path, schema = versioned_orders(spark, sf_dir)
    return snapshots.read_as_of(spark, log, entries, path, schema, _commit(1997))


@query
def read_between(spark, sf_dir):
    log, entries, path, schema = versioned_orders(spark, sf_dir)
    return snapshots.read_between(spark, log, entries, path, schema, _commit(1996), _commit(1998))


@query
def replicate_from_log(spark, sf_dir):
    """A copy of an early snapshot, brought up to the newest: rewritten and new months, and no file that isn't live."""
    log, entries, path, schema = versioned_orders(spark, sf_dir)
    source = snapshots.LogSource(spark, path, schema, log, entries)
    base = run_dir(spark, "from-log")
    target = sinks.PathTarget(spark, f"{base}/target")
    early = log.filter(F.col("committed_at") < "1997-01-01")
    replication.replicate(spark, source, target, f"{base}/state", "orders", early, entries)
    replication.replicate(spark, source, target, f"{base}/state", "orders", log, entries)
    return read_published(spark, target.path, schema)


# --- data tests --------------------------------------------------------------------------------


@query
def dq_not_null(spark, sf_dir):
    columns = ["app_id", "developer", "initial_price", "partition_date"]
    return quality.not_null(_staged(spark, sf_dir), columns)


@query
def dq_unique_key(spark, sf_dir):
    return quality.unique_key(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_relationship(spark, sf_dir):
    """Documents without a label are the orphans here; orders all have their customer."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return quality.relationship(documents, "doc_id", read_table(spark, sf_dir, "labels"), "doc_id")


@query
def dq_orders_customer(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return quality.relationship(orders, "o_custkey", read_table(spark, sf_dir, "customer"), "c_custkey")


# --- modelling patterns ------------------------------------------------------------------------


@query
def upsert_merge(spark, sf_dir):
    """Open orders are updated twice (the later version counts), finished ones re-entered."""
    orders = read_table(spark, sf_dir, "orders")
    opened, done = orders.filter("o_orderstatus = 'O'"), orders.filter("o_orderstatus = 'F'")
    updates = (
        opened.withColumns({"o_orderstatus": F.lit("X"), "version": F.lit(1)})
        .unionByName(opened.withColumns({"o_orderstatus": F.lit("P"), "version": F.lit(2)}))
        .unionByName(done.withColumns({"o_orderkey": -F.col("o_orderkey") - 1, "version": F.lit(1)}))
    )
    target = orders.withColumn("version", F.lit(0))
    return upsert(target, updates, ["o_orderkey"], "version").withColumn(
        "version", F.col("version").cast("bigint")
    )


@query
def merge_partitions(spark, sf_dir):
    """Entries that change, entries that move to another date, and new ones; other dates keep their files."""
    daily, _ = published_catalog(spark, sf_dir)
    table = daily.select(
        (F.col("appid") * 10_000 + F.substring("dt", 1, 4).cast("bigint")).alias("id"), "positive", "dt")
    path = run_dir(spark, "merge")
    sinks.publish_partitions(table, path)
    changed = table.filter("dt = '1996-01-01' AND id DIV 10000 % 5 = 0").withColumn("positive", F.lit(-1).cast("bigint"))
    moved = table.filter("dt = '1997-01-01' AND id DIV 10000 % 7 = 0").withColumn("dt", F.lit("1997-02-01"))
    new = table.filter("dt = '1998-01-01'").withColumns({"id": -F.col("id"), "dt": F.lit("1998-02-01")})
    merge.merge_partitions(spark, path, table.schema, changed.unionByName(moved).unionByName(new), ["id"])
    return read_published(spark, path, table.schema)


@query
def soft_delete_flag(spark, sf_dir):
    """A customer counts as deleted when an order of theirs is in state P."""
    tombstones = (
        read_table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
        .select(F.col("o_custkey").alias("c_custkey"))
    )
    return modelling.flag_deleted(read_table(spark, sf_dir, "customer"), tombstones, "c_custkey")


@query
def union_sources(spark, sf_dir):
    def party(name: str, p: str) -> DataFrame:
        columns = {f"{p}_{k}": k for k in ("name", "nationkey", "acctbal")}
        df = read_table(spark, sf_dir, name)
        key = F.col("c_custkey" if p == "c" else "s_suppkey").alias("party_id")
        return df.select(key, *[F.col(old).alias(new) for old, new in columns.items()])

    return modelling.union_sources({"customer": party("customer", "c"), "supplier": party("supplier", "s")})


@query
def pivot_status(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return modelling.pivot_sum(
        orders, ["o_custkey"], "o_orderstatus", ["F", "O", "P"], "o_totalprice", "total_amount"
    )


@query
def customer_mart(spark, sf_dir):
    per_customer = read_table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.count("o_orderkey").alias("n_orders"),
        F.round(F.sum("o_totalprice"), 2).alias("lifetime_value"),
    )
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return customers.join(per_customer, "c_custkey", "left").withColumn(
        "n_orders", F.coalesce("n_orders", F.lit(0))
    )


@query
def fan_out_quantity(spark, sf_dir):
    """Line items fanned out to units, counted per return flag and unit number."""
    units = modelling.fan_out(read_table(spark, sf_dir, "lineitem"), "l_quantity")
    return units.groupBy("l_returnflag", F.col("unit_no").cast("bigint").alias("unit_no")).agg(
        F.count(F.lit(1)).alias("n_units")
    )


@query
def stage_categorise(spark, sf_dir):
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(urgent, "express").otherwise("standard").alias("order_type"),
        cents.alias("amount_cents"),
        (cents / 100.0).alias("amount"),
        F.when(F.col("o_orderstatus") == "F", True).otherwise(False).alias("is_completed"),
        F.date_trunc("month", "o_orderdate").cast("date").alias("order_month"),
    )


@query
def scd2_history(spark, sf_dir):
    return modelling.history(catalog_daily(spark, sf_dir), "appid", ["owners"], "dt")


@query
def seed_lookup(spark, sf_dir):
    """Customers with their nation and region; Spark broadcasts the seeds while they are small."""
    nation, region = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    seeds = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    customers = read_table(spark, sf_dir, "customer")
    return customers.join(seeds, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey", "c_name", "n_name", "r_name"
    )


@query
def events_funnel(spark, sf_dir):
    steps = ["view", "click", "signup", "purchase"]
    return modelling.funnel(read_table(spark, sf_dir, "events"), "user_id", "event_type", "ts", steps)


@query
def date_spine(spark, sf_dir):
    """Daily count of all events, with three empty days on either side."""
    return modelling.spine_counts(read_table(spark, sf_dir, "events"), "ts", margin=3)


# --- stored marts ------------------------------------------------------------------------------


@query
def incremental_marts(spark, sf_dir):
    """Marts of an outdated catalogue, refreshed for the dates that changed, equal a full build."""
    daily, _ = published_catalog(spark, sf_dir)
    base = run_dir(spark, "marts")
    silver, marts = f"{base}/silver", f"{base}/marts"
    changed = ["1996-01-01", "1999-01-01"]
    outdated = F.when(F.col("dt").isin(changed), 0).otherwise(F.col("positive")).cast("bigint")
    doomed = daily.filter("dt = '1997-01-01'").withColumn("dt", F.lit("1900-01-01"))
    sinks.publish_partitions(daily.withColumn("positive", outdated).unionByName(doomed), silver)
    build.refresh_marts(spark, silver, daily, marts)

    sinks.publish_partitions(daily.filter(F.col("dt").isin(changed)), silver)
    files.drop_partitions(spark, silver, ["1900-01-01"])
    build.refresh_marts(spark, silver, daily, marts, dates=changed, gone=["1900-01-01"])
    return build.read_mart(spark, marts, "developers", daily)


@query
def incremental_marts_emptied(spark, sf_dir):
    """A date that loses all its developers keeps none in the refreshed mart."""
    daily, _ = published_catalog(spark, sf_dir)
    base = run_dir(spark, "marts")
    silver, marts = f"{base}/silver", f"{base}/marts"
    sinks.publish_partitions(daily, silver)
    build.refresh_marts(spark, silver, daily, marts)
    sinks.publish_partitions(daily.filter("dt = '1996-01-01'").withColumn("developer", F.lit(None).cast("string")), silver)
    build.refresh_marts(spark, silver, daily, marts, dates=["1996-01-01"])
    return build.read_mart(spark, marts, "developers", daily)


@query
def gated_marts(spark, sf_dir):
    """A refresh of two dates, one of them with a game without an id: that one keeps its old marts."""
    daily, _ = published_catalog(spark, sf_dir)
    base = run_dir(spark, "marts")
    silver, marts = f"{base}/silver", f"{base}/marts"
    sinks.publish_partitions(daily, silver)
    build.refresh_marts(spark, silver, daily, marts)
    changed = daily.filter("dt IN ('1996-01-01', '1999-01-01')").withColumn("positive", F.lit(0).cast("bigint"))
    nameless = changed.filter("dt = '1996-01-01'").withColumn("appid", F.lit(None).cast("bigint"))
    sinks.publish_partitions(changed.unionByName(nameless), silver)
    try:
        build.refresh_marts(spark, silver, daily, marts, dates=["1996-01-01", "1999-01-01"])
    except GateError as error:
        held = str(error)
    kept = build.read_mart(spark, marts, "developers", daily)
    return kept.withColumn("held_back", F.lit("partition_date=1996-01-01" in held) & (F.col("partition_date") == "1996-01-01"))


@query
def marts_over_versions(spark, sf_dir):
    """Marts of a serving table that holds an older version of every row beside the newest."""
    daily, _ = published_catalog(spark, sf_dir)
    base = run_dir(spark, "marts")
    older = daily.withColumns({
        "ingestion_timestamp": F.col("ingestion_timestamp") - F.expr("INTERVAL 1 DAY"),
        "positive": F.lit(0).cast("bigint"),
    })
    sinks.publish_partitions(daily.unionByName(older), f"{base}/silver")
    build.refresh_marts(spark, f"{base}/silver", daily, f"{base}/marts")
    return build.read_mart(spark, f"{base}/marts", "publishers", daily)


@query
def stored_rankings(spark, sf_dir):
    """Top games of the newest date, from marts built over the published catalogue."""
    silver, path = published_catalog(spark, sf_dir)
    marts = run_dir(spark, "marts")
    build.refresh_marts(spark, path, silver, marts)
    return build.metric_models(spark, marts, silver, when="latest")["top_games_ranked"]


@query
def layered_marts(spark, sf_dir):
    """Staging as a view, the exploded rows inlined, the mart as a table partitioned by date."""
    path = run_dir(spark, "layers")
    name = path.rsplit("-", 1)[1]
    staged = materialize(_unique(spark, sf_dir), f"stg_{name}", "view")
    rows = materialize(catalog.exploded(staged, "developer", unique_input=True), f"int_{name}", "inline")
    mart = entity_mart(rows, "developer", "app_id", "positive", "negative", "partition_date", unique_input=True)
    return materialize(mart, f"mart_{name}", "table", "partition_date", path)


@query
def landing_to_rankings(spark, sf_dir):
    """The whole chain: landing, bronze, silver, serving copy, stored marts, developer ranking."""
    base = run_dir(spark, "chain")
    bronze, silver_path, marts = f"{base}/bronze", f"{base}/silver", f"{base}/marts"
    serving = sinks.PathTarget(spark, f"{base}/serving")
    ingest_bronze(spark, landing_path(spark, sf_dir), bronze, "catalog", "run-1")
    build_silver(spark, bronze, silver_path)
    schema = silver_rows(read_published(spark, bronze, BRONZE_SCHEMA)).schema
    silver = read_published(spark, silver_path, schema)
    log = _log(spark, [(1, "2026-01-01", silver, replication.ADDED)])
    done = replication.replicate(
        spark, replication.PathSource(spark, silver_path, schema), serving, f"{base}/state", "catalog", *log
    )
    served = read_published(spark, serving.path, schema)
    build.refresh_marts(spark, serving.path, served, marts, done.reloaded, done.cleared)
    return build.metric_models(spark, marts, served)["developer_rankings"]
