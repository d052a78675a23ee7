"""Physical plans: what must and must not appear in them."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from shelfline.operators.entities import entity_mart, explode_entities
from shelfline.operators.latest import latest_by
from shelfline.operators.ranking import gated_ranking, top_ranked
from shelfline.operators.tokens import token_counts
from shelfline.plans.testdata import catalog_daily
from shelfline.sources.sinks import publish_partitions
from shelfline.sources.tables import partition_stats, read_published, scan_partitions

LAZY = [
    "stg_games", "review_metrics", "entity_explode", "entity_explode_strict", "developers_mart",
    "publishers_mart", "developers_mart_full_list", "developer_rankings", "top_games_ranked",
    "worst_games_ranked", "title_words", "document_words", "word_cloud_200", "tier_profile",
    "tier_index", "tier_retention", "scatter_points", "dev_power", "fans_vs_critics", "latest_by_key",
    "dedup_latest", "changed_partitions", "latest_snapshot", "dq_not_null", "dq_unique_key",
    "dq_relationship", "upsert_merge", "pivot_status", "customer_mart", "fan_out_quantity",
    "scd2_history", "seed_lookup", "events_funnel", "date_spine", "json_map_explode",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_unbounded_single_task(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    for word in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "MapInPandas"):
        assert word not in text
    lines = [line.strip(" :+-*") for line in text.splitlines()]
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # only partial aggregates without keys (one row per task) may meet in one task
            assert re.match(r"(\(\d+\) )?(Hash|Sort|ObjectHash)Aggregate\(key[s]?=\[\]", lines[i + 1]), line
    assert "BroadcastNestedLoopJoin" not in text


def test_dedup_cuts_before_the_exchange(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(latest_by(df, ["k"], "id"))
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")
    assert text.count("Exchange") == 1


def test_ranking_is_take_ordered(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("v"))
    text = plan(top_ranked(df, "v", ["id"], 5))
    # Every task keeps five rows before the one small shuffle; no task count is squeezed below it.
    assert "TakeOrderedAndProject(limit=5" in text and "Coalesce" not in text
    assert text.index("Exchange") < text.index("WindowGroupLimit [_group", text.index("Exchange"))
    text = plan(gated_ranking(df, "v", 50, "id", 5, ["id"]))
    assert text.count("TakeOrderedAndProject") == 2 and "Coalesce" not in text


def test_unique_entity_mart_has_one_shuffle(spark):
    df = spark.range(100).select(
        F.col("id").alias("app_id"), F.lit("a, b, llc").alias("dev"), F.lit(1).alias("pos"),
        F.lit(1).alias("neg"), F.lit("d").alias("dt"),
    )
    rows = explode_entities(df, "dev", ["app_id", "pos", "neg", "dt"], unique_input=True)
    text = plan(entity_mart(rows, "dev", "app_id", "pos", "neg", "dt", unique_input=True))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_count" in text


def test_words_are_counted_before_the_exchange(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = plan(token_counts(docs, "text"))
    assert text.index("Exchange hashpartitioning(word") < text.index("partial_count(1)")
    assert "ReadSchema: struct<text:string>" in text and "PushedFilters: [IsNotNull(text)]" in text


def test_catalog_prunes_to_the_columns_in_use(spark, sf_dir):
    text = plan(catalog_daily(spark, sf_dir).select("appid", "positive", "dt"))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert "l_partkey:bigint,l_returnflag:string,l_shipdate:timestamp_ntz" in schemas
    assert "p_partkey:bigint" in schemas and "count(distinct" not in text.lower()


def test_catalog_has_one_shuffle_of_line_items(spark, sf_dir):
    """Combining before the shuffle would hold nearly every line item in a hash table and ship as many rows."""
    text = plan(catalog_daily(spark, sf_dir))
    assert text.count("Exchange hashpartitioning(l_partkey") == text.count("Exchange hashpartitioning") == 1
    assert text.rindex("Aggregate(keys=[l_partkey") < text.index("Exchange hashpartitioning")


def test_the_verified_counts_are_counted_once(spark, sf_dir):
    report = queries()["verify_counts"](spark, sf_dir)
    assert "InMemoryTableScan" in plan(report)
    assert report.filter("expected_rows <> actual_rows").count() == 0 < report.count()
    report.unpersist()


def test_partition_pruning(spark, folder):
    df = spark.range(30).select("id", F.concat(F.lit("d"), (F.col("id") % 3).cast("string")).alias("dt"))
    publish_partitions(df, folder)
    table = read_published(spark, folder, df.schema)
    one = scan_partitions(table, "d1")
    assert re.search(r"PartitionFilters: \[.*dt#\d+ (= d1|IN \(d1\))", plan(one))
    assert "ReadSchema: struct<>" in plan(partition_stats(table))


def test_rebalance_in_the_write_plan(spark):
    df = spark.range(10).withColumn("dt", F.lit("a"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(df.hint("rebalance", F.col("dt")))
