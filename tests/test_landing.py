import glob
import os
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfline.plans import build, testdata
from shelfline.sources.files import latest_partition, list_partitions
from shelfline.sources.landing import (
    BRONZE_SCHEMA, GROUP_PAGES, bronze_rows, build_silver, entry_pages, ingest_bronze, parse_entries, read_landing,
    silver_rows, write_pages,
)
from shelfline.sources.listing import footers, list_files
from shelfline.sources.sinks import PathTarget
from shelfline.sources.tables import read_published
from shelfline.streaming.landing_stream import ingest_new_pages


def put(folder, dt, page, text, name=None):
    path = f"{folder}/dt={dt}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name or f'page={page:04d}.json'}", "w", encoding="utf-8") as f:
        f.write(text)


def entry(appid, **fields):
    body = ", ".join(f'"{k}": {v}' for k, v in {"appid": appid, **fields}.items())
    return f'"{appid}": {{{body}}}'


def page(*entries):
    return "{" + ",\n".join(entries) + "}"


def bronze_of(spark, folder, **kw):
    return bronze_rows(read_landing(spark, folder, **kw), "src", "run")


def test_bronze_columns(spark, folder):
    put(folder, "2026-01-01", 3, "{}\n{}")
    put(folder, "2026-01-02", 11, "x")
    rows = sorted(bronze_of(spark, folder).collect(), key=lambda r: r.dt)
    assert [(r.payload, r.dt, r.page, r.source, r.run_id) for r in rows] == [
        ("{}\n{}", "2026-01-01", 3, "src", "run"), ("x", "2026-01-02", 11, "src", "run"),
    ]
    assert rows[0].source_file.endswith("dt=2026-01-01/page=0003.json")
    assert rows[0].ingestion_date == rows[0].ingestion_timestamp.date()
    assert bronze_of(spark, folder, dates=["2026-01-02"]).count() == 1


def test_page_number_is_required(spark, folder):
    put(folder, "2026-01-01", 0, "{}", name="other.json")
    with pytest.raises(Exception, match="no page number in"):
        bronze_of(spark, folder).collect()


def test_json_edge_documents(spark, folder):
    put(folder, "2026-01-01", 0, '{"1": {"appid": 1, "name": "One"}, "2": null}')
    put(folder, "2026-01-01", 1, '{"2": {"appid": 2}, "3": {"appid": 3, "name": "cut')
    for i, text in enumerate(["[]", "{}", ""], 2):
        put(folder, "2026-01-01", i, text)
    put(folder, "2026-01-01", 5, page(entry(4, positive='"x"', price=199, score_rank=7, name='"ÉCRAN"')))
    rows = {r.appid: r for r in parse_entries(bronze_of(spark, folder)).collect()}
    assert set(rows) == {1, 4}  # a cut document gives nothing, not even its complete entries
    assert (rows[4].positive, rows[4].price, rows[4].score_rank) == (None, "199", "7")
    titles = {r.appid: r.game_title for r in silver_rows(bronze_of(spark, folder)).collect()}
    assert titles[4] == "écran"


def test_same_id_on_two_pages_and_dates(spark, folder):
    put(folder, "2026-01-01", 0, page(entry(1, positive=1), entry(2, positive=2)))
    put(folder, "2026-01-01", 1, page(entry(1, positive=10)))
    put(folder, "2026-01-02", 0, page(entry(1, positive=5)))
    rows = silver_rows(bronze_of(spark, folder)).collect()
    assert sorted((r.dt, r.appid, r.positive) for r in rows) == [
        ("2026-01-01", 1, 10), ("2026-01-01", 2, 2), ("2026-01-02", 1, 5),
    ]


def test_pages_round_trip(spark, folder):
    rows = [(i, f"Game {i}", i % 4, f"2026-01-0{1 + i % 2}") for i in range(40)]
    df = spark.createDataFrame(rows, "appid int, name string, page int, dt string")
    assert write_pages(entry_pages(df), folder) == 4
    landing = f"{folder}/request=all"
    assert os.path.exists(f"{landing}/dt=2026-01-01/page=0000.json")
    assert latest_partition(spark, landing) == "2026-01-02"
    got = parse_entries(bronze_of(spark, landing)).select("appid", "name", "page", "dt").collect()
    assert sorted(tuple(r) for r in got) == sorted(rows)


def test_zipped_pages(spark, folder):
    rows = [(i, f"Jeu nº {i}", i % 4, f"2026-01-0{1 + i % 2}") for i in range(4000)]
    pages = entry_pages(spark.createDataFrame(rows, "appid int, name string, page int, dt string"))
    assert write_pages(pages, f"{folder}/plain") == write_pages(pages, f"{folder}/zipped", zipped=True) == 4
    plain, zipped = f"{folder}/plain/request=all", f"{folder}/zipped/request=all"
    assert sorted(os.listdir(f"{zipped}/dt=2026-01-01")) == ["page=0000.json.gz", "page=0002.json.gz"]
    size = lambda d: sum(os.path.getsize(f) for f in glob.glob(f"{d}/*/*"))
    assert size(zipped) * 3 < size(plain)
    got = parse_entries(bronze_of(spark, zipped)).select("appid", "name", "page", "dt").collect()
    assert sorted(tuple(r) for r in got) == sorted(rows)
    # A page is a page however it is stored.
    shutil.copy(f"{plain}/dt=2026-01-01/page=0000.json", f"{zipped}/dt=2026-01-01")
    ingest_bronze(spark, zipped, f"{folder}/bronze", "src", "run")
    with pytest.raises(ValueError, match="2026-01-01"):
        build_silver(spark, f"{folder}/bronze", f"{folder}/silver")


def test_the_chain_takes_little_room(spark, sf_dir, folder, shuffle_files):
    """Landing pages and bronze are compressed, and no step leaves its shuffle files to the next."""
    landing = testdata.landing_path(spark, sf_dir).removeprefix("file:")
    names = glob.glob(f"{landing}/dt=*/page=*")
    assert names and all(n.endswith(".json.gz") for n in names)
    ingest_bronze(spark, landing, f"{folder}/bronze", "src", "run")
    # Those of counts may stay.
    assert not shuffle_files(least=5000)
    codecs = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in glob.glob(f"{folder}/bronze/*/*.parquet")}
    assert codecs == {"ZSTD"}
    build_silver(spark, f"{folder}/bronze", f"{folder}/silver")
    assert not shuffle_files(least=5000)
    schema = silver_rows(read_published(spark, f"{folder}/bronze", BRONZE_SCHEMA)).schema
    silver = read_published(spark, f"{folder}/silver", schema)
    PathTarget(spark, f"{folder}/serving").replace(silver, list_partitions(spark, f"{folder}/silver"))
    assert not shuffle_files(least=5000)
    build.refresh_marts(spark, f"{folder}/serving", silver, f"{folder}/marts")
    assert not shuffle_files(least=5000)


def test_ingest_and_silver_are_idempotent(spark, folder):
    landing, bronze, silver = f"{folder}/l", f"{folder}/b", f"{folder}/s"
    put(landing, "2026-01-01", 0, page(entry(1, positive=1)))
    put(landing, "2026-01-02", 0, page(entry(1, positive=2)))
    for _ in range(2):
        assert ingest_bronze(spark, landing, bronze, "src", "run") == 2
        assert build_silver(spark, bronze, silver) == 2
    # a later run of one date leaves the other alone
    put(landing, "2026-01-02", 0, page(entry(1, positive=7), entry(9, positive=8)))
    assert ingest_bronze(spark, landing, bronze, "src", "run-2", ["2026-01-02"]) == 1
    assert build_silver(spark, bronze, silver, ["2026-01-02"]) == 2
    schema = silver_rows(read_published(spark, bronze, BRONZE_SCHEMA)).schema
    rows = read_published(spark, silver, schema).collect()
    assert sorted((r.dt, r.appid, r.positive, r.run_id) for r in rows) == [
        ("2026-01-01", 1, 1, "run"), ("2026-01-02", 1, 7, "run-2"), ("2026-01-02", 9, 8, "run-2"),
    ]


def test_incomplete_date_is_refused(spark, folder):
    landing, bronze, silver = f"{folder}/l", f"{folder}/b", f"{folder}/s"
    put(landing, "2026-01-01", 0, page(entry(1)))
    put(landing, "2026-01-02", 0, page(entry(1)))
    put(landing, "2026-01-02", 2, page(entry(2)))
    ingest_bronze(spark, landing, bronze, "src", "run")
    with pytest.raises(ValueError, match="2026-01-02"):
        build_silver(spark, bronze, silver)
    assert build_silver(spark, bronze, silver, ["2026-01-01"]) == 1
    assert build_silver(spark, bronze, silver, require_complete=False) == 3


def test_no_partition_is_an_error(spark, folder):
    assert list_partitions(spark, folder) == []
    with pytest.raises(ValueError, match="no dt= partitions"):
        latest_partition(spark, folder)


def test_stream_reloads_whole_dates(spark, folder):
    landing, bronze, progress = f"{folder}/l", f"{folder}/b", f"{folder}/p"

    def run():
        ingest_new_pages(spark, landing, bronze, progress, "src", "run")
        rows = read_published(spark, bronze, BRONZE_SCHEMA).select("dt", F.col("page")).collect()
        return sorted(tuple(r) for r in rows)

    put(landing, "2026-01-01", 0, page(entry(1)))
    assert run() == [("2026-01-01", 0)]
    put(landing, "2026-01-01", 1, page(entry(2)))
    put(landing, "2026-01-02", 0, page(entry(1)))
    assert run() == [("2026-01-01", 0), ("2026-01-01", 1), ("2026-01-02", 0)]
    assert run() == [("2026-01-01", 0), ("2026-01-01", 1), ("2026-01-02", 0)]  # nothing new


def test_bronze_has_row_groups_of_few_pages(spark, folder):
    """A reader decodes up to 4,096 rows of a row group at once; a page may have hundreds of kilobytes."""
    landing, bronze = f"{folder}/l", f"{folder}/b"
    n = 3 * GROUP_PAGES + 1
    for i in range(n):
        put(landing, "2026-01-01", i, page(entry(i)))
    assert ingest_bronze(spark, landing, bronze, "src", "run") == n
    found = footers(list_files(spark, bronze)).collect()
    assert sum(r.n_rows for r in found) == n
    assert all(r.n_row_groups * GROUP_PAGES >= r.n_rows for r in found)
    assert len(parse_entries(read_published(spark, bronze, BRONZE_SCHEMA)).select("appid").distinct().collect()) == n
