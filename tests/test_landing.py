"""Landing, append-only bronze, published versions and the stream."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from larder.plans.silver import Warehouse
from larder.session import work_dir
from larder.sources import landing
from larder.sources.published import Load, PublishedTable
from larder.streaming import incremental
from tests.helpers import pages, table


def menu(pull, *ids):
    return json.dumps({"data": [{"id": "m" + pull, "start": pull, "recipes": [
        {"id": i, "name": f"{i}@{pull}"} for i in ids]}]})


def local(path):
    return Path(path.removeprefix("file:"))


def test_landed_files_become_bronze_pages(spark):
    home = work_dir(spark, "landed")
    for number in (1, 2):
        folder = local(home) / "pull_date=2026-02-03" / "endpoint=menus" / "locale=en-GB"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"page-{number:04d}.json").write_text(f'{{"data":\n [], "n": {number}}}')
    rows = landing.read_landed_pages(spark, home)
    assert table(rows) == [
        ("2026-02-03", "menus", "en-GB", n, f'{{"data":\n [], "n": {n}}}') for n in (1, 2)]


def test_bronze_is_append_only(spark):
    path = work_dir(spark, "bronze") + "/t"
    rows = pages(spark, ("2026-02-03", "menus", "{}"), ("2026-02-03", "tags", "{}"))
    landing.append_bronze(rows, path)
    landing.append_bronze(rows.limit(1), path)
    stored = landing.read_bronze(spark, path)
    assert stored.count() == 3
    assert stored.filter(F.col("ingestion_timestamp").isNull()).count() == 0


def test_reading_one_endpoint_prunes_partitions(spark):
    path = work_dir(spark, "bronze") + "/t"
    landing.append_bronze(pages(spark, ("2026-02-03", "menus", "{}"),
                                ("2026-02-10", "tags", "{}")), path)
    plan = landing.read_bronze(spark, path).filter("endpoint = 'tags'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(endpoint" in text


def test_versions_switch_and_repeat(spark):
    store = PublishedTable(spark, work_dir(spark, "table"))
    assert store.read() is None
    store.publish(spark.range(1))
    store.publish(store.read().union(spark.range(5, 7)))  # reads what it replaces
    assert table(store.read()) == [(0,), (5,), (6,)]
    store.publish(spark.range(9, 10), load=Load("s", 0))
    store.publish(spark.range(3), load=Load("s", 0))  # committed before: not written again
    assert table(store.read()) == [(9,)]
    assert [c.version for c in store.commits()] == [0, 1, 2]
    store.expire()
    assert table(spark.read.parquet(f"{store.path}/version=1")) == [(0,), (5,), (6,)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{store.path}/version=0")


def test_only_a_missing_log_means_nothing_is_stored(spark):
    store = PublishedTable(spark, work_dir(spark, "table"))
    assert store.read() is None
    spark.createDataFrame([("x",)], "version string").write.parquet(f"{store.path}/log")
    with pytest.raises(Exception):
        store.read()


def test_failed_publish_leaves_the_old_version(spark):
    store = PublishedTable(spark, work_dir(spark, "table"))
    store.publish(spark.range(1))
    with pytest.raises(Exception, match="broken"):
        store.publish(spark.range(1).select(F.raise_error(F.lit("broken")).alias("id")))
    assert table(store.read()) == [(0,)]


WEEKS = [("2026-01-15", "menus", menu("2026-01-15", 1, 2)),
         ("2026-01-22", "menus", menu("2026-01-22", 2)),
         ("2026-01-29", "menus", menu("2026-01-29", 2, 3))]
TABLES = ("recipes", "menu_recipes")


def test_stream_equals_rebuild_and_is_safe_to_rerun(spark):
    home = work_dir(spark, "stream")
    for week in (WEEKS[2], WEEKS[0]):  # the newest pull lands first
        landing.append_bronze(pages(spark, week), f"{home}/bronze")
    house = Warehouse(spark, f"{home}/silver")

    def run():
        stream = incremental.bronze_stream(spark, f"{home}/bronze", files_per_batch=1)
        incremental.silver_stream(stream, house, f"{home}/checkpoint", TABLES)

    run()
    landing.append_bronze(pages(spark, WEEKS[1]), f"{home}/bronze")
    run()
    run()  # nothing new
    rebuilt = Warehouse(spark, f"{home}/rebuilt")
    rebuilt.rebuild(landing.read_bronze(spark, f"{home}/bronze"), TABLES)
    for name in TABLES:
        assert table(house.table(name).drop("_ingestion_ts")) == table(
            rebuilt.table(name).drop("_ingestion_ts"))
    assert house.store("recipes").current_version() == 2
    newest = landing.read_bronze(spark, f"{home}/bronze").agg(F.max("pull_date")).scalar()
    assert table(house.table("recipes", newest), "id", "name", "first_seen_date",
                 "last_seen_date", "is_active") == [
        ("1", "1@2026-01-15", "2026-01-15", "2026-01-15", 0),
        ("2", "2@2026-01-29", "2026-01-15", "2026-01-29", 1),
        ("3", "3@2026-01-29", "2026-01-29", "2026-01-29", 1)]


def test_replayed_batch_changes_nothing(spark):
    house = Warehouse(spark, work_dir(spark, "replay"))
    house.append(pages(spark, WEEKS[0]), TABLES, Load("stream", 0))
    house.append(pages(spark, WEEKS[1]), TABLES, Load("stream", 1))
    before = table(house.table("recipes"))
    house.append(pages(spark, WEEKS[1]), TABLES, Load("stream", 1))
    assert table(house.table("recipes")) == before
    assert house.store("recipes").current_version() == 1


def test_rebuild_append_and_stream_share_one_line(spark, monkeypatch):
    """Whatever comes before, nothing is lost: all ways give what a rebuild of everything gives."""
    home = work_dir(spark, "line")
    whole = Warehouse(spark, f"{home}/whole", deactivate=True)
    whole.rebuild(pages(spark, *WEEKS), TABLES)

    def streamed(house, name, *weeks):
        for week in weeks:
            landing.append_bronze(pages(spark, week), f"{home}/{name}")
        incremental.silver_stream(incremental.bronze_stream(spark, f"{home}/{name}"), house,
                                  f"{home}/{name}-checkpoint", TABLES)

    rebuilt = Warehouse(spark, f"{home}/a", deactivate=True)
    rebuilt.rebuild(pages(spark, WEEKS[0]), TABLES)
    streamed(rebuilt, "a-bronze", WEEKS[1], WEEKS[2])

    mixed = Warehouse(spark, f"{home}/b", deactivate=True)
    for _ in range(2):
        mixed.append(pages(spark, WEEKS[2]), TABLES)
    streamed(mixed, "b-bronze", WEEKS[0])
    mixed.append(pages(spark, WEEKS[2]), TABLES)
    streamed(mixed, "b-bronze", WEEKS[1])

    monkeypatch.setattr("larder.plans.silver.DELTAS", 2)
    compacted = Warehouse(spark, f"{home}/c", deactivate=True)
    for week in WEEKS * 2:
        compacted.append(pages(spark, week), TABLES)
    for name in TABLES:
        want = table(whole.table(name).drop("_ingestion_ts"))
        for house in (rebuilt, mixed, compacted):
            assert table(house.table(name).drop("_ingestion_ts")) == want, (house.path, name)
    store = compacted.store("recipes")
    assert len(store.parts()) <= 2 and sum(c.base for c in store.commits()) > 1
    assert table(whole.table("recipes"), "id", "is_active") == [("1", 0), ("2", 1), ("3", 1)]


def test_an_append_writes_its_batch_only(spark):
    house = Warehouse(spark, work_dir(spark, "delta"))
    house.append(pages(spark, *WEEKS), ("recipes",))
    house.append(pages(spark, ("2026-02-05", "menus", menu("2026-02-05", 9))), ("recipes",))
    parts = house.store("recipes").parts()
    assert [p.count() for p in parts] == [3, 1]
    assert len(table(house.table("recipes"))) == 4


@pytest.mark.parametrize("dealt", [True, False])
def test_a_file_holds_a_bounded_number_of_pages(spark, tmp_path, monkeypatch, dealt):
    monkeypatch.setattr(landing, "PAGES", 2, raising=False)
    rows = pages(spark, *(("2026-01-01", "menus", "{}", n) for n in range(5))).coalesce(1)
    landing.append_bronze(rows, str(tmp_path), dealt=dealt)
    held = landing.read_bronze(spark, str(tmp_path)).groupBy("_metadata.file_path").count()
    assert sorted(r["count"] for r in held.collect()) == [1, 2, 2]
