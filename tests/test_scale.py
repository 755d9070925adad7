"""Plans and skew: what must hold when a table is a million times larger."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import payload_checks
from larder.functions.ranking import number_within
from larder.operators import gold, merge
from larder.plans import Catalogue, silver
from larder.schemas import SILVER
from larder.session import work_dir
from larder.sources import landing
from larder.sources.star import AS_OF, StarMenus, read_table
from larder.sources.star_pages import StarPages
from tests.helpers import moment
from tests.helpers import pages as bronze_pages
from tests.helpers import table

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_settings(spark):
    """Skew handling and no broadcasts, at test size."""
    before = {key: spark.conf.get(key, None) for key in SKEW}
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# Queries that run actions of their own (landing, publishing, streaming) are covered by the
# operators they use; the others must plan without products, Python or driver-side work.
@pytest.mark.parametrize("name", [
    "weekly_menu_metrics", "weekly_menu_metrics_compat", "recipe_survival_metrics",
    "ingredient_trends", "menu_stability_metrics", "allergen_density", "scd_upsert_entity",
    "scd_patch", "scd_deactivate", "scd2_history", "scd2_changes", "recipes_without_links",
    "recipe_link_counts", "by_family", "top_allergens_pct", "q02_used_ingredients",
    "q03_menu_diversity", "q05_cuisine_distribution", "q19_difficulty_usage"])
def test_no_products_and_no_python(spark, sf_dir, skew_settings, name):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoop", "Python", "ArrowEval"):
        assert unwanted not in plan


@pytest.mark.parametrize("name", [
    "recipes_without_links", "weekly_menu_metrics_compat", "popular_ingredients",
    "q02_used_ingredients"])
def test_right_sides_of_semi_and_anti_joins_are_distinct(spark, sf_dir, skew_settings, name):
    """Adaptive execution splits only the left side, so a hot key on the right must be one row."""
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    lines, found = plan.splitlines(), 0
    for at, line in enumerate(lines):
        if "Join LeftAnti" in line or "Join LeftSemi" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            below = [i for i in range(at + 1, len(lines))
                     if len(lines[i]) - len(lines[i].lstrip(" :+-")) == depth + 3]
            assert "Aggregate" in lines[below[1]], lines[below[1]]
            found += 1
    assert found


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    rows = StarMenus(spark, sf_dir).menus.filter(F.col("id") == 7).select("id", "is_active")
    plan = plan_of(rows)
    assert "PushedFilters: [IsNotNull(o_orderkey), EqualTo(o_orderkey,7)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_unused_spans_are_not_computed(spark, sf_dir):
    """Recipe names need no join with the order lines."""
    plan = plan_of(StarMenus(spark, sf_dir).recipes.select("id", "name"))
    assert "Join" not in plan and "lineitem" not in plan


def test_tables_of_a_catalogue_are_stored_once(spark, sf_dir, tmp_path):
    """Gold tables and queries read the same stored links."""
    home = str(tmp_path)
    cat = Catalogue(StarMenus(spark, sf_dir).builders(), as_of=AS_OF).storing_silver(
        home).storing_gold(home)
    assert cat.menu_recipes.count() and cat.weekly_menu_metrics.count()
    for name in ("menus", "menu_recipes", "weekly_items"):
        assert len(list((tmp_path / name).glob("version=*"))) == 1, name


def test_links_tracked_by_stored_recipes_do_not_read_lines(spark, sf_dir):
    known = spark.createDataFrame([], "id long, first_seen_date date, last_seen_date date, "
                                      "is_active int")
    star = StarMenus(spark, sf_dir, lambda: known)
    for rows in (star.recipe_allergens, star.allergens):
        assert "lineitem" not in plan_of(rows)


def test_top_per_week_is_cut_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan_of(entry.queries()["q16_top_allergens_per_week"](
        spark, sf_dir))


@pytest.mark.parametrize("endpoint", ["menus", "recipes"])
def test_lists_of_pages_are_made_after_the_last_shuffle(spark, sf_dir, skew_settings, endpoint):
    """What travels are lines, and for details also one list for each page; no group of lists is
    shuffled, sorted for a join and grouped again."""
    lines = plan_of(getattr(StarPages(spark, sf_dir), endpoint)).splitlines()
    lists = [i for i, line in enumerate(lines) if "collect_list" in line and "p_name" not in line]
    moves = [i for i, line in enumerate(lines) if "Exchange" in line]
    above = sum(i < max(lists) for i in moves)
    assert lists and above == {"menus": 0, "recipes": 1}[endpoint]


def test_menu_pages_are_written_without_another_shuffle(spark, sf_dir, tmp_path):
    pages = StarPages(spark, sf_dir)
    pages._tasks = 8
    landing.append_bronze(pages.menus, f"{tmp_path}/pages", dealt=True)
    stored = landing.read_bronze(spark, f"{tmp_path}/pages")
    held = stored.select("pull_date", F.col("_metadata.file_path").alias("f")).distinct().count()
    months = stored.select("pull_date").distinct().count()
    assert held <= months + 8  # a task holds neighbouring months, and shares its first and last
    whole = ("pull_date", "page_number", "payload")
    assert sorted(map(str, table(stored, *whole))) == sorted(map(str, table(pages.menus, *whole)))


def test_pages_of_menus_and_recipes_share_the_shuffle_of_lines(spark, sf_dir, skew_settings,
                                                               monkeypatch):
    """They are landed together, and no document is shuffled."""
    landed, append = [], landing.append_bronze
    monkeypatch.setattr(landing, "append_bronze", lambda pages, path, dealt=False: landed.append(
        (pages, dealt)) or append(pages, path, dealt))
    payload_checks.bronze_pages.__wrapped__(spark, sf_dir)
    (listings, dealt), = [each for each in landed if "l_partkey" in plan_of(each[0])]
    assert dealt and {row["endpoint"] for row in listings.collect()} == {"menus", "recipes"}
    assert "ReusedExchange" in plan_of(listings)


def test_pages_of_repeated_and_missing_rows(spark, tmp_path):
    """A part that comes twice is two recipes, a key with two parts as well, in the order of their
    attributes; lines of a supplier are added up."""
    day = moment("2001-03-05T00:00:00")
    rows = {
        "orders": ("o_orderkey long, o_orderdate timestamp_ntz, o_orderpriority string, "
                   "o_custkey long", [(7, day, "1", 41), (8, None, "1", None)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_quantity double",
                     [(7, 1, 2, 3.0), (7, 1, 2, 4.0), (7, 1, 29, 1.0), (7, 2, 3, None),
                      (7, 60, 2, 5.0), (8, 1, None, 1.0), (None, 1, 2, 1.0), (9, 1, 2, 1.0)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_size int, p_type string",
                 [(1, "a", "B", 17, "T"), (1, "a", "B", 17, "T"), (2, "x", "C", 50, "T"),
                  (2, "w", None, 3, "U"), (60, "y", "D", None, None)]),
    }
    for name, (schema, held) in rows.items():
        spark.createDataFrame(held, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    made = StarPages(spark, str(tmp_path))

    def recipe(n, key, name, brand, size, kind, *used):
        fields = [f'"n":{n}' if n else "", f'"id":{key}' if key else "", f'"name":"{name}"',
                  f'"headline":"{brand}"' if brand else "",
                  f'"difficulty":{size},"prep_time":"{size} mins"' if size else "",
                  f'"servingSize":"2","imagePath":"img/{n or key}"',
                  f'"cuisine":{{"name":"{kind}"}}' if kind else "",
                  '"ingredients":[%s]' % ",".join(used)]
        return "{%s}" % ",".join(filter(None, fields))

    a = ('{"n":2,"id":"2","quantity":7,"unit":"g"}', '{"n":29,"id":"","quantity":1,"unit":"pcs"}')
    b = '{"n":3,"id":"3","unit":"pcs"}'
    first = recipe(1, 1, "a", "B", 17, None, *a)
    unknown = recipe(1, 1, "a", "B", 17, None, '{"id":"","quantity":1,"unit":"pcs"}')
    page = '{"data":[{"id":7,"url":"menu/7","year_week":"200103","start":"2001-03-01",' \
           '"recipes":[%s]}],"meta":{"last_page":2}}'
    assert table(made.menus, "pull_date", "page_number", "payload") == sorted([
        ("2001-03-01", 1, page % ",".join([
            first, first, recipe(2, None, "x", "C", 50, "T", b),
            recipe(2, 2, "w", None, 3, "U", b)])),
        ("2001-03-01", 2, page % recipe(60, None, "y", "D", None, None,
                                        '{"n":2,"id":"2","quantity":5,"unit":"g"}')),
        (None, 1, '{"data":[{"id":8,"url":"menu/8","recipes":[%s]}],"meta":{}}' % ",".join(
            [unknown, unknown]))], key=lambda row: tuple((v is None, str(v)) for v in row))
    twice = [text for pull, text in table(made.recipes, "pull_date", "payload")
             if pull and '"id":1,' in text]
    assert len(twice) == 2 and len(set(twice)) == 1
    assert twice[0].startswith('{"data":{"id":1,"name":"a",') and twice[0].endswith("}}")


def listed_thrice(spark):
    return bronze_pages(spark, *(
        ("2026-01-15", "menus", '{"data": [{"id": "m%d", "recipes": [{"id": "r%d", "name": "Soup",'
         '"ingredients": [{"id": "i1", "unit": "g"}]}]}]}' % (n, n), n) for n in (1, 2, 3)), (
        "2026-01-15", "recipes", '{"id": "r1", "name": "Soup", "tags": [{"id": "t1"}]}')).coalesce(1)


def loaded(spark, seen, tables=SILVER):
    """What ``seen`` makes of each table's state, while its documents are staged."""
    found = {}
    silver.Warehouse(spark, work_dir(spark, "house"))._load(
        listed_thrice(spark), tables,
        lambda store, state: found.update({store.path.rsplit("/", 1)[1]: seen(state)}))
    return found


def test_tables_read_their_own_fields_of_staged_documents(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "9999")
    try:
        plans = loaded(spark, plan_of)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    for name, plan in plans.items():
        assert name == "recipes" or "headline:string" not in plan, name
    assert "recipes:array<struct<id:string>>" in plans["menu_recipes"]
    assert "recipe:struct<id:string,tags:array<struct<id:string>>>" in plans["recipe_tags"]


def test_staged_files_hold_a_bounded_number_of_documents(spark, monkeypatch):
    monkeypatch.setattr(silver, "STAGED", 1, raising=False)
    rows = lambda state: [r["count"] for r in spark.read.parquet(*state.inputFiles()).groupBy(
        "_metadata.file_path").count().collect()]
    assert loaded(spark, rows, ("menus", "menu_recipes"))["menus"] == [1, 1, 1]


def test_newest_pull_of_a_table_needs_no_combining(spark):
    house = silver.Warehouse(spark, work_dir(spark, "house"), deactivate=True)
    house.append(listed_thrice(spark))
    menus = house.table("menus")
    assert menus._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [id") == 1
    assert table(menus, "id", "is_active") == [("m1", 1), ("m2", 1), ("m3", 1)]


def hot_links(spark, count=60000):
    """A third of all links on one menu, a third of all on one recipe."""
    n = F.col("id")
    return spark.range(count).select(
        F.when(n % 3 == 0, 0).otherwise(n % 997 + 1).alias("menu_id"),
        F.when(n % 3 == 1, 0).otherwise(n + 1).alias("recipe_id"),
        F.lit(1).alias("is_active")).distinct()


def test_hot_menu_is_split_and_whole(spark, skew_settings):
    links = hot_links(spark)
    menus = spark.range(998).select(
        "id", F.date_add(F.lit("2026-01-03").cast("date"), (F.col("id") % 8 * 7).cast("int"))
        .alias("start_date"), F.lit(1).alias("is_active"))
    items = gold.weekly_items(menus, links)
    got = {(r[0], r[1], r[2]) for r in items.collect()}
    assert "skewed" in plan_of(items)
    wanted = {}
    starts = {r.id: r.start_date for r in menus.collect()}
    for link in links.collect():
        key = (starts[link.menu_id], link.recipe_id)
        wanted[key] = wanted.get(key, 0) + 1
    assert got == {(*key, n) for key, n in wanted.items()}


def test_links_are_not_multiplied_by_weeks_before_the_shuffle(spark, skew_settings):
    """Each of 6 recipes is listed in 30 weeks; one ingredient is in all, one link is doubled."""
    day = F.date_add(F.lit("2026-01-03").cast("date"), (F.col("id") * 7).cast("int"))
    menus = spark.range(30).select("id", day.alias("start_date"), F.lit(1).alias("is_active"))
    recipes = spark.range(6).select("id")
    on = recipes.withColumnRenamed("id", "recipe_id").withColumn("is_active", F.lit(1))
    listed = on.crossJoin(menus.select(F.col("id").alias("menu_id")))
    links = on.withColumn("ingredient_id", F.lit(0)).unionByName(
        on.withColumn("ingredient_id", F.col("recipe_id").cast("int") % 2 + 1)).unionByName(
        on.filter("recipe_id = 5").withColumn("ingredient_id", F.lit(2)))
    names = spark.range(3).select(F.col("id").cast("int").alias("ingredient_id"),
                                  F.col("id").cast("string").alias("name"),
                                  F.lit(1).alias("is_active"))
    counts = gold.ingredient_week_counts(names, links, recipes, listed, menus)
    assert table(counts.groupBy("ingredient_id").agg(
        F.count("*").alias("weeks"), F.min("recipe_count").alias("low"),
        F.max("recipe_count").alias("high"))) == [(0, 30, 6, 6), (1, 30, 3, 3), (2, 30, 4, 4)]
    lines = plan_of(gold.ingredient_week_counts(names, links, recipes, listed, menus)).splitlines()
    unpacked = [i for i, line in enumerate(lines) if "explode(_weeks" in line]
    assert unpacked and "Exchange hashpartitioning(ingredient_id" in "".join(
        lines[unpacked[0]:unpacked[0] + 4])


def test_hot_key_is_combined_before_the_shuffle(spark):
    """A key with a third of all observations leaves each map task as one row."""
    rows = spark.range(90000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 30).cast("int"))
        .alias("pull_date"), F.col("id").alias("value"))
    state = merge.fold(rows, ["key"], ["value"], ["value"])
    assert plan_of(state).count("partial_max") >= 1
    hot = merge.published(state).filter("key = 0")
    newest = max(n for n in range(0, 90000, 3) if n % 30 == 27)
    assert table(hot) == [(0, newest, "2026-01-01", "2026-01-28", 1)]


def test_ranking_never_gathers_a_group(spark):
    """The windows of a ranking are per range or over counts of ranges, not per week."""
    rows = spark.range(1000).select(F.lit("w").alias("g"), F.col("id").alias("k"),
                                    (F.col("id") % 7).alias("n"))
    plan = plan_of(number_within(rows, ["g"], "n", "k", "place"))
    over_rows = [line for line in plan.splitlines() if "row_number()" in line]
    assert over_rows and all("windowspecdefinition(_part" in line for line in over_rows)


def test_ranked_ids_with_a_common_prefix_spread_over_tasks(spark, monkeypatch):
    """One week, one count, ids that differ in their last digits only."""
    homes = []
    monkeypatch.setattr("larder.functions.ranking.work_dir",
                        lambda *_: homes.append(work_dir(*_)) or homes[-1])
    rows = spark.range(20_000).select(
        F.lit("w").alias("g"), F.lit(1).alias("n"),
        F.format_string("catalogue-item-%08d", "id").alias("k"))
    ranked = number_within(rows, ["g"], "n", "k", "place")
    assert ranked.filter("int(right(k, 8)) + 1 <> place").count() == 0
    shares = spark.read.parquet(homes[0]).groupBy("_part").count().collect()
    assert len(shares) == 4 and max(r["count"] for r in shares) < 10_000


def test_results_do_not_depend_on_partitioning(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem")
    links = lines.select(F.col("l_orderkey").alias("menu_id"),
                         F.col("l_partkey").alias("recipe_id"),
                         F.lit(1).alias("is_active")).distinct()
    menus = StarMenus(spark, sf_dir).menus
    one = gold.menu_stability_metrics(menus, links.coalesce(1))
    many = gold.menu_stability_metrics(menus, links.repartition(13))
    assert table(one) == table(many)
