"""Bronze selection and audits, payload flattening, rebuild, append and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import catalogue, on_catalogue, per_session, register
from larder.functions import calendar
from larder.operators import bronze, flatten, merge
from larder.library import quality
from larder.library.shared import per_table
from larder.plans.silver import Warehouse
from larder.schemas import GOLD, SILVER
from larder.session import work_dir
from larder.sources import landing
from larder.sources.published import PublishedTable
from larder.sources.star import StarMenus, read_table
from larder.sources.star_pages import StarPages
from larder.streaming import incremental

# --- calendar -------------------------------------------------------------------------

register(
    "week_bounds",
    lambda spark, sf: read_table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("day")).distinct().select(
        "day", calendar.week_start(F.col("day")).alias("monday"),
        calendar.week_end(F.col("day")).alias("sunday"),
        calendar.next_week_start(F.col("day")).alias("next_monday")),
    """SELECT DISTINCT o_orderdate::DATE AS day,
              date_trunc('week', o_orderdate)::DATE AS monday,
              date_trunc('week', o_orderdate)::DATE + 6 AS sunday,
              date_trunc('week', o_orderdate)::DATE + 7 AS next_monday FROM orders""")


def iso_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    selector = F.concat(F.extract(F.lit("YEAROFWEEK"), day), F.lit("-W"),
                        F.lpad(F.weekofyear(day).cast("string"), 2, "0"))
    weeks = read_table(spark, sf_dir, "orders").select(selector.alias("week")).distinct()
    window = calendar.week_window(F.col("week"))
    return weeks.select("week", window["start"].alias("monday"), window["end"].alias("sunday"))


register("iso_week_monday", iso_weeks,
         """SELECT DISTINCT strftime(o_orderdate, '%G-W%V') AS week,
                   date_trunc('week', o_orderdate)::DATE AS monday,
                   date_trunc('week', o_orderdate)::DATE + 6 AS sunday FROM orders""")

# --- bronze ---------------------------------------------------------------------------

API = "pull_date, endpoint, locale, page_number, payload, ingestion_timestamp, event_id"

on_catalogue("latest_pull", lambda cat: bronze.latest_pull(cat.api_responses),
             f"""SELECT {API} FROM api_responses
                 WHERE pull_date = (SELECT max(ts)::DATE FROM events)""")
on_catalogue("bronze_distinct_payloads",
             lambda cat: bronze.distinct_stored_payloads(cat.api_responses),
             "SELECT DISTINCT ts::DATE AS pull_date, event_type AS endpoint, props AS payload "
             "FROM events")
on_catalogue("bronze_summary", lambda cat: bronze.summary(cat.api_responses),
             "SELECT event_type AS endpoint, count(*) AS responses FROM events GROUP BY 1")


def damaged(pages: DataFrame) -> DataFrame:
    """Every 97th payload loses its last character, every 89th is missing."""
    payload = F.col("payload")
    return pages.withColumn("payload", F.when(
        F.col("event_id") % 97 == 0, F.substring(payload, F.lit(1), F.length(payload) - 1)
    ).when(F.col("event_id") % 89 != 0, payload))


DAMAGED = """SELECT * REPLACE (CASE WHEN event_id % 97 = 0 THEN left(payload, -1)
                                    WHEN event_id % 89 <> 0 THEN payload END AS payload)
             FROM api_responses"""

on_catalogue("bronze_bad_json", lambda cat: bronze.malformed(damaged(cat.api_responses)),
             f"SELECT {API} FROM ({DAMAGED}) WHERE payload IS NULL OR NOT json_valid(payload)")
on_catalogue("bronze_good_json", lambda cat: bronze.well_formed(damaged(cat.api_responses)),
             f"SELECT {API} FROM ({DAMAGED}) WHERE json_valid(payload)")


def odd_starts(cat) -> DataFrame:
    text = F.date_format("last_seen_date", "yyyy-MM-dd")
    start = F.when(F.col("id") % 10 == 3, F.replace(text, F.lit("-"), F.lit("/"))).when(
        F.col("id") % 10 != 7, text)
    return cat.menus.select("id", start.alias("start"))


on_catalogue(
    "menus_in_range",
    lambda cat: bronze.in_window(odd_starts(cat), "1998-01-01", "1998-12-31"),
    """SELECT o_orderkey AS id,
              CASE o_orderkey % 10 WHEN 3 THEN strftime(o_orderdate, '%Y/%m/%d')
                   WHEN 7 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS start
       FROM orders WHERE o_orderkey % 10 IN (3, 7) OR year(o_orderdate) = 1998""")


def landed_twice(spark: SparkSession, sf_dir: str) -> str:
    """Land the events as JSON lines, append them in two loads, return the bronze folder."""
    home = work_dir(spark, "bronze")
    pages = StarMenus(spark, sf_dir).api_responses
    odd = F.col("event_id") % 2 == 1
    for load, rows in (("first", pages.filter(odd)), ("second", pages.filter(~odd))):
        rows.drop("ingestion_timestamp", "event_id").write.json(f"{home}/landed-{load}")
        landing.append_bronze(landing.read_landed_lines(spark, f"{home}/landed-{load}"),
                              f"{home}/bronze")
    return f"{home}/bronze"


register("bronze_append",
         lambda spark, sf: landing.read_bronze(spark, landed_twice(spark, sf)).drop(
             "ingestion_timestamp"),
         """SELECT pull_date, endpoint, locale, page_number::INTEGER AS page_number, payload
            FROM api_responses""")

# --- pages made from the star tables --------------------------------------------------

PAGE_RECIPES = """
    SELECT l_orderkey, l_partkey, l_suppkey // 50 AS sb, l_partkey // 50 AS pb, p.*,
           row_number() OVER (PARTITION BY l_orderkey, l_partkey // 50, l_suppkey // 50
                              ORDER BY l_partkey) - 1 AS pos
    FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey // 50 * 50 AS l_suppkey
          FROM lineitem) JOIN part p ON p_partkey = l_partkey"""
PAGE_ORDERS = """
    SELECT DISTINCT l_orderkey, l_partkey // 50 AS pb, l_suppkey // 50 AS sb, month,
           o_orderdate, o_custkey
    FROM order_lines JOIN orders ON o_orderkey = l_orderkey"""
RECIPE_COLUMNS = """
    p_partkey::VARCHAR AS id, p_name AS name, p_brand AS headline,
    p_size::DOUBLE AS difficulty, p_size || ' mins' AS prep_time, '2' AS serving_size,
    CASE WHEN p_size % 17 <> 0 THEN p_type END AS cuisine,
    'img/' || p_partkey AS image_url"""


@per_session
def bronze_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze table of all pages, landed once per session and data folder."""
    path = work_dir(spark, "pages")
    pages = StarPages(spark, sf_dir)
    landing.append_bronze(pages.listings, path, dealt=True)
    landing.append_bronze(pages.references, path)
    return landing.read_bronze(spark, path)


def menus_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.menu_documents(bronze_pages(spark, sf_dir))


def details_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.recipe_documents(bronze_pages(spark, sf_dir))


AUDITED = f"""
    SELECT month AS pull_date, 'menus' AS endpoint, pb + 1 AS page,
           o_custkey % 40 + 1 AS last_page, 1 AS records FROM ({PAGE_ORDERS})
    UNION ALL
    SELECT min(month), 'recipes', l_suppkey // 50 + 1, NULL, 1
    FROM order_lines GROUP BY l_partkey, l_suppkey // 50
    UNION ALL
    SELECT DATE '1995-01-01', 'ingredients', s_suppkey // 50 + 1, NULL, 1 FROM supplier
    UNION ALL SELECT DATE '1995-01-01', 'allergens', 1, NULL, count(DISTINCT p_brand) FROM part
    UNION ALL SELECT DATE '1995-01-01', 'tags', 1, NULL, count(DISTINCT p_type) FROM part
    UNION ALL SELECT DATE '1995-01-01', 'labels', 1, NULL, count(DISTINCT p_size) FROM part"""

ANNOUNCED = f"""
    SELECT *, coalesce(max(last_page) OVER (PARTITION BY pull_date, endpoint), 1) AS announced
    FROM ({AUDITED})"""


def audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all pages, those of tags without a locale; missing pages as text."""
    locale = F.when(F.col("endpoint") != "tags", F.col("locale"))
    audit = bronze.page_audit(bronze_pages(spark, sf_dir).withColumn("locale", locale))
    return audit.withColumn("missing", F.array_join(F.transform(
        "missing", lambda m: F.concat_ws("-", m["first"], m["last"])), ","))


register(
    "bronze_page_audit", audited,
    f"""SELECT pull_date, endpoint, CASE WHEN endpoint <> 'tags' THEN 'en-GB' END AS locale,
               count(DISTINCT page) FILTER (page <= announced) AS pages_stored,
               announced::INTEGER AS pages_announced, max(page)::INTEGER AS max_page,
               sum(records)::BIGINT AS records,
               count(DISTINCT page) FILTER (page <= announced) >= announced AS is_complete,
               coalesce(any_value(holes), '') AS missing
        FROM ({ANNOUNCED}) LEFT JOIN (
          SELECT pull_date, endpoint, string_agg(before + 1 || '-' || page - 1, ',' ORDER BY page)
                 AS holes
          FROM (SELECT *, lag(page) OVER (PARTITION BY pull_date, endpoint ORDER BY page) AS before
                FROM (SELECT DISTINCT pull_date, endpoint, page FROM ({ANNOUNCED})
                      WHERE page <= announced
                      UNION SELECT pull_date, endpoint, 0 FROM ({ANNOUNCED})
                      UNION SELECT pull_date, endpoint, announced + 1 FROM ({ANNOUNCED})))
          WHERE page > before + 1 GROUP BY pull_date, endpoint) USING (pull_date, endpoint)
        GROUP BY pull_date, endpoint, announced""")
register("menu_recipe_ids", lambda spark, sf: flatten.listed_recipe_ids(menus_of(spark, sf)),
         """SELECT DISTINCT l_partkey::VARCHAR AS recipe_id
            FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size <> 50""")
register(
    "flat_menus",
    lambda spark, sf: flatten.menu_rows(menus_of(spark, sf)).select(
        "pull_date", "page_number", "id", "url", "year_week", "start_date"),
    f"""SELECT month AS pull_date, (pb + 1)::INTEGER AS page_number,
               l_orderkey::VARCHAR AS id, 'menu/' || l_orderkey AS url,
               strftime(o_orderdate, '%Y%m') AS year_week, month AS start_date
        FROM ({PAGE_ORDERS})""")
register(
    "flat_recipes",
    lambda spark, sf: flatten.recipe_rows(flatten.menu_recipe_documents(menus_of(spark, sf)))
    .select("id", "name", "headline", "difficulty", "prep_time", "serving_size", "cuisine",
            "image_url"),
    f"SELECT {RECIPE_COLUMNS} FROM ({PAGE_RECIPES}) WHERE p_size <> 50")
register(
    "flat_menu_recipes",
    lambda spark, sf: flatten.menu_recipe_rows(
        flatten.menu_recipe_documents(menus_of(spark, sf))).select(
        "menu_id", "recipe_id", "position"),
    f"""SELECT l_orderkey::VARCHAR AS menu_id, l_partkey::VARCHAR AS recipe_id,
               pos::INTEGER AS position FROM ({PAGE_RECIPES}) WHERE p_size <> 50""")
register(
    "flat_recipe_ingredients",
    lambda spark, sf: flatten.recipe_ingredient_rows(
        flatten.menu_recipe_documents(menus_of(spark, sf))).select(
        "recipe_id", "ingredient_id", "quantity", "unit", "position"),
    """SELECT l_partkey::VARCHAR AS recipe_id, l_suppkey::VARCHAR AS ingredient_id,
              quantity, unit, position
       FROM (SELECT l_orderkey, l_partkey, l_suppkey, sum(l_quantity)::BIGINT::VARCHAR AS quantity,
                    if(l_suppkey % 2 = 0, 'g', 'pcs') AS unit,
                    (row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey // 50
                                        ORDER BY l_suppkey) - 1)::INTEGER AS position
             FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey)
       JOIN part ON p_partkey = l_partkey WHERE p_size <> 50 AND l_suppkey % 29 <> 0""")

DETAIL_PAGES = """
    SELECT l_partkey, l_suppkey // 50 AS sb, min(month) AS pull_date
    FROM order_lines GROUP BY ALL"""

register(
    "flat_recipe_details",
    lambda spark, sf: flatten.recipe_rows(details_of(spark, sf)).select(
        "pull_date", "page_number", "id", "name", "headline", "difficulty", "prep_time",
        "serving_size", "cuisine", "image_url"),
    f"""SELECT pull_date, (sb + 1)::INTEGER AS page_number, {RECIPE_COLUMNS}
        FROM ({DETAIL_PAGES}) JOIN part ON p_partkey = l_partkey""")
register(
    "flat_detail_ingredients",
    lambda spark, sf: flatten.recipe_ingredient_rows(details_of(spark, sf)).select(
        "recipe_id", "ingredient_id", "quantity", "position"),
    """SELECT l_partkey::VARCHAR AS recipe_id, l_suppkey::VARCHAR AS ingredient_id,
              quantity, position
       FROM (SELECT l_partkey, l_suppkey, sum(l_quantity)::BIGINT::VARCHAR AS quantity,
                    (row_number() OVER (PARTITION BY l_partkey, l_suppkey // 50
                                        ORDER BY l_suppkey) - 1)::INTEGER AS position
             FROM lineitem GROUP BY l_partkey, l_suppkey)
       WHERE l_suppkey % 29 <> 0""")
for kind, key, value in (("allergens", "allergen_id", "p_brand"), ("tags", "tag_id", "p_type"),
                         ("labels", "label_id", "'size-' || p_size")):
    register(
        f"flat_recipe_{kind}",
        lambda spark, sf, k=kind, c=key: flatten.recipe_link_rows(
            details_of(spark, sf), k).select("pull_date", "recipe_id", c),
        f"""SELECT pull_date, l_partkey::VARCHAR AS recipe_id, {value} AS {key}
            FROM ({DETAIL_PAGES}) JOIN part ON p_partkey = l_partkey""")


def reference(spark: SparkSession, sf_dir: str, endpoint: str) -> DataFrame:
    rows = flatten.reference_rows(bronze_pages(spark, sf_dir), endpoint)
    return rows.withColumn("present", F.array_join("present", ",")).drop(*flatten.LINEAGE, "seq")


REFERENCE_SQL = {
    "ingredients": """
        SELECT s_suppkey::VARCHAR AS ingredient_id, s_name AS name,
               CASE WHEN s_suppkey % 3 <> 0 THEN n_name END AS family, NULL::VARCHAR AS type,
               CASE WHEN s_suppkey % 3 <> 0 THEN 'name,family' ELSE 'name' END AS present
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "allergens": """
        SELECT DISTINCT p_brand AS allergen_id, p_brand AS name, NULL::VARCHAR AS type,
               'icons/' || p_brand AS icon_url, 'name,icon_url' AS present FROM part""",
    "tags": """
        SELECT DISTINCT p_type AS tag_id, p_type AS name, 'range' AS type,
               NULL::VARCHAR AS icon_url, 'name,type' AS present FROM part""",
    "labels": """
        SELECT DISTINCT 'size-' || p_size AS label_id, 'Size ' || p_size AS name,
               CASE WHEN p_size > 25 THEN 'large' END AS description,
               CASE WHEN p_size > 25 THEN 'name,description' ELSE 'name' END AS present
        FROM part""",
}
for endpoint, sql in REFERENCE_SQL.items():
    register(f"flat_{endpoint}",
             lambda spark, sf, e=endpoint: reference(spark, sf, e), sql)

# --- rebuild, append, refresh and stream ----------------------------------------------

SILVER_RECIPES = f"""
    SELECT {RECIPE_COLUMNS}, NULL::VARCHAR AS description, NULL::VARCHAR AS total_time,
           lo AS first_seen_date, hi AS last_seen_date, 1 AS is_active
    FROM part JOIN recipe_spans ON l_partkey = p_partkey WHERE p_size <> 50
    UNION ALL BY NAME
    SELECT {RECIPE_COLUMNS}, NULL::VARCHAR AS description, NULL::VARCHAR AS total_time,
           lo AS first_seen_date, hi AS last_seen_date, 1 AS is_active
    FROM part JOIN (SELECT l_partkey, min(pull_date) AS lo, max(pull_date) AS hi
                    FROM ({DETAIL_PAGES}) GROUP BY l_partkey) ON l_partkey = p_partkey
    WHERE p_size = 50"""


def rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    house = Warehouse(spark, work_dir(spark, "rebuild"))
    house.rebuild(bronze_pages(spark, sf_dir), ("recipes",))
    return house.table("recipes").drop("_ingestion_ts")


def appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newer pulls first, then the older ones: a backfill must not move dates or values."""
    house = Warehouse(spark, work_dir(spark, "append"))
    everything = bronze_pages(spark, sf_dir)
    for period in (F.col("pull_date") >= "1998-07-01", F.col("pull_date") < "1998-07-01"):
        house.append(everything.filter(period), ("recipes",))
    return house.table("recipes").drop("_ingestion_ts")


def rebuilt_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rebuild all silver tables from all pages and count their rows."""
    house = Warehouse(spark, work_dir(spark, "rebuild"))
    house.rebuild(bronze_pages(spark, sf_dir))
    return per_table({name: house.table(name) for name in SILVER}, SILVER,
                     F.count("*").alias("total"))


register("silver_rebuild", rebuilt, SILVER_RECIPES)
register("silver_append", appended, SILVER_RECIPES)
register(
    "silver_rebuild_counts", rebuilt_counts,
    """SELECT 'menus' AS table_name, count(DISTINCT l_orderkey) AS total FROM lineitem
       UNION ALL SELECT 'recipes', count(DISTINCT l_partkey) FROM lineitem
       UNION ALL SELECT 'menu_recipes', count(DISTINCT (l_orderkey, l_partkey))
                 FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size <> 50
       UNION ALL SELECT 'recipe_ingredients', count(DISTINCT (l_partkey, l_suppkey))
                 FROM lineitem WHERE l_suppkey % 29 <> 0
       UNION ALL SELECT 'recipe_' || k, count(DISTINCT l_partkey) FROM lineitem,
                 (VALUES ('allergens'), ('tags'), ('labels')) v(k) GROUP BY k
       UNION ALL SELECT 'ingredients', count(*) FROM supplier
       UNION ALL SELECT 'allergens', count(DISTINCT p_brand) FROM part
       UNION ALL SELECT 'tags', count(DISTINCT p_type) FROM part
       UNION ALL SELECT 'labels', count(DISTINCT p_size) FROM part""")


@per_session
def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """All silver tables: the middle pulls rebuilt, the newest appended, the oldest streamed."""
    home = work_dir(spark, "warehouse")
    house = Warehouse(spark, f"{home}/silver", deactivate=True)
    pages = bronze_pages(spark, sf_dir).withColumn(
        "ingestion_timestamp", F.col("pull_date").cast("timestamp_ntz"))
    day = F.col("pull_date")
    house.rebuild(pages.filter(day.between("1996-01-01", "1998-06-30")))
    house.append(pages.filter(day > "1998-06-30"))
    pages.filter(day < "1996-01-01").write.partitionBy("pull_date", "endpoint").option(
        "compression", "zstd").parquet(f"{home}/landed")
    incremental.silver_stream(incremental.bronze_stream(spark, f"{home}/landed"), house,
                              f"{home}/checkpoint")
    return house


def seen_between(select: str) -> str:
    """Rows with a pull date as a table that deactivates."""
    return f"""SELECT * EXCLUDE (pull_date), min(pull_date) AS first_seen_date,
                      max(pull_date) AS last_seen_date,
                      (max(pull_date) = max(max(pull_date)) OVER ())::INTEGER AS is_active,
                      max(pull_date)::TIMESTAMP AS _ingestion_ts
               FROM ({select}) GROUP BY ALL"""


LISTED_PARTS = "SELECT l_orderkey, l_partkey, month AS pull_date FROM order_lines"
WAREHOUSE_SQL = {
    "menus": """SELECT l_orderkey::VARCHAR AS id, 'menu/' || l_orderkey AS url,
                       strftime(o_orderdate, '%Y%m') AS year_week, month AS start_date,
                       month AS pull_date
                FROM order_lines JOIN orders ON o_orderkey = l_orderkey""",
    "recipes": f"""SELECT {RECIPE_COLUMNS}, NULL::VARCHAR AS description,
                          NULL::VARCHAR AS total_time, pull_date
                   FROM ({LISTED_PARTS} UNION ALL
                         SELECT 0, l_partkey, pull_date FROM ({DETAIL_PAGES}))
                   JOIN part ON p_partkey = l_partkey
                   WHERE l_orderkey = 0 OR p_size <> 50""",
    "recipe_ingredients": f"""SELECT l_partkey::VARCHAR AS recipe_id,
                                     l_suppkey::VARCHAR AS ingredient_id, pull_date
                              FROM (SELECT l_partkey, l_suppkey, month AS pull_date
                                    FROM order_lines JOIN part ON p_partkey = l_partkey
                                    WHERE p_size <> 50
                                    UNION ALL
                                    SELECT d.l_partkey, l_suppkey, pull_date
                                    FROM ({DETAIL_PAGES}) d JOIN order_lines o
                                    ON o.l_partkey = d.l_partkey AND l_suppkey // 50 = sb)
                              WHERE l_suppkey % 29 <> 0""",
    "menu_recipes": f"""SELECT l_orderkey::VARCHAR AS menu_id, l_partkey::VARCHAR AS recipe_id,
                               pull_date
                        FROM ({LISTED_PARTS}) JOIN part ON p_partkey = l_partkey
                        WHERE p_size <> 50""",
    **{f"recipe_{kind}": f"""SELECT l_partkey::VARCHAR AS recipe_id, {value} AS {kind[:-1]}_id,
                                    pull_date
                             FROM ({DETAIL_PAGES}) JOIN part ON p_partkey = l_partkey"""
       for kind, value in (("allergens", "p_brand"), ("tags", "p_type"),
                           ("labels", "'size-' || p_size"))},
    **{name: f"SELECT * EXCLUDE (present), DATE '1995-01-01' AS pull_date FROM ({sql})"
       for name, sql in REFERENCE_SQL.items()},
}
# Of links listed on several pages of a pull, the other checks hold position, quantity and unit.
for name, sql in WAREHOUSE_SQL.items():
    register(f"warehouse_{name}",
             lambda spark, sf, n=name: warehouse(spark, sf).table(n).drop(
                 "position", "quantity", "unit"),
             seen_between(sql))


def aborted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Menus of an audited warehouse after the newest pull broke off: all earlier pulls, then of
    the newest the first page only."""
    house = Warehouse(spark, work_dir(spark, "aborted"), deactivate=True, audited=True)
    pages = bronze_pages(spark, sf_dir).filter(F.col("endpoint") == "menus")
    newest = pages.agg(F.max("pull_date")).scalar()
    house.rebuild(pages.filter(F.col("pull_date") < newest), ("menus",))
    house.append(pages.filter((F.col("pull_date") == newest) & (F.col("page_number") == 1)),
                 ("menus",))
    return house.table("menus").drop("_ingestion_ts")


ABORTED_PAGES = f"""
    SELECT l_orderkey, pb + 1 AS page, month, o_custkey % 40 + 1 AS last_page
    FROM ({PAGE_ORDERS}) WHERE pb = 0 OR month < (SELECT max(month) FROM order_lines)"""
register(
    "warehouse_aborted_pull", aborted,
    f"""SELECT * FROM (WITH whole AS (
          SELECT month FROM (SELECT *, max(last_page) OVER (PARTITION BY month) AS announced
                             FROM ({ABORTED_PAGES}))
          GROUP BY month, announced
          HAVING count(DISTINCT page) FILTER (page <= announced) = announced)
        SELECT l_orderkey::VARCHAR AS id, 'menu/' || l_orderkey AS url,
               strftime(o_orderdate, '%Y%m') AS year_week, month AS start_date,
               month AS first_seen_date, month AS last_seen_date,
               coalesce(month >= (SELECT max(month) FROM whole), true)::INTEGER AS is_active
        FROM (SELECT DISTINCT l_orderkey, month FROM ({ABORTED_PAGES}))
        JOIN orders ON o_orderkey = l_orderkey)""")


def order_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The explicit range from each order day to the end of its month, in and out as text."""
    day = F.to_date("o_orderdate")
    ranges = read_table(spark, sf_dir, "orders").select(
        day.cast("string").alias("start_text"),
        F.last_day(day).cast("string").alias("end_text")).distinct()
    window = calendar.date_window(F.col("start_text"), F.col("end_text"))
    return ranges.select("start_text", "end_text", window["start"].alias("first_day"),
                         window["end"].alias("last_day"))


register("date_window", order_windows,
         """SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS start_text,
                   strftime(last_day(o_orderdate), '%Y-%m-%d') AS end_text,
                   o_orderdate::DATE AS first_day, last_day(o_orderdate)::DATE AS last_day
            FROM orders""")


def refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish all gold tables and count what readers now see."""
    return quality.gold_row_counts(
        catalogue(spark, sf_dir).refresh_gold(work_dir(spark, "gold")))


register("gold_full_refresh", refreshed, "\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in GOLD))


def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land events as bronze files, stream them in several batches into a state table."""
    home = work_dir(spark, "stream")
    source = f"{home}/bronze"
    landing.append_bronze(StarMenus(spark, sf_dir).api_responses.drop(
        "ingestion_timestamp", "event_id").withColumn(
        "page_number", F.col("page_number").cast("int")), source)
    files = spark.read.parquet(source).select("_metadata.file_path").distinct().count()
    stream = incremental.bronze_stream(spark, source, files_per_batch=files // 3 + 1)
    table = PublishedTable(spark, f"{home}/state")
    incremental.merge_stream(
        stream, lambda batch: merge.fold(batch, ["page_number", "endpoint"], ["payload"],
                                         ["payload"]),
        table, f"{home}/checkpoint")
    state = merge.combine(*table.parts())
    return merge.published(state, state.agg(F.max(merge.LAST)).scalar())


register(
    "stream_silver", streamed,
    """SELECT page_number::INTEGER AS page_number, endpoint,
              arg_max(payload, (pull_date, payload)) AS payload,
              min(pull_date) AS first_seen_date, max(pull_date) AS last_seen_date,
              (max(pull_date) = (SELECT max(ts)::DATE FROM events))::INTEGER AS is_active
       FROM api_responses GROUP BY page_number, endpoint""")
