"""The query library and the report datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.payload_checks import DAMAGED, damaged
from checks.registry import catalogue, on_catalogue, register
from larder.library import insights, lifecycle, quality, questions, relationships, validation
from larder.plans import Catalogue, report
from larder.schemas import BRIDGES, ENTITIES, GOLD, SILVER, TABLES

REPORT_DAY = "2001-07-20"
HEATMAP_WEEKS = ["2001-04-01", "2001-05-01", "2001-06-01", "2001-07-01"]


def union(tables, select: str) -> str:
    """One SELECT per table; ``{t}`` stands for its name."""
    return "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, {select} FROM {t}" for t in tables)


ON, OFF = "count(*) FILTER (is_active = 1)", "count(*) FILTER (is_active = 0)"
MINUTES = r"try_cast(regexp_extract(prep_time, '^\s*(\d+)', 1) AS INTEGER)"
DAYS = "(last_seen_date - first_seen_date)::INTEGER"


def exact_mean(column: str, digits: int) -> str:
    """Mean of two-decimal values, rounded in decimal arithmetic."""
    return f"""round((sum({column}::DECIMAL(9, 2)) / count({column}))::DECIMAL(18, 8),
                     {digits})::DOUBLE"""


LIVE_RECIPES = "(FROM recipes WHERE is_active = 1)"


def live_links(bridge: str, by: str, partner: str) -> str:
    return f"""(SELECT {by}, count(DISTINCT {partner}) AS n FROM {bridge}
                WHERE is_active = 1 GROUP BY {by})"""


# --- quality --------------------------------------------------------------------------

on_catalogue("table_counts", quality.table_counts, union(TABLES, "count(*) AS row_count"))
on_catalogue("gold_row_counts", quality.gold_row_counts, union(GOLD, "count(*) AS row_count"))
on_catalogue("silver_active_counts", quality.silver_active_counts,
             union(SILVER, f"{ON} AS active_count"))
on_catalogue("active_inactive", quality.active_inactive,
             union(("recipes", "ingredients", "allergens", "tags", "menus"),
                   f"{ON} AS active_count, {OFF} AS inactive_count, count(*) AS total_count"))
on_catalogue("entity_check", quality.entity_check,
             union(ENTITIES, f"count(*) AS total, {ON} AS active, {OFF} AS inactive"))
on_catalogue("bridge_check", quality.bridge_check,
             union(BRIDGES, f"count(*) AS total, {ON} AS active"))
on_catalogue(
    "missing_recipe_fields", quality.missing_recipe_fields,
    f"""SELECT count(*) AS total_recipes, count(*) - count(name) AS missing_name,
               count(*) - count(difficulty) AS missing_difficulty,
               count(*) - count(prep_time) AS missing_prep_time,
               count(*) - count(cuisine) AS missing_cuisine FROM {LIVE_RECIPES}""")
on_catalogue(
    "ingredient_quality", quality.ingredient_quality,
    """SELECT count(*) AS total_ingredients, count(DISTINCT name) AS unique_names,
              count(DISTINCT family) AS unique_families, count(*) - count(name) AS missing_name,
              count(*) - count(family) AS missing_family
       FROM ingredients WHERE is_active = 1""")
on_catalogue(
    "date_coverage", quality.date_coverage,
    union(("recipes", "menus", "ingredients"),
          """min(first_seen_date) AS earliest_date, max(last_seen_date) AS latest_date,
             (max(last_seen_date) - min(first_seen_date))::INTEGER AS days_spanned"""))
on_catalogue(
    "relationship_counts", quality.relationship_counts,
    "SELECT " + ", ".join(f"(SELECT {ON} FROM {t}) AS active_{t}" for t in BRIDGES))
on_catalogue(
    "recipes_without_links", quality.recipes_without_links,
    "SELECT " + ", ".join(
        f"""count(*) FILTER (id NOT IN (SELECT recipe_id FROM recipe_{k} WHERE is_active = 1))
            AS recipes_with_no_{k}""" for k in ("ingredients", "allergens", "tags"))
    + f" FROM {LIVE_RECIPES}")
on_catalogue(
    "ingestion_stats", quality.ingestion_stats,
    """SELECT endpoint, count(*) AS ingestion_count,
              count(DISTINCT pull_date) AS distinct_pull_dates,
              min(ingestion_timestamp) AS first_ingestion,
              max(ingestion_timestamp) AS last_ingestion,
              count(*) - count(payload) AS null_payloads FROM api_responses GROUP BY ALL""")
on_catalogue(
    "ingestion_history", quality.ingestion_history,
    """SELECT endpoint, count(*) AS ingestion_count, min(ingestion_timestamp) AS first_ingest,
              max(ingestion_timestamp) AS last_ingest,
              count(DISTINCT ingestion_timestamp::DATE) AS days_ingested
       FROM api_responses GROUP BY ALL""")
on_catalogue(
    "ingestion_completeness", quality.ingestion_completeness,
    """SELECT count(*) AS total_ingestions, count(DISTINCT pull_date) AS unique_pull_dates,
              count(DISTINCT endpoint) AS endpoints_covered,
              count(DISTINCT locale) AS locales_covered,
              min(ingestion_timestamp) AS first_ingestion,
              max(ingestion_timestamp) AS latest_ingestion FROM api_responses""")
on_catalogue("bronze_check", quality.bronze_check,
             union(["api_responses"], """count(*) AS row_count,
                   count(DISTINCT endpoint) AS endpoints,
                   count(DISTINCT pull_date) AS pull_dates"""))
on_catalogue("pulls_by_date", quality.pulls_by_date,
             "SELECT pull_date, count(*) AS record_count FROM api_responses GROUP BY ALL")
on_catalogue(
    "date_ranges", quality.date_ranges,
    "\nUNION ALL ".join(
        f"""SELECT '{t}' AS source, min({c}) AS earliest_date, max({c}) AS latest_date,
                   count(*) AS total_records FROM {t}"""
        for t, c in (("api_responses", "pull_date"), ("menus", "start_date"),
                     ("weekly_menu_metrics", "week_start_date"))))


def with_bad_payloads(spark, sf_dir: str):
    cat = catalogue(spark, sf_dir)
    rows = damaged(cat.api_responses).withColumn("payload", F.when(
        F.col("event_id") % 83 == 0, "").otherwise(F.col("payload")))
    return quality.bad_payloads(Catalogue({"api_responses": lambda: rows}, cat.as_of))


register(
    "bad_payloads", with_bad_payloads,
    f"""SELECT endpoint, count(*) FILTER (p IS NULL) AS null_payloads,
               count(*) FILTER (p = '') AS empty_payloads,
               count(*) FILTER (coalesce(p, '') = '') AS total_invalid
        FROM (SELECT endpoint, if(event_id % 83 = 0, '', payload) AS p FROM ({DAMAGED}))
        GROUP BY endpoint""")

# --- relationships --------------------------------------------------------------------

on_catalogue(
    "recipe_link_counts", relationships.recipe_link_counts,
    f"""SELECT id, name, difficulty, prep_time, coalesce(i.n, 0) AS ingredient_count,
               coalesce(a.n, 0) AS allergen_count, coalesce(t.n, 0) AS tag_count,
               coalesce(m.n, 0) AS menu_count, is_active, first_seen_date, last_seen_date
        FROM {LIVE_RECIPES} r
        LEFT JOIN {live_links('recipe_ingredients', 'recipe_id', 'ingredient_id')} i
               ON i.recipe_id = id
        LEFT JOIN {live_links('recipe_allergens', 'recipe_id', 'allergen_id')} a
               ON a.recipe_id = id
        LEFT JOIN {live_links('recipe_tags', 'recipe_id', 'tag_id')} t ON t.recipe_id = id
        LEFT JOIN {live_links('menu_recipes', 'recipe_id', 'menu_id')} m ON m.recipe_id = id
        ORDER BY id LIMIT 20""")
on_catalogue(
    "top_ingredients", relationships.top_ingredients,
    f"""SELECT ingredient_id, name, family, coalesce(n, 0) AS recipe_count, is_active
        FROM ingredients
        LEFT JOIN {live_links('recipe_ingredients', 'ingredient_id', 'recipe_id')}
             USING (ingredient_id)
        WHERE is_active = 1 ORDER BY 4 DESC, 1 LIMIT 10""")
on_catalogue(
    "top_allergens_pct", relationships.top_allergens_pct,
    f"""SELECT allergen_id, name, type, coalesce(n, 0) AS recipe_count,
               round(100e0 * coalesce(n, 0) / (SELECT {ON} FROM recipes), 2)
                   AS pct_of_active_recipes
        FROM allergens
        LEFT JOIN {live_links('recipe_allergens', 'allergen_id', 'recipe_id')}
             USING (allergen_id)
        WHERE is_active = 1 ORDER BY 4 DESC, 1 LIMIT 10""")
on_catalogue(
    "by_family", relationships.by_family,
    """SELECT family, count(DISTINCT x.recipe_id) AS recipe_count,
              count(DISTINCT i.ingredient_id) AS unique_ingredients
       FROM ingredients i
       LEFT JOIN recipe_ingredients x ON x.ingredient_id = i.ingredient_id AND x.is_active = 1
       WHERE i.is_active = 1 AND family IS NOT NULL GROUP BY ALL""")
on_catalogue(
    "menu_composition", relationships.menu_composition,
    f"""SELECT id, year_week, start_date, coalesce(n, 0) AS recipe_count, is_active,
               first_seen_date, last_seen_date
        FROM menus LEFT JOIN {live_links('menu_recipes', 'menu_id', 'recipe_id')}
             ON menu_id = id
        WHERE is_active = 1 ORDER BY start_date DESC, id LIMIT 20""")
on_catalogue(
    "difficulty_bands", lambda cat: relationships.difficulty_bands(cat, (10, 20, 30)),
    f"""SELECT CASE (least(ceil(difficulty / 10), 4))::INTEGER WHEN 1 THEN 'Easy (0-10)'
                    WHEN 2 THEN 'Medium (10-20)' WHEN 3 THEN 'Hard (20-30)'
                    ELSE 'Very Hard (30+)' END AS difficulty_level,
               count(*) AS recipe_count, round(avg({MINUTES}), 1) AS avg_prep_time_mins
        FROM {LIVE_RECIPES} GROUP BY ALL""")
on_catalogue(
    "recipe_ingredient_sample", relationships.recipe_ingredient_sample,
    """SELECT r.name AS recipe, i.name AS ingredient, quantity, unit, position
       FROM recipe_ingredients x JOIN recipes r ON r.id = recipe_id
       JOIN ingredients i USING (ingredient_id)
       WHERE x.is_active = 1 ORDER BY recipe_id, ingredient_id LIMIT 15""")
on_catalogue(
    "cuisine_breakdown", relationships.cuisine_breakdown,
    f"""SELECT cuisine, count(*) AS recipe_count, round(avg(difficulty), 2) AS avg_difficulty,
               round(avg({MINUTES}), 1) AS avg_prep_time_mins
        FROM {LIVE_RECIPES} WHERE cuisine IS NOT NULL GROUP BY ALL""")
on_catalogue(
    "ingredients_per_recipe", relationships.ingredients_per_recipe,
    f"""SELECT id, name, coalesce(n, 0) AS ingredient_count FROM {LIVE_RECIPES}
        LEFT JOIN {live_links('recipe_ingredients', 'recipe_id', 'ingredient_id')}
             ON recipe_id = id ORDER BY 3 DESC, 1 LIMIT 15""")

# --- insights -------------------------------------------------------------------------


def newest(columns: str, table: str, n: int) -> str:
    return f"SELECT {columns} FROM {table} ORDER BY week_start_date DESC LIMIT {n}"


on_catalogue("weekly_summary", insights.weekly_summary, newest(
    """* EXCLUDE (avg_prep_time_minutes) REPLACE (round(avg_difficulty, 2) AS avg_difficulty),
       round(avg_prep_time_minutes, 1) AS avg_prep_time_mins""", "weekly_menu_metrics", 10))
on_catalogue("survival_top", insights.survival_top,
             """FROM recipe_survival_metrics
                ORDER BY total_weeks_active DESC, recipe_id LIMIT 15""")
on_catalogue(
    "survival_churned", insights.survival_churned,
    """SELECT * EXCLUDE (first_appearance_date, consecutive_weeks_active, is_currently_active)
       FROM recipe_survival_metrics WHERE is_currently_active = 0
       ORDER BY weeks_since_last_seen DESC, recipe_id LIMIT 10""")
on_catalogue("top_movers", insights.top_movers,
             """SELECT * EXCLUDE (ingredient_id) FROM ingredient_trends
                ORDER BY week_start_date DESC, popularity_rank LIMIT 15""")
on_catalogue(
    "ingredient_history_top5", insights.ingredient_history,
    """SELECT ingredient_name, week_start_date, recipe_count, popularity_rank
       FROM ingredient_trends
       QUALIFY dense_rank() OVER (ORDER BY (SELECT -count(*) FROM ingredient_trends o
            WHERE o.ingredient_name = ingredient_trends.ingredient_name), ingredient_name) <= 5
    """)
on_catalogue(
    "allergen_by_week", insights.allergen_by_week,
    """SELECT week_start_date, allergen_name, recipe_count, percentage_of_menu AS pct_of_menu
       FROM allergen_density ORDER BY 1 DESC, 4 DESC, allergen_id LIMIT 20""")
on_catalogue(
    "allergen_prevalence", insights.allergen_prevalence,
    f"""SELECT allergen_name, count(*) AS weeks_present,
              round(avg(recipe_count), 1) AS avg_recipe_count,
              max(recipe_count) AS max_recipe_count,
              {exact_mean('percentage_of_menu', 2)} AS avg_pct_of_menu
       FROM allergen_density GROUP BY ALL""")
on_catalogue("stability_recent", insights.stability_recent, newest(
    """* RENAME (overlap_with_prev_week AS overlap_prev_week)""",
    "menu_stability_metrics", 10))
on_catalogue("stability_trends", insights.stability_trends, newest(
    """week_start_date, overlap_with_prev_week AS avg_overlap, new_recipe_rate AS avg_new_rate,
       recipes_added AS total_added, recipes_removed AS total_removed""",
    "menu_stability_metrics", 12))
on_catalogue("introductions", insights.introductions,
             """SELECT first_seen_date AS first_appearance_date, count(*) AS recipes_introduced
                FROM recipes GROUP BY ALL""")
on_catalogue(
    "menu_health", insights.menu_health,
    f"""SELECT 'Menu Health' AS metric, count(*) AS active_recipes,
               (SELECT {ON} FROM menus) AS active_menus,
               count(*) AS recipes_in_survival_metrics,
               (SELECT count(DISTINCT start_date) FROM menus WHERE is_active = 1)
                   AS weeks_of_data FROM {LIVE_RECIPES}""")

# --- lifecycle ------------------------------------------------------------------------

on_catalogue(
    "recipe_lifecycle", lifecycle.recipe_lifecycle,
    f"""SELECT id, name, first_seen_date, last_seen_date, {DAYS} AS days_active, is_active,
               if(is_active = 1, 'Currently Active', 'Inactive/Churned') AS status
        FROM recipes ORDER BY last_seen_date DESC NULLS LAST, id LIMIT 20""")
on_catalogue(
    "ingredient_lifecycle", lifecycle.ingredient_lifecycle,
    f"""SELECT ingredient_id, name, family, first_seen_date, last_seen_date,
               {DAYS} AS days_active, is_active
        FROM ingredients ORDER BY last_seen_date DESC NULLS LAST, ingredient_id LIMIT 20""")
on_catalogue(
    "recently_deactivated", lifecycle.recently_deactivated,
    f"""SELECT id, name, first_seen_date, last_seen_date, {DAYS} AS total_days,
               (DATE '2001-09-01' - last_seen_date)::INTEGER AS days_since_deactivation
        FROM recipes WHERE is_active = 0
        ORDER BY last_seen_date DESC NULLS LAST, id LIMIT 10""")
on_catalogue(
    "recently_activated", lifecycle.recently_activated,
    f"""SELECT id, name, first_seen_date, last_seen_date, {DAYS} AS days_active,
               (DATE '2001-09-01' - first_seen_date)::INTEGER AS days_since_activation
        FROM {LIVE_RECIPES} QUALIFY rank() OVER (ORDER BY first_seen_date DESC) = 1""")
on_catalogue(
    "change_status", lifecycle.change_status,
    f"""SELECT id, name, difficulty, prep_time, cuisine, first_seen_date, last_seen_date,
               if({DAYS} > 0, 'Updated', 'Static') AS change_status
        FROM {LIVE_RECIPES} ORDER BY last_seen_date DESC, id LIMIT 15""")
on_catalogue(
    "bridge_lifecycle", lifecycle.bridge_lifecycle,
    union(BRIDGES, f"""count(*) AS total_links, {ON} AS active_links, {OFF} AS inactive_links,
          min(first_seen_date) AS earliest, max(last_seen_date) AS latest"""
          ).replace("AS table_name", "AS bridge_table"))

# --- validation -----------------------------------------------------------------------

on_catalogue(
    "gold_population", validation.gold_population,
    "\nUNION ALL ".join(
        f"""SELECT '{t}' AS table_name, count(*) AS row_count,
                   count(DISTINCT {k}) AS unique_weeks, min({lo}) AS earliest_week,
                   max({hi}) AS latest_week FROM {t}"""
        for t in GOLD for k, lo, hi in
        [("recipe_id", "first_appearance_date", "last_appearance_date")
         if t == "recipe_survival_metrics" else ("week_start_date",) * 3]))
on_catalogue(
    "weekly_completeness", validation.weekly_completeness,
    """SELECT 'Expected metrics per week' AS check_type, count(*) AS weeks_with_data,
              (SELECT count(*) FROM recipes) AS unique_recipes_tracked,
              count(avg_difficulty) AS weeks_with_difficulty,
              count(avg_prep_time_minutes) AS weeks_with_prep_time FROM weekly_menu_metrics""")
on_catalogue(
    "survival_coverage", validation.survival_coverage,
    """SELECT count(*) AS total_recipes_in_survival,
              count(*) FILTER (is_currently_active = 1) AS active_recipes,
              count(*) FILTER (is_currently_active = 0) AS inactive_recipes,
              count(consecutive_weeks_active) AS with_consecutive_weeks,
              min(total_weeks_active) AS min_weeks, max(total_weeks_active) AS max_weeks,
              round(avg(total_weeks_active), 1) AS avg_weeks FROM recipe_survival_metrics""")
on_catalogue(
    "trend_validation", validation.trend_validation,
    """SELECT count(DISTINCT ingredient_id) AS unique_ingredients_tracked,
              count(DISTINCT week_start_date) AS weeks_tracked, count(*) AS total_trend_rows,
              min(recipe_count) AS min_recipes, max(recipe_count) AS max_recipes,
              count(week_over_week_change) AS rows_with_wow_change FROM ingredient_trends""")
on_catalogue(
    "density_validation", validation.density_validation,
    """SELECT count(DISTINCT allergen_id) AS unique_allergens,
              count(DISTINCT week_start_date) AS weeks_tracked,
              min(percentage_of_menu) AS min_pct, max(percentage_of_menu) AS max_pct,
              count(*) FILTER (percentage_of_menu > 100) AS invalid_percentages
       FROM allergen_density""")
on_catalogue(
    "stability_validation", validation.stability_validation,
    f"""SELECT count(*) AS total_weeks, count(overlap_with_prev_week) AS weeks_with_overlap,
              {exact_mean('overlap_with_prev_week', 3)} AS avg_overlap,
              min(overlap_with_prev_week) AS min_overlap,
              max(overlap_with_prev_week) AS max_overlap,
              count(new_recipe_rate) AS weeks_with_new_rate FROM menu_stability_metrics""")
on_catalogue(
    "week_counts", validation.week_counts,
    "\nUNION ALL ".join(
        f"""SELECT 'Weeks in {t}' AS source, count(DISTINCT week_start_date) AS week_count
            FROM {t}""" for t in GOLD if t != "recipe_survival_metrics"))
on_catalogue(
    "gold_scorecard", validation.gold_scorecard,
    "SELECT " + ", ".join(
        f"(SELECT if(count(*) > 0, '✓', '✗') FROM {t}) AS {c}" for t, c in (
            ("weekly_menu_metrics", "has_weekly_metrics"),
            ("recipe_survival_metrics", "has_recipe_survival"),
            ("ingredient_trends", "has_ingredient_trends"),
            ("allergen_density", "has_allergen_density"),
            ("menu_stability_metrics", "has_menu_stability")))
    + """, if((SELECT count(DISTINCT week_start_date) FROM weekly_menu_metrics)
              = (SELECT count(DISTINCT week_start_date) FROM menu_stability_metrics),
              '✓', '✗') AS weeks_aligned""")

# --- numbered questions ---------------------------------------------------------------

on_catalogue(
    "q01_common_recipes", questions.common_recipes,
    f"""SELECT name, n AS menu_appearances, difficulty, prep_time, cuisine
        FROM {LIVE_RECIPES} JOIN {live_links('menu_recipes', 'recipe_id', 'menu_id')}
             ON recipe_id = id ORDER BY n DESC, id LIMIT 5""")

USED = """
    SELECT i.ingredient_id, i.name, count(DISTINCT x.recipe_id) AS recipe_count,
           count(DISTINCT m.menu_id) AS menu_count
    FROM ingredients i
    JOIN recipe_ingredients x ON x.ingredient_id = i.ingredient_id AND x.is_active = 1
    JOIN menu_recipes m ON m.recipe_id = x.recipe_id AND m.is_active = 1
    GROUP BY ALL ORDER BY recipe_count DESC, i.ingredient_id"""

on_catalogue("q02_used_ingredients", questions.used_ingredients,
             f"SELECT * EXCLUDE (ingredient_id) FROM ({USED} LIMIT 10)")
on_catalogue(
    "q03_menu_diversity", questions.menu_diversity,
    """SELECT m.start_date AS week_date, m.year_week,
              count(DISTINCT x.recipe_id) AS unique_recipes,
              count(DISTINCT r.cuisine) AS unique_cuisines,
              round(avg(r.difficulty), 2) AS avg_difficulty
       FROM menu_recipes x JOIN menus m ON m.id = x.menu_id JOIN recipes r ON r.id = x.recipe_id
       WHERE m.is_active = 1 AND x.is_active = 1 GROUP BY m.id, m.start_date, m.year_week""")
on_catalogue(
    "q04_common_allergens", questions.common_allergens,
    f"""SELECT name, n AS recipe_count,
               round(100e0 * n / (SELECT count(*) FROM recipes), 2) AS pct_of_recipes
        FROM allergens JOIN {live_links('recipe_allergens', 'allergen_id', 'recipe_id')}
             USING (allergen_id) ORDER BY n DESC, allergen_id LIMIT 10""")

RECIPES_ON_MENUS = """
    SELECT r.*, x.menu_id FROM recipes r
    LEFT JOIN menu_recipes x ON x.recipe_id = r.id AND x.is_active = 1 WHERE r.is_active = 1"""

on_catalogue(
    "q05_cuisine_distribution", questions.cuisine_distribution,
    f"""SELECT coalesce(cuisine, 'Unknown') AS cuisine, count(DISTINCT id) AS recipe_count,
               count(DISTINCT menu_id) AS menu_appearances
        FROM ({RECIPES_ON_MENUS}) GROUP BY ALL""")
on_catalogue(
    "q06_complexity_histogram", questions.complexity_histogram,
    f"""SELECT coalesce(n, 0) AS ingredient_count, count(*) AS recipe_count
        FROM {LIVE_RECIPES}
        LEFT JOIN {live_links('recipe_ingredients', 'recipe_id', 'ingredient_id')}
             ON recipe_id = id GROUP BY ALL""")
on_catalogue(
    "q07_quickest", questions.quickest_recipes,
    f"""SELECT name, prep_time, total_time, difficulty, coalesce(n, 0) AS ingredient_count
        FROM {LIVE_RECIPES}
        LEFT JOIN {live_links('recipe_ingredients', 'recipe_id', 'ingredient_id')}
             ON recipe_id = id WHERE prep_time IS NOT NULL ORDER BY {MINUTES}, id LIMIT 5""")
on_catalogue(
    "q08_lifecycle_summary", questions.lifecycle_summary,
    f"""SELECT if(is_active = 1, 'Active', 'Inactive') AS status, count(*) AS recipe_count,
               round(avg({DAYS}), 0) AS avg_days_active,
               min(first_seen_date) AS earliest_first_seen,
               max(last_seen_date) AS latest_last_seen FROM recipes GROUP BY is_active""")
on_catalogue(
    "q09_recent_churn", lambda cat: questions.recent_churn(cat, days=150),
    """SELECT name, last_seen_date,
              (DATE '2001-09-01' - last_seen_date)::INTEGER AS days_since_removal, difficulty,
              cuisine
       FROM recipes WHERE is_active = 0 AND last_seen_date >= DATE '2001-09-01' - 150
       ORDER BY last_seen_date DESC, id LIMIT 10""")
on_catalogue(
    "q10_new_this_week", lambda cat: questions.new_recipes(cat, days=2200),
    """SELECT name, r.first_seen_date, difficulty, cuisine,
              count(DISTINCT ingredient_id) AS ingredient_count
       FROM recipes r LEFT JOIN recipe_ingredients ON recipe_id = id
       WHERE r.first_seen_date >= DATE '2001-09-01' - 2200
       GROUP BY id, name, r.first_seen_date, difficulty, cuisine""")
on_catalogue("q11_weekly_metrics", questions.weekly_metrics, newest(
    "* EXCLUDE (locale) REPLACE (round(avg_prep_time_minutes, 0) AS avg_prep_time_minutes)",
    "weekly_menu_metrics", 6))
on_catalogue(
    "q12_survivors", questions.survivors,
    """SELECT * EXCLUDE (recipe_id, consecutive_weeks_active) FROM recipe_survival_metrics
       WHERE is_currently_active = 1 ORDER BY total_weeks_active DESC, recipe_id LIMIT 5""")
on_catalogue(
    "q13_churned", lambda cat: questions.churned(cat, weeks=20),
    """SELECT * EXCLUDE (recipe_id, consecutive_weeks_active, is_currently_active)
       FROM recipe_survival_metrics
       WHERE is_currently_active = 0 AND weeks_since_last_seen <= 20
       ORDER BY last_appearance_date DESC, recipe_id LIMIT 5""")
on_catalogue(
    "q14_weekly_top5", questions.weekly_top,
    """SELECT week_start_date, ingredient_name, recipe_count, popularity_rank
       FROM ingredient_trends WHERE popularity_rank <= 5 ORDER BY 1 DESC, 4 LIMIT 20""")
on_catalogue("q15_stability", questions.stability, newest(
    """* EXCLUDE (locale) RENAME (overlap_with_prev_week AS overlap_pct,
         new_recipe_rate AS new_recipe_rate_pct,
         churned_recipe_rate AS churned_recipe_rate_pct)""", "menu_stability_metrics", 8))

DENSE = """SELECT week_start_date, allergen_name, recipe_count,
                  percentage_of_menu AS pct_of_menu FROM allergen_density"""

on_catalogue("q16_weekly_allergens", questions.weekly_allergens,
             f"{DENSE} ORDER BY 1 DESC, 4 DESC, allergen_id LIMIT 60")
on_catalogue(
    "q16_top_allergens_per_week",
    lambda cat: questions.weekly_allergens(cat, limit=None, per_week=10),
    f"""{DENSE} QUALIFY row_number() OVER (PARTITION BY week_start_date
                ORDER BY percentage_of_menu DESC, allergen_id) <= 10""")


def rounded_retention(cat: Catalogue):
    rows = questions.rolling_retention(cat)
    return rows.withColumn("retention_8wk_avg", F.round("retention_8wk_avg", 6))


on_catalogue(
    "q17_rolling_retention", rounded_retention,
    """SELECT week_start_date, overlap_with_prev_week,
              round((SELECT avg(b.overlap_with_prev_week) FROM menu_stability_metrics b
                     WHERE b.week_start_date <= a.week_start_date
                       AND b.week_start_date > a.week_start_date - INTERVAL 8 MONTH), 6)
                  AS retention_8wk_avg
       FROM menu_stability_metrics a WHERE overlap_with_prev_week IS NOT NULL""")
on_catalogue(
    "q18_ingredient_lifecycle", questions.ingredient_lifecycle,
    """SELECT i.name, count(*) FILTER (r.is_active = 1) AS currently_active,
              count(*) FILTER (r.is_active = 0) AS recently_churned,
              (max(r.last_seen_date) - min(r.first_seen_date))::INTEGER AS total_days_in_use
       FROM recipes r JOIN recipe_ingredients ON recipe_id = r.id
       JOIN ingredients i USING (ingredient_id)
       GROUP BY ingredient_id, i.name ORDER BY count(*) DESC, ingredient_id LIMIT 10""")
on_catalogue(
    "q19_difficulty_usage", questions.difficulty_usage,
    f"""SELECT difficulty, count(DISTINCT id) AS recipe_count,
               round(avg({MINUTES}), 1) AS avg_prep_time,
               count(DISTINCT menu_id) AS total_menu_appearances
        FROM ({RECIPES_ON_MENUS}) GROUP BY ALL""")
on_catalogue(
    "q20_gold_counts", questions.gold_counts,
    "SELECT " + ", ".join(f"(SELECT count(*) FROM {t}) AS {c}_rows" for t, c in (
        ("weekly_menu_metrics", "weekly_metrics"),
        ("recipe_survival_metrics", "recipe_survival"),
        ("ingredient_trends", "ingredient_trends"),
        ("menu_stability_metrics", "menu_stability"),
        ("allergen_density", "allergen_density"))))
on_catalogue("q21_silver_counts", questions.silver_counts,
             union(("recipes", "menus", "ingredients", "allergens"),
                   f"count(*) AS row_count, {ON} AS active_count"))
on_catalogue(
    "q22_refresh", questions.refresh,
    """SELECT max(last_seen_date) AS latest_data_in_system,
              (DATE '2001-09-01' - max(last_seen_date))::INTEGER AS days_since_update,
              count(DISTINCT last_seen_date) AS distinct_days_with_data
       FROM recipes WHERE last_seen_date >= DATE '2001-09-01' - 90""")

# --- report ---------------------------------------------------------------------------

LISTED = f"(SELECT max(start_date) FROM menus WHERE start_date <= DATE '{REPORT_DAY}')"

on_catalogue("latest_week", report.latest_week,
             "SELECT max(start_date) AS week_start_date FROM menus WHERE is_active = 1")
on_catalogue(
    "week_summary", lambda cat: report.week_summary(cat, REPORT_DAY),
    f"""SELECT * EXCLUDE (locale) RENAME (week_start_date AS week_date,
                 avg_prep_time_minutes AS avg_prep_time)
        FROM weekly_menu_metrics WHERE week_start_date = {LISTED}""")
on_catalogue(
    "top_recipes_by_difficulty", report.top_recipes_by_difficulty,
    f"""SELECT id AS recipe_id, name, difficulty, prep_time,
               coalesce(n, 0) AS menu_appearances
        FROM {LIVE_RECIPES} LEFT JOIN {live_links('menu_recipes', 'recipe_id', 'menu_id')}
             ON recipe_id = id ORDER BY difficulty DESC, id LIMIT 5""")
on_catalogue(
    "stability_history", lambda cat: report.stability_history(cat, REPORT_DAY),
    f"""SELECT * EXCLUDE (locale, recipes_retained) FROM menu_stability_metrics
        WHERE week_start_date <= DATE '{REPORT_DAY}' ORDER BY week_start_date DESC LIMIT 5""")
on_catalogue(
    "week_trending", lambda cat: report.week_trending(cat, REPORT_DAY),
    f"""SELECT ingredient_name, recipe_count, popularity_rank FROM ingredient_trends
        WHERE week_start_date = {LISTED} AND popularity_rank <= 5""")
on_catalogue(
    "trend_chart_series", lambda cat: report.trend_chart_series(cat, REPORT_DAY),
    f"""SELECT ingredient_name, recipe_count FROM ingredient_trends
        WHERE week_start_date = {LISTED} ORDER BY popularity_rank LIMIT 5""")
on_catalogue("popular_ingredients", report.popular_ingredients,
             f"""SELECT * EXCLUDE (ingredient_id) RENAME (name AS ingredient_name)
                 FROM ({USED} LIMIT 5)""")
on_catalogue(
    "report_availability", report.report_availability,
    """SELECT (SELECT count(*) FROM menu_stability_metrics) AS stability_weeks,
              (SELECT count(*) FROM ingredient_trends) AS ingredient_trends,
              (SELECT count(*) FROM allergen_density) AS allergen_density,
              (SELECT count(*) FROM weekly_menu_metrics) AS weeks_in_metrics""")
on_catalogue(
    "allergen_heatmap",
    lambda cat: report.allergen_heatmap(cat, REPORT_DAY, HEATMAP_WEEKS, n_weeks=4),
    "SELECT allergen_name, " + ", ".join(
        f"""coalesce(max(percentage_of_menu) FILTER (week_start_date = DATE '{w}'), 0)
            AS "{w}\"""" for w in HEATMAP_WEEKS)
    + f""" FROM allergen_density WHERE week_start_date BETWEEN DATE '{HEATMAP_WEEKS[0]}'
           AND DATE '{REPORT_DAY}' GROUP BY allergen_name""")
on_catalogue(
    "allergen_heatmap_rows",
    lambda cat: report.allergen_heatmap(cat, REPORT_DAY, HEATMAP_WEEKS, rows=20),
    "SELECT allergen_name, " + ", ".join(
        f"""coalesce(max(percentage_of_menu) FILTER (week_start_date = DATE '{w}'), 0)
            AS "{w}\"""" for w in HEATMAP_WEEKS)
    + f""" FROM (FROM allergen_density WHERE week_start_date <= DATE '{REPORT_DAY}'
                 ORDER BY week_start_date DESC, allergen_name LIMIT 20)
           GROUP BY allergen_name""")
on_catalogue("survival_histogram", report.survival_histogram,
             """SELECT is_currently_active, total_weeks_active, count(*) AS recipe_count
                FROM recipe_survival_metrics GROUP BY ALL""")
