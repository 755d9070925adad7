"""Gold metrics."""

from checks.registry import on_silver
from larder.operators import gold

for table in ("weekly_menu_metrics", "recipe_survival_metrics", "ingredient_trends",
              "menu_stability_metrics", "allergen_density"):
    on_silver(table, lambda cat, name=table: cat[name], f"SELECT * FROM {table}")

on_silver("weekly_menu_metrics_compat", lambda cat: cat.weekly_menu_metrics,
             "SELECT * FROM weekly_menu_metrics_compat", compat=True)
on_silver("ingredient_trends_compat", lambda cat: cat.ingredient_trends,
             "SELECT * REPLACE (0::BIGINT AS week_over_week_change) FROM ingredient_trends",
             compat=True)
on_silver(
    "ingredient_wow",
    lambda cat: gold.with_weekly_change(gold.ingredient_week_counts(
        cat.ingredients, cat.recipe_ingredients, cat.recipes, cat.menu_recipes, cat.menus)),
    "SELECT * EXCLUDE (popularity_rank) FROM ingredient_trends")
on_silver(
    "ingredient_trend_slope", lambda cat: gold.trend_slope(cat.ingredient_trends, cat.menus),
    """SELECT ingredient_id, ingredient_name, count(*) AS weeks_present,
              round(regr_slope(recipe_count, k), 6) AS trend_slope
       FROM ingredient_counts
       JOIN (SELECT week_start_date, row_number() OVER (ORDER BY week_start_date) AS k
             FROM (SELECT DISTINCT start_date AS week_start_date FROM menus))
       USING (week_start_date) GROUP BY ALL""")
