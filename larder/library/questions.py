"""The 22 numbered questions on silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.calendar import as_date
from larder.functions.scalars import count_where, leading_int, percent
from larder.library.insights import MOVES, RATES, SPAN, WEEK
from larder.library.lifecycle import days_tracked
from larder.library.relationships import prep_minutes
from larder.library.shared import (active, links_of, links_of_few, newest_weeks, one_row,
                                   per_table, row_count, top)
from larder.plans.catalogue import Catalogue
from larder.plans.report import popular_ingredients
from larder.schemas import GOLD


def common_recipes(cat: Catalogue, limit: int | None = 5) -> DataFrame:
    """Q1: active recipes on most menus."""
    menus = active(cat.menu_recipes).groupBy(F.col("recipe_id").alias("id")).agg(
        F.count("*").alias("menu_appearances"))
    return top(active(cat.recipes).join(menus, "id"), limit, F.desc("menu_appearances"),
               "id").select("name", "menu_appearances", "difficulty", "prep_time", "cuisine")


def used_ingredients(cat: Catalogue, limit: int = 10) -> DataFrame:
    """Q2: ingredients in most recipes that are on a menu."""
    return popular_ingredients(cat, limit).withColumnRenamed("ingredient_name", "name")


def menu_diversity(cat: Catalogue) -> DataFrame:
    """Q3: recipes, cuisines and difficulty of each active menu."""
    facts = cat.recipes.select(F.col("id").alias("recipe_id"), "cuisine", "difficulty")
    menus = active(cat.menus).select(F.col("id").alias("menu_id"), "start_date", "year_week")
    links = active(cat.menu_recipes).select("menu_id", "recipe_id")
    per_menu = links.join(facts, "recipe_id").groupBy("menu_id").agg(
        F.count("*").alias("unique_recipes"),
        F.countDistinct("cuisine").alias("unique_cuisines"),
        F.round(F.avg("difficulty"), 2).alias("avg_difficulty"))
    return per_menu.join(menus, "menu_id").orderBy(F.desc("start_date"), "menu_id").select(
        F.col("start_date").alias("week_date"), "year_week", "unique_recipes",
        "unique_cuisines", "avg_difficulty")


def common_allergens(cat: Catalogue, limit: int | None = 10) -> DataFrame:
    """Q4: allergens in most recipes, in percent of all recipes."""
    counts = active(cat.recipe_allergens).groupBy("allergen_id").agg(
        F.count("*").alias("recipe_count"))
    total = row_count(cat.recipes).scalar()
    return top(cat.allergens.join(counts, "allergen_id"), limit, F.desc("recipe_count"),
               "allergen_id").select(
        "name", "recipe_count",
        percent(F.col("recipe_count"), total).alias("pct_of_recipes"))


def _recipes_and_menus(cat: Catalogue, by: str, *measures) -> DataFrame:
    """Active recipes per value of ``by``, and the distinct menus carrying any of them.

    The two counts are taken apart, so recipes are not multiplied by their menus.
    """
    recipes = active(cat.recipes)
    sizes = recipes.groupBy(by).agg(F.count("*").alias("recipe_count"), *measures)
    pairs = active(cat.menu_recipes).select(F.col("recipe_id").alias("id"), "menu_id").join(
        recipes.select("id", by), "id").select(F.col(by).alias("_by"), "menu_id").distinct()
    menus = pairs.groupBy("_by").agg(F.count("*").alias("_menus"))
    return sizes.join(menus, sizes[by].eqNullSafe(menus["_by"]), "left").withColumn(
        "_menus", F.coalesce("_menus", F.lit(0)))


def cuisine_distribution(cat: Catalogue) -> DataFrame:
    """Q5: recipes and menus per cuisine."""
    return _recipes_and_menus(cat, "cuisine").select(
        F.coalesce("cuisine", F.lit("Unknown")).alias("cuisine"), "recipe_count",
        F.col("_menus").alias("menu_appearances"),
    ).orderBy(F.desc("recipe_count"), "cuisine")


def complexity_histogram(cat: Catalogue) -> DataFrame:
    """Q6: recipes per number of ingredients."""
    counted = links_of(active(cat.recipe_ingredients), "recipe_id",
                       active(cat.recipes).select("id"), "id", "ingredient_count")
    return counted.groupBy("ingredient_count").agg(
        F.count("*").alias("recipe_count")).orderBy("ingredient_count")


def quickest_recipes(cat: Catalogue, limit: int = 5) -> DataFrame:
    """Q7: shortest preparation first."""
    timed = active(cat.recipes).filter(F.col("prep_time").isNotNull()).select(
        "id", "name", "prep_time", "total_time", "difficulty")
    minutes = leading_int(F.col("prep_time"))
    quick = top(timed.withColumn("_minutes", minutes), limit, F.asc_nulls_last("_minutes"), "id")
    return links_of_few(active(cat.recipe_ingredients), "recipe_id", quick, "id",
                        "ingredient_count").select(
        "name", "prep_time", "total_time", "difficulty", "ingredient_count")


def lifecycle_summary(cat: Catalogue) -> DataFrame:
    """Q8: active and inactive recipes with their average time on record."""
    status = F.when(F.col("is_active") == 1, "Active").otherwise("Inactive")
    return cat.recipes.groupBy("is_active").agg(
        F.count("*").alias("recipe_count"),
        F.round(F.avg(days_tracked()), 0).alias("avg_days_active"),
        F.min("first_seen_date").alias("earliest_first_seen"),
        F.max("last_seen_date").alias("latest_last_seen"),
    ).select(status.alias("status"), "recipe_count", "avg_days_active", "earliest_first_seen",
             "latest_last_seen")


def recent_churn(cat: Catalogue, days: int = 14, limit: int | None = 10) -> DataFrame:
    """Q9: recipes that became inactive within ``days``."""
    today = as_date(cat.as_of)
    gone = cat.recipes.filter((F.col("is_active") == 0)
                              & (F.col("last_seen_date") >= F.date_sub(today, days)))
    return top(gone, limit, F.desc("last_seen_date"), "id").select(
        "name", "last_seen_date",
        F.datediff(today, "last_seen_date").alias("days_since_removal"), "difficulty",
        "cuisine")


def new_recipes(cat: Catalogue, days: int = 7) -> DataFrame:
    """Q10: recipes first seen within ``days``, with all their ingredient links."""
    fresh = cat.recipes.filter(
        F.col("first_seen_date") >= F.date_sub(as_date(cat.as_of), days))
    counted = links_of(cat.recipe_ingredients, "recipe_id", fresh, "id", "ingredient_count")
    return counted.orderBy(F.desc("first_seen_date"), "id").select(
        "name", "first_seen_date", "difficulty", "cuisine", "ingredient_count")


def weekly_metrics(cat: Catalogue, limit: int | None = 6) -> DataFrame:
    """Q11: composition of the latest weeks."""
    return newest_weeks(cat.weekly_menu_metrics, limit).select(
        WEEK, "total_recipes", "unique_recipes", "new_recipes", "returning_recipes",
        F.round("avg_difficulty", 2).alias("avg_difficulty"),
        F.round("avg_prep_time_minutes", 0).alias("avg_prep_time_minutes"))


def survivors(cat: Catalogue, limit: int | None = 5) -> DataFrame:
    """Q12: active recipes with most weeks."""
    alive = cat.recipe_survival_metrics.filter("is_currently_active = 1")
    return top(alive, limit, F.desc("total_weeks_active"), "recipe_id").select(
        "recipe_name", *SPAN, "total_weeks_active", "weeks_since_last_seen",
        "is_currently_active")


def churned(cat: Catalogue, weeks: int = 4, limit: int | None = 5) -> DataFrame:
    """Q13: inactive recipes seen within ``weeks``."""
    gone = cat.recipe_survival_metrics.filter(
        (F.col("is_currently_active") == 0) & (F.col("weeks_since_last_seen") <= weeks))
    return top(gone, limit, F.desc("last_appearance_date"), "recipe_id").select(
        "recipe_name", *SPAN, "total_weeks_active", "weeks_since_last_seen")


def weekly_top(cat: Catalogue, ranks: int = 5, limit: int | None = 20) -> DataFrame:
    """Q14: the best ranked ingredients of each week, latest weeks first."""
    ranked = cat.ingredient_trends.filter(F.col("popularity_rank") <= ranks)
    return top(ranked, limit, F.desc(WEEK), "popularity_rank").select(
        WEEK, "ingredient_name", "recipe_count", "popularity_rank")


def stability(cat: Catalogue, limit: int | None = 8) -> DataFrame:
    """Q15: overlap of the latest weeks."""
    names = ("overlap_pct", "new_recipe_rate_pct", "churned_recipe_rate_pct")
    return newest_weeks(cat.menu_stability_metrics, limit).select(
        WEEK, *(F.round(rate, 2).alias(name) for rate, name in zip(RATES, names)), *MOVES)


def weekly_allergens(cat: Catalogue, limit: int | None = 60,
                     per_week: int | None = None) -> DataFrame:
    """Q16: densest allergens, latest weeks first: ``limit`` rows overall and, optionally,
    the first ``per_week`` of each week (Spark cuts those before the shuffle)."""
    rows, share = cat.allergen_density, F.desc("percentage_of_menu")
    if per_week is not None:
        place = F.row_number().over(Window.partitionBy(WEEK).orderBy(share, "allergen_id"))
        rows = rows.withColumn("_place", place).filter(F.col("_place") <= per_week)
    return top(rows, limit, F.desc(WEEK), share, "allergen_id").select(
        WEEK, "allergen_name", "recipe_count",
        F.round("percentage_of_menu", 2).alias("pct_of_menu"))


def rolling_retention(cat: Catalogue, weeks: int = 8) -> DataFrame:
    """Q17: running mean of the overlap over ``weeks`` listed weeks (one row per week)."""
    frame = Window.partitionBy("locale").orderBy(WEEK).rowsBetween(1 - weeks, 0)
    overlap = F.col("overlap_with_prev_week")
    return (cat.menu_stability_metrics.filter(overlap.isNotNull())
            .select(WEEK, overlap, F.avg(overlap).over(frame).alias("retention_8wk_avg"))
            .orderBy(F.desc(WEEK)))


def ingredient_lifecycle(cat: Catalogue, limit: int | None = 10) -> DataFrame:
    """Q18: links to active and inactive recipes per ingredient, and days in use."""
    recipes = cat.recipes.select(F.col("id").alias("recipe_id"), "is_active",
                                 "first_seen_date", "last_seen_date")
    links = cat.recipe_ingredients.select("recipe_id", "ingredient_id")
    usage = links.join(recipes, "recipe_id").groupBy("ingredient_id").agg(
        count_where(F.col("is_active") == 1).alias("currently_active"),
        count_where(F.col("is_active") == 0).alias("recently_churned"),
        F.datediff(F.max("last_seen_date"), F.min("first_seen_date"))
        .alias("total_days_in_use"))
    named = cat.ingredients.select("ingredient_id", "name").join(usage, "ingredient_id")
    return top(named, limit, F.desc(F.col("currently_active") + F.col("recently_churned")),
               "ingredient_id").select("name", "currently_active", "recently_churned",
                                       "total_days_in_use")


def difficulty_usage(cat: Catalogue) -> DataFrame:
    """Q19: recipes, menus and preparation time per difficulty.

    The mean time weighs a recipe by the menus carrying it (once if there are none).
    """
    counted = links_of(active(cat.menu_recipes), "recipe_id", active(cat.recipes), "id", "_n")
    weight, minutes = F.greatest("_n", F.lit(1)), prep_minutes()
    times = counted.groupBy(F.col("difficulty").alias("_difficulty")).agg(F.round(
        F.sum(minutes * weight) / F.sum(F.when(minutes.isNotNull(), weight)), 1)
        .alias("avg_prep_time"))
    sizes = _recipes_and_menus(cat, "difficulty")
    return (sizes.join(times, F.col("difficulty").eqNullSafe(F.col("_difficulty")), "left")
            .select("difficulty", "recipe_count", "avg_prep_time",
                    F.col("_menus").alias("total_menu_appearances"))
            .orderBy("difficulty"))


def gold_counts(cat: Catalogue) -> DataFrame:
    """Q20: rows of the gold tables, on one row."""
    short = {"weekly_menu_metrics": "weekly_metrics",
             "recipe_survival_metrics": "recipe_survival",
             "menu_stability_metrics": "menu_stability"}
    return one_row(**{f"{short.get(name, name)}_rows": row_count(cat[name]) for name in GOLD})


def silver_counts(cat: Catalogue) -> DataFrame:
    """Q21: rows and active rows of the main entities."""
    return per_table(cat, ("recipes", "menus", "ingredients", "allergens"),
                     F.count("*").alias("row_count"),
                     count_where(F.col("is_active") == 1).alias("active_count"))


def refresh(cat: Catalogue, days: int = 90) -> DataFrame:
    """Q22: newest data, its age, and days with data within ``days``."""
    today, last = as_date(cat.as_of), F.max("last_seen_date")
    recent = cat.recipes.filter(F.col("last_seen_date") >= F.date_sub(today, days))
    return recent.agg(
        last.alias("latest_data_in_system"), F.datediff(today, last).alias("days_since_update"),
        F.countDistinct("last_seen_date").alias("distinct_days_with_data"))
