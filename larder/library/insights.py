"""Reading the gold tables: trends, survival, stability, density."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.scalars import exact_mean
from larder.library.shared import active, newest_weeks, one_row, row_count, top
from larder.plans.catalogue import Catalogue

WEEK = "week_start_date"
RATES = ("overlap_with_prev_week", "new_recipe_rate", "churned_recipe_rate")
MOVES = ("recipes_retained", "recipes_added", "recipes_removed")
SPAN = ("first_appearance_date", "last_appearance_date")


def weekly_summary(cat: Catalogue, limit: int | None = 10) -> DataFrame:
    return newest_weeks(cat.weekly_menu_metrics, limit).select(
        WEEK, "locale", "total_recipes", "unique_recipes", "new_recipes", "returning_recipes",
        F.round("avg_difficulty", 2).alias("avg_difficulty"),
        F.round("avg_prep_time_minutes", 1).alias("avg_prep_time_mins"))


def survival_top(cat: Catalogue, limit: int | None = 15) -> DataFrame:
    return top(cat.recipe_survival_metrics, limit, F.desc("total_weeks_active"),
               "recipe_id").select(
        "recipe_id", "recipe_name", *SPAN, "total_weeks_active", "consecutive_weeks_active",
        "is_currently_active", "weeks_since_last_seen")


def survival_churned(cat: Catalogue, limit: int | None = 10) -> DataFrame:
    churned = cat.recipe_survival_metrics.filter("is_currently_active = 0")
    return top(churned, limit, F.desc("weeks_since_last_seen"), "recipe_id").select(
        "recipe_id", "recipe_name", "last_appearance_date", "total_weeks_active",
        "weeks_since_last_seen")


def top_movers(cat: Catalogue, limit: int | None = 15) -> DataFrame:
    return top(cat.ingredient_trends, limit, F.desc(WEEK), "popularity_rank").select(
        "ingredient_name", WEEK, "recipe_count", "week_over_week_change", "popularity_rank")


def ingredient_history(cat: Catalogue, names: int = 5) -> DataFrame:
    """Weekly rows of the ingredient names that were tracked longest."""
    longest = top(cat.ingredient_trends.groupBy("ingredient_name").agg(
        F.count("*").alias("n")), names, F.desc("n"), "ingredient_name")
    return (cat.ingredient_trends.join(longest, "ingredient_name", "left_semi")
            .orderBy("ingredient_name", F.desc(WEEK), "ingredient_id")
            .select("ingredient_name", WEEK, "recipe_count", "popularity_rank"))


def allergen_by_week(cat: Catalogue, limit: int | None = 20) -> DataFrame:
    return top(cat.allergen_density, limit, F.desc(WEEK), F.desc("percentage_of_menu"),
               "allergen_id").select(
        WEEK, "allergen_name", "recipe_count",
        F.round("percentage_of_menu", 2).alias("pct_of_menu"))


def allergen_prevalence(cat: Catalogue) -> DataFrame:
    return cat.allergen_density.groupBy("allergen_name").agg(
        F.countDistinct(WEEK).alias("weeks_present"),
        F.round(F.avg("recipe_count"), 1).alias("avg_recipe_count"),
        F.max("recipe_count").alias("max_recipe_count"),
        exact_mean(F.col("percentage_of_menu"), 2).alias("avg_pct_of_menu"),
    ).orderBy(F.desc("avg_pct_of_menu"), "allergen_name")


def stability_recent(cat: Catalogue, limit: int | None = 10) -> DataFrame:
    overlap, added, churned = (F.round(rate, 3) for rate in RATES)
    return newest_weeks(cat.menu_stability_metrics, limit).select(
        WEEK, "locale", overlap.alias("overlap_prev_week"), added.alias(RATES[1]),
        churned.alias(RATES[2]), *MOVES)


def stability_trends(cat: Catalogue, limit: int | None = 12) -> DataFrame:
    return newest_weeks(cat.menu_stability_metrics.groupBy(WEEK).agg(
        exact_mean(F.col("overlap_with_prev_week"), 3).alias("avg_overlap"),
        exact_mean(F.col("new_recipe_rate"), 3).alias("avg_new_rate"),
        F.sum("recipes_added").alias("total_added"),
        F.sum("recipes_removed").alias("total_removed")), limit)


def introductions(cat: Catalogue) -> DataFrame:
    return cat.recipe_survival_metrics.groupBy("first_appearance_date").agg(
        F.count("*").alias("recipes_introduced")).orderBy(F.desc("first_appearance_date"))


def menu_health(cat: Catalogue) -> DataFrame:
    survivors = cat.recipe_survival_metrics.filter("is_currently_active = 1")
    return one_row(
        active_recipes=row_count(active(cat.recipes)),
        active_menus=row_count(active(cat.menus)),
        recipes_in_survival_metrics=row_count(survivors),
        weeks_of_data=cat.weekly_menu_metrics.agg(F.countDistinct(WEEK)),
    ).select(F.lit("Menu Health").alias("metric"), "*")
