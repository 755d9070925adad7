"""Checks that the gold tables are filled and consistent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.scalars import exact_mean
from larder.library.shared import labelled, one_row, row_count, stack, sum_where
from larder.plans.catalogue import Catalogue

WEEK = "week_start_date"
SURVIVAL_COLUMNS = ("recipe_id", "first_appearance_date", "last_appearance_date")
ORDERED = ("weekly_menu_metrics", "recipe_survival_metrics", "ingredient_trends",
           "allergen_density", "menu_stability_metrics")
WEEKLY = ("weekly_menu_metrics", "menu_stability_metrics", "ingredient_trends",
          "allergen_density")
YES, NO = "✓", "✗"


def filled(column: str) -> Column:
    return F.count(F.col(column))


def gold_population(cat: Catalogue) -> DataFrame:
    """Rows, distinct weeks (recipes for the survival table) and date range per gold table."""

    def measure(name: str) -> DataFrame:
        key, low, high = SURVIVAL_COLUMNS if name == ORDERED[1] else (WEEK,) * 3
        return labelled(name, cat[name].agg(
            F.count("*").alias("row_count"), F.countDistinct(key).alias("unique_weeks"),
            F.min(low).alias("earliest_week"), F.max(high).alias("latest_week")))

    return stack(measure(name) for name in ORDERED)


def weekly_completeness(cat: Catalogue) -> DataFrame:
    """Weeks with each measure filled. Recipe ids live in the survival table only, so that is
    where tracked recipes are counted."""
    tracked = cat.recipe_survival_metrics.agg(F.countDistinct("recipe_id")).scalar()
    return cat.weekly_menu_metrics.agg(
        F.countDistinct(WEEK).alias("weeks_with_data"),
        filled("avg_difficulty").alias("weeks_with_difficulty"),
        filled("avg_prep_time_minutes").alias("weeks_with_prep_time"),
    ).select(F.lit("Expected metrics per week").alias("check_type"), "weeks_with_data",
             tracked.alias("unique_recipes_tracked"), "weeks_with_difficulty",
             "weeks_with_prep_time")


def survival_coverage(cat: Catalogue) -> DataFrame:
    weeks = F.col("total_weeks_active")
    return cat.recipe_survival_metrics.agg(
        F.count("*").alias("total_recipes_in_survival"),
        sum_where(F.col("is_currently_active") == 1).alias("active_recipes"),
        sum_where(F.col("is_currently_active") == 0).alias("inactive_recipes"),
        filled("consecutive_weeks_active").alias("with_consecutive_weeks"),
        F.min(weeks).alias("min_weeks"), F.max(weeks).alias("max_weeks"),
        F.round(F.avg(weeks), 1).alias("avg_weeks"))


def trend_validation(cat: Catalogue) -> DataFrame:
    return cat.ingredient_trends.agg(
        F.countDistinct("ingredient_id").alias("unique_ingredients_tracked"),
        F.countDistinct(WEEK).alias("weeks_tracked"),
        F.count("*").alias("total_trend_rows"), F.min("recipe_count").alias("min_recipes"),
        F.max("recipe_count").alias("max_recipes"),
        filled("week_over_week_change").alias("rows_with_wow_change"))


def density_validation(cat: Catalogue) -> DataFrame:
    share = F.col("percentage_of_menu")
    return cat.allergen_density.agg(
        F.countDistinct("allergen_id").alias("unique_allergens"),
        F.countDistinct(WEEK).alias("weeks_tracked"), F.min(share).alias("min_pct"),
        F.max(share).alias("max_pct"), F.count_if(share > 100).alias("invalid_percentages"))


def stability_validation(cat: Catalogue) -> DataFrame:
    overlap = F.col("overlap_with_prev_week")
    return cat.menu_stability_metrics.agg(
        F.count("*").alias("total_weeks"), F.count(overlap).alias("weeks_with_overlap"),
        exact_mean(overlap, 3).alias("avg_overlap"), F.min(overlap).alias("min_overlap"),
        F.max(overlap).alias("max_overlap"),
        filled("new_recipe_rate").alias("weeks_with_new_rate"))


def _weeks_in(cat: Catalogue, name: str) -> DataFrame:
    return cat[name].agg(F.countDistinct(WEEK).alias("week_count"))


def week_counts(cat: Catalogue) -> DataFrame:
    """Distinct weeks per weekly table, to compare."""
    return stack(labelled(f"Weeks in {name}", _weeks_in(cat, name), "source")
                 for name in WEEKLY)


def gold_scorecard(cat: Catalogue) -> DataFrame:
    counts = one_row(**{name: row_count(cat[name]) for name in ORDERED},
                     composed=_weeks_in(cat, "weekly_menu_metrics"),
                     compared=_weeks_in(cat, "menu_stability_metrics"))
    mark = lambda good, name: F.when(good, YES).otherwise(NO).alias(name)
    columns = dict(zip(ORDERED, ("has_weekly_metrics", "has_recipe_survival",
                                 "has_ingredient_trends", "has_allergen_density",
                                 "has_menu_stability")))
    return counts.select(*(mark(F.col(name) > 0, out) for name, out in columns.items()),
                         mark(F.col("composed") == F.col("compared"), "weeks_aligned"))
