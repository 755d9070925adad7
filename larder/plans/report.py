"""Datasets of the weekly report, each as a DataFrame.

A report day is resolved to the latest listed week on or before it, because week keys are
menu start dates and need not be Mondays.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.calendar import as_date
from larder.plans.catalogue import Catalogue

WEEK = "week_start_date"


def _active(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("is_active") == 1)


def latest_week(cat: Catalogue) -> DataFrame:
    """The newest week of the metrics, else the reference date."""
    return cat.weekly_menu_metrics.agg(
        F.coalesce(F.max(WEEK), as_date(cat.as_of)).alias(WEEK))


def listed_week(weekly: DataFrame, day: Column | date | str) -> Column:
    """The last listed week on or before ``day``, as a scalar subquery."""
    return weekly.filter(F.col(WEEK) <= as_date(day)).agg(F.max(WEEK)).scalar()


def week_summary(cat: Catalogue, day: date | str) -> DataFrame:
    weekly = cat.weekly_menu_metrics
    return weekly.filter(F.col(WEEK) == listed_week(weekly, day)).select(
        F.col(WEEK).alias("week_date"), "total_recipes", "unique_recipes", "new_recipes",
        "returning_recipes", "avg_difficulty",
        F.col("avg_prep_time_minutes").alias("avg_prep_time")).limit(1)


def top_recipes_by_difficulty(cat: Catalogue, limit: int = 5) -> DataFrame:
    """Hardest active recipes. They are chosen first; only their links are then counted."""
    hardest = _active(cat.recipes).select(
        F.col("id").alias("recipe_id"), "name", "difficulty", "prep_time",
    ).orderBy(F.desc_nulls_last("difficulty"), "recipe_id").limit(limit)
    menus = (_active(cat.menu_recipes).select("recipe_id", "menu_id")
             .join(hardest.select("recipe_id"), "recipe_id", "left_semi")
             .groupBy("recipe_id").agg(F.count("*").alias("menu_appearances")))
    return (hardest.join(menus, "recipe_id", "left")
            .withColumn("menu_appearances", F.coalesce("menu_appearances", F.lit(0)))
            .orderBy(F.desc_nulls_last("difficulty"), "recipe_id"))


def stability_history(cat: Catalogue, day: date | str, limit: int = 5) -> DataFrame:
    """Stability of the weeks up to a day, newest first: table and chart series."""
    return (cat.menu_stability_metrics.filter(F.col(WEEK) <= as_date(day))
            .orderBy(F.desc(WEEK)).limit(limit)
            .select(WEEK, "overlap_with_prev_week", "new_recipe_rate", "churned_recipe_rate",
                    "recipes_added", "recipes_removed"))


def _trends_of_week(cat: Catalogue, day: date | str) -> DataFrame:
    """Trends of the report week, which all parts look up in the weekly metrics."""
    return cat.ingredient_trends.filter(
        F.col(WEEK) == listed_week(cat.weekly_menu_metrics, day))


def week_trending(cat: Catalogue, day: date | str, limit: int = 5) -> DataFrame:
    return (_trends_of_week(cat, day).filter(F.col("popularity_rank") <= limit)
            .orderBy("popularity_rank").limit(limit)
            .select("ingredient_name", "recipe_count", "popularity_rank"))


def trend_chart_series(cat: Catalogue, day: date | str, limit: int = 5) -> DataFrame:
    """The week's best ranked ingredients; rows without a rank follow by count."""
    return (_trends_of_week(cat, day)
            .orderBy(F.asc_nulls_last("popularity_rank"), F.desc("recipe_count"),
                     "ingredient_id").limit(limit)
            .select("ingredient_name", "recipe_count"))


def popular_ingredients(cat: Catalogue, limit: int = 5) -> DataFrame:
    """Ingredients in most recipes that are on a menu, with the menus they reach.

    A recipe counts if any active menu link has it. Menus are counted for the chosen few only:
    each recipe gets a bit for every chosen ingredient it uses, a menu the bits of its recipes, so
    a recipe on many menus is never multiplied by its ingredients.
    """
    uses = _active(cat.recipe_ingredients).select("ingredient_id", "recipe_id")
    listed = _active(cat.menu_recipes).select("recipe_id", "menu_id")
    # Distinct combines before the shuffle: only the left side of a semi join is split.
    on_menu = listed.select("recipe_id").distinct()
    counts = (uses.join(on_menu, "recipe_id", "left_semi").groupBy("ingredient_id")
              .agg(F.count("*").alias("recipe_count")))
    order = (F.desc("recipe_count"), F.asc("ingredient_id"))
    chosen = (cat.ingredients.select("ingredient_id", F.col("name").alias("ingredient_name"))
              .join(counts, "ingredient_id").orderBy(*order).limit(limit))
    place = F.row_number().over(Window.orderBy(*order)) - 1  # over the chosen few
    numbered = chosen.withColumn("_bit", place)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_bit") % 60).cast("int"))
    masks = (uses.join(numbered.select("ingredient_id", "_bit"), "ingredient_id")
             .select("recipe_id", F.floor(F.col("_bit") / 60).alias("word"),
                     bit.alias("bits"))
             .groupBy("recipe_id", "word").agg(F.bit_or("bits").alias("bits")))
    per_menu = (listed.join(masks, "recipe_id").groupBy("menu_id", "word")
                .agg(F.bit_or("bits").alias("bits")))
    sums = per_menu.groupBy("word", "bits").agg(F.count("*").alias("n"))
    menus = (numbered.join(sums, F.floor(F.col("_bit") / 60) == F.col("word"))
             .filter(F.col("bits").bitwiseAND(bit) != 0)
             .groupBy("ingredient_id").agg(F.sum("n").alias("menu_count")))
    return chosen.join(menus, "ingredient_id").orderBy(*order).select(
        "ingredient_name", "recipe_count", "menu_count")


def report_availability(cat: Catalogue) -> DataFrame:
    """How much there is to chart."""
    rows = F.count("*")
    return cat.menu_stability_metrics.agg(
        F.countDistinct(WEEK).alias("stability_weeks")).select(
        "stability_weeks",
        cat.ingredient_trends.agg(rows).scalar().alias("ingredient_trends"),
        cat.allergen_density.agg(rows).scalar().alias("allergen_density"),
        cat.weekly_menu_metrics.agg(F.countDistinct(WEEK)).scalar()
        .alias("weeks_in_metrics"))


def allergen_heatmap(cat: Catalogue, day: date | str, weeks: list[str] | None = None,
                     n_weeks: int = 4, rows: int | None = None) -> DataFrame:
    """Allergen by week matrix of menu shares, 0 where absent.

    Takes the latest ``n_weeks`` listed weeks, whole, or with ``rows`` the latest so many rows, as
    published. ``weeks`` names the week columns; a selected week that it lacks is an error.
    """
    density = cat.allergen_density.filter(
        F.col("allergen_name").isNotNull() & (F.col(WEEK) <= as_date(day)))
    if rows is None:  # a few weeks, which then stand in the plan as literals
        latest = density.select(WEEK).distinct().orderBy(F.desc(WEEK)).limit(n_weeks).collect()
        recent = density.filter(F.col(WEEK).isin([row[0] for row in latest]))
        found = sorted(row[0].isoformat() for row in latest)
    else:
        recent = density.orderBy(F.desc(WEEK), "allergen_name", "allergen_id").limit(rows)
        found = sorted(row[0].isoformat() for row in recent.select(WEEK).distinct().collect())
    cells = recent.withColumn("_week", F.date_format(WEEK, "yyyy-MM-dd"))
    if weeks is None:
        weeks = found
    elif set(found) - set(weeks):
        raise ValueError(f"weeks not listed: {sorted(set(found) - set(weeks))}")
    return (cells.groupBy("allergen_name").pivot("_week", weeks)
            .agg(F.avg("percentage_of_menu")).na.fill(0.0).orderBy("allergen_name"))


def survival_histogram(cat: Catalogue) -> DataFrame:
    """Recipes per status and weeks on record."""
    return cat.recipe_survival_metrics.groupBy("is_currently_active", "total_weeks_active").agg(
        F.count("*").alias("recipe_count")).orderBy("is_currently_active",
                                                    "total_weeks_active")
