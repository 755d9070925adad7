"""The five recomputed metric tables.

All of them start from :func:`weekly_items`, the distinct (week, recipe) pairs. Reducing to
pairs first means every later count is a plain, map-side combined ``count``: bridge tables
hold one row per key pair, so joining a unique pair to a unique link never double counts.
Dimension names are joined after aggregation, when one row per key and week is left.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.calendar import as_date
from larder.functions.ranking import number_within
from larder.functions.scalars import (at_least, leading_int, minutes_before_space, percent,
                                      whole_weeks)

LOCALE = "en-GB"
WEEK = "week_start_date"
SHARES = 4  # tasks that the links of one ingredient are dealt to


def _active(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("is_active") == 1)


def listed_weeks(menus: DataFrame) -> DataFrame:
    """Distinct start dates of active menus, with or without recipes. Null starts are no week."""
    return (_active(menus).filter(F.col("start_date").isNotNull())
            .select(F.col("start_date").alias(WEEK)).distinct())


def weekly_items(menus: DataFrame, menu_recipes: DataFrame,
                 active_menus_only: bool = True) -> DataFrame:
    """Distinct (week, recipe_id) of active links with ``menu_count``, the number of active
    menus carrying the recipe (0 where only inactive ones do, if those are included).

    An inner join, so that AQE may split whichever side is skewed (the link side of a left
    join cannot be split). Weeks without links are added back from :func:`listed_weeks`.
    """
    weeks = (_active(menus) if active_menus_only else menus).filter(
        F.col("start_date").isNotNull()).select(
        F.col("id").alias("menu_id"), F.col("start_date").alias(WEEK),
        F.when(F.col("is_active") == 1, 1).otherwise(0).alias("_on"))
    links = _active(menu_recipes).select("menu_id", "recipe_id")
    return links.join(weeks, "menu_id").groupBy(WEEK, "recipe_id").agg(
        F.sum("_on").alias("menu_count"))


def _listed_items(menus: DataFrame, menu_recipes: DataFrame,
                  items: DataFrame | None) -> DataFrame:
    """Items on active menus, from the stored items of all menus if there are any."""
    return (weekly_items(menus, menu_recipes) if items is None
            else items.filter(F.col("menu_count") > 0))


def weekly_menu_metrics(menus: DataFrame, menu_recipes: DataFrame, recipes: DataFrame,
                        locale: str = LOCALE, compat: bool = False,
                        items: DataFrame | None = None) -> DataFrame:
    """Composition of each listed week.

    New and returning count distinct recipes, and preparation time averages the minutes that
    can be read. ``compat=True`` counts a recipe once per menu carrying it and takes an
    unreadable or bare-number time as 0, as the published tables do. Difficulty is averaged
    over menu rows in both.
    """
    facts = recipes.select(
        F.col("id").alias("recipe_id"), F.col("first_seen_date").alias("_first"),
        F.col("difficulty").cast("double").alias("_difficulty"),
        (minutes_before_space if compat else leading_int)(F.col("prep_time")).alias("_prep"))
    joined = _listed_items(menus, menu_recipes, items).join(facts, "recipe_id", "left")
    rows = F.col("menu_count")
    weight = rows if compat else F.lit(1)

    def row_mean(value: Column) -> Column:
        return F.round(F.sum(value * rows) / F.sum(F.when(value.isNotNull(), rows)), 2)

    per_week = joined.groupBy(WEEK).agg(
        F.count("*").alias("total_recipes"),
        F.sum(F.when(F.col("_first") == F.col(WEEK), weight)).alias("new_recipes"),
        F.sum(F.when(F.col("_first") < F.col(WEEK), weight)).alias("returning_recipes"),
        row_mean(F.col("_difficulty")).alias("avg_difficulty"),
        row_mean(F.col("_prep").cast("double")).alias("avg_prep_time_minutes"),
        F.sum(F.col("_prep") * rows).alias("_minutes"), F.sum(rows).alias("_rows"))
    weeks = listed_weeks(menus).join(per_week, WEEK, "left")
    if compat:
        # Every row without a readable time weighs in with 0, also a menu without links.
        linked = _active(menu_recipes).select(F.col("menu_id").alias("id")).distinct()
        empty = (_active(menus).join(linked, "id", "left_anti")
                 .groupBy(F.col("start_date").alias(WEEK)).agg(F.count("*").alias("_empty")))
        number = lambda name: F.coalesce(F.col(name), F.lit(0))
        weeks = weeks.join(empty, WEEK, "left").withColumn(
            "avg_prep_time_minutes",
            F.round(number("_minutes") / (number("_rows") + number("_empty")), 2))
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("long")
    return weeks.select(
        WEEK, F.lit(locale).alias("locale"), zero("total_recipes").alias("total_recipes"),
        zero("total_recipes").alias("unique_recipes"),
        zero("new_recipes").alias("new_recipes"),
        zero("returning_recipes").alias("returning_recipes"), "avg_difficulty",
        "avg_prep_time_minutes")


def recipe_survival_metrics(recipes: DataFrame, as_of: Column | date | str) -> DataFrame:
    """Lifespan of every recipe in whole weeks, relative to ``as_of``."""
    first, last = F.col("first_seen_date"), F.col("last_seen_date")
    span = at_least(whole_weeks(F.datediff(last, first) + F.lit(7)), 1)
    return recipes.select(
        F.col("id").alias("recipe_id"), F.col("name").alias("recipe_name"),
        first.alias("first_appearance_date"), last.alias("last_appearance_date"),
        span.alias("total_weeks_active"),
        F.when(F.col("is_active") == 1, span).otherwise(0).alias("consecutive_weeks_active"),
        at_least(whole_weeks(F.datediff(as_date(as_of), last)), 0)
        .alias("weeks_since_last_seen"),
        F.col("is_active").alias("is_currently_active"))


def ingredient_week_counts(ingredients: DataFrame, recipe_ingredients: DataFrame,
                           recipes: DataFrame, menu_recipes: DataFrame, menus: DataFrame,
                           items: DataFrame | None = None) -> DataFrame:
    """Distinct recipes per active ingredient and week. Inactive menus count here.

    A recipe's weeks travel as one list beside its links, so what is joined and shuffled is one row
    for each link, however many weeks it is listed in. The lists are dealt by ingredient (a hot one
    over ``SHARES`` tasks) and unpacked where a task's counts are those of its own ingredients.
    """
    if items is None:
        items = weekly_items(menus, menu_recipes, active_menus_only=False)
    items = items.select(WEEK, "recipe_id")
    known = recipes.select(F.col("id").alias("recipe_id"))
    links = _active(recipe_ingredients).select("recipe_id", "ingredient_id")
    weeks = items.join(known, "recipe_id", "left_semi").groupBy("recipe_id").agg(
        F.collect_list(WEEK).alias("_weeks"))
    counts = (links.join(weeks, "recipe_id")
              .select("ingredient_id", "_weeks",
                      F.pmod(F.xxhash64("recipe_id"), F.lit(SHARES)).alias("_share"))
              .repartition("ingredient_id", "_share")
              .select("ingredient_id", F.explode("_weeks").alias(WEEK))
              .groupBy("ingredient_id", WEEK).agg(F.count("*").alias("recipe_count")))
    names = _active(ingredients).select("ingredient_id",
                                        F.col("name").alias("ingredient_name"))
    return counts.join(names, "ingredient_id")


def with_weekly_change(trends: DataFrame) -> DataFrame:
    """Change of ``recipe_count`` against the ingredient's previous listed week."""
    earlier = Window.partitionBy("ingredient_id").orderBy(WEEK)
    return trends.withColumn(
        "week_over_week_change", F.col("recipe_count") - F.lag("recipe_count").over(earlier))


def ingredient_trends(ingredients: DataFrame, recipe_ingredients: DataFrame,
                      recipes: DataFrame, menu_recipes: DataFrame, menus: DataFrame,
                      compat: bool = False, items: DataFrame | None = None) -> DataFrame:
    """Weekly ingredient popularity with rank (ties by id).

    ``compat=True`` leaves the change at the constant 0 of the published tables.
    """
    counts = ingredient_week_counts(ingredients, recipe_ingredients, recipes, menu_recipes,
                                    menus, items)
    changed = (counts.withColumn("week_over_week_change", F.lit(0).cast("long")) if compat
               else with_weekly_change(counts))
    ranked = number_within(changed, [WEEK], "recipe_count", "ingredient_id",
                           "popularity_rank")
    return ranked.select("ingredient_id", "ingredient_name", WEEK, "recipe_count",
                         "week_over_week_change", "popularity_rank")


def menu_stability_metrics(menus: DataFrame, menu_recipes: DataFrame,
                           locale: str = LOCALE,
                           items: DataFrame | None = None) -> DataFrame:
    """Overlap of each listed week with the listed week before it, in percent of that week.

    A recipe is retained when its own previous week is the listed previous week, so one
    window per recipe (at most one row per week) replaces set comparison; what is left to
    compare is one row per pair of weeks.
    """
    own_weeks = Window.partitionBy("recipe_id").orderBy(WEEK)
    pairs = (_listed_items(menus, menu_recipes, items)
             .select(WEEK, F.lag(WEEK).over(own_weeks).alias("_seen_before"))
             .groupBy(WEEK, "_seen_before").agg(F.count("*").alias("_n")))
    by_week = Window.partitionBy("locale").orderBy(WEEK)
    weeks = listed_weeks(menus).select(
        WEEK, F.lit(locale).alias("locale")).withColumn("_prev", F.lag(WEEK).over(by_week))
    kept = F.when(F.col("_seen_before") == F.col("_prev"), F.col("_n"))
    sizes = weeks.join(pairs, WEEK, "left").groupBy("locale", WEEK).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_size"),
        F.coalesce(F.sum(kept), F.lit(0)).alias("recipes_retained"))
    size, before = F.col("_size"), F.col("_size_before")
    retained = F.col("recipes_retained")
    return (sizes.withColumn("_size_before", F.lag("_size").over(by_week))
            .withColumn("recipes_added", size - retained)
            .withColumn("recipes_removed", F.coalesce(before - retained, F.lit(0)))
            .select(WEEK, "locale",
                    percent(retained, before).alias("overlap_with_prev_week"),
                    percent(F.col("recipes_added"), before).alias("new_recipe_rate"),
                    percent(F.col("recipes_removed"), before).alias("churned_recipe_rate"),
                    "recipes_retained", "recipes_added", "recipes_removed"))


def allergen_density(menus: DataFrame, menu_recipes: DataFrame, recipes: DataFrame,
                     recipe_allergens: DataFrame, allergens: DataFrame,
                     items: DataFrame | None = None) -> DataFrame:
    """Share of each week's recipes that carry an allergen."""
    items = _listed_items(menus, menu_recipes, items).select(WEEK, "recipe_id")
    totals = items.groupBy(WEEK).agg(F.count("*").alias("_total"))
    known = recipes.select(F.col("id").alias("recipe_id"))
    links = _active(recipe_allergens).select("recipe_id", "allergen_id")
    counts = (items.join(known, "recipe_id", "left_semi").join(links, "recipe_id")
              .groupBy("allergen_id", WEEK).agg(F.count("*").alias("recipe_count")))
    names = allergens.select("allergen_id", F.col("name").alias("allergen_name"))
    return counts.join(names, "allergen_id").join(totals, WEEK).select(
        "allergen_id", WEEK, "allergen_name", "recipe_count",
        percent(F.col("recipe_count"), F.col("_total")).alias("percentage_of_menu"))


def trend_slope(trends: DataFrame, menus: DataFrame) -> DataFrame:
    """Least-squares slope of weekly counts per ingredient over the number of the week, which
    is its place among all listed weeks (one row per week, so one small window)."""
    weeks = menus.filter(F.col("start_date").isNotNull()).select(
        F.col("start_date").alias(WEEK)).distinct().withColumn(
        "week_index", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(WEEK)))
    return trends.join(weeks, WEEK).groupBy("ingredient_id", "ingredient_name").agg(
        F.count("*").alias("weeks_present"),
        F.round(F.regr_slope(F.col("recipe_count").cast("double"),
                             F.col("week_index").cast("double")), 6).alias("trend_slope"))
