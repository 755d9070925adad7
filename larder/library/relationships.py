"""How recipes, ingredients, allergens and menus relate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.scalars import leading_int, percent
from larder.library.shared import active, links_of, links_of_few, row_count, top
from larder.plans.catalogue import Catalogue

BAND_NAMES = ("Easy", "Medium", "Hard", "Very Hard")


def prep_minutes():
    return leading_int(F.col("prep_time")).cast("double")


def recipe_link_counts(cat: Catalogue, limit: int = 20) -> DataFrame:
    """Active recipes with their link counts. The recipes are chosen first, so only the
    links of those shown are counted."""
    chosen = top(active(cat.recipes).select(
        "id", "name", "difficulty", "prep_time", "is_active", "first_seen_date",
        "last_seen_date"), limit, "id")
    shown = chosen
    for out, bridge in (("ingredient_count", "recipe_ingredients"),
                        ("allergen_count", "recipe_allergens"), ("tag_count", "recipe_tags"),
                        ("menu_count", "menu_recipes")):
        shown = links_of_few(active(cat[bridge]).select("recipe_id"), "recipe_id", shown, "id",
                             out, chosen)
    return shown


def top_ingredients(cat: Catalogue, limit: int | None = 10) -> DataFrame:
    counted = links_of(active(cat.recipe_ingredients), "ingredient_id",
                       active(cat.ingredients), "ingredient_id", "recipe_count")
    return top(counted, limit, F.desc("recipe_count"), "ingredient_id").select(
        "ingredient_id", "name", "family", "recipe_count", "is_active")


def top_allergens_pct(cat: Catalogue, limit: int | None = 10) -> DataFrame:
    counted = links_of(active(cat.recipe_allergens), "allergen_id", active(cat.allergens),
                       "allergen_id", "recipe_count")
    total = row_count(active(cat.recipes)).scalar()
    return top(counted, limit, F.desc("recipe_count"), "allergen_id").select(
        "allergen_id", "name", "type", "recipe_count",
        percent(F.col("recipe_count"), total).alias("pct_of_active_recipes"))


def by_family(cat: Catalogue) -> DataFrame:
    """Recipes and ingredients per ingredient family."""
    named = active(cat.ingredients).filter(F.col("family").isNotNull()).select(
        "ingredient_id", "family")
    pairs = active(cat.recipe_ingredients).select("ingredient_id", "recipe_id").join(
        named, "ingredient_id").select("family", "recipe_id").distinct()
    sizes = named.groupBy("family").agg(F.count("*").alias("unique_ingredients"))
    return (links_of(pairs, "family", sizes, "family", "recipe_count")
            .select("family", "recipe_count", "unique_ingredients")
            .orderBy(F.desc("recipe_count"), "family"))


def menu_composition(cat: Catalogue, limit: int | None = 20) -> DataFrame:
    """The latest active menus with their recipe counts."""
    shown = top(active(cat.menus).select("id", "year_week", "start_date", "is_active",
                                         "first_seen_date", "last_seen_date"),
                limit, F.desc("start_date"), "id")
    count = links_of if limit is None else links_of_few
    return count(active(cat.menu_recipes).select("menu_id"), "menu_id", shown, "id",
                 "recipe_count")


def difficulty_bands(cat: Catalogue, limits: tuple[int, int, int] = (1, 2, 3)) -> DataFrame:
    """Active recipes per difficulty band; the limits are inclusive upper bounds."""
    edges = (0, *limits)
    names = [f"{name} ({low}-{high})" for name, low, high in zip(BAND_NAMES, edges, limits)]
    band = F.lit(f"{BAND_NAMES[-1]} ({limits[-1]}+)")
    for name, high in reversed(list(zip(names, limits))):
        band = F.when(F.col("difficulty") <= high, name).otherwise(band)
    return (active(cat.recipes).filter(F.col("difficulty").isNotNull())
            .groupBy(band.alias("difficulty_level")).agg(
                F.count("*").alias("recipe_count"),
                F.round(F.avg(prep_minutes()), 1).alias("avg_prep_time_mins"),
                F.min("difficulty").alias("_easiest"))
            .orderBy("_easiest").drop("_easiest"))


def recipe_ingredient_sample(cat: Catalogue, limit: int | None = 15) -> DataFrame:
    recipes = cat.recipes.select(F.col("id").alias("recipe_id"), F.col("name").alias("recipe"))
    ingredients = cat.ingredients.select("ingredient_id", F.col("name").alias("ingredient"))
    links = active(cat.recipe_ingredients).select(
        "recipe_id", "ingredient_id", "quantity", "unit", "position")
    known = (links.join(recipes.select("recipe_id"), "recipe_id", "left_semi")
             .join(ingredients.select("ingredient_id"), "ingredient_id", "left_semi"))
    # Cut first: names are joined for the listed few only.
    chosen = top(known, limit, "recipe_id", "ingredient_id")
    return (chosen.join(recipes, "recipe_id").join(ingredients, "ingredient_id")
            .orderBy("recipe_id", "ingredient_id")
            .select("recipe", "ingredient", "quantity", "unit", "position"))


def cuisine_breakdown(cat: Catalogue) -> DataFrame:
    return (active(cat.recipes).filter(F.col("cuisine").isNotNull()).groupBy("cuisine").agg(
                F.count("*").alias("recipe_count"),
                F.round(F.avg("difficulty"), 2).alias("avg_difficulty"),
                F.round(F.avg(prep_minutes()), 1).alias("avg_prep_time_mins"))
            .orderBy(F.desc("recipe_count"), "cuisine"))


def ingredients_per_recipe(cat: Catalogue, limit: int | None = 15) -> DataFrame:
    counted = links_of(active(cat.recipe_ingredients), "recipe_id",
                       active(cat.recipes).select("id", "name"), "id", "ingredient_count")
    return top(counted, limit, F.desc("ingredient_count"), "id")
