"""First-seen and last-seen tracking of entities and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.calendar import as_date
from larder.library.shared import active, per_table, sum_where, top
from larder.plans.catalogue import Catalogue
from larder.schemas import BRIDGES

SEEN = ("first_seen_date", "last_seen_date")


def days_tracked() -> Column:
    return F.datediff("last_seen_date", "first_seen_date")


def recipe_lifecycle(cat: Catalogue, limit: int | None = 20) -> DataFrame:
    status = F.when(F.col("is_active") == 1, "Currently Active").otherwise("Inactive/Churned")
    return top(cat.recipes, limit, F.desc("last_seen_date"), "id").select(
        "id", "name", *SEEN, days_tracked().alias("days_active"), "is_active",
        status.alias("status"))


def ingredient_lifecycle(cat: Catalogue, limit: int | None = 20) -> DataFrame:
    return top(cat.ingredients, limit, F.desc("last_seen_date"), "ingredient_id").select(
        "ingredient_id", "name", "family", *SEEN, days_tracked().alias("days_active"),
        "is_active")


def recently_deactivated(cat: Catalogue, limit: int | None = 10) -> DataFrame:
    since = F.datediff(as_date(cat.as_of), "last_seen_date")
    return top(cat.recipes.filter("is_active = 0"), limit, F.desc("last_seen_date"),
               "id").select("id", "name", *SEEN, days_tracked().alias("total_days"),
                            since.alias("days_since_deactivation"))


def recently_activated(cat: Catalogue) -> DataFrame:
    """Active recipes that share the newest first-seen date."""
    recipes = active(cat.recipes)
    newest = recipes.agg(F.max("first_seen_date")).scalar()
    since = F.datediff(as_date(cat.as_of), "first_seen_date")
    return recipes.filter(F.col("first_seen_date") == newest).select(
        "id", "name", *SEEN, days_tracked().alias("days_active"),
        since.alias("days_since_activation")).orderBy("id")


def change_status(cat: Catalogue, limit: int | None = 15) -> DataFrame:
    """'Updated' means seen again after the first pull; real changes are
    :func:`larder.operators.history.attribute_changes`."""
    status = F.when(F.col("last_seen_date") > F.col("first_seen_date"),
                    "Updated").otherwise("Static")
    return top(active(cat.recipes), limit, F.desc("last_seen_date"), "id").select(
        "id", "name", "difficulty", "prep_time", "cuisine", *SEEN,
        status.alias("change_status"))


def bridge_lifecycle(cat: Catalogue) -> DataFrame:
    return per_table(
        cat, BRIDGES, F.count("*").alias("total_links"),
        sum_where(F.expr("is_active = 1")).alias("active_links"),
        sum_where(F.expr("is_active = 0")).alias("inactive_links"),
        F.min("first_seen_date").alias("earliest"), F.max("last_seen_date").alias("latest"),
        label="bridge_table")
