"""Row counts, completeness and date coverage of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.library.shared import (active, labelled, one_row, per_table, row_count, stack,
                                   sum_where)
from larder.plans.catalogue import Catalogue
from larder.schemas import BRIDGES, ENTITIES, GOLD, SILVER, TABLES

IS_ACTIVE, IS_INACTIVE = "is_active = 1", "is_active = 0"


def table_counts(cat: Catalogue) -> DataFrame:
    return per_table(cat, TABLES, F.count("*").alias("row_count"))


def gold_row_counts(cat: Catalogue) -> DataFrame:
    return per_table(cat, GOLD, F.count("*").alias("row_count"))


def silver_active_counts(cat: Catalogue) -> DataFrame:
    return per_table(cat, SILVER, F.count_if(F.expr(IS_ACTIVE)).alias("active_count"))


def active_inactive(cat: Catalogue) -> DataFrame:
    tables = ("recipes", "ingredients", "allergens", "tags", "menus")
    return per_table(cat, tables, sum_where(F.expr(IS_ACTIVE)).alias("active_count"),
                     sum_where(F.expr(IS_INACTIVE)).alias("inactive_count"),
                     F.count("*").alias("total_count"))


def entity_check(cat: Catalogue) -> DataFrame:
    return per_table(cat, ENTITIES, F.count("*").alias("total"),
                     sum_where(F.expr(IS_ACTIVE)).alias("active"),
                     sum_where(F.expr(IS_INACTIVE)).alias("inactive"))


def bridge_check(cat: Catalogue) -> DataFrame:
    return per_table(cat, BRIDGES, F.count("*").alias("total"),
                     sum_where(F.expr(IS_ACTIVE)).alias("active"))


def missing_recipe_fields(cat: Catalogue) -> DataFrame:
    fields = ("name", "difficulty", "prep_time", "cuisine")
    return active(cat.recipes).agg(
        F.count("*").alias("total_recipes"),
        *(sum_where(F.col(field).isNull()).alias(f"missing_{field}") for field in fields))


def ingredient_quality(cat: Catalogue) -> DataFrame:
    return active(cat.ingredients).agg(
        F.count("*").alias("total_ingredients"),
        F.countDistinct("name").alias("unique_names"),
        F.countDistinct("family").alias("unique_families"),
        *(sum_where(F.col(field).isNull()).alias(f"missing_{field}")
          for field in ("name", "family")))


def date_coverage(cat: Catalogue) -> DataFrame:
    first, last = F.min("first_seen_date"), F.max("last_seen_date")
    return per_table(cat, ("recipes", "menus", "ingredients"), first.alias("earliest_date"),
                     last.alias("latest_date"), F.datediff(last, first).alias("days_spanned"))


def relationship_counts(cat: Catalogue) -> DataFrame:
    return one_row(**{f"active_{name}": row_count(active(cat[name])) for name in BRIDGES})


def recipes_without_links(cat: Catalogue) -> DataFrame:
    """Active recipes lacking any active ingredient, allergen or tag link."""
    recipes = active(cat.recipes).select(F.col("id").alias("recipe_id"))

    def lacking(bridge: str) -> DataFrame:
        # Distinct combines before the shuffle: only the left side of an anti join is split.
        linked = active(cat[bridge]).select("recipe_id").distinct()
        return row_count(recipes.join(linked, "recipe_id", "left_anti"))

    return one_row(**{f"recipes_with_no_{kind}": lacking(f"recipe_{kind}")
                      for kind in ("ingredients", "allergens", "tags")})


# --- bronze ---------------------------------------------------------------------------
# Responses are first reduced to one row per (endpoint, day, …): that combines in the map
# tasks, so the distinct counts run over a few rows instead of expanding every response.


def ingestion_stats(cat: Catalogue) -> DataFrame:
    daily = cat.api_responses.groupBy("endpoint", "pull_date").agg(
        F.count("*").alias("n"), F.min("ingestion_timestamp").alias("lo"),
        F.max("ingestion_timestamp").alias("hi"),
        F.count_if(F.col("payload").isNull()).alias("nulls"))
    return daily.groupBy("endpoint").agg(
        F.sum("n").alias("ingestion_count"),
        F.count("pull_date").alias("distinct_pull_dates"), F.min("lo").alias("first_ingestion"),
        F.max("hi").alias("last_ingestion"), F.sum("nulls").alias("null_payloads"),
    ).orderBy(F.desc("ingestion_count"), "endpoint")


def ingestion_history(cat: Catalogue) -> DataFrame:
    daily = cat.api_responses.groupBy("endpoint", F.to_date("ingestion_timestamp").alias("day"))
    return daily.agg(
        F.count("*").alias("n"), F.min("ingestion_timestamp").alias("lo"),
        F.max("ingestion_timestamp").alias("hi"),
    ).groupBy("endpoint").agg(
        F.sum("n").alias("ingestion_count"), F.min("lo").alias("first_ingest"),
        F.max("hi").alias("last_ingest"), F.count("day").alias("days_ingested"),
    ).orderBy(F.desc("last_ingest"), "endpoint")


def ingestion_completeness(cat: Catalogue) -> DataFrame:
    groups = cat.api_responses.groupBy("pull_date", "endpoint", "locale").agg(
        F.count("*").alias("n"), F.min("ingestion_timestamp").alias("lo"),
        F.max("ingestion_timestamp").alias("hi"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_ingestions"),
        F.countDistinct("pull_date").alias("unique_pull_dates"),
        F.countDistinct("endpoint").alias("endpoints_covered"),
        F.countDistinct("locale").alias("locales_covered"),
        F.min("lo").alias("first_ingestion"), F.max("hi").alias("latest_ingestion"))


def bronze_check(cat: Catalogue) -> DataFrame:
    groups = cat.api_responses.groupBy("endpoint", "pull_date").agg(F.count("*").alias("n"))
    return labelled("api_responses", groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.countDistinct("endpoint").alias("endpoints"),
        F.countDistinct("pull_date").alias("pull_dates")))


def bad_payloads(cat: Catalogue) -> DataFrame:
    """Endpoints with null or empty payloads."""
    missing, empty = F.col("payload").isNull(), F.col("payload") == ""
    return cat.api_responses.groupBy("endpoint").agg(
        F.count_if(missing).alias("null_payloads"), F.count_if(empty).alias("empty_payloads"),
        F.count_if(missing | empty).alias("total_invalid"),
    ).filter("total_invalid > 0")


def pulls_by_date(cat: Catalogue) -> DataFrame:
    return cat.api_responses.groupBy("pull_date").agg(
        F.count("*").alias("record_count")).orderBy(F.desc("pull_date"))


def date_ranges(cat: Catalogue) -> DataFrame:
    """First and last date of each layer."""
    dated = {"api_responses": "pull_date", "menus": "start_date",
             "weekly_menu_metrics": "week_start_date"}
    return stack(labelled(name, cat[name].agg(
        F.min(column).alias("earliest_date"), F.max(column).alias("latest_date"),
        F.count("*").alias("total_records")), "source") for name, column in dated.items())
