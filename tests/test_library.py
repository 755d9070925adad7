"""Library and report queries on a small catalogue with nulls, gaps and empty tables."""

import pytest

from larder.library import insights, lifecycle, quality, questions, relationships, validation
from larder.plans import Catalogue, report
from larder.schemas import BRIDGES, TABLES
from tests.helpers import day, table

AS_OF = day("2026-02-20")


def rows_of(spark, name, *rows):
    """A silver table from dicts; missing columns are null."""
    spec = TABLES[name]
    fields = [*(f"{key} string" for key in spec.keys),
              *(f"{f.name} {f.dataType.simpleString()}" for f in spec.attributes)]
    fields += ["first_seen_date date", "last_seen_date date", "is_active int"]
    names = [field.split()[0] for field in fields]
    seen = {"first_seen_date": day("2026-01-03"), "last_seen_date": day("2026-02-14"),
            "is_active": 1}
    return spark.createDataFrame(
        [tuple({**seen, **row}.get(name) for name in names) for row in rows],
        ", ".join(fields))


@pytest.fixture(scope="module")
def cat(spark):
    silver = {
        "recipes": [
            {"id": "a", "name": "A", "difficulty": 1.0, "prep_time": "35", "cuisine": "Thai"},
            {"id": "b", "name": "B", "difficulty": 3.0, "prep_time": "20 mins"},
            {"id": "c", "name": None, "difficulty": None, "prep_time": None, "cuisine": "Thai"},
            {"id": "d", "name": "D", "difficulty": 5.0, "prep_time": "PT35M", "is_active": 0,
             "last_seen_date": day("2026-02-07")}],
        "ingredients": [{"ingredient_id": i, "name": i.title(), "family": f}
                        for i, f in (("salt", "Spice"), ("rye", "Grain"), ("oil", None))],
        "allergens": [{"allergen_id": "nuts", "name": "Nuts"}],
        "tags": [], "labels": [],
        "menus": [{"id": "m1", "start_date": day("2026-01-24")},
                  {"id": "m2", "start_date": day("2026-02-07")},
                  {"id": "m3", "start_date": day("2026-02-14"), "is_active": 0}],
        "recipe_ingredients": [
            {"recipe_id": "a", "ingredient_id": "salt", "position": 0},
            {"recipe_id": "b", "ingredient_id": "salt", "position": 0},
            {"recipe_id": "a", "ingredient_id": "rye", "position": 1},
            {"recipe_id": "d", "ingredient_id": "rye", "position": 0, "is_active": 0}],
        "recipe_allergens": [{"recipe_id": "a", "allergen_id": "nuts"}],
        "recipe_tags": [], "recipe_labels": [],
        "menu_recipes": [{"menu_id": "m1", "recipe_id": "a"}, {"menu_id": "m1", "recipe_id": "b"},
                         {"menu_id": "m2", "recipe_id": "a"}, {"menu_id": "m3", "recipe_id": "c"}],
    }
    builders = {name: (lambda n=name, r=rows: rows_of(spark, n, *r))
                for name, rows in silver.items()}
    builders["api_responses"] = lambda: spark.createDataFrame(
        [], TABLES["api_responses"].attributes)
    return Catalogue(builders, AS_OF)


def test_counts_and_missing_fields(cat):
    counts = dict(table(quality.table_counts(cat)))
    assert len(counts) == 17 and counts["recipes"] == 4 and counts["tags"] == 0
    assert counts["weekly_menu_metrics"] == 2
    assert table(quality.missing_recipe_fields(cat)) == [(3, 1, 1, 1, 1)]
    assert table(quality.ingredient_quality(cat)) == [(3, 3, 2, 0, 1)]
    assert ("recipes", 3, 1, 4) in table(quality.active_inactive(cat))
    # Sums over an empty table are null, counts are 0.
    assert ("tags", None, None, 0) in table(quality.active_inactive(cat))
    assert dict(table(quality.silver_active_counts(cat)))["tags"] == 0


def test_empty_bronze(cat):
    assert table(quality.ingestion_completeness(cat)) == [(0, 0, 0, 0, None, None)]
    assert quality.ingestion_stats(cat).count() == 0
    assert table(quality.bronze_check(cat)) == [("api_responses", 0, 0, 0)]


def test_relationships(cat):
    assert table(quality.relationship_counts(cat)) == [(3, 1, 0, 0, 4)]
    assert table(quality.recipes_without_links(cat)) == [(1, 2, 3)]
    assert table(relationships.recipe_link_counts(cat), "id", "ingredient_count",
                 "allergen_count", "tag_count", "menu_count") == [
        ("a", 2, 1, 0, 2), ("b", 1, 0, 0, 1), ("c", 0, 0, 0, 1)]
    assert [r[0] for r in relationships.top_ingredients(cat).collect()] == ["salt", "rye", "oil"]
    assert table(relationships.by_family(cat)) == [("Grain", 1, 1), ("Spice", 2, 1)]
    assert table(relationships.top_allergens_pct(cat), "name", "recipe_count",
                 "pct_of_active_recipes") == [("Nuts", 1, 33.33)]
    assert table(relationships.menu_composition(cat), "id", "recipe_count") == [
        ("m1", 2), ("m2", 1)]


def test_difficulty_bands_in_order(cat):
    rows = relationships.difficulty_bands(cat).collect()
    assert [tuple(r) for r in rows] == [("Easy (0-1)", 1, 35.0), ("Hard (2-3)", 1, 20.0)]


def test_lifecycle(cat):
    assert table(lifecycle.recently_deactivated(cat), "id", "total_days",
                 "days_since_deactivation") == [("d", 35, 13)]
    assert {r.id for r in lifecycle.recently_activated(cat).collect()} == {"a", "b", "c"}
    assert lifecycle.recipe_lifecycle(cat).first().status == "Currently Active"
    assert {r[0] for r in table(lifecycle.bridge_lifecycle(cat), "bridge_table")} == set(BRIDGES)


def test_questions(cat):
    assert table(questions.common_recipes(cat), "name", "menu_appearances") == [
        ("A", 2), ("B", 1), (None, 1)]
    assert table(questions.used_ingredients(cat)) == [("Rye", 1, 2), ("Salt", 2, 2)]
    assert table(questions.common_allergens(cat)) == [("Nuts", 1, 25.0)]
    assert table(questions.cuisine_distribution(cat)) == [("Thai", 2, 3), ("Unknown", 1, 1)]
    assert table(questions.complexity_histogram(cat)) == [(0, 1), (1, 1), (2, 1)]
    assert [r[0] for r in questions.quickest_recipes(cat).collect()] == ["B", "A"]
    assert table(questions.lifecycle_summary(cat), "status", "recipe_count",
                 "avg_days_active") == [("Active", 3, 42.0), ("Inactive", 1, 35.0)]
    assert table(questions.recent_churn(cat), "name", "days_since_removal") == [("D", 13)]
    assert questions.recent_churn(cat, days=12).count() == 0
    assert table(questions.ingredient_lifecycle(cat)) == [("Rye", 1, 1, 42), ("Salt", 2, 0, 42)]
    assert table(questions.difficulty_usage(cat)) == [
        (1.0, 1, 35.0, 2), (3.0, 1, 20.0, 1), (None, 1, None, 1)]
    assert table(questions.refresh(cat)) == [("2026-02-14", 6, 2)]
    assert table(questions.silver_counts(cat))[0] == ("allergens", 1, 1)


def test_gold_readers(cat):
    assert table(insights.stability_recent(cat), "week_start_date", "overlap_prev_week") == [
        ("2026-01-24", None), ("2026-02-07", 50.0)]
    assert table(questions.rolling_retention(cat)) == [("2026-02-07", 50.0, 50.0)]
    assert table(validation.gold_scorecard(cat)) == [("✓",) * 6]
    assert table(validation.stability_validation(cat), "total_weeks",
                 "weeks_with_overlap") == [(2, 1)]
    assert table(insights.menu_health(cat)) == [("Menu Health", 3, 2, 3, 2)]
    assert table(questions.gold_counts(cat)) == [(2, 4, 4, 2, 2)]


def test_report_week_is_the_last_listed_one(cat):
    assert table(report.latest_week(cat)) == [("2026-02-07",)]
    # A Monday between two menu starts finds the week before it.
    assert table(report.week_summary(cat, "2026-02-02"), "week_date", "total_recipes") == [
        ("2026-01-24", 2)]
    assert report.week_summary(cat, "2026-01-01").count() == 0
    assert table(report.week_trending(cat, "2026-01-26"), "ingredient_name",
                 "popularity_rank") == [("Rye", 2), ("Salt", 1)]
    assert table(report.trend_chart_series(cat, "2026-01-26")) == [("Rye", 1), ("Salt", 2)]


def test_report_tables(cat):
    assert [r.recipe_id for r in report.top_recipes_by_difficulty(cat).collect()] == [
        "b", "a", "c"]
    assert table(report.report_availability(cat)) == [(2, 4, 2, 2)]
    heat = report.allergen_heatmap(cat, "2026-02-07")
    assert heat.columns == ["allergen_name", "2026-01-24", "2026-02-07"]
    assert table(heat) == [("Nuts", 50.0, 100.0)]
    assert report.allergen_heatmap(cat, "2026-02-07", n_weeks=1).columns == [
        "allergen_name", "2026-02-07"]
    assert table(report.survival_histogram(cat)) == [(0, 6, 1), (1, 7, 3)]
    assert table(report.allergen_heatmap(cat, "2026-02-07", rows=1)) == [("Nuts", 100.0)]
    with pytest.raises(ValueError, match="2026-01-24"):
        report.allergen_heatmap(cat, "2026-02-07", ["2026-02-07"])


def test_empty_week_and_latest_week_without_metrics(spark, cat):
    empty = Catalogue({"weekly_menu_metrics": lambda: cat.weekly_menu_metrics.limit(0)}, AS_OF)
    assert table(report.latest_week(empty)) == [("2026-02-20",)]


def test_unknown_table(cat):
    with pytest.raises(KeyError):
        cat["nothing"]
