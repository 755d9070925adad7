"""Landed pages to silver, gold, library and report, in three weekly loads."""

import json

from larder.library import questions
from larder.operators import bronze
from larder.plans import Catalogue, report
from larder.plans.silver import Warehouse
from larder.schemas import SILVER
from larder.session import work_dir
from larder.sources import landing
from tests.helpers import day, pages, table


def week(pull, start, *recipes):
    """The pages of one pull: a menu of recipes with their ingredients, and details."""
    listed = [{"id": r, "name": r.upper(), "difficulty": n, "prep_time": f"{10 * n} mins",
               "ingredients": [{"id": i} for i in uses]}
              for n, (r, uses) in enumerate(recipes, 1)]
    menu = {"data": [{"id": "m" + start, "start": start, "recipes": listed}]}
    yield pull, "menus", json.dumps(menu)
    for r, _ in recipes:
        yield pull, "recipes", json.dumps({"id": r, "name": r.upper() + "!", "difficulty": 2,
                                           "allergens": [{"id": "nuts"}]})
    yield pull, "ingredients", json.dumps({"data": [{"id": i, "name": i.title()}
                                                    for i in ("rye", "oil")]})
    yield pull, "allergens", '{"data": [{"id": "nuts", "name": "Nuts"}]}'
    yield pull, "menus", "{damaged"


def test_weekly_loads(spark):
    home = work_dir(spark, "weekly")
    house = Warehouse(spark, f"{home}/silver")
    loads = [week("2026-02-03", "2026-02-07", ("a", ["rye"]), ("b", ["rye", "oil"])),
             week("2026-02-10", "2026-02-14", ("b", ["rye", "oil"]), ("c", []))]
    for load in loads:
        landing.append_bronze(pages(spark, *load), f"{home}/bronze")
        stored = landing.read_bronze(spark, f"{home}/bronze")
        house.append(bronze.latest_pull(bronze.well_formed(stored)))

    builders = {name: (lambda n=name: house.table(n)) for name in SILVER}
    builders["api_responses"] = lambda: landing.read_bronze(spark, f"{home}/bronze")
    cat = Catalogue(builders, as_of=day("2026-02-17")).refresh_gold(f"{home}/gold")

    assert table(cat.recipes, "id", "name", "difficulty", "prep_time", "first_seen_date",
                 "last_seen_date") == [
        ("a", "A!", 2.0, None, "2026-02-03", "2026-02-03"),
        ("b", "B!", 2.0, None, "2026-02-03", "2026-02-10"),
        ("c", "C!", 2.0, None, "2026-02-10", "2026-02-10")]
    assert table(cat.menu_stability_metrics, "week_start_date", "overlap_with_prev_week",
                 "recipes_retained", "recipes_added", "recipes_removed") == [
        ("2026-02-07", None, 0, 2, 0), ("2026-02-14", 50.0, 1, 1, 1)]
    assert table(cat.ingredient_trends, "ingredient_name", "week_start_date", "recipe_count",
                 "week_over_week_change", "popularity_rank") == [
        ("Oil", "2026-02-07", 1, None, 2), ("Oil", "2026-02-14", 1, 0, 1),
        ("Rye", "2026-02-07", 2, None, 1), ("Rye", "2026-02-14", 1, -1, 2)]
    assert table(cat.allergen_density, "week_start_date", "percentage_of_menu") == [
        ("2026-02-07", 100.0), ("2026-02-14", 100.0)]
    assert table(questions.used_ingredients(cat)) == [("Oil", 1, 2), ("Rye", 2, 2)]
    assert table(report.week_summary(cat, "2026-02-16"), "week_date", "total_recipes",
                 "new_recipes", "returning_recipes") == [("2026-02-14", 2, 0, 2)]
    assert bronze.malformed(cat.api_responses).count() == 2

