"""Gold metrics on hand-made weeks, including the documented traps and published figures."""

import random

from pyspark.sql import functions as F

from larder.operators import gold
from tests.helpers import day, table

W1, W2, W3 = "2026-01-24", "2026-02-07", "2026-02-14"


def menus(spark, *rows):
    return spark.createDataFrame([(i, day(d), a) for i, d, a in rows],
                                 "id string, start_date date, is_active int")


def links(spark, *rows):
    return spark.createDataFrame([(m, r, a) for m, r, a in rows],
                                 "menu_id string, recipe_id string, is_active int")


def recipes(spark, *rows):
    return spark.createDataFrame(
        [(i, i.upper(), d, p, day(f), day(l), a) for i, d, p, f, l, a in rows],
        "id string, name string, difficulty double, prep_time string, first_seen_date date, "
        "last_seen_date date, is_active int")


def pairs(spark, left, right, *rows):
    return spark.createDataFrame(list(rows), f"{left} string, {right} string, is_active int")


BOOK = [("a", 1.0, "35 mins", W1, W2, 1), ("b", 2.0, "10", W2, W2, 1),
        ("c", None, None, "2026-03-01", "2026-03-01", 0)]


def test_weekly_metrics_and_compat(spark):
    weeks = menus(spark, ("m1", W1, 1), ("m2", W1, 1), ("m3", W2, 1), ("m4", W3, 1),
                  ("off", "2026-05-02", 0), ("none", None, 1))
    listed = links(spark, ("m1", "a", 1), ("m2", "a", 1), ("m2", "b", 1), ("m3", "a", 1),
                   ("m3", "c", 1), ("m3", "b", 0), ("off", "a", 1))
    book = recipes(spark, *BOOK)
    columns = ("week_start_date", "total_recipes", "unique_recipes", "new_recipes",
               "returning_recipes", "avg_difficulty", "avg_prep_time_minutes")
    assert table(gold.weekly_menu_metrics(weeks, listed, book), *columns) == [
        (W1, 2, 2, 1, 0, 1.33, 26.67), (W2, 2, 2, 0, 1, 1.0, 35.0),
        (W3, 0, 0, 0, 0, None, None)]
    # Rows, not recipes, and 0 for every time that has no space in it.
    assert table(gold.weekly_menu_metrics(weeks, listed, book, compat=True), *columns) == [
        (W1, 2, 2, 2, 0, 1.33, 23.33), (W2, 2, 2, 0, 1, 1.0, 17.5),
        (W3, 0, 0, 0, 0, None, 0.0)]


def test_compat_counts_an_empty_menu_as_a_row_of_no_minutes(spark):
    weeks = menus(spark, ("m1", W1, 1), ("m2", W1, 1))
    result = gold.weekly_menu_metrics(weeks, links(spark, ("m1", "a", 1)),
                                      recipes(spark, *BOOK), compat=True)
    assert table(result, "avg_prep_time_minutes") == [(17.5,)]


def test_survival(spark):
    book = recipes(spark, ("a", 1.0, None, "2026-01-01", "2026-01-15", 1),
                   ("b", 1.0, None, "2026-01-01", "2026-01-07", 0),
                   ("c", 1.0, None, "2026-02-01", "2026-01-01", 1),
                   ("d", 1.0, None, None, None, 1))
    assert table(gold.recipe_survival_metrics(book, "2026-01-20"), "recipe_id",
                 "total_weeks_active", "consecutive_weeks_active", "weeks_since_last_seen",
                 "is_currently_active") == [
        ("a", 3, 3, 0, 1), ("b", 1, 0, 1, 0), ("c", 1, 1, 2, 1), ("d", None, None, None, 1)]


def stability(spark, *weeks):
    """Stability of weeks given as (date, iterable of recipe ids)."""
    rows = [(f"m{n}", d) for n, (d, _) in enumerate(weeks)]
    listed = [(f"m{n}", str(r), 1) for n, (_, items) in enumerate(weeks) for r in items]
    return gold.menu_stability_metrics(
        menus(spark, *((m, d, 1) for m, d in rows)), links(spark, *listed))


RATES = ("overlap_with_prev_week", "new_recipe_rate", "churned_recipe_rate")
MOVES = ("recipes_retained", "recipes_added", "recipes_removed")


def test_published_figures(spark):
    result = stability(spark, ("2026-01-24", range(140)), ("2026-01-31", range(200, 349)),
                       ("2026-02-07", range(400, 548)), ("2026-02-14", range(437, 586)))
    assert table(result, "week_start_date", *RATES, *MOVES) == [
        ("2026-01-24", None, None, None, 0, 140, 0),
        ("2026-01-31", 0.0, 106.43, 100.0, 0, 149, 140),
        ("2026-02-07", 0.0, 99.33, 100.0, 0, 148, 149),
        ("2026-02-14", 75.0, 25.68, 25.0, 111, 38, 37)]
    assert table(stability(spark, (W1, range(149)), (W2, range(42, 200))),
                 "overlap_with_prev_week") == [(71.81,), (None,)]


def test_empty_week_and_previous_listed_week(spark):
    result = stability(spark, (W1, "ab"), (W2, ""), (W3, "a"), ("2026-03-28", "ab"))
    assert table(result, "week_start_date", *RATES, *MOVES) == [
        (W1, None, None, None, 0, 2, 0), (W2, 0.0, 0.0, 100.0, 0, 0, 2),
        (W3, None, None, None, 0, 1, 0), ("2026-03-28", 100.0, 100.0, 0.0, 1, 1, 0)]


def test_stability_against_sets(spark):
    rng = random.Random(5)
    weeks = [(f"2026-0{1 + n // 4}-{1 + 7 * (n % 4):02d}",
              rng.sample(range(30), rng.randint(0, 20))) for n in range(12)]
    found = {r.week_start_date.isoformat(): r for r in stability(spark, *weeks).collect()}
    for (_, before), (week, now) in zip(weeks, weeks[1:]):
        kept = len(set(before) & set(now))
        row = found[week]
        assert (row.recipes_retained, row.recipes_added, row.recipes_removed) == (
            kept, len(now) - kept, len(before) - kept)


def test_trends_ranks_and_changes(spark):
    weeks = menus(spark, ("m1", W1, 1), ("m1b", W1, 1), ("m2", W2, 0))
    listed = links(spark, ("m1", "a", 1), ("m1b", "a", 1), ("m1", "b", 1), ("m2", "a", 1),
                   ("m2", "gone", 1))
    uses = pairs(spark, "recipe_id", "ingredient_id", ("a", "salt", 1), ("b", "salt", 1),
                 ("a", "oil", 1), ("b", "rye", 1), ("b", "off", 1), ("a", "rye", 0),
                 ("gone", "oil", 1))
    items = spark.createDataFrame([("salt", "Salt", 1), ("oil", "Oil", 1), ("rye", "Rye", 1),
                                   ("off", "Off", 0)],
                                  "ingredient_id string, name string, is_active int")
    result = gold.ingredient_trends(items, uses, recipes(spark, *BOOK), listed, weeks)
    rows = table(result, "week_start_date", "ingredient_id", "recipe_count",
                 "week_over_week_change")
    # The inactive menu counts, the unknown recipe and the inactive ingredient do not.
    assert rows == [(W1, "oil", 1, None), (W1, "rye", 1, None), (W1, "salt", 2, None),
                    (W2, "oil", 1, 0), (W2, "salt", 1, -1)]
    ranks = table(result, "week_start_date", "popularity_rank")
    assert ranks == [(W1, 1), (W1, 2), (W1, 3), (W2, 1), (W2, 2)]
    assert table(result.filter("ingredient_id = 'salt'"), "week_start_date",
                 "popularity_rank")[0] == (W1, 1)
    compat = gold.ingredient_trends(items, uses, recipes(spark, *BOOK), listed, weeks, True)
    assert {r[0] for r in table(compat, "week_over_week_change")} == {0}


def test_density(spark):
    weeks = menus(spark, ("m1", W1, 1), ("m2", W1, 1), ("m3", W2, 1), ("off", W3, 0))
    listed = links(spark, ("m1", "a", 1), ("m2", "a", 1), ("m1", "b", 1), ("m1", "unknown", 1),
                   ("m3", "b", 1), ("off", "a", 1))
    carries = pairs(spark, "recipe_id", "allergen_id", ("a", "nuts", 1), ("b", "nuts", 0),
                    ("b", "milk", 1), ("unknown", "milk", 1))
    names = spark.createDataFrame([("nuts", "Nuts", 0), ("milk", "Milk", 1)],
                                  "allergen_id string, name string, is_active int")
    result = gold.allergen_density(weeks, listed, recipes(spark, *BOOK), carries, names)
    assert table(result, "week_start_date", "allergen_name", "recipe_count",
                 "percentage_of_menu") == [
        (W1, "Milk", 1, 33.33), (W1, "Nuts", 1, 33.33), (W2, "Milk", 1, 100.0)]


def test_slope(spark):
    weeks = menus(spark, *((str(n), f"2026-01-{d:02d}", 1) for n, d in enumerate((3, 10, 17))))
    trends = spark.createDataFrame(
        [("x", "X", day("2026-01-03"), 1), ("x", "X", day("2026-01-10"), 3),
         ("x", "X", day("2026-01-17"), 5), ("y", "Y", day("2026-01-17"), 5)],
        "ingredient_id string, ingredient_name string, week_start_date date, recipe_count long")
    assert table(gold.trend_slope(trends, weeks), "ingredient_id", "weeks_present",
                 "trend_slope") == [("x", 3, 2.0), ("y", 1, None)]


def test_number_within_is_row_number(spark):
    """All rows in one group, a third of them tied, still numbered 1..n in order."""
    rows = spark.range(3000).select(
        F.lit("w").alias("g"), F.col("id").cast("string").alias("k"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 100).cast("long").alias("n"))
    from larder.functions.ranking import number_within
    for keys in (rows, rows.withColumn("k", F.col("k").cast("long") - 1500)):
        got = {r.k: r.place for r in number_within(keys, ["g"], "n", "k", "place").collect()}
        order = sorted(keys.collect(), key=lambda r: (-r.n, r.k))
        assert got == {r.k: place for place, r in enumerate(order, 1)}
