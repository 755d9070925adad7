import random

import pytest

from larder.operators import history
from tests.helpers import day, table

KEYS, ATTRS = ["id"], ["difficulty"]


def daily(spark, *rows):
    return spark.createDataFrame([(i, d, day(p)) for i, d, p in rows],
                                 "id string, difficulty int, pull_date date")


def documented(spark):
    """A recipe unchanged, changed, then gone; another one new in the last pull."""
    return daily(spark, ("R123", 2, "2026-01-15"), ("R123", 2, "2026-01-22"),
                 ("R123", 3, "2026-01-29"), ("R456", 1, "2026-02-05"))


def test_documented_example(spark):
    versions = history.version_history(documented(spark), KEYS, ATTRS)
    assert table(versions) == [
        ("R123", 1, 2, "2026-01-15", "2026-01-29", "2026-01-22", 0),
        ("R123", 2, 3, "2026-01-29", "2026-02-05", "2026-01-29", 0),
        ("R456", 1, 1, "2026-02-05", None, "2026-02-05", 1)]
    assert table(history.current_versions(versions), "id") == [("R456",)]
    assert table(history.attribute_changes(versions, KEYS, "difficulty")) == [
        ("R123", 2, 3, "2026-01-29")]
    assert table(history.closed_lifetimes(versions, KEYS), "id", "version", "days_active") == [
        ("R123", 1, 14), ("R123", 2, 7)]


def test_point_in_time_half_open_and_inclusive(spark):
    versions = history.version_history(documented(spark), KEYS, ATTRS)
    assert table(history.versions_as_of(versions, "2026-01-20"), "version") == [(1,)]
    assert table(history.versions_as_of(versions, "2026-01-29"), "version") == [(2,)]
    assert table(history.versions_as_of(versions, "2026-01-29", inclusive=True),
                 "version") == [(1,), (2,)]


def test_only_changes_close_when_absence_is_ignored(spark):
    rows = daily(spark, ("a", 1, "2026-01-01"), ("b", 1, "2026-01-08"),
                 ("a", 1, "2026-01-15"), ("a", 2, "2026-01-22"))
    merged = history.version_history(rows, KEYS, ATTRS, close_missing=False)
    assert table(merged.filter("id = 'a'"), "version", "valid_from", "valid_to") == [
        (1, "2026-01-01", "2026-01-22"), (2, "2026-01-22", None)]
    split = history.version_history(rows, KEYS, ATTRS)
    assert table(split.filter("id = 'a'"), "version", "valid_from", "valid_to") == [
        (1, "2026-01-01", "2026-01-08"), (2, "2026-01-15", "2026-01-22"),
        (3, "2026-01-22", None)]


def test_return_with_the_same_value_is_not_a_change(spark):
    rows = daily(spark, ("a", 1, "2026-01-01"), ("b", 1, "2026-01-08"), ("a", 2, "2026-01-15"))
    versions = history.version_history(rows, KEYS, ATTRS)
    assert history.attribute_changes(versions, KEYS, "difficulty").count() == 0


def test_null_attributes_compare_equal(spark):
    rows = daily(spark, ("a", None, "2026-01-01"), ("a", None, "2026-01-08"),
                 ("a", 1, "2026-01-15"))
    versions = history.version_history(rows, KEYS, ATTRS)
    assert table(versions, "version", "difficulty") == [(1, None), (2, 1)]


@pytest.mark.parametrize("seed", range(6))
def test_pulls_in_any_order_give_the_history_of_all(spark, seed):
    """Late pulls split, shorten and join versions; keys vanish, return and change."""
    dice = random.Random(seed)
    days = [f"2026-01-{n:02d}" for n in range(1, 13)]
    rows = [(f"k{k}", dice.choice([1, 1, 2, None]), d) for k in range(8) for d in days
            if dice.random() < 0.75]
    order = dice.sample(days, len(days))
    cut = sorted(dice.sample(range(1, len(days)), 2))
    loads = [order[:cut[0]], order[cut[0]:cut[1]], order[cut[1]:]]
    of = lambda load: daily(spark, *(r for r in rows if r[2] in load))
    spliced, known = history.version_history(of(loads[0]), KEYS, ATTRS), loads[0]
    for load in loads[1:]:
        spliced = spark.createDataFrame(
            history.splice_history(spliced, of(load), KEYS, ATTRS, of(known)).collect(),
            spliced.schema)
        known = known + load
    assert table(spliced) == table(history.version_history(daily(spark, *rows), KEYS, ATTRS))


def test_a_repeated_load_changes_nothing_and_a_new_row_replaces(spark):
    whole = documented(spark)
    versions = history.version_history(whole, KEYS, ATTRS)
    again = history.splice_history(versions, whole, KEYS, ATTRS, whole)
    assert table(again) == table(versions)
    fixed = history.splice_history(versions, daily(spark, ("R123", 3, "2026-01-22")), KEYS, ATTRS,
                                   whole)
    assert table(fixed.filter("id = 'R123'"), "version", "difficulty", "valid_from", "valid_to",
                 "last_seen_date") == [(1, 2, "2026-01-15", "2026-01-22", "2026-01-15"),
                                       (2, 3, "2026-01-22", "2026-02-05", "2026-01-29")]


def test_an_empty_pull_closes_and_an_empty_load_does_nothing(spark):
    whole = documented(spark)
    versions, nothing = history.version_history(whole, KEYS, ATTRS), whole.limit(0)
    assert table(history.splice_history(versions, nothing, KEYS, ATTRS, whole)) == table(versions)
    closed = history.splice_history(versions, nothing, KEYS, ATTRS, whole,
                                    pulls=daily(spark, ("-", 0, "2026-02-12")))
    assert table(closed.filter("id = 'R456'"), "valid_to", "is_active") == [("2026-02-12", 0)]


def test_versions_closed_before_a_load_pass_by_the_windows(spark, tmp_path):
    """What was closed before is read by a filter and is in no window or aggregate of attributes."""
    whole = documented(spark)
    history.version_history(whole, KEYS, ATTRS).write.parquet(f"{tmp_path}/h")
    stored = spark.read.parquet(f"{tmp_path}/h")
    late = daily(spark, ("R123", 3, "2026-02-12"))
    spliced = history.splice_history(stored, late, KEYS, ATTRS, whole)
    assert table(spliced, "id", "version", "valid_from", "valid_to") == [
        ("R123", 1, "2026-01-15", "2026-01-29"), ("R123", 2, "2026-01-29", "2026-02-05"),
        ("R123", 3, "2026-02-12", None), ("R456", 1, "2026-02-05", "2026-02-12")]
    plan = spliced._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
