"""Keyed merge: overwrite, patch, late and repeated pulls, deactivation."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from larder.functions.scalars import packed, unpacked
from larder.operators import merge
from larder.plans.silver import Warehouse, fold_bronze
from larder.session import work_dir
from tests.helpers import day, pages, table

ROWS = "id string, name string, size int, pull_date date, seq int, present array<string>"


def observed(spark, *rows):
    """(id, name, size, pull date[, seq[, present columns]])"""
    return spark.createDataFrame(
        [(i, n, s, day(p), rest[0] if rest else 0,
          rest[1] if len(rest) > 1 else ["name", "size"]) for i, n, s, p, *rest in rows], ROWS)


def fold(rows, present=None):
    return merge.fold(rows, ["id"], ["name", "size"], ["seq"], present=present)


def test_second_pull_overwrites_and_keeps_first_seen(spark):
    first = fold(observed(spark, ("a", "Old", 1, "2026-01-15"), ("b", "Only", 1, "2026-01-15")))
    second = observed(spark, ("a", "New", 2, "2026-01-22"), ("c", "Late", 3, "2026-01-22"))
    merged = merge.published(merge.upsert(first, second, ["id"], ["name", "size"], ["seq"]))
    assert table(merged) == [
        ("a", "New", 2, "2026-01-15", "2026-01-22", 1),
        ("b", "Only", 1, "2026-01-15", "2026-01-15", 1),
        ("c", "Late", 3, "2026-01-22", "2026-01-22", 1)]


def test_late_pull_moves_nothing_backwards(spark):
    newer = fold(observed(spark, ("a", "New", 2, "2026-01-22")))
    older = observed(spark, ("a", "Old", 1, "2026-01-15"))
    merged = merge.published(merge.upsert(newer, older, ["id"], ["name", "size"], ["seq"]))
    assert table(merged) == [("a", "New", 2, "2026-01-15", "2026-01-22", 1)]


def test_patch_keeps_absent_and_overwrites_with_null(spark):
    rows = observed(spark, ("a", "Salt", 1, "2026-01-15", 0, ["name", "size"]),
                    ("a", None, None, "2026-01-22", 0, ["name"]),
                    ("b", "Oil", None, "2026-01-15", 0, ["name"]))
    assert table(merge.published(fold(rows, present="present")), "id", "name", "size") == [
        ("a", None, 1), ("b", "Oil", None)]


def test_any_order_and_repeats_give_the_same_table(spark):
    pulls = [observed(spark, ("a", "1", 1, "2026-01-01", 0, ["name"]),
                      ("b", "1", 1, "2026-01-01")),
             observed(spark, ("a", "2", 2, "2026-01-08", 0, ["size"])),
             observed(spark, ("a", "3", None, "2026-01-15", 0, ["size"]),
                      ("c", "3", 3, "2026-01-15"))]
    whole = fold(pulls[0].union(pulls[1]).union(pulls[2]), present="present")
    expected = table(merge.published(whole))
    for order in itertools.permutations(range(3)):
        state = fold(pulls[order[0]], present="present")
        for index in (*order[1:], order[0]):
            state = merge.combine(state, fold(pulls[index], present="present"))
        assert table(merge.published(state)) == expected


def test_last_write_of_a_pull_wins(spark):
    rows = observed(spark, ("a", "x", 1, "2026-01-15", 1), ("a", "y", 2, "2026-01-15", 2),
                    ("a", "z", 3, "2026-01-22", 0)).drop("present")
    assert table(merge.dedupe_batch(rows, ["id"], ["seq"]), "pull_date", "name") == [
        ("2026-01-15", "y"), ("2026-01-22", "z")]


def test_keys_without_a_value_are_dropped(spark):
    rows = observed(spark, (None, "x", 1, "2026-01-15"), ("", "x", 1, "2026-01-15"),
                    ("0", "kept", 1, "2026-01-15"))
    assert table(merge.published(fold(rows)), "id") == [("0",)]


def test_deactivation_and_return(spark):
    rows = observed(spark, ("a", "x", 1, "2026-01-15"), ("b", "x", 1, "2026-01-15"),
                    ("b", "x", 1, "2026-01-22"))
    state = fold(rows)
    snapshot = rows.filter("pull_date = DATE '2026-01-22'")
    closed = merge.deactivate_missing(merge.published(state), snapshot, ["id"])
    assert table(closed, "id", "last_seen_date", "is_active") == [
        ("a", "2026-01-15", 0), ("b", "2026-01-22", 1)]
    assert table(merge.published(state, merge.newest_pull(rows))) == table(closed)
    dated = merge.deactivate_missing(merge.published(state), snapshot, ["id"],
                                     F.lit("2026-01-22").cast("date"))
    assert table(dated, "id", "last_seen_date") == [("a", "2026-01-22"), ("b", "2026-01-22")]
    back = merge.upsert(state, observed(spark, ("a", "x", 1, "2026-01-29")), ["id"],
                        ["name", "size"], ["seq"])
    assert table(merge.published(back, merge.newest_pull(
        observed(spark, ("a", "x", 1, "2026-01-29")))), "id", "is_active") == [
        ("a", 1), ("b", 0)]


def listing(pull, *names):
    menu = {"id": "m", "start": pull, "recipes": [{"id": i, "name": n}
                                                  for i, n in enumerate(names, 1)]}
    return pull, "menus", json.dumps({"data": [menu]})


def test_detail_wins_over_listing_within_a_pull(spark):
    bronze = pages(spark, ("2026-01-15", "recipes", '{"id": 1, "name": "Detail"}'),
                   listing("2026-01-15", "Listing"))
    assert table(merge.published(fold_bronze(bronze)["recipes"]), "id", "name") == [
        ("1", "Detail")]


def test_rebuild_equals_append_in_any_order(spark):
    weeks = [listing("2026-01-15", "A", "B"), listing("2026-01-22", "A2"),
             ("2026-01-22", "ingredients", '{"data": [{"id": 1, "name": "Salt"}]}'),
             listing("2026-01-29", "A3", "B3", "C3")]
    tables = ("recipes", "menus", "menu_recipes", "ingredients")
    rebuilt = Warehouse(spark, work_dir(spark, "test"))
    rebuilt.rebuild(pages(spark, *weeks), tables)
    appended = Warehouse(spark, work_dir(spark, "test"))
    for some in ((3, 2), (0,), (1, 0)):
        appended.append(pages(spark, *(weeks[n] for n in some)), tables)
    for name in tables:
        assert table(rebuilt.table(name)) == table(appended.table(name))
    assert table(rebuilt.table("recipes"), "id", "name", "first_seen_date",
                 "last_seen_date") == [("1", "A3", "2026-01-15", "2026-01-29"),
                                       ("2", "B3", "2026-01-15", "2026-01-29"),
                                       ("3", "C3", "2026-01-29", "2026-01-29")]


def test_bridge_keys_are_pairs(spark):
    bronze = pages(spark, listing("2026-01-15", "A", "B"), listing("2026-01-22", "A"))
    links = merge.published(fold_bronze(bronze)["menu_recipes"])
    assert table(links, "menu_id", "recipe_id", "position", "last_seen_date") == [
        ("m", "1", 0, "2026-01-22"), ("m", "2", 1, "2026-01-15")]


@pytest.mark.parametrize("name", ["tags", "labels"])
def test_tables_without_rows_fold_to_nothing(spark, name):
    assert fold_bronze(pages(spark, listing("2026-01-15", "A")))[name].count() == 0


def test_packed_texts_sort_as_their_fields_and_come_back(spark):
    """Also with the characters that packing itself uses."""
    some = (None, "", "a", "ab", "a\0", "a\0b", "\0", "\1", "\1\2", "\2", "\1\3\0", "\3", "é")
    rows = spark.createDataFrame([(a, b, "z") for a in some for b in some],
                                 "a string, b string, c string")
    one = rows.select("*", packed(F.col("a"), F.col("b"), F.col("c")).alias("one"))
    assert [tuple(r)[:3] for r in one.coalesce(1).sortWithinPartitions("one").collect()] == [
        tuple(r) for r in rows.coalesce(1).sortWithinPartitions("a", "b", "c").collect()]
    back = one.select(*(unpacked(F.col("one"), at).eqNullSafe(F.col(name)).alias(name)
                        for at, name in enumerate("abc")))
    assert back.filter("not (a and b and c)").isEmpty()


def test_fold_shuffles_one_flat_version(spark):
    """The last date and the texts side by side travel inside it, and the state is as it was."""
    rows = spark.createDataFrame(
        [("k", day("2026-01-02"), 2, None, "b", "c", 1.0, "d"),
         ("k", day("2026-01-02"), 2, "", "b", "c", 0.5, None),
         ("k", day("2026-01-02"), 1, "z", "b", "c", 2.0, "d"),
         ("k", day("2026-01-01"), 9, "z", "b", "c", 2.0, "d")],
        "k string, pull_date date, o int, a string, b string, c string, n double, d string")
    state = merge.fold(rows, ["k"], ["a", "b", "c", "n", "d"], ["o"])
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max") == 1
    assert state.schema.simpleString() == (
        "struct<k:string,first_seen_date:date,last_seen_date:date,_written_:struct<at:struct<"
        "pull:date,o:int>,value:struct<a:string,b:string,c:string,n:double,d:string>>>")
    assert table(merge.published(state)) == [
        ("k", "", "b", "c", 0.5, None, "2026-01-01", "2026-01-02", 1)]
