"""Raw pages: damage, dedupe, the accepted shapes, dropped items, presence."""

import json

from pyspark.sql import functions as F

from larder.operators import bronze, flatten
from tests.helpers import pages, table

RECIPE = {"id": 7, "name": "Stew", "difficulty": 2, "prep_time": 35, "servingSize": 2,
          "imagePath": "/s.png", "cuisine": {"name": "Irish"},
          "ingredients": [{"id": "a", "quantity": 1.5, "unit": "g"}, {"id": None},
                          {"id": ""}, {"id": "b"}],
          "allergens": [{"id": "x"}, {"id": None}], "tags": [{"id": "t"}], "labels": None}


def menu_page(*menus, last_page=1):
    return json.dumps({"data": list(menus), "meta": {"last_page": last_page}})


def test_malformed_pages_are_set_aside(spark):
    rows = pages(spark, ("2026-02-03", "menus", '{"data": ['), ("2026-02-03", "menus", None),
                 ("2026-02-03", "menus", "not json"), ("2026-02-03", "menus", '{"data": []}'))
    assert bronze.malformed(rows).count() == 3
    assert bronze.well_formed(rows).count() == 1


def test_pages_pulled_twice_count_once_per_pull(spark):
    rows = pages(spark, ("2026-02-03", "menus", "{}"), ("2026-02-03", "menus", "{}"),
                 ("2026-02-10", "menus", "{}"))
    assert bronze.distinct_payloads(rows).count() == 2
    assert table(bronze.latest_pull(rows), "pull_date") == [("2026-02-10",)]


def test_stored_copies_go_without_a_shuffle_of_payloads(spark, tmp_path):
    rows = pages(spark, *[("2026-02-03", "menus", "{}")] * 3, ("2026-02-03", "tags", "{}"),
                 ("2026-02-03", "menus", None), ("2026-02-03", "menus", None),
                 ("2026-02-10", "menus", "{}"), ("2026-02-10", "menus", "{x"))
    rows.repartition(3).write.parquet(f"{tmp_path}/pages")
    stored = spark.read.parquet(f"{tmp_path}/pages")
    found = bronze.distinct_stored_payloads(stored)
    columns = ("pull_date", "endpoint", "payload")
    assert sorted(map(str, table(found, *columns))) == sorted(
        map(str, table(bronze.distinct_payloads(rows), *columns)))
    assert found.count() == 5
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    assert bronze.distinct_stored_payloads(stored.limit(0)).count() == 0


def test_page_audit_counts_the_stored_empty_page(spark):
    rows = pages(spark, ("2026-02-03", "menus", menu_page({"id": 1}, {"id": 2}, last_page=3)),
                 ("2026-02-03", "menus", '{"data": []}', 2),
                 ("2026-02-03", "tags", '{"data": [{"id": 1}]}'))
    assert table(bronze.page_audit(rows), "endpoint", "pages_stored", "pages_announced",
                 "records", "is_complete") == [("menus", 2, 3, 2, False),
                                               ("tags", 1, 1, 1, True)]


def test_page_audit_sees_holes_and_counts_every_shape(spark):
    rows = pages(spark, ("2026-02-03", "menus", menu_page({"id": 1}, last_page=3)),
                 ("2026-02-03", "menus", menu_page({"id": 2}, last_page=3), 3),
                 ("2026-02-03", "menus", menu_page({"id": 2}, last_page=3), 3),
                 ("2026-02-03", "recipes", '{"data": {"id": 1}}'),
                 ("2026-02-03", "recipes", ' [{"id": 2}, {"id": 3}]', 2),
                 ("2026-02-03", "recipes", '{"id": 4}', 3),
                 ("2026-02-03", "tags", "{damaged"), ("2026-02-03", "labels", None))
    assert table(bronze.page_audit(rows), "endpoint", "pages_stored", "pages_announced",
                 "max_page", "records", "is_complete") == [
        ("labels", 1, 1, 1, 0, True), ("menus", 2, 3, 3, 3, False), ("recipes", 1, 1, 3, 4, True),
        ("tags", 1, 1, 1, 0, True)]


def test_page_audit_keeps_null_locales_and_lists_what_is_missing(spark):
    rows = pages(spark, *(("2026-02-03", "menus", menu_page({"id": n}, last_page=70_000), n)
                          for n in (1, 2, 5, 8, 9, 32_768, 32_769, 69_999, 80_000, 0)),
                 ("2026-02-03", "menus", "{damaged", None))
    rows = rows.withColumn("locale", F.lit(None).cast("string")).unionByName(
        pages(spark, ("2026-02-03", "menus", menu_page({"id": 1}, last_page=2), 2)))
    found = {r.locale: r for r in bronze.page_audit(rows).collect()}
    assert set(found) == {None, "en-GB"}
    row = found[None]
    assert (row.pages_stored, row.pages_announced, row.max_page, row.records) == (
        8, 70_000, 80_000, 10)
    assert [tuple(r) for r in row.missing] == [
        (3, 4), (6, 7), (10, 32_767), (32_770, 69_998), (70_000, 70_000)]
    assert [tuple(r) for r in found["en-GB"].missing] == [(1, 1)]


def test_page_audit_scans_and_parses_once(spark, tmp_path):
    pages(spark, ("2026-02-03", "menus", menu_page({"id": 1}))).write.parquet(f"{tmp_path}/b")
    audit = bronze.page_audit(spark.read.parquet(f"{tmp_path}/b"))
    plan = audit._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
    assert plan.count("from_json") + plan.count("jsontostructs") <= 1


def test_marks_of_loads_add_up(spark):
    """In any split and with any load twice, the audit of the marks is that of all pages."""
    rows = [("2026-02-03", "menus", menu_page({"id": n}, last_page=40), n) for n in range(1, 40, 3)]
    parts = [bronze.page_marks(pages(spark, *rows[a::3])) for a in range(3)]
    columns = ("pages_stored", "pages_announced", "max_page", "is_complete", "missing")
    assert table(bronze.audit_of(bronze.combine_marks(*parts, parts[0])), *columns) == table(
        bronze.page_audit(pages(spark, *rows)), *columns)


def test_window_keeps_unreadable_starts(spark):
    rows = spark.createDataFrame([("2026-02-07",), ("2026-03-07",), (None,), ("2026/01/15",)],
                                 "start string")
    kept = bronze.in_window(rows, "2026-02-01", "2026-02-28")
    assert table(kept) == [("2026-02-07",), ("2026/01/15",), (None,)]


def test_all_detail_shapes_are_read(spark):
    shapes = [{"data": [RECIPE]}, {"data": RECIPE}, [RECIPE], RECIPE]
    rows = pages(spark, *(("2026-02-03", "recipes", json.dumps(s), n)
                          for n, s in enumerate(shapes)))
    found = flatten.recipe_rows(flatten.recipe_documents(rows))
    assert table(found, "page_number", "id", "name", "difficulty", "prep_time",
                 "serving_size", "cuisine", "image_url") == [
        (n, "7", "Stew", 2.0, "35", "2", "Irish", "/s.png") for n in range(4)]


def test_detail_shapes_with_space_and_late_keys(spark):
    texts = ('\n [{"id": 1}, {"id": 2}]', ' {\n "data" : {"id": 3}}', '{"meta": {}, "data": {"id": 4}}',
             '{"id": 5, "data": {"id": 6}}', '{"id": 7, "data": null}', '{"id": 8, "data": 3}',
             '{"meta": {"last_page": 2}, "data": [{"id": 9}, {"id": 10}]}',
             '{"id": 11, "tags": [{"id": "t", "data": {"id": 12}}]}')
    rows = pages(spark, *(("2026-02-03", "recipes", text, n) for n, text in enumerate(texts)))
    found = flatten.recipe_documents(rows)
    assert table(found, "page_number", "seq", "recipe.id") == [
        (0, [0], "1"), (0, [1], "2"), (1, [0], "3"), (2, [0], "4"), (3, [0], "6"), (4, [0], "7"),
        (5, [0], "8"), (6, [0], "9"), (6, [1], "10"), (7, [0], "11")]


def test_detail_payloads_are_parsed_once(spark, tmp_path):
    """Each shape has one parse of the payload; text under ``data`` is taken out of late ones only."""
    pages(spark, ("2026-02-03", "recipes", "{}")).write.parquet(f"{tmp_path}/b")
    details = flatten.recipe_rows(flatten.recipe_documents(spark.read.parquet(f"{tmp_path}/b")))
    plan = details._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 4 and plan.count("get_json_object") == 1
    assert "get_json_object(_page" in plan and plan.count("Relation") == 1


def test_unusable_detail_payloads_give_no_rows_and_spare_the_others(spark):
    rows = pages(spark, *(("2026-02-03", "recipes", text) for text in (
        '{"data": 5}', '{"data": null}', '{"data": [{"name": "no id"}]}', "{", "[]",
        json.dumps({"data": {"id": "ok", "cuisine": None, "ingredients": None}}))))
    details = flatten.recipe_documents(rows)
    assert table(flatten.recipe_rows(details), "id", "cuisine") == [("ok", None)]
    assert flatten.recipe_ingredient_rows(details).count() == 0


def test_menu_page_gives_all_its_rows(spark):
    menu = {"id": "m1", "url": "u", "year_week": "2026-W06", "start": "2026-02-07",
            "recipes": [RECIPE, {"id": None}, {"id": 8, "cuisine": None}]}
    rows = pages(spark, ("2026-02-03", "menus", menu_page(menu, {"id": ""}, {"id": "m2"})))
    menus = flatten.menu_documents(rows)
    listed = flatten.menu_recipe_documents(menus)
    assert table(flatten.menu_rows(menus), "id", "year_week", "start_date") == [
        ("m1", "2026-W06", "2026-02-07"), ("m2", None, None)]
    assert table(flatten.menu_recipe_rows(listed), "menu_id", "recipe_id", "position") == [
        ("m1", "7", 0), ("m1", "8", 2)]
    assert table(flatten.recipe_ingredient_rows(listed), "recipe_id", "ingredient_id",
                 "quantity", "unit", "position") == [("7", "a", "1.5", "g", 0),
                                                     ("7", "b", None, None, 3)]
    assert [r[0] for r in flatten.listed_recipe_ids(menus).collect()] == ["7", "8"]


def test_links_come_from_details(spark):
    details = flatten.recipe_documents(pages(spark, ("2026-02-03", "recipes",
                                                     json.dumps(RECIPE))))
    assert table(flatten.recipe_link_rows(details, "allergens"), "recipe_id",
                 "allergen_id") == [("7", "x")]
    assert table(flatten.recipe_link_rows(details, "tags"), "tag_id") == [("t",)]
    assert flatten.recipe_link_rows(details, "labels").count() == 0


def test_reference_rows_tell_absent_from_null_and_ignore_unknown_columns(spark):
    items = [{"id": 1, "name": "Salt", "family": None, "iconPath": "/i", "price": 3},
             {"id": 2, "type": "spice"}, {"name": "no id"}]
    rows = flatten.reference_rows(pages(spark, ("2026-02-03", "ingredients",
                                                json.dumps({"data": items}))), "ingredients")
    assert set(rows.columns) >= {"ingredient_id", "name", "family", "type", "present"}
    assert "icon_url" not in rows.columns
    found = rows.select("ingredient_id", "name", "family", "type",
                        F.array_join(F.array_sort("present"), ",").alias("present"))
    assert table(found) == [("1", "Salt", None, None, "family,name"),
                            ("2", None, None, "spice", "type")]
    icons = flatten.reference_rows(pages(spark, ("2026-02-03", "allergens", json.dumps(
        {"data": [{"id": 1, "iconPath": "/i"}]}))), "allergens")
    assert table(icons, "allergen_id", "icon_url") == [("1", "/i")]
