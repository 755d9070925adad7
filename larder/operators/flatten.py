"""Response payloads to entity and bridge rows.

Every row keeps its lineage: ``pull_date``, ``endpoint``, ``ingestion_timestamp``,
``page_number`` and ``seq`` (its indexes inside the payload). Together they give the total
order that the merge uses. Null arrays are empty, items without an id are dropped, and
positions are the 0-based array indexes, counting dropped items too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.calendar import iso_date
from larder.operators.merge import has_key
from larder.schemas import ITEM_PAGE, MENU_PAGE, RECIPE_DOC, SILVER, TABLES

LINEAGE = ("pull_date", "endpoint", "ingestion_timestamp", "page_number")
ORDER = ("endpoint", "ingestion_timestamp", "page_number", "seq")

# Payload key -> column, for keys that are stored under another name.
RENAMED = {"servingSize": "serving_size", "imagePath": "image_url", "iconPath": "icon_url"}
#: How a page begins that is a bare list, and one that holds a single object under ``data``.
BARE_LIST, ONE_UNDER_DATA = r"^\s*\[", r'^\s*\{\s*"data"\s*:\s*\{'
#: Recipe attributes that are stored as they are, and those that are renamed or taken apart.
RECIPE_PLAIN = ("name", "headline", "description", "difficulty", "prep_time", "total_time")
RECIPE_NESTED = ("servingSize", "cuisine", "imagePath")
REFERENCE_ENDPOINTS = ("ingredients", "allergens", "tags", "labels")

#: Writes documents under a name and gives a reader, which takes the schema to read them by.
Stage = Callable[[str, DataFrame], Callable[[T.StructType], DataFrame]]


def _of(bronze: DataFrame, endpoint: str) -> DataFrame:
    return bronze.filter(F.col("endpoint") == endpoint)


def _items(rows: DataFrame, array: Column, *carry: str | Column, seq: Column,
           name: str) -> DataFrame:
    """Explode ``array`` into ``name``, extend ``seq``, drop items without an id.

    The outer form, because for the inner one Spark infers a filter on the array's size and
    so parses every JSON payload a second time; the id filter drops the empty rows anyway.
    """
    exploded = rows.select(*carry, seq.alias("_outer"),
                           F.posexplode_outer(array).alias("_pos", name))
    return (exploded.withColumn("seq", F.concat("_outer", F.array("_pos")))
            .filter(has_key(F.col(f"{name}.id"))).drop("_outer"))


# --- parsed documents -----------------------------------------------------------------


def menu_documents(bronze: DataFrame) -> DataFrame:
    """One row per menu of the ``menus`` pages, as a parsed document."""
    page = F.from_json("payload", MENU_PAGE)
    parsed = _of(bronze, "menus").select(*LINEAGE, page.alias("_page"))
    return _items(parsed, F.col("_page.data"), *LINEAGE, seq=F.array().cast("array<int>"),
                  name="menu").drop("_pos")


def menu_recipe_documents(menus: DataFrame) -> DataFrame:
    """One row per recipe listed on a menu document."""
    return _items(menus, F.col("menu.recipes"), *LINEAGE, F.col("menu.id").alias("menu_id"),
                  seq=F.col("seq"), name="recipe").withColumnRenamed("_pos", "position")


def recipe_documents(bronze: DataFrame) -> DataFrame:
    """One row per recipe of the ``recipes`` detail pages.

    Accepts ``{data: [...]}``, ``{data: {...}}``, ``[...]`` and a bare recipe. How a payload begins
    tells its shape, so each is parsed once, by the schema of that shape. Only an object with a
    ``data`` key after other keys that holds no list is parsed again.
    """
    text = F.col("payload")
    is_list, is_one = text.rlike(BARE_LIST), text.rlike(ONE_UNDER_DATA)
    listed = T.ArrayType(RECIPE_DOC)
    # A bare recipe is read together with a list under ``data``: only one of them is there.
    either = T.StructType([T.StructField("data", listed), *RECIPE_DOC.fields])
    shaped = F.struct(
        F.when(is_list, F.from_json(text, listed)).alias("bare_list"),
        F.when(is_one, F.from_json(
            text, T.StructType([T.StructField("data", RECIPE_DOC)]))["data"]).alias("one"),
        F.when(~is_list & ~is_one, F.from_json(text, either)).alias("either"),
        F.when(~is_list & ~is_one & text.rlike(r'"data"\s*:\s*\{'), text).alias("late"))
    parsed = _of(bronze, "recipes").select(*LINEAGE, shaped.alias("_page"))
    page, found = F.col("_page"), F.col("_page.either")
    bare = F.struct(*(found[name].alias(name) for name in RECIPE_DOC.fieldNames()))
    late = F.from_json(F.get_json_object(page["late"], "$.data"), listed)
    recipes = F.coalesce(page["bare_list"], F.when(page["one"].isNotNull(), F.array(page["one"])),
                         found["data"], F.when(page["late"].isNotNull(), late),
                         F.when(found.isNotNull(), F.array(bare)))
    return _items(parsed, recipes, *LINEAGE, seq=F.array().cast("array<int>"),
                  name="recipe").drop("_pos")


# --- entities -------------------------------------------------------------------------


def menu_rows(menus: DataFrame) -> DataFrame:
    return menus.select(*LINEAGE, "seq", "menu.id", "menu.url", "menu.year_week",
                        iso_date(F.col("menu.start")).alias("start_date"))


def recipe_rows(recipes: DataFrame) -> DataFrame:
    """Recipe attributes, from menu listings or details."""
    return recipes.select(
        *LINEAGE, "seq", *(F.col(f"recipe.{key}") for key in ("id", *RECIPE_PLAIN)),
        F.col("recipe.servingSize").alias(RENAMED["servingSize"]),
        F.col("recipe.cuisine.name").alias("cuisine"),
        F.col("recipe.imagePath").alias(RENAMED["imagePath"]))


def reference_rows(bronze: DataFrame, endpoint: str) -> DataFrame:
    """Ingredients, allergens, tags or labels, with the list of columns each item carries.

    Items are read as maps, because a struct cannot tell an absent key from a null one.
    Keys that are not columns of the target table are ignored.
    """
    table = TABLES[endpoint]
    stored = {name: name for name in table.attribute_names}
    stored.update({column: key for key, column in RENAMED.items() if column in stored})
    page = F.from_json("payload", ITEM_PAGE)
    parsed = _of(bronze, endpoint).select(*LINEAGE, page.alias("_page"))
    items = parsed.select(*LINEAGE, F.posexplode_outer("_page.data").alias("_pos", "item"))
    item = F.col("item")
    present = F.array_compact(F.array(*(
        F.when(F.map_contains_key(item, key), F.lit(column))
        for column, key in stored.items())))
    return items.select(
        *LINEAGE, F.array("_pos").alias("seq"), item["id"].alias(table.keys[0]),
        *(item[key].alias(column) for column, key in stored.items()),
        present.alias("present")).filter(has_key(F.col(table.keys[0])))


# --- bridges --------------------------------------------------------------------------


def menu_recipe_rows(listed: DataFrame) -> DataFrame:
    return listed.select(*LINEAGE, "seq", "menu_id", F.col("recipe.id").alias("recipe_id"),
                         "position")


def recipe_ingredient_rows(recipes: DataFrame) -> DataFrame:
    rows = _items(recipes, F.col("recipe.ingredients"), *LINEAGE,
                  F.col("recipe.id").alias("recipe_id"), seq=F.col("seq"), name="used")
    return rows.select(*LINEAGE, "seq", "recipe_id", F.col("used.id").alias("ingredient_id"),
                       "used.quantity", "used.unit", F.col("_pos").alias("position"))


def recipe_link_rows(recipes: DataFrame, kind: str) -> DataFrame:
    """Recipe to ``allergens``, ``tags`` or ``labels`` pairs, from detail documents."""
    rows = _items(recipes, F.col(f"recipe.{kind}"), *LINEAGE,
                  F.col("recipe.id").alias("recipe_id"), seq=F.col("seq"), name="linked")
    return rows.select(*LINEAGE, "seq", "recipe_id",
                       F.col("linked.id").alias(TABLES[kind].keys[0]))


def listed_recipe_ids(menus: DataFrame) -> DataFrame:
    """Distinct, sorted ids of all recipes listed on menus."""
    ids = menus.select(F.explode_outer("menu.recipes.id").alias("recipe_id"))
    return ids.filter(has_key(F.col("recipe_id"))).distinct().orderBy("recipe_id")


#: The fields of recipe documents that a table is made from, as they are staged.
RECIPE_FIELDS = {
    "recipes": ("id", *RECIPE_PLAIN, *RECIPE_NESTED),
    "menu_recipes": ("id",),
    "recipe_ingredients": ("id", "ingredients"),
    **{f"recipe_{kind}": ("id", kind) for kind in ("allergens", "tags", "labels")},
}
#: Tables made from menu documents, and from recipe documents.
FROM_MENUS = ("menus", "recipes", "menu_recipes", "recipe_ingredients")
FROM_DETAILS = ("recipes", "recipe_ingredients", "recipe_allergens", "recipe_tags",
                "recipe_labels")


def _document_type(document: T.StructType, table: str) -> T.StructType:
    """A recipe or menu document with those fields of recipes only that a table is made from."""
    fields = RECIPE_FIELDS.get(table, ("id",))
    if document == RECIPE_DOC:
        return T.StructType([RECIPE_DOC[name] for name in fields])
    return T.StructType([
        T.StructField(f.name, T.ArrayType(_document_type(RECIPE_DOC, table)))
        if f.name == "recipes" else f for f in document])


def _staged(stage: Stage, name: str, rows: DataFrame) -> Callable[[str], DataFrame]:
    """Staged documents by table. The type is given on reading, because Spark prunes no fields below
    exploded lists: without it every table would read and copy whole documents."""
    column, read = name[:-1], stage(name, rows)
    return lambda table: read(T.StructType([
        T.StructField(f.name, _document_type(f.dataType, table)) if f.name == column else f
        for f in rows.schema]))


def silver_observations(bronze: DataFrame, tables: Iterable[str] = SILVER,
                        stage: Stage | None = None) -> dict[str, DataFrame]:
    """Rows for silver tables, from all well-formed pages of all pulls given.

    Menu documents feed four tables and recipe documents five. ``stage`` may write them and give
    their reader, so that JSON is parsed once and each table then reads its fields only. Both
    are staged side by side.
    """
    tables = tuple(tables)
    parsed = {name: make(bronze) for name, make, fed in (
        ("menus", menu_documents, FROM_MENUS), ("recipes", recipe_documents, FROM_DETAILS))
        if set(fed) & set(tables)}
    if stage is None or not parsed:
        documents = {name: lambda table, rows=rows: rows for name, rows in parsed.items()}
    else:
        with ThreadPoolExecutor(max_workers=len(parsed)) as pool:
            documents = dict(zip(parsed, pool.map(
                lambda name: _staged(stage, name, parsed[name]), parsed)))
    menus = lambda table: documents["menus"](table)
    details = lambda table: documents["recipes"](table)
    listed = lambda table: menu_recipe_documents(menus(table))
    both = lambda table, rows: rows(listed(table)).unionByName(rows(details(table)))
    makers = {
        "menus": lambda: menu_rows(menus("menus")),
        "recipes": lambda: both("recipes", recipe_rows),
        "menu_recipes": lambda: menu_recipe_rows(listed("menu_recipes")),
        "recipe_ingredients": lambda: both("recipe_ingredients", recipe_ingredient_rows),
        **{f"recipe_{kind}": lambda k=kind: recipe_link_rows(details(f"recipe_{k}"), k)
           for kind in ("allergens", "tags", "labels")},
        **{endpoint: lambda e=endpoint: reference_rows(bronze, e)
           for endpoint in REFERENCE_ENDPOINTS},
    }
    return {name: makers[name]() for name in tables}
