"""Table and payload schemas. JSON payloads are always read with these, never inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
DATE, STAMP = T.DateType(), T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


@dataclass(frozen=True)
class Table:
    """A stored table: its key, its attribute columns, and whether it is seen-date tracked."""

    layer: str
    keys: tuple[str, ...]
    attributes: T.StructType
    tracked: bool = False

    @property
    def attribute_names(self) -> list[str]:
        return self.attributes.fieldNames()


def _silver(keys: tuple[str, ...], **fields: T.DataType) -> Table:
    return Table("silver", keys, _struct(**fields), tracked=True)


def _gold(keys: tuple[str, ...], **fields: T.DataType) -> Table:
    return Table("gold", keys, _struct(**fields))


BRONZE = _struct(pull_date=DATE, endpoint=STRING, locale=STRING, page_number=INT,
                 payload=STRING, ingestion_timestamp=STAMP)
LANDED_LINE = _struct(pull_date=DATE, endpoint=STRING, locale=STRING, page_number=INT,
                      payload=STRING)

TRACKING = ("first_seen_date", "last_seen_date", "is_active")

TABLES: dict[str, Table] = {
    "api_responses": Table("bronze", (), BRONZE),
    "recipes": _silver(("id",), name=STRING, headline=STRING, description=STRING,
                       difficulty=DOUBLE, prep_time=STRING, total_time=STRING,
                       serving_size=STRING, cuisine=STRING, image_url=STRING),
    "ingredients": _silver(("ingredient_id",), name=STRING, family=STRING, type=STRING),
    "allergens": _silver(("allergen_id",), name=STRING, type=STRING, icon_url=STRING),
    "tags": _silver(("tag_id",), name=STRING, type=STRING, icon_url=STRING),
    "labels": _silver(("label_id",), name=STRING, description=STRING),
    "menus": _silver(("id",), url=STRING, year_week=STRING, start_date=DATE),
    "recipe_ingredients": _silver(("recipe_id", "ingredient_id"), quantity=STRING,
                                  unit=STRING, position=INT),
    "recipe_allergens": _silver(("recipe_id", "allergen_id")),
    "recipe_tags": _silver(("recipe_id", "tag_id")),
    "recipe_labels": _silver(("recipe_id", "label_id")),
    "menu_recipes": _silver(("menu_id", "recipe_id"), position=INT),
    "weekly_menu_metrics": _gold(
        ("week_start_date",), locale=STRING, total_recipes=LONG, unique_recipes=LONG,
        new_recipes=LONG, returning_recipes=LONG, avg_difficulty=DOUBLE,
        avg_prep_time_minutes=DOUBLE),
    "recipe_survival_metrics": _gold(
        ("recipe_id",), recipe_name=STRING, first_appearance_date=DATE,
        last_appearance_date=DATE, total_weeks_active=INT, consecutive_weeks_active=INT,
        weeks_since_last_seen=INT, is_currently_active=INT),
    "ingredient_trends": _gold(
        ("ingredient_id", "week_start_date"), ingredient_name=STRING, recipe_count=LONG,
        week_over_week_change=LONG, popularity_rank=LONG),
    "menu_stability_metrics": _gold(
        ("week_start_date",), locale=STRING, overlap_with_prev_week=DOUBLE,
        new_recipe_rate=DOUBLE, churned_recipe_rate=DOUBLE, recipes_retained=LONG,
        recipes_added=LONG, recipes_removed=LONG),
    "allergen_density": _gold(
        ("allergen_id", "week_start_date"), allergen_name=STRING, recipe_count=LONG,
        percentage_of_menu=DOUBLE),
}

ENTITIES = ("recipes", "ingredients", "allergens", "tags", "labels", "menus")
BRIDGES = ("recipe_ingredients", "recipe_allergens", "recipe_tags", "recipe_labels",
           "menu_recipes")
SILVER = ENTITIES + BRIDGES
GOLD = tuple(name for name, table in TABLES.items() if table.layer == "gold")

# --- payloads -------------------------------------------------------------------------
# Ids are declared as strings: a JSON number is then read as its text.

_REF = T.ArrayType(_struct(id=STRING))
RECIPE_DOC = _struct(
    id=STRING, name=STRING, headline=STRING, description=STRING, difficulty=DOUBLE,
    prep_time=STRING, total_time=STRING, servingSize=STRING, imagePath=STRING,
    cuisine=_struct(name=STRING),
    ingredients=T.ArrayType(_struct(id=STRING, quantity=STRING, unit=STRING)),
    allergens=_REF, tags=_REF, labels=_REF)
MENU_DOC = _struct(id=STRING, url=STRING, year_week=STRING, start=STRING,
                   recipes=T.ArrayType(RECIPE_DOC))
PAGE_META = _struct(last_page=INT)
MENU_PAGE = _struct(data=T.ArrayType(MENU_DOC), meta=PAGE_META)
ITEM_PAGE = _struct(data=T.ArrayType(T.MapType(STRING, STRING)))
