"""The star-schema test tables read as a menu catalogue.

Orders are menus, parts are recipes, suppliers are ingredients, brands are allergens, part
types are tags, order priorities are labels, events are raw responses. Month starts play the
part of the weekly key. Everything is derived by Spark from whole tables; nothing is cut.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.schemas import SILVER

# Reference dates of the test data (orders run 1995-01-01 .. 2001-08-01).
AS_OF = date(2001, 9, 1)
ACTIVE_SINCE = date(2001, 6, 1)

_SCHEMAS: dict[str, StructType] = {}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One test table; its file schema is looked up once per path."""
    path = f"{root}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def month_of(stamp: Column) -> Column:
    return F.trunc(F.to_date(stamp), "month")


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


class StarMenus:
    """Silver tables of the menu model, as lazy DataFrames over the star-schema files."""

    def __init__(self, spark: SparkSession, root: str,
                 recipes: Callable[[], DataFrame] | None = None):
        """``recipes`` gives the recipes as a stored table, for tables that are tracked by them."""
        self.spark, self.root = spark, root
        self._tracked = recipes or (lambda: self.recipes)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name)

    def builders(self) -> dict:
        """Table name -> zero-argument builder, as :class:`larder.plans.Catalogue` takes it."""
        names = ("api_responses", *SILVER)
        return {name: (lambda n=name: getattr(self, n)) for name in names}

    # --- base rows --------------------------------------------------------------------

    @cached_property
    def order_lines(self) -> DataFrame:
        """Line items with the columns of their order."""
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            month_of(F.col("o_orderdate")).alias("month"), "o_orderpriority", "o_orderdate",
            "o_custkey")
        return self.table("lineitem").join(orders, "l_orderkey")

    def _line_links(self, *keys: Column, **extra: Column) -> DataFrame:
        """Distinct key pairs of line items with link tracking columns."""
        shipped = F.to_date("l_shipdate")
        return self.table("lineitem").groupBy(*keys).agg(
            *(column.alias(name) for name, column in extra.items()),
            F.min(shipped).alias("first_seen_date"), F.max(shipped).alias("last_seen_date"),
            F.max(_flag(F.col("l_returnflag") != "R")).alias("is_active"))

    # --- entities ---------------------------------------------------------------------

    @cached_property
    def menus(self) -> DataFrame:
        day = F.to_date("o_orderdate")
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"),
            F.concat(F.lit("menu/"), F.col("o_orderkey")).alias("url"),
            (F.year(day) * 100 + F.weekofyear(day)).alias("year_week"),
            F.trunc(day, "month").alias("start_date"),
            F.trunc(day, "month").alias("first_seen_date"), day.alias("last_seen_date"),
            _flag(F.col("o_orderstatus") != "P").alias("is_active"))

    @cached_property
    def recipes(self) -> DataFrame:
        spans = self.order_lines.groupBy(F.col("l_partkey").alias("id")).agg(
            F.min("month").alias("first_seen_date"), F.max("month").alias("last_seen_date"))
        size = F.col("p_size")
        prep = (F.when(size % 10 == 5, size.cast("string"))
                .when(size % 10 != 0, F.concat(size, F.lit(" mins"))))
        return (self.table("part").select(
                    F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                    F.col("p_brand").alias("headline"), size.cast("double").alias("difficulty"),
                    prep.alias("prep_time"),
                    F.concat(size + 10, F.lit(" mins")).alias("total_time"),
                    F.when(size % 17 != 0, F.col("p_type")).alias("cuisine"))
                .join(spans, "id", "left")
                .withColumn("is_active",
                            _flag(F.col("last_seen_date") >= F.lit(ACTIVE_SINCE))))

    @cached_property
    def ingredients(self) -> DataFrame:
        spans = self._line_links(F.col("l_suppkey").alias("ingredient_id")).drop("is_active")
        nations = self.table("nation").select(
            F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("family"))
        return (self.table("supplier").join(nations, "s_nationkey", "left").select(
                    F.col("s_suppkey").alias("ingredient_id"), F.col("s_name").alias("name"),
                    "family", _flag(F.col("s_acctbal") >= 0).alias("is_active"))
                .join(spans, "ingredient_id", "left"))

    def _dimension(self, key: str, source: str, kind: str) -> DataFrame:
        """A dimension of distinct part values, tracked over the recipes that carry them."""
        spans = self._tracked().select("id", "first_seen_date", "last_seen_date", "is_active")
        parts = self.table("part").select(F.col("p_partkey").alias("id"),
                                          F.col(source).alias(key))
        return parts.join(spans, "id").groupBy(key).agg(
            F.min("first_seen_date").alias("first_seen_date"),
            F.max("last_seen_date").alias("last_seen_date"),
            F.max("is_active").alias("is_active"),
        ).withColumns({"name": F.col(key), "type": F.lit(kind)})

    @cached_property
    def allergens(self) -> DataFrame:
        return self._dimension("allergen_id", "p_brand", "brand")

    @cached_property
    def tags(self) -> DataFrame:
        return self._dimension("tag_id", "p_type", "type")

    @cached_property
    def labels(self) -> DataFrame:
        return self.table("orders").groupBy(F.col("o_orderpriority").alias("label_id")).agg(
            F.min(month_of(F.col("o_orderdate"))).alias("first_seen_date"),
            F.max(month_of(F.col("o_orderdate"))).alias("last_seen_date"),
            F.max(_flag(F.col("o_orderstatus") != "P")).alias("is_active"),
        ).withColumn("name", F.col("label_id"))

    # --- bridges ----------------------------------------------------------------------

    @cached_property
    def menu_recipes(self) -> DataFrame:
        return self._line_links(
            F.col("l_orderkey").alias("menu_id"), F.col("l_partkey").alias("recipe_id"),
            position=F.min("l_linenumber") - 1)

    @cached_property
    def recipe_ingredients(self) -> DataFrame:
        return self._line_links(
            F.col("l_partkey").alias("recipe_id"), F.col("l_suppkey").alias("ingredient_id"),
            position=F.min("l_linenumber") - 1,
            quantity=F.sum("l_quantity").cast("long"), unit=F.min("l_linestatus"))

    def _part_links(self, key: str, source: str, active: Column) -> DataFrame:
        spans = self._tracked().select(F.col("id").alias("recipe_id"), "first_seen_date",
                                    "last_seen_date")
        return (self.table("part").select(F.col("p_partkey").alias("recipe_id"),
                                          F.col(source).alias(key),
                                          _flag(active).alias("is_active"))
                .join(spans, "recipe_id", "left"))

    @cached_property
    def recipe_allergens(self) -> DataFrame:
        return self._part_links("allergen_id", "p_brand", F.col("p_size") > 4)

    @cached_property
    def recipe_tags(self) -> DataFrame:
        return self._part_links("tag_id", "p_type", F.col("p_size") % 9 != 0)

    @cached_property
    def recipe_labels(self) -> DataFrame:
        return self.order_lines.groupBy(
            F.col("l_partkey").alias("recipe_id"), F.col("o_orderpriority").alias("label_id"),
        ).agg(F.min("month").alias("first_seen_date"), F.max("month").alias("last_seen_date"),
              F.max(_flag(F.col("l_returnflag") != "R")).alias("is_active"))

    # --- bronze -----------------------------------------------------------------------

    @cached_property
    def api_responses(self) -> DataFrame:
        return self.table("events").select(
            F.to_date("ts").alias("pull_date"), F.col("event_type").alias("endpoint"),
            F.lit("en-GB").alias("locale"), F.col("user_id").alias("page_number"),
            F.col("props").alias("payload"), F.col("ts").alias("ingestion_timestamp"),
            "event_id")

    @cached_property
    def observations(self) -> DataFrame:
        """Keyed observations for the merge and history operators: a user seen on a day."""
        return self.table("events").select(
            "user_id", F.to_date("ts").alias("pull_date"), "event_type", "value", "ts",
            "event_id", "props")
