"""Response pages made from the star-schema test tables, to feed the JSON operators.

Pages have a bounded size by construction: a page holds one order (or part) and one block of
50 consecutive part and supplier keys, so no array outgrows a row however skewed the keys
are. Some ids are left out or empty, to be dropped on reading.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.schemas import BRONZE
from larder.sources.star import StarMenus, month_of

BLOCK = 50
LINES = 150_000  # lines that a task makes pages of
REFERENCE_PULL = "1995-01-01"
#: The columns of a part that a recipe has, in the order by which recipes of one key are listed.
PART = {"p_name": "name", "p_brand": "headline", "p_size": "difficulty", "p_type": "kind"}


def block(key: str) -> Column:
    return F.floor(F.col(key) / BLOCK).cast("int")


def sorted_list(row: Column) -> Column:
    """The group's structs, ordered by their first field."""
    return F.array_sort(F.collect_list(row))


class StarPages:
    """Bronze pages for each endpoint, over the whole test tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.star = StarMenus(spark, root)

    @cached_property
    def _tasks(self) -> int:
        """Tasks that make pages: by the number of lines, so that none outgrows its memory."""
        lines = self.star.table("lineitem").count()
        least = min(lines // 20_000, self.star.spark.sparkContext.defaultParallelism)
        return max(lines // LINES, least) + 1

    @cached_property
    def _months(self) -> int:
        return self.star.table("orders").select(month_of(F.col("o_orderdate"))).distinct().count()

    @cached_property
    def _parts(self) -> DataFrame:
        """Distinct rows of the part table and how often each comes: its copies are recipes of their
        own, but lines meet them once."""
        return self.star.table("part").groupBy(
            F.col("p_partkey").alias("l_partkey"),
            *(F.col(column).alias(name) for column, name in PART.items()),
        ).agg(F.count("*").alias("copies"))

    def _lines(self, *columns: str | Column) -> DataFrame:
        return self.star.order_lines.select(*columns, "l_partkey", "l_suppkey", "l_quantity")

    @staticmethod
    def _summed(lines: DataFrame, *group: str, **extra: Column) -> DataFrame:
        """One line per group and supplier. Lines that lie together by some of the group's keys are
        not shuffled again, and all that is grouped here is of fixed width."""
        return lines.groupBy(*group, "l_suppkey").agg(
            F.sum("l_quantity").cast("long").alias("quantity"),
            *(column.alias(name) for name, column in extra.items()))

    @staticmethod
    def _ingredient(supplier: Column, quantity: Column) -> Column:
        """A line as an ingredient; every 29th supplier has no id."""
        return F.struct(
            supplier.alias("n"),
            F.when(supplier % 29 != 0, supplier.cast("string")).otherwise("").alias("id"),
            quantity.alias("quantity"),
            F.when(supplier % 2 == 0, "g").otherwise("pcs").alias("unit"))

    @staticmethod
    def _attributes() -> list[Column]:
        """A recipe's attributes, from the columns of its part."""
        size = F.col("difficulty")
        return [F.col("name"), F.col("headline"), size,
                F.concat(size, F.lit(" mins")).alias("prep_time"), F.lit("2").alias("servingSize"),
                F.concat(F.lit("img/"), "l_partkey").alias("imagePath"),
                F.when(size % 17 != 0, F.struct(F.col("kind").alias("name"))).alias("cuisine")]

    @staticmethod
    def _page(rows: DataFrame, endpoint: str, pull: Column, page: Column,
              payload: Column) -> DataFrame:
        return rows.select(
            pull.cast("date").alias("pull_date"), F.lit(endpoint).alias("endpoint"),
            F.lit("en-GB").alias("locale"), page.cast("int").alias("page_number"),
            payload.alias("payload"),
            pull.cast("timestamp_ntz").alias("ingestion_timestamp")).select(
                *BRONZE.fieldNames())

    @cached_property
    def menus(self) -> DataFrame:
        """One order per page, its parts as recipes; parts of size 50 have no id."""
        order = ("l_orderkey", "o_orderdate", "o_custkey")
        # Narrow lines are summed where they met their order, then take their part's columns along,
        # so lists and documents are never shuffled. The last shuffle deals neighbouring days to
        # a task, as bronze is stored by month.
        summed = self._summed(self._lines(*order), *order, "l_partkey")
        lines = (summed.join(self._parts, "l_partkey")
                 .repartitionByRange(self._tasks, "o_orderdate", "l_orderkey"))
        page = (*order, block("l_partkey").alias("page"), block("l_suppkey").alias("block"))
        recipes = lines.groupBy(*page, "l_partkey", *PART.values(), "copies").agg(sorted_list(
            self._ingredient(F.col("l_suppkey"), F.col("quantity"))).alias("ingredients"))
        key = F.when(F.col("difficulty") != 50, F.col("l_partkey")).alias("id")
        text = F.to_json(F.struct(F.col("l_partkey").alias("n"), key, *self._attributes(),
                                  "ingredients"))
        pages = recipes.withColumn("text", text).groupBy(*order, "page", "block").agg(
            sorted_list(F.struct("l_partkey", key, *PART.values(), "text", "copies"))
            .alias("recipes"))
        texts = F.array_join(F.flatten(F.transform("recipes", lambda r: F.array_repeat(
            r["text"], r["copies"].cast("int")))), ",")
        day = F.to_date("o_orderdate")
        menu = F.to_json(F.struct(
            F.col("l_orderkey").alias("id"), F.concat(F.lit("menu/"), "l_orderkey").alias("url"),
            F.date_format(day, "yyyyMM").alias("year_week"),
            F.date_format(F.trunc(day, "month"), "yyyy-MM-dd").alias("start")))
        meta = F.to_json(F.struct((F.col("o_custkey") % 40 + 1).alias("last_page")))
        document = F.concat(
            F.lit('{"data":['), F.expr("left(menu, length(menu) - 1)"), F.lit(',"recipes":['),
            texts, F.lit(']}],"meta":'), "meta", F.lit("}"))
        return self._page(pages.withColumns({"menu": menu, "meta": meta}), "menus",
                          month_of(F.col("o_orderdate")), F.col("page") + 1, document)

    @cached_property
    def recipes(self) -> DataFrame:
        """Recipe details in the four accepted shapes, one supplier block per page."""
        ref = lambda key: F.array(F.struct(key.alias("id")))
        ingredients = F.transform("lines", lambda line: self._ingredient(
            line["l_suppkey"], line["quantity"])).alias("ingredients")
        recipe = F.struct(
            F.col("l_partkey").alias("id"), *self._attributes(), ingredients,
            ref(F.col("headline")).alias("allergens"), ref(F.col("kind")).alias("tags"),
            ref(F.concat(F.lit("size-"), "difficulty")).alias("labels"))
        shape, text = F.col("l_partkey") % 4, F.col("text")
        document = (F.when(shape == 0, F.concat(F.lit('{"data":['), text, F.lit("]}")))
                    .when(shape == 1, F.concat(F.lit('{"data":'), text, F.lit("}")))
                    .when(shape == 2, F.concat(F.lit("["), text, F.lit("]")))
                    .otherwise(text))
        lines = self._lines("month").repartition(self._tasks, "l_partkey")
        summed = self._summed(lines, "l_partkey", month=F.min("month")).join(
            self._parts, "l_partkey")
        page = ("l_partkey", block("l_suppkey").alias("block"), *PART.values(), "copies")
        pages = summed.groupBy(*page).agg(
            F.min("month").alias("month"),
            sorted_list(F.struct("l_suppkey", "quantity")).alias("lines"))
        # Dealt by month, as bronze is stored, before documents are made: each month to so many
        # tasks that none writes, and sorts, many more pages than one of menus.
        share = F.pmod(F.xxhash64("l_partkey", "block"), F.lit(self._tasks // self._months + 1))
        dealt = pages.repartition(self._tasks, "month", share)
        made = dealt.select("month", "block", "l_partkey", F.explode(F.array_repeat(
            F.to_json(recipe), F.col("copies").cast("int"))).alias("text"))
        return self._page(made, "recipes", F.col("month"), F.col("block") + 1, document)

    def _reference(self, rows: DataFrame, endpoint: str, item: Column,
                   page: Column | None = None) -> DataFrame:
        document = F.to_json(F.struct(item.alias("data")))
        return self._page(rows, endpoint, F.lit(REFERENCE_PULL),
                          F.lit(1) if page is None else page, document)

    @cached_property
    def ingredients(self) -> DataFrame:
        """Suppliers in blocks; every third carries no family, and none a type."""
        key = F.col("s_suppkey")
        nations = self.star.table("nation").select(F.col("n_nationkey").alias("s_nationkey"),
                                                   "n_name")
        rows = (self.star.table("supplier").join(nations, "s_nationkey")
                .groupBy(block("s_suppkey").alias("block")).agg(sorted_list(F.struct(
                    key.alias("n"), key.alias("id"), F.col("s_name").alias("name"),
                    F.when(key % 3 != 0, F.col("n_name")).alias("family"))).alias("items")))
        return self._reference(rows, "ingredients", F.col("items"), F.col("block") + 1)

    @cached_property
    def allergens(self) -> DataFrame:
        brand = F.col("p_brand")
        item = F.struct(brand.alias("id"), brand.alias("name"),
                        F.concat(F.lit("icons/"), brand).alias("iconPath"))
        return self._reference(self.star.table("part").select("p_brand").distinct(),
                               "allergens", F.array(item))

    @cached_property
    def tags(self) -> DataFrame:
        kind = F.col("p_type")
        item = F.struct(kind.alias("id"), kind.alias("name"), F.lit("range").alias("type"))
        return self._reference(self.star.table("part").select("p_type").distinct(), "tags",
                               F.array(item))

    @cached_property
    def labels(self) -> DataFrame:
        size = F.col("p_size")
        item = F.struct(F.concat(F.lit("size-"), size).alias("id"),
                        F.concat(F.lit("Size "), size).alias("name"),
                        F.when(size > 25, F.lit("large")).alias("description"))
        return self._reference(self.star.table("part").select("p_size").distinct(), "labels",
                               F.array(item))

    @cached_property
    def listings(self) -> DataFrame:
        """The pages of menus and recipes, made side by side: lines are shuffled to their orders
        once for both."""
        return self.menus.unionByName(self.recipes)

    @cached_property
    def references(self) -> DataFrame:
        """The pages of all other endpoints."""
        return reduce(DataFrame.unionByName, (self.ingredients, self.allergens, self.tags,
                                              self.labels))

    @cached_property
    def bronze(self) -> DataFrame:
        """All endpoints."""
        return self.listings.unionByName(self.references)
