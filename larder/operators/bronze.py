"""Selection, deduplication and audits of raw response pages."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.calendar import as_date, iso_date
from larder.session import work_dir


def latest_pull(bronze: DataFrame) -> DataFrame:
    """Pages of the newest pull. The date is a scalar subquery on the partition column, so
    only that pull's partitions are read."""
    return bronze.filter(F.col("pull_date") == bronze.agg(F.max("pull_date")).scalar())


def distinct_payloads(bronze: DataFrame) -> DataFrame:
    """Re-pulled copies of a page within a pull count once."""
    return bronze.select("pull_date", "endpoint", "payload").distinct()


def distinct_stored_payloads(bronze: DataFrame) -> DataFrame:
    """The same of pages read from Parquet files, whose place (file and row) tells copies apart.

    Only digests and places are shuffled. The places of copies are written down, so that Spark
    knows their size: a list that is small enough is broadcast and payloads go from the scan
    straight to the result, a longer one costs a single shuffle of payloads, by place and so even
    if one payload holds a third of all rows.
    """
    page, place = ["pull_date", "endpoint"], ["_file", "_row"]
    pages = bronze.select(*page, "payload", F.col("_metadata.file_path").alias("_file"),
                          F.col("_metadata.row_index").alias("_row"))
    digests = _written(pages.select(*page, F.sha2("payload", 256).alias("_digest"), *place),
                       "digests")
    first = digests.groupBy(*page, "_digest").agg(
        F.min(F.struct(*place)).alias("_first"), F.count("*").alias("_n")).filter(F.col("_n") > 1)
    d, f = digests.alias("d"), first.alias("f")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"f.{c}")) for c in (*page, "_digest")]
    copies = _written(d.join(f, same).filter(F.struct(*place) != F.col("_first")).select(*place),
                      "copies")
    return pages.join(copies, place, "left_anti").select(*page, "payload")


def _written(rows: DataFrame, purpose: str) -> DataFrame:
    path = work_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def is_json(payload: Column) -> Column:
    return F.try_parse_json(payload).isNotNull()


def well_formed(bronze: DataFrame) -> DataFrame:
    return bronze.filter(is_json(F.col("payload")))


def malformed(bronze: DataFrame) -> DataFrame:
    """Pages to quarantine: a payload that is missing or not JSON."""
    return bronze.filter(F.col("payload").isNull() | ~is_json(F.col("payload")))


PAGE = "struct<id:string,data:array<struct<id:string>>,meta:struct<last_page:int>>"
PLACE = ("pull_date", "endpoint", "locale")
_BYTE = "coalesce(cast(conv(hex(substring({}, {} + 1, 1)), 16, 10) as int), 0)"


def page_marks(bronze: DataFrame) -> DataFrame:
    """Per pull, endpoint, locale and 32,768 page numbers: a bitmap of the pages stored, the number
    announced, the highest number and the records. One scan, and one parse of pages that list
    their items under ``data``; what is shuffled is a small row for each page, then the bitmaps."""
    text = F.ltrim("payload")
    page = F.from_json(F.when(~text.startswith("["), text), PAGE)
    # Evaluated for the other shapes only: one object, a list of other things, a bare object.
    held = F.get_json_object("_text", "$.data")
    other = F.when(F.col("_text").startswith("["), F.json_array_length("_text")).when(
        held.startswith("{") | (held.isNull() & F.col("_page.id").isNotNull()), 1).otherwise(
        F.json_array_length(held))
    # Numbers below 1 name no page: they are counted among the records only.
    number = F.col("page_number")
    usable = F.when(number > 0, number)
    return (bronze.select(*PLACE, "page_number", page.alias("_page"), text.alias("_text"))
            .select(*PLACE, "page_number", F.col("_page.meta.last_page").alias("_last"),
                    F.when(F.col("_page.data").isNotNull(), F.size("_page.data")).otherwise(
                        F.coalesce(other, F.lit(0))).alias("_records"))
            # Bitmaps are aggregated by sorting, so pages are counted by hashing first.
            .groupBy(*PLACE, "page_number").agg(
                F.max("_last").alias("_last"), F.sum("_records").alias("_records"))
            .withColumn("bucket", F.bitmap_bucket_number(usable))
            .withColumn("_bit", F.bitmap_bit_position(usable))
            .groupBy(*PLACE, "bucket").agg(
                F.bitmap_construct_agg("_bit").alias("bits"), F.max("_last").alias("last_page"),
                F.max("page_number").alias("max_page"), F.sum("_records").alias("records")))


def combine_marks(*marks: DataFrame) -> DataFrame:
    """Marks of several loads. Pages marked twice count once; records are added up."""
    everything = marks[0]
    for other in marks[1:]:
        everything = everything.unionByName(other)
    return everything.groupBy(*PLACE, "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.max("last_page").alias("last_page"),
        F.max("max_page").alias("max_page"), F.sum("records").alias("records"))


def audit_of(marks: DataFrame) -> DataFrame:
    """Marks as one row for each pull, endpoint and locale, with the missing pages as ranges."""
    places = marks.groupBy(*PLACE).agg(
        F.coalesce(F.max("last_page"), F.lit(1)).alias("pages_announced"),
        F.max("max_page").alias("max_page"), F.sum("records").alias("records"),
        F.array_sort(F.collect_list(F.when(F.col("bucket").isNotNull(), F.struct(
            "bucket", "bits")))).alias("maps"))
    # Of each bitmap the part up to the last page announced.
    cut = F.expr("""transform(maps, m -> struct(m.bucket AS bucket, m.bits AS bits, cast(greatest(0,
        least(32768, pages_announced - (m.bucket - 1) * 32768)) AS int) AS upto))""")
    stored = F.expr(f"""aggregate(cut, 0L, (n, c) -> n
        + bitmap_count(substring(c.bits, 1, cast(c.upto div 8 AS int)))
        + bit_count({_BYTE.format("c.bits", "cast(c.upto div 8 AS int)")}
                    & (shiftleft(1, c.upto % 8) - 1)))""")
    present = f"""flatten(transform(cut, c -> flatten(transform(
        filter(sequence(0, 4095), i -> hex(substring(c.bits, i + 1, 1)) <> '00'),
        i -> transform(filter(sequence(0, 7), b -> i * 8 + b < c.upto AND
                              getbit({_BYTE.format("c.bits", "i")}, b) = 1),
                       b -> cast((c.bucket - 1) * 32768 + i * 8 + b + 1 AS int))))))"""
    ends = F.expr(f"concat(array(0), {present}, array(pages_announced + 1))")
    holes = F.expr("""filter(transform(sequence(1, size(ends) - 1), i -> struct(
        ends[i - 1] + 1 AS first, ends[i] - 1 AS last)), h -> h.first <= h.last)""")
    complete = F.col("pages_stored") >= F.col("pages_announced")
    return (places.withColumn("cut", cut).withColumn("pages_stored", stored)
            .withColumn("ends", F.when(~complete, ends)).select(
        *PLACE, "pages_stored", "pages_announced", "max_page", "records",
        complete.alias("is_complete"),
        F.coalesce(holes, F.expr("cast(array() AS array<struct<first: int, last: int>>)"))
        .alias("missing")))


def page_audit(bronze: DataFrame) -> DataFrame:
    """Per pull, endpoint and locale: distinct pages stored of those announced, the highest page
    number, the records of all responses, and the missing pages as ranges.

    A response without ``meta.last_page`` announces one page; an empty page counts as stored, a
    second response of a page does not. A null pull, endpoint or locale is a place like any other,
    a page without a number counts among the records only. Records are counted in all accepted
    shapes: a list or one object under ``data``, a bare list, a bare object with an id.
    """
    return audit_of(page_marks(bronze))


def newest_complete_pull(audit: DataFrame, endpoints: Sequence[str]) -> Column:
    """The latest pull in which everything audited of these endpoints is complete, as a scalar
    subquery: null if there is none."""
    pulls = audit.filter(F.col("endpoint").isin(*endpoints)).groupBy("pull_date").agg(
        F.bool_and("is_complete").alias("whole"))
    return pulls.filter("whole").agg(F.max("pull_date")).scalar()


def summary(bronze: DataFrame) -> DataFrame:
    """Responses stored per endpoint."""
    return bronze.groupBy("endpoint").agg(F.count("*").alias("responses"))


def in_window(menus: DataFrame, start: date | str, end: date | str,
              column: str = "start") -> DataFrame:
    """Menus starting within [start, end]; a missing or unreadable start date is kept."""
    day = iso_date(F.col(column))
    return menus.filter(day.isNull() | day.between(as_date(start), as_date(end)))
