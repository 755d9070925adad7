"""Contiguous shards of equal bytes, from global prefix sums.

Rows are range-partitioned into one global order; each partition is summed once, the few partition
totals are added up in order, and a row's global offset is its partition's offset plus its running
sum inside it. The byte line is then cut at equal targets. Only ids, sizes and checksums are
shuffled, never texts.

Defined results: a null text has size 1 and checksum 0; ids need not be unique: rows are ordered
by (id, checksum, size), null ids first, and rows equal in all three stand in any order; an empty
table gives no rows. The order's last key is a row number, so even a key that holds most rows is
spread over partitions. Only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import partitions, stored, text_of

ORDER = ["doc_id", "text_crc32", "size", "tie"]


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(text_of(text)) + 1).cast("long").alias("size"),
        F.crc32(text_of(text)).alias("text_crc32"))


def placed(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, ``offset`` (bytes before the row), ``shard`` and ``slot`` (the
    row's place in its shard, from 0)."""
    spark = docs.sparkSession
    dealt = sized(docs, doc_id, text).withColumn("tie", F.monotonically_increasing_id())
    # Written down once: partition numbers must not change between the two uses below.
    dealt = stored(dealt.repartitionByRange(partitions(spark), *ORDER)
                   .select("*", F.spark_partition_id().alias("part")), "sharding")
    totals = dealt.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    # One row per partition: the only window without a key sees no data rows.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    offsets = totals.select(
        "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(whole).alias("total"))
    inside = Window.partitionBy("part").orderBy(*ORDER)
    lined = dealt.select(
        "*", (F.sum("size").over(inside) - F.col("size")).alias("inside_bytes"),
        (F.row_number().over(inside) - 1).alias("inside_rows")).join(offsets, "part")
    # The middle of a row decides, so a shard misses its target by half a row at most.
    cut = lined.select(
        "doc_id", "size", "text_crc32",
        (F.col("bytes_before") + F.col("inside_bytes")).alias("offset"),
        (F.col("rows_before") + F.col("inside_rows")).alias("place"), "total").select(
        "*", F.expr(f"CAST((2 * offset + size) * {shards} DIV (2 * total) AS INT)")
              .alias("shard"))
    first = cut.groupBy("shard").agg(F.min("place").alias("first"))
    return cut.join(first, "shard").select(
        "doc_id", "size", "text_crc32", "offset", "shard",
        (F.col("place") - F.col("first")).cast("long").alias("slot"))
