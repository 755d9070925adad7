"""Row numbers inside groups that may be too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.session import work_dir


def number_within(rows: DataFrame, group: list[str], measure: str, key: str,
                  out: str) -> DataFrame:
    """``row_number`` over (group, measure desc, key) without one task per group.

    A plain window sorts each group in one task; a week with a third of all rows would sink it.
    Here the rows are dealt by ranges of (group, measure, key), whose borders Spark takes from a
    sample, so a group is cut wherever its rows are many and whatever its keys look like. Rows are
    numbered inside (range, group) and shifted by the group's rows in earlier ranges: one small row
    for each range and group. The dealt rows are written once to the shared work folder, since
    their ranges are used twice; what they are made of is planned and run once.
    """
    spark = rows.sparkSession
    home = work_dir(spark, "ranked")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *group, F.desc(measure), F.asc(key)).withColumn(
        "_part", F.spark_partition_id())
    dealt.write.parquet(home)
    dealt = spark.read.schema(dealt.schema).parquet(home)
    # Groups may be null: they are matched as texts that never are.
    cell = F.to_json(F.struct("_part", *group)).alias("_cell")
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    offsets = (dealt.groupBy("_part", *group).agg(F.count("*").alias("_n"))
               .select(cell, (F.sum("_n").over(before) - F.col("_n")).alias("_offset")))
    local = F.row_number().over(
        Window.partitionBy("_part", *group).orderBy(F.desc(measure), F.asc(key)))
    return (dealt.select("*", local.alias("_local"), cell).join(offsets, "_cell")
            .withColumn(out, (F.col("_offset") + F.col("_local")).cast("long"))
            .drop("_part", "_cell", "_local", "_offset"))
