"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import work_dir

#: What separates words: space and \t to \r, nothing else.
GAP = r"[ \t\n\x0B\f\r]+"


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """All words of a text; none for an empty one."""
    return F.filter(F.split(text, GAP), lambda w: w != "")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The same rows, written once to the shared work folder: later jobs start from the files, so
    a lost executor costs only the tasks it ran."""
    spark = frame.sparkSession
    path = work_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in short batches: what a task makes of a batch is held in memory at once. At
    the end the worker gives back what it holds for no one."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
    pa.default_memory_pool().release_unused()
