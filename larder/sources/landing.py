"""Landed JSON responses and the append-only bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.schemas import BRONZE, LANDED_LINE

PARTITIONS = ("pull_date", "endpoint")
#: Pages a file holds. Files are dealt to tasks by size, and pages compress well, so this bounds
#: the pages that a task reads, and sorts if their rows are folded.
PAGES = 150_000


def read_landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """One whole JSON response per file, laid out as
    ``pull_date=…/endpoint=…/locale=…/page-<n>.json``."""
    files = T.StructType([T.StructField("value", T.StringType()),
                          *(BRONZE[name] for name in ("pull_date", "endpoint", "locale"))])
    pages = spark.read.schema(files).text(path, wholetext=True)
    number = F.regexp_extract("_metadata.file_name", r"(\d+)\.json$", 1).try_cast("int")
    return pages.select("pull_date", "endpoint", "locale", number.alias("page_number"),
                        F.col("value").alias("payload"))


def read_landed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Many responses per file: JSON lines with the response text in ``payload``."""
    return spark.read.schema(LANDED_LINE).json(path)


def stamp(pages: DataFrame) -> DataFrame:
    """Add the UTC ingestion time and fix the column order of the bronze table."""
    now = F.to_timestamp_ntz(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()))
    return pages.withColumn("ingestion_timestamp", now).select(*BRONZE.fieldNames())


def append_bronze(pages: DataFrame, path: str, dealt: bool = False) -> None:
    """Append pages; re-pulled pages land again and are deduplicated on read.

    Rebalancing (instead of ``repartition``) keeps files large and lets AQE split a
    (pull date, endpoint) that holds most of a load over several tasks. Pages whose tasks hold few
    pull dates each are ``dealt`` already, and are written without another shuffle.
    """
    rows = stamp(pages)
    if not dealt:
        rows = rows.hint("rebalance", *PARTITIONS)
    (rows.write.mode("append").partitionBy(*PARTITIONS).option("compression", "zstd")
     .option("maxRecordsPerFile", PAGES).parquet(path))


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE).parquet(path).select(*BRONZE.fieldNames())
