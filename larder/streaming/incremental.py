"""The incremental load as a Structured Streaming job.

Each micro-batch of landed pages is folded and appended to the silver state as a delta. A commit
names the checkpoint by the id inside it, the batch, and the plan of offsets the checkpoint holds for
that batch. A batch replayed after a lost driver has the same three and is written once, on whatever
the warehouse holds by then; a checkpoint made anew at the same path, or put back from a copy and
run on, gives its batches to new rows and has others. Because the merge is idempotent and
order-free, no watermark is needed and backfilled pulls land correctly.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.plans.silver import Warehouse, append_state
from larder.schemas import BRONZE, SILVER
from larder.sources.published import Load, PublishedTable


def bronze_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New bronze files as they are committed."""
    return (spark.readStream.schema(BRONZE)
            .option("maxFilesPerTrigger", files_per_batch).parquet(path))


def load_of(spark: SparkSession, checkpoint: str, batch: int) -> Load:
    """The identity of a batch, from what its checkpoint wrote down before the batch began. The plan
    of offsets holds the time it was made, so no two plans are the same."""
    def text(name: str) -> str:
        return spark.read.text(f"{checkpoint.rstrip('/')}/{name}", wholetext=True).first()[0]

    return Load(json.loads(text("metadata"))["id"], batch, text(f"offsets/{batch}"))


def _drain(stream: DataFrame, each: Callable[[DataFrame, Load], None], checkpoint: str) -> None:
    spark = stream.sparkSession
    query = (stream.writeStream.foreachBatch(
        lambda batch, number: each(batch, load_of(spark, checkpoint, number)))
        .trigger(availableNow=True).option("checkpointLocation", checkpoint).start())
    query.awaitTermination()


def merge_stream(stream: DataFrame, fold: Callable[[DataFrame], DataFrame],
                 table: PublishedTable, checkpoint: str) -> None:
    """Merge everything available into one state table, then stop."""
    _drain(stream, lambda batch, load: append_state(table, fold(batch), load), checkpoint)


def silver_stream(stream: DataFrame, warehouse: Warehouse, checkpoint: str,
                  tables: tuple[str, ...] = SILVER) -> None:
    """Merge everything available into the silver tables, then stop."""
    _drain(stream, lambda batch, load: warehouse.append(batch, tables, load), checkpoint)
