"""Building blocks of the query library."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.plans.catalogue import Catalogue


def active(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("is_active") == 1)


def sum_where(condition: Column) -> Column:
    """Rows meeting a condition; null over no rows, like any SQL sum."""
    return F.sum(F.when(condition, 1).otherwise(0))


def top(rows: DataFrame, limit: int | None, *order: Column | str) -> DataFrame:
    """Ordered rows, cut to a report size. ``order`` must end in a unique key."""
    ordered = rows.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def stack(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def per_table(cat: Catalogue | Mapping[str, DataFrame], tables: Iterable[str], *measures: Column,
              label: str = "table_name") -> DataFrame:
    """One row of the same measures for each table, map-side combined, in one job."""
    return stack(labelled(name, cat[name].agg(*measures), label) for name in tables)


def labelled(name: str, row: DataFrame, label: str = "table_name") -> DataFrame:
    return row.select(F.lit(name).alias(label), *row.columns)


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("row_count"))


def one_row(**cells: DataFrame) -> DataFrame:
    """One row from one-cell frames: scalar subqueries, so nothing is joined."""
    (first, source), *others = cells.items()
    return source.select(F.col(source.columns[0]).alias(first),
                         *(frame.scalar().alias(name) for name, frame in others))


def links_of(links: DataFrame, key: str, owners: DataFrame, owner_key: str,
             out: str) -> DataFrame:
    """``owners`` with the number of their links. Pairs are unique, so counting rows counts
    distinct partners; links are counted before the join, which then is one row per key."""
    counts = links.groupBy(F.col(key).alias(owner_key)).agg(F.count("*").alias(out))
    return (owners.join(counts, owner_key, "left")
            .withColumn(out, F.coalesce(F.col(out), F.lit(0))))


def links_of_few(links: DataFrame, key: str, owners: DataFrame, owner_key: str, out: str,
                 chosen: DataFrame | None = None) -> DataFrame:
    """Like :func:`links_of` for owners already cut to a report size: only their links are
    kept, and AQE turns the semi join into a broadcast once it has seen how few they are.
    ``chosen`` holds the owner keys where ``owners`` has become a larger plan."""
    few = (owners if chosen is None else chosen).select(F.col(owner_key).alias(key))
    return links_of(links.join(few, key, "left_semi"), key, owners, owner_key, out)


def newest_weeks(rows: DataFrame, limit: int | None) -> DataFrame:
    return top(rows, limit, F.desc("week_start_date"))
