"""Every registered query: a name, a Spark callable and (mostly) an independent DuckDB oracle."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.model import over_model
from larder.plans import Catalogue
from larder.schemas import SILVER
from larder.session import work_dir
from larder.sources.star import AS_OF, StarMenus

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def per_session(build: Callable) -> Callable:
    """Call ``build(spark, *arguments)`` once per Spark application and arguments."""
    made: dict = {}

    @functools.wraps(build)
    def remembered(spark: SparkSession, *arguments):
        key = (spark.sparkContext.applicationId, spark.sparkContext.startTime, *arguments)
        if key not in made:
            made[key] = build(spark, *arguments)
        return made[key]

    return remembered


@per_session
def catalogue(spark: SparkSession, sf_dir: str, compat: bool = False) -> Catalogue:
    return Catalogue(StarMenus(spark, sf_dir).builders(), as_of=AS_OF, compat=compat)


def register(name: str, build: Callable[[SparkSession, str], DataFrame],
             sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"registered twice: {name}")
    QUERIES[name] = build
    if sql is not None:
        ORACLES[name] = over_model(sql)


@per_session
def stored_catalogue(spark: SparkSession, sf_dir: str) -> Catalogue:
    """The same tables as the query library expects them, stored: silver and gold tables are
    published on first use and then read back."""
    home = work_dir(spark, "catalogue")
    star = StarMenus(spark, sf_dir, lambda: silver.recipes)
    silver = Catalogue(star.builders(), as_of=AS_OF).storing_silver(home)
    return silver.storing_gold(home)


def on_catalogue(name: str, build: Callable[[Catalogue], DataFrame],
                 sql: str | None = None) -> None:
    """Register a query of the library: silver tables and stored gold tables."""
    register(name, lambda spark, sf_dir: build(stored_catalogue(spark, sf_dir)), sql)


def on_silver(name: str, build: Callable[[Catalogue], DataFrame], sql: str | None = None,
              compat: bool = False) -> None:
    """Register a query that plans its gold tables from silver, anew each time: a ranking writes its
    rows down when it is planned, which is part of the query."""
    def planned(spark: SparkSession, sf_dir: str) -> DataFrame:
        known = catalogue(spark, sf_dir, compat)
        silver = {name: (lambda n=name: known[n]) for name in SILVER}
        return build(Catalogue(silver, known.as_of, known.locale, compat))

    register(name, planned, sql)
