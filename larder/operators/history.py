"""Versioned history of keyed observations.

Input is one row per key and pull (:func:`larder.operators.merge.dedupe_batch`), so a window
over one key holds at most one row per pull date: its size is bounded by the calendar, not by
how often a key was observed.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.calendar import as_date
from larder.operators.merge import PULL

FROM, TO = "valid_from", "valid_to"


def pull_calendar(rows: DataFrame, pull: str = PULL) -> DataFrame:
    """Each pull date with the one after it (null for the newest)."""
    following = Window.partitionBy(F.lit(0)).orderBy(pull)
    return rows.select(pull).distinct().withColumn("_next_pull",
                                                   F.lead(pull).over(following))


def version_history(daily: DataFrame, keys: Sequence[str], attributes: Sequence[str],
                    pull: str = PULL, close_missing: bool = True,
                    pulls: DataFrame | None = None) -> DataFrame:
    """One row per version: attributes, ``valid_from``, ``valid_to`` and ``last_seen_date``.

    A version ends at the pull where an attribute differs (nulls compare equal) or, with
    ``close_missing``, at the first pull that lacks the key; a key that comes back starts a
    new version. ``valid_to`` is exclusive and null while the version is open. ``pulls`` are rows
    to take the pull dates from, such as those before deduplication, so that ``daily`` is planned
    once.
    """
    timeline = Window.partitionBy(*keys).orderBy(pull)
    values = F.struct(*attributes) if attributes else F.lit(1)
    starts = F.lag(pull).over(timeline).isNull() | ~values.eqNullSafe(
        F.lag(values).over(timeline))
    if close_missing:
        daily = daily.join(pull_calendar(daily if pulls is None else pulls, pull), pull)
        starts = starts | (F.lag("_next_pull").over(timeline) != F.col(pull))
    numbered = daily.withColumn("_starts", F.when(starts, 1).otherwise(0)).withColumn(
        "version", F.sum("_starts").over(timeline))
    ends = F.max("_next_pull") if close_missing else F.lit(None).cast("date")
    # Attributes are constant inside a version, so grouping by them adds no rows.
    versions = numbered.groupBy(*keys, "version", *attributes).agg(
        F.min(pull).alias(FROM), F.max(pull).alias("last_seen_date"), ends.alias(TO))
    if close_missing:
        # The newest observation of a still open version has no next pull.
        versions = versions.withColumn(
            TO, F.when(F.col(TO) > F.col("last_seen_date"), F.col(TO)))
    else:
        order = Window.partitionBy(*keys).orderBy("version")
        versions = versions.withColumn(TO, F.lead(FROM).over(order))
    return versions.select(*keys, "version", *attributes, FROM, TO, "last_seen_date",
                           F.when(F.col(TO).isNull(), 1).otherwise(0).alias("is_active"))


def splice_history(history: DataFrame, daily: DataFrame, keys: Sequence[str],
                   attributes: Sequence[str], known: DataFrame, pull: str = PULL,
                   pulls: DataFrame | None = None) -> DataFrame:
    """A closing history (``close_missing``) with pulls added that may lie anywhere in time; equal to
    the history of all pulls made anew.

    ``known`` are rows with the pull dates the history was made of, ``daily`` the added rows (one per
    key and pull), ``pulls`` rows with their pull dates (by default ``daily``; a pull without any row
    closes all keys). A row for a key and date that the history has already replaces it.

    Versions closed before the first added pull pass through. The others are cut only where
    something is added, never spread over their pulls: at a new date, which a key lacks until it has
    a row there, and at the dates of the key's own rows. Pieces and rows that follow each other
    without a pull between and have the same values are then joined. A key's pieces are at most
    its versions and twice the added pulls.

    A history of changes only cannot be spliced: it does not tell when a key was seen inside a
    version.
    """
    added = daily if pulls is None else pulls
    dates = lambda rows: rows.agg(F.array_sort(F.collect_set(pull))).scalar()
    after = lambda calendar, day: F.array_min(F.filter(calendar, lambda d: d > day))
    before = lambda calendar, day: F.array_max(F.filter(calendar, lambda d: d < day))
    closed = F.coalesce(F.col(TO) < added.agg(F.min(pull)).scalar(), F.lit(False))
    told = daily.groupBy(*keys).agg(F.collect_set(pull).alias("_told"))

    # Which dates cut a run of pulls [valid_from, last_seen_date], and what is left of it.
    known_dates, run_start, run_end = F.col("_known"), F.col(FROM), F.col("last_seen_date")
    fresh = F.filter(F.array_except("_added", "_known"), lambda d: d.between(run_start, run_end))
    own = F.filter(F.coalesce("_told", F.array().cast("array<date>")),
                   lambda d: d.between(run_start, run_end))
    starts = F.concat(F.array(run_start),
                      F.transform("_cuts", lambda d: after(known_dates, d)))
    ends = F.concat(F.transform("_cuts", lambda d: before(known_dates, d)), F.array(run_end))
    runs = (history.filter(~closed).join(told, list(keys), "left")
            .withColumn("_known", dates(known)).withColumn("_added", dates(added))
            .withColumn("_cuts", F.array_sort(F.array_union(fresh, own)))
            .withColumn("_pieces", F.filter(
                F.arrays_zip(starts.alias("start"), ends.alias("end")),
                lambda piece: piece["start"] <= piece["end"]))
            .select(*keys, *attributes, F.explode("_pieces").alias("_piece"))
            .select(*keys, *attributes, F.col("_piece.start").alias("_start"),
                    F.col("_piece.end").alias("_end")))
    points = daily.select(*keys, *attributes, F.col(pull).alias("_start"),
                          F.col(pull).alias("_end"))

    timeline = Window.partitionBy(*keys).orderBy("_start")
    values = F.struct(*attributes) if attributes else F.lit(1)
    joins = values.eqNullSafe(F.lag(values).over(timeline)) & (
        F.lag("_next").over(timeline) == F.col("_start"))
    numbered = (runs.unionByName(points)
                .withColumn("_known", dates(known)).withColumn("_added", dates(added))
                .withColumn("_all", F.array_union("_known", "_added"))
                .withColumn("_next", after(F.col("_all"), F.col("_end"))).drop("_all")
                .withColumn("_joins", F.lag("_start").over(timeline).isNotNull() & joins)
                .withColumn("_place", F.sum(F.when(F.col("_joins"), 0).otherwise(1))
                            .over(timeline)))
    spliced = numbered.groupBy(*keys, "_place", *attributes).agg(
        F.min("_start").alias(FROM), F.max("_end").alias("last_seen_date"),
        F.max_by("_next", "_end").alias(TO))
    # Numbers go on from the versions that passed through.
    passed = history.filter(closed)
    base = passed.join(spliced.select(*keys).distinct(), list(keys), "left_semi").groupBy(
        *keys).agg(F.max("version").alias("_base"))
    renewed = spliced.join(base, list(keys), "left").withColumn(
        "version", F.coalesce("_base", F.lit(0)) + F.col("_place")).withColumn(
        "is_active", F.when(F.col(TO).isNull(), 1).otherwise(0))
    return passed.unionByName(renewed.select(*passed.columns))


def current_versions(history: DataFrame) -> DataFrame:
    """Open versions."""
    return history.filter(F.col("is_active") == 1)


def versions_as_of(history: DataFrame, day: Column | date | str,
                   inclusive: bool = False) -> DataFrame:
    """Versions valid on a day. Half-open by default; ``inclusive`` also keeps a version on
    its closing day, so two versions match on a change date."""
    day = as_date(day)
    ends = F.coalesce(F.col(TO), F.lit("9999-12-31").cast("date"))
    return history.filter((F.col(FROM) <= day) & (day <= ends if inclusive else day < ends))


def closed_lifetimes(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Days between opening and closing of every closed version, longest first. The order
    ends in the unique key, or a sort could not split the many versions of equal length."""
    return (history.filter(F.col("is_active") == 0)
            .withColumn("days_active", F.datediff(TO, FROM))
            .orderBy(F.desc("days_active"), *keys, "version"))


def attribute_changes(history: DataFrame, keys: Sequence[str], attribute: str,
                      nulls: bool = True) -> DataFrame:
    """Old and new value wherever one version directly follows another with a new value. Without
    ``nulls``, changes to and from null are left out."""
    order = Window.partitionBy(*keys).orderBy("version")
    following = F.lead(F.struct(FROM, attribute)).over(order)
    old, new = F.col(attribute), F.col(f"_following.{attribute}")
    return (history.withColumn("_following", following)
            .filter((F.col(f"_following.{FROM}") == F.col(TO))
                    & (~new.eqNullSafe(old) if nulls else new != old))
            .select(*keys, F.col(attribute).alias(f"old_{attribute}"),
                    F.col(f"_following.{attribute}").alias(f"new_{attribute}"),
                    F.col(TO).alias("change_date")))
