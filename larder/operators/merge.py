"""Keyed merge with first-seen and last-seen dates.

The merge is a fold. Every key is reduced to one *state row*: earliest and latest pull date
and the newest attribute values together with the order they were written at (one order for
all, or one per attribute where rows may carry only some of them). ``min``,
``max`` and "newest" are associative, commutative and idempotent, so states can be combined
in any grouping: pulls may arrive late, twice or out of order and the table is the same. It
also means map-side combining: a key holding a third of all observations is reduced to one
row per task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from larder.functions.scalars import packed, unpacked

PULL = "pull_date"
FIRST, LAST, ACTIVE = "first_seen_date", "last_seen_date", "is_active"
INGESTED = "_ingestion_ts"
_VERSION = "_written_"


def has_key(*keys: Column) -> Column:
    """Key columns that hold a usable id: not null and not empty."""
    usable = F.lit(True)
    for key in keys:
        usable = usable & key.isNotNull() & (key.cast("string") != "")
    return usable


def dedupe_batch(rows: DataFrame, keys: Sequence[str], order: Sequence[str],
                 pull: str = PULL) -> DataFrame:
    """Last write wins: one row per key and pull, the greatest by ``order``.

    An aggregate over a struct instead of ``row_number``, so it combines before the shuffle.
    """
    rest = [name for name in rows.columns if name not in {*keys, pull, *order}]
    newest = F.max(F.struct(*order, *rest)).alias("_row")
    return rows.groupBy(*keys, pull).agg(newest).select(
        *keys, pull, *(F.col(f"_row.{name}").alias(name) for name in (*order, *rest)))


def fold(rows: DataFrame, keys: Sequence[str], attributes: Sequence[str],
         order: Sequence[str], pull: str = PULL, present: str | None = None,
         stamp: str | None = None) -> DataFrame:
    """Observations to state rows. ``stamp`` names the ingestion time, of which the latest is kept.

    ``order`` ranks writes within a pull (newer pulls always win). ``present`` names an
    ``array<string>`` column listing the attributes a row really carries; an attribute that
    is absent keeps its older value, one that is present as null overwrites it.
    """
    def newest(name: str) -> Column:
        at = F.struct(F.col(pull).alias("pull"), *order).alias("at")
        value = F.struct(at, F.col(name).alias("value"))
        return F.max(F.when(F.array_contains(present, name), value)).alias(_VERSION + name)

    kept = rows.filter(has_key(*(F.col(key) for key in keys))).groupBy(*keys)
    first = F.min(pull).alias(FIRST)
    stamps = [F.max(stamp).alias(INGESTED)] if stamp else []
    if present is not None:
        return kept.agg(first, F.max(pull).alias(LAST), *stamps,
                        *(newest(name) for name in attributes))
    if not attributes:
        return kept.agg(first, F.max(pull).alias(LAST), *stamps)
    # Attributes are written together, so they share one version. It is sorted and shuffled flat,
    # and as it begins with the pull date, it also tells the last one. Neighbouring texts are one.
    texts = {f.name for f in rows.schema if f.dataType == StringType()}
    flat, value = [pull, *order], {}
    for is_text, run in groupby(attributes, texts.__contains__):
        run = list(run)
        if is_text and len(run) > 2:
            value |= {name: (len(flat), at) for at, name in enumerate(run)}
            flat.append(packed(*map(F.col, run)))
        else:
            value |= {name: (len(flat) + at, None) for at, name in enumerate(run)}
            flat += run
    written = [(F.col(it) if isinstance(it, str) else it).alias(f"_{at}")
               for at, it in enumerate(flat)]
    version = lambda at: F.col(_VERSION)[f"_{at}"]
    of = lambda at, place: version(at) if place is None else unpacked(version(at), place)
    return kept.agg(first, *stamps, F.max(F.struct(*written)).alias(_VERSION)).select(
        *keys, FIRST, version(0).alias(LAST), *([INGESTED] if stamp else []), F.struct(
            F.struct(*(version(at).alias(name) for at, name in enumerate(("pull", *order))))
            .alias("at"),
            F.struct(*(of(*place).alias(name) for name, place in value.items())).alias("value"),
        ).alias(_VERSION))


def combine(*states: DataFrame) -> DataFrame:
    """Merge state rows of the same table: one shuffle on the key, no join."""
    first = states[0]
    versions = [name for name in first.columns if name.startswith(_VERSION)]
    stamps = [name for name in first.columns if name == INGESTED]
    keys = [name for name in first.columns if name not in {FIRST, LAST, *stamps, *versions}]
    everything = first
    for other in states[1:]:
        everything = everything.unionByName(other)
    return everything.groupBy(*keys).agg(
        F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST),
        *(F.max(name).alias(name) for name in (*stamps, *versions)))


def published(state: DataFrame, newest_pull: Column | None = None) -> DataFrame:
    """State rows as a silver table.

    Without ``newest_pull`` every key stays active, as in the published tables. With it, a
    key is active only if it was seen in that pull or a later one; its last seen date is kept.
    A null pull leaves every key active.
    """
    values = []
    for name in state.columns:
        if name == _VERSION:
            values.append(F.col(f"{name}.value.*"))
        elif name.startswith(_VERSION):
            values.append(F.col(f"{name}.value").alias(name.removeprefix(_VERSION)))
    keys = [name for name in state.columns
            if name not in {FIRST, LAST, INGESTED} and not name.startswith(_VERSION)]
    stamps = [name for name in state.columns if name == INGESTED]
    active = F.lit(1) if newest_pull is None else F.when(
        F.col(LAST) < newest_pull, 0).otherwise(1)
    return state.select(*keys, *values, FIRST, LAST, active.alias(ACTIVE), *stamps)


def newest_pull(rows: DataFrame, pull: str = PULL) -> Column:
    """The latest pull date of ``rows`` as a scalar subquery."""
    return rows.agg(F.max(pull)).scalar()


def upsert(current: DataFrame, batch: DataFrame, keys: Sequence[str],
           attributes: Sequence[str], order: Sequence[str], pull: str = PULL,
           present: str | None = None) -> DataFrame:
    """Merge a batch of observations into state rows; the same for entities and bridges."""
    return combine(current, fold(batch, keys, attributes, order, pull, present))


def deactivate_missing(table: DataFrame, snapshot: DataFrame, keys: Sequence[str],
                       pull: Column | None = None) -> DataFrame:
    """Set ``is_active`` to 0 for keys absent from a pull's snapshot.

    ``pull`` sets the last seen date of the closed rows; by default it keeps the last pull
    the key was seen in.
    """
    seen = snapshot.select(*keys).distinct().withColumn("_seen", F.lit(1))
    joined = table.join(seen, list(keys), "left")
    missing = F.col("_seen").isNull() & (F.col(ACTIVE) == 1)
    changes = {ACTIVE: F.when(missing, 0).otherwise(F.col(ACTIVE))}
    if pull is not None:
        changes[LAST] = F.when(missing, pull).otherwise(F.col(LAST))
    return joined.withColumns(changes).drop("_seen").select(*table.columns)
