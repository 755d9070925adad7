"""Keyed merge and version history, on users observed daily in ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import register
from larder.operators import history, merge
from larder.sources.star import StarMenus

USER = ["user_id"]
LINK = ["user_id", "event_type"]
ATTRS = ["event_type", "value"]
ORDER = ["ts", "event_id"]

DAYS = "SELECT *, ts::DATE AS pull_date FROM events"
NEWEST = f"(SELECT max(pull_date) FROM ({DAYS}))"


def seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return StarMenus(spark, sf_dir).observations


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Everything before the newest pull, and the newest pull."""
    newest = merge.newest_pull(rows)
    return rows.filter(F.col("pull_date") < newest), rows.filter(F.col("pull_date") == newest)


def upserted(rows: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    earlier, latest = split(rows)
    state = merge.fold(earlier, keys, attributes, ORDER)
    return merge.upsert(state, latest, keys, attributes, ORDER)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = seen(spark, sf_dir).select("user_id", "pull_date", *ORDER, *ATTRS[:1])
    return merge.dedupe_batch(rows, USER, ORDER)


def versions(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return history.version_history(daily(spark, sf_dir), USER, ["event_type"],
                                   pulls=seen(spark, sf_dir), **options)


register(
    "scd_dedupe_batch",
    lambda spark, sf: merge.dedupe_batch(
        seen(spark, sf).select("user_id", "pull_date", "event_type", "ts", "event_id", "value"),
        USER, ["event_type", "ts", "event_id"]),
    f"""SELECT user_id, pull_date, event_type, ts, event_id, value FROM ({DAYS})
        QUALIFY row_number() OVER (PARTITION BY user_id, pull_date
                                   ORDER BY event_type DESC, ts DESC, event_id DESC) = 1""")

LATEST_USERS = f"""
    SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type,
           arg_max(value, (ts, event_id)) AS value, min(pull_date) AS first_seen_date,
           max(pull_date) AS last_seen_date, {{active}} AS is_active
    FROM ({DAYS}) GROUP BY user_id"""

register("scd_upsert_entity",
         lambda spark, sf: merge.published(upserted(seen(spark, sf), USER, ATTRS)),
         LATEST_USERS.format(active="1"))
register(
    "scd_upsert_bridge",
    lambda spark, sf: merge.published(upserted(seen(spark, sf), LINK, ["value"])),
    f"""SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value,
               min(pull_date) AS first_seen_date, max(pull_date) AS last_seen_date,
               1 AS is_active
        FROM ({DAYS}) GROUP BY user_id, event_type""")
register("first_last_seen",
         lambda spark, sf: merge.published(merge.fold(seen(spark, sf), USER, ATTRS, ORDER)),
         LATEST_USERS.format(active="1"))


def patched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value`` is only carried by purchases, ``props`` by all but errors."""
    kind = F.col("event_type")
    carried = F.array_compact(F.array(
        F.when(kind == "purchase", F.lit("value")), F.when(kind != "error", F.lit("props"))))
    rows = seen(spark, sf_dir).withColumn("carried", carried)
    earlier, latest = split(rows)
    state = merge.fold(earlier, USER, ["value", "props"], ORDER, present="carried")
    return merge.published(merge.upsert(state, latest, USER, ["value", "props"], ORDER,
                                        present="carried"))


register(
    "scd_patch", patched,
    f"""SELECT user_id,
               arg_max(value, (ts, event_id)) FILTER (event_type = 'purchase') AS value,
               arg_max(props, (ts, event_id)) FILTER (event_type <> 'error') AS props,
               min(pull_date) AS first_seen_date, max(pull_date) AS last_seen_date,
               1 AS is_active
        FROM ({DAYS}) GROUP BY user_id""")


def deactivated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = seen(spark, sf_dir)
    table = merge.published(merge.fold(rows, USER, ATTRS, ORDER))
    return merge.deactivate_missing(table, split(rows)[1], USER)


register("scd_deactivate", deactivated,
         LATEST_USERS.format(active=f"(max(pull_date) = {NEWEST})::INTEGER"))

# Versions, counted by walking runs of (day rank - row rank) per value.
DAILY = f"""
    SELECT user_id, pull_date, arg_max(event_type, (ts, event_id)) AS event_type,
           dense_rank() OVER (ORDER BY pull_date) AS day_no
    FROM ({DAYS}) GROUP BY user_id, pull_date"""
CALENDAR = f"""
    SELECT pull_date AS d, lead(pull_date) OVER (ORDER BY pull_date) AS next_d
    FROM (SELECT DISTINCT pull_date FROM ({DAYS}))"""
HISTORY = f"""
    SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY valid_from) AS version,
           event_type, valid_from, next_d AS valid_to, last_seen_date,
           (next_d IS NULL)::INTEGER AS is_active
    FROM (SELECT user_id, event_type, min(pull_date) AS valid_from,
                 max(pull_date) AS last_seen_date
          FROM (SELECT *, day_no - row_number() OVER (
                           PARTITION BY user_id, event_type ORDER BY pull_date) AS run
                FROM ({DAILY}))
          GROUP BY user_id, event_type, run)
    JOIN ({CALENDAR}) ON d = last_seen_date"""

register("scd2_history", versions, HISTORY)


def late_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of every other pull, with the pulls between added afterwards."""
    rows, days = daily(spark, sf_dir), seen(spark, sf_dir)
    early = F.dayofmonth("pull_date") % 2 == 0
    made = history.version_history(rows.filter(early), USER, ["event_type"],
                                   pulls=days.filter(early))
    return history.splice_history(made, rows.filter(~early), USER, ["event_type"],
                                  days.filter(early), pulls=days.filter(~early))


register("scd2_late_pulls", late_pulls, HISTORY)
register(
    "scd2_history_changes_only",
    lambda spark, sf: versions(spark, sf, close_missing=False),
    f"""SELECT user_id, row_number() OVER w AS version, event_type, valid_from,
               lead(valid_from) OVER w AS valid_to, last_seen_date,
               (lead(valid_from) OVER w IS NULL)::INTEGER AS is_active
        FROM (SELECT user_id, event_type, min(pull_date) AS valid_from,
                     max(pull_date) AS last_seen_date
              FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pull_date)
                              - row_number() OVER (PARTITION BY user_id, event_type
                                                   ORDER BY pull_date) AS run
                    FROM ({DAILY}))
              GROUP BY user_id, event_type, run)
        WINDOW w AS (PARTITION BY user_id ORDER BY valid_from)""")
register("scd2_current", lambda spark, sf: history.current_versions(versions(spark, sf)),
         f"SELECT * FROM ({HISTORY}) WHERE valid_to IS NULL")
register(
    "scd2_as_of", lambda spark, sf: history.versions_as_of(versions(spark, sf), "2024-01-15"),
    f"""SELECT * FROM ({HISTORY}) WHERE valid_from <= DATE '2024-01-15'
        AND (valid_to IS NULL OR valid_to > DATE '2024-01-15')""")
register(
    "scd2_as_of_inclusive",
    lambda spark, sf: history.versions_as_of(versions(spark, sf), "2024-01-15", True),
    f"""SELECT * FROM ({HISTORY}) WHERE valid_from <= DATE '2024-01-15'
        AND (valid_to IS NULL OR valid_to >= DATE '2024-01-15')""")
register("scd2_lifetimes", lambda spark, sf: history.closed_lifetimes(
    versions(spark, sf), USER),
         f"""SELECT *, (valid_to - valid_from)::INTEGER AS days_active FROM ({HISTORY})
             WHERE valid_to IS NOT NULL""")
register(
    "scd2_changes",
    lambda spark, sf: history.attribute_changes(versions(spark, sf), USER, "event_type"),
    f"""SELECT o.user_id, o.event_type AS old_event_type, n.event_type AS new_event_type,
               n.valid_from AS change_date
        FROM ({HISTORY}) o JOIN ({HISTORY}) n
          ON n.user_id = o.user_id AND n.valid_from = o.valid_to
        WHERE n.event_type <> o.event_type""")
