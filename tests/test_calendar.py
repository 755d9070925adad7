import pytest
from pyspark.sql import functions as F

from larder.functions import calendar
from tests.helpers import table


def windows(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    window = calendar.week_window(F.col("text"))
    return {r[0]: (r[1] and str(r[1]), r[2] and str(r[2])) for r in rows.select(
        "text", window["start"], window["end"]).collect()}


def test_week_selectors(spark):
    found = windows(spark, ["2026-W05", "2026-W01", "2026-W52", "2026-W00", "2026-W53",
                            "2026-W5", "2026-01-12", "2026-01-16", "2024-02-29"])
    assert found == {
        "2026-W05": ("2026-01-26", "2026-02-01"),
        "2026-W01": ("2025-12-29", "2026-01-04"),
        "2026-W52": ("2026-12-21", "2026-12-27"),
        "2026-W00": ("2025-12-22", "2025-12-28"),
        "2026-W53": ("2026-12-28", "2027-01-03"),
        "2026-W5": ("2026-01-26", "2026-02-01"),
        "2026-01-12": ("2026-01-12", "2026-01-18"),
        "2026-01-16": ("2026-01-12", "2026-01-18"),
        "2024-02-29": ("2024-02-26", "2024-03-03"),
    }


@pytest.mark.parametrize("text", ["2026W05", "2026/01/15", "2026-13-01", "2026-02-30",
                                  "20260115"])
def test_unreadable_selectors_fail(spark, text):
    with pytest.raises(Exception, match="not a week or date"):
        windows(spark, [text])


def test_a_missing_selector_has_no_bounds(spark):
    assert windows(spark, [None]) == {None: (None, None)}


def test_every_day_of_a_week_gives_the_same_bounds(spark):
    days = spark.range(7).select(F.date_add(F.lit("2026-01-12").cast("date"),
                                            F.col("id").cast("int")).alias("d"))
    assert table(days.select(calendar.week_start(F.col("d")).alias("m"),
                             calendar.week_end(F.col("d")).alias("s")).distinct()) == [
        ("2026-01-12", "2026-01-18")]


def test_next_week_never_starts_today(spark):
    days = spark.sql("SELECT explode(array(DATE '2026-01-12', DATE '2026-01-18')) AS d")
    assert table(days.select(calendar.next_week_start(F.col("d")).alias("n")).distinct()) == [
        ("2026-01-19",)]


def test_date_window(spark):
    window = calendar.date_window(F.lit("2026-01-15"), F.lit("2026-03-15"))
    row = spark.range(1).select(window.alias("w")).select(F.datediff("w.end", "w.start")).first()
    assert row[0] == 59


@pytest.mark.parametrize("bounds", [("2026-03-15", "2026-01-15"), ("x", "2026-01-15")])
def test_bad_date_window_fails(spark, bounds):
    window = calendar.date_window(*(F.lit(b) for b in bounds))
    with pytest.raises(Exception, match="not a date range"):
        spark.range(1).select(window.alias("w")).collect()
