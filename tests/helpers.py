"""Small frames and readable results for the tests."""

from datetime import date, datetime


def day(text):
    return None if text is None else date.fromisoformat(text)


def moment(text):
    return datetime.fromisoformat(text)


def table(frame, *columns):
    """Rows as a sorted list of tuples; dates as ISO text."""
    def plain(value):
        return value.isoformat() if isinstance(value, (date, datetime)) else value

    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(plain(v) for v in row) for row in picked.collect()),
                  key=lambda row: tuple((v is None, str(v)) for v in row))


def pages(spark, *rows):
    """Bronze from (pull date, endpoint, payload[, page number]) tuples."""
    from larder.schemas import BRONZE
    stamp = moment("2026-01-01T00:00:00")
    return spark.createDataFrame(
        [(day(pull), endpoint, "en-GB", rest[0] if rest else 1, payload, stamp)
         for pull, endpoint, payload, *rest in rows], BRONZE)
