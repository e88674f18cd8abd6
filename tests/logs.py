"""Small literal logs for the tests."""

from datetime import datetime

from pulseboard.sources import FEED_SCHEMA, MESSAGE_SCHEMA


def at(text):
    return datetime.fromisoformat(text)


def feed_log(spark, rows):
    """Rows of (user, time, action[, gender, age, os])."""
    full = [(u, at(t), a, *(p or (1, 30, "iOS"))) for u, t, a, *p in rows]
    return spark.createDataFrame(full, FEED_SCHEMA)


def message_log(spark, rows):
    """Rows of (user, receiver, time[, gender, age, os])."""
    full = [(u, r, at(t), *(p or (1, 30, "iOS"))) for u, r, t, *p in rows]
    return spark.createDataFrame(full, MESSAGE_SCHEMA)


def records(frame, *order):
    return [tuple(r) for r in frame.orderBy(*(order or frame.columns)).collect()]
