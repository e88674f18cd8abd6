"""Operators over the two products' logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.functions import day_of


def both_products(
    feed: DataFrame, messages: DataFrame, columns: Sequence[str], day: str | None = None
) -> DataFrame:
    """Rows of both logs on top of each other, told apart by ``is_feed``.

    ``day`` names a further column with the day of each row.

    Grouping this once answers what would otherwise take one aggregation per log
    and a join of the results.
    """

    def rows(log: DataFrame, is_feed: bool) -> DataFrame:
        dated = [day_of(log).alias(day)] if day else []
        return log.select(*columns, *dated, F.lit(is_feed).alias("is_feed"))

    return rows(feed, True).unionByName(rows(messages, False))


# What n messages of a pair add to their sender and to their receiver.
_SIDES = """inline(array(
  named_struct(
    'user_id', user_id,
    'rows_sent', n,
    'messages_received', 0L,
    'messages_sent', IF(reciever_id IS NULL, 0L, n),
    'users_sent', IF(reciever_id IS NULL, 0L, 1L),
    'users_received', 0L),
  named_struct(
    'user_id', reciever_id,
    'rows_sent', 0L,
    'messages_received', n,
    'messages_sent', 0L,
    'users_sent', 0L,
    'users_received', IF(user_id IS NULL, 0L, 1L))))"""


def message_sides(messages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per person (and ``by``): messages sent and received, distinct peers on either side.

    Messages are first counted per (sender, receiver), which combines on the map
    side and spreads a busy person over all of their peers. Each pair then adds one
    row to its sender and one to its receiver, and sums finish the work: no distinct
    aggregate, no join of senders with receivers. ``rows_sent`` also counts messages
    without a receiver.
    """
    pairs = messages.groupBy(*by, "user_id", "reciever_id").agg(F.count("*").alias("n"))
    sides = pairs.selectExpr(*by, _SIDES).where("user_id IS NOT NULL")
    totals = ("rows_sent", "messages_received", "messages_sent", "users_sent", "users_received")
    return sides.groupBy(*by, "user_id").agg(*[F.sum(c).alias(c) for c in totals])
