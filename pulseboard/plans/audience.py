"""How many people use which product, and how many are new."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.functions import Moment, Span, history, last_days, rows_in
from pulseboard.operators import both_products, first_seen
from pulseboard.operators.bands import BUCKET
from pulseboard.operators.bitmaps import size_of, union_of
from pulseboard.operators.sketches import LG_SIZE, error_bound, estimate, merged

_WORD = 63  # days kept in one bigint


def _some(masks: list[Column]) -> Column:
    return reduce(lambda x, y: x | y, [m != 0 for m in masks])


def audience_daily(feed: DataFrame, messages: DataFrame, as_of: Moment, days: int = 7) -> DataFrame:
    """Users per day of the feed, of the messenger, and feed users who sent a message on any day.

    Per user the active days of each product become bits of a number. One shuffle of
    one small row per user (and map task) then gives all three exact counts; the
    logs are not joined. Only days on which all three counts exist are returned.
    """
    span = last_days(as_of, days)
    rows = both_products(rows_in(feed, span), rows_in(messages, span), ["user_id"], day="date")
    rows = rows.where("user_id IS NOT NULL").withColumn(
        "_day", F.datediff("date", F.lit(span.first_day))
    )
    words = range((days + _WORD - 1) // _WORD)
    word_of_day = F.expr(f"int(_day div {_WORD})")
    bit_of_day = F.col("_day") % _WORD
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit_of_day)

    def masks(product: Column, name: str) -> list[Column]:
        in_word = [product & (word_of_day == w) if len(words) > 1 else product for w in words]
        return [
            F.coalesce(F.bit_or(F.when(cond, bit)), F.lit(0).cast("bigint")).alias(f"{name}{w}")
            for w, cond in zip(words, in_word, strict=True)
        ]

    per_user = rows.groupBy("user_id").agg(
        *masks(F.col("is_feed"), "_feed"), *masks(~F.col("is_feed"), "_msg")
    )
    feed_words = [F.col(f"_feed{w}") for w in words]
    msg_words = [F.col(f"_msg{w}") for w in words]

    def active(masks: list[Column]) -> Column:
        word = F.get(F.array(*masks), word_of_day) if len(masks) > 1 else masks[0]
        return F.call_function("getbit", word, bit_of_day) == 1

    user_days = per_user.withColumn("_day", F.explode(F.sequence(F.lit(0), F.lit(days - 1))))
    return (
        user_days.groupBy(F.date_add(F.lit(span.first_day), F.col("_day")).alias("date"))
        .agg(
            F.count_if(active(feed_words)).alias("feed_users"),
            F.count_if(active(msg_words)).alias("message_users"),
            F.count_if(active(feed_words) & _some(msg_words)).alias("feed_message_users"),
        )
        .where("feed_message_users > 0 AND message_users > 0")
    )


def new_users_daily(
    feed: DataFrame, messages: DataFrame, as_of: Moment, days: int = 7, seen: DataFrame | None = None
) -> DataFrame:
    """Users by the day they were first seen in the feed, in the messenger, in both.

    Someone new in both products within the window counts on the day of their first
    message. First-seen days need all history: computed from the logs, or taken from
    ``seen``, a table kept up to date with ``merge_first_seen``.
    """
    span = last_days(as_of, days)
    if seen is None:
        # Rows after the window cannot make anyone new inside it.
        past = history(as_of)
        seen = first_seen(rows_in(feed, past), rows_in(messages, past))
    window = f"BETWEEN DATE '{span.first_day}' AND DATE '{span.last_day}'"
    feed_new, msg_new = f"feed_first {window}", f"msg_first {window}"
    arrivals = f"""inline(array(
      named_struct('date', IF({feed_new}, feed_first, NULL),
        'feed_new_users', 1L, 'msg_new_users', 0L, 'feed_msg_new_users', 0L),
      named_struct('date', IF({msg_new}, msg_first, NULL),
        'feed_new_users', 0L, 'msg_new_users', 1L,
        'feed_msg_new_users', IF({feed_new}, 1L, 0L))))"""
    counts = ("feed_new_users", "msg_new_users", "feed_msg_new_users")
    return (
        seen.where(f"user_id IS NOT NULL AND ({feed_new} OR {msg_new})")
        .selectExpr(arrivals)
        .where("date IS NOT NULL")
        .groupBy("date")
        .agg(*[F.sum(c).alias(c) for c in counts])
    )


def _kept_days(kept: DataFrame, span: Span) -> DataFrame:
    return kept.where(f"date BETWEEN DATE '{span.first_day}' AND DATE '{span.last_day}'")


def active_users(
    bitmaps: DataFrame, as_of: Moment, days: Sequence[int] = (1, 7, 30), by: Sequence[str] = ()
) -> DataFrame:
    """Users active in the last 1, 7, 30 days (any spans): of the feed, of the messenger, of both, of either.

    From the rows of :func:`pulseboard.operators.bitmaps.audience_bitmaps`; no log is read, and the
    days of the longest span are read once.
    """
    longest = last_days(as_of, max(days))
    spans = F.array(*[F.lit(n) for n in sorted(set(days))])
    age = F.datediff(F.lit(longest.last_day), F.col("date"))
    rows = _kept_days(bitmaps, longest).withColumn("days", F.explode(F.filter(spans, lambda n: n > age)))
    feed, message = F.col("is_feed"), ~F.col("is_feed")
    # Bitmaps are made where sums of counts are wanted, one bucket at a time.
    counts = rows.groupBy("days", *by, "bucket").agg(
        size_of(union_of(F.col("users"), feed)).alias("feed_users"),
        size_of(union_of(F.col("users"), message)).alias("message_users"),
        size_of(union_of(F.col("users"))).alias("users"),
    )
    return counts.groupBy("days", *by).agg(
        F.sum("feed_users").alias("feed_users"),
        F.sum("message_users").alias("message_users"),
        F.sum(F.col("feed_users") + F.col("message_users") - F.col("users")).alias("feed_message_users"),
        F.sum("users").alias("users"),
    )


def audience_daily_kept(bitmaps: DataFrame, as_of: Moment, days: int = 7) -> DataFrame:
    """What :func:`audience_daily` tells, from kept bitmaps instead of the logs.

    Feed users of a day who sent a message on any day are counted as the feed's users plus the span's
    senders less their union, bucket by bucket.
    """
    span = last_days(as_of, days)
    rows = _kept_days(bitmaps, span)
    senders = rows.where("NOT is_feed").groupBy("bucket").agg(union_of(F.col("users")).alias("users"))
    each_day = F.explode(F.sequence(F.lit(span.first_day), F.lit(span.last_day))).alias("date")
    stacked = rows.select("date", "bucket", F.when(F.col("is_feed"), "feed").otherwise("message").alias("kind"), "users").unionByName(
        senders.select(each_day, "bucket", F.lit("sender").alias("kind"), "users")
    )
    users, kind = F.col("users"), F.col("kind")
    counts = stacked.groupBy("date", "bucket").agg(
        size_of(union_of(users, kind == "feed")).alias("feed_users"),
        size_of(union_of(users, kind == "message")).alias("message_users"),
        size_of(union_of(users, kind == "sender")).alias("senders"),
        size_of(union_of(users, kind != "message")).alias("either"),
    )
    return (
        counts.groupBy("date")
        .agg(
            F.sum("feed_users").alias("feed_users"),
            F.sum("message_users").alias("message_users"),
            F.sum(F.col("feed_users") + F.col("senders") - F.col("either")).alias("feed_message_users"),
        )
        .where("feed_message_users > 0 AND message_users > 0")
    )


def audience_exact(feed: DataFrame, messages: DataFrame, as_of: Moment, days: int = 7) -> DataFrame:
    """Per day the users of the feed, of the messenger, and those who used both on that day."""
    span = last_days(as_of, days)
    rows = both_products(rows_in(feed, span), rows_in(messages, span), ["user_id"], day="date")
    per_user = (
        rows.where("user_id IS NOT NULL")
        .groupBy("date", "user_id")
        .agg(F.max("is_feed").alias("feed"), F.max(~F.col("is_feed")).alias("message"))
    )
    return per_user.groupBy("date").agg(
        F.count_if("feed").alias("feed_users"),
        F.count_if("message").alias("message_users"),
        F.count_if(F.col("feed") & F.col("message")).alias("both_users"),
    )


def audience_estimates(sketches: DataFrame, as_of: Moment, days: int = 7, lg_size: int = LG_SIZE) -> DataFrame:
    """Per day estimates of the feed's users, the messenger's and those who used both on that day, each with
    the bound of its error; from rows of :func:`pulseboard.operators.sketches.audience_sketches`."""
    span = last_days(as_of, days)
    date = F.to_date(BUCKET).alias("date")
    of_span = f"date BETWEEN DATE '{span.first_day}' AND DATE '{span.last_day}'"
    users = F.col("users")
    daily = (
        sketches.select(date, "is_feed", "users")
        .where(of_span)
        .groupBy("date")
        .agg(
            merged(F.when(F.col("is_feed"), users), lg_size).alias("feed"),
            merged(F.when(~F.col("is_feed"), users), lg_size).alias("message"),
            merged(users, lg_size).alias("either"),
        )
    )
    both = F.theta_intersection("feed", "message")
    told = daily.select(
        "date",
        estimate(F.col("feed")).alias("feed_users"),
        estimate(F.col("message")).alias("message_users"),
        estimate(both).alias("both_users"),
        estimate(F.col("either")).alias("_either"),
    )
    return told.select(
        "date",
        *[F.col(c).cast("long").alias(c) for c in ("feed_users", "message_users", "both_users")],
        error_bound(F.col("feed_users"), lg_size).alias("feed_error"),
        error_bound(F.col("message_users"), lg_size).alias("message_error"),
        error_bound(F.col("_either"), lg_size).alias("both_error"),
    )
