"""Daily reports of the feed, the messenger and the whole application."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.functions import Moment, day_of, half_even, last_days, number_text, ratio, rows_in
from pulseboard.operators import message_sides
from pulseboard.plans.audience import audience_daily, new_users_daily

FEED_SERIES = ("DAU", "views", "likes", "CTR")


def newest_first(report: DataFrame) -> DataFrame:
    """Order for reading; reports themselves come unordered."""
    return report.orderBy(F.desc("date"))


def _feed_user_days(feed: DataFrame, as_of: Moment, days: int) -> DataFrame:
    """Likes and views per day and user. Both feed reports group this further, so a plan that
    holds both shuffles the log once."""
    rows = rows_in(feed, last_days(as_of, days))
    return rows.groupBy(day_of(rows).alias("date"), "user_id").agg(
        F.expr("count_if(action = 'like') AS likes"),
        F.expr("count_if(action = 'view') AS views"),
    )


def feed_daily(feed: DataFrame, as_of: Moment, days: int = 7) -> DataFrame:
    """Per day: users, views, likes and likes per view of the feed."""
    return (
        _feed_user_days(feed, as_of, days)
        .groupBy("date")
        .agg(
            F.count("user_id").alias("DAU"),
            F.sum("views").alias("views"),
            F.sum("likes").alias("likes"),
        )
        .withColumn("CTR", ratio(F.col("likes"), F.col("views")))
    )


def feed_report(feed: DataFrame, as_of: Moment, days: int = 7, zero: str = "ieee") -> DataFrame:
    """Per day: totals and per-user means of likes, views and click-through rate (%).

    ``avg_ctr`` is the mean of the users' rates, ``sum_ctr`` the rate of the totals.
    ``zero`` says what a rate without views is, see :func:`ratio`; as ``"null"`` it
    is left out of the mean.
    """
    per_user = _feed_user_days(feed, as_of, days).withColumn(
        "ctr", ratio(F.col("likes"), F.col("views"), zero) * 100
    )
    return (
        per_user.groupBy("date")
        .agg(
            half_even(F.avg("likes")).alias("avg_likes"),
            F.sum("likes").alias("sum_likes"),
            half_even(F.avg("views")).alias("avg_views"),
            F.sum("views").alias("sum_views"),
            half_even(F.avg("ctr"), 2).alias("avg_ctr"),
        )
        .withColumn(
            "sum_ctr", half_even(ratio(F.col("sum_likes"), F.col("sum_views"), zero) * 100, 2)
        )
    )


def message_report(messages: DataFrame, as_of: Moment, days: int = 7) -> DataFrame:
    """Per day: senders, receivers, messages, and means per sender of messages and receivers."""
    rows = rows_in(messages, last_days(as_of, days))
    people = message_sides(rows.withColumn("date", day_of(rows)), by=["date"])
    return people.groupBy("date").agg(
        F.expr("count_if(rows_sent > 0) AS senders"),
        F.expr("count_if(messages_received > 0) AS recievers"),
        F.sum("rows_sent").alias("msg_sent"),
        F.expr("rint(avg(IF(rows_sent > 0, messages_sent, NULL))) AS avg_msg_sent"),
        F.expr("rint(avg(IF(rows_sent > 0, users_sent, NULL))) AS avg_resivers_per_user"),
    )


def app_reports(
    feed: DataFrame, messages: DataFrame, as_of: Moment, days: int = 7, seen: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The four reports on the whole application, by name.

    ``seen`` is the table of first-seen days, if kept; see :func:`new_users_daily`.
    """
    return {
        "audience": audience_daily(feed, messages, as_of, days),
        "new_users": new_users_daily(feed, messages, as_of, days, seen),
        "feed": feed_report(feed, as_of, days),
        "messages": message_report(messages, as_of, days),
    }


def _long(report: DataFrame, name: str, metrics: list[str]) -> DataFrame:
    pairs = ", ".join(f"'{m}', double({m})" for m in metrics)
    return report.selectExpr(
        f"'{name}' AS report", "date", f"stack({len(metrics)}, {pairs}) AS (metric, value)"
    )


def report_series(
    feed: DataFrame, messages: DataFrame, as_of: Moment, days: int = 7, seen: DataFrame | None = None
) -> DataFrame:
    """Long (report, date, metric, value): every line drawn in the app and the feed report."""
    undrawn = {"date", "avg_resivers_per_user"}
    lines = _long(feed_daily(feed, as_of, days), "feed", list(FEED_SERIES))
    for report in app_reports(feed, messages, as_of, days, seen).values():
        lines = lines.unionByName(
            _long(report, "app", [c for c in report.columns if c not in undrawn])
        )
    return lines


def app_report_latest(
    feed: DataFrame, messages: DataFrame, as_of: Moment, days: int = 7, seen: DataFrame | None = None
) -> DataFrame:
    """One row: the newest day of each of the four reports, which need not be the same day."""
    newest = None
    columns = []
    for name, report in app_reports(feed, messages, as_of, days, seen).items():
        dated = report.withColumnRenamed("date", f"{name}_date")
        columns += dated.columns
        top = dated.orderBy(F.desc(f"{name}_date")).limit(1)
        newest = top if newest is None else newest.unionByName(top, allowMissingColumns=True)
    # Every column is set in one of the (at most four) rows only.
    return newest.agg(*[F.max(c).alias(c) for c in columns])


# The wording of the two reports.
FEED_TEXT = '''отчет "ЛЕНТА НОВОСТЕЙ"
за {date}:

DAU: {DAU}
Просмотры: {views}
Лайки: {likes}
CTR: {CTR}
'''
APP_TEXT = '''ОТЧЕТ ЗА {audience_date}

Число пользователей:
    ленты: {feed_users}
    мессенджера: {message_users}
    обоих продуктов: {feed_message_users}

Новые пользователи:
    ленты: {feed_new_users}
    мессенджера: {msg_new_users}
    обоих продуктов: {feed_msg_new_users}

_________________
Лента новостей:
    лайки: {sum_likes}
    просмотры: {sum_views}
    CTR: {sum_ctr}

Средние показатели на пользователя:
    лайки: {avg_likes}
    просмотры: {avg_views}
    CTR: {avg_ctr}
_________________
Мессенджер:
    отправлено писем:{msg_sent}
    отправители: {senders}
    получатели: {recievers}

Средние показатели на пользователя:
    отправлено писем: {avg_msg_sent}
    получатели: {avg_resivers_per_user}
__________________
'''


def _filled_text(row: DataFrame, template: str) -> DataFrame:
    """The template with the row's values in place of {column}; absent values read ``None``."""
    text = F.lit(template)
    for name, kind in row.dtypes:
        shown = number_text(F.col(name)) if kind == "double" else F.col(name).cast("string")
        text = F.replace(text, F.lit(f"{{{name}}}"), F.coalesce(shown, F.lit("None")))
    return row.select(text.alias("text"))


def feed_report_text(feed: DataFrame, as_of: Moment, days: int = 7) -> DataFrame:
    """The feed report's message about its newest day."""
    newest = feed_daily(feed, as_of, days).orderBy(F.desc("date")).limit(1)
    return _filled_text(newest.withColumn("CTR", half_even(F.col("CTR"), 2)), FEED_TEXT)


def app_report_text(
    feed: DataFrame, messages: DataFrame, as_of: Moment, days: int = 7, seen: DataFrame | None = None
) -> DataFrame:
    """The app report's message, from the newest day of each report."""
    return _filled_text(app_report_latest(feed, messages, as_of, days, seen), APP_TEXT)
