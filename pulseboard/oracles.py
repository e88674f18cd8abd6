"""The queries of :mod:`pulseboard.catalog` as SQL for another engine.

Written separately, from one table of all actions and with the distinct counts and
joins that the Spark plans avoid, so that agreement means something. Dates match the
catalog's.
"""

from __future__ import annotations

_LOGS = """
person AS (
  SELECT *, user_id + 1 AS u,
    (user_id + 1) // 2
      + CASE WHEN (user_id + 1) % 10 = 0 AND day(ts) >= 16 THEN 1 ELSE 0 END AS half,
    CASE WHEN user_id % 7 = 0 THEN false
         WHEN user_id % 5 = 0 THEN true
         ELSE event_type IN ('view', 'click') END AS in_feed
  FROM events),
acted AS (
  SELECT u AS user_id, ts AS time, CAST(ts AS DATE) AS date, in_feed,
    CAST(u % 2 AS INTEGER) AS gender, CAST(10 + (u * 37) % 61 AS INTEGER) AS age,
    CASE WHEN half % 2 = 0 THEN 'iOS' ELSE 'Android' END AS os,
    in_feed AND event_type IN ('click', 'purchase') AS liked,
    in_feed AND event_type NOT IN ('click', 'purchase') AS viewed,
    CASE WHEN NOT in_feed THEN 2 * CAST(json_extract_string(props, '$.k') AS BIGINT)
      + event_id % 2 + 1 END AS reciever_id
  FROM person)"""

_DAYS = "2024-01-31"
_NEW = "2024-01-08"
_BACKFILL = "2024-01-16"


def _sql(ctes: str, select: str) -> str:
    return f"WITH {_LOGS}{',' if ctes else ''}{ctes}\n{select}"


def _week(as_of: str, days: int = 7) -> str:
    return f"date >= DATE '{as_of}' - {days} AND date < DATE '{as_of}'"


_LIKES = "count(*) FILTER (liked)"
_VIEWS = "count(*) FILTER (viewed)"
_CTR = f"CAST({_LIKES} AS DOUBLE) / {_VIEWS}"


def _feed_daily(as_of: str, days: int = 7) -> str:
    return f"""
SELECT date, count(DISTINCT user_id) AS "DAU", {_VIEWS} AS views, {_LIKES} AS likes, {_CTR} AS "CTR"
FROM acted WHERE in_feed AND {_week(as_of, days)} GROUP BY date"""


def _audience(as_of: str, days: int = 7) -> str:
    return f"""
SELECT date, count(DISTINCT user_id) FILTER (in_feed) AS feed_users,
  count(DISTINCT user_id) FILTER (NOT in_feed) AS message_users,
  count(DISTINCT user_id) FILTER (in_feed AND writes) AS feed_message_users
FROM (SELECT *, bool_or(NOT in_feed) OVER (PARTITION BY user_id) AS writes
      FROM acted WHERE {_week(as_of, days)})
GROUP BY date HAVING message_users > 0 AND feed_message_users > 0"""


def _spans(by: str = "") -> str:
    """Users of the last 1, 7 and 30 days."""
    own, same = (f"{by}, ", f" AND f.{by} = m.{by}") if by else ("", "")
    keys = f"days, {by}" if by else "days"
    return f"""
SELECT {keys}, count(DISTINCT user_id) FILTER (in_feed) AS feed_users,
  count(DISTINCT user_id) FILTER (NOT in_feed) AS message_users,
  CAST(coalesce((SELECT count(DISTINCT f.user_id) FROM recent f JOIN recent m
     ON f.in_feed AND NOT m.in_feed AND f.user_id = m.user_id AND f.days = m.days{same}
     WHERE f.days = o.days{f" AND f.{by} = o.{by}" if by else ""}), 0) AS BIGINT) AS feed_message_users,
  count(DISTINCT user_id) AS users
FROM recent o GROUP BY {keys}"""


_RECENT = f"""
recent AS (
  SELECT DISTINCT days, user_id, in_feed, os FROM acted, (SELECT unnest([1, 7, 30]) AS days)
  WHERE date >= DATE '{_DAYS}' - days AND date < DATE '{_DAYS}')"""


def _feed_report(as_of: str, days: int = 7, null_rate: bool = False) -> str:
    def rate(likes: str, views: str) -> str:
        below = f"nullif({views}, 0)" if null_rate else views
        return f"CAST({likes} AS DOUBLE) / {below} * 100"

    return f"""
SELECT date, round_even(CAST(sum(likes) AS DOUBLE) / count(*), 0) AS avg_likes,
  CAST(sum(likes) AS BIGINT) AS sum_likes,
  round_even(CAST(sum(views) AS DOUBLE) / count(*), 0) AS avg_views,
  CAST(sum(views) AS BIGINT) AS sum_views, round_even(avg(rate), 2) AS avg_ctr,
  round_even({rate("sum(likes)", "CAST(sum(views) AS DOUBLE)")}, 2) AS sum_ctr
FROM (SELECT date, user_id, {_LIKES} AS likes, {_VIEWS} AS views, {rate("likes", "views")} AS rate
      FROM acted WHERE in_feed AND {_week(as_of, days)} GROUP BY date, user_id)
GROUP BY date"""


def _message_report(as_of: str, days: int = 7) -> str:
    """Means per sender are totals over the number of senders."""
    return f"""
SELECT date, count(DISTINCT user_id) AS senders, count(DISTINCT reciever_id) AS recievers,
  count(*) AS msg_sent,
  round_even(CAST(count(reciever_id) AS DOUBLE) / senders, 0) AS avg_msg_sent,
  round_even(CAST(count(DISTINCT (user_id, reciever_id)) AS DOUBLE) / senders, 0)
    AS avg_resivers_per_user
FROM acted WHERE NOT in_feed AND {_week(as_of, days)} GROUP BY date"""


def _new_users(as_of: str, days: int = 7) -> str:
    """Every day of the window against every user."""
    start = f"DATE '{as_of}' - {days}"
    return f"""
SELECT date, count(*) FILTER (feed_first = date) AS feed_new_users,
  count(*) FILTER (msg_first = date) AS msg_new_users,
  count(*) FILTER (msg_first = date AND feed_first >= {start} AND feed_first < DATE '{as_of}')
    AS feed_msg_new_users
FROM (SELECT CAST(range AS DATE) AS date FROM range({start}, DATE '{as_of}', INTERVAL 1 DAY)),
  (SELECT user_id, min(date) FILTER (in_feed) AS feed_first,
     min(date) FILTER (NOT in_feed) AS msg_first
   FROM acted GROUP BY user_id)
GROUP BY date HAVING feed_new_users + msg_new_users > 0"""


def _activity(
    days: int = 1, latest: bool = False, as_of: str = _DAYS, unknown: bool = False, ever: bool = False
) -> str:
    """CTEs feed_users, message_users and user_activity for the days before ``as_of``.

    Attributes are those of actions up to the day in question, looked up day by day, or with ``ever``
    those of all actions.
    """
    known = "true" if ever else "acted.date <= event_date"
    age = "age" if unknown else "coalesce(age, 0)"
    gender = "gender" if unknown else "coalesce(gender, 0)"
    rank = "1"
    if latest:
        rank = """row_number() OVER (PARTITION BY event_date, user_id
      ORDER BY time DESC, gender DESC, age DESC, os DESC)"""
    return f"""
feed_user AS (
  SELECT date AS event_date, user_id, gender, age, os, {_LIKES} AS likes, {_VIEWS} AS views
  FROM acted WHERE in_feed AND {_week(as_of, days)} GROUP BY ALL),
ends AS (
  SELECT date AS event_date, user_id, reciever_id AS peer, true AS sent
  FROM acted WHERE NOT in_feed AND {_week(as_of, days)}
  UNION ALL
  SELECT date, reciever_id, user_id, false
  FROM acted WHERE NOT in_feed AND {_week(as_of, days)}),
messaged AS (
  SELECT event_date, user_id, count(*) FILTER (NOT sent) AS messages_received,
    count(peer) FILTER (sent) AS messages_sent,
    count(DISTINCT peer) FILTER (sent) AS users_sent,
    count(DISTINCT peer) FILTER (NOT sent) AS users_received
  FROM ends GROUP BY ALL),
known AS (
  SELECT event_date, user_id, gender, age, os, max(acted.time) AS time
  FROM (SELECT DISTINCT event_date, user_id FROM messaged) m JOIN acted USING (user_id)
  WHERE {known} GROUP BY ALL),
ranked AS (SELECT *, {rank} AS rank FROM known),
message_user AS (
  SELECT event_date, user_id, {gender} AS gender, {age} AS age,
    coalesce(os, '') AS os, messages_received, messages_sent, users_sent, users_received
  FROM messaged LEFT JOIN (SELECT * FROM ranked WHERE rank = 1) USING (event_date, user_id)),
merged AS (
  SELECT event_date, user_id, gender, age AS years, os, coalesce(likes, 0) AS likes,
    coalesce(views, 0) AS views, coalesce(messages_received, 0) AS messages_received,
    coalesce(messages_sent, 0) AS messages_sent, coalesce(users_sent, 0) AS users_sent,
    coalesce(users_received, 0) AS users_received
  FROM feed_user FULL JOIN message_user USING (event_date, user_id, gender, age, os)),
user_activity AS (
  SELECT event_date, user_id, gender,
    CASE WHEN years <= 20 THEN '0-20' WHEN years <= 30 THEN '21-30' WHEN years <= 40 THEN '31-40'
      WHEN years <= 50 THEN '41-50' WHEN years <= 60 THEN '51-60' WHEN years > 60 THEN '> 60'
      ELSE 'unknown' END AS age,
    os, likes, views, messages_received, messages_sent, users_sent, users_received
  FROM merged)"""


def _slice(dimension: str) -> str:
    totals = ", ".join(
        f"CAST(sum({m}) AS BIGINT) AS {m}"
        for m in (
            "views", "likes", "messages_received", "messages_sent", "users_sent", "users_received"
        )
    )
    return f"""
SELECT event_date, '{dimension}' AS dimension, CAST({dimension} AS VARCHAR) AS dimension_value, {totals}
FROM user_activity GROUP BY event_date, {dimension}"""


def _dimensions(days: int = 1, **options) -> str:
    return _sql(_activity(days, **options), " UNION ALL ".join(_slice(d) for d in ("gender", "age", "os")))


_LIVE = "time >= TIMESTAMP '2024-01-30' AND time < TIMESTAMP '2024-01-31'"
# As of 12:07 the bucket of 12:00 is still open.
_MIDDAY = "time >= TIMESTAMP '2024-01-29' AND time < TIMESTAMP '2024-01-30 12:00:00'"
_ALERT = "time >= TIMESTAMP '2024-01-29' AND time < TIMESTAMP '2024-01-30 12:30:00'"


def _quarters(where: str, by: str = "") -> str:
    """CTE quarters: the metrics of both products per quarter hour."""
    return f"""
quarters AS (
  SELECT time_bucket(INTERVAL 15 MINUTE, time) AS quart_hour{', ' + by if by else ''},
    count(DISTINCT user_id) FILTER (in_feed) AS feed_users,
    count(DISTINCT user_id) FILTER (NOT in_feed) AS msg_users,
    {_LIKES} AS likes, {_VIEWS} AS views, count(*) FILTER (NOT in_feed) AS messages,
    {_CTR} AS ctr
  FROM acted WHERE {where} GROUP BY ALL HAVING feed_users > 0 AND msg_users > 0)"""


def _bands(where: str, ahead: int, by: str = "", size: int = 6) -> str:
    """CTE bands over quarters from ``size`` rows before, smoothed over ``ahead`` rows after each row."""
    also = f", {by}" if by else ""
    return f"""{_quarters(where, by)},
series AS (
  SELECT quart_hour{also}, metric, value FROM
    (UNPIVOT (SELECT quart_hour{also}, feed_users, msg_users, likes, views, messages FROM quarters)
     ON feed_users, msg_users, likes, views, messages INTO NAME metric VALUE value)),
raw AS (
  SELECT *, lag(value) OVER all_rows AS prev_value,
    CASE WHEN count(*) OVER sample = {size}
      THEN quantile_cont(CAST(value AS DOUBLE), 0.25) OVER sample END AS q25,
    CASE WHEN count(*) OVER sample = {size}
      THEN quantile_cont(CAST(value AS DOUBLE), 0.75) OVER sample END AS q75
  FROM series
  WINDOW all_rows AS (PARTITION BY metric{also} ORDER BY quart_hour),
    sample AS (PARTITION BY metric{also} ORDER BY quart_hour
               ROWS BETWEEN {size} PRECEDING AND 1 PRECEDING)),
bands AS (
  SELECT *, q75 - q25 AS iqr, avg(q75 + 4 * (q75 - q25)) OVER around AS up,
    avg(q25 - 4 * (q75 - q25)) OVER around AS low
  FROM raw
  WINDOW around AS (PARTITION BY metric{also} ORDER BY quart_hour
                    ROWS BETWEEN {size // 2} PRECEDING AND {f'{ahead} FOLLOWING' if ahead else 'CURRENT ROW'})),
replay AS (
  SELECT metric{also}, quart_hour, value, prev_value, low, up,
    CASE WHEN prev_value <> 0
      THEN abs(round_even((1 - CAST(value AS DOUBLE) / prev_value) * 100, 2)) END AS deviation_pct,
    coalesce(value < low OR value > up, false) AS is_alert
  FROM bands)"""


# Buckets that the streams' watermark has closed once both logs are read.
_CLOSED = """quart_hour + INTERVAL 15 MINUTE <= least(
  (SELECT max(time) FROM acted WHERE in_feed), (SELECT max(time) FROM acted WHERE NOT in_feed))
  - INTERVAL 30 MINUTE"""


def _app_reports(as_of: str) -> str:
    return f"""
feed_days AS ({_feed_daily(as_of)}),
audience AS ({_audience(as_of)}),
new_users AS ({_new_users(as_of)}),
feed AS ({_feed_report(as_of)}),
messages AS ({_message_report(as_of)})"""


def _lines(report: str, source: str, metrics: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{report}' AS report, date, '{m}' AS metric, CAST(\"{m}\" AS DOUBLE) AS value FROM {source}"
        for m in metrics.split()
    )


_LATEST = """
latest AS (
  SELECT audience.date AS audience_date, feed_users, message_users, feed_message_users,
    new_users.date AS new_users_date, feed_new_users, msg_new_users, feed_msg_new_users,
    feed.date AS feed_date, avg_likes, sum_likes, avg_views, sum_views, avg_ctr, sum_ctr,
    messages.date AS messages_date, senders, recievers, msg_sent, avg_msg_sent,
    avg_resivers_per_user
  FROM (SELECT * FROM audience ORDER BY date DESC LIMIT 1) audience,
    (SELECT * FROM new_users ORDER BY date DESC LIMIT 1) new_users,
    (SELECT * FROM feed ORDER BY date DESC LIMIT 1) feed,
    (SELECT * FROM messages ORDER BY date DESC LIMIT 1) messages)"""

_DECIMALS = {"CTR", "sum_ctr", "avg_ctr", "avg_likes", "avg_views", "avg_msg_sent"} | {
    "avg_resivers_per_user"
}


def _number(column: str) -> str:
    return (
        f"CASE WHEN isnan({column}) THEN 'nan' WHEN isinf({column}) THEN 'inf' "
        f"ELSE regexp_replace(printf('%.2f', {column}), '0$', '') END"
    )


def _text(template: str, columns: dict[str, str]) -> str:
    text = "'" + template.replace("'", "''") + "'"
    for name, value in columns.items():
        text = f"replace({text}, '{{{name}}}', {value})"
    return text


def _report_columns(template: str) -> dict[str, str]:
    names = [part.split("}")[0] for part in template.split("{")[1:]]
    return {
        n: _number(f'round_even("{n}", 2)') if n in _DECIMALS else f'CAST("{n}" AS VARCHAR)'
        for n in names
    }


# The wording of the messages, written out here once more.
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
ALERT_TEXT = '''Метрика {metric}:
текущее значение: {value}
отклонение от предыдущего значения: {deviation}%
'''


def oracles() -> dict[str, str]:
    everything = "true"
    replayed = "metric, quart_hour, value, prev_value, low, up, deviation_pct, is_alert"
    alert_text = _text(
        ALERT_TEXT,
        {
            "metric": "metric",
            "value": "CAST(value AS VARCHAR)",
            "deviation": f"coalesce({_number('deviation_pct')}, 'None')",
        },
    )
    series = _sql(
        _app_reports(_NEW),
        " UNION ALL ".join(
            [
                _lines("feed", "feed_days", "DAU views likes CTR"),
                _lines("app", "audience", "feed_users message_users feed_message_users"),
                _lines("app", "new_users", "feed_new_users msg_new_users feed_msg_new_users"),
                _lines(
                    "app", "feed", "sum_likes avg_likes sum_views avg_views sum_ctr avg_ctr"
                ),
                _lines("app", "messages", "senders recievers msg_sent avg_msg_sent"),
            ]
        ),
    )
    app_text = _sql(
        _app_reports(_NEW) + "," + _LATEST,
        f"SELECT {_text(APP_TEXT, _report_columns(APP_TEXT))} AS text FROM latest",
    )
    return {
        "feed_daily": _sql("", _feed_daily(_DAYS)),
        "feed_daily_sql": _sql("", _feed_daily(_DAYS)),
        "feed_daily_month": _sql("", _feed_daily(_DAYS, 30)),
        "audience_daily": _sql("", _audience(_DAYS)),
        "audience_from_bitmaps": _sql(_RECENT, _spans()),
        "audience_from_bitmaps_by_os": _sql(_RECENT, _spans("os")),
        "audience_daily_from_bitmaps": _sql("", _audience(_DAYS, 30)),
        "audience_estimates": _sql(
            "",
            f"""
SELECT date, count(*) FILTER (feed) AS feed_users, count(*) FILTER (message) AS message_users,
  count(*) FILTER (feed AND message) AS both_users,
  true AS feed_within, true AS message_within, true AS both_within
FROM (SELECT date, user_id, bool_or(in_feed) AS feed, bool_or(NOT in_feed) AS message
      FROM acted WHERE {_week(_DAYS, 30)} GROUP BY ALL)
GROUP BY date""",
        ),
        "audience_month": _sql("", _audience(_DAYS, 30)),
        "feed_report": _sql("", _feed_report(_DAYS)),
        "feed_report_null_ctr": _sql("", _feed_report(_DAYS, null_rate=True)),
        "feed_report_month": _sql("", _feed_report(_DAYS, 30)),
        "message_report_month": _sql("", _message_report(_DAYS, 30)),
        "message_report": _sql("", _message_report(_DAYS)),
        "new_users_daily": _sql("", _new_users(_NEW)),
        "new_users_month": _sql("", _new_users(_DAYS, 30)),
        "new_users_incremental": _sql("", _new_users(_NEW)),
        "new_users_bucketed": _sql("", _new_users(_NEW)),
        "feed_user_daily": _sql(_activity(), "SELECT * FROM feed_user"),
        "message_user_daily": _sql(_activity(), "SELECT * FROM message_user"),
        "message_user_ever": _sql(
            _activity(as_of=_BACKFILL, ever=True), "SELECT * FROM message_user"
        ),
        "message_user_latest": _sql(_activity(latest=True), "SELECT * FROM message_user"),
        "message_user_incremental": _sql(_activity(), "SELECT * FROM message_user"),
        "message_user_latest_incremental": _sql(
            _activity(latest=True), "SELECT * FROM message_user"
        ),
        "message_user_latest_month": _sql(
            _activity(30, latest=True), "SELECT * FROM message_user"
        ),
        "message_user_backfill": _sql(_activity(as_of=_BACKFILL), "SELECT * FROM message_user"),
        "message_user_backfill_latest": _sql(
            _activity(latest=True, as_of=_BACKFILL), "SELECT * FROM message_user"
        ),
        "user_activity_incremental": _sql(_activity(), "SELECT * FROM user_activity"),
        "dimension_metrics_incremental": _dimensions(),
        "dimension_metrics_backfill": _dimensions(as_of=_BACKFILL),
        "dimension_metrics_unknown": _dimensions(unknown=True),
        "feed_daily_newest": _sql("", _feed_daily(_DAYS) + " ORDER BY date DESC"),
        "audience_stored": _sql("", _audience(_DAYS)),
        "quarter_hour_metrics_midday": _sql(
            _quarters(_MIDDAY), "SELECT * EXCLUDE (ctr) FROM quarters"
        ),
        "alert_latest_midday": _sql(
            _bands(_MIDDAY, ahead=0),
            f"SELECT {replayed} FROM replay WHERE quart_hour = (SELECT max(quart_hour) FROM quarters)",
        ),
        "alert_messages_latest": _sql(
            _bands(_ALERT, ahead=0),
            f"SELECT metric, quart_hour, {alert_text} AS message FROM replay "
            "WHERE is_alert AND quart_hour = (SELECT max(quart_hour) FROM quarters)",
        ),
        "user_activity_daily": _sql(_activity(), "SELECT * FROM user_activity"),
        "slice_gender": _sql(_activity(), _slice("gender")),
        "slice_age": _sql(_activity(), _slice("age")),
        "slice_os": _sql(_activity(), _slice("os")),
        "dimension_metrics": _dimensions(),
        "dimension_metrics_month": _dimensions(30),
        "dimension_metrics_sink": _dimensions(),
        "dimension_metrics_published": _dimensions(30),
        "quarter_hour_metrics": _sql(
            _quarters(_LIVE), "SELECT * EXCLUDE (ctr) FROM quarters"
        ),
        "quarter_hour_history": _sql(_quarters(everything), "SELECT * FROM quarters"),
        "metric_bands": _sql(
            _bands(_LIVE, ahead=2),
            "SELECT quart_hour, metric, value, q25, q75, iqr, up, low FROM bands",
        ),
        "metric_bands_week": _sql(
            _bands(everything, ahead=335, size=672),
            "SELECT quart_hour, metric, value, q25, q75, iqr, up, low FROM bands",
        ),
        "alert_replay_week": _sql(
            _bands(everything, ahead=0, size=672), f"SELECT {replayed} FROM replay"
        ),
        "alert_latest": _sql(
            _bands(_LIVE, ahead=0),
            f"SELECT {replayed} FROM replay WHERE quart_hour = (SELECT max(quart_hour) FROM quarters)",
        ),
        "alert_replay": _sql(_bands(everything, ahead=0), f"SELECT {replayed} FROM replay"),
        "alert_replay_by_os": _sql(
            _bands(everything, ahead=0, by="os"), f"SELECT os, {replayed} FROM replay"
        ),
        "alert_messages": _sql(
            _bands(everything, ahead=0),
            f"SELECT metric, quart_hour, {alert_text} AS message FROM replay WHERE is_alert",
        ),
        "report_series": series,
        "report_series_incremental": series,
        "app_report_latest": _sql(_app_reports(_NEW) + "," + _LATEST, "SELECT * FROM latest"),
        "feed_report_text": _sql(
            "",
            f"SELECT {_text(FEED_TEXT, _report_columns(FEED_TEXT))} AS text "
            f"FROM ({_feed_daily(_DAYS)} ORDER BY date DESC LIMIT 1)",
        ),
        "app_report_text": app_text,
        "app_report_text_incremental": app_text,
        "quarter_hour_stream": _sql(
            _quarters(everything), f"SELECT * EXCLUDE (ctr) FROM quarters WHERE {_CLOSED}"
        ),
        "quarter_hour_join_stream": _sql(
            _quarters(everything), f"SELECT * EXCLUDE (ctr) FROM quarters WHERE {_CLOSED}"
        ),
        "quarter_hour_replayed_stream": _sql(
            _quarters(everything), f"SELECT * EXCLUDE (ctr) FROM quarters WHERE {_CLOSED}"
        ),
        "silence_stream": _sql(
            """
heard AS (
  SELECT DISTINCT CASE WHEN in_feed THEN 'feed' ELSE 'messages' END AS product,
    time_bucket(INTERVAL 15 MINUTE, time) AS quart_hour FROM acted),
gaps AS (
  SELECT product, quart_hour AS last_bucket, quart_hour + INTERVAL 45 MINUTE AS silent_from,
    lead(quart_hour) OVER (PARTITION BY product ORDER BY quart_hour) AS next FROM heard)""",
            "SELECT product, last_bucket, silent_from FROM gaps "
            "WHERE coalesce(next > silent_from, true) AND "
            + _CLOSED.replace("quart_hour + INTERVAL 15 MINUTE", "silent_from + INTERVAL 15 MINUTE"),
        ),
        "quarter_hour_corrected_stream": _sql(_quarters(everything), "SELECT * FROM quarters"),
        "alert_stream": _sql(
            _bands(everything, ahead=0), f"SELECT {replayed} FROM replay WHERE {_CLOSED}"
        ),
    }
