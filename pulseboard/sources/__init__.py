from pulseboard.sources.events import feed_actions, feed_rows, message_actions, message_rows
from pulseboard.sources.logs import FEED_SCHEMA, MESSAGE_SCHEMA, query, read_log, stream_log, write_log
from pulseboard.sources.tables import DIMENSION_SCHEMA, create_dimension_table, write_dimension_metrics

__all__ = [
    "DIMENSION_SCHEMA",
    "FEED_SCHEMA",
    "MESSAGE_SCHEMA",
    "create_dimension_table",
    "feed_actions",
    "feed_rows",
    "message_actions",
    "message_rows",
    "query",
    "read_log",
    "stream_log",
    "write_dimension_metrics",
    "write_log",
]
