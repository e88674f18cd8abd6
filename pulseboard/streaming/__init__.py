from pulseboard.streaming.alerts import alert_stream
from pulseboard.streaming.late import BucketStore, start_corrected
from pulseboard.streaming.metrics import quarter_hour_join_stream, quarter_hour_stream
from pulseboard.streaming.run import few_partitions, start
from pulseboard.streaming.silence import silence_stream

__all__ = [
    "BucketStore",
    "alert_stream",
    "few_partitions",
    "quarter_hour_join_stream",
    "quarter_hour_stream",
    "silence_stream",
    "start",
    "start_corrected",
]
