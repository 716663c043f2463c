"""Streaming form of the scan alarm (ST2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.metrics import ALARM_WINDOW, scan_alarm


def stream_alarm(
    points: DataFrame,
    threshold: float,
    metric: str | None = None,
    window: str = ALARM_WINDOW,
    lateness: str = "10 minutes",
) -> DataFrame:
    """The batch alarm on a stream; points later than ``lateness`` are dropped."""
    return scan_alarm(points.withWatermark("ts", lateness), threshold, metric, window)


def start_alarm(alarms: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each firing window once, when the watermark has closed it."""
    return (
        alarms.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
