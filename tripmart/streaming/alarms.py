"""Alarms over a stream of metrics."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tripmart import schemas
from tripmart.plans.monitoring import SILENT, alarm_definitions, judge_periods, period_statistics

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def metric_alarms_stream(metrics: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """State of each alarm per closed period; rows later than ``delay`` are dropped.

    Periods that may still grow are not emitted yet. Times without zone are
    taken in the session's time zone.
    """
    timed = metrics.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return judge_periods(period_statistics(timed), alarm_definitions(metrics.sparkSession))


def alarm_transitions_stream(metrics: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """The closed periods in which an alarm changes, also by falling silent.

    Each alarm keeps the start of its last breach as state. Where the next period has no
    data, a timer of the watermark ends the alarm in it. Needs the state store on disk that
    ``run_alarms`` names.
    """
    timed = metrics.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    alarms = alarm_definitions(metrics.sparkSession)
    judged = judge_periods(period_statistics(timed), alarms, keep=("_w",)).select(
        "name", F.unix_seconds("period_start").alias("start"), "state", "reason", "_w"
    )
    changes = judged.groupBy("name").transformWithStateInPandas(
        AlarmChanges(),
        "name string, start long, state string, reason string",
        "Append",
        "EventTime",
    )
    return changes.select(
        "name", F.timestamp_seconds("start").alias("period_start"), "state", "reason"
    )


class AlarmChanges(StatefulProcessor):
    """Changes of an alarm from its judged periods and from the lack of them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.breach = handle.getValueState("breach", "start long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """The changes in newly closed periods; a batch has one row for each of them."""
        (name,), step = key, schemas.ALARM_PERIOD_SECONDS
        breach = self.breach.get()[0] if self.breach.exists() else None
        if breach is not None:
            self.handle.deleteTimer(_due(breach))
        found = []
        parts = pd.concat([b[["start", "state", "reason"]] for b in rows])
        for start, judged, reason in sorted(parts.itertuples(index=False, name=None)):
            if breach is not None and start > breach + step:
                found.append((name, breach + step, "OK", SILENT))
                breach = None
            if judged == "ALARM":
                if breach is None:
                    found.append((name, start, "ALARM", reason))
                breach = start
            elif breach is not None:
                found.append((name, start, "OK", reason))
                breach = None
        if breach is not None and _due(breach) <= timerValues.getCurrentWatermarkInMs():
            found.append((name, breach + step, "OK", SILENT))
            breach = None
        if breach is None:
            self.breach.clear()
        else:
            self.breach.update((breach,))
            self.handle.registerTimer(_due(breach))
        yield _rows(found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The period after a breach is closed and had no data."""
        found = []
        if self.breach.exists():
            after = self.breach.get()[0] + schemas.ALARM_PERIOD_SECONDS
            found.append((key[0], after, "OK", SILENT))
            self.breach.clear()
        yield _rows(found)


def _due(breach: int) -> int:
    """The time in milliseconds at which the period after a breach is closed."""
    return (breach + 2 * schemas.ALARM_PERIOD_SECONDS) * 1000


def _rows(found: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(found, columns=["name", "start", "state", "reason"])


def run_alarms(
    metrics: DataFrame, out: str, checkpoint: str, delay: str = "10 minutes", stream=metric_alarms_stream
) -> StreamingQuery:
    """Judge what has arrived, append the rows of ``stream`` to a table, then stop."""
    conf = metrics.sparkSession.conf
    before = conf.get(STATE_STORE)
    conf.set(STATE_STORE, ON_DISK)
    try:
        return (
            stream(metrics, delay)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .option("path", out)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        conf.set(STATE_STORE, before)
