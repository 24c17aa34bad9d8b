"""Folding a stream of status events by key: the last status, how many, and a running total; in batch and as a stream."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE = "last long, last_id long, status string, events long, total double"


def fold_batch(events: DataFrame) -> DataFrame:
    """user_id, status, events, total: the status of the last event by (ts, event_id). Partially aggregated before the shuffle."""
    total = F.sum(F.round("value", 6).cast("decimal(18,6)"))
    return events.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("status"), F.count("*").alias("events"), total.alias("total"))


def _update(key: tuple, frames: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
    last, last_id, status, events, total = state.get if state.exists else (-(1 << 62), -1, "", 0, 0.0)
    for f in frames:
        events += len(f)
        total += float(f["value"].round(6).sum())
        top = f.sort_values(["at", "event_id"]).iloc[-1]
        if (int(top["at"]), int(top["event_id"])) > (last, last_id):
            last, last_id, status = int(top["at"]), int(top["event_id"]), top["event_type"]
    state.update((last, last_id, status, events, total))
    yield pd.DataFrame([(key[0], status, events, total)], columns=["user_id", "status", "events", "total"])


def fold_stream(events: DataFrame) -> DataFrame:
    """The same as a streaming query in update mode; late events count but don't change a later status."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    rows = events.select("user_id", "event_id", "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return rows.groupBy("user_id").applyInPandasWithState(_update, "user_id long, status string, events long, total double", STATE, "update", GroupStateTimeout.NoTimeout)


def merge_artifacts(parts: DataFrame) -> DataFrame:
    """task, artifact, content: parts in order, from the last one on that replaces what came before (append = false)."""
    from pyspark.sql import Window

    w = Window.partitionBy("task", "artifact")
    start = F.max(F.when(~F.col("append"), F.col("seq"))).over(w)
    kept = parts.withColumn("__s", F.coalesce(start, F.lit(-1))).where(F.col("seq") >= F.col("__s"))
    listed = kept.groupBy("task", "artifact").agg(F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("p"))
    return listed.select("task", "artifact", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("content"))
