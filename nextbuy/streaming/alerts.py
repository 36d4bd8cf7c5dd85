"""Alert rules on a stream: windowed counts, then a state machine with event time.

The counts are the ones of ``nextbuy.functions.alerts`` (mergeable, one row per
open window), finished by a watermark.  The machine holds two numbers a rule:
since when it is breached and which evaluation came last.  A breach that a gap
in the evaluations interrupts starts anew, as in batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import alerts as L
from ..functions import drift as K
from .monitor import WATERMARK

_STATE = "since long, last long"
_OUT = "rule string, at long, value double, state string, since long"


def _windows(step: int, window: int):
    return F.window("ts", f"{window} seconds", f"{step} seconds").alias("w")


def latency_points(events: DataFrame, q: float = L.LATENCY_Q, limit: float = L.LATENCY_LIMIT, step: int = L.REQUEST_STEP,
                   window: int = L.REQUEST_WINDOW) -> DataFrame:
    """K7 on a stream: (rule, at, value, breached) of finished windows; a window's state is one count a bucket."""
    log = K.request_log(events).filter(F.col("latency_ms").isNotNull()).withWatermark("ts", WATERMARK)
    histogram = log.withColumn("bucket", L.bucket_of(F.col("latency_ms"), L.LATENCY_BOUNDS)).groupBy(_windows(step, window)).agg(
        *L.cumulative(L.LATENCY_BOUNDS, F.count_if))
    found = histogram.select(F.lit("latency").alias("rule"), F.unix_seconds("w.end").alias("at"), L.latency_quantile(histogram, q).alias("value"))
    return found.withColumn("breached", F.col("value") > limit)


def error_points(events: DataFrame, limit: float = L.ERROR_LIMIT, step: int = L.REQUEST_STEP, window: int = L.REQUEST_WINDOW) -> DataFrame:
    """K8 on a stream."""
    log = K.request_log(events).withWatermark("ts", WATERMARK)
    found = log.groupBy(_windows(step, window)).agg(F.count_if(F.col("status") >= 500).alias("errors"), F.count(F.lit(1)).alias("requests"))
    return found.select(F.lit("errors").alias("rule"), F.unix_seconds("w.end").alias("at"), (F.col("errors") / F.col("requests")).alias("value")) \
        .withColumn("breached", F.col("value") > limit)


def states(points: DataFrame, hold: int, step: int) -> DataFrame:
    """(rule, at, value, state, since) of a stream of evaluations (rule, at, value, breached).

    Evaluations of one micro-batch are taken in time order; one that comes after
    a later one of its rule was handled is left out, as its state is already told.
    """
    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("at")
        since, last = state.get if state.exists else (None, None)
        out = []
        for at, value, breached in zip(rows["at"], rows["value"], rows["breached"], strict=True):
            if last is not None and at <= last:
                continue
            if not breached:
                since = None
            elif since is None or at - last > step:
                since = at
            status = "inactive" if since is None else "firing" if at - since >= hold else "pending"
            out.append((key[0], int(at), float(value), status, None if since is None else int(since)))
            last = int(at)
        state.update((None if since is None else int(since), last))
        yield pd.DataFrame(out, columns=["rule", "at", "value", "state", "since"]).astype({"since": "Int64"})

    return points.groupBy("rule").applyInPandasWithState(follow, _OUT, _STATE, "append", GroupStateTimeout.NoTimeout)
