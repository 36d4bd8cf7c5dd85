"""Structured Streaming forms of the drift and service monitors.

Main drift form: bin counts per (event-time window, feature, bin) with a
10-minute watermark.  Counts are mergeable, so the state is one small row
per open window x feature x bin however many events arrive, and PSI is
computed from the finished counts (``psi_from_counts``) - per micro-batch in
``foreachBatch`` or later from the sink.

Parity form: the exact "last N values per feature" window of the reference,
kept in ``applyInPandasWithState`` keyed by feature.  Its state is bounded
(N values per feature) but a feature is one key, so this form does not
scale out with the number of events; it exists to match the reference's
sliding-deque semantics, the windowed counts are the form to run at scale.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import drift as K
from ..sources import io as A

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

WATERMARK = "10 minutes"


def events_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # watermarks need TIMESTAMP (with zone); the session zone is UTC
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def drift_counts(events: DataFrame, reference: dict, width: str = "10 minutes") -> DataFrame:
    """(window_start, feature, bin, n) over a stream, watermarked on event time."""
    obs = K.observations(events).withWatermark("ts", WATERMARK)
    known = obs.filter(F.col("feature").isin(list(reference)))
    g = known.groupBy(F.window("ts", width).alias("w"), "feature",
                      K.bin_expr(F.col("feature"), F.col("value"), reference).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("window_start"), "feature", "bin", "n")


def psi_sink(reference: dict, out_path: str):
    """foreachBatch writer: PSI of the windows finalized in each micro-batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        psi = K.psi_from_counts(batch, reference, keys=["window_start"])
        psi.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out_path)
    return write


def request_counters(events: DataFrame, width: str = "5 minutes") -> DataFrame:
    """K6 on a stream: requests per (window, endpoint, status)."""
    log = K.request_log(events).withWatermark("ts", WATERMARK)
    return K.request_counters(log, width)


def latency_p95(events: DataFrame, width: str = "5 minutes", slide: str = "1 minute",
                alert_ms: float = 2000.0) -> DataFrame:
    """K7 on a stream: approximate p95 per sliding window (exact form is batch)."""
    log = K.request_log(events).withWatermark("ts", WATERMARK)
    g = log.groupBy(F.window("ts", width, slide).alias("w")).agg(
        F.percentile_approx("latency_ms", 0.95, 10000).alias("p95"))
    return g.select(F.col("w.start").alias("window_start"), "p95",
                    (F.col("p95") > alert_ms).alias("over_slo"))


def error_rate(events: DataFrame, width: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """K8 on a stream."""
    return K.error_rate(K.request_log(events).withWatermark("ts", WATERMARK), width, slide)


def profiles(raw_json: DataFrame) -> DataFrame:
    """A9 on a stream of JSON text lines (column ``value``)."""
    return A.ingest_profiles(raw_json)


# --- parity form: exact last-N window per feature -------------------------------------

_COUNTS = "feature string, counts array<long>"
_STATE = "bins array<int>"


def last_n_psi(observations: DataFrame, reference: dict, n: int = K.WINDOW_SIZE,
               min_samples: int = K.MIN_SAMPLES) -> DataFrame:
    """Exact last-N PSI per feature over a stream of (event_id, ts, feature, value).

    Values become bin numbers before they reach the state, which remembers the
    last ``n`` of them; the index itself is an expression over the bin counts.
    Features without a reference are left out.
    """
    width = max((len(r["shares"]) for r in reference.values()), default=1)

    def remember(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
                 ) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(batches)).sort_values(["ts", "event_id"])["bin"]
        kept = np.concatenate([state.get[0] if state.exists else [], arrived])[-n:].astype(int)
        state.update((kept.tolist(),))
        yield pd.DataFrame({"feature": [key[0]],
                            "counts": [np.bincount(kept, minlength=width).tolist()]})

    feature = F.col("feature")
    binned = observations.filter(feature.isin(list(reference))).select(
        "event_id", "ts", "feature", K.bin_expr(feature, F.col("value"), reference).alias("bin"))
    counts = binned.groupBy("feature").applyInPandasWithState(
        remember, _COUNTS, _STATE, "update", GroupStateTimeout.NoTimeout)
    samples = F.aggregate("counts", F.lit(0).cast("long"), lambda total, x: total + x)
    found = counts.select("feature", samples.alias("samples"),
                          K.psi_expr(K.shares_expr(feature, reference), F.col("counts")).alias("p"))
    status = K.status_expr(F.col("p"), F.col("samples"), min_samples)
    return found.select("feature", "samples", F.when(F.col("samples") >= min_samples, F.col("p")).alias("psi"),
                        status.alias("status"))
