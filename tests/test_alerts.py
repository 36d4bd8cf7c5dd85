"""Alert rules: histogram quantiles, holds, and batch = stream."""
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from nextbuy.functions import alerts as L
from nextbuy.streaming import alerts as SL
from nextbuy.streaming import monitor

T0 = dt.datetime(2024, 1, 1)


def quantile(q, values):
    """The bucketed quantile in plain Python."""
    bounds = L.LATENCY_BOUNDS
    counts = [sum(v <= b and (i == 0 or v > bounds[i - 1]) for v in values) for i, b in enumerate(bounds)] + [sum(v > bounds[-1] for v in values)]
    rank, seen = q * len(values), 0
    for i, c in enumerate(counts):
        if seen + c >= rank and seen + c > 0:
            if i == len(bounds):
                return bounds[-1]
            low = bounds[i - 1] if i else 0.0
            return low + (bounds[i] - low) * (rank - seen) / c
        seen += c


def log_rows(seed=1, minutes=400):
    r = random.Random(seed)
    out = []
    for m in range(minutes):
        slow = 100 <= m < 125 or 200 <= m < 205 or 300 <= m < 360
        # one minute holds a third of all requests; another stretch has none
        for _ in range(600 if m == 110 else 0 if 330 <= m < 345 else r.randint(1, 4)):
            ms = r.choice([2600.0, 4000.0, 12000.0]) if slow else r.choice([3.0, 5.0, 80.0, 900.0])
            at = T0 + dt.timedelta(minutes=m, seconds=r.randint(0, 59), microseconds=r.randint(0, 999_999))
            out.append((len(out), at, 7, "error" if slow and r.random() < 0.5 else "view", ms, "{}"))
    return out


def machine(points, hold, step):
    """State by state: what an evaluator would say at each evaluation."""
    out, since, last = {}, None, None
    for at, breached in sorted(points):
        if not breached:
            since = None
        elif since is None or at - last > step:
            since = at
        out[at] = ("inactive" if since is None else "firing" if at - since >= hold else "pending", since)
        last = at
    return out


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(log_rows(), monitor.EVENTS_SCHEMA).repartition(6)


def told(df):
    return {r["at"]: (r["state"], r["since"]) for r in df.collect()}


def test_latency_quantile(spark, log):
    points = {r["at"]: r["value"] for r in L.latency_points(L.K.request_log(log)).collect()}
    rows = log_rows()
    epoch = dt.datetime(1970, 1, 1)
    minute = lambda x: int((x - epoch).total_seconds() // 60)
    assert len(points) > 380
    for at in list(points)[::7]:
        window = [r[4] for r in rows if at // 60 - 5 <= minute(r[1]) < at // 60]
        assert points[at] == pytest.approx(quantile(0.95, window), abs=1e-9)


@pytest.mark.parametrize("values", [[3.0], [10000.0, 20000.0], [5.0] * 19 + [9.0], [0.0, 100.0, 100.0]])
def test_quantile_of_one_histogram(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    histogram = df.withColumn("bucket", L.bucket_of(F.col("v"), L.LATENCY_BOUNDS)).agg(*L.cumulative(L.LATENCY_BOUNDS, F.count_if))
    got = histogram.select(L.latency_quantile(histogram, 0.95)).first()[0]
    assert got == pytest.approx(quantile(0.95, values))


def test_no_observation_is_null(spark):
    assert spark.range(1).select(L.histogram_quantile(0.95, (1.0, 2.0), [F.lit(0.0)] * 3)).first()[0] is None


def test_holds(spark, log):
    requests = L.K.request_log(log)
    for points in (L.latency_points(requests), L.error_points(requests)):
        rows = points.collect()
        want = machine([(r["at"], r["breached"]) for r in rows], 600, 60)
        got = told(L.states(points, 600, 60))
        stamp = lambda s: None if s is None else dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s)
        assert got == {stamp(at): (s, stamp(since)) for at, (s, since) in want.items()}
        assert {s for s, _ in got.values()} == {"inactive", "pending", "firing"}


def test_gap_ends_a_breach(spark):
    points = spark.createDataFrame([(60 * m, 9.0, True) for m in [*range(1, 12), *range(14, 20)]], "at long, value double, breached boolean")
    got = told(L.states(points, 600, 60))
    at = lambda m: dt.datetime(1970, 1, 1) + dt.timedelta(minutes=m)
    assert got[at(11)] == ("firing", at(1)) and got[at(10)][0] == "pending" and got[at(14)] == ("pending", at(14)) and got[at(19)][0] == "pending"


def test_drift_takes_the_worst_feature(spark):
    reference = {f: {"edges": [0.0, 1.0, 2.0, 3.0], "shares": [0.4, 0.3, 0.3]} for f in ("a", "b")}
    r = random.Random(2)
    rows = []
    for m in range(0, 600, 2):
        for f in ("a", "b"):
            moved = f == "b" and m > 300
            rows.append((len(rows), T0 + dt.timedelta(minutes=m), f, 2.5 if moved else r.uniform(0, 3)))
    obs = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, feature string, value double")
    got = L.drift_points(obs, reference, step=600, window=3600, min_samples=20).orderBy("at").collect()
    from nextbuy.functions.drift import PSI_EPS
    for p in got[::5]:
        best = 0.0
        for f in ("a", "b"):
            inside = [x[3] for x in rows if x[2] == f and p["at"] - 3600 <= (x[1] - dt.datetime(1970, 1, 1)).total_seconds() < p["at"]]
            if len(inside) < 20:
                continue
            o = np.maximum(np.bincount([min(int(v), 2) for v in inside], minlength=3) / len(inside), PSI_EPS)
            q = np.maximum(np.array([0.4, 0.3, 0.3]), PSI_EPS)
            o, q = o / o.sum(), q / q.sum()
            best = max(best, float(((q - o) * np.log(q / o)).sum()))
        assert p["value"] == pytest.approx(best, abs=1e-9)
    assert got[-1]["breached"] and not got[15]["breached"]
    assert "firing" in {s for s, _ in told(L.states(L.drift_points(obs, reference, step=600, window=3600, min_samples=20), 1800, 600)).values()}
    assert L.drift_points(obs.limit(0), reference).collect() == []


def test_stream_equals_batch(spark, tmp_path):
    rows = log_rows(minutes=220)
    flush = (10**6, T0 + dt.timedelta(days=2), 7, "view", 1.0, "{}")
    source = tmp_path / "events"
    for i in range(0, len(rows), 300):
        spark.createDataFrame(rows[i:i + 300], monitor.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
    spark.createDataFrame([flush], monitor.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
    batch = L.K.request_log(spark.createDataFrame(rows, monitor.EVENTS_SCHEMA))
    for name, stream_points, batch_points in (("latency", SL.latency_points, L.latency_points), ("errors", SL.error_points, L.error_points)):
        finished = str(tmp_path / name)
        stream_points(monitor.events_stream(spark, str(source))).writeStream.format("parquet").option("path", finished).option(
            "checkpointLocation", str(tmp_path / f"ck-{name}")).trigger(availableNow=True).start().awaitTermination()
        done = spark.read.parquet(finished)
        # evaluations in five micro-batches, by time
        parts = tmp_path / f"parts-{name}"
        cuts = done.filter(F.col("at") < F.unix_seconds(F.lit("2024-01-02").cast("timestamp")))
        for k in range(5):
            lo, hi = (F.unix_seconds(F.lit(str(T0 + dt.timedelta(minutes=m))).cast("timestamp")) for m in (60 * k, 60 * k + 60))
            cuts.filter((F.col("at") >= lo) & (F.col("at") < hi)).coalesce(1).write.parquet(str(parts / f"p{k}"))
        stream = spark.readStream.schema(done.schema).option("maxFilesPerTrigger", 1).parquet(str(parts / "*"))
        SL.states(stream, 600, 60).writeStream.outputMode("append").format("memory").queryName(f"states_{name}").option(
            "checkpointLocation", str(tmp_path / f"ck2-{name}")).trigger(availableNow=True).start().awaitTermination()
        got = {r["at"]: (round(r["value"], 9), r["state"], r["since"]) for r in spark.table(f"states_{name}").collect()}
        seconds = lambda c: F.unix_seconds(F.col(c).cast("timestamp")).alias(c)
        want = {r["at"]: (round(r["value"], 9), r["state"], r["since"])
                for r in L.states(batch_points(batch), 600, 60).select(seconds("at"), "value", "state", seconds("since")).collect()}
        assert got == want and {s for _, s, _ in got.values()} == {"inactive", "pending", "firing"}
