"""K5, K7, K8: alert rules with holds, on mergeable counts.

A rule is evaluated at fixed steps.  Its expression looks back over a trailing
window; the alert is ``pending`` from the first breach, ``firing`` once the
breach has lasted ``hold``, and ``inactive`` again at the first evaluation
without a breach or without data.

* Latency: a histogram with fixed bounds per step, one row a step and bucket
  however many requests there are, and the quantile by interpolation inside
  the bucket that holds its rank.  No window keeps values.
* Error rate: two counts per step.
* Drift: bin counts per step and feature, the largest index over the features
  that have enough samples.

In batch the states are islands of consecutive breaches: only breached
evaluations enter the window, one row per step and rule.  The stream's form is
``nextbuy.streaming.alerts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import drift as K

#: Upper bounds (ms) of the service's latency histogram.
LATENCY_BOUNDS = (5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0, 1000.0, 2500.0, 5000.0, 10000.0)
LATENCY_Q, LATENCY_LIMIT = 0.95, 2000.0
ERROR_LIMIT = 0.01
MINUTE = 60
#: Seconds: evaluation step, trailing window and hold of the request rules and of the drift rule.
REQUEST_STEP, REQUEST_WINDOW, REQUEST_HOLD = MINUTE, 5 * MINUTE, 10 * MINUTE
DRIFT_STEP, DRIFT_WINDOW, DRIFT_HOLD = 10 * MINUTE, 1440 * MINUTE, 30 * MINUTE


def step_of(ts: Column, step: int) -> Column:
    """The number of the step that a time falls in, since 1970."""
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(step * 1_000_000)).cast("long")


def bucket_of(value: Column, bounds: tuple[float, ...]) -> Column:
    """Index of the first bound that is not below the value; one past the last beyond all."""
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < value))


def cumulative(bounds: tuple[float, ...], count) -> list[Column]:
    """A histogram's cumulative counts: of the values up to each bound, and of all; ``count`` aggregates those a condition holds for."""
    return [count(F.col("bucket") <= i).cast("double").alias(f"le_{i}") for i in range(len(bounds) + 1)]


def histogram_quantile(q: float, bounds: tuple[float, ...], upto: list[Column]) -> Column:
    """Quantile of a histogram by its cumulative counts (``cumulative``): linear inside a bucket that begins at 0 or the bound before;
    the last bound if the rank lies beyond it; NULL without observations."""
    rank = upto[-1] * q
    out = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        low, before = (bounds[i - 1], upto[i - 1]) if i else (0.0, F.lit(0.0))
        out = F.when(upto[i] >= rank, low + (bounds[i] - low) * F.try_divide(rank - before, upto[i] - before)).otherwise(out)
    return F.when(upto[-1] > 0, out)


def latency_quantile(histogram: DataFrame, q: float) -> Column:
    """The quantile of rows that carry the latency histogram's cumulative counts."""
    return histogram_quantile(q, LATENCY_BOUNDS, [histogram[f"le_{i}"] for i in range(len(LATENCY_BOUNDS) + 1)])


def _looked_back(per_step: DataFrame, step: int, window: int) -> DataFrame:
    """Each step's counts at every evaluation whose window covers it: ``at`` is the evaluation's time in seconds."""
    return per_step.withColumn("at", F.explode(F.sequence(F.col("step") + 1, F.col("step") + window // step))).withColumn("at", F.col("at") * step)


def latency_points(log: DataFrame, q: float = LATENCY_Q, limit: float = LATENCY_LIMIT, step: int = REQUEST_STEP,
                   window: int = REQUEST_WINDOW) -> DataFrame:
    """K7: (at, value, breached): the bucketed latency quantile of the trailing window."""
    per_step = log.filter(F.col("latency_ms").isNotNull()).groupBy(
        step_of(F.col("ts"), step).alias("step"), bucket_of(F.col("latency_ms"), LATENCY_BOUNDS).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    points = _looked_back(per_step, step, window).groupBy("at").agg(
        *cumulative(LATENCY_BOUNDS, lambda held: F.sum(F.when(held, F.col("n")).otherwise(0))))
    return points.select("at", latency_quantile(points, q).alias("value")).withColumn("breached", F.coalesce(F.col("value") > limit, F.lit(False)))


def error_points(log: DataFrame, limit: float = ERROR_LIMIT, step: int = REQUEST_STEP, window: int = REQUEST_WINDOW) -> DataFrame:
    """K8: (at, value, breached): the share of 5xx in the trailing window."""
    per_step = log.groupBy(step_of(F.col("ts"), step).alias("step")).agg(
        F.count_if(F.col("status") >= 500).alias("errors"), F.count(F.lit(1)).alias("requests"))
    points = _looked_back(per_step, step, window).groupBy("at").agg((F.sum("errors") / F.sum("requests")).alias("value"))
    return points.withColumn("breached", F.col("value") > limit)


def drift_points(obs: DataFrame, reference: dict, limit: float = K.PSI_SIGNIFICANT, step: int = DRIFT_STEP, window: int = DRIFT_WINDOW,
                 min_samples: int = K.MIN_SAMPLES) -> DataFrame:
    """K5: (at, value, breached): the largest PSI over the features with at least ``min_samples`` in the trailing window.

    One row per feature and step carries the bin counts; sums over the window
    run along the steps from the first observation to the last.
    """
    width = max((len(r["shares"]) for r in reference.values()), default=1)
    known = obs.filter(F.col("feature").isin(list(reference)))
    counted = known.groupBy("feature", step_of(F.col("ts"), step).alias("step"),
                            K.bin_expr(F.col("feature"), F.col("value"), reference).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    per_step = counted.groupBy("feature", "step").agg(*[F.sum(F.when(F.col("bin") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(width)])
    ends = counted.agg(F.min("step").alias("a"), F.max("step").alias("b")).filter("a is not null")
    grid = ends.select(F.explode(F.array(*[F.lit(f) for f in reference])).alias("feature"), "a", "b").select(
        "feature", F.explode(F.sequence("a", "b")).alias("step"))
    trailing = Window.partitionBy("feature").orderBy("step").rowsBetween(-(window // step - 1), 0)
    sums = grid.join(per_step, ["feature", "step"], "left").select(
        "feature", "step", F.array(*[F.coalesce(F.sum(f"n{i}").over(trailing), F.lit(0)).cast("double") for i in range(width)]).alias("counts"))
    samples = F.aggregate("counts", F.lit(0.0), lambda a, x: a + x)
    psi = sums.filter(samples >= min_samples).select("step", K.psi_expr(K.shares_expr(F.col("feature"), reference), F.col("counts")).alias("psi"))
    return psi.groupBy(((F.col("step") + 1) * step).alias("at")).agg(F.max("psi").alias("value")).withColumn("breached", F.col("value") > limit)


def states(points: DataFrame, hold: int, step: int) -> DataFrame:
    """(at, value, state, since): the alert's state at each evaluation; ``since`` is the first breach of an unbroken row of them.

    Evaluations without data are no rows and end a breach, as the next breached
    one is more than a step later.
    """
    in_time = Window.orderBy("at")
    breached = points.filter("breached").withColumn("island", F.col("at") / step - F.row_number().over(in_time))
    began = F.min("at").over(Window.partitionBy("island"))
    active = breached.select("at", "value", began.alias("since")).withColumn(
        "state", F.when(F.col("at") - F.col("since") >= hold, "firing").otherwise("pending"))
    idle = points.filter("not breached").select("at", "value", F.lit(None).cast("long").alias("since"), F.lit("inactive").alias("state"))
    return active.unionByName(idle).select(F.timestamp_seconds("at").cast("timestamp_ntz").alias("at"), "value", "state",
                                           F.timestamp_seconds("since").cast("timestamp_ntz").alias("since"))
