"""Splits and samples (survey family E).

Stratified sampling and fold assignment need "the first n rows of each class
in a seeded hash order".  ``row_number`` over the class would put a whole
class into one task, and class 0 holds ~96% of the panel, so positions are
computed in two levels instead: rows are bucketed by the top 16 bits of the
hash, a (class, bucket) histogram - at most classes x 65,536 rows - gives
each bucket's offset by a running sum, and only the rows *inside* one bucket
are ranked against each other.  Every window partition then holds about
1/65,536 of a class, and the result is exact.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 16


def _hash(id_cols: list[str], seed: int) -> Column:
    return F.xxhash64(F.lit(int(seed)), *[F.col(c) for c in id_cols])


def hash_positions(df: DataFrame, label: str, id_cols: list[str], seed: int) -> DataFrame:
    """Adds ``_pos`` (0-based position of the row in its class, seeded hash order)
    and ``_n`` (class size)."""
    h = _hash(id_cols, seed)
    keyed = df.select("*", h.alias("_h"),
                      F.shiftright(h, 64 - BUCKET_BITS).alias("_b"))
    hist = keyed.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hist.select(label, "_b",
                          F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"),
                          F.sum("_cnt").over(Window.partitionBy(label)).alias("_n"))
    wb = Window.partitionBy(label, "_b").orderBy("_h", *id_cols)
    ranked = keyed.select("*", (F.row_number().over(wb) - 1).alias("_rn"))
    return (ranked.join(offsets, [label, "_b"])
            .select("*", (F.col("_off") + F.col("_rn")).alias("_pos"))
            .drop("_h", "_b", "_rn", "_off"))


def stratified_sample(df: DataFrame, label: str, id_cols: list[str], fraction: float,
                      seed: int = 42, min_per_class: int = 50) -> DataFrame:
    """Per class max(round_half_even(n * fraction), min(n, min_per_class)) rows,
    without replacement, reproducible for a seed.  Exact counts."""
    pos = hash_positions(df, label, id_cols, seed)
    n = F.col("_n")
    take = F.greatest(F.bround(n * F.lit(float(fraction)), 0),
                      F.least(n, F.lit(min_per_class)).cast("double"))
    return pos.filter(F.col("_pos") < take).drop("_pos", "_n")


def stratified_folds(df: DataFrame, label: str, id_cols: list[str], k: int,
                     seed: int = 0) -> DataFrame:
    """``fold`` in 0..k-1, class balanced, shuffled by a seeded hash."""
    pos = hash_positions(df, label, id_cols, seed)
    return pos.select("*", F.pmod(F.col("_pos"), F.lit(int(k))).cast("int").alias("fold")) \
        .drop("_pos", "_n")


def temporal_split(df: DataFrame, date_col: str, test_size: float = 0.3
                   ) -> tuple[DataFrame, _dt.date]:
    """cutoff = day of the (1 - test_size) row-level linear quantile of a date;
    test = date > cutoff; NULL dates go to train.  If a side would be empty, the
    distinct date at index round((1-ts)(n-1)) (at most n-2) is used.  Fewer than
    two distinct dates is an error.
    """
    day = F.unix_date(F.to_date(F.col(date_col)))
    row = df.agg(F.percentile(day, 1.0 - test_size).alias("q"),
                 F.count_distinct(day).alias("nd"), F.max(day).alias("mx"),
                 F.min(day).alias("mn")).collect()[0]
    if row["nd"] is None or row["nd"] < 2:
        raise ValueError("temporal split needs at least 2 distinct dates")
    cutoff_day = int(row["q"] // 1)
    if not (row["mn"] <= cutoff_day < row["mx"]):
        # one side would be empty: fall back to the distinct-date index rule
        idx = int(round((1.0 - test_size) * (row["nd"] - 1)))
        idx = min(max(idx, 0), row["nd"] - 2)
        w = Window.orderBy("d")  # distinct dates only
        pick = (df.select(day.alias("d")).where(F.col("d").isNotNull()).distinct()
                .select("d", (F.row_number().over(w) - 1).alias("i"))
                .where(F.col("i") == idx).collect()[0])
        cutoff_day = int(pick["d"])
    cutoff = _dt.date(1970, 1, 1) + _dt.timedelta(days=cutoff_day)
    part = F.when(day > cutoff_day, F.lit("test")).otherwise(F.lit("train"))
    return df.withColumn("part", part), cutoff


def check_calendar(frame: DataFrame, date_col: str = "snapshot_date", split: str = "split") -> None:
    """An error unless both parts have rows and every train date lies before every test date."""
    ends = {r[split]: (r["a"], r["b"]) for r in frame.groupBy(split).agg(F.min(date_col).alias("a"), F.max(date_col).alias("b")).collect()}
    if set(ends) != {"train", "test"}:
        raise ValueError(f"calendar split: one part only ({', '.join(sorted(ends)) or 'no rows'})")
    if ends["train"][1] >= ends["test"][0]:
        raise ValueError(f"calendar split: train dates up to {ends['train'][1]} meet test dates from {ends['test'][0]}")
