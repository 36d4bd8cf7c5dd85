"""Panel profiling (survey family B).

Many-column statistics are computed in one pass: either one ``agg`` with an
expression per column (null shares, penetration, numeric summaries), or an
unpivot to (column, value) followed by a single grouped count (value
shares), never one job per column.  Everything returned is a small report
table.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import exact_quantiles_many
from ..products import PRODUCTS

# Human labels of the panel columns (column dictionary).
COLUMN_LABELS = {
    "ncodpers": "client id",
    "fecha_dato": "snapshot date",
    "q": "snapshot index (quarters since 1995)",
    "age": "age",
    "fecha_alta": "date of the first contract",
    "antiguedad": "tenure in months",
    "renta": "household income",
    "segmento": "client segment",
    "pais_residencia": "country of residence",
    "canal_entrada": "acquisition channel",
}


def null_shares(df: DataFrame) -> DataFrame:
    """B1: (column, null_share) for columns with any NULL, one aggregate pass."""
    cols = [c for c in df.columns]
    row = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in cols])
    return row.unpivot([], cols, "column", "null_share").filter(F.col("null_share") > 0)


def date_range(df: DataFrame, col: str) -> DataFrame:
    """B2: min, max, null count and share of a date column (bad text -> NULL)."""
    d = F.to_date(F.col(col).cast("string")) if dict(df.dtypes)[col] == "string" else \
        F.col(col).cast("date")
    return df.agg(F.lit(col).alias("column"), F.min(d).alias("min_date"),
                  F.max(d).alias("max_date"), F.count_if(d.isNull()).alias("nulls"),
                  F.avg(d.isNull().cast("int")).alias("null_share"))


def monthly_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per calendar month of a date column."""
    return df.groupBy(F.trunc(F.col(col), "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"))


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: distinct, nulls, mean, skew, excess kurtosis (population),
    count, std, min, p25, p50, p75, p95, p99, max - on all rows, one pass."""
    probs = [0.25, 0.5, 0.75, 0.95, 0.99]
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count_distinct(x).alias(f"{c}__nunique"),
                 F.count_if(x.isNull()).alias(f"{c}__nulls"),
                 F.avg(x).alias(f"{c}__mean"), F.skewness(x).alias(f"{c}__skew"),
                 F.kurtosis(x).alias(f"{c}__kurt"), F.count(x).alias(f"{c}__count"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    row = df.agg(*aggs)
    # exact, without a one-task value map; all columns share the passes
    allq = exact_quantiles_many(df, {c: (c, probs) for c in columns})
    parts = []
    for c in columns:
        qs = allq[c]
        p = F.array(*[F.lit(q).cast("double") for q in qs])
        parts.append(row.select(
            F.lit(c).alias("column"), F.col(f"{c}__nunique").alias("n_unique"),
            F.col(f"{c}__nulls").alias("nulls"),
            *[F.round(F.col(f"{c}__{k}"), 6).alias(k) for k in ("mean", "skew", "kurt")],
            F.col(f"{c}__count").alias("count"), F.round(F.col(f"{c}__std"), 6).alias("std"),
            F.col(f"{c}__min").alias("min"),
            *[F.round(p[i], 6).alias(n) for i, n in enumerate(["p25", "p50", "p75", "p95", "p99"])],
            F.col(f"{c}__max").alias("max")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram (last bin closed) as (bin, lo, hi, n).

    The range is a two-number aggregate read back as literals, so the
    binning pass is a plain projection + partial aggregate.
    """
    x = F.col(col).cast("double")
    mm = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx")).collect()[0]
    mn, mx = mm["mn"], mm["mx"]
    if mn is None:
        return df.sparkSession.createDataFrame(
            [], "column string, bin int, lo double, hi double, n bigint")
    width = (mx - mn) / bins or 1.0
    b = F.least(F.floor((x - F.lit(mn)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counted = df.filter(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.lit(col).alias("column"), "bin",
                          F.round(F.lit(mn) + F.col("bin") * F.lit(width), 6).alias("lo"),
                          F.round(F.lit(mn) + (F.col("bin") + 1) * F.lit(width), 6).alias("hi"),
                          "n")


def box_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column the box plot's numbers: quartiles, whisker ends (the outermost values within 1.5 interquartile ranges of the box) and
    outlier counts on both sides.  Quartiles come from shared histogram passes, the rest from one aggregate."""
    quartiles = exact_quantiles_many(df, {c: (c, [0.25, 0.5, 0.75]) for c in columns})
    aggs, rows = [], []
    for c in columns:
        q1, _, q3 = (None if v is None else float(v) for v in quartiles[c])
        if q1 is None:
            continue
        x, low, high = F.nanvl(F.col(c).cast("double"), F.lit(None)), q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = F.when((x >= low) & (x <= high), x)
        aggs += [F.min(inside).alias(f"{c}__lo"), F.max(inside).alias(f"{c}__hi"),
                 F.count_if(x < low).alias(f"{c}__below"), F.count_if(x > high).alias(f"{c}__above")]
        rows.append(c)
    if not rows:
        return df.sparkSession.createDataFrame([], "column string, q1 double, median double, q3 double, whisker_lo double, whisker_hi double, "
                                                   "outliers_lo bigint, outliers_hi bigint")
    found = df.agg(*aggs)
    return found.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), *[F.round(F.lit(float(v)), 6).alias(n) for v, n in zip(quartiles[c], ("q1", "median", "q3"), strict=True)],
        F.round(F.col(f"{c}__lo"), 6).alias("whisker_lo"), F.round(F.col(f"{c}__hi"), 6).alias("whisker_hi"),
        F.col(f"{c}__below").alias("outliers_lo"), F.col(f"{c}__above").alias("outliers_hi")) for c in rows])).alias("r")).select("r.*")


# The coefficients of the rational approximation of the inverse normal distribution (relative error below 1.2e-9).
_NORMAL_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_NORMAL_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01, -1.328068155288572e+01, 1.0)
_NORMAL_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_NORMAL_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00, 1.0)
_NORMAL_TAIL = 0.02425


def _poly(x, coefficients):
    out = F.lit(0.0)
    for c in coefficients:
        out = out * x + F.lit(c)
    return out


def inverse_normal(p):
    """The standard normal quantile of a column of probabilities in (0, 1); NULL outside."""
    tail = lambda t: _poly(t, _NORMAL_C) / _poly(t, _NORMAL_D)
    r = p - 0.5
    middle = r * _poly(r * r, _NORMAL_A) / _poly(r * r, _NORMAL_B)
    return F.when((p > 0) & (p < _NORMAL_TAIL), tail(F.sqrt(-2 * F.ln(p)))).when(
        (p > 1 - _NORMAL_TAIL) & (p < 1), -tail(F.sqrt(-2 * F.ln(1 - p)))).when((p > 0) & (p < 1), middle)


def qq_points(df: DataFrame, column: str, points: int = 99) -> DataFrame:
    """(column, p, theoretical, sample): the sample quantile against the normal one at evenly spaced plotting positions p = i / (points + 1).

    The sample side is exact (shared histogram passes, no sort of the column),
    the normal side a column expression.
    """
    places = [(i + 1) / (points + 1) for i in range(points)]
    sample = exact_quantiles_many(df, {column: (column, places)})[column]
    rows = df.sparkSession.createDataFrame([(column, p, None if v is None else float(v)) for p, v in zip(places, sample, strict=True)],
                                           "column string, p double, sample double").filter("sample is not null")
    return rows.select("column", F.round("p", 6).alias("p"), F.round(inverse_normal(F.col("p")), 6).alias("theoretical"), F.round("sample", 6).alias("sample"))


def qq_fit(points: DataFrame) -> DataFrame:
    """Per column the least-squares line through the Q-Q points and their correlation."""
    slope = F.try_divide(F.covar_pop("theoretical", "sample"), F.var_pop("theoretical"))
    return points.groupBy("column").agg(slope.alias("slope"), (F.avg("sample") - slope * F.avg("theoretical")).alias("intercept"),
                                        F.corr("theoretical", "sample").alias("r")).select(
        "column", *[F.round(c, 6).alias(c) for c in ("slope", "intercept", "r")])


def penetration(df: DataFrame, products: list[str] = PRODUCTS) -> DataFrame:
    """(product, penetration %) for every flag, one aggregate + unpivot."""
    row = df.agg(*[(F.avg(F.col(p).cast("double")) * 100).alias(p) for p in products])
    return row.unpivot([], products, "product", "penetration").select(
        "product", F.round("penetration", 6).alias("penetration"),
        (F.col("penetration") < 1.0).alias("below_1pct"))


def penetration_by(df: DataFrame, by: str, products: list[str] = PRODUCTS) -> DataFrame:
    """(group, product, penetration %) - one grouped aggregate, then unpivot."""
    g = df.groupBy(by).agg(*[(F.avg(F.col(p).cast("double")) * 100).alias(p) for p in products])
    return g.unpivot([by], products, "product", "penetration").select(
        by, "product", F.round("penetration", 6).alias("penetration"))


def value_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """Normalized value counts of every listed column (values as text)."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns])).alias("kv")).select("kv.column", "kv.value")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    # per-column totals: one row per column, broadcast back (a window per column
    # would put every distinct value of a column into one task)
    totals = counts.groupBy("column").agg(F.sum("n").alias("_total"))
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", "n", (F.col("n") / F.col("_total")).alias("share"))


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and duplicates; one grouped count on all columns."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("distinct_rows")).select(
        "rows", "distinct_rows", (F.col("rows") - F.col("distinct_rows")).alias("duplicates"))


def dependency_violations(df: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct (a, b) pairs and keys mapping to > 1 value, both ways."""
    pairs = df.select(a, b).distinct()
    ab = pairs.groupBy(a).agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    ba = pairs.groupBy(b).agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    return (ab.agg(F.count(F.lit(1)).alias("violations"))
            .select(F.lit(f"{a}->{b}").alias("direction"), "violations")
            .unionByName(ba.agg(F.count(F.lit(1)).alias("violations"))
                         .select(F.lit(f"{b}->{a}").alias("direction"), "violations")))


def active_periods(panel: DataFrame) -> DataFrame:
    """Per client and product, first and last snapshot where it was held."""
    return (panel.select("ncodpers", "fecha_dato", F.explode("owned").alias("code"))
            .groupBy("ncodpers", "code")
            .agg(F.min("fecha_dato").alias("start"), F.max("fecha_dato").alias("end")))


def panel_volume(panel: DataFrame, events: DataFrame) -> DataFrame:
    """Rows, columns, snapshots, clients, clients with events."""
    v = panel.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct("fecha_dato").alias("snapshots"),
                  F.count_distinct("ncodpers").alias("clients"))
    e = events.agg(F.count_distinct("ncodpers").alias("event_clients"))
    both = v.unionByName(e, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("rows", "snapshots", "clients", "event_clients")])
    return both.select("rows", F.lit(len(panel.columns)).alias("columns"), "snapshots",
                       "clients", "event_clients")


def column_dictionary(spark) -> DataFrame:
    """(column, label) dimension; product flags are labelled by their code."""
    rows = list(COLUMN_LABELS.items()) + [(p, f"owns product {p[-2:]}") for p in PRODUCTS]
    return spark.createDataFrame(rows, "column string, label string")


def near_duplicates(df: DataFrame, col: str, threshold: float = 0.8) -> DataFrame:
    """For each distinct value, its most similar other value with
    similarity = 1 - levenshtein / max(length) >= ``threshold``.

    Exact blocking instead of a cross product: if two values qualify, their
    edit distance is at most d = floor(len(a) / 4) (threshold 0.8), and
    splitting ``a`` into d + 1 pieces leaves at least one piece intact inside
    ``b`` (pigeonhole).  So candidates come from an equi-join of a's pieces
    with b's substrings of the piece lengths; only those pairs get a
    levenshtein check.  (Not difflib's ratio: the score is edit-distance based.)
    """
    if threshold < 0.8:
        raise ValueError("blocking is derived for threshold >= 0.8")
    vals = df.select(F.col(col).cast("string").alias("v")).where(F.col("v").isNotNull()) \
        .distinct().select("v", F.length("v").alias("n"))
    pieces = vals.select("v", "n", F.explode(F.expr(
        "transform(sequence(0, cast(floor(n / 4) as int)), i -> named_struct("
        "'start', cast(i * floor(n / (floor(n / 4) + 1)) + least(i, n % (floor(n / 4) + 1)) + 1 as int),"
        "'size', cast(floor(n / (floor(n / 4) + 1)) + if(i < n % (floor(n / 4) + 1), 1, 0) as int)))"
    )).alias("p")).select(F.col("v").alias("a"), F.col("n").alias("na"),
                          F.expr("substring(v, p.start, p.size)").alias("piece"),
                          F.col("p.size").alias("size"))
    sizes = [r[0] for r in pieces.select("size").distinct().collect()]  # <= max value length
    subs = vals.select(F.col("v").alias("b"), F.col("n").alias("nb"), F.explode(F.array(*[
        F.expr(f"transform(sequence(1, greatest(n - {s} + 1, 1)), i -> substring(v, i, {s}))")
        for s in sizes])).alias("subs")).select("b", "nb", F.explode("subs").alias("piece"))
    cand = (pieces.join(subs, "piece")
            .where((F.col("a") != F.col("b")) &
                   (F.abs(F.col("na") - F.col("nb")) <= F.floor(F.col("na") / 4)))
            .select("a", "b", "na", "nb").distinct())
    scored = cand.select("a", "b", (1 - F.levenshtein("a", "b") /
                                    F.greatest("na", "nb")).alias("similarity"))
    good = scored.where(F.col("similarity") >= threshold)
    w = Window.partitionBy("a").orderBy(F.col("similarity").desc(), F.col("b").desc())
    return good.select(F.col("a").alias("value"), F.col("b").alias("match"),
                       F.round("similarity", 9).alias("similarity"),
                       F.row_number().over(w).alias("_r")).where("_r = 1").drop("_r")


def _ratios(batches):
    """The share of matching blocks of each pair (value, match): 2 * matched / (both lengths); pairs below the threshold are left out."""
    from difflib import SequenceMatcher

    for pdf in batches:
        found = []
        for word, rows in pdf.groupby("value", sort=False):
            matcher = SequenceMatcher()
            matcher.set_seq2(word)  # analysed once, compared with many
            for other, least in zip(rows["match"], rows["least"], strict=True):
                matcher.set_seq1(other)
                if matcher.real_quick_ratio() >= least and matcher.quick_ratio() >= least and (r := matcher.ratio()) >= least:
                    found.append((word, other, r))
        yield pd.DataFrame(found, columns=["value", "match", "ratio"])


def close_matches(df: DataFrame, col: str, threshold: float = 0.8, n: int = 2) -> DataFrame:
    """(value, rank, match, ratio): of each distinct value with another one as close, its ``n`` closest values, itself included.

    The ratio is that of longest matching blocks (taken from the value's side,
    as it is not symmetric); equally close values come in falling order.  If a
    pair reaches the threshold, the value loses at most d characters and gaps,
    d = 2 (1 - threshold) / threshold of its length, so of d + 1 pieces one is
    whole in the match, shifted by at most d: candidates come from an equi-join
    on pieces, and only they are compared.
    """
    if not 2 / 3 < threshold <= 1:
        raise ValueError("pieces are whole only for thresholds above 2/3")
    vals = df.select(F.col(col).cast("string").alias("v")).where(F.col("v").isNotNull()).distinct().select("v", F.length("v").alias("n"))
    lost = lambda c: F.floor(F.lit(2 * (1 - threshold) / threshold + 1e-12) * c).cast("int")
    sized = vals.select("v", "n", lost(F.col("n")).alias("d"), (lost(F.col("n")) + 1).alias("k")).filter("n > 0")
    cut = "transform(sequence(0, k - 1), i -> struct(cast(floor(i * n / k) as int) as at, cast(floor((i + 1) * n / k) - floor(i * n / k) as int) as size))"
    pieces = sized.select(F.col("v").alias("value"), F.col("n").alias("n_a"), "d", F.explode(F.expr(cut)).alias("p")).select(
        "value", "n_a", "d", "p.at", F.expr("substring(value, p.at + 1, p.size)").alias("piece"))
    longest = pieces.agg(F.max(F.length("piece"))).first()[0] or 1
    subs = sized.select(F.col("v").alias("match"), F.col("n").alias("n_b"), F.explode(F.sequence(F.lit(1), F.lit(longest))).alias("size")).filter("size <= n_b").select(
        "match", "n_b", F.explode(F.expr("transform(sequence(0, n_b - size), i -> struct(i as at, substring(match, i + 1, size) as piece))")).alias("s")).select(
        "match", "n_b", F.col("s.at").alias("place"), F.col("s.piece").alias("piece"))
    least = F.lit(float(threshold))
    near = (F.abs(F.col("at") - F.col("place")) <= F.col("d")) & (F.col("value") != F.col("match")) & (
        2 * F.least("n_a", "n_b") >= least * (F.col("n_a") + F.col("n_b")))
    pairs = pieces.join(subs, "piece").where(near).select("value", "match").distinct().select("value", "match", least.alias("least"))
    close = pairs.mapInPandas(_ratios, "value string, match string, ratio double")
    own = close.select("value").distinct().select("value", F.col("value").alias("match"), F.lit(1.0).alias("ratio"))
    ranked = Window.partitionBy("value").orderBy(F.col("ratio").desc(), F.col("match").desc())
    return close.unionByName(own).select("value", F.row_number().over(ranked).alias("rank"), "match", F.round("ratio", 9).alias("ratio")).where(F.col("rank") <= n)
