"""Train-only preprocessing: fit statistics, apply them in one projection
(survey families F and G).

``fit_params`` runs a fixed number of aggregate passes over the train frame
(medians + modes + age histogram + date quantiles in the first, bin
statistics in the second, clip quantiles / rare values / drift deciles in the
third); every fitted number is an aggregate whose size is bounded by a
parameter (bins, intervals, quantiles), and only those small results reach the
driver; the rare-value dictionary, which grows with a column's categories,
stays a table.  ``apply_params`` is a single ``select`` of ``CASE WHEN`` /
``coalesce`` expressions with the fitted values as literals, after a left join
per column that has rare values; identical for batch and streaming input.
"""

from __future__ import annotations

import datetime as _dt
import math
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..products import PRODUCTS, TENURE_MISSING
from ..session import materialize
from .quantiles import exact_quantiles, exact_quantiles_many

MEDIAN_COLUMNS = ("age", "antiguedad", "renta")
# Columns without a mode (numeric, key and derived ones).
MODES_EXCLUDED = frozenset({"age", "antiguedad", "fecha_dato", "ncodpers", "renta", "q",
                            "purchase", "snapshot_date", "target_date", "split", "owned"})
DERIVED_COLUMNS = frozenset({"age_interval", "total_products", "recommended_product_id"})
DATE_COHORT_COLUMNS = ("fecha_alta", "ult_fec_cli_1t")
CLIP_COLUMNS = ("renta", "antiguedad")
# Categorical columns whose rare values are folded at apply time (product flags excluded).
CATEGORICAL_COLUMNS = ["pais_residencia", "canal_entrada", "segmento", "total_products",
                       "age_interval", "recommended_product_id",
                       "mean_renta_by_pais_residencia", "median_antiguedad_by_pais_residencia",
                       "mean_renta_by_segmento", "median_antiguedad_by_segmento"]

# Fallback parameters used when a fitted section is absent.
LEGACY_MEDIANS = {"age": 39.0, "antiguedad": 50.0, "renta": 101850.0}
LEGACY_MODES = {
    "ind_empleado": "N", "pais_residencia": "ES", "sexo": "V", "fecha_alta": "2014-07-28",
    "ind_nuevo": 0, "ult_fec_cli_1t": "2015-12-24", "indrel_1mes": 1.0, "tiprel_1mes": "I",
    "indresi": "S", "conyuemp": "N", "canal_entrada": "KHE", "indfall": "N", "tipodom": 1,
    "cod_prov": 28, "nomprov": "MADRID", "ind_actividad_cliente": 0,
    "segmento": "02 - PARTICULARES", **{p: 0 for p in PRODUCTS},
}
LEGACY_CLIP_BOUNDS = {"renta": [26449.65, 337117.17], "antiguedad": [1.0, 207.0]}
LEGACY_AGE_INTERVALS = [[2, 23], [24, 28], [29, 36], [37, 41], [42, 45], [46, 49],
                        [50, 54], [55, 63], [64, 164]]
# Fallback date intervals ('start – end', closed, first match wins), in the
# order of the saved training run.
LEGACY_DATE_INTERVALS = {
    "fecha_alta": [
        "2014-08-13 – 2015-02-27", "2012-07-23 – 2012-12-10", "2013-10-18 – 2014-08-13",
        "2012-12-10 – 2013-10-18", "2004-04-23 – 2006-07-11", "2002-02-16 – 2004-04-23",
        "2011-09-01 – 2012-07-23", "2006-07-11 – 2008-09-30", "2008-09-30 – 2011-09-01",
        "2000-05-16 – 2002-02-16", "1995-01-15 – 2000-05-16", "2015-02-27 – 2016-05-31",
    ],
    "ult_fec_cli_1t": [
        "2015-06-30 – 2015-07-09", "2015-07-21 – 2015-08-03", "2015-07-09 – 2015-07-21",
        "2015-08-03 – 2015-09-14", "2015-09-14 – 2015-10-19", "2015-10-19 – 2015-11-18",
        "2015-11-18 – 2015-12-21", "2015-12-21 – 2016-01-11", "2016-01-11 – 2016-02-10",
        "2016-02-10 – 2016-03-16", "2016-03-16 – 2016-04-26", "2016-04-26 – 2016-05-30",
    ],
}
COHORT_DASH = " – "


@dataclass
class PrepParams:
    medians: dict[str, float] = field(default_factory=dict)
    modes: dict[str, Any] = field(default_factory=dict)
    clip_bounds: dict[str, list[float]] = field(default_factory=dict)
    age_intervals: list[list[int]] = field(default_factory=list)
    date_cohorts: dict[str, dict] = field(default_factory=dict)
    date_intervals: dict[str, list[str]] = field(default_factory=dict)
    replacer: dict[str, dict[str, str]] = field(default_factory=dict)
    drift_reference: dict[str, dict] = field(default_factory=dict)
    aggregates: dict[str, dict[str, float]] = field(default_factory=dict)
    label_map: dict[int, str] = field(default_factory=dict)
    feature_columns: dict[str, list[str]] = field(default_factory=dict)
    created_at: str | None = None
    source: str = "defaults"
    #: Fitted rare values (column, value), and the columns that have any; ``replacer`` is the form of a given file.
    rare: DataFrame | None = None
    rare_columns: list[str] = field(default_factory=list)


# --- F1 / F4 / F5 ----------------------------------------------------------------

def coerce_numeric(df: DataFrame) -> DataFrame:
    """age, tenure, income to double (bad text -> NULL); tenure sentinel -> NULL."""
    out = []
    for f in df.schema.fields:
        c = f.name
        if c in MEDIAN_COLUMNS:
            e = F.col(c) if f.dataType.typeName() == "double" else \
                F.expr(f"try_cast(`{c}` AS DOUBLE)")
            if c == "antiguedad":
                e = F.when(e == float(TENURE_MISSING), F.lit(None).cast("double")).otherwise(e)
            out.append(e.alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def fill_missing(df: DataFrame, medians: dict[str, float], modes: dict[str, Any]) -> DataFrame:
    """numeric NULL -> median (legacy default if absent), others -> mode."""
    fills = {}
    for c in MEDIAN_COLUMNS:
        if c in df.columns:
            fills[c] = medians.get(c, LEGACY_MEDIANS[c])
    for c, v in modes.items():
        if c in df.columns and c not in fills:
            fills[c] = v
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    cols = []
    for c in df.columns:
        if c in fills and fills[c] is not None:
            v = fills[c]
            if types[c] == "date" and isinstance(v, str):
                v = _dt.date.fromisoformat(v)
            cols.append(F.coalesce(F.col(c), F.lit(v).cast(types[c] if types[c] != "void"
                                                            else "string")).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def total_products(flags: list[str] = PRODUCTS) -> Column:
    """number of held products; non-numeric flags count as missing (0)."""
    return sum((F.coalesce(F.expr(f"try_cast(`{c}` AS DOUBLE)"), F.lit(0.0)) for c in flags),
               F.lit(0.0))


# --- F6 / G1 -------------------------------------------------------------------

def age_intervals(df: DataFrame, n_intervals: int = 9) -> DataFrame:
    """(i, lo, hi) intervals holding ~1/n of all held products each.

    upper_i = smallest age whose cumulative product count exceeds i*total/n
    (the last age if none); next lower = upper + 1; last upper = max age.
    Works on the per-age histogram (one row per distinct age).
    """
    hist = df.groupBy("age").agg(F.sum("total_products").alias("tp"))
    w = Window.orderBy("age").rowsBetween(Window.unboundedPreceding, 0)  # distinct ages
    cum = hist.select("age", F.sum("tp").over(w).alias("cum"),
                      F.sum("tp").over(Window.partitionBy()).alias("total"),
                      F.min("age").over(Window.partitionBy()).alias("amin"),
                      F.max("age").over(Window.partitionBy()).alias("amax"))
    targets = cum.select(F.explode(F.sequence(F.lit(1), F.lit(n_intervals - 1))).alias("i"),
                         "age", "cum", "total", "amin", "amax")
    uppers = (targets.groupBy("i").agg(
        F.min(F.when(F.col("cum") > F.col("i") * F.col("total") / n_intervals,
                     F.col("age"))).alias("u"),
        F.first("amax").alias("amax"), F.first("amin").alias("amin"))
        .select("i", F.coalesce("u", "amax").alias("upper"), "amin", "amax"))
    w2 = Window.orderBy("i")  # n_intervals rows
    inner = uppers.select("i", F.coalesce(F.lag("upper").over(w2) + 1, F.col("amin")).alias("lo"),
                          F.col("upper").alias("hi"), "amax")
    last = inner.groupBy().agg(F.max("i").alias("i"), F.max("hi").alias("prev_hi"),
                               F.first("amax").alias("amax"))
    # The last interval starts after the last computed upper and ends at the max age.
    last_row = inner.join(last.select("i"), "i").select(
        (F.col("i") + 1).alias("i"), (F.col("hi") + 1).alias("lo"), F.col("amax").alias("hi"))
    return (inner.select("i", "lo", "hi").unionByName(last_row)
            .select(F.col("i").cast("int").alias("i"), F.col("lo").cast("int").alias("lo"),
                    F.col("hi").cast("int").alias("hi")))


def age_interval_expr(age: Column, intervals: list[list[int]]) -> Column:
    """G1: clip to [first lo, last hi]; right-closed bins on the lowers + last hi."""
    bins = [iv[0] for iv in intervals] + [intervals[-1][1]]
    labels = [f"{iv[0]}-{iv[1]}" for iv in intervals]
    a = F.when(age < bins[0], F.lit(float(bins[0]))).when(age > bins[-1], F.lit(float(bins[-1]))) \
        .otherwise(age)
    out = F.lit(None).cast("string")
    for edge, label in reversed(list(zip(bins[1:], labels))):
        out = F.when(a <= edge, F.lit(label)).otherwise(out)
    return F.when(age.isNull(), F.lit(None).cast("string")).otherwise(out)


# --- F7 / F8 / G2 / G3 ---------------------------------------------------------

def _round_half_even(x: float) -> float:
    return float(round(x))


def date_cohort_spec(df: DataFrame, col: str, max_cohorts: int = 12) -> dict:
    """equal-frequency cohorts of a date column as a serving spec.

    Days since the minimum date; q = min(max_cohorts, distinct days); linear
    quantile edges with duplicates dropped; bins (a, b], the first including
    its left edge.  The spec keeps the **observed** last day of each bin
    (left = previous right, first left = min - 1); labels come from the
    edges rounded half-to-even, the first left edge minus one.  Failure ->
    mode ``raw``.
    """
    d = as_date(F.col(col))
    stats = df.agg(F.min(d).alias("base"), F.count_distinct(d).alias("nd"),
                   F.count_if(d.isNull()).alias("nnull")).collect()[0]
    if stats["base"] is None:
        return {"mode": "raw"}
    base = stats["base"]
    days = F.datediff(d, F.lit(base))
    n = min(max_cohorts, int(stats["nd"]) + (stats["nnull"] > 0))  # missing dates count as one more value
    if n < 1:
        return {"mode": "raw"}
    probs = [i / n for i in range(n + 1)]
    edges = df.agg(F.percentile(days, probs).alias("e")).collect()[0]["e"]
    edges = sorted(set(float(e) for e in edges))
    if len(edges) < 2:
        return {"mode": "raw"}
    inner = edges[1:]
    bin_idx = _once(days, lambda x: F.size(F.filter(F.array(*[F.lit(e) for e in inner]), lambda e: e < x)))
    per_bin = (df.filter(d.isNotNull()).groupBy(bin_idx.alias("b"))
               .agg(F.max(days).alias("r"), F.min(days).alias("l")).collect())
    obs = {int(r["b"]): (int(r["l"]), int(r["r"])) for r in per_bin}
    labels = []
    for i in range(len(edges) - 1):
        left = _round_half_even(edges[i]) - (1 if i == 0 else 0)
        right = _round_half_even(edges[i + 1])
        labels.append(f"{(base + _dt.timedelta(days=int(left))).isoformat()}{COHORT_DASH}"
                      f"{(base + _dt.timedelta(days=int(right))).isoformat()}")
    rights, lefts, kept = [], [], []
    for i in range(len(labels)):
        if i in obs:
            rights.append(obs[i][1])
            kept.append(labels[i])
    if not rights:
        return {"mode": "raw"}
    first_left = obs[min(obs)][0] - 1
    lefts = [first_left] + rights[:-1]
    missing_label = "nan" if stats["nnull"] else "unknown"
    kept_bins = [i for i in range(len(labels)) if i in obs]
    return {"mode": "intervals", "base_date": base.isoformat(), "closed": "right",
            "missing_label": missing_label, "edges": edges, "bins": kept_bins,
            "intervals": [{"left_days": l, "right_days": r, "label": lab}
                          for l, r, lab in zip(lefts, rights, kept)]}


def as_date(value: Column) -> Column:
    """Date from a date, timestamp or text column; unparseable text -> NULL."""
    return F.try_to_timestamp(value.cast("string")).cast("date")


def _once(value: Column, of) -> Column:
    """``of(value)`` with ``value`` computed once a row, however often ``of`` uses it."""
    return F.get(F.transform(F.array(value), of), 0)


def date_cohort_expr(value: Column, spec: dict) -> Column:
    """Date -> cohort label by the spec (NULL -> missing label, outside -> unknown)."""
    d = as_date(F.col(value) if isinstance(value, str) else value)
    if spec.get("mode") == "raw":
        return F.coalesce(F.date_format(d, "yyyy-MM-dd"), F.lit("unknown"))

    def label(days: Column) -> Column:
        out = F.lit("unknown")
        for iv in reversed(spec["intervals"]):
            out = F.when((days > iv["left_days"]) & (days <= iv["right_days"]),
                         F.lit(iv["label"])).otherwise(out)
        return F.when(days.isNull(), F.lit(spec.get("missing_label", "unknown"))).otherwise(out)

    return _once(F.datediff(d, F.lit(_dt.date.fromisoformat(spec["base_date"]))), label)


def fit_cohort_expr(value: Column, spec: dict) -> Column:
    """The label the fit itself gives a date: its quantile bin on the exact edges."""
    d = F.datediff(as_date(value), F.lit(_dt.date.fromisoformat(spec["base_date"])))
    inner = spec["edges"][1:]

    def label(b: Column) -> Column:
        out = F.lit("unknown")
        for i, iv in zip(spec["bins"], spec["intervals"]):
            out = F.when(b == i, F.lit(iv["label"])).otherwise(out)
        return F.when(b.isNull(), F.lit(spec.get("missing_label", "unknown"))).otherwise(out)

    place = _once(d, lambda x: F.when(x.isNotNull(), F.size(F.filter(F.array(*[F.lit(float(e)) for e in inner]), lambda e: e < x))))
    return _once(place, label)


def cohort_mismatches(df: DataFrame, col: str, spec: dict) -> DataFrame:
    """F8: rows whose served cohort (spec intervals) differs from the fit's label."""
    served = date_cohort_expr(F.col(col), spec)
    return df.agg(F.count_if(served != fit_cohort_expr(F.col(col), spec)).alias("mismatches"),
                  F.count(F.lit(1)).alias("rows"))


def fixed_interval_expr(value: Column, intervals: list[str]) -> Column:
    """First closed 'start – end' interval containing the date, else NULL."""
    def label(d: Column) -> Column:
        out = F.lit(None).cast("string")
        for text in reversed(intervals):
            start, end = text.split(COHORT_DASH)
            out = F.when(d.between(F.lit(_dt.date.fromisoformat(start)),
                                   F.lit(_dt.date.fromisoformat(end))), F.lit(text)).otherwise(out)
        return out

    return _once(as_date(value), label)


# --- F9 / G4, F10 / G5, F11 ------------------------------------------------------

def rare_values(df: DataFrame, columns: list[str], threshold: float = 0.01) -> DataFrame:
    """(column, value) pairs whose share (values as text) is below ``threshold``.

    One unpivot + one grouped count for all columns; shares by a window over
    the per-column totals (one row per distinct value).
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, value string, share double")
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"),
                 F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("value"))
        for c in columns])).alias("kv")).select("kv.column", "kv.value")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("column").agg(F.sum("n").alias("_total"))  # one row per column
    share = F.col("n") / F.col("_total")
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", share.alias("share")).filter(F.col("share") < threshold)


def fold_rare_expr(col: str, mapping: dict[str, str]) -> Column:
    """Value (as text) found in the dictionary -> its replacement, else unchanged."""
    if not mapping:
        return F.col(col)
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    as_text = F.col(col).cast("string")
    return F.coalesce(F.element_at(m, as_text), as_text)


def fold_rare_join(df: DataFrame, rare: DataFrame, columns: list[str],
                   replacement: str = "other") -> DataFrame:
    """G4, join form: ``rare`` = (column, value) rows of any size (e.g. from
    ``rare_values``); matched values (as text) -> ``replacement``, others as text.

    One left join per column on the value; the dictionary side is left to
    AQE (broadcast only when its measured size is under the threshold).
    """
    out = df
    for c in columns:
        if c not in out.columns:
            continue
        d = rare.filter(F.col("column") == c).select(F.col("value").alias("_rare")).distinct()
        as_text = F.col(c).cast("string")
        j = out.join(d, as_text == F.col("_rare"), "left")
        out = j.select(*[F.when(F.col("_rare").isNotNull(), F.lit(replacement))
                          .otherwise(as_text).alias(c) if x == c else F.col(x)
                         for x in out.columns])
    return out


def clip_expr(col: str, lo: float, hi: float) -> Column:
    """Clip to [lo, hi]; NULL stays NULL."""
    c = F.col(col)
    return F.when(c < lo, F.lit(float(lo))).when(c > hi, F.lit(float(hi))).otherwise(c)


def drift_reference(df: DataFrame, columns=MEDIAN_COLUMNS, n_bins: int = 10,
                    deciles: dict[str, list[float | None]] | None = None) -> dict:
    """per column, unique decile edges (ends -> -inf/+inf) and bin shares.

    Skips columns with < 2 distinct values (min = max) or < 3 edges.  Bins
    [a, b), last closed.  Two passes: the exact quantiles of all columns
    together (or ``deciles`` computed by the caller with ``drift_probs``),
    then the bin counts.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return {}
    valid = {c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in present}
    if deciles is None:
        deciles = exact_quantiles_many(df, {c: (valid[c], drift_probs(n_bins)) for c in present})
    specs = {}
    for c in present:
        qs = deciles[c]
        if qs[0] is None or not qs[0] < qs[-1]:
            continue
        edges = sorted(set(float(e) for e in qs))
        if len(edges) < 3:
            continue
        specs[c] = edges
    if not specs:
        return {}
    # The row's bins first, so that each is found once and not for every count.
    bins = [_bin(valid[c], edges[1:-1]).alias(c) for c, edges in specs.items()]
    counts = df.select(*bins).agg(*[F.count_if(F.col(c) == i).alias(f"{c}__{i}")
                                    for c, edges in specs.items() for i in range(len(edges) - 1)]).collect()[0]
    out = {}
    for c, edges in specs.items():
        cnt = [int(counts[f"{c}__{i}"]) for i in range(len(edges) - 1)]
        total = sum(cnt)
        e = list(edges)
        e[0], e[-1] = -math.inf, math.inf
        out[c] = {"edges": e, "shares": [x / total for x in cnt]}
    return out


def _bin(value: Column, inner: list[float]) -> Column:
    """Place of the [a, b) bin between the inner edges; NULL for NULL."""
    return F.when(value.isNotNull(), F.size(F.filter(F.array(*[F.lit(e) for e in inner]), lambda e: e <= value)))


def drift_probs(n_bins: int = 10) -> list[float]:
    return [i / n_bins for i in range(n_bins + 1)]


# --- F12 / G6 --------------------------------------------------------------------

def mode_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in MODES_EXCLUDED and c not in DERIVED_COLUMNS]


def mode_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, number): the most frequent non-null value of each column, as text; of equally frequent ones the smallest.

    One unpivot and grouped counts; no task holds a column's values.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = lambda c: F.col(c).cast("double") if isinstance(types[c], T.NumericType) else F.lit(None).cast("double")
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), numeric(c).alias("number")) for c in columns])).alias("p")).select("p.*")
    counts = pairs.filter("value is not null").groupBy("column", "value", "number").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), "number", "value"))
    return counts.groupBy("column").agg(best.alias("m")).select("column", "m.value", "m.number")


def column_modes(df: DataFrame, columns: list[str]) -> dict[str, Any]:
    """the modes as Python values of the columns' types (dates as ISO text)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out: dict[str, Any] = {}
    for r in mode_counts(df, columns).collect() if columns else []:  # one row a column
        kind = types[r["column"]]
        out[r["column"]] = (int(r["value"]) if isinstance(kind, T.IntegralType) else r["number"] if isinstance(kind, T.NumericType) else r["value"])
    return {c: out[c] for c in columns if c in out}


def fit_params(fit_df: DataFrame, *, rare_threshold: float = 0.01, n_age_intervals: int = 9,
               max_cohorts: int = 12, clip_quantiles=(0.01, 0.96),
               drift_columns=MEDIAN_COLUMNS, drift_bins: int = 10) -> PrepParams:
    """fit all preprocessing statistics on the train frame (order as the reference)."""
    df = coerce_numeric(fit_df.drop("purchase"))
    df = df.persist()
    try:
        mcols = mode_columns(df)
        med_cols = [c for c in MEDIAN_COLUMNS if c in df.columns]
        modes = column_modes(df, mcols)
        # medians and drift deciles of the raw columns share three passes
        drift_cols = [c for c in drift_columns if c in df.columns]
        probs = {c: [0.5] * (c in med_cols) + drift_probs(drift_bins) * (c in drift_cols) for c in dict.fromkeys([*med_cols, *drift_cols])}
        qs = exact_quantiles_many(df, {c: (c, p) for c, p in probs.items()})
        medians = {}
        for c in med_cols:
            m = qs[c][0]
            if m is not None:
                medians[c] = float(m)
        work = fill_missing(df, medians, modes)
        flags = [p for p in PRODUCTS if p in work.columns]
        if not flags or "age" not in work.columns:
            raise ValueError("fit_params(age_intervals=...): no column age, or none of the products, in the frame")
        work = work.withColumn("total_products", total_products(flags))
        ivs = [[r["lo"], r["hi"]] for r in
               age_intervals(work, n_age_intervals).orderBy("i").collect()]
        work = work.withColumn("age_interval", age_interval_expr(F.col("age"), ivs))
        cohorts = {}
        for c in DATE_COHORT_COLUMNS:
            if c in work.columns:
                spec = date_cohort_spec(work, c, max_cohorts)
                cohorts[c] = spec
                work = work.withColumn(c, date_cohort_expr(F.col(c), spec))
        rep_cols = [c for c in mcols if c not in PRODUCTS]
        rare = materialize(rare_values(work, rep_cols, rare_threshold).select("column", "value"), "rare-values")
        found = sorted(r[0] for r in rare.select("column").distinct().collect())  # column names
        clip_cols = [c for c in CLIP_COLUMNS if c in work.columns]
        cq = exact_quantiles_many(work, {c: (c, list(clip_quantiles)) for c in clip_cols})
        clip = {}
        for c in clip_cols:
            lo, hi = cq[c]
            if lo is not None:
                clip[c] = [float(lo), float(hi)]
        drift = drift_reference(df, drift_columns, drift_bins,
                                deciles={c: qs[c][int(c in med_cols):] for c in drift_cols})
    finally:
        df.unpersist()
    return PrepParams(medians=medians, modes=modes, clip_bounds=clip, age_intervals=ivs,
                      date_cohorts=cohorts, drift_reference=drift, rare=rare, rare_columns=found,
                      created_at=_dt.datetime.now(_dt.timezone.utc).isoformat(timespec="seconds"), source="fit(train)")


def apply_params(df: DataFrame, params: PrepParams) -> DataFrame:
    """F1, F4, G1, G2/G3, G4, G5, F5 (if all flags) as one projection, after the joins of G4."""
    df = coerce_numeric(df)
    df = fill_missing(df, params.medians, params.modes)
    if params.rare is not None:
        df = fold_rare_join(df, params.rare, [c for c in CATEGORICAL_COLUMNS if c in params.rare_columns and c in df.columns])
    ivs = params.age_intervals or LEGACY_AGE_INTERVALS
    cols = {c: F.col(c) for c in df.columns}
    if "age" in cols:
        cols["age_interval"] = age_interval_expr(F.col("age"), ivs)
    for c in DATE_COHORT_COLUMNS:
        if c not in cols:
            continue
        if params.date_cohorts.get(c):
            cols[c] = date_cohort_expr(F.col(c), params.date_cohorts[c])
        elif params.date_intervals.get(c):
            cols[c] = fixed_interval_expr(F.col(c), params.date_intervals[c])
    for c in CATEGORICAL_COLUMNS:
        if c in df.columns and params.replacer.get(c):
            cols[c] = fold_rare_expr(c, params.replacer[c])
    for c, (lo, hi) in params.clip_bounds.items():
        if c in cols:
            cols[c] = clip_expr(c, lo, hi)
    if all(p in df.columns for p in PRODUCTS):
        cols["total_products"] = total_products(PRODUCTS)
    return df.select(*[e.alias(c) for c, e in cols.items()])
