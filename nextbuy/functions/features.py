"""Derived features (survey family H): pair arithmetic, ratios, group
statistics, sanitising, feature typing and the matrix quality check.

Group statistics are tables, one row per category, whatever the number of
categories: means by one partial aggregate, medians by grouped histogram
refinement.  They are applied by a left join on the category, which Spark
broadcasts only when its measured size is under the broadcast threshold.
Parameters read from a file (plain dictionaries) are applied as literal maps.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .quantiles import exact_quantiles, grouped_quantile

GROUP_COLUMNS = ("pais_residencia", "segmento")
DEFAULT_KEY = "__default__"

# Derived numeric feature names (pair arithmetic on tenure and income).
PAIR_FEATURES = ["antiguedad_plus_renta", "antiguedad_div_renta", "renta_div_antiguedad",
                 "antiguedad_times_renta", "ln_antiguedad", "ln_renta", "sqrt_antiguedad",
                 "sqrt_renta"]
NUMERIC_FEATURES = ["antiguedad", "renta", *PAIR_FEATURES, "renta_antiguedad_ratio",
                    "log_renta", "renta_vs_country_mean"]


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def pair_arithmetic(t: Column, r: Column) -> list[Column]:
    """H1: sum, both quotients, product, ln and sqrt of tenure and income.

    Spark yields NULL where numpy yields +-inf (x/0, ln 0) and NULL or NaN
    for ln / sqrt of negatives; H5 maps all of these to 0.0, as the
    reference does after its own inf/NaN.
    """
    return [(t + r).alias("antiguedad_plus_renta"),
            _div(t, r).alias("antiguedad_div_renta"),
            _div(r, t).alias("renta_div_antiguedad"),
            (t * r).alias("antiguedad_times_renta"),
            F.ln(t).alias("ln_antiguedad"),
            F.ln(r).alias("ln_renta"),
            F.sqrt(t).alias("sqrt_antiguedad"),
            F.sqrt(r).alias("sqrt_renta")]


def ratio_and_log(t: Column, r: Column) -> list[Column]:
    """H2: income / (tenure + 1) and log1p(income)."""
    return [_div(r, t + 1).alias("renta_antiguedad_ratio"),
            F.log1p(r).alias("log_renta")]


@dataclass
class GroupStats:
    """H3: per grouping column a table (category, mean income, median tenure), and the values for unseen categories."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    defaults: dict[str, float | None] = field(default_factory=dict)

    def names(self, column: str) -> tuple[str, str]:
        return f"mean_renta_by_{column}", f"median_antiguedad_by_{column}"

    def as_dict(self) -> dict[str, dict[str, float]]:
        """The dictionaries of the saved form; for columns of few categories, as every category comes to the driver."""
        out: dict[str, dict[str, float]] = {}
        for c, t in self.tables.items():
            rows = t.collect()
            for name in self.names(c):
                out[name] = {r[c]: r[name] for r in rows} | {DEFAULT_KEY: self.defaults[name]}
        return out

    def attach(self, df: DataFrame) -> DataFrame:
        """``df`` with the statistics of its categories."""
        for c, t in self.tables.items():
            if c not in df.columns:
                continue
            mine = t.select(F.col(c).alias("_key"), *[F.col(n).alias(f"_{n}") for n in self.names(c)])
            joined = df.join(mine, F.col(c).cast("string") == F.col("_key"), "left")
            df = joined.select(*df.columns, *[F.coalesce(F.col(f"_{n}"), F.lit(self.defaults[n]).cast("double")).alias(n) for n in self.names(c)])
        return df


def fit_group_stats(train: DataFrame, columns=GROUP_COLUMNS) -> GroupStats:
    """H3 fit: mean income and median tenure per category + global default."""
    train = materialize(train.select("renta", "antiguedad", *columns), "group-input")
    mean = train.agg(F.avg("renta").alias("m")).first()["m"]
    median = exact_quantiles(train, "antiguedad", [0.5])[0]
    out = GroupStats()
    for c in columns:
        out.tables[c] = materialize(group_stats_table(train, c), f"group-{c}")
        out.defaults |= dict(zip(out.names(c), (mean, median), strict=True))
    return out


def group_stats_table(train: DataFrame, column: str) -> DataFrame:
    """H3 fit in table form: (category, mean income, median tenure); the NULL category is left out."""
    means = train.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias(column)).agg(F.avg("renta").alias(f"mean_renta_by_{column}"))
    medians = grouped_quantile(train, column, "antiguedad", 0.5).withColumnRenamed("value", f"median_antiguedad_by_{column}")
    return means.join(medians, column, "left")


def _lookup(col: str, stats: dict[str, float]) -> Column:
    default = stats.get(DEFAULT_KEY)
    if default is None:  # parameters saved without a default: mean of the stored values
        vals = [v for v in stats.values() if v is not None]
        default = sum(vals) / len(vals) if vals else None
    items = [(k, v) for k, v in stats.items() if k != DEFAULT_KEY and v is not None]
    if not items:
        return F.lit(default).cast("double")
    m = F.create_map(*[x for k, v in items for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(F.element_at(m, F.col(col).cast("string")),
                      F.lit(default).cast("double"))


def sanitize(c: Column) -> Column:
    """H5: +-inf, NaN and NULL -> 0.0."""
    d = c.cast("double")
    return F.when(d.isNull() | F.isnan(d) | (F.abs(d) == float("inf")), F.lit(0.0)).otherwise(d)


def add_features(df: DataFrame, aggregates: GroupStats | dict[str, dict[str, float]]) -> DataFrame:
    """H1-H6: derived columns appended, numerics sanitized; fitted statistics come by join, saved dictionaries as literals."""
    names = df.columns
    if len(set(names)) != len(names) or {"unique_id", "index"} & set(names):
        df = first_copies(df)
    t, r = F.col("antiguedad").cast("double"), F.col("renta").cast("double")
    derived = pair_arithmetic(t, r) + ratio_and_log(t, r)
    groups = []
    if isinstance(aggregates, GroupStats):
        df = aggregates.attach(df)
        groups = [n for c in aggregates.tables if c in df.columns for n in aggregates.names(c)]
        aggregates = {}
    tail, groups = groups, []
    for c in GROUP_COLUMNS:
        mk, dk = f"mean_renta_by_{c}", f"median_antiguedad_by_{c}"
        if mk in aggregates and dk in aggregates and c in df.columns:
            groups += [_lookup(c, aggregates[mk]).alias(mk), _lookup(c, aggregates[dk]).alias(dk)]
    with_derived = df.select(*[c for c in df.columns if c not in tail], *derived, *groups, *tail)
    rel = _div(F.col("renta"), F.col("mean_renta_by_pais_residencia")).alias(
        "renta_vs_country_mean") if "mean_renta_by_pais_residencia" in with_derived.columns \
        else F.lit(None).cast("double").alias("renta_vs_country_mean")
    out = with_derived.select("*", rel)
    return first_copies(out, sanitize_numeric=True)


def first_copies(df: DataFrame, sanitize_numeric: bool = False) -> DataFrame:
    """H6: first copy of a duplicated name wins; ``unique_id`` / ``index`` dropped.

    Columns are renamed by position first, so a name that occurs twice (e.g.
    after a join) is never an ambiguous reference.
    """
    fields = df.schema.fields
    names = [f.name for f in fields]
    if len(set(names)) == len(names):      # no repeated name: plain by-name projection
        return df.select(*[
            sanitize(F.col(f.name)).alias(f.name)
            if sanitize_numeric and f.dataType.typeName() in ("double", "float")
            else F.col(f.name) for f in fields if f.name not in ("unique_id", "index")])
    pos = df.toDF(*[f"_c{i}" for i in range(len(fields))])
    seen, cols = set(), []
    for i, f in enumerate(fields):
        if f.name in seen or f.name in ("unique_id", "index"):
            continue
        seen.add(f.name)
        e = F.col(f"_c{i}")
        if sanitize_numeric and f.dataType.typeName() in ("double", "float"):
            e = sanitize(e)
        cols.append(e.alias(f.name))
    return pos.select(*cols)


def feature_types(train: DataFrame, columns: list[str], max_levels: int = 25) -> DataFrame:
    """H7: (feature, n_distinct, kind): < max_levels distinct or non-numeric -> categorical."""
    types = {f.name: f.dataType.typeName() for f in train.schema.fields}
    row = train.agg(*[F.count_distinct(c).alias(c) for c in columns]).collect()[0]
    data = []
    for c in columns:
        numeric = types[c] in ("double", "float", "integer", "long", "short", "byte")
        kind = "numeric" if numeric and row[c] >= max_levels else "categorical"
        data.append((c, int(row[c]), kind))
    return train.sparkSession.createDataFrame(data, "feature string, n_distinct long, kind string")


def feature_kinds(train: DataFrame, columns: list[str], max_levels: int = 25) -> dict[str, str]:
    """H7's kinds without the exact numbers: a task keeps at most ``max_levels`` values a column, which settles whether there are as many."""
    types = {f.name: f.dataType.typeName() for f in train.schema.fields}
    numeric = [c for c in columns if types[c] in ("double", "float", "integer", "long", "short", "byte")]

    def levels(batches):
        seen: dict[str, set] = {c: set() for c in numeric}
        for batch in batches:
            for c in numeric:
                if len(seen[c]) < max_levels:
                    seen[c] |= {"nan" if x != x else repr(float(x) + 0.0) for x in batch.column(c).unique().to_pylist() if x is not None}
        yield pa.RecordBatch.from_pylist([{"feature": c, "level": x} for c in numeric for x in sorted(seen[c])[:max_levels]],
                                         pa.schema([("feature", pa.string()), ("level", pa.string())]))

    found = train.select(*numeric).mapInArrow(levels, "feature string, level string").groupBy("feature").agg(
        F.count_distinct("level").alias("n")).collect() if numeric else []  # a row a column
    many = {r["feature"] for r in found if r["n"] >= max_levels}
    return {c: "numeric" if c in many else "categorical" for c in columns}


def quality_check(df: DataFrame, columns: list[str]) -> DataFrame:
    """H8: count of NULL / NaN / inf values per numeric feature (must all be 0)."""
    return df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c)) |
                               (F.abs(F.col(c)) == float("inf"))).alias(c) for c in columns])
