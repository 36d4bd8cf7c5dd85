"""Purchase events, target panel and class bookkeeping (survey family C).

The whole family rests on one window: ``partitionBy(client).orderBy(snapshot)``.
``lag`` of the owned-products array gives the purchase events of a row
(owned now, not owned in the client's previous observed row); ``lead`` gives
the events of the client's next row, which are exactly the target of the
row when that next row is the next dataset snapshot.  So events, labels and
diagnostics come out of a single hash exchange on the client key, with no
self-join of the panel; the snapshot-pair table (one row per distinct
snapshot) is the only thing broadcast, and its size is bounded by the
calendar, not by the data.  Rows per window partition are bounded by the
number of snapshots per client, so one heavy client cannot overload a task.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..products import NO_PURCHASE_CLASS, OTHER_CLASS, N_PRODUCTS, product_name_expr
from ..session import spread

CLIENT = "ncodpers"
SNAPSHOT = "q"
SNAPSHOT_DATE = "fecha_dato"

# Fixed defaults of the training run (same roles as in the reference notebook).
TEST_CUTOFF = _dt.date(2000, 1, 1)
MIN_PURCHASE_SHARE = 0.01
MAX_TARGET_PRODUCTS = 12
MIN_CLASS_SUPPORT = 100

def _empty_int_array() -> Column:
    return F.array().cast("array<int>")


def client_window():
    return Window.partitionBy(CLIENT).orderBy(SNAPSHOT)


def with_neighbours(panel: DataFrame) -> DataFrame:
    """Adds the previous/next observed row of the client (one window, one shuffle, in tasks of bounded rows)."""
    w = client_window()
    return spread(panel, CLIENT).select(
        "*",
        F.lag("owned").over(w).alias("prev_owned"),
        F.lag(SNAPSHOT).over(w).alias("prev_q"),
        F.lead("owned").over(w).alias("next_owned"),
        F.lead(SNAPSHOT).over(w).alias("next_q"),
    )


def new_codes(owned: Column, prev_owned: Column) -> Column:
    """Codes held now and not in the previous observed row (NULL prev = none)."""
    return F.array_except(F.coalesce(owned, _empty_int_array()),
                          F.coalesce(prev_owned, _empty_int_array()))


def purchase_events(panel: DataFrame) -> DataFrame:
    """(ncodpers, fecha_dato, q, purchase) for every 0->1 flag change.

    Everything owned in a client's first row counts as bought; 1-0-1 counts
    twice; "previous" skips snapshots in which the client was absent.
    """
    w = client_window()
    return (spread(panel.select(CLIENT, SNAPSHOT_DATE, SNAPSHOT, "owned"), CLIENT)
            .select(CLIENT, SNAPSHOT_DATE, SNAPSHOT, "owned",
                    F.lag("owned").over(w).alias("prev_owned"))
            .select(CLIENT, SNAPSHOT_DATE, SNAPSHOT,
                    F.explode(new_codes(F.col("owned"), F.col("prev_owned"))).alias("purchase")))


def snapshot_pairs(panel: DataFrame) -> DataFrame:
    """Consecutive distinct dataset snapshots (q, date, next_q, next_date, prev_q).

    One row per distinct snapshot; the global window runs on that tiny set.
    """
    dates = panel.select(SNAPSHOT, SNAPSHOT_DATE).distinct()
    w = Window.orderBy(SNAPSHOT)
    return dates.select(
        SNAPSHOT, SNAPSHOT_DATE,
        F.lead(SNAPSHOT).over(w).alias("pair_next_q"),
        F.lead(SNAPSHOT_DATE).over(w).alias("target_date"),
        F.lag(SNAPSHOT).over(w).alias("pair_prev_q"),
    )


def _in_window(col: Column, first: _dt.date | None, last: _dt.date | None) -> Column:
    cond = F.lit(True)
    if first is not None:
        cond = cond & (col >= F.lit(first))
    if last is not None:
        cond = cond & (col <= F.lit(last))
    return cond


@dataclass
class TargetPanel:
    panel: DataFrame        # panel rows + snapshot_date, target_date, purchase
    diagnostics: DataFrame  # one row per snapshot pair


def build_target_panel(panel: DataFrame, first_snapshot: _dt.date | None = None,
                       last_snapshot: _dt.date | None = None,
                       keep: list[str] | None = None) -> TargetPanel:
    """C5 + C6: "state at t -> first product bought at t+1" with diagnostics.

    Label = minimum code among the client's events in the next dataset
    snapshot, 0 if none.  Rows are the snapshots in [first, last] that have
    a next snapshot (which may lie outside the window); a window without any
    such snapshot is an error.
    """
    pairs = F.broadcast(snapshot_pairs(panel))
    inside = _in_window(F.col(SNAPSHOT_DATE), first_snapshot, last_snapshot) & F.col("pair_next_q").isNotNull()
    if snapshot_pairs(panel).filter(inside).isEmpty():
        raise ValueError("no pair of consecutive snapshots to build a target from")
    nb = with_neighbours(panel).join(pairs, [SNAPSHOT, SNAPSHOT_DATE])
    is_buyer = F.size(new_codes(F.col("owned"), F.col("prev_owned"))) > 0
    missing_prev = F.col("prev_q").isNull() | (F.col("prev_q") != F.col("pair_prev_q"))
    label = F.when(
        F.col("next_q") == F.col("pair_next_q"),
        F.coalesce(F.array_min(new_codes(F.col("next_owned"), F.col("owned"))),
                   F.lit(NO_PURCHASE_CLASS))).otherwise(F.lit(NO_PURCHASE_CLASS))
    enriched = nb.select(
        "*",
        label.cast("int").alias("purchase"),
        is_buyer.alias("_buyer"),
        (is_buyer & missing_prev).alias("_missing_buyer"),
    )
    rows_keep = _in_window(F.col(SNAPSHOT_DATE), first_snapshot, last_snapshot) & \
        F.col("pair_next_q").isNotNull()
    base_cols = keep if keep is not None else [c for c in panel.columns]
    labelled = enriched.filter(rows_keep).select(
        *base_cols,
        F.col(SNAPSHOT_DATE).alias("snapshot_date"),
        "target_date", "purchase")

    # Diagnostics: per-snapshot counts from the same windowed rows.
    per_q = enriched.groupBy(SNAPSHOT).agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(CLIENT).alias("clients"),
        F.count_if(F.col("purchase") != NO_PURCHASE_CLASS).alias("purchasers_in_snapshot"),
        F.count_if("_buyer").alias("buyers_here"),
        F.count_if("_missing_buyer").alias("missing_here"),
    )
    t = per_q.alias("t")
    tgt = per_q.select(F.col(SNAPSHOT).alias("tq"), "buyers_here", "missing_here").alias("u")
    p = pairs.filter(F.col("pair_next_q").isNotNull() &
                     _in_window(F.col(SNAPSHOT_DATE), first_snapshot, last_snapshot)).alias("p")
    diagnostics = (p.join(t, F.col("p.q") == F.col("t.q"))
                   .join(tgt, F.col("p.pair_next_q") == F.col("u.tq"), "left")
                   .select(F.col("p." + SNAPSHOT_DATE).alias("snapshot_date"),
                           F.col("p.target_date").alias("target_date"),
                           F.col("t.rows").alias("rows"),
                           F.col("t.clients").alias("clients"),
                           F.coalesce(F.col("u.buyers_here"), F.lit(0)).alias("purchasers_in_target"),
                           F.col("t.purchasers_in_snapshot").alias("purchasers_in_snapshot"),
                           F.coalesce(F.col("u.missing_here"), F.lit(0)).alias(
                               "purchasers_missing_in_snapshot"),
                           (F.col("t.purchasers_in_snapshot") / F.col("t.rows")).alias(
                               "purchase_share")))
    return TargetPanel(labelled, diagnostics)


def panel_summary(target: TargetPanel) -> DataFrame:
    """One-row summary of a target panel."""
    rows = target.panel.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(CLIENT).alias("clients"),
        F.count_if(F.col("purchase") != NO_PURCHASE_CLASS).alias("purchasers"))
    diag = target.diagnostics.agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.sum("purchasers_missing_in_snapshot").alias("unpredictable_purchasers"),
        F.sum("purchasers_in_target").alias("_in_target"))
    # Two one-row aggregates stacked and folded: no join needed.
    both = rows.unionByName(diag, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("snapshots", "rows", "clients", "purchasers",
                                      "unpredictable_purchasers", "_in_target")])
    return both.select(
        "snapshots", "rows", "clients", "purchasers",
        (F.col("purchasers") / F.col("rows")).alias("purchase_share"),
        F.col("unpredictable_purchasers").cast("bigint").alias("unpredictable_purchasers"),
        (F.col("unpredictable_purchasers") /
         F.greatest(F.col("_in_target"), F.lit(1))).alias("unpredictable_purchaser_share"))


def purchase_share(events: DataFrame, until: _dt.date) -> DataFrame:
    """(purchase, n, share) of events dated on or before ``until``."""
    counts = events.filter(F.col(SNAPSHOT_DATE) <= F.lit(until)).groupBy("purchase").agg(
        F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # <= N_PRODUCTS rows
    return counts.select("purchase", "n", (F.col("n") / total).alias("share"))


def select_target_products(share: DataFrame, min_share: float = MIN_PURCHASE_SHARE,
                           max_products: int = MAX_TARGET_PRODUCTS) -> DataFrame:
    """(purchase, share, rank, selected) over products passing ``min_share``.

    Rank orders by share descending, code ascending on ties; the first
    ``max_products`` are the shortlist, the rest of the passing ones are
    reported as dropped (``selected = false``).
    """
    w = Window.orderBy(F.col("share").desc(), F.col("purchase"))  # <= N_PRODUCTS rows
    ranked = share.filter(F.col("share") >= min_share).select(
        "purchase", "share", F.row_number().over(w).alias("rank"))
    return ranked.select("purchase", "share", "rank",
                         (F.col("rank") <= max_products).alias("selected"))


def label_map(spark, shortlist_codes: list[int]) -> DataFrame:
    """C4: class dimension (code, name, is_candidate) with 0 and 99 added."""
    rows = [(NO_PURCHASE_CLASS, False)] + [(int(c), True) for c in sorted(shortlist_codes)] + \
        [(OTHER_CLASS, False)]
    df = spark.createDataFrame(rows, "code int, is_candidate boolean")
    return df.select("code", class_name(F.col("code")).alias("name"), "is_candidate")


def class_name(code: Column) -> Column:
    """0 -> no_purchase, 99 -> other, 1..N -> product name, else NULL."""
    return (F.when(code == NO_PURCHASE_CLASS, F.lit("no_purchase"))
            .when(code == OTHER_CLASS, F.lit("other"))
            .otherwise(product_name_expr(code)))


def fold_to_other(labelled: DataFrame, shortlist: DataFrame, label: str = "purchase") -> DataFrame:
    """A purchase outside the shortlist becomes class 99.

    ``shortlist`` holds one row per selected code (column ``code``); it is
    bounded by the number of products, so it is broadcast.
    """
    sl = F.broadcast(shortlist.select(F.col("code").alias("_sl_code")))
    return (labelled.join(sl, F.col(label) == F.col("_sl_code"), "left")
            .withColumn(label, F.when((F.col(label) != NO_PURCHASE_CLASS) &
                                      F.col("_sl_code").isNull(), F.lit(OTHER_CLASS))
                        .otherwise(F.col(label)))
            .drop("_sl_code"))


def rare_classes(labelled: DataFrame, train: Column, min_support: int = MIN_CLASS_SUPPORT,
                 label: str = "purchase") -> DataFrame:
    """C9 (fit): classes with fewer than ``min_support`` train rows (never 0 or 99).

    A class with no train row at all has no count and is not folded.
    """
    return (labelled.filter(train).groupBy(label).agg(F.count(F.lit(1)).alias("support"))
            .filter((F.col("support") < min_support) &
                    ~F.col(label).isin(NO_PURCHASE_CLASS, OTHER_CLASS))
            .select(F.col(label).alias("rare_code"), "support"))


def fold_rare(labelled: DataFrame, rare: DataFrame, label: str = "purchase") -> DataFrame:
    """C9 (apply): rare classes -> 99 everywhere.  ``rare`` has at most one row per class."""
    return (labelled.join(F.broadcast(rare.select("rare_code")),
                          F.col(label) == F.col("rare_code"), "left")
            .withColumn(label, F.when(F.col("rare_code").isNotNull(), F.lit(OTHER_CLASS))
                        .otherwise(F.col(label)))
            .drop("rare_code"))


def relevant_products(events: DataFrame) -> DataFrame:
    """C11: client -> sorted set of product names bought (as array and text)."""
    return events.groupBy(CLIENT).agg(
        F.array_sort(F.collect_set(product_name_expr(F.col("purchase")))).alias("products"))


def owned_long(panel: DataFrame) -> DataFrame:
    """(ncodpers, q, code) for every held product (NULL flags = not held)."""
    return panel.select(CLIENT, SNAPSHOT, F.explode("owned").alias("code"))


__all__ = [n for n in dir() if not n.startswith("_") and n != "spread"] + ["N_PRODUCTS"]
