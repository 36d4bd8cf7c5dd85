"""Collaborative-filtering feature (survey family D) on Spark ML's ALS.

* Client ids become dense int codes (ALS wants int) without a global sort:
  hash buckets + per-bucket offsets, the same two-level trick as the splits.
* Interactions are (user, item, count) - repeated purchases add up.
* Scoring never cross-joins users and items: the item factors (one row per
  product, bounded by the catalogue) are collected and shipped with the
  scoring function, and users are scored in Arrow batches (``mapInPandas``: one numpy matmul of the
  batch's user factors by the item matrix), owned products masked, best
  remaining items picked by a stable sort.  Written as Spark expressions,
  25 items x rank dot products overflow the 64 KB generated-method limit
  (the stage fails to compile and falls back to interpreted evaluation).
* The walk-forward feature fits one model per snapshot on strictly earlier
  events, all of them side by side with the small-catalogue solver of
  ``operators.als``; Spark ML's ALS stays for catalogues beyond it.
"""

from __future__ import annotations

import datetime as _dt

import numpy as np

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..products import N_PRODUCTS, product_name_expr
from ..session import materialize, spread
from . import als

FEATURE = "recommended_product_id"
BUCKET_BITS = 16


def dense_codes(ids: DataFrame, id_col: str = "ncodpers") -> DataFrame:
    """Distinct ids -> dense codes 0..n-1 as (id, user_code)."""
    distinct = ids.select(id_col).distinct()
    b = F.shiftright(F.xxhash64(F.col(id_col)), 64 - BUCKET_BITS)
    keyed = distinct.select(id_col, b.alias("_b"))
    hist = keyed.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # <= 65,536 rows
    offsets = hist.select("_b", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    ranked = keyed.select(id_col, "_b",
                          (F.row_number().over(Window.partitionBy("_b").orderBy(id_col)) - 1)
                          .alias("_rn"))
    return ranked.join(F.broadcast(offsets), "_b").select(
        id_col, (F.col("_off") + F.col("_rn")).cast("int").alias("user_code"))


def interactions(events: DataFrame, codes: DataFrame) -> DataFrame:
    """(user_code, item, rating = number of purchase events)."""
    g = events.groupBy("ncodpers", F.col("purchase").cast("int").alias("item")).agg(
        F.count(F.lit(1)).cast("float").alias("rating"))
    return g.join(codes, "ncodpers").select("user_code", "item", "rating")


def als_blocks(inter: DataFrame, ratings_per_block: int = 200_000) -> int:
    """User blocks for ALS: one per ``ratings_per_block`` ratings, whatever the
    cluster (the factors depend on the block layout; one counting job)."""
    return max(1, -(-inter.count() // ratings_per_block))


def fit_als(inter: DataFrame, rank: int = 50, max_iter: int = 50, reg: float = 0.05,
            seed: int = 0, user_blocks: int | None = None) -> ALSModel:
    """D3: implicit-feedback ALS (values differ from other solvers' scaling).

    Items are the product catalogue (tens of rows), each a block of its own, so
    an item half-step is as many tasks; users are split into ``user_blocks`` blocks (default: sized from the
    number of ratings, see ``als_blocks``).
    """
    if user_blocks is None:
        user_blocks = als_blocks(inter)
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, implicitPrefs=True, seed=seed,
              userCol="user_code", itemCol="item", ratingCol="rating",
              coldStartStrategy="drop", nonnegative=False,
              numUserBlocks=user_blocks, numItemBlocks=N_PRODUCTS)
    return als.fit(inter)


def item_vectors(model: ALSModel) -> dict[int, list[float]]:
    """Item factors as literals; the item set is the product catalogue."""
    rows = model.itemFactors.limit(N_PRODUCTS + 1).collect()
    if len(rows) > N_PRODUCTS:
        raise ValueError("item factors exceed the product catalogue")
    return {int(r["id"]): [float(x) for x in r["features"]] for r in rows}


def _score_batches(items: dict[int, list[float]], exclude_col: str, k: int):
    """Arrow-batch scorer: user factors (n x r) @ item factors (r x m) with numpy.

    Excluded items are masked to -inf; items are ordered by code, so a stable
    descending sort breaks score ties toward the lowest code.  Emits the
    input columns plus ``_codes`` (best first, at most ``k``) and ``_scores``.
    """
    codes = np.array(sorted(items), dtype=np.int64)
    mat = np.array([items[c] for c in codes], dtype=np.float64)          # m x r
    pos = np.full(int(codes.max()) + 2, -1, dtype=np.int64)
    pos[codes] = np.arange(len(codes))

    def run(batches):
        for pdf in batches:
            n = len(pdf)
            uf = pdf["_uf"]
            has = uf.notna().to_numpy()
            users = np.zeros((n, mat.shape[1]), dtype=np.float64)
            if has.any():
                users[has] = np.stack(uf[has].to_numpy()).astype(np.float64)
            scores = users @ mat.T                                      # n x m
            ex = pdf[exclude_col]
            lens = ex.map(lambda a: 0 if a is None else len(a)).to_numpy()
            if lens.sum():
                flat = np.concatenate([a for a in ex.to_numpy() if a is not None and len(a)])
                rows = np.repeat(np.arange(n), lens)
                ok = (flat >= 0) & (flat < len(pos))
                cols = np.where(ok, pos[np.clip(flat, 0, len(pos) - 1)], -1)
                keep = cols >= 0
                scores[rows[keep], cols[keep]] = -np.inf
            order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            top = np.take_along_axis(scores, order, axis=1)
            out_codes, out_scores = [], []
            for i in range(n):
                if not has[i]:
                    out_codes.append(None)
                    out_scores.append(None)
                    continue
                live = np.isfinite(top[i])
                out_codes.append(codes[order[i][live]])
                out_scores.append(top[i][live])
            yield pdf.drop(columns=["_uf"]).assign(_codes=out_codes, _scores=out_scores)
    return run


def score_items(rows: DataFrame, model: ALSModel, exclude_col: str, k: int) -> DataFrame:
    """Rows (with ``user_code`` and an ``exclude_col`` int array) -> ``_codes`` /
    ``_scores``: the best ``k`` items not excluded, NULL for users without factors.

    The only driver-side data is the item factor matrix (bounded by the product
    catalogue); the rows stay in their Spark partitions (no shuffle beyond the
    join with the user factors) and are scored in Arrow batches.
    """
    items = item_vectors(model)
    uf = model.userFactors.select(F.col("id").alias("user_code"), F.col("features").alias("_uf"))
    joined = rows.join(uf, "user_code", "left")
    schema = T.StructType(
        [f for f in joined.schema.fields if f.name != "_uf"]
        + [T.StructField("_codes", T.ArrayType(T.LongType())),
           T.StructField("_scores", T.ArrayType(T.DoubleType()))])
    return joined.mapInPandas(_score_batches(items, exclude_col, k), schema)


def top1(rows: DataFrame, model: ALSModel, owned_col: str = "owned") -> DataFrame:
    """Best item per row, products currently owned masked.

    Rows need ``user_code`` and the owned array; users without factors (and
    rows with every item owned) get NULL (caller maps to '0').  Score ties
    go to the lowest product code.
    """
    scored = score_items(rows, model, owned_col, 1)
    return scored.select(
        *rows.columns,
        product_name_expr(F.get(F.col("_codes"), 0)).alias(FEATURE),
        F.get(F.col("_scores"), 0).alias("recommended_score"))


def topk_lists(users: DataFrame, model: ALSModel, history: DataFrame, k: int) -> DataFrame:
    """Top-k product names per user, excluding products in the user's history."""
    hist = history.groupBy("user_code").agg(F.collect_set("item").alias("_hist"))
    uf_users = model.userFactors.select(F.col("id").alias("user_code"))
    j = users.join(uf_users, "user_code", "left_semi").join(hist, "user_code", "left")
    scored = score_items(j, model, "_hist", k)
    names = F.transform(F.col("_codes"), lambda c: product_name_expr(c))
    return scored.select(*users.columns, names.alias("recommended"))


def catalogue(events: DataFrame) -> list[int]:
    """The item codes that were ever bought, in order; more than the small-catalogue solver takes is an error there."""
    rows = events.select(F.col("purchase").cast("int").alias("c")).distinct().orderBy("c").limit(als.MOST_ITEMS + 1).collect()
    return [r["c"] for r in rows]


def walk_forward(panel: DataFrame, events: DataFrame, snapshots: list[_dt.date] | None = None, refit_every: int = 1,
                 rank: int = als.RANK, max_iter: int = als.ITERATIONS, reg: float = als.REG, seed: int = 0) -> DataFrame:
    """Per snapshot t, a model fitted on events strictly before t scores the state at t.

    Snapshots without history are skipped; between refits the last model (fitted
    on no later history) is reused.  All models are fitted side by side, one pass
    over the history rows an iteration, and one pass scores all panel rows.
    Clients without history at t get NULL.  The result is written once.
    """
    spark = panel.sparkSession
    dates = [r[0] for r in panel.select("fecha_dato").distinct().orderBy("fecha_dato").collect()]
    if snapshots is not None:
        wanted = set(snapshots)
        dates = [d for d in dates if d in wanted]
    events = materialize(events.select("ncodpers", "fecha_dato", "purchase"), "als-events")
    first_event = events.agg(F.min("fecha_dato")).collect()[0][0]
    # Segments: a refit snapshot and the following snapshots that reuse its model.
    segments: list[list[_dt.date]] = []
    for pos, snap in enumerate(dates):
        if first_event is None or snap <= first_event:
            continue  # no history strictly before this snapshot
        if not segments or refit_every <= 1 or pos % refit_every == 0:
            segments.append([snap])
        else:
            segments[-1].append(snap)
    if not segments:
        return spark.createDataFrame(
            [], f"ncodpers long, snapshot_date date, {FEATURE} string, recommended_score double")
    items = catalogue(events)
    history = als.written(als.histories(events, [seg[0] for seg in segments], items))
    factors = als.fit(history, len(segments), items, rank, max_iter, reg, seed)
    seg_of = F.create_map(*[x for i, seg in enumerate(segments) for d in seg for x in (F.lit(d), F.lit(i))])
    rows = panel.filter(F.col("fecha_dato").isin([d for seg in segments for d in seg])).select(
        "ncodpers", "fecha_dato", "owned", F.element_at(seg_of, F.col("fecha_dato")).alias("seg"))
    keys, n = ["seg", "ncodpers"], rows.count()
    known = spread(rows, *keys, rows=n).join(spread(history, *keys, rows=n), keys, "left")
    return materialize(top1_lookup(als.rank_items(known, factors, "owned", 1)),
                       "als-lookup", ["snapshot_date"])


def top1_lookup(ranked: DataFrame) -> DataFrame:
    """(ncodpers, snapshot_date, product, score) of rows ranked with their owned products left out."""
    first = F.get(F.col("ranked"), 0)
    return ranked.select("ncodpers", F.col("fecha_dato").alias("snapshot_date"),
                         product_name_expr(first["code"]).alias(FEATURE), first["score"].alias("recommended_score"))


def latest_lookup(lookup: DataFrame) -> DataFrame:
    """Rows of the latest snapshot (the serving lookup)."""
    last = lookup.agg(F.max("snapshot_date").alias("_last"))
    return lookup.join(F.broadcast(last), F.col("snapshot_date") == F.col("_last")).select(
        "ncodpers", FEATURE)


def attach_feature(panel: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left join on (client, snapshot); missing -> '0'."""
    return (panel.join(lookup.select("ncodpers", "snapshot_date", FEATURE),
                       ["ncodpers", "snapshot_date"], "left")
            .withColumn(FEATURE, F.coalesce(F.col(FEATURE), F.lit("0"))))


def serving_join(requests: DataFrame, lookup: DataFrame) -> DataFrame:
    """Request batch -> recommendation; miss or NULL -> '0'."""
    return (requests.join(lookup.select("ncodpers", FEATURE), "ncodpers", "left")
            .withColumn(FEATURE, F.coalesce(F.col(FEATURE), F.lit("0"))))
