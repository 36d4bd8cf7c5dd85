"""Hand-made 3-client panel: events, labels, diagnostics."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from nextbuy.operators import panel as P

S1, S2, S3 = dt.date(2015, 1, 28), dt.date(2015, 2, 28), dt.date(2015, 3, 28)


def _panel(spark):
    rows = [(1, S1, 1, [3]), (1, S2, 2, [3, 5]), (1, S3, 3, [3, 5]),
            (2, S2, 2, [8]), (2, S3, 3, [3, 8]),
            (3, S1, 1, [3])]
    return spark.createDataFrame(rows, "ncodpers long, fecha_dato date, q int, owned array<int>")


def test_purchase_events(spark):
    ev = {(r.ncodpers, r.fecha_dato, r.purchase)
          for r in P.purchase_events(_panel(spark)).collect()}
    assert {(1, S1, 3), (1, S2, 5), (2, S3, 3)} <= ev
    assert (1, S3, 3) not in ev and (3, S2, 3) not in ev


def test_target_window(spark):
    tp = P.build_target_panel(_panel(spark), first_snapshot=S1, last_snapshot=S2,
                              keep=["ncodpers"])
    got = {(r.snapshot_date, r.ncodpers): r.purchase for r in tp.panel.collect()}
    assert got == {(S1, 1): 5, (S1, 3): 0, (S2, 1): 0, (S2, 2): 3}


def test_diagnostics_and_summary(spark):
    tp = P.build_target_panel(_panel(spark), first_snapshot=S1, last_snapshot=S1)
    d = tp.diagnostics.collect()
    assert len(d) == 1
    assert d[0].purchasers_in_target == 2
    assert d[0].purchasers_in_snapshot == 1
    assert d[0].purchasers_missing_in_snapshot == 1
    s = P.panel_summary(tp).collect()[0]
    assert s.unpredictable_purchaser_share == 0.5


def test_label_iff_buyer(spark):
    """Every buyer of t+1 present in t is labelled; nobody else is."""
    pnl = _panel(spark)
    tp = P.build_target_panel(pnl).panel
    ev = P.purchase_events(pnl)
    labelled = {(r.ncodpers, r.snapshot_date) for r in tp.filter("purchase <> 0").collect()}
    pairs = {S1: S2, S2: S3}
    present = {(r.ncodpers, r.fecha_dato) for r in pnl.collect()}
    buyers = {(r.ncodpers, d) for r in ev.collect() for d, nxt in pairs.items()
              if r.fecha_dato == nxt and (r.ncodpers, d) in present}
    assert labelled == buyers


def test_shortlist_and_rare(spark):
    codes = [3] * 70 + [5] * 20 + [7] * 5 + [24] * 5
    ev = spark.createDataFrame([(i, S1, c) for i, c in enumerate(codes)],
                               "ncodpers long, fecha_dato date, purchase int")
    ranked = P.select_target_products(P.purchase_share(ev, S1), min_share=0.2, max_products=1)
    sel = {r.purchase: r.selected for r in ranked.collect()}
    assert sel == {3: True, 5: False}
    labels = [3] * 50 + [5] * 5 + [7] * 40
    df = spark.createDataFrame([(i, c, i < 55) for i, c in enumerate(labels)],
                               "id long, purchase int, train boolean")
    rare = P.rare_classes(df, F.col("train"), 10)
    assert [r.rare_code for r in rare.collect()] == [5]
    folded = P.fold_rare(df, rare)
    counts = {r.purchase: r["count"] for r in folded.groupBy("purchase").count().collect()}
    assert counts == {3: 50, 99: 5, 7: 40}


def test_class_names(spark):
    df = spark.createDataFrame([(3,), (0,), (99,), (26,)], "code int")
    names = [r[0] for r in df.select(P.class_name(F.col("code"))).collect()]
    assert names == ["prod_03", "no_purchase", "other", None]


def test_no_pair_and_bad_splits_are_errors(spark):
    import datetime as dt

    from nextbuy.operators import splits as S
    one = spark.createDataFrame([(1, 4, dt.date(2020, 1, 1), [1])], "ncodpers long, q int, fecha_dato date, owned array<int>")
    with pytest.raises(ValueError, match="no pair"):
        P.build_target_panel(one)
    two = one.union(spark.createDataFrame([(1, 5, dt.date(2020, 4, 1), [1, 2])], one.schema))
    assert P.build_target_panel(two).panel.count() == 1
    with pytest.raises(ValueError, match="no pair"):
        P.build_target_panel(two, first_snapshot=dt.date(2020, 4, 1))
    rows = lambda *x: spark.createDataFrame(x, "split string, snapshot_date date")
    S.check_calendar(rows(("train", dt.date(2020, 1, 1)), ("test", dt.date(2020, 2, 1))))
    for bad, message in ((rows(("train", dt.date(2020, 1, 1))), "one part"), (rows(("train", dt.date(2020, 2, 1)), ("test", dt.date(2020, 2, 1))), "meet")):
        with pytest.raises(ValueError, match=message):
            S.check_calendar(bad)


def test_client_windows_run_in_tasks_of_bounded_rows(spark, monkeypatch):
    from nextbuy import session
    rows = [(c, q, [1 + (c + q) % 3, 5]) for c in range(60) for q in range(4)]
    df = spark.createDataFrame(rows, "ncodpers long, q int, owned array<int>").withColumn("fecha_dato", F.make_date(F.lit(1995), F.col("q") * 3 + 1, F.lit(1)))
    want = sorted(map(tuple, P.purchase_events(df).collect()), key=str)
    monkeypatch.setattr(P, "spread", lambda d, *keys: session.spread(d, *keys, per_task=20))
    few = P.purchase_events(df)
    assert few.rdd.getNumPartitions() == 12 and P.with_neighbours(df).rdd.getNumPartitions() == 12
    assert sorted(map(tuple, few.collect()), key=str) == want and len(want) > 60


def test_write_by_partition_keeps_every_row_and_the_settings(spark, tmp_path):
    from nextbuy.session import OPEN_FILES, materialize
    df = spark.range(2000).selectExpr("id", "cast(id % 150 as int) as part").repartition(3)  # more partitions than open files
    seen = []
    real = type(df.write).parquet
    from pyspark.sql import DataFrameWriter

    def spy(self, path, *a, **k):
        seen.append(spark.conf.get(OPEN_FILES))
        return real(self, path, *a, **k)

    before = spark.conf.get(OPEN_FILES, None)
    try:
        DataFrameWriter.parquet = spy
        back = materialize(df, "parts", ["part"])
    finally:
        DataFrameWriter.parquet = real
    assert seen == ["64"] and spark.conf.get(OPEN_FILES, None) == before
    assert sorted(map(tuple, back.select("id", "part").collect())) == [(i, i % 150) for i in range(2000)]
