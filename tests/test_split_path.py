"""The split path (range-sorted positions, blocks, carried anchors) must give
exactly the window path's result; tiny blocks force many block edges."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from curvethin.config import ThinConfig
from curvethin.operators.thin import score
from curvethin.operators.split import global_positions
from curvethin.plans import pipeline as P
from curvethin.sources import fixtures as FX

COLS = ["row_num", "n", "region", "mpos", "sig", "rnk", "entry", "level", "fit", "failed", "keep"]


def _rows(df, keys):
    out = []
    for r in df.select(*keys, *COLS).collect():
        t = tuple(round(v, 9) if isinstance(v, float) else v for v in r)
        out.append(t)
    return sorted(out, key=repr)


@pytest.mark.parametrize("anchor", ["origin", "first"])
def test_split_equals_local_events_by_type(spark, anchor):
    src = FX.events_by_type(spark, SF_SMALL)
    cfg = ThinConfig(target=0.3, leading_anchor=anchor, block_rows=17, sort_rows=97)
    a = score(src, ["event_type"], ["ts", "event_id"], "value", cfg, split="never")
    b = score(src, ["event_type"], ["ts", "event_id"], "value", cfg, split="always")
    assert _rows(a, ["event_type"]) == _rows(b, ["event_type"])


def test_split_equals_local_events_by_user(spark):
    src = FX.events_by_user(spark, SF_SMALL)
    cfg = ThinConfig(target=0.5, block_rows=7, sort_rows=500)
    a = score(src, ["user_id"], ["ts", "event_id"], "value", cfg, split="never")
    b = score(src, ["user_id"], ["ts", "event_id"], "value", cfg, split="always")
    assert _rows(a, ["user_id"]) == _rows(b, ["user_id"])


def test_auto_routes_only_long_series(spark):
    """max_series_rows below the longest series: both paths in one result."""
    src = FX.events_by_user(spark, SF_SMALL)
    base = ThinConfig(target=0.5, block_rows=9, sort_rows=300)
    a = score(src, ["user_id"], ["ts", "event_id"], "value", base, split="never")
    b = score(src, ["user_id"], ["ts", "event_id"], "value", base.with_(max_series_rows=66),
              split="auto")
    assert _rows(a, ["user_id"]) == _rows(b, ["user_id"])


def test_split_equals_local_five_metrics(spark):
    rows = P.load_rows(FX.process_rows(spark, SF_SMALL), None)
    cfg = ThinConfig(target=0.5, block_rows=13, sort_rows=1000)
    keys = FX.PROCESS_KEYS + ["zip_category"]
    a = P.score_metrics(rows, cfg, split="never")
    b = P.score_metrics(rows, cfg, split="always")
    assert _rows(a, keys) == _rows(b, keys)


def test_global_positions_match_row_number(spark):
    src = FX.events_by_type(spark, SF_SMALL)
    n = src.count()
    pos = global_positions(src, ["event_type"], ["ts", "event_id"], "pos", n, 50, 5)
    from pyspark.sql import Window
    ref = src.withColumn("pos", F.row_number().over(
        Window.partitionBy("event_type").orderBy("ts", "event_id")))
    got = sorted(pos.select("event_id", "pos").collect())
    want = sorted(ref.select("event_id", "pos").collect())
    assert got == want


def test_split_without_broadcasts(spark, monkeypatch):
    """Side tables over the byte budget are shuffle-joined on (keys, block)
    or (keys, partition); same result."""
    import curvethin.operators.split as SP
    monkeypatch.setattr(SP, "SIDE_BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src = FX.events_by_type(spark, SF_SMALL)
        cfg = ThinConfig(target=0.3, block_rows=23, sort_rows=101)
        a = score(src, ["event_type"], ["ts", "event_id"], "value", cfg, split="never")
        b = score(src, ["event_type"], ["ts", "event_id"], "value", cfg, split="always")
        plan = b._jdf.queryExecution().executedPlan().toString()
        # only the two routing joins against the (key-count bounded) hot-key list
        assert plan.count("BroadcastHashJoin") <= 2
        assert _rows(a, ["event_type"]) == _rows(b, ["event_type"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("anchor", ["origin", "first"])
def test_level_view_split_equals_local(spark, anchor):
    from curvethin.operators.thin import level_view
    src = FX.events_by_user(spark, SF_SMALL)
    cfg = ThinConfig(target=0.5, leading_anchor=anchor, block_rows=11, sort_rows=400)
    cols = ["user_id", "row_num", "x", "y", "x_prev", "y_prev", "x_next", "y_next", "sig",
            "rnk", "entry", "kept", "prev", "next", "yhat"]

    def rows(df):
        out = []
        for r in df.select(*cols).collect():
            out.append(tuple(tuple(v) if hasattr(v, "asDict") else
                             (round(v, 9) if isinstance(v, float) else v) for v in r))
        return sorted(out, key=repr)

    a = level_view(src, ["user_id"], ["ts", "event_id"], "value", cfg, 3, split="never")
    b = level_view(src, ["user_id"], ["ts", "event_id"], "value", cfg, 3, split="always")
    assert rows(a) == rows(b)


def test_routing_changes_no_row(spark):
    rows = P.load_rows(FX.process_rows(spark, SF_SMALL), None)
    keys = FX.PROCESS_KEYS + ["zip_category"]
    cfg = ThinConfig(target=0.5)
    a = _rows(P.score_metrics(rows, cfg), keys)
    assert a == _rows(P.score_metrics(rows, cfg, split="never"), keys)


def test_null_hot_key_takes_the_split_path(spark):
    """A null group above the bound is numbered and scored like any other long series."""
    src = spark.range(3000).selectExpr("IF(id < 2500, NULL, id % 3) AS k", "id AS t",
                                       "sin(id / 9) * (id % 17) AS v")
    cfg = ThinConfig(target=0.5, max_series_rows=1000, block_rows=90, sort_rows=400)
    a = score(src, ["k"], ["t"], "v", cfg, split="never")
    b = score(src, ["k"], ["t"], "v", cfg, split="auto")
    assert "_pid" in b._jdf.queryExecution().optimizedPlan().toString() or \
        "ExistingRDD" in b._jdf.queryExecution().optimizedPlan().toString()  # checkpointed positions
    assert _rows(a, ["k"]) == _rows(b, ["k"])
    from curvethin.operators.series import number_rows
    got = number_rows(src, ["k"], ["t"], split="auto", max_group_rows=1000)
    want = number_rows(src, ["k"], ["t"])
    assert sorted(got.collect(), key=lambda r: r["t"]) == sorted(want.collect(), key=lambda r: r["t"])


@pytest.mark.parametrize("split", ["never", "always"])
def test_text_that_is_no_number_fails_its_pair_only(spark, split):
    src = spark.range(320).selectExpr("id % 2 AS k", "id AS t",
                                      "IF(id = 80, 'n/a', CAST(id % 13 AS STRING)) AS v",
                                      "CAST(id % 7 AS STRING) AS w")
    cfg = ThinConfig(target=0.5, block_rows=20, sort_rows=60)
    s = score(src, ["k"], ["t"], {"V": "v", "W": "w"}, cfg, split=split)
    failed = {(r["k"], r["zip_category"]) for r in s.where("failed").select("k", "zip_category").distinct().collect()}
    assert failed == {(0, "V")}
    assert s.where("keep and k = 0 and zip_category = 'V'").isEmpty()
    assert s.where("keep").select("k", "zip_category").distinct().count() == 3


def test_a_task_holds_no_more_than_a_block(spark, monkeypatch):
    """By default a series longer than a block goes the split path, whose Python tasks hold a block each."""
    from curvethin.operators import thin as T

    cfg, seen = ThinConfig(target=0.3), []
    assert cfg.max_series_rows <= cfg.block_rows and cfg.sort_rows <= cfg.block_rows
    monkeypatch.setattr(T, "_score_hot", lambda df, *args, **kw: seen.append(args[4]) or T.score_local(df, ["k"], cfg, "y", order=["i"]))
    d = spark.range(cfg.block_rows + 1).selectExpr("1 AS k", "id AS i", "CAST(id % 7 AS DOUBLE) AS y")
    T.score(d, ["k"], ["i"], "y", cfg)
    assert seen == [1]
    T.score(d.limit(cfg.block_rows), ["k"], ["i"], "y", cfg)
    assert seen == [1]
