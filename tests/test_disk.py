"""What the wide queries leave on disk and send through exchanges."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from curvethin.operators.thin import mark, thin
from curvethin.plans import catalog as C
from curvethin.plans import pipeline as P
from curvethin.session import clear_stored, store
from curvethin.sources import fixtures as FX
from curvethin.sources import rows as R


def _exchanges(df):
    """Columns of each exchange in the plan."""
    found = []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.initialPlan())
        if node.nodeName() == "Exchange":
            found.append([node.output().apply(i).name() for i in range(node.output().size())])
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def wide(spark, tmp_path):
    """A table of several files and blocks, with values of many kinds and rows that repeat."""
    rows = [(i % 97, None if i % 5 == 0 else f"text {i % 11}", Decimal(i) / 7 if i % 3 else None, dt.datetime(2024, 3, 31, 1, i % 60, 0, i),
             dt.date(2024, 1, 1 + i % 28), float("nan") if i % 13 == 0 else i / 3, [i % 4, None] if i % 2 else None, {"a": i % 6}, i % 2 == 0, b"\0x")
            for i in range(700)]
    path = str(tmp_path / "wide")
    schema = "k int, t string, d decimal(20,6), ts timestamp, day date, y double, l array<int>, s struct<a:int>, b boolean, x binary"
    spark.createDataFrame(rows + rows[:50], schema).repartition(3).write.parquet(path)
    return R.with_ids(spark.read.parquet(path))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_many_marks_are_met_in_packed_blocks(spark, wide, monkeypatch, zone):
    monkeypatch.setattr(R, "BLOCK_BITS", 5)
    monkeypatch.setattr(R, "SMALL_TABLE", 0.0)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        wanted = wide.filter(F.col("k") % 4 != 1).select(R.ROW_ID, F.col("k").alias("kept"), F.col("t").alias("said"))
        few = R.fetch(wide, wanted)
        monkeypatch.setattr(R, "BROADCAST_ROWS", 0)
        many = R.fetch(wide, wanted)
        assert many.schema.simpleString() == few.schema.simpleString()
        assert _rows(many) == _rows(few) and many.count() > 500
        assert R.fetch(wide, wanted.limit(0)).count() == 0
        # the wide rows go through the exchange as one binary column
        assert sorted(_exchanges(many)) == [["_block", "_block", "_file", "_first", "_rows"], ["_block", "_file", "_row", "kept", "said"]]
        months = wide.withColumn("m", F.expr("make_ym_interval(k)"))  # not in Arrow
        assert R.fetch(months, wanted).count() == many.count() and not R._in_arrow(months)
        # rows that do not come as a scan reads them are joined row by row, with the same result
        dealt = wide.repartition(4, "k")
        assert _rows(R.fetch(dealt, wanted)) == _rows(few) and not any("_rows" in x for x in _exchanges(R.fetch(dealt, wanted)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
        clear_stored(spark)


def test_store_leaves_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = manager.getAllFiles()
        return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}

    before = files()
    store(spark.range(1000).repartition(3, "id").groupBy(F.col("id") % 7).count())
    assert not files() - before
    P.mark_rows(FX.process_source(spark, SF_SMALL)[0], C.CFG_A)  # counts long series
    assert not files() - before
    spark.range(1000).repartition(3, "id").write.format("noop").mode("overwrite").save()
    assert files() - before  # other actions keep theirs
    clear_stored(spark)


def test_process_rows_are_exchanged_once(spark):
    rows, _ = FX.process_source(spark, SF_SMALL)
    assert len(_exchanges(P.mark_rows(P.repair_metrics(rows), C.CFG_A))) == 1
    d = rows.select("step_id", "sequence_id", "handle", "pv_voltage", R.ROW_ID)  # dealt by another key: once more
    assert len(_exchanges(mark(d, ["step_id"], ["sequence_id", "handle"], {"V": "pv_voltage"}, C.CFG_A, [R.ROW_ID], split="never"))) == 2


def test_columns_named_like_the_scan_s_own(spark):
    d = FX.events_by_user(spark, SF_SMALL)
    odd = {"_number": "event_id", "_order0": "ts", "_key0": "value", "__metric0": "user_id"}
    kept = thin(d.withColumns({c: F.col(like) for c, like in odd.items()}), C.B_KEYS, C.B_ORDER, "value", C.CFG_B)
    assert kept.columns == [*d.columns, *odd, "row_num"]
    assert kept.filter(" or ".join(f"not {c} <=> {like}" for c, like in odd.items())).isEmpty()
    assert _rows(kept.drop(*odd)) == _rows(thin(d, C.B_KEYS, C.B_ORDER, "value", C.CFG_B))


def test_rounds_and_blocks_give_the_same_rows(spark, monkeypatch):
    want = _rows(C.q_compressed_output(spark, SF_SMALL))
    monkeypatch.setattr(P, "ROUND_BYTES", 0)
    assert _rows(C.q_compressed_output(spark, SF_SMALL)) == want
    monkeypatch.setattr(R, "BROADCAST_ROWS", 0)
    got = C.q_compressed_output(spark, SF_SMALL)
    assert any("_rows" in x for x in _exchanges(got)) and _rows(got) == want
    assert _rows(C.q_keep_wide_rows(spark, SF_SMALL)) and len(want) > 20_000
    clear_stored(spark)
