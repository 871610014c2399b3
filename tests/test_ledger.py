"""Batches that take effect once: a run stopped at any point, gone on with, ends as if it had not stopped."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from curvethin.config import ThinConfig
from curvethin.plans import ledger as LG
from curvethin.plans import pipeline as P
from curvethin.session import stored
from curvethin.sources import fixtures as FX
from curvethin.sources.files import Records
from curvethin.sources.sinks import JdbcSink, ParquetSink

PAGE = 5
RUN, CFG = "2024-06-30 12:00:00", ThinConfig(target=0.5)
DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


class Stop(BaseException):
    """The driver is gone."""


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Some series of the fixture; one status row twice, one under a null key."""
    root = str(tmp_path_factory.mktemp("tables"))
    FX.process_rows(spark, SF_SMALL).filter("remark < '12'").write.parquet(root + "/process")
    status = FX.status_rows(spark, SF_SMALL).filter("remark < '12'")
    twice = status.filter("remark = '1' AND step_id = 3").withColumn("modified_user", F.lit("second"))
    status.unionByName(twice).unionByName(status.limit(1).withColumn("remark", F.lit(None).cast("string"))).write.parquet(root + "/status")
    return spark.read.parquet(root + "/process"), spark.read.parquet(root + "/status")


def contents(df, cols=None):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def expected(spark, tables, tmp_path_factory):
    process, status = tables
    keys = P.pending_keys(status, 0).unionByName(P.pending_keys(status, 1))
    rows, outcome = P.thin_batch(process, keys, CFG, RUN)
    return contents(rows, P.OUTPUT_COLUMNS), contents(P.update_status(status, outcome, F.col("value"), RUN))


def run(ledger, tables, sink):
    return LG.run_ledger(tables[0], ledger, sink, CFG, RUN, limit=PAGE)


def test_pages(spark, tables, expected, tmp_path):
    ledger, sink = LG.Ledger(spark, str(tmp_path / "ledger")), ParquetSink(spark, str(tmp_path / "sink"))
    ledger.publish(tables[1])
    held = stored(spark)
    after = run(ledger, tables, sink)
    assert stored(spark) == held  # intermediate tables are gone
    assert (contents(sink.read(), P.OUTPUT_COLUMNS), contents(after)) == expected
    assert after.count() == tables[1].count()
    plan = spark.read.parquet(f"{ledger.root}/{ledger.records.get('plans/0')}")
    pages = plan.groupBy("shard", "page").count().collect()
    assert max(r["count"] for r in pages) == PAGE and len(pages) == len(ledger.committed(0)) > 3
    assert ledger.version() == 1 and contents(ledger.status(0)) == contents(tables[1])
    assert contents(run(ledger, tables, sink)) == contents(after)  # nothing left: no new version
    assert ledger.version() == 1 and contents(sink.read(), P.OUTPUT_COLUMNS) == expected[0]


@pytest.mark.parametrize("where", ["stage", "staged", "commit", "committed", "publish"])
def test_stop_and_go_on(spark, tables, expected, tmp_path, monkeypatch, where):
    """Stopped before or after each step of the second batch (and before the new version is named)."""
    ledger, sink = LG.Ledger(spark, str(tmp_path / "ledger")), ParquetSink(spark, str(tmp_path / "sink"))
    ledger.publish(tables[1])
    calls = {"stage": 0, "commit": 0}
    stage, commit, put = sink.stage, sink.commit, Records.put

    def at(name, before, after, work):
        def call(*args):
            calls[name] += 1
            if calls[name] == 2 and where == before:
                raise Stop
            out = work(*args)
            if calls[name] == 2 and where == after:
                raise Stop
            return out
        return call

    monkeypatch.setattr(sink, "stage", at("stage", "stage", "staged", stage))
    monkeypatch.setattr(sink, "commit", at("commit", "commit", "committed", commit))
    if where == "publish":
        def stop(self, name, text):
            if name == "versions/1":
                raise Stop
            put(self, name, text)
        monkeypatch.setattr(Records, "put", stop)
    with pytest.raises(Stop):
        run(ledger, tables, sink)
    monkeypatch.undo()
    again = LG.Ledger(spark, ledger.root), ParquetSink(spark, sink.root)
    after = run(again[0], tables, again[1])
    assert (contents(again[1].read(), P.OUTPUT_COLUMNS), contents(after)) == expected


def test_jdbc_sink_stopped_between_commit_and_record(spark, tables, expected, tmp_path, monkeypatch):
    """Embedded in-memory Derby: no server, no port."""
    url = "jdbc:derby:memory:ledger;create=true"
    ledger, sink = LG.Ledger(spark, str(tmp_path / "ledger")), JdbcSink(spark, url, "ZIPPED", DERBY)
    ledger.publish(tables[1])
    put, calls = Records.put, []

    def stop(self, name, text):
        if name.startswith("batches/"):
            calls.append(name)
            if len(calls) == 2:
                raise Stop
        put(self, name, text)

    monkeypatch.setattr(Records, "put", stop)
    with pytest.raises(Stop):
        run(ledger, tables, sink)
    monkeypatch.undo()
    after = run(LG.Ledger(spark, ledger.root), tables, JdbcSink(spark, url, "ZIPPED", DERBY))
    cols = ["handle", "zip_category", "sequence_id", "pv_voltage"]
    at = [P.OUTPUT_COLUMNS.index(c) for c in cols]
    assert contents(sink.read(), cols) == sorted((tuple(r[i] for i in at) for r in expected[0]), key=repr)
    assert contents(after) == expected[1]


def test_failed_page_is_recorded(spark, tables, tmp_path):
    ledger, sink = LG.Ledger(spark, str(tmp_path / "ledger")), ParquetSink(spark, str(tmp_path / "sink"))
    ledger.publish(tables[1])
    stage, calls = sink.stage, []

    def broken(rows, batch):
        calls.append(batch)
        if len(calls) == 2:
            raise RuntimeError("sink down")
        return stage(rows, batch)

    sink.stage = broken
    with pytest.raises(P.BatchFailed) as failed:
        run(ledger, tables, sink)
    assert str(failed.value.__cause__) == "sink down"
    after = run(ledger, tables, sink)
    assert {r["v_status"]: r["count"] for r in after.groupBy("v_status").count().collect()}[2] >= PAGE
    assert after.filter(P.pending_filter()).isEmpty() and calls.count(calls[1]) == 1


def test_default_run_time(spark):
    assert P.run_time("2024-01-01 00:00:00") == "2024-01-01 00:00:00" and P.run_time().startswith("20")


def test_nothing_pending(spark, tables, tmp_path):
    ledger, sink = LG.Ledger(spark, str(tmp_path / "ledger")), ParquetSink(spark, str(tmp_path / "sink"))
    ledger.publish(tables[1].limit(0))
    assert run(ledger, tables, sink).count() == 0 and sink.read() is None


def test_records(spark, tmp_path):
    r = Records(spark, str(tmp_path))
    assert r.get("a/b") is None and r.names("a") == []
    r.put("a/b", "text é")
    assert r.get("a/b") == "text é" and r.names("a") == ["b"]
    with pytest.raises(FileExistsError):
        r.put("a/b", "other")


def test_rounds_grow(spark, tables, expected, tmp_path):
    """Many pages take few writes, and a round that fails is halved until the failing page is alone."""
    ledger, sink = LG.Ledger(spark, str(tmp_path / "ledger")), ParquetSink(spark, str(tmp_path / "sink"))
    ledger.publish(tables[1])
    stage, calls = sink.stage, []

    def counting(rows, batch):
        calls.append(batch)
        if "0-1-1" in batch and not isinstance(batch, str):
            raise RuntimeError("too many")
        return stage(rows, batch)

    sink.stage = counting
    after = LG.run_ledger(tables[0], ledger, sink, CFG, RUN, limit=1)
    pages = len(ledger.committed(0))
    assert pages > 12 and len(calls) <= 12 and "0-1-1" in calls
    assert (contents(sink.read(), P.OUTPUT_COLUMNS), contents(after)) == expected


def test_batches_committed_before_stay(spark, tmp_path):
    sink = ParquetSink(spark, str(tmp_path / "sink"))
    rows = spark.createDataFrame([("a", 1, "C"), ("b", 2, "C"), ("c", 3, "V")], "batch string, v int, zip_category string")
    sink.commit("a", sink.stage(rows.filter("batch = 'a'").drop("batch"), "a"))
    for _ in range(2):
        sink.commit(["a", "b", "c"], sink.stage(rows, ["a", "b", "c"]))
        assert contents(sink.read(), ["v", "zip_category"]) == [(1, "C"), (2, "C"), (3, "V")]
    sink.commit("b", sink.stage(rows.filter("batch = 'b'").drop("batch"), "b"))
    assert sink.read().count() == 3
