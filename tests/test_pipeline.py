"""Batch pipeline: pending keys, five metrics, sink shape, status outcome,
parquet and JDBC sinks (embedded in-memory Derby: no server, no port)."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from curvethin.config import ThinConfig
from curvethin.plans import pipeline as P
from curvethin.sources import fixtures as FX
from curvethin.sources.io import read_config, read_jdbc, write_jdbc, write_parquet

RUN = "2024-06-30 12:00:00"


def test_run_batch_parquet(spark):
    process = FX.process_rows(spark, SF_SMALL)
    status = FX.status_rows(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="curvethin-out-")
    cfg = ThinConfig(target=0.5)
    new_status = P.run_batch(process, status, cfg, RUN,
                             lambda df: write_parquet(df, out, mode="overwrite"))
    written = spark.read.parquet(out)
    assert set(r[0] for r in written.select("zip_category").distinct().collect()) <= set("CEITV")
    assert written.filter(~F.col("handle").endswith(",2024-06-30")).count() == 0
    assert written.filter(F.col("modified_user") != "spark").count() == 0
    # every written row belongs to a pending even-shard key
    keys = P.pending_keys(status, 0)
    assert written.join(keys, FX.PROCESS_KEYS, "left_anti").count() == 0
    # status: batch keys -> 1, others unchanged
    s = new_status.join(keys.withColumn("b", F.lit(1)), FX.PROCESS_KEYS, "left")
    done = s.filter(F.col("b").isNotNull())
    assert done.filter(F.col("c_status") != 1).count() == 0
    assert done.count() == keys.count()
    before = status.join(keys, FX.PROCESS_KEYS, "left_anti").orderBy(*FX.PROCESS_KEYS).collect()
    after = (new_status.join(keys, FX.PROCESS_KEYS, "left_anti")
             .select(*status.columns).orderBy(*FX.PROCESS_KEYS).collect())
    assert before == after


def test_run_batch_write_failure_marks_batch_failed(spark):
    process = FX.process_rows(spark, SF_SMALL)
    status = FX.status_rows(spark, SF_SMALL)

    def broken(df):
        raise RuntimeError("sink down")

    with pytest.raises(P.BatchFailed) as failed:
        P.run_batch(process, status, ThinConfig(), RUN, broken)
    assert str(failed.value.__cause__) == "sink down"
    keys = P.pending_keys(status, 0)
    got = failed.value.status.join(keys, FX.PROCESS_KEYS).select("v_status").distinct().collect()
    assert [r[0] for r in got] == [2]


def test_backlog_runs_until_nothing_is_pending(spark):
    process = FX.process_rows(spark, SF_SMALL).filter("remark < '3'")
    status = FX.status_rows(spark, SF_SMALL).filter("remark < '3'")
    work = tempfile.mkdtemp(prefix="curvethin-backlog-")
    calls = []

    def write(df):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("sink down")
        write_parquet(df, work + "/rows")

    def run():
        return P.run_backlog(process, status, work + "/status", ThinConfig(target=0.5), RUN, write)

    with pytest.raises(P.BatchFailed) as failed:
        run()
    assert str(failed.value.__cause__) == "sink down"
    after = run()  # goes on from what is stored; the failed shard stays failed
    assert after.count() == status.count()
    assert after.filter(P.pending_filter()).isEmpty()
    odd = P.pending_keys(status, 1)
    assert {r[0] for r in after.join(odd, FX.PROCESS_KEYS).select("v_status").distinct().collect()} == {2}
    even = P.pending_keys(status, 0)
    assert {r[0] for r in after.join(even, FX.PROCESS_KEYS).select("v_status").distinct().collect()} == {1}


def test_more_keys_than_the_old_batch_size(spark):
    status = spark.range(7000).selectExpr("CAST(id AS STRING) AS remark", "0 AS st_business_cycle", "2 AS step_id",
                                          *[f"0 AS {c}" for c in FX.FLAG_COLUMNS])
    assert P.pending_keys(status, 0).count() == 7000


def test_output_columns_and_repair(spark):
    rows = P.load_rows(FX.process_rows(spark, SF_SMALL), None)
    kept = P.thin_metrics(rows, ThinConfig(target=0.5))
    out = P.compressed_output(kept, RUN)
    assert out.columns == P.OUTPUT_COLUMNS
    assert "step_logic_number" not in out.columns and "row_num" not in out.columns
    # repaired capacity is never 0 where the discharge value is not 0
    bad = out.filter((F.col("pv_charge_capacity") == 0) & (F.col("pv_discharge_capacity") != 0))
    assert bad.count() == 0


def test_read_config_by_position(spark):
    row = [None, None, 40, 5, 6, 0.8, 0.2, 0.05, None, None, None, None]
    schema = ",".join(f"c{i} string" for i in range(12))
    df = spark.createDataFrame([tuple(None if v is None else str(v) for v in row)], schema)
    cfg = read_config(df)
    assert (cfg.threshold, cfg.pre, cfg.post, cfg.target, cfg.start, cfg.step) == \
        (40, 5, 6, 0.8, 0.2, 0.05)


def test_jdbc_round_trip(spark):
    url = "jdbc:derby:memory:curvethin;create=true"
    opts = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = P.load_rows(FX.process_rows(spark, SF_SMALL), None)
    kept = P.compressed_output(P.thin_metrics(rows, ThinConfig(target=0.5)), RUN)
    small = kept.select("handle", "zip_category", F.col("pv_voltage").cast("double").alias("v"),
                        "sequence_id")
    write_jdbc(small, url, "ZIP_OUT", opts, mode="overwrite")
    back = read_jdbc(spark, url, table="ZIP_OUT", options=opts, partition_column="SEQUENCE_ID",
                     lower_bound=0, upper_bound=1000, num_partitions=4)
    assert back.count() == small.count()
    assert sorted(r[0] for r in back.select("HANDLE").collect()) == \
        sorted(r[0] for r in small.select("handle").collect())


def test_run_batch_per_metric_status(spark):
    """Keys with only v_status pending: only V rows written, only v_status set."""
    process = FX.process_rows(spark, SF_SMALL)
    status = FX.status_rows(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="curvethin-out-")
    new_status = P.run_batch(process, status, ThinConfig(target=0.5), RUN,
                             lambda df: write_parquet(df, out, mode="overwrite"),
                             per_metric_status=True)
    keys = P.pending_keys(status, 0)
    v_only = status.join(keys, FX.PROCESS_KEYS).filter(
        (F.col("c_status") == 1) & (F.col("v_status") == 0)).select(*FX.PROCESS_KEYS)
    all_pending = status.join(keys, FX.PROCESS_KEYS).filter(F.col("c_status") == 0) \
        .select(*FX.PROCESS_KEYS)
    assert v_only.count() > 0 and all_pending.count() > 0
    written = spark.read.parquet(out)
    cats = {r[0] for r in written.join(v_only, FX.PROCESS_KEYS).select("zip_category")
            .distinct().collect()}
    assert cats == {"V"}
    cats_all = {r[0] for r in written.join(all_pending, FX.PROCESS_KEYS)
                .select("zip_category").distinct().collect()}
    assert cats_all == set("CEITV")
    after = new_status.join(v_only, FX.PROCESS_KEYS).select(
        "c_status", "e_status", "i_status", "t_status", "v_status").distinct().collect()
    assert [tuple(r) for r in after] == [(1, 1, 1, 1, 1)]
    # keys outside the batch are unchanged
    before = status.join(keys, FX.PROCESS_KEYS, "left_anti").orderBy(*FX.PROCESS_KEYS).collect()
    rest = (new_status.join(keys, FX.PROCESS_KEYS, "left_anti").select(*status.columns)
            .orderBy(*FX.PROCESS_KEYS).collect())
    assert before == rest


def test_jdbc_ranges_of_a_skewed_column(spark):
    """Equal parts of a column whose values crowd at one end, with a heavy value and nulls; every row in one part."""
    from statistics import median

    from curvethin.sources.io import jdbc_ranges, read_jdbc_balanced

    url, opts = "jdbc:derby:memory:skewed;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.range(6000).selectExpr("CAST(CASE WHEN id % 40 = 0 THEN NULL WHEN id % 7 = 0 THEN 1000000000 + id "
                                        "ELSE pow(id / 6000.0, 6) * 40000 - 50 END AS BIGINT) AS K", "id AS V")
    write_jdbc(rows.repartition(3), url, "SKEWED", opts, mode="overwrite")
    parts = jdbc_ranges(spark, url, "SKEWED", "K", 8, opts)
    assert parts[0] == "K IS NULL"
    back = read_jdbc_balanced(spark, url, "SKEWED", "K", 8, opts)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    counts = {r[0]: (r[1], r[2]) for r in back.filter("K IS NOT NULL").groupBy(F.spark_partition_id())
              .agg(F.count("*"), F.countDistinct("K")).collect()}
    wide = [n for n, values in counts.values() if values > 1]
    assert len(counts) >= 6 and max(wide) <= 2 * median(n for n, _ in counts.values())
    none = spark.createDataFrame([], "K bigint, V bigint")
    write_jdbc(none, url, "NOTHING", opts, mode="overwrite")
    assert read_jdbc_balanced(spark, url, "NOTHING", "K", 4, opts).count() == 0


def test_ordered_files(spark):
    """Sorted inside each file and among them, by position."""
    import os

    from curvethin.sources.io import read_ordered, write_ordered

    path = tempfile.mkdtemp(prefix="curvethin-ordered-") + "/rows"
    rows = FX.process_rows(spark, SF_SMALL).select("remark", "sequence_id", "handle")
    write_ordered(rows, path, ["remark", "sequence_id", "handle"], rows_per_file=700)
    got = [tuple(r) for r in read_ordered(spark, path).orderBy("position").collect()]
    assert [r[3] for r in got] == list(range(1, rows.count() + 1))
    assert [r[:3] for r in got] == sorted(map(tuple, rows.collect()), key=lambda r: (r[0].encode(), r[1], r[2].encode()))
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) > 4


def test_failed_status_write_keeps_the_cause(spark):
    from curvethin.streaming.incremental import process_micro_batch

    def rows(df):
        raise RuntimeError("sink down")

    def status(df):
        raise RuntimeError("status down")

    with pytest.raises(RuntimeError, match="status down") as e:
        process_micro_batch(FX.process_rows(spark, SF_SMALL), FX.status_rows(spark, SF_SMALL), ThinConfig(target=0.5), rows, status)
    assert str(e.value.__cause__) == "sink down"
