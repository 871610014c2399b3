"""Scan, row ids and split path on real and hostile rows."""

from __future__ import annotations

import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from curvethin.config import ThinConfig
from curvethin.operators.thin import SCORE_COLUMNS, mark, score, thin
from curvethin.plans import catalog as C
from curvethin.plans import pipeline as P
from curvethin.session import clear_stored, store
from curvethin.sources import fixtures as FX
from curvethin.sources import rows as R

KEYS, ORDER = ["user_id"], ["ts", "event_id"]


def rows_of(df, cols):
    return sorted((tuple(r[c] if not isinstance(r[c], list) else tuple(r[c]) for c in cols) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("anchor", ["origin", "first"])
def test_fits_are_bit_equal_on_both_paths(spark, anchor):
    d = FX.events_by_user(spark, SF_SMALL)
    cols = ["user_id", "row_num", "n", *SCORE_COLUMNS, "level_fits"]
    got = {}
    for name, cfg in {"scan": ThinConfig(target=0.5, leading_anchor=anchor), "blocks": ThinConfig(target=0.5, leading_anchor=anchor, block_rows=13, sort_rows=300),
                      "large": ThinConfig(target=0.5, leading_anchor=anchor, block_rows=50)}.items():
        for parts in (3, 11) if name == "scan" else (5,):
            got[name, parts] = rows_of(score(d.repartition(parts), KEYS, ORDER, "value", cfg, detail=True, split="never" if name == "scan" else "always"), cols)
    first, *others = got.values()
    assert len(first) == 1000 and all(o == first for o in others)


def test_a_thousand_levels(spark):
    """Many levels on both paths; the chosen level is the first that reaches the target."""
    d = FX.events_by_type(spark, SF_SMALL)
    cfg = ThinConfig(target=0.5, start=0.001, step=0.001)
    cols = ["event_type", "row_num", "level", "fit", "keep", "level_fits"]
    one = rows_of(score(d, ["event_type"], ORDER, "value", cfg, detail=True, split="never"), cols)
    assert one == rows_of(score(d, ["event_type"], ORDER, "value", cfg.with_(block_rows=37), detail=True, split="always"), cols)
    for _, _, level, fit, _, fits in one:
        assert len(fits) == 1000 and fits[level - 1] == fit >= 0.5 and max(fits[:level - 1], default=0) < 0.5


def hostile(spark, tmp_path):
    """Null keys, NaN, infinities and text that is no number; rows that repeat; series of all sizes; written as a table."""
    rnd = random.Random(4)
    rows = []
    for key, n in {None: 70, "a": 51, "b": 50, "c": 300, "": 60, "d": 1, "e": 90}.items():
        for i in range(n):
            y = str(round(rnd.gauss(0, 3), 2))
            if key == "e" and i == 40:
                y = "n/a"
            rows.append((key, i // 2 if key == "c" else i, y, {"a": "NaN", "b": "Infinity"}.get(key, "1.5") if i == 30 else str(i % 7), "wide" * 5))
    rows += rows[:20]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "k string, i int, u string, v string, w string").repartition(3).write.parquet(path)
    return R.with_ids(spark.read.parquet(path))


@pytest.mark.parametrize("split", ["auto", "always"])
def test_marks_and_fetch(spark, tmp_path, monkeypatch, split):
    d = hostile(spark, tmp_path)
    cfg, metrics = ThinConfig(target=0.4, block_rows=11), {"U": "u", "V": "v"}
    narrow = d.select("k", "i", "u", "v", R.ROW_ID, F.col(f"{R.ROW_ID}.file").alias("f"), F.col(f"{R.ROW_ID}.row").alias("r")).withColumns({"u2": F.col("u"), "v2": F.col("v")})
    order = ["i", "u2", "v2", "f", "r"]
    s = score(narrow, ["k"], order, metrics, cfg, split="never")
    want = {}
    for r in s.collect():
        want.setdefault((r["f"], r["r"]), [r["row_num"], 0, 0])
        bit = 1 if r["zip_category"] == "U" else 2
        want[r["f"], r["r"]][1] |= bit * r["keep"]
        want[r["f"], r["r"]][2] |= bit * r["failed"]
    assert {v[2] for v in want.values()} == {0, 1, 2}
    m = store(mark(narrow, ["k"], order, metrics, cfg, [R.ROW_ID], split))
    got = {(r[R.ROW_ID]["file"], r[R.ROW_ID]["row"]): [r["row_num"], r["kept"], r["failed"]] for r in m.collect()}
    assert got == {k: v for k, v in want.items() if v[1] or v[2]}
    for limit in (R.BROADCAST_ROWS, 0):
        monkeypatch.setattr(R, "BROADCAST_ROWS", limit)
        kept = P.fetch_kept(d.drop("u"), m, metrics)
        assert sorted(kept.columns) == ["i", "k", "row_num", "v", "w", "zip_category"]
        assert kept.count() == sum(bin(v[1]).count("1") for v in want.values())
    assert {r["w"] for r in kept.collect()} == {"wide" * 5}
    clear_stored(spark)


def _widest(df, kinds):
    found = []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.initialPlan())
        if any(node.nodeName().startswith(k) for k in kinds):
            found.append(node.output().size())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return max(found, default=0)


def test_wide_rows_are_not_exchanged(spark, monkeypatch):
    assert _widest(C.q_compressed_output(spark, SF_SMALL), ("Exchange", "Sort")) <= 16  # a small table's rows as found: not the 45 columns
    monkeypatch.setattr(R, "SMALL_TABLE", 0.0)
    assert _widest(C.q_compressed_output(spark, SF_SMALL), ("Exchange", "Sort")) == 0  # the marks are stored; what is left is scan, lookup, projection
    rows, _ = FX.process_source(spark, SF_SMALL)
    assert 0 < _widest(P.mark_rows(P.repair_metrics(rows), C.CFG_A), ("Exchange", "Sort")) <= 14


def test_batch_with_row_ids_equals_batch_without(spark, tmp_path):
    rows = FX.process_rows(spark, SF_SMALL)
    path = str(tmp_path / "process")
    rows.repartition(4).write.parquet(path)
    stored = spark.read.parquet(path)
    status = FX.status_rows(spark, SF_SMALL)
    out = {}
    for name, table in {"ids": R.with_ids(stored), "plain": stored}.items():
        where = str(tmp_path / name)
        after = P.run_batch(table, status, C.CFG_A, C.RUN_TS, lambda d: d.write.parquet(where), shard=0)
        out[name] = (rows_of(spark.read.parquet(where), P.OUTPUT_COLUMNS), rows_of(after, status.columns))
    assert out["ids"] == out["plain"] and len(out["ids"][0]) > 100


def test_thin_keeps_its_columns(spark):
    d = FX.events_by_user(spark, SF_SMALL).withColumn("extra", F.array(F.lit(1), F.lit(2)))
    kept = thin(d, KEYS, ORDER, "value", C.CFG_B)
    assert kept.columns == ["user_id", "ts", "event_id", "value", "extra", "row_num"]
    assert kept.count() == C.q_thin_series(spark, SF_SMALL).count()


def test_empty_table(spark):
    none = FX.events_by_user(spark, SF_SMALL).limit(0)
    assert thin(none, KEYS, ORDER, "value", C.CFG_B).count() == 0
    assert score(none, KEYS, ORDER, "value", C.CFG_B, split="never", detail=True).count() == 0
