"""Split path: thin series too long for one task.

A series holding a large share of all rows cannot be one task's.  This path
computes exactly what :mod:`curvethin.operators.scan` computes, fits included bit
for bit, with every shuffle keyed on something finer than the series:

1. exact positions by a range-partitioned sort (:func:`global_positions`):
   ``repartitionByRange`` splits a hot series over many tasks; a small table
   of per-(series, partition) offsets turns partition-local ids into 1-based
   positions.  The sorted rows are checkpointed so the ids are stable data.
2. the series is cut into blocks of ``cfg.block_rows`` consecutive rows, which
   are grouped by (keys, block).
3. what a block needs from outside (the neighbour across its edge; the points
   before and after it that are the nearest kept ones at some level) comes from
   per-block summaries of a few points each, carried along the blocks.
4. ranking by significance is a second range-partitioned sort.
5. each block gives its part of SSE for every level as three integers
   (:func:`curvethin.functions.levels.pieces`), which add up exactly in any order;
   the chosen level is joined back as a one-row-per-series table.

All side tables have at most one row per block or per (series, sort
partition); they are broadcast when their row count is below a limit, and
joined by shuffle otherwise.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ThinConfig
from ..functions import exprs as X
from ..functions import levels as L
from ..session import checkpoint_dir, store
from ..sources.rows import ROW_ID
from .series import join_same, with_regions
from .thin import (BAD_SQL, INTERIOR, KEEP, MIDDLE, is_interior, kept_point_sql, point,
                   prev_eligible_sql, view_columns)

# Side tables are broadcast when their proven row bound times an estimated
# row width stays under this many bytes; otherwise they are shuffle-joined
# (on keys that include the block, so the join is balanced).
SIDE_BROADCAST_BYTES = 128 * 1024 * 1024
SIDE_BROADCAST_ROWS = 2_000_000  # for narrow key lists (~64 bytes per row)


def _small(bound: int, row_bytes: int = 64) -> bool:
    """Whether a side table whose row count is proven <= ``bound`` may be broadcast."""
    return bound * row_bytes <= SIDE_BROADCAST_BYTES


def global_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                     out: str, rows: int, rows_per_task: int, n_keys: int,
                     size: str | None = None) -> DataFrame:
    """Exact 1-based ``row_number()`` per ``keys`` in ``order`` for groups of
    any size, and optionally the group size in ``size``.

    ``rows``/``n_keys`` bound the input (rows, groups); ``rows_per_task`` sets
    the number of range partitions.  ``order`` must be a total order.  The
    offsets table is joined on (keys, partition id), never on keys alone.
    """
    checkpoint_dir(df.sparkSession)
    keys = list(keys)
    parts = max(1, math.ceil(rows / max(1, rows_per_task)))
    sort_cols = [F.col(k) for k in keys] + [F.col(c) if isinstance(c, str) else c for c in order]
    tagged = (df.repartitionByRange(parts, *sort_cols)
                .sortWithinPartitions(*sort_cols)
                .select("*", F.spark_partition_id().alias("_pid"),
                        F.monotonically_increasing_id().alias("_mid")))
    # Cut the lineage: partition ids and row ids become stored values, so a
    # lost executor cannot renumber anything.
    tagged = tagged.checkpoint(eager=True)
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    extra = [F.sum("_cnt").over(whole).alias(size)] if size else []
    bases = (tagged.groupBy(*keys, "_pid")
                   .agg(F.min("_mid").alias("_min"), F.count(F.lit(1)).alias("_cnt"))
                   .select(*keys, "_pid",
                           (F.col("_min") - F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
                           .alias("_base"), *extra))
    bound = parts + n_keys  # a group spans consecutive partitions
    return (join_same(tagged, bases, [*keys, "_pid"], small=_small(bound))
                  .withColumn(out, F.col("_mid") - F.col("_base") + 1)
                  .drop("_pid", "_mid", "_base"))


def score_split(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None, y: str,
                cfg: ThinConfig, n_series: int, rows: int, detail: bool = False,
                row_num: str = "row_num", size: str = "n",
                view_level: int | None = None) -> DataFrame:
    """Score rows like :func:`curvethin.operators.scan.scan_series`, block by block.

    ``n_series`` and ``rows`` bound the input.  Without ``order`` the rows already have
    ``row_num`` and ``size``, as stored values.
    """
    keys = list(keys)
    B = cfg.block_rows
    n_blocks = rows // B + n_series  # bound on (series, block) pairs

    d = df if order is None else global_positions(df, keys, order, row_num, rows, cfg.sort_rows, n_series, size)
    d = with_regions(d, cfg, row_num, size)
    d = (d.withColumn("_blk", F.floor((F.col(row_num) - 1) / F.lit(B)).cast("long"))
          .withColumn("_x", F.col(row_num).cast("double"))
          .withColumn("_y", F.col(y).try_cast("double")))

    # Neighbours: inside the block by lag/lead, across the edge from the
    # neighbouring block's last/first row.
    wb = Window.partitionBy(*keys, "_blk")
    wbx = wb.orderBy(row_num)
    edges = d.groupBy(*keys, "_blk").agg(F.min(point(row_num, "_y")).alias("_f"),
                                          F.max(point(row_num, "_y")).alias("_l"))
    we = Window.partitionBy(*keys).orderBy("_blk")
    edges = edges.select(*keys, "_blk",
                         F.lag(F.col("_l")["y"]).over(we).alias("_edge_yp"),
                         F.lead(F.col("_f")["y"]).over(we).alias("_edge_yn"))
    d = join_same(d, edges, [*keys, "_blk"], small=_small(n_blocks))
    first_in_blk = (F.col(row_num) - 1) % F.lit(B) == 0
    last_in_blk = (F.col(row_num) % F.lit(B) == 0)
    d = (d.withColumn("_yp", F.when(first_in_blk, F.col("_edge_yp")).otherwise(F.lag("_y").over(wbx)))
          .withColumn("_yn", F.when(last_in_blk, F.col("_edge_yn")).otherwise(F.lead("_y").over(wbx))))
    sig = X.significance_sql("_x", "_y", "_x - 1", "_yp", "_x + 1", "_yn")
    d = d.withColumn("sig", F.expr(f"CASE WHEN {INTERIOR} THEN {sig} END"))
    d = d.drop("_edge_yp", "_edge_yn", *([] if view_level is not None else ["_yp", "_yn"]))

    # Rank by significance: interior points first (non-null), ties by x.
    d = global_positions(d, keys, [F.col("sig").desc_nulls_last(), F.col(row_num).asc()],
                         "_pos2", rows, cfg.sort_rows, n_series)
    d = d.withColumn("rnk", F.when(is_interior(), F.col("_pos2"))).drop("_pos2")
    end = F.expr(f"{MIDDLE} AND (mpos = 1 OR mpos = n_mid)")
    d = d.withColumn("entry", F.when(end, 0).when(is_interior(), _entry(cfg)("rnk", "n_mid")))

    middle = d.filter(MIDDLE).select(*keys, "_blk", "_x", "_y", "entry", "n_mid")
    blocks = store(_summaries(middle, keys))
    series = store(_series(middle, blocks, keys))
    sums = _block_sums(middle, _carried(blocks, keys), series, keys, cfg, n_series)
    per_series = _fits(sums, series, keys, cfg)
    base = d if view_level is None else _with_anchors(d, keys, row_num, cfg, view_level, n_blocks)
    if _small(n_series, 64 + 8 * len(cfg.levels())):
        out = join_same(base, per_series, keys, "left", small=True)
    else:
        # one copy per block, joined on (keys, block): no task gets a whole series
        per_block = join_same(edges.select(*keys, "_blk"), per_series, keys)
        out = join_same(base, per_block, [*keys, "_blk"], "left")
    return _finish(out, cfg, detail).drop("_blk")


def _entry(cfg: ThinConfig):
    """Column function (rank, size of the middle) -> the first level that keeps the point."""
    levels = np.array(cfg.levels())

    @F.pandas_udf("int")
    def entry(rank: pd.Series, n_mid: pd.Series) -> pd.Series:
        known = rank.notna()
        m = n_mid[known].to_numpy(np.int64) - 2
        out = pd.Series(np.nan, rank.index)
        if len(m):
            kinds, which = np.unique(m, return_inverse=True)
            out[known] = L.entries(rank[known].to_numpy(np.int64), kinds, which, levels)
        return out.astype("Int32")

    return entry


def _types(df: DataFrame, keys: Sequence[str]) -> str:
    return ", ".join(f"{X.q(k)} {df.schema[k].dataType.simpleString()}" for k in keys)


_POINTS = "array<double>"


def _summaries(middle: DataFrame, keys: list[str]) -> DataFrame:
    """Of each block: its points that are at some level the last or the first one kept."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_x")
        x, y, entry = rows["_x"].to_numpy(), rows["_y"].to_numpy(float), rows["entry"].to_numpy(np.int64)
        out = [*key]
        for places in (L.last_kept(entry), L.first_kept(entry)):
            out += [entry[places].astype(float), x[places], y[places]]
        return pd.DataFrame([out], columns=[*keys, "_blk", "_le", "_lx", "_ly", "_fe", "_fx", "_fy"])

    schema = f"{_types(middle, [*keys, '_blk'])}, " + ", ".join(f"{c} {_POINTS}" for c in ("_le", "_lx", "_ly", "_fe", "_fx", "_fy"))
    return middle.groupBy(*keys, "_blk").applyInPandas(run, schema)


def _carried(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Of each block: the points before it and after it that are at some level the nearest kept ones.
    One series' summaries, a few points for ``block_rows`` rows, are walked along the blocks."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_blk")
        n = len(rows)
        sides = []
        for names, way in ((("_le", "_lx", "_ly"), range(n)), (("_fe", "_fx", "_fy"), range(n - 1, -1, -1))):
            held, out = np.zeros((3, 0)), [None] * n
            for i in way:
                out[i] = held
                own = np.array([rows[c].iloc[i] for c in names], float)
                held = held[:, held[0] < own[0].min()]
                held = np.concatenate([held, own] if names[0] == "_le" else [own, held], axis=1)
            sides.append(out)
        cols = {k: [v] * n for k, v in zip(keys, key)} | {"_blk": rows["_blk"].to_numpy()}
        for side, out in zip("pq", sides):
            cols |= {f"_{side}{c}": [o[j] for o in out] for j, c in enumerate("exy")}
        return pd.DataFrame(cols)

    schema = f"{_types(blocks, [*keys, '_blk'])}, " + ", ".join(f"_{s}{c} {_POINTS}" for s in "pq" for c in "exy")
    return blocks.groupBy(*keys).applyInPandas(run, schema)


def _piece_columns(term: str, b: str) -> list[Column]:
    """Exact sums of :func:`curvethin.functions.levels.pieces` as SQL aggregates."""
    first = f"(({term}) * pow(2.0D, {61 - L.BITS_ABOVE} - {b}))"
    second = f"(({first} - floor({first})) * pow(2.0D, 61 - {b}))"
    third = f"(({second} - floor({second})) * pow(2.0D, 61 - {b}))"
    return [F.sum(F.expr(f"CAST(floor({p}) AS BIGINT)")).alias(f"_s{i}") for i, p in enumerate((first, second, third))]


def _series(middle: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Of each series: whether it has a bad value, its size, whether it is flat, the scaling exponent, ``bits``, the mean of the scaled values."""
    one = middle.groupBy(*keys).agg(
        F.max(F.expr(BAD_SQL)).alias("_bad"), F.max("n_mid").alias("_n"),
        F.max(F.expr("CASE WHEN NOT " + BAD_SQL + " THEN abs(_y) END")).alias("_most"),
        (F.min("_y") == F.max("_y")).alias("_flat"))

    @F.pandas_udf("long")
    def exponent(most: pd.Series) -> pd.Series:
        return pd.Series(L.exponent(most.fillna(0.0).to_numpy(float)))

    @F.pandas_udf("long")
    def bits(n: pd.Series) -> pd.Series:
        return pd.Series(L.bits(n.to_numpy(np.int64)))

    one = store(one.select(*keys, "_bad", "_n", "_flat", exponent("_most").alias("_k"), bits("_n").alias("_b")))
    # by block first: the sums of one series come from many tasks
    scale = join_same(blocks.select(*keys, "_blk"), one.filter("NOT _bad").select(*keys, "_k", "_b"), keys)
    rows = join_same(middle.select(*keys, "_blk", "_y"), scale, [*keys, "_blk"])
    scaled = "(_y * pow(2.0D, -(_k div 2)) * pow(2.0D, -(_k - _k div 2)))"
    sums = rows.groupBy(*keys).agg(*_piece_columns(scaled, "_b"))

    @F.pandas_udf("double")
    def mean(a: pd.Series, b: pd.Series, c: pd.Series, bits_: pd.Series, n: pd.Series) -> pd.Series:
        total = L.value([v.fillna(0).to_numpy(np.int64) for v in (a, b, c)], bits_.to_numpy(np.int64))
        return pd.Series(total / n.to_numpy(np.int64))

    return join_same(one, sums, keys, "left").select(*keys, "_bad", "_n", "_flat", "_k", "_b", mean("_s0", "_s1", "_s2", "_b", "_n").alias("_mean"))


def _block_sums(middle: DataFrame, carried: DataFrame, series: DataFrame, keys: list[str], cfg: ThinConfig,
                n_series: int) -> DataFrame:
    """keys, _level, _s0, _s1, _s2: exact sums of a series' squared errors at each level; level 0 holds those of SST."""
    n_levels, from_origin, first_x = len(cfg.levels()), cfg.leading_anchor == "origin", float(cfg.pre + 1)
    carried = join_same(carried, series.filter("NOT _bad").select(*keys, "_k", "_b", "_mean"), keys, small=_small(n_series))

    def run(rows: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(columns=[*keys, "_level", "_s0", "_s1", "_s2"])
        if not len(rows) or not len(around):
            return out
        a, rows = around.iloc[0], rows.sort_values("_x")
        col = lambda c, name: np.concatenate([np.asarray(a["_p" + c], float), rows[name].to_numpy(float), np.asarray(a["_q" + c], float)])
        x, y, entry = col("x", "_x"), np.ldexp(col("y", "_y"), -int(a["_k"])), col("e", "entry").astype(np.int64)
        real = np.zeros(len(x), bool)
        real[len(a["_px"]):len(a["_px"]) + len(rows)] = True
        b = np.array([a["_b"]], np.int64)
        d = y[real] - a["_mean"]
        found = [(0, *(int(p.sum()) for p in L.pieces(d * d, b)))]
        for level, sums in L.errors_by_level(x, y, np.array([0, len(x)]), entry, b, n_levels,
                                             (x == first_x) & from_origin, real):
            found.append((level, *(int(s[0]) for s in sums)))
        return pd.DataFrame([(*(a[k] for k in keys), *f) for f in found], columns=out.columns)

    schema = f"{_types(middle, keys)}, _level int, _s0 bigint, _s1 bigint, _s2 bigint"
    parts = middle.groupBy(*keys, "_blk").cogroup(carried.groupBy(*keys, "_blk")).applyInPandas(run, schema)
    return parts.groupBy(*keys, "_level").agg(*[F.sum(c).alias(c) for c in ("_s0", "_s1", "_s2")])


def _fits(sums: DataFrame, series: DataFrame, keys: list[str], cfg: ThinConfig) -> DataFrame:
    """keys, failed, level, fit, _fits of each series; a group has a row for each level."""
    n_levels = len(cfg.levels())
    rows = join_same(series, sums, keys, "left")

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_level")
        one = rows.iloc[0]
        if one["_bad"]:
            return pd.DataFrame([(*key, True, None, None, None)], columns=[*keys, "failed", "level", "fit", "_fits"])
        b = np.array([one["_b"]], np.int64)
        total = L.value([rows[c].to_numpy(np.int64) for c in ("_s0", "_s1", "_s2")], b)
        sst = 0.0 if one["_flat"] else total[0]
        fits = L.fit(total[1:], np.full(n_levels, sst))
        level = int(np.flatnonzero(fits >= cfg.target)[0])
        return pd.DataFrame([(*key, False, level + 1, fits[level], fits)], columns=[*keys, "failed", "level", "fit", "_fits"])

    return rows.groupBy(*keys).applyInPandas(run, f"{_types(series, keys)}, failed boolean, level int, fit double, _fits array<double>")


def _with_anchors(d: DataFrame, keys: list[str], row_num: str, cfg: ThinConfig, level: int, n_blocks: int) -> DataFrame:
    """The step-by-step columns at one level: nearest kept points inside the block by running windows, else
    carried from the blocks before and after."""
    ok = prev_eligible_sql(cfg)
    summ = d.groupBy(*keys, "_blk").agg(F.max(F.expr(kept_point_sql(level, ok))).alias("_lp"),
                                        F.min(F.expr(kept_point_sql(level, MIDDLE))).alias("_fn"))
    wup = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    wdn = Window.partitionBy(*keys).orderBy(F.col("_blk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(*keys, "_blk", F.last("_lp", ignorenulls=True).over(wup).alias("_cp"),
                        F.last("_fn", ignorenulls=True).over(wdn).alias("_cn"))
    wb = Window.partitionBy(*keys, "_blk")
    wprev = wb.orderBy(row_num).rowsBetween(Window.unboundedPreceding, -1)
    wnext = wb.orderBy(F.col(row_num).desc()).rowsBetween(Window.unboundedPreceding, -1)
    a = join_same(d, carry, [*keys, "_blk"], small=_small(n_blocks, 128))
    a = a.select("*", F.coalesce(F.last(F.expr(kept_point_sql(level, ok)), ignorenulls=True).over(wprev), F.col("_cp"))
                 .alias(f"_p{level}"))
    a = a.select("*", F.coalesce(F.last(F.expr(kept_point_sql(level, MIDDLE)), ignorenulls=True).over(wnext), F.col("_cn"))
                 .alias(f"_n{level}"))
    return a.select("*", *view_columns(cfg, level))


def _finish(d: DataFrame, cfg: ThinConfig, detail: bool) -> DataFrame:
    """``failed``, ``level``, ``fit`` and ``keep`` from the joined series row (none for series without a middle)."""
    inside = f"({MIDDLE} OR region IN ('head', 'tail'))"
    d = d.withColumn("failed", F.coalesce("failed", F.lit(False)))
    d = d.withColumns({"level": F.when(F.expr(inside), F.col("level")), "fit": F.when(F.expr(inside), F.col("fit"))})
    d = d.withColumn("keep", F.expr(KEEP))
    if detail:
        d = d.withColumn("level_fits", F.when(F.expr(f"{inside} AND NOT failed"), F.col("_fits")))
    return d.select(*[c for c in d.columns if not c.startswith("_") or c == "_blk" or c == ROW_ID])
