"""The thinning operator.

Per series (and per metric, if several are thinned at once):

* series of at most ``threshold`` rows pass through whole;
* otherwise the first ``pre`` and last ``post`` rows are kept and the rows in
  between (the *middle list*) are thinned: interior points are ranked by the
  area of the triangle they span with their neighbours; level ``l`` keeps the
  ``floor(m * p_l)`` best of the ``m`` interior points plus the two ends of the
  middle list; dropped points are interpolated linearly between the nearest
  kept points; the first level whose fit ``1 - sqrt(SSE/SST)`` reaches the
  target is chosen.

The original loop over levels becomes a bounded *level scan*: each point gets
the first level at which it is kept (``entry``); for every level the previous
and next kept point come from running ``max``/``min``/``last`` windows over
frames that only grow (never ``... FOLLOWING``), SSE per level is a window
sum, and the chosen level is the smallest one meeting the target.  All of it
is built-in window and aggregate expressions: no Python in the data path.
The per-level expressions are written as SQL text (one JVM call per column
instead of one per expression node).

Series longer than ``cfg.max_series_rows`` are routed to the split path
(:mod:`curvethin.operators.split`), which computes the same result without
holding a whole series in one task.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ThinConfig
from ..functions import exprs as X
from ..session import checkpoint_dir, swept
from ..sources.rows import ROW_ID
from .series import join_same, number_rows, series_sizes, with_regions

# Columns the scoring adds (besides row_num / n when it numbers the rows).
SCORE_COLUMNS = ["region", "n_mid", "mpos", "sig", "rnk", "entry", "level", "fit",
                 "failed", "keep"]

# Number of hot series above which the hot-key list is not broadcast.
BROADCAST_KEY_LIMIT = 1_000_000


def point(x: str | Column, y: str | Column) -> Column:
    return F.struct(X.col(x).alias("x"), X.col(y).alias("y"))


MIDDLE = "region = 'middle'"
INTERIOR = f"({MIDDLE} AND mpos > 1 AND mpos < n_mid)"
END = f"({MIDDLE} AND (mpos = 1 OR mpos = n_mid))"


def is_middle() -> Column:
    return F.expr(MIDDLE)


def is_interior() -> Column:
    return F.expr(INTERIOR)


def prev_eligible_sql(cfg: ThinConfig) -> str:
    return f"({MIDDLE} AND mpos > 1)" if cfg.leading_anchor == "origin" else f"({MIDDLE})"


def kept_value_sql(level: int, cond: str, value: str) -> str:
    return f"CASE WHEN entry <= {level} AND {cond} THEN {value} END"


def kept_point_sql(level: int, cond: str) -> str:
    """The point (x, y) if kept at ``level`` and ``cond`` holds, else null."""
    return (f"CASE WHEN entry <= {level} AND {cond} "
            f"THEN named_struct('x', _x, 'y', _y) END")


BAD_SQL = "(_y IS NULL OR isnan(_y) OR abs(_y) = CAST('inf' AS DOUBLE))"


def entry_sql(cfg: ThinConfig) -> str:
    return (f"CASE WHEN {END} THEN 0 WHEN {INTERIOR} THEN "
            f"{X.entry_level_sql('rnk', 'n_mid - 2', cfg.levels())} END")


def with_entry(df: DataFrame, cfg: ThinConfig) -> DataFrame:
    """``entry``: 0 for the ends of the middle list, the first level keeping an
    interior point otherwise; needs ``rnk`` (1-based rank of interior points
    by significance, ties by x) and ``n_mid``."""
    return df.select("*", F.expr(entry_sql(cfg)).alias("entry"))


def error_sql(cfg: ThinConfig, level: int, prev: str, nxt: str) -> str:
    """Squared interpolation error at ``level`` (0 for kept middle points,
    null outside the middle list); ``prev``/``nxt`` are anchor struct columns."""
    if cfg.leading_anchor == "origin":
        px, py = f"coalesce({prev}.x, 0.0D)", f"coalesce({prev}.y, 0.0D)"
    else:
        px, py = f"{prev}.x", f"{prev}.y"
    yhat = X.interpolate_sql("_x", px, py, f"{nxt}.x", f"{nxt}.y")
    return (f"CASE WHEN {MIDDLE} THEN CASE WHEN entry <= {level} THEN 0.0D "
            f"ELSE (({yhat}) - _y) * (({yhat}) - _y) END END")


def error_columns(cfg: ThinConfig, prev: Sequence[str], nxt: Sequence[str]) -> list[Column]:
    return [F.expr(error_sql(cfg, lv, p, n)) for lv, (p, n) in enumerate(zip(prev, nxt), 1)]


def fits_column(cfg: ThinConfig, sse: Sequence[str], sst: str) -> Column:
    """Array of per-level fits."""
    return F.expr("array(" + ", ".join(X.fit_sql(s, sst) for s in sse) + ")")


KEEP = (f"NOT failed AND (region IN ('pass', 'head', 'tail', 'all') "
        f"OR ({MIDDLE} AND entry <= level))")


def score_local(df: DataFrame, keys: Sequence[str], cfg: ThinConfig, y: str = "y",
                row_num: str = "row_num", size: str = "n", detail: bool = False,
                order: Sequence[str | Column] | None = None,
                view_level: int | None = None) -> DataFrame:
    """Score rows with windows over ``partitionBy(keys)``: one exchange for
    the whole operator and five window stages.

    With ``order`` the rows are numbered here (``row_num``, series size
    ``size``) in the same window stage as the neighbours; without it they
    must already carry ``row_num`` (1..n, consecutive) and ``size``.
    """
    L = len(cfg.levels())
    keys = list(keys)
    wp = Window.partitionBy(*keys)
    levels = range(1, L + 1)

    # A: numbering (optional), series size, neighbours -- one Window operator.
    if order is not None:
        wo = wp.orderBy(*[F.col(c) if isinstance(c, str) else c for c in order])
        d = df.select("*", F.row_number().over(wo).cast("bigint").alias(row_num),
                      F.count(F.lit(1)).over(wo.rowsBetween(Window.unboundedPreceding,
                                                           Window.unboundedFollowing)).alias(size),
                      F.lag(y).over(wo).alias("_yp"), F.lead(y).over(wo).alias("_yn"))
    else:
        wx = wp.orderBy(row_num)
        d = df.select("*", F.lag(y).over(wx).alias("_yp"), F.lead(y).over(wx).alias("_yn"))
    d = with_regions(d, cfg, row_num, size)
    rn, yq = X.q(row_num), X.q(y)
    # a text that is no number becomes null, which fails its own pair only
    xd, yd = f"CAST({rn} AS DOUBLE)", f"TRY_CAST({yq} AS DOUBLE)"
    sig = X.significance_sql(xd, yd, f"{xd} - 1", "TRY_CAST(_yp AS DOUBLE)", f"{xd} + 1",
                             "TRY_CAST(_yn AS DOUBLE)")
    d = d.select("*", F.expr(xd).alias("_x"), F.expr(yd).alias("_y"),
                 F.expr(f"CASE WHEN {INTERIOR} THEN {sig} END").alias("sig"))

    # B: rank interior points by significance (ties: smaller x first).
    ws = wp.orderBy(F.col("sig").desc_nulls_last(), F.col(row_num).asc())
    d = d.select("*", F.when(is_interior(), F.row_number().over(ws).cast("bigint")).alias("rnk"))
    d = with_entry(d, cfg)

    # C / D: previous and next kept point for every level (growing frames).
    # x increases along the order, so the last kept x before a row is a max
    # and the first kept x after it a min; y is the matching last value.
    wprev = wp.orderBy(row_num).rowsBetween(Window.unboundedPreceding, -1)
    wdesc = wp.orderBy(F.col(row_num).desc())
    wnext = wdesc.rowsBetween(Window.unboundedPreceding, -1)
    ok = prev_eligible_sql(cfg)
    d = d.select("*", *[c for lv in levels for c in (
        F.max(F.expr(kept_value_sql(lv, ok, "_x"))).over(wprev).alias(f"_px{lv}"),
        F.last(F.expr(kept_value_sql(lv, ok, "_y")), ignorenulls=True).over(wprev)
        .alias(f"_py{lv}"))])
    d = d.select("*", *[c for lv in levels for c in (
        F.min(F.expr(kept_value_sql(lv, MIDDLE, "_x"))).over(wnext).alias(f"_nx{lv}"),
        F.last(F.expr(kept_value_sql(lv, MIDDLE, "_y")), ignorenulls=True).over(wnext)
        .alias(f"_ny{lv}"))])
    d = d.select(*[c for c in d.columns if not c.startswith(("_p", "_n"))],
                 *[F.expr(f"named_struct('x', _px{lv}, 'y', _py{lv})").alias(f"_p{lv}")
                   for lv in levels],
                 *[F.expr(f"named_struct('x', _nx{lv}, 'y', _ny{lv})").alias(f"_n{lv}")
                   for lv in levels])

    # E: per-series sums over the whole partition (same order as D: no sort).
    whole = wdesc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    errs = error_columns(cfg, [f"_p{lv}" for lv in levels], [f"_n{lv}" for lv in levels])
    mid_y = F.expr(f"CASE WHEN {MIDDLE} THEN _y END")
    bad = F.expr(f"CASE WHEN {MIDDLE} THEN {BAD_SQL} END")
    d = d.select("*", *[F.sum(e).over(whole).alias(f"_sse{i}") for i, e in enumerate(errs, 1)],
                 F.max(bad).over(whole).alias("_bad"),
                 F.var_pop(mid_y).over(whole).alias("_var"),
                 F.count(mid_y).over(whole).alias("_cnt"),
                 F.min(mid_y).over(whole).alias("_ymin"),
                 F.max(mid_y).over(whole).alias("_ymax"))
    sst = "CASE WHEN _ymin = _ymax THEN 0.0D ELSE _var * _cnt END"
    d = d.select("*", F.expr("coalesce(_bad, false)").alias("failed"),
                 fits_column(cfg, [f"_sse{lv}" for lv in levels], f"({sst})").alias("_fits"))
    if view_level is not None:
        d = d.select("*", *view_columns(cfg, view_level))
    return finish(d, cfg, detail)


def view_columns(cfg: ThinConfig, level: int) -> list[Column]:
    """Step-by-step columns at one level (middle rows only): x, y, the
    neighbours of interior points, kept flag, anchors and interpolated y."""
    if cfg.leading_anchor == "origin":
        px, py = f"coalesce(_p{level}.x, 0.0D)", f"coalesce(_p{level}.y, 0.0D)"
    else:
        px, py = f"_p{level}.x", f"_p{level}.y"
    nx, ny = f"_n{level}.x", f"_n{level}.y"
    mid = lambda e: F.expr(f"CASE WHEN {MIDDLE} THEN {e} END")
    inner = lambda e: F.expr(f"CASE WHEN {INTERIOR} THEN {e} END")
    return [
        mid("_x").alias("x"), mid("_y").alias("y"),
        inner("_x - 1").alias("x_prev"), inner("TRY_CAST(_yp AS DOUBLE)").alias("y_prev"),
        inner("_x + 1").alias("x_next"), inner("TRY_CAST(_yn AS DOUBLE)").alias("y_next"),
        mid(f"entry <= {level}").alias("kept"),
        mid(f"named_struct('x', {px}, 'y', {py})").alias("prev"),
        mid(f"named_struct('x', {nx}, 'y', {ny})").alias("next"),
        mid(f"CASE WHEN entry <= {level} THEN _y ELSE {X.interpolate_sql('_x', px, py, nx, ny)} END")
        .alias("yhat"),
    ]


def finish(d: DataFrame, cfg: ThinConfig, detail: bool) -> DataFrame:
    """From ``_fits`` (array of per-level fits) to ``level``, ``fit``, ``keep``."""
    L = len(cfg.levels())
    thinned = f"(({MIDDLE} OR region IN ('head', 'tail')) AND NOT failed)"
    d = d.select("*", F.expr(f"CASE WHEN {thinned} THEN "
                             f"{X.first_level_sql('_fits', L, cfg.target)} END").alias("level"))
    extra = [F.expr("CASE WHEN level IS NOT NULL THEN element_at(_fits, level) END").alias("fit"),
             F.expr(KEEP).alias("keep")]
    if detail:
        extra.append(F.expr(f"CASE WHEN {thinned} THEN _fits END").alias("level_fits"))
    d = d.select("*", *extra)
    return d.select(*[c for c in d.columns if not c.startswith("_") or c == ROW_ID])


def unpivot_metrics(df: DataFrame, ids: Sequence[str], metrics: Mapping[str, str | Column],
                    category: str = "zip_category", value: str = "y") -> DataFrame:
    """One row per (row, metric): ``ids``, ``category`` (the metric tag) and
    ``value`` as double.

    Written as ``inline(array(struct(...)))``: a Generate keeps the child's
    hash partitioning (an Expand from ``DataFrame.unpivot`` does not), so the
    per-metric windows reuse the numbering exchange on the series keys.
    """
    clash = {c.lower() for c in ids} & {category.lower(), value.lower()}
    if clash:
        raise ValueError(f"output names clash with id columns: {clash}")
    pairs = [F.struct(F.lit(tag).alias(category), X.col(c).try_cast("double").alias(value))
             for tag, c in metrics.items()]
    return df.select(*ids, F.inline(F.array(*pairs)))


def _score_cold(df: DataFrame, keys: list[str], order, y, cfg: ThinConfig, out: Sequence[str],
                kept_only: bool, row_num: str, size: str, category: str,
                pairs: DataFrame | None = None, view_level: int | None = None) -> DataFrame:
    """Series that fit in a task: one pass over sorted rows, or windows for a view of one level."""
    if view_level is not None:
        d, gk, v = _prepare(df, keys, y, order, row_num, size, category, pairs)
        own_order = order if isinstance(y, str) else None  # numbered in the first window stage
        return score_local(d, gk, cfg, v, row_num, size, False, own_order, view_level=view_level)
    from .scan import scan_series  # local import, as split

    many = not isinstance(y, str)
    carry = [c for c in df.columns if not (many and c in set(map(str, y.values())))]
    cols = (["y"] if many else []) + list(out)
    d = scan_series(df, keys, order, y, cfg, cols, carry, kept_only, row_num, size, category)
    return _only(d, pairs, keys, category)


def _only(long: DataFrame, pairs: DataFrame | None, keys: list[str], category: str) -> DataFrame:
    """Keep the (series, metric) pairs listed in ``pairs`` (a semi
    join; Spark broadcasts the pairs when they are small)."""
    if pairs is None:
        return long
    return join_same(long, pairs.select(*keys, category), keys + [category], "left_semi")


def _prepare(df: DataFrame, keys: list[str], y: str | Mapping[str, str | Column], order,
             row_num: str, size: str, category: str, pairs: DataFrame | None = None):
    """Unpivot several metrics, numbering the rows before; returns (frame, group keys, value column)."""
    if isinstance(y, str):
        return df, keys, y
    return _unpivoted(number_rows(df, keys, order, row_num, size), keys, y, category, pairs)


def _unpivoted(df: DataFrame, keys: list[str], y: Mapping[str, str | Column], category: str,
               pairs: DataFrame | None):
    ids = [c for c in df.columns if c not in set(map(str, y.values()))]
    long = _only(unpivot_metrics(df, ids, y, category, "y"), pairs, keys, category)
    return long, keys + [category], "y"


def _score_hot(df: DataFrame, keys: list[str], order, y: str | Mapping[str, str | Column],
               cfg: ThinConfig, n_hot: int, rows: int, detail: bool = False,
               row_num: str = "row_num", size: str = "n", category: str = "zip_category",
               pairs: DataFrame | None = None, view_level: int | None = None) -> DataFrame:
    """The split path.  Rows with several metrics are numbered once, before they are unpivoted."""
    from .split import global_positions, score_split

    if isinstance(y, str):
        return score_split(df, keys, order, y, cfg, n_hot, rows, detail, row_num, size, view_level)
    d = global_positions(df, keys, order, row_num, rows, cfg.sort_rows, n_hot, size)
    d, group_keys, value = _unpivoted(d, keys, y, category, pairs)
    return score_split(d, group_keys, None, value, cfg, n_hot * len(y), rows * len(y), detail,
                       row_num, size, view_level)


def score(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
          y: str | Mapping[str, str | Column], cfg: ThinConfig, detail: bool = False,
          split: str = "auto", row_num: str = "row_num", size: str = "n",
          category: str = "zip_category", pairs: DataFrame | None = None,
          view_level: int | None = None, out: Sequence[str] | None = None,
          kept_only: bool = False) -> DataFrame:
    """Number the rows of each series by ``order`` and score them.

    y: the metric column, or ``{tag: column}`` to thin several metrics of the
       same rows at once (output has one row per row and tag, tag in
       ``category``).
    split: "auto" routes series longer than ``cfg.max_series_rows`` to the
       split path; one aggregate over the key columns decides it.  "never"
       skips that aggregate; "always" forces the split path.
    pairs: with several metrics, an optional bounded table of (keys, tag)
       pairs to thin; others are left out of the result.
    view_level: also return, for middle rows, the step-by-step columns at
       that level (x, y, neighbours, kept, prev/next anchors, yhat).
    out: which of ``SCORE_COLUMNS`` to return (default all); what is not
       asked for is not sent back from the tasks that scan the rows.
    kept_only: only kept rows.
    """
    keys = list(keys)
    out = list(SCORE_COLUMNS if out is None else out) + (["level_fits"] if detail else [])
    cold_path = lambda d: _score_cold(d, keys, order, y, cfg, out, kept_only, row_num, size,
                                      category, pairs, view_level)
    if split == "never":
        return cold_path(df)
    found = _hot_series(df, keys, cfg, size, split)
    if found is None:
        return cold_path(df)
    hot, n_hot, hot_rows = found
    hot_keys, small = hot.select(*keys), n_hot <= BROADCAST_KEY_LIMIT
    cold_scored = cold_path(join_same(df, hot_keys, keys, "left_anti", small))
    warm = join_same(df, hot_keys, keys, "left_semi", small)
    warm_scored = _score_hot(warm, keys, order, y, cfg, n_hot, hot_rows, detail, row_num, size,
                             category, pairs, view_level)
    if kept_only:
        warm_scored = warm_scored.filter(F.col("keep"))
    return cold_scored.unionByName(warm_scored.select(*cold_scored.columns))


def _hot_series(df: DataFrame, keys: list[str], cfg: ThinConfig, size: str, split: str):
    """(series for the split path with their sizes, how many, their rows), or None."""
    sizes = series_sizes(df, keys, size)
    hot = sizes if split == "always" else sizes.filter(F.col(size) > F.lit(cfg.max_series_rows))
    with swept(df.sparkSession):
        stats = hot.agg(F.count(F.lit(1)).alias("k"), F.sum(size).alias("rows")).first()
    if not stats["k"]:
        return None
    checkpoint_dir(df.sparkSession)
    # few rows, read by several plans
    return hot.checkpoint(eager=True), int(stats["k"]), int(stats["rows"])


def mark(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
         metrics: Mapping[str, str | Column], cfg: ThinConfig, carry: Sequence[str],
         split: str = "auto") -> DataFrame:
    """``carry``, ``row_num``, ``n`` and the bit masks ``kept`` and ``failed`` (over the metrics, in
    their order) of each row that a metric keeps, or whose series fails one."""
    from .scan import mark_series

    keys, carry = list(keys), list(carry)
    cold = lambda d: mark_series(d, keys, order, metrics, cfg, carry)
    found = None if split == "never" else _hot_series(df, keys, cfg, "n", split)
    if found is None:
        return cold(df)
    hot, n_hot, hot_rows = found
    hot_keys, small = hot.select(*keys), n_hot <= BROADCAST_KEY_LIMIT
    warm = join_same(df, hot_keys, keys, "left_semi", small)
    scored = _score_hot(warm, keys, order, metrics, cfg, n_hot, hot_rows)
    bit = F.expr("CASE zip_category " + " ".join(
        f"WHEN '{tag}' THEN {1 << i}" for i, tag in enumerate(metrics)) + " END")
    mask = lambda c: F.coalesce(F.bit_or(F.when(F.col(c), bit)), F.lit(0)).cast("int")
    marks = (scored.groupBy(*carry, "row_num", "n").agg(mask("keep").alias("kept"), mask("failed").alias("failed"))
                   .filter((F.col("kept") != 0) | (F.col("failed") != 0)))
    rest = cold(join_same(df, hot_keys, keys, "left_anti", small))
    return rest.unionByName(marks.select(*rest.columns))


def thin(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], y: str,
         cfg: ThinConfig, split: str = "auto") -> DataFrame:
    """Kept rows of ``df`` (its own columns plus ``row_num``)."""
    cols = df.columns
    s = score(df, keys, order, y, cfg, split=split, out=[], kept_only=True)
    return s.select(*cols, "row_num")


def level_view(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], y: str,
               cfg: ThinConfig, level: int, split: str = "auto") -> DataFrame:
    """Middle rows of long series with the step-by-step columns at one fixed
    level: ``x``, ``y``, neighbours (``x_prev`` .. ``y_next``, interior
    points), ``sig``, ``rnk``, ``entry``, ``kept``, anchors ``prev``/``next``
    (structs of x, y; ``prev`` is (0, 0) in "origin" mode when missing) and
    ``yhat``.  Same routing as :func:`score`, so long series are safe.
    """
    clash = {"x", "y", "x_prev", "y_prev", "x_next", "y_next", "kept", "prev", "next",
             "yhat"} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"input columns clash with view columns: {clash}")
    s = score(df, keys, order, y, cfg, split=split, view_level=level)
    return s.filter(F.col("region") == "middle")
