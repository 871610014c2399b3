"""Series-level operators: numbering, sizes, head / tail / middle, routing.

A series is the set of rows sharing the key columns; it is never materialised
as a list.  Everything is a window over ``partitionBy(keys)`` (one exchange on
the keys, shared by all windows that follow) or a partial aggregate.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ThinConfig
from ..session import checkpoint_dir, swept


def _order_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
              small: bool = False) -> DataFrame:
    """Join on equal keys where null equals null; the keys appear once, from ``left``.

    ``small``: broadcast ``right`` (the caller has proven its size).
    """
    r = right.select(*[F.col(k).alias(f"_same{i}") for i, k in enumerate(keys)],
                     *[c for c in right.columns if c not in set(keys)])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_same{i}"))
                                     for i, k in enumerate(keys)])
    out = left.join(F.broadcast(r) if small else r, on, how)
    return out.drop(*[f"_same{i}" for i in range(len(keys))])


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                out: str = "row_num", size: str | None = "n", split: str = "never",
                max_group_rows: int = 2_000_000) -> DataFrame:
    """``row_number()`` per series in ``order`` (make it total: add a unique
    tie-break column) and, optionally, the series size.

    split="auto" first counts rows per key (a partial aggregate) and numbers
    groups above ``max_group_rows`` by a range-partitioned sort instead of a
    window, so no group has to fit in one task.
    """
    if split == "auto":
        return _number_rows_routed(df, list(keys), order, out, size, max_group_rows)
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    df = df.withColumn(out, F.row_number().over(w).cast("bigint"))
    if size:
        df = df.withColumn(size, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    return df


def series_sizes(df: DataFrame, keys: Sequence[str], size: str = "n") -> DataFrame:
    """Rows per series; a partial (map-side) aggregate, safe for hot keys."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(size))


def with_regions(df: DataFrame, cfg: ThinConfig, row_num: str = "row_num",
                 size: str = "n") -> DataFrame:
    """Add the region of each row and its place in the middle list.

    region   'pass' (series of at most ``threshold`` rows), 'head' (first
             ``pre``), 'tail' (last ``post``), 'middle' (the rest), or 'all'
             when a long series has no middle (pre + post >= n): kept whole.
    mpos     1-based position inside the middle list
    n_mid    size of the middle list
    """
    rn, n = _q(row_num), _q(size)
    n_mid = f"({n} - {cfg.pre} - {cfg.post})"
    region = (f"CASE WHEN {n} <= {cfg.threshold} THEN 'pass' WHEN {n_mid} <= 0 THEN 'all' "
              f"WHEN {rn} <= {cfg.pre} THEN 'head' WHEN {rn} > {n} - {cfg.post} THEN 'tail' "
              f"ELSE 'middle' END")
    middle = f"(({region}) = 'middle')"
    # one projection (each select re-analyses the plan)
    return df.select("*", F.expr(region).alias("region"),
                     F.expr(f"CASE WHEN {middle} THEN {n_mid} END").alias("n_mid"),
                     F.expr(f"CASE WHEN {middle} THEN {rn} - {cfg.pre} END").alias("mpos"))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def head_rows(df: DataFrame, cfg: ThinConfig) -> DataFrame:
    return with_regions(df, cfg).filter(F.col("region") == "head")


def tail_rows(df: DataFrame, cfg: ThinConfig) -> DataFrame:
    return with_regions(df, cfg).filter(F.col("region") == "tail")


def middle_rows(df: DataFrame, cfg: ThinConfig) -> DataFrame:
    return with_regions(df, cfg).filter(F.col("region") == "middle")


def passthrough_rows(df: DataFrame, cfg: ThinConfig, size: str = "n") -> DataFrame:
    return df.filter(F.col(size) <= F.lit(cfg.threshold))


def thinnable_rows(df: DataFrame, cfg: ThinConfig, size: str = "n") -> DataFrame:
    return df.filter(F.col(size) > F.lit(cfg.threshold))


def _number_rows_routed(df: DataFrame, keys: list[str], order, out: str, size: str | None,
                        max_rows: int) -> DataFrame:
    from .split import SIDE_BROADCAST_ROWS, global_positions  # split imports series

    sizes = series_sizes(df, keys, "_n")
    hot = sizes.filter(F.col("_n") > F.lit(max_rows))
    with swept(df.sparkSession):
        stats = hot.agg(F.count(F.lit(1)).alias("k"), F.sum("_n").alias("rows")).first()
    if int(stats["k"]) == 0:
        return number_rows(df, keys, order, out, size)
    checkpoint_dir(df.sparkSession)
    hot = hot.checkpoint(eager=True)  # few rows, read by two joins
    k, small = hot.select(*keys), int(stats["k"]) <= SIDE_BROADCAST_ROWS
    cold = number_rows(join_same(df, k, keys, "left_anti", small), keys, order, out, size)
    warm = global_positions(join_same(df, k, keys, "left_semi", small), keys, order, out,
                            int(stats["rows"]), max_rows, int(stats["k"]), size)
    return cold.unionByName(warm.select(*cold.columns))
