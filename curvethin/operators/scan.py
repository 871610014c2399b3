"""Thinning of whole series in one pass over sorted rows.

Rows are dealt by series and sorted (of the narrow columns only; no exchange where they already lie by some of the keys); each task then streams its
series through :mod:`curvethin.functions.levels`, some thousands of rows at a time and never less than a whole series. A series
longer than ``cfg.max_series_rows`` does not come here (see :mod:`curvethin.operators.split`), so a task's memory is bounded.
Numbering, regions, significance, rank, entry level, fits and the choice of the level all happen there, for all
metrics of a row at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ThinConfig
from ..functions import exprs as X
from ..functions import levels as L

ROWS = 1 << 17  # rows scanned at once, if the series are short

# What a scan can return besides the rows' own columns.
TYPES = {"region": pa.string(), "n_mid": pa.int64(), "mpos": pa.int64(), "sig": pa.float64(), "rnk": pa.int64(), "entry": pa.int32(),
         "failed": pa.bool_(), "level": pa.int32(), "fit": pa.float64(), "keep": pa.bool_(), "level_fits": pa.list_(pa.float64())}
SQL = {"region": "string", "n_mid": "bigint", "mpos": "bigint", "sig": "double", "rnk": "bigint", "entry": "int", "failed": "boolean",
       "level": "int", "fit": "double", "keep": "boolean", "level_fits": "array<double>"}


def _changes(now: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before; null equals null, NaN equals NaN."""
    a, b = now[1:], now[:-1]
    differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    differ = differ | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))
    if pa.types.is_floating(now.type):
        nan = lambda v: pc.fill_null(pc.is_nan(v), False).to_numpy(zero_copy_only=False)
        differ = differ & ~(nan(a) & nan(b))
    return differ


def _begins(keys: list[pa.Array]) -> np.ndarray:
    """Whether a row begins a series; the first one does."""
    out = np.zeros(len(keys[0]), bool)
    out[0] = True
    for k in keys:
        out[1:] |= _changes(k)
    return out


def whole_series(batches: Iterator[pa.RecordBatch], n_keys: int, rows: int = ROWS) -> Iterator[pa.Table]:
    """Runs of whole series (the first ``n_keys`` columns) of about ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    count, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i) for i in range(n_keys)]
        if last is not None:
            keys = [pa.concat_arrays([a, k]) for a, k in zip(last, keys)]
        new = _begins(keys)[0 if last is None else 1:]
        new[0] &= last is not None
        last = [batch.column(i).slice(batch.num_rows - 1) for i in range(n_keys)]
        cut = np.flatnonzero(new)
        if len(cut) and count + cut[-1] >= rows:
            cut = int(cut[-1])
            if cut:
                held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held, count, batch = [], 0, batch.slice(cut)
        held.append(batch)
        count += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


class Thinned:
    """The scan of one metric over some whole series (rows from ``start``, ``n`` of them)."""

    def __init__(self, y: np.ndarray, start: np.ndarray, n: np.ndarray, cfg: ThinConfig, detail: bool):
        levels = np.array(cfg.levels())
        n_mid = n - cfg.pre - cfg.post
        long = (n > cfg.threshold) & (n_mid > 0)
        first, size = start + cfg.pre, np.where(long, n_mid, 0)
        middle = L.ranges(first, size)
        bad = np.zeros(len(y), np.int64)
        bad[middle] = ~np.isfinite(y[middle])
        self.failed = np.add.reduceat(bad, start) > 0 if len(start) else np.zeros(0, bool)
        done = long & ~self.failed
        at, size = first[done], n_mid[done]
        rows = L.ranges(at, size)
        off = np.concatenate([[0], np.cumsum(size)])
        which = np.repeat(np.arange(len(at)), size)
        place = np.arange(len(rows)) - off[which]
        x, v = (cfg.pre + 1 + place).astype(float), y[rows]
        inner = (place > 0) & (place < size[which] - 1)
        i = np.flatnonzero(inner)
        sig = L.significance(x[i], v[i], v[i - 1], v[i + 1])
        by = np.argsort(np.where(np.isnan(sig), -np.inf, -sig), kind="stable")
        by = by[np.argsort(which[i][by], kind="stable")]
        rank = np.empty(len(i), np.int64)
        rank[by] = np.arange(len(i)) - (np.cumsum(np.maximum(size - 2, 0)) - np.maximum(size - 2, 0))[which[i]] + 1
        entry = np.zeros(len(rows), np.int64)
        entry[i] = L.entries(rank, np.maximum(size - 2, 0), which[i], levels)
        self.level, self.fit = np.zeros(len(n), np.int64), np.full(len(n), np.nan)
        self.fits = None
        if len(rows):
            found = L.scan(x, v, off, entry, len(levels), cfg.target, cfg.leading_anchor == "origin", detail)
            self.level[done], self.fit[done] = found.level, found.fit
            if detail:
                self.fits = np.full((len(n), len(levels)), np.nan)
                self.fits[done] = found.fits
        self.long, self.done, self.n_mid, self.cfg = long, done, n_mid, cfg
        self.rows, self.inner, self.sig, self.rank, self.entry = rows, rows[i], sig, rank, entry
        self.own = np.repeat(np.arange(len(n)), n)
        keep = ~self.failed[self.own]
        keep[rows] = entry <= found.level[which] if len(rows) else False
        self.keep = keep

    def column(self, name: str, number: np.ndarray, n: np.ndarray, rows: np.ndarray) -> pa.Array:
        """One of ``TYPES`` for the chosen rows."""
        own, cfg, out = self.own[rows], self.cfg, None
        none = np.zeros(len(rows), bool)
        in_middle = self.long[own] & (number[rows] > cfg.pre) & (number[rows] <= n[own] - cfg.post)
        if name == "region":
            names = np.array(["pass", "all", "head", "tail", "middle"], object)
            head = number[rows] <= cfg.pre
            out = names[np.where(n[own] <= cfg.threshold, 0, np.where(~self.long[own], 1, np.where(in_middle, 4, np.where(head, 2, 3))))]
        elif name == "n_mid":
            out, none = self.n_mid[own], ~in_middle
        elif name == "mpos":
            out, none = number[rows] - cfg.pre, ~in_middle
        elif name in ("sig", "rnk", "entry"):
            spots, found = (self.rows, self.entry) if name == "entry" else (self.inner, self.sig if name == "sig" else self.rank)
            wide, has = np.zeros(len(self.own), found.dtype), np.zeros(len(self.own), bool)
            wide[spots], has[spots] = found, True
            out, none = wide[rows], ~has[rows]
        elif name == "failed":
            out = self.failed[own]
        elif name == "keep":
            out = self.keep[rows]
        elif name in ("level", "fit"):
            out, none = (self.level if name == "level" else self.fit)[own], ~self.done[own]
        elif name == "level_fits":
            kinds = [None if self.fits is None or not d else f for d, f in zip(self.done, self.fits if self.fits is not None else self.done)]
            lists = pa.array(kinds, TYPES[name])
            return lists.take(pa.array(own))
        return pa.array(out, TYPES[name], mask=none) if none.any() else pa.array(out, TYPES[name])


def _thinned(batches: Iterator[pa.RecordBatch], n_keys: int, n_metrics: int, cfg: ThinConfig, detail: bool):
    """(rows of whole series, their numbers, the series' sizes, the scan of each metric); see :func:`_sorted` for the columns."""
    for table in whole_series(batches, n_keys):
        part = table.combine_chunks().to_batches()[0]
        start = np.flatnonzero(_begins([part.column(i) for i in range(n_keys)]))
        n = np.diff(np.append(start, part.num_rows))
        values = [pc.fill_null(part.column(n_keys + i), float("nan")).to_numpy(zero_copy_only=False) for i in range(n_metrics)]
        number = part.column(part.num_columns - 1).to_numpy(zero_copy_only=False)
        yield part, number, n, (Thinned(y, start, n, cfg, detail) for y in values)


def _sorted(df: DataFrame, keys: list[str], order: Sequence[str | Column], metrics: Mapping[str, str | Column], carry: list[str]) -> DataFrame:
    """Keys, metrics (as doubles), ``carry`` and the number in its series of each row, dealt by series and sorted. A window asks for that, so
    rows that already lie by some of the keys are not exchanged again; nothing else of ``df`` is exchanged."""
    own = "_"  # begins the names that are made here
    while any(c.startswith(own) for c in carry):
        own += "_"
    cols = [F.col(c).alias(f"{own}key{i}") for i, c in enumerate(keys)]
    cols += [X.col(c).try_cast("double").alias(f"{own}metric{i}") for i, c in enumerate(metrics.values())]
    by = {c if isinstance(c, str) and c in carry else f"{own}order{i}": c for i, c in enumerate(order)}
    more = [name for name in by if name not in carry]
    d = df.select(*cols, *carry, *[X.col(by[name]).alias(name) for name in more])
    w = Window.partitionBy(*[f"{own}key{i}" for i in range(len(keys))]).orderBy(*[X.q(name) for name in by])
    return d.withColumn(f"{own}number", F.row_number().over(w).cast("bigint")).drop(*more)


def mark_series(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], metrics: Mapping[str, str | Column], cfg: ThinConfig,
                carry: Sequence[str], row_num: str = "row_num", size: str = "n") -> DataFrame:
    """One row for each row that a metric keeps or whose series fails one: ``carry``, ``row_num``, ``size`` and bit masks over the
    metrics in their order, ``kept`` and ``failed``."""
    keys, carry = list(keys), list(carry)
    n_keys, n_metrics = len(keys), len(metrics)
    fields = [f"{X.q(f.name)} {f.dataType.simpleString()}" for f in df.select(*carry).schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, number, n, thinned in _thinned(batches, n_keys, n_metrics, cfg, False):
            kept, failed = np.zeros(len(number), np.int32), np.zeros(len(number), np.int32)
            for i, t in enumerate(thinned):
                kept |= t.keep.astype(np.int32) << i
                failed |= t.failed[t.own].astype(np.int32) << i
            rows = np.flatnonzero(kept | failed)
            base = part.take(pa.array(rows))
            made = [base.column(n_keys + n_metrics + k) for k in range(len(carry))]
            made += [pa.array(x[rows]) for x in (number, np.repeat(n, n), kept, failed)]
            yield pa.RecordBatch.from_arrays(made, [*carry, row_num, size, "kept", "failed"])

    d = _sorted(df, keys, order, metrics, carry)
    return d.mapInArrow(run, ", ".join([*fields, f"{X.q(row_num)} bigint", f"{X.q(size)} bigint", "kept int", "failed int"]))


def scan_series(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], y: str | Mapping[str, str | Column], cfg: ThinConfig,
                out: Sequence[str], carry: Sequence[str] | None = None, kept_only: bool = False, row_num: str = "row_num", size: str = "n",
                category: str = "zip_category", value: str = "y") -> DataFrame:
    """The rows of ``df`` (its columns ``carry``) with ``row_num``, ``size`` and the columns ``out`` of the scan.

    With a mapping of metrics each row comes once for each tag, with the tag in ``category`` and the metric in ``value`` if listed in ``out``;
    ``kept_only`` leaves out what is not kept.
    """
    keys, many = list(keys), not isinstance(y, str)
    metrics = dict(y) if many else {"": y}
    carry = list(df.columns if carry is None else carry)
    d = _sorted(df, keys, order, metrics, carry)
    fields = [f"{X.q(f.name)} {f.dataType.simpleString()}" for f in df.select(*carry).schema.fields]
    extra = [row_num, size, *([category] if many else []), *out]
    clash = {c.lower() for c in carry} & {c.lower() for c in extra}
    if clash:
        raise ValueError(f"input columns clash with the scan's: {sorted(clash)}")
    kinds = {row_num: "bigint", size: "bigint", category: "string", value: "double"} | SQL
    fields += [f"{X.q(c)} {kinds[c]}" for c in extra]
    tags, n_keys, detail = list(metrics), len(keys), "level_fits" in out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, number, n, thinned in _thinned(batches, n_keys, len(tags), cfg, detail):
            for i, (tag, t) in enumerate(zip(tags, thinned)):
                rows = np.flatnonzero(t.keep) if kept_only else np.arange(part.num_rows)
                base = part.take(pa.array(rows)) if kept_only else part
                made = [base.column(n_keys + len(tags) + k) for k in range(len(carry))]
                made += [pa.array(number[rows]), pa.array(n[t.own[rows]])]
                if many:
                    made.append(pa.array([tag], pa.string()).take(pa.array(np.zeros(len(rows), np.int64))))
                made += [base.column(n_keys + i) if c == value and c not in TYPES else t.column(c, number, n, rows) for c in out]
                yield pa.RecordBatch.from_arrays(made, [*carry, *extra])

    return d.mapInArrow(run, ", ".join(fields))

