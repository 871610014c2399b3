"""The level scan of many curves at once, as array operations (numpy), for any number of levels.

A point kept from level ``entry`` on splits the gap between its kept neighbours. Going down from the last level, where all points
are kept, each level removes the points that enter right above it: only the gaps around those are interpolated anew, and
a curve's squared error changes by the new gaps' errors less the old ones'. A point lies in few distinct gaps (about
twice the logarithm of the number of levels), so the time hardly depends on how many levels there are.

Sums do not depend on their order: a curve is scaled by a power of two so that all its values lie below 1, and each term
is cut into three integers (``pieces``) whose sums are exact. So a fit is the same bit for bit however rows are partitioned,
and whether a curve is scanned whole or in blocks.

Rounding agrees with the same formulas as SQL expressions on doubles, as every operation is a single IEEE one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# |value| < 1 after scaling, so |difference| < 2 and a square is below 2**BITS_ABOVE with room for rounding
BITS_ABOVE = 3


def bits(n: np.ndarray) -> np.ndarray:
    """Bits that the sum of n terms needs above those of a term."""
    return np.ceil(np.log2(np.maximum(n, 1) + 1.0)).astype(np.int64)


def pieces(term: np.ndarray, b: np.ndarray | int) -> list[np.ndarray]:
    """Three integers that hold a term below 2**BITS_ABOVE; ``b`` as ``bits`` gives it, so that n of them add up without overflow."""
    first = np.ldexp(term, 61 - BITS_ABOVE - b)
    out = [np.floor(first)]
    rest = first - out[0]
    for _ in range(2):
        rest = np.ldexp(rest, 61 - b)
        out.append(np.floor(rest))
        rest = rest - out[-1]
    return [p.astype(np.int64) for p in out]


def value(sums: list[np.ndarray], b: np.ndarray) -> np.ndarray:
    """The double of three sums of pieces."""
    low = np.ldexp(sums[2].astype(float), b - 61)
    low = np.ldexp(sums[1].astype(float) + low, b - 61)
    return np.ldexp(sums[0].astype(float) + low, b + BITS_ABOVE - 61)


def exponent(largest: np.ndarray) -> np.ndarray:
    """k with |value| * 2**-k < 1."""
    return np.frexp(largest)[1].astype(np.int64)


def fit(sse: np.ndarray, sst: np.ndarray) -> np.ndarray:
    """1 - sqrt(SSE / SST), 1 when either is 0."""
    none = (sse == 0) | (sst == 0)
    return np.where(none, 1.0, 1.0 - np.sqrt(sse / np.where(none, 1.0, sst)))


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def entries(rank: np.ndarray, m: np.ndarray, which: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """First level whose share of curve ``which``'s ``m`` interior points, floor(m * level), reaches the rank."""
    kinds, kind = np.unique(m, return_inverse=True)
    top = np.int64(max(kinds.max(initial=0), rank.max(initial=0)) + 2)
    cuts = np.minimum(np.floor(kinds[:, None].astype(float) * levels[None, :]), float(top - 1)).astype(np.int64)
    cuts = np.maximum.accumulate(cuts, axis=1) + np.arange(len(kinds))[:, None] * top
    row_kind = kind[which]
    return (np.searchsorted(cuts.ravel(), row_kind * top + rank) - row_kind * len(levels) + 1).astype(np.int64)


def significance(x: np.ndarray, y: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Twice the area of the triangle with the neighbours at x - 1 and x + 1."""
    with np.errstate(all="ignore"):
        return np.abs(((x + 1) - (x - 1)) * (y - before) + (before - after) * (x - (x - 1)))


@dataclass
class Scan:
    """What ``scan`` finds of each curve: the first level that reaches the target and its fit; with ``detail`` all fits."""

    level: np.ndarray
    fit: np.ndarray
    fits: np.ndarray | None


def deviations(y: np.ndarray, off: np.ndarray, b: np.ndarray) -> np.ndarray:
    """SST of each curve of scaled values: squared distances from the mean, both summed exactly."""
    at = off[:-1]
    n = np.diff(off)
    own = np.repeat(np.arange(len(n)), n)
    mean = value([np.add.reduceat(p, at) for p in pieces(y, b[own])], b) / n
    d = y - mean[own]
    sst = value([np.add.reduceat(p, at) for p in pieces(d * d, b[own])], b)
    return np.where(np.maximum.reduceat(y, at) == np.minimum.reduceat(y, at), 0.0, sst)


def last_kept(entry: np.ndarray) -> np.ndarray:
    """Places of the points that are, at some level, the last one kept: entered before all that follow."""
    later = np.minimum.accumulate(entry[::-1])[::-1]
    return np.flatnonzero(entry < np.append(later[1:], np.iinfo(np.int64).max))


def first_kept(entry: np.ndarray) -> np.ndarray:
    """Places of the points that are, at some level, the first one kept."""
    return len(entry) - 1 - last_kept(entry[::-1])[::-1]


def gap_errors(x, y, left, right, rows_at, size, px, py) -> np.ndarray:
    """Squared errors of the rows in the gaps: ``size`` rows each, at ``rows_at``, between the points (px, py) and ``right``."""
    nx, ny = x[right], y[right]
    dy, dx = ny - py, nx - px
    with np.errstate(all="ignore"):
        slope = dy / dx
        rest = ny - slope * nx
    gap = np.repeat(np.arange(len(left)), size)
    flat = ((dy == 0) | (dx == 0))[gap]
    with np.errstate(all="ignore"):
        line = slope[gap] * x[rows_at] + rest[gap]
    e = np.where(flat, ny[gap], line) - y[rows_at]
    return e * e


def errors_by_level(x: np.ndarray, y: np.ndarray, off: np.ndarray, entry: np.ndarray, b: np.ndarray, n_levels: int,
                    origin: np.ndarray, real: np.ndarray | None = None):
    """Yields (level, [three sums of pieces of each curve's squared errors]) from the last level down to 1.

    ``off``: where each curve begins; its first and last point are kept at all levels (entry 0). ``origin``: places that,
    as the left end of a gap, stand for the point (0, 0). ``real``: points that count (others are only ends of gaps).
    """
    n = len(x)
    curve = np.repeat(np.arange(len(off) - 1), np.diff(off))
    order = np.argsort(entry, kind="stable")
    by = np.searchsorted(entry[order], np.arange(n_levels + 2))
    total = [np.zeros(len(off) - 1, np.int64) for _ in range(3)]
    of_gap = [np.zeros(n, np.int64) for _ in range(3)]  # sums of the gap that begins at a place
    px, py = np.where(origin, 0.0, x), np.where(origin, 0.0, y)
    alive = np.ones(n, bool)
    kept = np.arange(n)
    yield n_levels, total
    for level in range(n_levels - 1, 0, -1):
        gone = order[by[level + 1]:by[level + 2]]
        if len(gone):
            alive[gone] = False
            kept = kept[alive[kept]]
            after = np.searchsorted(kept, gone)
            first = np.flatnonzero(np.diff(after, prepend=-1))  # gone is in order, so equal gaps are next to each other
            left, right = kept[after[first] - 1], kept[after[first]]
            size = right - left - 1
            rows = ranges(left + 1, size)
            e = gap_errors(x, y, left, right, rows, size, px[left], py[left])
            if real is not None:
                e = np.where(real[rows], e, 0.0)
            at = np.cumsum(size) - size
            for t, g, p in zip(total, of_gap, pieces(e, b[curve[rows]])):
                np.subtract.at(t, curve[gone], g[gone])
                new = np.add.reduceat(p, at)
                np.add.at(t, curve[left], new - g[left])
                g[left] = new
        yield level, total


def scan(x: np.ndarray, y: np.ndarray, off: np.ndarray, entry: np.ndarray, n_levels: int, target: float, from_origin: bool,
         detail: bool = False) -> Scan:
    """Chooses each curve's level. ``y``: values of whole curves, finite; ``off``: where each begins, and the end."""
    n = np.diff(off)
    b = bits(n)
    k = exponent(np.maximum.reduceat(np.abs(y), off[:-1]))
    y = np.ldexp(y, -np.repeat(k, n))
    sst = deviations(y, off, b)
    origin = np.zeros(len(y), bool)
    origin[off[:-1]] = from_origin
    level, best = np.full(len(n), n_levels, np.int64), np.ones(len(n))
    fits = np.ones((len(n), n_levels)) if detail else None
    for at, sums in errors_by_level(x, y, off, entry, b, n_levels, origin):
        now = fit(value(sums, b), sst)
        reached = now >= target
        level[reached], best[reached] = at, now[reached]
        if detail:
            fits[:, at - 1] = now
    return Scan(level, best, fits)
