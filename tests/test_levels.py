"""The level scan against a plain loop over levels."""

from __future__ import annotations

import math

import numpy as np
import pytest

from curvethin.config import ThinConfig
from curvethin.functions import levels as L
from curvethin.operators.scan import Thinned


def brute(y, cfg):
    """(entry levels, fits by level) of one series' middle."""
    mid = list(y[cfg.pre:len(y) - cfg.post])
    n, levels = len(mid), cfg.levels()
    x = [float(cfg.pre + 1 + i) for i in range(n)]
    sig = {i: abs(2.0 * (mid[i] - mid[i - 1]) + (mid[i - 1] - mid[i + 1]) * 1.0) for i in range(1, n - 1)}
    ranked = sorted(sig, key=lambda i: (-sig[i], i))
    entry = [0] * n
    for r, i in enumerate(ranked, 1):
        entry[i] = next(k for k, p in enumerate(levels, 1) if r <= math.floor((n - 2) * p))
    mean = math.fsum(mid) / n
    sst = 0.0 if min(mid) == max(mid) else math.fsum((v - mean) ** 2 for v in mid)
    fits = []
    for k in range(1, len(levels) + 1):
        kept = [i for i in range(n) if entry[i] <= k]
        e = []
        for a, b in zip(kept, kept[1:]):
            px, py = (0.0, 0.0) if a == 0 and cfg.leading_anchor == "origin" else (x[a], mid[a])
            for i in range(a + 1, b):
                dy, dx = mid[b] - py, x[b] - px
                yhat = mid[b] if dy == 0 or dx == 0 else dy / dx * x[i] + (mid[b] - dy / dx * x[b])
                e.append((yhat - mid[i]) ** 2)
        sse = math.fsum(e)
        fits.append(1.0 if sse == 0 or sst == 0 else 1 - math.sqrt(sse / sst))
    return entry, fits


def curves(seed, count):
    rng = np.random.default_rng(seed)
    out = [np.full(60, 5.0), np.arange(60.0), np.full(60, 0.1), np.full(21, 3.0), np.arange(22.0) % 3, np.zeros(70)]
    for _ in range(count):
        n = int(rng.integers(52, 200))
        kind = rng.integers(4)
        y = rng.normal(size=n) * 10.0 ** (rng.integers(-2, 3) if kind == 1 else rng.integers(-30, 30)) + (kind == 1) * rng.normal() * 1e4
        out.append(np.round(y, 1) if kind == 2 else np.cumsum(y) if kind == 3 else y)
    return out


def thinned(ys, cfg, detail=True):
    n = np.array([len(y) for y in ys])
    return Thinned(np.concatenate(ys), np.cumsum(n) - n, n, cfg, detail)


@pytest.mark.parametrize("cfg", [
    ThinConfig(threshold=20, target=0.6), ThinConfig(threshold=20, target=0.6, leading_anchor="first"),
    ThinConfig(threshold=20, target=1.0, start=0.01, step=0.01), ThinConfig(threshold=0, pre=0, post=0, target=0.9, start=0.0, step=0.3),
    ThinConfig(threshold=20, target=0.8, start=0.001, step=0.001),
])
def test_levels(cfg):
    ys = curves(1, 25 if len(cfg.levels()) < 500 else 6)
    t = thinned(ys, cfg)
    assert not t.failed.any()
    at = 0
    for i, y in enumerate(ys):
        if not t.long[i]:
            continue
        entry, fits = brute(y, cfg)
        m = len(entry)
        assert t.entry[at:at + m].tolist() == entry
        at += m
        np.testing.assert_allclose(t.fits[i], fits, rtol=1e-6, atol=1e-7)
        chosen = next(k for k, f in enumerate(t.fits[i], 1) if f >= cfg.target)
        assert t.level[i] == chosen and t.fit[i] == t.fits[i][chosen - 1]


def test_sums_do_not_depend_on_order_or_company():
    """Bit-equal fits for a curve alone, among others, and shifted among them."""
    ys, cfg = curves(2, 30), ThinConfig(threshold=20, target=0.7)
    together, back = thinned(ys, cfg), thinned(ys[::-1], cfg)
    assert np.array_equal(together.fits, back.fits[::-1], equal_nan=True)
    for i, y in enumerate(ys):
        assert np.array_equal(thinned([y], cfg).fits, together.fits[i:i + 1], equal_nan=True)


def test_pieces_hold_a_sum_in_any_order():
    rng = np.random.default_rng(3)
    e = np.abs(rng.normal(size=5000)) * 2.0 ** rng.integers(-60, 1, 5000)
    b = L.bits(np.array(len(e)))
    sums = [[p[order].sum() for p in L.pieces(e, b)] for order in (np.arange(5000), rng.permutation(5000))]
    assert sums[0] == sums[1]
    assert L.value([np.array(s) for s in sums[0]], b) == pytest.approx(math.fsum(e), rel=1e-15)


def test_work_hardly_grows_with_levels(monkeypatch):
    """Points interpolated grow with the logarithm of the number of levels, up to that of the points."""
    rng = np.random.default_rng(4)
    ys = [np.cumsum(rng.normal(size=400)) for _ in range(100)]
    work, errors = {}, L.gap_errors

    def counted(x, y, left, right, rows_at, *rest):
        work[n] = work.get(n, 0) + len(rows_at)
        return errors(x, y, left, right, rows_at, *rest)

    monkeypatch.setattr(L, "gap_errors", counted)
    for n in (10, 100, 1000):
        thinned(ys, ThinConfig(target=1.0, start=1 / n, step=1 / n), False)
    assert work[100] < 3 * work[10] and work[1000] < 1.6 * work[100], work
