"""Hand-worked thinning results (middle list = rows after 10 head rows)."""

import pytest

from curvethin.config import ThinConfig
from curvethin.operators.thin import thin

from helpers import kept, series_df

HEAD = [0.0] * 10


def _cfg(**kw):
    base = dict(threshold=5, pre=10, post=0, target=0.99)
    base.update(kw)
    return ThinConfig(**base)


def _mid_kept(spark, ys, cfg, split="never"):
    df = series_df(spark, {"g": HEAD + ys})
    return [rn for _, rn in kept(thin(df, ["key"], ["seq"], "y", cfg, split=split)) if rn > 10]


G1 = [0, 0, 10, 0, 0, 0]
G2 = [100 + x for x in range(11, 22)]
G3 = [5.0] * 11


@pytest.mark.parametrize("split", ["never", "always"])
@pytest.mark.parametrize("ys,kw,expect", [
    (G1, dict(), [11, 12, 13, 14, 16]),
    (G1, dict(leading_anchor="first"), [11, 12, 13, 14, 16]),
    (G1, dict(target=0.01), [11, 12, 13, 16]),
    (G1, dict(target=0.01, leading_anchor="first"), [11, 13, 16]),
    (G2, dict(), [11, 12, 21]),
    (G2, dict(leading_anchor="first"), [11, 21]),
    (G3, dict(), [11, 21]),
    (G3, dict(leading_anchor="first"), [11, 21]),
])
def test_golden(spark, ys, kw, expect, split):
    cfg = _cfg(**kw)
    if split == "always":
        cfg = cfg.with_(block_rows=4)
    assert _mid_kept(spark, ys, cfg, split) == expect


def test_g4_constant_51_rows(spark):
    df = series_df(spark, {"g": [5.0] * 51})
    got = [rn for _, rn in kept(thin(df, ["key"], ["seq"], "y", ThinConfig(), split="never"))]
    assert got == list(range(1, 14)) + list(range(41, 52))


def test_g5_passthrough_50_rows(spark):
    df = series_df(spark, {"g": [float(i % 7) for i in range(50)]})
    got = kept(thin(df, ["key"], ["seq"], "y", ThinConfig(), split="never"))
    assert len(got) == 50


def test_levels_are_repeated_sums():
    lv = ThinConfig().levels()
    assert lv[2] == 0.30000000000000004
    assert lv[7] == 0.7999999999999999
    assert len(lv) == 11 and lv[-1] >= 1.0 and lv[-2] < 1.0


@pytest.mark.parametrize("kw", [dict(step=0), dict(target=1.5), dict(start=-0.1),
                                dict(leading_anchor="x"), dict(target=float("nan"))])
def test_bad_parameters(kw):
    with pytest.raises(ValueError):
        ThinConfig(**kw)
