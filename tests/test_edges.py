"""Edge cases: bad values, short middles, constants, fan-out, blanks."""

import math

from pyspark.sql import functions as F

from curvethin.config import ThinConfig
from curvethin.operators.thin import score, thin
from curvethin.sources.io import normalize_blank

from helpers import series_df


def _scored(spark, series, cfg, split="never"):
    return score(series_df(spark, series), ["key"], ["seq"], "y", cfg, split=split)


def test_edge_cases_together(spark):
    cfg = ThinConfig(threshold=5, pre=2, post=2, target=0.99)
    n1 = [float(i % 3) for i in range(12)]
    n1[6] = None                      # null in the middle -> failed series
    n1b = [float(i % 3) for i in range(12)]
    n1b[0] = None                     # null in the head -> not a failure
    nan = [1.0, 2.0, 3.0, float("nan"), 5.0, 6.0, 7.0]
    series = {
        "n1": n1, "n1b": n1b, "nan": nan,
        "n2": [0.1] * 12,             # constant 0.1 -> SST = 0 -> first level
        "mid0": [1.0] * 6,            # n=6 > 5, pre+post=4 -> middle of 2
        "mid1": [1.0, 2.0, 9.0, 2.0, 1.0],  # n=5 -> pass-through
        "all": [3.0, 1.0, 4.0, 1.0, 5.0, 9.0],
    }
    s = {(r["key"], r["row_num"]): r for r in _scored(spark, series, cfg).collect()}
    assert all(s[("n1", i)]["failed"] and not s[("n1", i)]["keep"] for i in range(1, 13))
    assert not any(s[("n1b", i)]["failed"] for i in range(1, 13))
    assert all(s[("nan", i)]["failed"] for i in range(1, 8))
    assert s[("n2", 3)]["level"] == 1
    assert [s[("n2", i)]["keep"] for i in range(1, 13)] == \
        [True, True, True] + [False] * 6 + [True, True, True]
    assert all(s[("mid0", i)]["keep"] for i in range(1, 7))
    assert all(s[("mid1", i)]["keep"] and s[("mid1", i)]["region"] == "pass" for i in range(1, 6))


def test_no_middle_keeps_everything(spark):
    cfg = ThinConfig(threshold=3, pre=3, post=3)
    s = _scored(spark, {"k": [1.0, 5.0, 2.0, 8.0, 3.0]}, cfg).collect()
    assert all(r["keep"] and r["region"] == "all" for r in s)


def test_invariants_on_random_series(spark):
    import random
    rnd = random.Random(7)
    series = {f"s{i}": [rnd.uniform(-5, 5) for _ in range(rnd.randint(55, 90))] for i in range(12)}
    base = ThinConfig(target=0.3)
    df = series_df(spark, series)
    lo = {(r["key"], r["row_num"]) for r in thin(df, ["key"], ["seq"], "y", base,
                                                  split="never").collect()}
    hi = {(r["key"], r["row_num"]) for r in thin(df, ["key"], ["seq"], "y",
                                                  base.with_(target=0.6), split="never").collect()}
    assert lo <= hi                                   # more fit, more points
    for k, ys in series.items():
        n = len(ys)
        for rn in list(range(1, 11)) + list(range(n - 9, n + 1)) + [11, n - 10]:
            assert (k, rn) in lo                      # head, tail, middle ends
    # scaling y changes nothing
    scaled = series_df(spark, {k: [2 * v for v in ys] for k, ys in series.items()})
    lo2 = {(r["key"], r["row_num"]) for r in thin(scaled, ["key"], ["seq"], "y", base,
                                                   split="never").collect()}
    assert lo == lo2


def test_fit_reaches_target_and_level_below_misses(spark):
    import random
    rnd = random.Random(3)
    series = {f"s{i}": [rnd.uniform(0, 10) for _ in range(70)] for i in range(6)}
    cfg = ThinConfig(target=0.4)
    s = score(series_df(spark, series), ["key"], ["seq"], "y", cfg, detail=True, split="never")
    for r in s.filter(F.col("mpos") == 1).collect():
        fits, lvl = r["level_fits"], r["level"]
        assert fits[lvl - 1] >= 0.4 or math.isnan(fits[lvl - 1])
        assert all(f < 0.4 for f in fits[:lvl - 1])


def test_duplicate_handle_fan_out(spark):
    """Rebuilding a split wide row by left joins on a repeated handle fans
    out k^3 rows (k=2 -> 8), as the three-way join does."""
    df = spark.createDataFrame([("h", 1, "a"), ("h", 2, "b")], "handle string, x int, s string")
    p1, p2, p3 = df.select("handle", "x"), df.select("handle", "s"), df.select("handle")
    assert p1.join(p2, ["handle"], "left_outer").join(p3, ["handle"], "left_outer").count() == 8


def test_blank_strings(spark):
    df = spark.createDataFrame([("", " ", None, "x")], "a string, b string, c string, d string")
    r = normalize_blank(df).collect()[0]
    assert (r["a"], r["b"], r["c"], r["d"]) == (None, " ", None, "x")


def _kept_set(df):
    return {(r["key"], r["row_num"]) for r in df.collect()}


def test_partitioning_and_shift_invariance(spark):
    import random
    rnd = random.Random(11)
    # values on a 1/8 grid: shifting by 4.0 is exact in binary
    series = {f"s{i}": [rnd.randint(-80, 80) / 8 for _ in range(rnd.randint(52, 80))]
              for i in range(10)}
    df = series_df(spark, series)
    cfg = ThinConfig(target=0.4, leading_anchor="first")
    base = _kept_set(thin(df, ["key"], ["seq"], "y", cfg, split="never"))
    for parts in (1, 3, 17):
        shuffled = df.orderBy(F.rand(seed=parts)).repartition(parts)
        assert _kept_set(thin(shuffled, ["key"], ["seq"], "y", cfg, split="never")) == base
    shifted = df.withColumn("y", F.col("y") + F.lit(4.0))
    assert _kept_set(thin(shifted, ["key"], ["seq"], "y", cfg, split="never")) == base
