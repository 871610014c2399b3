"""Copies of a row for each metric in its mask."""

from pyspark.sql import functions as F

from curvethin.plans import pipeline as P


def _want(masks, tags):
    return sorted((m, t) for m in masks if m is not None for i, t in enumerate(tags) if m >> i & 1)


def test_tagged_every_mask(spark):
    """Every mask gives its tags; 0 and null give none; more metrics than the constant table holds go the other way."""
    for tags in (list(P.METRICS), ["V"], [f"m{i}" for i in range(P.TABLE_METRICS + 1)]):
        masks = [*range(1 << len(tags)), None]
        rows = spark.createDataFrame([(m, m) for m in masks], "m int, kept int")
        got = P.tagged(rows, dict.fromkeys(tags, "y")).select("m", "zip_category").collect()
        assert sorted(map(tuple, got)) == _want(masks, tags)


def test_tagged_in_generated_code(spark):
    """The copying of rows is part of the generated code, as are the columns made before and after it."""
    rows = spark.range(100).select("id", (F.col("id") % 32).cast("int").alias("kept"))
    plan = P.tagged(rows)._jdf.queryExecution().executedPlan().toString()
    assert "*(1) Generate explode" in plan
