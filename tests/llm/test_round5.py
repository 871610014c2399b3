"""Components: no broadcast, whatever the tables' size."""

from pyspark.sql import functions as F

from curvethin.llm import graph
from curvethin.llm import textops as T


def test_components_without_broadcast(spark, monkeypatch):
    """A path, a star, a cycle, a repeated link and nodes without links, labelled without a broadcast on the driver."""
    edges = [(k, k + 1) for k in range(10, 30)] + [(50, k) for k in range(51, 60)] + [(72, 71), (71, 70), (70, 72), (72, 71)]
    nodes = [1, 2, *range(10, 31), *range(50, 60), 70, 71, 72]
    plans, cut = [], T.cut

    def seen(df):
        out = cut(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(T, "cut", seen)
    got = graph.components(spark.createDataFrame([(n,) for n in nodes], "id long"), spark.createDataFrame(edges, "a long, b long"))
    want = {1: 1, 2: 2} | dict.fromkeys(range(10, 31), 10) | dict.fromkeys(range(50, 60), 50) | dict.fromkeys((70, 71, 72), 70)
    assert sorted(map(tuple, got.collect())) == sorted(want.items())
    assert len(plans) >= 3 and not any("BroadcastExchange" in p for p in plans)
    none = graph.components(spark.createDataFrame([(7,)], "id long"), spark.createDataFrame([], "a long, b long"))
    assert [tuple(r) for r in none.select(F.col("id"), "component").collect()] == [(7, 7)]
