"""Findings of round 3 on the training-data operators."""

from __future__ import annotations

from collections import Counter

from curvethin.llm import op6_pii


def test_pii_is_fitted_on_all_documents(spark):
    """More documents than were sampled; few of them have cards, in no order or partition that matters."""
    texts = [f"nothing {i} here" for i in range(6000)] + [f"pay by card 4539 5787 6362 1486 on {i} May" for i in range(12)]
    rows = [(i, t) for i, t in enumerate(texts)]
    want = Counter((k, y, tuple(x)) for t in texts for k, y, x in op6_pii._training_rows(t))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r["kind"], r["label"], tuple(r["x"])): r["n"] for r in op6_pii.counted(d).collect()} == want
    models = op6_pii.fit(d)
    again = op6_pii.fit(spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(5))
    assert models[2] is not None and models == again
