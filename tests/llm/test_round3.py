"""Cases that earlier code of op4 and op9 got wrong."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from curvethin.llm import op3_exact, op4_substring, op5_mix, op9_secrets


def _reported(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: [(s["start"], op9_secrets.KINDS[s["kind"]], s["end"]) for s in r["spans"] if s["reported"]] for r in op9_secrets.find(rows).collect()}
    return [found[i] for i in range(len(texts))]


def test_overlapping_parts_do_not_vouch_for_each_other(spark):
    got = _reported(spark, ["read https://example.com/docs/GuideToSpark2024Windows now", "user=AbCdEf1234567890abcdefGHIJ",
                            "user=bob https://example.com/docs/GuideToSpark2024Windows", "user: bob AbCdEf1234567890abcdefGHIJ"])
    assert got[0] == got[1] == []
    assert [k for _, k, _ in got[2]] == ["identifier", "secret"] and [k for _, k, _ in got[3]] == ["identifier", "secret"]


def test_long_runs(spark):
    """A million characters of what a format repeats, for every format."""
    runs = ["user: bob a" + ".a" * 500_000, "host" + ".a" * 500_000 + ":8080", "token=" + "a." * 500_000, "AKIA" + "A1" * 500_000, "0f" * 500_000,
            "login=" + "b@" * 500_000, "aB3" * 333_333 + "=", "https://" + "x.y/" * 250_000, "user user " * 100_000, "a-" * 500_000 + ":80", "a..b:8080"]
    got = _reported(spark, runs)
    assert [k for _, k, _ in got[2]] == ["assign"] and [k for _, k, _ in got[3]] == ["access"] and got[4] == [(0, "hex", 1_000_000)]
    assert got[1] == got[6] == got[7] == got[9] == got[10] == []


def test_links_against_all_pairs(spark):
    rnd = random.Random(6)
    pieces = ["user: bob", "login=x9y8z7", "AKIAABCDEFGH12", "AKIA" + "B2" * 9, "Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op8Qr", "https://example.org/p", "db.local:5432",
              "secret=abcdef12", "0123456789abcdef0123456789", "word", "x" * 120, "y" * 250, "https://example.com/Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op8", "user=Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op8"]
    texts = [" ".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 12))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = set()
    for r in op9_secrets.find(rows).collect():
        parts = [(s["start"], op9_secrets.KINDS[s["kind"]], s["end"], s["reported"]) for s in r["spans"]]
        for start, kind, end, reported in parts:
            near = {k for a, k, b, _ in parts if 0 <= start - b <= op9_secrets.SCOPE or 0 <= a - end <= op9_secrets.SCOPE}
            id_, base, secret = near & {"identifier", "access"}, near & {"assign", "access", "hex"}, near & {"secret"}
            want = {"identifier": base or secret, "secret": id_ or near & {"endpoint"}, "endpoint": id_ and (base or secret)}
            assert reported == bool(want.get(kind, True)), (texts[r["doc_id"]], start, kind)
            seen.add((kind, reported))
    assert len(seen) == 9


def test_rows_of_one_id_are_told_apart(spark):
    """Texts whose 32-bit hashes are equal, under a null id and under a repeated one: neither takes words from the other."""
    words = lambda i: F.concat_ws(" ", *[F.concat(F.lit(f"w{k}x"), i.cast("string")) for k in range(40)])
    made = spark.range(200_000).select(words(F.col("id")).alias("text")).withColumn("h", F.hash("text"))
    a, b = sorted(made.groupBy("h").agg(F.collect_list("text").alias("t")).where(F.size("t") > 1).select("t").first()["t"])[:2]
    passage = " ".join(f"p{k}" for k in range(36))
    for i in (None, 7):
        data = [(i, f"{passage} {a}"), (i, b), (8, f"{passage} other"), (i, "one")]
        got = op4_substring.remove_repeats(spark.createDataFrame(data, "doc_id long, text string").repartition(2)).collect()
        assert sorted((r["doc_id"] or 0, r["kept"]) for r in got) == sorted([(i or 0, a), (i or 0, b), (8, "other"), (i or 0, "one")])


def test_mix_of_rows_under_one_id(spark):
    """Fifty texts under a null id, and fifty under one id, are taken near their sources' targets."""
    text = lambda s, i: " ".join(f"{s}{i}w{k}" for k in range(100))
    data = [(None, text("a", i), "a") for i in range(50)] + [(3, text("b", i), "b") for i in range(50)] + [(i, text("c", i), "c") for i in range(100, 150)]
    got = op5_mix.mix(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()
    for s in "abc":
        target = next(r["target"] for r in got if r["source"] == s)
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - target) <= 100


def test_exact_dedup_with_names_of_its_own(spark):
    data = [(1, "a b", 7, "s", True), (2, "a  b", 8, "t", False), (None, "c", 9, "u", None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, _did long, _sha string, _kept boolean")
    assert sorted((tuple(r) for r in op3_exact.dedup(docs).collect()), key=repr) == sorted([data[0], data[2]], key=repr)
    assert op3_exact.dedup(docs).columns == docs.columns
