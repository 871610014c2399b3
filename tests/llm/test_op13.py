"""The Merkle manifest against a plain recursive one."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from curvethin.llm import op13_merkle as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, idx string, digest string, n string, at string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    i, _, lang, source, n = row
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k:k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def beside(levels, k):
    out = []
    for level in levels[:-1]:
        run = level[k // 8 * 8:k // 8 * 8 + 8]
        out.append((run[:k % 8], run[k % 8 + 1:]))
        k //= 8
    return out


def brute(rows):
    lower = lambda t: None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    langs = {}
    for r in rows:
        bent = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        langs.setdefault(r[2], []).append((r[0], leaf(r, r[1]), leaf(r, lower(r[1]) if bent else r[1])))
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in names:
        langs[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[lang] = climb([x[1] for x in langs[lang]])
    top = climb([trees[x][-1][0] for x in names])
    out = []
    for at, lang in enumerate(names):
        for k, (i, own, bent) in enumerate(langs[lang]):
            steps = beside(trees[lang], k) + beside(top, at)
            folded = bent
            for before, after in steps:
                folded = h(*before, folded, *after)
            out.append((i, own, trees[lang][-1][0], top[-1][0], h(*(x for a, b in steps for x in a + b)), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def documents(seed, sizes):
    rnd = random.Random(seed)
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            i = None if rnd.random() < 0.02 else rnd.randint(-5, 3 * sum(sizes.values()))
            rows.append((i, rnd.choice([None, "", "Ab cÉ", f"Text {rnd.random()}", "lower é"]), lang, rnd.choice([None, "", "web"]), rnd.choice([None, 3])))
    rows += rows[:3]  # rows that repeat
    return rows


def got(spark, rows, monkeypatch):
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA).repartition(4)
    monkeypatch.setattr(M.T, "read", lambda *_: docs)
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[c] for c in columns) for r in M.query(spark, "").collect()), key=repr)


@pytest.mark.parametrize("sizes", [
    {"en": 1200, "de": 65, None: 64, "": 9, "é": 8, "fr": 1, "zz": 513},
    {"en": 1}, {None: 2}, {f"l{i}": 1 for i in range(70)}, {"en": 4200},
])
def test_manifest(spark, monkeypatch, sizes):
    rows = documents(1, sizes)
    if sizes == {"en": 1}:
        rows = rows[:1]
    assert got(spark, rows, monkeypatch) == brute(rows)


def test_stored_levels(spark):
    """Only the leaves and every third level above them are stored."""
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in documents(2, {"en": 1300, "de": 10})], SCHEMA)
    levels = M.build(M.number(M.leaves(docs), ["doc_id", "digest"]))
    sizes = [{r["tree"]: r["count"] for r in level.groupBy("tree").count().collect()} for level in levels]
    assert sizes == [{"en": 1303, "de": 10}, {"en": 3, "de": 1}, {"en": 1, "de": 1}]


def test_empty(spark, monkeypatch):
    assert got(spark, [], monkeypatch) == []


def test_long_text(spark, monkeypatch):
    rows = [(1, "A" * 3_000_000, "en", None, None), (2, "x", "en", "s", 1)]
    assert got(spark, rows, monkeypatch) == brute(rows)
