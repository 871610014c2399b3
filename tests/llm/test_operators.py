"""Each operator on hostile small tables, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from curvethin.llm import (op1_toxicity, op2_decontaminate, op3_exact, op4_substring, op5_mix, op6_pii, op7_ngram_join, op8_quality,
                           op9_secrets, op10_chat)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, score string, h string, tag string"


def texts() -> list[str | None]:
    """Nulls, empty and blank texts, copies with other spaces, near copies, shared passages, one very long text."""
    rnd = random.Random(5)
    word = lambda: rnd.choice(["ab", "cde", "fgh", "é", "x1"]) + rnd.choice(["", "q", "zz", "ß"]) + str(rnd.randint(0, 400))
    base = [" ".join(word() for _ in range(rnd.randint(1, 120))) for _ in range(40)]
    passage = " ".join(word() for _ in range(50))
    out: list[str | None] = [None, "", " \t\n", "one two", "One  two", None]
    for b in base:
        w = b.split()
        out += [b, b.replace(" ", "\n ")]
        for _ in range(3):
            v = list(w)
            for _ in range(rnd.randint(0, 3)):
                v[rnd.randrange(len(v))] = word()
            out.append(" ".join(v))
        if rnd.random() < 0.5:
            out.append(f"{b} {passage} {word()}")
    return [*out, " ".join(base) + " " + " ".join(word() for _ in range(20_000))]


@pytest.fixture(scope="module")
def rows():
    t = texts()
    out = [(i, x, ["a", "b", "b", None, "\U0001F600"][i % 5]) for i, x in enumerate(t)]
    return [*out, out[10], out[10], out[0]]  # repeated rows


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y", "z") for i, t, s in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact(docs, rows, empty):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _ in rows]
    size, keep = Counter(norm), {}
    for (i, _, _), t in zip(rows, norm):
        keep[t] = min(i, keep.get(t, i))
    want = sorted((i, keep[t], size[t], keep[t] == i, hashlib.sha256(t.encode()).hexdigest()) for (i, _, _), t in zip(rows, norm))
    assert sorted(map(tuple, op3_exact.ingest(*op3_exact.halves(docs)).collect())) == want
    stay = op3_exact.dedup(docs)
    assert sorted(r["doc_id"] for r in stay.collect()) == sorted(keep.values()) and stay.columns == docs.columns
    assert op3_exact.dedup(empty).count() == 0


def test_exact_many_keys(docs, monkeypatch):
    """Small shards, a batch of many slices, and keys too many to broadcast give the same rows."""
    old, new = op3_exact.halves(docs)
    want = [sorted(map(tuple, op3_exact.ingest(*x).collect())) for x in ((old, new), (old.limit(0), docs), (docs, new.limit(0)))]
    assert want[0] == want[1] == want[2]
    monkeypatch.setattr(op3_exact, "SHARD_KEYS", 40)
    monkeypatch.setattr(op3_exact.T, "FEW", 0)
    small = old.where("doc_id < 30")
    assert sorted(map(tuple, op3_exact.ingest(small, docs.join(small.select("doc_id"), "doc_id", "left_anti")).collect())) == want[0]


def test_fuse_filter():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 30_000, dtype=np.uint64))
    for n in (1, 2, 7, 100, len(keys)):
        f = op3_exact.fuse_build(keys[:n])
        assert op3_exact.fuse_contains(keys[:n], *f).all()
    assert op3_exact.fuse_contains(keys + np.uint64(1), *f).mean() < 0.01


def test_substring(docs, rows, empty):
    words = [WORD.findall(t or "") for _, t, _ in rows]
    for size in (6, 35):
        seen = Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
        want = []
        for (i, _, _), w in zip(rows, words):
            gone = {k + j for k in range(len(w) - size + 1) if seen[tuple(w[k:k + size])] > 1 for j in range(size)}
            want.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
        got = op4_substring.remove_repeats(docs, size)
        assert sorted(tuple(r)[:4] for r in got.collect()) == sorted(want)
    assert op4_substring.remove_repeats(empty).count() == 0


def test_substring_hot(spark):
    """One passage in every text, and one row many times over under a null id."""
    passage = " ".join(f"p{k}" for k in range(40))
    data = [(i, f"{passage} own{i}") for i in range(3000)] + [(None, passage)] * 500 + [(9999, "alone " * 10)]
    got = op4_substring.remove_repeats(spark.createDataFrame(data, "doc_id long, text string").repartition(7)).collect()
    assert Counter((r["doc_id"] is None, r["n_words"], r["n_removed"]) for r in got) == {(False, 41, 40): 3000, (True, 40, 40): 500, (False, 10, 0): 1}
    assert all(r["kept"] == f"own{r['doc_id']}" for r in got if r["n_words"] == 41)


def test_mix(docs, rows, empty):
    got = op5_mix.mix(docs).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _, _ in rows)
    size = Counter()
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), 1.5 * sum(size.values()), set(names)
    while left > 1e-9 and free:  # share the excess again and again
        w = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / w
        left = sum(max(0.0, target[s] - 2 * size[s]) for s in names)
        target = {s: min(target[s], 2.0 * size[s]) for s in names}
        free = {s for s in free if target[s] < 2 * size[s]}
    for s in names:
        mine = [r for r in got if r["source"] == s]
        assert mine[0]["target"] == pytest.approx(target[s])
        assert abs(sum(r["taken"] for r in mine) - target[s]) <= max(r["size"] for r in mine) * 3 / 2 + 1
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in mine)
    assert op5_mix.mix(empty).count() == 0


def test_ngram_join(docs, rows, empty):
    sets = {}
    for i, t, _ in rows:
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    want = sorted((i, len(sets[i]), find(i)) for i, _, _ in rows)
    got = op7_ngram_join.join(docs).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect())) == want
    assert op7_ngram_join.join(empty).count() == 0


def test_overlap_bound():
    rnd = random.Random(2)
    for _ in range(4000):
        a = {rnd.random() for _ in range(rnd.randint(1, 50))}
        b = {x for x in a if rnd.random() > 0.1} | {rnd.random() for _ in range(rnd.randint(0, len(a) // 5 + 1))}
        if b and 100 * len(a & b) >= 75 * len(a | b):
            n = np.array([len(a)]), np.array([len(b)])
            head = [set(sorted(s)[: int(op7_ngram_join.posted(k)[0])]) for s, k in zip((a, b), n)]
            bound = int(op7_ngram_join.overlap(*n)[0])
            assert len(head[0] & head[1]) >= bound >= max(op7_ngram_join.least(len(a)), op7_ngram_join.least(len(b)))


def test_decontaminate(spark, docs, rows, empty):
    long_ = [(i, t) for i, t, _ in rows if t and 12 <= len(t.split()) <= 60][:6]
    items = [(100 + k, t.upper() if k % 2 else t) for k, (_, t) in enumerate(long_)] + [(1, None), (2, ""), (3, "one two"), (4, "zz none of it here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in op2_decontaminate.matches(docs, bench).collect()}
    want = set()
    for i, t, _ in rows:
        w = WORD.findall((t or "").lower())
        for j, b in items:
            v = WORD.findall((b or "").lower())
            k = min(5, len(v))
            if not v or len(w) < k:
                continue
            y = Counter(tuple(v[p:p + k]) for p in range(len(v) - k + 1))
            for s in range(max(1, len(w) - len(v) + 1)):
                part = w[s:s + len(v)]
                x = Counter(tuple(part[p:p + k]) for p in range(len(part) - k + 1))
                if sum((x & y).values()) >= 0.75 * sum((x | y).values()):
                    want.add((i, j))
                    break
    assert got == want and want
    assert op2_decontaminate.clean(docs, bench).count() == len(rows) - sum(i in {a for a, _ in want} for i, _, _ in rows)
    assert op2_decontaminate.matches(empty, bench).count() == 0 and op2_decontaminate.matches(docs, bench.limit(0)).count() == 0


def test_decontaminate_long(spark, monkeypatch):
    """An item and a text longer than 2**16 shingles, repeated rows, null ids, and items over several blocks."""
    long_ = " ".join(f"a{k}" for k in range(70_000))
    items = [(1, long_)] + [(k, " ".join(f"b{k}x{j}" for j in range(20))) for k in range(2, 40)]
    data = [(1, "pre " + long_), (2, items[5][1] + " tail"), (2, items[5][1] + " tail"), (None, "x y " + items[9][1]), (None, items[9][1]), (4, "b2x0 b2x1 b2x2")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame(data, "doc_id long, text string")
    want = {(1, 1, 1), (2, 6, 0), (None, 10, 0)}
    for block in (op2_decontaminate.BLOCK_SHINGLES, 300):
        monkeypatch.setattr(op2_decontaminate, "BLOCK_SHINGLES", block)
        monkeypatch.setattr(op2_decontaminate, "HITS", 7 if block == 300 else 1000)
        b = bench if block > 300 else bench.where("item_id > 1")
        got = {(r["doc_id"], r["item_id"], r["start"]) for r in op2_decontaminate.matches(d, b).collect()}
        assert got == {w for w in want if block > 300 or w[1] > 1}


def test_decontaminate_own_text(spark):
    """A row goes by its own text: clean rows of a null or shared doc_id stay."""
    item = " ".join(f"i{k}" for k in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    data = [(None, "clean one"), (None, f"pre {item} post"), (None, None), (None, "clean one"), (7, "clean two"), (7, f"{item} z"), (8, item), (9, "clean three")]
    d = spark.createDataFrame(data, "doc_id long, text string")
    got = Counter(map(tuple, op2_decontaminate.clean(d, bench).collect()))
    assert got == Counter([(None, "clean one"), (None, "clean one"), (None, None), (7, "clean two"), (9, "clean three")])
    assert {(r["doc_id"], r["start"]) for r in op2_decontaminate.matches(d, bench).collect()} == {(None, 1), (7, 0), (8, 0)}
    assert op2_decontaminate.clean(d, bench.limit(0)).count() == len(data)


def test_decontaminate_at_threshold(spark):
    """Windows at exactly SIMILARITY: the fingerprints' radius loses none of 4000."""
    n = 4000
    words = [[f"r{k}x{j}" for j in range(25)] for k in range(n)]  # 21 shingles, of which the changed end leaves 18: 18 / 24
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(words)], "item_id long, text string")
    d = spark.createDataFrame([(k, " ".join([*w[:22], "y1", "y2", "y3"])) for k, w in enumerate(words)], "doc_id long, text string")
    got = op2_decontaminate.matches(d, bench).select("doc_id", "item_id", "similarity").collect()
    assert len(got) == n and all(r["doc_id"] == r["item_id"] and r["similarity"] == 0.75 for r in got)


def test_toxicity(spark):
    rnd = random.Random(3)
    calm = ["tree", "river", "stone", "cloud", "house", "garden", "table", "window", "paper", "bread"]
    bad = ["numbskull", "dimwit", "blockhead"]
    make = lambda toxic: " ".join(rnd.choice(bad) if toxic and rnd.random() < 0.15 else rnd.choice(calm) for _ in range(40)) + "."
    data = [(i, make(i % 2), i % 2) for i in range(240)]
    d = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    model = op1_toxicity.fit(d.select("doc_id", "text"), d.select("doc_id", "toxic"))
    tests = [make(1).replace("dimwit", "dim-wit") + " num.bskull num.bskull dimwwit", make(0), "", None, "tree " * 30_000]
    t = spark.createDataFrame([(i, x, "kept") for i, x in enumerate(tests)], "doc_id long, text string, score string")
    got = {r["doc_id"]: r["predicted"] for r in op1_toxicity.score(t, model).collect()}
    assert got == {0: 1, 1: 0, 2: 0, 3: 0, 4: 0}
    assert op1_toxicity.score(t.limit(0), model).count() == 0
    assert op1_toxicity.fit(d.select("doc_id", "text"), d.where("toxic = 0").select("doc_id", "toxic")) is None
    assert {r["score"] for r in op1_toxicity.score(t, None).collect()} == {0.0}


def test_quality(spark):
    rnd = random.Random(4)
    good = lambda: " ".join(rnd.choice("the a river runs under old stone bridges and fields".split()) for _ in range(60)) + "."
    junk = lambda: " ".join(rnd.choice(["BUY!!", "NOW!!", "$$$", "WIN###"]) for _ in range(60))
    d = spark.createDataFrame([(i, good() if i % 3 else junk(), int(i % 3 > 0)) for i in range(200)], "doc_id long, text string, quality int")
    model = op8_quality.fit(d.select("doc_id", "text"), d.select("doc_id", "quality"))
    t = spark.createDataFrame([(0, good()), (1, junk()), (2, ""), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in op8_quality.score(t, model).collect()}
    assert got[0]["predicted"] == 1 and got[1]["predicted"] == 0 and got[2]["score"] == got[3]["score"]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and op8_quality.score(t.limit(0), model).count() == 0


def _pii(text: str) -> list:
    out = []
    for k, p in enumerate([r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if [lambda: True, lambda: all(int(x) <= 255 for x in m[0].split(".")), lambda: 12 <= len(d) <= 19 and op6_pii.luhn(d), lambda: 9 <= len(d) <= 15][k]():
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii(spark, docs, empty):
    rnd = random.Random(6)
    parts = ["@", ".", "1", "25", "4", "-", " ", "+", "(", ")", "a", "b%", "4539578763621486", "é", "x@y.z", "\U0001F600"]
    data = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    assert all(op6_pii.base_spans(t) == _pii(t) for t in data)
    d = spark.createDataFrame([(i, t) for i, t in enumerate([*data, None, "7" * 50_000 + " a@b.c"])], "doc_id long, text string")
    found = op6_pii.find(d, op6_pii.fit(d)).collect()
    for r in found:
        base, every = {tuple(x) for x in r["base"]}, {tuple(x) for x in r["all"]}
        assert base <= every and (r["doc_id"] >= len(data) or sorted(base) == _pii(data[r["doc_id"]]))
    assert op6_pii.find(empty, [None] * 4).count() == 0 and op6_pii.fit(empty) == [None] * 4
    assert op6_pii.redact("to a@b.c now", op6_pii.base_spans("to a@b.c now")) == "to [email] now"


def test_pii_prescreen():
    rnd = random.Random(3)
    parts = ["john", "Example", "com", " at ", " AT ", "(at)", "[At]", " ( at ) ", "@", ".", " dot ", "[dot]", "(DOT)", " ", "1", "22", "333", "4444", "-", "/", "[.]", ":80"]
    data = ["mail john(at)example.com now", "write to john at example.com please", "mail john [at] example.org"]
    data += ["".join(rnd.choice(parts) for _ in range(rnd.randint(3, 12))) for _ in range(5000)]
    hits = [t for t in data if op6_pii.base_spans(t) or any(list(op6_pii._candidates(t, k)) for k in range(4))]
    assert set(data[:3]) <= set(hits) and len(hits) > 100 and all(op6_pii._SOME.search(t) for t in hits)


def test_pii_alignments():
    """Numbers beside other digits: every alignment is proposed, and the trees choose the right one."""
    rnd = random.Random(8)

    def card() -> str:
        d = "4" + "".join(rnd.choice("0123456789") for _ in range(14))
        return next(d + c for c in "0123456789" if op6_pii.luhn(d + c))

    cut = lambda d: " ".join(d[i:i + 4] for i in range(0, 16, 4))
    number = lambda n: "".join(rnd.choice("123456789") for _ in range(n))
    rows = []
    for k in range(150):
        c, phone = card(), f"+{rnd.randint(1, 99)} {number(3)} {number(3)} {number(4)}"
        rows += op6_pii._training_rows(f"we met and then card {c if k % 2 else cut(c)} was paid by {phone} in all")
        rows += op6_pii._training_rows(f"order {number(3)} {number(4)} {number(4)} {number(5)} and {number(16)}, list {number(2)} {number(3)} {number(3)} {number(8)}")
    models = op6_pii.train(rows)
    for text, want in [("order 12 4539578763621486 paid", "4539578763621486"), ("order 1234 4539 5787 6362 1486 paid", "4539 5787 6362 1486"),
                       ("call +49 301 234 5678 12345678 now", "+49 301 234 5678")]:
        kind = 3 if "+" in want else 2
        assert not op6_pii.base_spans(text) and want in [text[a:b] for a, b in op6_pii._candidates(text, kind)]
        assert want in [text[a:b] for a, _, b in op6_pii._with_added(text, [], models)], text
    mail = "x@y.co.uk"
    assert [mail[a:b] for a, b in op6_pii._candidates(mail, 0)] == ["x@y.co", "x@y.co.uk"]
    assert set(op6_pii._candidates("0049 301 2345 6789", 3)) == {(0, 13), (0, 18), (5, 18)}


def test_secrets(spark, empty):
    rnd = random.Random(7)
    parts = ["token", "secret=", "Api_Key:", "password", " = ", '"', "abcdef12", "AKIA", "ABCDEFGH12", "0123456789abcdef", "é", "\U0001F600", " ", "\n", "user: bob"]
    data = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(400)]
    weak = "Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op8Qr"
    data += [None, "", f"see {weak} alone", f"user: bob\n{weak}", f"user: bob{' ' * 500}{weak}"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(data)] + [(0, data[0])], "doc_id long, text string")
    got = op9_secrets.find(d).collect()
    assert len(got) == len(data) + 1
    for r in got:
        t, want = data[r["doc_id"]] or "", []
        for m in re.finditer(op9_secrets.FORMATS["assign"], t):
            want += [(m.start(), 0, m.end())] * (len(m[2]) >= 6)
        want += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        want += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
        assert [(s["start"], s["kind"], s["end"]) for s in r["spans"] if s["kind"] < 3] == sorted(want)
    n = len(data)
    reported = {r["doc_id"]: [op9_secrets.KINDS[s["kind"]] for s in r["spans"] if s["reported"]] for r in got}
    assert reported[n - 3] == [] and reported[n - 2] == ["identifier", "secret"] and reported[n - 1] == []
    assert op9_secrets.find(empty).count() == 0


def test_secrets_gaps(spark):
    """Distances count from the end of a part to the start of the next; a token's digit or letter case may come late."""
    weak, late = "Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op8Qr" * 30, "aB" * 100 + "7"
    data = {1: (f"{weak} user: bob", ["secret", "identifier"]), 2: (f"user: bob {weak}", ["identifier", "secret"]),
            3: (f"{weak} https://example.org/x", ["secret"]), 4: (f"user: bob {late}", ["identifier", "secret"]),
            5: (f"{late}{' ' * 400}user: bob", ["secret", "identifier"]), 6: (f"{late}{' ' * 401}user: bob", []),
            7: (f"user: bob{' ' * 400}{late}", ["identifier", "secret"]), 8: (f"user: bob{' ' * 401}{late}", []),
            9: (f"{weak} user: bob at https://example.org/{'x' * 500} user: eve", ["secret", "identifier", "endpoint"]),  # eve is too far
            10: (f"user: bob {'aB' * 100}", [])}
    d = spark.createDataFrame([(i, t) for i, (t, _) in data.items()], "doc_id long, text string")
    got = {r["doc_id"]: [op9_secrets.KINDS[s["kind"]] for s in r["spans"] if s["reported"]] for r in op9_secrets.find(d).collect()}
    assert got == {i: w for i, (_, w) in data.items()}


def test_chat(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (2, 1, "assistant", "hello you"), (2, 1, "assistant", "hello you"),
             (3, 0, None, None), (4, 0, "user", "q"), (4, 1, "assistant", "é\U0001F600"), (None, 0, "user", "x"), (None, 0, "user", "x"), (None, 1, "assistant", "y")]
    d = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    found = op10_chat.format_pairs(op10_chat.pairs(op10_chat.conversations(d))).collect()
    got = {r["conv_id"]: r for r in found}
    assert sorted(r["prompt"] for r in found if r["conv_id"] is None) == ["<|assistant|>\ny<|end|>\n", "<|user|>\nx<|end|>\n"]
    assert set(got) == {1, 2, 3, 4, None}
    r = got[1]
    assert (r["other_id"], r["prefix_turns"], r["prompt"]) == (2, 1, "<|user|>\nhi<|end|>\n")
    assert r["chosen_text"] == "<|assistant|>\nhello you<|end|>\n" and r["rejected_text"] == "<|assistant|>\nyo<|end|>\n"
    a, b = r["chosen_mask"][0]
    assert r["chosen_text"][a:b] == "hello you<|end|>\n"
    assert got[4]["chosen_text"] == "" and got[3]["prefix_turns"] == 1
    assert op10_chat.pairs(op10_chat.conversations(d.limit(0))).count() == 0


def test_chat_sparse_ids(spark):
    """Ids far apart, over several ranges: the next one that opens alike, else the next one's reply."""
    rnd = random.Random(10)
    ids = sorted(rnd.sample(range(-10 ** 12, 10 ** 12), 120))
    opening = {i: f"q{rnd.choice([0, 0, 0, *range(1, 60)])}" for i in ids}
    turns = [(i, k, *t) for i in ids for k, t in enumerate([("user", opening[i]), ("assistant", f"a{i}")])]
    d = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["conv_id"]: r for r in op10_chat.format_pairs(op10_chat.pairs(op10_chat.conversations(d))).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(got) == ids
    for k, i in enumerate(ids):
        alike = [j for j in ids[k + 1:] if opening[j] == opening[i]]
        other = alike[0] if alike else ids[k + 1] if k + 1 < len(ids) else None
        assert got[i]["other_id"] == other and got[i]["prefix_turns"] == (2 if other is None else 1)
        texts = {got[i][f"{s}_text"] for s in ("chosen", "rejected")}
        assert texts == ({""} if other is None else {f"<|assistant|>\na{j}<|end|>\n" for j in (i, other)})


def test_slices_and_lists():
    from curvethin.llm import textops as T

    text = pa.array(["a b", None, "", "c" * 100, "d e f"])
    got = [(i, j, bytes(d)) for i, j, d, _ in T.chunks(text, 10)]
    assert b"".join(x for _, _, x in got) == b"a b" + b"c" * 100 + b"d e f" and got[-1][1] == 5
    w = T.Words(np.frombuffer(b"ab cdef", np.uint8), np.array([0, 2, 2, 4, 7]))
    assert w.counts().tolist() == [1, 0, 1, 1]
