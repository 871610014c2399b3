"""Conversation repair against a brute-force program over plain strings."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from curvethin.llm import op12_repair as R

SCHEMA = "conv_id long, turn long, role string, text string, key string, kind string, digest string, at string"
SPACE = "\x20\x09-\x0D"


def damage(rows):
    out = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k:
            role, text = "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out += [(c, t, role, text)] * (2 if k == 3 else 1)
    return out


def brute(rows):
    """The rows of one conversation after damage, in order."""
    seen, flags = set(), []
    for _, _, role, text in rows:
        bare = re.sub(f"[{SPACE}]+$", "", text)
        flags.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    fits = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    nxt = {"": "u", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}

    def hops(best):
        best = dict(best)
        for _ in range(4):
            for s, (cost, audit, lines) in list(best.items()):
                new = (cost + 5, audit + "I", (*lines, full[nxt[s]] + ":"))
                if nxt[s] not in best or new[:2] < best[nxt[s]][:2]:
                    best[nxt[s]] = new
        return best

    best = {"": (0, "", ())}
    for (_, _, role, text), flag in zip(rows, flags):
        found = {}
        for s, (cost, audit, lines) in hops(best).items():
            options = [(s, cost + 2, "D", ())]
            if flag not in ("blank", "duplicate"):
                more = 5 * (flag == "truncated")
                options.append((nxt[s], cost + 1 + more, "R", (f"{full[nxt[s]]}:{text}",)))
                if (s, role[:1]) in fits:
                    options.append((fits[s, role[:1]], cost + more, "K", (f"{role}:{text}",)))
            for state, c, letter, line in options:
                new = (c, audit + letter, (*lines, *line))
                if state not in found or new[:2] < found[state][:2]:
                    found[state] = new
        best = found
    cost, audit, lines = min(v for s, v in hops(best).items() if s in ("", "a"))
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, flags.count("blank"), flags.count("duplicate"), flags.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    groups = {r[0]: [] for r in rows}
    for r in damage(rows):
        groups[r[0]].append(r)
    digest = lambda r: hashlib.sha256(f"{len(r[2].encode())}:{r[2]}{r[3]}".encode()).digest()
    return {c: brute(sorted(g, key=lambda r: (r[1] is not None, r[1] or 0, digest(r)))) for c, g in groups.items()}


def conversations(seed=1, count=120, longest=9):
    rnd = random.Random(seed)
    words = ["Yes.", "no", "ok!", "", " \t", "why?", "Éa. ", "one two", "..", "x" * 20 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "ugly", "s"]
    rows = []
    for c in [*range(count), None]:
        for t in range(rnd.randint(1, longest)):
            role = ["user", "assistant"][t % 2] if rnd.random() < 0.5 else rnd.choice(roles)
            text = rnd.choice([None, *words]) if rnd.random() < 0.5 else f"{c} {t}."
            rows.append((c, None if rnd.random() < 0.05 else t + 2 * (rnd.random() < 0.1), role, text))
    return rows + rows[3:6] + [(777, None, "user", "Hi."), (777, None, "assistant", "Yo."), (778, 5, None, None)]


def got(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA).repartition(3)
    return {r[0]: tuple(r)[1:] for r in R.repair(df).collect()}


def test_repair(spark):
    rows = conversations()
    assert got(spark, rows) == expected(rows)


def test_blocks_and_levels(spark, monkeypatch):
    """Small blocks and groups: conversations of many segments, combined over several levels, give the same rows."""
    rows = conversations(2, 12, 9) + [r for r in conversations(3, 3, 220) if r[0] is not None]
    monkeypatch.setattr(R, "BLOCK_BITS", 2)
    monkeypatch.setattr(R, "FAN", 3)
    assert got(spark, rows) == expected(rows)


def test_one_long_conversation(spark):
    rnd = random.Random(9)
    rows = [(5, t, rnd.choice(["user", "assistant", "assistant", "system"]), rnd.choice(["a.", f"{t}.", f"{t}"])) for t in range(5000)]
    rows += [(6, 1, "user", "same.")] * 3000  # one row many times
    assert got(spark, rows) == expected(rows)


def test_empty(spark):
    assert got(spark, []) == {}


@pytest.mark.parametrize("base", [0x1F3D5B79A8642031, 1, 0])
def test_audits(monkeypatch, base):
    """Order as that of strings, also where hashes collide (base 1: anagrams; base 0: equal last letters)."""
    monkeypatch.setattr(R, "_BASE", base)
    rnd = random.Random(8)
    audits, nodes = R.Audits(), [(0, "")]
    for _ in range(400):
        node, text = rnd.choice(nodes[-60:])
        letter = rnd.choice("DIKR")
        nodes.append((audits.extend(node, letter, letter), text + letter))
    for _ in range(3000):
        (a, x), (b, y) = rnd.choice(nodes), rnd.choice(nodes)
        sign = audits.compare(a, b)
        assert (sign > 0) - (sign < 0) == (x > y) - (x < y)
    assert all("".join(audits.edits(n)) == t for n, t in nodes)


def test_segments_combine_like_one():
    rnd = random.Random(7)
    for _ in range(60):
        rows = [(rnd.choice("suaut"), rnd.random() < 0.2, rnd.random() < 0.3) for _ in range(rnd.randint(2, 14))]
        whole = R.segment(rows)
        cuts = sorted(rnd.sample(range(1, len(rows)), min(3, len(rows) - 1)))
        parts = [R.segment(rows[a:b]) for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        costs, places, ways = R.combine([p[:2] for p in parts])
        assert (costs, places) == whole[:2]
        for i, way in enumerate(ways):
            states = [i // 4, *map(int, way)]
            assert "".join(p[2][a * 4 + b] for p, a, b in zip(parts, states, states[1:])) == whole[2][i]
