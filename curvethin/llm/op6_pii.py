"""PII: candidate spans from high-recall generators, scored by gradient-boosted trees, cut at calibrated thresholds.

Base spans (always kept) are the leftmost non-overlapping matches, kind by kind, of the formats below that pass
their check (email; ip with parts of at most 255; card of 12 to 19 digits passing Luhn; phone of 9 to 15 digits).

The generators propose more, overlapping and loosely: addresses spelled with "at" and "dot", phone-like and
card-like digit groups without "+" or with other separators, dotted quads in brackets or with a port. Every alignment is a candidate of its
own: each group start with each permitted end, so a number beside other digits is proposed alone as well. Each candidate is described by
its format (digits, groups, separators, longest group, brackets, checks) and context (neighbouring characters, cue words
before it). One ensemble of depth-2 trees for each kind is boosted on logistic loss. Positives are base spans and
the same spans rewritten the way the generators allow (no "+" and country code, "(at)", a port, further digits beside it ...), at their exact
alignment; negatives are candidates that touch no base span, and those that reach over a rewritten span's edge. A kind's threshold is the lowest that keeps PRECISION on rows not used for boosting; a kind
without enough rows adds nothing. All documents are used: training rows that are alike become one with a count, and each tree is grown from
histograms that Spark sums over them in whole numbers, so neither their order nor their partitions matter. Of overlapping candidates the highest margin is added (the longer of equals); added spans overlap no other span.

The driver gets sums only: quantiles of the features, a histogram for each task and kind, counts by margin.

Defined results: null counts as empty; offsets are code points, end exclusive; texts without candidates have empty
lists; repeated rows give equal results; further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvethin.llm import textops as T
from curvethin.session import store

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.99
TREES = 40
RATE = 0.2
LEAST_ROWS = 20
SCORED = 20_000  # candidates described at once
CUTS = np.linspace(0.05, 0.95, 12)  # quantiles of a feature at which a tree may cut
BINS = len(CUTS) + 1
UNIT = 2.0 ** 24  # gradients are summed as whole numbers of 1 / UNIT
GRID = 1024  # margins are told apart in steps of 1 / GRID when a threshold is chosen

# Possessive quantifiers where the next item can't begin inside the run: same matches, no quadratic retries.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# a text without any of these has no match of any format or generator: all need a digit, an @ or a spelled-out "at"
_SOME = re.compile(r"[0-9@]|[\x20(\[]at[\x20)\]]", re.I)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: the run of local characters before an @ (not before the last match's end), then a domain."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        if at >= floor:
            start = at
            while start > floor and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at)):
                out.append((start, m.end()))
                floor = m.end()
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end), sorted."""
    out = [(a, 0, b) for a, b in _emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


# --- candidates ---------------------------------------------------------------------------------------

_AT = r"(?:@|[\x20]?[(\[][\x20]?at[\x20]?[)\]][\x20]?|[\x20]at[\x20])"
_DOT = r"(?:\.|[\x20]?[(\[][\x20]?dot[\x20]?[)\]][\x20]?|[\x20]dot[\x20])"
_LABEL = r"[A-Za-z0-9-]{1,63}"
# Lookaheads: a match at every start. Of an address, the captured domain's parts are the ends.
_ADDRESS = re.compile(rf"(?<![A-Za-z0-9._%+-])(?=[A-Za-z0-9._%+-]{{1,64}}+{_AT}{_LABEL}((?:{_DOT}{_LABEL}){{1,6}}))", re.I)
_PART = re.compile(_DOT + _LABEL, re.I)
_QUADS = tuple(re.compile(rf"(?<![0-9.])(?=([0-9]{{1,3}}(?:(?:\.|\[\.\]|\(\.\))[0-9]{{1,3}}){{3}}{port})(?![0-9.]))") for port in ("", ":[0-9]{2,5}"))
_LOCAL_PHONES = tuple(re.compile(rf"(?<![0-9+(])(?=({code}\(?[0-9]{{2,4}}\)?[\x20./-]{{1,2}}[0-9]{{3,4}}[\x20./-][0-9]{{3,4}})(?![0-9]))")
                      for code in ("", "00[0-9]{1,3}", r"00[0-9]{1,3}[\x20.-]"))
_GROUP = re.compile(r"[0-9]+")
_CARD_GAP = re.compile(r"[\x20._/-]{1,2}")
_PHONE_GAP = re.compile(r"[\x20().-]+")
_CUES = (("mail", "contact", "write"), ("ip", "host", "server", "addr"), ("card", "visa", "pay", "credit"), ("phone", "tel", "call", "fax", "mobile"))
N_FEATURES = 16


def _describe(text: str, a: int, b: int, kind: int) -> list[float]:
    s, before, after = text[a:b], text[max(0, a - 24):a].lower(), text[b:b + 2]
    groups = re.findall(r"[0-9]+", s)
    d = "".join(groups)
    left, right = before[-1:] or " ", after[:1] or " "
    return [len(s), len(d), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0), s.count("."), s.count("-"), s.count(" "),
            s.count("(") + s.count("["), sum(c.isalpha() for c in s), max((int(g[:6]) for g in groups), default=0), float(bool(d) and luhn(d)),
            float(left.isalnum()), float(right.isalnum()), float(any(c in before for c in _CUES[kind])), float(d[:1] in ("0", "1"))]


def _variants(text: str, a: int, b: int, kind: int) -> list[tuple[str, str, str]]:
    """A base span rewritten the way the generators allow, with what stands directly before and after it."""
    s = text[a:b]
    if kind == 0:
        user, _, host = s.partition("@")
        return [("", v, "") for v in (f"{user} at {host.replace('.', ' dot ')}", f"{user}(at){host}", f"{user} [at] {host.replace('.', ' [dot] ')}")]
    if kind == 1:
        return [("", s.replace(".", "[.]"), ""), ("", s + ":8080", "")]
    if kind == 2:
        d = _digits(s)
        fours = [d[i:i + 4] for i in range(0, len(d), 4)]
        return [("", ".".join(fours), ""), ("", "/".join(fours), ""), ("12 ", s, ""), ("1234 ", " ".join(fours), ""), ("", s, " 123")]
    rest = re.sub(r"^\+[0-9]{1,3}[\x20.-]*", "", s)
    return [("", rest, ""), ("", "00" + s[1:], ""), ("", rest.replace("-", "."), ""), ("", s, " 12345678")]


def _runs(text: str, gap: re.Pattern, least: int, most: int, plus: bool) -> Iterator[tuple[int, int]]:
    """Every run of whole digit groups with ``gap`` between them and ``least`` to ``most`` digits; with ``plus``, from a + on."""
    groups = [m.span() for m in _GROUP.finditer(text)]
    for i, (a, _) in enumerate(groups):
        if plus and text[a - 1:a] != "+":
            continue
        n = 0
        for k in range(i, len(groups)):
            n += groups[k][1] - groups[k][0]
            if n > most or (k > i and not gap.fullmatch(text, groups[k - 1][1], groups[k][0])):
                break
            if n >= least:
                yield a - plus, groups[k][1]


def _candidates(text: str, kind: int) -> Iterator[tuple[int, int]]:
    """Every alignment of a kind, overlapping."""
    if kind == 0:
        for m in _ADDRESS.finditer(text):
            for part in _PART.finditer(text, *m.span(1)):
                yield m.start(), part.end()
    elif kind == 1:
        yield from (m.span(1) for g in _QUADS for m in g.finditer(text))
    elif kind == 2:
        yield from _runs(text, _CARD_GAP, 12, 19, False)
    else:
        yield from sorted({m.span(1) for g in _LOCAL_PHONES for m in g.finditer(text)})
        yield from _runs(text, _PHONE_GAP, 9, 15, True)


class _Taken:
    """Disjoint intervals, in order."""

    def __init__(self, spans: Iterable[tuple[int, int, int]]):
        self.start: list[int] = []
        self.end: list[int] = []
        for a, _, b in sorted(spans):
            if self.end and a < self.end[-1]:
                self.end[-1] = max(self.end[-1], b)
            else:
                self.start.append(a)
                self.end.append(b)

    def meets(self, a: int, b: int) -> bool:
        k = bisect_left(self.start, b)
        return k > 0 and self.end[k - 1] > a

    def add(self, a: int, b: int) -> None:
        k = bisect_left(self.start, a)
        self.start.insert(k, a)
        self.end.insert(k, b)


def _training_rows(text: str) -> list[tuple[int, int, list[float]]]:
    """(kind, label, features) of a document's candidates and of its base spans' variants."""
    base, out = base_spans(text), []
    for a, kind, b in base:
        for before, v, after in _variants(text, a, b, kind):
            t = text[max(0, a - 30):a] + before + v + after + text[b:b + 30]
            low = min(a, 30) + len(before)
            high = low + len(v)
            for x, y in _candidates(t, kind):
                if (x, y) == (low, high):
                    out.append((kind, 1, _describe(t, x, y, kind)))
                elif x < low < y or x < high < y:
                    out.append((kind, 0, _describe(t, x, y, kind)))
    taken = _Taken(base)
    for kind in range(len(KINDS)):
        out += [(kind, 0, _describe(text, a, b, kind)) for a, b in _candidates(text, kind) if not taken.meets(a, b)]
    return out


# --- gradient boosting ----------------------------------------------------------------------------------

@dataclass
class Boosted:
    start: float
    trees: list  # (feature, cut, (feature, cut, low, high) for each side)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for f, cut, sides in self.trees:
            above = x[:, f] > cut
            for side, (g, c, low, high) in ((~above, sides[0]), (above, sides[1])):
                out[side] += np.where(x[side, g] > c, high, low)
        return out


@dataclass
class Rows:
    """Training rows of a kind, with how often each counts."""

    x: np.ndarray
    y: np.ndarray
    n: np.ndarray


def _sums(rows: dict[int, Rows], models: dict[int, Boosted], roots: dict[int, tuple], cuts: dict[int, list]) -> dict[int, np.ndarray]:
    """Of each kind: sums of gradients and second derivatives by side of the root's cut, feature and bin."""
    out = {}
    for kind, model in models.items():
        total = np.zeros((2, N_FEATURES, BINS, 2))
        if kind in rows:
            r = rows[kind]
            p = 1 / (1 + np.exp(-model.margin(r.x)))
            parts = np.rint((r.y - p) * UNIT) * r.n, np.rint(np.maximum(p * (1 - p), 1e-6) * UNIT) * r.n
            side = BINS * (r.x[:, roots[kind][0]] > roots[kind][1]) if kind in roots else 0
            for f, values in enumerate(cuts[kind]):
                at = side + np.searchsorted(values, r.x[:, f])
                for k, v in enumerate(parts):
                    total[:, f, :, k] = np.bincount(at, v, 2 * BINS).reshape(2, BINS)
        out[kind] = total.astype(np.int64)
    return out


def _split(sums: np.ndarray, cuts: list[np.ndarray]) -> tuple[int, float, float, float]:
    """The feature and cut with the largest gain, and the values of the leaves below and above it."""
    best, most = (0, np.inf, 0.0, 0.0), -1.0
    g, h = sums[0].sum(axis=0) / UNIT
    for f, values in enumerate(cuts):
        above = np.cumsum(sums[f, ::-1], axis=0)[::-1] / UNIT
        for j, c in enumerate(values):
            g1, h1 = above[j + 1]
            gain = g1 * g1 / (h1 + 1) + (g - g1) ** 2 / (h - h1 + 1)
            if gain > most + 1e-12:
                best, most = (f, float(c), float(RATE * (g - g1) / (h - h1 + 1)), float(RATE * g1 / (h1 + 1))), gain
    return best


def boost(sums, starts: dict[int, float], cuts: dict[int, list]) -> dict[int, Boosted]:
    """Depth-2 trees by Newton boosting on logistic loss, for all kinds at once; ``sums(models, roots)`` as ``_sums``."""
    models = {kind: Boosted(start, []) for kind, start in starts.items()}
    for _ in range(TREES if models else 0):
        whole = sums(models, {})
        roots = {kind: _split(whole[kind][0], cuts[kind])[:2] for kind in models}
        sides = sums(models, roots)
        for kind, model in models.items():
            model.trees.append((*roots[kind], [_split(side, cuts[kind]) for side in sides[kind]]))
    return models


def _start(positive: float, rows: float) -> float:
    rate = np.clip(positive / rows, 0.01, 0.99)
    return float(np.log(rate / (1 - rate)))


def _threshold(steps: np.ndarray, n: np.ndarray, positive: np.ndarray) -> float | None:
    """The lowest margin, in steps, from which on PRECISION is kept."""
    order = np.argsort(-steps)
    good = np.flatnonzero(np.cumsum(positive[order]) >= PRECISION * np.cumsum(n[order]))
    return float(max(steps[order][good[-1]] / GRID, 0.0)) if len(good) else None


def _chosen(models: dict[int, Boosted], counts: dict[int, tuple]) -> list[tuple[Boosted, float] | None]:
    """For each kind, the trees and the threshold on their margin; None adds nothing. ``counts``: of each kind its steps of
    margins, how many checked rows have them and how many of those are positive."""
    limit = {kind: _threshold(*map(np.array, counts[kind])) for kind in models if kind in counts}
    return [(models[kind], limit[kind]) if limit.get(kind) is not None else None for kind in range(len(KINDS))]


def train(rows: list[tuple[int, int, list[float]]]) -> list[tuple[Boosted, float] | None]:
    """``fit`` of training rows at hand, every third of which is kept for the threshold."""
    fitted, counts, starts, cuts = {}, {}, {}, {}
    for kind in range(len(KINDS)):
        mine = sorted((r[1:] for r in rows if r[0] == kind), key=lambda r: (r[1], r[0]))
        y = np.array([r[0] for r in mine], float)
        if y.sum() < LEAST_ROWS:
            continue
        x = np.array([r[1] for r in mine], float)
        check = np.arange(len(x)) % 3 == 0
        fitted[kind] = Rows(x[~check], y[~check], np.ones((~check).sum()))
        counts[kind] = x[check], y[check]
        starts[kind] = _start(y[~check].sum(), (~check).sum())
        cuts[kind] = [np.unique(np.quantile(x[~check, f], CUTS)) for f in range(N_FEATURES)]
    models = boost(lambda models, roots: _sums(fitted, models, roots, cuts), starts, cuts)
    for kind, (x, y) in counts.items():
        steps, at = np.unique(np.floor(models[kind].margin(x) * GRID), return_inverse=True)
        counts[kind] = steps, np.bincount(at), np.bincount(at, y)
    return _chosen(models, counts)


def counted(docs: DataFrame) -> DataFrame:
    """(kind, label, x, n): the training rows of all documents' texts, alike ones once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in batched(batch.column("text").to_pylist(), 500):
                rows = [r for t in some if t and _SOME.search(t) for r in _training_rows(t)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.float64()))],
                    ["kind", "label", "x"])

    rows = docs.select("text").mapInArrow(run, "kind int, label int, x array<double>")
    return rows.groupBy("kind", "label", "x").agg(F.count(F.lit(1)).alias("n"))


def _rows(batch: pa.RecordBatch, count: str) -> dict[int, Rows]:
    kind, y, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("kind", "label", count))
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
    return {int(k): Rows(x[kind == k], y[kind == k].astype(float), n[kind == k].astype(float)) for k in np.unique(kind)}


def fit(docs: DataFrame) -> list[tuple[Boosted, float] | None]:
    """From (doc_id, text), on all documents: for each kind, the trees and the threshold on their margin; None adds nothing."""
    # a third of the rows is kept for the threshold: of alike ones every third, from a place that their hash sets
    check = "(n + pmod(xxhash64(kind, label, x), 3)) div 3"
    rows = store(counted(docs).selectExpr("kind", "label", "x", "n", f"n - {check} AS fit_n", f"{check} AS check_n"))
    at = ", ".join(map(repr, CUTS.tolist()))
    facts = rows.groupBy("kind").agg(F.sum(F.col("label") * F.col("n")).alias("positive"), F.sum("fit_n").alias("fit_n"),
                                     F.sum(F.col("label") * F.col("fit_n")).alias("fit_positive"),
                                     *[F.expr(f"percentile(x[{f}], array({at}), fit_n)").alias(f"x{f}") for f in range(N_FEATURES)]).collect()
    facts = {r["kind"]: r for r in facts if r["positive"] >= LEAST_ROWS and r["fit_n"]}
    cuts = {kind: [np.unique(r[f"x{f}"]) for f in range(N_FEATURES)] for kind, r in facts.items()}

    def sums(models: dict[int, Boosted], roots: dict[int, tuple]) -> dict[int, np.ndarray]:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for kind, some in _sums(_rows(batch, "fit_n"), models, roots, cuts).items():
                    total[kind] = total[kind] + some if kind in total else some
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.ravel() for v in total.values()], pa.list_(pa.int64()))], ["kind", "sums"])

        out = {kind: np.zeros((2, N_FEATURES, BINS, 2), np.int64) for kind in models}
        for r in rows.mapInArrow(run, "kind int, sums array<long>").collect():
            out[r["kind"]] += np.array(r["sums"], np.int64).reshape(2, N_FEATURES, BINS, 2)
        return out

    models = boost(sums, {kind: _start(r["fit_positive"], r["fit_n"]) for kind, r in facts.items()}, cuts)

    def margins(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, r in _rows(batch, "check_n").items():
                if kind in models:
                    step = np.floor(models[kind].margin(r.x) * GRID).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(step), kind, np.int32)), pa.array(step), pa.array(r.n.astype(np.int64)), pa.array((r.n * r.y).astype(np.int64))],
                                                     ["kind", "step", "n", "positive"])

    counts: dict[int, list] = {}
    if models:
        checked = rows.where("check_n > 0").mapInArrow(margins, "kind int, step long, n long, positive long")
        for r in checked.groupBy("kind", "step").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive")).collect():
            for values, v in zip(counts.setdefault(r["kind"], [[], [], []]), (r["step"], r["n"], r["positive"])):
                values.append(v)
    return _chosen(models, counts)


def _with_added(text: str, base: list[tuple[int, int, int]], models: list) -> list[tuple[int, int, int]]:
    spans, taken = list(base), _Taken(base)
    for kind, model in enumerate(models):
        if model is None:
            continue
        good = []
        for some in batched((c for c in _candidates(text, kind) if not taken.meets(*c)), SCORED):
            margin = model[0].margin(np.array([_describe(text, a, b, kind) for a, b in some]))
            good += [(-m, a - b, a) for (a, b), m in zip(some, margin.tolist()) if m >= model[1]]
        for _, size, a in sorted(good):
            if not taken.meets(a, a - size):
                spans.append((a, kind, a - size))
                taken.add(a, a - size)
    return sorted(spans)


def find(docs: DataFrame, models: list) -> DataFrame:
    """doc_id, base and all: lists of (start, kind, end), for each row."""
    kind = "array<struct<start:int,kind:int,end:int>>"
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))

    def spans(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, every = [], []
        for t in batch.column("text").to_pylist():
            b = base_spans(t) if t and _SOME.search(t) else []
            base.append(b)
            every.append(_with_added(t, b, models) if t and _SOME.search(t) else [])
        asdict = lambda r: [{"start": a, "kind": k, "end": e} for a, k, e in r]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([asdict(r) for r in c], arrow) for c in (base, every))], ["doc_id", "base", "all"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                yield spans(batch.slice(i, 500))

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, base {kind}, all {kind}")


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind."""
    out, at = [], 0
    for a, kind, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind]}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = T.read(spark, sf_dir, "documents")
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    joined = lambda c: f"array_join(transform({c}, s -> concat({names}[s.kind], ':', s.start, ':', s.end)), ',')"
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return find(docs, fit(docs)).select("doc_id", *counts, F.sha2(F.expr(joined("base")), 256).alias("base_sha256"), F.expr(joined("all")).alias("spans"))
