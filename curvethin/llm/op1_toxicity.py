"""Toxicity: support vector machine over a gap-weighted subsequence string kernel, with Nystrom landmarks.

Kernel. A word (or a run of single spaced-out characters, taken as one word) is described by its
subsequences of three symbols with at most ``GAPS`` skipped symbols, each weighted ``DECAY ** span``. Skipped
symbols make inserted characters ("i*d*iot") and changed endings share subsequences with the plain
word. Letters are lower-cased, a word's first letter is a symbol of its own, other ASCII is one symbol, other bytes map
to the rest of 80 symbols. The kernel is divided by the lengths' own weights, so a word's kernel with itself is about 1.

Nystrom. ``LANDMARKS`` words of the training sample (those that lean most to either label) span the feature
space: features K(w, Z) K(Z, Z)^-1/2. A linear machine in that space is linear in the subsequences as well, so the
trained machine is one table of 80**3 weights, and scoring a word is a sum of look-ups.

Training. Sentences (lines, cut at ``.!?``) inherit the label of their document. The machine is first trained on
the words of all sentences by squared hinge loss, then again with each toxic document represented by its highest
sentences only, because most of its sentences are harmless. A document's score is a logistic
function of its strongest words' and sentences' decision values, fitted on the same rows.

Labels are learned only from rows outside the held-out fold. The sample is bounded: at most ``SAMPLE`` documents of
each label and ``SAMPLE_BYTES`` bytes of text, those with the smallest hash of their doc_id, and the
``VOCABULARY`` most frequent words of that sample; scoring covers every whole text.

Defined results: null and empty texts have no words and score like a text without any sign, the model's base;
repeated rows score alike; further columns pass through; without labelled rows of both kinds every score is 0
(nothing was learned that could reject a text).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as St

from curvethin.llm import textops as T

ORDER = 3
GAPS = 2
DECAY = 0.7
LANDMARKS = 512
SAMPLE = 1500
SAMPLE_BYTES = 8 << 20
VOCABULARY = 24_000
SYMBOLS = 80
PIECE = 128 << 10  # bytes of a text worked on at once
INITIAL = 26  # added to a letter that begins a word

_SYMBOL = np.concatenate([np.zeros(128, np.int64), 53 + np.arange(128) % 27])  # other bytes: 53 .. 79
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[65:91] = np.arange(1, 27)
# the skips (before the 2nd, before the 3rd symbol) that GAPS allows
_SKIPS = [(x, y) for x in range(GAPS + 1) for y in range(GAPS + 1 - x)]


def _joined(w: T.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as (start, end, document), with runs of single characters of a document joined to one word."""
    doc = np.repeat(np.arange(len(w.doc) - 1), w.counts())
    one = w.end - w.start == 1
    glue = np.zeros(len(one), bool)
    glue[1:] = one[1:] & one[:-1] & (doc[1:] == doc[:-1])
    first = np.flatnonzero(~glue)
    last = np.append(first[1:], len(one))[: len(first)] - 1
    return w.start[first], w.end[last] if len(first) else w.end, doc[first]


def _terms(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(word, subsequence, weight) for each skip pattern; ``word`` counts from 0."""
    symbol = _SYMBOL[data]
    keep = np.zeros(len(data) + 1, np.int32)
    np.add.at(keep, start, 1)
    np.add.at(keep, end, -1)
    inside = (np.cumsum(keep)[:-1] > 0) & ~T._SEP[data]
    at = np.flatnonzero(inside)
    word = np.searchsorted(start, at, "right") - 1
    s = symbol[at]
    first = np.ones(len(at), bool)
    first[1:] = word[1:] != word[:-1]
    s[first & (s > 0) & (s <= 26)] += INITIAL
    for x, y in _SKIPS:
        span = ORDER + x + y
        if len(at) < span:
            continue
        n = len(at) - span + 1
        same = word[:n] == word[span - 1:]
        code = (s[:n] * SYMBOLS + s[x + 1:x + 1 + n]) * SYMBOLS + s[span - 1:]
        yield word[:n][same], code[same], DECAY ** span


def _own(length: np.ndarray) -> np.ndarray:
    """A word's kernel with itself if no subsequence occurs twice in it: a function of its length."""
    total = np.zeros(len(length))
    for x, y in _SKIPS:
        total += np.maximum(0, length - (ORDER + x + y) + 1) * DECAY ** (2 * (ORDER + x + y))
    return total


def word_values(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The machine's value of each word; 0 for words shorter than ORDER. Long texts go in pieces of whole words."""
    value = np.zeros(len(start))
    edges = np.unique(np.append(np.searchsorted(start, np.arange(0, len(data), PIECE)), len(start)))
    for a, b in zip(edges[:-1], edges[1:]):
        low, high = start[a], end[b - 1]
        value[a:b] = _piece_values(data[low:high], start[a:b] - low, end[a:b] - low, table)
    return value


def _piece_values(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    value = np.zeros(len(start))
    for word, code, weight in _terms(data, start, end):
        value += np.bincount(word, table[code], len(start)) * weight
    own = _own(_lengths(data, start, end))
    return np.where(own > 0, value / np.sqrt(np.maximum(own, 1e-9)), 0.0)


def _lengths(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~T._SEP[data], out=inside[1:])
    return inside[end] - inside[start]


def _features(data: np.ndarray, off: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A row for each document: its strongest words and sentences, as a fixed number of figures."""
    w = T.Words(data, off)
    start, end, doc = _joined(w)
    n = len(off) - 1
    out = np.zeros((n, 5))
    if not len(start):
        return out
    v = np.maximum(word_values(data, start, end, table), 0)
    count = np.bincount(doc, minlength=n)
    sure = v * v
    out[:, 1] = np.bincount(doc, sure, n)
    np.maximum.at(out[:, 0], doc, v)
    out[:, 2] = np.bincount(doc, v > 0.5, n) / np.maximum(count, 1) ** 0.5
    out[:, 3] = out[:, 1] / np.maximum(count, 1)
    # sentences: words up to one that ends with . ! ? or a line
    stop = np.isin(data[end - 1], np.frombuffer(b".!?", np.uint8))
    line = np.zeros(len(data) + 1, np.int32)
    np.cumsum(data == 10, out=line[1:])
    cut = np.ones(len(start), bool)
    cut[1:] = stop[:-1] | (line[start[1:]] != line[end[:-1]]) | (doc[1:] != doc[:-1])
    sentence = np.cumsum(cut) - 1
    mean = np.bincount(sentence, sure) / np.bincount(sentence) ** 0.5
    np.maximum.at(out[:, 4], doc[cut], mean)
    return np.log1p(out * [1, 1, 4, 20, 1])


@dataclass
class Model:
    table: np.ndarray  # weight of each subsequence
    scale: np.ndarray  # of the document features
    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        z = _features(data, off, self.table) / self.scale @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


# --- training on the driver, over the bounded sample -----------------------------------------------------

def _pack(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), off


def _matrix(words: list[str]):
    """Rows (word, subsequence, value) of the normalised kernel map of some words."""
    data, off = _pack(words)
    w, c, x = [], [], []
    for word, code, weight in _terms(data, off[:-1], off[1:]):
        w.append(word)
        c.append(code)
        x.append(np.full(len(word), weight))
    if not w:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    w, c, x = np.concatenate(w), np.concatenate(c), np.concatenate(x)
    own = np.sqrt(np.maximum(_own(np.diff(off)), 1e-9))
    return w, c, x / own[w]


def _products(words: list[str], row_of: np.ndarray, dense: np.ndarray, root: np.ndarray) -> np.ndarray:
    """K(words, landmarks) root, in pieces. row_of: row of ``dense`` for a subsequence, -1 if no landmark has it."""
    out = np.zeros((len(words), root.shape[1]), np.float32)
    for i in range(0, len(words), 200):
        w, c, x = _matrix(words[i:i + 200])
        known = row_of[c] >= 0
        w, c, x = w[known], c[known], x[known].astype(np.float32)
        order = np.argsort(w, kind="stable")
        w, c, x = w[order], c[order], x[order]
        if len(w):
            row, first = np.unique(w, return_index=True)
            terms = dense[row_of[c]]
            terms *= x[:, None]
            out[i + row] = np.add.reduceat(terms, first, axis=0) @ root
    return out


def _svm(x: np.ndarray, yes: np.ndarray, no: np.ndarray, ridge: float, steps: int = 25) -> np.ndarray:
    """Squared hinge loss by Newton steps on the violating rows; each row counts ``yes`` as +1 and ``no`` as -1."""
    beta = np.zeros(x.shape[1] + 1)
    reg = np.full(len(beta), ridge)
    reg[-1] = 1e-6
    for _ in range(steps):
        f = x @ beta[:-1].astype(x.dtype) + beta[-1]
        up, down = yes * (f < 1), no * (f > -1)
        h, g = np.diag(reg), np.zeros(len(beta))
        for k in range(0, len(x), 2000):
            part = np.hstack([x[k:k + 2000], np.ones((len(x[k:k + 2000]), 1), x.dtype)]).astype(float)
            h += (part * (up + down)[k:k + 2000, None]).T @ part
            g += part.T @ (up - down)[k:k + 2000]
        new = np.linalg.solve(h, g)
        if np.abs(new - beta).max() < 1e-6:
            break
        beta = new
    return beta[:-1]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    x1 = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x1.shape[1])
    reg = np.diag([ridge] * (x1.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ beta, -30, 30)))
        h = (x1 * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ x1 + reg
        step = np.linalg.solve(h, x1.T @ (y - p) - reg @ beta)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-7:
            break
    return beta


_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SENTENCE = re.compile(r"[^\n.!?]+")


def _words(text: str, one: dict[str, str]) -> list[str]:
    """Lower-cased words, equal words as one object; ``one`` goes when training ends."""
    return [one.setdefault(w, w) for w in _WORD.findall(text.lower())]


def train(texts: list[str], labels: np.ndarray, odds: float | None = None) -> Model | None:
    """None if the rows are all of one label. odds: toxic to other rows among all labels, which the sample balances."""
    labels = np.asarray(labels, float)
    pos, neg = int((labels == 1).sum()), int((labels == 0).sum())
    if not pos or not neg:
        return None
    one: dict[str, str] = {}
    sentences = [[_words(s, one) for s in _SENTENCE.findall(t)] for t in texts]
    del one
    table = None
    for _ in range(2):
        table = _train_table(sentences, labels, table, pos, neg)
    x = np.vstack([_features(d, o, table) for _, _, d, o in T.chunks(pa.array(texts, pa.string()))])
    scale = np.maximum(x.std(axis=0), 1e-6)
    beta = _logistic(x / scale, labels)
    shift = np.log(odds * neg / pos) if odds else 0.0
    return Model(table.astype(np.float32), scale, beta[:-1], float(beta[-1] + shift))


def _train_table(sentences: list, labels: np.ndarray, table: np.ndarray | None, pos: int, neg: int) -> np.ndarray:
    """The subsequence weights. With a table from before, a toxic document counts by its highest sentences only."""
    yes, no = Counter(), Counter()
    for parts, label in zip(sentences, labels):
        if label == 1 and table is not None and len(parts) > 3:
            flat = pa.array([" ".join(p) for p in parts], pa.string())
            value = np.concatenate([_features(d, o, table)[:, 4] for _, _, d, o in T.chunks(flat)])
            best = np.argsort(-value, kind="stable")[: max(3, len(parts) // 4)]
            parts = [parts[i] for i in sorted(best)]
        (yes if label == 1 else no).update({w for p in parts for w in p if len(w.encode()) >= ORDER})
    vocabulary = sorted((w for w in yes.keys() | no.keys() if yes[w] + no[w] >= 2), key=lambda w: (-yes[w] - no[w], w))[:VOCABULARY]
    vocabulary.sort()
    if not vocabulary:
        vocabulary = sorted(yes.keys() | no.keys())[:1000] or ["none"]
    a = np.array([yes[w] for w in vocabulary], float)
    b = np.array([no[w] for w in vocabulary], float)
    lean = (a / pos - b / neg) / np.sqrt((a + b + 1) / (pos + neg))
    rank = np.argsort(lean, kind="stable")
    half = LANDMARKS // 2
    spread = rank[:-half][np.linspace(0, max(0, len(rank) - half - 1), half).astype(int)] if len(rank) > half else rank[:0]
    chosen = sorted({*rank[-half:].tolist(), *spread.tolist()})
    marks = [vocabulary[i] for i in chosen]
    w, c, x = _matrix(marks)
    used, row = np.unique(c, return_inverse=True)
    row_of = np.full(SYMBOLS ** ORDER, -1, np.int32)
    row_of[used] = np.arange(len(used))
    dense = np.zeros((len(used), len(marks)), np.float32)
    np.add.at(dense, (row, w), x)
    weights = np.zeros(SYMBOLS ** ORDER)
    if not len(used):
        return weights
    gram = dense.astype(float).T @ dense
    value, vector = np.linalg.eigh(gram)
    good = value > value.max() * 1e-5
    root = (vector[:, good] / np.sqrt(value[good])).astype(np.float32)  # Nystrom: features = K(., Z) root
    features = _products(vocabulary, row_of, dense, root)
    scale = 1000 / (a.sum() / pos + b.sum() / neg)
    beta = _svm(features, a / pos * scale, b / neg * scale, ridge=18 / pos)  # fewer toxic documents, smoother
    # the bias is the same for every word: the document's logistic function has its own
    weights[used] = dense @ (root @ beta)
    return weights


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """From docs (doc_id, text) and labels (doc_id, toxic); the sample is bounded as described above.

    The sample is chosen among the labels, so only its rows (at most 2 * SAMPLE) are broadcast to the scan of the texts.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropDuplicates(["doc_id"])
    known = known.withColumn("k", F.xxhash64("doc_id"))
    sample = reduce(DataFrame.unionByName, [known.where(F.col("toxic") == t).orderBy("k").limit(SAMPLE) for t in (0, 1)])
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    # sizes first, so that the texts fetched are within the bound whatever their lengths
    sizes = rows.select("doc_id", "toxic", "k", F.octet_length("text").alias("bytes")).collect()
    chosen = []
    for label in (0, 1):
        room = SAMPLE_BYTES // 2
        for r in sorted((r for r in sizes if r["toxic"] == label), key=lambda r: (r["k"], r["bytes"])):
            if r["bytes"] <= room:
                room -= r["bytes"]
                chosen.append(r["doc_id"])
    if not chosen:
        return None
    ids = docs.sparkSession.createDataFrame([(i,) for i in sorted(set(chosen))], "doc_id long")
    got = rows.join(F.broadcast(ids), "doc_id", "left_semi").select("k", "text", "toxic").collect()
    got.sort(key=lambda r: (r["toxic"], r["k"], r["text"]))
    count = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    odds = count.get(1, 0) / max(count.get(0, 0), 1)
    return train([r["text"] for r in got], np.array([r["toxic"] for r in got]), odds)


def fit_tables(spark: SparkSession, sf_dir: str) -> Model | None:
    labels = T.read(spark, sf_dir, "labels").select("doc_id", "toxic")
    return fit(T.read(spark, sf_dir, "documents").select("doc_id", "text"), labels.where(~T.held_out("doc_id")))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows with ``score`` (0 to 1) and ``predicted`` (1 from 0.5); columns of those names are replaced."""
    docs = docs.drop("score", "predicted")
    if model is None:
        return docs.withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: the table and a few weights

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in T.by_chunk(batches):
            s = shared.value.scores(data, off)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*rows.schema.names, "score", "predicted"])

    schema = St.StructType([*docs.schema.fields, St.StructField("score", St.DoubleType()), St.StructField("predicted", St.IntegerType())])
    return docs.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = T.read(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, fit_tables(spark, sf_dir))
    return out.select("doc_id", T.held_out("doc_id").alias("held_out"), "score", "predicted")
