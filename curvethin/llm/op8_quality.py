"""Quality classifier: Bradley-Terry pairwise ranking over text statistics.

Every text becomes ``FEATURES`` (shares of capitals, symbols and digits, repeated words and lines, word and line
lengths ...), each spread over ``KNOTS`` hinges at training quantiles. Preference pairs (a row of quality 1 preferred to
a row of quality 0) are learned by logistic loss on the difference of their features: P(a before b) =
1 / (1 + exp(-(s(a) - s(b)))). That fixes the ranking; the threshold is the quantile of the training scores at the share of
quality 0 among them, and the reported score is a logistic function of the ranking that equals ``CUT`` there.

Labels are learned only from rows outside the held-out fold. At most ``SAMPLE`` labelled rows (smallest hash of doc_id) and
``PAIRS`` pairs are used to fit; only their statistics reach the driver. Scoring covers every whole text.

Defined results: null and empty texts have all statistics 0 and a score like any other; repeated rows score alike;
further columns pass through; without labelled rows of both kinds every score is 1 (nothing was learned that could
reject a text).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as St

from curvethin.llm import textops as T

SAMPLE = 12_000
PAIRS = 40_000
KNOTS = (0.1, 0.3, 0.5, 0.7, 0.9)
CUT = 0.3
FEATURES = ["words", "letters_a_word", "capitals", "symbols", "digits", "punctuation", "bars", "shouts", "wide", "odd_ends",
            "word_repeats", "word_runs", "distinct", "lines_a_word", "line_repeats", "longest_word"]

_CLASS = np.zeros((256, 8), bool)  # lower, upper, symbol, digit, punctuation, bar, shout, wide
_CLASS[97:123, 0] = True
_CLASS[65:91, 1] = True
_CLASS[[ord(c) for c in "#$%&*@^~<>=+_\\/{}[]"], 2] = True
_CLASS[48:58, 3] = True
_CLASS[[ord(c) for c in ".,;:?'\"()-"], 4] = True
_CLASS[ord("|"), 5] = True
_CLASS[ord("!"), 6] = True
_CLASS[128:, 7] = True


def _repeats(key: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """For each document, how many of its keys it had before."""
    order = np.lexsort((key, doc))
    k, d = key[order], doc[order]
    same = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    return np.bincount(d[1:][same], minlength=n)


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text."""
    w = T.Words(data, off)
    n, count = len(off) - 1, w.counts()
    size = np.maximum(np.diff(off), 1)
    words = np.maximum(count, 1)
    doc = np.repeat(np.arange(n), count)
    chars = np.empty((n, 8))
    for k in range(8):
        total = np.concatenate([[0], np.cumsum(_CLASS[data, k])])
        chars[:, k] = total[off[1:]] - total[off[:-1]]
    letters = np.maximum(chars[:, 0] + chars[:, 1], 1)
    h = w.hashes()
    run = np.zeros(len(h), bool)
    run[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    odd = (_CLASS[data[w.end - 1], 2] | _CLASS[data[w.end - 1], 6]) if len(h) else run
    # lines by the hash of their words
    new_line = np.concatenate([[0], np.cumsum(data == 10)])
    first = np.ones(len(h), bool)
    if len(h):
        first[1:] = (doc[1:] != doc[:-1]) | (new_line[w.start[1:]] != new_line[w.end[:-1]])
    start = np.flatnonzero(first)
    line = T.mix(T.rolling(h, start, np.append(start[1:], len(h))[: len(start)]))
    lines = np.maximum(np.bincount(doc[start], minlength=n), 1)
    longest = np.zeros(n)
    np.maximum.at(longest, doc, w.end - w.start)
    repeats = _repeats(h, doc, n)
    return np.column_stack([
        np.log1p(count), (chars[:, 0] + chars[:, 1] + chars[:, 7]) / words, chars[:, 1] / letters, chars[:, 2] / size, chars[:, 3] / size,
        chars[:, 4] / size, chars[:, 5] / words, chars[:, 6] / words, chars[:, 7] / size, np.bincount(doc, odd, n) / words,
        repeats / words, np.bincount(doc, run, n) / words, (count - repeats) / np.maximum(words, 1) ** 0.5, lines / words,
        _repeats(line, doc[start], n) / lines, np.log1p(longest)])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    knots: np.ndarray  # (KNOTS, FEATURES), in scaled units
    weights: np.ndarray
    threshold: float
    slope: float

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([z, *(np.maximum(z - k, 0) for k in self.knots)])

    def rank(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * (self.rank(x) - self.threshold) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(x: np.ndarray, quality: np.ndarray, ridge: float = 3.0) -> Model | None:
    """None if the rows are all of one label."""
    good, bad = np.flatnonzero(quality == 1), np.flatnonzero(quality == 0)
    if not len(good) or not len(bad):
        return None
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    m = Model(mean, scale, np.quantile((x - mean) / scale, KNOTS, axis=0), np.zeros(0), 0.0, 1.0)
    e = m.expand(x)
    rng = np.random.default_rng(7)
    pairs = min(PAIRS, len(good) * len(bad))
    d = e[rng.choice(good, pairs)] - e[rng.choice(bad, pairs)]
    w = np.zeros(e.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(w)), d.T @ (1 - p) - ridge * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    m.weights = w
    s = m.rank(x)
    m.threshold = float(np.quantile(s, len(bad) / len(x)))
    spread = np.mean(s[good]) - np.mean(s[bad])
    m.slope = float(4 / max(spread, 1e-6))
    return m


def with_statistics(docs: DataFrame) -> DataFrame:
    """The rows with ``stats``, an array of FEATURES, instead of ``text``."""
    rest = [f for f in docs.schema.fields if f.name not in ("text", "stats")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in T.by_chunk(batches):
            x = statistics(data, off)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(f.name) for f in rest), T.lists(x.ravel(), np.full(len(x), x.shape[1]), pa.float64())], [*(f.name for f in rest), "stats"])

    return docs.select("text", *(f.name for f in rest)).mapInArrow(run, St.StructType([*rest, St.StructField("stats", St.ArrayType(St.DoubleType()))]))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """From docs (doc_id, text) and labels (doc_id, quality). At most SAMPLE labels are broadcast to the scan of the texts."""
    known = labels.where("doc_id is not null and quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    sample = known.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = with_statistics(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["stats"]))
    if not rows:
        return None
    return train(np.array([r["stats"] for r in rows]), np.array([r["quality"] for r in rows]))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows with ``score`` (0 to 1) and ``predicted`` (1 from CUT); columns of those names are replaced."""
    docs = docs.drop("score", "predicted")
    if model is None:
        return docs.withColumn("score", F.lit(1.0)).withColumn("predicted", F.lit(1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in T.by_chunk(batches):
            s = model.scores(statistics(data, off))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(s), pa.array((s >= CUT).astype(np.int32))], [*rows.schema.names, "score", "predicted"])

    schema = St.StructType([*docs.schema.fields, St.StructField("score", St.DoubleType()), St.StructField("predicted", St.IntegerType())])
    return docs.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = T.read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, T.read(spark, sf_dir, "labels").where(~T.held_out("doc_id")))
    return score(docs, model).select("doc_id", T.held_out("doc_id").alias("held_out"), "score", "predicted")
