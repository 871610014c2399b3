"""Substring dedup: Rabin-Karp hashes of every window of fixed length, counted in Spark.

``remove_repeats`` hashes every window of ``size`` words of every whole text. A window whose hash
occurs again, in any document or later in its own, is repeated; the words that repeated windows cover
are merged into maximal intervals and removed.

The counting takes two exchanges, both of hashes only:

1. Each window is represented by its *anchor*: the smallest hash of the ``SHINGLE``-word windows inside
   it. Equal windows have equal anchors at equal offsets, so a window whose anchor occurs once in the
   corpus occurs once itself. Neighbouring windows share anchors: about one row for 16 words.
2. The hashes of all windows not proven single by (1) are sorted by hash and streamed; hashes that
   occur again are repeated.

A list of rows with equal hash is streamed, never held. Before the exchange, each slice of texts finds the hashes that
occur again inside it: their rows are decided, so only one row for each such hash goes on to meet the other slices, and the
others are dealt evenly. A hash that holds a third of all rows so sends one row a slice to its task. A window's hash has 64 bits and passes
a bijective finaliser; two different windows compare equal with probability 2**-64 a pair.

Defined results: null and empty texts have no words (0, 0, hash of the empty string); texts shorter
than ``size`` words keep all; repeated rows (same doc_id and text) are separate texts and so repeat each other;
a null doc_id is a key like any other (a row many times repeated marks each of its positions once); further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvethin.llm import textops as T

SIZE = 35
SHINGLE = 5


def _anchors(h: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Position (in ``h``) of the smallest of h[i .. i + width) for each i in ``at``; the first of equals."""
    best, value = at.copy(), h[at]
    for j in range(1, width):
        other = h[at + j]
        less = other < value
        best[less] = (at + j)[less]
        value = np.where(less, other, value)
    return best


def _windows(words: T.Words, size: int):
    """Window starts, window hashes, hash of each window's anchor, anchor's position."""
    h = words.hashes()
    at, win = words.windows(size, h)
    sat, sh = words.windows(SHINGLE, h)
    dense = np.zeros(len(h), np.uint64)
    dense[sat] = sh
    where = _anchors(dense, at, size - SHINGLE + 1) if len(at) else at
    return at, win, dense[where] if len(at) else win, where


def _doc_of(words: T.Words, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(words.doc, at, "right") - 1


def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text, words joined by one space), removed (word intervals)."""
    if size < SHINGLE:
        raise ValueError(f"size must be at least {SHINGLE}")
    # one column list for both joins below, so that the exchange of the texts is made once and reused
    docs = docs.select(F.coalesce("doc_id", F.lit(T.NULL_ID)).alias("did"), F.coalesce("text", F.lit("")).alias("text"))
    docs = _tagged(docs)

    def anchor_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in T.by_chunk(batches):
            w = T.Words(data, off)
            _, _, anchor, where = _windows(w, size)
            where, first = np.unique(where, return_index=True)
            d = _doc_of(w, where)
            yield _rows(rows, d, T.signed(anchor[first]), where - w.doc[d])

    def window_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in T.by_chunk(batches):
            w = T.Words(data, off)
            at, win, _, where = _windows(w, size)
            wanted = _flat(rows.column("at"), w)
            open_ = np.zeros(int(w.doc[-1]) + 1, bool)
            open_[wanted] = True
            keep = open_[where] if len(where) else np.zeros(0, bool)
            at, win = at[keep], win[keep]
            d = _doc_of(w, at)
            yield _rows(rows, d, T.signed(win), at - w.doc[d])

    schema = "h long, did long, tag long, pos int"
    first = _repeated(docs.mapInArrow(anchor_rows, schema))
    second = _repeated(_with_positions(docs, first).mapInArrow(window_rows, schema))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in T.by_chunk(batches):
            w = T.Words(data, off)
            n = int(w.doc[-1])
            step = np.zeros(n + 1, np.int64)
            hits = np.unique(_flat(rows.column("at"), w))
            np.add.at(step, hits, 1)
            np.add.at(step, hits + size, -1)
            gone = np.cumsum(step)[:n] > 0
            raw = data.tobytes()
            kept, spans = [], []
            for i in range(rows.num_rows):
                a, b = int(w.doc[i]), int(w.doc[i + 1])
                left = np.flatnonzero(~gone[a:b]) + a
                kept.append(b" ".join([raw[s:e] for s, e in zip(w.start[left].tolist(), w.end[left].tolist())]).decode("utf-8", "replace"))
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].view(np.int8), [0]])))
                spans.append(edge.reshape(-1, 2).tolist())
            removed = np.add.reduceat(np.append(gone, 0), w.doc[:-1]) if n else np.zeros(rows.num_rows, int)
            removed = np.where(w.counts() > 0, removed, 0)
            yield pa.RecordBatch.from_arrays(
                [rows.column("did"), pa.array(w.counts(), pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                ["did", "n_words", "n_removed", "kept", "removed"])

    out = _with_positions(docs, second).mapInArrow(cut, "did long, n_words long, n_removed long, kept string, removed array<array<long>>")
    return out.select(F.expr(f"nullif(did, {T.NULL_ID}L)").alias("doc_id"), "n_words", "n_removed", "kept", "removed")


def _tagged(docs: DataFrame) -> DataFrame:
    """did, tag, text: rows are told apart by did, and where that is null or repeats, also by 64 bits of their text."""
    again = T.cut(docs.where(f"did <> {T.NULL_ID}L").groupBy("did").count().where("count > 1").select(F.col("did").alias("again")))
    own, unsure = F.xxhash64("text"), F.col("did") == F.lit(T.NULL_ID)
    n = again.count()
    if not n:
        return docs.select("did", F.when(unsure, own).otherwise(F.lit(0)).alias("tag"), "text")
    docs = docs.join(F.broadcast(again) if n <= T.FEW else again, F.col("did") == F.col("again"), "left")
    return docs.select("did", F.when(unsure | F.col("again").isNotNull(), own).otherwise(F.lit(0)).alias("tag"), "text")


def _rows(rows: pa.RecordBatch, d: np.ndarray, h: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """Rows to be counted by h. Those known to repeat have ~pos instead of pos.

    Of the rows with a hash that occurs again in this slice, the first keeps the hash and tells the other slices;
    the others get one of their own (from document and position, the same in every run), which spreads them.
    """
    did, tag = (rows.column(c).take(pa.array(d)) for c in ("did", "tag"))
    if len(h):
        _, first, inverse, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        known = count[inverse] > 1
        spread = known.copy()
        spread[first] = False
        own = T.mix(did.to_numpy().view(np.uint64) + T.mix(pos.astype(np.uint64), 3) + h.view(np.uint64), 5)
        h = np.where(spread, T.signed(own), h)
        pos = np.where(known, ~pos, pos)
    return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), did, tag, pa.array(pos, pa.int32())], ["h", "did", "tag", "pos"])


def _flat(lists: pa.Array, words: T.Words) -> np.ndarray:
    """Positions given per document, as positions in all words of the chunk."""
    lists = lists.fill_null([]) if lists.null_count else lists
    n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(words.doc[:-1], n)


def _repeated(rows: DataFrame) -> DataFrame:
    found = rows.repartition("h").sortWithinPartitions("h").mapInArrow(T.keep_repeated("h", "pos"), rows.schema)
    return found.select("did", "tag", F.expr("if(pos < 0, ~pos, pos)").alias("pos"))


def _with_positions(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Both uses share one exchange of the texts (equal plans are reused)."""
    at = found.groupBy("did", "tag").agg(F.collect_set("pos").alias("at"))
    return docs.hint("merge").join(at, ["did", "tag"], "left")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(T.read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 34, 0))) AS i FROM w),
k AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM p),
r AS (SELECT doc_id, i FROM k WHERE h IN (SELECT h FROM k GROUP BY h HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, i + j AS pos FROM r, (SELECT unnest(generate_series(0, 34)) AS j) s),
g AS (SELECT doc_id, list(pos) AS gone FROM c GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(coalesce(gone, [])) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_filter(ws, lambda x, n: NOT list_contains(coalesce(gone, []), n)), ' ')) AS kept_sha256
FROM w LEFT JOIN g ON w.doc_id = g.doc_id
"""
