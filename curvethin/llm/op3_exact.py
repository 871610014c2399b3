"""Exact dedup: static binary-fuse filters over immutable snapshots screen incoming digests.

``ingest`` takes a snapshot (never changed afterwards) and an incoming batch:

1. Digests of the whitespace-normalised texts, grouped on each side with map-side partial counts. Copies
   inside the batch are found here, without the snapshot.
2. ``build_filters``: the snapshot's distinct digests are dealt to shards of about ``SHARD_KEYS`` keys, and
   each shard gets one 3-wise binary fuse filter with 8-bit fingerprints (about 9 bits a key).
3. ``screen``: the batch's distinct digests meet the filter of their shard, in slices of about ``SHARD_KEYS`` digests
   however much larger than the snapshot the batch is. No false negatives; about one in 256 absent digests passes.
4. Positives join the snapshot's exact buckets by whole digest. Then the bytes are checked: the texts of
   all rows whose digest occurs more than once are grouped by (digest, text) itself, so only equal bytes
   share a group, and partial aggregation leaves one row of a hot text per task. The rows are found by a semi-join on an
   8-byte key of the digest: broadcast while the keys are few, else shuffled with ``SALT`` copies of each key, so that the
   copies of one text never meet in one task before they are aggregated.

Defined results: null text counts as empty, and empty texts are equal to each other; the row with the
smallest doc_id of a group stays (nulls last); rows that repeat in doc_id and text count in group_size, all
say ``kept``, and ``dedup`` returns one of them; further columns pass through ``dedup``; empty tables
give no rows.
"""

from __future__ import annotations

import math
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curvethin.llm import textops as T

SHARD_KEYS = 1 << 18
SALT = 64


def normalised(text: Column | str) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest (32 bytes), tag: tag splits the texts of one digest, should two ever share it."""
    t = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    return t.select("doc_id", F.unhex(F.sha2("norm", 256)).alias("digest"), F.xxhash64("norm").alias("tag"))


# --- binary fuse filter ---------------------------------------------------------------------------------

def _slots(keys: np.ndarray, seed: int, length: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Three slots in consecutive segments for each key, and its fingerprint."""
    h = T.mix(keys, seed)
    first = ((h >> np.uint64(32)) * np.uint64(segments * length)) >> np.uint64(32)
    mask = np.uint64(length - 1)
    where = np.stack([first, (first + np.uint64(length)) ^ ((h >> np.uint64(18)) & mask), (first + np.uint64(2 * length)) ^ (h & mask)])
    return where.astype(np.int64), ((h ^ (h >> np.uint64(40))) & np.uint64(255)).astype(np.uint8)


def fuse_build(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, table) of a filter that holds all ``keys`` (distinct uint64).

    Keys are peeled in rounds, each round as one array operation: every slot that only one key uses frees that
    key. Slots are filled in reverse order, so each key's own slot is set after its other two.
    """
    n = max(len(keys), 2)
    length = min(1 << max(2, int(math.log(n) / math.log(3.33) + 2.25)), 1 << 18)
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    segments = max(1, math.ceil(n * factor / length) - 2)
    size = (segments + 2) * length
    for seed in range(1, 1000):
        where, print_ = _slots(keys, seed, length, segments)
        uses = np.bincount(where.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)  # xor of the keys (by number) that still use the slot
        number = np.arange(len(keys))
        for w in where:
            np.bitwise_xor.at(owner, w, number)
        rounds, left = [], len(keys)
        while left:
            single = np.flatnonzero(uses == 1)
            if not len(single):
                break
            who, pick = np.unique(owner[single], return_index=True)
            rounds.append((who, single[pick]))
            left -= len(who)
            for w in where[:, who]:
                np.subtract.at(uses, w, 1)
                np.bitwise_xor.at(owner, w, who)
        if left:
            continue
        table = np.zeros(size, np.uint8)
        for who, slot in reversed(rounds):
            a, b, c = table[where[:, who]]
            table[slot] = print_[who] ^ a ^ b ^ c ^ table[slot]  # its own slot is among the three
        return seed, length, segments, table.tobytes()
    raise RuntimeError("no seed peels these keys; are they distinct?")


def fuse_contains(keys: np.ndarray, seed: int, length: int, segments: int, table: bytes) -> np.ndarray:
    where, print_ = _slots(keys, seed, length, segments)
    t = np.frombuffer(table, np.uint8)
    return (t[where[0]] ^ t[where[1]] ^ t[where[2]]) == print_


def _keys(digest: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(d)[:8] for d in digest), np.uint64)


def build_filters(index: DataFrame, shards: int) -> DataFrame:
    """One filter for each shard of a snapshot's distinct digests."""

    def build(key: Any, rows: pd.DataFrame) -> pd.DataFrame:
        seed, length, segments, table = fuse_build(np.unique(_keys(rows["digest"])))
        return pd.DataFrame({"shard": [key[0]], "seed": [seed], "length": [length], "segments": [segments], "cells": [table]})

    return index.select(_shard(shards), "digest").groupBy("shard").applyInPandas(build, "shard long, seed int, length int, segments int, cells binary")


def screen(digests: DataFrame, filters: DataFrame, shards: int, slices: int = 1) -> DataFrame:
    """The distinct digests that the filters don't rule out; a shard's digests meet its filter in ``slices`` tasks."""

    def test(rows: pd.DataFrame, filter_: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(filter_):
            return pd.DataFrame({"digest": pd.Series([], dtype=object)})
        f = filter_.iloc[0]
        hit = fuse_contains(_keys(rows["digest"]), int(f.seed), int(f.length), int(f.segments), f.cells)
        return rows.loc[hit, ["digest"]]

    left = digests.select(_shard(shards), F.pmod(F.hash("digest"), F.lit(slices)).alias("slice"), "digest").groupBy("shard", "slice")
    right = filters.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).groupBy("shard", "slice")
    return left.cogroup(right).applyInPandas(test, "digest binary")


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard")


def _of_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows (doc_id, k, ...) whose k is in ``keys``, without gathering the rows of one k."""
    keys = T.cut(keys.distinct())
    if keys.count() <= T.FEW:
        return rows.join(F.broadcast(keys), "k", "left_semi")
    salted = keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return rows.withColumn("salt", F.pmod(F.hash("doc_id"), F.lit(SALT))).join(salted, ["k", "salt"], "left_semi").drop("salt")


# --- dedup ----------------------------------------------------------------------------------------------

def ingest(snapshot: DataFrame, incoming: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for the rows of both."""
    old = _digests(snapshot).withColumn("new", F.lit(False))
    both = T.cut(old.unionByName(_digests(incoming).withColumn("new", F.lit(True))))
    index = both.where("not new").groupBy("digest").agg(F.count("*").alias("n"))
    batch = both.where("new").groupBy("digest").agg(F.count("*").alias("n"))
    rows = {r["new"]: r["count"] for r in both.groupBy("new").count().collect()}  # at most two rows
    shards = max(1, math.ceil(rows.get(False, 0) / SHARD_KEYS))
    slices = max(1, math.ceil(rows.get(True, 0) / (shards * SHARD_KEYS)))
    positive = screen(batch, build_filters(index, shards), shards, slices)
    shared = positive.join(index.select("digest"), "digest", "left_semi")  # the exact buckets
    within = index.where("n > 1").select("digest").unionByName(batch.where("n > 1").select("digest"))
    several = shared.unionByName(within).select(F.xxhash64("digest").alias("k"))

    texts = snapshot.select("doc_id", "text").unionByName(incoming.select("doc_id", "text"))
    texts = texts.select("doc_id", normalised(F.col("text")).alias("norm"))
    texts = texts.select("doc_id", "norm", F.unhex(F.sha2("norm", 256)).alias("digest")).withColumn("k", F.xxhash64("digest"))
    groups = (_of_keys(texts, several).groupBy("digest", "norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
              .select("digest", F.xxhash64("norm").alias("tag"), "keep_id", "group_size"))
    out = both.join(groups, ["digest", "tag"], "left")
    keep = F.coalesce("keep_id", "doc_id")
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
                      keep.eqNullSafe(F.col("doc_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def halves(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A table that has no snapshot yet is taken as one and a batch, dealt by doc_id; the result is the same for any deal."""
    side = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    return docs.where(side == 0), docs.where(side == 1)


def dedup(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns, whatever their names."""
    taken = {c.lower() for c in docs.columns}
    did, sha, stays = (next(n for n in (f"_{name}{'_' * k}" for k in range(len(taken) + 1)) if n not in taken) for name in ("did", "sha", "kept"))
    found = ingest(*halves(docs)).where("group_size > 1")
    id_ = F.coalesce("doc_id", F.lit(T.NULL_ID)).alias(did)
    marks = found.select(id_, F.col("text_sha256").alias(sha), F.col("kept").alias(stays)).distinct()
    rows = docs.select("*", id_, F.sha2(normalised(F.col("text")), 256).alias(sha))
    rows = rows.join(marks, [did, sha], "left")
    single = rows.where(F.col(stays).isNull()).select(*docs.columns)
    return single.unionByName(rows.where(stays).dropDuplicates([did, sha]).select(*docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest(*halves(T.read(spark, sf_dir, "documents")))


ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""
