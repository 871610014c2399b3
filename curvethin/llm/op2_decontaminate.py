"""Benchmark decontamination by SimHash over item-sized windows, with DataFrame functions only.

A document is contaminated by a benchmark item of n words when one of its windows of n words has a
weighted Jaccard similarity (5-word shingles, weighted by how often they occur) of at least ``SIMILARITY``
to the item.

1. Documents and items become arrays of shingle hashes (lower-cased words between ``[\\x20\\x09-\\x0D]+``).
   The places of shingles that some item has are found first, by hash; only texts with such a place are read again for
   the windows around them, ``HITS`` places at a time, so a text's cost grows with its length and its shared places.
2. A window that shares no shingle with an item has similarity 0. Moving a window to the right until it begins
   with a shared shingle never lowers its similarity, so windows that begin with one (or end with the document)
   are enough. Each such window keeps the length of the item, and equal windows of all documents are one content.
3. Contents and items get 64-bit SimHash fingerprints: sums per bit, packed as 32-bit lanes of 32 longs.
4. Multi-index Hamming blocks: 64 bits in ``RADIUS + 1`` blocks; fingerprints within ``RADIUS`` bits agree in one
   block at least, so the join on (length, block number, block) misses none of them. By the angle model (each bit differs with
   the angle's share of a half turn) a window at exactly ``SIMILARITY`` lies beyond the radius once in 500 million.
5. Exact weighted-shingle similarity verifies each candidate.

The benchmark is met in blocks of consecutive items, cut by their running number of words: a block has at most
``BLOCK_SHINGLES`` words more than its last item, and its distinct shingles are broadcast under that bound. Documents are scanned
once for each block; only those with a shared place can be shuffled.

Defined results: null, empty and wordless texts hold no passage; items of fewer than 5 words have one shingle, their
whole sequence; a document shorter than an item is compared whole; several rows of a doc_id are reported together,
with the best window; repeated items are reported each; a null doc_id or item_id is reported as null; further
columns are ignored by ``matches`` and kept by ``clean``, which removes a row by its own text, whatever other rows of its
doc_id (or of the null doc_id) hold; empty tables give no matches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvethin.llm import textops as T

SIZE = 5
SIMILARITY = 0.75
RADIUS = 31
BLOCK_SHINGLES = 500_000  # at most 32 MB as a broadcast hash table
LANES = 32
HITS = 1000


def words(text: Column) -> Column:
    """Lower-cased words; no text or only separators give [''], which has no shingle below."""
    return F.split(F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+")


def _shingles(rows: DataFrame, size: int) -> DataFrame:
    """Adds ``hs``: hashes of the windows of ``size`` words, in order.

    The words are bound to a lambda variable (the one element of an array), so that they are split and hashed once;
    as a column, the optimiser would inline them into the loop over the windows.
    """
    one = "xxhash64(" + ", ".join(f"w[i + {k}]" for k in range(size)) + ")"
    empty = f"size(w) < {size} or (size(w) = 1 and w[0] = xxhash64(''))"
    loop = f"if({empty}, cast(array() as array<bigint>), transform(sequence(0, size(w) - {size}), i -> {one}))"
    rows = rows.withColumn("_w", F.array(F.transform(words(F.col("text")), lambda w: F.xxhash64(w))))
    return rows.withColumn("hs", F.expr(f"transform(_w, w -> {loop})[0]")).drop("_w")


def _simhash(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """keys, fp from rows (keys, h): bit b is set when more than half of the hashes have it.

    Cut here, because the blocks use fp many times and the optimiser would repeat its 64 cases in each.
    """
    mask = F.lit(0x0000000100000001)
    sums = [F.sum(F.shiftrightunsigned("h", k).bitwiseAND(mask)).alias(f"s{k}") for k in range(LANES)]
    g = shingles.groupBy(*keys).agg(F.count("*").alias("m"), *sums)
    bits = []
    for k in range(LANES):
        for lane in range(64 // LANES):
            b = k + LANES * lane
            value = (1 << b) - (1 << 64 if b == 63 else 0)
            bits.append(F.when(F.shiftrightunsigned(f"s{k}", LANES * lane).bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > F.col("m"), F.lit(value)).otherwise(F.lit(0)))
    return T.cut(T.cut(g).select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long").alias("fp")))


def _blocks(fp: str) -> Column:
    """The fingerprint's RADIUS + 1 blocks as an array of (number, bits) structs."""
    n, out, at = RADIUS + 1, [], 0
    for k in range(n):
        width = 64 // n + (k < 64 % n)
        out.append(F.struct(F.lit(k).alias("no"), F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1)).alias("bits")))
        at += width
    return F.array(*out)


def _match_block(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """did, tag (hash of the text), item, start, similarity for one block of items (item, n, hs) with shingles of ``size`` words."""
    spots = items.select("item", "n", F.explode("hs").alias("h"))
    probe = spots.groupBy("h").agg(F.collect_set("n").alias("ns"))
    docs = docs.select(F.coalesce("doc_id", F.lit(T.NULL_ID)).alias("did"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"), "text")
    places = (_shingles(docs, size).select("did", "tag", F.posexplode("hs").alias("p", "h"))
              .join(F.broadcast(probe), "h").select("did", "tag", F.explode("ns").alias("n"), "p"))
    places = T.cut(places.groupBy("did", "tag").agg(F.collect_set(F.struct("p", "n")).alias("at")))
    touched = docs.join(T.sized(places.select("did", "tag")), ["did", "tag"], "left_semi").join(places, ["did", "tag"])
    # equal windows of a text are told before they are cut out: those of its last shared places begin alike
    start = f"greatest(least(x.p, size(hs) - (x.n - {size - 1})), 0)"
    spots_of = f"array_distinct(transform(at, x -> cast(x.n as bigint) * {1 << 32} + {start}))"
    some = F.expr(f"transform(array({spots_of}), s -> transform(sequence(0, size(s) - 1, {HITS}), i -> slice(s, i + 1, {HITS})))[0]")
    touched = _shingles(touched, size).select("did", "tag", "hs", F.explode(some).alias("some"))
    n, at = f"cast(x div {1 << 32} as int)", f"cast(x % {1 << 32} as int)"
    window = f"named_struct('n', {n}, 'start', {at}, 'part', slice(hs, {at} + 1, {n} - {size - 1}))"
    seen = touched.select("did", "tag", F.explode(F.expr(f"transform(some, x -> {window})")).alias("w")).select("did", "tag", "w.*")
    seen = T.cut(seen.withColumn("content", F.xxhash64("part")).distinct())

    contents = seen.groupBy("n", "content").agg(F.first("part").alias("part"))
    tokens = contents.select("n", "content", F.explode("part").alias("h"))
    left = _simhash(tokens, ["n", "content"]).select("n", "content", "fp", F.explode(_blocks("fp")).alias("block"))
    right = (_simhash(spots, ["item", "n"])
             .select("item", F.col("n").alias("n2"), F.col("fp").alias("fp2"), F.explode(_blocks("fp")).alias("block2")))
    near = (left.join(right, (F.col("n") == F.col("n2")) & (F.col("block") == F.col("block2")))
            .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= RADIUS).select("n", "content", "item").distinct())

    weight = tokens.groupBy("n", "content", "h").agg(F.count("*").alias("c"))
    total = tokens.groupBy("n", "content").agg(F.count("*").alias("m"))
    weight2 = spots.groupBy("item", "h").agg(F.count("*").alias("c2"))
    common = (near.join(weight, ["n", "content"]).join(weight2, ["item", "h"]).groupBy("n", "content", "item")
              .agg(F.sum(F.least("c", "c2")).alias("i")).join(total, ["n", "content"]))
    sure = common.withColumn("similarity", F.col("i") / (F.col("m") + F.col("n") - size + 1 - F.col("i"))).where(F.col("similarity") >= SIMILARITY)
    return seen.join(sure.select("n", "content", "item", "similarity"), ["n", "content"]).select("did", "tag", "item", "start", "similarity")


def _found(docs: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """did, tag, item, start, similarity of every match; None without items."""
    docs = docs.select("doc_id", "text")
    texts = benchmark.select(F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("item"), "text").distinct()
    texts = texts.withColumn("n", F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.size(words(F.col("text")))).otherwise(0)).where("n > 0")
    # one row (item, length) for each item of the benchmark
    ids = texts.select("item", F.least("n", F.lit(SIZE)).alias("size"), "n")
    before = F.sum("n").over(Window.partitionBy("size").orderBy("item").rowsBetween(Window.unboundedPreceding, -1))
    blocks = T.cut(ids.select(F.col("item").alias("in_block"), "size", F.floor(F.coalesce(before, F.lit(0)) / BLOCK_SHINGLES).alias("block")))
    found = []
    for r in blocks.select("size", "block").distinct().orderBy("size", "block").collect():  # one row a block
        mine = blocks.where((F.col("size") == r["size"]) & (F.col("block") == r["block"])).select(F.col("in_block").alias("item"))
        items = _shingles(texts.join(mine, "item", "left_semi"), r["size"]).select("item", "n", "hs")
        found.append(_match_block(docs, items, r["size"]))
    return reduce(DataFrame.unionByName, found) if found else None


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, start (first word of the best window; the first of equals)."""
    names = benchmark.select("item_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("item"))
    found = _found(docs, benchmark)
    if found is None:
        return docs.select("doc_id").join(names.select("item_id"), F.lit(False)).select("doc_id", "item_id", F.lit(0.0).alias("similarity"), F.lit(0).alias("start"))
    best = found.groupBy("did", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("at"))
    return best.join(names, "item").select(F.expr(f"nullif(did, {T.NULL_ID}L)").alias("doc_id"), "item_id", "at.similarity", (-F.col("at.back")).alias("start"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose own text holds no passage of the benchmark, with all their columns."""
    found = _found(docs, benchmark)
    if found is None:
        return docs
    gone = T.sized(found.select(F.col("did").alias("_gone"), F.col("tag").alias("_tag")).distinct())
    mine = (F.coalesce(docs["doc_id"], F.lit(T.NULL_ID)) == gone["_gone"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["_tag"])
    return docs.join(gone, mine, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(T.read(spark, sf_dir, "documents"), T.read(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM benchmark),
s AS (SELECT doc_id, p, array_to_string(ws[p + 1:p + 5], ' ') AS h, len(ws) AS words
  FROM (SELECT *, unnest(generate_series(0, len(ws) - 5)) AS p FROM w WHERE len(ws) >= 5)),
t AS (SELECT item_id, array_to_string(ws[p + 1:p + 5], ' ') AS h, len(ws) AS n
  FROM (SELECT *, unnest(generate_series(0, len(ws) - 5)) AS p FROM b WHERE len(ws) >= 5)),
c AS (SELECT DISTINCT s.doc_id, t.item_id, t.n, greatest(least(s.p, s.words - t.n), 0) AS start FROM s JOIN t ON s.h = t.h),
a AS (SELECT c.doc_id, c.item_id, c.n, c.start, s.h, count(*) AS k FROM c JOIN s ON s.doc_id = c.doc_id AND s.p BETWEEN c.start AND c.start + c.n - 5 GROUP BY ALL),
m AS (SELECT doc_id, item_id, start, sum(k) AS m FROM a GROUP BY ALL),
x AS (SELECT item_id, h, count(*) AS k FROM t GROUP BY ALL),
i AS (SELECT a.doc_id, a.item_id, a.n, a.start, sum(least(a.k, x.k)) AS i FROM a JOIN x ON a.item_id = x.item_id AND a.h = x.h GROUP BY ALL),
r AS (SELECT i.doc_id, i.item_id, i.start, i.i / (m.m + i.n - 4 - i.i) AS similarity FROM i JOIN m USING (doc_id, item_id, start))
SELECT doc_id, item_id, similarity, CAST(min(start) AS INTEGER) AS start FROM r
WHERE similarity >= 0.75 AND similarity = (SELECT max(similarity) FROM r q WHERE q.doc_id = r.doc_id AND q.item_id = r.item_id)
GROUP BY ALL
"""
