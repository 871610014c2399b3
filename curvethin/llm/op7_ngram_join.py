"""N-gram Jaccard join by T-occurrence search, and one representative for each group.

Two documents with sets of ``a`` and ``b`` distinct shingles link when they share at least
T(a, b) = ceil(r * (a + b) / (1 + r)) of them (r = 3/4: 100 * |A n B| >= 75 * |A u B|). ``links`` finds all links
between different sets; equal sets are one class from the start.

1. ``shingle_sets``: every whole text to its set of 64-bit shingle hashes; classes of equal sets.
2. A class posts the ``q(n)`` smallest hashes of its set. If A and B link, at most a - T of A's and b - T of B's
   hashes are not shared, so their posted sets share at least ``overlap(a, b)`` >= 1 hashes (proof at ``overlap``).
3. The posted hashes are sorted and streamed: lists of one entry vanish. A class of n needs at least ``least(n)``
   hashes that occur again, whatever its partner's size; the others have no partner and leave.
4. DivideSkip over the whole sets of those that remain. Their inverted lists are built the same way. A class that does not
   share T hashes with all sets of any one size class together has no partner and leaves. With T(n) = ceil(3n / 4), the
   least for any partner, its T(n) - 1 longest lists are not merged: a partner that is
   in none of the others cannot reach the overlap, so what the long lists hold is only probed.
5. Merging: in ``ROUNDS`` rounds each list offers one member against the rest (a star, linear in the list), the first time
   the member whose hashes are the most common. Verified links join classes to components, and lists
   within one component are done. Then all pairs of a list that are still in different components are offered. Pairs in one
   component add no link that the result needs, so a group of copies costs its size, not its square.
6. Probing: each offered pair is verified exactly, by binary search of the smaller set's hashes in the larger's.

Nothing is capped, and no list is held by a task: lists are streamed or joined by Spark, which splits skewed keys.

Defined results: null, empty and wordless texts have an empty set, link with nothing and are their own
component; texts shorter than ``SIZE`` words have one shingle, the whole sequence; repeated rows are
one class; rows that share a doc_id but not a text link wherever one of them does; a null doc_id gets the component of
a document with an equal set (null if there is none); further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvethin.llm import textops as T
from curvethin.llm.graph import components

SIZE = 5
ROUNDS = 2
STEP = 1.0125  # between size classes


def posted(n: np.ndarray) -> np.ndarray:
    """q(n): how many of its smallest hashes a set of n posts. Above a third, overlap() leaves room to rule classes out."""
    return np.minimum(n, (n * 37) // 100 + 2)


def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """T(a, b): the smallest intersection with 100 * i >= 75 * (a + b - i)."""
    return -((-3 * (a + b)) // 7)


def overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Posted hashes that linked sets of a and b hashes share at least.

    Of A's first k hashes at most a - T are not in B. A shared one among them has at most b - T of B's other
    hashes before it besides those shared ones, so for k = q(b) - (b - T) it is posted by B too. The same holds with A
    and B exchanged. The smallest shared hash is posted by both in any case.
    """
    t = shared(a, b)
    one = np.minimum(posted(a), posted(b) - (b - t)) - (a - t)
    two = np.minimum(posted(b), posted(a) - (a - t)) - (b - t)
    return np.maximum(1, np.maximum(one, two))


def least(n: int) -> int:
    """The smallest overlap with a partner of any size that can link."""
    b = np.arange(-(-3 * n // 4), 4 * n // 3 + 1)
    return int(overlap(np.full(len(b), n), b).min())


def _sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order (as uint64), and how many each has."""
    w = T.Words(data, off, lower=True)
    h = w.hashes()
    at, sh = w.windows(SIZE, h)
    doc = np.searchsorted(w.doc, at, "right") - 1
    short = np.flatnonzero((w.counts() > 0) & (w.counts() < SIZE))
    if len(short):
        whole = T.mix(T.rolling(h, w.doc[short], w.doc[short + 1]), SIZE) + w.counts()[short].astype(np.uint64)
        doc, sh = np.concatenate([doc, short]), np.concatenate([sh, whole])
    order = np.lexsort((sh, doc))
    doc, sh = doc[order], sh[order]
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])
    return sh[new], np.bincount(doc[new], minlength=len(off) - 1)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n, s1, s2 (128-bit signature of the set), head: the posted hashes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in T.by_chunk(batches):
            sh, n = _sets(data, off)
            end = np.cumsum(n)
            start = end - n
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(T.mix(sh, seed))]) for seed in (11, 23)]
            s1, s2 = (T.signed(s[end] - s[start]) for s in sums)
            q = posted(n)
            first = np.repeat(start - (np.cumsum(q) - q), q) + np.arange(q.sum())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(s1), pa.array(s2), T.lists(T.signed(sh[first]), q, pa.int64())],
                ["doc_id", "n", "s1", "s2", "head"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, s1 long, s2 long, head array<long>")


def _whole_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, cells): the whole set as sorted uint64 bytes, for the rows whose doc_id is in ``ids``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in T.by_chunk(batches):
            sh, n = _sets(data, off)
            end = np.cumsum(n).tolist()
            cells = [sh[e - k:e].tobytes() for e, k in zip(end, n.tolist())]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(cells, pa.binary())], ["id", "cells"])

    wanted = docs.select("doc_id", "text").join(T.sized(ids.select(F.col("id").alias("doc_id"))), "doc_id", "left_semi")
    return wanted.mapInArrow(run, "id long, cells binary")


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, exactly."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yes = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                found = np.searchsorted(y, x)
                hits = int((y[np.minimum(found, len(y) - 1)] == x).sum())
                yes.append(100 * hits >= 75 * (len(x) + len(y) - hits))
            yield batch.filter(pa.array(yes, pa.bool_())).select(["a", "b"])

    x = sets.select(F.col("id").alias("a"), F.col("cells").alias("x"))
    y = sets.select(F.col("id").alias("b"), F.col("cells").alias("y"))
    # each offered pair moves one set: that of its member b, to the star's centre a
    return pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _again(entries: DataFrame) -> DataFrame:
    """The entries (h, ...) of lists with at least two."""
    rows = entries.repartition("h").sortWithinPartitions("h")
    return rows.mapInArrow(T.keep_repeated("h"), rows.schema)


def _candidates(reps: DataFrame) -> DataFrame:
    """The classes (id) that post enough hashes that others post too."""

    @F.pandas_udf("long")
    def needs(n: pd.Series) -> pd.Series:
        return n.map({v: least(int(v)) for v in n.unique()})

    again = _again(reps.where("n > 0").select("id", "n", F.explode("head").alias("h")))
    return again.groupBy("id", "n").agg(F.count("*").alias("k")).where(F.col("k") >= needs("n")).select("id").distinct()


def _size_class(n: str) -> str:
    return f"int(floor(ln({n}) / ln({STEP}) + 1e-9))"


def _possible(again: DataFrame) -> DataFrame:
    """Classes (id) that share enough hashes with the sets of some size together.

    Sizes are put in classes ``STEP`` apart (so a list has a bounded number of them). A class of n links with a set of
    size class c only if at least T(n, smallest size in c) of its hashes occur in other sets of that size class.
    """
    whole = again.groupBy("id", "n").agg(F.count("*").alias("k")).where("4 * k >= 3 * n").select("id").distinct()
    again = again.join(T.sized(whole), "id", "left_semi").withColumn("own", F.expr(_size_class("n")))
    sizes = again.groupBy("h", F.col("own").alias("c")).agg(F.count("*").alias("k")).groupBy("h").agg(F.collect_list(F.struct("c", "k")).alias("cs"))
    near = f"x.c >= {_size_class('3 * n / 4')} - 1 and x.c <= {_size_class('4 * n / 3')} + 1 and (x.c <> own or x.k > 1)"
    each = again.join(sizes, "h").select("id", "n", F.explode(F.expr(f"transform(filter(cs, x -> {near}), x -> x.c)")).alias("c"))
    smallest = f"greatest(floor(pow({STEP}, c) - 1e-6), 3 * n / 4)"
    return each.groupBy("id", "n", "c").agg(F.count("*").alias("k")).where(F.expr(f"7 * k >= 3 * (n + {smallest}) - 1e-6")).select("id").distinct()


def _merged(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The short lists (h, id, n, rest), and for each class how common its hashes are (id, weight).

    rest: how many of the class's hashes are this one or come later in its order, rarest first. A linked pair shares at
    least T hashes, all of them from the first shared one on, so the list of that one has rest >= T for both.
    """
    again = T.store(_again(sets.mapInArrow(_entries, "h long, id long, n long")))
    again = again.join(T.sized(_possible(again)), "id", "left_semi")
    length = again.groupBy("h").agg(F.count("*").alias("length")).where("length > 1")
    mine = again.join(length, "h").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("length", "h"))).alias("mine"))
    needs = F.expr("int((3 * n + 3) div 4)")
    mine = T.store(mine.where(F.size("mine") >= needs).withColumn("size", F.size("mine")))
    weight = mine.select("id", F.expr("aggregate(mine, 0D, (s, e) -> s + e.length) / n").alias("weight"))
    short = mine.select("id", "n", "size", F.posexplode(F.slice("mine", F.lit(1), F.col("size") - needs + 1)).alias("p", "e"))
    return T.store(_again(short.select(F.col("e.h").alias("h"), "id", "n", (F.col("size") - F.col("p")).alias("rest")))), weight


def _entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 500):
            part = batch.slice(i, 500)
            cells = [np.frombuffer(c.as_buffer(), np.int64) for c in part.column("cells")]
            n = np.array([len(c) for c in cells])
            ids = np.repeat(part.column("id").to_numpy(), n)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells)), pa.array(ids), pa.array(np.repeat(n, n))], ["h", "id", "n"])


def _can_link(a: str, b: str, rest: str, other: str):
    return F.expr(f"7 * least({a}, {b}, {rest}, {other}) >= 3 * ({a} + {b})")


def _open(lists: DataFrame, label: DataFrame) -> DataFrame:
    """Lists whose members are not all in one component, with ``component``."""
    named = lists.join(label, "id")
    several = named.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("h")
    return named.join(several, "h", "left_semi")


def links(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """Links (a, b) between classes, from (id, n, head) of each class.

    The links span every component; those between classes that others already connect are not listed.
    """
    sets = T.store(_whole_sets(docs, _candidates(reps)))
    lists, weight = _merged(sets)
    members = T.cut(lists.select("id").distinct().join(weight, "id"))
    label, found, tried = members.select("id", F.col("id").alias("component")), None, None
    for r in range(ROUNDS):
        order = -F.col("weight") if r == 0 else F.xxhash64("id", F.lit(r)).cast("double")
        now = _open(lists, label).join(members.select("id", order.alias("order")), "id")
        centre = now.groupBy("h").agg(F.min(F.struct("order", "id", "n", "rest", "component")).alias("c"))
        offer = (now.join(centre, "h").where("component <> c.component").where(_can_link("c.n", "n", "c.rest", "rest"))
                 .select(F.col("c.id").alias("a"), F.col("id").alias("b")).distinct())
        offer = T.cut(offer if tried is None else offer.join(tried, ["a", "b"], "left_anti"))
        new = T.cut(_verify(offer, sets))
        tried = offer if tried is None else T.cut(tried.unionByName(offer))
        found = new if found is None else T.cut(found.unionByName(new))
        label = components(members.select("id"), found)
    now = _open(lists, label)
    left = now.select("h", F.col("id").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"), F.col("rest").alias("ra"))
    right = now.select("h", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"), F.col("rest").alias("rb"))
    rest = left.join(right, "h").where("a < b and ca <> cb").where(_can_link("na", "nb", "ra", "rb")).select("a", "b").distinct()
    both = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return T.cut(found.unionByName(_verify(rest.join(both, ["a", "b"], "left_anti"), sets)))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (links found at the document's class) for each row."""
    base = shingle_sets(docs)
    rows = T.cut(base.select("doc_id", "n", "s1", "s2"))
    classes = rows.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("id"))
    copies = rows.join(classes, ["s1", "s2", "n"]).where("doc_id <> id").select("doc_id").distinct()
    reps = base.where("doc_id is not null").join(T.sized(copies), "doc_id", "left_anti").select(F.col("doc_id").alias("id"), "n", "head")
    found = links(docs, reps).distinct()
    label = components(found.select(F.explode(F.array("a", "b")).alias("id")).distinct(), found)
    degree = found.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links"))
    named = classes.where("n > 0").join(label, "id", "left").join(degree, "id", "left")
    named = named.select("s1", "s2", "n", F.coalesce("component", "id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    rows = rows.join(named, ["s1", "s2", "n"], "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def dedup(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns: of each component the one with the smallest doc_id."""
    gone = T.sized(join(docs).where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct())
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(T.read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 4], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN r ON r.a = w.doc_id GROUP BY w.doc_id
"""
