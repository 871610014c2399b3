"""Merkle manifest of a table: a tree for each language, a tree over their roots, and a proof for each row.

``build`` stores only every ``LEVELS``-th level of a tree (checkpoint): the nodes of a stored level are dealt to aligned
subtrees of ``GROUP`` consecutive nodes, each of which is hashed up to its root in one row, and only the roots are written.
``paths`` goes down again (recompute): for each aligned subtree it hashes the missing interior nodes once more from the
stored nodes below them, hands every node its runs and its place in them, together with the path of the subtree's own
root, and drops them. So the stored levels above the leaves take 1/511 of the leaves' digests, no group has over
``GROUP`` digests, and the texts are read once and never shuffled.

Positions come from a range-partitioned sort of the leaves (language, doc_id, digest) and a running sum over the rows in
each (language, partition); a language with most of the rows is spread over as many partitions as others need. Stored levels are
written to the shared checkpoint folder.

Defined results: null fields are written ``-``, other fields with their length in bytes, so empty and null differ; languages are
ordered null first, then by UTF-8 bytes; inside one, null doc_ids come first, and rows that share a doc_id are ordered by
their leaves (rows that repeat in full are leaves of their own, next to each other); a null doc_id is not tampered with; further
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvethin.llm import textops as T

ARITY = 8
LEVELS = 3
GROUP = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _leaf(text: Column) -> Column:
    parts = []
    for name in FIELDS:
        value = text if name == "text" else F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """tree (the language), doc_id, digest, bent: the leaf of the tampered row, null where tampering changes nothing."""
    own, lower = _leaf(F.col("text")), _leaf(F.translate("text", string.ascii_uppercase, string.ascii_lowercase))
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False)) & F.col("text").rlike("[A-Z]")
    return docs.select(F.col("lang").alias("tree"), "doc_id", own.alias("digest"), F.when(hit, lower).alias("bent"))


def number(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Adds idx (from 0 in each tree, in this order, nulls first) and n (nodes of the tree); stored."""
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order, "tie")]
    rows = nodes.withColumn("tie", F.monotonically_increasing_id())  # splits rows that repeat in full
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("tie")
    rows = T.store(rows.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    spans = rows.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    tree = Window.partitionBy("tree")  # a row for each of its partitions
    before = F.coalesce(F.sum("size").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select(F.col("tree").alias("t"), F.col("part").alias("p"), (before - F.col("first")).alias("shift"), F.sum("size").over(tree).alias("n"))
    rows = rows.join(spans, F.col("tree").eqNullSafe(F.col("t")) & (F.col("part") == F.col("p")))
    return rows.withColumn("idx", F.col("at") + F.col("shift")).drop("t", "p", "part", "at", "shift")


# --- aligned subtrees --------------------------------------------------------------------------------------

def _parents(level: str) -> str:
    """SQL: the digests one level above those in the array ``level``."""
    run = f"slice({level}, cast(k * {ARITY} + 1 as int), {ARITY})"
    return f"transform(sequence(0, (size({level}) - 1) div {ARITY}), k -> sha2(array_join({run}, ''), 256))"


def _subtrees(nodes: DataFrame, others: tuple[str, ...] = ()) -> DataFrame:
    """tree, place, n, nodes (in order), l0 .. l3 (digests by level), height (levels that exist: a tree ends with one node)."""
    row = F.struct("idx", "digest", *others)
    g = nodes.groupBy("tree", F.expr(f"idx div {GROUP}").alias("place"))
    g = g.agg(F.max("n").alias("n"), F.array_sort(F.collect_list(row)).alias("nodes")).withColumn("l0", F.col("nodes.digest"))
    for k in range(LEVELS):
        g = g.withColumn(f"l{k + 1}", F.expr(_parents(f"l{k}")))
    height = F.lit(LEVELS)
    for k in reversed(range(LEVELS)):
        height = F.when(F.col("n") <= ARITY**k, k).otherwise(height)
    return g.withColumn("height", height)


def build(nodes: DataFrame) -> list[DataFrame]:
    """The stored levels from the numbered nodes up to the roots: each tree, idx, n, digest."""
    levels = [nodes]
    while True:
        g = _subtrees(levels[-1])
        top = F.element_at(F.element_at(F.array(*[f"l{k}" for k in range(LEVELS + 1)]), F.col("height") + 1), 1)
        levels.append(T.store(g.select("tree", F.col("place").alias("idx"), F.expr(f"(n + {GROUP - 1}) div {GROUP}").alias("n"), top.alias("digest"))))
        if (levels[-1].agg(F.max("n")).first()[0] or 1) == 1:
            return levels


def _down(nodes: DataFrame, above: DataFrame, others: tuple[str, ...] = ()) -> DataFrame:
    """tree, idx, digest, the others, and path (runs from the node's up to the root's, with its place in each) and the further columns of ``above``."""
    g = _subtrees(nodes, others)
    # one row a run of nodes, then one a node: the interior digests are handed to the runs, not copied for each node
    run = "struct(r as r, slice(nodes, cast(r * 8 + 1 as int), 8) as own, slice(l0, cast(r * 8 + 1 as int), 8) as a, slice(l1, cast(r div 8 * 8 + 1 as int), 8) as b, l2 as c)"
    a = above.select(F.col("tree").alias("t"), F.col("idx").alias("i"), F.col("path").alias("rest"), *[c for c in above.columns if c not in ("tree", "idx", "path")])
    g = g.join(a, F.col("tree").eqNullSafe(F.col("t")) & (F.col("place") == F.col("i")))
    keep = [c for c in a.columns if c not in ("t", "i")]
    g = g.select("tree", "height", *keep, F.explode(F.expr(f"transform(sequence(0, (size(l0) - 1) div 8), r -> {run})")).alias("run"))
    g = g.select("tree", "height", *keep, "run", F.posexplode("run.own"))
    steps = "array(struct(pos as at, run.a as run), struct(cast(run.r % 8 as int) as at, run.b as run), struct(cast(run.r div 8 as int) as at, run.c as run))"
    path = F.expr(f"concat(slice({steps}, 1, height), rest)")
    return g.select("tree", "col.idx", "col.digest", *[f"col.{c}" for c in others], path.alias("path"), *[c for c in keep if c != "rest"])


def paths(levels: list[DataFrame], above: DataFrame, others: tuple[str, ...] = ()) -> DataFrame:
    """What ``_down`` gives for the lowest level, from ``above``: the paths of the trees' roots (tree, idx 0, path, ...)."""
    for nodes in levels[-2:0:-1]:
        above = T.store(_down(nodes, above).drop("digest"))
    return _down(levels[0], above, others)


def prove(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, bent, subroot, root, path for each row."""
    by_tree = build(number(leaves(docs), ["doc_id", "digest"]))
    roots = by_tree[-1].select(F.lit(0).alias("tree"), F.col("tree").alias("lang"), "digest")
    over = build(number(roots, ["lang"]))
    none = F.expr("cast(array() as array<struct<at: int, run: array<string>>>)")
    top = over[-1].select("tree", "idx", none.alias("path"), F.col("digest").alias("root"))
    top = paths(over, top, ("lang",)).select(F.col("lang").alias("tree"), F.lit(0).alias("idx"), "path", F.col("digest").alias("subroot"), "root")
    return paths(by_tree, T.store(top), ("doc_id", "bent")).withColumnRenamed("digest", "leaf")


def siblings(path: str = "path") -> Column:
    """The digests beside the path, joined from the leaf's run to the root's."""
    return F.expr(f"array_join(transform({path}, p -> concat(array_join(slice(p.run, 1, p.at), ''), array_join(slice(p.run, p.at + 2, {ARITY}), ''))), '')")


def fold(leaf: str, path: str = "path") -> Column:
    """The root that a leaf and its siblings give."""
    step = f"sha2(concat(array_join(slice(p.run, 1, p.at), ''), h, array_join(slice(p.run, p.at + 2, {ARITY}), '')), 256)"
    return F.expr(f"aggregate({path}, {leaf}, (h, p) -> {step})")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prove(T.read(spark, sf_dir, "documents")).withColumn("folded_root", fold("coalesce(bent, leaf)"))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(), 256).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


ORACLE = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, lang,
    list_reduce(list_transform(string_split('~' || CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
      lambda c, b: list_reduce([CAST(xor(CASE WHEN c = 126 THEN 4294967295 ELSE c END, b) AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda y, z: xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS low
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(head || tail) AS leaf, sha256(head || CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN low ELSE tail END) AS bent,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256(head || tail)) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM f),
up AS (
  SELECT lang, 0 AS lvl, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY lang, lvl, idx // 8, n),
subroots AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS lvl, idx, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY lvl, idx // 8, n),
side AS (
  SELECT l.lang, l.idx, 0 AS part, u.lvl, u.idx AS pos, u.h FROM leaves l JOIN up u
    ON u.lang IS NOT DISTINCT FROM l.lang AND u.n > 1 AND u.idx // 8 = (l.idx >> CAST(3 * u.lvl AS BIGINT)) // 8 AND u.idx <> l.idx >> CAST(3 * u.lvl AS BIGINT)
  UNION ALL
  SELECT l.lang, l.idx, 1, t.lvl, t.idx, t.h FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang JOIN top t
    ON t.n > 1 AND t.idx // 8 = (s.idx >> CAST(3 * t.lvl AS BIGINT)) // 8 AND t.idx <> s.idx >> CAST(3 * t.lvl AS BIGINT)),
proof AS (SELECT lang, idx, string_agg(h, '' ORDER BY part, lvl, pos) AS p FROM side GROUP BY lang, idx),
fold AS (
  SELECT lang, idx AS me, 0 AS lvl, idx, n, bent AS h FROM leaves
  UNION ALL
  SELECT o.lang, o.me, o.lvl + 1, o.idx // 8, (o.n + 7) // 8, sha256(string_agg(CASE WHEN u.idx = o.idx THEN o.h ELSE u.h END, '' ORDER BY u.idx))
  FROM fold o JOIN up u ON u.lang IS NOT DISTINCT FROM o.lang AND u.lvl = o.lvl AND u.idx // 8 = o.idx // 8
  WHERE o.n > 1 GROUP BY o.lang, o.me, o.lvl, o.idx // 8, o.n),
fold2 AS (
  SELECT o.lang, o.me, 0 AS lvl, s.idx, s.n, o.h FROM fold o JOIN subroots s ON s.lang IS NOT DISTINCT FROM o.lang WHERE o.n = 1
  UNION ALL
  SELECT o.lang, o.me, o.lvl + 1, o.idx // 8, (o.n + 7) // 8, sha256(string_agg(CASE WHEN u.idx = o.idx THEN o.h ELSE u.h END, '' ORDER BY u.idx))
  FROM fold2 o JOIN top u ON u.lvl = o.lvl AND u.idx // 8 = o.idx // 8
  WHERE o.n > 1 GROUP BY o.lang, o.me, o.lvl, o.idx // 8, o.n)
SELECT l.doc_id, l.leaf, s.h AS subroot, t.h AS root, sha256(coalesce(p.p, '')) AS proof_sha256, z.h AS folded_root, z.h = t.h AS verified
FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang JOIN top t ON t.n = 1
LEFT JOIN proof p ON p.lang IS NOT DISTINCT FROM l.lang AND p.idx = l.idx
JOIN fold2 z ON z.lang IS NOT DISTINCT FROM l.lang AND z.me = l.idx AND z.n = 1
"""
