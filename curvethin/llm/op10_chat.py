"""Chat formatting of preference pairs, with DataFrame functions only.

``format_pairs`` takes pairs of conversations (chosen, rejected). Their longest common prefix of turns (equal role and
text) is rendered once as the prompt; the turns after it are rendered as two completions. A completion's mask lists the
character ranges that are trained on: the text and end marker of assistant turns; other turns and headers are masked.

``pairs`` makes pairs of a table of conversations: a conversation is paired with the next one (by conv_id, in the whole
table) that opens with the same first turn; if there is none, its rejected side is its own turns with the text of the
last assistant turn replaced by that of the next conversation. The next one is found in ranges of the ids in order, each
with the first row of the range after it, so no task holds a group, however many conversations open alike and whatever
the ids are. The longer of the two (assistant characters; first on a tie) is the chosen one.

Defined results: turns are ordered by turn, then role and text (nulls first); turns repeated in full count once; null
role and text render as empty; conversations without assistant turns or without a neighbour pair with themselves and
have empty completions; rows with null conv_id belong to no common conversation: each distinct one is a conversation of one
turn, paired with itself; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvethin.llm import textops as T

OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"


def conversations(rows: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text) from one row for each turn."""
    t = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    g = rows.where("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_set(t)).alias("t"))
    g = g.unionByName(rows.where("conv_id is null").select("conv_id", F.array(t).alias("t")).distinct())
    return g.select("conv_id", F.expr("transform(t, x -> struct(x.role, x.text))").alias("turns"))


def _following(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The rows with ``name``: the keys (distinct) of the next row in their order, as a struct; null for the last."""
    own = F.struct(*keys)
    rows = T.cut(rows.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()))
    heads = rows.groupBy("part").agg(F.min(own).alias("head"))  # one row a range
    heads = heads.select("part", F.lead("head").over(Window.orderBy("part")).alias("after"))
    rows = rows.withColumn(name, F.lead(own).over(Window.partitionBy("part").orderBy(*keys)))
    return rows.join(F.broadcast(heads), "part").withColumn(name, F.coalesce(name, "after")).drop("part", "after")


def pairs(convs: DataFrame) -> DataFrame:
    """conv_id, other_id, chosen, rejected (arrays of turns)."""
    c = T.store(convs.withColumn("reply", F.expr("aggregate(turns, cast(null as string), (a, t) -> if(t.role = 'assistant', t.text, a))")))
    c, lone = c.where("conv_id is not null"), c.where("conv_id is null")  # null ids have no neighbours
    ids = _following(c.select("conv_id", F.xxhash64(F.expr("turns[0]")).alias("first")), ["first", "conv_id"], "alike")
    ids = _following(ids.withColumn("same_id", F.expr("if(alike.first = first, alike.conv_id, null)")).drop("first", "alike"), ["conv_id"], "near")
    ids = ids.select("conv_id", "same_id", F.coalesce("same_id", "near.conv_id").alias("other_id"))
    other = c.select(F.col("conv_id").alias("other_id"), F.col("turns").alias("same"), F.col("reply").alias("near"))
    c = c.join(ids, "conv_id").join(other, "other_id", "left").unionByName(lone, allowMissingColumns=True)
    last = "array_max(transform(turns, (t, i) -> if(t.role = 'assistant', i, -1)))"
    c = c.withColumn("last", F.expr(last))
    swap = F.expr("transform(turns, (t, i) -> if(i = last and near is not null, struct(t.role as role, near as text), t))")
    c = c.withColumn("rejected", F.when(F.col("same_id").isNotNull(), F.col("same")).otherwise(swap))
    longer = _spoken("rejected") > _spoken("turns")
    return c.select("conv_id", "other_id", F.when(longer, F.col("rejected")).otherwise(F.col("turns")).alias("chosen"),
                    F.when(longer, F.col("turns")).otherwise(F.col("rejected")).alias("rejected"))


def _spoken(turns: str) -> Column:
    return F.expr(f"aggregate({turns}, 0, (n, t) -> n + if(t.role = 'assistant', length(t.text), 0))")


def _render(turns: str) -> Column:
    return F.expr(f"array_join(transform({turns}, t -> concat('{OPEN}', t.role, '{MIDDLE}', t.text, '{CLOSE}')), '')".replace("\n", "\\n"))


def _mask(turns: str) -> Column:
    """Ranges (start, end) of the assistant's text and end marker in the rendered turns."""
    head, tail = len(OPEN) + len(MIDDLE), len(CLOSE)
    size = f"({head + tail} + length(t.role) + length(t.text))"
    ends = f"transform(sequence(1, size({turns})), k -> aggregate(slice({turns}, 1, k), 0, (n, t) -> n + {size}))"
    ranges = f"zip_with({turns}, {ends}, (t, e) -> struct(t.role as role, e - length(t.text) - {tail} as start, e as end))"
    return F.expr(f"if(size({turns}) = 0, cast(array() as array<struct<start:int,end:int>>), "
                  f"transform(filter({ranges}, r -> r.role = 'assistant'), r -> struct(r.start, r.end)))")


def format_pairs(rows: DataFrame) -> DataFrame:
    """Adds prefix_turns, prompt, chosen_text, rejected_text, chosen_mask, rejected_mask; replaces the turns."""
    same = "zip_with(chosen, rejected, (a, b) -> a <=> b)"
    prefix = F.expr(f"if(array_contains({same}, false), array_position({same}, false) - 1, least(size(chosen), size(rejected)))").cast("int")
    r = rows.withColumn("prefix_turns", prefix)
    r = r.withColumn("head", F.expr("slice(chosen, 1, prefix_turns)"))
    for side in ("chosen", "rejected"):
        r = r.withColumn(side, F.expr(f"slice({side}, prefix_turns + 1, size({side}))"))
    r = r.withColumn("prompt", _render("head"))
    for side in ("chosen", "rejected"):
        r = r.withColumn(f"{side}_text", _render(side)).withColumn(f"{side}_mask", _mask(side))
    return r.drop("head", "chosen", "rejected")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = format_pairs(pairs(conversations(T.read(spark, sf_dir, "conversations"))))
    mask = lambda c: F.expr(f"array_join(transform({c}, m -> concat(m.start, '-', m.end)), ',')")
    return out.select("conv_id", "other_id", "prefix_turns", "prompt", "chosen_text", "rejected_text",
                      mask("chosen_mask").alias("chosen_mask"), mask("rejected_mask").alias("rejected_mask"))


ORACLE = r"""
WITH c AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)
  GROUP BY conv_id, CASE WHEN conv_id IS NULL THEN {'n': turn, 'r': role, 't': text} END),
r AS (SELECT *, conv_id IS NULL AS lone, list_filter(turns, lambda t: t.role = 'assistant')[-1].text AS reply,
  list_max(list_transform(turns, lambda t, i: CASE WHEN t.role = 'assistant' THEN i ELSE 0 END)) AS last FROM c),
n AS (SELECT *, lead(conv_id) OVER a AS same_id, CASE WHEN NOT lone THEN lead(turns) OVER a END AS same, lead(conv_id) OVER b AS near_id,
    CASE WHEN conv_id IS NOT NULL THEN lead(reply) OVER b END AS near
  FROM r WINDOW a AS (PARTITION BY lone, turns[1] ORDER BY conv_id), b AS (PARTITION BY lone ORDER BY conv_id)),
p AS (SELECT conv_id, coalesce(same_id, near_id) AS other_id, turns,
  CASE WHEN same_id IS NOT NULL THEN same
    ELSE list_transform(turns, lambda t, i: CASE WHEN i = last AND near IS NOT NULL THEN {'role': t.role, 'text': near} ELSE t END) END AS other FROM n),
s AS (SELECT *, coalesce(list_sum(list_transform(turns, lambda t: CASE WHEN t.role = 'assistant' THEN length(t.text) ELSE 0 END)), 0) AS x,
  coalesce(list_sum(list_transform(other, lambda t: CASE WHEN t.role = 'assistant' THEN length(t.text) ELSE 0 END)), 0) AS y FROM p),
o AS (SELECT conv_id, other_id, CASE WHEN y > x THEN other ELSE turns END AS ch, CASE WHEN y > x THEN turns ELSE other END AS re FROM s),
f AS (SELECT *, coalesce(list_min(list_filter(generate_series(1, greatest(len(ch), len(re))), lambda i: ch[i] IS DISTINCT FROM re[i])) - 1, least(len(ch), len(re))) AS k FROM o),
t AS (SELECT conv_id, other_id, CAST(k AS INTEGER) AS prefix_turns, ch[1:k] AS hd, ch[k + 1:] AS ch, re[k + 1:] AS re FROM f)
SELECT conv_id, other_id, prefix_turns,
  array_to_string(list_transform(hd, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), '') AS prompt,
  array_to_string(list_transform(ch, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), '') AS chosen_text,
  array_to_string(list_transform(re, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), '') AS rejected_text,
  coalesce(array_to_string(list_filter(list_transform(ch, lambda t, i: CASE WHEN t.role = 'assistant' THEN
    CAST(list_sum(list_transform(ch[1:i], lambda u: 13 + length(u.role) + length(u.text))) - length(t.text) - 8 AS BIGINT)::VARCHAR || '-' ||
    CAST(list_sum(list_transform(ch[1:i], lambda u: 13 + length(u.role) + length(u.text))) AS BIGINT)::VARCHAR END), lambda z: z IS NOT NULL), ','), '') AS chosen_mask,
  coalesce(array_to_string(list_filter(list_transform(re, lambda t, i: CASE WHEN t.role = 'assistant' THEN
    CAST(list_sum(list_transform(re[1:i], lambda u: 13 + length(u.role) + length(u.text))) - length(t.text) - 8 AS BIGINT)::VARCHAR || '-' ||
    CAST(list_sum(list_transform(re[1:i], lambda u: 13 + length(u.role) + length(u.text))) AS BIGINT)::VARCHAR END), lambda z: z IS NOT NULL), ','), '') AS rejected_mask
FROM t
"""
