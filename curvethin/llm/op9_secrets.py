"""Secret scans by linking the parts of a credential, with DataFrame functions only.

Base spans (always reported): ``assign`` (a password-like name, = or :, and a value of 6 or more characters),
``access`` (AKIA keys of 20 or more characters), ``hex`` (24 or more hex digits).

Weak parts are reported only when complementary parts co-occur in the same text, at most ``SCOPE`` characters lying between
the end of one and the start of the other:

- ``identifier`` (user, client or account names being set, short access keys) needs a ``secret`` or a base span;
- ``secret`` (24 or more characters of a base64-like alphabet, with a digit, upper- and lower-case) needs an
  identifier, an access key or an endpoint;
- ``endpoint`` (a URL or host with port) needs an identifier and a secret or base span.

Matches are found by splitting a text at its matches: piece lengths and match lengths, summed in order, give
the offsets. Parts are linked by an interval join within a text, written as running windows over the ends of all parts in order:
of each kind, the last end at or before a part's start and the first start at or after its end. So parts that overlap (a token
inside a URL, an identifier that is its own value) never vouch for each other, and no pairs are formed.

Defined results: null counts as empty; offsets are code points, end exclusive; rows without parts have empty
lists; repeated rows (same doc_id and text) give equal results; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvethin.llm import textops as T

SCOPE = 400
# fixed values: the formats, in reporting order
FORMATS = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
    "identifier": r"""(?i:(?<![a-z])(?:client_?id|access_?key_?id|user(?:_?name)?|login|account(?:_?id)?))["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,64}|(?<![A-Z0-9])(?:AKIA|ASIA)[A-Z0-9]{8,15}(?![A-Z0-9])""",
    "secret": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}={0,2}",
    "endpoint": r"""https?://[A-Za-z0-9.:/_~%?&=#@-]{4,}|(?<![A-Za-z0-9.-])[a-z0-9-][a-z0-9.-]*:[0-9]{2,5}(?![0-9])""",
}
KINDS = list(FORMATS)
BASE = KINDS[:3]
# a text without any of these has no match of any format
_SOME = r"(?i:passw|secret|token|api_?key|client_?id|key_?id|user|login|account)|AKIA|ASIA|https?:|:[0-9][0-9]|[A-Za-z0-9+/_-]{24}"


def _matches(texts: DataFrame) -> DataFrame:
    """did, tag, kind (its number), start, end of every match of every format."""
    found = []
    for k, (name, pattern) in enumerate(FORMATS.items()):
        p = F.lit(pattern)
        # pieces and matches alternate: piece 0, match 0, piece 1, match 1 ... last piece
        rows = texts.select("did", "tag", F.split("text", pattern, -1).alias("pieces"), F.regexp_extract_all("text", p, F.lit(0)).alias("hits")).where(F.size("hits") > 0)
        rows = rows.select("did", "tag", F.expr("transform(pieces, x -> length(x))").alias("gaps"), F.posexplode("hits").alias("i", "hit"))
        rows = rows.select("did", "tag", "i", "hit", F.expr("gaps[i]").alias("gap"), F.length("hit").alias("n"))
        before = Window.partitionBy("did", "tag").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(before))
        if name == "assign":
            rows = rows.where(F.length(F.regexp_extract("hit", pattern, 2)) >= 6)
        if name == "access":
            rows = rows.where("n >= 20")
        if name == "secret":
            rows = rows.where(F.col("hit").rlike("[0-9]") & F.col("hit").rlike("[A-Z]") & F.col("hit").rlike("[a-z]"))
        if name == "endpoint":  # parts of a host name are not empty; checked here, as a repeated group would recurse for each part
            rows = rows.where(F.col("hit").rlike("^https?://") | (F.col("hit").contains(".") & ~F.col("hit").contains("..") & ~F.col("hit").contains(".:")))
        found.append(rows.select("did", "tag", F.lit(k).alias("kind"), (F.col("end") - F.col("n")).cast("int").alias("start"), F.col("end").cast("int").alias("end")))
    return reduce(DataFrame.unionByName, found)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, spans: (start, kind, end, reported) of every part in order, for each row."""
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(T.NULL_ID)).alias("did"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tag", F.xxhash64("text"))
    texts = T.cut(rows.where(F.col("text").rlike(_SOME)).select("did", "tag", "text").dropDuplicates(["did", "tag"]))
    parts = _matches(texts)
    # each part asks at its start for what ended before, and at its end for what starts after; at one place ends come first
    asks = F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("opens")), F.struct(F.col("end").alias("at"), F.lit(0).alias("opens")))
    events = parts.withColumn("event", F.explode(asks)).select("did", "tag", "kind", "start", "end", "event.*")
    text = Window.partitionBy("did", "tag")
    before = text.orderBy("at", "opens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = text.orderBy(F.desc("at"), F.desc("opens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_ = {k: F.col("kind") == i for i, k in enumerate(KINDS)}
    opens = F.col("opens") == 1
    wanted = {"id": is_["identifier"] | is_["access"], "base": F.col("kind") < len(BASE), "secret": is_["secret"], "place": is_["endpoint"]}
    gap = {k: F.when(opens, F.col("at") - F.max(F.when(~opens & w, F.col("at"))).over(before))
           .otherwise(F.min(F.when(opens & w, F.col("at"))).over(after) - F.col("at")) for k, w in wanted.items()}
    events = events.select("did", "tag", "kind", "start", "end", *[F.coalesce(g <= SCOPE, F.lit(False)).alias(k) for k, g in gap.items()])
    parts = events.groupBy("did", "tag", "kind", "start", "end").agg(*[F.max(k).alias(k) for k in wanted])
    linked = (F.when(is_["identifier"], F.col("base") | F.col("secret")).when(is_["secret"], F.col("id") | F.col("place"))
              .when(is_["endpoint"], F.col("id") & (F.col("base") | F.col("secret"))).otherwise(True))
    spans = parts.withColumn("reported", linked).groupBy("did", "tag").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "reported"))).alias("spans"))
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int,reported:boolean>>)")
    return rows.select("doc_id", "did", "tag").join(spans, ["did", "tag"], "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def redact_expr() -> str:
    """SQL for (text, spans): the text with every reported span replaced by its kind; overlaps keep the first."""
    names = "array(" + ", ".join(f"'[{k}]'" for k in KINDS) + ")"
    step = (f"if(s.start >= a.at, named_struct('at', s.end, 'out', concat(a.out, substring(text, a.at + 1, s.start - a.at), {names}[s.kind])), a)")
    start = "named_struct('at', 0, 'out', '')"
    return f"aggregate(filter(spans, s -> s.reported), {start}, (a, s) -> {step}, a -> concat(a.out, substring(text, a.at + 1)))"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    joined = lambda c: f"array_join(transform({c}, s -> concat({names}[s.kind], ':', s.start, ':', s.end)), ',')"
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(BASE)]
    base = F.expr(joined(f"filter(spans, s -> s.kind < {len(BASE)})"))
    out = find(T.read(spark, sf_dir, "documents"))
    return out.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), F.expr(joined("filter(spans, s -> s.reported)")).alias("spans"))
