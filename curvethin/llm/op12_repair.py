"""Conversation structure repair: the cheapest edits that make the roles of a conversation ``(s?(ua)+)?``.

Each row of a conversation, in order, is kept (K, 0), given the role that fits (R, 1) or deleted (D, 2; blank and duplicate rows
must be); turns without text can be inserted (I, 5); a truncated row that is not deleted adds 5. Of the cheapest audits
(the edits' letters in order) the least one is taken.

``Audits`` holds audits persistently: a node is one edit, linked to the node of the prefix before it, so all states of the
dynamic program share their prefixes. Each node has the rolling hash of its whole string and its ancestors 1, 2, 4, ... steps
back. A tie is decided at the longest common prefix, found by leaping back as long as the hashes differ; the hit is
verified (equal prefixes of one program are one node), and strings whose hashes collided are compared letter by letter.

A conversation may have most of the rows, so none is ever gathered in one group:

1. Rows (without their texts) are sorted by range partitions on (conversation, turn, digest); ``at`` numbers them. Duplicates
   are rows that are not the first ``at`` of their (conversation, digest), a partial aggregate.
2. Blocks of ``BLOCK`` consecutive rows run the dynamic program for each part of a conversation (a segment) from each of the four states
   that it may begin in (start, after s, after u, after a), giving 4 x 4 costs and audits. Inserts always stand before a row
   they precede, so no audit of a segment is a prefix of another one, and segments combine by costs and by the order of
   their audits alone.
3. Segments combine in groups of ``FAN``, level by level, by the same program with a segment as one step; the states chosen at the top are handed
   down again. Most conversations have one segment and skip this.
4. Texts are dealt by conversation once and stream, in order, past the audits: counts and the running hash of the repaired
   text are kept, never the rows. The hash of one conversation is a sequence by its definition, so one task reads it whole, in constant memory but for the audit that
   it returns.

Defined results: nulls in conv_id, turn, role and text count as one space in the damage; null conv_ids are one conversation; rows are
ordered by turn (nulls first), then by ``digest`` (role and text); a role's initial is its first character, so an empty
role has none and fits nowhere; inserted rows and rows with a new role are ``user`` or ``assistant``; further
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvethin.llm import textops as T

BLOCK_BITS = 11
BLOCK = 1 << BLOCK_BITS
FAN = 1024

# The edits' costs.
RETURN_COST, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

START, S, U, A = range(4)
FITS = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
NEXT = {START: U, S: U, U: A, A: U}  # the state after the turn that may always follow
TAILS = ("", "ua", "a", "")  # inserts that end a conversation in each state
LETTER = {"D": "D", "u": "I", "a": "I", "K": "K", "U": "R", "A": "R"}  # edits, and how the audit writes them

_PRIME, _BASE = (1 << 61) - 1, 0x1F3D5B79A8642031


class Audits:
    """Strings that share their prefixes; node 0 is the empty one."""

    def __init__(self):
        self.last = [""]  # the edit
        self.sign = [""]  # what is compared
        self.depth = [0]
        self.hash = [0]
        self.back: list[list[int]] = [[]]  # the ancestors 1, 2, 4, ... steps back

    def extend(self, node: int, edit, sign) -> int:
        back = [node]
        while len(self.back[back[-1]]) >= len(back):  # the ancestor has one as far back as itself
            back.append(self.back[back[-1]][len(back) - 1])
        self.last.append(edit)
        self.sign.append(sign)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * _BASE + self.code(sign)) % _PRIME)
        self.back.append(back)
        return len(self.last) - 1

    @staticmethod
    def code(sign) -> int:
        return ord(sign) if isinstance(sign, str) else sign + 1

    def _lift(self, node: int, steps: int) -> int:
        k = 0
        while steps:
            if steps & 1:
                node = self.back[node][k]
            steps, k = steps >> 1, k + 1
        return node

    def _equal(self, a: int, b: int) -> bool:
        """Letter by letter, up to the prefix that both share."""
        while a != b:
            if self.sign[a] != self.sign[b]:
                return False
            a, b = self.back[a][0], self.back[b][0]
        return True

    def _split(self, a: int, b: int) -> tuple[int, int]:
        """The first nodes at which two strings of one length differ; (0, 0) if they don't."""
        if self.hash[a] != self.hash[b]:
            x, y = a, b
            for k in reversed(range(len(self.back[x]))):
                if k < len(self.back[x]) and self.hash[self.back[x][k]] != self.hash[self.back[y][k]]:
                    x, y = self.back[x][k], self.back[y][k]
            if self.sign[x] != self.sign[y] and self._equal(self.back[x][0], self.back[y][0]):
                return x, y
        elif self._equal(a, b):
            return 0, 0
        first = (0, 0)  # hashes collided
        while a != b:
            if self.sign[a] != self.sign[b]:
                first = a, b
            a, b = self.back[a][0], self.back[b][0]
        return first

    def compare(self, a: int, b: int) -> int:
        shorter = min(self.depth[a], self.depth[b])
        x, y = self._split(self._lift(a, self.depth[a] - shorter), self._lift(b, self.depth[b] - shorter))
        if x == y:
            return self.depth[a] - self.depth[b]
        return -1 if self.sign[x] < self.sign[y] else 1

    def edits(self, node: int) -> list:
        out = []
        while node:
            out.append(self.last[node])
            node = self.back[node][0]
        return out[::-1]


Table = dict[int, tuple[int, int]]  # state: (cost, audit)


def _offer(audits: Audits, table: Table, state: int, cost: int, node: int, edit, sign) -> None:
    old = table.get(state)
    if old is not None and old[0] < cost:
        return
    new = audits.extend(node, edit, sign)
    if old is None or cost < old[0] or audits.compare(new, old[1]) < 0:
        table[state] = cost, new


def _inserted(audits: Audits, best: Table) -> Table:
    """With up to two inserts before the next row."""
    out = dict(best)
    for _ in range(2):
        for state, (cost, node) in list(out.items()):
            _offer(audits, out, NEXT[state], cost + INSERT, node, "ua"[NEXT[state] == A], "I")
    return out


def _row(audits: Audits, best: Table, initial: str, must_go: bool, truncated: bool) -> Table:
    out: Table = {}
    for state, (cost, node) in _inserted(audits, best).items():
        _offer(audits, out, state, cost + DELETE, node, "D", "D")
        if not must_go:
            cost += TRUNCATED * truncated
            if (state, initial) in FITS:
                _offer(audits, out, FITS[state, initial], cost, node, "K", "K")
            _offer(audits, out, NEXT[state], cost + RETURN_COST, node, "UA"[NEXT[state] == A], "R")
    return out


def _matrix(runs: list[tuple[Audits, Table]]) -> tuple[list[int], list[int], list[str]]:
    """Costs (-1: cannot be reached), places in the order of one start's audits, and audits, from each start to each end."""
    costs, places, audits = [-1] * 16, [0] * 16, [""] * 16
    for start, (strings, best) in enumerate(runs):
        order = sorted(best, key=cmp_to_key(lambda a, b: strings.compare(best[a][1], best[b][1])))
        for place, end in enumerate(order):
            i = start * 4 + end
            costs[i], places[i], audits[i] = best[end][0], place, "".join(map(str, strings.edits(best[end][1])))
    return costs, places, audits


def segment(rows: list[tuple[str, bool, bool]], starts: int = 4) -> tuple[list[int], list[int], list[str]]:
    """``_matrix`` of consecutive rows (initial, must be deleted, truncated), for the first ``starts`` states."""
    runs = []
    for start in range(starts):
        strings, best = Audits(), {start: (0, 0)}
        for initial, must_go, truncated in rows:
            best = _row(strings, best, initial, must_go, truncated)
        runs.append((strings, best))
    return _matrix(runs)


def combine(parts: list[tuple[list[int], list[int]]]) -> tuple[list[int], list[int], list[str]]:
    """``_matrix`` of consecutive segments (costs, places); the audits are the states after each segment."""
    runs = []
    for start in range(4):
        strings, best = Audits(), {start: (0, 0)}
        for costs, places in parts:
            after: Table = {}
            for state, (cost, node) in best.items():
                for end in range(4):
                    i = state * 4 + end
                    if costs[i] >= 0:
                        _offer(strings, after, end, cost + costs[i], node, end, places[i])
            best = after
        runs.append((strings, best))
    return _matrix(runs)


# --- damage and order --------------------------------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """key (null conv_ids have one too), turn, role, text, digest of the rows after the damage."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    r = rows.select(_key(), "turn", text("role").alias("role"), text("text").alias("text"), fault.alias("fault")).where("fault <> 0")
    r = r.withColumns({"role": F.when(F.col("fault") == 4, "user").otherwise(F.col("role")),
                       "text": F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))})
    r = r.withColumn("digest", F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    return r.withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("copy", "fault")


def _key():
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key")


def numbered(rows: DataFrame) -> DataFrame:
    """key, turn, digest, initial, blank, cut, at: without texts, numbered in order; stored."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    r = rows.select("key", "turn", "digest", F.substring("role", 1, 1).alias("initial"), last.alias("last"))
    r = r.withColumn("blank", F.col("last") == "").withColumn("cut", ~F.col("last").isin(".", "!", "?")).drop("last")
    by = [F.col("key"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("tie")]
    r = r.withColumn("tie", F.monotonically_increasing_id())  # splits rows that repeat
    r = r.repartitionByRange(*by).sortWithinPartitions(*by).drop("tie")
    return T.store(r.withColumn("at", F.monotonically_increasing_id()))


# --- segments ----------------------------------------------------------------------------------------------

_MATRIX = "costs array<bigint>, places array<int>, audits array<string>"


def segments(rows: DataFrame) -> DataFrame:
    """key, at (of its first row), turn, digest (its first row's), blank, duplicate, truncated (counts) and the matrix of each segment."""
    rows = rows.withColumn("block", F.expr(f"shiftright(at, {BLOCK_BITS})"))
    firsts = rows.groupBy("key", "digest").agg(F.min("at").alias("at")).select(F.expr(f"shiftright(at, {BLOCK_BITS})").alias("block"), "at")

    def run(rows: pd.DataFrame, firsts: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        rows["again"] = ~rows["at"].isin(firsts["at"])
        out = []
        for key, part in rows.groupby("key", sort=False):
            first = part.iloc[0]
            blank, again = part["blank"].to_numpy(bool), part["again"].to_numpy(bool)
            gone = blank | again
            cut = part["cut"].to_numpy(bool) & ~gone
            starts = 4 if first["at"] == rows["at"].iloc[0] else 1  # it may go on from the block before
            matrix = segment(list(zip(part["initial"], gone.tolist(), cut.tolist())), starts)
            out.append((key, first["at"], first["turn"], first["digest"], int(blank.sum()), int((again & ~blank).sum()), int(cut.sum()), *matrix))
        return pd.DataFrame(out, columns=["key", "at", "turn", "digest", "blank", "duplicate", "truncated", "costs", "places", "audits"])

    turn = rows.schema["turn"].dataType.simpleString()
    rows = rows.select("block", "key", F.col("turn").cast("string").alias("turn"), "digest", "initial", "blank", "cut", "at")
    found = rows.groupBy("block").cogroup(firsts.groupBy("block")).applyInPandas(
        run, f"key string, at bigint, turn string, digest binary, blank bigint, duplicate bigint, truncated bigint, {_MATRIX}")
    found = T.store(found.withColumn("turn", F.col("turn").cast(turn)))
    of_key = Window.partitionBy("key")  # one row for BLOCK rows
    place = found.select(F.col("key").alias("k"), F.col("at").alias("p"), (F.row_number().over(of_key.orderBy("at")) - 1).cast("long").alias("idx"),
                         F.count("*").over(of_key).alias("n"))
    return found.join(place, (F.col("key") == F.col("k")) & (F.col("at") == F.col("p"))).drop("k", "p")


def _end(costs: str = "costs", places: str = "places"):
    """struct(cost, place, state) of the best end of a whole conversation, begun in START."""
    ends = [F.struct((F.expr(f"{costs}[{q}]") + INSERT * len(TAILS[q])).alias("cost"), F.expr(f"{places}[{q}]").alias("place"), F.lit(q).alias("state")) for q in range(4)]
    return F.array_min(F.filter(F.array(*ends), lambda e: F.element_at(F.col(costs), e["state"] + 1) >= 0))


def choose(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(segments with their ``piece`` of the audit, conversations with ``cost`` and ``tail``)."""
    up = [found.select("key", "idx", "n", "costs", "places", "audits")]

    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        matrix = combine([(list(map(int, c)), list(map(int, p))) for c, p in zip(rows["costs"], rows["places"])])
        return pd.DataFrame([(*key, -(-int(rows["n"].iloc[0]) // FAN), *matrix)], columns=["key", "idx", "n", "costs", "places", "audits"])

    while (up[-1].agg(F.max("n")).first()[0] or 0) > 1:  # one number
        parts = up[-1].where("n > 1").select("key", F.expr(f"idx div {FAN}").alias("group"), "idx", "n", "costs", "places")
        joined = parts.groupBy("key", "group").applyInPandas(join, f"key string, idx bigint, n bigint, {_MATRIX}")
        up.append(T.store(joined))
    tops = [level.where("n = 1").select("key", F.lit(0).cast("long").alias("idx"), _end().alias("end")) for level in up]
    tail = F.element_at(F.array(*map(F.lit, TAILS)), F.col("end.state") + 1)
    chosen = None
    for level, top in zip(reversed(up), reversed(tops)):
        here = top.select("key", "idx", F.col("end.state").alias("way"))  # begun in START, so its number is the way's
        if chosen is not None:
            here = here.unionByName(chosen)
        here = level.drop("n").join(here.select(F.col("key").alias("k"), F.col("idx").alias("i"), "way"), (F.col("key") == F.col("k")) & (F.col("idx") == F.col("i")))
        here = here.select("key", "idx", F.expr("audits[way]").alias("piece"), F.expr("way div 4").cast("int").alias("start"))
        if level is up[0]:
            chosen = here
            break
        states = F.filter(F.split(F.concat(F.col("start").cast("string"), "piece"), ""), lambda x: x != "")
        steps = here.select("key", "idx", states.alias("s")).select("key", "idx", "s", F.posexplode(F.expr("slice(s, 2, size(s))")))
        chosen = steps.select("key", (F.col("idx") * FAN + F.col("pos")).alias("idx"), (F.expr("s[pos]").cast("int") * 4 + F.col("col").cast("int")).alias("way"))
    ends = None
    for top in tops:
        one = top.select("key", F.col("end.cost").alias("cost"), tail.alias("tail"))
        ends = one if ends is None else ends.unionByName(one)
    pieces = found.drop("costs", "places", "audits").join(chosen.select(F.col("key").alias("k"), F.col("idx").alias("i"), "piece"), (F.col("key") == F.col("k")) & (F.col("idx") == F.col("i")))
    return pieces.drop("k", "i"), ends


# --- repaired texts ----------------------------------------------------------------------------------------

class _Open:
    """What is kept of a conversation while its rows pass."""

    def __init__(self, key: str):
        self.key, self.sha, self.lines, self.audit = key, hashlib.sha256(), 0, []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.cost = 0
        self.low = self.high = self.before = None
        self.tail = self.piece = ""
        self.pieces: list[str] = []
        self.at = 0

    def line(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.lines else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.lines += 1

    def edit(self, letter: str, role: str, text: str) -> None:
        self.audit.append(LETTER[letter])
        if letter in "uU":
            self.line("user", text if letter == "U" else "")
        elif letter in "aA":
            self.line("assistant", text if letter == "A" else "")
        elif letter == "K":
            self.line(role, text)

    def row(self, turn: int | None, role: str, text: str) -> None:
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        while True:
            if self.at == len(self.piece):
                self.piece, self.at = self.pieces.pop(0), 0
            letter = self.piece[self.at]
            self.at += 1
            self.edit(letter, role, text)
            if letter not in "ua":
                return

    def done(self) -> tuple:
        for letter in self.tail:
            self.edit(letter, "", "")
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


_COLUMNS = ["key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, of each conversation: what ends it (kind 0), its segments (1) and texts (2), a segment not after its rows."""
    now: _Open | None = None
    for batch in batches:
        out = []
        names = ("key", "kind", "turn", "role", "text", "blank", "duplicate", "truncated", "cost")
        for key, kind, turn, role, text, blank, duplicate, truncated, cost in zip(*(batch.column(n).to_pylist() for n in names)):
            if now is None or now.key != key:
                if now is not None:
                    out.append(now.done())
                now = _Open(key)
            if kind == 0:
                now.cost, now.tail = cost or 0, text or ""
            elif kind == 1:
                now.pieces.append(text)
                now.blank, now.duplicate, now.truncated = now.blank + blank, now.duplicate + duplicate, now.truncated + truncated
            else:
                now.row(turn, role, text)
        yield _batch(out)
    if now is not None:
        yield _batch([now.done()])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], _COLUMNS)


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation."""
    after = damaged(rows)
    pieces, ends = choose(segments(numbered(after)))
    every = rows.select(_key()).distinct()
    every = every.join(ends.withColumnRenamed("key", "k"), F.col("key") == F.col("k"), "left").drop("k")
    after = after.withColumn("turn", F.col("turn").cast("long"))
    of = lambda kind, d: d.withColumn("kind", F.lit(kind))
    stream = of(0, every.withColumnRenamed("tail", "text"))
    stream = stream.unionByName(of(1, pieces.withColumnRenamed("piece", "text").drop("idx", "n").withColumn("turn", F.col("turn").cast("long"))), allowMissingColumns=True)
    stream = stream.unionByName(of(2, after), allowMissingColumns=True)
    order = [F.col("key"), F.expr("kind = 0").desc(), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("kind"), F.col("at")]
    stream = stream.repartition("key").sortWithinPartitions(*order).drop("digest", "at")
    out = stream.mapInArrow(_apply, "key string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string")
    conv_id = F.expr("if(key = '', null, substr(key, 2))").cast(rows.schema["conv_id"].dataType)
    return out.select(conv_id.alias("conv_id"), *_COLUMNS[1:])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(T.read(spark, sf_dir, "conversations"))


ORACLE = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split('~' || coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
      lambda c, b: list_reduce([CAST(xor(CASE WHEN c = 126 THEN 4294967295 ELSE c END, b) AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda y, z: xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 20 AS k
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM raw, LATERAL (SELECT unnest(generate_series(1, CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy) WHERE k <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, unhex(sha256(strlen(role) || ':' || role || text))) AS i FROM d),
f AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS pc,
    rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS r,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM o),
g AS (SELECT *, r = '' AS blank, r <> '' AND again AS dup, r <> '' AND NOT again AND right(r, 1) NOT IN ('.', '!', '?') AS cut FROM f),
hop AS (SELECT * FROM (VALUES (0,0,'','',0),(1,1,'','',0),(2,2,'','',0),(3,3,'','',0),(0,2,'I',chr(10)||'user:',5),(1,2,'I',chr(10)||'user:',5),(3,2,'I',chr(10)||'user:',5),
  (2,3,'I',chr(10)||'assistant:',5),(0,3,'II',chr(10)||'user:'||chr(10)||'assistant:',10),(1,3,'II',chr(10)||'user:'||chr(10)||'assistant:',10)) t(s, x, ins, lines, c)),
op AS (SELECT * FROM (VALUES (0,'K','s',1),(0,'K','u',2),(1,'K','u',2),(2,'K','a',3),(3,'K','u',2),(0,'R','user',2),(1,'R','user',2),(2,'R','assistant',3),(3,'R','user',2),
  (0,'D','',0),(1,'D','',1),(2,'D','',2),(3,'D','',3)) t(x, e, w, y)),
dp AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS st, CAST(0 AS BIGINT) AS cost, '' AS audit, '' AS rep FROM g
  UNION ALL
  SELECT conv_id, i, st, cost, audit, rep FROM (
    SELECT dp.conv_id, dp.i + 1 AS i, op.y AS st,
      dp.cost + hop.c + CASE op.e WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN g.cut AND op.e <> 'D' THEN 5 ELSE 0 END AS cost,
      dp.audit || hop.ins || op.e AS audit,
      dp.rep || hop.lines || CASE op.e WHEN 'K' THEN chr(10) || g.role || ':' || g.text WHEN 'R' THEN chr(10) || op.w || ':' || g.text ELSE '' END AS rep
    FROM dp JOIN g ON g.conv_id IS NOT DISTINCT FROM dp.conv_id AND g.i = dp.i + 1 JOIN hop ON hop.s = dp.st JOIN op ON op.x = hop.x
    WHERE (op.e = 'D' OR NOT (g.blank OR g.dup)) AND (op.e <> 'K' OR op.w = g.c))
  QUALIFY row_number() OVER (PARTITION BY conv_id, st ORDER BY cost, audit) = 1),
s AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated, count(*) FILTER (pc || c NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id),
e AS (
  SELECT dp.conv_id, dp.cost + hop.c AS cost, dp.audit || hop.ins AS audit, dp.rep || hop.lines AS rep
  FROM dp JOIN s ON s.conv_id IS NOT DISTINCT FROM dp.conv_id AND s.n = dp.i JOIN hop ON hop.s = dp.st WHERE hop.x IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY dp.conv_id ORDER BY dp.cost + hop.c, dp.audit || hop.ins) = 1)
SELECT c.conv_id, CAST(coalesce(s.gaps, 0) AS BIGINT) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate, coalesce(s.truncated, 0) AS truncated,
  coalesce(s.illegal, 0) AS illegal, coalesce(e.cost, 0) AS cost, coalesce(e.audit, '') AS audit, sha256(coalesce(substr(e.rep, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
