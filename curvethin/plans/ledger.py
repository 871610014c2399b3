"""A backlog whose batches take effect exactly once, over a status table kept in versions.

A ledger is a folder. ``versions/<v>`` names the data of status version v; ``plans/<v>`` names its pending keys, sorted once and
cut into pages; a file in ``batches/<v>`` is the commit record of one page or several and names the outcome of their keys. The data lie in
``data``, each write in a folder of its own; what no record names is left over from a stop and never read.

A batch is one page. It thins the page's series, stages the rows in the sink, stores the keys' outcome, commits
the rows and then records the page. A stop before the sink's commit leaves nothing visible; a stop between it and the record
repeats the batch, whose second commit does nothing as the sink knows the name. When all pages are recorded, the next status version is
written with one join by key (so status rows that share a key are all updated and none is lost) and named.

Pages are worked on in rounds: one round is as many pages as are recorded already (at least one), so a run of n pages takes about
log2(n) rounds of Spark jobs, while a stop loses no more than was done before. The process rows of all open pages are stored once, by round, and a
round reads its own. A round that fails is halved until the page that fails is alone; the other pages are
done. Sinks that take one batch at a time (without ``many``) get one page at a time.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ThinConfig
from ..operators.series import join_same
from ..operators.split import global_positions
from ..operators.thin import BROADCAST_KEY_LIMIT
from ..session import checkpoint_dir, clear_stored, store, stored
from ..sources.files import Records
from ..sources.fixtures import PROCESS_KEYS
from ..sources.rows import ROW_ID, with_ids
from . import pipeline as P

PLAN_ROWS = 2_000_000  # keys sorted in one task


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        checkpoint_dir(spark)
        self.spark, self.root = spark, root.rstrip("/")
        self.records = Records(spark, self.root)

    def _save(self, df: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{folder}")
        return folder

    def _load(self, folder: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{folder}")

    # --- status versions

    def version(self) -> int | None:
        names = self.records.names("versions")
        return max(map(int, names)) if names else None

    def status(self, version: int | None = None) -> DataFrame:
        """A status version; the latest by default."""
        return self._load(self.records.get(f"versions/{self.version() if version is None else version}"))

    def publish(self, status: DataFrame) -> int:
        """Stores the next version."""
        folder = self._save(status)
        new = 0 if self.version() is None else self.version() + 1
        self.records.put(f"versions/{new}", folder)
        return new

    # --- pages

    def plan(self, shards: int = P.SHARDS, limit: int | None = None) -> DataFrame:
        """shard, page and keys of what is pending in the latest version: pages of ``limit`` keys in key order."""
        name = f"plans/{self.version()}"
        keys = (self.status().filter(P.pending_filter()).select(*PROCESS_KEYS, F.pmod("step_id", F.lit(shards)).alias("shard"))
                .dropDuplicates(PROCESS_KEYS).filter("shard IS NOT NULL"))
        schema = keys.withColumn("page", F.lit(0).cast("long")).schema
        if self.records.get(name) is None:
            n = keys.count()
            keys = global_positions(keys, ["shard"], PROCESS_KEYS, "_position", max(n, 1), PLAN_ROWS, shards)
            page = F.expr(f"(_position - 1) div {limit}") if limit else F.lit(0).cast("long")
            self.records.put(name, self._save(keys.select(*PROCESS_KEYS, "shard", page.alias("page"))))
        return self.spark.read.schema(schema).parquet(f"{self.root}/{self.records.get(name)}")

    def record(self, version: int, batches: list[str], what: dict) -> None:
        """The commit record of one page or several."""
        name = batches[0] if len(batches) == 1 else f"{batches[0]}+{len(batches)}"
        self.records.put(f"batches/{version}/{name}", json.dumps(what | ({"batches": batches} if len(batches) > 1 else {})))

    def _recorded(self, version: int) -> list[dict]:
        names = self.records.names(f"batches/{version}")
        return [{"batches": [n]} | json.loads(self.records.get(f"batches/{version}/{n}")) for n in names]

    def committed(self, version: int) -> set[str]:
        return {b for r in self._recorded(version) for b in r["batches"]}

    def outcomes(self, version: int) -> DataFrame | None:
        """keys, value and run time of all recorded pages."""
        folders = [r["outcome"] for r in self._recorded(version)]
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in folders]) if folders else None


def run_ledger(process: DataFrame, ledger: Ledger, sink, cfg: ThinConfig, run_ts: str | _dt.datetime | None = None,
               shards: int = P.SHARDS, limit: int | None = None, split: str = "auto") -> DataFrame:
    """Thins everything pending in the ledger's latest status version, page by page, and returns the next version.

    ``sink`` has ``stage(rows, batch)`` and ``commit(batch, staged)`` (see :mod:`curvethin.sources.sinks`). A run that stopped goes
    on with the pages that are not recorded. A page that cannot be scored or staged is recorded with outcome 2 before its
    :class:`BatchFailed` is raised; the next run goes on after it. ``run_ts`` defaults to the time of each batch.
    """
    version = ledger.version()
    if version is None:
        raise ValueError("publish a status table first")
    plan, done = ledger.plan(shards, limit), ledger.committed(version)
    pages = sorted((r["shard"], r["page"]) for r in plan.select("shard", "page").distinct().collect())  # a row a batch
    todo = [(*p, f"{version}-{p[0]}-{p[1]}") for p in pages if f"{version}-{p[0]}-{p[1]}" not in done]
    if todo:
        held = stored(ledger.spark)
        try:
            _Run(process, ledger, sink, cfg, run_ts, limit, split, version, plan, todo).rounds(len(done))
        finally:
            clear_stored(ledger.spark, held)  # the run's own intermediate tables
    status, outcomes = ledger.status(version), ledger.outcomes(version)
    if outcomes is None:
        return status
    new = P.update_status(status, outcomes, F.col("value"), F.col("run_ts"))
    return ledger.status(ledger.publish(new))


class _Run:
    """The open pages ``todo`` (shard, page, name), of a run of ``run_ledger``."""

    def __init__(self, process, ledger, sink, cfg, run_ts, limit, split, version, plan, todo):
        self.process, self.ledger, self.sink, self.cfg, self.run_ts = process, ledger, sink, cfg, run_ts
        self.limit, self.split, self.version, self.plan, self.todo = limit, split, version, plan, todo
        self.names = [name for *_, name in todo]
        self.keys = self.dealt = None

    def rounds(self, done: int) -> None:
        ends = [0]
        while ends[-1] < len(self.todo):
            ends.append(min(ends[-1] + max(1, done + ends[-1]), len(self.todo)))
        spans = list(zip(ends, ends[1:]))
        number = [k for k, (a, b) in enumerate(spans) for _ in range(a, b)]
        schema = ", ".join(f"{c} {self.plan.schema[c].dataType.simpleString()}" for c in ("shard", "page"))
        listed = self.ledger.spark.createDataFrame([(*t, at, k) for at, (t, k) in enumerate(zip(self.todo, number))],
                                                   f"{schema}, batch string, at bigint, round int")
        self.keys = self.plan.join(F.broadcast(listed), ["shard", "page"])
        try:
            self.dealt = with_ids(self._deal())
        except Exception:  # noqa: BLE001 - rows that cannot all be read: each page reads its own, and only those that cannot fail
            self.dealt = None
        for k, (first, last) in enumerate(spans):
            self._work(k, first, last)

    def _deal(self) -> DataFrame:
        """The process rows of the open pages, stored by round."""
        rows = P.tied(P.load_rows(self.process.drop(ROW_ID), None))
        keys = self.keys.select(*PROCESS_KEYS, "batch", "at", "round")
        small = keys.count() <= BROADCAST_KEY_LIMIT
        return store(join_same(rows, keys if small else keys.hint("shuffle_hash"), PROCESS_KEYS, small=small), "round")

    def _work(self, k: int, first: int, last: int) -> None:
        """Thins, stages, commits and records the pages ``first`` to ``last`` (exclusive) of round ``k``."""
        alone, ledger, ts = last - first == 1, self.ledger, P.run_time(self.run_ts)
        if not alone and (self.dealt is None or not getattr(self.sink, "many", False)):
            for at in range(first, last):
                self._work(k, at, at + 1)
            return
        batches, held = self.names[first:last], stored(ledger.spark)
        own = F.col("at").between(first, last - 1)
        keys = self.keys.filter(own).select(*PROCESS_KEYS)
        note = lambda outcome: ledger._save(outcome.withColumn("run_ts", F.lit(ts).cast("timestamp")))
        try:
            if self.dealt is None:
                rows, outcome = P.thin_batch(self.process, keys, self.cfg, ts, self.split, small=self.limit is not None)
            else:
                mine = self.dealt.filter((F.col("round") == k) & own)
                rows, outcome = P.thin_loaded(mine, keys, self.cfg, ts, self.split, carry=[] if alone else ["batch"])
            staged = self.sink.stage(rows, batches[0] if alone else batches)
            folder, cause = note(outcome), None
        except Exception as e:  # noqa: BLE001
            cause = e
        if cause is not None and not alone:
            clear_stored(ledger.spark, held)
            middle = (first + last) // 2
            self._work(k, first, middle)
            self._work(k, middle, last)
            return
        if cause is not None:
            ledger.record(self.version, batches, {"outcome": note(keys.withColumn("value", F.lit(2))), "failed": str(cause)[:500]})
            raise P.BatchFailed(P.update_status(ledger.status(self.version), keys, 2, ts)) from cause
        self.sink.commit(batches[0] if alone else batches, staged)
        ledger.record(self.version, batches, {"outcome": folder, "rows": staged})
        clear_stored(ledger.spark, held)
