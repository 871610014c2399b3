"""The batch: pending keys -> process rows -> five metrics thinned -> tagged
output rows -> status update.

Plan shape (one pass, no driver hop):

* pending keys: filter + ordered limit on the status table (bounded by the
  batch size), joined to the process rows by broadcast;
* the narrow projection (keys, order, five metrics) is numbered once and
  unpivoted; all windows share one exchange on the series keys;
* rows of a stored table carry the id of their place in it: the kept ids with
  the metrics that keep them are looked up while the table is scanned a second
  time, so wide rows are neither numbered nor sorted, nor exchanged while the
  kept ids are few enough to broadcast, and beyond that only packed in blocks;
* rows of other sources are stored once, which gives them such ids; a hash of the
  whole row tells rows alike in the order columns apart;
* what is the same for all copies of a row is worked out before it is copied for
  each metric that keeps it.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..config import ThinConfig
from ..functions import exprs as X
from ..operators.series import join_same, number_rows
from ..operators.thin import mark, score
from ..session import checkpoint_dir, store
from ..sources.fixtures import FLAG_COLUMNS, PROCESS_COLUMNS, PROCESS_KEYS, PROCESS_ORDER
from ..sources.rows import ROW_ID, fetch, table_bytes, with_ids

# Metric tags and the process column each one thins.
METRICS = {
    "C": "pv_charge_capacity",
    "E": "pv_charge_energy",
    "I": "pv_current",
    "T": "pv_temperature",
    "V": "pv_voltage",
}
# The batch size and shard count of the original job.
BATCH_KEYS = 6000
SHARDS = 2

# Output columns, in sink order (process columns without step_logic_number,
# zip_category inserted after st_business_cycle).
OUTPUT_COLUMNS = [c for c in PROCESS_COLUMNS[:41] if c != "step_logic_number"] + \
    ["zip_category"] + PROCESS_COLUMNS[41:]


# Types of the sink's columns that are not text.
SINK_TYPES = {
    **dict.fromkeys(["channel_id", "sequence_id", "cycle", "step_id", "pv_data_flag",
                     "pv_work_type", "st_business_cycle"], "int"),
    **dict.fromkeys(["test_time_duration", "sv_ic_range", "sv_iv_range", "pv_voltage",
                     "pv_current", "pv_ir", "pv_temperature", "pv_charge_capacity",
                     "pv_discharge_capacity", "pv_charge_energy", "pv_discharge_energy"],
                    "decimal(20,6)"),
    **dict.fromkeys(["timestamp", "created_date_time", "modified_date_time"], "timestamp"),
}


def sink_types(rows: DataFrame) -> DataFrame:
    """Text columns of an all-text source as the sink's types; what cannot be read becomes null."""
    return rows.withColumns({f.name: F.col(f.name).try_cast(SINK_TYPES[f.name])
                             for f in rows.schema.fields
                             if f.name in SINK_TYPES and f.dataType == StringType()})


def pending_filter() -> Column:
    """Any of the five flags is 0 (a null flag is not pending)."""
    cond = F.lit(False)
    for c in FLAG_COLUMNS:
        cond = cond | F.col(c).eqNullSafe(0)
    return cond


def pending_keys(status: DataFrame, shard: int = 0, shards: int = SHARDS,
                 limit: int | None = None) -> DataFrame:
    """Series keys to process in this batch: pending, in the shard
    ``pmod(step_id, shards) == shard``. The whole shard, or with a ``limit``
    the first ones in key order (a top-k: each task keeps its best ``limit``,
    then one merge)."""
    d = (status.filter(pending_filter() & (F.pmod(F.col("step_id"), F.lit(shards)) == shard))
               .select(*PROCESS_KEYS).dropDuplicates(PROCESS_KEYS))
    # an ordered limit is a top-k (bounded per task); without a limit no sort
    return d.orderBy(*PROCESS_KEYS).limit(limit) if limit else d


def repair_metrics(process: DataFrame) -> DataFrame:
    """Charge capacity / energy replaced by the discharge value when 0 or null."""
    return process.withColumns({
        "pv_charge_capacity": X.repair("pv_charge_capacity", "pv_discharge_capacity"),
        "pv_charge_energy": X.repair("pv_charge_energy", "pv_discharge_energy"),
    })


def load_rows(process: DataFrame, keys: DataFrame | None, broadcast_keys: bool = False) -> DataFrame:
    """Process rows of the given series keys, metrics repaired.

    ``broadcast_keys`` is for a key set bounded by a batch limit; otherwise
    Spark chooses the join by the size it finds.
    """
    rows = process
    if keys is not None:
        k = keys.select(*PROCESS_KEYS).dropDuplicates(PROCESS_KEYS)
        rows = join_same(rows, k, PROCESS_KEYS, "left_semi", broadcast_keys)
    ids = [ROW_ID] if ROW_ID in rows.columns else []
    return repair_metrics(rows).select(*PROCESS_COLUMNS, *ids)


def score_metrics(rows: DataFrame, cfg: ThinConfig, metrics: Mapping[str, str] | None = None,
                  detail: bool = False, split: str = "auto",
                  pairs: DataFrame | None = None, position: str | None = None,
                  out: Sequence[str] | None = None, kept_only: bool = False) -> DataFrame:
    """Narrow scored points: one row per (process row, metric); with
    ``pairs`` only the listed (series keys, zip_category) pairs, with
    ``position`` in the order of that column (1..n of each series)."""
    metrics = dict(metrics or METRICS)
    order = PROCESS_ORDER if position is None else ["_position"]
    at = PROCESS_ORDER if position is None else [F.col(position).alias("_position")]
    narrow = rows.select(*PROCESS_KEYS, *at, *sorted(set(metrics.values())))
    return score(narrow, PROCESS_KEYS, order, metrics, cfg, detail=detail, split=split,
                 pairs=pairs, out=out, kept_only=kept_only)


# The status flag of each metric tag.
FLAG_OF = {"C": "c_status", "E": "e_status", "I": "i_status", "T": "t_status", "V": "v_status"}


def pending_pairs(status: DataFrame, keys: DataFrame) -> DataFrame:
    """(series keys, zip_category) pairs whose own flag is 0, for the given
    keys."""
    s = join_same(status, keys.select(*PROCESS_KEYS), PROCESS_KEYS, "left_semi")
    pairs = F.array(*[F.struct(F.lit(t).alias("zip_category"), F.col(c).alias("flag"))
                      for t, c in FLAG_OF.items()])
    return (s.select(*PROCESS_KEYS, F.inline(pairs)).filter(F.col("flag").eqNullSafe(0))
             .select(*PROCESS_KEYS, "zip_category"))


def metric_outcome(pairs: DataFrame, scored: DataFrame) -> DataFrame:
    """(keys, zip_category, value): 2 where the pair failed, else 1."""
    per_pair = scored.groupBy(*PROCESS_KEYS, "zip_category").agg(F.max("failed").alias("failed"))
    return join_same(pairs, per_pair, PROCESS_KEYS + ["zip_category"], "left").select(
        *PROCESS_KEYS, "zip_category",
        F.when(F.coalesce("failed", F.lit(False)), 2).otherwise(1).alias("value"))


def update_status_per_metric(status: DataFrame, outcome: DataFrame,
                             run_ts: str | _dt.datetime | Column) -> DataFrame:
    """Set each flag from ``outcome`` (keys, zip_category, value); flags
    without an outcome are unchanged."""
    ts = run_ts if isinstance(run_ts, Column) else F.lit(str(run_ts)).cast("timestamp")
    wide = outcome.groupBy(*PROCESS_KEYS).agg(
        *[F.max(F.when(F.col("zip_category") == t, F.col("value"))).alias(f"_{c}")
          for t, c in FLAG_OF.items()])
    j = join_same(status, wide.withColumn("_hit", F.lit(True)), PROCESS_KEYS, "left")
    new = {c: F.coalesce(F.col(f"_{c}").cast(status.schema[c].dataType), F.col(c))
           for c in FLAG_COLUMNS}
    hit = F.col("_hit").isNotNull()
    new["modified_date_time"] = F.when(hit, ts.cast(status.schema["modified_date_time"].dataType)) \
        .otherwise(F.col("modified_date_time"))
    new["modified_user"] = F.when(hit, F.lit(X.WRITER_USER)).otherwise(F.col("modified_user"))
    return j.withColumns(new).select(*status.columns)


TIE = "_tie"  # the hash of a whole row


def tied(rows: DataFrame) -> DataFrame:
    """With a hash of the whole row, by which rows alike in the order columns are told apart, so that every
    evaluation numbers alike; rows alike in all columns are interchangeable."""
    return rows.withColumn(TIE, F.xxhash64(*rows.columns))


def stored_rows(rows: DataFrame) -> DataFrame:
    """Rows of any source stored once, with the ids that a stored table's rows have."""
    return with_ids(store(tied(rows)))


def mark_rows(rows: DataFrame, cfg: ThinConfig, metrics: Mapping[str, str] | None = None,
              split: str = "auto", carry: Sequence[str] = ()) -> DataFrame:
    """What each row with a ``_row_id`` is kept for: see :func:`curvethin.operators.thin.mark`."""
    metrics = dict(metrics or METRICS)
    order = [*PROCESS_ORDER, *([TIE] if TIE in rows.columns else [])]
    narrow = rows.select(*PROCESS_KEYS, *order, *sorted(set(metrics.values())), ROW_ID)
    return mark(narrow, PROCESS_KEYS, order, metrics, cfg, [ROW_ID, *carry], split)


# A table over this size is marked in two rounds of whole series: it is read twice, and half its shuffle files are on disk at a time.
ROUND_BYTES = 256 << 20


def mark_source(rows: DataFrame, table: DataFrame, cfg: ThinConfig, metrics: Mapping[str, str] | None = None,
                split: str = "auto", carry: Sequence[str] = (), drop: Sequence[str] = ()) -> tuple[DataFrame, bool]:
    """(``mark_rows`` of the ``rows`` of a stored ``table`` without the columns ``drop``, whether they are stored): a large table is
    marked in rounds, whose shuffle files are deleted as each is stored."""
    rounds = 2 if table_bytes(table) > ROUND_BYTES else 1
    if rounds == 1:
        return mark_rows(rows, cfg, metrics, split, carry).drop(*drop), False
    # by one key, so that the filter reaches the scan below a numbering by it
    of = F.pmod(F.xxhash64(PROCESS_KEYS[0]), F.lit(rounds))
    parts = [store(mark_rows(rows.filter(of == i), cfg, metrics, split, carry).drop(*drop)) for i in range(rounds)]
    return reduce(DataFrame.unionByName, parts), True


def tagged(rows: DataFrame, metrics: Mapping[str, str] | None = None) -> DataFrame:
    """A copy of each row for each metric in its mask ``kept``, tagged in ``zip_category``."""
    return rows.withColumn("zip_category", F.explode(_tags_of(F.col("kept"), list(metrics or METRICS)))).drop("kept")


# Up to this many metrics the tags of every mask are a constant table.
TABLE_METRICS = 8


def _tags_of(mask: Column, tags: Sequence[str]) -> Column:
    """The tags whose bit is set.  Looked up in a constant, as ``array_compact`` has no generated code and would keep
    the copying of rows, and what is done to the copies, out of it too."""
    if len(tags) > TABLE_METRICS:
        return F.array_compact(F.array(*[F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.lit(t)) for i, t in enumerate(tags)]))
    table = [[F.lit(t) for i, t in enumerate(tags) if m >> i & 1] for m in range(1 << len(tags))]
    empty = F.lit(None).cast("array<string>")
    return F.get(F.array(*[F.array(*t) if t else empty for t in table]), mask.bitwiseAND(F.lit(len(table) - 1)))


def fetch_marked(wide: DataFrame, marks: DataFrame, stored: bool = False) -> DataFrame:
    """The stored rows that ``marks`` keeps, with ``row_num``, the mask ``kept`` and what ``marks`` carries.
    Wide rows are read where they lie and only looked up in the marks, which may be ``stored`` already."""
    return fetch(wide.drop(TIE), marks.filter(F.col("kept") != 0).drop("n", "failed"), stored)


def fetch_kept(wide: DataFrame, marks: DataFrame, metrics: Mapping[str, str] | None = None) -> DataFrame:
    """``fetch_marked``, one copy for each tag."""
    return tagged(fetch_marked(wide, marks), metrics)


def thin_metrics(rows: DataFrame, cfg: ThinConfig, metrics: Mapping[str, str] | None = None,
                 split: str = "auto") -> DataFrame:
    """Kept wide rows, one copy per metric that keeps them, tagged in
    ``zip_category``; plus ``row_num``."""
    return tagged(thin_marked(rows, cfg, metrics, split), metrics)


def thin_marked(rows: DataFrame, cfg: ThinConfig, metrics: Mapping[str, str] | None = None,
                split: str = "auto") -> DataFrame:
    """Kept wide rows with ``row_num`` and the mask ``kept``, to be copied by ``tagged``.  Rows with a
    ``_row_id`` (see :func:`curvethin.sources.rows.with_ids`) are marked by their narrow columns
    and fetched from their files; others are stored first."""
    if ROW_ID not in rows.columns:
        rows = stored_rows(rows)
    return fetch_marked(rows, mark_rows(rows, cfg, metrics, split))


def number_process_rows(rows: DataFrame, cfg: ThinConfig) -> DataFrame:
    """``row_num`` per series, on which kept points are joined back one to one."""
    return number_rows(tied(rows), PROCESS_KEYS, [*PROCESS_ORDER, TIE], "row_num", None, split="auto",
                       max_group_rows=cfg.max_series_rows).drop(TIE)


def join_back(numbered: DataFrame, kept: DataFrame) -> DataFrame:
    """The wide rows of the kept points, one copy for each tag; null keys are equal."""
    return join_same(numbered, kept.select(*PROCESS_KEYS, "row_num", "zip_category"),
                     [*PROCESS_KEYS, "row_num"])


def compressed_output(kept: DataFrame, run_ts: str | _dt.datetime | Column) -> DataFrame:
    """Sink-shaped rows: handle suffixed ``,<tag>,<yyyy-MM-dd>``,
    step_logic_number and row_num dropped, modification stamp = run time and
    user ``spark``; text columns are cast to the sink's types."""
    return _with_handles(_stamped(kept, run_ts), run_ts).select(*OUTPUT_COLUMNS)


def compressed_marked(marked: DataFrame, run_ts: str | _dt.datetime | Column, metrics: Mapping[str, str] | None = None,
                      carry: Sequence[str] = (), shape: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``compressed_output`` of ``tagged`` rows, each row being shaped (by ``shape`` too) before it is copied."""
    rows = _stamped(marked, run_ts)
    rows = shape(rows) if shape else rows
    return _with_handles(tagged(rows, metrics), run_ts).select(*OUTPUT_COLUMNS, *carry)


def _stamped(rows: DataFrame, run_ts: str | _dt.datetime | Column) -> DataFrame:
    rows, ts = sink_types(rows), _time(run_ts)
    return rows.withColumns({"modified_date_time": ts.cast(rows.schema["modified_date_time"].dataType),
                             "modified_user": F.lit(X.WRITER_USER)})


def _with_handles(copies: DataFrame, run_ts: str | _dt.datetime | Column) -> DataFrame:
    return copies.withColumn("handle", X.output_handle("handle", "zip_category", _time(run_ts)))


def _time(run_ts: str | _dt.datetime | Column) -> Column:
    return run_ts if isinstance(run_ts, Column) else F.lit(str(run_ts)).cast("timestamp")


def series_outcome(scored: DataFrame) -> DataFrame:
    """Per series: failed if any metric failed (a bad value in its middle)."""
    return scored.groupBy(*PROCESS_KEYS).agg(F.max(F.col("failed")).alias("failed"))


def update_status(status: DataFrame, keys: DataFrame, value: int | Column,
                  run_ts: str | _dt.datetime | Column,
                  flags: Sequence[str] = FLAG_COLUMNS, broadcast_keys: bool = False) -> DataFrame:
    """New version of the status table: rows of ``keys`` get ``value`` in the
    given flags and a fresh stamp; others are unchanged.

    ``keys`` may carry a ``value`` column (per-key outcome) and a ``run_ts``; ``value`` may
    then be ``F.col("value")``, ``run_ts`` its column.  Status rows that share a key are all updated.  A left join + coalesce, i.e. ``UPDATE ... FROM`` as a new table version.
    """
    ts = run_ts if isinstance(run_ts, Column) else F.lit(str(run_ts)).cast("timestamp")
    k = keys.select(*PROCESS_KEYS, *[c for c in ("value", "run_ts") if c in keys.columns])
    k = k.withColumn("_hit", F.lit(True))
    j = join_same(status, k, PROCESS_KEYS, "left", broadcast_keys)
    hit = F.col("_hit").isNotNull()
    v = value if isinstance(value, Column) else F.lit(value)
    new = {c: F.when(hit, v.cast(status.schema[c].dataType)).otherwise(F.col(c)) for c in flags}
    new["modified_date_time"] = F.when(hit, ts.cast(status.schema["modified_date_time"].dataType)) \
        .otherwise(F.col("modified_date_time"))
    new["modified_user"] = F.when(hit, F.lit(X.WRITER_USER)).otherwise(F.col("modified_user"))
    return j.withColumns(new).select(*status.columns)


def run_time(run_ts: str | _dt.datetime | None = None) -> str:
    """The given run time as text, or the present one (UTC)."""
    if run_ts is None:
        run_ts = _dt.datetime.now(_dt.timezone.utc)
    return run_ts.strftime("%Y-%m-%d %H:%M:%S") if isinstance(run_ts, _dt.datetime) else str(run_ts)


def thin_batch(process: DataFrame, keys: DataFrame, cfg: ThinConfig, run_ts: str, split: str = "auto",
               small: bool = False) -> tuple[DataFrame, DataFrame]:
    """(sink rows, outcome: keys with value 1, or 2 where a metric failed) of the given series keys."""
    rows = load_rows(process, keys, broadcast_keys=small)
    return thin_loaded(rows if ROW_ID in rows.columns else stored_rows(rows), keys, cfg, run_ts, split)


def thin_loaded(rows: DataFrame, keys: DataFrame, cfg: ThinConfig, run_ts: str, split: str = "auto",
                carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``thin_batch`` of rows with ids, which are those of ``keys``; ``carry``: columns that the sink rows keep."""
    marks = store(mark_rows(rows, cfg, split=split, carry=PROCESS_KEYS))
    kept = fetch_marked(rows, marks.drop(*PROCESS_KEYS))
    failed = marks.select(*PROCESS_KEYS, (F.col("failed") != 0).alias("failed"))
    outcome = join_same(keys, series_outcome(failed), PROCESS_KEYS, "left").select(
        *PROCESS_KEYS, F.when(F.coalesce("failed", F.lit(False)), 2).otherwise(1).alias("value"))
    return compressed_marked(kept, run_ts, carry=carry), outcome


class BatchFailed(RuntimeError):
    """A batch whose rows could not be scored or written; ``status`` is the status table with its
    keys set to 2, and the cause is chained."""

    def __init__(self, status: DataFrame):
        super().__init__("the batch failed; its keys are set to 2 in .status")
        self.status = status


def run_batch(process: DataFrame, status: DataFrame, cfg: ThinConfig,
              run_ts: str | _dt.datetime | None, write: Callable[[DataFrame], None],
              shard: int = 0, shards: int = SHARDS, limit: int | None = None,
              split: str = "auto", per_metric_status: bool = False) -> DataFrame:
    """One batch end to end.  Writes the kept rows with ``write`` (one
    distributed write action) and returns the new status table: 1 for the
    batch's series, 2 for series with a failed metric.  If scoring or the
    write raises, raises :class:`BatchFailed` with every batch key at 2.

    per_metric_status: thin only the metrics whose own flag is pending and
    set each flag on its own (1 done, 2 failed); the default thins all five
    metrics of a pending series and sets all five flags together.
    """
    checkpoint_dir(status.sparkSession)
    # one row per batch key: stored, as every later plan reads it
    keys = pending_keys(status, shard, shards, limit).checkpoint(eager=True)
    pairs = pending_pairs(status, keys).checkpoint(eager=True) if per_metric_status else None
    run_ts = run_time(run_ts)
    try:
        if pairs is None:
            out, outcome = thin_batch(process, keys, cfg, run_ts, split, small=limit is not None)
            write(out)
            outcome = outcome.checkpoint(eager=True)
        else:
            rows = number_process_rows(load_rows(process, keys, limit is not None).drop(ROW_ID), cfg)
            scored = store(score_metrics(rows, cfg, split=split, pairs=pairs, position="row_num", out=["keep", "failed"])
                           .select(*PROCESS_KEYS, "row_num", "zip_category", "keep", "failed"))
            write(compressed_output(join_back(rows, scored.filter(F.col("keep"))), run_ts))
            outcome = metric_outcome(pairs, scored).checkpoint(eager=True)
    except Exception as cause:
        failed = (update_status_per_metric(status, pairs.withColumn("value", F.lit(2)), run_ts)
                  if pairs is not None else update_status(status, keys, 2, run_ts))
        raise BatchFailed(failed) from cause
    if pairs is not None:
        return update_status_per_metric(status, outcome, run_ts)
    return update_status(status, outcome, F.col("value"), run_ts)


def current_status(status: DataFrame, outcomes: DataFrame | None) -> DataFrame:
    """The status table with the latest stored outcome of each key in place of its row."""
    if outcomes is None:
        return status
    rest = [c for c in status.columns if c not in PROCESS_KEYS]
    both = status.withColumn("batch", F.lit(-1).cast("bigint")).unionByName(outcomes)
    last = both.groupBy(*PROCESS_KEYS).agg(F.max_by(F.struct(*rest), "batch").alias("row"))
    return last.select(*PROCESS_KEYS, "row.*").select(*status.columns)


def read_outcomes(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored outcomes, or None before the first batch."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def run_backlog(process: DataFrame, status: DataFrame, outcomes_path: str, cfg: ThinConfig,
                run_ts: str | _dt.datetime, write: Callable[[DataFrame], None],
                shards: int = SHARDS, limit: int | None = None, split: str = "auto",
                per_metric_status: bool = False) -> DataFrame:
    """Batches of every shard until no key is pending; returns the status table then.

    Each batch appends the status rows it set, numbered by batch, to ``outcomes_path`` after its
    rows are written; ``status`` itself is only read.  A run that stopped goes on from what is
    stored.  A failed batch's rows are stored with 2 before its :class:`BatchFailed` is raised.
    """
    spark = status.sparkSession
    for shard in range(shards):
        while True:
            stored = read_outcomes(spark, outcomes_path)
            now = current_status(status, stored)
            if pending_keys(now, shard, shards, limit=1).isEmpty():
                break
            batch = 0 if stored is None else stored.agg(F.max("batch")).first()[0] + 1

            def store(new: DataFrame) -> None:
                changed = join_same(new, pending_keys(now, shard, shards, limit), PROCESS_KEYS,
                                    "left_semi")
                (changed.withColumn("batch", F.lit(batch).cast("bigint"))
                 .write.mode("append").parquet(outcomes_path))

            try:
                store(run_batch(process, now, cfg, run_ts, write, shard, shards, limit, split,
                                per_metric_status))
            except BatchFailed as failed:
                store(failed.status)
                raise
    return current_status(status, read_outcomes(spark, outcomes_path))
