"""Registered queries: one per operator of the inventory, each reading the
driver's tables (``sf_dir``) through the fixture views.

Every query returns plain column types (bigint, double, string, boolean) with
the same names as its oracle in :mod:`curvethin.plans.oracle`.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ThinConfig
from ..functions import exprs as X
from ..operators import series as S
from ..operators.thin import level_view, score, thin, unpivot_metrics
from ..session import checkpoint_dir
from ..sources import fixtures as FX
from ..sources.io import config_literals, normalize_blank, read_config, read_ordered, write_ordered
from ..sources.sinks import ParquetSink
from . import pipeline as P
from .ledger import Ledger, run_ledger

# Parameters of the registered queries (fixed so Spark and SQL agree).
CFG_A = ThinConfig(target=0.5)
CFG_B = ThinConfig(target=0.5)
CFG_C = ThinConfig(target=0.3)
LEVEL = 3                # fixed level for the step-by-step queries (p = 0.30000000000000004)
RUN_TS = "2024-06-30 12:00:00"
B_KEYS, B_ORDER = ["user_id"], ["ts", "event_id"]
C_KEYS = ["event_type"]
PAGE = 250               # keys in a page of the backlog queries

Query = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Plain types for comparison: ints -> bigint, decimals -> double,
    timestamps -> 'yyyy-MM-dd HH:mm:ss' text."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType
        c = F.col(f.name)
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, X.DATETIME_FORMAT)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def r6(c) -> "F.Column":
    return F.round(X.col(c), 6)


# --------------------------------------------------------------- fixtures
def _a_rows(spark, sf):
    """A: repaired process rows numbered per series (the load query)."""
    rows = P.load_rows(FX.process_rows(spark, sf), None)
    return S.number_rows(rows, FX.PROCESS_KEYS, FX.PROCESS_ORDER, "row_num", "n", split="auto")


def _b_numbered(spark, sf):
    return S.number_rows(FX.events_by_user(spark, sf), B_KEYS, B_ORDER, "row_num", "n",
                         split="auto")


def _b_level(spark, sf, cfg=CFG_B):
    return level_view(FX.events_by_user(spark, sf), B_KEYS, B_ORDER, "value", cfg, LEVEL)


# ------------------------------------------------------------- scans etc.
def q_scan_process_rows(spark, sf):
    return present(_a_rows(spark, sf).drop("n"))


def q_normalize_blank(spark, sf):
    d = normalize_blank(FX.process_rows(spark, sf), ["pv_sub_channel_1", "pv_sub_channel_2"])
    return d.select("handle", "pv_sub_channel_1", "pv_sub_channel_2",
                    F.coalesce("pv_sub_channel_1", F.lit("null")).alias("sub_channel_1_text"),
                    F.col("pv_sub_channel_1").isNull().alias("sub_channel_1_missing"))


def q_config_broadcast(spark, sf):
    cfg = read_config(FX.config_rows(spark, sf))
    sizes = S.series_sizes(FX.process_rows(spark, sf), FX.PROCESS_KEYS)
    return present(sizes.select(*FX.PROCESS_KEYS, "n", *config_literals(cfg),
                                (F.col("n") > F.lit(cfg.threshold)).alias("thinnable")))


def q_pending_keys(spark, sf):
    return present(P.pending_keys(FX.status_rows(spark, sf), 0, limit=P.BATCH_KEYS))


def q_shard_odd(spark, sf):
    return present(P.pending_keys(FX.status_rows(spark, sf), 1, limit=P.BATCH_KEYS))


def q_load_pending_rows(spark, sf):
    keys = P.pending_keys(FX.status_rows(spark, sf), 0)
    rows = P.load_rows(FX.process_rows(spark, sf), keys)
    rows = S.number_rows(rows, FX.PROCESS_KEYS, FX.PROCESS_ORDER, "row_num", None, split="auto")
    return present(rows.select("handle", *FX.PROCESS_KEYS, "sequence_id", "row_num",
                               "pv_charge_capacity", "pv_charge_energy"))


def _repair(spark, sf, a, b):
    d = FX.process_rows(spark, sf)
    return present(d.select("handle", F.col(a).alias("raw"), F.col(b).alias("fallback"),
                            X.repair(a, b).alias("repaired")))


def q_repair_capacity(spark, sf):
    return _repair(spark, sf, "pv_charge_capacity", "pv_discharge_capacity")


def q_repair_energy(spark, sf):
    return _repair(spark, sf, "pv_charge_energy", "pv_discharge_energy")


def q_series_key(spark, sf):
    d = FX.process_rows(spark, sf)
    return d.select("handle", X.series_key_text(FX.PROCESS_KEYS).alias("series_key"))


def q_series_size(spark, sf):
    return present(S.series_sizes(FX.process_rows(spark, sf), FX.PROCESS_KEYS))


def q_series_size_events(spark, sf):
    return present(S.series_sizes(FX.events_by_user(spark, sf), B_KEYS))


def q_number_rows(spark, sf):
    return present(_a_rows(spark, sf).select("handle", "row_num"))


def q_passthrough_series(spark, sf):
    d = S.passthrough_rows(_a_rows(spark, sf), CFG_A)
    return present(d.select("handle", "row_num", "n"))


def q_thinnable_series(spark, sf):
    d = S.thinnable_rows(_a_rows(spark, sf), CFG_A)
    return present(d.select("handle", "row_num", "n"))


def _b_region(spark, sf, fn):
    d = fn(_b_numbered(spark, sf), CFG_B)
    return present(d.select("user_id", "event_id", "row_num", "mpos"))


def q_series_head(spark, sf):
    return _b_region(spark, sf, S.head_rows)


def q_series_tail(spark, sf):
    return _b_region(spark, sf, S.tail_rows)


def q_series_middle(spark, sf):
    return _b_region(spark, sf, S.middle_rows)


def q_unpivot_metrics(spark, sf):
    d = _a_rows(spark, sf)
    long = unpivot_metrics(d, [*FX.PROCESS_KEYS, "row_num"], P.METRICS, "zip_category", "y")
    return present(long)


# ------------------------------------------------------- thinning steps (B)
def q_neighbours(spark, sf):
    d = _b_level(spark, sf).filter(F.col("sig").isNotNull())
    return present(d.select("user_id", "row_num", "x_prev", "y_prev", "x_next", "y_next"))


def q_point_significance(spark, sf):
    d = _b_level(spark, sf).filter(F.col("sig").isNotNull())
    return present(d.select("user_id", "row_num", "sig"))


def q_rank_points(spark, sf):
    d = _b_level(spark, sf).filter(F.col("rnk").isNotNull())
    return present(d.select("user_id", "row_num", "rnk"))


def q_top_fraction(spark, sf):
    p = CFG_B.levels()[LEVEL - 1]
    d = _b_level(spark, sf).filter(F.col("rnk").isNotNull())
    d = d.filter(F.col("rnk") <= X.level_cut(F.col("n_mid") - 2, p))
    return present(d.select("user_id", "row_num", "rnk"))


def _b_sets(spark, sf):
    d = _b_level(spark, sf)
    allp = d.select("user_id", "row_num", "y")
    chosen = d.filter(F.col("rnk").isNotNull() & F.col("kept")).select("user_id", "row_num", "y")
    ends = d.filter(F.col("entry") == 0).select("user_id", "row_num", "y")
    return allp, chosen, ends


def q_kept_points(spark, sf):
    allp, chosen, ends = _b_sets(spark, sf)
    return present(allp.intersectAll(chosen).unionByName(ends))


def q_dropped_points(spark, sf):
    allp, chosen, ends = _b_sets(spark, sf)
    return present(allp.exceptAll(chosen).exceptAll(ends))


def q_level_flags(spark, sf):
    d = _b_level(spark, sf)
    return present(d.select("user_id", "row_num", "y", F.col("kept").cast("int").alias("flag")))


def q_nearest_kept(spark, sf):
    d = _b_level(spark, sf).filter(~F.col("kept"))
    return present(d.select("user_id", "row_num", F.col("prev.x").alias("prev_x"),
                            F.col("prev.y").alias("prev_y"), F.col("next.x").alias("next_x"),
                            F.col("next.y").alias("next_y")))


def q_nearest_kept_first(spark, sf):
    cfg = CFG_B.with_(leading_anchor="first")
    d = _b_level(spark, sf, cfg).filter(~F.col("kept"))
    return present(d.select("user_id", "row_num", F.col("prev.x").alias("prev_x"),
                            F.col("prev.y").alias("prev_y"), F.col("next.x").alias("next_x"),
                            F.col("next.y").alias("next_y")))


def q_interpolate(spark, sf):
    d = _b_level(spark, sf)
    return present(d.select("user_id", "row_num", "y", r6("yhat").alias("yhat")))


def q_fit_quality(spark, sf):
    d = _b_level(spark, sf)
    err = (F.col("yhat") - F.col("y")) * (F.col("yhat") - F.col("y"))
    g = d.groupBy("user_id").agg(F.sum("y").alias("sum_y"), F.count("y").alias("n_points"),
                                 F.sum(err).alias("sse"),
                                 (F.var_pop("y") * F.count("y")).alias("sst"),
                                 (F.min("y") == F.max("y")).alias("flat"))
    sst = F.when(F.col("flat"), F.lit(0.0)).otherwise(F.col("sst"))
    # sums reach ~1e5: 3 decimals keep them clear of summation-order noise
    # the mean is sum_y / n_points; the mean itself can sit on a rounding half
    return present(g.select("user_id", F.round("sum_y", 3).alias("sum_y"), "n_points",
                            F.round("sse", 3).alias("sse"), F.round(sst, 3).alias("sst"),
                            r6(X.fit(F.col("sse"), sst)).alias("fit")))


def _b_scored(spark, sf, cfg=CFG_B, split="auto"):
    return score(FX.events_by_user(spark, sf), B_KEYS, B_ORDER, "value", cfg, detail=True,
                 split=split)


def q_fit_by_level(spark, sf):
    s = _b_scored(spark, sf).filter(F.col("level").isNotNull())
    s = s.select("user_id", "level_fits").dropDuplicates(["user_id"])
    return present(s.select("user_id", F.posexplode("level_fits").alias("pos", "fit"))
                   .select("user_id", (F.col("pos") + 1).alias("level"), r6("fit").alias("fit")))


def _chosen(s, keys):
    s = s.filter(F.col("level").isNotNull()).select(*keys, "level", "fit")
    return present(s.dropDuplicates(keys).select(*keys, "level", r6("fit").alias("fit")))


def q_chosen_level(spark, sf):
    return _chosen(_b_scored(spark, sf), B_KEYS)


def q_chosen_level_by_type(spark, sf):
    s = score(FX.events_by_type(spark, sf), C_KEYS, B_ORDER, "value", CFG_C, out=["level", "fit"])
    return _chosen(s, C_KEYS)


def _thin_b(spark, sf, cfg):
    d = thin(FX.events_by_user(spark, sf), B_KEYS, B_ORDER, "value", cfg)
    return present(d.select("user_id", "event_id", "row_num"))


def q_thin_series(spark, sf):
    return _thin_b(spark, sf, CFG_B)


def q_thin_series_first_anchor(spark, sf):
    return _thin_b(spark, sf, CFG_B.with_(leading_anchor="first"))


def q_thin_series_by_type(spark, sf):
    d = thin(FX.events_by_type(spark, sf), C_KEYS, B_ORDER, "value", CFG_C)
    return present(d.select("event_type", "event_id", "row_num"))


def q_thinned_middle(spark, sf):
    s = _b_scored(spark, sf).filter((F.col("region") == "middle") & F.col("keep"))
    return present(s.select("user_id", "event_id", "row_num"))


def q_thinned_rows(spark, sf):
    s = _b_scored(spark, sf).filter(F.col("keep"))
    return present(s.select("user_id", "event_id", "row_num", F.col("region").alias("part")))


# ------------------------------------------------------- process rows (A)
def _a_loaded(spark, sf):
    return P.load_rows(FX.process_rows(spark, sf), None)


def _thin_metric(tag):
    def q(spark, sf):
        rows = _a_loaded(spark, sf)
        cols = [*FX.PROCESS_KEYS, *FX.PROCESS_ORDER, P.METRICS[tag]]
        d = thin(rows.select(*cols), FX.PROCESS_KEYS, FX.PROCESS_ORDER, P.METRICS[tag], CFG_A)
        return present(d.select("handle", *FX.PROCESS_KEYS, "row_num"))
    q.__name__ = f"q_thin_{tag}"
    return q


def q_thin_all_metrics(spark, sf):
    s = P.score_metrics(_a_loaded(spark, sf), CFG_A, out=[], kept_only=True)
    return present(s.select(*FX.PROCESS_KEYS, "row_num", "zip_category"))


def _a_marked(spark, sf, metrics=None, drop=()):
    """Kept wide rows of the stored table, not yet copied for each tag: narrow columns are thinned, wide rows
    fetched by their ids; of the marks those in ``drop`` are not wanted."""
    rows, table = FX.process_source(spark, sf)
    marks = P.mark_source(P.repair_metrics(rows), table, CFG_A, metrics, carry=["sequence_id"], drop=drop)
    return P.repair_metrics(FX.process_view(P.fetch_marked(table, *marks)))


def q_keep_wide_rows(spark, sf):
    cols = ["row_num", "sequence_id", "site", "sfc", "pv_voltage", "pv_current", "pv_temperature",
            "pv_charge_capacity", "pv_charge_energy", "created_date_time"]
    return P.tagged(present(_a_marked(spark, sf).select("handle", *cols, "kept"))).select("handle", "zip_category", *cols)


def q_string_metrics(spark, sf):
    """Metrics read as text, some of it no number: only the (series, metric) pairs with one in
    their middle fail."""
    bad = (F.col("sequence_id") % 50 == 0) & F.col("step_id").isin(1, 2)
    d = _a_loaded(spark, sf)
    d = d.withColumns({c: F.col(c).cast("string") for c in P.METRICS.values()})
    d = d.withColumn("pv_voltage", F.when(bad, F.lit("n/a")).otherwise(F.col("pv_voltage")))
    s = P.score_metrics(d, CFG_A)
    return present(s.groupBy(*FX.PROCESS_KEYS, "zip_category").agg(
        F.max("failed").alias("failed"), F.sum(F.col("keep").cast("int")).alias("rows_kept")))


def q_typed_sink(spark, sf):
    """The sink's rows of a source whose columns are all text."""
    metrics = {"V": "pv_voltage"}
    kept = P.tagged(_a_marked(spark, sf, metrics), metrics)
    text = kept.select(*[F.col(c).cast("string").alias(c) for c in kept.columns])
    return present(P.compressed_output(text, RUN_TS).select(
        "handle", "sequence_id", "step_id", "pv_voltage", "pv_charge_energy", "created_date_time"))


def q_keep_repeated_rows(spark, sf):
    """The join back where keys and handles are null and rows occur twice."""
    d = _a_loaded(spark, sf)
    d = d.unionByName(d.filter(F.col("step_id") == 3))
    d = d.withColumns({"remark": F.when(F.col("remark") != "1", F.col("remark")),
                       "handle": F.when(F.col("step_id") != 2, F.col("handle"))})
    cols = ["row_num", "sequence_id", "site", "pv_voltage", "created_date_time"]
    kept = P.tagged(present(P.thin_marked(d, CFG_A).select("handle", "remark", *cols, "kept")))
    return kept.select("handle", "remark", "zip_category", *cols)


def q_split_and_rejoin(spark, sf):
    d = FX.process_rows(spark, sf)
    cols = FX.PROCESS_COLUMNS
    p1 = d.select(*cols[0:16])
    p2 = d.select("handle", *cols[16:31])
    p3 = d.select("handle", *cols[31:45])
    out = p1.join(p2, ["handle"], "left_outer").join(p3, ["handle"], "left_outer")
    return present(out.drop("step_logic_number"))


def q_split_fields(spark, sf):
    d = FX.process_rows(spark, sf)
    text = F.concat_ws(X.FIELD_SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit("null"))
                                            for c in ("handle", "site", "remark", "step_id",
                                                      "pv_sub_channel_2")])
    parts = F.split(text, X.FIELD_SEPARATOR)
    return d.select("handle", F.size(parts).cast("bigint").alias("n_fields"),
                    F.element_at(parts, 3).alias("remark"),
                    F.element_at(parts, 4).cast("bigint").alias("step_id"),
                    F.element_at(parts, 5).alias("sub_channel_2"))


def q_scalar_kit(spark, sf):
    d = FX.process_rows(spark, sf)
    return present(d.select(
        "handle",
        F.pmod(F.col("step_id"), F.lit(2)).alias("step_mod"),
        X.repair("pv_charge_capacity", "pv_discharge_capacity").alias("repaired"),
        X.series_key_text(FX.PROCESS_KEYS).alias("series_key"),
        F.size(F.split(F.col("handle"), "-")).alias("handle_parts"),
        F.date_format("timestamp", X.DATE_FORMAT).alias("day"),
        F.floor(F.col("pv_current").cast("double") * F.lit(0.30000000000000004)).alias("cut"),
        F.abs(F.col("pv_voltage").cast("double") - F.lit(0.05)).alias("dist"),
        F.round(F.sqrt(F.col("pv_temperature").cast("double")), 6).alias("root"),
        F.col("sequence_id").cast("double").alias("x"),
    ))


def q_compressed_output(spark, sf):
    return P.compressed_marked(_a_marked(spark, sf, drop=["row_num"]), RUN_TS, shape=present)


def _status_update(spark, sf, value):
    status = FX.status_rows(spark, sf)
    keys = P.pending_keys(status, 0)
    return present(P.update_status(status, keys, value, RUN_TS))


def q_status_after_success(spark, sf):
    return _status_update(spark, sf, 1)


def q_status_after_failure(spark, sf):
    return _status_update(spark, sf, 2)


def q_status_per_metric(spark, sf):
    """Per-metric outcome: only pending flags of the batch are thinned and set."""
    status = FX.status_rows(spark, sf)
    checkpoint_dir(spark)
    # stored once, as run_batch does: several branches of the plan read them
    keys = P.pending_keys(status, 0).checkpoint(eager=True)
    pairs = P.pending_pairs(status, keys).checkpoint(eager=True)
    scored = P.score_metrics(P.load_rows(FX.process_rows(spark, sf), keys), CFG_A, pairs=pairs)
    return present(P.update_status_per_metric(status, P.metric_outcome(pairs, scored), RUN_TS))


LOAD_ORDER = [*FX.PROCESS_KEYS, *FX.PROCESS_ORDER]


def q_ordered_load(spark, sf):
    """Process rows stored in key and sequence order, each with its place in the stored files."""
    path = f"{checkpoint_dir(spark)}/ordered-{uuid.uuid4().hex}"
    rows = FX.process_rows(spark, sf).select(*LOAD_ORDER, "pv_voltage")
    write_ordered(rows, path, LOAD_ORDER, rows_per_file=20_000)
    return present(read_ordered(spark, path))


def _backlog(spark, sf):
    """The whole backlog, page by page, into a sink whose batches count once: (status after, the sink's rows)."""
    root = f"{checkpoint_dir(spark)}/backlog-{uuid.uuid4().hex}"
    ledger, sink = Ledger(spark, f"{root}/ledger"), ParquetSink(spark, f"{root}/sink")
    ledger.publish(FX.status_rows(spark, sf))
    return run_ledger(FX.process_rows(spark, sf), ledger, sink, CFG_A, RUN_TS, limit=PAGE), sink


def q_backlog_status(spark, sf):
    return present(_backlog(spark, sf)[0])


def q_backlog_rows(spark, sf):
    rows = _backlog(spark, sf)[1].read()
    return present(rows.select("handle", "zip_category", "sequence_id", "pv_voltage", "pv_charge_energy"))


def _report(s, keys):
    g = s.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.sum(F.col("keep").cast("int")).alias("rows_out"),
        F.max("level").alias("level"), F.max("fit").alias("fit"))
    return present(g.select(*keys, "rows_in", "rows_out",
                            r6(F.col("rows_out") / F.col("rows_in")).alias("ratio"),
                            "level", r6("fit").alias("fit")))


def q_compression_report(spark, sf):
    s = P.score_metrics(_a_loaded(spark, sf), CFG_A)
    return _report(s, [*FX.PROCESS_KEYS, "zip_category"])


def q_compression_report_events(spark, sf):
    return _report(_b_scored(spark, sf), B_KEYS)


QUERIES: dict[str, Query] = {
    "scan_process_rows": q_scan_process_rows,
    "normalize_blank": q_normalize_blank,
    "config_broadcast": q_config_broadcast,
    "pending_keys": q_pending_keys,
    "shard_odd": q_shard_odd,
    "load_pending_rows": q_load_pending_rows,
    "repair_capacity": q_repair_capacity,
    "repair_energy": q_repair_energy,
    "series_key": q_series_key,
    "series_size": q_series_size,
    "series_size_events": q_series_size_events,
    "number_rows": q_number_rows,
    "passthrough_series": q_passthrough_series,
    "thinnable_series": q_thinnable_series,
    "series_head": q_series_head,
    "series_tail": q_series_tail,
    "series_middle": q_series_middle,
    "unpivot_metrics": q_unpivot_metrics,
    "neighbours": q_neighbours,
    "point_significance": q_point_significance,
    "rank_points": q_rank_points,
    "top_fraction": q_top_fraction,
    "kept_points": q_kept_points,
    "dropped_points": q_dropped_points,
    "level_flags": q_level_flags,
    "nearest_kept": q_nearest_kept,
    "nearest_kept_first": q_nearest_kept_first,
    "interpolate": q_interpolate,
    "fit_quality": q_fit_quality,
    "fit_by_level": q_fit_by_level,
    "chosen_level": q_chosen_level,
    "chosen_level_by_type": q_chosen_level_by_type,
    "thin_series": q_thin_series,
    "thin_series_first_anchor": q_thin_series_first_anchor,
    "thin_series_by_type": q_thin_series_by_type,
    "thinned_middle": q_thinned_middle,
    "thinned_rows": q_thinned_rows,
    "thin_capacity": _thin_metric("C"),
    "thin_energy": _thin_metric("E"),
    "thin_current": _thin_metric("I"),
    "thin_temperature": _thin_metric("T"),
    "thin_voltage": _thin_metric("V"),
    "thin_all_metrics": q_thin_all_metrics,
    "keep_wide_rows": q_keep_wide_rows,
    "keep_repeated_rows": q_keep_repeated_rows,
    "string_metrics": q_string_metrics,
    "typed_sink": q_typed_sink,
    "split_and_rejoin": q_split_and_rejoin,
    "split_fields": q_split_fields,
    "scalar_kit": q_scalar_kit,
    "compressed_output": q_compressed_output,
    "status_after_success": q_status_after_success,
    "status_after_failure": q_status_after_failure,
    "status_per_metric": q_status_per_metric,
    "ordered_load": q_ordered_load,
    "backlog_status": q_backlog_status,
    "backlog_rows": q_backlog_rows,
    "compression_report": q_compression_report,
    "compression_report_events": q_compression_report_events,
}
