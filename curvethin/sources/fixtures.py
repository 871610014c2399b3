"""Views of the driver's tables in the shapes the thinning job reads.

A  lineitem as process rows (many short series, five metrics)
A-status  pending / done / failed flags for A's series keys
B  events by user (one metric, ~66 rows per series)
C  events by type (5 long series)

The same views are written in SQL in :mod:`curvethin.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.series import number_rows
from .io import read_table
from .rows import with_ids

DEC = "decimal(20,6)"

# The process-row columns of the original job, in source order.
PROCESS_COLUMNS = [
    "handle", "site", "remark", "sfc", "resource_id", "channel_id", "sequence_id", "cycle",
    "step_id", "step_name", "step_logic_number", "test_time_duration", "timestamp",
    "sv_ic_range", "sv_iv_range", "pv_voltage", "pv_current", "pv_ir", "pv_temperature",
    "pv_charge_capacity", "pv_discharge_capacity", "pv_charge_energy", "pv_discharge_energy",
    "pv_sub_channel_1", "pv_sub_channel_2", "pv_sub_channel_3", "pv_sub_channel_4",
    "pv_sub_channel_5", "pv_sub_channel_6", "pv_data_flag", "pv_work_type",
    "tx_is_exceptional", "tx_alert_current", "tx_alert_voltage", "tx_alert_temperature",
    "tx_alert_capacity", "tx_alert_duration", "tx_alert_category1", "tx_alert_category2",
    "tx_root_remark", "st_business_cycle", "created_date_time", "created_user",
    "modified_date_time", "modified_user",
]
STATUS_COLUMNS = ["remark", "st_business_cycle", "step_id", "c_status", "e_status", "i_status",
                  "t_status", "v_status", "modified_date_time", "modified_user"]
FLAG_COLUMNS = ["c_status", "e_status", "i_status", "t_status", "v_status"]
PROCESS_KEYS = ["remark", "st_business_cycle", "step_id"]
PROCESS_ORDER = ["sequence_id", "handle"]
FIXTURE_TIME = "2024-01-01 00:00:00"


def process_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture A: lineitem viewed as raw process rows (45 columns)."""
    return process_view(_in_sequence(read_table(spark, sf_dir, "lineitem"))).select(*PROCESS_COLUMNS)


def process_source(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Fixture A as a stored table with row ids: (its rows in sequence, of which a plan takes the narrow columns it
    needs, and the table that wide rows are fetched from, to be seen through :func:`process_view`)."""
    li = with_ids(read_table(spark, sf_dir, "lineitem"))
    return process_view(_in_sequence(li)), li


def _in_sequence(li: DataFrame) -> DataFrame:
    """Numbered by the text of the key that series have, so that rows lie by series already."""
    seq_order = ["l_shipdate", "l_orderkey", "l_linestatus", "l_linenumber", "l_partkey",
                 "l_extendedprice"]
    li = li.withColumn("remark", F.col("l_suppkey").cast("string"))
    return number_rows(li, ["remark"], seq_order, "sequence_id", None, split="auto")


def process_view(li: DataFrame) -> DataFrame:
    """Lineitem rows with their ``sequence_id`` as process rows; further columns stay."""
    remark = F.col("remark") if "remark" in li.columns else F.col("l_suppkey").cast("string")
    cyc = (F.col("l_linestatus") == "F").cast("int")
    step = F.col("l_linenumber").cast("int")
    null_s = F.lit(None).cast("string")
    cols = {
        "handle": F.concat_ws("-", remark, cyc.cast("string"), step.cast("string"),
                              F.col("sequence_id").cast("string")),
        "site": F.col("l_returnflag"),
        "remark": remark,
        "sfc": F.col("l_orderkey").cast("string"),
        "resource_id": F.col("l_partkey").cast("string"),
        "channel_id": step,
        "sequence_id": F.col("sequence_id").cast("int"),
        "cycle": F.year("l_shipdate").cast("int"),
        "step_id": step,
        "step_name": F.col("l_linestatus"),
        "step_logic_number": step,
        "test_time_duration": F.col("l_quantity").cast(DEC),
        "timestamp": F.col("l_shipdate"),
        "sv_ic_range": F.col("l_discount").cast(DEC),
        "sv_iv_range": F.col("l_tax").cast(DEC),
        "pv_voltage": F.col("l_tax").cast(DEC),
        "pv_current": F.col("l_quantity").cast(DEC),
        "pv_ir": F.col("l_discount").cast(DEC),
        "pv_temperature": (F.col("l_extendedprice") / 1000).cast(DEC),
        "pv_charge_capacity": F.col("l_discount").cast(DEC),
        "pv_discharge_capacity": F.col("l_tax").cast(DEC),
        "pv_charge_energy": F.when(F.col("l_returnflag") == "R", F.lit(0.0))
                             .otherwise(F.col("l_extendedprice")).cast(DEC),
        "pv_discharge_energy": F.col("l_extendedprice").cast(DEC),
        "pv_sub_channel_1": F.when(step == 1, F.lit("")).otherwise(
            F.concat(F.col("l_returnflag"), F.col("l_linestatus"))),
        "pv_sub_channel_2": null_s,
        "pv_sub_channel_3": null_s,
        "pv_sub_channel_4": null_s,
        "pv_sub_channel_5": null_s,
        "pv_sub_channel_6": null_s,
        "pv_data_flag": F.lit(0),
        "pv_work_type": (step % 2).cast("int"),
        "tx_is_exceptional": F.lit("N"),
        "tx_alert_current": null_s,
        "tx_alert_voltage": null_s,
        "tx_alert_temperature": null_s,
        "tx_alert_capacity": null_s,
        "tx_alert_duration": null_s,
        "tx_alert_category1": null_s,
        "tx_alert_category2": null_s,
        "tx_root_remark": null_s,
        "st_business_cycle": cyc,
        "created_date_time": F.col("l_shipdate"),
        "created_user": F.lit("gen"),
        "modified_date_time": F.col("l_shipdate"),
        "modified_user": F.lit("gen"),
    }
    further = [c for c in li.columns if c not in cols and not c.startswith("l_")]
    return li.select(*[cols[c].alias(c) for c in PROCESS_COLUMNS], *further)


def status_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture A-status: one row per series key of A; s = (suppkey + linenumber) % 4:
    0 all pending, 1 all done, 2 all failed, 3 done except v_status pending."""
    li = read_table(spark, sf_dir, "lineitem")
    keys = li.select(F.col("l_suppkey").cast("string").alias("remark"),
                     (F.col("l_linestatus") == "F").cast("int").alias("st_business_cycle"),
                     F.col("l_linenumber").cast("int").alias("step_id"),
                     ((F.col("l_suppkey") + F.col("l_linenumber")) % 4).cast("int").alias("s")
                     ).distinct()
    s = F.col("s")
    flag = F.when(s == 0, 0).when(s == 1, 1).when(s == 2, 2).otherwise(1)
    v = F.when(s == 3, 0).otherwise(flag)
    return keys.select("remark", "st_business_cycle", "step_id",
                       *[flag.alias(c) for c in FLAG_COLUMNS[:-1]], v.alias("v_status"),
                       F.to_timestamp(F.lit(FIXTURE_TIME)).alias("modified_date_time"),
                       F.lit("gen").alias("modified_user"))


def config_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-row tuning table: 12 text columns by position, its values counted from ``region``."""
    n = F.count(F.lit(1))
    at = {2: n * 10, 3: n * 2, 4: n * 2, 5: n / 10, 6: n / 50, 7: n / 50}
    return read_table(spark, sf_dir, "region").agg(
        *[at.get(i, F.lit(None)).cast("string").alias(f"c{i}") for i in range(12)])


def events_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture B source: key user_id, order (ts, event_id), metric value."""
    return read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")


def events_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture C source: key event_type, order (ts, event_id), metric value."""
    return read_table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value")
