"""Incremental batches with Structured Streaming.

The original job is re-run on a schedule and each run takes the series whose
status is pending.  Here new pending keys arrive as files (one row per
series key, status-table shape); every micro-batch runs the batch pipeline on
the keys it received: the process rows of those keys are read from the
(batch) process table, all five metrics are thinned, the kept rows are
appended to the sink and the keys' outcome (1 done / 2 failed) is appended to
a status-update table.  The stream's checkpoint records which key files are
done, so a restart resumes after the last committed micro-batch.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import ThinConfig
from ..plans import pipeline as P
from ..sources.fixtures import PROCESS_KEYS

# Micro-batches with at most this many series keys broadcast them.
BROADCAST_KEYS = 1_000_000


def process_micro_batch(process: DataFrame, keys: DataFrame, cfg: ThinConfig,
                        write_rows: Callable[[DataFrame], None],
                        write_status: Callable[[DataFrame], None],
                        run_ts: str | None = None, split: str = "auto") -> None:
    """Thin the series of ``keys`` (pending rows of a micro-batch).  If that fails, its keys are
    written as failed and the cause is raised."""
    run_ts = P.run_time(run_ts)
    pending = (keys.filter(P.pending_filter()).select(*PROCESS_KEYS)
               .dropDuplicates(PROCESS_KEYS).persist())
    # a micro-batch's key set is broadcast when its counted size allows;
    # otherwise a shuffle join (AQE splits skewed partitions)
    small = pending.count() <= BROADCAST_KEYS

    def done(outcome: DataFrame) -> None:
        write_status(outcome.withColumn("modified_date_time", F.lit(run_ts).cast("timestamp"))
                            .withColumn("modified_user", F.lit("spark")))

    try:
        rows, outcome = P.thin_batch(process, pending, cfg, run_ts, split, small)
        write_rows(rows)
        done(outcome.withColumnRenamed("value", "status"))
    except Exception as cause:
        try:
            done(pending.select(*PROCESS_KEYS, F.lit(2).alias("status")))
        except Exception as second:
            raise second from cause  # neither is lost
        raise
    finally:
        pending.unpersist()


def start(spark: SparkSession, process: DataFrame, keys_dir: str, keys_schema,
          out_dir: str, status_dir: str, checkpoint_location: str, cfg: ThinConfig,
          available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream pending-key files from ``keys_dir``; thinned rows go to
    ``out_dir`` (parquet, partitioned by metric tag), outcomes to
    ``status_dir``."""
    reader = spark.readStream.schema(keys_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(keys_dir)

    def each(batch: DataFrame, batch_id: int) -> None:
        process_micro_batch(
            process, batch, cfg,
            # a batch repeated after a restart replaces its own folder
            lambda df: (df.write.mode("overwrite").partitionBy("zip_category")
                        .parquet(f"{out_dir}/batch={batch_id}")),
            lambda df: df.write.mode("overwrite").parquet(f"{status_dir}/batch={batch_id}"))

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
