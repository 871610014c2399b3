"""Incremental batches: two key files arrive; each micro-batch thins its keys."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from curvethin.config import ThinConfig
from curvethin.plans import pipeline as P
from curvethin.sources import fixtures as FX
from curvethin.streaming.incremental import start


def test_incremental_stream(spark):
    base = tempfile.mkdtemp(prefix="curvethin-stream-")
    keys_dir, out_dir, status_dir, ck = (os.path.join(base, d) for d in
                                         ("keys", "out", "status", "ck"))
    status = FX.status_rows(spark, SF_SMALL)
    even = P.pending_keys(status, 0, limit=None)
    odd = P.pending_keys(status, 1, limit=None)
    pend = status.join(even.unionByName(odd), FX.PROCESS_KEYS)
    pend.join(even, FX.PROCESS_KEYS).write.parquet(os.path.join(keys_dir, "a"))
    pend.join(odd, FX.PROCESS_KEYS).write.parquet(os.path.join(keys_dir, "b"))
    flat = spark.read.parquet(os.path.join(keys_dir, "a"))
    q = start(spark, FX.process_rows(spark, SF_SMALL), keys_dir + "/*", flat.schema, out_dir,
              status_dir, ck, ThinConfig(target=0.5), max_files_per_trigger=1)
    q.awaitTermination(600)
    outcome = spark.read.parquet(status_dir)
    assert outcome.count() == even.count() + odd.count()
    assert outcome.filter(F.col("status") != 1).count() == 0
    rows = spark.read.parquet(out_dir)
    assert rows.join(even.unionByName(odd), FX.PROCESS_KEYS, "left_anti").count() == 0
    assert rows.select(*FX.PROCESS_KEYS).distinct().count() == even.count() + odd.count()
