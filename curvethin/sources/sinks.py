"""Sinks whose batches take effect once.

A batch's rows are first staged, by a distributed write that may fail or be repeated, and then committed in one
step under the batch's name. Staging again starts afresh; committing again does nothing. Rows that were
staged but not committed are not part of the table. A sink with ``many`` also takes a list of batches, whose rows name theirs in
a column ``batch``: they are staged by one write and committed in one step; those committed before stay as they are.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce
from typing import Any, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import store
from .files import Records
from .io import read_jdbc, write_jdbc


class ParquetSink:
    """A folder of Parquet files, a subfolder for what is staged at once; a record names the subfolder that counts,
    and for a list of batches those of its rows that do."""

    many = True

    def __init__(self, spark: SparkSession, root: str, partition_by: tuple[str, ...] = ("zip_category",)):
        self.spark, self.root, self.partition_by = spark, root.rstrip("/"), partition_by
        self._records = Records(spark, f"{self.root}/_batches")

    def stage(self, rows: DataFrame, batch: str | list[str]) -> str:
        name = batch if isinstance(batch, str) else f"{batch[0]}+{len(batch)}"
        folder = f"_staged={name}-{uuid.uuid4().hex}"
        rows.write.partitionBy(*self.partition_by).parquet(f"{self.root}/rows/{folder}")
        return folder

    def commit(self, batch: str | list[str], staged: str) -> None:
        if isinstance(batch, str) and self._records.get(batch) is not None:
            return
        done = {b for _, some, _ in self._committed(several=isinstance(batch, str)) for b in some}
        if isinstance(batch, str):
            if batch not in done:
                self._records.put(batch, staged)
        elif new := [b for b in batch if b not in done]:
            text = json.dumps({"staged": staged, "batches": new, "all": len(new) == len(batch)})
            self._records.put(f"{new[0]}+{len(new)}", text)

    def _committed(self, several: bool = False) -> list[tuple[str, list[str], bool]]:
        """(subfolder, its batches that count, whether those are all) of each record, or of those of lists."""
        out = []
        for name in self._records.names(""):
            if name.startswith("_") or (several and "+" not in name):
                continue
            text = self._records.get(name)
            r = json.loads(text) if text.startswith("{") else {"staged": text, "batches": [name], "all": True}
            out.append((r["staged"], r["batches"], r["all"]))
        return out

    def read(self) -> DataFrame | None:
        """The committed rows, or None before the first batch."""
        committed, base = self._committed(), f"{self.root}/rows"
        load = lambda folders: self.spark.read.option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])
        parts = [load(whole).drop("_staged", "batch")] if (whole := [f for f, _, every in committed if every]) else []
        parts += [load([f]).filter(F.col("batch").isin(some)).drop("_staged", "batch") for f, some, every in committed if not every]
        return reduce(DataFrame.unionByName, parts) if parts else None


class JdbcSink:
    """A database table. Rows are staged in ``<table>_STAGE``; a batch is committed by one transaction that moves its
    rows inside the database and notes its name in ``<table>_BATCHES``."""

    def __init__(self, spark: SparkSession, url: str, table: str, options: Mapping[str, Any] | None = None):
        self.spark, self.url, self.table, self.options = spark, url, table, dict(options or {})

    def _run(self, work):
        """``work(connection)`` in one transaction."""
        jvm = self.spark.sparkContext._jvm
        properties = jvm.java.util.Properties()
        for k, v in self.options.items():
            properties.setProperty(k, str(v))
        if "driver" in self.options:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.options["driver"])
        c = jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            c.setAutoCommit(False)
            out = work(c)
            c.commit()
            return out
        except Exception:
            c.rollback()
            raise
        finally:
            c.close()

    def _update(self, c, sql: str, *args: str) -> None:
        s = c.prepareStatement(sql)
        for i, a in enumerate(args, 1):
            s.setString(i, a)
        s.executeUpdate()
        s.close()

    def _exists(self, c, table: str) -> bool:
        found = c.getMetaData().getTables(None, None, table.upper(), None)
        try:
            return bool(found.next())
        finally:
            found.close()

    def _rows(self, c, batch: str) -> int:
        s = c.prepareStatement(f"SELECT COUNT(*) FROM {self.table}_STAGE WHERE BATCH_NAME = ?")
        s.setString(1, batch)
        r = s.executeQuery()
        r.next()
        n = r.getLong(1)
        s.close()
        return n

    def stage(self, rows: DataFrame, batch: str) -> str:
        rows = store(rows)
        want = rows.count()
        types = {**self.options, "createTableColumnTypes": "BATCH_NAME VARCHAR(200)"}
        write_jdbc(rows.limit(0), self.url, self.table, self.options)  # the target, if it isn't there
        for _ in range(3):
            self._run(lambda c: self._exists(c, f"{self.table}_STAGE") and self._update(c, f"DELETE FROM {self.table}_STAGE WHERE BATCH_NAME = ?", batch))
            write_jdbc(rows.withColumn("BATCH_NAME", F.lit(batch)), self.url, f"{self.table}_STAGE", types)
            # a task whose transaction went through before it was lost has written twice
            if self._run(lambda c: self._rows(c, batch)) == want:
                return ",".join(f'"{c}"' for c in rows.columns)
        raise RuntimeError(f"batch {batch} could not be staged: its rows are not {want}")

    def commit(self, batch: str, staged: str) -> None:
        def work(c) -> None:
            if not self._exists(c, f"{self.table}_BATCHES"):
                self._update(c, f"CREATE TABLE {self.table}_BATCHES (BATCH_NAME VARCHAR(200) PRIMARY KEY)")
            s = c.prepareStatement(f"SELECT COUNT(*) FROM {self.table}_BATCHES WHERE BATCH_NAME = ?")
            s.setString(1, batch)
            r = s.executeQuery()
            r.next()
            done = r.getLong(1)
            s.close()
            if not done:
                self._update(c, f"INSERT INTO {self.table} ({staged}) SELECT {staged} FROM {self.table}_STAGE WHERE BATCH_NAME = ?", batch)
                self._update(c, f"INSERT INTO {self.table}_BATCHES VALUES (?)", batch)
            self._update(c, f"DELETE FROM {self.table}_STAGE WHERE BATCH_NAME = ?", batch)

        self._run(work)

    def read(self) -> DataFrame:
        return read_jdbc(self.spark, self.url, table=self.table, options=self.options)
