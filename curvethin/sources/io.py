"""Readers and writers: parquet tables, JDBC tables, the one-row config.

Credentials and URLs come only from the caller's options.
"""

from __future__ import annotations

from typing import Any, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import ThinConfig
from ..functions.exprs import blank_to_null


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_jdbc(spark: SparkSession, url: str, *, table: str | None = None,
              query: str | None = None, options: Mapping[str, Any] | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetchsize: int = 10_000) -> DataFrame:
    """Read a table or query over JDBC, split into parallel range reads when
    ``partition_column`` and bounds are given (each executor opens its own
    connection; nothing passes through the driver)."""
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", fetchsize)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if partition_column:
        if table is None:
            if query is None:
                raise ValueError("give table or query")
            table = f"({query}) q"
        r = (r.option("dbtable", table).option("partitionColumn", partition_column)
              .option("lowerBound", lower_bound).option("upperBound", upper_bound)
              .option("numPartitions", num_partitions or 8))
    elif query is not None:
        r = r.option("query", query)
    elif table is not None:
        r = r.option("dbtable", table)
    else:
        raise ValueError("give table or query")
    return r.load()


# Histogram buckets asked for at once, for each partition wanted.
BUCKETS = 32


def _histogram(spark: SparkSession, url: str, table: str, column: str, low: int, width: int, buckets: int,
               options: Mapping[str, Any]) -> dict[int, int]:
    """Rows in each of ``buckets`` ranges of ``width`` values from ``low`` on, counted by the database."""
    inside = f"{column} >= {low} AND {column} < {low + width * buckets}"
    sql = (f"SELECT B, COUNT(*) AS N FROM (SELECT ({column} - ({low})) / {width} AS B FROM {table} WHERE {inside}) Q GROUP BY B")
    rows = read_jdbc(spark, url, query=sql, options=options).collect()  # at most ``buckets`` rows
    return {int(r[0]): int(r[1]) for r in rows}


def jdbc_ranges(spark: SparkSession, url: str, table: str, column: str, partitions: int,
                options: Mapping[str, Any] | None = None) -> list[str]:
    """Predicates that cut a table into about ``partitions`` parts of equal size by an integer column, nulls apart.

    The database counts rows in ranges of equal width; ranges that hold more than a part's share are counted again in finer ones,
    until a range is small enough or is a single value. Neighbours are then joined up to a part's share.
    A value that alone has more rows than that is a part of its own, as no range can cut it.
    """
    options = dict(options or {})
    ends = read_jdbc(spark, url, query=f"SELECT MIN({column}) AS LO, MAX({column}) AS HI, COUNT({column}) AS N, COUNT(*) AS A FROM {table}",
                     options=options).first()
    n, every = int(ends[2]), int(ends[3])
    parts = [f"{column} IS NULL"] if every > n else []
    if not n:
        return parts
    low, high = int(ends[0]), int(ends[1])
    share, buckets = max(1, n // max(1, partitions)), BUCKETS * max(1, partitions)
    todo, done = [(low, high + 1, n)], []
    while todo:
        a, b, rows = todo.pop()
        if rows * 4 <= share or b - a == 1:
            done.append((a, b, rows))
            continue
        width = -(-(b - a) // buckets)
        for i, k in _histogram(spark, url, table, column, a, width, -(-(b - a) // width), options).items():
            todo.append((a + i * width, min(b, a + (i + 1) * width), k))
    bounds, held = [], 0
    for a, _, rows in sorted(done):
        if held and held + rows > share * 1.25:
            bounds.append(a)
            held = 0
        held += rows
    edges = [None, *bounds, None]
    for a, b in zip(edges[:-1], edges[1:]):
        said = [f"{column} >= {a}" if a is not None else "", f"{column} < {b}" if b is not None else ""]
        parts.append(" AND ".join(x for x in said if x) or f"{column} IS NOT NULL")
    return parts


def read_jdbc_balanced(spark: SparkSession, url: str, table: str, column: str, partitions: int,
                       options: Mapping[str, Any] | None = None, fetchsize: int = 10_000) -> DataFrame:
    """A table read in parallel parts of about equal size, however skewed its integer ``column`` is."""
    predicates = jdbc_ranges(spark, url, table, column, partitions, options) or ["1 = 1"]
    properties = {"fetchsize": str(fetchsize), **{k: str(v) for k, v in (options or {}).items()}}
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def write_ordered(df: DataFrame, path: str, order: Sequence[str], rows_per_file: int = 5_000_000) -> None:
    """Files that are sorted inside and among each other (by name): no task sorts more than a file."""
    rows = df.count()
    parts = max(1, -(-rows // rows_per_file))
    df.repartitionByRange(parts, *order).sortWithinPartitions(*order).write.parquet(path)


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """Rows of ``write_ordered`` with their place in the whole (from 1), from the files' order and the rows' places in them."""
    m = F.col("_metadata")
    rows = spark.read.parquet(path).select("*", m["file_name"].alias("_file"), m["row_index"].alias("_at"))
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))  # a row a file
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(F.col("_file").alias("_name"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rows = rows.join(files, F.col("_file") == F.col("_name"))
    return rows.withColumn(position, F.col("_before") + F.col("_at") + 1).drop("_file", "_name", "_before", "_at")


def normalize_blank(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Empty strings become null in the given (default: all string) columns."""
    cols = columns if columns is not None else [
        f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: blank_to_null(c) for c in cols})


def read_config(config_df: DataFrame, **overrides: Any) -> ThinConfig:
    """First row of the tuning table (values by position) as a ThinConfig.

    One row crosses to the driver; its values become literals in the plan.
    """
    row = config_df.limit(1).first()
    if row is None:
        return ThinConfig(**overrides)
    return ThinConfig.from_row(list(row), **overrides)


def write_parquet(df: DataFrame, path: str, mode: str = "append",
                  partition_by: Sequence[str] = ("zip_category",)) -> None:
    """Distributed write; one folder per metric tag."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, options: Mapping[str, Any] | None = None,
               mode: str = "append", connections: int | None = None, batchsize: int = 10_000) -> None:
    """Append over JDBC from the executors: a writer for each partition of the
    data, at most ``connections`` if given, batched inserts, one transaction per partition."""
    w = (df.write.format("jdbc").mode(mode).option("url", url)
           .option("dbtable", table).option("batchsize", batchsize)
           .option("isolationLevel", "READ_COMMITTED"))
    if connections:
        w = w.option("numPartitions", connections)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save()


def config_literals(cfg: ThinConfig) -> list:
    """The config as literal columns (for reports)."""
    return [F.lit(cfg.threshold).alias("threshold"), F.lit(cfg.pre).alias("pre"),
            F.lit(cfg.post).alias("post"), F.lit(cfg.target).alias("target"),
            F.lit(cfg.start).alias("start"), F.lit(cfg.step).alias("step")]
