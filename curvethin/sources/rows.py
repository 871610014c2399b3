"""Rows identified by where they are stored, so that wide rows need not travel while narrow ones are worked on.

``with_ids`` adds ``_row_id`` (the file, by the 64-bit hash of its path, and the row's index in it) to a Parquet scan. A plan keeps the
id with the few columns that it sorts and groups, and ``fetch`` scans the table again for the rows it wants in the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import PySparkTypeError
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import store

ROW_ID = "_row_id"
# Wanted rows up to this many are broadcast (about 100 bytes each in the hash table), so the wide rows stay where they are
# read; beyond it they are exchanged once by their id: those of a scan as compressed blocks of columns, others as rows, against
# a hash table of the narrow side, and never sorted.
BROADCAST_ROWS = 1_000_000
BLOCK_BITS = 14  # a block is this part of a file: 16 384 rows
SMALL_TABLE = 1.0  # share of a split of each core below which a table is scanned by too few tasks


def with_ids(scan: DataFrame) -> DataFrame:
    """A Parquet scan with the id of each row; the scan has to be the reader's own frame."""
    m = F.col("_metadata")
    return scan.select("*", F.struct(F.xxhash64(m["file_path"]).alias("file"), m["row_index"].alias("row")).alias(ROW_ID))


def fetch(wide: DataFrame, wanted: DataFrame, stored: bool = False) -> DataFrame:
    """The rows of ``wide`` whose id is in ``wanted`` (unique ids), with the other columns of ``wanted``; without the id.
    ``stored``: ``wanted`` reads stored rows only, so it is not stored here."""
    wanted = wanted.select(F.col(f"{ROW_ID}.file").alias("_file"), F.col(f"{ROW_ID}.row").alias("_row"),
                           *[c for c in wanted.columns if c != ROW_ID])
    wanted = wanted if stored else store(wanted)
    same = (F.col(f"{ROW_ID}.file") == F.col("_file")) & (F.col(f"{ROW_ID}.row") == F.col("_row"))
    if wanted.count() > BROADCAST_ROWS:
        if _in_file_order(wide) and _in_arrow(wide):
            return _fetch_blocks(wide, wanted)
        return wide.join(wanted.hint("shuffle_hash"), same).drop("_file", "_row", ROW_ID)
    found = wide.join(F.broadcast(wanted), same).drop("_file", "_row", ROW_ID)
    return found.repartition(wide.sparkSession.sparkContext.defaultParallelism) if _few_tasks(wide) else found


def _in_file_order(wide: DataFrame) -> bool:
    """Whether the rows come as a scan reads them, so that neighbours in a file come together."""
    node = wide._jdf.queryExecution().optimizedPlan()
    while node.nodeName() in ("Project", "Filter"):
        node = node.children().apply(0)
    return node.children().size() == 0


def _in_arrow(wide: DataFrame) -> bool:
    """Whether Python's Arrow has all types of the columns (no intervals of months, for one)."""
    try:
        return bool(to_arrow_schema(wide.schema))
    except PySparkTypeError:
        return False


def _fetch_blocks(wide: DataFrame, wanted: DataFrame) -> DataFrame:
    """``fetch`` by an exchange of both sides by the block of the id; a task has one block in memory."""
    cols, more = [c for c in wide.columns if c != ROW_ID], wanted.drop("_file", "_row")
    block = F.xxhash64("_file", F.shiftright("_row", BLOCK_BITS)).alias("_block")
    packed = wide.select(F.col(f"{ROW_ID}.file").alias("_file"), F.col(f"{ROW_ID}.row").alias("_row"), *cols).select(block, "*").mapInArrow(
        _packed, "_block bigint, _file bigint, _first bigint, _rows binary")
    schema = T.StructType([*wide.select(*cols).schema.fields, *more.schema.fields])
    kinds = to_arrow_schema(schema)

    def found(blocks: pa.Table, marks: pa.Table) -> pa.Table:
        return _found(blocks, marks, kinds)

    return packed.groupBy("_block").cogroup(wanted.groupBy(block)).applyInArrow(found, schema)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows (``_block``, ``_file``, ``_row``, others) of the same block, each as one row with a compressed stream of columns."""
    held: list[pa.RecordBatch] = []
    of = None
    for batch in batches:
        if not batch.num_rows:
            continue
        block, file = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((block[1:] != block[:-1]) | (file[1:] != file[:-1])) + 1
        for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if held and of != (block[first], file[first]):
                yield _blob(held)
                held = []
            of = block[first], file[first]
            held.append(batch.slice(first, end - first))
    if held:
        yield _blob(held)


def _blob(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(held).combine_chunks()
    block, file, row = (rows.column(i).to_numpy() for i in range(3))
    steps = pa.array(np.diff(row, prepend=row[0]))  # mostly ones, which take no room
    rows = rows.select(range(3, rows.num_columns)).add_column(0, "_step", steps)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(rows)
    return pa.RecordBatch.from_arrays([*(pa.array(x[:1]) for x in (block, file, row)), pa.array([out.getvalue().to_pybytes()], pa.binary())],
                                      ["_block", "_file", "_first", "_rows"])


def _found(blocks: pa.Table, marks: pa.Table, kinds: pa.Schema) -> pa.Table:
    """The rows of a block that are marked, with what ``marks`` says of them."""
    out = [kinds.empty_table()]
    files, wanted = marks.column("_file").to_numpy(), marks.column("_row").to_numpy()
    for file, first, packed in zip(*(blocks.column(c) for c in ("_file", "_first", "_rows"))):
        mine = np.flatnonzero(files == file.as_py())
        by = mine[np.argsort(wanted[mine])]
        rows = pa.ipc.open_stream(packed.as_buffer()).read_all()
        row = first.as_py() + np.cumsum(rows.column("_step").to_numpy())
        at = np.searchsorted(wanted[by], row)
        hit = np.flatnonzero(np.append(wanted[by], -1)[at] == row)
        rows, said = rows.take(pa.array(hit)), marks.take(pa.array(by[at[hit]]))
        out.append(pa.Table.from_arrays([(rows if f.name in rows.column_names else said).column(f.name).cast(f.type) for f in kinds], schema=kinds))
    return pa.concat_tables(out)


def _few_tasks(wide: DataFrame) -> bool:
    """Whether the scan is too small for a task on each core: its rows are then dealt out, as found, before they are
    worked on. Never so for a table of over ``maxPartitionBytes`` a core."""
    spark = wide.sparkSession
    task = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return table_bytes(wide) < SMALL_TABLE * task * spark.sparkContext.defaultParallelism


def table_bytes(df: DataFrame) -> int:
    """Spark's estimate of the size of ``df``."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
