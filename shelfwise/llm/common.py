"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401 - as pa.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a Python task gathers before it works on them as one block.
BLOCK_BYTES = 24 << 20
#: Setting of the bytes after which the JVM sends a batch of rows to a Python task, and its value for texts.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where the session names none and runs locally."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="shelfwise-")
        spark.conf.set("spark.checkpoint.dir", found)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` into the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def small_batches(spark: SparkSession) -> None:
    """Batches of ``BATCH_BYTES`` in this session unless it names a size of its own. The JVM holds a batch outside its
    heap, in buffers that double as they grow, on the way to Python and back; 10,000 texts of a few thousand characters,
    as by default, are well over 100 MB of it for each running task."""
    key, limit = BATCH_BYTES
    spark.conf.set(key, spark.conf.get(key, limit))


def whole(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of a documents table; a null text is empty. Other columns are left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(0))


def partitions(spark: SparkSession) -> int:
    """Tasks of a shuffle, as the session sets it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def blocks(batches: Iterable[pa.RecordBatch], sized_by: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Tables of at least ``limit`` bytes of the column ``sized_by``; the last may be smaller, none is empty."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:  # a batch of very long texts is cut by rows
            column, to = batch.column(sized_by), at
            part = column.slice(at)
            if size + part.nbytes <= limit:
                to = batch.num_rows
            else:
                lengths = pa.compute.cumulative_sum(pa.compute.fill_null(pa.compute.binary_length(part), 0).cast(pa.int64()))
                to = at + 1 + int(pa.compute.sum(pa.compute.less(lengths, limit - size)).as_py() or 0)
                to = min(to, batch.num_rows)
            piece = batch.slice(at, to - at)
            held.append(piece)
            size += piece.column(sized_by).nbytes
            at = to
            if size >= limit or at < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def over_blocks(df: DataFrame, work: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str, sized_by: str = "text", limit: int = BLOCK_BYTES) -> DataFrame:
    """``mapInArrow`` whose function gets bounded blocks of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, sized_by, limit):
            yield from work(block)

    return df.mapInArrow(run, schema)
