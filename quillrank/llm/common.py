"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Stands for a null doc_id inside joins; larger than any real id, so null ids come last.
NULL_KEY = (1 << 63) - 1

#: ASCII white space as the word pattern of the contracts has it: space and tab to carriage return.
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def key_of(column: str = "doc_id") -> Column:
    """The id as a long that is never null (see NULL_KEY)."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_KEY))


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which every executor can reach; it is deleted when the driver ends.

    Where the setting is missing and all tasks run in the driver's own process (tests), a folder under /tmp is set. On a
    cluster that raises: each executor would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir is not set, and tasks of {master} share no local folder")
        base = "file:///tmp/checkpoints"
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/stage-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def written(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again: lineage ends there, and a lost executor costs nothing."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """name, with as many underscores after it as make it none of df's columns, whatever their case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, gone: DataFrame, most: int) -> DataFrame:
    """Rows of df, with its columns alone, whose doc_id is not among the keys of gone (key: see key_of).

    gone is written and counted: up to `most` keys (8 bytes each) go to all executors, and no text moves; beyond that both
    sides are joined by key. Rows that share a doc_id, and all those without one, go or stay together.
    """
    name = free_name(df, "gone_key")
    gone = written(gone.select(F.col("key").alias(name)).distinct())
    side = F.broadcast(gone) if gone.count() <= most else gone
    return df.withColumn(name, key_of()).join(side, name, "left_anti").select(*(f"`{c}`" for c in df.columns))


def drop_written(df: DataFrame) -> None:
    """Deletes what written() stored; only for frames that nothing reads any more."""
    spark = df.sparkSession
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of an Arrow batch sent to a worker; a longer row stands alone.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Sets the session's Arrow batches to BATCH_BYTES at most; a smaller setting stays.

    The setting is read when a plan runs, so it can't be bound to one frame. The default of 64 MB a batch is held by the
    JVM, the worker and the copies it makes, for every task of an executor at once.
    """
    name, conf = "spark.sql.execution.arrow.maxBytesPerBatch", spark.conf
    set_to = re.fullmatch(r"(\d+)b?", str(conf.get(name, "64m")))
    if not set_to or not 0 < int(set_to[1]) <= BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))


def map_arrow(df: DataFrame, run: Callable, schema: StructType | str, kind: object = None, every: int = 1) -> DataFrame:
    """df.mapInArrow with lean() workers and small_batches(). schema: df.schema where rows are kept as they are.

    Spark takes column names with dots for paths there, so such frames are mapped under plain names.
    """
    small_batches(df.sparkSession)
    names = df.columns
    if schema == df.schema and (any(re.search(r"[^A-Za-z0-9_]", c) for c in names) or len({c.lower() for c in names}) < len(names)):
        df = df.toDF(*(f"c{i}" for i in range(len(names))))
        return df.mapInArrow(lean(run, kind, every), df.schema).toDF(*names)
    return df.mapInArrow(lean(run, kind, every), schema)


def group_arrow(groups, run: Callable[[pa.Table], pa.Table], schema: StructType | str) -> DataFrame:
    """groups.applyInArrow in workers that give freed memory back after each group."""

    def wrapped(table: pa.Table) -> pa.Table:
        drop_kept(None)
        out = run(table)
        del table
        trim()
        return out

    return groups.applyInArrow(wrapped, schema)


#: What tasks of one kind keep in a worker process for later ones.
_kept: dict[object, dict] = {}


def kept(kind: object) -> dict:
    """The memory of one kind of task in this worker process."""
    return _kept.setdefault(kind, {})


def drop_kept(kind: object) -> None:
    """Drops what tasks of other kinds keep."""
    for other in [x for x in _kept if x != kind]:
        del _kept[other]


def trim() -> None:
    """Gives freed memory back to the system; without glibc only that of Arrow."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def lean(run: Callable, kind: object = None, every: int = 1) -> Callable:
    """run (for mapInArrow) in workers that hold no more than they use.

    Workers are reused by later stages, so freed memory goes back after `every` batches and at the end of a task, and a
    task drops what those of other kinds keep.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept(kind)
        try:
            for i, batch in enumerate(run(batches)):
                yield batch
                if (i + 1) % every == 0:
                    trim()
        finally:
            trim()

    return wrapped


def chunks_by_bytes(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose text holds about `limit` bytes each; a longer row stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)
