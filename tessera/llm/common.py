"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tessera-llm-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder and continue from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Tables written in the shared folder in place of checkpoints: compressed, and deleted when done with.

    Use it as a context, or call :meth:`drop` for a table that is no longer read.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.paths = spark, f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}", {}

    def table(self, name: str, df: DataFrame) -> DataFrame:
        """``df``, computed once, written as Parquet and read again."""
        self.paths[name] = f"{self.folder}/{name}-{len(self.paths)}"
        df.write.parquet(self.paths[name])
        return self.spark.read.schema(df.schema).parquet(self.paths[name])

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(self.paths.pop(name))

    def _delete(self, path: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self._delete(self.folder)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are no longer referenced.

    It does so when the driver's JVM collects them, which a driver with little to do may put
    off while the next large shuffle fills the disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextlib.contextmanager
def small_batches(spark: SparkSession, limit: int = 2 << 20) -> Iterator[None]:
    """Inside, rows go to Python workers in Arrow batches of about ``limit`` bytes.

    By default a batch has 10,000 rows or 64 MB, which the executor's JVM and the worker both hold, for
    each running task, outside the heap. Holds for what is computed inside, not for later plans.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(limit))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release_memory() -> None:
    """Give a Python worker's freed memory back at the end of a task: the worker stays for the next.

    Call it after the last use of large arrays, inside the task.
    """
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def remainder(doc_id: Column, divisor: int) -> Column:
    """``crc32`` of the id's decimal text, modulo ``divisor``; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % divisor, F.lit(-1))


def text_bytes(text: Column) -> Column:
    """The text in UTF-8; null counts as empty."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


def same(left: Column, right: Column) -> Column:
    """Null-safe equality, usable as a join key."""
    return left.eqNullSafe(right)
