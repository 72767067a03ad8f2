"""Session helpers: building a session and cutting lineage reliably."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


MB = 1 << 20


def scale_settings(
    input_bytes: int,
    split_bytes: int = 512 * MB,
    reducer_bytes: int = 2048 * MB,
    max_shuffle_partitions: int = 50_000,
) -> dict[str, str]:
    """Partition sizing for a job reading about ``input_bytes``.

    * Scans are cut into ``split_bytes`` splits (about 200k tasks for 100 TB).
    * The initial shuffle width gives the widest shuffle here, the pair join,
      about ``reducer_bytes`` per reducer, capped at
      ``max_shuffle_partitions``: a wider shuffle multiplies the number of
      map-output blocks (map tasks x reducers) for little gain, and
      sort-merge joins spill rather than fail on large partitions.
    * Aggregation shuffles are small after map-side combine; AQE coalesces
      their partitions toward 256 MB and splits skewed join partitions above
      512 MB.
    """
    partitions = min(max_shuffle_partitions, max(200, -(-int(input_bytes) // reducer_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MB),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * MB),
    }


def build_session(
    master: str | None = None,
    app_name: str = "tessera",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """Return a session with adaptive execution on and the UI off.

    On a cluster pass ``master=None`` and let the launcher decide, and pass
    ``input_bytes`` to size partitions with :func:`scale_settings`.
    ``shuffle_partitions`` and ``extra`` override those settings.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    if input_bytes:
        conf.update(scale_settings(input_bytes))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the session, if any.

    Reads ``spark.checkpoint.dir`` (or a directory already set on the
    context); never invents a machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no context; the server applies the setting
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage for repeated passes; :func:`release` ends it.

    With a checkpoint folder configured the result is written there as
    Parquet, which survives executor loss without recomputing the
    upstream joins, and read again. Without one it is persisted to memory and disk; a lost
    block is then rebuilt from lineage, which is slower but still correct.
    """
    folder = checkpoint_dir(df.sparkSession)
    if folder is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = f"{folder.rstrip('/')}/materialized-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._materialized_path = path
    return table


def release(df: DataFrame) -> None:
    """Drop a result of :func:`materialize`: its cached blocks, or its files in the shared folder.

    Plans that still read it fail afterwards. Other DataFrames are left as they are, and releasing twice does no harm.
    """
    if df.storageLevel != StorageLevel.NONE:
        df.unpersist()
    path = df.__dict__.pop("_materialized_path", None)
    if path is not None:
        context = df.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


class QueryScope:
    """The tables that one query materializes; all of them go when the query ends.

    ``with QueryScope() as scope: points = scope.materialize(df)``. What is returned from
    the block must not read them any more: see :meth:`result`.
    """

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def materialize(self, df: DataFrame) -> DataFrame:
        self.tables.append(materialize(df))
        return self.tables[-1]

    def result(self, df: DataFrame, most_rows: int) -> DataFrame:
        """``df`` computed now, as a literal, for results bounded by a parameter (at most ``most_rows`` rows)."""
        rows = df.take(most_rows + 1)
        if len(rows) > most_rows:
            raise ValueError(f"the result has more than {most_rows} rows")
        return literal_frame(df.sparkSession, rows, df.schema)

    def __enter__(self) -> QueryScope:
        return self

    def __exit__(self, *_) -> None:
        while self.tables:
            release(self.tables.pop())


def literal_frame(spark: SparkSession, rows: Sequence[Sequence], schema: StructType) -> DataFrame:
    """A small driver-side table as a plan literal (one-row range + ``inline``).

    For parameter-sized tables only (vocabularies, k centres, a k-means
    trace): the rows travel inside the plan as one SQL expression, no RDD is
    parallelized and no Python worker is involved. An empty list gives an
    empty table.
    """
    from .functions.literals import struct_array

    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return spark.range(1).select(F.inline(struct_array(rows, schema)))
