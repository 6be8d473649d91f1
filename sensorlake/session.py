"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_SHUFFLE_CONF = "spark.sql.shuffle.partitions"
_SPLIT_CONF = "spark.sql.files.maxPartitionBytes"
_TASK_BYTES = 128 << 20
SPLIT_BYTES = 32 << 20  # of files whose rows take ten times as much in memory


def build_session(app: str = "sensorlake", master: str | None = None, **conf: object) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # a busy sensor's sessions are merged in each task before they are shuffled
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without that setting it lies below the warehouse, which executors share too.
    """
    sc = spark.sparkContext
    named = spark.conf.get(_CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    # getCheckpointDir() adds a run-specific sub-folder, which is what we want here
    return sc.getCheckpointDir()


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: one outcome, of known size, without a lineage."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_intermediate(spark: SparkSession) -> None:
    """Remove this session's checkpoints and intermediate tables, once no frame that reads them is used any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int, task_bytes: int = _TASK_BYTES) -> Iterator[None]:
    """Task sizes for a job that shuffles ``input_bytes`` of files.

    About ``task_bytes`` of input per shuffle partition, and at most
    ``SPLIT_BYTES`` per scan task: copies collapse there, in memory, before the
    shuffle. Adaptive execution merges partitions that turn out small, but
    cannot add any, so their number is only ever raised, and splits are only
    made smaller. For jobs that run inside the block; a lazy frame is planned
    with what holds when it runs.
    """
    current = spark._jsparkSession.sessionState().conf()
    wanted = {_SHUFFLE_CONF: max(current.numShufflePartitions(), -(-input_bytes // task_bytes)),
              _SPLIT_CONF: min(current.filesMaxPartitionBytes(), SPLIT_BYTES)}
    before = {conf: spark.conf.get(conf) for conf in wanted}
    for conf, value in wanted.items():
        spark.conf.set(conf, str(value))
    try:
        yield
    finally:
        for conf, value in before.items():
            spark.conf.set(conf, value)
