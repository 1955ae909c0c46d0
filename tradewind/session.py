"""SparkSession construction and the checkpoint-directory contract."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every plan in the package assumes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tradewind",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster, pass no master."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point reliable checkpoints at the cluster's shared ``spark.checkpoint.dir``.

    The directory is read from the session.  Only when it is unset and Spark
    runs in local mode (tests, laptops) is a private scratch directory created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="tradewind-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)          # later calls find it through getCheckpointDir()
    try:
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:                  # some versions reject runtime changes of core settings
        pass
    return path


def materialize(df, label: str = "stage", partition_by: list[str] | None = None):
    """Cut lineage by writing ``df`` as a parquet table in the shared checkpoint
    folder and reading it back.

    One job computes the rows once (an eager ``checkpoint()`` computes them
    twice: once to count, once to save), the files are columnar and survive the
    loss of any executor, and later reads are vectorised scans.  Readers that filter on
    ``partition_by`` columns leave out the other folders.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
    # The given schema: an empty table written by partition has no files to tell it.
    return spark.read.schema(df.schema).parquet(path) if partition_by else spark.read.parquet(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared checkpoint folder, which enclosing ``intermediates`` blocks delete."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tradewind-{label}-{uuid.uuid4().hex}"
    for scope in _SCOPES:
        scope.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete ``path`` through the Hadoop file system API, so on whatever storage it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_SCOPES: list[list[str]] = []


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[list[str]]:
    """Delete what ``materialize`` writes inside the block when the block ends, also by a failure.

    Results must have been written elsewhere by then; a path taken off the yielded list stays.
    """
    written: list[str] = []
    _SCOPES.append(written)
    try:
        yield written
    finally:
        _SCOPES.remove(written)
        for path in written:
            remove(spark, path)
