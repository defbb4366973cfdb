"""Session helpers: settings every job in this library assumes."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on. Timestamps inside the library are epoch-ms
# longs, so the session zone only matters for display and TimestampType output.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
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
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and state tables.

    Read from ``spark.checkpoint.dir`` (the cluster's shared folder). Where it
    is unset, a scratch folder is made for a local master; on a cluster that is
    an error, since executors would not see each other's files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table under the shared checkpoint folder;
    ``drop_written`` deletes it."""
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _WRITTEN.append(path)
    return path


def ensure_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def materialize(df, name: str = "table"):
    """Write ``df`` as a parquet table under the shared checkpoint folder and
    read it back: one job, lineage cut, survives executor loss, and later
    reads get column pruning and filter pushdown (an RDD checkpoint gets
    neither). Used for tables that a plan reads several times."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


_WRITTEN: list[str] = []


def written() -> int:
    """How many written tables exist; a mark for ``drop_written``."""
    return len(_WRITTEN)


def written_since(mark: int) -> list[str]:
    """Paths of the tables written after a mark."""
    return _WRITTEN[mark:]


def drop_tables(spark: SparkSession, paths: list[str]) -> int:
    """Delete written tables that nothing will read again."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    for path in paths:
        if path in _WRITTEN:
            _WRITTEN.remove(path)
            p = jvm.org.apache.hadoop.fs.Path(path)
            n += bool(p.getFileSystem(conf).delete(p, True))
    return n


def settle(df, mark: int, name: str = "table"):
    """``materialize`` a result, and delete the tables written since ``mark``
    that led to it."""
    used = written_since(mark)
    out = materialize(df, name)
    drop_tables(df.sparkSession, used)
    return out


def drop_written(spark: SparkSession, since: int = 0) -> int:
    """Delete the tables written in this process, those after a mark only."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while len(_WRITTEN) > since:
        p = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        if p.getFileSystem(conf).delete(p, True):
            n += 1
    return n
