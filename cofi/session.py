"""Session construction and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: adaptive execution for runtime re-planning (partition
# coalescing, skew-join splitting, broadcast conversion from measured sizes) and UTC.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cofi", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` and ``shuffle_partitions`` are only meant for local runs; on a cluster
    leave them unset and let the submitter decide.
    """
    builder = SparkSession.builder.appName(app_name)
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
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it; only when it is unset in local mode (tests) a scratch folder is
    made. On a cluster an unset folder is an error: a machine-local folder would split the
    written tables across executors.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor shares "
                             "(intermediate tables are written there)")
        path = tempfile.mkdtemp(prefix="cofi-ckpt-")  # local mode only: one machine
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df: DataFrame, name: str = "table", compression: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back
    (``compression``: other than the session's parquet codec).

    Used where one intermediate feeds several branches of a plan (both sides of a
    self-join, a ranking and its per-user counts): each branch then scans the written
    columns it needs instead of recomputing the lineage, and the lineage is cut, so a lost
    executor costs a re-read, not a recomputation from the sources.
    """
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    # The schema just written is known: reading with it skips the footer-inference job.
    return spark.read.schema(df.schema).parquet(path)


_ROOTS: dict[str, str] = {}
_SCOPES: list[list[str]] = []


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def table_path(spark: SparkSession, name: str) -> str:
    """A new path under ``<checkpoint dir>/cofi-tables/<application id>``, the folder of every
    table this application writes. The folder is made first, as Hadoop only registers existing
    paths for deletion at exit; ``drop_tables`` removes it sooner, ``table_scope`` the tables of
    one query."""
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        root = f"{checkpoint_dir(spark).rstrip('/')}/cofi-tables/{app}"
        hpath, fs = _file_system(spark, root)
        fs.mkdirs(hpath)
        fs.deleteOnExit(hpath)
        _ROOTS[app] = root
    path = f"{_ROOTS[app]}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def table_scope(spark: SparkSession):
    """Deletes the tables written inside it when it ends; results must be read before."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            hpath, fs = _file_system(spark, path)
            fs.delete(hpath, True)


def drop_tables(spark: SparkSession) -> None:
    """Delete the tables this application wrote (call at job end, once no DataFrame built on
    them will run again)."""
    root = _ROOTS.pop(spark.sparkContext.applicationId, None)
    if root is not None:
        hpath, fs = _file_system(spark, root)
        fs.delete(hpath, True)
