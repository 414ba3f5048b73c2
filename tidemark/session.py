"""Spark session defaults and the shared scratch area.

Scratch output (sinks in tests and registered queries, checkpoints) always
goes under the folder the cluster names in ``spark.checkpoint.dir``: on a
cluster that is a shared file system, never a machine-local temp folder.
A local folder is only created when the setting is missing, as in tests.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library expects. AQE coalesces shuffle
# partitions and splits skewed join partitions at run time; UTC pins the
# day boundary of ``to_date`` (trap T13).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_made: ContextVar[list[str] | None] = ContextVar("scratch folders of the innermost scope", default=None)


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    pin_utc(spark)
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Day boundaries are computed in UTC (trap T13)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset and the master is local
    (tests) a private folder is created and registered. On a cluster an
    unset setting is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local"):
            # a machine-local folder is invisible to other executors and
            # lost with its machine
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on this cluster")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/tidemark/{name}-{uuid.uuid4().hex[:12]}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named; nothing if it isn't there."""
    if not re.search(r"/tidemark/[^/]+-[0-9a-f]{12}$", path):
        raise ValueError(f"not a scratch folder: {path}")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Deletes on leaving, also after an error, the scratch folders named inside.

    Frames read from them are lazy, so write or collect what is wanted before,
    to a place named outside of the scope. Scopes may be nested.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            remove_scratch(spark, path)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Survives executor loss (blocks are files, not executor memory);
    ``localCheckpoint`` is never used.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
