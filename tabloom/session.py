"""Spark session and checkpoint helpers.

Every job in the package assumes the session zone is UTC and that naive
timestamps are ``timestamp_ntz``; both are pinned here.  On a cluster the
caller owns the session and ``spark.checkpoint.dir`` points at shared
storage; ``checkpoint_dir`` only invents a local folder when nothing is set
(tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE may coalesce small shuffles, but not below 256 KB per partition:
    # stages after a small shuffle are often CPU-heavy (parsing, encoding),
    # and a 1 MB floor leaves most cores idle on them.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot never compiles methods of more than 8,000 bytes: a wide
    # projection in one such method runs interpreted, row by row.  Beyond this
    # size Spark compiles the operators one by one, in small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Joins leave broadcasting to the planner, below this fixed size in
    # bytes; explicit hints are only given to sides of a known bound.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, app: str = "tabloom",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit"):
        spark.conf.set(k, conf[k])
    ship_package(spark)
    return spark


def prepare(spark: SparkSession) -> None:
    """What the plans need of a session that the caller made."""
    for k in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit"):
        spark.conf.set(k, BASE_CONF[k])
    ship_package(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` (or the SparkContext's directory).  Only
    when neither is set and the master is local -- a test session -- a fresh
    folder under the system temp directory is created and registered.  On a
    cluster a missing setting is an error: a machine-local folder would lose
    data.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tabloom-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per context.

    Kernels of the Python operators are pickled by module name, so workers
    must be able to import the package wherever they start.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tabloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(root):
        out = os.path.join(tempfile.mkdtemp(prefix="tabloom-src-"), "tabloom.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in sorted(os.walk(root)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("tabloom", os.path.relpath(full, root)))
        sc.addPyFile(out)
    sc._tabloom_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint (never ``localCheckpoint``): survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Spark drops the shuffle files of a query that ends in here; a plan
    that is run again computes them anew."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage through a parquet table below the shared checkpoint folder.

    Columnar and compressed: repeated categories take a few bits each, where
    ``checkpoint`` writes whole rows.  Once it is written, its shuffle files go."""
    path = scratch_path(df.sparkSession, name)
    with dropping_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
