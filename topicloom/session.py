"""Session helpers: a local session for tests and benches, and lineage cuts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


_SHIPPED: set[str] = set()


def local_session(cpus: int | str = "*", app: str = "topicloom", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benches. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    made = tempfile.mkdtemp(prefix="topicloom-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    sc.setCheckpointDir(made)
    return made


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once, for clusters where it is not installed."""
    sc = spark.sparkContext
    if sc.master.split("[")[0] == "local" or sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    with tempfile.TemporaryDirectory() as folder:
        archive = shutil.make_archive(f"{folder}/topicloom", "zip", Path(__file__).resolve().parents[1], "topicloom")
        sc.addPyFile(archive)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that lost executors cost one re-read and
    iterative plans stay short."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
