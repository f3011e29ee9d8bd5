"""Session settings the jobs rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Results depend on these, so they are set on whichever session runs a job.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    # JSON objects may repeat a key; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in REQUIRED.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def build_session(app: str = "tillstream", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    defaults = {
        **REQUIRED,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for name, value in {**defaults, **conf}.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local run may fall back to a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tillstream-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def enable_checkpoints(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, for the tables and checkpoints of one run."""
    return os.path.join(shared_folder(spark), f"{name}-{os.urandom(6).hex()}")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Makes this package known to the executors' Python, once per application."""
    context, package = spark.sparkContext, os.path.dirname(os.path.abspath(__file__))
    if context.applicationId not in _shipped and os.path.isdir(package):
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="package-"), "tillstream"), "zip",
            os.path.dirname(package), os.path.basename(package))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
