"""Session construction and the shared working folder."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings the jobs rely on. Joins are never hinted: the static threshold and the
# run-time sizes seen by adaptive execution decide what is broadcast, and skewed
# partitions of lookups on hot keys are split by the adaptive skew join.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "shelfmark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings; cluster sizing comes from the submitter."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by the cluster in ``spark.checkpoint.dir``.

    In local mode, where one machine is all there is, a folder is made if none is named. On
    a cluster a folder of the driver would be out of the executors' sight: that is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors see")
        folder = tempfile.mkdtemp(prefix="shelfmark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per session."""
    context = spark.sparkContext
    if getattr(context, "_shelfmark_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        str(Path(tempfile.mkdtemp(prefix="shelfmark-")) / root.name), "zip", root.parent, root.name
    )
    context.addPyFile(archive)
    context._shelfmark_shipped = True
