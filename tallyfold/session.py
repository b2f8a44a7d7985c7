"""Session settings every job of this package assumes."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, wherever they run; once per application.

    Functions that run on executors are imported there by name. Spark hands out the archive.
    """
    context = spark.sparkContext
    if getattr(context, "has_tallyfold", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tallyfold-"), "tallyfold.zip")
    with zipfile.ZipFile(archive, "w") as zipped:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    zipped.write(path, os.path.join("tallyfold", os.path.relpath(path, root)))
    context.addPyFile(archive)
    context.has_tallyfold = True


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; sizing is left to the cluster.

    ``spark.checkpoint.dir`` is the cluster's to name. Only a local run (driver and
    executors in one process) that leaves it unset gets a folder of its own.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        spark.conf.set("spark.checkpoint.dir", os.path.join(tempfile.gettempdir(), "tallyfold-scratch"))
    ship_package(spark)
    return spark
