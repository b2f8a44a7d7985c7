"""Intermediate tables in the shared folder of the cluster.

A result that is read more than once, or that ends an iteration, is written as
Parquet below ``spark.checkpoint.dir`` and read back. This cuts the lineage,
survives the loss of any executor, and keeps the column statistics that size
later joins. Everything lies in one folder per application: ``drop`` removes one
table as soon as nothing reads it, ``release`` removes what is left at the end of a job.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session; ``session.configure`` fills it in for local runs."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return root


def application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/tallyfold/{spark.sparkContext.applicationId}"


#: Folders of the stages that are running; threads of a stage store into its folder, too.
_stages: list[str] = []


def scratch_path(spark: SparkSession, label: str = "table") -> str:
    folder = "/".join([application_folder(spark), *_stages[-1:]])
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def stage_folder(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are deleted at the end: for stages that keep their results elsewhere."""
    name = f"stage-{uuid.uuid4().hex}"
    _stages.append(name)
    try:
        yield
    finally:
        _stages.remove(name)
        delete(spark, f"{application_folder(spark)}/{name}")


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Compute ``df`` once, store it, and return a scan of the stored table."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop(stored: DataFrame) -> None:
    """Remove a table that ``materialise`` returned and no later plan reads."""
    delete(stored.sparkSession, stored.stored_at)


def free_shuffles(spark: SparkSession) -> None:
    """Have the driver notice which finished plans nothing refers to, so their shuffle files go now.

    Spark removes shuffle files when the driver's garbage collector finds their plan unused, which on an
    idle driver may be long after.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release(spark: SparkSession) -> None:
    """Remove every table this application stored."""
    delete(spark, application_folder(spark))
