"""CSV and Parquet readers and writers."""

from __future__ import annotations

import csv
import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists: one status request to its file system."""
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder within its file system in one step."""
    fs, old = _file_system(spark, source)
    if not fs.rename(old, _file_system(spark, target)[1]):
        raise OSError(f"could not rename {source} to {target}")


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a file, or a folder that its writer finished, exists.

    A finished folder has Spark's success marker; a folder from elsewhere counts if no attempt of a
    write is left in it.
    """
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return False
    if not fs.getFileStatus(target).isDirectory():
        return True
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    return "_SUCCESS" in names or ("_temporary" not in names and any(not n.startswith(("_", ".")) for n in names))


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files of a CSV path by their header line."""
    jvm = spark.sparkContext._jvm
    fs, target = _file_system(spark, path)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    found: dict[tuple[str, ...], list[str]] = {}
    statuses = fs.globStatus(target)
    files = [s for status in statuses for s in (fs.listStatus(status.getPath()) if status.isDirectory() else [status])]
    for status in files:
        file = status.getPath()
        if status.isDirectory() or file.getName().startswith(("_", ".")):
            continue
        codec = codecs.getCodec(file)
        raw = fs.open(file)
        reader = jvm.java.io.BufferedReader(
            jvm.java.io.InputStreamReader(codec.createInputStream(raw) if codec else raw, "UTF-8")
        )
        line = reader.readLine()
        reader.close()
        if line is not None:  # an empty part file has no header
            header = tuple(next(csv.reader([line.removeprefix("\ufeff")]), ()))
            found.setdefault(header, []).append(file.toString())
    return found


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a sales CSV file or folder as text columns, with ``card`` added if absent.

    Columns are matched by name: files are grouped by their header line, each group is read with it as
    explicit schema, and a column that a group lacks is NULL there. Types are never inferred from the data.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"dataset not found: {path}")
    parts = []
    for header, files in sorted(_headers(spark, path).items()):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        parts.append(spark.read.schema(schema).option("header", True).option("escape", '"').csv(files))
    if not parts:
        raise FileNotFoundError(f"dataset is empty: {path}")
    df = union_sources(parts)
    return df if "card" in df.columns else df.withColumn("card", F.lit(None).cast("string"))


def union_sources(parts: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; a column absent from one part becomes NULL there."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def scan_merge_sources(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Stack the sources that exist; a missing one is reported, none at all is an error."""
    parts = []
    for path in paths:
        if path_exists(spark, path):
            parts.append(scan_csv(spark, path))
        else:
            log.warning("source not found, skipped: %s", path)
    if not parts:
        raise FileNotFoundError(f"none of the sources exists: {list(paths)}")
    return union_sources(parts)


def sink_csv(df: DataFrame, path: str) -> str:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(path)
    )
    return path


def sink_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_with_fallback(spark: SparkSession, processed: str, raw_csv: str) -> DataFrame:
    """Processed Parquet if present, else the raw CSV; ``datetime`` falls back to ``date``."""
    if is_complete(spark, processed):
        df = scan_parquet(spark, processed)
        if "datetime" not in df.columns and "date" in df.columns:
            return df.withColumn("datetime", F.col("date").cast("timestamp_ntz"))
        return df.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))
    log.warning("%s not found, reading %s", processed, raw_csv)
    df = scan_csv(spark, raw_csv)
    return df.withColumn("datetime", F.try_to_timestamp("datetime").cast("timestamp_ntz")).withColumn(
        "money", F.col("money").try_cast("double")
    )


def reuse_or_build(
    spark: SparkSession, path: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """Read the stored table, or compute and store it when it is absent or half-written."""
    if not is_complete(spark, path):
        sink_parquet(build(), path)
    return scan_parquet(spark, path)
