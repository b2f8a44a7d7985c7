"""Run metrics kept as a table: append, scan and the queries over it."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.schemas import RUN_METRICS
from tallyfold.sources import files


def run_metrics_append(runs: DataFrame, path: str) -> str:
    """Add runs to the store, all of them or none: they are written aside and appear by one rename.

    Readers pass over folders that begin with an underscore, so what an interrupted writer left is never seen.
    Concurrent writers only ever add folders.
    """
    number = uuid.uuid4().hex
    aside, shown = f"{path}/_append-{number}", f"{path}/append-{number}"
    runs.select(*[F.col(f.name).cast(f.dataType) for f in RUN_METRICS]).write.parquet(aside)
    files.rename(runs.sparkSession, aside, shown)
    return path


def run_metrics_scan(spark: SparkSession, path: str) -> DataFrame:
    """All runs of finished appends."""
    return spark.read.schema(RUN_METRICS).option("recursiveFileLookup", "true").parquet(path)


def metric_map(columns: Sequence[str]) -> Column:
    """A metrics map of the named columns, without the NULL ones."""
    pairs: list[Column] = []
    for c in columns:
        pairs += [F.lit(c), F.col(c).cast("double")]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def as_runs(
    df: DataFrame, experiment: str, run_id: Column, start_time: Column,
    metrics: Sequence[str], params: Column | None = None, tags: Column | None = None,
) -> DataFrame:
    """Turn result rows into rows of the run store."""
    empty = F.create_map().cast("map<string,string>")
    return df.select(
        F.lit(experiment).alias("experiment"),
        run_id.cast("string").alias("run_id"),
        run_id.cast("string").alias("run_name"),
        start_time.cast("timestamp_ntz").alias("start_time"),
        metric_map(metrics).alias("metrics"),
        (empty if params is None else params).alias("params"),
        (empty if tags is None else tags).alias("tags"),
    )


def latest_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """The newest ``n`` runs of every experiment, with their recency rank."""
    newest = Window.partitionBy("experiment").orderBy(
        F.col("start_time").desc(), F.col("run_id").desc()
    )
    return runs.withColumn("recency_rank", F.row_number().over(newest)).where(
        F.col("recency_rank") <= n
    )


def latest_tagged_run(runs: DataFrame, experiment: str, model: str) -> DataFrame:
    """The newest run of one model within one experiment."""
    return (
        runs.where((F.col("experiment") == experiment) & (F.col("tags")["model_name"] == model))
        .orderBy(F.col("start_time").desc(), F.col("run_id").desc())
        .limit(1)
    )


def _silhouette() -> Column:
    """The exact measure of a run if it has one, else the linear one."""
    return F.coalesce(F.col("metrics")["silhouette"], F.col("metrics")["silhouette_squared"])


def best_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """One row per area: its best (for monitoring: newest) run among the newest ``n``.

    An area is found by a substring of the experiment name. A run without the
    metric ranks last.
    """
    name = F.lower("experiment")
    area = (
        F.when(name.contains("demand"), "demand")
        .when(name.contains("churn"), "churn")
        .when(name.contains("cluster"), "clustering")
        .when(name.contains("monitor"), "monitoring")
    )
    worst = F.lit(float("inf"))
    badness = (
        F.when(F.col("area") == "demand", F.coalesce(F.col("metrics")["mape"], worst))
        .when(F.col("area") == "churn", -F.coalesce(F.col("metrics")["pr_auc"], F.lit(0.0)))
        .when(F.col("area") == "clustering", -F.coalesce(_silhouette(), F.lit(0.0)))
        .otherwise(F.lit(0.0))
    )
    return (
        latest_runs(runs, n)
        .withColumn("area", area)
        .where(F.col("area").isNotNull())
        .groupBy("area")
        .agg(F.min_by(F.struct("run_name", "start_time", "metrics"),
                      F.struct(badness, "recency_rank")).alias("best"))
        .select("area", "best.run_name", "best.start_time", "best.metrics")
    )


def mape_history(runs: DataFrame, n: int = 10) -> DataFrame:
    """The demand runs that report a MAPE, oldest first, among the newest ``n``."""
    return (
        latest_runs(runs.where(F.lower("experiment").contains("demand")), n)
        .where(F.col("metrics")["mape"].isNotNull())
        .select("run_name", F.col("metrics")["mape"].alias("mape"), "start_time")
        .orderBy("start_time", "run_name")
    )


def model_status(runs: DataFrame, n: int = 10) -> DataFrame:
    """One row: headline metric and status per model; a missing metric takes its worst default."""
    best = best_runs(runs, n)

    def headline(area: str, metric: Column, default: float) -> Column:
        return F.coalesce(F.max(F.when(F.col("area") == area, metric)), F.lit(default))

    row = best.agg(
        headline("demand", F.col("metrics")["mape"], 100.0).alias("mape"),
        headline("churn", F.col("metrics")["pr_auc"], 0.0).alias("pr_auc"),
        headline("clustering", _silhouette(), 0.0).alias("silhouette"),
    )
    return row.select(
        "*",
        F.when(F.col("mape") < 50, "OK").otherwise("Warning").alias("demand_status"),
        F.when(F.col("pr_auc") >= 0.7, "OK").otherwise("Critical").alias("churn_status"),
        F.when(F.col("silhouette") >= 0.4, "OK").otherwise("Warning").alias("clustering_status"),
    )


def stage_summary(stages: DataFrame) -> DataFrame:
    """Stages and seconds per status."""
    return stages.groupBy("status").agg(
        F.count("*").alias("stages"), F.sum("elapsed").alias("elapsed")
    )
