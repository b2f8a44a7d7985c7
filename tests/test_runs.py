"""The run store: appends appear whole or not at all."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyfold.sources import files, runs


def row(spark, name):
    one = spark.createDataFrame([(1.5,)], "mape double")
    return runs.as_runs(one, "demand", F.lit(name), F.lit("2024-01-01 00:00:00"), ["mape"])


def test_interrupted_appends_are_never_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    runs.run_metrics_append(row(spark, "a"), path)

    def broken(*_):
        raise OSError("lost")

    monkeypatch.setattr(files, "rename", broken)
    with pytest.raises(OSError):
        runs.run_metrics_append(row(spark, "b"), path)
    monkeypatch.undo()
    assert [r["run_id"] for r in runs.run_metrics_scan(spark, path).collect()] == ["a"]
    failing = row(spark, "c").withColumn("run_name", F.expr("raise_error('half a run')"))
    with pytest.raises(Exception, match="half a run"):
        runs.run_metrics_append(failing, path)
    runs.run_metrics_append(row(spark, "d").union(row(spark, "e")), path)
    assert sorted(r["run_id"] for r in runs.run_metrics_scan(spark, path).collect()) == ["a", "d", "e"]


def test_rename_of_nothing_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="missing"):
        files.rename(spark, str(tmp_path / "missing"), str(tmp_path / "z"))
