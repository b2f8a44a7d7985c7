"""Distribution drift and metric drift.

All features go through one job in long form ``feature, side, value`` where ``side``
is ``reference`` or ``current``. Equal values are counted before any ordering.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions import numeric
from tallyfold.operators.ordering import exact_quantiles, long_form, running_totals
from tallyfold.schemas import available_columns
from tallyfold.scratch import materialise

DRIFT_FEATURES = ["revenue", "n_transactions", "lag_1", "rolling_mean_7"]
PSI_BINS = 10
PSI_THRESHOLD = 0.2
EPSILON = 1e-6
SERIES_TERMS = 100


def paired_values(split: DataFrame, features: Sequence[str] = DRIFT_FEATURES) -> DataFrame:
    """Long form of the listed features that exist, over a stored table; NULL and NaN are dropped."""
    present = available_columns(split, features)
    stored = materialise(split.select("side", *present), "drift")
    return long_form(stored, present, ["side"]).where("value IS NOT NULL AND NOT isnan(value)")


def _side(name: str) -> Column:
    return F.col("side") == name


def psi(values: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """``feature, psi``; features without values on one side are left out.

    Bins are the reference percentiles. Values outside them are not counted but stay
    in the denominator; the last bin includes its right edge. A constant reference
    gives 0.
    """
    edges = exact_quantiles(
        values.where(_side("reference")), "value", [i / bins for i in range(bins + 1)], ["feature"]
    ).select("feature", F.array_distinct("quantiles").alias("edges"))
    edges = materialise(edges, "edges")

    v, cuts = F.col("value"), F.col("edges")
    inside = v.between(cuts[0], F.element_at(cuts, -1))
    place = F.least(F.size(F.filter(cuts, lambda e: e <= v)), F.size(cuts) - 1)
    # One row of at most ``bins + 1`` numbers per feature.
    counts = (
        values.join(F.broadcast(edges), "feature")
        .groupBy("feature", F.when(inside, place).alias("bin"))
        .agg(F.count_if(_side("reference")).alias("r"), F.count_if(_side("current")).alias("c"))
    )
    entry = F.when(F.col("bin").isNotNull(), F.struct("bin", F.struct("r", "c").alias("n")))
    per_feature = counts.groupBy("feature").agg(
        F.map_from_entries(F.collect_list(entry)).alias("by_bin"),
        F.sum("r").alias("r_total"),
        F.sum("c").alias("c_total"),
    )

    def share(b: Column, side: str) -> Column:
        counted = F.coalesce(F.try_element_at(F.col("by_bin"), b)[side], F.lit(0))
        return counted / F.col(f"{side}_total") + F.lit(EPSILON)

    def term(b: Column) -> Column:
        return (share(b, "c") - share(b, "r")) * F.log(share(b, "c") / share(b, "r"))

    total = F.aggregate(
        F.sequence(F.lit(1), F.size("edges") - 1), F.lit(0.0), lambda acc, b: acc + term(b)
    )
    return (
        per_feature.join(edges, "feature")
        .where((F.col("r_total") > 0) & (F.col("c_total") > 0))
        .select("feature", F.when(F.size("edges") < 2, F.lit(0.0)).otherwise(total).alias("psi"))
    )


def kolmogorov_p(statistic: Column, n_reference: Column, n_current: Column) -> Column:
    """Asymptotic two-sided p-value with the usual small-sample correction."""
    root = F.sqrt(n_reference * n_current / (n_reference + n_current))
    lam = (root + F.lit(0.12) + F.lit(0.11) / root) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series))
    )


def ks_two_sample(values: DataFrame) -> DataFrame:
    """``feature, ks_statistic, ks_p_value``."""
    counted = values.groupBy("feature", "value").agg(
        F.count_if(_side("reference")).alias("r"), F.count_if(_side("current")).alias("c")
    )
    ranked = running_totals(counted, ["value"], ["r", "c"], ["feature"])
    gap = F.abs(F.col("r_upto") / F.col("r_total") - F.col("c_upto") / F.col("c_total"))
    found = ranked.where("r_total > 0 AND c_total > 0").groupBy("feature").agg(
        F.max(gap).alias("ks_statistic"),
        F.max("r_total").cast("double").alias("_r"),
        F.max("c_total").cast("double").alias("_c"),
    )
    return found.select(
        "feature", "ks_statistic",
        kolmogorov_p(F.col("ks_statistic"), F.col("_r"), F.col("_c")).alias("ks_p_value"),
    )


def data_drift(split: DataFrame, features: Sequence[str] = DRIFT_FEATURES, bins: int = PSI_BINS,
               threshold: float = PSI_THRESHOLD) -> DataFrame:
    """Both measures per feature, and whether any unrounded PSI exceeds the threshold."""
    values = paired_values(split, features)
    # The window sees one row per feature.
    anywhere = F.bool_or(F.col("psi") > threshold).over(Window.partitionBy())
    both = psi(values, bins).join(ks_two_sample(values), "feature")
    return both.withColumn("drift_detected", anywhere).select(
        "feature",
        *[numeric.half_even(F.col(c), 4).alias(c) for c in ("psi", "ks_statistic", "ks_p_value")],
        "drift_detected",
    )


def psi_status(report: DataFrame) -> DataFrame:
    """Display status; unlike the alerts, both limits are exclusive."""
    status = (
        F.when(F.col("psi") > 0.2, "CRITICAL").when(F.col("psi") > 0.1, "warning").otherwise("ok")
    )
    return report.withColumn("status", status)


def baseline_window(runs: DataFrame, metric: str) -> DataFrame:
    """Runs that report the metric, numbered by time, with baseline and latest marks."""
    whole = Window.partitionBy("experiment")
    ordered = whole.orderBy("start_time", "run_id")
    value = F.col("metrics")[metric]
    numbered = runs.where(value.isNotNull()).select(
        "experiment", "run_id", "start_time", value.alias("value"),
        F.row_number().over(ordered).alias("seq"),
        F.count(F.lit(1)).over(whole).alias("n"),
    )
    baseline_size = F.greatest(F.lit(1), F.floor(F.col("n") / 4))
    return numbered.withColumns(
        {"is_baseline": F.col("seq") <= baseline_size, "is_latest": F.col("seq") == F.col("n")}
    )


def concept_drift(runs: DataFrame, metric: str, threshold: float = 0.20,
                  direction: str = "both") -> DataFrame:
    """Per experiment: latest value against the mean of the first quarter of its runs.

    ``both`` flags changes either way; ``up`` or ``down`` only that direction. An
    experiment whose runs never report the metric is an error; no runs give no rows.
    """
    marked = baseline_window(runs, metric)
    found = marked.groupBy("experiment").agg(
        F.avg(F.when(F.col("is_baseline"), F.col("value"))).alias("baseline_value"),
        F.max(F.when(F.col("is_latest"), F.col("value"))).alias("current_value"),
    )
    everyone = runs.select("experiment").distinct().join(found, "experiment", "left")
    base = F.when(
        F.col("baseline_value").isNull(),
        F.raise_error(F.format_string(f"metric '{metric}' not found in runs of %s", "experiment")).cast("double"),
    ).otherwise(F.col("baseline_value"))
    change = F.when(base == 0, F.lit(0.0)).otherwise(
        (F.col("current_value") - base) / F.abs(base)
    )
    flagged = {
        "both": F.abs(F.col("_change")) > threshold,
        "up": F.col("_change") > threshold,
        "down": F.col("_change") < -threshold,
    }[direction]
    return everyone.withColumn("_change", change).select(
        "experiment", "baseline_value", "current_value",
        numeric.half_even(F.col("_change"), 4).alias("degradation_pct"),
        flagged.alias("drift_detected"),
    )
