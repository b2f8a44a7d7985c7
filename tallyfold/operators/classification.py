"""Churn classifiers and the metrics they are judged by.

Metrics start from one row per distinct score, so customers that share a score are
combined before the ordered pass.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from functools import partial, reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.numeric import safe_ratio
from tallyfold.operators import tuning
from tallyfold.operators.forecasting import model_leaderboard
from tallyfold.operators.ordering import running_totals
from tallyfold.operators.trials import at_once
from tallyfold.schemas import available_columns
from tallyfold.scratch import materialise

NUMERIC_FEATURES = [
    "recency_norm", "frequency_norm", "monetary_norm", "recency_days", "frequency", "monetary",
    "cluster_id", "freq_last_4w", "freq_last_8w", "avg_ticket_recent", "n_distinct_products",
    "days_since_first_purchase",
]
THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7)
DEFAULT_THRESHOLD = 0.5
RECOMMENDED_THRESHOLD = 0.4

# Rows a part of a table that is laid out in half as many parts as cores: fewer are soon done, more are too large for one task.
HALF_ROWS = 20_000, 1_000_000

# Default settings and tuning spaces of the candidates.
FOREST_DEFAULTS = {"trees": 300, "depth": 8}
GBT_DEFAULTS = {"rounds": 300, "depth": 4, "rate": 0.05, "subsample": 0.8, "columns": 0.8}
LOGISTIC_DEFAULTS = {"c": 1.0, "max_iter": 1000}
TUNING_SPACES = {
    "gbt": {"rounds": (100, 600), "depth": (3, 8), "rate": (0.01, 0.3), "subsample": (0.6, 1.0),
            "columns": (0.5, 1.0), "min_rows": (1, 10)},
    "forest": {"trees": (100, 600), "depth": (3, 15), "min_rows": (1, 10)},
    "logistic": {"c": (0.001, 100.0)},
}
LOG_SCALE = {"rate", "c"}


# -- split and weights ---------------------------------------------------------


def _shuffled(rows: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """Rows with their place within the class, in a seeded order of the keys."""
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    marked = rows.withColumns({"_order": order, "_one": F.lit(1).cast("bigint")})
    return running_totals(marked, ["_order", key], ["_one"], [label]).drop("_order", "_one")


def stratified_split(rows: DataFrame, label: str = "churn", key: str = "card",
                     test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``part``: an exact, repeatable share of every class is ``test``."""
    placed = _shuffled(rows, label, key, seed)
    held_out = F.col("_one_upto") <= F.floor(F.col("_one_total") * test_share + 0.5)
    return placed.withColumn("part", F.when(held_out, "test").otherwise("train")).drop(
        "_one_upto", "_one_total"
    )


def stratified_folds(rows: DataFrame, folds: int = 5, label: str = "churn", key: str = "card",
                     seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..folds-1 with equal class shares."""
    placed = _shuffled(rows, label, key, seed)
    return placed.withColumn("fold", F.pmod("_one_upto", F.lit(folds)).cast("int")).drop(
        "_one_upto", "_one_total"
    )


def class_weights(rows: DataFrame, label: str = "churn") -> DataFrame:
    """One row: class counts, positive weight, and the balanced weight of each class."""
    n = rows.agg(
        F.count_if(F.col(label) == 0).alias("n_neg"), F.count_if(F.col(label) == 1).alias("n_pos")
    )
    total = F.col("n_neg") + F.col("n_pos")
    return n.select(
        "*",
        (F.col("n_neg") / F.greatest("n_pos", F.lit(1))).alias("scale_pos_weight"),
        F.when(F.col("n_neg") > 0, total / (2 * F.col("n_neg"))).alias("weight_neg"),
        F.when(F.col("n_pos") > 0, total / (2 * F.col("n_pos"))).alias("weight_pos"),
    )


def with_weights(rows: DataFrame, label: str = "churn", scheme: str = "balanced") -> DataFrame:
    """Add ``weight``: balanced, or 1 for negatives and the class ratio for positives."""
    w = class_weights(rows, label).select(
        F.struct("scale_pos_weight", "weight_neg", "weight_pos")
    ).scalar()
    positive = F.col(label) == 1
    if scheme == "balanced":
        weight = F.when(positive, w["weight_pos"]).otherwise(w["weight_neg"])
    else:
        weight = F.when(positive, w["scale_pos_weight"]).otherwise(F.lit(1.0))
    return rows.withColumn("weight", weight)


# -- models ----------------------------------------------------------------------


def feature_stages(rows: DataFrame, scale: bool = False, one_hot: bool = True) -> list:
    """Encoder, assembler and optional scaler over the feature columns that exist."""
    inputs = available_columns(rows, NUMERIC_FEATURES)
    stages: list = []
    if one_hot and "segment_name" in rows.columns:
        stages += [
            StringIndexer(inputCol="segment_name", outputCol="_segment", handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCol="_segment", outputCol="_segment_1hot", dropLast=False),
        ]
        inputs = [*inputs, "_segment_1hot"]
    assembled = "_raw" if scale else "features"
    stages.append(VectorAssembler(inputCols=inputs, outputCol=assembled))
    if scale:
        stages.append(StandardScaler(inputCol=assembled, outputCol="features", withMean=True))
    return stages


def even_parts(stored: DataFrame) -> DataFrame:
    """A stored table in a multiple of as many even parts as there are cores, for fits of hundreds of passes.

    A pass over one part more than cores lasts as long as one over twice the parts. Tables of fewer parts stay as they are.
    """
    cores, parts = stored.sparkSession.sparkContext.defaultParallelism, stored.rdd.getNumPartitions()
    if parts <= cores or parts % cores == 0:
        return stored
    return materialise(stored.repartition(parts // cores * cores), "even")


def half_parts(stored: DataFrame) -> DataFrame:
    """A stored table in half as many even parts as there are cores, so that fits beside this one get the other half.

    Jobs are served in the order they were submitted, so passes of seconds over all cores would hold up thousands of short ones.
    Tables too small for such passes, or too large for so few parts, are left to ``even_parts``.
    """
    half = stored.sparkSession.sparkContext.defaultParallelism // 2
    if not half or not HALF_ROWS[0] <= stored.count() / half <= HALF_ROWS[1]:
        return even_parts(stored)
    return materialise(stored.repartition(half), "half")


def _fit(rows: DataFrame, classifier, label: str, scheme: str, scale: bool, laid_out=even_parts) -> PipelineModel:
    ready = laid_out(materialise(with_weights(rows, label, scheme), "churn-train"))
    return Pipeline(stages=[*feature_stages(ready, scale=scale), classifier]).fit(ready)


def churn_logistic(train: DataFrame, label: str = "churn", params: dict | None = None) -> PipelineModel:
    """Standardised, balanced logistic regression; ``c`` is the inverse penalty on the summed loss."""
    p = {**LOGISTIC_DEFAULTS, **(params or {})}
    n = train.count()
    model = LogisticRegression(
        featuresCol="features", labelCol=label, weightCol="weight", maxIter=p["max_iter"],
        regParam=1.0 / (p["c"] * max(n, 1)), standardization=False,
    )
    return _fit(train, model, label, "balanced", scale=True)


def churn_forest(train: DataFrame, label: str = "churn", params: dict | None = None,
                 seed: int = 42, laid_out=even_parts) -> PipelineModel:
    p = {**FOREST_DEFAULTS, **(params or {})}
    model = RandomForestClassifier(
        featuresCol="features", labelCol=label, weightCol="weight", numTrees=p["trees"],
        maxDepth=p["depth"], minInstancesPerNode=p.get("min_rows", 1), seed=seed,
    )
    return _fit(train, model, label, "balanced", scale=False, laid_out=laid_out)


def churn_gbt(train: DataFrame, label: str = "churn", params: dict | None = None,
              seed: int = 42) -> PipelineModel:
    p = {**GBT_DEFAULTS, **(params or {})}
    model = GBTClassifier(
        featuresCol="features", labelCol=label, weightCol="weight", maxIter=p["rounds"],
        maxDepth=p["depth"], stepSize=p["rate"], subsamplingRate=p["subsample"],
        featureSubsetStrategy=str(p["columns"]), minInstancesPerNode=p.get("min_rows", 1), seed=seed,
    )
    return _fit(train, model, label, "scale_pos_weight", scale=False)


TRAINERS = {"logistic": churn_logistic, "forest": churn_forest, "gbt": churn_gbt}


def churn_candidates(train: DataFrame, params: dict[str, dict] | None = None) -> dict[str, PipelineModel]:
    """The three families fitted side by side on the same rows; ``params`` by family.

    Boosting and the logistic fit are chains of hundreds of short jobs that leave cores idle; the forest, whose
    few passes are long, keeps to half of them.
    """
    params, beside = params or {}, {"forest": {"laid_out": half_parts}}
    return dict(zip(TRAINERS, at_once([
        partial(fit, train, "churn", params.get(family), **beside.get(family, {})) for family, fit in TRAINERS.items()
    ])))


def churn_leaderboard(models: dict[str, PipelineModel], held_out: DataFrame) -> DataFrame:
    """Hold-out metrics by family with their place by PR-AUC, best first."""
    parts = [
        score(model, held_out).select(F.lit(family).alias("model"), "churn", "churn_probability")
        for family, model in models.items()
    ]
    scored = materialise(reduce(DataFrame.unionByName, parts), "candidates")
    return model_leaderboard(classifier_metrics(scored, by=["model"]), "pr_auc", best="high")


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with ``churn_probability``."""
    return model.transform(rows).select(
        *rows.columns, vector_to_array(F.col("probability"))[1].alias("churn_probability")
    )


def score_customers(model: PipelineModel, rows: DataFrame, segments: DataFrame | None = None,
                    threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """``card, churn_probability, churn_label, segment_name, monetary`` for every customer."""
    scored = score(model, rows).withColumn(
        "churn_label", (F.col("churn_probability") >= threshold).cast("int")
    )
    if segments is not None:
        scored = join_pred_segments(scored.drop("segment_name"), segments)
    return scored.select("card", "churn_probability", "churn_label", "segment_name", "monetary")


def join_pred_segments(predictions: DataFrame, segments: DataFrame) -> DataFrame:
    """Predictions with their segment, NULL for customers without one."""
    return predictions.join(segments.select("card", "segment_name"), "card", "left")


def feature_importance(model: PipelineModel, top: int | None = 12) -> DataFrame:
    """``feature, importance`` in descending order: tree importances or absolute coefficients."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    names: list[str] = []
    for c in assembler.getInputCols():
        if c == "_segment_1hot":
            labels = next(s for s in model.stages if hasattr(s, "labelsArray")).labelsArray[0]
            names += [f"segment_name_{v}" for v in labels]
        else:
            names.append(c)
    last = model.stages[-1]
    weights = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    # One row per model feature.
    rows = [(name, abs(float(weights[i]))) for i, name in enumerate(names)]
    table = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    ranked = table.orderBy(F.col("importance").desc(), "feature")
    return ranked if top is None else ranked.limit(top)


# -- metrics ----------------------------------------------------------------------


def ranked_scores(scored: DataFrame, label: str = "churn", score_col: str = "churn_probability",
                  by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score, highest first, with class counts up to it."""
    counted = scored.where(F.col(score_col).isNotNull()).groupBy(
        *by, (-F.col(score_col)).alias("_down")
    ).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    return running_totals(counted, ["_down"], ["pos", "neg"], by).withColumn("score", -F.col("_down"))


def _confusion(threshold: float) -> tuple[Column, Column, Column]:
    """Hits, flagged and positives at a threshold, from ranked scores."""
    flagged = F.col("score") >= threshold
    tp = F.sum(F.when(flagged, F.col("pos")).otherwise(F.lit(0)))
    fp = F.sum(F.when(flagged, F.col("neg")).otherwise(F.lit(0)))
    return tp, tp + fp, F.sum("pos")


def _f1(precision: Column, recall: Column) -> Column:
    return safe_ratio(2 * precision * recall, precision + recall)


def classifier_metrics(scored: DataFrame, label: str = "churn", score_col: str = "churn_probability",
                       threshold: float = DEFAULT_THRESHOLD, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 at the threshold; ROC-AUC; average precision as a step sum.

    A ratio without denominator is 0, ROC-AUC with one class only is NULL.
    """
    ranked = ranked_scores(scored, label, score_col, by)
    tp, flagged, positives = _confusion(threshold)
    step = F.col("pos") / F.col("pos_total") * F.col("pos_upto") / (F.col("pos_upto") + F.col("neg_upto"))
    # Positives above each negative; equal scores count half.
    above = F.col("neg") * (F.col("pos_upto") - F.col("pos") / 2)
    pairs = F.max("pos_total") * F.max("neg_total")
    out = ranked.groupBy(*by).agg(
        safe_ratio(tp, flagged).alias("precision"),
        safe_ratio(tp, positives).alias("recall"),
        F.when(pairs > 0, F.sum(above) / pairs).alias("roc_auc"),
        F.coalesce(F.sum(F.when(F.col("pos_total") > 0, step)), F.lit(0.0)).alias("pr_auc"),
    )
    return out.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def pr_curve(scored: DataFrame, label: str = "churn", score_col: str = "churn_probability") -> DataFrame:
    """``threshold, precision, recall`` at every distinct score."""
    ranked = ranked_scores(scored, label, score_col)
    return ranked.select(
        F.col("score").alias("threshold"),
        (F.col("pos_upto") / (F.col("pos_upto") + F.col("neg_upto"))).alias("precision"),
        safe_ratio(F.col("pos_upto"), F.col("pos_total")).alias("recall"),
    )


def threshold_table(scored: DataFrame, thresholds: Sequence[float] = THRESHOLDS, label: str = "churn",
                    score_col: str = "churn_probability") -> DataFrame:
    """Precision, recall, F1 and flagged customers per threshold, from one pass."""
    s, y = F.col(score_col), F.col(label)
    row = scored.agg(
        F.count_if(y == 1).alias("p"),
        *[F.count_if((s >= t) & (y == 1)).alias(f"tp{i}") for i, t in enumerate(thresholds)],
        *[F.count_if(s >= t).alias(f"n{i}") for i, t in enumerate(thresholds)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                safe_ratio(F.col(f"tp{i}"), F.col(f"n{i}")).alias("precision"),
                safe_ratio(F.col(f"tp{i}"), F.col("p")).alias("recall"),
                F.col(f"n{i}").alias("n_flagged"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    table = row.select(F.inline(lines))
    return table.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


# -- tuning ----------------------------------------------------------------------


def draw_params(family: str, trials: int, seed: int = 42, space: dict | None = None) -> list[dict]:
    rng = random.Random(seed)
    drawn = []
    for _ in range(trials):
        one: dict = {}
        for name, (low, high) in (space or TUNING_SPACES[family]).items():
            if name in LOG_SCALE:
                one[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
            elif isinstance(low, int):
                one[name] = rng.randint(low, high)
            else:
                one[name] = rng.uniform(low, high)
        drawn.append(one)
    return drawn


def tune_churn(train: DataFrame, family: str = "gbt", trials: int = 20, folds: int = 5, seed: int = 42,
               space: dict | None = None, label: str = "churn", key: str = "card") -> DataFrame:
    """``trial, params, pr_auc``: mean average precision over stratified folds, best first (see ``tuning``)."""
    features = available_columns(train, NUMERIC_FEATURES)
    names = tuning.segment_names(train)
    width = len(features) + len(names)
    points = materialise(
        stratified_folds(train, folds, label, key, seed).where(F.col(label).isNotNull()).select(
            F.col(key).alias("key"), F.col("fold").cast("int").alias("fold"), F.col(label).cast("double").alias("y"),
            *[c.alias(f"x{i}") for i, c in enumerate(tuning.design(train, features, names))],
        ),
        "folds",
    )
    drawn = draw_params(family, trials, seed, space)
    if family == "logistic":
        fits = tuning.logistic_fits(points, width, folds, [p["c"] for p in drawn])
        scored = tuning.logistic_scores(points, width, fits, trials)
    else:
        defaults = GBT_DEFAULTS if family == "gbt" else FOREST_DEFAULTS
        scored = tuning.tree_scores(points, width, folds, family, [{**defaults, **p, "seed": seed} for p in drawn])
    per_fold = classifier_metrics(materialise(scored, "fold-scores"), "y", "probability", by=["trial", "fold"])
    texts = F.array(*[F.lit(", ".join(f"{k}={v:.6g}" for k, v in sorted(p.items()))) for p in drawn])
    means = per_fold.groupBy("trial").agg(F.avg("pr_auc").alias("pr_auc"))
    named = means.select("trial", F.get(texts, F.col("trial")).alias("params"), "pr_auc")
    return named.orderBy(F.col("pr_auc").desc(), "trial")
