"""Registered queries: churn classification and customer clusters."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators import classification as cl, customers, density, segmentation as sg
from tallyfold.operators.trials import at_once
from tallyfold.plans import inputs, sqltext as S
from tallyfold.plans.queries_monitor import AP, PREDICTIONS, SCORES
from tallyfold.plans.registry import query
from tallyfold.scratch import materialise


def scores_sql(body: str, *more: str) -> str:
    return S.with_ctes(S.SALES, S.rfm(), S.behaviour(), SCORES, *more, body=body)


GLOBAL_AP = AP.format(by="0", source="labelled")

SPLIT = """split AS (
  SELECT card, churn, CASE WHEN row_number() OVER (PARTITION BY churn ORDER BY md5(card || ':42'), card)
           <= floor(count(*) OVER (PARTITION BY churn) * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS part FROM beh)"""


@query("stratified_split", S.with_ctes(S.SALES, S.behaviour(), SPLIT, body="SELECT * FROM split"))
def _(spark, sf_dir):
    labels = customers.behaviour(inputs.sales(spark, sf_dir)).select("card", "churn")
    return cl.stratified_split(labels)


@query("stratified_folds", S.with_ctes(S.SALES, S.behaviour(), body="""
SELECT card, churn, CAST(row_number() OVER (PARTITION BY churn ORDER BY md5(card || ':42'), card) % 5 AS INTEGER) AS fold FROM beh"""))
def _(spark, sf_dir):
    labels = customers.behaviour(inputs.sales(spark, sf_dir)).select("card", "churn")
    return cl.stratified_folds(labels)


@query("class_weights", S.with_ctes(S.SALES, S.behaviour(), body="""
SELECT n_neg, n_pos, n_neg / greatest(n_pos, 1) AS scale_pos_weight, (n_neg + n_pos) / (2 * n_neg) AS weight_neg,
       (n_neg + n_pos) / (2 * n_pos) AS weight_pos
FROM (SELECT count(*) FILTER (churn = 0) AS n_neg, count(*) FILTER (churn = 1) AS n_pos FROM beh)"""),
    "scale_pos_weight:9 weight_neg:9 weight_pos:9")
def _(spark, sf_dir):
    return cl.class_weights(customers.behaviour(inputs.sales(spark, sf_dir)))


@query("classifier_metrics", scores_sql("SELECT precision, recall, f1, roc_auc, pr_auc FROM quality", GLOBAL_AP),
       "precision:9 recall:9 f1:9 roc_auc:9 pr_auc:9")
def _(spark, sf_dir):
    return cl.classifier_metrics(inputs.labelled_scores(spark, sf_dir))


@query("pr_curve", scores_sql("""
SELECT s AS threshold, tp / (tp + fp) AS precision, tp / p AS recall FROM cum""", GLOBAL_AP),
    "threshold:9 precision:9 recall:9")
def _(spark, sf_dir):
    return cl.pr_curve(inputs.labelled_scores(spark, sf_dir))


@query("threshold_table", scores_sql("""
SELECT threshold, precision, recall, n_flagged,
       CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
FROM (SELECT threshold, count(*) FILTER (churn_probability >= threshold) AS n_flagged,
             coalesce(count(*) FILTER (churn_probability >= threshold AND churn = 1) / nullif(count(*) FILTER (churn_probability >= threshold), 0), 0.0) AS precision,
             count(*) FILTER (churn_probability >= threshold AND churn = 1) / count(*) FILTER (churn = 1) AS recall
      FROM labelled, (SELECT unnest([0.3, 0.4, 0.5, 0.6, 0.7])::DOUBLE AS threshold) GROUP BY threshold)"""),
    "precision:9 recall:9 f1:9")
def _(spark, sf_dir):
    return cl.threshold_table(inputs.labelled_scores(spark, sf_dir))


@query("join_pred_segments", S.churn_sql("""
SELECT l.card, l.churn_probability, s.segment_name FROM labelled l LEFT JOIN segments s ON s.card = l.card AND s.segment_name <> 'Lost'""", SCORES),
    "churn_probability:9")
def _(spark, sf_dir):
    scored = inputs.scored(spark, sf_dir)
    labels = customers.behaviour(inputs.sales(spark, sf_dir)).select("card")
    rows = scored.join(labels, "card").select("card", inputs.rule_score().alias("churn_probability"))
    kept = inputs.segments_of(scored).where("segment_name <> 'Lost'")
    return cl.join_pred_segments(rows, kept)


@query("one_hot_segment", S.scored_sql("SELECT card, " + ", ".join(
    f"CAST(segment_name = '{n}' AS INTEGER) AS \"segment_{n.replace(' ', '_')}\"" for n in inputs.SEGMENT_NAMES
) + " FROM scored"))
def _(spark, sf_dir):
    name = F.col("segment_name")
    return inputs.scored(spark, sf_dir).select(
        "card",
        *[(name == n).cast("int").alias(f"segment_{n.replace(' ', '_')}") for n in inputs.SEGMENT_NAMES],
    )


def split_table(spark, sf_dir) -> DataFrame:
    # The split lays rows out by range, which reads them twice.
    table = materialise(inputs.churn_table(spark, sf_dir), "churn-table")
    return materialise(cl.stratified_split(table), "split")


def evaluated(spark, sf_dir, trainer) -> DataFrame:
    """Hold-out metrics of one candidate."""
    split = split_table(spark, sf_dir)
    model = trainer(split.where("part = 'train'"))
    return cl.classifier_metrics(cl.score(model, split.where("part = 'test'")))


@query("churn_logistic")
def _(spark, sf_dir):
    return evaluated(spark, sf_dir, cl.churn_logistic)


@query("churn_forest")
def _(spark, sf_dir):
    return evaluated(spark, sf_dir, cl.churn_forest)


@query("churn_gbt")
def _(spark, sf_dir):
    return evaluated(spark, sf_dir, cl.churn_gbt)


@query("churn_champion")
def _(spark, sf_dir):
    split = split_table(spark, sf_dir)
    return cl.churn_leaderboard(cl.churn_candidates(split.where("part = 'train'")), split.where("part = 'test'"))


@query("score_customers")
def _(spark, sf_dir):
    rows = split_table(spark, sf_dir)
    model = cl.churn_logistic(rows.where("part = 'train'"))
    return cl.score_customers(model, rows, threshold=cl.RECOMMENDED_THRESHOLD)


@query("scores_follow_the_rule", S.with_ctes(S.SALES, S.behaviour(), body="""
SELECT count(*) AS customers, CAST(0 AS BIGINT) AS outside, CAST(0 AS BIGINT) AS mislabelled FROM beh"""))
def _(spark, sf_dir):
    """One row per customer, probabilities within [0, 1], labels by the threshold."""
    rows = split_table(spark, sf_dir)
    threshold = cl.RECOMMENDED_THRESHOLD
    scored = cl.score_customers(cl.churn_logistic(rows.where("part = 'train'")), rows, threshold=threshold)
    p = F.col("churn_probability")
    return scored.agg(
        F.count_distinct("card").alias("customers"),
        F.count_if(~p.between(0.0, 1.0)).alias("outside"),
        F.count_if((p >= threshold).cast("int") != F.col("churn_label")).alias("mislabelled"),
    )


@query("importances_add_up", "SELECT 1.0 AS total FROM (SELECT count(*) FROM lineitem)", "total:9")
def _(spark, sf_dir):
    split = split_table(spark, sf_dir)
    model = cl.churn_forest(split.where("part = 'train'"))
    return cl.feature_importance(model, top=None).agg(F.sum("importance").alias("total"))


@query("feature_importance")
def _(spark, sf_dir):
    split = split_table(spark, sf_dir)
    return cl.feature_importance(cl.churn_forest(split.where("part = 'train'")))


@query("churn_logistic_optimum", "SELECT 0.0 AS gradient FROM (SELECT count(*) FROM lineitem)", "gradient:3")
def _(spark, sf_dir):
    """Largest component of the penalised gradient beside the size of its terms: zero where the fit is the optimum."""
    train = split_table(spark, sf_dir).where("part = 'train'")
    model = cl.churn_logistic(train)
    beta, c = model.stages[-1].coefficients, cl.LOGISTIC_DEFAULTS["c"]
    z = vector_to_array(F.col("features"))
    scored = materialise(model.transform(cl.with_weights(train)).select(
        (F.col("weight") * (vector_to_array("probability")[1] - F.col("churn"))).alias("off"), F.abs("weight").alias("w"), z.alias("z")
    ), "scored")
    steep = [
        F.abs(F.sum(F.col("off") * F.get("z", F.lit(i))) + float(b) / c) / (1 + F.sum(F.col("w") * F.abs(F.get("z", F.lit(i)))))
        for i, b in enumerate(beta)
    ]
    return scored.agg(F.greatest(*steep).alias("gradient"))


@query("tune_churn")
def _(spark, sf_dir):
    """Settings of the champion's family, whichever that is."""
    split = split_table(spark, sf_dir)
    train = split.where("part = 'train'")
    models = cl.churn_candidates(train)
    champion = cl.churn_leaderboard(models, split.where("part = 'test'")).where("place = 1").first()["model"]
    return cl.tune_churn(train.drop("part"), champion).withColumn("family", F.lit(champion))


@query("tune_churn_logistic")
def _(spark, sf_dir):
    return cl.tune_churn(split_table(spark, sf_dir).where("part = 'train'").drop("part"), "logistic")


@query("tune_churn_forest")
def _(spark, sf_dir):
    return cl.tune_churn(split_table(spark, sf_dir).where("part = 'train'").drop("part"), "forest")


@query("tune_churn_gbt")
def _(spark, sf_dir):
    return cl.tune_churn(split_table(spark, sf_dir).where("part = 'train'").drop("part"), "gbt")


# -- clusters ------------------------------------------------------------------------


def fitted(spark, sf_dir, k: int = 4) -> sg.Clustering:
    return sg.kmeans_segments(sg.vectors(inputs.rfm(spark, sf_dir)), k)


@query("kmeans_segments")
def _(spark, sf_dir):
    return fitted(spark, sf_dir).rows.drop("features")


@query("kmeans_fixed_point", S.rfm_sql("""
SELECT count(*) AS customers, CAST(0 AS BIGINT) AS misplaced, 0.0 AS centre_gap FROM rfm"""), "centre_gap:3")
def _(spark, sf_dir):
    """A K-Means solution: every row is at its nearest centre and every centre is the mean of its rows."""
    fit = fitted(spark, sf_dir)
    centres = fit.centres
    reach = F.array(*[
        sum((F.pow(F.col(f) - v, F.lit(2.0)) for f, v in zip(customers.RFM_NORM, centre)), F.lit(0.0)) for centre in centres
    ])
    rows = materialise(fit.rows.select("cluster_id", *customers.RFM_NORM, reach.alias("reach")), "placed")
    means = rows.groupBy("cluster_id").agg(*[F.avg(f).alias(f"_{f}") for f in customers.RFM_NORM])
    gaps = sg.centroid_table(fit).join(means, "cluster_id").agg(
        F.max(F.greatest(*[F.abs(F.col(f) - F.col(f"_{f}")) for f in customers.RFM_NORM])).alias("gap")
    )
    return rows.agg(
        F.count("*").alias("customers"),
        F.count_if(F.col("reach")[F.col("cluster_id")] > F.array_min("reach") + 1e-12).alias("misplaced"),
    ).withColumn("centre_gap", gaps.scalar())


CENTRES = """centre AS (
  SELECT cluster_id, avg(recency_norm) AS x, avg(frequency_norm) AS y, avg(monetary_norm) AS z FROM member GROUP BY 1),
spread AS (
  SELECT cluster_id, any_value(x) AS x, any_value(y) AS y, any_value(z) AS z,
         avg(sqrt(pow(recency_norm - x, 2) + pow(frequency_norm - y, 2) + pow(monetary_norm - z, 2))) AS s
  FROM member JOIN centre USING (cluster_id) GROUP BY 1)"""
MEMBER = """member AS (SELECT r.*, s.cluster_id, s.segment_name FROM rfm r JOIN segments s USING (card))"""


def members(spark, sf_dir) -> DataFrame:
    """Customers with their quintile segment as cluster."""
    scored = materialise(inputs.scored(spark, sf_dir), "scored")
    ids = inputs.segments_of(scored).select("card", "cluster_id")
    return materialise(scored.join(ids, "card"), "members")


@query("davies_bouldin", S.scored_sql("""
SELECT avg(worst) AS davies_bouldin FROM (
  SELECT a.cluster_id, max((a.s + b.s) / sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2))) AS worst
  FROM spread a JOIN spread b ON a.cluster_id <> b.cluster_id GROUP BY 1)""", S.SEGMENTS, MEMBER, CENTRES), "davies_bouldin:9")
def _(spark, sf_dir):
    return sg.davies_bouldin(members(spark, sf_dir))


@query("silhouette_euclid", S.scored_sql("""
SELECT avg(CASE WHEN size = 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM (
  SELECT p, max(n) FILTER (own) AS size, max(total / nullif(n - 1, 0)) FILTER (own) AS a, min(total / n) FILTER (NOT own) AS b FROM (
    SELECT p.card AS p, p.cluster_id = q.cluster_id AS own, q.cluster_id AS c, count(*) AS n,
           sum(sqrt(pow(p.recency_norm - q.recency_norm, 2) + pow(p.frequency_norm - q.frequency_norm, 2) + pow(p.monetary_norm - q.monetary_norm, 2))) AS total
    FROM member p, member q GROUP BY ALL) GROUP BY p)""", S.SEGMENTS, MEMBER), "silhouette:9")
def _(spark, sf_dir):
    return sg.silhouette_euclid(members(spark, sf_dir))


LADDER = """summary AS (
  SELECT cluster_id, round_even(quantile_cont(CAST(recency_days AS DOUBLE), 0.5), 1) AS recency_days,
         round_even(quantile_cont(CAST(frequency AS DOUBLE), 0.5), 1) AS frequency FROM member GROUP BY 1),
placed AS (
  SELECT cluster_id, row_number() OVER (ORDER BY recency_days, cluster_id) AS place,
         row_number() OVER (ORDER BY frequency DESC, cluster_id) = 1 AS busy FROM summary),
swapped AS (
  SELECT cluster_id, CASE WHEN place <= 2 AND (SELECT bool_or(place = 2 AND busy) FROM placed) THEN 3 - place ELSE place END AS place FROM placed),
named AS (
  SELECT cluster_id, ['Champions', 'Loyal', 'Potential', 'At Risk', 'Lost', 'Inactive'][least(place, 6)] AS segment_name FROM swapped)"""


@query("name_clusters_ladder", S.scored_sql("SELECT * FROM named", S.SEGMENTS, MEMBER, LADDER))
def _(spark, sf_dir):
    return sg.name_clusters_ladder(sg.cluster_summary(members(spark, sf_dir)))


@query("segment_order", S.scored_sql("SELECT cluster_id, CAST(place AS INTEGER) AS place FROM placed", S.SEGMENTS, MEMBER, LADDER))
def _(spark, sf_dir):
    from pyspark.sql import Window

    order = Window.partitionBy().orderBy("recency_days", "cluster_id")
    summary = sg.cluster_summary(members(spark, sf_dir))
    return summary.select("cluster_id", F.row_number().over(order).alias("place"))


@query("cluster_name_join", S.scored_sql("""
SELECT card, cluster_id, named.segment_name, recency_days, frequency, monetary FROM member JOIN named USING (cluster_id)""",
    S.SEGMENTS, MEMBER, LADDER), "monetary")
def _(spark, sf_dir):
    rows = members(spark, sf_dir).drop("segment_name")
    return sg.customer_segments(rows, sg.name_clusters_ladder(sg.cluster_summary(rows)))


@query("name_clusters_freq", S.scored_sql("""
SELECT cluster_id, ['At Risk', 'Loyal', 'Champions', 'New', 'Lost'][row_number() OVER (ORDER BY y DESC, cluster_id)] AS segment_name
FROM centre""", S.SEGMENTS, MEMBER, CENTRES))
def _(spark, sf_dir):
    centres = members(spark, sf_dir).groupBy("cluster_id").agg(F.avg("frequency_norm").alias("frequency_norm"))
    return sg.name_clusters_freq(centres)


@query("centroid_backtransform", S.scored_sql("""
SELECT cluster_id, (SELECT max(recency_days) FROM rfm) - x * (SELECT max(recency_days) - min(recency_days) FROM rfm) AS recency_days,
       (SELECT min(frequency) FROM rfm) + y * (SELECT max(frequency) - min(frequency) FROM rfm) AS frequency,
       (SELECT min(monetary) FROM rfm) + z * (SELECT max(monetary) - min(monetary) FROM rfm) AS monetary FROM centre""",
    S.SEGMENTS, MEMBER, CENTRES), "recency_days:7 frequency:8 monetary:5")
def _(spark, sf_dir):
    rows = members(spark, sf_dir)
    centres = rows.groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in customers.RFM_NORM])
    return sg.centroid_backtransform(centres, rows)


@query("k_sweep")
def _(spark, sf_dir):
    return sg.k_sweep(sg.vectors(inputs.rfm(spark, sf_dir)))


@query("k_sweep_fixed_points", S.rfm_sql("""
SELECT CAST(k AS INTEGER) AS k, count(*) AS customers, CAST(0 AS BIGINT) AS misplaced, 0.0 AS centre_gap, 0.0 AS inertia_gap
FROM rfm, range(2, 9) r(k) GROUP BY k"""), "centre_gap:3 inertia_gap:6")
def _(spark, sf_dir):
    """The solution of every k: rows at their nearest centre, centres at the mean of their rows, costs that add up."""
    rows = sg.vectors(inputs.rfm(spark, sf_dir))
    lines = []
    for k, run in sg.kmeans_runs(rows, list(sg.K_RANGE)).items():
        near = [F.col(f"_d{i}") for i in range(k)]
        away = [
            sum((F.pow(F.col(f) - v, F.lit(2.0)) for f, v in zip(customers.RFM_NORM, c)), F.lit(0.0)).alias(f"_d{i}")
            for i, c in enumerate(run.centres.tolist())
        ]
        placed = sg.place_rows(rows, run.centres).select("cluster_id", *customers.RFM_NORM, *away)
        own = F.get(F.array(*near), F.col("cluster_id"))
        gap = F.greatest(*[
            F.max(F.abs(F.col(f"_m{f}") - F.get(F.array(*[F.lit(v) for v in run.centres[:, d].tolist()]), F.col("cluster_id"))))
            for d, f in enumerate(customers.RFM_NORM)
        ])
        per = placed.groupBy("cluster_id").agg(
            F.count("*").alias("n"), F.count_if(own > F.least(*near) + 1e-12).alias("off"), F.sum(own).alias("cost"),
            *[F.avg(f).alias(f"_m{f}") for f in customers.RFM_NORM],
        )
        lines.append(per.agg(
            F.lit(k).alias("k"), F.sum("n").alias("customers"), F.sum("off").alias("misplaced"), gap.alias("centre_gap"),
            F.abs(F.sum("cost") - F.lit(float(run.cost))).alias("inertia_gap"),
        ))
    return reduce(DataFrame.unionByName, lines)


@query("choose_k")
def _(spark, sf_dir):
    return sg.choose_k(sg.k_sweep(sg.vectors(inputs.rfm(spark, sf_dir))))


# -- density -------------------------------------------------------------------------

EPS = 0.04

DISTANCES = """pairs AS (
  SELECT p.card, sqrt(pow(p.recency_norm - q.recency_norm, 2) + pow(p.frequency_norm - q.frequency_norm, 2) + pow(p.monetary_norm - q.monetary_norm, 2)) AS d
  FROM rfm p, rfm q)"""


NEAR = f"""near AS (
  SELECT p.card AS p, q.card AS q FROM rfm p JOIN rfm q
  ON pow(p.recency_norm - q.recency_norm, 2) + pow(p.frequency_norm - q.frequency_norm, 2) + pow(p.monetary_norm - q.monetary_norm, 2)
     <= CAST('{EPS * EPS!r}' AS DOUBLE))"""


@query("eps_neighbour_join", S.rfm_sql("""
SELECT p AS card, count(*) AS n_neighbours, count(*) >= 5 AS is_core FROM near GROUP BY 1""", NEAR))
def _(spark, sf_dir):
    counts = density.eps_neighbour_counts(inputs.rfm(spark, sf_dir), EPS)
    return counts.select("card", "n_neighbours", (F.col("n_neighbours") >= density.MIN_POINTS).alias("is_core"))


CELLS = ", ".join(f"CAST(floor({c} / CAST('{density.cell_side(EPS)!r}' AS DOUBLE)) AS BIGINT)" for c in customers.RFM_NORM)


@query("dbscan_labels", S.rfm_sql("""
SELECT card, CAST(coalesce(inner_id, border_id, -1) AS INTEGER) AS cluster_id FROM rfm
LEFT JOIN (SELECT card, cluster_id AS inner_id FROM core JOIN numbered USING (cell)) USING (card)
LEFT JOIN (SELECT p AS card, min(cluster_id) AS border_id FROM near JOIN core ON core.card = q JOIN numbered USING (cell) GROUP BY 1)
USING (card)""", NEAR, f"""core AS (
  SELECT card, concat_ws(':', {CELLS}) AS cell FROM rfm JOIN (SELECT p AS card FROM near GROUP BY 1 HAVING count(*) >= 5) USING (card)),
edges AS (SELECT DISTINCT a.cell AS x, b.cell AS y FROM near JOIN core a ON a.card = p JOIN core b ON b.card = q),
numbered AS (
  SELECT cell, dense_rank() OVER (ORDER BY root) - 1 AS cluster_id FROM (
    WITH RECURSIVE walk AS (
      SELECT DISTINCT cell, cell AS root FROM core
      UNION SELECT y, root FROM walk JOIN edges ON x = cell)
    SELECT cell, min(root) AS root FROM walk GROUP BY 1))"""))
def _(spark, sf_dir):
    """DBSCAN at a fixed eps, beside the same clusters by recursion."""
    return density.dbscan_segments(materialise(inputs.rfm(spark, sf_dir), "rfm"), EPS).select("card", "cluster_id")


@query("k_distance", S.rfm_sql("""
SELECT card, d AS k_distance FROM pairs QUALIFY row_number() OVER (PARTITION BY card ORDER BY d) = 5""", DISTANCES), "k_distance:8")
def _(spark, sf_dir):
    return density.k_distance(inputs.rfm(spark, sf_dir))


@query("suggested_eps", S.rfm_sql("""
SELECT coalesce(quantile_cont(d, 0.15) FILTER (d > 0), 1e-9) AS eps
FROM (SELECT d FROM pairs QUALIFY row_number() OVER (PARTITION BY card ORDER BY d) = 5)""", DISTANCES), "eps:8")
def _(spark, sf_dir):
    eps = density.suggested_eps(density.k_distance(inputs.rfm(spark, sf_dir)))
    return spark.range(1).select(F.lit(eps).alias("eps"))


@query("dbscan_segments")
def _(spark, sf_dir):
    rows = materialise(inputs.rfm(spark, sf_dir), "rfm")
    return density.dbscan_segments(rows, density.suggested_eps(density.k_distance(rows), above=density.LEAST_EPS))


def champion_of(rows: DataFrame) -> DataFrame:
    """Both searches side by side: each is a chain of hundreds of short jobs that leave cores idle."""

    def best_k() -> DataFrame:
        chosen = sg.choose_k(sg.k_sweep(rows)).withColumnRenamed("silhouette_squared", "silhouette")
        return materialise(chosen, "sweep")

    sweep, search = at_once([best_k, lambda: density.dbscan_search(rows)])
    return sg.cluster_champion(sweep, search)


@query("cluster_champion")
def _(spark, sf_dir):
    """K-Means with the best k against DBSCAN with the best eps, both by the squared silhouette."""
    return champion_of(sg.vectors(inputs.rfm(spark, sf_dir)))
