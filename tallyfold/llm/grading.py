"""Quality classifier: ordinal regression with a cumulative link on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered thresholds cut its score into
grades: P(grade <= k) = logistic(threshold_k - score). From that follow the expected grade and the tail
probability P(grade >= k) that selects documents.

Features: distinct words of the whole text and their beginnings, hashed to ``2 ** BITS`` columns, and the
text's shape (marks that follow words, upper case, repetition) by share. Values are scaled by the
number of words, so long texts do not win by length. Weights are shrunk more where a column's documents
are graded like all others, which one count per column and grade tells beforehand.

Fitting uses a sample of about ``FIT_ROWS`` rated documents, chosen by a hash of the id; this bound
is the only sampling. Its features are stored once, every step of the optimiser (L-BFGS) is one
aggregation of gradients over executors, and the driver holds a few vectors of ``2 ** BITS`` numbers.
Scoring is one pass over all documents, without a shuffle.

Ratings with a null grade or id, or of unknown documents, are not used. Null and empty texts have no features and
are scored by the thresholds alone. A grade without ratings gets no probability of its own. Without ratings
every document gets a null grade and is not selected. Equal texts get equal scores; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm.common import documents, row_slices
from tallyfold.llm.language import fold
from tallyfold.scratch import drop, materialise

BITS = 16
FIT_ROWS = 16_000
#: Bytes of a word's beginning that are a feature of their own.
STEM = 5
RIDGE = 0.3
STEPS = 40
#: Tasks of a gradient: each returns one vector to the driver.
FIT_TASKS = 4
TAIL_GRADE, SELECT_AT = 2, 0.5


def features(text: str) -> dict[int, float]:
    """Hashed columns with their values."""
    words = text.split()
    if not words:
        return {}
    counted = Counter(words)
    shape: Counter[str] = Counter()
    for word, n in counted.items():
        if word.isupper() and len(word) > 1:
            shape["upper"] += n
        if not word[-1].isalnum():
            shape["end " + word[len(word.rstrip("!?.,;:|*%$&#<>~^-_=+/\\'\"()[]{}")):][:4]] += n
    shape["repeated"] = len(words) - len(counted)
    mask = (1 << BITS) - 1
    out: dict[int, float] = {}
    scale = 4.0 / (4.0 + len(counted) ** 0.5)
    for word in counted:
        bare = word.lower().strip(".,;:!?\"'()").encode("utf-8", "surrogatepass")
        out[zlib.crc32(bare) & mask] = scale
        if len(bare) > STEM:
            out[zlib.crc32(b"\1" + bare[:STEM]) & mask] = scale
    for name, n in shape.items():
        level = int(8 * n / len(words))
        for step in range(1, level + 1):  # each level reached counts
            out[zlib.crc32(f"\0{name} {step}".encode("utf-8", "surrogatepass")) & mask] = 1.0
    return out


def _matrix(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of all features."""
    rows, columns, values = [], [], []
    for i, text in enumerate(texts):
        found = features(text or "")
        rows.append(np.full(len(found), i))
        columns.append(np.fromiter(found.keys(), np.int64, len(found)))
        values.append(np.fromiter(found.values(), np.float64, len(found)))
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(values)


def _featurised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in row_slices(batch):
            found = [features(t or "") for t in part.column(1).to_pylist()]
            yield pa.record_batch(
                [
                    part.column(0),
                    pa.array([list(f) for f in found], pa.list_(pa.int32())),
                    pa.array([list(f.values()) for f in found], pa.list_(pa.float32())),
                ],
                names=["grade", "columns", "values"],
            )


@dataclass
class Grader:
    """``grades`` in order, a weight per column and a threshold between neighbouring grades."""

    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    def at_most(self, score: np.ndarray) -> np.ndarray:
        """P(grade <= k) for all but the highest grade."""
        return _logistic(self.thresholds[None, :] - score[:, None])

    def shares(self, score: np.ndarray) -> np.ndarray:
        upto = np.hstack([np.zeros((len(score), 1)), self.at_most(score), np.ones((len(score), 1))])
        return np.diff(upto, axis=1)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def thresholds_of(free: np.ndarray) -> np.ndarray:
    """Ordered thresholds from unbounded numbers: the first, then logs of the gaps."""
    return free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])


def loss_and_slope(theta: np.ndarray, cuts: int, grade, rows, columns, values) -> tuple[float, np.ndarray]:
    """Negative log likelihood of one part of the ratings and its gradient."""
    weights, free = theta[:-cuts], theta[-cuts:]
    score = np.bincount(rows, values * weights[columns], minlength=len(grade))
    limits = thresholds_of(free)
    upper = _logistic(np.where(grade < cuts, limits[np.minimum(grade, cuts - 1)] - score, 40.0))
    lower = _logistic(np.where(grade > 0, limits[np.maximum(grade - 1, 0)] - score, -40.0))
    share = np.maximum(upper - lower, 1e-12)
    steep_up, steep_low = upper * (1 - upper), lower * (1 - lower)
    by_score = (steep_up - steep_low) / share
    slope = np.zeros_like(theta)
    slope[:-cuts] = np.bincount(columns, values * by_score[rows], minlength=len(weights))
    by_limit = np.bincount(np.minimum(grade, cuts - 1), np.where(grade < cuts, -steep_up / share, 0), minlength=cuts)
    by_limit += np.bincount(np.maximum(grade - 1, 0), np.where(grade > 0, steep_low / share, 0), minlength=cuts)
    # A threshold moves with the first number and with every gap up to it.
    slope[-cuts] = by_limit.sum()
    for gap in range(1, cuts):
        slope[-cuts + gap] = by_limit[gap:].sum() * np.exp(free[gap])
    return float(-np.log(share).sum()), slope


def minimise(evaluate, start: np.ndarray, steps: int = STEPS, memory: int = 8) -> np.ndarray:
    """L-BFGS with step halving; ``evaluate`` returns loss and gradient."""
    x, pairs = start, []
    loss, slope = evaluate(x)
    for _ in range(steps):
        direction, alphas = -slope, []
        for s, y, rho in reversed(pairs):
            alphas.append(rho * s @ direction)
            direction = direction - alphas[-1] * y
        if pairs:
            s, y, _ = pairs[-1]
            direction = direction * (s @ y) / (y @ y)
        else:
            direction = direction / max(1.0, np.abs(direction).sum() ** 0.5)
        for (s, y, rho), alpha in zip(pairs, reversed(alphas), strict=True):
            direction = direction + s * (alpha - rho * y @ direction)
        size, along = 1.0, slope @ direction
        while True:
            moved = x + size * direction
            new_loss, new_slope = evaluate(moved)
            if new_loss <= loss + 1e-4 * size * along or size < 1e-3:
                break
            size /= 2.5
        if new_loss > loss:
            break
        s, y = moved - x, new_slope - slope
        done = loss - new_loss < 1e-4 * abs(loss)
        x, loss, slope = moved, new_loss, new_slope
        if s @ y > 1e-10:
            pairs = [*pairs, (s, y, 1.0 / (s @ y))][-memory:]
        if done:
            break
    return x


def clearness(table: DataFrame, grades: int) -> np.ndarray:
    """Factor of each column, from how clearly its documents differ in grade from the rest."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((grades, 1 << BITS), np.int32)
        rows = np.zeros(grades, np.int64)
        for batch in batches:
            grade = batch.column(0).to_numpy()
            lengths = np.diff(batch.column(1).offsets.to_numpy())
            np.add.at(held, (np.repeat(grade, lengths), batch.column(1).flatten().to_numpy()), 1)
            rows += np.bincount(grade, minlength=grades)
        yield pa.record_batch(
            [pa.array([rows.tobytes()], pa.binary()), pa.array([held.tobytes()], pa.binary())], names=["rows", "held"]
        )

    held, rows = np.zeros((grades, 1 << BITS)), np.zeros(grades)
    for part in table.coalesce(FIT_TASKS).mapInArrow(count, "rows binary, held binary").toLocalIterator():
        held += np.frombuffer(part["held"], np.int32).reshape(held.shape)
        rows += np.frombuffer(part["rows"], np.int64)
    clear = np.zeros(1 << BITS)
    for cut in range(1, grades):
        low, high = held[:cut].sum(0), held[cut:].sum(0)
        ratio = np.log((low + 0.5) / (rows[:cut].sum() + 1)) - np.log((high + 0.5) / (rows[cut:].sum() + 1))
        clear = np.maximum(clear, ratio**2 / (1 / (low + 0.5) + 1 / (high + 0.5)))
    return np.sqrt((0.1 + np.maximum(0, clear - 4)) / 10)


def fit(rated: DataFrame) -> Grader | None:
    """A grader from rows (id, grade int, text); at most a few thousand rows are sensible, see ``sample``."""
    spark = rated.sparkSession
    grades = sorted(r["grade"] for r in rated.select("grade").distinct().collect())  # few
    if not grades:
        return None
    if len(grades) == 1:
        return Grader(grades, np.zeros(1 << BITS), np.zeros(0))
    number = F.array_position(F.array(*[F.lit(g) for g in grades]), F.col("grade")).cast("int") - 1
    wide = rated.repartition(FIT_TASKS, "id").select(number.alias("grade"), "text")
    table = materialise(
        wide.mapInArrow(_featurised, "grade int, columns array<int>, values array<float>"), "features"
    )
    cuts = len(grades) - 1
    total = table.count()
    # Columns are stretched instead of shrunk differently, which the optimiser takes better.
    stretch = clearness(table, len(grades))

    def evaluate(theta: np.ndarray) -> tuple[float, np.ndarray]:
        shipped = spark.sparkContext.broadcast(np.concatenate([theta[:-cuts] * stretch, theta[-cuts:]]))

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loss, slope = 0.0, np.zeros(len(shipped.value))
            for batch in batches:
                columns, values = batch.column(1), batch.column(2)
                lengths = np.diff(columns.offsets.to_numpy())
                rows = np.repeat(np.arange(batch.num_rows), lengths)
                found = loss_and_slope(
                    shipped.value, cuts, batch.column(0).to_numpy(), rows,
                    columns.flatten().to_numpy(), values.flatten().to_numpy().astype(np.float64),
                )
                loss, slope = loss + found[0], slope + found[1]
            yield pa.record_batch([pa.array([loss]), pa.array([slope.tobytes()], pa.binary())], names=["loss", "slope"])

        # One vector per task; FIT_TASKS bounds them.
        got = table.coalesce(FIT_TASKS).mapInArrow(part, "loss double, slope binary").collect()
        shipped.destroy()
        got.sort(key=lambda r: (r["loss"], bytes(r["slope"][:64])))  # the same sum in every run
        loss = sum(r["loss"] for r in got) / total
        slope = sum(np.frombuffer(r["slope"], np.float64) for r in got) / total
        weights = theta[:-cuts]
        loss += 0.5 * RIDGE / total * weights @ weights
        slope[:-cuts] = slope[:-cuts] * stretch + RIDGE / total * weights
        return loss, slope

    start = np.zeros((1 << BITS) + cuts)
    start[-cuts] = -1.0
    theta = minimise(evaluate, start)
    drop(table)
    return Grader(grades, (theta[:-cuts] * stretch).astype(np.float32), thresholds_of(theta[-cuts:]))


def sample(ratings: DataFrame, docs: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """About ``rows`` rated documents as (id, grade, text), chosen by a hash of the id.

    An id with several ratings counts once with each, one with several texts by the first in code-point order.
    """
    known = ratings.where("doc_id IS NOT NULL AND grade IS NOT NULL")
    n = max(1, known.count())
    parts = 1 << 20
    chosen = known.where(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(parts)) < parts * rows // n)
    ids = chosen.select(F.col("doc_id").alias("_id"), "grade").distinct()
    # Bounded by ``rows``, give or take the spread of the hash; one text per id, however many rows hold it.
    held = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
    return held.groupBy(F.col("_id").alias("id"), "grade").agg(F.min("text").alias("text"))


def score(docs: DataFrame, grader: Grader | None, tail: int = TAIL_GRADE) -> DataFrame:
    """``doc_id, expected_grade, tail_probability`` for every document."""
    shipped = docs.sparkSession.sparkContext.broadcast(grader)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in batches:
            for part in row_slices(batch):
                if model is None:
                    expected = above = pa.nulls(part.num_rows, pa.float64())
                else:
                    rows, columns, values = _matrix(part.column(1).to_pylist())
                    total = np.bincount(rows, values * model.weights[columns], minlength=part.num_rows)
                    shares = model.shares(total)
                    grades = np.array(model.grades)
                    expected, above = pa.array(shares @ grades), pa.array(shares[:, grades >= tail].sum(1))
                yield pa.record_batch([part.column(0), expected, above], names=["doc_id", "expected", "above"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, expected double, above double"
    ).toDF("doc_id", "expected_grade", "tail_probability")


def grades_of(labels: DataFrame) -> DataFrame:
    """Ratings from the labels: 0 poor, 1 well written but toxic, 2 well written and harmless."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.cast("int").alias("grade"))


def op1_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on ratings outside the held-out fold; every document is graded."""
    docs = documents(spark, sf_dir)
    ratings = grades_of(spark.read.parquet(f"{sf_dir}/labels.parquet")).where(fold(F.col("doc_id")) != 1)
    out = score(docs, fit(sample(ratings, docs)))
    return out.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "expected_grade",
        "tail_probability",
        F.coalesce(F.col("tail_probability") >= SELECT_AT, F.lit(False)).alias("selected"),
    )
