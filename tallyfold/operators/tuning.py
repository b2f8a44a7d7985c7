"""Search for churn settings: every setting on every fold, all side by side.

The logistic family is fitted on all rows by Newton steps that all (setting, fold) pairs share: one pass adds up the
gradient and curvature of each pair, a small system per pair is solved, and pairs that stand still
drop out. Trees have no such sums; each (setting, fold) pair is fitted on all rows in a task of its own, which
reads the stored rows itself. Such a task holds all rows, so its memory and time grow with them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators import boosting

NEWTON_STEPS, TOLERANCE = 50, 1e-8
PIECE_ROWS = 512


def design(rows: DataFrame, features: Sequence[str], segments: Sequence[str] = ()) -> list[Column]:
    """Features as doubles, missing as 0, and a 0/1 column per segment."""
    numbers = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in features]
    return numbers + [F.coalesce((F.col("segment_name") == s).cast("double"), F.lit(0.0)) for s in segments]


def segment_names(rows: DataFrame) -> list[str]:
    """Names in order; a handful."""
    if "segment_name" not in rows.columns:
        return []
    return sorted(r[0] for r in rows.select("segment_name").distinct().collect() if r[0] is not None)


def _x(batch, width: int) -> np.ndarray:
    return np.column_stack([batch.column(f"x{i}").to_numpy(zero_copy_only=False) for i in range(width)])


def _pairs(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    return _x(batch, width), *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold"))


def _pieces(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Features, targets and folds of so few rows that a number per row and pair stays in a core's cache."""
    for batch in batches:
        parts = _pairs(batch, width)
        for start in range(0, batch.num_rows, PIECE_ROWS):
            yield tuple(part[start : start + PIECE_ROWS] for part in parts)


def fold_moments(points: DataFrame, width: int, folds: int) -> dict[int, dict]:
    """Per fold left out: class counts, means and deviations of the features of the other folds."""
    x = [F.col(f"x{i}") for i in range(width)]
    sums = points.groupBy("fold").agg(
        F.count("*").alias("n"), F.sum("y").alias("pos"),
        *[F.sum(c).alias(f"s{i}") for i, c in enumerate(x)], *[F.sum(c * c).alias(f"q{i}") for i, c in enumerate(x)],
    ).collect()  # one row per fold
    out = {}
    for left_out in range(folds):
        rest = [r for r in sums if r["fold"] != left_out]
        n = sum(r["n"] for r in rest)
        if not n:
            continue
        mean = np.array([sum(r[f"s{i}"] for r in rest) for i in range(width)]) / n
        square = np.array([sum(r[f"q{i}"] for r in rest) for i in range(width)])
        # Sample deviation; a constant feature is left at 0.
        deviation = np.sqrt(np.maximum(square - n * mean**2, 0) / max(n - 1, 1))
        pos = float(sum(r["pos"] for r in rest))
        out[left_out] = {"n": n, "pos": pos, "mean": mean,
                         "scale": np.where(deviation > 1e-9 * np.maximum(1, np.abs(mean)), deviation, np.inf)}
    return out


def logistic_fits(points: DataFrame, width: int, folds: int, penalties: Sequence[float]) -> dict[tuple[int, int], np.ndarray]:
    """(setting, fold) to coefficients of the standardised features and an intercept.

    Minimises the class-balanced loss plus ``1 / (2 c)`` times the squared coefficients.
    """
    known = {f: m for f, m in fold_moments(points, width, folds).items() if 0 < m["pos"] < m["n"]}
    beta = {(t, f): np.zeros(width + 1) for t in range(len(penalties)) for f in known}
    moving, size = set(beta), width + 1
    upper = np.triu_indices(size)
    # Batches are standardised once, by numbers common to all folds; a fold's own features are linear in those.
    centre = np.mean([m["mean"] for m in known.values()], axis=0) if known else np.zeros(width)
    spread = np.max([np.where(np.isfinite(m["scale"]), m["scale"], 0.0) for m in known.values()], axis=0, initial=0.0)
    spread = np.where(spread > 0, spread, 1.0)
    own = {}
    for f, m in known.items():
        own[f] = np.diag(np.append(spread / m["scale"], 1.0))
        own[f][-1, :-1] = (centre - m["mean"]) / m["scale"]
    for _ in range(NEWTON_STEPS):
        if not moving:
            break
        now = {pair: beta[pair] for pair in sorted(moving)}

        def sums(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            left_out = np.array([f for _, f in now])
            start = np.column_stack([own[f] @ b for (_, f), b in now.items()])
            positive = np.array([known[f]["n"] / (2 * known[f]["pos"]) for f in left_out])
            negative = np.array([known[f]["n"] / (2 * (known[f]["n"] - known[f]["pos"])) for f in left_out])
            added = np.zeros((len(now), size + len(upper[0])))
            for raw, y, fold in _pieces(batches, width):
                x = np.column_stack([(raw - centre) / spread, np.ones(len(y))])
                # Rows by pairs: all sums are two products of matrices.
                share = boosting.logistic(x @ start)
                weight = np.where((y == 1)[:, None], positive, negative) * (fold[:, None] != left_out)
                added[:, :size] += (weight * (share - y[:, None])).T @ x
                added[:, size:] += (weight * share * (1 - share)).T @ (x[:, upper[0]] * x[:, upper[1]])
            totals = dict(zip(now, added))
            yield pa.record_batch(
                [pa.array([p[0] for p in totals], pa.int32()), pa.array([p[1] for p in totals], pa.int32()),
                 pa.array([v.tolist() for v in totals.values()], pa.list_(pa.float64()))], names=["trial", "fold", "sums"]
            )

        table = points.mapInArrow(sums, "trial int, fold int, sums array<double>").groupBy("trial", "fold")
        added = F.array(*[F.sum(F.get("sums", F.lit(d))) for d in range(size + len(upper[0]))])
        for row in table.agg(added.alias("sums")).collect():  # one row per pair
            pair = row["trial"], row["fold"]
            ridge = np.append(np.full(width, 1 / penalties[pair[0]]), 1e-12)
            turn = own[pair[1]]
            slope = turn.T @ np.array(row["sums"][:size]) + ridge * beta[pair]
            gram = np.zeros((size, size))
            gram[upper] = row["sums"][size:]
            gram = turn.T @ (gram + np.triu(gram, 1).T) @ turn + np.diag(ridge)
            step = np.linalg.solve(gram, slope)
            # Far steps of nearly separable data are shortened; the loss is convex.
            beta[pair] = beta[pair] - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-300))
            if np.abs(step).max() <= TOLERANCE * (1 + np.abs(beta[pair]).max()):
                moving.discard(pair)
    return {pair: np.concatenate([b[:-1] / known[pair[1]]["scale"],
                                  [b[-1] - (b[:-1] * known[pair[1]]["mean"] / known[pair[1]]["scale"]).sum()]])
            for pair, b in beta.items()}


def logistic_scores(points: DataFrame, width: int, fits: dict[tuple[int, int], np.ndarray], trials: int) -> DataFrame:
    """``trial, fold, y, probability`` of every row under the fits that left its fold out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, y, fold = _pairs(batch, width)
            for (trial, f), b in fits.items():
                at = np.flatnonzero(fold == f)
                share = boosting.logistic(raw[at] @ b[:-1] + b[-1])
                yield pa.record_batch(
                    [pa.array(np.full(len(at), trial, np.int32)), pa.array(np.full(len(at), f, np.int32)),
                     pa.array(y[at]), pa.array(share)], names=["trial", "fold", "y", "probability"]
                )

    return points.mapInArrow(run, "trial int, fold int, y double, probability double")


def _all_rows(batches: Iterator[pa.RecordBatch], width: int) -> tuple:
    """Number of the pair, features, targets and folds of all rows in the order of their keys; None each without rows."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return (None,) * 4
    table = pa.Table.from_batches(held)
    turn = pc.sort_indices(table.column("key")).to_numpy()
    x = np.empty((len(turn), width))
    for i in range(width):
        x[:, i] = table.column(f"x{i}").to_numpy()[turn]
    y, own = (table.column(c).to_numpy()[turn] for c in ("y", "fold"))
    return table.column("pair")[0].as_py(), x, y, own


def longest_first(settings: Sequence[dict], folds: int) -> list[tuple[int, int]]:
    """(setting, fold) pairs by the number of tree levels and columns they search, most first, as partitions are begun in order."""

    def levels(p: dict) -> float:
        return p.get("trees", p.get("rounds", 1)) * p.get("depth", 1) * p.get("columns", 1.0)

    order = sorted(range(len(settings)), key=lambda t: (-levels(settings[t]), t))
    return [(t, f) for t in order for f in range(folds)]


def tree_scores(points: DataFrame, width: int, folds: int, family: str, settings: Sequence[dict]) -> DataFrame:
    """``trial, fold, y, probability`` of the rows of each fold, every (trial, fold) fitted on all other rows in a task of its own.

    ``points`` should be stored: every task reads them, so they are not shuffled once per pair.
    """
    pairs = longest_first(settings, folds)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, x, y, own = _all_rows(batches, width)
        if pair is None:
            return
        trial, fold = pairs[pair]
        rest, held = own != fold, own == fold
        asked, seen, targets = x[held], x[rest], y[rest]
        del x
        pos, total = targets.sum(), rest.sum()
        probability = np.full(held.sum(), np.nan)
        if 0 < pos < total:
            p = settings[trial]
            if family == "gbt":
                weight = np.where(targets == 1, (total - pos) / pos, 1.0)
                trees = boosting.fit_trees(seen, targets, {**p, "loss": "logistic"}, weight)
                probability = boosting.logistic(boosting.predict_trees(trees, asked))
            else:
                weight = np.where(targets == 1, total / (2 * pos), total / (2 * (total - pos)))
                probability = boosting.fit_forest(seen, targets, asked, {"columns": 0.5, **p}, weight)
        n = len(probability)
        yield pa.record_batch(
            [pa.array(np.full(n, trial, np.int32)), pa.array(np.full(n, fold, np.int32)), pa.array(y[held]),
             pc.if_else(pc.is_nan(pa.array(probability)), None, pa.array(probability))], names=["trial", "fold", "y", "probability"]
        )

    # A partition per pair, in their order: the rows of one partition beside each of the pairs, whatever the sizes.
    numbers = points.sparkSession.range(0, len(pairs), 1, len(pairs)).select(F.col("id").cast("int").alias("pair"))
    met = points.coalesce(1).hint("shuffle_replicate_nl").crossJoin(numbers)
    return met.mapInArrow(fit, "trial int, fold int, y double, probability double")
