"""Boosted regression trees: one model per group of rows, all groups and settings in parallel.

For groups that a task holds by their nature, such as the days of one product, however many groups
there are. Rows are shuffled once, to the task that fits their group; every further setting to be tried is a group of
its own. Within a group, all nodes of a level and all columns are searched at once, on rows kept in
the order of each column: exact splits, no bins.

Squared error or logistic loss, with a ``penalty`` on leaf values. A split needs a weight of ``min_rows`` (for squared
error: rows) on both sides and a gain above ``min_gain``; each round draws rows and columns by ``seed``. Missing and NaN values lie below all
others. The trees of a group are one row: complete binary trees, level by level, round after round.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULTS = {
    "rounds": 200, "depth": 4, "rate": 0.05, "subsample": 1.0, "columns": 1.0, "seed": 42, "min_rows": 1, "min_gain": 0.0,
    "penalty": 1.0, "loss": "squared",
}
#: Values of a level that are searched together: their temporary numbers take about 100 bytes each.
VALUES_AT_ONCE = 1 << 20
TREES = "base double, depth int, feature array<int>, threshold array<double>, value array<double>"


@dataclass
class Trees:
    """``feature`` (-1: leaf), ``threshold`` (up to it: left) and ``value``, a row per round."""

    base: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray


def matrix(table: pa.Table, names: Sequence[str]) -> np.ndarray:
    columns = [pc.fill_null(table.column(c).cast(pa.float64()), np.nan).to_numpy() for c in names]
    x = np.column_stack(columns)
    return np.where(np.isnan(x), -np.inf, x)


def _split_level(x, columns, order, node, slope, curve, first, totals, masses, p):
    """Best split of every node of a level: node, column, threshold, and the sums of its left side.

    ``VALUES_AT_ONCE`` bounds the columns searched together, whatever the number of rows.
    """
    width = first + 1
    owner = np.sort(node[order[0]] - first)
    # The rows of a node are the same in every column, so its place is, too; rows in leaves of earlier levels go last.
    owner = owner[owner >= 0]
    m = len(owner)
    if m < 2:
        return None
    starts = np.searchsorted(owner, np.arange(width))
    held = np.flatnonzero(np.bincount(owner, minlength=width))
    rank = np.full(width, -1)
    rank[held] = np.arange(len(held))
    whole, full = totals[owner], masses[owner]
    with np.errstate(divide="ignore", invalid="ignore"):
        alone = whole**2 / (full + p["penalty"])
    same, place = owner[:-1] == owner[1:], rank[owner]
    least = p["min_rows"] - 1e-9
    top, chosen = np.full(len(held), -np.inf), np.zeros(len(held), np.int64)
    low, high, before, mass_before = (np.zeros(len(held)) for _ in range(4))
    step = max(1, VALUES_AT_ONCE // order.shape[1])
    for begin in range(0, len(columns), step):
        some = slice(begin, begin + step)
        local = node[order[some]] - first
        local[local < 0] = width
        turn = np.argsort(local.astype(np.int16 if width < 1 << 14 else np.int64), axis=1, kind="stable")
        order[some] = np.take_along_axis(order[some], turn, axis=1)
        placed, numbers = order[some, :m], columns[some]

        def left_of(amounts):
            upto = np.cumsum(amounts[placed], axis=1)
            return upto - np.concatenate([np.zeros((len(numbers), 1)), upto], axis=1)[:, starts][:, owner]

        left, mass = left_of(slope), left_of(curve)
        values = x[placed, numbers[:, None]]
        fits = same & (values[:, :-1] < values[:, 1:])
        fits &= (mass[:, :-1] >= least) & ((full - mass)[:, :-1] >= least)
        gain = np.full(left.shape, -np.inf)
        with np.errstate(divide="ignore", invalid="ignore"):
            both = left**2 / (mass + p["penalty"]) + (whole - left) ** 2 / (full - mass + p["penalty"])
            np.copyto(gain[:, :-1], (both - alone)[:, :-1], where=fits)
        best = np.maximum.reduceat(gain, starts[held], axis=1)
        column = best.argmax(axis=0)  # ties: the first column, then the lowest threshold
        most = best[column, np.arange(len(held))]
        at = np.flatnonzero(gain[column[place], np.arange(m)] == most[place])
        _, where = np.unique(owner[at], return_index=True)
        better = most > top
        at, column = at[where][better], column[better]
        top[better], chosen[better] = most[better], numbers[column]
        # A split is never behind the last row; nodes without one are left out below.
        low[better], high[better] = values[column, at], values[column, np.minimum(at + 1, m - 1)]
        before[better], mass_before[better] = left[column, at], mass[column, at]
    good = top > max(p["min_gain"], 1e-12)
    threshold = low[good] / 2 + high[good] / 2  # -inf, where missing values are split off
    return held[good], chosen[good], threshold, before[good], mass_before[good]


def sorted_rows(x: np.ndarray) -> np.ndarray:
    """The rows in the order of each column, in numbers of four bytes."""
    order = np.empty(x.shape[::-1], np.int32)
    for column, line in zip(x.T, order):
        line[:] = np.argsort(column, kind="stable")
    return order


def grow(x, order, slope, curve, keep, columns, p):
    """One tree on the rows ``keep``; its arrays and the leaf of every row."""
    size = (2 << p["depth"]) - 1
    feature, threshold, value = np.full(size, -1, np.int32), np.zeros(size), np.zeros(size)
    node = np.zeros(len(x), np.int64)
    order = order[columns]
    order = order[keep[order]].reshape(len(columns), -1)
    totals, masses = np.array([slope[keep].sum()]), np.array([curve[keep].sum()])
    value[0] = -p["rate"] * totals[0] / max(masses[0] + p["penalty"], 1e-300)
    for level in range(p["depth"]):
        first = (1 << level) - 1
        found = _split_level(x, columns, order, node, slope, curve, first, totals, masses, p)
        if found is None or not len(found[0]):
            break
        nodes, column, cut, left, mass = found
        feature[first + nodes], threshold[first + nodes] = column, cut
        sums, sizes = np.zeros((len(totals), 2)), np.zeros((len(totals), 2))
        sums[nodes] = np.column_stack([left, totals[nodes] - left])
        sizes[nodes] = np.column_stack([mass, masses[nodes] - mass])
        children = 2 * (first + nodes)[:, None] + [1, 2]
        value[children] = -p["rate"] * sums[nodes] / np.maximum(sizes[nodes] + p["penalty"], 1e-300)
        totals, masses = sums.ravel(), sizes.ravel()
        split = feature[node] >= 0
        moved = node[split]
        node[split] = 2 * moved + 1 + (x[split, feature[moved]] > threshold[moved])
    return feature, threshold, value, node


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_trees(x: np.ndarray, y: np.ndarray, params: dict, weight: np.ndarray | None = None) -> Trees:
    """Boosted trees; with ``loss`` "logistic" the sum of leaves is a log odds and ``y`` is 0 or 1."""
    p = {**DEFAULTS, **params}
    n, width = x.shape
    weight = np.ones(n) if weight is None else weight
    odds = p["loss"] == "logistic"
    rng = np.random.default_rng(p["seed"])
    order = sorted_rows(x)
    base = 0.0 if odds else float((y * weight).sum() / weight.sum())
    predicted = np.full(n, base)
    made = []
    for _ in range(p["rounds"]):
        keep = rng.random(n) < p["subsample"]
        chosen = rng.permutation(width)[: max(1, round(p["columns"] * width))]
        if not keep.any():
            continue
        share = logistic(predicted) if odds else predicted
        curve = weight * np.maximum(share * (1 - share), 1e-16) if odds else weight
        *tree, leaf = grow(x, order, weight * (share - y), curve, keep, np.sort(chosen), p)
        predicted += tree[2][leaf]
        made.append(tree)
    shape = (len(made), (2 << p["depth"]) - 1)
    parts = [np.array([t[i] for t in made]).reshape(shape) for i in range(3)]
    return Trees(base, p["depth"], parts[0].astype(np.int32), *parts[1:])


def fit_forest(x: np.ndarray, y: np.ndarray, asked: np.ndarray, params: dict, weight: np.ndarray) -> np.ndarray:
    """Mean of the leaves of trees on resampled rows, for the rows ``asked``; the trees are not kept.

    Every tree draws its rows with repetition and ``columns`` of the columns.
    """
    p = {**DEFAULTS, **params, "penalty": 0.0, "rate": 1.0}
    n, width = x.shape
    rng = np.random.default_rng(p["seed"])
    order = sorted_rows(x)
    total = np.zeros(len(asked))
    for _ in range(p["trees"]):
        drawn = np.bincount(rng.integers(0, n, n), minlength=n) * weight
        chosen = rng.permutation(width)[: max(1, round(p["columns"] * width))]
        *tree, _ = grow(x, order, -y * drawn, drawn, drawn > 0, np.sort(chosen), p)
        total += predict_trees(Trees(0.0, p["depth"], *(part[None] for part in tree)), asked)
    return total / p["trees"]


def predict_trees(trees: Trees, x: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """Sum of the leaves, for blocks of rows of bounded size."""
    out = np.full(len(x), trees.base)
    rounds = np.arange(len(trees.feature))[:, None]
    step = max(1, block // max(1, len(rounds)))
    for start in range(0, len(x), step):
        rows = x[start : start + step]
        node = np.zeros((len(rounds), len(rows)), np.int64)
        for _ in range(trees.depth):
            feature = trees.feature[rounds, node]
            right = rows[np.arange(len(rows)), feature] > trees.threshold[rounds, node]
            node = np.where(feature >= 0, 2 * node + 1 + right, node)
        out[start : start + step] += trees.value[rounds, node].sum(axis=0)
    return out


def _one_row(trees: Trees, known: dict[str, pa.Scalar]) -> pa.Table:
    lists = [trees.feature.ravel(), trees.threshold.ravel(), trees.value.ravel()]
    columns = {k: pa.array([v.as_py()], v.type) for k, v in known.items()}
    return pa.table({
        **columns,
        "base": pa.array([trees.base]),
        "depth": pa.array([trees.depth], pa.int32()),
        **{k: pa.array([v], pa.list_(pa.from_numpy_dtype(v.dtype))) for k, v in zip(("feature", "threshold", "value"), lists)},
    })


def _usable(table: pa.Table, target: str, order: str) -> pa.Table:
    """Rows with a target, in a fixed order, so that draws do not depend on how rows were dealt."""
    known = table.filter(pc.is_finite(pc.fill_null(table.column(target).cast(pa.float64()), np.nan)))
    return known.sort_by(order)


def fit_groups(
    rows: DataFrame, key: str, features: Sequence[str], target: str, order: str, settings: Sequence[dict],
    trial: str | None = None,
) -> DataFrame:
    """``key`` and ``TREES``, a row per group with a known target.

    ``trial`` names the column with the number of the setting of each group; without it the first holds for all.
    """
    names, kind = list(features), rows.schema[key].dataType.simpleString()
    keys = [key] if trial is None else [key, trial]

    def fit(values: tuple, table: pa.Table) -> pa.Table:
        known = _usable(table, target, order)
        if not known.num_rows:
            return _none(table, key)
        params = settings[0 if trial is None else values[1].as_py()]
        y = known.column(target).cast(pa.float64()).to_numpy()
        return _one_row(fit_trees(matrix(known, names), y, params), {key: values[0]})

    return rows.select(*dict.fromkeys([*keys, *names, target, order])).groupBy(*keys).applyInArrow(
        fit, f"{key} {kind}, {TREES}"
    )


def _none(table: pa.Table, key: str) -> pa.Table:
    fields = [("base", pa.float64()), ("depth", pa.int32()), ("feature", pa.list_(pa.int32())),
              ("threshold", pa.list_(pa.float64())), ("value", pa.list_(pa.float64()))]
    return pa.table({key: table.column(key).slice(0, 0), **{k: pa.nulls(0, t) for k, t in fields}})


def predict_groups(rows: DataFrame, trees: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """All rows with ``prediction``; NULL where the group has no trees."""
    names = list(features)

    def predict(table: pa.Table, model: pa.Table) -> pa.Table:
        if not model.num_rows or not table.num_rows:
            return table.append_column("prediction", pa.nulls(table.num_rows, pa.float64()))
        depth = model.column("depth")[0].as_py()
        shape = (-1, (2 << depth) - 1)
        parts = [np.asarray(model.column(c).combine_chunks().flatten()).reshape(shape) for c in ("feature", "threshold", "value")]
        known = Trees(model.column("base")[0].as_py(), depth, *parts)
        return table.append_column("prediction", pa.array(predict_trees(known, matrix(table, names))))

    schema = T.StructType([*rows.schema.fields, T.StructField("prediction", T.DoubleType())])
    return rows.groupBy(key).cogroup(trees.groupBy(key)).applyInArrow(predict, schema)


def try_settings(
    rows: DataFrame, key: str, features: Sequence[str], target: str, order: str, settings: Sequence[dict], test: str,
) -> DataFrame:
    """``key, trial, order, target, prediction`` of the rows where ``test`` is true, for every setting.

    Each setting is fitted on the other rows of the group. The trees are not kept.
    """
    names, kinds = list(features), dict(rows.dtypes)

    def run(values: tuple, table: pa.Table) -> pa.Table:
        asked = table.filter(table.column(test))
        train = _usable(table.filter(pc.invert(table.column(test))), target, order)
        predicted = pa.nulls(asked.num_rows, pa.float64())
        if train.num_rows and asked.num_rows:
            y = train.column(target).cast(pa.float64()).to_numpy()
            trees = fit_trees(matrix(train, names), y, settings[values[1].as_py()])
            predicted = pa.array(predict_trees(trees, matrix(asked, names)))
        return asked.select([key, "trial", order, target]).append_column("prediction", predicted)

    trial = F.explode(F.array(*[F.lit(i) for i in range(len(settings))]))
    return (
        rows.select(*dict.fromkeys([key, *names, target, order, test]))
        .withColumn("trial", trial)
        .groupBy(key, "trial")
        .applyInArrow(
            run, f"{key} {kinds[key]}, trial int, {order} {kinds[order]}, {target} {kinds[target]}, prediction double"
        )
    )
