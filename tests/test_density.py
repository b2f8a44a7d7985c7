"""DBSCAN and nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from tallyfold.operators import density, segmentation

NORM = ["recency_norm", "frequency_norm", "monetary_norm"]


def brute_dbscan(x, eps, min_points):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    near = d <= eps
    core = near.sum(axis=1) >= min_points
    label = np.full(len(x), -1)
    current = 0
    for i in range(len(x)):
        if not core[i] or label[i] != -1:
            continue
        label[i], todo = current, [i]
        while todo:
            for q in np.flatnonzero(near[todo.pop()] & core):
                if label[q] == -1:
                    label[q] = current
                    todo.append(q)
        current += 1
    reachable = [set(label[near[i] & core]) for i in range(len(x))]
    return core, label, reachable


def crowd(seed):
    """Two crowded places, a thin chain between others, duplicates and scattered points."""
    rng = np.random.default_rng(seed)
    blob = rng.normal([0.2, 0.2, 0.2], 0.01, (150, 3))
    near_blob = rng.normal([0.26, 0.2, 0.2], 0.006, (100, 3))
    twins = np.repeat(rng.random((1, 3)), 40, axis=0)
    chain = np.column_stack([np.linspace(0.5, 0.9, 60), np.full(60, 0.5), np.full(60, 0.5)])
    return np.clip(np.vstack([blob, near_blob, twins, chain, rng.random((80, 3))]), 0, 1)


def as_rows(spark, x):
    return spark.createDataFrame(
        [(f"c{i:04d}", *map(float, p)) for i, p in enumerate(x)], "card string, " + ", ".join(f"{c} double" for c in NORM)
    )


@pytest.mark.parametrize("seed, eps", [(1, 0.02), (2, 0.04)])
def test_dbscan_matches_brute_force(spark, seed, eps):
    x = crowd(seed)
    core, label, reachable = brute_dbscan(x, eps, 5)
    got = {r.card: r.cluster_id for r in density.dbscan_segments(as_rows(spark, x), eps).collect()}
    ours = np.array([got[f"c{i:04d}"] for i in range(len(x))])
    pairs = {(a, b) for a, b in zip(label[core], ours[core])}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    to_ours = dict(pairs)
    for i in np.flatnonzero(~core):
        options = {to_ours[c] for c in reachable[i]}
        assert ours[i] == (min(options) if options else -1)


def test_dbscan_parts_cells_as_near_as_two_numbers_can_be(spark):
    """Cells of neighbouring floating-point numbers, which no halving of the cell itself can part."""
    z = [0.39786264574221025, 0.3978626457422103, 0.39786264574221036]
    x = np.array([[0.9503025064822818, 0.38461538461538464, v] for v in np.repeat(z, [10, 20, 25])])
    core, label, _ = brute_dbscan(x, 8e-17, 5)
    got = density.dbscan_segments(as_rows(spark, x), 8e-17).collect()
    assert core.all() and len(set(label)) == 1
    assert {r.cluster_id for r in got} == {0} and len(got) == len(x)


def test_rounding_is_no_scale_for_eps(spark):
    """Equal rows whose money was added up in another order differ by rounding."""
    distances = spark.createDataFrame([(1e-17 * (i % 3),) for i in range(20)] + [(0.25,)] * 3, "k_distance double")
    assert density.suggested_eps(distances, above=density.LEAST_EPS) == 0.25
    assert density.suggested_eps(distances.where("k_distance < 0.1"), above=density.LEAST_EPS) == density.LEAST_EPS


@pytest.fixture
def small_nodes(monkeypatch):
    for name, value in (("BLOCK_ROWS", 32), ("FAN", 3), ("VISITS_PER_TASK", 50), ("DISTANCES_AT_ONCE", 300)):
        monkeypatch.setattr(density, name, value)


def by_place(rows, column):
    got = {r.card: r[column] for r in rows.collect()}
    return [got[f"c{i:04d}"] for i in range(len(got))]


def all_distances(x):
    return np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))


@pytest.mark.parametrize("stretch, shift", [(250, -40)])
def test_k_distance_matches_brute_force(spark, small_nodes, stretch, shift):
    """Any range of coordinates will do."""
    x = crowd(3) * stretch + shift
    d = np.sort(all_distances(x), axis=1)[:, 4]
    assert np.allclose(by_place(density.k_distance(as_rows(spark, x)), "k_distance"), d, atol=1e-12 * stretch)


@pytest.mark.parametrize("eps", [0.015, 0.6])
def test_neighbour_counts_match_brute_force(spark, small_nodes, eps):
    x = crowd(4)
    want = (((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2) <= eps * eps).sum(axis=1)
    assert by_place(density.eps_neighbour_counts(as_rows(spark, x), eps), "n_neighbours") == want.tolist()


def test_box_tree_of_equal_few_and_no_points(spark, small_nodes):
    equal = np.vstack([np.full((90, 3), 0.5), [[0.1, 0.2, 0.3]]])
    assert by_place(density.eps_neighbour_counts(as_rows(spark, equal), 0.0), "n_neighbours") == [90] * 90 + [1]
    assert by_place(density.k_distance(as_rows(spark, equal)), "k_distance")[:90] == [0.0] * 90
    few = as_rows(spark, equal[:3])
    assert by_place(density.k_distance(few), "k_distance") == [np.inf] * 3
    assert density.k_distance(few.limit(0)).count() == density.eps_neighbour_counts(few.limit(0), 1.0).count() == 0
    gap = as_rows(spark, np.vstack([equal, [[np.inf, 0, 0], [np.nan, 0, 0]]])).union(
        spark.sql("SELECT 'x', NULL, 0.0D, 0.0D")
    )
    assert density.k_distance(gap).count() == density.eps_neighbour_counts(gap, 0.1).count() == 91


def test_leaves_meet_their_neighbours_only(spark, small_nodes, monkeypatch):
    """Along a line, a leaf meets the leaves beside it and not all others."""
    stored = []
    keep = density.materialise

    def counting(df, label="table"):
        out = keep(df, label)
        if label == "pairs":
            stored.append(out.count())
        return out

    monkeypatch.setattr(density, "materialise", counting)
    line = np.repeat(np.linspace(0, 1, 3000)[:, None], 3, axis=1)
    density.k_distance(as_rows(spark, line))
    assert stored[-1] <= 3 * -(-3000 // 32)


def test_squared_silhouette_of_many_clusters(spark):
    """Equal rows as clusters: rows meet few of the clusters, and the measure is that of all pairs."""
    rng = np.random.default_rng(7)
    k, n = 3000, 9000
    own = np.concatenate([np.arange(40), rng.integers(0, k, n - 40)])
    x = rng.random((k, 3))[own] + np.where(own % 3 == 0, 0.05, 0.0)[:, None] * rng.normal(size=(n, 3))
    rows = as_rows(spark, x).toPandas().assign(cluster_id=own)
    squares = np.array([((x - x[own == c].mean(axis=0)) ** 2).sum(axis=1) + x[own == c].var(axis=0).sum() for c in range(k) if (own == c).any()]).T
    names, at, size = np.unique(own, return_inverse=True, return_counts=True)
    a = squares[np.arange(n), at] * size[at] / np.maximum(size[at] - 1, 1)
    squares[np.arange(n), at] = np.inf
    b = squares.min(axis=1)
    want = np.where(size[at] == 1, 0.0, (b - a) / np.maximum(a, b)).mean()
    assert segmentation.silhouette_squared(segmentation.vectors(spark.createDataFrame(rows))) == pytest.approx(want, abs=1e-12)

    met = []
    keep = segmentation._squares
    segmentation._squares = lambda p, q: met.append(len(p) * len(q)) or keep(p, q)
    try:
        means = rng.random((k, 3))
        groups = np.array([np.resize(g, segmentation.LEAF) for g in segmentation._leaves(means, segmentation.LEAF)])
        leaves = {"at": means[groups], "spread": np.zeros(groups.shape), "number": groups, "least": np.zeros(len(groups)),
                  "lo": means[groups].min(axis=1), "hi": means[groups].max(axis=1)}
        copies = np.repeat(np.arange(k), 20)
        segmentation._nearest_other(means[copies], copies, leaves)
    finally:
        segmentation._squares = keep
    assert sum(met) < 0.3 * len(copies) * k


def test_squared_silhouette_of_noise_equal_clusters_and_one_row(spark):
    x = np.array([[0.125, 0.25, 0.5]] * 6 + [[0.75, 0.75, 0.75], [0.5, 0.5, 0.5]])
    rows = as_rows(spark, x).toPandas().assign(cluster_id=[0, 0, 0, 1, 1, 1, 2, -1])
    table = segmentation.vectors(spark.createDataFrame(rows))
    assert segmentation.silhouette_squared(table) == 0.0
    with pytest.raises(ValueError):
        segmentation.silhouette_squared(table.where("cluster_id IN (-1, 2)"))


@pytest.mark.parametrize("eps, part, share", [(0.25, 50_000, 200_000), (0.3, 40, 90), (1.0, 100, 300)])
def test_neighbours_by_columns_match_brute_force(spark, monkeypatch, eps, part, share):
    """Days and counts on a grid, heights with ties at the rim; large tiles are cut."""
    rng = np.random.default_rng(11)
    n = 900
    z = np.where(rng.random(n) < 0.5, rng.integers(0, 41, n) / 40, rng.random(n))
    x = np.column_stack([rng.integers(0, 9, n) / 8, rng.integers(0, 5, n) / 4, z])
    monkeypatch.setattr(density, "PART_ROWS", part)
    monkeypatch.setattr(density, "SHARE_ROWS", share)
    monkeypatch.setattr(density, "box_tree", None)
    want = (((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2) <= eps * eps).sum(axis=1)
    assert by_place(density.eps_neighbour_counts(as_rows(spark, x), eps), "n_neighbours") == want.tolist()


@pytest.fixture
def stored_plans(monkeypatch):
    """Final plans of the tables that density stores, and of what is asked of it."""
    plans, keep = [], density.materialise

    def noting(df, label="table"):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return keep(df, label)

    monkeypatch.setattr(density, "materialise", noting)
    return plans


def test_dbscan_broadcasts_no_table(spark, stored_plans):
    """Files of a few rows would all be broadcast, and each broadcast goes through the driver."""
    out = density.dbscan_segments(as_rows(spark, crowd(5)), 0.03)
    stored_plans.append(("result", out._jdf.queryExecution().executedPlan().toString()))
    joined = {label for label, plan in stored_plans if "SortMergeJoin" in plan}
    assert {"grid", "near-cells", "cores", "boxes", "labels", "result"} <= joined
    assert not [label for label, plan in stored_plans if "BroadcastHashJoin" in plan and "_slice" not in plan]


def test_near_cells_are_all_pairs_two_cells_apart_with_near_boxes(spark):
    r = np.random.default_rng(9)
    x = np.vstack([r.random((250, 3)) * 0.4 - 0.2, r.normal(3.0, 0.01, (60, 3))])
    eps = 0.05
    points, cells = density.grid(density._points(as_rows(spark, x), "card", NORM), eps, 5)
    near = density.near_cells(cells, eps)
    got = [(r.cell, r.ncell) for r in near.collect()]
    place = np.floor(x / density.cell_side(eps)).astype(int)
    names = [":".join(map(str, p)) for p in place]
    touch = all_distances(x) <= eps
    want = {(names[i], names[j]) for i, j in zip(*np.nonzero(touch))}
    assert len(got) == len(set(got)) and want <= set(got)
    boxes = {n: (x[[m == n for m in names]].min(axis=0), x[[m == n for m in names]].max(axis=0)) for n in set(names)}
    for a, b in got:
        gap = np.maximum(np.maximum(boxes[a][0] - boxes[b][1], boxes[b][0] - boxes[a][1]), 0)
        assert (gap**2).sum() <= eps * eps


def test_many_centres_are_not_walked_one_by_one():
    """Thousands of groups of equal rows as clusters took most of the time of a search for eps."""

    class Walked(np.ndarray):
        def __iter__(self):
            raise AssertionError("centre by centre")

    r = np.random.default_rng(10)
    x, centres = r.random((128, 3)), r.random((256, 3))
    few = np.hstack([segmentation._squares(x, centres[i : i + 8]) for i in range(0, 256, 8)])
    assert np.array_equal(segmentation._squares(x, centres.view(Walked)), few)
