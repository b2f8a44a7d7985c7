"""Customer clusters by K-Means, their quality measures and names."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.operators.customers import RFM_NORM
from tallyfold.operators.profiles import segment_profile
from tallyfold.scratch import materialise

K_RANGE = range(2, 9)
MIN_K = 3
RESTARTS = 10
SEED = 42
NOISE = -1
MAX_NOISE_SHARE = 0.5
#: Rows of a block of the exact silhouette, and the distances computed at once.
PAIR_ROWS, TILE = 32_768, (64, 512)
#: Blocks up to which large tables get more rows a block, and rows a block at most.
ENOUGH_BLOCKS, MOST_PAIR_ROWS = 44, 262_144
MOST_TASKS = 1000
#: Squared silhouette: clusters of a leaf, leaves visited at once, rows that visit together, and rows a task holds.
LEAF, VISITS, CHUNK, ROWS_AT_ONCE = 32, 8, 128, 200_000
#: Centres up to which squares are computed centre by centre.
FEW_CENTRES = 32

# Names from the most recent cluster to the least recent one, and the
# order the training pipeline gives by falling frequency.
NAME_LADDER = ["Champions", "Loyal", "Potential", "At Risk", "Lost", "Inactive"]
FREQUENCY_NAMES = ["At Risk", "Loyal", "Champions", "New", "Lost"]


@dataclass(frozen=True)
class Clustering:
    """Centres of a K-Means solution, the labelled rows and the within-cluster sum of squares."""

    centres: list[list[float]]
    rows: DataFrame
    inertia: float


def vectors(rows: DataFrame, features: Sequence[str] = RFM_NORM) -> DataFrame:
    """Stored rows with their feature vector; reused by every pass over them."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return materialise(assembler.transform(rows), "vectors")


@dataclass
class Run:
    """One K-Means start on its way: ``k`` centres wanted, those found so far, and its last cost."""

    k: int
    number: int
    centres: np.ndarray
    cost: float = math.inf
    moving: bool = True


def _points(rows: DataFrame, features: Sequence[str], key: str) -> DataFrame:
    """A draw per row and its features; rows without all of them take no part."""
    own = [key] if key in rows.columns else list(features)
    known = [F.col(f).cast("double").alias(f) for f in features]
    table = rows.select(F.xxhash64(*own).alias("_draw"), *known)
    for f in features:
        table = table.where(F.col(f).isNotNull() & ~F.isnan(f))
    return table


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """Rows by features; every feature lies in one stretch of memory."""
    return np.array([batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, batch.num_columns)]).T


def _uniform(draw: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1) that only depend on the row's draw and the salt."""
    x = draw.view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53 + 2.0**-54


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Rows by centres; the rows of a centre lie in one stretch of memory. Many centres beside few rows are taken at once."""
    out = np.zeros((len(centres), len(x)))
    if len(centres) > FEW_CENTRES:
        for d in range(x.shape[1]):
            off = x[:, d] - centres[:, d, None]
            off *= off
            out += off
        return out.T
    for line, centre in zip(out, centres):
        for d, c in enumerate(centre):
            off = x[:, d] - c
            off *= off
            line += off
    return out.T


def _nearest(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest centre of each row and the square to it."""
    near, least = np.zeros(len(squares), dtype=np.intp), squares[:, 0].copy()
    for i in range(1, squares.shape[1]):
        near[squares[:, i] < least] = i
        np.minimum(least, squares[:, i], out=least)
    return near, least


def _add_centres(points: DataFrame, runs: list[Run], features: Sequence[str], seed: int) -> None:
    """One more centre for each run that lacks one, drawn by squared distance from those it has.

    The row with the least exponential variate of its weight wins, which any number of tasks can
    decide apart: one candidate per task and run.
    """
    open_ = [(i, r.centres) for i, r in enumerate(runs) if len(r.centres) < r.k]
    salts = {i: (seed * 1_000_003 + runs[i].number) * 1_009 + len(runs[i].centres) for i, _ in open_}

    def race(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple] = {}
        for batch in batches:
            x, draw = _matrix(batch), batch.column(0).to_numpy()
            if not len(x):
                continue
            for i, centres in open_:
                weight = _nearest(_squares(x, centres))[1] if len(centres) else np.ones(len(x))
                with np.errstate(divide="ignore"):
                    time = np.where(weight > 0, -np.log(_uniform(draw, salts[i])) / weight, np.inf)
                first = np.flatnonzero(time == time.min())
                at = int(first[np.lexsort(x[first].T)[0]])
                best[i] = min(best.get(i, (np.inf, ())), (float(time[at]), tuple(x[at].tolist())))
        found = [(i, *pair) for i, pair in best.items() if pair[0] < np.inf]
        yield pa.record_batch(
            [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.float64()),
             pa.array([f[2] for f in found], pa.list_(pa.float64()))], names=["run", "time", "centre"]
        )

    first = points.mapInArrow(race, "run int, time double, centre array<double>").groupBy("run").agg(
        F.min_by("centre", F.struct("time", "centre")).alias("centre")
    )
    found = {r["run"]: r["centre"] for r in first.collect()}  # one row per run
    for i, centres in open_:
        # With fewer distinct rows than centres the first one is repeated and stays empty.
        more = found.get(i) or (centres[0] if len(centres) else np.zeros(len(features)))
        runs[i].centres = np.vstack([centres.reshape(-1, len(features)), more])


def _totals(points: DataFrame, centres: dict[int, np.ndarray], terms) -> dict[int, np.ndarray]:
    """Sums over the rows of every cluster of every solution, in one pass over the rows.

    ``terms(number, x, near, least)`` gives the columns to add up for a batch, from the nearest centre of each row and
    the square to it. Tasks send one row per cluster.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            x = _matrix(batch)
            for i, c in centres.items():
                near, least = _nearest(_squares(x, c))
                columns = terms(i, x, near, least)
                added = np.column_stack([np.bincount(near, v, minlength=len(c)) for v in columns])
                totals[i] = totals.get(i, 0.0) + added
        flat = [(i, c, row.tolist()) for i, t in totals.items() for c, row in enumerate(t)]
        yield pa.record_batch(
            [pa.array([f[0] for f in flat], pa.int32()), pa.array([f[1] for f in flat], pa.int32()),
             pa.array([f[2] for f in flat], pa.list_(pa.float64()))], names=["run", "cluster", "sums"]
        )

    empty = np.empty((0, len(points.columns) - 1))
    width = max(len(terms(i, empty, empty[:, 0].astype(int), empty[:, 0])) for i in centres)
    table = points.mapInArrow(sums, "run int, cluster int, sums array<double>").groupBy("run", "cluster")
    added = F.array(*[F.sum(F.get("sums", F.lit(d))) for d in range(width)])
    out = {i: np.zeros((len(c), width)) for i, c in centres.items()}
    for row in table.agg(added.alias("sums")).collect():  # one row per centre
        out[row["run"]][row["cluster"]] = row["sums"]
    return out


def _lloyd_step(points: DataFrame, runs: list[Run], tol: float) -> None:
    """Move the centres of all runs that still move, in one pass over the rows."""
    open_ = {i: r.centres for i, r in enumerate(runs) if r.moving}

    def terms(i, x, near, least):
        return [*x.T, np.ones(len(x)), least]

    for i, sums in _totals(points, open_, terms).items():
        run, n = runs[i], sums[:, -2:-1]
        moved = np.where(n > 0, sums[:, :-2] / np.maximum(n, 1), run.centres)
        run.cost = float(sums[:, -1].sum())
        # The cost belongs to the centres before the step, so a run that stands still keeps those.
        run.moving = bool(np.abs(moved - run.centres).max() > tol)
        if run.moving:
            run.centres = moved


def kmeans_runs(rows: DataFrame, ks: Sequence[int], seed: int = SEED, restarts: int = RESTARTS,
                features: Sequence[str] = RFM_NORM, key: str = "card", tol: float = 1e-4,
                max_steps: int = 300) -> dict[int, Run]:
    """The best of ``restarts`` starts for every k; all starts of all k share each pass over the rows."""
    points = _points(rows, features, key)
    runs = [Run(k, i, np.empty((0, len(features)))) for k in ks for i in range(restarts)]
    for _ in range(max(ks)):
        _add_centres(points, runs, features, seed)
    for _ in range(max_steps):
        _lloyd_step(points, runs, tol)
        if not any(r.moving for r in runs):
            break
    return {k: min((r for r in runs if r.k == k), key=lambda r: (r.cost, r.number)) for k in ks}


def place_rows(rows: DataFrame, centres: np.ndarray, features: Sequence[str] = RFM_NORM) -> DataFrame:
    """Rows with ``cluster_id``, the nearest centre (ties: the first); NULL where a feature is missing."""
    reach = F.array(*[
        sum((F.pow(F.col(f) - F.lit(float(v)), F.lit(2.0)) for f, v in zip(features, c)), F.lit(0.0)) for c in centres
    ])
    nearest = F.array_position(reach, F.array_min(reach)) - 1
    known = ~F.isnan(F.array_min(reach))  # NULL where one is missing, NaN where one is NaN
    return rows.withColumn("cluster_id", F.when(known, nearest).cast("int"))


def kmeans_segments(rows: DataFrame, k: int, seed: int = SEED, restarts: int = RESTARTS,
                    features: Sequence[str] = RFM_NORM) -> Clustering:
    """Best of several seeded starts; ``rows`` should be stored (see ``vectors``)."""
    best = kmeans_runs(rows, [k], seed, restarts, features)[k]
    return Clustering(best.centres.tolist(), place_rows(rows, best.centres, features), best.cost)


def centroid_table(clustering: Clustering, features: Sequence[str] = RFM_NORM) -> DataFrame:
    """``cluster_id`` and one column per feature; k rows."""
    rows = [(i, *map(float, c)) for i, c in enumerate(clustering.centres)]
    schema = "cluster_id int, " + ", ".join(f"{f} double" for f in features)
    return SparkSession.active().createDataFrame(rows, schema)


def centroid_backtransform(centroids: DataFrame, rfm: DataFrame) -> DataFrame:
    """Centroids in days, purchases and money; recency was scaled upside down."""
    span = rfm.agg(
        F.struct(
            *[F.min(c).alias(f"{c}_lo") for c in ("recency_days", "frequency", "monetary")],
            *[F.max(c).alias(f"{c}_hi") for c in ("recency_days", "frequency", "monetary")],
        )
    ).scalar()

    def back(c: str, norm: str) -> Column:
        width = span[f"{c}_hi"] - span[f"{c}_lo"]
        if c == "recency_days":
            return span[f"{c}_hi"] - F.col(norm) * width
        return span[f"{c}_lo"] + F.col(norm) * width

    return centroids.select(
        "cluster_id",
        back("recency_days", "recency_norm").alias("recency_days"),
        back("frequency", "frequency_norm").alias("frequency"),
        back("monetary", "monetary_norm").alias("monetary"),
    )


# -- quality -----------------------------------------------------------------------


def _clustered(rows: DataFrame, cluster: str) -> DataFrame:
    """Rows without noise; at least two clusters are required."""
    clean = rows.where(F.col(cluster).isNotNull() & (F.col(cluster) != NOISE))
    if clean.select(cluster).distinct().limit(2).count() < 2:
        raise ValueError("cluster quality needs at least two clusters")
    return clean


def _distance_sums(x: np.ndarray, y: np.ndarray, parts_x: dict, parts_y: dict) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the distances from each x to the clusters of y, and from each y to those of x.

    ``parts_x`` and ``parts_y``: cluster to its stretch of the rows. Tiles are small enough for a core's cache.
    """
    high, wide = TILE
    d, more = np.empty(TILE), np.empty(TILE)
    from_x, from_y = np.zeros((len(x), len(parts_y))), np.zeros((len(y), len(parts_x)))
    x, y = np.ascontiguousarray(x.T)[:, :, None], np.ascontiguousarray(y.T)[:, None, :]
    for p, (x_from, x_to) in enumerate(parts_x.values()):
        for q, (y_from, y_to) in enumerate(parts_y.values()):
            for i in range(x_from, x_to, high):
                rows = slice(i, min(i + high, x_to))
                for j in range(y_from, y_to, wide):
                    columns = slice(j, min(j + wide, y_to))
                    size = rows.stop - i, columns.stop - j
                    total, term = d[: size[0], : size[1]], more[: size[0], : size[1]]
                    np.subtract(x[0, rows], y[0, :, columns], out=total)
                    np.multiply(total, total, out=total)
                    for a, b in zip(x[1:], y[1:]):
                        np.subtract(a[rows], b[:, columns], out=term)
                        np.multiply(term, term, out=term)
                        np.add(total, term, out=total)
                    np.sqrt(total, out=total)
                    from_x[rows, q] += total.sum(axis=1)
                    from_y[columns, p] += total.sum(axis=0)
    return from_x, from_y


def pair_blocks(n: int, block_rows: int = PAIR_ROWS) -> int:
    """Blocks of the exact silhouette. A row is copied to, and sends its sums from, every block, so they should be few."""
    return max(1, math.ceil(n / max(block_rows, min(math.ceil(n / ENOUGH_BLOCKS), MOST_PAIR_ROWS))))


def silhouette_rows(rows: DataFrame, cluster: str = "cluster_id", key: str = "card",
                    features: Sequence[str] = RFM_NORM, block_rows: int = PAIR_ROWS) -> DataFrame:
    """``key, silhouette`` with Euclidean distances, exact.

    The mean distance to every cluster has no shortcut, so the work is quadratic. Rows
    are cut into blocks by a hash of the key; a task sees one pair of blocks, computes each distance once for both
    its ends, and returns one row of distance sums per point, never pairs of points.
    """
    names = list(features)
    points = materialise(
        _clustered(rows, cluster).select(F.col(key).alias("id"), F.col(cluster).alias("c"), *names),
        "points",
    )
    # One row per cluster.
    sizes = {r["c"]: r["n"] for r in points.groupBy("c").agg(F.count("*").alias("n")).orderBy("c").collect()}
    place = {c: i for i, c in enumerate(sizes)}
    blocks = pair_blocks(sum(sizes.values()), block_rows)
    mine = F.pmod(F.xxhash64("id"), F.lit(blocks))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>"))
    met = points.select("*", mine.alias("mine"), every.alias("other"))
    paired = met.select("*", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))

    def sums(pair: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("c", kind="stable")

        def side(block) -> tuple[pd.DataFrame, dict]:
            part = pdf[pdf["mine"] == block]
            found = part["c"].to_numpy()
            starts = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.empty(0, int)
            return part, {found[s]: (s, e) for s, e in zip(starts, [*starts[1:], len(found)])}

        def lines(part: pd.DataFrame, totals: np.ndarray, seen: dict) -> pd.DataFrame:
            whole = np.zeros((len(part), len(place)))
            whole[:, [place[c] for c in seen]] = totals
            return pd.DataFrame({"id": part["id"].to_numpy(), "c": part["c"].to_numpy(), "totals": list(whole)})

        (a, in_a), (b, in_b) = side(pair[0]), side(pair[1])
        from_a, from_b = _distance_sums(a[names].to_numpy(float), b[names].to_numpy(float), in_a, in_b)
        if pair[0] == pair[1]:
            return lines(a, from_a, in_b)
        return pd.concat([lines(a, from_a, in_b), lines(b, from_b, in_a)])

    id_type, c_type = dict(points.dtypes)["id"], dict(points.dtypes)["c"]
    # Few bytes, much work: a pair of blocks is not put with others into one task.
    tasks = min(blocks * (blocks + 1) // 2, MOST_TASKS)
    blocked = paired.drop("other").repartition(tasks, "i", "j").groupBy("i", "j").applyInPandas(
        sums, f"id {id_type}, c {c_type}, totals array<double>"
    )
    nothing = F.array_repeat(F.lit(0.0), len(place))
    # One array per block that a point has met.
    per_point = blocked.groupBy("id", "c").agg(F.collect_list("totals").alias("parts")).select(
        "id", "c", (F.size("parts") / blocks).alias("times"),
        F.aggregate("parts", nothing, lambda t, x: F.zip_with(t, x, lambda u, v: u + v)).alias("totals"),
    )
    counts = F.array(*[F.lit(float(n)) for n in sizes.values()])
    own = F.array_position(F.array(*[F.lit(c).cast(c_type) for c in sizes]), F.col("c")).cast("int") - 1
    size = F.get(counts, own) * F.col("times")
    means = F.zip_with("totals", counts, lambda t, n: t / n)
    away = F.transform(means, lambda m, i: F.when(i != own, m / F.col("times")))
    # The point itself is among its own cluster, at distance 0.
    per_point = per_point.select(
        "id", size.alias("size"), (F.get("totals", own) / F.nullif(size - 1, F.lit(0.0))).alias("a"), F.array_min(away).alias("b"),
    ).groupBy("id").agg(F.max("size").alias("size"), F.max("a").alias("a"), F.min("b").alias("b"))
    width = (F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0))
    return per_point.select(
        F.col("id").alias(key),
        F.when(F.col("size") == 1, F.lit(0.0)).otherwise(F.coalesce(width, F.lit(0.0))).alias("silhouette"),
    )


def silhouette_euclid(rows: DataFrame, cluster: str = "cluster_id", key: str = "card",
                      features: Sequence[str] = RFM_NORM) -> DataFrame:
    """One row ``silhouette``: the mean over all clustered rows."""
    return silhouette_rows(rows, cluster, key, features).agg(F.avg("silhouette").alias("silhouette"))


def _leaves(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Rows in groups of at most ``size``, halved along their widest axis."""
    out, open_ = [], [np.arange(len(x))]
    while open_:
        rows = open_.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        part, middle = x[rows], len(rows) // 2
        turn = np.argpartition(part[:, np.ptp(part, axis=0).argmax()], middle)
        open_ += [rows[turn[middle:]], rows[turn[:middle]]]
    return out


def _nearest_other(x: np.ndarray, own: np.ndarray, leaves: dict[str, np.ndarray]) -> np.ndarray:
    """Least mean squared distance from each row to a cluster other than its ``own``.

    ``leaves``: clusters as rows of leaves (``at``, ``spread``, ``number``) and the boxes of the leaves. Rows that lie together visit
    the leaves in the order of their distance, until none can be nearer than what they have found.
    """
    out = np.empty(len(x))
    for rows in _leaves(x, CHUNK):
        here, mine = x[rows], own[rows]
        gap = np.maximum(np.maximum(leaves["lo"] - here.max(axis=0), here.min(axis=0) - leaves["hi"]), 0.0)
        near = (gap**2).sum(axis=1) + leaves["least"]
        turn, best = np.argsort(near), np.full(len(rows), np.inf)
        for start in range(0, len(turn), VISITS):
            # A hair wider than the bound, as both are rounded.
            if near[turn[start]] * (1 - 1e-9) > best.max():
                break
            visit = turn[start : start + VISITS]
            number = leaves["number"][visit].ravel()
            squares = _squares(here, leaves["at"][visit].reshape(len(number), -1)) + leaves["spread"][visit].ravel()
            squares[number == mine[:, None]] = np.inf
            np.minimum(best, squares.min(axis=1), out=best)
        out[rows] = best
    return out


def silhouette_squared(rows: DataFrame, cluster: str = "cluster_id") -> float:
    """Silhouette with squared distances over rows with ``features``; used wherever models are compared.

    The mean squared distance from a row to a cluster is that to its mean plus the cluster's spread, so a pass gives
    these, one row per cluster, and a second one finds for each row the nearest cluster but its own by boxes of
    clusters: no row is compared with all clusters, of which there may be as many as groups of equal rows.
    """
    known = _clustered(rows, cluster).select(F.col(cluster).alias("c"), vector_to_array("features").alias("x"))
    width = known.select(F.size("x")).first()[0]
    names = [f"x{d}" for d in range(width)]
    points = known.select("c", *[F.get("x", F.lit(d)).alias(x) for d, x in enumerate(names)])
    spread = sum((F.var_pop(x) for x in names), F.lit(0.0))
    # One row per cluster.
    found = points.groupBy("c").agg(F.count("*").alias("n"), spread.alias("v"), *[F.avg(x).alias(x) for x in names]).toPandas()
    found = found.sort_values("c", kind="stable")
    ids, n, v, means = found["c"].to_numpy(), found["n"].to_numpy(float), found["v"].to_numpy(), found[names].to_numpy()
    groups = _leaves(np.column_stack([means, np.sqrt(v)]), LEAF)
    full = np.array([np.resize(g, LEAF) for g in groups])  # repeated clusters change no minimum
    shared = rows.sparkSession.sparkContext.broadcast((ids, n, v, means, {
        "at": means[full], "spread": v[full], "number": full, "least": v[full].min(axis=1),
        "lo": means[full].min(axis=1), "hi": means[full].max(axis=1),
    }))

    def widths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, n, v, means, leaves = shared.value
        for table in _gathered(batches, ROWS_AT_ONCE):
            x = np.column_stack([table.column(i + 1).to_numpy() for i in range(width)])
            own = np.searchsorted(ids, table.column(0).to_numpy())
            a = (((x - means[own]) ** 2).sum(axis=1) + v[own]) * n[own] / np.maximum(n[own] - 1, 1)
            b = _nearest_other(x, own, leaves)
            top = np.maximum(a, b)
            value = np.divide(b - a, top, out=np.zeros(len(x)), where=top > 0)
            value[n[own] == 1] = 0.0
            yield pa.record_batch([pa.array([value.sum()]), pa.array([len(x)])], names=["total", "rows"])

    sums = points.mapInArrow(widths, "total double, rows bigint").agg(F.sum("total"), F.sum("rows")).first()
    shared.unpersist()
    return sums[0] / sums[1]


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches put together to about so many rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held)
            held = []
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def davies_bouldin(rows: DataFrame, cluster: str = "cluster_id",
                   features: Sequence[str] = RFM_NORM) -> DataFrame:
    """One row ``davies_bouldin``: mean over clusters of the worst (s_i + s_j) / d(c_i, c_j)."""
    names = list(features)
    clean = _clustered(rows, cluster).select(F.col(cluster).alias("c"), *names)
    centres = materialise(clean.groupBy("c").agg(*[F.avg(f).alias(f"_{f}") for f in names]), "centres")
    off = F.sqrt(sum((F.pow(F.col(f) - F.col(f"_{f}"), F.lit(2.0)) for f in names), F.lit(0.0)))
    spread = clean.join(centres, "c").groupBy("c", *[f"_{f}" for f in names]).agg(F.avg(off).alias("s"))
    spread = materialise(
        spread.select("c", "s", F.array(*[f"_{f}" for f in names]).alias("at")), "spread"
    )
    # One entry per cluster; every ordered pair of clusters is compared.
    others = spread.agg(F.collect_list(F.struct("c", "s", "at"))).scalar()
    pairs = spread.select("c", "s", "at", F.explode(others).alias("o")).where(F.col("o.c") != F.col("c"))
    apart = F.sqrt(
        sum((F.pow(F.col("at")[i] - F.col("o.at")[i], F.lit(2.0)) for i in range(len(names))), F.lit(0.0))
    )
    ratio = (F.col("s") + F.col("o.s")) / F.nullif(apart, F.lit(0.0))
    worst = pairs.groupBy("c").agg(F.coalesce(F.max(ratio), F.lit(0.0)).alias("worst"))
    return worst.agg(F.avg("worst").alias("davies_bouldin"))


def cluster_quality(rows: DataFrame, cluster: str = "cluster_id", key: str = "card",
                    features: Sequence[str] = RFM_NORM) -> DataFrame:
    """One row with both exact measures. Quadratic: a diagnostic, not part of any job or sweep."""
    return silhouette_euclid(rows, cluster, key, features).withColumn(
        "davies_bouldin", davies_bouldin(rows, cluster, features).scalar()
    )


def linear_quality(rows: DataFrame, cluster: str = "cluster_id",
                   features: Sequence[str] = RFM_NORM) -> DataFrame:
    """One row ``davies_bouldin, silhouette_squared`` from linear work; ``rows`` must hold ``features``."""
    return davies_bouldin(rows, cluster, features).withColumn(
        "silhouette_squared", F.lit(float(silhouette_squared(rows, cluster)))
    )


def k_sweep(rows: DataFrame, ks: Sequence[int] = K_RANGE, seed: int = SEED, restarts: int = RESTARTS,
            features: Sequence[str] = RFM_NORM) -> DataFrame:
    """``k, inertia, silhouette_squared, davies_bouldin`` for every k, each measure in one pass for all k."""
    best = kmeans_runs(rows, list(ks), seed, restarts, features)
    return sweep_quality(rows, best, features)


def sweep_quality(rows: DataFrame, best: dict[int, Run], features: Sequence[str] = RFM_NORM,
                  key: str = "card") -> DataFrame:
    """Measures of several solutions of the same rows.

    The mean squared distance from a row to a cluster follows from the cluster's size, mean and mean square, so
    two passes serve all solutions: one for these, one for the silhouettes and the spreads.
    """
    points, solutions = _points(rows, features, key), {k: r.centres for k, r in best.items()}
    sums = _totals(points, solutions, lambda k, x, near, least: [np.ones(len(x)), *x.T, (x**2).sum(axis=1)])
    sizes = {k: t[:, 0] for k, t in sums.items()}
    means = {k: t[:, 1:-1] / np.maximum(t[:, :1], 1) for k, t in sums.items()}
    norms = {k: t[:, -1] / np.maximum(t[:, 0], 1) for k, t in sums.items()}

    def measures(k, x, near, least):
        n, line = sizes[k], np.arange(len(x))
        far = (x**2).sum(axis=1)[:, None] - 2 * x @ means[k].T + norms[k]
        far = np.where(n > 0, np.maximum(far, 0.0), np.inf)
        own = far[line, near] * n[near] / np.maximum(n[near] - 1, 1)
        far[line, near] = np.inf
        other = far.min(axis=1, initial=np.inf)
        top = np.maximum(own, other)
        width = np.divide(other - own, top, out=np.zeros(len(x)), where=(top > 0) & np.isfinite(top))
        return [np.where(n[near] == 1, 0.0, width), np.sqrt(((x - means[k][near]) ** 2).sum(axis=1))]

    lines = []
    for k, found in _totals(points, solutions, measures).items():
        held = np.flatnonzero(sizes[k] > 0)
        spread = found[held, 1] / sizes[k][held]
        apart = np.sqrt(((means[k][held][:, None] - means[k][held][None]) ** 2).sum(axis=2))
        ratio = np.divide(spread[:, None] + spread[None], apart, out=np.zeros_like(apart), where=apart > 0)
        several = len(held) > 1
        lines.append((
            k, float(best[k].cost), float(found[:, 0].sum() / sizes[k].sum()) if several else None,
            float(ratio.max(axis=1).mean()) if several else None,
        ))
    return rows.sparkSession.createDataFrame(
        lines, "k int, inertia double, silhouette_squared double, davies_bouldin double"
    )


def choose_k(sweep: DataFrame, min_k: int = MIN_K) -> DataFrame:
    """One row: the k with the best squared silhouette, from ``min_k`` up if there is one; first on ties."""
    order = F.struct((F.col("k") >= min_k).alias("wanted"), "silhouette_squared", (-F.col("k")).alias("first"))
    return sweep.agg(F.max_by(F.struct("k", "silhouette_squared"), order).alias("best")).select("best.*")


def cluster_champion(kmeans: DataFrame, dbscan: DataFrame) -> DataFrame:
    """One row: DBSCAN wins only with at most half noise and a higher silhouette.

    ``kmeans`` holds ``silhouette``; ``dbscan`` holds ``silhouette, n_noise, n_rows``.
    """
    score = kmeans.select("silhouette").scalar()
    qualified = F.col("silhouette").isNotNull() & (F.col("n_noise") <= MAX_NOISE_SHARE * F.col("n_rows"))
    return dbscan.select(
        score.alias("kmeans_silhouette"),
        F.col("silhouette").alias("dbscan_silhouette"),
        qualified.alias("dbscan_qualified"),
        F.when(qualified & (F.col("silhouette") > score), "dbscan").otherwise("kmeans").alias("champion"),
    )


# -- names ---------------------------------------------------------------------------


def cluster_summary(rows: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Median recency, frequency and spend, and size, per cluster."""
    return segment_profile(rows, cluster, ["recency_days", "frequency", "monetary"])


def _name_at(names: Sequence[str], place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.least(place, F.lit(len(names))))


def name_clusters_ladder(summary: DataFrame) -> DataFrame:
    """``cluster_id, segment_name`` by rising median recency.

    When the second most recent cluster buys most often, the first two names swap.
    """
    whole = Window.partitionBy()
    placed = summary.withColumns(
        {
            # One row per cluster.
            "place": F.row_number().over(whole.orderBy("recency_days", "cluster_id")),
            "busy": F.row_number().over(whole.orderBy(F.col("frequency").desc(), "cluster_id")) == 1,
        }
    )
    swap = F.bool_or((F.col("place") == 2) & F.col("busy")).over(whole)
    place = F.when(swap & F.col("place").isin(1, 2), 3 - F.col("place")).otherwise(F.col("place"))
    return placed.select("cluster_id", _name_at(NAME_LADDER, place).alias("segment_name"))


def name_clusters_freq(centroids: DataFrame, frequency: str = "frequency_norm") -> DataFrame:
    """``cluster_id, segment_name`` by falling centroid frequency.

    Kept for compatibility: this order calls the most frequent buyers "At Risk".
    """
    order = Window.partitionBy().orderBy(F.col(frequency).desc(), "cluster_id")
    place = F.row_number().over(order)
    name = F.element_at(F.array(*[F.lit(n) for n in FREQUENCY_NAMES]), place)
    named = F.when(place <= len(FREQUENCY_NAMES), name).otherwise("Unknown")
    return centroids.select("cluster_id", named.alias("segment_name"))


def customer_segments(rows: DataFrame, names: DataFrame) -> DataFrame:
    """The segment table; ``names`` has one row per cluster."""
    return rows.join(names, "cluster_id").select(
        "card", "cluster_id", "segment_name", "recency_days", "frequency", "monetary"
    )
