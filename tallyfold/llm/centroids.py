"""Exact centroid clustering over blocks with zone maps.

Vectors become rows of whole numbers. They are laid out along a Hilbert curve through the ``AXES`` directions
in which the starting centroids differ most, and cut into blocks of ``BLOCK`` neighbours. A block is one
stored row: packed vectors, ids, and the least and greatest value of every component (its box). In each round a block
first finds its candidate centroids from the box alone: with ``a`` the centroid nearest to the middle of
the box, ``b`` goes if even the least value of ``|v - b|^2 - |v - a|^2`` over the box is above 0. That
difference is linear in ``v``, so its least value lies in a corner and is exact in whole numbers; bounding each distance by
itself would be looser. The rest are compared exactly for all vectors of the block at once (ties: smaller number).
The curve only decides how few candidates are left, never the result.

Rows are dealt by range of the curve position, then id, then row number, so equal vectors spread over tasks. A round sends
one sum and count per task, centroid and component; the driver holds the centroids, as many numbers
as parameters. The blocks are stored once, in the shared folder, and read in every round.

Kept are vectors of ``DIMENSIONS`` components, none null or non-finite; others have no row in the result. Whole
numbers beyond ``LIMIT`` (x beyond 2 million) count as that, so that no distance leaves the range of a long; an inertia that does
reads as the greatest long. A null id is hashed as an empty one, ``1:``. Repeated rows count each; as
starting centroids, too (ties of the hash: by vector). With fewer vectors than centroids all of them start; an empty table gives
no row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.scratch import materialise

DIMENSIONS, SCALE = 64, 64
CENTROIDS, ROUNDS, SEED = 16, 3, 1
LIMIT = 1 << 27
BLOCK = 256
#: Directions and bits of the curve; their product fits a long.
AXES, BITS = 8, 7
#: Products of vectors and centroids up to this magnitude are exact in doubles: 64 * 2^22 * 2^22 < 2^53.
EXACT = 1 << 22


def whole_numbers(vectors: pa.ListArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that hold ``size`` finite components, and those as whole numbers."""
    fits = np.asarray(vectors.value_lengths().fill_null(-1)) == size
    rows = np.flatnonzero(fits)
    flat = vectors.take(pa.array(rows)).flatten().cast(pa.float64())
    values = np.asarray(flat.fill_null(np.nan)).reshape(len(rows), size)
    finite = np.isfinite(values).all(axis=1)
    scaled = np.clip(np.floor(values[finite] * SCALE), -LIMIT, LIMIT)
    return rows[finite], scaled.astype(np.int32)


def hilbert_position(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of points with ``bits`` bits per axis (Skilling's transform)."""
    x = cells.T.astype(np.int64).copy()
    axes = len(x)
    for step in range(bits - 1, 0, -1):
        low = (1 << step) - 1
        for i in range(axes):
            set_ = (x[i] >> step) & 1 == 1
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    for step in range(bits - 1, 0, -1):
        flips ^= np.where((x[-1] >> step) & 1 == 1, (1 << step) - 1, 0)
    x ^= flips
    position = np.zeros_like(x[0])
    for step in range(bits - 1, -1, -1):
        for i in range(axes):
            position = position << 1 | (x[i] >> step) & 1
    return position


def directions(centroids: np.ndarray) -> np.ndarray:
    """Principal directions of the centroids, as columns."""
    spread = centroids - centroids.mean(axis=0)
    return np.linalg.svd(spread, full_matrices=False)[2][:AXES].T


def place(centroids: np.ndarray, size: int):
    """Batches of (vec_id, embedding) to (vec_id, position, packed vector)."""
    axes = directions(centroids)
    seen = centroids @ axes
    # Three times the range of the centroids, which lie nearer to the middle than most vectors.
    middle, width = (seen.max(axis=0) + seen.min(axis=0)) / 2, np.ptp(seen, axis=0) * 1.5 + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = whole_numbers(batch.column(1), size)
            cells = ((values @ axes - middle) / width + 1) * (1 << BITS - 1)
            positions = hilbert_position(np.clip(cells, 0, (1 << BITS) - 1).astype(np.int64), BITS)
            yield pa.record_batch(
                [batch.column(0).take(pa.array(rows)), pa.array(positions), packed(values)],
                names=["vec_id", "position", "vector"],
            )

    return run


def packed(values: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix of 32-bit numbers."""
    data = np.ascontiguousarray(values, "<i4")
    ends = np.arange(len(data) + 1, dtype=np.int32) * data.shape[1] * 4
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def unpacked(vectors: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(vectors.to_pylist()), "<i4").reshape(-1, size)


def to_blocks(size: int):
    """Batches of (vec_id, vector), in the order of the curve, to blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(start, BLOCK)
                values = unpacked(rows.column(1), size)
                yield pa.record_batch(
                    [
                        pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64())),
                        pa.array([values.astype("<i4").tobytes()], pa.binary()),
                        packed(values.min(axis=0, keepdims=True)),
                        packed(values.max(axis=0, keepdims=True)),
                    ],
                    names=["ids", "vectors", "low", "high"],
                )

    return run


BLOCKS = "ids array<bigint>, vectors binary, low binary, high binary"


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """For each box, which centroids can be nearest to a vector in it."""
    low, high = low.astype(np.int64)[:, None, :], high.astype(np.int64)[:, None, :]
    twice_off = low + high - 2 * centroids[None]
    pivot = (twice_off.astype(np.float64) ** 2).sum(axis=2).argmin(axis=1)
    norms = (centroids**2).sum(axis=1)
    slope = 2 * (centroids[pivot][:, None, :] - centroids[None])
    least = np.where(slope > 0, slope * low, slope * high).sum(axis=2)
    return least + norms[None] - norms[pivot][:, None] <= 0


def nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest centroid (ties: the first) and the squared distance to it."""
    values = values.astype(np.int64)
    if max(np.abs(values).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT:
        cross = (values.astype(np.float64) @ centroids.T.astype(np.float64)).astype(np.int64)
        squares = (values**2).sum(axis=1)[:, None] - 2 * cross + (centroids**2).sum(axis=1)[None]
    else:
        squares = np.stack([((values - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    best = squares.argmin(axis=1)
    return best, squares[np.arange(len(values)), best]


def assign_blocks(batches: Iterator[pa.RecordBatch], centroids: np.ndarray):
    """Per block: ids, vectors, number and squared distance of the nearest centroid."""
    size = centroids.shape[1]
    for batch in batches:
        boxes = [unpacked(batch.column(i), size) for i in (2, 3)]
        open_ = candidates(*boxes, centroids)
        for ids, vectors, left in zip(batch.column(0), batch.column(1), open_, strict=True):
            numbers = np.flatnonzero(left)
            values = np.frombuffer(vectors.as_buffer(), "<i4").reshape(-1, size)
            best, squares = nearest(values, centroids[numbers])
            yield ids.values, values, numbers[best], squares


def sum_clusters(centroids: np.ndarray):
    """Blocks to (cluster, component, n, total) of the task."""
    count, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, totals = np.zeros(count, np.int64), np.zeros((count, size), np.int64)
        for _, values, clusters, _ in assign_blocks(batches, centroids):
            n += np.bincount(clusters, minlength=count)
            np.add.at(totals, clusters, values)
        yield pa.record_batch(
            [
                pa.array(np.repeat(np.arange(count, dtype=np.int32), size)),
                pa.array(np.tile(np.arange(size, dtype=np.int32), count)),
                pa.array(np.repeat(n, size)),
                pa.array(totals.ravel()),
            ],
            names=["cluster", "component", "n", "total"],
        )

    return run


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round."""
    sums = (
        blocks.mapInArrow(sum_clusters(centroids), "cluster int, component int, n bigint, total bigint")
        .groupBy("cluster", "component")
        # A total over all tasks can leave the range of a long before it is divided.
        .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(20,0)")).alias("total"))
    )
    after = centroids.copy()
    for row in sums.collect():  # one row per component of a centroid
        if row["n"]:
            after[row["cluster"], row["component"]] = int(row["total"]) // row["n"]
    return after


def assigned(centroids: np.ndarray):
    """Blocks to (vec_id, cluster, distance)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, clusters, squares in assign_blocks(batches, centroids):
            columns = [ids, pa.array(clusters.astype(np.int32)), pa.array(squares)]
            yield pa.record_batch(columns, names=["vec_id", "cluster", "distance"])

    return run


def starting_centroids(vectors: DataFrame, count: int, size: int, seed: int) -> np.ndarray:
    """The kept vectors whose hashed ids come first."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = whole_numbers(batch.column(1), size)
            numbers = pa.array(list(values), pa.list_(pa.int32()))
            yield pa.record_batch([batch.column(0).take(pa.array(rows)), numbers], names=["vec_id", "numbers"])

    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    kept = vectors.mapInArrow(keep, "vec_id bigint, numbers array<int>").withColumn("key", key)
    first = kept.orderBy("key", "numbers").limit(count).collect()  # top-k: ``count`` rows
    return np.array([r["numbers"] for r in first], np.int64).reshape(-1, size)


def cluster(
    embeddings: DataFrame,
    count: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    size: int = DIMENSIONS,
    name: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` per kept vector."""
    spark = embeddings.sparkSession
    vectors = embeddings.select(F.col("vec_id").cast("bigint"), F.col(name).cast("array<double>").alias("vector"))
    centroids = starting_centroids(vectors, count, size, seed)
    if not len(centroids):
        return spark.createDataFrame([], SCHEMA)
    placed = (
        vectors.mapInArrow(place(centroids, size), "vec_id bigint, position bigint, vector binary")
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange("position", "vec_id", "row")
        .sortWithinPartitions("position", "vec_id", "row")
        .select("vec_id", "vector")
    )
    blocks = materialise(placed.mapInArrow(to_blocks(size), BLOCKS), "blocks")
    for _ in range(rounds):
        centroids = moved(blocks, centroids)
    rows = materialise(blocks.mapInArrow(assigned(centroids), "vec_id bigint, cluster int, distance bigint"), "assigned")

    # One row per centroid: no more than ``count``.
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("sum")).collect()
    greatest = (1 << 63) - 1
    whole = min(sum(int(r["sum"]) for r in sums), greatest)
    known = [
        (r["cluster"], min(int(r["sum"]), greatest), whole,
         hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest())
        for r in sums
    ]
    totals = spark.createDataFrame(known, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(totals), "cluster").select(*[c.split()[0] for c in SCHEMA.split(", ")])


SCHEMA = (
    "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql(rounds: int = ROUNDS) -> str:
    """All pairs of vectors and centroids, round by round."""
    steps = [
        "kept AS MATERIALIZED (SELECT row_number() OVER () AS row_no, vec_id,"
        f" list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings"
        f" WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding,"
        f" lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS})",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS cluster, v AS c FROM"
        f" (SELECT *, sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')) AS h FROM kept ORDER BY h, v LIMIT {CENTROIDS}))",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"a{i} AS MATERIALIZED (SELECT row_no, vec_id, v, min(struct_pack(d := d, k := cluster)) AS best FROM"
            f" (SELECT row_no, vec_id, v, cluster, list_sum(list_transform(list_zip(v, c),"
            f" lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept, c{i}) GROUP BY ALL)"
        )
        if i < rounds:
            steps.append(
                f"m{i} AS (SELECT k, list(m ORDER BY j) AS c FROM (SELECT best.k AS k, j,"
                f" (sum(v[j]) - ((sum(v[j]) % count(*)) + count(*)) % count(*)) // count(*) AS m"
                f" FROM a{i}, range(1, {DIMENSIONS + 1}) r(j) GROUP BY ALL) GROUP BY k)"
            )
            steps.append(
                f"c{i + 1} AS MATERIALIZED (SELECT cluster, list_transform(coalesce(m{i}.c, c{i}.c),"
                f" lambda x: x::BIGINT) AS c FROM c{i} LEFT JOIN m{i} ON k = cluster)"
            )
    return (
        "WITH " + ",\n".join(steps) + f"\nSELECT vec_id, best.k::INTEGER AS cluster, best.d AS distance,"
        " sum(best.d) OVER (PARTITION BY best.k)::BIGINT AS cluster_inertia, sum(best.d) OVER ()::BIGINT AS inertia,"
        f" sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} ON cluster = best.k"
    )


OP12_SQL = _sql()
