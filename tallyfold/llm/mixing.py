"""Mixing sources to target weights by entropy balancing.

Every document ``d`` of source ``s`` gets a rate: how often the mix takes it. Among all rates between 0
and ``MAX_COPIES`` whose words add up to the target of the source, those nearest to equal in
(bounded) entropy are exponential tilts of the size,

    rate = MAX_COPIES * e^(lambda_s * x) / (1 + e^(lambda_s * x)),   x = size / mean size of the source.

The dual is convex with one token constraint per source. Its Newton steps are distributed: one
aggregation per step sums tokens and their derivative by source over the counted cells
(source, size, number of documents), a few numbers per source return to the driver, and a bracket around
each root keeps the step safe. Sums are decimal, so they do not depend on the order of tasks.

Rounding into copies: within a source, cells are laid out by size and the running total of rates is
rounded, which keeps the words taken within about one document of the target; a few single copies
then close the gap. Inside a cell, where all rates agree, the copies left over go to the documents with
the smallest hashed id and text, found by one cut per cell. Only equal rows hash alike; where the cut falls among
them, they are numbered and as many taken as are left.

Targets: sources in code-point order, null last, weigh 5, 2, 1, 5, 2, 1, ... and share 150 % of all
sizes; a target stops at twice the source's size and the excess is reshared by weight.

Columns and SQL expressions only. One source, or one size, may hold a third of all documents: both
are counted before any shuffle, and cuts come from a range-ordered running count. The only thing the
driver sees is one row per source; more than ``MAX_SOURCES`` raise an error.

Null and empty texts have size 0, are taken once and add no words. A null source is a source.
Tables without rows give none. Other columns are carried along.
"""

from __future__ import annotations

import json
import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import WORD, documents, free_name, whole_text
from tallyfold.operators.ordering import running_totals
from tallyfold.scratch import materialise

WEIGHTS = (5, 2, 1)
TOTAL_PERCENT = 150
MAX_COPIES = 2
#: Mixing weights are set by hand or by a table of this size at most; they are kept on the driver.
MAX_SOURCES = 100_000
#: Cells (source, size) to broadcast at most; a cell is six small values.
MAX_CELLS = 500_000
TOLERANCE = 1e-9
MAX_STEPS = 80


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Words wanted of each source: shares by weight, capped, the excess reshared."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(order)}
    left, free, out = TOTAL_PERCENT * sum(sizes.values()) / 100, list(order), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        above = [s for s in free if unit * weight[s] > MAX_COPIES * sizes[s]]
        if not above:
            return out | {s: unit * weight[s] for s in free}
        for s in above:
            out[s] = float(MAX_COPIES * sizes[s])
            left -= out[s]
        free = [s for s in free if s not in out]
    return out


def _frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """One row per source; broadcast, as ``MAX_SOURCES`` bounds it."""
    names = [part.split()[0] for part in schema.split(", ")]
    literal = F.lit(json.dumps([dict(zip(names, row, strict=True)) for row in rows]))
    parsed = F.from_json(literal, f"array<struct<{schema.replace(' ', ': ').replace(',:', ',')}>>")
    return F.broadcast(spark.range(1).select(F.inline(parsed)))


def balance(cells: DataFrame, sizes: dict, docs: dict, wanted: dict) -> dict[str | None, float]:
    """Solve the dual: the tilt of each source, infinite where every document is taken fully."""
    spark = cells.sparkSession
    mean = {s: sizes[s] / docs[s] or 1.0 for s in sizes}
    tilt = {s: math.inf for s in sizes}
    # At tilt 0 every rate is half of MAX_COPIES; brackets widen until they hold the root.
    state = {
        s: {"at": 0.0, "low": -math.inf, "high": math.inf}
        for s in sizes
        if 0 < sizes[s] and wanted[s] < MAX_COPIES * sizes[s] * (1 - 1e-12)
    }
    for _ in range(MAX_STEPS):
        if not state:
            break
        rows = [(s, v["at"], mean[s]) for s, v in state.items()]
        at = _frame(spark, rows, "_source string, _tilt double, _mean double")
        x = F.col("_size") / F.col("_mean")
        rate = MAX_COPIES / (1 + F.exp(-F.col("_tilt") * x))
        words = F.col("_n") * F.col("_size") * rate
        slope = words * x * (1 - rate / MAX_COPIES)
        sums = (
            cells.join(at, F.col("source").eqNullSafe(F.col("_source")))
            .groupBy("source")
            .agg(*[F.sum(v.cast("decimal(38,9)")).alias(k) for k, v in (("words", words), ("slope", slope))])
            .collect()  # one row per source
        )
        for row in sums:
            s, got, slope_at = row["source"], float(row["words"]), float(row["slope"])
            v = state[s]
            if abs(got - wanted[s]) <= TOLERANCE * max(wanted[s], 1.0):
                tilt[s] = state.pop(s)["at"]
                continue
            v["low" if got < wanted[s] else "high"] = v["at"]
            step = v["at"] + (wanted[s] - got) / slope_at if slope_at > 0 else math.nan
            low, high = v["low"], v["high"]
            # Outside the bracket: halve it, or double away from a side that is still open.
            if not low < step < high or abs(step) > 10 * (1 + abs(v["at"])):
                if math.isinf(high):
                    step = 2 * low + 1 if low >= 0 else low / 2 if low < -1e-6 else 1.0
                elif math.isinf(low):
                    step = 2 * high - 1 if high <= 0 else high / 2 if high > 1e-6 else -1.0
                else:
                    step = (low + high) / 2
            v["at"] = step
    for s, v in state.items():
        tilt[s] = v["at"]
    return tilt


def sized(docs: DataFrame, *carried: Column) -> DataFrame:
    """``source``, ``_size`` and ``_key``, which decides within a cell who gets the copies left over."""
    words = F.regexp_count(whole_text(F.col("text")), F.lit(WORD)).cast("bigint")
    key = F.xxhash64(F.lit("mix"), F.col("doc_id"), F.col("text"))
    return docs.select(*carried, "source", words.alias("_size"), key.alias("_key"))


def settle(laid: DataFrame) -> DataFrame:
    """Bring each source's words closer to its target by a few more or fewer copies, then split copies evenly.

    A step looks, in every source, for the size nearest to what is missing (or too much) that has copies
    to give, and moves as many as fit. It stops where no copy improves the sum. Rounding leaves at most about one
    document's words open, so steps are few; each is one aggregation that returns one row per source.
    """
    spark, moved = laid.sparkSession, {}

    def current() -> DataFrame:
        if not moved:
            return laid
        rows = _frame(spark, [(i, z, n) for (i, z), n in moved.items()], "_i int, _z bigint, _more bigint")
        joined = laid.join(rows, (F.col("_id") == F.col("_i")) & (F.col("_size") == F.col("_z")), "left")
        return joined.withColumn("_copies", F.col("_copies") + F.coalesce("_more", F.lit(0))).drop("_i", "_z", "_more")

    while True:
        now = current()
        totals = now.groupBy("_id").agg(
            (F.max("_target") - F.sum(F.col("_copies") * F.col("_size")).cast("double")).alias("_missing")
        )
        missing = [(r["_id"], r["_missing"]) for r in totals.collect()]  # one row per source
        gap = _frame(spark, missing, "_i int, _missing double")
        off = F.abs(F.abs(F.col("_missing")) - F.col("_size"))
        spare = MAX_COPIES * F.col("_n") - F.col("_copies")
        room = F.when(F.col("_missing") > 0, spare).otherwise(F.col("_copies"))
        best = (
            now.join(gap, F.col("_id") == F.col("_i"))
            .where((room > 0) & (off < F.abs(F.col("_missing"))))
            .groupBy("_id")
            .agg(F.min(F.struct(off.alias("off"), F.col("_size").alias("size"), room.alias("room"))).alias("best"))
            .collect()  # one row per source
        )
        if not best:
            break
        gaps = dict(missing)
        for row in best:
            i, size, wide = row["_id"], row["best"]["size"], gaps[row["_id"]]
            copies = max(1, min(row["best"]["room"], int(abs(wide) // size)))
            moved[i, size] = moved.get((i, size), 0) + (copies if wide > 0 else -copies)
    base = F.floor(F.col("_copies") / F.col("_n")).cast("bigint")
    return current().withColumn("_base", base).withColumn(
        "_extra", F.col("_copies") - F.col("_base") * F.col("_n")
    )


def plan(rows: DataFrame) -> DataFrame:
    """From (source, _size, _key): a row per cell with its copies and its cut.

    ``_id, source, _size, _base, _cut, _split, _left, _source_size, _target``: documents of the cell are taken
    ``_base`` times, once more where the key is at most ``_cut``, and so are ``_left`` rows whose key is ``_split``.
    """
    spark = rows.sparkSession
    cells = materialise(rows.groupBy("source", "_size").agg(F.count("*").alias("_n")), "cells")
    per_source = (
        cells.groupBy("source")
        .agg(F.sum(F.col("_n") * F.col("_size")).alias("size"), F.sum("_n").alias("docs"))
        .limit(MAX_SOURCES + 1)
        .collect()
    )
    if len(per_source) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources to mix")
    sizes = {r["source"]: r["size"] for r in per_source}
    docs = {r["source"]: r["docs"] for r in per_source}
    wanted = targets(sizes)
    tilt = balance(cells, sizes, docs, wanted)
    solved = _frame(
        spark,
        # A missing tilt stands for an infinite one.
        [
            (s, i, sizes[s], float(wanted[s]), None if math.isinf(tilt[s]) else tilt[s], sizes[s] / docs[s] or 1.0)
            for i, s in enumerate(sizes)
        ],
        "_source string, _id int, _source_size bigint, _target double, _tilt double, _mean double",
    )

    x = F.col("_size") / F.col("_mean")
    full = F.col("_tilt").isNull()
    rate = F.when(full & (F.col("_size") > 0), F.lit(float(MAX_COPIES))).otherwise(
        MAX_COPIES / (1 + F.exp(-F.coalesce("_tilt", F.lit(0.0)) * x))
    )
    # At most one row per distinct size in each window: sizes are bounded by the longest text.
    upto = Window.partitionBy("_id").orderBy("_size").rowsBetween(Window.unboundedPreceding, 0)
    share = (F.col("_n") * rate).cast("decimal(30,9)")
    laid = (
        cells.join(solved, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_share", share)
        .withColumn("_end", F.sum("_share").over(upto))
    )
    half = F.lit(Decimal("0.5"))
    copies = F.floor(F.col("_end") + half) - F.floor(F.col("_end") - F.col("_share") + half)
    laid = laid.select(
        "_id", "source", "_size", "_n", "_source_size", "_target", copies.cast("bigint").alias("_copies")
    )
    laid = materialise(settle(materialise(laid, "laid")), "settled")

    # Equal keys are counted first, so repeated rows are one row here.
    open_cells = laid.where("_extra > 0").select(
        F.col("_id"), F.col("source").alias("_of"), F.col("_size").alias("_cell"), "_extra"
    )
    counted = rows.groupBy("source", "_size", "_key").agg(F.count("*").alias("_one"))
    ranked = running_totals(
        counted.join(
            open_cells, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_size") == F.col("_cell"))
        ).select("_id", "_size", "_key", "_one", "_extra"),
        ["_key"], ["_one"], ["_id", "_size"],
    )
    left = F.col("_extra") - F.col("_one_upto") + F.col("_one")
    divided = (left > 0) & (left < F.col("_one"))
    cuts = (
        ranked.where(left > 0)
        .groupBy(F.col("_id").alias("_i"), F.col("_size").alias("_s"))
        .agg(
            F.max(F.when(~divided, F.col("_key"))).alias("_cut"),
            F.max(F.when(divided, F.col("_key"))).alias("_split"),
            F.max(F.when(divided, left)).alias("_left"),
        )
    )
    return materialise(
        laid.join(cuts, (F.col("_id") == F.col("_i")) & (F.col("_size") == F.col("_s")), "left").select(
            "_id", "source", "_size", "_base", "_cut", "_split", "_left", "_source_size", "_target"
        ),
        "mix",
    )


def copies_of(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Add ``_copies``, ``_source_size`` and ``_target`` to rows with source, ``_size`` and ``_key``.

    The cells are broadcast up to a checked number, so texts need no shuffle, and joined by it beyond.
    """
    cell = cells.withColumnsRenamed({"source": "_of", "_size": "_cell"})
    counts = cells.agg(F.count("*").alias("all"), F.count("_left").alias("divided")).first()
    cell = F.broadcast(cell) if counts["all"] <= MAX_CELLS else cell.hint("merge")
    joined = rows.join(cell, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_size") == F.col("_cell")))

    def taken(rows: DataFrame, once_more: Column) -> DataFrame:
        more = F.when(once_more, F.lit(1)).otherwise(F.lit(0))
        added = [(F.col("_base") + more).alias("_copies"), F.col("_source_size"), F.col("_target")]
        return rows.select(*kept, *added)

    kept = rows.columns
    below = F.col("_key") <= F.col("_cut")
    if not counts["divided"]:
        return taken(joined, below)
    among = F.coalesce(F.col("_key") == F.col("_split"), F.lit(False))
    # Equal rows, of which some are taken once more: numbered in slices, however many they are.
    numbered = running_totals(
        joined.where(among).select(
            "*", F.monotonically_increasing_id().alias("_row"), F.lit(1).cast("bigint").alias("_one")
        ),
        ["_row"], ["_one"], ["_id", "_size"],
    )
    return taken(joined.where(~among), below).unionByName(taken(numbered, F.col("_one_upto") <= F.col("_left")))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents, each row as often as the mix takes it; the columns of ``docs``."""
    cells = plan(materialise(sized(docs), "sizes"))
    whole = free_name(docs, "_whole")
    taken = copies_of(sized(docs, F.struct("*").alias(whole)), cells).where("_copies > 0")
    repeated = taken.select(whole, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy"))
    return repeated.select(f"{whole}.*")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = materialise(sized(documents(spark, sf_dir), F.col("doc_id")), "sizes")
    out = copies_of(narrow, plan(narrow))
    return out.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
        F.col("_copies").cast("int").alias("copies"),
    )
