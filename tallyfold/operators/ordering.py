"""Global orders, running totals and exact quantiles without a one-task sort.

A window with no partition columns runs in a single task. The operators here lay
rows out by range instead, so that each slice is sorted on its own task and only
one total per slice is combined. Rows are laid out on the full sort key, so a
value shared by a third of all rows still spreads over many slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.numeric import without_nan
from tallyfold.scratch import materialise


#: Groups whose intervals are broadcast; beyond, values are counted and laid out by range.
MAX_GROUPS = 10_000
#: Values of an interval that are ordered in one task, and buckets of a pass over a larger one.
MAX_SLICE, BUCKETS = 100_000, 4096


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    sums: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Add ``<c>_upto`` (inclusive) and ``<c>_total`` for every column in ``sums``.

    ``by`` and ``order`` together must identify a row. Columns are sorted
    ascending; pass a negated column for the other direction.
    """
    keys = list(by)
    # Adaptive execution may merge neighbouring slices, which keeps their order. The
    # slice number is stored with the rows, so both readers below agree on it.
    placed = materialise(
        df.repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id()),
        "ordered",
    )

    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy(*keys)
    # At most (number of slices + number of groups) rows reach these windows.
    offsets = (
        placed.groupBy(*keys, "_slice")
        .agg(*[F.sum(c).alias(f"_{c}_slice") for c in sums])
        .select(
            *keys,
            "_slice",
            *[F.coalesce(F.sum(f"_{c}_slice").over(before), F.lit(0)).alias(f"_{c}_before") for c in sums],
            *[F.sum(f"_{c}_slice").over(whole).alias(f"{c}_total") for c in sums],
        )
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = placed.select("*", *[F.sum(c).over(inside).alias(f"_{c}_in") for c in sums])
    if not keys:
        # One row per slice: bounded by the number of shuffle partitions.
        offsets = F.broadcast(offsets)
    joined = local.join(offsets, [*keys, "_slice"])
    return joined.select(
        *df.columns,
        *[(F.col(f"_{c}_in") + F.col(f"_{c}_before")).alias(f"{c}_upto") for c in sums],
        *[F.col(f"{c}_total") for c in sums],
    )


def global_rank(
    df: DataFrame, order: Sequence[str], by: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """Unique rank 1..n (per group) over a total order."""
    ranked = running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), order, ["_one"], by)
    return ranked.withColumnRenamed("_one_upto", name).drop("_one", "_one_total")


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact linear-interpolation quantiles: ``by..., n, quantiles array<double>``.

    Selection by refinement: a pass counts the values of every bucket of the intervals that hold a wanted
    rank, within tasks before the shuffle, and the bucket of each rank is the next interval. So rows are never
    shuffled, and neither a hot value nor a hot group is held by one task. NULL and NaN values and NULL
    groups are left out; without groups there is one row, of NULLs where no value is left.
    """
    keys = list(by) or ["_all"]
    rows = df if by else df.withColumn("_all", F.lit(0))
    rows = rows.select(*keys, without_nan(F.col(value).cast("double")).alias("_v"))
    for c in [*keys, "_v"]:
        rows = rows.where(F.col(c).isNotNull())
    rows = materialise(rows, "values")
    groups = materialise(
        rows.groupBy(*keys).agg(F.count("*").alias("_total"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")),
        "groups",
    )
    place = [f"((_total - 1) * {float(p)!r}D)" for p in probs]
    ranks = ", ".join(f"CAST({end}{x} AS bigint)" for x in place for end in ("floor", "ceil"))
    wanted = groups.withColumn("_want", F.explode(F.expr(f"array_distinct(array({ranks}))")))
    if groups.count() <= MAX_GROUPS:
        found = _refined(rows, wanted, keys)
    else:
        counted = rows.groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
        ordered = running_totals(counted, ["_v"], ["_n"], keys)
        found = ordered.join(wanted.drop("_lo", "_hi"), keys).where(
            (F.col("_want") >= F.col("_n_upto") - F.col("_n")) & (F.col("_want") < F.col("_n_upto"))
        ).withColumnRenamed("_v", "_lo")

    # Position of each quantile among the sorted rows; ``t`` is its part between two of them.
    def value_at(position: str) -> str:
        return f"max(IF(_want = CAST({position} AS bigint), _lo, NULL))"

    quantiles = F.expr("transform(lo, (v, i) -> IF(t[i] = 0, v, v + (hi[i] - v) * t[i]))")
    return found.groupBy(*by).agg(
        F.max("_total").alias("n"),
        F.expr(f"array({', '.join(value_at(f'floor{x}') for x in place)})").alias("lo"),
        F.expr(f"array({', '.join(value_at(f'ceil{x}') for x in place)})").alias("hi"),
        F.expr(f"array({', '.join(f'max({x} - floor{x})' for x in place)})").alias("t"),
    ).select(*by, "n", quantiles.alias("quantiles"))


def _refined(rows: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``wanted`` with the value of rank ``_want`` as ``_lo``; at most two intervals per quantile and group are open."""
    # ``_rank`` counts within the interval from ``_lo`` to ``_hi``, which holds ``_n`` values.
    state = materialise(
        wanted.select(*keys, "_total", "_want", F.col("_want").alias("_rank"), "_lo", "_hi", F.col("_total").alias("_n")),
        "ranks",
    )
    span = [*keys, "_lo", "_hi"]
    while True:
        open_ = state.where("_lo < _hi")
        largest = open_.agg(F.max("_n")).first()[0]
        if largest is None:
            return state
        spans = open_.select(*span).distinct().groupBy(*keys).agg(F.collect_list(F.struct("_lo", "_hi")).alias("_spans"))
        holds = F.filter("_spans", lambda s: (F.col("_v") >= s["_lo"]) & (F.col("_v") <= s["_hi"]))
        # One row per group, of which there are at most ``MAX_GROUPS``.
        inside = rows.join(F.broadcast(spans), list(keys)).select(*keys, "_v", F.get(holds, F.lit(0)).alias("_s"))
        inside = inside.where("_s IS NOT NULL").select(*keys, "_v", "_s._lo", "_s._hi")
        if largest <= MAX_SLICE:
            cells = inside.groupBy(*span, F.col("_v").alias("_from")).agg(F.count("*").alias("_in"))
            cells = cells.withColumn("_to", F.col("_from"))
        else:
            # Halves, so that the width is finite; an infinite end leaves the finite values in one bucket.
            part = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
            middle = F.floor(F.nanvl(part, F.lit(0.0)) * BUCKETS)
            bucket = F.when(F.col("_v") == F.col("_lo"), -1).when(F.col("_v") == F.col("_hi"), BUCKETS + 1).otherwise(middle)
            cells = inside.groupBy(*span, bucket.alias("_bucket")).agg(
                F.count("*").alias("_in"), F.min("_v").alias("_from"), F.max("_v").alias("_to")
            ).drop("_bucket")
        # At most ``BUCKETS`` cells, or ``MAX_SLICE`` values, reach a window.
        upto = F.sum("_in").over(Window.partitionBy(*span).orderBy("_from"))
        moved = open_.join(cells.withColumn("_upto", upto), span).where(
            (F.col("_rank") >= F.col("_upto") - F.col("_in")) & (F.col("_rank") < F.col("_upto"))
        )
        moved = moved.select(
            *keys, "_total", "_want", (F.col("_rank") - F.col("_upto") + F.col("_in")).alias("_rank"),
            F.col("_from").alias("_lo"), F.col("_to").alias("_hi"), F.col("_in").alias("_n"),
        )
        state = materialise(state.where("_lo >= _hi").unionByName(moved), "ranks")


def exact_median(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``by..., median``."""
    out = exact_quantiles(df, value, [0.5], by)
    return out.select(*by, F.col("quantiles")[0].alias("median"))


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (),
              names: str = "feature", values: str = "value") -> DataFrame:
    """One row per (row, column), values as double."""
    typed = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot(list(keep), list(columns), names, values)
