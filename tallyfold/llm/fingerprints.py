"""Document fingerprints by consistent weighted sampling.

A text is a set of terms (words) with weights (how often each occurs). For each of ``SAMPLES`` hash functions, every
term draws r, c ~ Gamma(2, 1) and b ~ U(0, 1) from its hash alone, quantises its log weight,

    t = floor(ln w / r + b),    ln a = ln c - r * (t - b + 1),

and the term with the smallest a is the sample (term, t). Two texts share a sample with probability
sum of minima / sum of maxima of their weights: their generalised Jaccard similarity. The share of
equal samples estimates it; equal texts have equal fingerprints.

Columns and SQL expressions only. Terms are counted inside a row (sorted hashes, run lengths), and samples are
minima of packed numbers (42 bits of ln a, 24 bits that name the sample), which one hash aggregate keeps
for a document. The only shuffle brings neighbours in doc_id order together: documents are cut into
slices at approximate quantiles of the id, the first document of each slice is copied to the end of the slice
before, and all later steps keep that partitioning.

Neighbours: the next document has the next smaller id (rows with one id by text, null ids last); after the
last comes the first. Null texts count as empty; empty texts have an empty fingerprint, which is like another
empty one (1) and unlike all others (0). Repeated rows are neighbours of each other. A table without rows gives
none; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import documents, once, whole_text, words_of

SAMPLES = 32
#: Slices per shuffle partition; the bounds are a literal of that many numbers.
SLICES = 4


def term_counts(text: Column) -> dict[str, Column]:
    """Steps from a text to ``_terms``: array of (hash of the term, log of its count)."""
    hashes = F.sort_array(F.transform(words_of(text), lambda w: F.xxhash64(w)))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("_hashes") - 1),
        lambda i: (i == 0) | (F.get("_hashes", i) != F.get("_hashes", i - 1)),
    )
    counts = F.transform(
        "_starts",
        lambda s, k: F.struct(
            F.get("_hashes", s).alias("term"),
            F.ln((F.coalesce(F.get("_starts", k + 1), F.size("_hashes")) - s).cast("double")).alias("weight"),
        ),
    )
    return {"_hashes": hashes, "_starts": F.when(F.size("_hashes") > 0, starts), "_terms": counts}


def sample(k: int) -> Column:
    """Sample ``k`` of a term as one number: ordered by ln a, its low 24 bits name (term, t)."""
    uniform = lambda bits: f"((({bits}) & 16777215) + 0.5D) / 16777216"
    one, two = f"xxhash64(term, {2 * k})", f"xxhash64(term, {2 * k + 1})"
    r = f"(-ln(({uniform(one)}) * ({uniform(f'shiftright({one}, 24)')})))"
    c = f"(-ln(({uniform(two)}) * ({uniform(f'shiftright({two}, 24)')})))"
    b = f"((shiftrightunsigned({one}, 48) * 65536 + shiftrightunsigned({two}, 48) + 0.5D) / 4294967296)"
    t = f"floor(weight / {r} + {b})"
    ln_a = f"(ln({c}) - {r} * ({t} - {b} + 1))"
    # ln a lies between -80 and 10.
    return F.expr(f"shiftleft(CAST(({ln_a} + 128) * 1073741824 AS BIGINT), 24) | (({one} ^ ({t} * 40503)) & 16777215)")


def ordered_slices(rows: DataFrame) -> DataFrame | None:
    """Add ``_slice`` and ``_halo`` to rows with ``_order``; None if there are no rows.

    Slice i holds the rows from its bound down to the next bound, which belongs to slice i + 1; rows at a bound
    are copied to the slice before (cyclically) as halo.
    """
    spark = rows.sparkSession
    n = SLICES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = [i / n for i in range(1, n + 1)]
    got = rows.agg(
        F.percentile_approx("_order", F.array(*[F.lit(p) for p in places]), F.lit(max(10_000, 10 * n))).alias("q"),
        F.max("_order").alias("top"),
    ).collect()[0]
    if got["top"] is None:
        return None
    bounds = sorted({*got["q"], got["top"]})
    count = len(bounds)
    strides = [1 << i for i in reversed(range(count.bit_length()))]
    ends = F.array(*[F.lit(b) for b in bounds])
    # Binary search: how many bounds lie below.
    below = F.aggregate(
        F.array(*[F.lit(s) for s in strides]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= count) & (F.get(ends, at + step - 1) < F.col("_order")), at + step
        ).otherwise(at),
    )
    placed = once(rows, {"_below": below}).withColumn("_mine", F.lit(count - 1) - F.col("_below"))
    copies = F.when(
        F.get(ends, F.col("_below")) == F.col("_order"),
        F.array(
            F.struct(F.col("_mine").alias("_slice"), F.lit(0).alias("_halo")),
            F.struct(((F.col("_mine") + (count - 1)) % count).alias("_slice"), F.lit(1).alias("_halo")),
        ),
    ).otherwise(F.array(F.struct(F.col("_mine").alias("_slice"), F.lit(0).alias("_halo"))))
    return placed.select(*rows.columns, F.inline(copies)).repartition("_slice")


def likeness(one: str, two: str) -> Column:
    """Share of equal samples; texts without words have none."""
    equal = F.aggregate(
        F.zip_with(one, two, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda total, e: total + e
    )
    shared = equal / F.lit(float(SAMPLES))
    return F.when(F.col(one).isNull() | F.col(two).isNull(), (F.col(one).isNull() & F.col(two).isNull()).cast("double")).otherwise(shared)


def shown(samples: str) -> Column:
    """Six hexadecimal digits per sample; empty for a text without words."""
    return F.coalesce(F.array_join(F.transform(samples, lambda x: F.lower(F.lpad(F.hex(x), 6, "0"))), ""), F.lit(""))


def sampled(bodies: DataFrame, keys: list[str]) -> DataFrame:
    """Per key (all columns but ``body``): ``_samples``, the low 24 bits of each minimum, null without words."""
    rows = bodies
    for name, column in term_counts(F.col("body")).items():
        rows = once(rows, {name: column})
        if name == "_hashes":
            rows = rows.drop("body")
    terms = rows.select(*keys, F.inline_outer("_terms"))
    minima = terms.groupBy(*keys).agg(
        *[F.min(F.when(F.col("term").isNotNull(), sample(k))).alias(f"_m{k}") for k in range(SAMPLES)]
    )
    low = F.array(*[F.col(f"_m{k}").bitwiseAND(F.lit(16777215)) for k in range(SAMPLES)])
    return minima.select(*keys, F.when(F.col("_m0").isNotNull(), low).alias("_samples"))


def fingerprint(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint``: one row per document, repeated rows included."""
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", whole_text(F.col("text")).alias("body"))
    return sampled(rows, ["_row", "doc_id"]).select("doc_id", shown("_samples").alias("fingerprint"))


def neighbours(docs: DataFrame) -> DataFrame | None:
    """``_slice, _pos, _halo, doc_id, text, n_chars, _next`` (text of the next document), by slice."""
    rows = docs.select("doc_id", whole_text(F.col("text")).alias("text")).withColumn(
        "_order", F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    )
    cut = ordered_slices(rows)
    if cut is None:
        return None
    order = Window.partitionBy("_slice").orderBy("_halo", F.desc("_order"), F.desc(F.col("doc_id").isNotNull()), "text")
    return cut.select(
        "_slice", "_halo", "doc_id", "text",
        F.length("text").cast("bigint").alias("n_chars"),
        F.row_number().over(order).alias("_pos"),
        F.lead("text").over(order).alias("_next"),
    )


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def fingerprint_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text whose last third is taken from the next document."""
    placed = neighbours(docs)
    if placed is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - third).cast("int")), F.substring("_next", F.lit(1), third)
    )
    placed = once(placed, {"_edited": F.when(F.col("_halo") == 0, edited)})
    # Two rows a document; the digest goes with the edited text and names no group of its own.
    bodies = F.array(
        F.struct(F.lit(0).alias("_side"), F.col("text").alias("body"), F.lit(None).cast("string").alias("_sha")),
        F.struct(F.lit(1).alias("_side"), F.col("_edited").alias("body"), F.sha2("_edited", 256).alias("_sha")),
    )
    keys = ["_slice", "_pos", "_halo", "doc_id", "n_chars"]
    rows = placed.select(*keys, F.inline(bodies)).where("_side = 0 OR _halo = 0")
    made = sampled(rows, [*keys, "_side", "_sha"])
    sides = made.groupBy(*keys).agg(
        F.max(F.when(F.col("_side") == 0, F.col("_samples"))).alias("_own"),
        F.max(F.when(F.col("_side") == 1, F.col("_samples"))).alias("_edit"),
        F.max("_sha").alias("edited_sha256"),
    )
    after = sides.withColumn("_then", F.lead("_own").over(Window.partitionBy("_slice").orderBy("_pos")))
    return after.where("_halo = 0").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        shown("_own").alias("fingerprint"),
        shown("_edit").alias("edited_fingerprint"),
        likeness("_own", "_edit").alias("near_edited"),
        likeness("_own", "_then").alias("near_next"),
    )


def op3_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_with_edits(documents(spark, sf_dir))
