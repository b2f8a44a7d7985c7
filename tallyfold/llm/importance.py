"""Target-distribution importance resampling over hashed n-grams.

Words are read from the UTF-8 bytes: one table of 256 bytes lower-cases A-Z and turns every other ASCII
character that is neither a letter nor a digit into a blank, and ``bytes.split`` yields the words (bytes
above 127, so all of a non-ASCII character, belong to words). The checksum of an n-gram goes on from that of its
first n - 1 words (``zlib.crc32`` takes the earlier value as a seed), so each run of words costs one call on its
last word. A ``Counter`` per task sums features by bucket before anything is shuffled.

Two passes over the whole texts: bucket counts of the corpus and of the target, then weights. Between them
the driver holds ``BUCKETS`` gains, whatever the input. A text is read in stretches of ``STRETCH`` bytes cut at
blanks, which carry their last two words on, so a very long text takes no more memory for its words.
Ranks are laid out by range (``ordering.running_totals``); rows of one score and id spread over
slices, too.

Null and empty texts have no feature, weight 0, and are never drawn. A null id is hashed as an empty
one, ``42:``, and loses ties. Repeated rows are documents of their own, each with its own rank. An empty corpus gives
no row; an empty target leaves gains that only depend on the corpus. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm.common import documents, row_slices
from tallyfold.operators.ordering import running_totals
from tallyfold.scratch import materialise

BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
DRAW_PERCENT = 5
SEED = 42
#: Bytes of text whose words are held at once.
STRETCH = 4_000_000

#: Digits and lower-case letters stay, upper-case ones are lowered, other ASCII becomes a blank.
BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def stretches(raw: bytes, size: int = STRETCH) -> Iterator[bytes]:
    """``raw``, translated, in pieces that end at a blank."""
    plain = raw.translate(BYTES)
    start = 0
    while len(plain) - start > size:
        stop = plain.find(b" ", start + size)
        if stop < 0:
            break
        yield plain[start:stop]
        start = stop
    yield plain[start:] if start else plain


def checksums(raw: bytes, size: int = STRETCH) -> Iterator[tuple[int, list[int]]]:
    """Per stretch: its number of words, and the checksums of all runs that end in it."""
    carried: list[bytes] = []
    for piece in stretches(raw, size):
        fresh = piece.split()
        words = carried + fresh
        spaced = [b" " + w for w in words]
        runs = list(map(crc32, words))
        found = runs[len(carried) :]
        for n in range(1, LONGEST):
            runs = list(map(crc32, spaced[n:], runs))
            found += runs[max(len(carried) - n, 0) :]
        carried = words[1 - LONGEST :]
        yield len(fresh), found


def _texts(column: pa.Array) -> Iterator[bytes]:
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (text) to (bucket, n) of the task."""
    counts: Counter[int] = Counter()
    to_bucket = BUCKETS.__rmod__
    for batch in batches:
        for rows in row_slices(batch):
            for raw in _texts(rows.column(0)):
                for _, found in checksums(raw):
                    counts.update(map(to_bucket, found))
    yield pa.record_batch(
        [pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], names=["bucket", "n"]
    )


def bucket_counts(texts: DataFrame) -> list[int]:
    """Features of all rows of ``texts`` in each bucket: BUCKETS numbers, whatever the input."""
    partial = texts.select("text").mapInArrow(count_buckets, "bucket int, n bigint")
    counts = [0] * BUCKETS
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """Thousandths of the log ratio of target to corpus per bucket, both smoothed by one."""
    all_s, all_t = float(sum(corpus) + BUCKETS), float(sum(target) + BUCKETS)
    ratios = ((t + 1.0) * all_s / ((s + 1.0) * all_t) for s, t in zip(corpus, target, strict=True))
    return [math.floor(1000 * math.log(r)) for r in ratios]


def weigh(gain: list[int]):
    """Batches of (doc_id, text) to (doc_id, n_words, n_features, weight)."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_bucket, to_gain = BUCKETS.__rmod__, gain.__getitem__
        for batch in batches:
            for rows in row_slices(batch):
                words, features, weights = [], [], []
                for raw in _texts(rows.column(1)):
                    n, m, weight = 0, 0, 0
                    for fresh, found in checksums(raw):
                        n, m = n + fresh, m + len(found)
                        weight += sum(map(to_gain, map(to_bucket, found)))
                    words.append(n)
                    features.append(m)
                    weights.append(weight)
                made = [pa.array(x, pa.int64()) for x in (words, features, weights)]
                yield pa.record_batch([rows.column(0), *made], schema=schema)

    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variate that only depends on the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.ln(-F.ln((h + 0.5) / 4294967296.0)) * -1000.0)


def resample(docs: DataFrame, target: DataFrame, percent: int = DRAW_PERCENT, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank``: the ``percent`` of the eligible documents that
    come first by weight plus noise have a rank, without replacement."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    schema = "doc_id bigint, n_words bigint, n_features bigint, weight bigint"
    weighed = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(weigh(gain), schema)
    scored = materialise(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    eligible = F.col("n_words") >= MIN_WORDS
    placed = scored.where(eligible).select(
        "*",
        (-F.col("score")).alias("_down"),
        F.col("doc_id").isNull().alias("_unnamed"),
        # Splits rows that share score and id over slices.
        F.monotonically_increasing_id().alias("_row"),
        F.lit(1).cast("bigint").alias("_one"),
    )
    ranked = running_totals(placed, ["_down", "_unnamed", "doc_id", "_row"], ["_one"])
    drawn = F.col("_one_upto") * 100 <= F.col("_one_total") * percent
    return ranked.select(*scored.columns, F.when(drawn, F.col("_one_upto")).alias("rank")).unionByName(
        scored.where(~eligible).withColumn("rank", F.lit(None).cast("bigint"))
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: The checksum is reduced over the bytes of each distinct feature, by the usual table of the reflected polynomial.
OP11_SQL = r"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)::BIGINT[]),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) t(i))
), texts AS (
  SELECT 0 AS side, doc_id, doc_id IS NULL AS unnamed, row_number() OVER () AS row_no, text FROM documents
  UNION ALL SELECT 1, NULL, true, row_number() OVER (), text FROM benchmark
), split AS (
  SELECT * EXCLUDE (text), regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts
), runs AS (
  SELECT side, row_no, unnest(list_transform(range(1, len(words) - n + 2),
      lambda i: array_to_string(words[i:i + n - 1], ' '))) AS feature
  FROM split, range(1, 4) r(n)
), counted AS (
  SELECT side, row_no, feature, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
  SELECT feature, xor(list_reduce(
      list_prepend(4294967295, list_transform(range(octet_length(encode(feature))),
        lambda i: ('0x' || substr(hex(encode(feature)), 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM counted), crc_table
), placed AS (
  SELECT side, row_no, bucket, sum(n) AS n FROM counted JOIN hashed USING (feature) GROUP BY ALL
), sums AS (
  SELECT b.bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t
  FROM range(10000) b(bucket) LEFT JOIN placed USING (bucket) GROUP BY 1
), gain AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain
  FROM sums
), weights AS (
  SELECT row_no, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM placed JOIN gain USING (bucket) WHERE side = 0 GROUP BY 1
), scored AS (
  SELECT doc_id, unnamed, row_no, len(words)::BIGINT AS n_words, coalesce(n_features, 0) AS n_features,
    coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
      + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM split LEFT JOIN weights USING (row_no) WHERE side = 0
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, unnamed, doc_id, row_no) AS place, count(*) OVER () AS eligible
  FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_words, n_features, weight, score, CASE WHEN place * 100 <= eligible * 5 THEN place END AS rank FROM ranked
UNION ALL SELECT doc_id, n_words, n_features, weight, score, NULL FROM scored WHERE n_words < 20
"""
