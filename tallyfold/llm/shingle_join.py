"""N-gram Jaccard join by PartEnum signatures: all documents whose word shingles overlap enough.

A document's set holds its distinct five-word shingles (64-bit hashes; a shorter text is one shingle). Two sets
link when intersection / union >= 80 / 100, tested in whole numbers. Results are connected components.

1. Classes. Documents with equal sets are one class from here on, so copies cost nothing; a class is
   named by 64 bits of a digest of its set.
2. PartEnum. Sizes fall into bands whose ends differ by the threshold, so linked sets lie in one band or in
   neighbours, and differ in at most k = 2/9 of the band's end elements. The feature domain is cut into
   more than k parts at random; two linked sets agree on at least one part whole. As there are spare parts, a set
   that has more than k parts with two elements or more signs only those: one of them agrees, and the other
   set signs it as well, for what is signed depends on the part alone. Otherwise a set signs its parts with one
   element too, and if these are still too few, its empty parts. The enumeration of subsets is at its
   cheapest setting, where a signature covers one part. Sets sign for their own band and the next one.
3. Buckets. Signatures are range-free sorted and streamed: a bucket of up to ``SMALL`` classes is a list of candidates.
   Classes of larger buckets (a passage that many short documents share fills whole parts) are joined
   exactly in another way: they are bucketed by their rarest shingles, as many as a linked set must share one of.
4. Links. In every bucket, the first class is compared with the others; components follow from the links found;
   only buckets that still hold several components are compared further, with 16 times as many classes at
   their front, until none is left. Before sets are compared, an upper bound of their intersection from
   256 counters sorts out most pairs. So a group of thousands of near copies takes about one comparison
   each, no pair is skipped unless its ends are linked already, and none is capped.

Null and empty texts, and texts without words, have no shingles and are linked with nothing: their component is their
own id. Rows with equal ids are separate documents. A component whose ids are all null has a null id.
Tables without rows give none; other columns are not read (``keep_one`` carries them along).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import documents, free_name, row_slices, whole_text
from tallyfold.operators.ordering import running_totals
from tallyfold.scratch import drop, free_shuffles, materialise

WORDS = 5
#: Similarity as a fraction of whole numbers.
PART, WHOLE = 80, 100
SPARE = 0.25
SMALL = 16
COUNTERS = 256
#: Classes remembered by a task so that copies are signed once; it starts anew beyond.
SEEN = 100_000
#: Ids of candidate classes are broadcast up to here (16 bytes each), and joined by shuffle beyond.
MAX_BROADCAST = 500_000
_SEEDS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _SEEDS[1]
    x = (x ^ (x >> np.uint64(27))) * _SEEDS[2]
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes. ``bytes.lower`` and ``bytes.split`` know ASCII only, as wanted."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out = _mixed(out + hashes[i : len(words) - width + 1 + i])
    return np.unique(out)


def bands(largest: int) -> list[int]:
    """Upper ends of the size bands up to ``largest``, and two more."""
    ends = [0]
    while len(ends) < 3 or ends[-3] < largest:
        ends.append((ends[-1] + 1) * WHOLE // PART)
    return ends[1:]


def parts_of(end: int) -> tuple[int, int]:
    """Largest difference of linked sets up to size ``end``, and the number of parts."""
    apart = 2 * end * (WHOLE - PART) // (WHOLE + PART)
    return apart, apart + 1 + int(np.ceil(SPARE * (apart + 1)))


def signatures(members: np.ndarray, ends: list[int]) -> np.ndarray:
    """Signatures of one set for its own band and the next."""
    size = len(members)
    band = int(np.searchsorted(ends, size))
    found = []
    low, high = members & np.uint64(0xFFFFFFFF), members >> np.uint64(32)
    for at in (band, band + 1):
        apart, parts = parts_of(ends[at])
        if apart == 0:  # only equal sets link, and they are one class
            continue
        seed = np.uint64((at + 1) * int(_SEEDS[0]) & (1 << 64) - 1)
        where = (_mixed(members + seed) % np.uint64(parts)).astype(np.int64)
        held = np.bincount(where, minlength=parts)
        # Sums of 32-bit halves are exact in doubles and do not depend on order.
        sums = np.bincount(where, low, parts).astype(np.uint64) + (
            np.bincount(where, high, parts).astype(np.uint64) << np.uint64(32)
        )
        tag = np.arange(parts, dtype=np.uint64) + np.uint64(at << 32)
        signed = _mixed(_mixed(sums) + _mixed(tag + _SEEDS[0]))
        # The most this set and a linked one of the band can differ in.
        differ = (size + min(ends[at], size * WHOLE // PART)) * (WHOLE - PART) // (WHOLE + PART)
        least = next((n for n in (2, 1) if (held >= n).sum() > differ), 0)
        found.append(signed[held >= least])
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, hash of text, text) to their class and, for the first of a class, its signatures."""
    seen: set[bytes] = set()
    ends = bands(1 << 12)
    for batch in batches:
        for rows in row_slices(batch):
            sizes, names, signed = [], [], []
            for text in rows.column(2).to_pylist():
                members = shingles(text)
                sizes.append(len(members))
                name = hashlib.blake2b(members.tobytes(), digest_size=8).digest()
                names.append(int.from_bytes(name, "little", signed=True))
                if not len(members) or name in seen:
                    signed.append(np.empty(0, np.uint64))
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                if len(members) > ends[-3]:
                    ends = bands(2 * len(members))
                signed.append(signatures(members, ends))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in signed])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(signed).view(np.int64)))
            yield pa.record_batch(
                [rows.column(0), rows.column(1), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), lists],
                names=["doc_id", "_hash", "n_shingles", "_class", "_signatures"],
            )


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, class) to the members of buckets of two or more; ``large`` marks those beyond SMALL.

    Only the last bucket of a batch is carried over, as SMALL + 1 classes at most: once a bucket is large, its
    members pass through.
    """
    carried = np.empty((2, 0), np.int64)
    passing: tuple[int, int] | None = None  # key of a large bucket that goes on, and its last class

    def out(keys, classes, large) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array(keys), pa.array(classes), pa.array(np.full(len(keys), large))], names=["_key", "_class", "_large"]
        )

    def closed(table: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not table.shape[1]:
            return
        first = np.flatnonzero(np.concatenate([[True], table[0, 1:] != table[0, :-1]]))
        sizes = np.diff(np.append(first, table.shape[1]))
        size = np.repeat(sizes, sizes)
        for large, chosen in ((False, (size > 1) & (size <= SMALL)), (True, size > SMALL)):
            if chosen.any():
                yield out(table[0, chosen], table[1, chosen], large)

    for batch in batches:
        table = np.vstack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        table = np.hstack([carried, table])
        new = np.ones(table.shape[1], bool)
        new[1:] = (table[:, 1:] != table[:, :-1]).any(0)  # a class signs once per task
        table = table[:, new]
        if not table.shape[1]:
            continue
        if passing is not None:
            on = (table[0] == passing[0]) & (table[1] != passing[1])
            mine = table[0] == passing[0]
            if on.any():
                yield out(table[0, on], table[1, on], True)
                passing = (passing[0], int(table[1, mine][-1]))
            table = table[:, ~mine]
            if not table.shape[1]:
                carried = table
                continue
            passing = None
        last = table[0] == table[0, -1]
        carried, table = table[:, last], table[:, ~last]
        yield from closed(table)
        if carried.shape[1] > SMALL:
            yield out(carried[0], carried[1], True)
            passing, carried = (int(carried[0, -1]), int(carried[1, -1])), carried[:, :0]
    yield from closed(carried)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (class, text) to the set and its counters."""
    for batch in batches:
        for rows in row_slices(batch):
            members = [shingles(t) for t in rows.column(1).to_pylist()]
            counters = [
                np.minimum(np.bincount((m % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS), 65535)
                .astype(np.uint16).tobytes()
                for m in members
            ]
            offsets = np.concatenate([[0], np.cumsum([len(m) for m in members])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(members).view(np.int64)))
            yield pa.record_batch(
                [rows.column(0), pa.array([len(m) for m in members], pa.int64()), lists, pa.array(counters, pa.binary())],
                names=["_class", "_n", "_set", "_counters"],
            )


def _linked(both, sizes):
    """100 * intersection >= 80 * union."""
    return WHOLE * both >= PART * (sizes - both)


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, sizes, counters of a, of b) whose counters allow a link."""
    for batch in batches:
        if not batch.num_rows:
            continue
        counts = [
            np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, COUNTERS) for i in (3, 4)
        ]
        saturated = (counts[0] == 65535).any(1) | (counts[1] == 65535).any(1)
        bound = np.minimum(*counts).sum(1, dtype=np.int64)
        kept = pa.array(_linked(bound, batch.column(2).to_numpy()) | saturated)
        yield pa.record_batch([batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["_a", "_b"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, set of a, set of b) that link."""
    for batch in batches:
        sets = [(c.flatten().to_numpy(), c.offsets.to_numpy()) for c in (batch.column(2), batch.column(3))]
        kept = []
        for i in range(batch.num_rows):
            x, y = (values[at[i] - at[0] : at[i + 1] - at[0]] for values, at in sets)
            merged = np.sort(np.concatenate([x, y]), kind="stable")
            both = int((merged[1:] == merged[:-1]).sum())
            kept.append(bool(_linked(both, len(x) + len(y))))
        kept = pa.array(kept, pa.bool_())
        yield pa.record_batch([batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["_a", "_b"])


def components(links: DataFrame) -> DataFrame:
    """``_class, _root``: the smallest class reachable, by alternating large and small stars."""
    edges = materialise(links.select("_a", "_b").distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select("_b", "_a"))
        low = both.groupBy("_a").agg(F.least(F.col("_a"), F.min("_b")).alias("_m"))
        # Every larger neighbour points to the smallest.
        large = materialise(
            both.join(low, "_a").where("_b > _a").select(F.col("_b").alias("_x"), F.col("_m").alias("_y"))
            .where("_x <> _y").distinct(), "large",
        )
        small = large.groupBy("_x").agg(F.min("_y").alias("_m"))
        joined = large.join(small, "_x")
        stars = joined.select(F.col("_x").alias("_b"), F.col("_m").alias("_a")).union(
            joined.where("_y <> _m").select(F.col("_y").alias("_b"), F.col("_m").alias("_a"))
        )
        new = materialise(stars.select("_a", "_b").distinct(), "edges")
        drop(large)
        drop(edges)
        edges = new
        # Order-free checksum of the edges.
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("_a", "_b").cast("decimal(38,0)"))).collect()[0]
        if state == tuple(row):
            break
        state = tuple(row)
    roots = edges.groupBy(F.col("_b").alias("_class")).agg(F.min("_a").alias("_root"))
    return materialise(roots.union(edges.select("_a", F.col("_a").alias("_root")).distinct()), "roots")


def classes_of(docs: DataFrame) -> DataFrame:
    """``doc_id, _hash, n_shingles, _class, _signatures``, one row per document."""
    text = whole_text(F.col("text"))
    rows = docs.select("doc_id", F.xxhash64(text).alias("_hash"), text.alias("text"))
    schema = "doc_id bigint, _hash bigint, n_shingles bigint, _class bigint, _signatures array<bigint>"
    return materialise(rows.mapInArrow(_signed, schema), "signed")


def _place() -> F.Column:
    """Orders documents by id, null last."""
    return F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("id"), F.col("_hash").alias("h"))


def candidate_buckets(signed: DataFrame) -> DataFrame:
    """``_key, _class, _large`` for all buckets with two classes or more."""
    rows = signed.select(F.explode("_signatures").alias("_key"), "_class")
    ordered = rows.repartition("_key").sortWithinPartitions("_key", "_class")
    return materialise(ordered.mapInArrow(_bucketed, "_key bigint, _class bigint, _large boolean"), "buckets")


def sets_of(docs: DataFrame, signed: DataFrame, wanted: DataFrame) -> DataFrame:
    """``_class, _n, _set, _counters`` of the wanted classes, from the text of their first document."""
    first = signed.join(wanted, "_class", "left_semi").groupBy("_class").agg(F.min(_place()).alias("_p"))
    first = materialise(first.select("_class", F.col("_p.id").alias("_id"), F.col("_p.h").alias("_h")), "firsts")
    # The count is checked: a row is three numbers.
    if first.count() <= MAX_BROADCAST:
        first = F.broadcast(first)
    text = whole_text(F.col("text"))
    found = docs.select("doc_id", F.xxhash64(text).alias("_hash"), text.alias("text")).join(
        first, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h"))
    )
    schema = "_class bigint, _n bigint, _set array<bigint>, _counters binary"
    made = materialise(found.select("_class", "text").mapInArrow(_sets, schema), "sets")
    copies = made.groupBy("_class").agg(F.count("*").alias("_c")).where("_c > 1").limit(1).count()
    # A row that stands twice in the input yields its set twice.
    return materialise(made.dropDuplicates(["_class"]), "sets") if copies else made


def rare_buckets(sets: DataFrame, large: DataFrame) -> DataFrame:
    """``_key, _class, _pos``: the classes of large buckets by their rarest shingles, with their place by rarity."""
    rows = sets.join(large, "_class", "left_semi").select("_class", "_n", F.explode("_set").alias("_key"))
    rows = materialise(rows, "members")
    often = rows.groupBy("_key").agg(F.count("*").alias("_often"))
    # Linked sets share one of their n - ceil(0.8 n) + 1 rarest shingles. A window holds one set.
    ranked = rows.join(often, "_key").withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_class").orderBy("_often", "_key"))
    )
    needed = F.col("_n") - F.ceil(F.col("_n") * PART / WHOLE) + 1
    chosen = ranked.where((F.col("_rank") <= needed) & (F.col("_often") > 1))
    return chosen.select("_key", "_class", F.col("_rank").cast("bigint").alias("_pos"))


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (_a, _b) that link."""

    def with_both(rows: DataFrame, column: str) -> DataFrame:
        for side in ("_a", "_b"):
            one = sets.select(F.col("_class").alias(side), F.col("_n").alias(f"_n{side}"), F.col(column).alias(f"_v{side}"))
            rows = rows.join(one, side)
        return rows

    counted = with_both(pairs, "_counters").select("_a", "_b", (F.col("_n_a") + F.col("_n_b")).alias("_n"), "_v_a", "_v_b")
    likely = materialise(counted.mapInArrow(_possible, "_a bigint, _b bigint"), "likely")
    compared = with_both(likely, "_set").select("_a", "_b", "_v_a", "_v_b")
    return materialise(compared.mapInArrow(_compared, "_a bigint, _b bigint"), "links")


def links_of(buckets: DataFrame, sets: DataFrame) -> DataFrame | None:
    """``_class, _root`` for all classes with a link; None if there is none.

    ``buckets``: ``_key, _class, _pos``. Where a bucket's key is the first shingle two sets have in common, they share at
    most what follows it in both, itself included; fewer than a link needs, and the pair is left out.
    The sets with least before their key come first, as they are most like the others.
    """
    sized = buckets.distinct().join(sets.select("_class", "_n"), "_class").withColumn("_one", F.lit(1).cast("bigint"))
    ranked = materialise(
        running_totals(sized, ["_pos", "_class"], ["_one"], ["_key"]).select(
            "_key", "_class", "_n", "_pos", F.col("_one_upto").alias("_rank"), F.col("_one_total").alias("_size")
        ),
        "ranked",
    )
    done, front, roots = 0, 1, None
    while True:
        open_rows = ranked.where(F.col("_size") > done + 1)
        if roots is not None:
            open_rows = open_rows.join(roots, "_class", "left").withColumn("_root", F.coalesce("_root", "_class"))
            mixed = open_rows.groupBy("_key").agg(F.min("_root").alias("_lo"), F.max("_root").alias("_hi"))
            open_rows = open_rows.join(mixed.where("_lo <> _hi").select("_key"), "_key", "left_semi")
        else:
            open_rows = open_rows.withColumn("_root", F.col("_class"))
        open_rows = materialise(open_rows, "open")
        if open_rows.limit(1).count() == 0:
            return roots
        heads = open_rows.where((F.col("_rank") > done) & (F.col("_rank") <= front)).select(
            "_key", F.col("_class").alias("_a"), F.col("_n").alias("_na"), F.col("_pos").alias("_pa"),
            F.col("_rank").alias("_ra"), F.col("_root").alias("_xa"),
        )
        shared = F.least(F.col("_n") - F.col("_pos"), F.col("_na") - F.col("_pa")) + 1
        near = (
            (PART * F.greatest("_n", "_na") <= WHOLE * F.least("_n", "_na"))
            & _linked(shared, F.col("_n") + F.col("_na"))
        )
        pairs = (
            open_rows.join(heads, "_key")
            .where((F.col("_rank") > F.col("_ra")) & (F.col("_root") != F.col("_xa")) & near)
            .select("_a", F.col("_class").alias("_b")).distinct()
        )
        pairs = materialise(pairs, "pairs")
        found = verify(pairs, sets) if pairs.limit(1).count() else pairs
        if found.limit(1).count():
            # Components so far enter as one link per class, so the graph does not grow with the rounds.
            known = found if roots is None else found.union(roots.where("_class <> _root").select("_root", "_class"))
            roots = components(known)
        done, front = front, front * SMALL


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` and ``_hash``, ``_first`` (whether a document leads its component)."""
    whole = classes_of(docs)
    signed = materialise(whole.drop("_signatures"), "classes")
    buckets = candidate_buckets(whole)
    drop(whole)
    free_shuffles(docs.sparkSession)  # the signatures, the largest shuffle of all
    wanted = buckets.select("_class").distinct()
    sets = sets_of(docs, signed, wanted)
    rare = materialise(rare_buckets(sets, buckets.where("_large").select("_class").distinct()), "rare")
    free_shuffles(docs.sparkSession)
    small = buckets.where("NOT _large").select("_key", "_class", F.lit(1).cast("bigint").alias("_pos"))
    roots = links_of(small.union(rare), sets)
    for table in (buckets, rare, sets):
        drop(table)

    rows = signed.select("doc_id", "_hash", "n_shingles", "_class")
    heads = materialise(
        rows.where("n_shingles > 0").groupBy("_class").agg(F.min(_place()).alias("_head")), "heads"
    )
    if roots is not None:
        joined = heads.join(roots, "_class", "left").withColumn("_root", F.coalesce("_root", "_class"))
        joined = materialise(joined, "rooted")
        tops = joined.groupBy("_root").agg(F.min("_head").alias("_top"))
        heads = joined.join(tops, "_root").select("_class", F.col("_top").alias("_head"))
    out = rows.join(heads, "_class", "left")
    alone = F.col("n_shingles") == 0
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_head.id")).alias("component_id"),
        "_hash",
        (alone | (F.col("_head") == _place())).alias("_first"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The first document of each component, and all without shingles; the columns of ``docs``.

    Of rows with equal id and text one stays, whichever their other columns.
    """
    key_id, key_hash, repeats = (free_name(docs, x) for x in ("_id", "_h", "_repeats"))
    firsts = near_duplicates(docs).where("_first").groupBy("doc_id", "_hash").agg(F.count("*"))
    firsts = materialise(firsts.toDF(key_id, key_hash, repeats), "firsts")
    same = F.col("doc_id").eqNullSafe(F.col(key_id)) & (F.xxhash64(whole_text(F.col("text"))) == F.col(key_hash))
    kept = docs.join(firsts, same)
    # Without repeated rows the texts need no second shuffle.
    if firsts.where(F.col(repeats) > 1).limit(1).count():
        kept = kept.dropDuplicates([key_id, key_hash])
    return kept.select(*docs.columns)


def op9_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")
