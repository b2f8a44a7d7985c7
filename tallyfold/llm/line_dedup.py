"""Line dedup: later copies of repeated runs of lines are deleted.

A document is a sequence of line ids. The suffixes of all sequences are ranked by distributed prefix doubling:
rank 0 orders lines, rank j+1 orders pairs (rank j here, rank j 2^j lines on), so after j rounds equal
ranks mean equal runs of 2^j lines, in one order for the whole corpus: its suffix array, sorted to
2^j lines. A rank that only one place holds is dropped, and with it all longer runs there. Places that agree on
a run of m lines form an interval of the array with a common prefix of m or more; it is named by m and the ranks of
the two blocks of 2^j lines that cover the run. Maximal repeated runs are unions of such runs.

What counts: a run of consecutive lines with ``MIN_WORDS`` words or more that also stands earlier (by doc_id,
then line; in the same document too, even overlapping). Every line of such a run is deleted; the first place
of a run stays. A line lies in such a run exactly if it lies in a shortest one that starts at some line
(the fewest lines with enough words), or in a shortest one that ends at some line: in a longer run, start at
the line itself, end there, or start at the last line from which enough words follow. So the depth that
matters is bounded by ``MIN_WORDS`` lines, and the doubling takes at most six rounds however long documents are.

Lines are compared without blanks at their ends. Lines without a word are no part of a sequence and are never
deleted. Null and empty texts stay as they are. Rows with equal id and text are one document: both stay and
get the same result. Documents with a null id come last, in the order of a hash of their text; so are
different texts with one id. Tables without rows give none; other columns are carried along.

Only lines that occur twice go past the first count. Counts are summed before shuffles, ranks are running totals
over range-ordered distinct values (one line may be a third of all), windows run within one document, and
joins on ranks are equi-joins that adaptive execution splits. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import WORD, documents, free_name, once, whole_text
from tallyfold.operators.ordering import running_totals
from tallyfold.scratch import drop, materialise

MIN_WORDS = 50
DOC = ["_doc", "_hash"]
BLANKS = " \t\n\x0b\x0c\r"


def line_table(docs: DataFrame) -> DataFrame:
    """``_doc, _hash, _i (number among lines with words), _line, _words, _a, _b`` (ids of the line)."""
    text = whole_text(F.col("text"))
    rows = docs.select(F.col("doc_id").alias("_doc"), F.xxhash64(text).alias("_hash"), text.alias("_text"))
    split = F.transform(F.split("_text", "\n"), lambda x, i: F.struct(i.alias("n"), F.btrim(x, F.lit(BLANKS)).alias("t")))
    worded = once(rows, {"_lines": F.filter(split, lambda x: x["t"] != "")})
    placed = worded.select(*DOC, F.posexplode("_lines").alias("_i", "_at"))
    return placed.select(
        *DOC, "_i",
        F.col("_at.n").alias("_line"),
        F.regexp_count("_at.t", F.lit(WORD)).alias("_words"),
        F.xxhash64("_at.t").alias("_a"),
        F.hash("_at.t").alias("_b"),
    )


def _ranked(pairs: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Keys that occur twice or more, with their place in the order of all of them."""
    counted = pairs.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    totals = running_totals(counted, keys, ["_n"])
    return totals.select(*[F.col(k).alias(f"{k}_of") for k in keys], (F.col("_n_upto") - F.col("_n")).alias(name))


def suffix_ranks(lines: DataFrame, rounds: int) -> DataFrame:
    """``_doc, _hash, _i, _line, _words, _r0 .. _r<rounds>``: ranks of the first 2^j lines, null if unique."""
    first = _ranked(lines, ["_a", "_b"], "_r0")
    same = (F.col("_a") == F.col("_a_of")) & (F.col("_b") == F.col("_b_of"))
    kept = lines.join(first, same).select(*DOC, "_i", "_line", "_words", "_r0")
    # Equal rows of the input are one document.
    kept = kept.repartition(*DOC).dropDuplicates([*DOC, "_i"])
    ranks = materialise(kept, "rank0")
    for j in range(rounds):
        here, wide = f"_r{j}", 2**j
        # Lines that occur once are missing, so the line 2^j on is looked up by its number.
        later = Window.partitionBy(*DOC).orderBy("_i").rangeBetween(wide, wide)
        paired = ranks.withColumn("_next", F.max(here).over(later))
        pairs = materialise(paired, f"pairs{j}")
        both = pairs.where(f"{here} IS NOT NULL AND _next IS NOT NULL").select(here, "_next")
        named = _ranked(both, [here, "_next"], f"_r{j + 1}")
        equal = (F.col(here) == F.col(f"{here}_of")) & (F.col("_next") == F.col("_next_of"))
        longer = materialise(pairs.join(named, equal, "left").drop(f"{here}_of", "_next", "_next_of"), f"rank{j + 1}")
        drop(ranks)
        drop(pairs)
        ranks = longer
    return ranks


def shortest_runs(ranks: DataFrame, min_words: int) -> DataFrame:
    """``_doc, _hash, _i, _m``: runs with enough words that are shortest for their first or their last line."""
    # Stretches of consecutive repeated lines; runs do not leave them.
    by_doc = Window.partitionBy(*DOC).orderBy("_i")
    rows = ranks.select(*DOC, "_i", "_words").withColumn("_part", F.col("_i") - F.row_number().over(by_doc))
    upto = Window.partitionBy(*DOC, "_part").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_upto", F.sum("_words").over(upto)).withColumn("_before", F.col("_upto") - F.col("_words"))
    stretch = Window.partitionBy(*DOC, "_part")
    # Words only grow along a stretch: the first line from which ``min_words`` lie behind ends a run.
    after = stretch.orderBy("_before").rangeBetween(min_words, Window.unboundedFollowing)
    before = stretch.orderBy("_upto").rangeBetween(Window.unboundedPreceding, -min_words)
    rows = rows.select(
        "*",
        F.min("_i").over(after).alias("_past"),
        F.max("_i").over(before).alias("_ahead"),
        F.max("_i").over(stretch).alias("_last"),
        F.min("_i").over(stretch).alias("_first"),
        F.max("_upto").over(stretch).alias("_all"),
    )
    ends = F.when(F.col("_past").isNotNull(), F.col("_past") - 1).when(
        F.col("_all") - F.col("_before") >= min_words, F.col("_last")
    )
    starts = F.when(F.col("_ahead").isNotNull(), F.col("_ahead") + 1).when(F.col("_upto") >= min_words, F.col("_first"))
    runs = rows.select(
        *DOC,
        F.inline(F.array(
            F.struct(F.col("_i").alias("_s"), ends.alias("_e")), F.struct(starts.alias("_s"), F.col("_i").alias("_e"))
        )),
    )
    runs = runs.where("_s IS NOT NULL AND _e IS NOT NULL")
    return runs.select(*DOC, F.col("_s").alias("_i"), (F.col("_e") - F.col("_s") + 1).alias("_m"))


def later_copies(ranks: DataFrame, rounds: int, min_words: int) -> DataFrame:
    """``_doc, _hash, _i, _m``: the shortest runs that also stand at an earlier place."""
    runs = shortest_runs(ranks, min_words)
    level = F.floor(F.log2("_m") + 1e-9).cast("int")
    runs = runs.distinct().withColumn("_level", level).withColumn(
        "_tail", (F.col("_i") + F.col("_m") - F.pow(F.lit(2), F.col("_level"))).cast("int")
    )
    at_level = F.coalesce(*[F.when(F.col("_level") == j, F.col(f"_r{j}")) for j in range(rounds + 1)])
    columns = [f"_r{j}" for j in range(rounds + 1)]
    head = ranks.select(*DOC, F.col("_i"), *columns)
    # Null ids equal each other here, so ids are compared through a struct of both.
    key = lambda i: F.struct(F.coalesce(F.col("_doc"), F.lit(0)), F.col("_doc").isNull(), F.col("_hash"), F.col(i))
    head = head.select(key("_i").alias("_key"), *columns)
    found = (
        runs.withColumn("_key", key("_i")).join(head, "_key").withColumn("_x", at_level).drop(*columns)
        .withColumn("_key", key("_tail")).join(head, "_key").withColumn("_y", at_level).drop(*columns, "_key")
        .where("_x IS NOT NULL AND _y IS NOT NULL")
    )
    place = F.struct(
        F.col("_doc").isNull().alias("n"), F.col("_doc").alias("d"), F.col("_hash").alias("h"), F.col("_i").alias("i")
    )
    found = materialise(found.select(*DOC, "_i", "_m", "_x", "_y", place.alias("_place")), "runs")
    # The same run of a place may be shortest at both ends; only different places make it repeated.
    earliest = found.groupBy("_m", "_x", "_y").agg(F.min("_place").alias("_first"), F.max("_place").alias("_final"))
    repeated = earliest.where("_first < _final").select(
        F.col("_m").alias("_m1"), F.col("_x").alias("_x1"), F.col("_y").alias("_y1"), "_first"
    )
    same = (F.col("_m") == F.col("_m1")) & (F.col("_x") == F.col("_x1")) & (F.col("_y") == F.col("_y1"))
    return found.join(repeated, same).where("_place > _first").select(*DOC, "_i", "_m")


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``_doc, _hash, _gone``: sorted numbers of the lines to delete, for documents that have any."""
    rounds = max(0, min_words.bit_length() - 1)
    lines = materialise(line_table(docs), "lines")
    ranks = suffix_ranks(lines, rounds)
    drop(lines)
    runs = later_copies(ranks, rounds, min_words)
    covered = runs.select(*DOC, F.explode(F.sequence(F.col("_i"), F.col("_i") + F.col("_m") - 1)).alias("_i")).distinct()
    places = ranks.select(F.col("_doc").alias("_d"), F.col("_hash").alias("_h"), F.col("_i").alias("_k"), "_line")
    numbered = covered.join(
        places, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h")) & (F.col("_i") == F.col("_k"))
    )
    # Bounded by the lines of a document.
    return materialise(
        numbered.groupBy(*DOC).agg(F.sort_array(F.collect_list("_line")).alias("_gone")), "deleted"
    )


def marked(docs: DataFrame, min_words: int, names: tuple[str, str, str]) -> DataFrame:
    """Add the numbers of deleted lines (or null), all lines and the text that is left."""
    gone, lines, left = names
    key_doc, key_hash = free_name(docs, "_d"), free_name(docs, "_h")
    table = deleted_lines(docs, min_words).toDF(key_doc, key_hash, gone)
    same = F.col("doc_id").eqNullSafe(F.col(key_doc)) & (F.xxhash64(whole_text(F.col("text"))) == F.col(key_hash))
    # The same plan at every size: broadcasting while the table is small would only move the surprise.
    joined = docs.join(table.hint("merge"), same, "left").drop(key_doc, key_hash)
    split = once(joined, {lines: F.split("text", "\n")})
    kept = F.filter(F.col(lines), lambda _, i: ~F.array_contains(F.col(gone), i))
    return once(split, {left: F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))})


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without later copies of runs; the columns of ``docs``."""
    names = tuple(free_name(docs, x) for x in ("_gone", "_lines", "_left"))
    out = marked(docs, min_words, names)
    fixed = {"text": F.col(names[2])}
    if "n_chars" in docs.columns:
        fixed["n_chars"] = F.when(F.col(names[0]).isNull(), F.col("n_chars")).otherwise(
            F.length(names[2]).cast("bigint")
        )
    return out.withColumns(fixed).select(*docs.columns)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = marked(docs, MIN_WORDS, ("_gone", "_lines", "_left"))
    return out.select(
        "doc_id",
        F.coalesce(F.size("_lines"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_deleted"),
        F.coalesce(F.array_join("_gone", ","), F.lit("")).alias("deleted"),
        F.col("_left").alias("text"),
    )


OP6_SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
    SELECT rid, doc_id, unnest(ls) AS raw, unnest(range(len(ls))) AS n FROM d
), s AS (
    SELECT rid, doc_id, n, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM l
), w AS (
    SELECT *, len(regexp_extract_all(t, '{WORD}')) AS words, row_number() OVER (PARTITION BY rid ORDER BY n) AS i,
        sum(len(regexp_extract_all(t, '{WORD}'))) OVER (PARTITION BY rid ORDER BY n) AS upto
    FROM s WHERE t <> ''
), r AS (
    SELECT a.rid, a.doc_id, a.i AS s, min(b.i) AS e
    FROM w a JOIN w b ON a.rid = b.rid AND b.i BETWEEN a.i AND a.i + {MIN_WORDS} AND b.upto - a.upto + a.words >= {MIN_WORDS}
    GROUP BY ALL
    UNION
    SELECT b.rid, b.doc_id, max(a.i) AS s, b.i AS e
    FROM w a JOIN w b ON a.rid = b.rid AND a.i BETWEEN b.i - {MIN_WORDS} AND b.i AND b.upto - a.upto + a.words >= {MIN_WORDS}
    GROUP BY ALL
), k AS (
    SELECT r.rid, r.doc_id, r.s, r.e, string_agg(w.t, chr(10) ORDER BY w.i) AS run
    FROM r JOIN w ON w.rid = r.rid AND w.i BETWEEN r.s AND r.e GROUP BY ALL
), f AS (
    SELECT *, min((doc_id, s)) OVER (PARTITION BY run) AS head FROM k
), gone AS (
    SELECT DISTINCT w.rid, w.n FROM f JOIN w ON w.rid = f.rid AND w.i BETWEEN f.s AND f.e WHERE (f.doc_id, f.s) > f.head
), g AS (
    SELECT rid, count(*) AS n_deleted, string_agg(n::VARCHAR, ',' ORDER BY n) AS deleted, list(n) AS ns FROM gone GROUP BY rid
)
SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(ls) END::BIGINT AS n_lines,
    coalesce(n_deleted, 0)::BIGINT AS n_deleted, coalesce(deleted, '') AS deleted,
    CASE WHEN ns IS NULL THEN text ELSE
        array_to_string(list_filter(ls, lambda x, i: NOT list_contains(ns, i - 1)), chr(10)) END AS text
FROM d LEFT JOIN g USING (rid)
"""
