"""License scans: canonical digests of entire texts, looked up in a table of known licences.

A text is brought into canonical form: lower case, copyright lines dropped, everything but letters
and digits removed, equivalent spellings replaced. The SHA-256 of that form is the key of an
equi-join with the digests of known licences and notices. Scanned are every whole document and
every line of it that is a text of its own (licence notices stand on lines of their own).

Columns and SQL expressions only. All units of a document stay in its task until they are counted,
so the one shuffle carries a narrow row per document. The known table is broadcast while it has
at most ``MAX_BROADCAST`` rows (two short strings each) and joined by digest otherwise.

Null and empty texts, and texts that are copyright lines only, have no digest and match nothing.
Rows with the same id are scanned separately. Tables without rows give none; other columns are
not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm.common import documents, once, whole_text
from tallyfold.llm.license_texts import KNOWN, all_texts  # noqa: F401  (KNOWN for readers of this module)

MAX_BROADCAST = 100_000

#: Spellings that count as the same, in canonical form (no blanks, no punctuation).
EQUIVALENT = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"),
    ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("calibre", "caliber"), ("cancelled", "canceled"), ("capitalisation", "capitalization"),
    ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("fulfilll", "fulfill"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("labour", "labor"), ("licence", "license"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"),
    ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"), ("percent", "pc"), ("copyrightowner", "copyrightholder"), ("https", "http"),
]
#: Lines that may be copyright lines.
COPYRIGHT = r"^\W*(copyright\b|\(c\)|©|copr\b|portions copyright|all rights reserved\W*$)"


#: A sign, or the word, and a year or a second sign (lower case).
SIGNED = (
    r"^\W*(portions )?((copyright|copr)[\s.:,]*(\(c\)|©)|((copyright|copr|\(c\)|©)[\s.:,]*)+[\[<(]?([12]\d{3}|yyyy|year)\b)"
    r"|^\W*all rights reserved\W*$"
)
_NAME = r"([\p{Lu}\p{N}<\[(&]\S*|of|the|and|de|der|van|von|et|al\.)"
#: A sign, or the word, and nothing but a name; for a paragraph of such lines.
NAMED = (
    r"^\W*(?i:portions )?((?i:copyright|copr)\b|\([cC]\)|©)[\s.:,]*((?i:by)\s+)?"
    r"(?!(?i:the\s+)?(?i:notice|holder|owner|law|licen[cs]e|and|or)s?\b)" + _NAME + r"(\s+" + _NAME + r")*\s*$"
)


def canonical_lines(text: Column) -> Column:
    """Lower case letters and digits of each line; empty for a copyright line.

    A sentence that is wrapped so that a line starts with 'copyright' keeps that line.
    """

    def canonical(lines: Column, line: Column, i: Column) -> Column:
        lower = F.lower(line)
        bare = F.regexp_replace(lower, r"[^\p{L}\p{N}]+", "")
        # A neighbour of the same paragraph that is no copyright line itself makes the line part of a sentence.
        beside = lambda x: ~F.coalesce(x.rlike(r"\S"), F.lit(False)) | F.lower(x).rlike(COPYRIGHT)
        alone = beside(F.when(i > 0, F.get(lines, i - 1))) & beside(F.get(lines, i + 1))
        dropped = lower.rlike(COPYRIGHT) & (lower.rlike(SIGNED) | line.rlike(NAMED) & alone)
        return F.when(dropped, F.lit("")).otherwise(bare)

    # Bound as a lambda's variable, so that the text is split once.
    split = F.array(F.split(text, "\n"))
    return F.transform(split, lambda lines: F.transform(lines, lambda x, i: canonical(lines, x, i)))[0]


def same_spelling(text: Column) -> Column:
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), EQUIVALENT, text)


def digest(text: Column) -> Column:
    """Digest of a canonical text, null where nothing is left."""
    return F.when(text != "", F.sha2(text, 256))


def known_licenses(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """``digest, license`` of all known texts, or of these; where two share a canonical text the first name stays.

    The driver reads the shipped texts, as executors may not see its files.
    """
    rows = spark.createDataFrame(all_texts() if texts is None else list(texts.items()), "license string, text string")
    lines = canonical_lines(F.col("text"))
    out = rows.select("license", digest(same_spelling(F.array_join(lines, ""))).alias("digest"))
    return out.where("digest IS NOT NULL").groupBy("digest").agg(F.min("license").alias("license"))


def license_scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Per document: digest of the whole text, its licence, and the licences of its lines.

    ``doc_id, text_digest, license, line_licenses array<string> (sorted, distinct), n_license_lines``.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text")
    canonical = canonical_lines(whole_text(F.col("text")))
    units = (
        once(rows, {"_lines": canonical})
        # The whole text comes first, then its lines unless there is only one.
        .select("_row", "doc_id", F.array(F.array_join("_lines", "")).alias("_whole"), "_lines")
        .select(
            "_row", "doc_id",
            F.when(F.size("_lines") > 1, F.concat("_whole", F.filter("_lines", lambda x: x != "")))
            .otherwise(F.col("_whole")).alias("_units"),
        )
        .select("_row", "doc_id", F.posexplode("_units").alias("_pos", "_unit"))
        .select("_row", "doc_id", "_pos", digest(same_spelling(F.col("_unit"))).alias("_digest"))
    )
    table = known.select(F.col("digest").alias("_known"), F.col("license").alias("_license"))
    if known.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:
        table = F.broadcast(table)
    whole = F.col("_pos") == 0
    found = units.join(table, F.col("_digest") == F.col("_known"), "left")
    return found.groupBy("_row", "doc_id").agg(
        F.max(F.when(whole, F.col("_digest"))).alias("text_digest"),
        F.max(F.when(whole, F.col("_license"))).alias("license"),
        # Bounded by the names in the known table.
        F.sort_array(F.collect_set(F.when(~whole, F.col("_license")))).alias("line_licenses"),
        F.count(F.when(~whole, F.col("_license"))).alias("n_license_lines"),
    ).drop("_row")


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan(documents(spark, sf_dir), known_licenses(spark))
    return out.withColumn("line_licenses", F.array_join("line_licenses", ","))


def _canonical_sql(text: str) -> str:
    """Canonical lines of a text; RE2 has no look-ahead, so the words a name must not be are a pattern of their own."""
    found = lambda x, pattern: f"regexp_matches({x}, '{pattern}')"
    head, _, tail = NAMED.partition("(?!")
    words, _, names = tail.partition(r"\b)")
    maybe = lambda x: found(f"lower({x})", COPYRIGHT)
    blank = lambda x: f"NOT coalesce(regexp_matches({x}, '[^\\s\\x0B]'), false)"
    beside = lambda x: f"({blank(x)} OR {maybe(x)})"
    named = f"({found('x', head + names)} AND NOT {found('x', head + words + chr(92) + 'b')} AND {beside('ls[i - 1]')} AND {beside('ls[i + 1]')})"
    dropped = f"({maybe('x')} AND ({found('lower(x)', SIGNED)} OR {named}))"
    bare = "regexp_replace(lower(x), '[^\\p{L}\\p{N}]+', '', 'g')"
    return (
        f"list_transform(list_transform([string_split({text}, chr(10))], lambda ls: list_transform(ls, lambda x, i:"
        f" CASE WHEN {dropped} THEN '' ELSE {bare} END)), lambda r: r)[1]"
    )


def _spelling_sql(text: str) -> str:
    return reduce(lambda t, pair: f"replace({t}, '{pair[0]}', '{pair[1]}')", EQUIVALENT, text)


def _known_sql() -> str:
    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in all_texts())
    return (
        f"SELECT sha256({_spelling_sql("array_to_string(ls, '')")}) AS digest, min(license) AS license "
        f"FROM (SELECT license, {_canonical_sql('text')} AS ls FROM (VALUES {rows}) AS k(license, text)) GROUP BY 1"
    )


OP5_SQL = f"""
WITH known AS ({_known_sql()}), d AS (
    SELECT row_number() OVER () AS rid, doc_id, {_canonical_sql("coalesce(text, '')")} AS ls FROM documents
), u AS (
    SELECT rid, doc_id, 0 AS pos, {_spelling_sql("array_to_string(ls, '')")} AS unit FROM d
    UNION ALL
    SELECT rid, doc_id, 1, {_spelling_sql('unit')}
    FROM (SELECT rid, doc_id, unnest(ls) AS unit FROM d WHERE len(ls) > 1) WHERE unit <> ''
), g AS (
    SELECT rid, doc_id, pos, CASE WHEN unit <> '' THEN sha256(unit) END AS digest FROM u
)
SELECT doc_id, max(digest) FILTER (pos = 0) AS text_digest, max(license) FILTER (pos = 0) AS license,
    coalesce(array_to_string(list_sort(list_distinct(list(license) FILTER (pos = 1 AND license IS NOT NULL))), ','), '')
        AS line_licenses,
    count(license) FILTER (pos = 1) AS n_license_lines
FROM g LEFT JOIN known USING (digest) GROUP BY rid, doc_id
"""
