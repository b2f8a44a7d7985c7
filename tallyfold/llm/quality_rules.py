"""Quality rules, line first: clean every document line by line, then judge what is left.

Column expressions only and no shuffle: a document is one row from scan to verdict.

Each line is put to three kinds of rules.

* punctuation: symbols or repeated marks make up a large part of the line, or few distinct words fill it
  (measured by stretches of ``FILLER_STRETCH`` words, as the distinct share of any prose falls with length);
* navigation: separators between most words, or a short line that is nothing but menu words;
* boilerplate: notices about cookies, scripts, rights and terms.

Lines that fail are removed. A document is rejected if it fails the word rules (too few words, too
many words in repeated three-word windows), or if the removed lines held more than
``max_lost_percent`` of its word characters.

Null and empty texts have no words and are rejected. Blank lines are never counted as lost. Equal
rows get equal verdicts, tables without rows give none, and other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm.common import WORD, documents, free_name, once, whole_text, words_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 30

SYMBOL = r"[#*$%&|<>]"
#: Any of these, as many as a quarter of the words of a line, makes it noise.
NOISE = r"[#*$%&<>~^]|[!?]{2,}"
SEPARATOR = r"[|»›·•>]"
MENU = (
    r"(?i)^[\s|»›·•>/-]*((home|menu|login|log in|log out|sign in|sign up|register|search|contact|contact us"
    r"|about|about us|sitemap|next|previous|prev|back|top|back to top|share|print|help|faq|more|read more)"
    r"[\s|»›·•>/-]*)+$"
)
NOTICE = (
    r"(?i)(use[sd]? (of )?cookies|accept (all )?cookies|cookie policy|privacy policy|terms of (use|service)"
    r"|all rights reserved|enable javascript|javascript (is )?(disabled|required)|lorem ipsum"
    r"|subscribe to (our|the) newsletter|powered by |click here to )"
)
#: Every notice holds one of these, in lower case.
NOTICE_STEMS = (
    "cookie", "privacy policy", "terms of ", "all rights reserved", "javascript", "lorem ipsum", "newsletter",
    "powered by ", "click here to ",
)
#: A line of this many words is filler if this percentage of them repeat words of the same stretch of the line.
FILLER_WORDS, FILLER_PERCENT = 12, 50
#: Words of a stretch. Prose keeps 60 % distinct words over so many, however long the line; over a whole line it
#: would fall below half by length alone.
FILLER_STRETCH = 128


def few_distinct(words: Column) -> Column:
    """True where distinct words are few in the stretches of a line.

    One word may stand in all of them and counts once, so a word that fills the line is seen at any length.
    """
    n, few = F.size(words), lambda distinct: 100 * distinct <= (100 - FILLER_PERCENT) * F.size(words)
    later = F.floor((n - 1) / FILLER_STRETCH).cast("int")
    counts = F.transform(
        F.sequence(F.lit(0), later),
        lambda i: F.size(F.array_distinct(F.slice(words, i * FILLER_STRETCH + 1, F.lit(FILLER_STRETCH)))),
    )
    # A line with many distinct words as a whole, as most have, needs no look at its stretches.
    whole = few(F.size(F.array_distinct(words)))
    return whole & ((later == 0) | few(F.aggregate(counts, -later, lambda total, count: total + count)))


def may_hold(text: Column) -> dict[str, Column]:
    """Per document: whether any line can fail by marks, separators or a notice, so that most lines need no look."""

    def has_stem(lower: Column) -> Column:
        found = F.lit(False)
        for stem in NOTICE_STEMS:
            found = found | F.contains(lower, F.lit(stem))
        return found

    return {
        "noise": text.rlike(NOISE),
        "separators": text.rlike(SEPARATOR),
        # Bound as a lambda's variable, so that the text is lowered once.
        "notice": F.exists(F.array(F.lower(text)), has_stem),
    }


def line_fails(line: Column, words: Column, may: dict[str, Column]) -> Column:
    """True for a line with these words that a rule removes."""
    n = F.size(words)
    noise = may["noise"] & (4 * F.regexp_count(line, F.lit(NOISE)) > n)
    # More than a quarter of the words, and three at least.
    separated = may["separators"] & (F.regexp_count(line, F.lit(SEPARATOR)) > F.greatest(F.lit(2), F.floor(n / 4)))
    filler = (n >= FILLER_WORDS) & few_distinct(words)
    notice = may["notice"] & line.rlike(NOTICE)
    return (n > 0) & (noise | separated | filler | line.rlike(MENU) | notice)


def repeated_words(positions: Column) -> Column:
    """Words covered by the windows at ``positions`` (ascending starts, three words each; null: none)."""
    steps = F.transform(positions, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(positions, k + 1) - x, F.lit(3))))
    return F.coalesce(F.aggregate(steps, F.lit(0), lambda total, step: total + step), F.lit(0))


def measure(docs: DataFrame, text: str = "text", into: str = "measures") -> DataFrame:
    """Add a struct column of the counts, the verdicts and the cleaned text."""
    t = whole_text(F.col(text))
    names = [
        free_name(docs, f"_{x}")
        for x in ("lines", "may", "by_line", "words", "bad", "hashes", "sorted", "lost", "starts", "counts")
    ]
    lines, may, by_line, w, bad, hashes, ordered, lost, starts, counts = names
    c = F.col

    step = once(docs, {lines: F.split(t, "\n"), may: F.struct(*[v.alias(k) for k, v in may_hold(t).items()])})
    # Blanks end words and a line break is one, so the words of the text are those of its lines.
    step = once(step, {by_line: F.transform(c(lines), words_of)})
    step = once(step, {
        w: F.flatten(c(by_line)),
        bad: F.transform(c(by_line), lambda words, k: line_fails(F.get(c(lines), k), words, c(may))),
    })
    # One hash per three-word window; where all are distinct nothing repeats and the rest is skipped.
    window = F.transform(c(w), lambda x, i: F.xxhash64(x, F.get(c(w), i + 1), F.get(c(w), i + 2)))
    step = once(step, {
        hashes: F.when(F.size(w) >= 4, F.slice(window, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))),
        lost: F.when(
            F.exists(c(bad), lambda b: b), F.flatten(F.filter(c(by_line), lambda _, k: F.get(c(bad), k)))
        ),
    })
    repeats = F.size(F.array_distinct(c(hashes))) < F.size(c(hashes))
    pairs = F.sort_array(F.transform(c(hashes), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    step = once(step, {ordered: F.when(repeats, pairs)})
    alike = F.filter(
        c(ordered),
        lambda s, k: F.coalesce(s["h"] == F.get(c(ordered), k - 1)["h"], F.lit(False))
        | F.coalesce(s["h"] == F.get(c(ordered), k + 1)["h"], F.lit(False)),
    )
    step = once(step, {starts: F.sort_array(F.transform(alike, lambda s: s["i"]))})

    worded = F.filter(c(lines), lambda _, k: F.size(F.get(c(by_line), k)) > 0)
    kept_lines = F.filter(c(lines), lambda _, k: ~F.get(c(bad), k))
    chars = F.length(F.array_join(w, "")).cast("bigint")
    lost_chars = F.coalesce(F.length(F.array_join(c(lost), "")), F.lit(0))
    step = once(step, {counts: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        chars.alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        F.size(worded).cast("bigint").alias("n_lines"),
        F.size(F.array_distinct(worded)).cast("bigint").alias("n_distinct_lines"),
        repeated_words(c(starts)).cast("bigint").alias("n_repeat_words"),
        F.size(F.filter(c(bad), lambda b: b)).cast("bigint").alias("n_lines_removed"),
        (chars - lost_chars).alias("clean_chars"),
        F.when(c(lost).isNull(), t).otherwise(F.array_join(kept_lines, "\n")).alias("clean_text"),
    )})
    m = c(counts)
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    thin = 100 * (m["word_chars"] - m["clean_chars"]) > MAX_LOST_PERCENT * m["word_chars"]
    verdicts = F.struct(f"{counts}.*", failed.alias("base_failed"), (~failed & ~thin).alias("kept"))
    return step.withColumn(into, verdicts).drop(*names)


def quality_rules(docs: DataFrame) -> DataFrame:
    """The accepted documents with their cleaned text; all columns of ``docs``."""
    into = free_name(docs, "_measures")
    out = measure(docs, into=into).where(F.col(into)["kept"])
    fixed = {"text": F.col(into)["clean_text"]}
    if "n_chars" in docs.columns:
        fixed["n_chars"] = F.length(F.col(into)["clean_text"]).cast("bigint")
    return out.withColumns(fixed).select(*docs.columns)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    m = F.col("measures")
    return measure(docs).select(
        "doc_id",
        m["n_words"].alias("n_words"),
        m["word_chars"].alias("word_chars"),
        m["n_symbols"].alias("n_symbols"),
        (m["n_lines"] - m["n_distinct_lines"]).alias("n_dup_lines"),
        m["n_repeat_words"].alias("n_repeat_words"),
        m["base_failed"].alias("base_failed"),
        m["kept"].alias("kept"),
        m["n_lines_removed"].alias("n_lines_removed"),
        m["clean_chars"].alias("clean_chars"),
    )


def _line_sql(line: str) -> str:
    count = lambda pattern: f"len(regexp_extract_all({line}, '{pattern}'))"
    words, n = f"regexp_extract_all({line}, '{WORD}')", count(WORD)
    few = lambda distinct: f"100 * ({distinct}) <= {100 - FILLER_PERCENT} * {n}"
    later = f"(({n} - 1) // {FILLER_STRETCH})"
    stretches = (
        f"list_sum(list_transform(range(0, {later} + 1), lambda s: len(list_distinct("
        f"{words}[s * {FILLER_STRETCH} + 1:(s + 1) * {FILLER_STRETCH}]))))"
    )
    return f"""({n} > 0 AND (
        4 * {count(NOISE)} > {n}
        OR ({count(SEPARATOR)} >= 3 AND 4 * {count(SEPARATOR)} > {n})
        OR ({n} >= {FILLER_WORDS} AND {few(f'len(list_distinct({words}))')}
            AND ({later} = 0 OR {few(f'{stretches} - {later}')}))
        OR regexp_matches({line}, '{MENU}') OR regexp_matches({line}, '{NOTICE}')))"""


OP8_SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT rid, doc_id, t, regexp_extract_all(t, '{WORD}') AS ws, string_split(t, chr(10)) AS ls FROM d
), p AS (
    SELECT rid, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w
), g AS (
    SELECT rid, i, word, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3
    FROM p WINDOW o AS (PARTITION BY rid ORDER BY i)
), r AS (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, word, w2, w3) AS c FROM g WHERE w3 IS NOT NULL
), cover AS (
    SELECT rid, count(*) AS n_repeat_words
    FROM (SELECT DISTINCT rid, i + k AS j FROM r, (VALUES (0), (1), (2)) AS o(k) WHERE c > 1) GROUP BY rid
), m AS (
    SELECT rid, doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '{SYMBOL}'))::BIGINT AS n_symbols,
        list_filter(ls, lambda x: regexp_matches(x, '{WORD}')) AS worded,
        list_filter(ls, lambda x: {_line_sql('x')}) AS removed
    FROM w
), v AS (
    SELECT m.*, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        length(array_to_string(regexp_extract_all(array_to_string(removed, ' '), '{WORD}'), '')) AS lost
    FROM m LEFT JOIN cover USING (rid)
), f AS (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM v
)
SELECT doc_id, n_words, word_chars, n_symbols,
    (len(worded) - len(list_distinct(worded)))::BIGINT AS n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND 100 * lost <= {MAX_LOST_PERCENT} * word_chars AS kept,
    len(removed)::BIGINT AS n_lines_removed, (word_chars - lost)::BIGINT AS clean_chars
FROM f
"""
