"""Language identification with language-bitmask n-gram filters.

The filter is a table of ``SLOTS`` rows with one bit per language (a Bloom filter per language, sliced by
bit). An n-gram is looked up at ``HASHES`` slots; the conjunction of their masks is the set of languages
that contain it. Over a text, each language counts its bits. A language whose filter is filled to a share
``f`` answers wrongly with probability ``f ** HASHES``; counts are corrected for that, and the largest
corrected count decides (ties: the first language in code-point order). The score is the corrected
share of the text's n-grams known to the language.

Texts are reduced to lower-case letters and single blanks; n-grams never cross documents.

Learning counts, over all training documents, how many documents of each language hold each n-gram.
Counts are summed within tasks before the shuffle. An n-gram enters the filter of a language if it
occurs in at least ``MIN_DOCS`` documents and ``MIN_SHARE`` of that language's, and not ``RATIO`` times
more rarely than in the language where it is most common. The driver holds the finished table only:
``SLOTS`` entries per 32 languages, whatever the input.

Null texts and texts without a letter are ``und`` with score 0. Texts too short for an n-gram get the
language with most training documents and score 0. Without training rows all is ``und``. Rows with
a null id are predicted, but neither held out nor learned from. Equal rows get equal results; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm.common import documents, row_slices

N = 4
SLOTS = 1 << 20
HASHES = 4
MIN_DOCS, MIN_SHARE, RATIO = 2, 0.0005, 20.0
#: Languages per word of a mask.
BITS = 32
#: Distinct n-grams a task holds before it passes partial counts on.
FLUSH = 2_000_000
UNKNOWN = "und"

_BLANK, _BREAK = 32, 0x110000
_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """Lower-case code point of every letter, a blank for all else; built once per worker."""
    global _letters
    if _letters is None:
        table = np.full(_BREAK + 1, _BLANK, np.uint32)
        for code in range(_BREAK):
            char = chr(code)
            if char.isalpha():
                table[code] = ord(char.lower()[0])
        table[_BREAK] = _BREAK
        _letters = table
    return _letters


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, the text each belongs to, and whether each text has a letter."""
    lengths = np.fromiter((len(t) + 3 for t in texts), np.int64, len(texts))
    joined = "".join(f" {t} \0" for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    codes[np.cumsum(lengths) - 1] = _BREAK
    codes = letter_table()[codes]
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != _BLANK) | (codes[:-1] != _BLANK)
    codes = codes[keep].astype(np.uint64)
    breaks = codes == _BREAK
    owner = np.cumsum(breaks) - breaks
    letters = np.bincount(owner[(codes != _BLANK) & ~breaks], minlength=len(texts)) > 0
    if len(codes) < N:
        return np.empty(0, np.uint64), np.empty(0, np.int64), letters
    # A window that holds a break has two owners.
    inside = (owner[: len(codes) - N + 1] == owner[N - 1 :]) & ~breaks[N - 1 :]
    mixed = np.zeros(len(codes) - N + 1, np.uint64)
    for i in range(N):
        mixed = (mixed + codes[i : len(codes) - N + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed = mixed[inside] * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return mixed, owner[: len(codes) - N + 1][inside], letters


def slots_of(hashes: np.ndarray) -> list[np.ndarray]:
    step = (hashes >> np.uint64(40)) | np.uint64(1)
    return [((hashes + np.uint64(i) * step) & np.uint64(SLOTS - 1)).astype(np.int64) for i in range(HASHES)]


def _merged(hashes: list[np.ndarray], langs: list[np.ndarray], counts: list[np.ndarray]):
    h, g, n = np.concatenate(hashes), np.concatenate(langs), np.concatenate(counts)
    order = np.lexsort((g, h))
    h, g, n = h[order], g[order], n[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    return [h[first]], [g[first]], [np.add.reduceat(n, np.flatnonzero(first)) if len(n) else n]


def count_grams(languages: list[str]):
    """Batches of (lang, text) to partial counts (gram, lang number, documents)."""
    number = {lang: i for i, lang in enumerate(languages)}

    def emitted(kept) -> pa.RecordBatch:
        (h,), (g,), (n,) = _merged(*kept)
        columns = [pa.array(h.view(np.int64)), pa.array(g.astype(np.int32)), pa.array(n.astype(np.int64))]
        return pa.record_batch(columns, names=["gram", "lang", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[list, list, list] = ([], [], [])
        held = 0
        for batch in batches:
            for rows in row_slices(batch, 4_000_000):
                langs = np.array([number[x] for x in rows.column(0).to_pylist()], np.int64)
                hashes, owner, _ = grams(rows.column(1).to_pylist())
                # One count per document and n-gram.
                key = hashes ^ (owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
                _, at = np.unique(key, return_index=True)
                part = _merged([hashes[at]], [langs[owner[at]]], [np.ones(len(at), np.int64)])
                for column, new in zip(kept, part, strict=True):
                    column += new
                held += len(part[0][0])
                if held > FLUSH:
                    kept = _merged(*kept)
                    held = len(kept[0][0])
                    if held > FLUSH // 2:
                        yield emitted(kept)
                        kept, held = ([], [], []), 0
        if held:
            yield emitted(kept)

    return run


def _to_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = batch.column(0).to_numpy().view(np.uint64)
        for at in slots_of(hashes):
            yield pa.record_batch(
                [pa.array(at.astype(np.int32)), batch.column(1), batch.column(2)], names=["slot", "word", "mask"]
            )


@dataclass
class Filters:
    """``table[slot, word]`` masks; ``wrong`` the false-positive rate and ``common`` the commonest language."""

    languages: list[str]
    table: np.ndarray
    wrong: np.ndarray
    common: int


def learn(docs: DataFrame) -> Filters:
    """Filters from rows (lang, text) with non-null values."""
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    words = max(1, -(-len(languages) // BITS))
    table = np.zeros((SLOTS, words), np.uint32)
    if languages:
        partial = docs.select("lang", "text").mapInArrow(count_grams(languages), "gram bigint, lang int, docs bigint")
        counts = partial.groupBy("gram", "lang").agg(F.sum("docs").alias("docs"))
        size = F.element_at(F.array(*[F.lit(float(sizes[x])) for x in languages]), F.col("lang") + 1)
        rates = counts.withColumn("size", size).withColumn("rate", F.col("docs") / F.col("size"))
        # An n-gram has a row per language at most.
        listed = rates.groupBy("gram").agg(
            F.max("rate").alias("top"), F.collect_list(F.struct("lang", "docs", "rate", "size")).alias("held")
        )
        chosen = listed.select("gram", "top", F.inline("held")).where(
            (F.col("docs") >= MIN_DOCS) & (F.col("rate") >= MIN_SHARE) & (F.col("rate") * RATIO >= F.col("top"))
        )
        masks = chosen.groupBy("gram", F.floor(F.col("lang") / BITS).cast("int").alias("word")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, lang % {BITS})")).alias("mask")
        )
        filled = (
            masks.mapInArrow(_to_slots, "slot int, word int, mask bigint")
            .groupBy("slot", "word").agg(F.bit_or("mask").alias("mask"))
            .toArrow()  # SLOTS rows per word at most
        )
        at = filled["slot"].to_numpy(), filled["word"].to_numpy()
        table[at] = filled["mask"].to_numpy().astype(np.uint32)
    fill = [np.count_nonzero(table[:, i // BITS] >> np.uint32(i % BITS) & 1) / SLOTS for i in range(len(languages))]
    common = min(range(len(languages)), key=lambda i: (-sizes[languages[i]], i), default=0)
    return Filters(languages, table, np.array(fill) ** HASHES, common)


def decide(filters: Filters, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    plain = [t or "" for t in texts]
    hashes, owner, letters = grams(plain)
    total = np.bincount(owner, minlength=len(texts))
    langs = len(filters.languages)
    if not langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    corrected = np.zeros((len(texts), langs))
    slots = slots_of(hashes)
    for word in range(filters.table.shape[1]):
        column = np.ascontiguousarray(filters.table[:, word])
        mask = column[slots[0]]
        for at in slots[1:]:
            mask &= column[at]
        for bit in range(min(BITS, langs - word * BITS)):
            lang = word * BITS + bit
            counted = np.bincount(owner[(mask >> np.uint32(bit)) & 1 > 0], minlength=len(texts))
            wrong = filters.wrong[lang]
            corrected[:, lang] = np.maximum(0, counted - total * wrong) / max(1 - wrong, 1e-9)
    best = corrected.argmax(1)
    score = np.minimum(1.0, corrected[np.arange(len(texts)), best] / np.maximum(total, 1))
    best = np.where(score > 0, best, filters.common)
    names = [filters.languages[b] if has else UNKNOWN for b, has in zip(best, letters, strict=True)]
    return names, np.where(letters, score, 0.0)


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """``doc_id, lang_pred, score`` for rows (doc_id, text)."""
    shipped = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in row_slices(batch, 4_000_000):
                names, score = decide(shipped.value, rows.column(1).to_pylist())
                yield pa.record_batch(
                    [rows.column(0), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def fold(doc_id):
    """The fold of a document; 1 is held out."""
    return F.crc32(doc_id.cast("string")) % 3


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 1))
    out = predict(docs, learn(known.select("lang", "text")))
    held_out = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
