"""Line dedup, shingle join, fingerprints and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import statistics
from collections import Counter

import pytest

import corpus_pipeline
from tallyfold.llm import fingerprints, line_dedup, pieces, quality_rules, shingle_join
from tallyfold.llm import mixing

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def slow_lines(rows, min_words):
    """Texts left when every run of lines with enough words that stands earlier goes."""
    rows = sorted(set(rows), key=lambda r: r[0])
    docs = []
    for i, t in rows:
        lines = [(n, x.strip(" \t\n\x0b\x0c\r")) for n, x in enumerate((t or "").split("\n"))]
        docs.append((i, t, [(n, x) for n, x in lines if x]))
    seen, gone = {}, {}
    for d, (i, _, lines) in enumerate(docs):
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                run = tuple(x for _, x in lines[a:b])
                if sum(len(WORDS.findall(x)) for x in run) >= min_words and seen.setdefault(run, (d, a)) < (d, a):
                    gone.setdefault(i, set()).update(n for n, _ in lines[a:b])
    return {
        i: t if i not in gone else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i]) for i, t, _ in docs
    }


@pytest.mark.parametrize("min_words", [4, 9])
def test_runs_of_lines(spark, min_words):
    rng = random.Random(min_words)
    lines = ["a b", "c", "d e f", "", "  g h ", "g h", "x y z w v u t s r q"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 14)))) for i in range(40)]
    rows += [(i, f"only {i}\n" + "\n".join(["c", "d e f", "a b"] * 3)) for i in range(50, 58)] + [(3, rows[3][1]), (70, None), (71, "")]
    out = line_dedup.line_dedup(frame(spark, rows), min_words).collect()
    wanted = slow_lines(rows, min_words)
    assert len(out) == len(rows)
    for r in out:
        assert r["text"] == wanted[r["doc_id"]], r
        assert r["n_chars"] == len(r["text"] or "")


def test_line_dedup_of_nothing_and_null_ids(spark):
    assert line_dedup.line_dedup(frame(spark, [])).collect() == []
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(5, "first\n" + passage), (None, passage + "\nlast"), (9, passage)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(frame(spark, rows)).collect()}
    assert got == {5: "first\n" + passage, None: "last", 9: ""}


def slow_components(rows):
    sets = []
    for i, t in rows:
        words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        shingles = {tuple(words)} if 0 < len(words) < 5 else {tuple(words[k:k + 5]) for k in range(len(words) - 4)}
        sets.append((i, shingles))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[find(a)] = find(b)
    low = {}
    for a, (i, s) in enumerate(sets):
        if s and i is not None:
            low[find(a)] = min(low.get(find(a), i), i)
    return [(i, len(s), low.get(find(a)) if s else i) for a, (i, s) in enumerate(sets)]


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def test_components_of_shingles(spark):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, rows, ids = text(90), [], iter(rng.sample(range(10_000), 600))
    for n in (1, 3, 5, 6, 9, 14, 25, 60, 150, 400):
        one = text(n)
        rows += [(next(ids), edited(rng, one, e)) for e in (0, 0, 0, 1, 1, 2, 3)] + [(next(ids), one.upper())]
    base = text(200)
    rows += [(next(ids), edited(rng, base, rng.randrange(1, 7))) for _ in range(60)]  # one large group of near copies
    rows += [(next(ids), passage + " " + text(70)) for _ in range(60)]  # one passage in many documents
    chain = text(120)
    for _ in range(12):
        rows.append((next(ids), chain))
        chain = edited(rng, chain, 2)
    rows += [(7777777, None), (7777778, ""), (7777779, " \n"), (None, base), (rows[5][0], rows[5][1])]
    out = shingle_join.near_duplicates(frame(spark, rows)).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=str)
    assert got == sorted(slow_components(rows), key=str)
    kept = shingle_join.keep_one(frame(spark, rows)).collect()
    groups = {c for i, n, c in slow_components(rows) if n}
    assert sorted(r["doc_id"] for r in kept if WORDS.search(r["text"] or "")) == sorted(groups)
    assert {7777777, 7777778, 7777779} <= {r["doc_id"] for r in kept}
    assert shingle_join.near_duplicates(frame(spark, [])).collect() == []


def test_large_buckets_are_streamed_whole():
    import numpy as np
    import pyarrow as pa

    keys = np.repeat([1, 2, 3, 4], [2, 40, 1, 16])
    classes = np.concatenate([[5, 6], np.arange(40), [1], np.arange(16)])
    for size in (1, 3, 17, 100):
        batches = [pa.record_batch([pa.array(keys[i:i + size]), pa.array(classes[i:i + size])], names=["a", "b"]) for i in range(0, 59, size)]
        got = [tuple(r.values()) for b in shingle_join._bucketed(iter(batches)) for r in b.to_pylist()]
        wanted = [(k, c, k == 2) for k, c in zip(keys.tolist(), classes.tolist(), strict=True) if k != 3]
        assert sorted(got) == wanted


def jaccard(a, b):
    a, b = Counter(WORDS.findall(a)), Counter(WORDS.findall(b))
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_fingerprints_and_edits(spark):
    rng = random.Random(2)
    text = lambda n: " ".join(f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(n))
    rows = [(i, text(rng.randrange(5, 200))) for i in range(150)] + [(500, "é" * 7), (501, ""), (502, None), (503, "one")]
    out = {r["doc_id"]: r for r in fingerprints.fingerprint_with_edits(frame(spark, rows)).collect()}
    ordered = sorted(rows, key=lambda r: -r[0])
    off = []
    for k, (i, t) in enumerate(ordered):
        t, after = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        third = len(t) // 3
        new = t[: len(t) - third] + after[:third]
        assert out[i]["n_chars"] == len(t)
        assert out[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        if WORDS.search(t) and WORDS.search(new):
            off.append(out[i]["near_edited"] - jaccard(t, new))
        if WORDS.search(t) and WORDS.search(after):
            off.append(out[i]["near_next"] - jaccard(t, after))
    assert abs(statistics.mean(off)) < 0.02 and statistics.pstdev(off) < 0.1
    assert out[502]["near_next"] == 1.0 and out[501]["fingerprint"] == "" and out[503]["near_next"] == 0.0
    again = [(1, "a b a"), (1, "a b a"), (None, "x"), (None, "a b a"), (9, "b a a")]
    twice = fingerprints.fingerprint_with_edits(frame(spark, again)).collect()
    assert len(twice) == 5 and len({r["fingerprint"] for r in twice}) == 2
    alone = fingerprints.fingerprint_with_edits(frame(spark, [(4, "a b c")])).collect()
    assert alone[0]["near_next"] == 1.0 and alone[0]["edited_sha256"] == hashlib.sha256(b"a b a").hexdigest()
    assert fingerprints.fingerprint_with_edits(frame(spark, [])).collect() == []
    assert fingerprints.fingerprint(frame(spark, again)).count() == 5


def test_pipeline_by_brute_force(spark, tmp_path):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(500)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, rows = text(60), []
    for i in range(60):
        rows.append((i, "\n".join([text(30), passage if i % 6 == 0 else text(20), text(30)])))
    rows += [(100 + i, edited(rng, rows[i][1], 1)) for i in range(0, 20, 5)]
    rows += [(200, None), (201, ""), (202, " | ".join(vocabulary[:80])), (203, "spam " * 90)]
    table = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows], DOCS)
    table.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))

    kept = {r["doc_id"]: r["text"] for r in quality_rules.quality_rules(table).collect()}
    assert set(kept) == {i for i, _ in rows if i < 200}
    lines = slow_lines(list(kept.items()), line_dedup.MIN_WORDS)
    groups = slow_components(list(lines.items()))
    stay = {i: lines[i] for i, n, c in groups if c == i}
    sizes = {s: sum(len(WORDS.findall(t)) for i, t in stay.items() if i % 3 == int(s[1])) for s in ("s0", "s1", "s2")}
    wanted = mixing.targets(sizes)

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} <= set(stay)
    vocab = pieces.read_vocabulary(pieces.read_model())
    taken = Counter()
    for r in out:
        assert r["lossless"] and pieces.decode_ids(vocab, r["pieces"]) == stay[r["doc_id"]]
        taken[f"s{r['doc_id'] % 3}"] += len(WORDS.findall(stay[r["doc_id"]]))
    assert max(Counter(r["doc_id"] for r in out).values()) <= 2
    for s in sizes:
        assert abs(taken[s] - wanted[s]) <= 0.06 * wanted[s]
