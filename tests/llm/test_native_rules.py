"""Quality rules, license scans and mixing on small hand-made tables."""

from __future__ import annotations

import hashlib
import json
import math
import random
import re
import textwrap

import pytest

from tallyfold.llm import license_texts, licenses, mixing, quality_rules

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def plain(n, tag="w"):
    return " ".join(f"{tag}{i}" for i in range(n)) + "."


def brute_repeats(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    return len(words), len(covered)


def test_counts_follow_their_definition(spark):
    texts = ["", None, "a", "a b", "a b c a b c a", "x x x x x", "a\n\na\nb", plain(80), "one two three four " * 30,
             "é ü ü # $ %%\n" * 3, "a\tb\x0bc\x0cd\re"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["measures"] for r in quality_rules.measure(frame(spark, rows)).collect()}
    for i, t in enumerate(texts):
        n, repeats = brute_repeats(t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (got[i]["n_words"], got[i]["n_repeat_words"]) == (n, repeats), t
        assert got[i]["n_lines"] - got[i]["n_distinct_lines"] == len(lines) - len(set(lines))
        assert got[i]["base_failed"] == (n < 50 or 100 * repeats > 50 * n)


def test_bad_lines_go_and_clean_documents_stay(spark):
    body = "\n".join(plain(30, f"k{i}_") for i in range(4))
    junk = " ".join(f"w{i}*** z{i}%%%" for i in range(60))
    rows = [
        (1, body, "en", "a", 1),
        (2, "Home | About | Contact | Login\n" + body + "\nAll rights reserved.", "en", "a", 1),
        (3, plain(60) + "\n" + junk, "en", "a", 1),
        (4, " | ".join(f"item{i}" for i in range(70)), "en", "a", 1),
        (5, None, None, None, None),
        (6, "", "en", "a", 0),
        (7, plain(20_000), "en", "a", 1),
        (1, body, "en", "a", 1),
    ]
    kept = quality_rules.quality_rules(frame(spark, rows)).collect()
    texts = {r["doc_id"]: r["text"] for r in kept}
    assert sorted(r["doc_id"] for r in kept) == [1, 1, 2, 7]
    assert texts[1] == body and texts[2] == body and texts[7] == plain(20_000)
    assert {r["doc_id"]: r["n_chars"] for r in kept}[2] == len(body)


def prose(n):
    """Words by Zipf's law, as in prose: fewer distinct ones the longer it is."""
    draw = random.Random(5)
    ranks = draw.choices(range(2_000), [1 / (k + 3) for k in range(2_000)], k=n)
    return " ".join(f"w{k}" for k in ranks)


def test_long_clean_lines_stay_and_long_filler_goes(spark):
    body, long = "\n".join(plain(30, f"k{i}_") for i in range(4)), prose(6_000)
    assert 2 * len(set(long.split())) < len(long.split())
    half = " ".join(f"spam s{i}" for i in range(1_000)) + " spam spam"
    filler = ["spam " * 12, "spam " * 5_000, "a b c d e f " * 500, half]
    rows = [(1, long, None, None, None), (2, body + "\n" + long, None, None, None)]
    rows += [(10 + i, x + "\n" + body, None, None, None) for i, x in enumerate(filler)]
    got = {r["doc_id"]: r["measures"] for r in quality_rules.measure(frame(spark, rows)).collect()}
    assert got[1]["kept"] and got[1]["clean_text"] == long
    assert got[2]["n_lines_removed"] == 0 and got[2]["clean_text"] == rows[1][1]
    assert all(got[10 + i]["clean_text"] == body for i in range(len(filler)))


def test_other_columns_and_empty_tables(spark):
    schema = "doc_id bigint, text string, _measures int, measures string, words string, _lines int"
    rows = frame(spark, [(1, plain(60), 5, "m", "w", 9)], schema)
    assert quality_rules.quality_rules(rows).collect()[0].asDict() == rows.collect()[0].asDict()
    assert quality_rules.quality_rules(rows.limit(0)).collect() == []


def test_licenses_are_found_whatever_their_spelling(spark):
    mit = licenses.KNOWN["MIT"]
    other = mit.replace("free of charge", "FREE   of\tcharge").replace("sublicense", "sub-licence")
    rows = [
        (1, mit, None, None, None),
        (2, "Copyright (c) 2020 Some One\n\n" + other.replace("\n\n", "\n \n"), None, None, None),
        (3, mit + " but not quite", None, None, None),
        (4, "Intro text.\nreleased under the MIT licence\nEnd.", None, None, None),
        (5, None, None, None, None),
        (6, "", None, None, None),
        (7, "Copyright 2020 X", None, None, None),
        (7, "Copyright 2020 X", None, None, None),
        (None, "Released under the MIT License.", None, None, None),
    ]
    out = licenses.license_scan(frame(spark, rows), licenses.known_licenses(spark)).collect()
    assert len(out) == len(rows)
    got = {r["doc_id"]: r for r in out}
    assert got[1]["license"] == got[2]["license"] == "MIT" and got[1]["text_digest"] == got[2]["text_digest"]
    assert got[3]["license"] is None and got[3]["text_digest"]
    assert got[4]["line_licenses"] == ["MIT notice"] and got[4]["n_license_lines"] == 1
    assert got[5]["text_digest"] is None and got[6]["text_digest"] is None and got[7]["text_digest"] is None
    assert got[None]["license"] == "MIT notice"
    assert licenses.license_scan(frame(spark, []), licenses.known_licenses(spark)).collect() == []


def rewrapped(text, width):
    return "\n\n".join("\n".join(textwrap.wrap(p, width, break_on_hyphens=False, break_long_words=False))
                       for p in text.split("\n\n"))


def test_licenses_are_found_however_they_are_wrapped(spark):
    texts = [(k, w) for k, text in licenses.KNOWN.items()
             for w in [rewrapped(text, n) for n in (30, 44, 58, 72, 79, 100, 10**6)] + [" ".join(text.split())]]
    rows = [(i, w, None, None, None) for i, (_, w) in enumerate(texts)]
    got = {r["doc_id"]: r["license"] for r in license_rows(spark, rows)}
    assert [got[i] for i in range(len(texts))] == [k for k, _ in texts]


def test_only_copyright_lines_are_dropped(spark):
    lines = ["Copyright (c) 2020 Some One", "(C) 1999-2003 A", "© 2020 B", "Copyright 2020, 2021 by C", "Copyright © D",
             "Copyright: Some Company Ltd.", "Copyright by The Authors of It", "Portions Copyright (C) E", "All rights reserved.",
             "copyright notice and this permission notice appear", "Copyright holders be liable", "COPYRIGHT OWNER OR CONTRIBUTORS",
             "(c) You must retain all notices", '"Copyright" also means laws like it']
    rows = [(i, x, None, None, None) for i, x in enumerate(lines)]
    rows.append((99, "the holders of the\nCopyright Some Name\nmust agree", None, None, None))
    got = {r["doc_id"]: r["text_digest"] for r in license_rows(spark, rows)}
    assert [got[i] is None for i in range(len(lines))] == [True] * 9 + [False] * 5
    assert got[99] == hashlib.sha256(b"theholdersofthecopyrightsomenamemustagree").hexdigest()


def test_standard_full_texts_are_known(spark):
    mit, bsd = licenses.KNOWN["MIT body"], licenses.KNOWN["BSD-3-Clause"].split("\n\n", 1)[1]
    with open(license_texts.FULL, encoding="utf-8") as file:
        full = {r["license"]: r["text"] for r in map(json.loads, file)}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0"} <= set(full)
    texts = list(full.items())
    texts += [("Apache-2.0 terms", full["Apache-2.0"].split("   APPENDIX")[0]), ("MPL-2.0 body", full["MPL-2.0"].split("\n\n", 1)[1]),
              ("GPL-3.0 body", full["GPL-3.0"].split("29 June 2007\n", 1)[1]), ("MPL-2.0", rewrapped(full["MPL-2.0"], 60)),
              ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2020 A\n\n" + mit), ("BSD-3-Clause body", bsd)]
    rows = [(i, x, None, None, None) for i, (_, x) in enumerate(texts)]
    got = {r["doc_id"]: r["license"] for r in license_rows(spark, rows)}
    named = [got[i] or "" for i in range(len(texts))]
    assert [n.replace(" unwrapped", "") for n in named] == [n.replace(" unwrapped", "") for n, _ in texts]


def license_rows(spark, rows):
    return licenses.license_scan(frame(spark, rows), licenses.known_licenses(spark)).collect()


def test_targets_reshare_what_small_sources_cannot_take():
    got = mixing.targets({"a": 100, "b": 100, "c": 1000, None: 0})
    # 1800 words by 5:2:1:5; a stops at 200, null at 0, b at 200, the rest would give c 1400.
    assert got == {"a": 200.0, None: 0.0, "b": 200.0, "c": 1400.0}
    assert mixing.targets({}) == {}


@pytest.fixture(scope="module")
def mixed(spark):
    rows = []
    for i in range(400):
        rows.append((i, plain(3 + (i * 37) % 120), "en", ["a", "b", "c", None, "d"][i % 5], i))
    rows += [(1000 + i, plain(10), "en", "hot", 1) for i in range(300)] + [(2000, "", "en", "a", 0), (2001, None, "en", "a", 0)]
    docs = frame(spark, rows)
    return docs, mixing.sized(docs, "doc_id")


def test_mix_meets_its_targets(spark, mixed):
    docs, rows = mixed
    from pyspark.sql import functions as F
    plan = mixing.plan(rows)
    out = mixing.copies_of(rows, plan).collect()
    again = mixing.copies_of(rows, mixing.plan(rows)).collect()
    assert len(out) == 702 and sorted(map(str, out)) == sorted(map(str, again))
    for s in ("a", "b", "c", "d", "hot", None):
        mine = [r for r in out if r["source"] == s]
        taken = sum(r["_copies"] * r["_size"] for r in mine)
        assert abs(taken - mine[0]["_target"]) <= 5, (s, taken, mine[0]["_target"])
        assert mine[0]["_source_size"] == sum(r["_size"] for r in mine)
        assert all(0 <= r["_copies"] <= 2 for r in mine)
    total = sum(r["_size"] for r in out)
    assert abs(sum({r["source"]: r["_target"] for r in out}.values()) - 1.5 * total) < 1e-6 * total
    copies = mixing.mix(docs)
    assert copies.columns == docs.columns
    assert copies.count() == sum(r["_copies"] for r in out)
    assert copies.agg(F.max("n_chars")).collect()[0][0] == 399


def test_mix_of_ties_and_nothing(spark):
    assert mixing.mix(frame(spark, [])).collect() == []
    same = frame(spark, [(7, plain(10), None, "x", 1)] * 9 + [(None, plain(4), None, "y", 1)] * 5,
                 DOCS.replace("lang", "_size"))
    out = mixing.mix(same)
    assert out.columns == same.columns
    # 110 words: x gets 5/7 and y 2/7 of 165, within half a document; y stops at twice its 20.
    assert mixing.targets({"x": 90, "y": 20}) == {"x": 125.0, "y": 40.0}
    assert out.where("doc_id = 7").count() in (12, 13) and out.where("doc_id IS NULL").count() == 10
    empty = frame(spark, [(1, None, None, None, None), (2, "", None, "a", 0)])
    assert mixing.mix(empty).count() == 2


def test_equal_rows_and_null_ids_reach_their_targets(spark):
    for n, doc_id in ((300, None), (300, 5)):
        docs = frame(spark, [(doc_id, plain(10), None, s, i) for s in "xyz" for i in range(n)])
        counts = {r["source"]: r["count"] for r in mixing.mix(docs).groupBy("source").count().collect()}
        wanted = mixing.targets({s: 10 * n for s in "xyz"})
        assert all(abs(10 * counts.get(s, 0) - wanted[s]) <= 10 for s in "xyz"), (counts, wanted)


def test_rates_solve_the_dual(spark, mixed):
    """The copies of each size are the tilted rates, found by bisection, but for rounding."""
    _, rows = mixed
    sizes, docs = {}, {}
    for r in rows.collect():
        sizes.setdefault(r["source"], []).append(r["_size"])
    for s, mine in sizes.items():
        docs[s] = len(mine)
    totals = {s: sum(mine) for s, mine in sizes.items()}
    wanted = mixing.targets(totals)
    cells = rows.groupBy("source", "_size").count().withColumnRenamed("count", "_n")
    tilts = mixing.balance(cells, totals, docs, wanted)
    for s, mine in sizes.items():
        mean = totals[s] / docs[s]

        def words(tilt):
            return sum(2 * z / (1 + math.exp(-max(-700.0, min(700.0, tilt * z / mean)))) for z in mine)

        if wanted[s] >= 2 * totals[s] * (1 - 1e-9):
            assert tilts[s] == math.inf
            continue
        low, high = -500.0, 500.0
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if words(middle) < wanted[s] else (low, middle)
        assert abs(tilts[s] - low) < 1e-6 and abs(words(tilts[s]) - wanted[s]) < 1e-6 * wanted[s]


def test_sql_counts_filler_by_stretches(spark):
    """Long lines of few and of many distinct words: the operator and its SQL agree."""
    import duckdb

    lines = [" ".join(f"w{(i * i) % m}" for i in range(n)) for n in (100, 127, 128, 129, 300, 1000) for m in (7, 60, 97, 400)]
    lines += ["Home | About | Contact", "please accept all cookies now", "What?? Really!! no", "a » b » c » d"]
    docs = frame(spark, [(i, plain(60) + "\n" + line, None, None, 0) for i, line in enumerate(lines)] + [(99, None, None, None, 0)])
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.sql(f"SELECT doc_id, kept, n_lines_removed, clean_chars FROM ({quality_rules.OP8_SQL})").fetchall()
    got = [
        (r["doc_id"], r["measures"]["kept"], r["measures"]["n_lines_removed"], r["measures"]["clean_chars"])
        for r in quality_rules.measure(docs).collect()
    ]
    assert sorted(got) == sorted(want)
    assert {k for _, _, k, _ in got} == {0, 1}


def test_license_sql_is_the_operator(spark):
    """Every known text, rewrapped and under copyright lines of all kinds: operator and SQL agree."""
    import duckdb

    from compare import difference

    heads = ["", "Copyright (c) 2020 Jane Doe\n\n", "Copyright Jane Doe and the Authors\n\n", "copyright notice of ours\n",
             "(c) Some Company\nAll rights reserved.\n\n", "Portions Copyright 1999, 2001 X\n", "Copyright holders gave us this.\n\n"]
    rows = []
    for i, (_, text) in enumerate(license_texts.all_texts()):
        if len(text) < 4000:
            rows.append((i, heads[i % len(heads)] + text, None, None, 0))
            wrapped = "\n\n".join(textwrap.fill(p, 40 + i % 30) for p in text.split("\n\n"))
            rows.append((1000 + i, heads[(i + 3) % len(heads)] + wrapped, None, None, 0))
            rows.append((2000 + i, heads[(i + 5) % len(heads)] + " ".join(text.split()) + "\nÉté ©\n© Ümit", None, None, 0))
        else:
            rows.append((i, text, None, None, 0))
    rows += [(9000, None, None, None, None), (9001, "", None, None, 0), (9002, "© \ncopyright the notice\n(C) by IBM", None, None, 0)]
    docs = frame(spark, rows)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    out = licenses.license_scan(docs, licenses.known_licenses(spark)).withColumn("line_licenses", quality_rules.F.array_join("line_licenses", ","))
    assert difference(out, con, licenses.OP5_SQL) == ""
    assert out.where("license IS NOT NULL").count() > 60
