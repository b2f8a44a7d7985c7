"""Importance resampling, centroid clustering and personal data against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from tallyfold.llm import centroids, importance, personal

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words_in(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def features_in(text):
    words = words_in(text)
    return [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute_resample(docs, target, buckets=10_000):
    def counted(texts):
        return Counter(crc32(f.encode()) % buckets for t in texts for f in features_in(t))

    s, t = counted(x for _, x in docs), counted(target)
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
            for b in range(buckets)]
    rows = []
    for i, text in docs:
        found = features_in(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[crc32(f.encode()) % buckets] for f in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(words_in(text)), len(found), weight, score, None])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: len(able) * 5 // 100]):
        row[5] = place + 1
    return sorted(map(tuple, rows), key=str)


def test_resampling_equals_brute_force(spark):
    r = random.Random(3)
    vocabulary = ["Apple", "été", "x1", "ß", "the", "of", "2024", "naïve", "日本", "_under", "a-b"]
    docs = [(i, r.choice([" ", ", ", "\n"]).join(r.choices(vocabulary, k=r.randint(0, 60)))) for i in range(300)]
    docs += [(7, None), (8, ""), (9, "?!"), (None, "apple of " * 30), (None, "of the " * 30)]
    docs += [(5, "same words again and " * 10)] * 120 + [(None, "apple the " * 20)] * 50
    target = ["Apple of the été 2024", None, "", "x1 x1 x1"]
    frame = spark.createDataFrame([(i, t, None, "s", 1) for i, t in docs], DOCS)
    aims = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    got = importance.resample(frame, aims)
    assert sorted(map(tuple, got.collect()), key=str) == brute_resample(docs, target)


def test_resampling_of_nothing(spark):
    empty, none = spark.createDataFrame([], DOCS), spark.createDataFrame([], "item_id bigint, text string")
    assert importance.resample(empty, none).collect() == []
    rows = [(1, "a b c " * 10, None, None, 1)]
    got = importance.resample(spark.createDataFrame(rows, DOCS), none).collect()
    assert [tuple(r) for r in got] == brute_resample([(1, rows[0][1])], [])


@pytest.mark.parametrize("size", [1, 5, 17, 1000])
def test_stretches_change_no_checksum(size):
    r = random.Random(size)
    for _ in range(200):
        raw = "".join(r.choices("ab é.Z9\n", k=r.randint(0, 80))).encode()
        parts = list(importance.checksums(raw, size))
        assert sum(n for n, _ in parts) == len(words_in(raw.decode()))
        assert Counter(c for _, found in parts for c in found) == Counter(
            crc32(f.encode()) for f in features_in(raw.decode()))


def brute_clusters(rows, count=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in first[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for k, members in groups.items():
            centres[k] = [sum(x) // len(members) for x in zip(*members)]
    best = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, k in best:
        inertia[k] += d
    return sorted(((i, k, d, inertia[k], sum(inertia.values()),
                    hashlib.sha256(",".join(map(str, centres[k])).encode()).hexdigest()) for i, d, k in best), key=str)


def test_clusters_equal_brute_force(spark):
    r = random.Random(5)
    rows = [(i, [r.gauss(i % 3, 0.2) for _ in range(64)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(5, rows[5][1])] * 30 + [(None, rows[9][1]), (None, [0.0] * 64)]
    rows += [(1, None), (2, []), (3, [1.0] * 63), (4, [float("nan")] + [0.0] * 63), (6, [None] + [0.0] * 63),
             (7, [float("inf")] * 64), (8, [-float("inf")] * 64), (9, [-0.001] * 64)]
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id bigint, embedding array<float>, cluster int, low string")
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = centroids.cluster(frame)
    assert sorted(map(tuple, got.collect()), key=str) == brute_clusters(exact)


def test_clusters_of_few_and_of_huge_vectors(spark):
    schema = "vec_id bigint, embedding array<double>"
    assert centroids.cluster(spark.createDataFrame([], schema)).collect() == []
    rows = [(i, [float(i)] * 64) for i in range(3)]
    got = centroids.cluster(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, got.collect()), key=str) == brute_clusters(rows)
    huge = [(i, [1e300 if i % 2 else -1e300] * 64) for i in range(40)] + [(50, [0.0] * 64)]
    rows = centroids.cluster(spark.createDataFrame(huge, schema)).collect()
    assert len(rows) == 41 and all(row["distance"] >= 0 for row in rows)
    big = [(i, [float(i * 90_000 % 1_900_000 - 900_000)] * 64) for i in range(60)]
    got = centroids.cluster(spark.createDataFrame(big, schema))
    assert sorted(map(tuple, got.collect()), key=str) == brute_clusters(big)


def test_boxes_leave_out_no_nearest_centroid():
    r = np.random.default_rng(1)
    centres = r.integers(-30, 30, (16, 64))
    low = r.integers(-30, 25, (50, 64))
    high = low + r.integers(0, 6, (50, 64))
    open_ = centroids.candidates(low, high, centres)
    for box in range(50):
        inside = r.integers(low[box], high[box] + 1, (200, 64))
        best, _ = centroids.nearest(inside, centres)
        assert open_[box][best].all()
    point = centroids.candidates(centres, centres, centres)
    assert (point.sum(axis=1) == 1).all()


def test_curve_visits_neighbours():
    side = 1 << 3
    cells = np.array([(a, b, c) for a in range(side) for b in range(side) for c in range(side)])
    order = centroids.hilbert_position(cells, 3)
    assert sorted(order) == list(range(side**3))
    path = cells[np.argsort(order)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def brute_personal(text):
    spans = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 8 <= len(digits) <= 15
            ):
                spans.append((kind, *m.span()))
    return spans


def test_plain_kinds_equal_their_patterns():
    r = random.Random(1)
    parts = [*'a1b2.@-+ 0(9)%é"4:', "4111111111111111", "1.2.3.4", "a@b.cd", "+1", "DE8", "::", "tel:", "ssn"]
    for _ in range(20_000):
        text = "".join(r.choices(parts, k=r.randint(1, 40)))
        assert [s for s in personal.personal_spans(text) if s[0] in personal.BASE] == brute_personal(text), text


def test_personal_data_of_every_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in personal.personal_data(docs).collect():
        want = brute_personal(texts[row["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row["n_" + k] for k in PATTERNS] == [sum(s[0] == k for s in want) for k in PATTERNS]
        assert set(joined.split(",")) <= set(row["spans"].split(","))


@pytest.mark.parametrize("text, kind, found", [
    ("IBAN DE89 3704 0044 0532 0130 00.", "iban", "DE89 3704 0044 0532 0130 00"),
    ("to GB82WEST12345698765432 now", "iban", "GB82WEST12345698765432"),
    ("jörg.müller@firma.de x", "intl", "jörg.müller@firma.de"),
    ("max@müller.example.de", "intl", "max@müller.example.de"),
    ('"john doe"@example.com', "intl", '"john doe"@example.com'),
    ("see https://bob:word@host.org/x", "login", "bob:word"),
    ("href='tel:030-1234567'", "tel", "030-1234567"),
    ("host 2001:4860:4860::8888 up", "ip6", "2001:4860:4860::8888"),
    ("SSN: 536-90-4399", "account", "536-90-4399"),
    ("Account number is 12345678 and", "account", "12345678"),
    ("Kontonummer: 0532013000", "account", "0532013000"),
    ("número de cuenta 1234 5678 90", "account", "1234 5678 90"),
])
def test_added_kinds_have_exact_borders(text, kind, found):
    start = text.index(found)
    assert (kind, start, start + len(found)) in personal.personal_spans(text)


@pytest.mark.parametrize("text", [
    "DE89 3704 0044 0532 0130 01", "std::vector::b::c", "12:30:45", "00:1A:2B:3C:4D:5E", "ssn 000-12-3456", "fe80::1:2:3",
    "account number of customers grew", "the tax id form", "a@b", "@name", "https://host.org/path@x", "x DE1 DE2 FR3",
    "IBAN", "passport no", "::1", "tel: none", "C++ and 1+1=2", "version 1.2.3", "8 000 000 000",
])
def test_clean_texts_have_no_span(text):
    assert personal.personal_spans(text) == []


@pytest.mark.parametrize("unit", ["1", "1 ", "1.", "a@", "é@a.b", "+1", "tel:1", "DE8", "::1", "ssn 1", "https://a", '"@'])
def test_a_megabyte_of_anchors_takes_seconds(unit):
    start = time.perf_counter()
    personal.personal_spans(unit * (1_000_000 // len(unit)))
    assert time.perf_counter() - start < 8


def test_personal_data_of_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", None, None, 0), (3, "a@b.cd", None, None, 6), (3, "a@b.cd", None, None, 6)]
    got = personal.personal_data(spark.createDataFrame(rows, DOCS).withColumn("spans", personal.F.lit(1))).collect()
    assert sorted((r["doc_id"], r["n_email"], r["spans"]) for r in got) == [
        (1, 0, ""), (2, 0, ""), (3, 1, "email:0:6"), (3, 1, "email:0:6")]
    assert personal.personal_data(spark.createDataFrame([], DOCS)).collect() == []
