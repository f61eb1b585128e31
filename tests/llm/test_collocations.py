import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from quarry.llm import collocations as C
from tests.llm.util import edge_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, threshold, longest, first):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    f = {k: v for k, v in f.items() if v >= threshold}
    most = Counter()
    for (lang, w), a in f.items():
        for z in range(2, len(w)):
            for i in range(len(w) - z + 1):
                most[lang, w[i:i + z]] = max(most[lang, w[i:i + z]], a)
    found = {}
    for (lang, w), a in f.items():
        if len(w) > 1 and most[lang, w] < a:
            score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, v in found.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:first], 1))


def run(spark, rows, threshold=3, longest=5, first=2000):
    df = spark.createDataFrame([(t, g, "p", 1, "s") for t, g in rows], "text string, lang string, phrase string, n int, words string").repartition(3)
    return sorted(tuple(r) for r in C.collocations(df, threshold, longest, first).collect())


def fixture():
    rng = random.Random(12)
    words = ["a", "New", "york", "é", "new", "x\x1cy", "\x00", "don't", "漢字", "of"]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", ".", "\n", "\t", "\r\n", "!?"]) for _ in range(rng.randrange(0, 60))) for _ in range(60)]
    return [(t, rng.choice(["en", "fr", None, "und", ""])) for t in texts] + [(None, "en"), ("", None), (None, None), (texts[0], "en"), (texts[0], "en")]


def test_brute_force(spark):
    rows = fixture() + [(r[1], "en") for r in edge_rows()]
    for threshold, longest, first in ((3, 5, 2000), (1, 3, 7), (100, 5, 2000)):
        assert run(spark, rows, threshold, longest, first) == brute(rows, threshold, longest, first)


def test_many_hash_partitions_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(C, "PARTITION_MASS", 200)
    monkeypatch.setattr(C, "PIECE_KEYS", 10)
    rows = fixture()
    assert run(spark, rows) == brute(rows, 3, 5, 2000)


def test_chunks_do_not_change_counts():
    batch = pa.record_batch([pa.array([t for t, _ in fixture()]), pa.array([g for _, g in fixture()], pa.string())], names=["text", "lang"])
    def counted(words):
        out = Counter()
        for chunk in C.chunks(iter([batch]), words):
            for n, places, times in chunk.lengths(5):
                out.update({(chunk.lang_names[chunk.lang[p]], chunk.phrase(n, p)): t for p, t in zip(places.tolist(), times.tolist())})
        return out
    assert counted(10**6) == counted(1) == counted(100)


def test_summaries_keep_every_frequent_key():
    rng = np.random.default_rng(3)
    for capacity_factor in (1, 2):
        keys = np.concatenate([rng.integers(0, 2**40, 20_000, dtype=np.uint64), np.repeat(np.arange(9, dtype=np.uint64), 150)])
        rng.shuffle(keys)
        threshold = 100
        summary = C.Summary(capacity_factor * len(keys) // threshold + 1)
        for part in np.array_split(keys, 40):
            distinct, counts = np.unique(part, return_counts=True)
            summary.merge(*C.unpack(C.pack(distinct, counts)))
        summary.settle()
        assert len(summary.keys) <= summary.capacity and summary.taken <= len(keys) / (summary.capacity + 1)
        assert set(range(9)) <= set(summary.keys[summary.counts >= max(1, threshold - summary.taken)].tolist())
        assert len(summary.keys) < 2000


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = fixture()
    monkeypatch.setattr(C, "survivors", lambda *a: np.full(2, 255, np.uint8))
    assert run(spark, rows) == brute(rows, 3, 5, 2000)


def test_products_beyond_64_bits(spark):
    grams = spark.createDataFrame([("en", 1, "a", 3 * 10**11), ("en", 1, "b", 2 * 10**11), ("en", 2, "a b", 10**11)], "lang string, words int, phrase string, f long")
    totals = spark.createDataFrame([("en", 9 * 10**17)], "lang string, n long")
    saved, C.frequent_ngrams = C.frequent_ngrams, lambda *a: (grams, totals)
    try:
        (row,) = C.collocations(None).collect()
    finally:
        C.frequent_ngrams = saved
    assert row.score == 1000 * 10**11 * 9 * 10**17 // (3 * 10**11 * 2 * 10**11)


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
