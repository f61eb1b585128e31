import random

import numpy as np

from quarry.llm import decontam
from quarry.llm.shingles import word_hashes
from tests.llm.test_near_dedup import words
from tests.llm.util import edge_rows


def brute_tiles(text, item, least=5):
    """Greedy string tiling as in its definition, on lists of words."""
    open_t, open_p, out = [True] * len(text), [True] * len(item), []
    while True:
        best, found = least, []
        for x in range(len(text)):
            for y in range(len(item)):
                n = 0
                while x + n < len(text) and y + n < len(item) and text[x + n] == item[y + n] and open_t[x + n] and open_p[y + n]:
                    n += 1
                if n > best:
                    best, found = n, [(x, y)]
                elif n == best:
                    found.append((x, y))
        if not found:
            return out
        for x, y in found:
            if all(open_t[x:x + best]) and all(open_p[y:y + best]):
                for k in range(best):
                    open_t[x + k] = open_p[y + k] = False
                out.append((x, y, best))


def test_tiles_match_the_definition():
    rng = random.Random(1)
    for _ in range(150):
        letters = "ab" if rng.random() < 0.5 else "abcd"
        item = [rng.choice(letters) for _ in range(rng.randint(5, 25))]
        text = [rng.choice(letters) for _ in range(rng.randint(0, 20))] + item[rng.randint(0, 9):] + [rng.choice(letters)] + item[: rng.randint(0, 12)]
        want = brute_tiles(text, item)
        block = decontam.Items([(1, " ".join(item))])
        got = list(block.matches(word_hashes(" ".join(text))))
        assert got == ([(0, sum(n for *_, n in want), len(want))] if want else [])


def item_text(k, n=40):
    return " ".join(f"i{k}w{j}" for j in range(n))


def test_reordered_passages_and_edges(spark):
    a = item_text(1).split()
    filler = " ".join(f"f{k}" for k in range(200))
    docs = [(1, f"{filler} {' '.join(a).upper()} {filler}"), (2, f"{' '.join(a[20:])} {filler}\n{' '.join(a[:20])}"), (3, f"{' '.join(a[:25])} {filler}"),
            (4, " ".join(x for k in range(0, 40, 4) for x in a[k:k + 4] + ["z"])), (None, " ".join(a)), (1, "clean text"), (5, None), (6, "")]
    items = [(1, " ".join(a)), (2, item_text(2)), (3, "a b c d"), (4, None), (None, item_text(7)), (9, "")]
    docs += [(100 + k, r[1]) for k, r in enumerate(edge_rows())]
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, version string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id or -1, r.item_id, r.n_words, r.n_covered, r.n_tiles) for r in decontam.contaminated(d, b).collect())
    assert got == [(-1, 1, 40, 40, 1), (1, 1, 40, 40, 1), (2, 1, 40, 40, 2)]
    kept = decontam.drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted([1, 3, 4, 5, 6, *range(100, 100 + len(edge_rows()))])


def test_blocks_of_items_give_the_same(spark, small_dir):
    docs, bench = (spark.read.parquet(f"{small_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    one, many = (sorted(map(tuple, decontam.overlaps(docs, bench, n).collect())) for n in (decontam.BLOCK_BYTES, 3000))
    assert one == many and one
    texts, items = dict(docs.select("doc_id", "text").collect()), dict(bench.select("item_id", "text").collect())
    for doc, _, item, n, covered, count in one[:12]:
        want = brute_tiles(words(texts[doc])[:1500], words(items[item]))
        if len(words(texts[doc])) <= 1500:
            assert (n, covered, count) == (len(words(items[item])), sum(x[2] for x in want), len(want))


def test_sections(monkeypatch):
    monkeypatch.setattr(decontam, "SECTION", 50)
    item, text = item_text(1), " ".join(f"f{k}" for k in range(80)) + " " + item_text(1) + " end " * 60
    assert [x[1] for x in decontam.Items([(1, item)]).matches(word_hashes(text))] == [40]
    assert np.array_equal(word_hashes("a b"), word_hashes(" A\tb "))


def test_longest_first_over_all_sections(monkeypatch):
    monkeypatch.setattr(decontam, "SECTION", 100)
    filler = lambda a, n: [f"f{k}" for k in range(a, a + n)]
    for n, lo, hi in ((15, 4, 9), (13, 4, 9), (40, 3, 30)):
        item = item_text(1, n).split()
        for text in (filler(0, 20) + item[lo:hi] + filler(50, 100) + item + filler(200, 30), filler(0, 20) + item + filler(50, 100) + item[lo:hi], filler(0, 92) + item):
            assert list(decontam.Items([(1, " ".join(item))]).matches(word_hashes(" ".join(text)))) == [(0, n, 1)]


def test_sections_change_nothing(monkeypatch):
    monkeypatch.setattr(decontam, "SECTION", 7)
    rng = random.Random(2)
    for _ in range(150):
        letters = "ab" if rng.random() < 0.5 else "abcd"
        items = [[rng.choice(letters) for _ in range(rng.randint(5, 25))] for _ in range(2)]
        text = [w for _ in range(4) for w in [rng.choice(letters + "xyz") for _ in range(rng.randint(0, 9))] + items[rng.randint(0, 1)][rng.randint(0, 9): rng.randint(9, 25)]]
        want = [(k, sum(n for *_, n in got), len(got)) for k, got in enumerate(brute_tiles(text, i) for i in items) if got]
        assert list(decontam.Items(list(enumerate(map(" ".join, items)))).matches(word_hashes(" ".join(text)))) == want


def test_empty_tables(spark, no_docs):
    bench = spark.createDataFrame([(1, item_text(1))], "item_id long, text string")
    assert decontam.contaminated(no_docs, bench).collect() == []
    docs = spark.createDataFrame([(1, item_text(1))], "doc_id long, text string")
    assert decontam.contaminated(docs, bench.limit(0)).collect() == []
