import itertools
import random

import numpy as np

from quarry.llm import near_dedup, shingles
from tests.llm.util import edge_rows


def words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            out += [word] * bool(word)
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    return out


def shingle_set(text):
    w = words(text)
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Per id (n_shingles, component) of rows with distinct ids."""
    sets = {d: shingle_set(t) for d, t in rows}
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for x, y in itertools.combinations(sorted(sets), 2):
        if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
            a, b = sorted((find(x), find(y)))
            top[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()}


def test_groups_chains_and_edges(spark):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, r[1]) for k, r in enumerate(edge_rows()[:22])]
    for k in range(30):  # a chain: each is near the one before, the ends are not alike
        base = base[2:] + [f"x{k}a", f"x{k}b"]
        rows.append((100 + k, " ".join(base)))
    for k in range(40):  # near copies of one text, many of them unlike one another
        copy = [f"c{j}" for j in range(150)]
        for at in rng.sample(range(150), 3):
            copy[at] = f"d{rng.random()}"
        rows.append((200 + k, " ".join(copy)))
    rows += [(300 + k, "the same short text in many rows of the table") for k in range(20)]
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c\nd e f"), (None, "a b c d e f"), (None, None), (3, None)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (None, 2, None, True), (None, 0, None, True)]))
    kept = near_dedup.drop_near_duplicates(spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, sig string"))
    assert kept.columns == ["doc_id", "text", "sig"] and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 1, 3]


def test_hashes_of_long_texts_and_words():
    long_word, text = "q" * 200_000, "ab cd " * 40_000
    one, two = shingles.word_hashes(f"x {long_word} y"), shingles.word_hashes(f"{long_word}z {long_word} x")
    assert len(one) == 3 and one[0] == two[2] and one[1] == two[1] and two[0] != two[1]
    assert len(np.unique(shingles.word_hashes(text))) == 2 and len(shingles.word_hashes(text)) == 80_000
    assert shingles.word_hashes("ABC é")[0] == shingles.word_hashes("\nabc\x0b")[0]
    assert shingles.word_hashes("É")[0] != shingles.word_hashes("é")[0]


def test_recall_of_the_tables():
    """Pairs just above the limit meet in a table nearly always."""
    rng, met = np.random.default_rng(5), 0
    for _ in range(300):
        both, a, b = (rng.integers(0, 2**63, size=n, dtype=np.uint64) for n in (300, 48, 48))
        keys = [near_dedup.sub_keys(np.unique(np.concatenate([both, x]))) for x in (a, b)]
        met += all(set(keys[0][c]) & set(keys[1][c]) for c in (0, 1))
    assert met >= 297


def test_empty_table(spark, no_docs):
    assert near_dedup.near_duplicates(no_docs).collect() == []
