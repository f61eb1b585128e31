"""Queries that must not change or lose anything on the way: nesting, refusal, sloppy phrases, several indexes."""

import itertools
import random
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quarry.operators import search as S
from quarry.operators.index import build_index, read_index, write_index
from quarry.plans.corpus import LETTERS
from quarry.plans.retrieval import clause_rows
from test_search import index, run


def nested(depth, leaf):
    """MUST group in MUST group ... around ``leaf``, next to a clause that all documents but 4 match."""
    rows = [{"query_id": 1, "clause_id": 1, "field": "body", "text": "alpha gamma", "occur": "MUST"}]
    for d in range(depth):
        rows.append({"query_id": 1, "clause_id": 10 + d, "group_id": 9 + d if d else 0, "kind": "group", "occur": "MUST"})
    return [*rows, {"query_id": 1, "clause_id": 5, "group_id": 9 + depth, "occur": "MUST", **leaf}]


def test_groups_of_any_depth(spark):
    got = run(spark, nested(10, {"text": "beta"}))
    assert {d for _, d in got} == {1, 3, 5}


def test_depths_circles_and_lost_groups(spark):
    rows = nested(9, {"text": "x"}) + [
        {"query_id": 2, "clause_id": 1, "group_id": 2, "kind": "group"}, {"query_id": 2, "clause_id": 2, "group_id": 1, "kind": "group"},
        {"query_id": 2, "clause_id": 3, "group_id": 2, "text": "alpha"}, {"query_id": 3, "clause_id": 1, "group_id": 7, "text": "alpha"}, {"query_id": 4, "clause_id": 1, "text": "alpha"}]
    clauses = clause_rows(spark, [{**r, "index": "t"} for r in rows])
    depth = {(r.query_id, r.clause_id): r.depth for r in S.clause_depths(clauses).collect()}
    assert [depth[1, c] for c in (1, 10, 11, 18, 5)] == [0, 0, 1, 8, 9]
    assert [depth[2, c] for c in (1, 2, 3)] == [None] * 3 and depth[3, 1] is None and depth[4, 1] == 0
    valid, rejected = S.validate_clauses(clauses, ["t"])
    assert {r.query_id for r in valid.collect()} == {1, 4} and {r.query_id for r in rejected.collect()} == {2, 3}


def test_a_wrong_clause_refuses_the_whole_query(spark):
    for wrong in ({"text": "  "}, {"kind": "fuzzy", "text": "beta", "max_edits": 3}, {"kind": "nonsense", "text": "x"}):
        rows = [{"query_id": 1, "clause_id": 1, "text": "alpha", "occur": "MUST"}, {"query_id": 1, "clause_id": 2, "occur": "MUST", **wrong},
                {"query_id": 2, "clause_id": 1, "text": "zeta"}]
        assert set(run(spark, rows)) == {(2, 3)}


def test_one_search_over_indexes_with_other_id_types(spark):
    tables = spark.createDataFrame([("p_S1.T1", "alpha table"), ("p_S1.T2", "beta table")], "id string, caption string")
    both = {"t": index(spark), "tables": build_index("tables", tables, "id", {"caption": F.col("caption")}, LETTERS, ["caption"])}
    rows = [{"query_id": 1, "clause_id": 1, "index": name, "text": "alpha"} for name in both]
    got = [(r["index"], r.doc_id) for r in S.search(both, clause_rows(spark, rows)).orderBy("index", "rank").collect()]
    assert ("tables", "p_S1.T1") in got and {d for i, d in got if i == "t"} == {"1", "2", "5"}


def brute(words, phrase, slop):
    """Per place of the first word, the least spread over all ways to give each word its own position."""
    total = 0.0
    for anchor in (k for k, w in enumerate(words) if w == phrase[0]):
        spots = [[k for k, w in enumerate(words) if w == q] for q in phrase[1:]]
        spreads = []
        for way in itertools.product(*spots):
            if len({anchor, *way}) == len(phrase):
                shifts = [0, *(p - k - 1 - anchor for k, p in enumerate(way))]
                spreads.append(max(shifts) - min(shifts))
        if spreads and min(spreads) <= slop:
            total += 1 / (1 + min(spreads))
    return total


def test_sloppy_frequency_matches_brute_force(spark):
    rng = random.Random(4)
    docs = {k: [rng.choice("abc") for _ in range(rng.randint(1, 9))] for k in range(120)}
    phrases = [([rng.choice("abc") for _ in range(rng.randint(2, 4))], rng.randint(1, 4)) for _ in range(12)]
    keys = ["query_id", "clause_id", "field", "doc_id"]
    occ = [(n, 1, "f", d, q, p, p - q, len(phrase), slop) for n, (phrase, slop) in enumerate(phrases) for d, words in docs.items()
           for q, t in enumerate(phrase) for p, w in enumerate(words) if w == t]
    rows = spark.createDataFrame(occ, "query_id long, clause_id int, field string, doc_id long, qpos int, pos int, rel int, n_terms int, slop int")
    rows = rows.select("*", F.lit(9).alias("dl"), F.lit(1.0).alias("boost"), F.lit(5.0).alias("avgdl"))
    got = {(r.query_id, r.doc_id): round(r.freq, 9) for r in S._sloppy_hits(rows, keys).collect()}
    want = {(n, d): round(brute(words, phrase, slop), 9) for n, (phrase, slop) in enumerate(phrases) for d, words in docs.items()}
    assert got == {k: v for k, v in want.items() if v} and len(got) > 100


def test_sloppy_phrases_of_three_and_repeated_words(spark):
    docs = spark.createDataFrame([(1, "x a c x b c"), (2, "the end"), (3, "the big the")], "doc_id long, text string")
    idx = build_index("t", docs, "doc_id", {"body": F.col("text")}, LETTERS, ["body"], True)
    rows = [{"query_id": q, "clause_id": 1, "index": "t", "field": "body", "kind": "phrase", "text": t, "slop": n} for q, t, n in ((1, "a b c", 2), (2, "the the", 1))]
    assert {(r.query_id, r.doc_id) for r in S.search({"t": idx}, clause_rows(spark, rows)).collect()} == {(1, 1), (2, 3)}


def edits(a, b):
    """Levenshtein distance, or one more than that of ``a`` with two neighbours swapped."""
    def plain(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            last, row[0] = row[0], i
            for j, d in enumerate(y, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
        return row[-1]
    return min([plain(a, b)] + [1 + plain(a[:i] + a[i + 1] + a[i] + a[i + 2:], b) for i in range(len(a) - 1)])


def test_fuzzy_candidates_lose_no_term(spark):
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("ab\u00e9") for _ in range(rng.randint(1, 7))) for _ in range(300)})
    vocab = spark.createDataFrame([("f", w) for w in words], "field string, term string")
    rows = [(n, 1, "f", 1.0, e, 0, q, len(q)) for n, (q, e) in enumerate(itertools.product(rng.sample(words, 25), (0, 1, 2)))]
    q = spark.createDataFrame(rows, "query_id long, clause_id int, field string, boost double, max_edits int, qpos int, qterm string, qlen int")
    found = {(r.query_id, r.term) for r in S._fuzzy_candidates(vocab, q).collect()}
    assert {(n, t) for n, _, _, _, e, _, x, _ in rows for t in words if edits(x, t) <= e} <= found


def test_patterns_meet_every_term_they_match(spark):
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abz\u00e9\U0001F600") for _ in range(rng.randint(1, 6))) for _ in range(400)})
    vocab = spark.createDataFrame([("f", w) for w in words], "field string, term string")
    clauses, want = [], set()
    def clause(kind, test, pat=None, lo=None, hi=None, incl=True):
        n = len(clauses)
        clauses.append((n, 1, "f", kind, 1.0, pat, lo, hi, incl, incl))
        want.update((n, w) for w in words if test(w))
    for p in ("", "a", "ab", "abz", "\u00e9", "\U0001F600a"):
        clause("prefix", lambda w, p=p: w.startswith(p), p)
    for p in ("*", "?", "a*", "*aba*", "?bab*", "*ab?", "ab*za", "*abz*aab*"):
        r = re.compile(p.replace("*", ".*").replace("?", "."))
        clause("wildcard", lambda w, r=r: r.fullmatch(w), p)
    for p in (".*aba.*", "aba?.*", "ab+a.*", "(ab|za).*", "[az]b.*", "aab*", "\u00e9.*", "a.{2}"):
        r = re.compile(p)
        clause("regexp", lambda w, r=r: r.fullmatch(w), p)
    for lo, hi, incl in (("a", "b", True), ("a", "b", False), (None, "ab", True), ("z", None, False), (None, None, True), ("b", "a", True), ("aba", "abz", True)):
        inside = lambda w, lo=lo, hi=hi, incl=incl: (lo is None or w > lo or incl and w == lo) and (hi is None or w < hi or incl and w == hi)
        clause("range", inside, None, lo, hi, incl)
    q = spark.createDataFrame(clauses, "query_id long, clause_id int, field string, kind string, boost double, pat string, lo_n string, hi_n string, incl_lo boolean, incl_hi boolean")
    got = [(r.query_id, r.term) for r in S._expansion_terms(vocab, q).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_shuffle_joins_give_the_same(spark, monkeypatch):
    rows = [{"query_id": 1, "clause_id": 1, "text": "alpha gamma"}, {"query_id": 2, "clause_id": 1, "kind": "phrase", "text": "alpha gamma", "slop": 1},
            {"query_id": 3, "clause_id": 1, "kind": "wildcard", "text": "*amm*"}, {"query_id": 4, "clause_id": 1, "kind": "prefix", "text": "e"},
            {"query_id": 5, "clause_id": 1, "kind": "fuzzy", "text": "detla epsilon", "max_edits": 2}, {"query_id": 6, "clause_id": 1, "kind": "all"}]
    small = run(spark, rows)
    monkeypatch.setattr(S, "BROADCAST_MAX_ROWS", 0)
    large = run(spark, rows)
    assert {k: round(v, 9) for k, v in small.items()} == {k: round(v, 9) for k, v in large.items()} and {q for q, _ in small} == {1, 2, 3, 4, 5, 6}


def test_a_written_index_answers_alike_and_reads_only_its_terms_partitions(spark, tmp_path):
    idx = index(spark)
    write_index(idx, str(tmp_path / "i"), buckets=16)
    back = read_index(spark, str(tmp_path / "i"))
    assert back.positions is not None and back.buckets == 16
    rows = [{"query_id": 1, "clause_id": 1, "index": "t", "field": "body", "text": "alpha gamma"},
            {"query_id": 2, "clause_id": 1, "index": "t", "field": "body", "kind": "phrase", "text": "alpha gamma", "slop": 1},
            {"query_id": 3, "clause_id": 1, "index": "t", "field": "body", "kind": "fuzzy", "text": "gama", "max_edits": 1}]
    answers = lambda i: {(r.query_id, r.doc_id, round(r.score, 9)) for r in S.search({"t": i}, clause_rows(spark, rows)).collect()}
    assert answers(idx) == answers(back)
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    terms = S.search({"t": back}, clause_rows(spark, rows[:1]))
    plan = terms._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "tf#" in line]
    assert scans and all(re.search(r"PartitionFilters: .*dynamicpruningexpression\(bucket#", line) for line in scans)
    assert "LeftSemi" not in plan  # one join


def test_an_index_without_positions(spark, tmp_path):
    write_index(index(spark, positions=False), str(tmp_path / "i"))
    back = read_index(spark, str(tmp_path / "i"))
    assert back.positions is None and back.postings.count() == index(spark).postings.count()
    write_index(index(spark), str(tmp_path / "i"))  # rebuilt
    assert read_index(spark, str(tmp_path / "i")).positions is not None
    with pytest.raises(AnalysisException):
        write_index(index(spark), str(tmp_path / "i"), rebuild=False)
