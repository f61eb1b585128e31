"""Batch search semantics on a hand-made corpus (BM25 values checked by hand formulas)."""

import math

from pyspark.sql import functions as F

from quarry.functions import bm25
from quarry.operators import search as S
from quarry.operators.index import build_index, read_index, write_index
from quarry.plans.corpus import LETTERS
from quarry.plans.retrieval import clause_rows

DOCS = [
    (1, "alpha beta gamma"),
    (2, "alpha alpha delta"),
    (3, "beta gamma gamma gamma epsilon zeta"),
    (4, "delta epsilon"),
    (5, "alpha beta alpha beta"),
]


def index(spark, positions=True):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    return build_index("t", docs, "doc_id", {"body": F.col("text")}, LETTERS, ["body"], positions)


def run(spark, rows, k=10):
    rows = [{**r, "index": "t", "field": r.get("field", "body")} for r in rows]
    out = S.search({"t": index(spark)}, clause_rows(spark, rows), k)
    return {(r.query_id, r.doc_id): r.score for r in out.collect()}


def manual(tf, dl, df, n=5, avgdl=18 / 5):
    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
    return idf * tf / (tf + bm25.K1 * (1 - bm25.B + bm25.B * dl / avgdl))


def test_single_term_matches_formula(spark):
    got = run(spark, [{"query_id": 1, "clause_id": 1, "text": "alpha"}])
    assert set(got) == {(1, 1), (1, 2), (1, 5)}
    assert math.isclose(got[(1, 2)], manual(2, 3, 3), rel_tol=1e-12)
    assert math.isclose(got[(1, 1)], manual(1, 3, 3), rel_tol=1e-12)


def test_score_rises_with_tf_and_falls_with_length(spark):
    got = run(spark, [{"query_id": 1, "clause_id": 1, "text": "gamma"}])
    assert got[(1, 3)] > got[(1, 1)]  # tf 3 vs 1
    assert manual(1, 3, 2) > manual(1, 6, 2)


def test_boolean_must_should_not(spark):
    got = run(spark, [
        {"query_id": 1, "clause_id": 1, "text": "alpha", "occur": "MUST"},
        {"query_id": 1, "clause_id": 2, "text": "beta", "occur": "MUST"},
        {"query_id": 2, "clause_id": 1, "text": "alpha"},
        {"query_id": 2, "clause_id": 2, "text": "beta", "occur": "MUST_NOT"},
        {"query_id": 3, "clause_id": 1, "text": "alpha", "occur": "MUST_NOT"},
    ])
    assert {d for q, d in got if q == 1} == {1, 5}
    assert {d for q, d in got if q == 2} == {2}
    assert not {d for q, d in got if q == 3}  # purely negative query matches nothing


def test_nested_groups_two_levels(spark):
    # alpha AND (delta OR (gamma AND epsilon))
    got = run(spark, [
        {"query_id": 1, "clause_id": 1, "text": "alpha", "occur": "MUST"},
        {"query_id": 1, "clause_id": 2, "kind": "group", "occur": "MUST"},
        {"query_id": 1, "group_id": 2, "clause_id": 3, "text": "delta"},
        {"query_id": 1, "group_id": 2, "clause_id": 4, "kind": "group"},
        {"query_id": 1, "group_id": 4, "clause_id": 5, "text": "gamma", "occur": "MUST"},
        {"query_id": 1, "group_id": 4, "clause_id": 6, "text": "epsilon", "occur": "MUST"},
        {"query_id": 2, "clause_id": 1, "kind": "group", "occur": "MUST"},
        {"query_id": 2, "group_id": 1, "clause_id": 2, "kind": "group", "occur": "MUST"},
        {"query_id": 2, "group_id": 2, "clause_id": 3, "text": "gamma", "occur": "MUST"},
        {"query_id": 2, "group_id": 2, "clause_id": 4, "text": "epsilon", "occur": "MUST"},
    ])
    assert {d for q, d in got if q == 1} == {2}
    assert {d for q, d in got if q == 2} == {3}


def test_repeated_words_add_twice_and_boost_multiplies(spark):
    once = run(spark, [{"query_id": 1, "clause_id": 1, "text": "delta"}])
    twice = run(spark, [{"query_id": 1, "clause_id": 1, "text": "delta delta"}])
    boosted = run(spark, [{"query_id": 1, "clause_id": 1, "text": "delta", "boost": 3.0}])
    for key in once:
        assert math.isclose(twice[key], 2 * once[key], rel_tol=1e-12)
        assert math.isclose(boosted[key], 3 * once[key], rel_tol=1e-12)


def test_phrase_exact_and_sloppy(spark):
    got = run(spark, [
        {"query_id": 1, "clause_id": 1, "kind": "phrase", "text": "alpha beta"},
        {"query_id": 2, "clause_id": 1, "kind": "phrase", "text": "beta alpha"},
        {"query_id": 3, "clause_id": 1, "kind": "phrase", "text": "alpha gamma", "slop": 1},
        {"query_id": 4, "clause_id": 1, "kind": "phrase", "text": "alpha gamma"},
    ])
    assert {d for q, d in got if q == 1} == {1, 5}
    assert {d for q, d in got if q == 2} == {5}
    assert {d for q, d in got if q == 3} == {1}
    assert not {d for q, d in got if q == 4}


def test_dictionary_expansions(spark):
    got = run(spark, [
        {"query_id": 1, "clause_id": 1, "kind": "prefix", "text": "ALP"},
        {"query_id": 2, "clause_id": 1, "kind": "wildcard", "text": "?eta"},
        {"query_id": 3, "clause_id": 1, "kind": "regexp", "text": "(delta|zeta)"},
        {"query_id": 4, "clause_id": 1, "kind": "range", "lo": "delta", "hi": "epsilon", "incl_lo": False, "incl_hi": True},
        {"query_id": 5, "clause_id": 1, "kind": "fuzzy", "text": "detla", "max_edits": 1},
        {"query_id": 6, "clause_id": 1, "kind": "fuzzy", "text": "gama", "max_edits": 1},
    ])
    assert {d for q, d in got if q == 1} == {1, 2, 5} and got[(1, 1)] == 1.0  # constant score
    assert {d for q, d in got if q == 2} == {1, 3, 5, 4} - {4} | {3}
    assert {d for q, d in got if q == 3} == {2, 3, 4}
    assert {d for q, d in got if q == 4} == {3, 4}
    assert {d for q, d in got if q == 5} == {2, 4}  # one adjacent swap
    assert {d for q, d in got if q == 6} == {1, 3}


def test_top_k_ties_by_doc_id(spark):
    got = S.search({"t": index(spark)}, clause_rows(spark, [{"query_id": 1, "clause_id": 1, "index": "t", "kind": "all"}]), 3)
    assert [r.doc_id for r in got.orderBy("rank").collect()] == [1, 2, 3]


def test_validation_and_unknown_index(spark):
    rows = [
        {"query_id": 1, "clause_id": 1, "index": "t", "text": "  "},
        {"query_id": 2, "clause_id": 1, "index": None, "text": "alpha"},
        {"query_id": 3, "clause_id": 1, "index": "other", "text": "alpha"},
        {"query_id": 4, "clause_id": 1, "index": "t", "text": "alpha"},
    ]
    _, rejected = S.validate_clauses(clause_rows(spark, rows), ["t"])
    reasons = {r.query_id: r.reason for r in rejected.collect()}
    assert reasons == {1: "blank query", 2: "no index chosen", 3: "unknown index"}
    got = S.search({"t": index(spark)}, clause_rows(spark, rows))
    assert {r.query_id for r in got.collect()} == {4}


def test_index_roundtrip_parquet(spark, tmp_path):
    idx = index(spark)
    path = str(tmp_path / "idx")
    write_index(idx, path)
    back = read_index(spark, path)
    assert back.analyzers == idx.analyzers and back.default_fields == ["body"]
    q = clause_rows(spark, [{"query_id": 1, "clause_id": 1, "index": "t", "field": "body", "text": "alpha gamma"}])
    a = {(r.doc_id, round(r.score, 9)) for r in S.search({"t": idx}, q).collect()}
    b = {(r.doc_id, round(r.score, 9)) for r in S.search({"t": back}, q).collect()}
    assert a == b and len(a) == 4


def test_field_aliases_and_multi_field(spark):
    docs = spark.createDataFrame([(1, "cap one", "body alpha"), (2, "cap alpha", "body two")],
                                 "doc_id long, caption string, body string")
    idx = build_index("tabelle", docs, "doc_id", {"caption": F.col("caption"), "body": F.col("body")}, LETTERS,
                      ["caption", "body"], aliases={"mentions": "body"})
    rows = [{"query_id": 1, "clause_id": 1, "index": "tabelle", "field": "mentions", "text": "alpha"},
            {"query_id": 2, "clause_id": 1, "index": "tabelle", "text": "alpha"}]
    got = S.search({"tabelle": idx}, clause_rows(spark, rows)).collect()
    assert {r.doc_id for r in got if r.query_id == 1} == {1}
    assert {r.doc_id for r in got if r.query_id == 2} == {1, 2}


def test_approx_terms_close_to_exact(spark):
    from quarry.operators.index import approx_terms_per_field
    idx = index(spark)
    exact = {r.field: r.n_terms for r in idx.field_stats.collect()}
    approx = {r.field: r.approx_terms for r in approx_terms_per_field(idx).collect()}
    assert approx == exact == {"body": 6}
