"""Registered index and search queries over the ``documents`` / ``benchmark`` tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose column names equal
those of the matching oracle SQL in :data:`ORACLES`. Scores are rounded to 6 decimals.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import bm25
from quarry.functions import text as T
from quarry.operators import search as S
from quarry.operators.index import explode_tokens, index_statistics, position_lists, read_index, write_index
from quarry.plans import sqlkit as K
from quarry.operators import shape as SH
from quarry.plans.corpus import ARTICLE_DEFAULT_FIELDS, article_index, body_index, documents_as_articles
from quarry.session import ensure_checkpoint_dir
from quarry.sources.tables import read_table

def clause_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A small batch of user queries (the search form input) as a clauses DataFrame."""
    cols = [c.split()[0] for c in S.CLAUSE_SCHEMA.split(", ")]
    defaults = {"group_id": 0, "index": "documents", "kind": "term", "occur": "SHOULD", "boost": 1.0}
    data = [tuple({**defaults, **r}.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(data, S.CLAUSE_SCHEMA)


def _ranked(df: DataFrame) -> DataFrame:
    return df.select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


def _run(spark: SparkSession, sf_dir: str, rows: list[dict], positions: bool = False) -> DataFrame:
    idx = body_index(spark, sf_dir, with_positions=positions)
    return _ranked(S.search({"documents": idx}, clause_rows(spark, rows)))


# ---------------------------------------------------------------------------
# Index tables
# ---------------------------------------------------------------------------

def q_tokens_letter(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    toks = docs.select("doc_id", T.letter_tokens(F.col("text")).alias("tokens"))
    return explode_tokens(toks, ["doc_id"]).select("doc_id", "pos", "term")


def q_postings(spark, sf_dir):
    return body_index(spark, sf_dir).postings.select("field", "term", "doc_id", "tf", "dl")


def q_positions(spark, sf_dir):
    idx = body_index(spark, sf_dir, with_positions=True)
    return position_lists(idx.dealt).select(
        "field", "term", "doc_id", F.array_join(F.col("positions").cast("array<string>"), " ").alias("positions"))


def q_doc_lengths(spark, sf_dir):
    return body_index(spark, sf_dir).doc_len.select("field", "doc_id", "dl",
                                                   bm25.quantized_length("dl").alias("dl_quantized"))


def q_term_dictionary(spark, sf_dir):
    return body_index(spark, sf_dir).term_dict.select("field", "term", "df", "ttf")


def q_field_stats(spark, sf_dir):
    return body_index(spark, sf_dir).field_stats.select(
        "field", "doc_count", "sum_ttf", F.round("avgdl", 6).alias("avgdl"), "n_terms")


def q_index_stats(spark, sf_dir):
    return index_statistics(body_index(spark, sf_dir), ["title", "body", "caption"])


ORACLE_INDEX = {
    "tokens_letter": f"""
        WITH tk AS (SELECT doc_id, {K.letters('text')} AS toks FROM documents)
        SELECT doc_id, unnest(range(len(toks))) AS pos, unnest(toks) AS term FROM tk""",
    "postings": f"WITH {K.index_ctes()} SELECT field, term, doc_id, tf, dl FROM postings",
    "positions": f"""WITH {K.index_ctes()}
        SELECT field, term, doc_id, string_agg(CAST(pos AS VARCHAR), ' ' ORDER BY pos) AS positions
        FROM occ GROUP BY field, term, doc_id""",
    "doc_lengths": f"""WITH {K.index_ctes()}
        SELECT field, doc_id, dl,
          CASE WHEN dl < 40 THEN dl ELSE 24 + (((dl - 24) >> (bit_length(bin(dl - 24)::BIT) - 4))
               << (bit_length(bin(dl - 24)::BIT) - 4)) END AS dl_quantized
        FROM dls""",
    "term_dictionary": f"WITH {K.index_ctes()} SELECT field, term, df, ttf FROM td",
    "field_stats": f"""WITH {K.index_ctes()}
        SELECT fs.field, fs.doc_count, s.sum_ttf, round(fs.avgdl, 6) AS avgdl, n.n_terms
        FROM fs JOIN (SELECT field, sum(dl) AS sum_ttf FROM dls GROUP BY field) s USING (field)
        JOIN (SELECT field, count(*) AS n_terms FROM td GROUP BY field) n USING (field)""",
    "index_stats": f"""WITH {K.index_ctes()},
        f AS (SELECT * FROM (VALUES ('title'), ('body'), ('caption')) v(field)),
        s AS (SELECT field, count(*) AS doc_count, sum(dl) AS sum_ttf FROM dls GROUP BY field),
        n AS (SELECT field, count(*) AS n_terms FROM td GROUP BY field)
        SELECT 'documents' AS index, f.field, (SELECT count(*) FROM documents) AS num_docs,
               coalesce(s.doc_count, 0) AS doc_count, coalesce(n.n_terms, 0) AS n_terms,
               coalesce(s.sum_ttf, 0) AS sum_ttf
        FROM f LEFT JOIN s USING (field) LEFT JOIN n USING (field)""",
}

QUERIES_INDEX = {
    "tokens_letter": q_tokens_letter,
    "postings": q_postings,
    "positions": q_positions,
    "doc_lengths": q_doc_lengths,
    "term_dictionary": q_term_dictionary,
    "field_stats": q_field_stats,
    "index_stats": q_index_stats,
}


# ---------------------------------------------------------------------------
# Ranked search
# ---------------------------------------------------------------------------

def _term_sql(qrows: str, scored_extra: str = "") -> str:
    """Oracle for OR-ed term clauses. ``qrows`` yields (query_id, field, text, boost)."""
    return f"""WITH {K.index_ctes()},
        qr AS ({qrows}),
        qt AS (SELECT query_id, field, boost, unnest({K.letters('text')}) AS term FROM qr),
        hits AS (SELECT qt.query_id, p.doc_id,
                   {K.weight_sql('p.tf', 'p.dl', 'fs.avgdl', K.idf_sql(), 'qt.boost')} AS w
                 FROM qt JOIN td USING (field, term) JOIN fs USING (field)
                 JOIN postings p ON p.field = qt.field AND p.term = qt.term),
        scored AS (SELECT query_id, doc_id, sum(w) AS score FROM hits GROUP BY query_id, doc_id)
        SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ({K.top10('scored')})"""


def q_bm25_term(spark, sf_dir):
    return _run(spark, sf_dir, [
        {"query_id": 1, "clause_id": 1, "field": "body", "text": "tion"},
        {"query_id": 2, "clause_id": 1, "field": "body", "text": "dans"},
        {"query_id": 3, "clause_id": 1, "field": "title", "text": "und"},
    ])


def q_bm25_or(spark, sf_dir):
    """Every benchmark item (whole text) is one OR query over ``body``."""
    bench = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    clauses = bench.select(
        F.col("item_id").alias("query_id"), F.lit(0).alias("group_id"), F.lit(1).alias("clause_id"),
        F.lit("documents").alias("index"), F.lit("body").alias("field"), F.lit("term").alias("kind"),
        "text", F.lit("SHOULD").alias("occur"), F.lit(1.0).alias("boost"),
        *[F.lit(None).cast(t).alias(c) for c, t in
          [("slop", "int"), ("max_edits", "int"), ("lo", "string"), ("hi", "string"),
           ("incl_lo", "boolean"), ("incl_hi", "boolean")]])
    return _ranked(S.search({"documents": body_index(spark, sf_dir)}, clauses))


ORACLE_SEARCH = {
    "bm25_term": _term_sql(
        "SELECT * FROM (VALUES (1, 'body', 'tion', 1.0), (2, 'body', 'dans', 1.0), (3, 'title', 'und', 1.0)) "
        "v(query_id, field, text, boost)"),
    "bm25_or": _term_sql("SELECT item_id AS query_id, 'body' AS field, text, 1.0 AS boost FROM benchmark"),
}

QUERIES_SEARCH = {
    "bm25_term": q_bm25_term,
    "bm25_or": q_bm25_or,
}


# ---------------------------------------------------------------------------
# Boolean combinations, boosts, multi-field, match-all (Q2-Q5, Q11-Q13)
# ---------------------------------------------------------------------------

BOOL_QUERIES = {
    "bm25_and": [
        {"query_id": 1, "clause_id": 1, "field": "body", "text": "the", "occur": "MUST"},
        {"query_id": 1, "clause_id": 2, "field": "body", "text": "tion", "occur": "MUST"},
        {"query_id": 2, "clause_id": 1, "field": "body", "text": "que", "occur": "MUST"},
        {"query_id": 2, "clause_id": 2, "field": "body", "text": "dans", "occur": "MUST"},
        {"query_id": 3, "clause_id": 1, "text": "und", "occur": "MUST"},
        {"query_id": 3, "clause_id": 2, "text": "der", "occur": "SHOULD"},
    ],
    "bm25_not": [
        {"query_id": 1, "clause_id": 1, "field": "body", "text": "que"},
        {"query_id": 1, "clause_id": 2, "field": "body", "text": "dans", "occur": "MUST_NOT"},
        {"query_id": 2, "clause_id": 1, "field": "body", "text": "the", "occur": "MUST"},
        {"query_id": 2, "clause_id": 2, "field": "body", "text": "of", "occur": "MUST_NOT"},
        {"query_id": 3, "clause_id": 1, "field": "body", "text": "the", "occur": "MUST_NOT"},
    ],
    "bm25_group": [
        {"query_id": 1, "clause_id": 1, "field": "body", "text": "the", "occur": "MUST"},
        {"query_id": 1, "clause_id": 2, "kind": "group", "occur": "MUST"},
        {"query_id": 1, "group_id": 2, "clause_id": 3, "field": "body", "text": "und"},
        {"query_id": 1, "group_id": 2, "clause_id": 4, "field": "body", "text": "dans"},
        {"query_id": 2, "clause_id": 1, "kind": "group", "boost": 2.0},
        {"query_id": 2, "group_id": 1, "clause_id": 2, "field": "body", "text": "of", "occur": "MUST"},
        {"query_id": 2, "group_id": 1, "clause_id": 3, "field": "body", "text": "the", "occur": "MUST"},
        {"query_id": 2, "clause_id": 4, "field": "body", "text": "que"},
        {"query_id": 2, "clause_id": 5, "kind": "group", "occur": "MUST_NOT"},
        {"query_id": 2, "group_id": 5, "clause_id": 6, "field": "body", "text": "tion"},
    ],
    "bm25_boost": [
        {"query_id": 1, "clause_id": 1, "field": "body", "text": "tion", "boost": 2.0},
        {"query_id": 1, "clause_id": 2, "field": "body", "text": "que"},
        {"query_id": 2, "clause_id": 1, "field": "body", "text": "dans", "boost": 0.5},
        {"query_id": 2, "clause_id": 2, "field": "body", "text": "und", "boost": 3.0},
    ],
    "match_all": [
        {"query_id": 1, "clause_id": 1, "kind": "all"},
        {"query_id": 2, "clause_id": 1, "kind": "all"},
        {"query_id": 2, "clause_id": 2, "field": "body", "text": "the", "occur": "MUST_NOT"},
    ],
}

MULTI_FIELD_ROWS = [
    {"query_id": 1, "clause_id": 1, "text": "the tion"},
    {"query_id": 2, "clause_id": 1, "text": "the", "occur": "MUST"},
    {"query_id": 2, "clause_id": 2, "text": "und", "occur": "MUST"},
    {"query_id": 3, "clause_id": 1, "text": "unknown src"},
]


def _bool_query(name):
    def run(spark, sf_dir):
        return _run(spark, sf_dir, BOOL_QUERIES[name])
    run.__name__ = f"q_{name}"
    return run


def q_bm25_multi_field(spark, sf_dir):
    idx = article_index(spark, sf_dir)
    rows = [{**r, "index": "articoli"} for r in MULTI_FIELD_ROWS]
    return _ranked(S.search({"articoli": idx}, clause_rows(spark, rows)))


QUERIES_BOOL = {name: _bool_query(name) for name in BOOL_QUERIES}
QUERIES_BOOL["bm25_multi_field"] = q_bm25_multi_field

ORACLE_BOOL = {name: K.boolean_sql(rows, ["title", "body"]) for name, rows in BOOL_QUERIES.items()}
ORACLE_BOOL["bm25_multi_field"] = K.boolean_sql(MULTI_FIELD_ROWS, ARTICLE_DEFAULT_FIELDS, K.article_fields_cte())


# ---------------------------------------------------------------------------
# Phrases (Q6)
# ---------------------------------------------------------------------------

PHRASE_ROWS = [
    {"query_id": 1, "clause_id": 1, "field": "body", "kind": "phrase", "text": "of the"},
    {"query_id": 2, "clause_id": 1, "field": "body", "kind": "phrase", "text": "que de la"},
    {"query_id": 3, "clause_id": 1, "field": "body", "kind": "phrase", "text": "und der"},
    {"query_id": 4, "clause_id": 1, "field": "body", "kind": "phrase", "text": "qqqzz the"},
    {"query_id": 5, "clause_id": 1, "field": "body", "kind": "phrase", "text": "the the"},
]
SLOP_ROWS = [
    {"query_id": 1, "clause_id": 1, "field": "body", "kind": "phrase", "text": "the of", "slop": 2},
    {"query_id": 2, "clause_id": 1, "field": "body", "kind": "phrase", "text": "de la", "slop": 1},
    {"query_id": 3, "clause_id": 1, "field": "body", "kind": "phrase", "text": "tion the", "slop": 3},
    {"query_id": 4, "clause_id": 1, "field": "body", "kind": "phrase", "text": "the of and", "slop": 6},
    {"query_id": 5, "clause_id": 1, "field": "body", "kind": "phrase", "text": "the the", "slop": 2},
    {"query_id": 6, "clause_id": 1, "field": "body", "kind": "phrase", "text": "the of the", "slop": 4},
    {"query_id": 7, "clause_id": 1, "field": "body", "kind": "phrase", "text": "der und"},
]


def q_phrase_search(spark, sf_dir):
    return _run(spark, sf_dir, PHRASE_ROWS, positions=True)


def q_phrase_slop(spark, sf_dir):
    return _run(spark, sf_dir, SLOP_ROWS, positions=True)


def _phrase_qt(rows: list[dict]) -> str:
    vals = K.values([(r["query_id"], r["clause_id"], r["field"], r["text"], r.get("slop", 0), 1.0) for r in rows])
    return f"""cl AS (SELECT * FROM ({vals}) v(query_id, clause_id, field, text, slop, boost)),
        qtk AS (SELECT *, {K.letters('text')} AS toks FROM cl),
        qt AS (SELECT query_id, clause_id, field, slop, boost, len(toks) AS n,
                      unnest(toks) AS term, unnest(range(len(toks))) AS qpos FROM qtk),
        ok AS (SELECT query_id, clause_id, field, sum({K.idf_sql()}) AS idf_sum
               FROM qt JOIN td USING (field, term) JOIN fs USING (field)
               GROUP BY query_id, clause_id, field HAVING count(DISTINCT qpos) = max(n)),
        oc AS (SELECT qt.query_id, qt.clause_id, qt.field, o.doc_id, o.dl, qt.qpos, qt.n, qt.slop, qt.boost,
                      o.pos - qt.qpos AS rel
               FROM qt JOIN ok USING (query_id, clause_id, field)
               JOIN occ o ON o.field = qt.field AND o.term = qt.term)"""


ORACLE_PHRASE = {
    "phrase_search": f"""WITH {K.index_ctes()}, {_phrase_qt(PHRASE_ROWS)},
        st AS (SELECT query_id, clause_id, field, doc_id, rel, max(dl) AS dl, max(boost) AS boost
               FROM oc GROUP BY query_id, clause_id, field, doc_id, rel
               HAVING count(DISTINCT qpos) = max(n)),
        fr AS (SELECT query_id, clause_id, field, doc_id, count(*) AS freq, max(dl) AS dl, max(boost) AS boost
               FROM st GROUP BY query_id, clause_id, field, doc_id),
        scored AS (SELECT fr.query_id, fr.doc_id,
                          {K.weight_sql('fr.freq', 'fr.dl', 'fs.avgdl', 'ok.idf_sum', 'fr.boost')} AS score
                   FROM fr JOIN ok USING (query_id, clause_id, field) JOIN fs USING (field))
        SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ({K.top10('scored')})""",
    # phrases of two or three tokens: every way to give each token a position of its own
    "phrase_slop": f"""WITH {K.index_ctes()}, {_phrase_qt(SLOP_ROWS)},
        t0 AS (SELECT * FROM oc WHERE qpos = 0), t1 AS (SELECT * FROM oc WHERE qpos = 1), t2 AS (SELECT * FROM oc WHERE qpos = 2),
        ways AS (
          SELECT t0.query_id, t0.clause_id, t0.field, t0.doc_id, t0.rel AS a, t0.dl, t0.boost, t0.slop,
                 abs(t1.rel - t0.rel) AS mlen
          FROM t0 JOIN t1 USING (query_id, clause_id, field, doc_id)
          WHERE t0.n = 2 AND t1.rel + 1 <> t0.rel AND abs(t1.rel - t0.rel) <= t0.slop
          UNION ALL
          SELECT t0.query_id, t0.clause_id, t0.field, t0.doc_id, t0.rel, t0.dl, t0.boost, t0.slop,
                 greatest(t0.rel, t1.rel, t2.rel) - least(t0.rel, t1.rel, t2.rel)
          FROM t0 JOIN t1 USING (query_id, clause_id, field, doc_id) JOIN t2 USING (query_id, clause_id, field, doc_id)
          WHERE t0.n = 3 AND t1.rel + 1 <> t0.rel AND t2.rel + 2 <> t0.rel AND t1.rel + 1 <> t2.rel + 2
            AND abs(t1.rel - t0.rel) <= t0.slop AND abs(t2.rel - t0.rel) <= t0.slop),
        m AS (SELECT query_id, clause_id, field, doc_id, a, max(dl) AS dl, max(boost) AS boost, min(mlen) AS mlen
              FROM ways WHERE mlen <= slop GROUP BY query_id, clause_id, field, doc_id, a),
        fr AS (SELECT query_id, clause_id, field, doc_id, sum(1.0 / (mlen + 1)) AS freq, max(dl) AS dl,
                      max(boost) AS boost FROM m GROUP BY query_id, clause_id, field, doc_id),
        scored AS (SELECT fr.query_id, fr.doc_id,
                          {K.weight_sql('fr.freq', 'fr.dl', 'fs.avgdl', 'ok.idf_sum', 'fr.boost')} AS score
                   FROM fr JOIN ok USING (query_id, clause_id, field) JOIN fs USING (field))
        SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ({K.top10('scored')})""",
}

QUERIES_PHRASE = {"phrase_search": q_phrase_search, "phrase_slop": q_phrase_slop}


# ---------------------------------------------------------------------------
# Dictionary expansions: prefix, wildcard, regexp, range (Q7, Q9, Q10); fuzzy (Q8)
# ---------------------------------------------------------------------------

EXPANSION_ROWS = {
    "prefix_search": [
        {"query_id": 1, "clause_id": 1, "field": "body", "kind": "prefix", "text": "tio"},
        {"query_id": 2, "clause_id": 1, "kind": "prefix", "text": "Und"},
    ],
    "wildcard_search": [
        {"query_id": 1, "clause_id": 1, "field": "body", "kind": "wildcard", "text": "th?n*"},
        {"query_id": 2, "clause_id": 1, "field": "body", "kind": "wildcard", "text": "e?n"},
        {"query_id": 3, "clause_id": 1, "field": "title", "kind": "wildcard", "text": "*ble", "boost": 2.0},
    ],
    "regexp_search": [
        {"query_id": 1, "clause_id": 1, "field": "body", "kind": "regexp", "text": "[a-c]on.*"},
        {"query_id": 2, "clause_id": 1, "field": "body", "kind": "regexp", "text": "th(e|an)"},
    ],
    # starts of one byte, runs inside, choices without a run, open ranges
    "pattern_search": [
        {"query_id": 1, "clause_id": 1, "field": "body", "kind": "wildcard", "text": "*tion*"},
        {"query_id": 2, "clause_id": 1, "kind": "wildcard", "text": "?eit*ung", "boost": 2.0},
        {"query_id": 3, "clause_id": 1, "field": "body", "kind": "wildcard", "text": "*z?"},
        {"query_id": 4, "clause_id": 1, "field": "body", "kind": "regexp", "text": ".*ouque.*"},
        {"query_id": 5, "clause_id": 1, "field": "body", "kind": "regexp", "text": "que?s*t+.*"},
        {"query_id": 6, "clause_id": 1, "kind": "regexp", "text": "(que|und)(s|t).*"},
        {"query_id": 7, "clause_id": 1, "field": "body", "kind": "prefix", "text": "\u00e9"},
        {"query_id": 8, "clause_id": 1, "field": "body", "kind": "prefix", "text": "z"},
        {"query_id": 9, "clause_id": 1, "field": "title", "kind": "range", "lo": None, "hi": "at", "incl_lo": True, "incl_hi": False},
        {"query_id": 10, "clause_id": 1, "field": "body", "kind": "range", "lo": "w", "hi": "zz", "incl_lo": True, "incl_hi": True},
        {"query_id": 11, "clause_id": 1, "field": "body", "kind": "range", "lo": "z", "hi": "a", "incl_lo": True, "incl_hi": True},
    ],
    "term_range_search": [
        {"query_id": 1, "clause_id": 1, "field": "body", "kind": "range", "lo": "que", "hi": "quo",
         "incl_lo": True, "incl_hi": True},
        {"query_id": 2, "clause_id": 1, "field": "body", "kind": "range", "lo": "the", "hi": "thi",
         "incl_lo": False, "incl_hi": False},
        {"query_id": 3, "clause_id": 1, "field": "title", "kind": "range", "lo": "zu", "hi": None,
         "incl_lo": True, "incl_hi": True},
    ],
}
FUZZY_ROWS = [
    {"query_id": 1, "clause_id": 1, "field": "body", "kind": "fuzzy", "text": "dans", "max_edits": 1},
    {"query_id": 2, "clause_id": 1, "field": "body", "kind": "fuzzy", "text": "tion", "max_edits": 1},
    {"query_id": 3, "clause_id": 1, "field": "body", "kind": "fuzzy", "text": "hte", "max_edits": 1},
]


TWO_EDIT_ROWS = [
    {"query_id": 1, "clause_id": 1, "field": "body", "kind": "fuzzy", "text": "anderely", "max_edits": 2},
    {"query_id": 2, "clause_id": 1, "field": "body", "kind": "fuzzy", "text": "dnas", "max_edits": 2},
    {"query_id": 3, "clause_id": 1, "field": "body", "kind": "fuzzy", "text": "tion", "max_edits": 0},
    {"query_id": 4, "clause_id": 1, "field": "title", "kind": "fuzzy", "text": "on eriner", "max_edits": 1},
    {"query_id": 5, "clause_id": 1, "field": "body", "kind": "fuzzy", "text": "questioner questioner", "max_edits": 2},
]


def _expansion_query(name):
    def run(spark, sf_dir):
        return _run(spark, sf_dir, EXPANSION_ROWS[name])
    run.__name__ = f"q_{name}"
    return run


def q_fuzzy_search(spark, sf_dir):
    return _run(spark, sf_dir, FUZZY_ROWS)


def q_fuzzy_two_edits(spark, sf_dir):
    """Fuzzy clauses of none, one and two edits in one batch, some of several words."""
    return _run(spark, sf_dir, TWO_EDIT_ROWS)


def _expansion_sql(rows: list[dict]) -> str:
    cols = ["query_id", "clause_id", "field", "kind", "text", "boost", "lo", "hi", "incl_lo", "incl_hi"]
    dflt = {"field": None, "text": None, "boost": 1.0, "lo": None, "hi": None, "incl_lo": None, "incl_hi": None}
    vals = K.values([tuple({**dflt, **r}[c] for c in cols) for r in rows])
    return f"""WITH {K.index_ctes()},
        cl0 AS (SELECT * FROM ({vals}) v({', '.join(cols)})),
        cl AS (SELECT * EXCLUDE (field), lower(text) AS pat, lower(lo) AS lo_n, lower(hi) AS hi_n,
                      unnest(CASE WHEN field IS NULL THEN ['title', 'body'] ELSE [field] END) AS field FROM cl0),
        ex AS (SELECT cl.query_id, cl.clause_id, td.field, td.term, cl.boost FROM cl JOIN td ON td.field = cl.field
               WHERE CASE cl.kind
                 WHEN 'prefix' THEN starts_with(td.term, cl.pat)
                 WHEN 'wildcard' THEN td.term LIKE replace(replace(cl.pat, '*', '%'), '?', '_')
                 WHEN 'regexp' THEN regexp_full_match(td.term, cl.pat)
                 WHEN 'range' THEN (cl.lo_n IS NULL OR CASE WHEN coalesce(cl.incl_lo, TRUE) THEN td.term >= cl.lo_n
                                                           ELSE td.term > cl.lo_n END)
                               AND (cl.hi_n IS NULL OR CASE WHEN coalesce(cl.incl_hi, TRUE) THEN td.term <= cl.hi_n
                                                           ELSE td.term < cl.hi_n END)
                 END),
        hits AS (SELECT DISTINCT ex.query_id, ex.clause_id, ex.field, p.doc_id, ex.boost
                 FROM ex JOIN postings p ON p.field = ex.field AND p.term = ex.term),
        scored AS (SELECT query_id, doc_id, sum(boost) AS score FROM hits GROUP BY query_id, doc_id)
        SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ({K.top10('scored')})"""


def _fuzzy_sql(rows: list[dict]) -> str:
    vals = K.values([(r["query_id"], r["clause_id"], r["field"], r["text"], r["max_edits"], 1.0) for r in rows])
    return f"""WITH {K.index_ctes()},
        cl AS (SELECT * FROM ({vals}) v(query_id, clause_id, field, text, max_edits, boost)),
        qf AS (SELECT query_id, clause_id, field, max_edits, boost, unnest({K.letters('text')}) AS qterm FROM cl),
        pairs AS (SELECT qf.*, td.term, td.df FROM qf JOIN td ON td.field = qf.field
                  WHERE abs(length(td.term) - length(qf.qterm)) <= 1),
        pi AS (SELECT *, unnest(range(1, greatest(length(qterm), length(term)) + 1)) AS i FROM pairs),
        -- character-level check for at most one edit (substitution, insertion, deletion or
        -- one swap of adjacent characters)
        ex AS (SELECT query_id, clause_id, field, max_edits, boost, qterm, term, df,
                 CASE WHEN bool_or(qterm = term) THEN 0
                      WHEN bool_or(length(qterm) = length(term) AND substr(qterm, 1, i - 1) = substr(term, 1, i - 1)
                                   AND substr(qterm, i + 1) = substr(term, i + 1)) THEN 1
                      WHEN bool_or(length(qterm) = length(term) + 1
                                   AND substr(qterm, 1, i - 1) || substr(qterm, i + 1) = term) THEN 1
                      WHEN bool_or(length(term) = length(qterm) + 1
                                   AND substr(term, 1, i - 1) || substr(term, i + 1) = qterm) THEN 1
                      WHEN bool_or(length(qterm) = length(term) AND i < length(qterm)
                                   AND substr(qterm, 1, i - 1) || substr(qterm, i + 1, 1) || substr(qterm, i, 1)
                                       || substr(qterm, i + 2) = term) THEN 1
                      ELSE 2 END AS edits
               FROM pi GROUP BY query_id, clause_id, field, max_edits, boost, qterm, term, df
               HAVING edits <= max(max_edits)),
        ex2 AS (SELECT *, 1.0 - edits / least(length(qterm), length(term)) AS sim FROM ex),
        hits AS (SELECT ex2.query_id, p.doc_id,
                        {K.weight_sql('p.tf', 'p.dl', 'fs.avgdl', K.idf_sql('ex2.df'), 'ex2.boost')} * ex2.sim AS w
                 FROM ex2 JOIN fs USING (field) JOIN postings p ON p.field = ex2.field AND p.term = ex2.term
                 WHERE ex2.sim > 0),
        scored AS (SELECT query_id, doc_id, sum(w) AS score FROM hits GROUP BY query_id, doc_id)
        SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ({K.top10('scored')})"""


def _two_edits_sql(rows: list[dict]) -> str:
    """All pairs of a query word and a dictionary term. DuckDB's distance counts bytes; the query's words are
    ASCII, so a byte in place of each other character of a term leaves the number of character edits."""
    vals = K.values([(r["query_id"], r["clause_id"], r["field"], r["text"], r["max_edits"], 1.0) for r in rows])
    return f"""WITH {K.index_ctes()},
        cl AS (SELECT * FROM ({vals}) v(query_id, clause_id, field, text, max_edits, boost)),
        qf AS (SELECT query_id, field, max_edits, boost, unnest({K.letters('text')}) AS qterm FROM cl),
        vr AS (SELECT *, list_transform(range(1, length(qterm)), lambda i: substr(qterm, 1, i - 1) || substr(qterm, i + 1, 1)
                 || substr(qterm, i, 1) || substr(qterm, i + 2)) AS swaps FROM qf),
        ex AS (SELECT vr.* EXCLUDE (swaps), td.term, td.df, regexp_replace(td.term, '[^\\x00-\\x7F]', chr(1), 'g') AS plain,
                 least(levenshtein(qterm, plain), 1 + list_min(list_transform(list_filter(swaps, lambda v: v <> qterm) || ['{'#' * 40}'],
                   lambda v: levenshtein(v, plain)))) AS edits
               FROM vr JOIN td ON td.field = vr.field WHERE abs(length(td.term) - length(qterm)) <= max_edits),
        ex2 AS (SELECT *, 1.0 - edits / least(length(qterm), length(term)) AS sim FROM ex WHERE edits <= max_edits),
        hits AS (SELECT ex2.query_id, p.doc_id,
                        {K.weight_sql('p.tf', 'p.dl', 'fs.avgdl', K.idf_sql('ex2.df'), 'ex2.boost')} * ex2.sim AS w
                 FROM ex2 JOIN fs USING (field) JOIN postings p ON p.field = ex2.field AND p.term = ex2.term
                 WHERE ex2.sim > 0),
        scored AS (SELECT query_id, doc_id, sum(w) AS score FROM hits GROUP BY query_id, doc_id)
        SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ({K.top10('scored')})"""


QUERIES_EXPANSION = {name: _expansion_query(name) for name in EXPANSION_ROWS}
QUERIES_EXPANSION["fuzzy_search"] = q_fuzzy_search
ORACLE_EXPANSION = {name: _expansion_sql(rows) for name, rows in EXPANSION_ROWS.items()}
ORACLE_EXPANSION["fuzzy_search"] = _fuzzy_sql(FUZZY_ROWS)
QUERIES_EXPANSION["fuzzy_two_edits"] = q_fuzzy_two_edits
ORACLE_EXPANSION["fuzzy_two_edits"] = _two_edits_sql(TWO_EDIT_ROWS)


# ---------------------------------------------------------------------------
# Searches on a written index (SNK2-SNK4, JN4)
# ---------------------------------------------------------------------------

STORED_ROWS = [
    {"query_id": 1, "clause_id": 1, "field": "body", "text": "the tion"},
    {"query_id": 2, "clause_id": 1, "field": "body", "kind": "phrase", "text": "of the", "occur": "MUST"},
    {"query_id": 2, "clause_id": 2, "field": "title", "text": "and", "occur": "MUST_NOT"},
    {"query_id": 3, "clause_id": 1, "text": "dans"},
]


def q_stored_search(spark, sf_dir):
    """Term and phrase clauses over the index written as Parquet and read back."""
    path = f"{ensure_checkpoint_dir(spark)}/stored-index-{uuid.uuid4().hex}"
    write_index(body_index(spark, sf_dir, with_positions=True), path)
    return _ranked(S.search({"documents": read_index(spark, path)}, clause_rows(spark, STORED_ROWS)))


QUERIES_STORED = {"stored_search": q_stored_search}
ORACLE_STORED = {"stored_search": f"""WITH {K.index_ctes()},
        terms AS (SELECT * FROM (VALUES (1, 'body', 'the'), (1, 'body', 'tion'), (3, 'body', 'dans'), (3, 'title', 'dans')) v(query_id, field, term)),
        hits AS (SELECT t.query_id, p.doc_id, {K.weight_sql('p.tf', 'p.dl', 'fs.avgdl', K.idf_sql(), '1.0')} AS w
                 FROM terms t JOIN td USING (field, term) JOIN fs USING (field) JOIN postings p ON p.field = t.field AND p.term = t.term),
        starts AS (SELECT a.doc_id, count(*) AS freq, max(a.dl) AS dl FROM occ a JOIN occ b ON b.doc_id = a.doc_id AND b.field = a.field AND b.pos = a.pos + 1
                   WHERE a.field = 'body' AND a.term = 'of' AND b.term = 'the' GROUP BY a.doc_id),
        idf AS (SELECT sum({K.idf_sql()}) AS s, max(fs.avgdl) AS avgdl FROM td JOIN fs USING (field) WHERE field = 'body' AND term IN ('of', 'the')),
        pairs AS (SELECT doc_id, {K.weight_sql('freq', 'dl', 'idf.avgdl', 'idf.s', '1.0')} AS w FROM starts, idf
                  WHERE doc_id NOT IN (SELECT doc_id FROM postings WHERE field = 'title' AND term = 'and')),
        scored AS (SELECT query_id, doc_id, sum(w) AS score FROM (SELECT * FROM hits UNION ALL SELECT 2, * FROM pairs) GROUP BY query_id, doc_id)
        SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ({K.top10('scored')})"""}


# ---------------------------------------------------------------------------
# Lookups, filter selection and result shaping (Q16, Q17, PRJ1-PRJ7, JN5, AGG13)
# ---------------------------------------------------------------------------

FILTER_ROWS = [
    (1, "und", None, None, None),
    (2, None, "src3", None, None),
    (3, None, None, "the of", None),
    (4, None, None, None, "dans"),
    (5, None, "src1", None, "que"),
]
FILTER_SCHEMA = "query_id long, title string, authors string, articleAbstract string, allFields string"


def q_id_lookup(spark, sf_dir):
    """Every labelled document id looked up in the stored documents (unmatched kept)."""
    ids = read_table(spark, sf_dir, "labels", ["doc_id"])
    docs = body_index(spark, sf_dir).docs.select("doc_id", "title")
    return SH.lookup_ids(docs, ids).select("doc_id", "title")


def q_filter_priority(spark, sf_dir):
    filters = spark.createDataFrame(FILTER_ROWS, FILTER_SCHEMA)
    clauses = SH.filters_to_clauses(filters, "articoli")
    return _ranked(S.search({"articoli": article_index(spark, sf_dir)}, clauses))


def _benchmark_clauses(bench: DataFrame, index: str, field: str | None) -> DataFrame:
    return bench.select(
        F.col("item_id").alias("query_id"), F.lit(0).alias("group_id"), F.lit(1).alias("clause_id"),
        F.lit(index).alias("index"), F.lit(field).cast("string").alias("field"), F.lit("term").alias("kind"),
        "text", F.lit("SHOULD").alias("occur"), F.lit(1.0).alias("boost"),
        *[F.lit(None).cast(t).alias(c) for c, t in
          [("slop", "int"), ("max_edits", "int"), ("lo", "string"), ("hi", "string"),
           ("incl_lo", "boolean"), ("incl_hi", "boolean")]])


def q_search_results(spark, sf_dir):
    """Benchmark items as multi-field queries over the article index, shaped for display."""
    bench = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    idx = article_index(spark, sf_dir)
    hits = S.search({"articoli": idx}, _benchmark_clauses(bench, "articoli", None))
    return SH.shape_article_hits(hits, idx.docs)


def q_result_counts(spark, sf_dir):
    """Result list length per (query, requested index); an index that is not loaded
    ('tabelle' here) is skipped by the search and reported with zero results."""
    bench = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    clauses = _benchmark_clauses(bench, "articoli", "title").unionByName(
        _benchmark_clauses(bench, "tabelle", "caption"))
    hits = S.search({"articoli": article_index(spark, sf_dir)}, clauses)
    return SH.result_counts(hits, clauses, ["articoli", "tabelle"])


def q_detail_map(spark, sf_dir):
    docs = documents_as_articles(spark, sf_dir).withColumn("paragraphs", F.array_join("paragraphs", " "))
    url = F.concat(F.lit(SH.ARTICLE_URL_PREFIX), F.col("doc_id").cast("string"))
    return SH.detail_entries(docs, SH.ARTICLE_DETAIL_LABELS, url)


def q_document_response(spark, sf_dir):
    docs = documents_as_articles(spark, sf_dir).withColumn("authors", F.array_join("authors", " "))
    return SH.compact_response(docs)


_ART = K.article_fields_cte()
ORACLE_SHAPE = {
    "id_lookup": """SELECT l.doc_id, split_part(d.text, chr(10), 1) AS title
        FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id""",
    "filter_priority": f"""WITH {K.index_ctes(_ART)},
        f AS (SELECT * FROM ({K.values(FILTER_ROWS)}) v(query_id, title, authors, articleAbstract, allFields)),
        qr AS (SELECT query_id,
                 CASE WHEN title IS NOT NULL THEN 'title' WHEN authors IS NOT NULL THEN 'authors'
                      WHEN articleAbstract IS NOT NULL THEN 'articleAbstract' ELSE 'paragraphs' END AS field,
                 coalesce(title, authors, articleAbstract, allFields, '') AS text FROM f),
        qt AS (SELECT query_id, field, unnest({K.letters('text')}) AS term FROM qr),
        hits AS (SELECT qt.query_id, p.doc_id, {K.weight_sql('p.tf', 'p.dl', 'fs.avgdl', K.idf_sql(), '1.0')} AS w
                 FROM qt JOIN td USING (field, term) JOIN fs USING (field)
                 JOIN postings p ON p.field = qt.field AND p.term = qt.term),
        scored AS (SELECT query_id, doc_id, sum(w) AS score FROM hits GROUP BY query_id, doc_id)
        SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ({K.top10('scored')})""",
    "search_results": f"""WITH {K.index_ctes(_ART)},
        qf AS (SELECT item_id AS query_id, text, unnest(['title', 'authors', 'articleAbstract', 'paragraphs']) AS field
               FROM benchmark),
        qt AS (SELECT query_id, field, unnest({K.letters('text')}) AS term FROM qf),
        hits AS (SELECT qt.query_id, p.doc_id, {K.weight_sql('p.tf', 'p.dl', 'fs.avgdl', K.idf_sql(), '1.0')} AS w
                 FROM qt JOIN td USING (field, term) JOIN fs USING (field)
                 JOIN postings p ON p.field = qt.field AND p.term = qt.term),
        scored AS (SELECT query_id, doc_id, sum(w) AS score FROM hits GROUP BY query_id, doc_id),
        top AS ({K.top10('scored')}),
        ab AS (SELECT doc_id, text FROM ft WHERE field = 'articleAbstract')
        SELECT t.query_id, 'ARTICOLI' AS tipo, t.rank, t.doc_id, split_part(d.text, chr(10), 1) AS titolo,
               substr(ab.text, 1, 150) || '...' AS snippet, round(t.score, 4) AS score,
               '/raw_articles/' || CAST(t.doc_id AS VARCHAR) AS url
        FROM top t JOIN documents d ON d.doc_id = t.doc_id JOIN ab ON ab.doc_id = t.doc_id""",
    "result_counts": f"""WITH {K.index_ctes(_ART)},
        qt AS (SELECT item_id AS query_id, 'title' AS field, unnest({K.letters('text')}) AS term FROM benchmark),
        hits AS (SELECT DISTINCT qt.query_id, p.doc_id FROM qt JOIN postings p ON p.field = qt.field AND p.term = qt.term),
        n AS (SELECT query_id, least(count(*), 10) AS n FROM hits GROUP BY query_id)
        SELECT b.item_id AS query_id, i.index, CASE WHEN i.index = 'articoli' THEN coalesce(n.n, 0) ELSE 0 END AS n_results
        FROM benchmark b CROSS JOIN (VALUES ('articoli'), ('tabelle')) i(index) LEFT JOIN n ON n.query_id = b.item_id""",
    "detail_map": """
        SELECT doc_id, 'URL Articolo Originale' AS label, '/raw_articles/' || CAST(doc_id AS VARCHAR) AS value FROM documents
        UNION ALL SELECT doc_id, 'Abstract', CASE WHEN len(string_split(text, chr(10))) >= 2
               THEN string_split(text, chr(10))[2] ELSE 'No Abstract Found' END FROM documents
        UNION ALL SELECT doc_id, 'Testo', replace(text, chr(10), ' ') FROM documents
        UNION ALL SELECT doc_id, 'Data di Pubblicazione', 'Unknown Date' FROM documents""",
    "document_response": f"""SELECT doc_id, coalesce(split_part(text, chr(10), 1), 'No Title Found') AS title,
        coalesce(source, '') AS authors, 'N/A' AS snippet, 'N/A' AS snippetField FROM documents""",
}

QUERIES_SHAPE = {
    "id_lookup": q_id_lookup,
    "filter_priority": q_filter_priority,
    "search_results": q_search_results,
    "result_counts": q_result_counts,
    "detail_map": q_detail_map,
    "document_response": q_document_response,
}
