"""Building blocks of the DuckDB oracle SQL (independent re-statements of each query).

Patterns are the same strings the Spark expressions use (Java regex and RE2 agree on
them); everything else is plain SQL over the pre-registered test tables.
"""

from __future__ import annotations

from quarry.functions import bm25
from quarry.functions import stemmer as ST
from quarry.functions.text import LETTER_RUN


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def letters(expr: str) -> str:
    return f"regexp_extract_all(lower(coalesce({expr}, '')), {q(LETTER_RUN)})"


def body_fields_cte() -> str:
    """(doc_id, field, text) for the two-field ``documents`` index."""
    return (
        "ft AS (SELECT doc_id, 'title' AS field, split_part(text, chr(10), 1) AS text FROM documents "
        "WHERE text IS NOT NULL "
        "UNION ALL SELECT doc_id, 'body' AS field, text FROM documents WHERE text IS NOT NULL)"
    )


def index_ctes(fields_cte: str | None = None) -> str:
    """CTEs ft, tk, occ, postings, dls, fs, td for a letters-analysed index."""
    return ",\n".join([
        fields_cte or body_fields_cte(),
        f"tk AS (SELECT doc_id, field, {letters('text')} AS toks FROM ft)",
        "occ AS (SELECT doc_id, field, len(toks) AS dl, unnest(toks) AS term, "
        "unnest(range(len(toks))) AS pos FROM tk)",
        "postings AS (SELECT field, term, doc_id, count(*) AS tf, max(dl) AS dl FROM occ GROUP BY field, term, doc_id)",
        "dls AS (SELECT field, doc_id, len(toks) AS dl FROM tk WHERE len(toks) > 0)",
        "fs AS (SELECT field, count(*) AS doc_count, sum(dl) / count(*) AS avgdl FROM dls GROUP BY field)",
        "td AS (SELECT field, term, count(*) AS df, sum(tf) AS ttf FROM postings GROUP BY field, term)",
    ])


def idf_sql(df: str = "td.df", n: str = "fs.doc_count") -> str:
    return f"ln(1 + ({n} - {df} + 0.5) / ({df} + 0.5))"


def weight_sql(tf: str, dl: str, avgdl: str, idf: str, boost: str) -> str:
    return (f"({boost}) * ({idf}) * ({tf}) / (({tf}) + {bm25.K1} * ({1 - bm25.B} + {bm25.B} * ({dl}) / ({avgdl})))")


def top10(scored: str, k: int = 10, extra_partition: str = "") -> str:
    part = "query_id" + (", " + extra_partition if extra_partition else "")
    return (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {part} "
            f"ORDER BY round(score, 9) DESC, doc_id) AS rank FROM {scored}) WHERE rank <= {k}")


def article_fields_cte() -> str:
    """(doc_id, field, text) for the article view of ``documents``."""
    nl = "chr(10)"
    return (
        "ft AS ("
        f"SELECT doc_id, 'title' AS field, coalesce(split_part(text, {nl}, 1), 'No Title Found') AS text FROM documents "
        "UNION ALL SELECT doc_id, 'authors', coalesce(source, '') FROM documents "
        f"UNION ALL SELECT doc_id, 'articleAbstract', CASE WHEN len(string_split(text, {nl})) >= 2 "
        f"THEN string_split(text, {nl})[2] ELSE 'No Abstract Found' END FROM documents "
        f"UNION ALL SELECT doc_id, 'paragraphs', replace(text, {nl}, ' ') FROM documents WHERE text IS NOT NULL "
        "UNION ALL SELECT doc_id, 'publicationDate', 'Unknown Date' FROM documents)"
    )


def values(rows: list[tuple]) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, (int, float)):
            return repr(v)
        return q(v)
    return "VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def boolean_sql(rows: list[dict], default_fields: list[str], fields_cte: str | None = None,
                final: str | None = None) -> str:
    """Oracle for term / match-all clauses combined by MUST/SHOULD/MUST_NOT in at most
    two levels (top level plus groups whose children are leaves)."""
    cols = ["query_id", "group_id", "clause_id", "field", "kind", "text", "occur", "boost"]
    dflt = {"group_id": 0, "field": None, "kind": "term", "text": None, "occur": "SHOULD", "boost": 1.0}
    vals = values([tuple({**dflt, **r}[c] for c in cols) for r in rows])
    dfl = "[" + ", ".join(q(f) for f in default_fields) + "]"
    group_eval = """SELECT h.query_id, c.group_id, h.doc_id,
                 sum(CASE WHEN c.occur <> 'MUST_NOT' THEN h.score ELSE 0 END) AS score
          FROM {src} h JOIN cl c ON c.query_id = h.query_id AND c.clause_id = h.clause_id
          JOIN need n ON n.query_id = c.query_id AND n.group_id = c.group_id
          WHERE {where}
          GROUP BY h.query_id, c.group_id, h.doc_id
          HAVING count(DISTINCT CASE WHEN c.occur = 'MUST' THEN c.clause_id END) = max(n.n_must)
             AND max(CASE WHEN c.occur = 'MUST_NOT' THEN 1 ELSE 0 END) = 0
             AND (max(n.n_must) > 0 OR max(CASE WHEN c.occur = 'SHOULD' THEN 1 ELSE 0 END) = 1)"""
    g1 = group_eval.format(src="lh", where="c.group_id <> 0")
    root = group_eval.format(src="allh", where="c.group_id = 0")
    final = final or f"SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ({top10('root')})"
    return f"""WITH {index_ctes(fields_cte)},
        cl AS (SELECT * FROM ({vals}) v({', '.join(cols)})),
        clf AS (SELECT query_id, clause_id, boost, text,
                       unnest(CASE WHEN field IS NULL THEN {dfl} ELSE [field] END) AS field
                FROM cl WHERE kind = 'term'),
        qt AS (SELECT query_id, clause_id, field, boost, unnest({letters('text')}) AS term FROM clf),
        th AS (SELECT qt.query_id, qt.clause_id, p.doc_id,
                      {weight_sql('p.tf', 'p.dl', 'fs.avgdl', idf_sql(), 'qt.boost')} AS score
               FROM qt JOIN td USING (field, term) JOIN fs USING (field)
               JOIN postings p ON p.field = qt.field AND p.term = qt.term),
        ah AS (SELECT cl.query_id, cl.clause_id, d.doc_id, cl.boost AS score
               FROM cl, (SELECT DISTINCT doc_id FROM ft) d WHERE cl.kind = 'all'),
        lh AS (SELECT query_id, clause_id, doc_id, sum(score) AS score
               FROM (SELECT * FROM th UNION ALL SELECT * FROM ah) GROUP BY query_id, clause_id, doc_id),
        need AS (SELECT query_id, group_id, sum(CASE WHEN occur = 'MUST' THEN 1 ELSE 0 END) AS n_must
                 FROM cl GROUP BY query_id, group_id),
        g1 AS (SELECT g.query_id, g.group_id AS clause_id, g.doc_id, g.score * gb.boost AS score
               FROM ({g1}) g JOIN cl gb ON gb.query_id = g.query_id AND gb.clause_id = g.group_id),
        allh AS (SELECT * FROM lh UNION ALL SELECT * FROM g1),
        root AS (SELECT query_id, doc_id, score FROM ({root}))
        {final}"""


def html_space(expr: str) -> str:
    """Whitespace collapsed and trimmed as in HTML text."""
    return f"trim(regexp_replace({expr}, '[ \\t\\n\\f\\r\\x{{a0}}]+', ' ', 'g'))"


def stem_ctes(vocab: str) -> str:
    """CTE ``stems`` (token, stem) for a CTE with the distinct tokens ``t``: one CTE for each step of the stemmer."""
    cut = lambda n: f"left(w, length(w) - {n})"
    is_ = lambda x, pattern: f"regexp_matches({x}, {q(pattern)})"
    ends = lambda s: f"(ends_with(w, {q(s)}) AND length(w) >= {len(s)})"

    def table(rules: list[tuple[str, str]], measure: str) -> str:
        rows = []
        for suffix, put in sorted(rules, key=lambda r: -len(r[0])):
            more = f" AND {is_(cut(3), '[st]$')}" if suffix == "ion" else ""
            rows.append(f"WHEN {ends(suffix)} THEN CASE WHEN {is_(cut(len(suffix)), measure)}{more} THEN {cut(len(suffix))} || {q(put)} ELSE w END")
        return f"CASE {' '.join(rows)} ELSE w END"

    twice = f"(length(w) > 1 AND right(w, 1) = right({cut(1)}, 1) AND {is_('w', ST.ENDS_IN_CONSONANT)})"
    lost = f"NOT {ends('eed')} AND (({ends('ed')} AND {is_(cut(2), ST.HAS_VOWEL)}) OR ({ends('ing')} AND {is_(cut(3), ST.HAS_VOWEL)}))"
    steps = [
        f"SELECT t, CASE WHEN {ends('sses')} THEN {cut(2)} WHEN {ends('ies')} THEN {cut(3)} || 'i' WHEN {ends('ss')} THEN w WHEN {ends('s')} THEN {cut(1)} ELSE w END AS w, false AS lost",
        f"SELECT t, CASE WHEN {ends('eed')} THEN CASE WHEN {is_(cut(3), ST.MEASURE_OVER_0)} THEN {cut(1)} ELSE w END "
        f"WHEN {lost} THEN CASE WHEN {ends('ed')} THEN {cut(2)} ELSE {cut(3)} END ELSE w END AS w, {lost} AS lost",
        f"SELECT t, CASE WHEN NOT lost THEN w WHEN {ends('at')} OR {ends('bl')} OR {ends('iz')} THEN w || 'e' "
        f"WHEN {twice} THEN CASE WHEN right(w, 1) IN ('l', 's', 'z') THEN w ELSE {cut(1)} END "
        f"WHEN {is_('w', ST.MEASURE_1)} AND {is_('w', ST.CONSONANT_VOWEL_CONSONANT)} THEN w || 'e' ELSE w END AS w, lost",
        f"SELECT t, CASE WHEN length(w) > 1 AND {ends('y')} AND {is_(cut(1), ST.HAS_VOWEL)} THEN {cut(1)} || 'i' ELSE w END AS w, lost",
        f"SELECT t, {table(ST.STEP_2, ST.MEASURE_OVER_0)} AS w, lost",
        f"SELECT t, {table(ST.STEP_3, ST.MEASURE_OVER_0)} AS w, lost",
        f"SELECT t, {table([(s, '') for s in ST.STEP_4], ST.MEASURE_OVER_1)} AS w, lost",
        f"SELECT t, CASE WHEN length(w) > 1 AND {ends('e')} AND ({is_('w', ST.MEASURE_OVER_1)} OR ({is_('w', ST.MEASURE_1)} "
        f"AND NOT {is_(cut(1), ST.CONSONANT_VOWEL_CONSONANT)})) THEN {cut(1)} ELSE w END AS w, lost",
        f"SELECT t, CASE WHEN {ends('ll')} AND {is_('w', ST.MEASURE_OVER_1)} THEN {cut(1)} ELSE w END AS w, lost",
    ]
    parts = [f"sx0 AS MATERIALIZED (SELECT t, CASE WHEN starts_with(t, 'y') THEN 'Y' || substr(t, 2) ELSE t END AS w, false AS lost FROM {vocab})"]
    parts += [f"sx{n} AS MATERIALIZED ({step} FROM sx{n - 1})" for n, step in enumerate(steps, 1)]
    return ",\n".join([*parts, f"""stems AS MATERIALIZED (SELECT t AS token, CASE WHEN length(t) <= 2 THEN t
        WHEN starts_with(t, 'y') THEN 'y' || substr(w, 2) ELSE w END AS stem FROM sx{len(steps)})"""])
