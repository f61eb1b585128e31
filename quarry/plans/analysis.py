"""Registered text-analysis, mining, JSON and crawl-ledger queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import crawl, mine
from quarry.operators import extract as X
from quarry.operators.index import analyze_column, dealt_by, explode_tokens, unpivot_fields
from quarry.plans import sqlkit as K
from quarry.plans.corpus import ARTICLE_ANALYZERS_REFERENCE, documents_as_articles
from quarry.sources import table_json
from quarry.sources.tables import read_table


def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents", ["doc_id", "text"])


def q_informative_terms(spark, sf_dir):
    bench = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    terms = T.informative_terms(F.col("text"))
    return bench.select("item_id", F.size(terms).alias("n_terms"), F.array_join(terms, " ").alias("terms"))


def q_stopword_anti(spark, sf_dir):
    """Token counts after removing both stop-word lists (anti join with a fixed list)."""
    stop = spark.createDataFrame([(w,) for w in sorted(set(T.MINER_STOP_WORDS) | set(T.ITALIAN_STOP_WORDS))], "term string")
    toks = _docs(spark, sf_dir).select(F.explode(T.letter_tokens(F.col("text"))).alias("term"))
    kept = toks.join(F.broadcast(stop), "term", "left_anti")  # fixed list of 80 words
    return kept.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def q_tokens_standard(spark, sf_dir):
    toks = _docs(spark, sf_dir).select("doc_id", T.standard_tokens(F.col("text")).alias("tokens"))
    return explode_tokens(toks, ["doc_id"]).select("doc_id", "pos", "term")


def q_multi_field_unpivot(spark, sf_dir):
    """Article fields unpivoted and analysed with the per-field dispatch of the reference
    (simple / standard / whitespace+stem); token count per (doc, field)."""
    arts = documents_as_articles(spark, sf_dir)
    fields = {"title": F.col("title"), "authors": F.array_join("authors", " "),
              "articleAbstract": F.col("articleAbstract"), "paragraphs": F.array_join("paragraphs", " "),
              "publicationDate": F.col("publicationDate")}
    rows = unpivot_fields(arts, "doc_id", fields)
    toks = analyze_column(F.col("field"), F.col("text"), ARTICLE_ANALYZERS_REFERENCE)
    return rows.select("doc_id", "field", F.size(toks).alias("n_tokens"))


def q_term_overlap_join(spark, sf_dir):
    """Benchmark items x document lines sharing >= 2 informative terms (JN2)."""
    bench = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    docs = dealt_by(_docs(spark, sf_dir), "doc_id")  # a document's pairs are counted where its lines are
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    pairs = mine.term_overlap(bench, "item_id", F.col("text"), lines, ["doc_id", "line_no"], F.col("line"))
    return pairs.select("item_id", "doc_id", "line_no", "n_shared",
                        F.array_join("matched_terms", " ").alias("matched_terms"))


def q_mined_tables(spark, sf_dir):
    """Table miner over every page; one row per paper with its table map as JSON (SNK1)."""
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    per = mine.tables_per_paper(pages, mine.mine_tables(pages))
    return per.select("page_id", "json_name", F.size("tables").alias("n_tables"))


def documents_as_pages(docs):
    """Each document as a page with two tables: its lines are the paragraphs, the first two are caption and
    body of a table whose id is on the figure around it, the source is the body of another one. Some
    lines link to the second table, whose id begins with the first's, some to the first."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    par = lambda line, n: F.concat(F.lit("<p>"), esc(line), F.when(n % 5 == 1, F.lit('<a href="#S1.T10">see</a>')).otherwise(""),
                                   F.when(n % 7 == 2, F.lit('<a href="x.html#S1.T1">see</a>')).otherwise(""), F.lit("</p>"))
    html = F.concat(F.lit("<html><body><figure id='S1.T1'><table class='ltx_tabular'><tr><td>"), esc(F.coalesce(F.get("_l", F.lit(1)), F.lit(""))),
                    F.lit("</td></tr></table><figcaption>"), esc(F.get("_l", F.lit(0))), F.lit("</figcaption></figure><table class='ltx_tabular' id='S1.T10'><tr><td>"),
                    esc(F.coalesce("source", F.lit(""))), F.lit("</td></tr></table>"), F.array_join(F.transform("_l", par), ""), F.lit("</body></html>"))
    url = F.concat(F.lit("d/"), F.col("doc_id").cast("string"), F.lit(".html"))
    return docs.withColumn("_l", lines).select(F.col("doc_id").alias("page_id"), url.alias("url"), html.alias("html"))


def q_mined_records(spark, sf_dir):
    """The table miner's full records over every document as a page (EXT9-EXT14, JN1, JN2)."""
    pages = documents_as_pages(read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"]))
    mined = mine.mine_tables(pages)
    context = F.transform("contextual_paragraphs", lambda x: F.concat(x["html"], F.lit("|"), F.array_join(x["matched_terms"], " ")))
    return mined.select("page_id", "table_id", "caption", "body", F.array_join("informative_terms_identified", " ").alias("terms"),
                        F.size("citing_paragraphs").cast("long").alias("n_citing"), F.size("contextual_paragraphs").cast("long").alias("n_contextual"),
                        F.sha2(F.array_join("citing_paragraphs", "\n"), 256).alias("citing_sha256"), F.sha2(F.array_join(context, "\n"), 256).alias("contextual_sha256"))


def q_page_link_targets(spark, sf_dir):
    """Every link resolved to the page it names, when that page is in the corpus (left join on
    the paper id derived from both sides)."""
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    segs, els = X.dom_tables(pages, keep=False)
    links = X.links(els).select("page_id", "st", X.paper_id(X.file_name(F.col("href"))).alias("target"))
    ids = pages.select(F.col("page_id").alias("target_page"), X.paper_id(X.file_name(F.col("url"))).alias("target"))
    return links.join(ids, "target", "left").select("page_id", "st", "target", "target_page")


def q_json_map_explode(spark, sf_dir):
    """JSON object column -> one row per key (map explode)."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "props"])
    return table_json.explode_json_object(ev, "event_id", "props").select("event_id", "key", "value")


def q_ledger_batches(spark, sf_dir):
    return crawl.batch_counts(crawl.events_as_crawl_log(read_table(spark, sf_dir, "events")))


def q_ledger_totals(spark, sf_dir):
    return crawl.totals(crawl.events_as_crawl_log(read_table(spark, sf_dir, "events")))


def q_ledger_rollup(spark, sf_dir):
    return crawl.batch_rollup(crawl.events_as_crawl_log(read_table(spark, sf_dir, "events")))


QUERIES_ANALYSIS = {
    "informative_terms": q_informative_terms,
    "stopword_anti": q_stopword_anti,
    "tokens_standard": q_tokens_standard,
    "multi_field_unpivot": q_multi_field_unpivot,
    "term_overlap_join": q_term_overlap_join,
    "mined_tables": q_mined_tables,
    "mined_records": q_mined_records,
    "page_link_targets": q_page_link_targets,
    "json_map_explode": q_json_map_explode,
    "ledger_batches": q_ledger_batches,
    "ledger_totals": q_ledger_totals,
    "ledger_rollup": q_ledger_rollup,
}

# --- oracles -----------------------------------------------------------------

_STOP = "[" + ", ".join(K.q(w) for w in dict.fromkeys(T.MINER_STOP_WORDS)) + "]"
_WS = K.q(T.WHITESPACE_RUN)


def _standard_sql(expr: str) -> str:
    """Standard tokens by another route than the engine's pattern: a mark goes before each character that
    joins two letters or two digits (twice, as neighbours share a letter), then runs are cut."""
    x = f"replace(lower(coalesce({expr}, '')), chr(1), ' ')"
    for left, joiner, right in (("[\\p{L}\\p{M}]", "[.:·''’]", "\\p{L}"), ("\\p{N}", "[.,;''’]", "\\p{N}")) * 2:
        x = f"regexp_replace({x}, '({left})({joiner})({right})', '\\1' || chr(1) || '\\2\\3', 'g')"
    word = "[\\p{L}\\p{M}\\p{N}_]"
    toks = f"list_transform(regexp_extract_all({x}, '{word}(?:{word}|\\x01[.,;:·''’])*'), lambda t: replace(t, chr(1), ''))"
    return f"flatten(list_transform({toks}, lambda t: list_transform(range(0, length(t), 255), lambda i: substr(t, i + 1, 255))))"


def _terms_sql(expr: str) -> str:
    toks = f"regexp_split_to_array(translate(lower(coalesce({expr}, '')), {K.q(T.PUNCTUATION)}, ''), {_WS})"
    return (f"list_sort(list_distinct(list_filter({toks}, lambda x: length(x) > 2 AND NOT list_contains({_STOP}, x) "
            f"AND NOT regexp_full_match(x, '\\p{{Nd}}+'))))")


_ALLSTOP = ", ".join(f"({K.q(w)})" for w in sorted(set(T.MINER_STOP_WORDS) | set(T.ITALIAN_STOP_WORDS)))
WS_TOKENS = f"list_filter(regexp_split_to_array(coalesce(text, ''), {_WS}), lambda x: x <> '')"

def _escaped(expr: str) -> str:
    return f"replace(replace(replace({expr}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


#: what the miner finds in ``documents_as_pages``: tables (tt), paragraphs (ps), their pairs (pr)
MINED_CTES = f"""ln AS (SELECT doc_id, source, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS n,
               unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
        fst AS (SELECT doc_id, coalesce(max(source), '') AS source, max(line) FILTER (n = 0) AS caption,
                       coalesce(max(line) FILTER (n = 1), '') AS body FROM ln GROUP BY doc_id),
        tb AS (SELECT doc_id, 'S1.T1' AS table_id, trim(caption) AS caption, trim(body) AS body,
                      '<table class=''ltx_tabular''><tr><td>' || {_escaped('body')} || '</td></tr></table>' AS markup FROM fst
               UNION ALL SELECT doc_id, 'S1.T10', '', source,
                      '<table class=''ltx_tabular'' id=''S1.T10''><tr><td>' || {_escaped('source')} || '</td></tr></table>' FROM fst),
        tt AS (SELECT *, {_terms_sql("caption || ' ' || body")} AS terms FROM tb),
        ps AS (SELECT doc_id, n, n % 5 = 1 AS c10, n % 7 = 2 AS c1, {_terms_sql('line')} AS terms,
                      line || CASE WHEN n % 5 = 1 THEN 'see' ELSE '' END || CASE WHEN n % 7 = 2 THEN 'see' ELSE '' END AS plain,
                      '<p>' || {_escaped('line')}
                      || CASE WHEN n % 5 = 1 THEN '<a href="#S1.T10">see</a>' ELSE '' END
                      || CASE WHEN n % 7 = 2 THEN '<a href="x.html#S1.T1">see</a>' ELSE '' END || '</p>' AS html FROM ln),
        pr AS (SELECT tt.doc_id, table_id, n, html, plain, c10 OR (c1 AND table_id = 'S1.T1') AS cites,
                      list_sort(list_intersect(tt.terms, ps.terms)) AS shared FROM tt JOIN ps ON tt.doc_id = ps.doc_id)"""

ORACLE_ANALYSIS = {
    "informative_terms": f"""SELECT item_id, len(t) AS n_terms, array_to_string(t, ' ') AS terms
        FROM (SELECT item_id, {_terms_sql('text')} AS t FROM benchmark)""",
    "stopword_anti": f"""WITH tk AS (SELECT unnest({K.letters('text')}) AS term FROM documents),
        st AS (SELECT * FROM (VALUES {_ALLSTOP}) v(term))
        SELECT term, count(*) AS n FROM tk WHERE term NOT IN (SELECT term FROM st) GROUP BY term""",
    "tokens_standard": f"""WITH tk AS (SELECT doc_id, {_standard_sql('text')} AS toks FROM documents)
        SELECT doc_id, unnest(range(len(toks))) AS pos, unnest(toks) AS term FROM tk""",
    "multi_field_unpivot": f"""WITH ft0 AS ({K.article_fields_cte()[len('ft AS ('):-1]})
        SELECT doc_id, field,
          CASE WHEN field IN ('title', 'authors') THEN len({K.letters('text')})
               WHEN field IN ('paragraphs', 'articleAbstract')
                 THEN len({_standard_sql('text')})
               ELSE len({WS_TOKENS}) END AS n_tokens
        FROM ft0 WHERE text IS NOT NULL""",
    "term_overlap_join": f"""WITH it AS (SELECT item_id, unnest({_terms_sql('text')}) AS term FROM benchmark),
        ln AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS line_no,
                      unnest(string_split(text, chr(10))) AS line FROM documents),
        lt AS (SELECT doc_id, line_no, unnest({_terms_sql('line')}) AS term FROM ln)
        SELECT it.item_id, lt.doc_id, lt.line_no, count(*) AS n_shared,
               array_to_string(list_sort(list(it.term)), ' ') AS matched_terms
        FROM it JOIN lt USING (term) GROUP BY it.item_id, lt.doc_id, lt.line_no HAVING count(*) >= 2""",
    "mined_records": f"""WITH {MINED_CTES},
        ls AS (SELECT doc_id, table_id, count(*) FILTER (cites) AS n_citing, count(*) FILTER (NOT cites AND len(shared) >= 2) AS n_contextual,
                      string_agg(html, chr(10) ORDER BY n) FILTER (cites) AS citing,
                      string_agg(html || '|' || array_to_string(shared, ' '), chr(10) ORDER BY n) FILTER (NOT cites AND len(shared) >= 2) AS ctx
               FROM pr GROUP BY doc_id, table_id)
        SELECT tt.doc_id AS page_id, tt.table_id, caption, body, array_to_string(terms, ' ') AS terms, n_citing, n_contextual,
               sha256(coalesce(citing, '')) AS citing_sha256, sha256(coalesce(ctx, '')) AS contextual_sha256
        FROM tt JOIN ls ON tt.doc_id = ls.doc_id AND tt.table_id = ls.table_id""",
    "json_map_explode": """SELECT event_id, k AS key, json_extract_string(props, '$."' || k || '"') AS value
        FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events WHERE json_valid(props))""",
    "ledger_batches": f"""WITH lg AS (SELECT event_id AS idx, CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'skipped'
                 ELSE 'downloaded' END AS status, value AS seconds, strlen(coalesce(props, '')) AS bytes FROM events),
        n AS (SELECT count(*) AS k FROM lg)
        SELECT idx // {crawl.BATCH_SIZE} AS batch, (idx // {crawl.BATCH_SIZE}) * {crawl.BATCH_SIZE} AS start_offset,
               least({crawl.BATCH_SIZE}, max(n.k) - (idx // {crawl.BATCH_SIZE}) * {crawl.BATCH_SIZE}) AS page_size,
               count(*) AS processed, count_if(status = 'downloaded') AS downloaded,
               count_if(status = 'skipped') AS skipped, count_if(status = 'error') AS errors,
               count_if(status = 'downloaded') = 0 AS empty_batch
        FROM lg, n GROUP BY idx // {crawl.BATCH_SIZE}""",
    "ledger_totals": """WITH lg AS (SELECT CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'skipped'
                 ELSE 'downloaded' END AS status, value AS seconds, strlen(coalesce(props, '')) AS bytes FROM events)
        SELECT count(*) AS requested, count(*) AS processed, count_if(status = 'downloaded') AS downloaded,
               count_if(status = 'skipped') AS skipped, count_if(status = 'error') AS errors,
               round(sum(seconds), 6) AS total_seconds,
               round(sum(seconds) / nullif(count_if(status = 'downloaded'), 0), 6) AS seconds_per_download,
               round(sum(CASE WHEN status = 'downloaded' THEN bytes ELSE 0 END) / 1048576.0, 6) AS size_mb
        FROM lg""",
    "ledger_rollup": f"""WITH lg AS (SELECT event_id // {crawl.BATCH_SIZE} AS batch, CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'skipped'
                 ELSE 'downloaded' END AS status, value AS seconds, strlen(coalesce(props, '')) AS bytes FROM events),
        parts AS (SELECT batch, 0 AS level, * EXCLUDE (batch) FROM lg UNION ALL SELECT NULL, 1, * EXCLUDE (batch) FROM lg)
        SELECT batch, level, count(*) AS processed, count_if(status = 'downloaded') AS downloaded,
               count_if(status = 'skipped') AS skipped, count_if(status = 'error') AS errors,
               round(sum(seconds), 6) AS total_seconds,
               round(sum(seconds) / nullif(count_if(status = 'downloaded'), 0), 6) AS seconds_per_download,
               CAST(sum(CASE WHEN status = 'downloaded' THEN bytes ELSE 0 END) AS BIGINT) AS bytes
        FROM parts GROUP BY batch, level""",
}
