"""Registered page (HTML) queries: extraction, DOM intervals, ancestors, corpus size."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import dom
from quarry.operators import extract as X
from quarry.plans import sqlkit as K
from quarry.plans.corpus import NO_TITLE
from quarry.sources.tables import read_table

CONTAINERS = ["nav", "ul", "li", "div", "article", "footer", "p", "b", "body"]
OUTSIDE = ["nav", "footer", "table"]
PAGE_SIZE = 25  # result page size of the listing (offset paging)


def _pages(spark, sf_dir):
    return read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])


def q_page_title(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    segs, els = X.dom_tables(pages)
    titles = X.titles(segs, els, X.present_tags(els))
    return (pages.select("page_id").join(titles, "page_id", "left")
            .select("page_id", F.coalesce("title", F.lit(NO_TITLE)).alias("title"))
            .join(X.source_titles(pages, segs, els), "page_id"))


def q_page_paragraphs(spark, sf_dir):
    segs, els = X.dom_tables(_pages(spark, sf_dir))
    return X.body_paragraphs(segs, els)


def q_page_links(spark, sf_dir):
    segs, els = X.dom_tables(_pages(spark, sf_dir), keep=False)
    return X.links(els).select("page_id", "st", "href", X.article_file_id(F.col("href")).alias("file_id"))


def q_page_text(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    segs = dom.segments(pages)
    whole = segs.groupBy("page_id").agg(F.min("pos").alias("st"), F.max("pos").alias("en"))
    return dom.element_texts(whole, segs).select("page_id", "text")


def q_page_url_id(spark, sf_dir):
    name = X.file_name(F.col("url"))
    return _pages(spark, sf_dir).select("page_id", name.alias("file_name"),
                                        X.article_file_id(F.col("url")).alias("article_file"),
                                        X.paper_id(name).alias("paper_id"))


def q_page_elements(spark, sf_dir):
    segs = dom.segments(_pages(spark, sf_dir))
    return dom.elements(segs).select("page_id", "st", "en", "tag", "attr_id", "attr_class", "href")


def q_page_nearest_ancestor(spark, sf_dir):
    """Nearest enclosing container (li/ul/nav/div/article/...) of every link."""
    segs, els = X.dom_tables(_pages(spark, sf_dir))
    anchors = els.where((F.col("tag") == "a") & F.col("href").isNotNull()).select("page_id", "st")
    near = dom.nearest_enclosing(anchors, els.where(F.col("tag").isin(CONTAINERS)), value="tag")
    return near.select("page_id", "st", "anc_st", F.col("anc_tag"))


def q_page_paragraphs_outside(spark, sf_dir):
    """Paragraphs not inside navigation, footer or table elements (EXT13)."""
    segs, els = X.dom_tables(_pages(spark, sf_dir))
    ps = els.where(F.col("tag") == "p").select("page_id", "st")
    near = dom.nearest_enclosing(ps, els.where(F.col("tag").isin(OUTSIDE)))
    return near.where(F.col("anc_st").isNull()).select("page_id", "st")


def q_page_article(spark, sf_dir):
    arts = X.extract_articles(_pages(spark, sf_dir))
    return arts.select("page_id", "id", "title", F.size("authors").alias("n_authors"), "articleAbstract",
                       "publicationDate", F.size("paragraphs").alias("n_paragraphs"),
                       F.array_join("paragraphs", "\n").alias("body"))


def q_corpus_size(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    return pages.agg(F.count(F.lit(1)).alias("n_pages"),
                     F.sum(F.octet_length("html")).alias("total_bytes"),
                     F.round(F.sum(F.octet_length("html")) / F.lit(1048576.0), 6).alias("size_mb"))


def q_file_order_limit(spark, sf_dir):
    """Second result page (rows 26-50) of the pages listed in file-name order."""
    pages = _pages(spark, sf_dir).select("page_id", X.file_name(F.col("url")).alias("file_name"))
    page = pages.orderBy("file_name", "page_id").offset(PAGE_SIZE).limit(PAGE_SIZE)
    w = Window.orderBy("file_name", "page_id")  # over the 25 kept rows only
    return page.withColumn("rank", F.row_number().over(w) + PAGE_SIZE)


QUERIES_PAGES = {
    "page_title": q_page_title,
    "page_paragraphs": q_page_paragraphs,
    "page_links": q_page_links,
    "page_text": q_page_text,
    "page_url_id": q_page_url_id,
    "page_elements": q_page_elements,
    "page_nearest_ancestor": q_page_nearest_ancestor,
    "page_paragraphs_outside": q_page_paragraphs_outside,
    "page_article": q_page_article,
    "corpus_size": q_corpus_size,
    "file_order_limit": q_file_order_limit,
}


# ---------------------------------------------------------------------------
# Oracles: the segment / interval algorithm restated in DuckDB SQL
# ---------------------------------------------------------------------------

def _inlist(xs):
    return "(" + ", ".join(K.q(x) for x in xs) + ")"


def _decode(expr: str) -> str:
    for ent, ch in dom.NAMED_ENTITIES:
        expr = f"replace({expr}, {K.q(ent)}, {K.q(ch)})"
    return expr


def _norm(expr: str) -> str:
    return f"trim(regexp_replace({_decode(expr)}, {K.q(dom.HTML_SPACE_RUN)}, ' ', 'g'))"


def _attr_sql(name: str) -> str:
    return (f"CASE WHEN regexp_matches(head, {K.q('(?i)\\s' + name + '\\s*=')}) THEN "
            f"regexp_extract(head, {K.q('(?i)\\s' + name + '\\s*=\\s*[\"' + chr(39) + ']([^\"' + chr(39) + ']*)[\"' + chr(39) + ']')}, 1) END")


DOM_CTES = f"""
  sp AS (SELECT page_id, url, string_split(regexp_replace(regexp_replace(coalesce(html, ''), {K.q(dom.STRIP_PATTERN)}, '', 'g'),
           '<([A-Za-z/!])', chr(1) || '<\\1', 'g'), chr(1)) AS parts FROM pages),
  s0 AS (SELECT page_id, unnest(parts) AS seg, unnest(range(len(parts))) AS pos FROM sp),
  s1 AS (SELECT page_id, pos, seg, regexp_extract(seg, {K.q(dom.HEAD_PATTERN)}) AS head,
                lower(regexp_extract(seg, {K.q(dom.TAG_PATTERN)}, 2)) AS name,
                regexp_extract(seg, {K.q(dom.TAG_PATTERN)}, 1) AS slash FROM s0),
  sg AS (SELECT page_id, pos, seg, head, nullif(name, '') AS tag, name <> '' AND slash = '/' AS is_close,
                name <> '' AND slash = '' AS is_open, substr(seg, length(head) + 1) AS txt FROM s1),
  pr AS (SELECT *, sum(CASE WHEN is_open THEN 1 ELSE -1 END) OVER (PARTITION BY page_id, tag ORDER BY pos
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
         FROM sg WHERE tag IS NOT NULL AND tag NOT IN {_inlist(dom.VOID_TAGS)}),
  lv AS (SELECT *, CASE WHEN is_open THEN run ELSE run + 1 END AS lvl FROM pr),
  pd AS (SELECT *, lead(pos) OVER (PARTITION BY page_id, tag, lvl ORDER BY pos) AS nxt,
                lead(is_close) OVER (PARTITION BY page_id, tag, lvl ORDER BY pos) AS nxt_close FROM lv),
  bd AS (SELECT page_id, pos,
                last_value(CASE WHEN tag IN {_inlist(dom.BLOCK_TAGS)} THEN pos END IGNORE NULLS) OVER (
                  PARTITION BY page_id ORDER BY pos DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS next_block,
                max(pos) OVER (PARTITION BY page_id) AS last_pos FROM sg),
  e0 AS (SELECT pd.page_id, pd.pos AS st,
                coalesce(CASE WHEN nxt_close THEN nxt END,
                         CASE WHEN tag IN {_inlist(dom.OPTIONAL_CLOSE)} OR tag NOT IN {_inlist(dom.BLOCK_TAGS)}
                              THEN next_block - 1 END,
                         last_pos) AS en, tag, head
         FROM pd JOIN bd ON bd.page_id = pd.page_id AND bd.pos = pd.pos WHERE is_open
         UNION ALL SELECT page_id, pos, pos, tag, head FROM sg WHERE tag IN {_inlist(dom.VOID_TAGS)} AND is_open),
  e1 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY st) AS i FROM e0),
  -- an element ends with the one around it at the latest: a page's elements in order, with the ends still open
  e2 AS (SELECT page_id, i, st, en, [en] AS ends FROM e1 WHERE i = 1
         UNION ALL
         SELECT n.page_id, n.i, n.st, least(n.en, coalesce(list_filter(e2.ends, lambda x: x >= n.st)[-1], n.en)),
                list_filter(e2.ends, lambda x: x >= n.st) || [least(n.en, coalesce(list_filter(e2.ends, lambda x: x >= n.st)[-1], n.en))]
         FROM e2 JOIN e1 n ON n.page_id = e2.page_id AND n.i = e2.i + 1),
  el AS (SELECT e1.page_id, e1.st, e2.en, tag, {_attr_sql('id')} AS attr_id, {_attr_sql('class')} AS attr_class,
                {_attr_sql('href')} AS href FROM e1 JOIN e2 ON e2.page_id = e1.page_id AND e2.i = e1.i)"""


def _texts_sql(selected: str, raw: bool = False) -> str:
    """Texts of non-nesting selected elements (CTE name ``selected`` with page_id, st, en)."""
    if raw:
        piece = "s.txt"
        final = f"regexp_replace({_decode('r')}, {K.q('^' + K_WS + '+|' + K_WS + '+$')}, '', 'g')"
    else:
        piece = (f"CASE WHEN s.tag IN {_inlist(dom.BLOCK_TAGS + ['br'])} AND s.pos <> x.st THEN ' ' ELSE '' END || s.txt")
        final = _norm("r")
    return f"""(SELECT page_id, st, {final} AS text FROM (
        SELECT x.page_id, x.st, string_agg({piece}, '' ORDER BY s.pos) AS r
        FROM {selected} x JOIN sg s ON s.page_id = x.page_id AND s.pos BETWEEN x.st AND x.en
        GROUP BY x.page_id, x.st))"""


from quarry.functions.text import WHITESPACE_CLASS as K_WS  # noqa: E402

_BODY_P = """bp AS (SELECT e.page_id, e.st, e.en FROM el e
          JOIN (SELECT page_id, arg_min(st, st) AS bst, arg_min(en, st) AS ben FROM el WHERE tag = 'body' GROUP BY page_id) b
            ON b.page_id = e.page_id
          WHERE e.tag = 'p' AND e.st > b.bst AND e.st <= b.ben)"""

_NAME = "string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1]"

ORACLE_PAGES = {
    "page_title": f"""WITH RECURSIVE {DOM_CTES},
        tt AS (SELECT page_id, arg_min(st, st) AS st, arg_min(en, st) AS en FROM el WHERE tag = 'title' GROUP BY page_id),
        nt AS {_texts_sql('tt')}, rt AS {_texts_sql('tt', raw=True)}
        SELECT p.page_id, coalesce(nt.text, 'No Title Found') AS title,
               coalesce(nullif(rt.text, ''), {_NAME}) AS source_file
        FROM pages p LEFT JOIN nt ON nt.page_id = p.page_id LEFT JOIN rt ON rt.page_id = p.page_id""",
    "page_paragraphs": f"""WITH RECURSIVE {DOM_CTES}, {_BODY_P} SELECT * FROM {_texts_sql('bp')}""",
    "page_links": f"""WITH RECURSIVE {DOM_CTES}
        SELECT page_id, st, href, string_split(regexp_replace(href, '[?#].*$', ''), '/')[-1] || '.html' AS file_id
        FROM el WHERE tag = 'a' AND href IS NOT NULL""",
    "page_text": f"""WITH RECURSIVE {DOM_CTES},
        wp AS (SELECT page_id, min(pos) AS st, max(pos) AS en FROM sg GROUP BY page_id)
        SELECT page_id, text FROM {_texts_sql('wp')}""",
    "page_url_id": f"""SELECT page_id, {_NAME} AS file_name, {_NAME} || '.html' AS article_file,
        regexp_replace(regexp_replace({_NAME}, '_data\\.json$|\\.json$', ''), '(?i)\\.html$', '') AS paper_id FROM pages""",
    "page_elements": f"WITH RECURSIVE {DOM_CTES} SELECT page_id, st, en, tag, attr_id, attr_class, href FROM el",
    "page_nearest_ancestor": f"""WITH RECURSIVE {DOM_CTES},
        a AS (SELECT page_id, st FROM el WHERE tag = 'a' AND href IS NOT NULL),
        c AS (SELECT page_id, st, en, tag FROM el WHERE tag IN {_inlist(CONTAINERS)})
        SELECT a.page_id, a.st, max(c.st) AS anc_st, arg_max(c.tag, c.st) AS anc_tag
        FROM a LEFT JOIN c ON c.page_id = a.page_id AND c.st < a.st AND a.st <= c.en
        GROUP BY a.page_id, a.st""",
    "page_paragraphs_outside": f"""WITH RECURSIVE {DOM_CTES}
        SELECT p.page_id, p.st FROM el p WHERE p.tag = 'p' AND NOT EXISTS (
          SELECT 1 FROM el c WHERE c.page_id = p.page_id AND c.tag IN {_inlist(OUTSIDE)} AND c.st < p.st AND p.st <= c.en)""",
    "page_article": f"""WITH RECURSIVE {DOM_CTES}, {_BODY_P},
        tt AS (SELECT page_id, arg_min(st, st) AS st, arg_min(en, st) AS en FROM el WHERE tag = 'title' GROUP BY page_id),
        nt AS {_texts_sql('tt')},
        pt AS {_texts_sql('bp')},
        pa AS (SELECT page_id, count(*) AS n, string_agg(text, chr(10) ORDER BY st) AS body FROM pt GROUP BY page_id)
        SELECT p.page_id, {_NAME} AS id, coalesce(nt.text, 'No Title Found') AS title, 0 AS n_authors,
               'No Abstract Found' AS articleAbstract, 'Unknown Date' AS publicationDate,
               coalesce(pa.n, 0) AS n_paragraphs, coalesce(pa.body, '') AS body
        FROM pages p LEFT JOIN nt ON nt.page_id = p.page_id LEFT JOIN pa ON pa.page_id = p.page_id""",
    "corpus_size": """SELECT count(*) AS n_pages, sum(strlen(html)) AS total_bytes,
        round(sum(strlen(html)) / 1048576.0, 6) AS size_mb FROM pages""",
    "file_order_limit": f"""SELECT page_id, file_name, rank FROM (
        SELECT page_id, {_NAME} AS file_name, row_number() OVER (ORDER BY {_NAME}, page_id) AS rank FROM pages)
        WHERE rank > {PAGE_SIZE} AND rank <= {2 * PAGE_SIZE}""",
}


ORACLE_PAGES["page_link_targets"] = f"""WITH RECURSIVE {DOM_CTES},
    l AS (SELECT page_id, st, regexp_replace(regexp_replace(string_split(regexp_replace(href, '[?#].*$', ''), '/')[-1],
            '_data\\.json$|\\.json$', ''), '(?i)\\.html$', '') AS target FROM el WHERE tag = 'a' AND href IS NOT NULL),
    t AS (SELECT page_id AS target_page, regexp_replace(regexp_replace({_NAME}, '_data\\.json$|\\.json$', ''),
            '(?i)\\.html$', '') AS target FROM pages)
    SELECT l.page_id, l.st, l.target, t.target_page FROM l LEFT JOIN t USING (target)"""

ORACLE_PAGES["mined_tables"] = f"""WITH RECURSIVE {DOM_CTES},
    tb AS (SELECT *, coalesce(contains(attr_class, 'ltx_tabular'), FALSE) AS is_tab FROM el WHERE tag = 'table'),
    cand AS (SELECT * FROM (SELECT *, max(is_tab) OVER (PARTITION BY page_id) AS any_tab FROM tb) WHERE is_tab OR NOT any_tab),
    ids AS (SELECT c.page_id, c.st, CASE WHEN coalesce(c.attr_id, '') <> '' THEN c.attr_id ELSE (
              SELECT arg_max(a.attr_id, a.st) FROM el a WHERE a.page_id = c.page_id AND a.attr_id IS NOT NULL
                AND a.st < c.st AND c.st <= a.en) END AS tid FROM cand c),
    n AS (SELECT page_id, count(DISTINCT tid) AS n FROM ids WHERE coalesce(tid, '') <> '' GROUP BY page_id)
    SELECT p.page_id, replace({_NAME}, '.html', '_data.json') AS json_name, coalesce(n.n, 0) AS n_tables
    FROM pages p LEFT JOIN n ON n.page_id = p.page_id"""


FIRST_LINKS = 3  # links kept per page (batch cut-off)


def q_page_fulltext_status(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    segs, els = X.dom_tables(pages, keep=False)
    return X.fulltext_status(pages, els)


def q_page_first_links(spark, sf_dir):
    segs, els = X.dom_tables(_pages(spark, sf_dir), keep=False)
    return X.first_links(els, FIRST_LINKS)


QUERIES_PAGES["page_fulltext_status"] = q_page_fulltext_status
QUERIES_PAGES["page_first_links"] = q_page_first_links
ORACLE_PAGES["page_fulltext_status"] = f"""WITH RECURSIVE {DOM_CTES},
    l AS (SELECT page_id, arg_min(href, st) AS href FROM el WHERE attr_id = {K.q(X.FULLTEXT_LINK_ID)} GROUP BY page_id)
    SELECT p.page_id, l.href, CASE WHEN l.href IS NOT NULL THEN 'downloaded' ELSE 'skipped' END AS status
    FROM pages p LEFT JOIN l ON l.page_id = p.page_id"""
ORACLE_PAGES["page_first_links"] = f"""WITH RECURSIVE {DOM_CTES},
    a AS (SELECT page_id, st, href, row_number() OVER (PARTITION BY page_id ORDER BY st) AS n
          FROM el WHERE tag = 'a' AND href IS NOT NULL)
    SELECT page_id, n, href, string_split(regexp_replace(href, '[?#].*$', ''), '/')[-1] || '.html' AS file_id
    FROM a WHERE n <= {FIRST_LINKS}"""
