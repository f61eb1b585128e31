"""Article extraction from HTML pages (EXT1-EXT5, EXT8, SRC5-SRC7, EXT15).

Every rule is a selection over the interval-encoded ``elements`` of a page followed by a
per-page aggregation; the fallback chains are ``coalesce`` over candidates ranked by
priority and document order. Results are keyed by ``page_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import dom
from quarry.plans.corpus import NO_ABSTRACT, NO_TITLE, UNKNOWN_DATE
from quarry.session import ensure_checkpoint_dir


def file_name(url: Column) -> Column:
    """Last path segment of a URL or path (query and fragment removed)."""
    path = F.regexp_replace(url, "[?#].*$", "")
    return F.element_at(F.split(path, "/"), -1)


def article_file_id(href: Column) -> Column:
    """Stored file name of a fetched paper: ``basename(href) + '.html'`` (SRC7)."""
    return F.concat(file_name(href), F.lit(".html"))


def paper_id(name: Column) -> Column:
    """Paper id from a file name: strip ``_data.json`` / ``.json`` / ``.html`` (EXT15)."""
    return F.regexp_replace(F.regexp_replace(name, "_data\\.json$|\\.json$", ""), "(?i)\\.html$", "")


def dom_tables(pages: DataFrame, keep: bool = True) -> tuple[DataFrame, DataFrame]:
    """Segments and elements of the pages. Both are read by many selections of one job, so they are
    written once to the shared checkpoint folder: the selections' plans start there, and a lost
    executor costs nothing that went before. ``keep=False`` for jobs that read them once."""
    segs = dom.segments(pages)
    if keep:
        ensure_checkpoint_dir(pages.sparkSession)
        segs = segs.checkpoint()
    els = dom.elements(segs)
    return segs, els.checkpoint() if keep else els


def _first_text(texts: DataFrame, priority: Column | None = None) -> DataFrame:
    """(page_id, st, text[, prio]) -> first text per page by (priority, st)."""
    key = F.struct(priority if priority is not None else F.lit(0), F.col("st"))
    return texts.groupBy("page_id").agg(F.min_by("text", key).alias("text"))


def _ordered_list(texts: DataFrame, name: str) -> DataFrame:
    return texts.groupBy("page_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("st", "text"))), lambda x: x["text"]).alias(name))


def titles(segs: DataFrame, els: DataFrame, tags: set[str] | None = None) -> DataFrame:
    """EXT1: ``h1.ltx_title_document`` > ``article-title`` > ``title`` > placeholder."""
    cand = els.where(((F.col("tag") == "h1") & dom.has_class(F.col("attr_class"), "ltx_title_document"))
                     | F.col("tag").isin("article-title", "title"))
    prio = F.when(F.col("tag") == "h1", 0).when(F.col("tag") == "article-title", 1).otherwise(2)
    cand = cand.withColumn("prio", prio)
    parts = []
    for p, tag in ((0, "h1"), (1, "article-title"), (2, "title")):  # each selection non-nesting
        if tags is None or tag in tags:
            sel = cand.where(F.col("prio") == p)
            parts.append(dom.element_texts(sel, segs).withColumn("prio", F.lit(p)))
    if not parts:
        return els.select("page_id").distinct().withColumn("title", F.lit(None).cast("string"))
    texts = parts[0]
    for extra in parts[1:]:
        texts = texts.unionByName(extra)
    return _first_text(texts, F.col("prio")).withColumnRenamed("text", "title")


def authors(segs: DataFrame, els: DataFrame) -> DataFrame:
    """EXT2: every ``span.ltx_personname`` text; else each
    ``contrib[contrib-type=author] name`` as ``given-names + ' ' + surname``."""
    spans = els.where((F.col("tag") == "span") & dom.has_class(F.col("attr_class"), "ltx_personname"))
    latex = _ordered_list(dom.element_texts(spans, segs), "a1")
    contribs = els.where((F.col("tag") == "contrib") & (F.lower(dom._attr(F.col("head"), "contrib-type")) == "author"))
    names = els.where(F.col("tag") == "name")
    names_in = (dom.nearest_enclosing(names.select("page_id", "st"), contribs)
                .where(F.col("anc_st").isNotNull()).select("page_id", "st"))
    names_in = names_in.join(names.select("page_id", "st", "en"), ["page_id", "st"])
    parts = els.where(F.col("tag").isin("surname", "given-names"))
    part_txt = dom.element_texts(parts.where(F.col("tag") == "surname"), segs).withColumn("kind", F.lit("surname")) \
        .unionByName(dom.element_texts(parts.where(F.col("tag") == "given-names"), segs).withColumn("kind", F.lit("given")))
    owner = dom.nearest_enclosing(part_txt.select("page_id", "st"), names_in).select("page_id", "st", F.col("anc_st").alias("name_st"))
    per_name = (part_txt.join(owner, ["page_id", "st"]).where(F.col("name_st").isNotNull())
                .groupBy("page_id", "name_st")
                .agg(F.concat_ws(" ", F.collect_list(F.when(F.col("kind") == "given", F.col("text")))).alias("given"),
                     F.concat_ws(" ", F.collect_list(F.when(F.col("kind") == "surname", F.col("text")))).alias("surname")))
    pubmed = _ordered_list(per_name.select("page_id", F.col("name_st").alias("st"),
                                           F.concat(F.col("given"), F.lit(" "), F.col("surname")).alias("text")), "a2")
    return (latex.join(pubmed, "page_id", "full")
            .select("page_id", F.when(F.size(F.coalesce("a1", F.array())) > 0, F.col("a1"))
                    .otherwise(F.coalesce("a2", F.array().cast("array<string>"))).alias("authors")))


def _p_inside(segs: DataFrame, els: DataFrame, container: Column) -> DataFrame:
    ps = els.where(F.col("tag") == "p")
    inside = (dom.nearest_enclosing(ps.select("page_id", "st"), els.where(container))
              .where(F.col("anc_st").isNotNull()).select("page_id", "st"))
    return dom.element_texts(ps.join(inside, ["page_id", "st"], "left_semi"), segs)


def abstracts(segs: DataFrame, els: DataFrame) -> DataFrame:
    """EXT3: text of all ``div.ltx_abstract p`` joined by a space; else ``abstract p``."""
    latex = _ordered_list(_p_inside(segs, els, (F.col("tag") == "div") & dom.has_class(F.col("attr_class"), "ltx_abstract")), "x1")
    pub = _ordered_list(_p_inside(segs, els, F.col("tag") == "abstract"), "x2")
    return (latex.join(pub, "page_id", "full")
            .select("page_id", F.coalesce(F.array_join("x1", " "), F.array_join("x2", " ")).alias("articleAbstract")))


def dates(segs: DataFrame, els: DataFrame) -> DataFrame:
    """EXT4: first ``pub-date``: year[-mm[-dd]], one-character month/day padded with 0."""
    first_pd = els.where(F.col("tag") == "pub-date").groupBy("page_id").agg(F.min("st").alias("st"))
    pd_iv = first_pd.join(els.select("page_id", "st", "en"), ["page_id", "st"])
    out = first_pd.select("page_id")
    for part in ("year", "month", "day"):
        sel = els.where(F.col("tag") == part)
        txt = dom.element_texts(sel, segs)
        owner = dom.nearest_enclosing(txt.select("page_id", "st"), els.where(F.col("tag") == "pub-date"))
        inside = (txt.join(owner, ["page_id", "st"]).join(pd_iv.select("page_id", F.col("st").alias("anc_st")), ["page_id", "anc_st"]))
        # select('year').text() joins every match by a space
        agg = inside.groupBy("page_id").agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("st", "text"))), lambda x: x["text"]), " ").alias(part))
        out = out.join(agg, "page_id", "left")
    y, m, d = (F.coalesce(F.col(c), F.lit("")) for c in ("year", "month", "day"))
    pad = lambda c: F.when(F.length(c) == 1, F.concat(F.lit("0"), c)).otherwise(c)
    date = (F.when(y == "", F.lit(None))
            .when(m == "", y)
            .when(d == "", F.concat(y, F.lit("-"), pad(m)))
            .otherwise(F.concat(y, F.lit("-"), pad(m), F.lit("-"), pad(d))))
    return out.select("page_id", date.alias("publicationDate"))


def paragraphs(segs: DataFrame, els: DataFrame) -> DataFrame:
    """EXT5: ``p.ltx_p`` texts in document order; if none, every ``p`` inside ``body``."""
    ps = els.where(F.col("tag") == "p")
    latex = _ordered_list(dom.element_texts(ps.where(dom.has_class(F.col("attr_class"), "ltx_p")), segs), "p1")
    body = _ordered_list(body_paragraphs(segs, els), "p2")
    return (latex.join(body, "page_id", "full")
            .select("page_id", F.when(F.size(F.coalesce("p1", F.array())) > 0, F.col("p1"))
                    .otherwise(F.coalesce("p2", F.array().cast("array<string>"))).alias("paragraphs")))


#: element names that a selection of extract_articles starts from
SELECTED_TAGS = ["h1", "article-title", "title", "span", "contrib", "p", "div", "abstract", "pub-date"]


def present_tags(els: DataFrame) -> set[str]:
    """Which of ``SELECTED_TAGS`` the corpus holds, in one row of flags; used to leave out fallback
    branches that cannot fire."""
    flags = els.agg(*(F.max(F.col("tag") == t).alias(t) for t in SELECTED_TAGS)).first()
    return {t for t in SELECTED_TAGS if flags[t]}


def _inside_first(els: DataFrame, inner: DataFrame, tag: str) -> DataFrame:
    """Rows of ``inner`` inside the first ``tag`` element of their page (one interval per
    page, so this is a plain equi-join on page_id)."""
    first = (els.where(F.col("tag") == tag).groupBy("page_id")
             .agg(F.min_by(F.struct("st", "en"), F.col("st")).alias("c")))
    return (inner.join(first, "page_id")
            .where((F.col("st") > F.col("c.st")) & (F.col("st") <= F.col("c.en"))).drop("c"))


def body_paragraphs(segs: DataFrame, els: DataFrame) -> DataFrame:
    """Texts of every ``p`` inside ``body``: (page_id, st, text)."""
    ps = _inside_first(els, els.where(F.col("tag") == "p"), "body")
    return dom.element_texts(ps, segs)


def extract_articles(pages: DataFrame, id_col: Column | None = None) -> DataFrame:
    """pages(page_id, url, html) -> articles(page_id, id, title, authors, paragraphs,
    articleAbstract, publicationDate). ``id`` defaults to the page's file name."""
    segs, els = dom_tables(pages)
    tags = present_tags(els)
    ids = pages.select("page_id", (id_col if id_col is not None else file_name(F.col("url"))).alias("id"))
    out = ids.join(titles(segs, els, tags), "page_id", "left")
    if tags & {"span", "contrib"}:
        out = out.join(authors(segs, els), "page_id", "left")
    else:
        out = out.withColumn("authors", F.lit(None).cast("array<string>"))
    if "p" in tags:
        if "div" in tags or "abstract" in tags:
            out = out.join(abstracts(segs, els), "page_id", "left")
        else:
            out = out.withColumn("articleAbstract", F.lit(None).cast("string"))
        out = out.join(paragraphs(segs, els), "page_id", "left")
    else:
        out = (out.withColumn("articleAbstract", F.lit(None).cast("string"))
               .withColumn("paragraphs", F.lit(None).cast("array<string>")))
    if "pub-date" in tags:
        out = out.join(dates(segs, els), "page_id", "left")
    else:
        out = out.withColumn("publicationDate", F.lit(None).cast("string"))
    return out.select("page_id", "id",
                      F.coalesce("title", F.lit(NO_TITLE)).alias("title"),
                      F.coalesce("authors", F.array().cast("array<string>")).alias("authors"),
                      F.coalesce("paragraphs", F.array().cast("array<string>")).alias("paragraphs"),
                      F.coalesce("articleAbstract", F.lit(NO_ABSTRACT)).alias("articleAbstract"),
                      F.coalesce("publicationDate", F.lit(UNKNOWN_DATE)).alias("publicationDate"))


def source_titles(pages: DataFrame, segs: DataFrame | None = None, els: DataFrame | None = None, texts: DataFrame | None = None) -> DataFrame:
    """EXT8: text of the first ``<title>`` (raw text, outer whitespace stripped); when
    blank, the file name. ``texts``: the raw texts of all ``<title>`` elements, if known."""
    if texts is None:
        if segs is None or els is None:
            segs, els = dom_tables(pages)
        texts = dom.element_texts(els.where(F.col("tag") == "title"), segs, mode="raw")
    t = _first_text(texts)
    return (pages.select("page_id", file_name(F.col("url")).alias("fname")).join(t, "page_id", "left")
            .select("page_id", F.coalesce(F.when(F.col("text") != "", F.col("text")), F.col("fname")).alias("source_file")))


def links(els: DataFrame, inside_tag: str | None = None, inside_class: str | None = None) -> DataFrame:
    """Anchors with an href, numbered in document order per page (SRC5). Optionally only
    anchors inside a ``<inside_tag class=inside_class>`` element."""
    anchors = els.where((F.col("tag") == "a") & F.col("href").isNotNull())
    if inside_tag is not None:
        cond = F.col("tag") == inside_tag
        if inside_class is not None:
            cond = cond & (F.col("attr_class") == inside_class)
        inside = (dom.nearest_enclosing(anchors.select("page_id", "st"), els.where(cond))
                  .where(F.col("anc_st").isNotNull()).select("page_id", "st"))
        anchors = anchors.join(inside, ["page_id", "st"], "left_semi")
    return anchors.select("page_id", "st", "href")


# Fixed value: id of the element offering the full-text (HTML) rendering on a landing page.
FULLTEXT_LINK_ID = "latexml-download-link"


def fulltext_status(pages: DataFrame, els: DataFrame) -> DataFrame:
    """SRC6/AGG10: a landing page offers a full text when an element with the fixed id
    exists; its href is taken. -> (page_id, href, status downloaded|skipped)."""
    link = (els.where(F.col("attr_id") == FULLTEXT_LINK_ID).groupBy("page_id")
            .agg(F.min_by("href", F.col("st")).alias("href")))
    return (pages.select("page_id").join(link, "page_id", "left")
            .select("page_id", "href", F.when(F.col("href").isNotNull(), F.lit("downloaded"))
                    .otherwise(F.lit("skipped")).alias("status")))


def first_links(els: DataFrame, k: int) -> DataFrame:
    """TOP3: the first ``k`` links of every page in document order (the batch cut-off is
    the feature); a per-page window keeps at most k rows per page."""
    w = Window.partitionBy("page_id").orderBy("st")
    return (links(els).withColumn("n", F.row_number().over(w)).where(F.col("n") <= k)
            .select("page_id", "n", "href", article_file_id(F.col("href")).alias("file_id")))
