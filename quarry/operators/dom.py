"""HTML as relational intervals (no per-row HTML parser).

pages(page_id, html)
  -> segments(page_id, pos, seg, ...)  html split before every tag: a segment is one tag
                                        plus the text that follows it
  -> elements(page_id, st, en, tag, attr_id, attr_class, href, ...)
                                        each element is the segment interval [st, en]

Pairing an open tag with its close tag is a per-(page, tag) running level plus ``lead``
inside (page, tag, level): only window functions, partitioned by page, so the work is
linear in the page size. Unclosed elements (``<p>`` before the next ``<p>``, stray
inline tags) end before the next block-level tag boundary, as HTML parsers close them.

Ancestor questions ("nearest enclosing element of kind X") are answered with a running
depth over X's interval boundaries and a per-depth running ``last`` (a stack expressed
as windows) -- no pairwise containment join inside a page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import WHITESPACE_CLASS

# Fixed HTML vocabulary (from the HTML standard).
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
             "source", "track", "wbr"]
BLOCK_TAGS = ["address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "dialog",
              "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
              "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "li", "main", "nav", "ol", "p",
              "pre", "section", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul"]
# Elements whose end tag may be omitted (closed by the next block boundary).
OPTIONAL_CLOSE = ["p", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "option", "colgroup"]
# Named character references decoded in text (the common ones; '&amp;' last).
NAMED_ENTITIES = [("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
                  ("&#39;", "'"), ("&copy;", "\u00a9"), ("&reg;", "\u00ae"), ("&middot;", "\u00b7"),
                  ("&hellip;", "\u2026"), ("&mdash;", "\u2014"), ("&ndash;", "\u2013"), ("&amp;", "&")]
# jsoup-style whitespace (collapsed in normalised text).
HTML_SPACE_RUN = "[ \\t\\n\\f\\r\\x{a0}]+"

SPLIT_MARK = "\u0001"
STRIP_PATTERN = "(?is)<script[^>]*>.*?</script\\s*>|<style[^>]*>.*?</style\\s*>|<!--.*?-->"
TAG_PATTERN = "^<(/?)([A-Za-z][A-Za-z0-9-]*)"
HEAD_PATTERN = "^<[^>]*>"


def _attr(head: Column, name: str) -> Column:
    """Value of a quoted attribute in a tag head (null when absent)."""
    v = F.regexp_extract(head, f"(?i)\\s{name}\\s*=\\s*[\"']([^\"']*)[\"']", 1)
    has = head.rlike(f"(?i)\\s{name}\\s*=")
    return F.when(has, v)


def decode_entities(text: Column) -> Column:
    for ent, ch in NAMED_ENTITIES:
        text = F.replace(text, F.lit(ent), F.lit(ch))
    return text


def normalise_space(text: Column) -> Column:
    """Collapse whitespace runs to one space and trim (jsoup ``text()`` style)."""
    return F.trim(F.regexp_replace(text, HTML_SPACE_RUN, " "))


def strip_outer(text: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace only."""
    return F.regexp_replace(text, f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$", "")


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once a row: the optimizer may repeat a column's expression where it is
    used, even for each element in a lambda, but not a lambda's variable."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _marked(html: Column) -> Column:
    """The page's markup without scripts, styles and comments, with a mark before every tag."""
    clean = F.regexp_replace(F.coalesce(html, F.lit("")), STRIP_PATTERN, "")
    return F.regexp_replace(clean, "<([A-Za-z/!])", SPLIT_MARK + "<$1")


def segments(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, pos, seg, tag, is_open, is_close, head, txt) -- one row per segment."""
    marked = _marked(F.col(html))
    # hash-partition the pages once: every later window / join is keyed by page_id (plus
    # more columns) and reuses this partitioning instead of shuffling again
    pages = pages.repartition(F.col(key))
    # posexplode_outer: a plain posexplode makes the optimizer add a size() > 0 filter that
    # evaluates the regex rewrite of the whole page a second time (split never returns [])
    segs = pages.select(F.col(key).alias("page_id"), F.posexplode_outer(F.split(marked, SPLIT_MARK)).alias("pos", "seg"))
    head = F.regexp_extract("seg", HEAD_PATTERN, 0)
    name = F.lower(F.regexp_extract("seg", TAG_PATTERN, 2))
    slash = F.regexp_extract("seg", TAG_PATTERN, 1)
    return (segs.withColumn("head", head)
            .withColumn("tag", F.when(name != "", name))
            .withColumn("is_close", F.col("tag").isNotNull() & (slash == "/"))
            .withColumn("is_open", F.col("tag").isNotNull() & (slash == ""))
            .withColumn("txt", F.substring("seg", F.length("head") + 1, 1 << 30)))


def elements(segs: DataFrame) -> DataFrame:
    """Interval-encoded elements: (page_id, st, en, tag, attr_id, attr_class, href, head).

    ``st`` is the segment of the open tag, ``en`` the last segment inside the element
    (its close tag when present). Void elements have ``st == en``.
    """
    tagged = segs.where(F.col("tag").isNotNull())
    paired_rows = tagged.where(~F.col("tag").isin(VOID_TAGS))
    by_tag = Window.partitionBy("page_id", "tag").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    run = F.sum(F.when(F.col("is_open"), 1).otherwise(-1)).over(by_tag)
    lv = paired_rows.withColumn("lvl", F.when(F.col("is_open"), run).otherwise(run + 1))
    by_lvl = Window.partitionBy("page_id", "tag", "lvl").orderBy("pos")
    paired = (lv.withColumn("nxt", F.lead("pos").over(by_lvl))
              .withColumn("nxt_close", F.lead("is_close").over(by_lvl))
              .where("is_open")
              .withColumn("en_pair", F.when(F.col("nxt_close"), F.col("nxt"))))
    # next block boundary after each segment (running 'last' over the reversed order)
    boundary = F.when(F.col("tag").isin(BLOCK_TAGS), F.col("pos"))
    rev = Window.partitionBy("page_id").orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, -1)
    page_end = Window.partitionBy("page_id")
    bounds = segs.select("page_id", "pos",
                         F.last(boundary, ignorenulls=True).over(rev).alias("next_block"),
                         F.max("pos").over(page_end).alias("last_pos"))
    opened = (paired.join(bounds, ["page_id", "pos"])
              .withColumn("en", F.coalesce(
                  "en_pair",
                  # unclosed optional-close or inline element: ends before the next block
                  # boundary; an unclosed block container runs to the end of the page
                  F.when(F.col("tag").isin(OPTIONAL_CLOSE) | ~F.col("tag").isin(BLOCK_TAGS), F.col("next_block") - 1),
                  "last_pos"))
              .select("page_id", F.col("pos").alias("st"), "en", "tag", "head"))
    void = tagged.where(F.col("tag").isin(VOID_TAGS) & F.col("is_open")).select(
        "page_id", F.col("pos").alias("st"), F.col("pos").alias("en"), "tag", "head")
    return (properly_nested(opened.unionByName(void))
            .withColumn("attr_id", _attr(F.col("head"), "id"))
            .withColumn("attr_class", _attr(F.col("head"), "class"))
            .withColumn("href", _attr(F.col("head"), "href")))


def _crossings(spans: Column) -> Column:
    """The (st, new en) of those of a page's elements, an array of (st, en), that reach beyond the end of one they begin in."""
    def step(acc: Column, x: Column) -> Column:
        still = F.filter(acc["stack"], lambda e: e >= x["st"])
        end = F.least(x["en"], F.coalesce(F.try_element_at(still, F.lit(-1)), x["en"]))
        return F.struct(F.concat(still, F.array(end)).alias("stack"),
                        F.when(end < x["en"], F.concat(acc["cut"], F.array(F.struct(x["st"].alias("st"), end.alias("en"))))).otherwise(acc["cut"]).alias("cut"))

    start = F.struct(F.array().cast("array<int>").alias("stack"), F.array().cast("array<struct<st:int,en:int>>").alias("cut"))
    return F.aggregate(F.sort_array(spans), start, step, lambda acc: acc["cut"])


def properly_nested(els: DataFrame) -> DataFrame:
    """Elements that reach beyond the end of an element they begin in are cut to that end, as a parser closes
    them. A fold over a page's elements in order keeps the ends of those open, each at most that of the one
    around it, and remembers the few it had to cut; a page's (st, en) pairs are in one row, its text is not."""
    fold = _crossings(F.collect_list(F.struct(F.col("st").cast("int").alias("st"), F.col("en").cast("int").alias("en"))))
    cuts = els.groupBy("page_id").agg(fold.alias("_cut")).where(F.size("_cut") > 0).select("page_id", F.map_from_entries("_cut").alias("_cut"))
    return (els.join(cuts, "page_id", "left")
            .withColumn("en", F.coalesce(F.try_element_at("_cut", F.col("st").cast("int")), "en")).drop("_cut"))


def page_elements(pages: DataFrame) -> DataFrame:
    """As :func:`elements`, for pages with distinct ids: (page_id, els), a page's elements as an array of (st, en, tag,
    attr_id, attr_class, href) in the order of their starts.

    Tags are cut out where their page is read, and only they are exchanged, once: every window is per page,
    block boundaries are found before tags are paired, and elements that cross are cut in their page's row."""
    segs = pages.select("page_id", F.posexplode_outer(html_segments(F.col("html"))).alias("pos", "seg"))
    name = F.lower(F.regexp_extract("seg", TAG_PATTERN, 2))
    tags = (segs.select("page_id", "pos", F.regexp_extract("seg", HEAD_PATTERN, 0).alias("head"), F.nullif(name, F.lit("")).alias("tag"),
                        (F.regexp_extract("seg", TAG_PATTERN, 1) == "").alias("is_open"))
            .select("page_id", "pos", "tag", "is_open", *(F.when(F.col("tag").isNotNull() & F.col("is_open"), _attr(F.col("head"), a)).alias(c)
                                                          for a, c in (("id", "attr_id"), ("class", "attr_class"), ("href", "href"))))
            .repartition("page_id"))
    rev = Window.partitionBy("page_id").orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, -1)
    bounds = tags.withColumn("next_block", F.last(F.when(F.col("tag").isin(BLOCK_TAGS), F.col("pos")), ignorenulls=True).over(rev)) \
        .withColumn("last_pos", F.max("pos").over(Window.partitionBy("page_id"))).where(F.col("tag").isNotNull())
    by_tag = Window.partitionBy("page_id", "tag").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    run = F.sum(F.when(F.col("is_open"), 1).otherwise(-1)).over(by_tag)
    by_lvl = Window.partitionBy("page_id", "tag", "lvl").orderBy("pos")
    paired = (bounds.withColumn("lvl", F.when(F.col("is_open"), run).otherwise(run + 1))
              .withColumn("en_pair", F.when(~F.lead("is_open").over(by_lvl), F.lead("pos").over(by_lvl))).where("is_open"))
    loose = F.when(F.col("tag").isin(OPTIONAL_CLOSE) | ~F.col("tag").isin(BLOCK_TAGS), F.col("next_block") - 1)
    end = F.when(F.col("tag").isin(VOID_TAGS), F.col("pos")).otherwise(F.coalesce("en_pair", loose, "last_pos"))
    attrs = ("tag", "attr_id", "attr_class", "href")
    rows = paired.groupBy("page_id").agg(F.collect_list(F.struct(F.col("pos").alias("st"), end.alias("en"), *attrs)).alias("els"))
    cuts = F.map_from_entries(_crossings(F.transform("els", lambda e: F.struct(e["st"].alias("st"), e["en"].alias("en")))))
    return rows.select("page_id", bound(cuts, lambda cut: F.sort_array(F.transform("els", lambda e: F.struct(
        e["st"].alias("st"), F.coalesce(F.try_element_at(cut, e["st"]), e["en"]).alias("en"), *(e[a].alias(a) for a in attrs))))).alias("els"))


def has_class(cls_col: Column, name: str) -> Column:
    """CSS ``.name`` selector: ``name`` is one of the whitespace-separated classes."""
    return F.array_contains(F.split(F.coalesce(cls_col, F.lit("")), "\\s+"), name)


def _chains(selected: DataFrame) -> DataFrame:
    """(page_id, st, en, above): the selected elements around each selected one, as an array of starts.

    A running count of the open elements gives each its level; on every level above its own, the element
    around it is the latest one opened before it. Work and rows follow the selected elements only."""
    ends = selected.select("page_id", F.col("st").cast("double").alias("p"), F.lit(1).alias("d"), "st", "en").unionByName(
        selected.select("page_id", (F.col("en") + F.lit(0.5)).alias("p"), F.lit(-1).alias("d"), F.lit(None).cast("int").alias("st"), F.lit(None).cast("int").alias("en")))
    running = Window.partitionBy("page_id").orderBy("p", "d").rowsBetween(Window.unboundedPreceding, 0)
    levels = ends.withColumn("level", F.sum("d").over(running)).where("st is not null").select("page_id", "st", "en", "level")
    # each element once on its own level, with its place, and once on every level above
    spread = levels.withColumn("at", F.explode(F.sequence(F.lit(1).cast("long"), F.col("level"))))
    latest = Window.partitionBy("page_id", "at").orderBy("st").rowsBetween(Window.unboundedPreceding, 0)
    found = spread.withColumn("around", F.last(F.when(F.col("at") == F.col("level"), F.col("st")), ignorenulls=True).over(latest))
    return found.groupBy("page_id", "st").agg(F.first("en").alias("en"), F.collect_list(F.when(F.col("at") < F.col("level"), F.col("around"))).alias("above"))


def _assigned(selected: DataFrame, segs: DataFrame) -> DataFrame:
    """Segments of each selected element, tagged with its start ``cur_st``; a segment inside nested ones comes
    once for each. Segments, opens and closes are one stream a page: an open says which selected elements
    hold what follows, itself and those around it, a close that they are the ones around it again; the latest
    such event before a segment holds for it -- one running window over the page, whatever nests."""
    chains = _chains(selected)
    events = chains.select("page_id", (F.col("st") - F.lit(0.25)).alias("p"), (-F.col("st")).alias("o"), F.concat(F.array("st"), "above").alias("holds")).unionByName(
        chains.select("page_id", (F.col("en") + F.lit(0.5)).alias("p"), (-F.col("st")).alias("o"), F.col("above").alias("holds")))
    rows = segs.select("page_id", F.col("pos").cast("double").alias("p"), F.lit(0).alias("o"), "pos", "tag", "txt", "seg")
    stream = rows.unionByName(events, allowMissingColumns=True)
    w = Window.partitionBy("page_id").orderBy("p", "o").rowsBetween(Window.unboundedPreceding, 0)
    held = stream.withColumn("cur", F.last("holds", ignorenulls=True).over(w)).where(F.col("pos").isNotNull() & (F.size("cur") > 0))
    return held.select("page_id", "pos", "tag", "txt", "seg", F.explode("cur").alias("cur_st"))


def _ordered_concat(piece: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", piece.alias("p")))),
                                    lambda x: x["p"]), "")


def element_content(selected: DataFrame, segs: DataFrame, outputs: tuple[str, ...] = ("text",)) -> DataFrame:
    """Content of each selected element in one pass: (page_id, st, <outputs>).

    Selected elements may nest; the content of an inner one is content of the outer one, too.
    Outputs: ``text`` -- HTML-to-text as jsoup's ``text()`` (block tags and ``<br>``
    separate words, whitespace collapsed, trimmed); ``raw`` -- text nodes concatenated as
    they are, only the outer whitespace stripped (lxml ``itertext``); ``html`` -- source
    markup of the element (with the text following its close tag)."""
    rows = _assigned(selected, segs)
    sep = F.when(F.col("tag").isin(BLOCK_TAGS + ["br"]) & (F.col("pos") != F.col("cur_st")), F.lit(" ")).otherwise(F.lit(""))
    aggs = {
        "text": _ordered_concat(F.concat(sep, F.col("txt"))).alias("text"),
        "raw": _ordered_concat(F.col("txt")).alias("raw"),
        "html": _ordered_concat(F.col("seg")).alias("html"),
    }
    agg = rows.groupBy("page_id", F.col("cur_st").alias("st")).agg(*[aggs[o] for o in outputs])
    finals = {
        "text": normalise_space(decode_entities(F.col("text"))).alias("text"),
        "raw": strip_outer(decode_entities(F.col("raw"))).alias("raw"),
        "html": F.col("html"),
    }
    return agg.select("page_id", "st", *[finals[o] for o in outputs])


def page_content(selected: DataFrame, pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """As :func:`element_content`, for pages with distinct ids: (selected's columns but ``en``, raw, html).

    A page's segments stay in its row, where an element's content is the run of them from ``st`` to ``en``: texts
    are exchanged once with their page, not once for each segment, and not sorted. The work follows the
    length of the contents."""
    keys = [c for c in selected.columns if c != "page_id"]
    wanted = selected.groupBy("page_id").agg(F.collect_list(F.struct(*keys)).alias("_els"))
    rows = pages.select(F.col(key).alias("page_id"), F.split(_marked(F.col(html)), SPLIT_MARK).alias("_segs")).join(wanted, "page_id")

    def content(e: Column) -> Column:
        run = F.transform(F.sequence(e["st"], e["en"]), lambda i: F.get("_segs", i.cast("int")))
        return F.struct(*(e[k].alias(k) for k in keys if k != "en"), F.array_join(run, "").alias("html"),
                        F.array_join(F.transform(run, lambda seg: F.regexp_replace(seg, HEAD_PATTERN, "")), "").alias("raw"))
    found = rows.select("page_id", F.explode(F.transform("_els", content)).alias("_e")).select("page_id", "_e.*")
    return found.withColumn("raw", strip_outer(decode_entities(F.col("raw"))))


def html_segments(html: Column) -> Column:
    """A page's markup as its segments, in order."""
    return F.split(_marked(html), SPLIT_MARK)


def span_html(segs: Column, st: Column, en: Column) -> Column:
    """Source markup of an element, given its page's segments; null if the element is null."""
    return F.array_join(F.slice(segs, st + 1, F.greatest(en - st + 1, F.lit(0))), "")


def span_raw(segs: Column, st: Column, en: Column) -> Column:
    """Raw text of an element (``raw`` of :func:`element_content`), given its page's segments; null if the element is null."""
    run = F.transform(F.slice(segs, st + 1, F.greatest(en - st + 1, F.lit(0))), lambda seg: F.regexp_replace(seg, HEAD_PATTERN, ""))
    return strip_outer(decode_entities(F.array_join(run, "")))


def element_texts(selected: DataFrame, segs: DataFrame, mode: str = "normalised") -> DataFrame:
    """Text of each selected element: (page_id, st, text); ``mode`` is
    ``normalised`` (jsoup-style) or ``raw`` (itertext-style)."""
    if mode == "raw":
        return element_content(selected, segs, ("raw",)).withColumnRenamed("raw", "text")
    return element_content(selected, segs, ("text",))


def outer_html(selected: DataFrame, segs: DataFrame) -> DataFrame:
    """Source markup of each selected element: (page_id, st, html)."""
    return element_content(selected, segs, ("html",))


def nearest_enclosing(targets: DataFrame, containers: DataFrame, value: str = "st", carry: tuple[str, ...] = ()) -> DataFrame:
    """For each target (page_id, st) the nearest container interval that strictly
    encloses it: (page_id, st, anc_st, anc_<value>) and the target's columns ``carry``. Containers must nest properly.

    Events: container opens (+1) and closes (-1) and the targets, in page order. The
    running sum at a target is its container depth d; the nearest container is the
    latest container opened at depth d before it (running 'last' per (page, depth))."""
    opens = containers.select("page_id", F.col("st").cast("double").alias("p"), F.lit(1).alias("delta"),
                              F.col("st").alias("anc_st"), F.col(value).alias("anc_val"), F.lit(False).alias("is_target"))
    closes = containers.select("page_id", (F.col("en") + F.lit(0.5)).alias("p"), F.lit(-1).alias("delta"),
                               F.lit(None).cast("long").alias("anc_st"), F.lit(None).cast(containers.schema[value].dataType).alias("anc_val"),
                               F.lit(False).alias("is_target"))
    tg = targets.select("page_id", (F.col("st") - F.lit(0.25)).alias("p"), F.lit(0).alias("delta"),
                        F.lit(None).cast("long").alias("anc_st"), F.lit(None).cast(containers.schema[value].dataType).alias("anc_val"),
                        F.lit(True).alias("is_target"), *carry)
    ev = opens.unionByName(closes).unionByName(tg, allowMissingColumns=True)
    w = Window.partitionBy("page_id").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    ev = ev.withColumn("depth", F.sum("delta").over(w))
    wd = Window.partitionBy("page_id", "depth").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    ev = (ev.withColumn("last_st", F.last("anc_st", ignorenulls=True).over(wd))
          .withColumn("last_val", F.last("anc_val", ignorenulls=True).over(wd)))
    cols = ["page_id", (F.col("p") + F.lit(0.25)).cast("long").alias("st"),
            F.when(F.col("depth") > 0, F.col("last_st")).alias("anc_st")]
    if value != "st":
        cols.append(F.when(F.col("depth") > 0, F.col("last_val")).alias(f"anc_{value}"))
    cols += carry
    return ev.where("is_target").select(*cols)


def html_text(fragment: Column) -> Column:
    """HTML-to-text of a markup string held in one column (a stored paragraph or table):
    scripts, styles and comments removed, block tags and ``<br>`` become a space, other
    tags vanish, entities decoded, whitespace collapsed (EXT6 on fragments)."""
    blocks = "|".join(BLOCK_TAGS + ["br"])
    x = F.regexp_replace(F.coalesce(fragment, F.lit("")), STRIP_PATTERN, "")
    x = F.regexp_replace(x, f"(?i)</?(?:{blocks})\\b[^>]*>", " ")
    x = F.regexp_replace(x, "<[^>]*>", "")
    return normalise_space(decode_entities(x))
