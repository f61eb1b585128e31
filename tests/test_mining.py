"""Table miner, article extraction and JSON sources on inline fixtures (FIXTURES.md section 2)."""

import json

from pyspark.sql import functions as F

from quarry.operators import dom as D
from quarry.operators import extract as X
from quarry.operators import mine as M
from quarry.sources import table_json

PAPER = """<html><head><title> Paper T </title><script>var s = "</p>";</script></head><body>
<figure id="S4.T1"><table class="ltx_tabular"><tr><td>Accuracy 95.2</td><td>baseline model</td></tr></table>
<figcaption>Table 1: Accuracy comparison of baseline model</figcaption></figure>
<table class="ltx_tabular" id="S4.T10"><tr><td>Recall&nbsp;score</td></tr></table>
<table class="ltx_tabular"><tr><td><p>inside table recall score</p></td></tr></table>
<figure id="S5.F1"><table class="ltx_tabular"><tr><td>first</td></tr></table><table class="ltx_tabular"><tr><td>second copy</td></tr></table></figure>
<p>As shown in <a href="#S4.T1">Table 1</a>, accuracy improves.</p>
<p>The baseline model accuracy is lower.</p>
<p>Recall score grows; see <a href="paper.html#S4.T10">Table 10</a>.</p>
<p>Only one shared term: accuracy.</p>
<p>Unrelated words here.</p>
</body></html>"""

EQUATIONS = """<html><body><table id="S3.E1" class="ltx_equation"><tr><td>x = y + 1</td></tr></table>
<p>The equation x relation defines everything.</p></body></html>"""


def pages(spark):
    rows = [(1, "d/2501.00001v1.html", PAPER), (2, "d/2501.00002v1.html", "<html><body><p>no tables</p></body></html>"),
            (3, "d/2501.00003v1.html", EQUATIONS)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_table_miner_records(spark):
    mined = {(r.page_id, r.table_id): r for r in M.mine_tables(pages(spark)).collect()}
    assert set(mined) == {(1, "S4.T1"), (1, "S4.T10"), (1, "S5.F1"), (3, "S3.E1")}  # id-less table dropped
    t1 = mined[(1, "S4.T1")]
    assert t1.source_file == "Paper T"
    assert t1.caption == "Table 1: Accuracy comparison of baseline model"
    assert t1.body == "Accuracy 95.2baseline model"  # raw text nodes, joined without separator
    assert set(t1.informative_terms_identified) == {"accuracy", "comparison", "baseline", "model", "952baseline"}
    # prefix citation semantics: a link to #S4.T10 also cites S4.T1
    assert len(t1.citing_paragraphs) == 2 and t1.citing_paragraphs[0].startswith("<p>As shown")
    ctx = [(c.html.strip(), c.matched_terms) for c in t1.contextual_paragraphs]
    assert ctx == [("<p>The baseline model accuracy is lower.</p>", ["accuracy", "baseline", "model"])]
    t10 = mined[(1, "S4.T10")]
    assert t10.body == "Recall score" and t10.informative_terms_identified == ["recall", "score"]
    assert [c[:20] for c in t10.citing_paragraphs] == ["<p>Recall score grow"]
    assert t10.contextual_paragraphs == []  # the paragraph inside a table is not a candidate
    # two tables in one figure: the later one wins
    assert mined[(1, "S5.F1")].body == "second copy"
    # fallback: a page without ltx_tabular tables mines every table (equations)
    assert mined[(3, "S3.E1")].caption == ""


def test_exact_citation_mode(spark):
    mined = {r.table_id: r for r in M.mine_tables(pages(spark), cite_mode="exact").where("page_id = 1").collect()}
    assert len(mined["S4.T1"].citing_paragraphs) == 1
    # the paragraph citing only S4.T10 now shares >= 2 terms? no: it becomes non-citing for S4.T1
    assert all("Recall" not in c.html for c in mined["S4.T1"].contextual_paragraphs)


def test_tables_per_paper_json(spark):
    p = pages(spark)
    per = {r.json_name: json.loads(r.j) for r in
           M.tables_per_paper(p, M.mine_tables(p)).select("json_name", F.to_json("tables").alias("j")).collect()}
    assert per["2501.00002v1_data.json"] == {}
    rec = per["2501.00001v1_data.json"]["S4.T1"]
    assert set(rec) == {"source_file", "caption", "body", "html_code", "informative_terms_identified",
                        "citing_paragraphs", "contextual_paragraphs"}
    # source markup of the element plus the text that follows its close tag (the tail)
    assert rec["html_code"].startswith('<table class="ltx_tabular">') and rec["html_code"].rstrip().endswith("</table>")


def test_article_extraction_branches(spark):
    latex = ('<html><head><title>Fallback</title></head><body><h1 class="ltx_title ltx_title_document">Real '
             'Title</h1><span class="ltx_personname">Ann Bee</span><span class="ltx_personname">Cid Dee</span>'
             '<div class="ltx_abstract"><p>Abs <b>one</b></p><p>two</p></div><p class="ltx_p">P1 &amp; x</p>'
             '<p class="ltx_p">P2<br>z</p><p>plain</p></body></html>')
    pubmed = ('<article><article-title>AT</article-title><contrib contrib-type="author"><name><surname>Smith'
              '</surname><given-names>J</given-names></name></contrib><abstract><p>pa</p></abstract><pub-date>'
              '<year>2020</year><month>3</month><day>15</day></pub-date><body><p>b1<p>b2</p></body></article>')
    plain = "<html><head><title>Only</title></head><body><p>x</p><pub-date><year>1999</year></pub-date></body></html>"
    df = spark.createDataFrame([(1, "a/l.html", latex), (2, "a/m.html", pubmed), (3, "a/n.html", plain),
                                (4, "a/o.html", "<p>bare</p>")], "page_id long, url string, html string")
    got = {r.page_id: r for r in X.extract_articles(df).collect()}
    assert got[1].title == "Real Title" and got[1].authors == ["Ann Bee", "Cid Dee"]
    assert got[1].articleAbstract == "Abs one two" and got[1].paragraphs == ["P1 & x", "P2 z"]
    assert got[2].title == "AT" and got[2].authors == ["J Smith"] and got[2].articleAbstract == "pa"
    assert got[2].publicationDate == "2020-03-15" and got[2].paragraphs == ["b1", "b2"]
    assert got[3].publicationDate == "1999" and got[3].articleAbstract == "No Abstract Found"
    assert got[4].title == "No Title Found" and got[4].id == "o.html"


def test_table_json_source(spark):
    docs = [
        ("p/2509.1v1_data.json", json.dumps({"S2.T1": {"caption": "c", "body": "b", "informative_terms_identified": [" x ", ""],
                                                     "citing_paragraphs": ["<p>a</p>"],
                                                     "contextual_paragraphs": [{"html": " <p>h</p> ", "matched_terms": ["u", "v"]}]}})),
        ("p/empty_data.json", "{}"),
        ("p/array.json", "[1, 2]"),
        ("p/bad.json", "{not json"),
    ]
    raw = spark.createDataFrame(docs, "file string, value string")
    tables, bad = table_json.parse_table_documents(raw, "file", "value")
    rows = tables.collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.id == "2509.1v1_S2.T1" and r.sourceFilename == "2509.1v1" and r.informative_terms == ["x"]
    assert r.contextual_html == ["<p>h</p>"] and r.contextual_paragraphs[0].matched_terms == ["u", "v"]
    assert {b.file for b in bad.collect()} == {"p/array.json", "p/bad.json"}


def test_table_index_is_case_sensitive_and_stems(spark):
    from quarry.operators import search as S
    from quarry.plans.corpus import table_index
    from quarry.plans.retrieval import clause_rows
    rows = [("p1_S3.T2", "p1", None, "Comparison of systems", "", None, ["comparison"], ["<p>see <b>tables</b></p>"], []),
            ("p2_S5.T2", "p2", "Paper 2", "A comparison of models", "", None, ["models"], [], ["<p>running jobs</p>"])]
    tables = spark.createDataFrame(rows, "id string, paper_id string, sourceFilename string, caption string, body string, "
                                         "html_code string, informative_terms array<string>, citing_paragraphs array<string>, "
                                         "contextual_html array<string>")
    idx = table_index(tables)
    q = clause_rows(spark, [
        {"query_id": 1, "clause_id": 1, "index": "tabelle", "field": "caption", "text": "comparison"},
        {"query_id": 2, "clause_id": 1, "index": "tabelle", "field": "caption", "text": "Comparison"},
        {"query_id": 3, "clause_id": 1, "index": "tabelle", "field": "mentions", "text": "table"},
        {"query_id": 4, "clause_id": 1, "index": "tabelle", "text": "run"},
        {"query_id": 5, "clause_id": 1, "index": "tabelle", "field": "sourceFilename", "kind": "term", "text": "Unknown"},
    ])
    got = {}
    for r in S.search({"tabelle": idx}, q).collect():
        got.setdefault(r.query_id, set()).add(r.doc_id)
    assert got[1] == {"p2_S5.T2"} and got[2] == {"p1_S3.T2"}   # whitespace + stem, no lower-casing
    assert got[3] == {"p1_S3.T2"}                               # alias -> citing text, 'tables' stems to 'tabl'
    assert got[4] == {"p2_S5.T2"}                               # contextual text: 'running' -> 'run'
    assert got[5] == {"p1_S3.T2"}                               # null source file indexed as 'Unknown'


def test_html_text_and_searchable_text(spark):
    from quarry.functions.text import searchable_text
    from quarry.operators.dom import html_text
    df = spark.createDataFrame([("<p>a<b>b</b><br>c&amp;d</p><script>x</script>", "cap", ["t1", "t2"], ["c1"])],
                               "h string, c string, t array<string>, p array<string>")
    r = df.select(html_text(F.col("h")).alias("x"), searchable_text(F.col("c"), F.col("t"), F.col("p")).alias("y")).first()
    assert r.x == "ab c&d" and r.y == "cap t1 t2 c1 "


def test_nested_tables_keep_all_text(spark):
    html = ("<html><body><table id='A'><tr><td>before outer</td><td><table id='B'><tr><td>inner words</td></tr></table></td>"
            "<td>after outer</td></tr></table><table id='C'><tr><td>last one</td></tr></table></body></html>")
    segs = D.segments(spark.createDataFrame([(1, html)], "page_id long, html string"))
    tables = D.elements(segs).where("tag = 'table'")
    got = {r.attr_id: r.raw for r in tables.join(D.element_content(tables, segs, ("raw",)), ["page_id", "st"]).collect()}
    assert got == {"A": "before outerinner wordsafter outer", "B": "inner words", "C": "last one"}


def test_crossing_elements_end_with_the_one_around_them(spark):
    from quarry.operators import dom
    html = "<table id='A'><tr><td>x<div id='D'></table><p>y</p><div id='E'><b id='F'>u</div>v</b><p>w</p>"
    pages = spark.createDataFrame([(1, "a.html", html)], "page_id long, url string, html string")
    segs = dom.segments(pages)
    rows = sorted((r.st, r.en, r.tag) for r in dom.elements(segs).collect())
    for st, en, _ in rows:  # an element around the start is around the end
        assert all(e >= en for s, e, _ in rows if s < st <= e)
    els = dom.elements(segs)
    ps = els.where("tag = 'p'").select("page_id", "st")
    assert {r.anc_st for r in dom.nearest_enclosing(ps, els.where("tag in ('table', 'div', 'b')")).collect()} == {None}


def test_an_element_in_two_selected_ones_belongs_to_both_and_their_rest_only_to_the_outer(spark):
    from pyspark.sql import functions as F
    from quarry.operators import dom
    html = "<div id='1'>a<div id='2'>b<div id='3'>c</div>d</div><div id='4'>e</div>f</div>g<div id='5'>h</div>"
    pages = spark.createDataFrame([(1, "a", html), (2, "b", "no tags"), (3, "c", None)], "page_id long, url string, html string")
    segs = dom.segments(pages)
    divs = dom.elements(segs).where("tag = 'div'")
    got = dom.element_content(divs, segs, ("raw",)).join(divs.select("page_id", "st", "attr_id"), ["page_id", "st"])
    # the text after an element's close tag is in the segment of that tag
    assert {r.attr_id: r.raw for r in got.select("attr_id", F.col("raw")).collect()} == {"1": "abcdefg", "2": "bcd", "3": "cd", "4": "ef", "5": "h"}
