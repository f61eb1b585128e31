"""Steps that must not exchange or keep a row for each token or score."""

import re

import pytest

from quarry.operators import dom as D
from quarry.operators import mine as M
from quarry.plans.analysis import documents_as_pages
from quarry.plans.catalog import QUERIES
from quarry.plans.tables import _tables


@pytest.fixture
def tables(spark, tmp_path):
    texts = ["red boats sail\nthe red boats carry salt\nsalt of the sea", "green hills\nhills and running sheep", "red hills\nred sheep run", None, ""]
    docs = [(i, t, "en", "web", len(t or "")) for i, t in enumerate(texts * 4)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "red boats carry"), (2, "Sheep running hills")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def exchanges(df):
    df.count()
    return re.findall(r"Exchange hashpartitioning\(([^()]*)\)", re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString()))


@pytest.mark.parametrize("name, keys", [("bm25_or", "query_id, clause_id, doc_id"), ("search_results", "query_id, clause_id, doc_id"), ("positions", "field, term, doc_id"), ("postings", "field, term, doc_id"),
                                        ("term_overlap_join", "item_id, doc_id, line_no")])
def test_rows_are_summed_where_their_document_is(spark, tables, name, keys):
    df = QUERIES[name](spark, tables)
    assert not [x for x in exchanges(df) if x.startswith(keys)]


def test_mined_tables_are_written_once(spark, tables):
    plan = _tables(spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_texts_of_mined_pages_do_not_become_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(D, "_assigned", None)
    pages = documents_as_pages(spark.read.parquet(f"{tables}/documents.parquet"))
    got = {(r.page_id, r.table_id): r for r in M.mine_tables(pages).collect()}
    assert len(got) == 40
    r = got[0, "S1.T1"]
    assert (r.caption, r.body, r.source_file) == ("red boats sail", "the red boats carry salt", "0.html")
    assert [x.matched_terms for x in r.contextual_paragraphs] == [["boats", "red", "sail"]]
    assert r.citing_paragraphs[0].startswith("<p>the red boats carry salt<a href=")


def test_page_content_equals_element_content(spark):
    html = "<html><head><title>x &amp; y</title></head><body><div id='a'>one<div> two<p>three<p>four </div>five</div><script>no</script> six</body></html>"
    pages = spark.createDataFrame([(1, html), (2, None), (3, "plain")], "page_id long, html string")
    segs = D.segments(pages)
    els = D.elements(segs).select("page_id", "st", "en")
    old = {tuple(r) for r in D.element_content(els, segs, ("raw", "html")).select("page_id", "st", "raw", "html").collect()}
    new = {tuple(r) for r in D.page_content(els, pages).select("page_id", "st", "raw", "html").collect()}
    assert old == new and len(old) > 5


def test_occurrences_of_other_words_are_not_stemmed_or_exchanged(spark, tables):
    from quarry.operators.index import build_index, tokens_for_terms
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")
    index = build_index("t", docs, "doc_id", {"text": docs["text"], "id": docs["doc_id"]}, {"id": "keyword", "*": "porter"}, ["text"])
    wanted = spark.createDataFrame([("text", "run"), ("text", "hill"), ("id", "1")], "field string, term string")
    rows = tokens_for_terms(index, wanted, True)
    assert not exchanges(rows)
    assert sorted({(r.field, r.term) for r in rows.collect()}) == [("id", "1"), ("text", "hill"), ("text", "run")]
    full = index.tokens.join(wanted, ["field", "term"])
    key = lambda df: sorted(map(tuple, df.select("doc_id", "field", "dl", "pos", "term").collect()))
    assert key(rows) == key(full)
