"""The miner of pages with distinct ids: texts stay in the page's row, and it gives what the miner by segments gives."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import dom as D
from quarry.operators import mine as M

ODD = [
    "<html><head><title> First &amp; only </title><title>second</title></head><body><figure id='F1'><table class='ltx_tabular'><tr><td>red boats carry salt</td></tr></table>"
    "<figcaption>Boats <b>and</b> salt</figcaption></figure><p>red boats sail <a href='#F1'>x</a><p>boats carry <a href='y#F10'>y</a> salt</p><p>salt boats and red sails</p></body></html>",
    "<table id='T1'><tr><td>outer words here<table id='T2'><tr><td>inner words here<p>inside words</p></td></tr></table></td></tr></table><figcaption>outer words</figcaption>"
    "<p>inner outer words</p><div><p>outer words inner</div><p>x</p>",
    "<div id='a'><table><tr><td>green hills</td></table><div id=''><table><tr><td>no id</td></tr></table></div></div><table id='a'><td>later green hills</td></table><p>green hills <b>rise</p> later</b><p>hills later</p>",
    "<p>no tables, green hills <a href='#a'>z</a></p>", "plain", "", None,
    "<!DOCTYPE html><title> </title><img id='i'><table id='T'><tr><td>&lt;tag&gt; sheep run<br>hills</table><script>var t='<p>';</script><p>sheep run</p><section><p>sheep hills <a href='#T&amp;'>s</a><a href='#'>e</a>",
    "<section id='s'><table class='x'><tr><td>dropped words</td></tr></table><figcaption>late <table class='y ltx_tabular'><tr><td>kept words</td></tr></table></figcaption></section><p>kept words late</p>",
]


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    rows = [(i, f"http://h/{i}.html" if i % 4 else None, html) for i, html in enumerate(ODD * 3)]
    path = f"{tmp_path_factory.mktemp('pages')}/pages.parquet"
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(path)
    return spark.read.parquet(path)


def test_elements_in_a_row_equal_elements_in_rows(spark, pages):
    cols = ["page_id", "st", "en", "tag", "attr_id", "attr_class", "href"]
    rows = [tuple(r) for r in D.elements(D.segments(pages)).select(cols).collect()]
    got = [tuple(r) for r in D.page_elements(pages).select("page_id", F.inline("els")).select(cols).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, rows)) and len(rows) > 100


@pytest.mark.parametrize("mode", ["prefix", "exact"])
def test_page_rows_equal_segments(pages, mode):
    old = {(r.page_id, r.table_id): r for r in M._mine_segments(pages, mode).collect()}
    new = {(r.page_id, r.table_id): r for r in M.mine_tables(pages, mode).collect()}
    assert new == old and len(new) == 3 * 6
    assert any(r.contextual_paragraphs for r in new.values()) and any(r.citing_paragraphs for r in new.values())


def test_the_driver_broadcasts_nothing_of_the_miner(pages):
    # a file of starts and ends is a small part of the rows it holds, so its size is no estimate of theirs
    plan = M.mine_tables(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_texts_are_exchanged_once_and_not_kept(pages, monkeypatch):
    kept = []
    monkeypatch.setattr(M, "_keep", lambda df: kept.append(df.columns) or df)
    mined = M.mine_tables(pages)
    assert kept == [["page_id", "st", "en", "tag", "attr_id", "attr_class", "href"]]
    tree = mined._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in tree.splitlines() if "Join" in line]
    assert len(joins) == 1 and "page_id" in joins[0]


def test_tables_keep_their_records_and_little_else(spark, pages, tmp_path, monkeypatch):
    from quarry.plans import tables as T
    docs = [(i, "red boats\nboats carry salt\nred boats with salt", "web") for i in range(6)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    written, kept = [], M.written
    monkeypatch.setattr(M, "written", lambda df, name: written.append(name) or kept(df, name))
    monkeypatch.setattr(T, "written", lambda df, name: written.append(name) or kept(df, name))
    rows = T.q_parent_link(spark, str(tmp_path)).collect()
    assert written == ["mined", "mined-tables"] and len(rows) == 12
    assert {(r.article_file, r.n_versions) for r in rows} == {("0v3.html", 3), ("3v3.html", 3), (None, 0)}
    details = {(r.doc_id, r.label) for r in T.q_table_details(spark, str(tmp_path)).collect()}
    assert written == ["mined", "mined-tables"] * 2 and len({d for d, _ in details}) == 12


@pytest.mark.parametrize("name", ["table_search", "multi_index_search"])
def test_postings_of_a_search_are_neither_written_nor_exchanged(spark, tmp_path, monkeypatch, name):
    import re

    from quarry.operators import index as I
    from quarry.plans.catalog import QUERIES
    texts = ["red boats sail\nthe red boats carry salt\nsalt of the sea", "green hills\nhills and running sheep", "red hills\nred sheep run"]
    docs = [(i, t, "web") for i, t in enumerate(texts * 3)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "red boats carry"), (2, "sheep running hills")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names, kept = [], I.written
    monkeypatch.setattr(I, "written", lambda df, n: names.append(n) or kept(df, n))
    hits = QUERIES[name](spark, str(tmp_path))
    assert len(hits.collect()) > 4 and "matched-postings" not in names
    plan = re.sub(r"#\d+L?", "", hits._jdf.queryExecution().executedPlan().toString())
    assert not re.search(r"Exchange hashpartitioning\((field, term, )?doc_id, (field|query_id)", plan) and "hashpartitioning(field, term, doc_id" not in plan
