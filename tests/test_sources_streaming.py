"""HTML folder source, file order/limit, and incremental indexing with Structured Streaming."""

import os

from quarry.sources import html_files
from quarry.streaming import pages_stream


def test_html_folder_source(spark, tmp_path):
    d = tmp_path / "papers"
    d.mkdir()
    (d / "b.HTML").write_text("<html><head><title>B</title></head><body><p>two</p></body></html>")
    (d / "a.html").write_text("<html><head><title>A</title></head><body><p>one</p></body></html>")
    (d / "notes.txt").write_text("ignored")
    pages = html_files.read_html_folder(spark, str(d))
    assert sorted(r.id for r in pages.collect()) == ["a.html", "b.HTML"]
    assert [r.id for r in html_files.first_files(pages, 1).collect()] == ["a.html"]
    assert html_files.read_html_folder(spark, str(tmp_path / "missing")).count() == 0


def test_incremental_index_stream(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    rows = [(1, "x/p1.html", "<html><head><title>Alpha paper</title></head><body><p>alpha beta</p></body></html>"),
            (2, "x/p2.html", "<html><head><title>Beta</title></head><body><p>beta gamma</p></body></html>")]
    spark.createDataFrame(rows, pages_stream.PAGES_SCHEMA).write.parquet(str(src / "part1"))
    out, ckpt = str(tmp_path / "index"), str(tmp_path / "ckpt")
    q = pages_stream.start_incremental_index(pages_stream.page_stream(spark, str(src / "*")), out, ckpt)
    q.awaitTermination(120)
    stats = {(r.field, r.term): r.df for r in pages_stream.stored_term_stats(spark, out).collect()}
    assert stats[("paragraphs", "beta")] == 2 and stats[("title", "alpha")] == 1
    assert os.path.isdir(os.path.join(out, "postings"))
