"""Crawl ledger, id helpers and the length-norm quantiser."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from quarry.functions import bm25
from quarry.operators import crawl
from quarry.operators import extract as X
from quarry.session import ensure_checkpoint_dir


def test_quantized_length(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 39, 40, 41, 55, 56, 100, 1000, 70000)], "dl int")
    got = {r.dl: r.q for r in df.select("dl", bm25.quantized_length("dl").alias("q")).collect()}
    # exact below 40; above, four significant bits of (dl - 24) are kept
    assert got[0] == 0 and got[39] == 39 and got[40] == 40 and got[41] == 40
    assert got[55] == 54 and got[56] == 56 and got[100] == 96 and got[1000] == 984
    assert all(got[v] <= v for v in got)


def test_batches_and_totals(spark):
    rows = [(i, "downloaded" if i % 3 else ("error" if i % 2 else "skipped"), 1.5, 1024 * 1024) for i in range(60)]
    log = spark.createDataFrame(rows, "idx long, status string, seconds double, bytes long")
    b = {r.batch: r for r in crawl.batch_counts(log).collect()}
    assert sorted(b) == [0, 1, 2]
    assert [(b[i].start_offset, b[i].page_size) for i in range(3)] == [(0, 25), (25, 25), (50, 10)]
    assert sum(b[i].processed for i in b) == 60
    t = crawl.totals(log).first()
    assert t.downloaded == 40 and t.skipped + t.errors == 20
    assert t.size_mb == 40.0 and t.seconds_per_download == round(60 * 1.5 / 40, 6)
    none = crawl.totals(log.where("status <> 'downloaded'")).first()
    assert none.seconds_per_download is None  # only computed when something was downloaded


def test_file_ids(spark):
    df = spark.createDataFrame([("https://x.org/html/2509.18579v1?x=1#top",), ("p/2509.1v1_data.json",), ("a/B.HTML",)], "u string")
    got = [tuple(r) for r in df.select(X.file_name(F.col("u")), X.article_file_id(F.col("u")),
                                      X.paper_id(X.file_name(F.col("u")))).collect()]
    assert got == [("2509.18579v1", "2509.18579v1.html", "2509.18579v1"),
                   ("2509.1v1_data.json", "2509.1v1_data.json.html", "2509.1v1"),
                   ("B.HTML", "B.HTML.html", "B")]


def test_cluster_session_without_shared_folder_is_refused():
    conf = SimpleNamespace(get=lambda key, default=None: default)
    spark = SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(spark)


def test_rollup_by_batch_and_overall(spark):
    schema = "idx long, status string, seconds double, bytes int"
    log = spark.createDataFrame([(0, "downloaded", 2.0, 10), (24, "error", 1.0, None), (25, "skipped", 0.5, 7), (26, None, None, 3)], schema)
    got = {(r.level, r.batch): tuple(r)[2:] for r in crawl.batch_rollup(log).collect()}
    assert got == {(0, 0): (2, 1, 0, 1, 3.0, 3.0, 10), (0, 1): (2, 0, 1, 0, 0.5, None, 0), (1, None): (4, 1, 1, 1, 3.5, 3.5, 10)}
    assert crawl.batch_rollup(spark.createDataFrame([], schema)).collect() == []
