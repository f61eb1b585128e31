import hashlib
import re
from collections import Counter, defaultdict

from quarry.llm import line_dedup
from tests.llm.util import edge_rows


def brute(rows, min_chars=40, min_docs=5):
    """rows: (doc_id, text) -> per row (n_lines, n_dropped, kept)."""
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc)
    shared = {k: max((-1 if d is None else d) for d in v) for k, v in holders.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if shared.get(key(x), doc) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_edge_cases_match_brute_force(spark, edge_docs):
    got = line_dedup.dedup_lines(edge_docs).select("doc_id", "n_lines", "n_dropped", "text").collect()
    assert Counter((r[0], r[1], r[2], r[3] or "") for r in got) == brute([r[:2] for r in edge_rows()])


def test_hot_key_over_many_partitions(spark):
    line = "the very same line in nearly every document there is"
    rows = [(k, f"{line}\nown line number {k} which is not shared at all by others") for k in range(600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
        keys = line_dedup.line_keys(docs)
        got = line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "text").collect()
        spread = keys.repartitionByRange("h1", "h2", keys.doc_id.desc()).mapInArrow(line_dedup._stream(5), line_dedup._RUNS).where("open and holders > 5").count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert Counter(map(tuple, got)) == brute(rows)
    assert spread > 1  # the key does lie in several partitions


def test_bitmaps_hold_no_text(spark, edge_docs):
    bitmaps = line_dedup.keep_bitmaps(edge_docs.select("doc_id", "text"))
    assert [f[0] for f in bitmaps.dtypes] == ["doc_id", "version", "bitmap"]
    three = {r.doc_id: list(line_dedup.kept_lines(r.bitmap, 3)) for r in bitmaps.collect() if r.doc_id == 7}
    assert three == {7: [False, False, True]}


def test_empty_table(spark, no_docs):
    assert line_dedup.dedup_lines(no_docs).collect() == []
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
