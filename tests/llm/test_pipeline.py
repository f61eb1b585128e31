import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from quarry.llm import bpe, quality
from tests.llm import test_line_dedup, test_near_dedup
from tests.llm.test_decontam import brute_tiles
from tests.llm.test_near_dedup import shingle_set, words


def brute(rows, rules_keep, items):
    """rows: (doc_id, text). The stages in plain Python; the learned rules are given by ``rules_keep``."""
    rows = [r for r in rows if rules_keep[r[0]]]
    rows = [(d, kept) for d, _, _, kept in test_line_dedup.brute(rows)]
    top = test_near_dedup.brute(rows)
    rows = [r for r in rows if top[r[0]][1] == r[0]]
    seeds = {k: shingle_set(t) for k, t in items.items()}

    def clean(text):
        mine = shingle_set(text)
        return not any(mine & seeds[k] and 100 * sum(x[2] for x in brute_tiles(words(text), words(t))) >= 75 * len(words(t)) for k, t in items.items())

    return {d: t for d, t in rows if clean(t)}


def test_stages_match_brute_force(spark, small_dir):
    read = lambda t: spark.read.parquet(f"{small_dir}/{t}.parquet")
    rows = [(r.doc_id, r.text) for r in read("documents").collect() if len(r.text or "") < 4000]
    items = dict(read("benchmark").select("item_id", "text").collect())
    docs = read("documents").where("length(text) < 4000")
    kept = {r.doc_id: r.kept for r in quality.judge(docs, read("labels")).select("doc_id", "kept").collect()}
    want = brute(rows, kept, items)
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, small_dir)
        assert out.columns == docs.columns, name
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.STAGES[-1][1](spark, out, small_dir).collect()}
    assert 0 < len(want) < len(rows)
    assert got == {d: (len(i := library.encode_ordinary(t)), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for d, t in want.items()}


def test_run(spark, small_dir):
    out = corpus_pipeline.run(spark, small_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < out.count() < spark.read.parquet(f"{small_dir}/documents.parquet").count()
