import random
import zlib

import numpy as np

from quarry.llm import language_crf as C
from quarry.sources.tables import read_table
from tests.llm.util import edge_rows

EN = "the house and water of this with where people think about other through".split()
DE = "das haus und wasser von diesem mit wo leute denken über andere durch straße".split()


def exact(scores, moves):
    """Marginals of one chain in log space."""
    total = lambda x, axis: np.log(np.exp(x - x.max(axis, keepdims=True)).sum(axis)) + x.max(axis)
    ahead, back = [scores[0]], [np.zeros(scores.shape[1])]
    for s in scores[1:]:
        ahead.append(s + total(ahead[-1][:, None] + moves, 0))
    for s in scores[:0:-1]:
        back.insert(0, total(moves + s + back[0], 1))
    out = np.array(ahead) + np.array(back)
    out = np.exp(out - out.max(1, keepdims=True))
    return out / out.sum(1, keepdims=True)


def test_forward_backward_over_blocks_equals_one_chain():
    rng = np.random.default_rng(4)
    sizes = np.array([1, 63, 64, 65, 200, 3, 128, 129])
    for scale in (1, 30):
        scores, moves = rng.normal(size=(sizes.sum(), 3)) * scale, rng.normal(size=(3, 3))
        got = C.marginals(scores, sizes, moves)
        for lo, n in zip(np.cumsum(sizes) - sizes, sizes):
            assert np.allclose(got[lo:lo + n], exact(scores[lo:lo + n], moves))
    one = C.marginals(rng.normal(size=(70, 1)), np.array([70]), np.zeros((1, 1)))
    assert np.allclose(one, 1)


def test_training_expectations_are_the_chains_own():
    rng = np.random.default_rng(6)
    scores, moves = rng.normal(size=(2, 6, 3)), rng.normal(size=(3, 3))
    prob, pairs = C._chain_expectations(scores, moves)
    assert all(np.allclose(prob[k], exact(scores[k], moves)) for k in range(2)) and np.isclose(pairs.sum(), 2 * 5)


def corpus(rng, n=200):
    rows = []
    for k in range(n):
        lang, own = rng.choice([("en", EN), ("de", DE)])
        rows.append((k, " ".join(rng.choices(own, k=rng.randrange(5, 60))), lang, "s"))
    return rows


def test_words_of_code_switched_texts(spark):
    rows = corpus(random.Random(1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = C.learn(docs.select("text", "lang"))
    words = EN[:6] + DE[:6] + EN[6:]
    prob = C.marginals(model.scores(words), np.array([len(words)]), model.moves)
    assert [model.langs[k] for k in prob.argmax(1)] == ["en"] * 6 + ["de"] * 6 + ["en"] * (len(EN) - 6)
    assert (np.diag(model.moves) > model.moves.mean()).all()  # a language goes on more often than not


def test_defined_results_and_held_out(spark):
    rows = corpus(random.Random(2)) + [(1000 + k, t, None, "s") for k, (_, t, *_) in enumerate(edge_rows())]
    rows += [(None, "das haus", "de", None), (3000, "the house " * 30000 + "das", "xx", "s"), (3001, "1 2 ! ½ ²", "en", "s")]
    rows += [(3002, "straße", None, "s")] * 2
    got = C.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").repartition(3)).collect()
    assert len(got) == len(rows)
    texts = {i: t for i, t, *_ in rows}
    seen = {"en", "de"} | {g for i, _, g, _ in rows if g and i is not None and zlib.crc32(str(i).encode()) % 5}
    for r in got:
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, texts[r.doc_id] or ""))) and r.lang_pred in seen | {"und"}
        if r.lang_pred == "und":
            assert r.score == 0
    assert {r.lang_pred for r in got if r.doc_id == 3002} == {"de"} and len({r.score for r in got if r.doc_id == 3002}) == 1


def test_nothing_to_learn_from(spark, no_docs):
    schema = "doc_id long, text string, lang string"
    docs = spark.createDataFrame([(1, "the house", None), (2, None, "en"), (None, "x", "en")], schema)
    assert [(r.lang_pred, r.score) for r in C.identify(docs).collect()] == [("und", 0.0)] * 3
    assert C.identify(spark.createDataFrame([], schema)).collect() == []


def test_held_out_accuracy_and_no_other_inputs(spark, small_dir):
    docs = read_table(spark, small_dir, "documents", ["doc_id", "text", "lang"])
    got = {r.doc_id: r for r in C.identify(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    unseen = [d for d in got if got[d].held_out]
    assert len(unseen) > 20 and sum(got[d].lang_pred == truth[d] for d in unseen) >= 0.95 * len(unseen)
    # the lang of a held out document is not read: another one there changes nothing
    from pyspark.sql import functions as F
    other = docs.withColumn("lang", F.when(C.held_out(), F.lit("qq")).otherwise(F.col("lang")))
    again = {r.doc_id: r for r in C.identify(other).collect()}
    assert all(again[d].lang_pred == got[d].lang_pred and abs(again[d].score - got[d].score) < 1e-9 for d in got)
