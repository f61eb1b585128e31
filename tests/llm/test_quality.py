import random
import re
from collections import Counter

from quarry.llm import quality
from tests.llm.util import edge_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text or "")
    windows = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    repeated = {j for k in range(len(w) - 2) if windows[tuple(w[k:k + 3])] > 1 for j in range(k, k + 3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated), failed


def stats_of(docs):
    return quality.add_stats(docs).withColumn("base_failed", quality.base_failed()).select("text", *quality.STATS, "base_failed").collect()


def test_stats_match_brute_force(spark, edge_docs, small_dir):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("ab|#é") * rng.randint(1, 2) for _ in range(rng.randint(0, 60))) + "\n" * rng.randint(0, 2) for _ in range(60)]
    texts += ["a\nb\na\n \n \n a\r\na\r", "x\x0by\x0cz\x1cq", "a b c\na b c"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").unionByName(edge_docs.select("text")).unionByName(
        spark.read.parquet(f"{small_dir}/documents.parquet").select("text"))
    for row in stats_of(docs):
        assert tuple(row[1:]) == brute(row[0]), (row[0] or "")[:100]


def labelled(spark):
    rng = random.Random(7)
    rows, labels = [], []
    for k in range(600):
        words = ["w%d" % rng.randint(0, 10**6) for _ in range(rng.randint(60, 90))]
        kind = k % 6
        if kind == 0:
            words = [w + "##" for w in words]
        elif kind == 1:
            words = [w.upper() + "!!" for w in words]
        rows.append((k, " ".join(words), "x"))
        if k < 450:
            labels.append((k, int(kind > 1)))
    labels += [(5000, 0), (None, 1), (3, None), (4, 0), (4, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, rule string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_rules_hold_on_rows_without_labels(spark):
    docs, labels = labelled(spark)
    fit = quality.fit_table(docs, labels)
    assert fit.count() == 449  # a doc labelled both ways doesn't teach
    rules = quality.learn(fit)
    assert 1 <= len(rules) <= 4 and all(len(r) <= quality.MAX_CONDITIONS for r in rules)
    got = {r.doc_id: r.kept for r in quality.judge(docs, labels).collect()}
    right = [got[k] == (k % 6 > 1) for k in range(450, 600)]
    assert sum(right) >= 145
    kept = quality.drop_low_quality(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k in got if got[k]}
    assert quality.fit_table(docs, labels, rows=100).count() <= 100


def test_plan_is_native(spark):
    docs, labels = labelled(spark)
    plan = quality.judge(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_without_labels_and_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.judge(edge_docs, labels)
    assert all(r.kept == (not r.base_failed) and r.rule is None for r in got.collect())
    assert len(got.collect()) == len(edge_rows())
    assert quality.judge(no_docs, labels).collect() == []
