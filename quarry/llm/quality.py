"""Quality rules as a learned decision list (DataFrame functions only).

Labelled documents are described by simple statistics. Sequential covering learns rules for
the documents of low quality: a rule grows by the condition ``feature > t`` or ``feature <= t``
of the best information gain on two thirds of the labelled rows, loses its last conditions as
long as that helps on the other third, and is kept if it is right there often enough; the rows
that it covers go, and the next rule starts. The list becomes one ordered CASE expression.

Each step is an aggregation over the fit table that returns a count for each feature and bin.
The fit uses at most ``FIT_ROWS`` labelled rows, those with the smallest hashes of their ids;
the statistics and the rules apply to every document.

Words are runs of characters other than space and \\x09-\\x0D.

Defined results: a null or empty text has no words, so it fails the base test; labels that are
null, of unknown documents or repeated with both values don't teach; without labels there are no
rules and only the base test rejects; rows that repeat an id are judged each; an empty table gives
no rows. Columns of the input that bear a statistic's name are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise

FIT_ROWS = 20_000  # labelled rows that the fit reads at most
BINS = 24  # thresholds tried for each feature
MAX_RULES, MAX_CONDITIONS = 12, 3
MIN_COVER, MIN_PRECISION = 2, 0.95  # of a rule, on the rows held out for pruning
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_OTHER = ["n_capitals", "n_marks", "n_distinct"]
FEATURES = {
    "word_length": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "capital_share": "n_capitals / word_chars",
    "marks_per_word": "n_marks / n_words",
    "distinct_share": "n_distinct / n_words",
}
_BLANK = r"[\x20\x09-\x0D]+"


def repeated_words(words: str) -> Column:
    """Number of words that lie in a window of three words found twice or more, by 64-bit hashes of the
    windows: sorted with their places, equal neighbours are repeats."""
    hashes = f"if(size({words}) < 3, cast(array() as array<bigint>), transform(sequence(0, size({words}) - 3), i -> xxhash64({words}[i], {words}[i + 1], {words}[i + 2])))"
    return F.expr(f"""
        aggregate(array({hashes}), 0L, (none, h) -> if(size(array_distinct(h)) = size(h), 0L,
            aggregate(array(array_sort(transform(h, (x, i) -> named_struct('x', x, 'i', i)))), 0L, (none2, s) ->
                cast(size(array_distinct(flatten(transform(sequence(0, size(s) - 1), k ->
                    if(coalesce(get(s, k - 1).x = s[k].x, false) or coalesce(get(s, k + 1).x = s[k].x, false),
                       array(s[k].i, s[k].i + 1, s[k].i + 2), cast(array() as array<int>)))))) as bigint))))""")


def add_stats(docs: DataFrame) -> DataFrame:
    """``docs`` with the statistics (long): STATS, n_lines, n_capitals, n_marks, n_distinct."""
    names = [c for c in docs.columns if c not in {*STATS, *_OTHER, "n_lines"}]
    out = docs.select(*names, F.coalesce("text", F.lit("")).alias("_t"))
    out = out.select("*", F.filter(F.split("_t", _BLANK, -1), lambda w: w != "").alias("_w"),
                     F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    without = lambda pattern: F.length(F.regexp_replace("_t", pattern, ""))
    n = F.length("_t")
    stats = {
        "n_words": F.size("_w"), "word_chars": F.length(F.array_join("_w", "")), "n_symbols": n - without(r"[#*$%&|<>]+"),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")), "n_repeat_words": repeated_words("_w"), "n_lines": F.size("_l"),
        "n_capitals": n - without(r"\p{Lu}+"), "n_marks": n - without(r"[!?]+"), "n_distinct": F.size(F.array_distinct("_w"))}
    # a generated row: filters on statistics stay above it, and each is computed once
    return out.select(*names, F.inline(F.array(F.struct(*(c.cast("long").alias(k) for k, c in stats.items())))))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    @property
    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.threshold!r}D"


Rule = tuple[Condition, ...]


def rule_sql(rule: Rule) -> str:
    return " and ".join(c.sql for c in rule)


def fit_table(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """Statistics of the labelled documents that pass the base test, with bad (0 or 1) and held_out."""
    by_id = labels.where("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("_id"))
    sample = (by_id.agg(F.min("quality").alias("lo"), F.max("quality").alias("hi")).where("lo = hi")
              .select("_id", (1 - F.col("lo")).cast("int").alias("bad")).orderBy(F.xxhash64("_id"), "_id").limit(rows))
    known = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(sample), "_id")  # at most `rows` rows
    stats = add_stats(known).where(~base_failed()).withColumn("held_out", F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(3)) == 0)
    return materialise(stats.drop("text"), "quality-fit")


def _thresholds(fit: DataFrame) -> dict[str, list[float]]:
    at = [k / (BINS + 1) for k in range(1, BINS + 1)]
    quantiles = lambda f, bad: F.percentile_approx(F.when(F.col("bad") == bad, F.expr(FEATURES[f])), at, 10_000)
    row = fit.agg(*(quantiles(f, bad).alias(f"{f}_{bad}") for f in FEATURES for bad in (0, 1))).first()
    return {f: sorted({*(row[f"{f}_0"] or []), *(row[f"{f}_1"] or [])}) for f in FEATURES}


def _best_condition(rows: DataFrame, thresholds: dict[str, list[float]]) -> Condition | None:
    """The condition of the greatest information gain, from one histogram over all features."""
    def bin_of(f: str) -> Column:
        steps = F.array(*(F.lit(float(t)) for t in thresholds[f]))
        return F.size(F.filter(steps, lambda t: F.expr(FEATURES[f]) > t))

    cells = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), bin_of(f).alias("bin")) for f in FEATURES if thresholds[f])))
    counts = {(r.feature, r.bin): (r.p, r.n) for r in rows.select("bad", cells.alias("c")).groupBy("c.feature", "c.bin")
              .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()}
    best, top = None, 1e-9
    for f, steps in thresholds.items():
        bins = [counts.get((f, k), (0, 0)) for k in range(len(steps) + 1)]
        all_p, all_n = map(sum, zip(*bins))
        if not all_p:
            return None
        low_p = low_n = 0
        for k, t in enumerate(steps):  # bins 0 to k are the rows with feature <= t
            low_p, low_n = low_p + bins[k][0], low_n + bins[k][1]
            for above, p, n in ((False, low_p, low_n), (True, all_p - low_p, all_n - low_n)):
                if p and (gain := p * (math.log2(p / (p + n)) - math.log2(all_p / (all_p + all_n)))) > top:
                    best, top = Condition(f, above, t), gain
    if best is None:
        return None
    value = F.expr(FEATURES[best.feature])  # the middle of the gap around the threshold
    row = rows.agg(F.max(F.when(value <= best.threshold, value)).alias("lo"), F.min(F.when(value > best.threshold, value)).alias("hi")).first()
    return best if row.lo is None or row.hi is None else Condition(best.feature, best.above, (row.lo + row.hi) / 2)


def _pruned(rule: Rule, held: DataFrame) -> Rule | None:
    """The rule's beginning that does best on the rows held out, if good enough."""
    tests = [F.expr(rule_sql(rule[:k])) for k in range(1, len(rule) + 1)]
    row = held.agg(*(F.sum(F.when(t, F.col("bad") if bad else 1 - F.col("bad")).otherwise(0)).alias(f"c{k}_{bad}") for k, t in enumerate(tests) for bad in (0, 1))).first()
    scored = []
    for k in range(len(rule)):
        p, n = row[f"c{k}_1"] or 0, row[f"c{k}_0"] or 0
        if p >= MIN_COVER and p >= MIN_PRECISION * (p + n):
            scored.append(((p - n) / (p + n), p, -k))
    return rule[: 1 - max(scored)[2]] if scored else None


def learn(fit: DataFrame) -> list[Rule]:
    """The ordered rules for low quality. A grown rule that fails on the held-out rows sets its rows
    aside, and the search goes on without them."""
    thresholds, rules, tried = _thresholds(fit), [], []
    if not any(thresholds.values()):
        return rules
    for _ in range(MAX_RULES):
        rest = fit
        for done in tried:
            rest = rest.where(f"not ({rule_sql(done)})")
        rows, rule = rest.where("not held_out"), ()
        while len(rule) < MAX_CONDITIONS and (found := _best_condition(rows, thresholds)):
            rule, rows = (*rule, found), rows.where(found.sql)
        if not rule:
            break
        good = _pruned(rule, rest.where("held_out"))
        tried.append(good or rule)
        if good:
            rules.append(good)
    return rules


def decision(rules: list[Rule]) -> Column:
    """The first rule that fits, as text; null if none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(F.expr(rule_sql(rule)), F.lit(rule_sql(rule))).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with the statistics, base_failed, rule (the one that rejects) and kept."""
    rules = learn(fit_table(docs, labels))
    out = add_stats(docs).withColumn("base_failed", base_failed())
    out = out.withColumn("rule", F.when(~F.col("base_failed"), decision(rules)))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that the base test or a rule rejects; columns as given."""
    kept = judge(docs.select(F.struct("*").alias("_row"), "doc_id", "text"), labels).where("kept")
    return kept.select("_row.*")
