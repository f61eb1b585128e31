"""Porter stemming (M.F. Porter, "An algorithm for suffix stripping", 1980) as relational steps.

The rules are tables of (suffix, replacement); each step is one CASE expression over the word that the
step before has left, applied to the *distinct* vocabulary and joined back on the token. Conditions on
a stem's measure are patterns, as in the regular-expression renderings of the algorithm that are in wide use:
C is a run of consonants, V one of vowels, ``y`` a vowel after a consonant only.

Only lower-case ``a e i o u`` count as vowels, so an upper-case vowel behaves as a
consonant (the analyser that stems does not lower-case). Words of one or two characters
are returned unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the algorithm. Of the suffixes of a table that end a word the longest counts.
STEP_2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
          ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
          ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
          ("iviti", "ive"), ("biliti", "ble"), ("logi", "log")]
STEP_3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
STEP_4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
          "iti", "ous", "ive", "ize"]

_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
MEASURE_OVER_0 = f"^(?:{_C})?{_V}{_C}"
MEASURE_1 = f"^(?:{_C})?{_V}{_C}(?:{_V})?$"
MEASURE_OVER_1 = f"^(?:{_C})?{_V}{_C}{_V}{_C}"
HAS_VOWEL = f"^(?:{_C})?[aeiouy]"
ENDS_IN_CONSONANT = f"^(?:{_C})?(?:{_V}{_C})*$"
CONSONANT_VOWEL_CONSONANT = f"^{_C}[aeiouy][^aeiouwxy]$"  # of a stem of measure 1


def longest_first(rules: list) -> list:
    return sorted(rules, key=lambda r: -len(r[0] if isinstance(r, tuple) else r))


def _cut(w: Column, n: int) -> Column:
    return F.substring(w, F.lit(1), F.length(w) - n)


def _doubled(w: Column) -> Column:
    return (F.length(w) > 1) & (F.substring(w, -1, 1) == F.substring(_cut(w, 1), -1, 1)) & w.rlike(ENDS_IN_CONSONANT)


def _cases(w: Column, rules: list[tuple[str, Column]]) -> Column:
    """The value of the first rule whose suffix ends the word, else the word."""
    out = None
    for suffix, value in rules:
        out = (F if out is None else out).when(w.endswith(suffix), value)
    return out.otherwise(w)


def _steps(w: Column) -> list[tuple[Column | None, Column]]:
    """Each step's expression over the same column, which holds what the step before has left; the step that
    takes off ed and ing also says whether it did (``_lost``)."""
    plural = _cases(w, [("sses", _cut(w, 2)), ("ies", F.concat(_cut(w, 3), F.lit("i"))), ("ss", w), ("s", _cut(w, 1))])
    lost_ed, lost_ing = w.endswith("ed") & _cut(w, 2).rlike(HAS_VOWEL), w.endswith("ing") & _cut(w, 3).rlike(HAS_VOWEL)
    past = (F.when(w.endswith("eed"), F.when(_cut(w, 3).rlike(MEASURE_OVER_0), _cut(w, 1)).otherwise(w))
            .when(lost_ed, _cut(w, 2)).when(lost_ing, _cut(w, 3)).otherwise(w))
    lost = ~w.endswith("eed") & (lost_ed | lost_ing)
    mended = F.when(~F.col("_lost"), w).otherwise(
        F.when(w.endswith("at") | w.endswith("bl") | w.endswith("iz"), F.concat(w, F.lit("e")))
        .when(_doubled(w), F.when(F.substring(w, -1, 1).isin("l", "s", "z"), w).otherwise(_cut(w, 1)))
        .when(w.rlike(MEASURE_1) & w.rlike(CONSONANT_VOWEL_CONSONANT), F.concat(w, F.lit("e"))).otherwise(w))
    long = F.length(w) > 1
    final_y = F.when(long & w.endswith("y") & _cut(w, 1).rlike(HAS_VOWEL), F.concat(_cut(w, 1), F.lit("i"))).otherwise(w)
    table = lambda rules: _cases(w, [(a, F.when(_cut(w, len(a)).rlike(MEASURE_OVER_0), F.concat(_cut(w, len(a)), F.lit(b))).otherwise(w))
                                     for a, b in longest_first(rules)])
    bare = _cases(w, [(a, F.when(_cut(w, len(a)).rlike(MEASURE_OVER_1) & (_cut(w, len(a)).rlike("[st]$") if a == "ion" else F.lit(True)),
                                 _cut(w, len(a))).otherwise(w)) for a in longest_first(STEP_4)])
    final_e = F.when(long & w.endswith("e") & (w.rlike(MEASURE_OVER_1) | (w.rlike(MEASURE_1) & ~_cut(w, 1).rlike(CONSONANT_VOWEL_CONSONANT))),
                     _cut(w, 1)).otherwise(w)
    final_l = F.when(w.endswith("ll") & w.rlike(MEASURE_OVER_1), _cut(w, 1)).otherwise(w)
    return [(None, plural), (lost, past), (None, mended), *((None, x) for x in (final_y, table(STEP_2), table(STEP_3), bare, final_e, final_l))]


def stem_column_values(vocab: DataFrame, col: str, out: str) -> DataFrame:
    """Distinct values of ``col`` -> (col, out=stem). A leading ``y``, a consonant, is a capital on the way."""
    w = F.col(out)
    df = vocab.select(col).withColumn(out, F.when(F.col(col).startswith("y"), F.concat(F.lit("Y"), F.substring(col, 2, 1 << 30))).otherwise(F.col(col)))
    short = F.length(col) <= 2
    for lost, step in _steps(w):
        if lost is not None:
            df = df.withColumn("_lost", lost)
        df = df.withColumn(out, step)
    back = F.when(F.col(col).startswith("y"), F.concat(F.lit("y"), F.substring(w, 2, 1 << 30))).otherwise(w)
    return df.select(col, F.when(short, F.col(col)).otherwise(back).alias(out))
