"""Analysers, keyword rule and the Porter stemmer."""

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.stemmer import stem_column_values


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("r")).first()["r"]


def stems(spark, words):
    vocab = spark.createDataFrame([(w,) for w in words], "t string")
    return {r.t: r.s for r in stem_column_values(vocab, "t", "s").collect()}


def test_porter_published_examples(spark):
    # examples from Porter (1980)
    cases = {"caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
             "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
             "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
             "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
             "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
             "rational": "ration", "valenci": "valenc", "digitizer": "digit", "conformabli": "conform",
             "radicalli": "radic", "differentli": "differ", "vileli": "vile", "analogousli": "analog",
             "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal",
             "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous", "formaliti": "formal",
             "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form",
             "formalize": "formal", "electriciti": "electr", "electrical": "electr", "hopeful": "hope",
             "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer",
             "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens",
             "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend",
             "adoption": "adopt", "homologou": "homolog", "communism": "commun", "activate": "activ",
             "angulariti": "angular", "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler",
             "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll"}
    assert stems(spark, cases) == cases


def test_porter_is_case_sensitive(spark):
    # the stemming analyser does not lower-case: suffixes only match in lower case, and
    # an upper-case vowel counts as a consonant
    cases = {"running": "run", "RUNNING": "RUNNING", "agreed": "agre", "Agreed": "Agreed", "comparison": "comparison", "ab": "ab",
             "yes": "ye", "yying": "yy", "sses": "ss", "ies": "i", "ing": "ing", "\u00e9\u00e9ing": "\u00e9\u00e9ing", "tyying": "ty"}
    assert {w: s for w, s in stems(spark, cases).items()} == cases


def test_letter_and_standard_tokens(spark):
    assert one(spark, T.letter_tokens, "Héllo, Wörld 12 ab_c") == ["héllo", "wörld", "ab", "c"]
    assert one(spark, T.standard_tokens, "It's 3.5 e.g. x,y 1,000 ab_c") == ["it's", "3.5", "e.g", "x", "y", "1,000", "ab_c"]
    assert one(spark, T.whitespace_tokens, " a b\tC ") == ["a", "b", "C"]


def test_informative_terms_rule(spark):
    got = one(spark, T.informative_terms, "The F1-score of Table 2: 2024 results, using BERT model and the model")
    # punctuation deleted (not blanked), stop words / short / all-digit tokens dropped, set semantics
    assert got == sorted({"f1score", "results", "bert", "model"})
    assert one(spark, T.informative_terms, None) == []


def test_clean_lists(spark):
    df = spark.createDataFrame([([" a ", "", None, "b"],)], "x array<string>")
    assert df.select(T.clean_list(F.col("x"))).first()[0] == ["a", "b"]
    assert spark.createDataFrame([(None,)], "x array<string>").select(T.clean_list(F.col("x"))).first()[0] == []


def test_snippet(spark):
    long = "x" * 200
    assert one(spark, lambda c: T.snippet(c), long) == "x" * 150 + "..."
    assert one(spark, lambda c: T.snippet(c), "short") == "short..."
    assert one(spark, lambda c: T.snippet(c), None) == "Abstract non disponibile."
