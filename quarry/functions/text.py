"""Text analysis as Catalyst expressions (no Python on the hot path).

Every analyser turns a string column into an ``array<string>`` of tokens in document
order, so ``posexplode`` yields positions for phrase queries. All patterns but the standard
analyser's, which looks behind, run unchanged in Java regex (Spark) and RE2 (the SQL oracle).
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# ---------------------------------------------------------------------------

# Stop words of the table miner (English plus basic Italian, plus domain words), in the
# order the reference lists them (it holds them as a set; 'a' and 'in' occur twice).
MINER_STOP_WORDS = [
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by",
    "is", "are", "was", "were", "be", "been", "this", "that", "these", "those", "it", "we",
    "can", "may", "should", "table", "figure", "section", "eq", "et", "al", "shown", "using",
    "il", "lo", "la", "i", "gli", "le", "un", "uno", "una", "di", "a", "da", "in", "con", "su", "per",
    "tra", "fra", "è", "sono",
]

# Italian stop-word file shipped with the reference but referenced by no code path;
# offered as an optional second list.
ITALIAN_STOP_WORDS = [
    "a", "ad", "al", "alla", "allo", "anche", "che", "con", "da", "dal", "della", "dello", "di",
    "e", "è", "gli", "ha", "il", "in", "la", "le", "ma", "ne", "non", "o", "per", "si", "su",
    "tra", "un", "una", "uno",
]

# The 32 ASCII punctuation characters deleted (not blanked) before splitting.
PUNCTUATION = string.punctuation

# Minimum shared informative terms for a contextual paragraph.
CONTEXT_MIN_SHARED_TERMS = 2

# ---------------------------------------------------------------------------
# Patterns (portable between Java regex and RE2).
# ---------------------------------------------------------------------------

# Characters Python's ``str.split()`` treats as whitespace (Unicode White_Space plus the
# four ASCII information separators).
WHITESPACE_CLASS = (
    "[\\t\\n\\x0b\\x0c\\r \\x1c-\\x1f\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
)
WHITESPACE_RUN = WHITESPACE_CLASS + "+"

# Simple analyser: maximal runs of letters.
LETTER_RUN = "\\p{L}+"

# Standard analyser, after the Unicode word-break rules for alphabetic scripts: a run of
# letters/marks/digits/underscore, extended across one of .:·'’ between two letters and one of
# .,;'’ between two digits.
STANDARD_TOKEN = (
    "[\\p{L}\\p{M}\\p{N}_]+(?:(?:(?<=[\\p{L}\\p{M}])[.:·'’](?=\\p{L})|(?<=\\p{N})[.,;'’](?=\\p{N}))"
    "[\\p{L}\\p{M}\\p{N}_]+)*"
)

# Longer tokens are split into pieces of this many characters, each a token of its own.
STANDARD_MAX_TOKEN = 255

ALL_DIGITS = "^\\p{Nd}+$"


def _lit_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in dict.fromkeys(values)])


def letter_tokens(text: Column) -> Column:
    """Simple analyser (title, authors): lower-cased maximal letter runs."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(LETTER_RUN), 0)


def standard_tokens(text: Column) -> Column:
    """Standard analyser (paragraphs, abstract): word tokens, lower-cased, long ones in pieces."""
    toks = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(STANDARD_TOKEN), 0)
    size = F.lit(STANDARD_MAX_TOKEN)
    starts = lambda t: F.sequence(F.lit(0), F.floor((F.length(t) - 1) / size).cast("int"))
    return F.flatten(F.transform(toks, lambda t: F.transform(starts(t), lambda k: F.substring(t, k * size + 1, size))))


def whitespace_tokens(text: Column) -> Column:
    """Whitespace tokens, case kept (input of the stemming analyser)."""
    parts = F.split(F.coalesce(text, F.lit("")), WHITESPACE_RUN)
    return F.filter(parts, lambda t: t != F.lit(""))


def keyword_tokens(text: Column) -> Column:
    """Keyword analysis: the whole value is one term."""
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.array(text))


def informative_terms(text: Column, stop_words: list[str] | None = None) -> Column:
    """Set of informative terms of a text (table miner keyword rule).

    lower -> delete ASCII punctuation -> split on whitespace -> drop stop words, tokens of
    length <= 2 and all-digit tokens -> distinct. Returned sorted so that results are
    deterministic (the reference keeps an unordered set). ``array_except`` removes the stop
    words and duplicates with a hash set, so the per-token lambda only sees distinct
    candidates; ``sort_array`` is code-generated (``array_sort`` would run a comparator lambda).
    """
    stop = _lit_array((stop_words if stop_words is not None else MINER_STOP_WORDS) + [""])
    cleaned = F.translate(F.lower(F.coalesce(text, F.lit(""))), PUNCTUATION, "")
    candidates = F.array_except(F.split(cleaned, WHITESPACE_RUN), stop)
    kept = F.filter(candidates, lambda t: (F.length(t) > 2) & ~t.rlike(ALL_DIGITS))
    return F.sort_array(kept)


def clean_list(values: Column) -> Column:
    """Trim every string, drop blanks; a null list becomes empty."""
    trimmed = F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x: F.trim(x))
    return F.filter(trimmed, lambda x: x.isNotNull() & (x != F.lit("")))


def flatten_html_list(values: Column) -> Column:
    """List of ``{html, ...}`` records -> list of trimmed, non-blank html strings."""
    empty = F.array().cast("array<struct<html:string,matched_terms:array<string>>>")
    htmls = F.transform(F.coalesce(values, empty), lambda x: F.trim(x["html"]))
    return F.filter(htmls, lambda x: x.isNotNull() & (x != F.lit("")))


def join_values(values: Column) -> Column:
    """Multi-valued field -> one indexed string, values separated by a space."""
    return F.array_join(F.coalesce(values, F.array().cast("array<string>")), " ")


def snippet(text: Column, width: int = 150, missing: str = "Abstract non disponibile.") -> Column:
    """First ``width`` characters plus '...' (always appended); placeholder when null."""
    return F.when(text.isNull(), F.lit(missing)).otherwise(
        F.concat(F.substring(text, 1, width), F.lit("..."))
    )


def searchable_text(caption: Column, terms: Column, citing: Column) -> Column:
    """All searchable text of a table: the caption, every keyword and every citing
    paragraph, each followed by a space (EXT18)."""
    def spaced(values: Column) -> Column:
        vals = F.coalesce(values, F.array().cast("array<string>"))
        return F.array_join(F.transform(vals, lambda t: F.concat(t, F.lit(" "))), "")
    return F.concat(F.coalesce(caption, F.lit("")), F.lit(" "), spaced(terms), spaced(citing))
