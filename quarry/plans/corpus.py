"""Mapping of the driver's test tables onto the engine's document model.

* ``documents`` rows are articles: id = ``doc_id``; title = first line; authors =
  ``[source]``; abstract = second line (or the placeholder); paragraphs = all lines.
* ``benchmark`` items play the role of mined tables / short queries (caption = text).
* ``pages`` are raw HTML pages (article extraction, DOM jobs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.index import Index, build_index
from quarry.sources.tables import read_table

# Sentinel strings indexed as real text (fixed values of the reference).
NO_TITLE = "No Title Found"
NO_ABSTRACT = "No Abstract Found"
UNKNOWN_DATE = "Unknown Date"

# Analyser choices. ``reference`` mirrors the reference's per-field dispatch; ``letters``
# uses the simple analyser everywhere (exactly reproducible by the SQL oracle).
ARTICLE_ANALYZERS_REFERENCE = {"title": "letters", "authors": "letters", "paragraphs": "standard",
                               "articleAbstract": "standard", "id": "keyword", "*": "porter"}
LETTERS = {"*": "letters"}

ARTICLE_DEFAULT_FIELDS = ["title", "authors", "articleAbstract", "paragraphs"]


def documents_as_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.split(F.col("text"), "\n")
    return read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"]).select(
        "doc_id",
        F.coalesce(F.try_element_at(lines, F.lit(1)), F.lit(NO_TITLE)).alias("title"),
        F.array("source").alias("authors"),
        F.coalesce(F.try_element_at(lines, F.lit(2)), F.lit(NO_ABSTRACT)).alias("articleAbstract"),
        lines.alias("paragraphs"),
        F.lit(UNKNOWN_DATE).alias("publicationDate"),
    )


def body_index(spark: SparkSession, sf_dir: str, with_positions: bool = False) -> Index:
    """Two-field index over ``documents``: ``title`` (first line) and ``body`` (text)."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    fields = {"title": F.split("text", "\n")[0], "body": F.col("text")}
    stored = docs.select("doc_id", F.split("text", "\n")[0].alias("title"), "text")
    idx = build_index("documents", docs, "doc_id", fields, LETTERS, ["title", "body"], with_positions)
    idx.docs = stored
    return idx


def article_index(spark: SparkSession, sf_dir: str, analyzers: dict[str, str] | None = None,
                  with_positions: bool = False) -> Index:
    """Article index over ``documents`` with the reference's four searchable fields."""
    arts = documents_as_articles(spark, sf_dir)
    fields = {
        "title": F.col("title"),
        "authors": F.array_join("authors", " "),
        "articleAbstract": F.col("articleAbstract"),
        "paragraphs": F.array_join("paragraphs", " "),
        "publicationDate": F.col("publicationDate"),
    }
    return build_index("articoli", arts, "doc_id", fields, analyzers or LETTERS,
                       ARTICLE_DEFAULT_FIELDS, with_positions)


# Table index: keyword fields exact, everything else whitespace tokens + Porter stem
# (case-sensitive), as the reference's per-field dispatch does for tables.
TABLE_ANALYZERS = {"id": "keyword", "sourceFilename": "keyword", "*": "porter"}
TABLE_FIELDS_FAITHFUL = ["caption", "body"]
TABLE_FIELDS_INTENDED = ["caption", "body", "citing_paragraphs", "informative_terms", "contextual_paragraphs"]
TABLE_FIELD_ALIASES = {"mentions": "citing_paragraphs", "terms": "informative_terms",
                       "context_paragraphs": "contextual_paragraphs"}


def table_index(tables: DataFrame, mode: str = "intended", raw_markup: bool = False) -> Index:
    """Index over table records (id, paper_id, sourceFilename, caption, body, html_code,
    informative_terms, citing_paragraphs, contextual_html). Citing and contextual
    paragraphs are indexed as text (``raw_markup=True`` indexes the markup as the
    reference does)."""
    from quarry.operators.dom import html_text
    conv = (lambda c: c) if raw_markup else html_text
    docs = tables.select(
        F.col("id").alias("doc_id"), "paper_id", F.coalesce("sourceFilename", F.lit("Unknown")).alias("sourceFilename"),
        F.coalesce("caption", F.lit("")).alias("caption"), F.coalesce("body", F.lit("")).alias("body"), "html_code",
        F.array_join(F.coalesce("informative_terms", F.array().cast("array<string>")), " ").alias("informative_terms_text"),
        F.array_join(F.transform(F.coalesce("citing_paragraphs", F.array().cast("array<string>")), conv), " ").alias("citing_text"),
        F.array_join(F.transform(F.coalesce("contextual_html", F.array().cast("array<string>")), conv), " ").alias("contextual_text"))
    fields = {"id": F.col("doc_id"), "sourceFilename": F.col("sourceFilename"), "caption": F.col("caption"),
              "body": F.col("body"), "informative_terms": F.col("informative_terms_text"),
              "citing_paragraphs": F.col("citing_text"), "contextual_paragraphs": F.col("contextual_text")}
    defaults = TABLE_FIELDS_INTENDED if mode == "intended" else TABLE_FIELDS_FAITHFUL
    return build_index("tabelle", docs, "doc_id", fields, TABLE_ANALYZERS, defaults,
                       with_positions=True, aliases=TABLE_FIELD_ALIASES)
