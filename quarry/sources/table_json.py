"""Table-JSON source (SRC2, EXT15-EXT17) and generic JSON-object explode.

A table file holds one JSON object per paper: ``{table_id: record}``. Files are read
whole (``wholetext``), parsed with a fixed schema (never inferred) and exploded to one
row per table. Files that are not a JSON object (malformed, array root) parse to null
and go to a quarantine DataFrame instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import clean_list, flatten_html_list

RECORD = ("struct<source_file:string,caption:string,body:string,html_code:string,"
          "informative_terms_identified:array<string>,citing_paragraphs:array<string>,"
          "contextual_paragraphs:array<struct<html:string,matched_terms:array<string>>>>")
TABLE_MAP = f"map<string,{RECORD}>"


def read_table_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``*.json`` files under ``path`` -> (tables, quarantine(file, reason))."""
    raw = (spark.read.option("wholetext", "true").option("pathGlobFilter", "*.json").text(path)
           .select(F.input_file_name().alias("file"), "value"))
    return parse_table_documents(raw, "file", "value")


def parse_table_documents(raw: DataFrame, file_col: str, json_col: str) -> tuple[DataFrame, DataFrame]:
    parsed = raw.select(F.col(file_col).alias("file"),
                        F.from_json(F.col(json_col), TABLE_MAP, {"mode": "PERMISSIVE"}).alias("m"))
    bad = parsed.where(F.col("m").isNull()).select("file", F.lit("not a JSON object").alias("reason"))
    name = F.element_at(F.split("file", "/"), -1)
    paper = F.regexp_replace(F.regexp_replace(name, "_data\\.json$", ""), "\\.json$", "")
    rows = (parsed.where(F.col("m").isNotNull())
            .select(paper.alias("paper_id"), F.explode("m").alias("table_id", "r")))
    tables = rows.select(
        F.concat_ws("_", "paper_id", "table_id").alias("id"), "paper_id", "table_id",
        F.coalesce("r.source_file", "paper_id").alias("sourceFilename"),
        F.coalesce("r.caption", F.lit("")).alias("caption"),
        F.coalesce("r.body", F.lit("")).alias("body"),
        F.col("r.html_code").alias("html_code"),
        clean_list(F.col("r.informative_terms_identified")).alias("informative_terms"),
        clean_list(F.col("r.citing_paragraphs")).alias("citing_paragraphs"),
        F.coalesce("r.contextual_paragraphs",
                   F.array().cast("array<struct<html:string,matched_terms:array<string>>>")).alias("contextual_paragraphs"),
        flatten_html_list(F.col("r.contextual_paragraphs")).alias("contextual_html"))
    return tables, bad


def tables_per_file(tables: DataFrame) -> DataFrame:
    """AGG14: tables parsed per paper."""
    return tables.groupBy("paper_id").agg(F.count(F.lit(1)).alias("n_tables"))


def explode_json_object(df: DataFrame, key: str, col: str) -> DataFrame:
    """JSON object column -> (key, json key, value as string); invalid JSON gives no rows."""
    m = F.from_json(F.col(col), "map<string,string>", {"mode": "PERMISSIVE"})
    return df.select(key, F.explode(m).alias("key", "value"))
