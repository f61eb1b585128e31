"""HTML folder source (SRC1, SRC3, AGG12).

Files are read with the ``binaryFile`` source: one row per file, the id is the file name.
The glob is case-insensitive on the extension; unreadable files are skipped when
``spark.sql.files.ignoreCorruptFiles`` is on; a missing folder gives an empty result.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HTML_GLOB = "*.[hH][tT][mM][lL]"
SCHEMA = "page_id long, url string, id string, html string, bytes long"


def read_html_folder(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """``path`` -> pages(page_id, url, id, html, bytes). ``page_id`` is a 64-bit hash of
    the path (stable across runs, no global numbering job)."""
    try:
        raw = (spark.read.format("binaryFile").option("pathGlobFilter", HTML_GLOB)
               .option("recursiveFileLookup", str(recursive).lower()).load(path))
    except AnalysisException as e:  # missing folder -> empty corpus
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], SCHEMA)
        raise
    return raw.select(F.xxhash64("path").alias("page_id"), F.col("path").alias("url"),
                      F.element_at(F.split("path", "/"), -1).alias("id"),
                      F.decode("content", "UTF-8").alias("html"), F.col("length").alias("bytes"))


def folder_size(spark: SparkSession, path: str) -> DataFrame:
    """AGG12 without reading contents: file count and size in MB from file metadata."""
    raw = (spark.read.format("binaryFile").option("pathGlobFilter", "*").load(path).select("length"))
    return raw.agg(F.count(F.lit(1)).alias("n_files"), F.round(F.sum("length") / F.lit(1048576.0), 6).alias("size_mb"))


def first_files(pages: DataFrame, n: int | None, name_col: str = "id") -> DataFrame:
    """SRC3: deterministic file order, optionally only the first ``n`` files (no limit when
    ``n`` is None or <= 0). Ordering + limit keeps at most n rows per partition."""
    ordered = pages.orderBy(name_col)
    return ordered.limit(n) if n is not None and n > 0 else ordered
