"""Incremental ingestion of new pages with Structured Streaming.

New page files arriving in a folder are read as a stream; every micro-batch is turned
into postings (same analysis as the batch index) and appended to the stored index under
``postings/batch=<id>``. The write of a batch overwrites its own folder, so a replayed
batch after a failure (same batch id from the checkpoint) is idempotent. Dictionary and
field statistics are derived from the stored postings when queried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.extract import extract_articles
from quarry.operators.index import postings_from_tokens, token_rows, unpivot_fields

PAGES_SCHEMA = "page_id long, url string, html string"
ARTICLE_FIELDS = ["title", "authors", "articleAbstract", "paragraphs"]


def page_stream(spark: SparkSession, folder: str, fmt: str = "parquet", max_files: int = 100) -> DataFrame:
    """Stream of pages(page_id, url, html) from files landing in ``folder``."""
    return (spark.readStream.format(fmt).schema(PAGES_SCHEMA)
            .option("maxFilesPerTrigger", max_files).load(folder))


def _index_batch(out: str, analyzers: dict[str, str]):
    def run(batch: DataFrame, batch_id: int) -> None:
        arts = extract_articles(batch)
        fields = {"title": F.col("title"), "authors": F.array_join("authors", " "),
                  "articleAbstract": F.col("articleAbstract"), "paragraphs": F.array_join("paragraphs", " ")}
        tok = token_rows(unpivot_fields(arts, "page_id", fields), analyzers)
        (postings_from_tokens(tok)
         .write.mode("overwrite").parquet(f"{out}/postings/batch={batch_id}"))
        arts.write.mode("overwrite").parquet(f"{out}/docs/batch={batch_id}")
        batch.sparkSession.catalog.clearCache()
    return run


def start_incremental_index(stream: DataFrame, out: str, checkpoint: str,
                            analyzers: dict[str, str] | None = None, available_now: bool = True):
    """Start the query; ``checkpoint`` must be on shared storage on a cluster."""
    writer = (stream.writeStream.foreachBatch(_index_batch(out, analyzers or {"*": "letters"}))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def stored_term_stats(spark: SparkSession, out: str) -> DataFrame:
    """Dictionary of the incrementally built index: (field, term, df, ttf)."""
    p = spark.read.parquet(f"{out}/postings")
    return p.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf"))
