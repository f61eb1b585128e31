"""Crawl ledger: outcome per fetched item and totals per batch / overall (SRC4, AGG9-AGG12).

The network fetch itself is not part of the engine; its data work is. A crawl log has
one row per requested item: (idx, status, seconds, bytes). Items are requested in
batches of 25 (offsets 0, 25, 50, ...; the last batch may be shorter).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference's crawler.
BATCH_SIZE = 25
STATUSES = ["downloaded", "skipped", "error"]


def classify(event_type) -> F.Column:
    """Outcome of one item (AGG10): a failed fetch is an error, an item without a full-text
    rendering is skipped, everything else was downloaded."""
    return (F.when(event_type == "error", F.lit("error"))
            .when(event_type == "view", F.lit("skipped"))
            .otherwise(F.lit("downloaded")))


def events_as_crawl_log(events: DataFrame) -> DataFrame:
    """Driver ``events`` re-read as a crawl log: idx = event_id, outcome from event_type,
    seconds = value, bytes = size of the payload."""
    return events.select(F.col("event_id").alias("idx"), classify(F.col("event_type")).alias("status"),
                         F.col("value").alias("seconds"),
                         F.octet_length(F.coalesce("props", F.lit(""))).alias("bytes"))


def batch_offsets(requested: DataFrame) -> DataFrame:
    """SRC4: batch number, start offset and page size added to every requested item (idx)."""
    n = requested.agg(F.count(F.lit(1)).alias("k"))
    b = F.floor(F.col("idx") / BATCH_SIZE)
    return (requested.crossJoin(F.broadcast(n))  # one-row statistics
            .select(*requested.columns, b.alias("batch"), (b * BATCH_SIZE).alias("start_offset"),
                    F.least(F.lit(BATCH_SIZE), F.col("k") - b * BATCH_SIZE).alias("page_size")))


def batch_counts(log: DataFrame) -> DataFrame:
    """AGG9: per batch processed / downloaded / skipped / error counts, and the batches
    that downloaded nothing."""
    return (batch_offsets(log).groupBy("batch", "start_offset", "page_size")
            .agg(F.count(F.lit(1)).alias("processed"),
                 F.count_if(F.col("status") == "downloaded").alias("downloaded"),
                 F.count_if(F.col("status") == "skipped").alias("skipped"),
                 F.count_if(F.col("status") == "error").alias("errors"))
            .withColumn("empty_batch", F.col("downloaded") == 0))


def totals(log: DataFrame) -> DataFrame:
    """AGG9 grand total, AGG11 mean seconds per download (only when > 0), AGG12 MB."""
    dl = F.count_if(F.col("status") == "downloaded")
    return log.agg(
        F.count(F.lit(1)).alias("requested"), F.count(F.lit(1)).alias("processed"), dl.alias("downloaded"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.round(F.sum("seconds"), 6).alias("total_seconds"),
        F.round(F.sum("seconds") / F.nullif(dl, F.lit(0)), 6).alias("seconds_per_download"),
        F.round(F.sum(F.when(F.col("status") == "downloaded", F.col("bytes")).otherwise(0)) / F.lit(1048576.0), 6)
        .alias("size_mb"))


def batch_rollup(log: DataFrame) -> DataFrame:
    """AGG9-AGG12 by batch and overall in one aggregation: a row for each batch (level 0) and one for
    the whole log (level 1, batch null); an empty log has no rows."""
    got = F.col("status") == "downloaded"
    dl = F.count_if(got)
    return (log.withColumn("batch", F.floor(F.col("idx") / BATCH_SIZE)).rollup("batch")
            .agg(F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("processed"), dl.alias("downloaded"),
                 F.count_if(F.col("status") == "skipped").alias("skipped"), F.count_if(F.col("status") == "error").alias("errors"),
                 F.round(F.sum("seconds"), 6).alias("total_seconds"),
                 F.round(F.sum("seconds") / F.nullif(dl, F.lit(0)), 6).alias("seconds_per_download"),
                 F.sum(F.when(got, F.col("bytes")).otherwise(0)).cast("long").alias("bytes")))
