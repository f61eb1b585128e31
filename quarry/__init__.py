"""quarry: corpus analytics and batch ranked retrieval as Spark DataFrame jobs.

Stages (every one is DataFrame in -> DataFrame out, no driver-side loops over data):

* ``sources``    read HTML folders, stored pages, table-JSON files, crawl logs
* ``operators``  DOM intervals, extraction, table mining, index build, search, shaping
* ``functions``  Catalyst column expressions (text analysis, BM25) and one small
                 stemming helper applied to the distinct vocabulary only
* ``plans``      the driver-facing query catalogue over the test tables
* ``streaming``  incremental page ingestion with Structured Streaming
"""

__version__ = "0.1.0"
