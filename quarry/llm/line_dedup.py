"""Line dedup: keys that many documents share stay in one of them only.

Hashes of line keys are range-partitioned together with the document id and sorted by
(hash, document, place). One streaming pass over each partition meets the documents of a key
in order, the largest id first; it lets the first occurrence stay and reports the places of
the others. What comes back to the documents is a compressed bitmap of the lines that stay,
never text.

A range boundary may fall inside a key that very many documents hold, which keeps such a key
from landing in one task. Runs that touch a partition's edge are therefore reported as open,
with one summary row each; the summaries (at most two for each partition) say of every open
key how many documents hold it and which is the last.

Defined results: a null or empty text is one empty line; documents with the same id are one
holder of a key; a null id is smaller than all others; an exact repeat of a row gets the same
bitmap; no rows give no rows. Only doc_id and text are read; other columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from quarry.llm.common import arrow_rows, count_newlines, materialise, slices, to_batch

MIN_CHARS, MIN_DOCS = 40, 5
BLANKS = " \t\n\x0b\x0c\r"
_KEYS = "h1 long, h2 long, doc_id long, version long, places array<int>"
_RUNS = "open boolean, h1 long, h2 long, holders long, last_doc long, doc_id long, version long, places array<int>"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(n, kinds[k]) for n, k in (f.strip().split(" ") for f in ddl.split(","))])


def line_key(line: str) -> bytes:
    """Both ends stripped of blanks, A-Z lower-cased (``bytes.lower`` is ASCII only)."""
    return line.strip(BLANKS).encode("utf-8", "surrogatepass").lower()


def _key_rows(min_chars: int):
    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for doc, version, text in (row for part in slices(batch, 2) for row in zip(*(c.to_pylist() for c in part.columns))):
            places: dict[bytes, list[int]] = {}
            for at, line in enumerate(text.split("\n")):
                if len(line) >= min_chars and len(line.strip(BLANKS)) >= min_chars:
                    places.setdefault(xxhash.xxh3_128_digest(line_key(line)), []).append(at)
            for h, where in places.items():
                yield int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True), doc, version, where
    return rows


class _Run:
    """The documents of one key, in order: holds back rows until enough documents are seen."""

    def __init__(self, key: tuple, opens: bool, min_docs: int):
        self.key, self.opens, self.min_docs = key, opens, min_docs
        self.holders, self.first, self.doc, self.held = 0, None, None, []

    def add(self, doc, version, places) -> Iterator[tuple]:
        if self.holders == 0 or doc != self.doc:
            self.holders += 1
            self.first = doc if self.holders == 1 else self.first
            self.doc = doc
        if self.opens:
            yield (True, *self.key, None, None, doc, version, places)
        elif self.holders > 1:
            self.held.append((False, *self.key, None, None, doc, version, places))
            if self.holders >= self.min_docs:
                yield from self.held
                self.held = []

    def summary(self) -> tuple:
        return (True, *self.key, self.holders, self.first, None, None, None)


def _stream(min_docs: int):
    """First-occurrence pass over one sorted partition. The first key's run is open, as documents
    before it may lie in the partition before. The last run is open only while fewer documents
    than ``min_docs`` are seen: its first document is the key's last in any case."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, out, current = _arrow(_RUNS), [], None
        for batch in batches:
            for h1, h2, doc, version, places in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or current.key != (h1, h2):
                    if current is not None and current.opens:
                        out.append(current.summary())
                    current = _Run((h1, h2), current is None, min_docs)
                out.extend(current.add(doc, version, places))
                if len(out) >= 5000:
                    yield to_batch(out, schema)
                    out = []
        if current is not None:
            out.extend((True, *row[1:]) for row in current.held)
            out.append(current.summary())
        if out:
            yield to_batch(out, schema)

    return run


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, version, places): one row for each document and long key, by 128-bit hash.
    version tells rows of one id with different texts apart."""
    schema, rows = _arrow(_KEYS), _key_rows(min_chars)
    return (docs.where(F.col("text").isNotNull())
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), "text")
            .mapInArrow(lambda batches: arrow_rows(batches, schema, rows), _KEYS))


def dropped_places(keys: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, version, places) of the lines that go."""
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc_nulls_last()]
    runs = materialise(keys.repartitionByRange(*order).sortWithinPartitions(*order, "version")
                       .mapInArrow(_stream(min_docs), _RUNS), "line-runs")
    edges = (runs.where("open and holders is not null").groupBy("h1", "h2")
             .agg(F.sum("holders").alias("n"), F.max("last_doc").alias("last")).where(F.col("n") >= min_docs))
    opened = (runs.where("open and holders is null").join(F.broadcast(edges), ["h1", "h2"])  # two rows a partition at most
              .where(~F.col("doc_id").eqNullSafe(F.col("last"))))
    names = ["doc_id", "version", "places"]
    return runs.where("not open").select(*names).unionByName(opened.select(*names))


@F.pandas_udf(BinaryType())
def pack_bitmap(places: pd.Series) -> pd.Series:
    """Compressed bitmap with a 1 for each line that stays, up to the last line that goes."""
    def one(at) -> bytes:
        keep = np.ones(-(-(int(max(at)) + 1) // 8) * 8, dtype=bool)  # whole bytes
        keep[np.asarray(at, dtype=np.int64)] = False
        return zlib.compress(np.packbits(keep).tobytes())
    return places.map(one)


def kept_lines(bitmap: bytes, lines: int) -> np.ndarray:
    """Which of ``lines`` lines stay; lines beyond the bitmap do."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8)).astype(bool)[:lines]
    return np.concatenate([bits, np.ones(lines - len(bits), dtype=bool)])


@F.pandas_udf(StructType().add("n_dropped", LongType()).add("kept", StringType()))
def apply_bitmap(text: pd.Series, bitmap: pd.Series) -> pd.DataFrame:
    rows = []
    for t, b in zip(text, bitmap):
        if t is None or b is None:
            rows.append((0, None))
            continue
        lines = t.split("\n")
        keep = kept_lines(b, len(lines))
        rows.append((int((~keep).sum()), "\n".join(x for x, k in zip(lines, keep) if k)))
    return pd.DataFrame(rows, columns=["n_dropped", "kept"])


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, version, bitmap) of the documents that lose lines; the others keep all."""
    return (dropped_places(line_keys(docs, min_chars), min_docs).groupBy("doc_id", "version")
            .agg(F.flatten(F.collect_list("places")).alias("places"))
            .select("doc_id", "version", pack_bitmap("places").alias("bitmap")))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the kept lines in ``text`` and two more columns, n_lines (before) and n_dropped."""
    bitmaps = (keep_bitmaps(docs, min_chars, min_docs)
               .select(F.col("doc_id").alias("_doc"), F.col("version").alias("_version"), F.col("bitmap").alias("_bitmap")))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    own = docs.select(*names).withColumn("_v", F.xxhash64("text"))
    joined = own.join(bitmaps, F.col("doc_id").cast("long").eqNullSafe(F.col("_doc")) & (F.col("_v") == F.col("_version")), "left")
    texts = F.when(F.col("_bitmap").isNotNull(), F.col("text"))  # the other texts don't go to Python
    return (joined.withColumn("_new", apply_bitmap(texts, F.col("_bitmap")))
            .withColumn("n_lines", count_newlines("text") + 1)
            .withColumn("n_dropped", F.col("_new.n_dropped"))
            .withColumn("text", F.when(F.col("_bitmap").isNull(), F.col("text")).otherwise(F.col("_new.kept")))
            .select(*names, "n_lines", "n_dropped"))
