"""Helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir


SLICE_BYTES = 2_000_000  # of text that is in Python at a time, or one longer text


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder that the session names in spark.checkpoint.dir."""
    return f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage, and what is
    written outlives any executor. Returns a frame over the written Parquet files."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_rows(batches: Iterator[pa.RecordBatch], schema: pa.Schema, rows: Callable[[pa.RecordBatch], Iterator[tuple]],
               per_batch: int = 5000) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``per_batch`` of the tuples that ``rows`` yields for each batch."""
    out: list[tuple] = []
    for batch in batches:
        for row in rows(batch):
            out.append(row)
            if len(out) >= per_batch:
                yield to_batch(out, schema)
                out = []
    if out:
        yield to_batch(out, schema)


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of at most ``limit`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at, total = 0, 0
    for k, n in enumerate(sizes.tolist()):
        if k > at and total + n > limit:
            yield batch.slice(at, k - at)
            at, total = k, 0
        total += n
    if batch.num_rows > at:
        yield batch.slice(at)


class Memo:
    """What a worker worked out lately, by key: two generations of at most half of ``limit`` entries each, or of one
    call's keys. When the young one is full it becomes the old one, and what is met again moves over, so that keys
    that come all the time stay and those met once go. A speed and memory bound only."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def missing(self, keys: set) -> set:
        """The keys without a value; those with one are in ``young`` afterwards."""
        new = keys.difference(self.young)
        if len(self.young) + len(new) > self.limit // 2:
            self.old, self.young, new = self.young, {}, keys
        return self._from_old(new)

    def values(self, keys: list, make: Callable[[list], list]) -> list:
        """The values of distinct keys; ``make`` gives those of the keys that have none. Each key is looked up once
        in each generation."""
        found = list(map(self.young.get, keys))
        new = [k for k, v in zip(keys, found) if v is None]
        aged = list(map(self.old.get, new))
        made = iter(make([k for k, v in zip(new, aged) if v is None]))
        aged = [next(made) if v is None else v for v in aged]
        rest = iter(aged)
        found = [next(rest) if v is None else v for v in found]
        if len(self.young) + len(new) > self.limit // 2:
            self.old, self.young = self.young, dict(zip(keys, found))
        else:
            self.young.update(zip(new, aged))
        return found

    def unknown(self, keys: set) -> set:
        """The same for more keys of the call: nothing goes."""
        return self._from_old(keys.difference(self.young))

    def _from_old(self, new: set) -> set:
        met = self.old.keys() & new
        self.young.update((k, self.old[k]) for k in met)
        return new - met


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def count_newlines(text: str) -> Column:
    """Number of \\n in a text column (null: none)."""
    return F.coalesce(F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit(""))), F.lit(0)).cast("long")
