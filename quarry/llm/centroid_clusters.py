"""Centroid clustering by Lloyd rounds that are sharded over the dimensions.

The vectors are cut into tiles of a fixed number of rows, and each tile into blocks of
``BLOCK`` columns. A block's step uses the centroids' slice of its own columns only. In a
round it computes the exact partial distances of its rows to these slices. With up to ``DIRECT``
blocks in a tile these go to the tile's other blocks, each of which adds all and takes the argmin;
with more, ``reduceByKey`` adds them and the tile's assignment goes back to the blocks. Each shard
then sums its own columns by cluster; the sums of a slice's partitions give the new slice. Blocks are
dealt out once and stay where they are; between tasks go partial distances and assignments, to the
driver k x ``BLOCK`` sums for each partition, never vectors. The driver holds the k centroids and nothing else.

A component x counts as the integer floor(1024 * x), x as double. All arithmetic is on these
integers and exact: 64-bit where no result can pass 63 bits, Python's own integers elsewhere.

Tiles are written to the shared folder before the first round, so a lost executor's blocks are
read again from there. Rows are dealt by place, so equal vectors make no task larger.

Defined results: vectors that are null, of another length, or with a null or non-finite
component are left out; ties go to the cluster of smaller number; rows that repeat an id or a
vector are clustered row by row; a null id counts as an empty one in the choice of first
centroids, where equal hashes are told apart by the components; with fewer than k vectors there
are as many clusters; an empty cluster keeps its centroid; a distance or inertia of more than 63
bits is null; an empty table gives no rows. Only the id and the vector are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce
from math import floor, isqrt

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise

DIMENSIONS, K, ROUNDS, SEED = 64, 8, 10, "3"
SCALE = 1024
TILE, BLOCK = 2048, 32
PARTITION_BYTES = 32_000_000
DIRECT = 3  # blocks of a tile that exchange partial distances with one another, one shuffle a round; a speed bound only
#: integers of this size at most are summed as 64-bit ones: a squared difference has 56 bits, a block adds 5, a tile's column 11
SAFE = 2**27
MOST = 2**63 - 1


def scaled(x: np.ndarray) -> np.ndarray:
    """floor(1024 * x), as the narrowest of 16, 32 and 64-bit integers or Python's own that fits."""
    if not x.size:
        return x.astype(np.int16)
    top = np.abs(x).max()
    if top * SCALE >= SAFE:
        return np.array([floor(Fraction(v) * SCALE) for v in x.ravel().tolist()], dtype=object).reshape(x.shape)
    return np.floor(x * SCALE).astype(np.int16 if top * SCALE < 2**15 - 1 else np.int32)


def partial_distances(rows: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    """Squared distance of each row to each centroid over the given columns."""
    centres = np.array(centroids, dtype=object)
    if rows.dtype != object and np.abs(centres).max(initial=0) <= SAFE:
        rows, centres = rows.astype(np.int64), centres.astype(np.int64)
        out = np.stack([np.square(rows - c).sum(axis=1) for c in centres], axis=1)
        return out.astype(np.uint32) if out.max(initial=0) < 2**32 else out
    return np.stack([np.square(rows.astype(object) - c).sum(axis=1) for c in centres], axis=1)


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of two blocks' partial distances, wide enough."""
    wide = np.int64 if a.dtype != object and b.dtype != object and max(int(a.max(initial=0)), int(b.max(initial=0))) < 2**62 else object
    return a.astype(wide) + b.astype(wide)


def block_sums(rows: np.ndarray, assigned: np.ndarray, k: int) -> list[list[int]]:
    """Per cluster the columns' sums and, at the end, the number of rows."""
    wide = rows.astype(object if rows.dtype == object else np.int64)
    return [[*(int(v) for v in wide[assigned == c].sum(axis=0)), int((assigned == c).sum())] for c in range(k)]


def plus(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    return [[x + y for x, y in zip(p, q)] for p, q in zip(a, b)]


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, TILE):
            part = batch.slice(at, TILE)
            yield part.column(0).to_pylist(), np.array(part.column(1).flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(part.num_rows, -1)


def cut_tiles(vectors: DataFrame) -> DataFrame:
    """(tile, block, ids, cells) of (id, vec): the doubles of each tile's blocks, and the ids beside block 0."""
    kind = vectors.schema["id"].dataType.simpleString()
    schema = pa.schema([("tile", pa.int64()), ("block", pa.int32()), ("ids", pa.list_(_arrow(kind))), ("cells", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = TaskContext.get().partitionId() << 32
        for n, (ids, x) in enumerate(_tiles(batches)):
            blocks = [x[:, at: at + BLOCK] for at in range(0, x.shape[1], BLOCK)]
            yield pa.RecordBatch.from_arrays([
                pa.array([own + n] * len(blocks), pa.int64()), pa.array(range(len(blocks)), pa.int32()),
                pa.array([ids if b == 0 else None for b in range(len(blocks))], schema.field("ids").type),
                pa.array([np.ascontiguousarray(b).tobytes() for b in blocks], pa.binary())], schema=schema)

    return vectors.select("id", "vec").mapInArrow(cut, f"tile long, block int, ids array<{kind}>, cells binary")


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "string": pa.string()}[kind]


def place(key: tuple[int, int]) -> int:
    """Blocks of one column lie in the same partitions, if their number is a multiple of the columns' blocks."""
    tile, block = key
    return ((tile * 0x9E3779B97F4A7C15 >> 17) & 0xFFFFFFF) * (DIMENSIONS // BLOCK) + block


def first_centroids(vectors: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The k vectors of least sha256 of ``seed:id``, in that order."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(hashed.alias("h"), "vec").orderBy("h", "vec").limit(k).collect()  # k vectors
    return [scaled(np.array([r.vec], dtype=np.float64))[0].astype(object).tolist() for r in rows]


class Shards:
    """The blocks of all tiles, dealt out once, and the steps of a round over them."""

    def __init__(self, tiles: DataFrame, dimensions: int):
        self.blocks = -(-dimensions // BLOCK)
        n = tiles.where("block = 0").count()
        groups = max(1, min(n, -(-n * TILE * BLOCK * 8 // PARTITION_BYTES)))
        groups = max(groups, min(n, isqrt(tiles.sparkSession.sparkContext.defaultParallelism) + 1))
        self.parts = groups * self.blocks
        width = dimensions
        read = lambda r: ((r.tile, r.block), scaled(np.frombuffer(r.cells).reshape(-1, min(BLOCK, width - r.block * BLOCK))))
        self.data: RDD = (tiles.select("tile", "block", "cells").rdd.map(read)
                          .partitionBy(self.parts, place).persist(StorageLevel.MEMORY_AND_DISK))

    def slices(self, centroids: list[list[int]]) -> list[list[list[int]]]:
        return [[c[b * BLOCK: (b + 1) * BLOCK] for c in centroids] for b in range(self.blocks)]

    def distances(self, centroids: list[list[int]]) -> RDD:
        """(tile, its rows' distances to each centroid): the sum of the blocks' partial distances."""
        slices = self.slices(centroids)
        return (self.data.map(lambda kv: (kv[0][0], partial_distances(kv[1], slices[kv[0][1]])))
                .reduceByKey(add, max(1, self.parts // self.blocks)))

    def messages(self, centroids: list[list[int]]) -> RDD:
        """To each block of a tile: the others' partial distances, or the tile's assignment."""
        blocks, slices = range(self.blocks), self.slices(centroids)

        def to_others(kv: tuple) -> Iterator[tuple]:
            (tile, own), rows = kv
            found = partial_distances(rows, slices[own]) if len(blocks) > 1 else None
            return (((tile, b), (found,)) for b in blocks if b != own)

        if self.blocks <= DIRECT:
            return self.data.flatMap(to_others)
        nearest = self.distances(centroids).mapValues(lambda d: d.argmin(axis=1).astype(np.int32))
        return nearest.flatMap(lambda kv: (((kv[0], b), kv[1]) for b in blocks))

    def updated(self, centroids: list[list[int]]) -> list[list[int]]:
        """The centroids after one round."""
        blocks, k, slices = range(self.blocks), len(centroids), self.slices(centroids)
        both = self.data.union(self.messages(centroids).partitionBy(self.parts, place)).groupByKey(self.parts, place)

        def sums(groups: Iterator[tuple]) -> Iterator[tuple]:
            total: dict[int, list[list[int]]] = {}
            for (_, block), found in groups:
                found = list(found)
                rows = next(x for x in found if isinstance(x, np.ndarray) and x.ndim == 2)
                assigned = next((x for x in found if isinstance(x, np.ndarray) and x.ndim == 1), None)
                if assigned is None:
                    parts = [x[0] for x in found if isinstance(x, tuple)]
                    assigned = reduce(add, parts, partial_distances(rows, slices[block])).argmin(axis=1)
                one = block_sums(rows, assigned, k)
                total[block] = plus(total[block], one) if block in total else one
            return iter(total.items())

        new: dict[int, list[list[int]]] = {}
        for block, rows in both.mapPartitions(sums).collect():  # k x BLOCK numbers for each partition
            new[block] = plus(new[block], rows) if block in new else rows
        means = {b: [[s // r[-1] for s in r[:-1]] if r[-1] else None for r in rows] for b, rows in new.items()}
        return [[v for b in blocks for v in means[b][c]] if means[0][c] else centroids[c] for c in range(k)]


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, rounds: int = ROUNDS,
                    dimensions: int = DIMENSIONS, seed: str = SEED) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector kept."""
    spark = df.sparkSession
    fit = F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    vectors = (df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
               .where((F.size("vec") == dimensions) & fit))
    tiles = materialise(cut_tiles(vectors), "tiles")
    centroids = first_centroids(vectors, k, seed)
    shards = Shards(tiles, dimensions)
    for _ in range(rounds if centroids else 0):
        centroids = shards.updated(centroids)
    fits = lambda v: int(v) if v <= MOST else None

    def result(kv: tuple) -> tuple:
        tile, d = kv
        nearest = d.argmin(axis=1)
        least = d[np.arange(len(d)), nearest]
        return tile, nearest.tolist(), [fits(v) for v in least], [str(sum(int(v) for v in least[nearest == c])) for c in range(len(centroids))]

    rows = shards.distances(centroids).map(result) if centroids else spark.sparkContext.emptyRDD()
    done = materialise(spark.createDataFrame(rows, "tile long, cluster array<int>, distance array<long>, sums array<string>"), "clusters")
    shards.data.unpersist()
    totals = done.select("sums").rdd.map(lambda r: [int(v) for v in r.sums]).fold([0] * len(centroids), lambda a, b: [x + y for x, y in zip(a, b)])
    facts = spark.createDataFrame(
        [(c, fits(totals[c]), fits(sum(totals)), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    members = done.join(tiles.where("block = 0").select("tile", "ids"), "tile")
    rows = members.select(F.explode(F.arrays_zip("ids", "cluster", "distance")).alias("m"))
    return (rows.select(F.col("m.ids").alias(id_col), F.col("m.cluster").alias("cluster"), F.col("m.distance").alias("distance"))
            .join(F.broadcast(facts), "cluster")  # k rows
            .select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
