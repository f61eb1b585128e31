import hashlib
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quarry.llm import centroid_clusters as C

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string, inertia string"


def lloyd(rows, k, rounds, seed="3"):
    """Plain Python over whole integers: (vec_id, cluster, distance) per row and the centroids."""
    kept = [(i, [math.floor(Fraction(x) * 1024) for x in v]) for i, v in rows]
    order = sorted(range(len(kept)), key=lambda n: (hashlib.sha256(f"{seed}:{'' if kept[n][0] is None else kept[n][0]}".encode()).hexdigest(), rows[n][1]))
    centres = [kept[n][1] for n in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(col) // len(groups[j]) for col in zip(*groups[j])] if j in groups else c for j, c in enumerate(centres)]
    return [(i, *reversed(nearest(v))) for i, v in kept], centres


def check(spark, rows, dimensions, k, rounds):
    good = [(i, v) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    df = spark.createDataFrame([(i, v, "c", "d", "i") for i, v in rows], SCHEMA).repartition(3)
    got = C.cluster_vectors(df, k=k, rounds=rounds, dimensions=dimensions).collect()
    want, centres = lloyd(good, k, rounds)
    fits = lambda d: d if d < 2**63 else None
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=key) == sorted(((i, c, fits(d)) for i, c, d in want), key=key)
    for r in got:
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()
        assert r.cluster_inertia == fits(sum(d for _, c, d in want if c == r.cluster)) and r.inertia == fits(sum(d for _, _, d in want))
    return got


def test_brute_force_with_left_out_rows_ties_and_copies(spark):
    rng = random.Random(11)
    rows = [(n, [rng.gauss(rng.choice([-1, 0, 1]), 0.2) for _ in range(5)]) for n in range(120)]
    rows += [(500 + n, rows[0][1]) for n in range(90)]  # one vector many times
    rows += [(7, rows[9][1]), (None, rows[3][1]), (900, None), (901, []), (902, [1.0] * 4), (903, [1.0, None, 1.0, 1.0, 1.0]),
             (904, [float("nan")] + [0.0] * 4), (905, [float("-inf")] + [0.0] * 4), (906, [0.5] * 5), (907, [-0.5] * 5)]
    check(spark, rows, 5, 4, 5)


def test_dimensions_over_several_shards_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(C, "TILE", 16)
    monkeypatch.setattr(C, "BLOCK", 3)
    rng = random.Random(5)
    check(spark, [(n, [rng.uniform(-1, 1) for _ in range(8)]) for n in range(100)], 8, 3, 4)


def test_components_beyond_64_bits_stay_exact(spark):
    rng = random.Random(2)
    rows = [(n, [rng.uniform(-1, 1) * 10 ** rng.choice([0, 3, 9, 40, 300]) for _ in range(4)]) for n in range(40)]
    assert any(r.distance is None for r in check(spark, rows, 4, 3, 3))


def test_fewer_vectors_than_clusters_and_none(spark):
    assert {r.cluster for r in check(spark, [(1, [0.0, 1.0]), (2, [5.0, 1.0])], 2, 8, 2)} == {0, 1}
    empty = C.cluster_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert empty.collect() == [] and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_blocks_stay_where_they_are(spark, small_dir):
    """Assignments go back to partitioned blocks without dealing the blocks out again."""
    vectors = spark.read.parquet(f"{small_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    shards = C.Shards(C.cut_tiles(vectors), 64)
    back = shards.data.mapValues(lambda x: x[:, 0]).partitionBy(shards.parts, C.place)
    both = shards.data.union(back)
    assert both.getNumPartitions() == shards.parts and both.groupByKey(shards.parts, C.place).partitioner == shards.data.partitioner


def test_only_known_id_types(spark):
    out = C.cluster_vectors(spark.createDataFrame([("a", [0.0, 1.0])], "vec_id string, embedding array<double>"), dimensions=2).collect()
    assert [(r.vec_id, r.cluster, r.distance) for r in out] == [("a", 0, 0)]
    with pytest.raises(KeyError):
        C.cluster_vectors(spark.createDataFrame([(1.5, [0.0, 1.0])], "vec_id double, embedding array<double>"), dimensions=2)


def test_many_blocks_go_by_way_of_the_tile(spark, monkeypatch):
    monkeypatch.setattr(C, "TILE", 16)
    monkeypatch.setattr(C, "BLOCK", 2)
    rng = random.Random(6)
    check(spark, [(n, [rng.uniform(-1, 1) for _ in range(8)]) for n in range(60)], 8, 3, 2)


def test_a_round_has_one_shuffle(spark, small_dir):
    vectors = spark.read.parquet(f"{small_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    shards = C.Shards(C.cut_tiles(vectors), 64)
    centroids = C.first_centroids(vectors, 8, "3")
    shards.data.count()
    sc = spark.sparkContext
    sc.setJobGroup("one-round", "")
    try:
        shards.updated(centroids)
    finally:
        sc._jsc.clearJobGroup()
    jobs = sc.statusTracker().getJobIdsForGroup("one-round")
    stages = [s for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds]
    assert len(jobs) == 1 and len(stages) == 3  # dealing (skipped), partial distances, sums
