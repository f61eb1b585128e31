import zlib
from collections import defaultdict

from quarry.llm import sharding
from quarry.llm.common import shared_path
from tests.llm.util import edge_rows


def test_law_places_and_versions(spark, edge_docs):
    path = shared_path(spark, "slots")
    got = sharding.shard_records(edge_docs, 3, path, slots=64).collect()
    rows = edge_rows()
    assert sorted((r["size"], r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in rows)
    places, loads = defaultdict(list), defaultdict(int)
    for r in got:
        places[r.shard].append(r.slot)
        loads[r.shard] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    assert max(loads.values()) - min(loads.values()) <= max(x.bytes for x in sharding.load_map(spark, path, 1).collect())
    assert all(r.next_shard in (r.shard, 3) for r in got)  # a move only leads into the new shard
    assert sorted(v for (v,) in spark.read.parquet(path).select("version").distinct().collect()) == [1, 2]


def test_near_equal_on_a_table(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    got = sharding.shard_records(docs, 8, shared_path(spark, "slots")).groupBy("shard").sum("size").collect()
    sizes = [r[1] for r in got]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= docs.selectExpr("max(octet_length(text) + 1)").first()[0]


def test_empty_table(spark, no_docs):
    path = shared_path(spark, "slots")
    assert sharding.shard_records(no_docs, 4, path, slots=16).collect() == []
    assert sharding.load_map(spark, path, 1).count() == 16


def greedy(rows, shards):
    """Shard, place and next shard of (doc_id, size, crc, slot) rows by plain loops."""
    held = defaultdict(list)
    for r in rows:
        held[r[3]].append(r)
    sizes = {s: sum(r[1] for r in rs) for s, rs in held.items()}
    loads, chosen = [0] * shards, {}
    for s in sorted(sizes, key=lambda s: (-sizes[s], s)):
        chosen[s] = min(range(shards), key=lambda k: (loads[k], k))
        loads[chosen[s]] += sizes[s]
    share, grown = sum(loads) // (shards * (shards + 1)), dict(chosen)
    for k in range(shards):
        given = 0
        for s in sorted((s for s in chosen if chosen[s] == k), key=lambda s: (sizes[s], s)):
            given += sizes[s]
            if given <= share:
                grown[s] = shards
    out, used = [], [0] * shards
    for s in sorted(held):
        for r in sorted(held[s], key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1])):
            out.append((*r, chosen[s], used[chosen[s]], grown[s]))
            used[chosen[s]] += 1
    return out


def test_same_as_plain_greedy_placement(spark, edge_docs, small_dir):
    for docs, shards, slots in ((edge_docs, 3, 64), (spark.read.parquet(f"{small_dir}/documents.parquet"), 8, 64), (edge_docs, 5, 4)):
        got = [(r.doc_id, r["size"], r.text_crc32, r.vslot, r.shard, r.slot, r.next_shard)
               for r in sharding.shard_records(docs, shards, shared_path(spark, "slots"), slots=slots).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, greedy([g[:4] for g in got], shards)))
