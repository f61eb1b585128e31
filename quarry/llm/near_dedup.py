"""Near-duplicate documents by MinHash with tensored banding.

Each distinct shingle set gets two small collections of sub-keys, ``SIDE`` each, and a
sub-key joins ``PER_KEY`` minhashes. A table key is a pair of sub-keys, one from each
collection: SIDE * SIDE tables from 2 * SIDE * PER_KEY minhashes, about the square root of
what separate tables would need. Two sets of similarity s meet in some table with a chance of
(1 - (1 - s**PER_KEY)**SIDE)**2, 0.9995 at 0.75 and higher above. Every link is then confirmed
on the full shingle sets.

No bucket is expanded into all its pairs. Equal sets are one class before any table is built.
Within a bucket each member is compared with one centre, twice with different centres; the
members of buckets that still hold several components after that go through an exact join on
their rarest shingles, so no link between components is lost. Links, components and sets stay
in tables.

Defined results: null, empty and blank texts have no shingles and are linked with nothing; a
null id is linked with nothing, has no component and is kept; rows that repeat an id are one
document (with different texts: the one with the smallest set hash) and give one row, or stay
and go together; an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import arrow_rows, materialise, slices
from quarry.llm.shingles import mix, shingle_set, similar

SIDE, PER_KEY, PERCENT = 10, 2, 75
STAR_ROUNDS = 2
_CHUNK = 4096
_SIGNATURE = "doc_id long, n_shingles long, sig binary, a array<long>, b array<long>"
_LONG, _LONGS = pa.int64(), pa.list_(pa.int64())


@cache
def _functions(side: int, per_key: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(75)
    draw = lambda: rng.integers(0, 2**64, size=2 * side * per_key, dtype=np.uint64)
    return draw()[:, None], draw()[:, None] | np.uint64(1)


def sub_keys(shingles: np.ndarray, side: int = SIDE, per_key: int = PER_KEY) -> tuple[list[int], list[int]]:
    """The two collections of sub-keys of a non-empty set."""
    xor, times = _functions(side, per_key)
    least = None
    for at in range(0, len(shingles), _CHUNK):
        part = ((shingles[None, at: at + _CHUNK] ^ xor) * times).min(axis=1)
        least = part if least is None else np.minimum(least, part)
    least = least.reshape(2 * side, per_key)
    keys = np.arange(1, 2 * side + 1, dtype=np.uint64)
    for k in range(per_key):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + least[:, k])
    keys = keys.view(np.int64).tolist()
    return keys[:side], keys[side:]


def _set_hash(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _signature_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    for part in slices(batch, 1):
        for doc, text in zip(*(c.to_pylist() for c in part.columns)):
            found = shingle_set(text)
            if len(found):
                yield (doc, len(found), _set_hash(found), *sub_keys(found))
            else:
                yield doc, 0, None, None, None


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, sig, a, b): the set's 128-bit hash and its two collections of sub-keys."""
    schema = pa.schema([("doc_id", _LONG), ("n_shingles", _LONG), ("sig", pa.binary()), ("a", _LONGS), ("b", _LONGS)])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(lambda batches: arrow_rows(batches, schema, _signature_rows, 2000), _SIGNATURE))


def buckets(classes: DataFrame) -> DataFrame:
    """(key, rep) of all table keys that two classes or more share. ``classes`` has rep, a and b."""
    keys = F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.xxhash64(x, y))))
    rows = classes.select("rep", F.explode(keys).alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return rows.join(shared, "key").select("key", "rep")


def _set_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    for part in slices(batch, 1):
        for doc, text, sig in zip(*(c.to_pylist() for c in part.columns)):
            found = shingle_set(text)
            if _set_hash(found) == sig:  # else another text under a repeated id
                yield doc, found.tobytes()


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, members): the full sets, as bytes, of the documents in ``wanted`` (rep, sig)."""
    schema = pa.schema([("rep", _LONG), ("members", pa.binary())])
    return (docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(wanted, "rep").select("rep", "text", "sig")
            .mapInArrow(lambda batches: arrow_rows(batches, schema, _set_rows, 500), "rep long, members binary").dropDuplicates(["rep"]))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (x, y) whose full sets are similar."""
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            xs, ys, mx, my = batch.columns
            keep = []
            for k in range(batch.num_rows):
                raw = mx[k].as_buffer()
                if last != (x := xs[k].as_py()):
                    last, left = x, np.frombuffer(raw, np.uint64).copy()
                keep.append(similar(left, np.frombuffer(my[k].as_buffer(), np.uint64), percent))
            yield pa.RecordBatch.from_arrays([xs, ys], ["x", "y"]).filter(pa.array(keep, pa.bool_()))

    # similar sets differ by a quarter in size at most, which spares carrying most unlike ones
    size = lambda c: F.octet_length(F.col(c))
    sized = (100 * F.least(size("mx"), size("my")) >= percent * F.greatest(size("mx"), size("my")))
    left, right = sets.select(F.col("rep").alias("x"), F.col("members").alias("mx")), sets.select(F.col("rep").alias("y"), F.col("members").alias("my"))
    return (pairs.join(right, "y").join(left, "x").where(sized).select("x", "y", "mx", "my").mapInArrow(test, "x long, y long"))


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(rep, comp) of all linked nodes, comp the smallest node that can be reached. Each pass takes the
    least label among the neighbours, then the label of the label; passes go on until none changes."""
    both = materialise(links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    state = both.groupBy("x").agg(F.min("y").alias("low")).select(F.col("x").alias("rep"), F.least("x", "low").alias("comp"))
    if labels is not None:
        known = labels.select("rep", F.col("comp").alias("known"))
        state = state.join(known, "rep", "left").select("rep", F.least("comp", F.coalesce("known", "comp")).alias("comp"))
    state = materialise(state, "labels")
    while True:
        near = (both.join(state.select(F.col("rep").alias("y"), "comp"), "y").groupBy("x").agg(F.min("comp").alias("low")))
        step = state.join(near.withColumnRenamed("x", "rep"), "rep").select("rep", F.col("comp").alias("was"), F.least("comp", "low").alias("comp"))
        top = step.select(F.col("rep").alias("comp"), F.col("comp").alias("up"))
        new = materialise(step.join(top, "comp", "left").select("rep", "was", F.least("comp", F.coalesce("up", "comp")).alias("comp")), "labels")
        state = new.select("rep", "comp")
        if new.where("was <> comp").isEmpty():
            return state


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of the buckets that still hold more than one component, with their label."""
    if labels is None:
        return members.withColumn("label", F.col("rep"))
    known = members.join(labels.withColumnRenamed("comp", "label"), "rep", "left").select("key", "rep", "degree", F.coalesce("label", "rep").alias("label"))
    mixed = known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    return known.join(mixed, "key")


def star_pairs(members: DataFrame, turn: int) -> DataFrame:
    """Each member of a bucket with the bucket's centre, if their labels differ. The centre is the member
    that is in most buckets at first, later another one by a hash."""
    order = -F.col("degree") if turn == 0 else F.xxhash64("rep", F.lit(turn))
    centres = members.groupBy("key").agg(F.min(F.struct(order.alias("o"), "rep", "label")).alias("c")).select("key", F.col("c.rep").alias("centre"), F.col("c.label").alias("theirs"))
    return (members.join(centres, "key").where("label <> theirs")
            .select(F.least("rep", "centre").alias("x"), F.greatest("rep", "centre").alias("y")).distinct())


def _token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            rep, label, members = (c[k].as_py() for c in batch.columns)
            n = len(members) // 8
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, v, np.int64)) for v in (rep, label, n)] + [pa.array(np.frombuffer(members, np.int64))],
                                             ["rep", "label", "n", "token"])


def rest_pairs(members: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All pairs of ``members`` with different labels that can be similar still: an exact join on the
    rarest shingles. With every set ordered from the rarest to the commonest shingle, a similar
    pair has a first common shingle after which enough is left on both sides. Members differ from
    their bucket's centre in rare shingles mostly, so this leaves few pairs where the bucket has all."""
    tokens = (members.select("rep", "label").distinct().join(sets, "rep").select("rep", "label", "members")
              .mapInArrow(_token_batches, "rep long, label long, n long, token long"))
    held = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("holders"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    place = F.row_number().over(Window.partitionBy("rep").orderBy("holders", "token")) - 1
    early = (tokens.join(held, "token").withColumn("place", place)
             .where((F.col("place") * 100 <= F.col("n") * (100 - percent)) & (F.col("lo") != F.col("hi"))))
    early = materialise(early.select("token", "rep", "label", "n", "place"), "rarest")
    left, right = (early.select("token", *(F.col(c).alias(f"{c}_{side}") for c in ("rep", "label", "n", "place"))) for side in "xy")
    room = F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y")) * (100 + percent) >= (F.col("n_x") + F.col("n_y")) * percent
    joined = left.join(right, (left["token"] == right["token"]) & (F.col("rep_x") < F.col("rep_y")) & (F.col("label_x") != F.col("label_y")) & room)
    return joined.select(F.col("rep_x").alias("x"), F.col("rep_y").alias("y")).distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document."""
    rows = materialise(signatures(docs), "signatures")
    named = (rows.where("doc_id is not null and sig is not null").groupBy("doc_id").agg(F.min(F.struct("sig", "n_shingles", "a", "b")).alias("s"))
             .select("doc_id", "s.*"))
    classes = materialise(named.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.first("a").alias("a"), F.first("b").alias("b")), "classes")
    degree = F.count(F.lit(1)).over(Window.partitionBy("rep"))  # SIDE * SIDE at most
    members = materialise(buckets(classes).withColumn("degree", degree), "buckets")
    sets = materialise(shingle_sets(docs, members.select("rep").distinct().join(classes.select("rep", "sig"), "rep")), "sets")
    labels, links = None, None
    for turn in range(STAR_ROUNDS + 1):
        mixed = materialise(_labelled(members, labels), "mixed")
        if mixed.isEmpty():
            break
        pairs = star_pairs(mixed, turn) if turn < STAR_ROUNDS else rest_pairs(mixed, sets, percent)
        found = materialise(confirm(pairs, sets, percent), "links-found")
        links = found if links is None else links.unionByName(found)
        labels = components(links, labels)
    ids = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("sig", "n_shingles")).alias("s")).select("doc_id", "s.*")
    if labels is not None:
        classes = classes.join(labels, "rep", "left")
        top = classes.select("sig", F.coalesce("comp", "rep").alias("component_id"))
    else:
        top = classes.select("sig", F.col("rep").alias("component_id"))
    out = ids.join(top, "sig", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    return out.unionByName(rows.where("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one with the smallest id."""
    gone = near_duplicates(docs, percent).where("not kept").select("doc_id")
    return docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")
