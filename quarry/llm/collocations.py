"""Phrase collocations by mergeable Misra-Gries summaries.

First pass: tasks count the n-grams of their texts chunk by chunk and send each count to the
partition that the n-gram's hash names. There the counts are merged into one Misra-Gries summary.
Its capacity exceeds twice the partition's mass (the occurrences sent there, known before the
first count is merged) divided by the threshold, so at most half a threshold is ever taken off a
count, and every n-gram of threshold occurrences or more is left with at least the rest. Memory is
bounded by the capacity, which is proportional to the mass; the number of partitions follows the
input, so a partition's mass does not grow with it. What survives is one bit for each hash prefix
in a filter of fixed size (``FILTER_BITS`` at most), the only thing that is broadcast.

Second pass: n-grams whose bit is set are counted exactly, by their words, and those below the
threshold go. A filter too full, or hashes that meet, let more n-grams through to the exact
count; neither changes a result. A frequent n-gram is counted in every chunk of every task before
the shuffle, so it sends a row a chunk at most and no task gets its occurrences.

Scores and the drop of phrases inside longer ones are joins and aggregations over the table of
frequent n-grams, in decimal arithmetic. Prefixes and rests of a frequent phrase are as frequent,
so each is in that table.

Defined results: null and empty texts have no words; a null lang is ``und``, together with the
rows whose lang is that string; rows that repeat count each time; ties in all three sort keys
cannot occur; an empty table gives no rows. Only text and lang are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialise, slices

LONGEST, THRESHOLD, FIRST = 5, 100, 2000
CHUNK_WORDS = 400_000
#: the most occurrences that a hash partition is meant to get, by an upper bound from the bytes of the texts
PARTITION_MASS = 2**24
FILTER_BITS = 2**29
PIECE_KEYS = 20_000  # counts in a row of the first shuffle

_MARK = b"\xff"  # in no UTF-8 text
_CUT = bytes(0xFF if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(29), np.uint64(32))


def tokens(text: str) -> list[bytes]:
    """Lower-cased words, with a mark in place of each separator."""
    return text.encode("utf-8", "surrogatepass").translate(_CUT).replace(_MARK, b" \xff ").split()


class Chunk:
    """The n-grams of some texts: for each length the distinct ones, with their counts and a place."""

    def __init__(self) -> None:
        self.number = defaultdict(count(1).__next__, {_MARK: 0})
        self.lang_number: defaultdict[str, int] = defaultdict(count().__next__)
        self.words: list[np.ndarray] = []
        self.langs: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str, lang: str) -> None:
        found = tokens(text)
        found.append(_MARK)  # phrases end with their text
        ids = np.fromiter(map(self.number.__getitem__, found), dtype=np.int32, count=len(found))
        self.words.append(ids)
        self.langs.append(np.full(len(ids), self.lang_number[lang], dtype=np.int32))
        self.size += len(ids)

    def close(self) -> None:
        self.ids, self.lang = np.concatenate(self.words), np.concatenate(self.langs)
        self.words = self.langs = []
        self.spelled = list(self.number)
        self.lang_names = list(self.lang_number)

    def lengths(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, place of one occurrence of each distinct n-gram, count). An n-gram is told apart by the rank of
        its first n - 1 words and its last word, a pair of 32-bit numbers; ranks are exact, not hashes."""
        at = np.flatnonzero(self.ids)  # occurrences still whole: no mark inside
        rank = self.lang[at].astype(np.uint64)
        for n in range(1, longest + 1):
            if not len(at):
                return
            last = self.ids[at + (n - 1)]
            whole = last != 0
            at, last, rank = at[whole], last[whole], rank[whole]
            if not len(at):
                return
            code = (rank << np.uint64(32)) | last.astype(np.uint64)
            order = np.argsort(code, kind="stable")
            code = code[order]
            new = np.empty(len(code), dtype=bool)
            new[0] = True
            np.not_equal(code[1:], code[:-1], out=new[1:])
            starts = np.flatnonzero(new)
            yield n, at[order[starts]], np.diff(starts, append=len(code))
            rank = np.empty(len(code), dtype=np.uint64)
            rank[order] = np.cumsum(new).astype(np.uint64)

    def hashes(self, n: int, places: np.ndarray) -> np.ndarray:
        """64-bit hashes of the n-grams at these places, of their words and lang."""
        if not hasattr(self, "_word_hash"):
            of = lambda items: np.fromiter(map(xxhash.xxh3_64_intdigest, items), dtype=np.uint64, count=len(items))
            self._word_hash, self._lang_hash = of(self.spelled), of(self.lang_names)
        h = self._lang_hash[self.lang[places]] + np.uint64(n)
        for k in range(n):
            h = (h ^ self._word_hash[self.ids[places + k]]) * _MIX[0]
            h ^= h >> _MIX[2]
        h *= _MIX[1]
        return h ^ (h >> _MIX[3])

    def phrase(self, n: int, place: int) -> bytes:
        return b" ".join([self.spelled[w] for w in self.ids[place: place + n].tolist()])


def chunks(batches: Iterator[pa.RecordBatch], words: int = CHUNK_WORDS) -> Iterator[Chunk]:
    """Chunks of (text, lang) rows; a text is never cut."""
    now = Chunk()
    for batch in batches:
        for part in slices(batch, 0):
            for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                now.add(text or "", "und" if lang is None else lang)
                if now.size >= words:
                    now.close()
                    yield now
                    now = Chunk()
    if now.size:
        now.close()
        yield now


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and counts as byte planes: steps between keys and most counts are small, so that the upper
    planes are runs of zeros that the shuffle's compression takes away."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    rest = counts.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return len(keys).to_bytes(4, "little") + np.ascontiguousarray(steps).tobytes() + np.ascontiguousarray(rest).tobytes()


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:4], "little")
    raw = np.frombuffer(blob, np.uint8, offset=4)
    steps = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view("<u8").ravel()
    counts = np.ascontiguousarray(raw[8 * n:].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


class Summary:
    """A Misra-Gries summary of at most ``capacity`` counters between merges; ``taken`` bounds what
    any count has lost, and is at most mass / (capacity + 1)."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.more = 0

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.more += len(keys)
        if self.more > self.capacity:  # so that the sorts cost a constant a key
            self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.more = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        keys = keys[starts]
        counts = np.add.reduceat(counts, starts) if len(starts) else counts
        if len(keys) > self.capacity:
            cut = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            counts = counts - cut
            self.taken += cut
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts


def frequent_keys(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, keys that may be frequent) from (part, mass, blob) rows that come sorted by part, the
    masses of a part before its counts."""
    part, mass, summary = None, 0, None

    def done() -> tuple[int, np.ndarray]:
        summary.settle()
        return part, summary.keys[summary.counts >= max(1, threshold - summary.taken)]

    for batch in batches:
        for k in range(batch.num_rows):  # one blob at a time in Python
            p, m, blob = (batch.column(c)[k].as_py() for c in range(3))
            if p != part:
                if summary is not None:
                    yield done()
                part, mass, summary = p, 0, None
            if blob is None:
                mass += m
                continue
            if summary is None:
                summary = Summary(2 * mass // threshold + 1)
            summary.merge(*unpack(blob))
    if summary is not None:
        yield done()


def _first_pass(texts: DataFrame, parts: int, bits: int, longest: int) -> DataFrame:
    schema = pa.schema([("part", pa.int32()), ("mass", pa.int64()), ("counts", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masses = np.zeros(parts, dtype=np.int64)
        for chunk in chunks(batches):
            keys, counts = [], []
            for n, places, times in chunk.lengths(longest):
                keys.append(chunk.hashes(n, places) >> np.uint64(64 - bits))
                counts.append(times)
            del chunk
            if not keys:
                continue
            keys, counts = np.concatenate(keys), np.concatenate(counts)
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            edges = np.searchsorted(keys >> np.uint64(bits - parts.bit_length() + 1), np.arange(parts + 1, dtype=np.uint64)).tolist()
            out = []
            for p, lo, hi in zip(range(parts), edges, edges[1:]):
                if hi > lo:
                    masses[p] += counts[lo:hi].sum()
                    out += [(p, None, pack(keys[a: min(a + PIECE_KEYS, hi)], counts[a: min(a + PIECE_KEYS, hi)])) for a in range(lo, hi, PIECE_KEYS)]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            del out, keys, counts
        own = np.flatnonzero(masses)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(masses[own]), pa.nulls(len(own), pa.binary())], schema=schema)

    return texts.mapInArrow(rows, "part int, mass long, counts binary")


def survivors(texts: DataFrame, threshold: int, longest: int) -> np.ndarray:
    """A filter of a power of two of bits: the bit of every n-gram of ``threshold`` occurrences is set."""
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    most = longest * (n_bytes // 2 + 1)  # n-grams, at two bytes a word
    parts = 1 << max(0, (most // PARTITION_MASS).bit_length())
    bits = max(32, most.bit_length() + 1)  # n-grams whose hashes meet only add up to more survivors
    width = min(FILTER_BITS, max(2**16, 1 << (16 * most // threshold).bit_length())).bit_length() - 1
    parts = min(parts, 1 << (width - 3))
    size = 1 << (width - parts.bit_length() + 1)  # bits of a partition's slice
    schema = pa.schema([("part", pa.int32()), ("slice", pa.binary())])

    def slices_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, keys in frequent_keys(batches, threshold):
            own = np.zeros(size, dtype=bool)
            own[(keys >> np.uint64(bits - width)).astype(np.int64) - part * size] = True
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(own).tobytes()], pa.binary())], schema=schema)

    dealt = (_first_pass(texts, parts, bits, longest).repartition(parts, "part")
             .sortWithinPartitions("part", F.col("counts").isNotNull()))
    found = np.zeros((parts, size // 8), dtype=np.uint8)
    for row in dealt.mapInArrow(slices_of, "part int, slice binary").collect():  # FILTER_BITS at most
        found[row.part] = np.frombuffer(row.slice, np.uint8)
    return found.ravel()


def frequent_ngrams(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """((lang, words, phrase, f) of every n-gram of 1 to ``longest`` words found ``threshold`` times or more
    in a lang, (lang, n) with the number of words of each lang)."""
    texts = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    kept = texts.sparkSession.sparkContext.broadcast(survivors(texts, threshold, longest).tobytes())
    schema = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.binary()), ("f", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(kept.value, np.uint8)
        width = np.uint64(64 - (len(bits) * 8).bit_length() + 1)
        for chunk in chunks(batches):
            names = np.array(chunk.lang_names, dtype=object)
            own = np.bincount(chunk.lang[chunk.ids != 0], minlength=len(names))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([0] * len(names), pa.int32()),
                                              pa.nulls(len(names), pa.binary()), pa.array(own, pa.int64())], schema=schema)
            for n, places, times in chunk.lengths(longest):
                at = (chunk.hashes(n, places) >> width).astype(np.int64)
                hit = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
                places, times = places[hit], times[hit]
                for a in range(0, len(places), 50_000):
                    some = places[a: a + 50_000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(names[chunk.lang[some]], pa.string()), pa.array(np.full(len(some), n, np.int32)),
                        pa.array([chunk.phrase(n, p) for p in some.tolist()], pa.binary()), pa.array(times[a: a + 50_000], pa.int64())], schema=schema)
            del chunk

    counted = (texts.mapInArrow(rows, "lang string, words int, phrase binary, f long")
               .groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where(f"words = 0 or f >= {int(threshold)}"))
    table = materialise(counted.withColumn("phrase", F.col("phrase").cast("string")), "ngrams")
    return table.where("words > 0"), table.where("words = 0").select("lang", F.col("f").alias("n"))


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, first: int = FIRST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each lang's ``first`` best phrases: 1000 * a * n / (l * r) at
    the cut where that is least, without phrases that stand inside a longer one as often as alone."""
    grams, totals = frequent_ngrams(docs, threshold, longest)
    longer = grams.where("words >= 2").withColumnRenamed("f", "a")
    part = lambda lo, size: F.array_join(F.slice(F.split("phrase", " "), lo, size), " ")
    inner = (longer.where("words >= 3")
             .withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
             .withColumn("lo", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
             .select("lang", part(F.col("lo"), F.col("size")).alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("most")))
    kept = longer.join(inner, ["lang", "phrase"], "left").where(F.coalesce(F.col("most") < F.col("a"), F.lit(True))).drop("most")
    cuts = (kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .withColumn("left", part(F.lit(1), F.col("k"))).withColumn("right", part(F.col("k") + 1, F.col("words") - F.col("k"))))
    freq = lambda name, f: grams.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    big = lambda c: F.col(c).cast("decimal(38,0)")
    scored = (cuts.join(freq("left", "l"), ["lang", "left"]).join(freq("right", "r"), ["lang", "right"])
              .join(F.broadcast(totals), "lang")  # a row for each lang
              .withColumn("above", big("a") * big("n") * F.lit(1000).cast("decimal(38,0)")).withColumn("below", big("l") * big("r"))
              .withColumn("score", F.expr("above div below")))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b")).select("lang", "phrase", "b.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= first)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
