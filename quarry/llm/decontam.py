"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a seed, a run of ``MIN_MATCH`` words, are tiled:
the longest match between words that no tile covers yet becomes a tile, again and again, until
no match of ``MIN_MATCH`` words is left. Matches of a length are found by running Karp-Rabin
hashes over the places that the seeds allow. A document is contaminated by an item if tiles
cover at least ``PERCENT`` in 100 of the item's words, in whatever order they come.

The items are dealt into blocks of at most ``BLOCK_BYTES`` of text; a block goes to all tasks,
and there is one pass over the documents for each block. Documents are never shuffled.

Words are runs of characters other than space and \\x09-\\x0D, A-Z lower-cased. Seeds are looked
up in sections of ``SECTION`` words; the tiling is one over the whole text, which keeps only the
words that shared seeds cover: the longest match goes first wherever it is, and a word of the
item is covered once.

Defined results: null and empty texts, and items of fewer than ``MIN_MATCH`` words, contaminate
nothing; ties go to the first place in the document, then in the item; rows that repeat an id
or have none are judged each by its own text; repeated items are judged each; an empty table on
either side gives no rows. Only doc_id, text and item_id, text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_rows, slices
from quarry.llm.shingles import WIDTH, shingle_hashes, word_hashes

MIN_MATCH, PERCENT = WIDTH, 75
BLOCK_BYTES = 16_000_000
SECTION = 100_000
_ROLL = np.uint64(0x9E3779B97F4A7C15)
_PAIRS = "doc_id long, version long, item_id long, n_words long, n_covered long, n_tiles long"


def running_hash(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and powers with which the hash of any window takes one step."""
    powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(ids), _ROLL)]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * powers[:-1])])
    return sums, powers


def windows(hashes: tuple[np.ndarray, np.ndarray], at: np.ndarray, size: int, shift: np.ndarray) -> np.ndarray:
    """Karp-Rabin hashes of the windows of ``size`` words that start at ``at``, brought to one power by ``shift``."""
    sums, _ = hashes
    return (sums[at + size] - sums[at]) * shift


def tiles(text: np.ndarray, item: np.ndarray, seeds: tuple[np.ndarray, np.ndarray], free: np.ndarray) -> list[tuple[int, int, int]]:
    """Tiles (place in text, place in item, length), longest first. ``seeds`` holds the places of shared
    runs of MIN_MATCH words; ``free`` marks the item's words that may still be covered, and is updated."""
    t, p = seeds
    order = np.lexsort((t, t - p))
    t, p = t[order], p[order]
    open_text = np.ones(len(text), bool)
    th, ph = running_hash(text), running_hash(item)
    top = max(len(text), len(item))
    powers = th[1] if len(text) >= len(item) else ph[1]
    out = []
    while len(t):
        # seeds with all words free on both sides; runs of them on a diagonal are the longest matches
        used_t, used_p = np.concatenate([[0], np.cumsum(~open_text)]), np.concatenate([[0], np.cumsum(~free)])
        ok = (used_t[t + MIN_MATCH] == used_t[t]) & (used_p[p + MIN_MATCH] == used_p[p])
        t, p = t[ok], p[ok]
        if not len(t):
            break
        new = np.flatnonzero(np.concatenate([[True], (np.diff(t) != 1) | (np.diff(t - p) != 0)]))
        length = np.diff(np.concatenate([new, [len(t)]])) + MIN_MATCH - 1
        size = int(length.max())
        a, b = t[new][length == size], p[new][length == size]
        same = windows(th, a, size, powers[top - a]) == windows(ph, b, size, powers[top - b])
        placed = False
        for x, y in sorted(zip(a[same].tolist(), b[same].tolist())):
            if open_text[x: x + size].all() and free[y: y + size].all():
                open_text[x: x + size], free[y: y + size], placed = False, False, True
                out.append((x, y, size))
        if not placed:
            break
    return out


def shared_words(words: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words that the seeds at ``t`` cover, in order and without those between, and where the seeds are
    in them. Seeds on both sides of a gap are MIN_MATCH words apart there, so no match spans it."""
    starts = np.unique(t)
    places = np.unique((starts[:, None] + np.arange(MIN_MATCH)).ravel())
    return words[places], np.searchsorted(places, t)


class Items:
    """A block of items: their word hashes, and an index of all their seeds."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids = [r[0] for r in rows]
        self.words = [word_hashes(r[1]) for r in rows]
        long = [k for k, w in enumerate(self.words) if len(w) >= MIN_MATCH]
        found = [shingle_hashes(self.words[k]) for k in long]
        seed = np.concatenate([np.empty(0, np.uint64), *found])
        order = np.argsort(seed, kind="stable")
        self.seed = seed[order]
        self.item = np.concatenate([np.empty(0, np.int64), *(np.full(len(f), k) for k, f in zip(long, found))])[order]
        self.place = np.concatenate([np.empty(0, np.int64), *(np.arange(len(f)) for f in found)])[order]

    def seeds(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place in text, item, place in item) of the shared seeds, looked up a section at a time."""
        for at in range(0, len(words) - MIN_MATCH + 1, SECTION):
            seeds = shingle_hashes(words[at: at + SECTION + MIN_MATCH - 1])
            lo = np.searchsorted(self.seed, seeds, "left")
            hit = np.flatnonzero(self.seed[np.minimum(lo, len(self.seed) - 1)] == seeds)
            if not len(hit):
                continue
            lo, hi = lo[hit], np.searchsorted(self.seed, seeds[hit], "right")
            n = hi - lo
            entry = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            yield np.repeat(hit + at, n), self.item[entry], self.place[entry]

    def matches(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, covered words, tiles) of each item that shares a seed with the text."""
        found = list(self.seeds(words))
        if not found:
            return
        t, item, p = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(item, kind="stable")
        t, item, p = t[order], item[order], p[order]
        for mine in np.split(np.arange(len(t)), np.flatnonzero(np.diff(item)) + 1):
            k = int(item[mine[0]])
            part, at = shared_words(words, t[mine])
            free = np.ones(len(self.words[k]), bool)
            n = len(tiles(part, self.words[k], (at, p[mine]), free))
            yield k, int((~free).sum()), n


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """The items in blocks of about ``block_bytes`` of text, one block on the driver at a time."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-total // block_bytes)
    for k in range(blocks):
        rows = [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()]
        block = Items(rows)
        if len(block.seed):
            yield block


def overlaps(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, version, item_id, n_words, n_covered, n_tiles) of every document and item with a shared
    seed; n_words counts the item's words, version tells rows of one id with different texts apart."""
    schema = pa.schema([(f.split()[0], pa.int64()) for f in _PAIRS.split(", ")])
    columns = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), "text")
    out = docs.sparkSession.createDataFrame([], _PAIRS)
    for block in item_blocks(benchmark, block_bytes):
        held = docs.sparkSession.sparkContext.broadcast(block)  # at most block_bytes of text

        def rows(batch: pa.RecordBatch, held=held) -> Iterator[tuple]:
            items = held.value
            for part in slices(batch, 2):
                for doc, version, text in zip(*(c.to_pylist() for c in part.columns)):
                    for k, covered, n in items.matches(word_hashes(text)):
                        yield doc, version, items.ids[k], len(items.words[k]), covered, n

        out = out.unionByName(columns.mapInArrow(lambda batches, rows=rows: arrow_rows(batches, schema, rows), _PAIRS))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The overlaps that cover at least ``percent`` in 100 of an item's words."""
    return overlaps(docs, benchmark).where(F.col("n_covered") * 100 >= F.col("n_words") * percent)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the contaminated ones."""
    gone = contaminated(docs, benchmark, percent).select(F.col("doc_id").alias("_doc"), F.col("version").alias("_version")).distinct()
    return docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_version")), "left_anti")
