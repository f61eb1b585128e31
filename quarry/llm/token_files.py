"""Token ids in compressed binary files of patched frame-of-reference blocks.

Spark range-partitions the documents by id and sorts each range, so the written parts, taken
in order, hold the documents in ascending id order. A part holds one record for each
document: its start in the part, id, number of ids, and a payload. A payload has blocks of 128
ids: an index entry for each block (where its data start, the block's minimum, bit width,
number of exceptions), then the data: the ids less the minimum, packed at the width that fits
90 in 100 of them, and a list of the exceptions, each with its place and whole value. A single
document, or a single block of one, can be read without the rest.

Parts and records are written by Spark's Parquet writer, so any store that Spark writes to will
do and a part only appears when its task has ended. A document's start in the whole stream is
its start in the part plus the sizes of the parts before, one number for each file.

Ids come from the tokenizers library: texts are cut at ASCII white space, which the tokenizer
drops, Arrow numbers the distinct pieces of some texts, cuts the marks from their ends and puts the ids together. Each piece without
those marks is encoded once, words of letters many in a row, and remembered by the worker up to a fixed number of pieces. The strings of special tokens (``<|endoftext|>``) in a text give their ids, as they
do in the library by default.

Defined results: a null or empty text has only the end id; null ids come first; rows that
repeat an id follow one another in the order of their texts' hashes; no rows give an empty folder that
reads as no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import Memo, arrow_rows, slices

BLOCK, PERCENTILE = 128, 90
END_ID = 1
PIECES_KEPT = 800_000  # memo entries of a worker, a speed bound only
TEXT_BYTES = 8_000_000  # of text whose pieces are numbered at a time, or one longer text
PACKED_IDS = 500_000  # of whole documents that are packed at a time, or a document's
_INDEX = np.dtype([("start", "<u4"), ("base", "<u4"), ("width", "u1"), ("exceptions", "u1")])
_PATCH = np.dtype([("place", "u1"), ("value", "<u4")])
_GROUP = 4096  # blocks packed at a time, bounds the memory for single bits
FILE_SCHEMA = "part int, start long, doc_id long, n_tokens long, payload binary"


# -- the codec -----------------------------------------------------------------------------

def _block_sizes(index: np.ndarray) -> np.ndarray:
    return index["width"].astype(np.int64) * (BLOCK // 8) + index["exceptions"].astype(np.int64) * _PATCH.itemsize


def _whole(width: int) -> str:
    """The type that values of so many bits are taken from and put into."""
    return "<u2" if width <= 16 else "<u4"


def pack(ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """The payloads of consecutive documents; ``ids`` holds their ids one after another."""
    blocks = -(-lengths // BLOCK)
    total = int(blocks.sum())
    if not total:
        return [b""] * len(lengths)
    first_block = np.cumsum(blocks) - blocks
    first_id = np.cumsum(lengths) - lengths
    flat = np.arange(len(ids)) + np.repeat(first_block * BLOCK - first_id, lengths)
    values = np.zeros(total * BLOCK, np.uint32)
    filled = np.zeros(total * BLOCK, bool)
    values[flat], filled[flat] = ids, True
    values, filled = values.reshape(total, BLOCK), filled.reshape(total, BLOCK)
    base = np.where(filled, values, np.uint32(0xFFFFFFFF)).min(axis=1)
    over = np.where(filled, values - base[:, None], 0).astype(np.uint32)
    at = BLOCK * PERCENTILE // 100
    width = np.ceil(np.log2(np.partition(over, at, axis=1)[:, at].astype(np.float64) + 1)).astype(np.uint8)
    patch = over >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    index = np.zeros(total, _INDEX)
    index["base"], index["width"], index["exceptions"] = base, width, patch.sum(axis=1)
    sizes = _block_sizes(index)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    data = np.zeros(int(ends[-1]), np.uint8)
    for w in np.unique(width[width > 0]).tolist():
        same = np.flatnonzero(width == w)
        for k in range(0, len(same), _GROUP):
            part = same[k: k + _GROUP]
            bits = np.unpackbits(over[part].astype(_whole(w)).view(np.uint8), axis=1, bitorder="little").reshape(len(part), BLOCK, -1)[:, :, :w]
            packed = np.packbits(bits.reshape(len(part), -1), axis=1, bitorder="little")
            data[starts[part][:, None] + np.arange(packed.shape[1])] = packed
    block, where = np.nonzero(patch)
    if len(block):
        patches = np.zeros(len(block), _PATCH)
        patches["place"], patches["value"] = where, over[block, where]
        nth = np.arange(len(block)) - np.searchsorted(block, block)
        to = starts[block] + width[block].astype(np.int64) * (BLOCK // 8) + nth * _PATCH.itemsize
        data[to[:, None] + np.arange(_PATCH.itemsize)] = patches.view(np.uint8).reshape(len(block), -1)
    index["start"] = starts - np.repeat(starts[np.minimum(first_block, total - 1)], blocks)
    raw, out = data.tobytes(), []
    for lo, n in zip(first_block.tolist(), blocks.tolist()):
        out.append(index[lo: lo + n].tobytes() + raw[starts[lo]: ends[lo + n - 1]] if n else b"")
    return out


def pack_all(ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """The same, a bounded number of ids at a time."""
    ends = np.cumsum(lengths)
    cuts = [0, *(np.flatnonzero(np.diff(ends // PACKED_IDS)) + 1).tolist(), len(lengths)]
    at = [0, *ends.tolist()]
    return [x for lo, hi in zip(cuts, cuts[1:]) for x in pack(ids[at[lo]: at[hi]], lengths[lo:hi])]


def unpack(payloads: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """The ids of all documents, one after another."""
    blocks = -(-lengths // BLOCK)
    if not blocks.sum():
        return np.empty(0, np.uint32)
    heads = blocks * _INDEX.itemsize
    index = np.frombuffer(b"".join(p[:h] for p, h in zip(payloads, heads.tolist())), _INDEX)
    data = np.frombuffer(b"".join(p[h:] for p, h in zip(payloads, heads.tolist())), np.uint8)
    data_sizes = np.array([len(p) for p in payloads]) - heads
    starts = index["start"].astype(np.int64) + np.repeat(np.cumsum(data_sizes) - data_sizes, blocks)
    width = index["width"].astype(np.int64)
    values = np.zeros((len(index), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        same = np.flatnonzero(width == w)
        for k in range(0, len(same), _GROUP):
            part = same[k: k + _GROUP]
            bits = np.unpackbits(data[starts[part][:, None] + np.arange(w * BLOCK // 8)], axis=1, bitorder="little")
            wide = np.zeros((len(part), BLOCK, 8 * np.dtype(_whole(w)).itemsize), np.uint8)
            wide[:, :, :w] = bits.reshape(len(part), BLOCK, w)
            values[part] = np.packbits(wide.reshape(len(part), -1), axis=1, bitorder="little").view(_whole(w))
    count = index["exceptions"].astype(np.int64)
    block = np.repeat(np.arange(len(index)), count)
    if len(block):
        nth = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
        at = starts[block] + width[block] * (BLOCK // 8) + nth * _PATCH.itemsize
        patches = data[at[:, None] + np.arange(_PATCH.itemsize)].reshape(-1).view(_PATCH)
        values[block, patches["place"]] = patches["value"]
    values += index["base"][:, None]
    last = np.cumsum(blocks) - 1
    filled = np.full(len(index), BLOCK)
    some = blocks > 0
    filled[last[some]] = (lengths - (blocks - 1) * BLOCK)[some]
    return values[np.arange(BLOCK) < filled[:, None]]


# -- the tokenizer -------------------------------------------------------------------------

@cache
def _tokenizer(path: str):
    """(tokenizer that takes special tokens' strings for ordinary text, pattern of those strings, their ids)."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker for each core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    special = {a.content: np.array([k], "<u4").tobytes() for k, a in t.get_added_tokens_decoder().items()}
    t.encode_special_tokens = True
    found = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or "(?!)")
    return t, found, special


@cache
def _word_ends(path: str) -> np.ndarray:
    """Of each id, whether its token ends a word; empty if the tokenizer has no such tokens."""
    with open(path, encoding="utf-8") as f:
        suffix = json.load(f)["model"].get("end_of_word_suffix")
    vocabulary = _tokenizer(path)[0].get_vocab()
    out = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
    out[[k for token, k in vocabulary.items() if suffix and token.endswith(suffix)]] = True
    return out if out.any() else out[:0]


_memo: dict[str, Memo] = {}
_ROW = 200  # pieces that go to the tokenizer in a row


_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII marks but the apostrophe, which starts words of letters
_WORD_END = "[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]$"


def _parts(pieces: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """Pieces without the marks at their ends, and those marks. Behind an ASCII or Latin-1 letter or a digit these
    are a word of their own for the tokenizer; elsewhere nothing is cut."""
    column = pa.array(pieces, pa.large_string())
    heads = pc.ascii_rtrim(column, _MARKS)
    heads = pc.if_else(pc.match_substring_regex(heads, _WORD_END), heads, column)
    return heads, pa.array([w[n:] for w, n in zip(pieces, pc.binary_length(heads).to_numpy().tolist())], pa.large_string())


def _lowered(text: str) -> bytes:
    """UTF-8, ASCII lower-cased before the look-up where that changes nothing. The tokenizer composes marks first, and
    some have a small letter only: if the text is composed, before and after, no piece has one; else only those
    pieces of ASCII alone are lower-cased."""
    raw = text.encode("utf-8", "surrogatepass")
    if not text.isascii() and (text := raw.decode("utf-8", "replace")).encode() != raw:
        raw = text.encode()
    low = raw.lower()
    if text.isascii() or all(unicodedata.is_normalized("NFC", x) for x in (text, low.decode())):
        return low
    return b" ".join([w.lower() if w.isascii() else w for w in raw.split()])


def _pieces(text: str) -> list[bytes]:
    """Pieces between ASCII white space."""
    return _lowered(text).split()


def _cut(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct pieces of many texts, the number of each piece among them, and how many pieces end with each
    text. Arrow splits and numbers them, so that Python sees each distinct piece once; white space at a text's edge
    gives an empty piece, which has no ids."""
    ends = np.cumsum([0, *map(len, texts)], dtype=np.int64)
    column = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(texts))])
    words = pc.ascii_split_whitespace(column)
    coded = words.flatten().cast(pa.large_binary()).dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), np.cumsum(pc.list_value_length(words).to_numpy(), dtype=np.int64)


def _encode_pieces(pieces: list[str], path: str) -> list[bytes]:
    """The ids of each piece, as little-endian 32-bit integers. Pieces of letters are a word each for most
    tokenizers: many go in a row with spaces between them, and the tokens that end a word part them again. A row
    with another number of such tokens than pieces is encoded piece by piece, like pieces of other characters."""
    tokenizer, *_ = _tokenizer(path)
    ends = _word_ends(path)
    out: list[bytes] = [b""] * len(pieces)
    words = [k for k, x in enumerate(pieces) if x.isalpha()] if len(ends) else []
    single = [k for k, x in enumerate(pieces) if not x.isalpha()] if len(ends) else list(range(len(pieces)))
    rows = [words[at: at + _ROW] for at in range(0, len(words), _ROW)]
    for row, found in zip(rows, tokenizer.encode_batch_fast([" ".join([pieces[k] for k in row]) for row in rows], add_special_tokens=False)):
        ids = np.array(found.ids, "<u4")
        last = np.flatnonzero(ends[ids])
        if len(last) != len(row) or last[-1] != len(ids) - 1:
            single += row
            continue
        raw, to = ids.tobytes(), (4 * last + 4).tolist()
        for k, lo, hi in zip(row, [0, *to], to):
            out[k] = raw[lo:hi]
    for k, found in zip(single, tokenizer.encode_batch_fast([pieces[k] for k in single], add_special_tokens=False)):
        out[k] = np.array(found.ids, "<u4").tobytes()
    return out


def _known_ids(pieces: list[bytes], path: str) -> pa.Array:
    """The ids of distinct pieces, from the worker's memo or the tokenizer. The memo holds pieces without the marks
    at their ends, and such marks; Arrow numbers both and puts their ids together."""
    parts = pa.concat_arrays(_parts(pieces)).dictionary_encode()
    known = _memo.setdefault(path, Memo(PIECES_KEPT))
    ids = pa.array(known.values(parts.dictionary.to_numpy(zero_copy_only=False).tolist(), lambda new: _encode_pieces(new, path)), pa.large_binary()).take(parts.indices)
    return pc.binary_join_element_wise(ids[: len(pieces)], ids[len(pieces):], pa.scalar(b"", pa.large_binary()))


def token_ids(texts: list[str], path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, each with the end id, one after another, and the number of each text's. Strings of special
    tokens are cut out of a text as they stand, before anything else, and give their ids, as in the library."""
    if not texts:
        return np.empty(0, "<u4"), np.empty(0, np.int64)
    _, special, special_ids = _tokenizer(path)
    end = end_id.to_bytes(4, "little")
    runs, marks, last = [], [], []  # text between special tokens, the ids after each run, the number of a text's last run
    for t in texts:
        found = special.findall(t)
        runs += map(_lowered, special.split(t) if found else [t])
        marks += [special_ids[m] for m in found]
        marks.append(end)
        last.append(len(marks) - 1)
    pieces, numbers, ends = _cut(runs)
    marked = list(dict.fromkeys(marks))
    nth = {m: len(pieces) + k for k, m in enumerate(marked)}
    numbers = np.insert(numbers.astype(np.int64), ends, [nth[m] for m in marks])
    found = pa.concat_arrays([_known_ids(pieces, path), pa.array(marked, pa.large_binary())]).take(pa.array(numbers))
    _, offsets, data = found.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(numbers) + 1) // 4
    to = bounds[ends[last] + np.array(last) + 1]
    return np.frombuffer(data, "<u4", int(bounds[-1])), np.diff(to, prepend=0)


def tokenise(texts: list[str], path: str, end_id: int = END_ID) -> list[bytes]:
    """The ids of each text and the end id, as little-endian 32-bit integers."""
    ids, lengths = token_ids(texts, path, end_id)
    raw, to = ids.tobytes(), (4 * np.cumsum(lengths)).tolist()
    return [raw[lo:hi] for lo, hi in zip([0, *to], to)]


# -- files ---------------------------------------------------------------------------------

def write_tokens(docs: DataFrame, out: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` and write the token files to the folder ``out``."""
    schema = pa.schema([("part", pa.int32()), ("start", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, start = TaskContext.get().partitionId(), 0

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            nonlocal start
            for piece in slices(batch, 1, TEXT_BYTES):
                ids, lengths = token_ids([t or "" for t in piece.column(1).to_pylist()], tokenizer, end_id)
                payloads = pack_all(ids, lengths)
                for doc, n, payload in zip(piece.column(0).to_pylist(), lengths.tolist(), payloads):
                    yield part, start, doc, n, payload
                    start += n

        return arrow_rows(batches, schema, rows, 1000)

    order = F.col("doc_id").asc_nulls_first()
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(order)
     .sortWithinPartitions(order, F.xxhash64("text")).mapInArrow(write, FILE_SCHEMA).write.parquet(out))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the files in ``path``; start counts the ids of all documents
    before it, ids holds little-endian unsigned 32-bit integers."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    schema = pa.schema([("part", pa.int32()), ("start", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def decode(batch: pa.RecordBatch) -> Iterator[tuple]:
        for piece in slices(batch, 4):
            cols = [c.to_pylist() for c in piece.columns]
            lengths = np.array(cols[3], dtype=np.int64)
            raw = unpack(cols[4], lengths).astype("<u4").tobytes()
            ends = (4 * np.cumsum(lengths)).tolist()
            yield from zip(*cols[:4], (raw[a:b] for a, b in zip([0, *ends], ends)))

    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row for each file
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select("part", before.alias("before"))
    ids = files.mapInArrow(lambda batches: arrow_rows(batches, schema, decode, 1000), "part int, start long, doc_id long, n_tokens long, ids binary")
    return ids.join(F.broadcast(offsets), "part").select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids")
