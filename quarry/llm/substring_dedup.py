"""Removal of repeated strings of 100 bytes by suffix arrays of small groups.

Each start of a 100-byte string is keyed by its anchor, the least hash among the string's short
grams, so equal strings have equal anchors wherever they stand. Runs of starts with one anchor
are segments. Segments are range-partitioned by (anchor, content, document, place) and streamed:
a segment met before goes as a whole, and anchors with different contents go on. These few are
keyed again by longer grams, gathered in groups, and every group's text, without the parts that a
gram proves unique in it (``shared_parts``), gets a suffix array (see ``suffix_sort``), in which equal strings are neighbours; all but the first in (document,
start) order are covered. The covered bytes are removed from the texts in one last join.

Ranges are cut by a sample of rows, for which only some documents are hashed twice; wherever the cuts
fall, the results are the same. No group has to fit in one task. A range boundary may fall inside a group and a group of
more than ``GROUP_BYTES`` is sorted in pieces; each piece then reports the first of each of its
strings by a 128-bit hash, and a last aggregation compares these.

Defined results: a null or empty text and one below 100 bytes loses nothing; documents are
ordered by id, null ids first, then by a hash of the text if some id has several texts; rows that repeat
a document are one document and have one result each; an empty table gives no rows. Only doc_id and text are
read; other columns pass through.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_rows, materialise, slices, to_batch
from quarry.llm.shingles import mix
from quarry.llm.suffix_sort import suffix_array

SPAN = 100
GRAM, LONG_GRAM = 32, 72
MAX_STARTS = 170  # of a segment; longer runs of one anchor are cut
SECTION, _PLACE = 1 << 20, 21  # starts of a text that are hashed at a time, bits for a place among them
GROUP_BYTES = 1 << 16  # of text in one suffix array, or one longer segment
DOCS_PER_RANGE, ROWS_PER_RANGE = 8, 60  # sampled for the bounds of a range
STEP = 8  # between the grams that prove a string unique
_NO_ID = -(1 << 63)
_L, _I = pa.int64(), pa.int32()
_SEGMENT = "anchor long, content long, doc long, version long, place int, starts int, again boolean"
_FOUND = "open boolean, " + _SEGMENT
_PART = "key long, content long, doc long, version long, place int, starts int, again boolean, bytes binary"
_RESULT = "open boolean, h1 long, h2 long, doc long, version long, place int, starts int"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": _L, "int": _I, "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x, size = np.minimum(x[:-size], x[size:]), 2 * size
    return np.minimum(x[: len(x) - (width - size)], x[width - size:]) if size < width else x


def anchors(raw: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each start of a SPAN-byte string: the least hash among the string's grams, and the first
    and last place where it stands (hashes are compared by all but ``_PLACE`` of their bits)."""
    n = len(raw)
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate([raw, np.zeros(8, np.uint8)]), 8)[:n].copy().view(np.uint64).ravel()
    m = n - gram + 1
    hashes = eight[:m]
    for at in range(8, gram, 8):  # a gram's length is a multiple of eight
        hashes = mix(hashes) + eight[at: at + m]
    hashes = mix(hashes)
    mask, width = np.uint64((1 << _PLACE) - 1), SPAN - gram + 1
    place = np.arange(m, dtype=np.uint64)
    first = _sliding_min((hashes & ~mask) | place, width) & mask
    last = mask - (_sliding_min((hashes & ~mask) | (mask - place), width) & mask)
    return hashes[first.astype(np.int64)], first, last


def segments(raw: np.ndarray, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (anchor, content hash, place, starts, again) of the runs of starts with one anchor, section by
    section; again: the anchor stands there more than once, so that a string may be in it twice."""
    view = memoryview(raw)
    for lo in range(0, len(raw) - SPAN + 1, SECTION):
        least, first, last = anchors(raw[lo: lo + SECTION + SPAN - 1], gram)
        new = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        size = np.diff(np.concatenate([new, [len(least)]]))
        if (size > MAX_STARTS).any():
            more = -(-size // MAX_STARTS)
            new = np.repeat(new, more) + MAX_STARTS * (np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more))
            size = np.diff(np.concatenate([new, [len(least)]]))
        again = first[new] != last[new + size - 1]
        at = new + lo
        digest = xxhash.xxh3_64_intdigest
        content = np.fromiter((digest(view[a:b]) for a, b in zip(at.tolist(), (at + size + SPAN - 1).tolist())), np.uint64, len(at))
        yield least[new].view(np.int64), content.view(np.int64), at.astype(np.int32), size.astype(np.int32), again


def _raw(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def _segment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = _schema(_SEGMENT).names
    for batch in batches:
        for part in slices(batch, 2):
            found = [(doc, version, x) for doc, version, text in zip(*(c.to_pylist() for c in part.columns)) for x in segments(_raw(text), GRAM)]
            if found:
                sizes = [len(x[0]) for *_, x in found]
                key, content, at, n, again = (np.concatenate(c) for c in zip(*(x for *_, x in found)))
                doc, version = (np.repeat(np.array([f[k] for f in found], np.int64), sizes) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (key, content, doc, version, at, n, again)], names)


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over sorted segments. Yields those met before (not open), and the first of each content
    (open) where the anchor has several contents, stands more than once in this one, or lies at the
    partition's edge."""
    key = content = None  # of the row before
    held = None  # the only content so far of the last anchor, as a one-row batch
    edge = True  # the last anchor is the partition's first
    names = _schema(_FOUND).names

    def marked(batch: pa.RecordBatch, is_open: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, is_open)), *batch.columns], names)

    for batch in batches:
        a, c = (batch.column(k).to_numpy() for k in (0, 1))
        if not len(a):
            continue
        same_key = np.concatenate([[a[0] == key], a[1:] == a[:-1]])
        first = ~(same_key & np.concatenate([[c[0] == content], c[1:] == c[:-1]]))
        run = np.cumsum(~same_key)  # 0: goes on from the batch before
        count = np.bincount(run, first, minlength=run[-1] + 1)
        lone = count == 1
        if key is not None and count[0]:
            if held is not None:
                yield marked(held, True)
                held = None
            lone[0] = False  # the anchor had a content before
        elif key is not None and run[-1] > 0:
            held = None  # it ended with one content
        if edge and key is not None:
            lone[0] = False
        if key is None:
            lone[1] = False  # the partition's first anchor
        if run[-1] > 0 and key is not None:
            edge = False
        last = run[-1]
        if key is None:
            edge = last == 1
        keep_last = lone[last] and (last > 0)
        twice = batch.column(6).to_numpy(zero_copy_only=False)
        send = first & (~lone[run] | twice)
        if send.any():
            yield marked(batch.filter(pa.array(send)), True)
        if (~first).any():
            yield marked(batch.filter(pa.array(~first)), False)
        if keep_last:
            at = int(np.flatnonzero(first & (run == last))[0])
            held = None if twice[at] else batch.slice(at, 1)  # else it is sent already
        elif last > 0:
            held = None
        key, content = a[-1], c[-1]
    if held is not None:
        yield marked(held, True)  # the partition's last anchor


def _part_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Open segments of a document cut again by longer grams, with their bytes."""
    for part in slices(batch, 2):
        docs, versions, texts = (part.column(k).to_pylist() for k in range(3))
        lists = part.column(3)
        for k, (doc, version, text) in enumerate(zip(docs, versions, texts)):
            raw = _raw(text)
            wanted = lists[k].values
            anchor, place, starts = (wanted.field(j).to_numpy() for j in range(3))
            order = np.argsort(place, kind="stable")
            yield from _cut_again(raw, doc, version, anchor[order], place[order].astype(np.int64), starts[order].astype(np.int64))


def _cut_again(raw: np.ndarray, doc: int, version: int, anchor: np.ndarray, place: np.ndarray, starts: np.ndarray) -> Iterator[tuple]:
    view = memoryview(raw)
    lo = 0
    while lo < len(place):  # sections of neighbouring segments
        hi = int(np.searchsorted(place, place[lo] + SECTION - MAX_STARTS, "left"))
        at, n, key = place[lo:hi], starts[lo:hi], anchor[lo:hi]
        base = int(at[0])
        least, first, last = anchors(raw[base: int((at + n).max()) + SPAN - 1], LONG_GRAM)
        segment = np.repeat(np.arange(len(at)), n)
        where = np.arange(len(segment)) + np.repeat(at - base - (np.cumsum(n) - n), n)
        value = least[where]
        new = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (segment[1:] != segment[:-1])]))
        size = np.diff(np.concatenate([new, [len(value)]]))
        again = first[where[new]] != last[where[new + size - 1]]
        both = (mix(value[new]) ^ key[segment[new]].view(np.uint64)).view(np.int64)
        for k, a, m, twice in zip(both.tolist(), (where[new] + base).tolist(), size.tolist(), again.tolist()):
            piece = view[a: a + m + SPAN - 1]
            yield k, xxhash.xxh3_64_intdigest(piece) - (1 << 63), doc, version, a, m, twice, bytes(piece)
        lo = hi


def shared_parts(pieces: list[tuple[tuple, int, bytes]]) -> list[tuple[tuple, int, bytes]]:
    """The parts of ``pieces`` that may hold a string that stands twice among them. Such a string holds one of its
    piece's grams of SPAN - STEP + 1 bytes at every STEP-th place, and that gram stands elsewhere, too."""
    size = SPAN - STEP + 1
    whole = b"".join(raw for *_, raw in pieces)
    out, base = [], 0
    for doc, place, raw in pieces:
        met = []
        for at in range(0, len(raw) - size + 1, STEP):
            gram = raw[at: at + size]
            if whole.find(gram) != base + at or whole.find(gram, base + at + 1) >= 0:
                met.append(at)
        if met:
            lo = max(0, met[0] - STEP + 1)
            out.append((doc, place + lo, raw[lo: met[-1] + SPAN]))
        base += len(raw)
    return [x for x in out if len(x[2]) >= SPAN]


def repeats_in(pieces: list[tuple[tuple, int, bytes]], firsts: bool = True) -> Iterator[tuple[tuple, int, bytes, bool]]:
    """``pieces`` are (document, place, bytes). Yields (document, start, string, first) of each start of a
    SPAN-byte string; first for the earliest start of each string. Without ``firsts`` these are left out."""
    text, owner, offset = bytearray(), [], []
    symbols: list[int] = []
    for k, (_, _, raw) in enumerate(pieces):
        symbols += [b + 2 for b in raw]
        symbols.append(1)
        starts = len(raw) - SPAN + 1
        owner += [k] * starts + [-1] * SPAN
        offset += range(len(raw) + 1)
        text += raw + b"\0"
    symbols.append(0)
    owner.append(-1)
    whole = bytes(text)
    order = [i for i in suffix_array(symbols) if owner[i] >= 0]
    n, at = len(order), 0
    while at < n:
        i = order[at]
        string, end = whole[i: i + SPAN], at + 1
        while end < n and whole.startswith(string, order[end]):
            end += 1
        if firsts or end > at + 1:
            alike = []
            for i in order[at: end]:
                doc, place, _ = pieces[owner[i]]
                alike.append((doc, place + offset[i]))
            alike.sort()
            for doc_start in alike:
                if (first := doc_start == alike[0]) and not firsts:
                    continue
                yield *doc_start, string, first
        at = end


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over the parts of a partition, sorted by (key, content, doc, version, place). Yields runs of covered
    starts (not open), and for groups in pieces the first start of each string (open), with its hash."""
    schema = _schema(_RESULT)
    out: list[tuple] = []
    key, content, pieces, size, whole, first_group, twice = None, None, [], 0, True, True, False

    def close(ends: bool, edge: bool) -> None:
        """Sort what is gathered; ends: the group has no more rows here."""
        nonlocal pieces, size, twice
        alone = whole and ends and not edge
        if len(pieces) > 1 or pieces and (twice or not alone):
            covered: dict[tuple, list[int]] = {}
            # the edges of a group need the first start of all strings, other groups only what stands twice
            pieces = shared_parts(pieces) if alone else pieces
            for doc, start, string, first in repeats_in(pieces, not alone) if pieces else ():
                if not first:
                    covered.setdefault(doc, []).append(start)
                elif not alone:
                    h = xxhash.xxh3_128_digest(string)
                    out.append((True, int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True), *doc, start, 1))
            for doc, starts in covered.items():
                starts.sort()
                a = end = starts[0]
                for start in starts:
                    if start > end:
                        out.append((False, None, None, *doc, a, end - a))
                        a = start
                    end = start + 1
                out.append((False, None, None, *doc, a, end - a))
        pieces, size, twice = [], 0, False

    for batch in batches:
        for k, c, doc, version, place, starts, again, raw in zip(*(x.to_pylist() for x in batch.columns)):
            if k != key:
                close(True, first_group)
                first_group = key is None
                key, content, whole = k, None, True
            if c == content:
                out.append((False, None, None, doc, version, place, starts))
            else:
                if size + len(raw) > GROUP_BYTES:
                    close(False, False)
                    whole = False
                pieces.append(((doc, version), place, raw))
                size += len(raw)
                content, twice = c, twice or again
            if len(out) >= 5000:
                yield to_batch(out, schema)
                out = []
    close(True, True)
    if out:
        yield to_batch(out, schema)


def _dealt(batches: Iterator[pa.RecordBatch], bounds: list[tuple]) -> Iterator[pa.RecordBatch]:
    """``batches`` with the number of the range of each row: how many bounds are not above its first five columns."""
    keys = np.array([b[0] for b in bounds], np.int64)
    for batch in batches:
        columns = [batch.column(k).to_numpy() for k in range(5)]
        part, above = np.searchsorted(keys, columns[0], "left"), np.searchsorted(keys, columns[0], "right")
        on_edge = np.flatnonzero(part < above)  # the key of a bound: the other columns decide
        rows = zip(*(c[on_edge].tolist() for c in columns))
        part[on_edge] = [bisect_right(bounds, row, lo, hi) for row, lo, hi in zip(rows, part[on_edge].tolist(), above[on_edge].tolist())]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, _I)], [*batch.schema.names, "range"])


def _in_ranges(rows: DataFrame, sample: DataFrame, make: Callable, ddl: str) -> DataFrame:
    """What ``make`` yields from the batches of ``rows``, in ranges of its first five columns and sorted by them.
    The bounds come from ``sample``, some of the rows; it places rows and has no other effect."""
    n = _ranges(rows)
    order = _schema(ddl).names[:5]
    drawn = sample.mapInArrow(make, ddl).select(*order).orderBy(F.rand(7)).limit(ROWS_PER_RANGE * n).collect()
    drawn = sorted(map(tuple, drawn))
    bounds = sorted({drawn[len(drawn) * k // n] for k in range(1, n)}) if drawn else []
    return (rows.mapInArrow(lambda batches: _dealt(make(batches), bounds), f"{ddl}, range int")
            .repartitionById(n, "range").drop("range").sortWithinPartitions(*order))


def _ranges(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _some(rows: DataFrame) -> DataFrame:
    """A sample of about DOCS_PER_RANGE rows for each range."""
    return rows.sample(min(1.0, DOCS_PER_RANGE * _ranges(rows) / max(1, rows.count())), 7)


def _identified(docs: DataFrame) -> tuple[Column, Column]:
    """(doc, version): version is a constant unless some id has several texts."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    unique = docs.groupBy(doc.alias("doc")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    return doc, F.lit(0).cast("long") if unique else F.xxhash64("text")


def covered_starts(docs: DataFrame, doc: Column, version: Column) -> DataFrame:
    """(doc, version, place, starts): runs of starts whose string starts earlier as well."""
    def texts_of(rows: DataFrame) -> DataFrame:
        return rows.where(F.octet_length("text") >= SPAN).select(doc.alias("doc"), version.alias("version"), "text")

    texts = texts_of(docs)
    found = materialise(_in_ranges(texts, texts_of(_some(docs)), _segment_batches, _SEGMENT).mapInArrow(_first_of_each, _FOUND), "segments")
    names = ["doc", "version", "place", "starts"]
    first = F.min(F.struct("doc", "version", "place")).alias("first")
    opened = found.where("open")
    # edges: one content may be the first in several partitions
    contents = opened.groupBy("anchor", "content").agg(first, F.count(F.lit(1)).alias("n"))
    again = (opened.join(contents.where("n > 1").select("anchor", "content", "first"), ["anchor", "content"])
             .where(F.struct("doc", "version", "place") != F.col("first")))
    mixed = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1").select("anchor", F.lit(True).alias("mixed"))
    wanted = materialise(opened.join(mixed, "anchor", "left").where("mixed or again").groupBy("doc", "version")
                         .agg(F.collect_list(F.struct("anchor", "place", "starts")).alias("wanted")), "wanted")  # of one document
    some = _some(wanted.select("doc", "version")).limit(2 * DOCS_PER_RANGE * _ranges(docs)).collect()
    some = F.broadcast(docs.sparkSession.createDataFrame(some, "doc long, version long"))  # bounded by the limit

    def wanted_texts(few: DataFrame, lists: DataFrame) -> DataFrame:
        return few.join(lists, ["doc", "version"]).select("doc", "version", "text", "wanted").dropDuplicates(["doc", "version"])

    sample = wanted_texts(texts.join(some, ["doc", "version"]), wanted.join(some, ["doc", "version"]))
    ranged = _in_ranges(wanted_texts(texts, wanted), sample, lambda b: arrow_rows(b, _schema(_PART), _part_rows, 5000), _PART)
    sorted_groups = materialise(ranged.mapInArrow(_sorted_groups, _RESULT), "groups")
    edges = sorted_groups.where("open")
    later = (edges.join(edges.groupBy("h1", "h2").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), ["h1", "h2"])
             .where(F.struct("doc", "version", "place") != F.col("first")))
    out = found.where("not open").select(*names)
    for more in (again, sorted_groups.where("not open"), later):
        out = out.unionByName(more.select(*names))
    return out


def _removed(size: int, runs: list) -> np.ndarray:
    """Which of ``size`` bytes are covered."""
    change = np.zeros(size + 1, np.int32)
    for place, starts in runs:
        change[place] += 1
        change[place + starts + SPAN - 1] -= 1
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, and kept, the remaining bytes."""
    names = [c for c in docs.columns if c not in ("n_bytes", "n_removed", "n_spans", "kept")]
    doc, version = _identified(docs)
    runs = (covered_starts(docs, doc, version).distinct().groupBy("doc", "version")
            .agg(F.collect_list(F.struct("place", "starts")).alias("_runs"))  # of one document
            .withColumnRenamed("doc", "_doc").withColumnRenamed("version", "_version"))
    keyed = docs.select(*names).withColumn("_d", doc).withColumn("_v", version)
    joined = keyed.join(runs, (F.col("_d") == F.col("_doc")) & (F.col("_v") == F.col("_version")), "left").select(*names, "_runs")
    kind = "n_removed long, n_spans long, kept binary"
    schema = pa.schema([("n_removed", _L), ("n_spans", _L), ("kept", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            for part in slices(batch, at):
                rows = []
                for text, found in zip(part.column(at).to_pylist(), part.column(len(names)).to_pylist()):
                    raw = _raw(text or "")
                    gone = _removed(len(raw), [(r["place"], r["starts"]) for r in found or ()])
                    spans = int(gone[:1].sum() + (np.diff(gone.astype(np.int8)) == 1).sum())
                    rows.append((int(gone.sum()), spans, raw[~gone].tobytes()))
                made = to_batch(rows, schema)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made.columns], [*names, *schema.names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    out = joined.mapInArrow(cut, f"{fields}, {kind}")
    return out.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
