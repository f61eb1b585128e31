"""Byte-level BPE with the merges run as recursive DuckDB queries inside each partition.

Spark deals out the documents. A partition's texts are cut into words by the tokenizer's
pattern; the distinct words that are not tokens themselves become rows (word, place, token),
one for each byte. A recursive query joins neighbouring rows with the merge table, contracts
each word's pair of least rank, leftmost first, and goes on until no word has a pair left. A
word's ids are remembered in the worker, up to a fixed number of words, and the ids of a text
are those of its words in a row. Decoding takes each id's bytes from the vocabulary, a column in
the order of the ids, and cuts the run of bytes at the documents' ends.

A turn contracts all occurrences of a word's best pair at once where that is the same as one
after another: when no pair with the new token ranks before it. That keeps the number of turns
small; a query stops after a number of turns that bounds its memory, and another goes on from
there. Before each query very long words are cut between two tokens whose bytes, one after the
other, stand in no token of the vocabulary: no merge can ever cross such a place, so both sides go
on as words of their own, and such words fall into short ones within a few turns.

Only a slice of a partition's texts (see ``common.slices``) is in Python at a
time. Nothing is kept outside the worker, so a lost task simply runs again.

Defined results: a null or empty text has no ids and decodes to no bytes; repeated rows give
equal rows; an empty table gives no rows. Other columns pass through.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Memo, arrow_rows, slices

WORDS_PER_QUERY = 20_000
STATE_ROWS = 4_000_000  # of one query, bounds its memory
LONG = 1_000  # tokens of a word that is cut where no merge can cross; a speed bound only
WORDS_KEPT = 500_000  # memo entries of a worker, a speed bound only

#: State rows (word, place, size, token): place counts all bytes of a query and one more after each word, so a
#: token's right neighbour is the row at place + size. (Behind a cut word there is no gap, but no merge either.) Each turn, ``can`` holds the pairs that can merge, ``best`` each
#: word's least rank, ``hits`` its places; how (see ``database``) says which of them go in one turn.
MERGE = """
with recursive state(turn, word, place, size, token) as (
  select 0, word, place, size, token from pieces
  union all (
  with can as (
    select s.word, s.place, n.place as gone, s.size + n.size as size, m.merged, m.how, s.token = n.token as twin
    from state s join state n on n.place = s.place + s.size
    join merges m on m.left_token = s.token and m.right_token = n.token
    where s.turn < {turns}),
  best as (select word, min(merged) as merged from can group by word),
  hits as (select c.* from can c join best b on c.word = b.word and c.merged = b.merged),
  chains as (select *, coalesce(place <> lag(gone) over (partition by word order by place), true) as starts from hits where how = 'alternate'),
  links as (select *, sum(starts::int) over (partition by word order by place) as chain from chains),
  steps as (select *, row_number() over (partition by word, chain order by place) as step from links),
  {risky}
  taken as (
    select place, gone, size, merged from hits where how = 'all'
    union all select place, gone, size, merged from steps where step % 2 = 1
    union all {first}),
  edits as (select place, size, merged from taken union all select gone, 0, -1 from taken)
  select s.turn + 1, s.word, s.place, coalesce(e.size, s.size), coalesce(e.merged, s.token)
  from state s join best b on s.word = b.word left join edits e on s.place = e.place
  where e.merged is null or e.merged >= 0)),
ends as (select word, max(turn) as turn from state group by word)
select s.word, s.place, s.size, s.token, s.turn from state s join ends e on s.word = e.word and s.turn = e.turn order by s.place
"""
FIRST = "select min(place), arg_min(gone, place), arg_min(size, place), min(merged) from hits where how = 'first' group by word"
#: For long words: places go in one turn up to the first where a pair that the new token makes with its
#: neighbours (or with itself, made anew beside it) ranks before it.
RISKY = """
  sides as (
    select h.word, h.place, h.merged, p.token as left_token, h.merged as right_token
    from hits h join state p on p.word = h.word and p.place + p.size = h.place where h.how = 'first'
    union all select h.word, h.place, h.merged, h.merged, n.token
    from hits h join state n on n.word = h.word and n.place = h.place + h.size where h.how = 'first'
    union all select word, place, merged, merged, merged from hits where how = 'first'),
  risky as (select word, min(place) as place from (
    select s.word, s.place from sides s join merges m on m.left_token = s.left_token and m.right_token = s.right_token where m.merged < s.merged
    union all select word, place from hits where how = 'first' and twin) group by word),
"""
FIRST_RUN = """select h.place, h.gone, h.size, h.merged from hits h left join risky r on h.word = r.word
    where h.how = 'first' and (r.place is null or h.place <= r.place)"""
#: Words cut where no merge can cross, numbered anew. The last one of a place's row and the next must be of
#: one word, side by side, and their bytes must stand in some token.
CUT = """
select sum(fresh) over (order by place)::int as word, place, size, token from (
  select s.place, s.size, s.token, (s.before is distinct from s.word or j.left_token is null)::int as fresh
  from (select *, lag(word) over (order by place) as before, lag(token) over (order by place) as left_token from pieces) s
  left join joined j on j.left_token = s.left_token and j.right_token = s.token)
order by place
"""


@cache
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@cache
def database(path: str) -> duckdb.DuckDBPyConnection:
    """In-memory table of a rank file: merges (left_token, right_token, merged, how). how says which places of a word's best pair can go in one turn: the first only, if some pair with
    the merged token ranks before it; every other one of a chain, if both tokens are the same; or all."""
    ranks = read_ranks(path)
    rows = [(left, right, rank) for token, rank in ranks.items() for k in range(1, len(token))
            if (left := ranks.get(token[:k])) is not None and (right := ranks.get(token[k:])) is not None]
    con = duckdb.connect(config={"threads": "1", "memory_limit": "400MB", "temp_directory": ""})
    left, right, merged = (pa.array(c, pa.int32()) for c in zip(*rows))
    con.register("given", pa.table({"left_token": left, "right_token": right, "merged": merged}))
    con.execute("""create table merges as
        with low as (select t, min(merged) as least from (select left_token as t, merged from given union all select right_token, merged from given) group by t)
        select g.*, case when l.least <= g.merged then 'first' when left_token = right_token then 'alternate' else 'all' end as how
        from given g left join low l on g.merged = l.t""")
    con.unregister("given")
    return con


@cache
def vocabulary(path: str) -> pa.Array:
    """The bytes of each id, null where there is none."""
    ranks = read_ranks(path)
    out: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return pa.array(out, pa.large_binary())


@cache
def with_joined(path: str) -> duckdb.DuckDBPyConnection:
    """``database`` with the table joined: pairs of tokens whose bytes stand side by side in some token."""
    ranks, con = read_ranks(path), database(path)
    pairs = {(left, right) for token in ranks for i in range(len(token)) for j in range(i + 1, len(token)) if (left := ranks.get(token[i:j])) is not None
             for k in range(j + 1, len(token) + 1) if (right := ranks.get(token[j:k])) is not None}
    left, right = (pa.array(c, pa.int32()) for c in zip(*pairs))
    con.register("given", pa.table({"left_token": left, "right_token": right}))
    con.execute("create table joined as select * from given")
    con.unregister("given")
    return con


def cut_words(state: dict, path: str) -> dict:
    """State rows with words cut where no merge can cross."""
    con = with_joined(path)
    con.register("pieces", pa.table(state))
    got = con.execute(CUT).fetchnumpy()
    con.unregister("pieces")
    return {c: np.asarray(got[c]).astype(np.int32) for c in state}


def encode_words(words: list[bytes], path: str) -> list[bytes]:
    """The ids of each word, as little-endian 32-bit integers."""
    ranks, con = read_ranks(path), database(path)
    single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
    out: list[bytes] = [b""] * len(words)
    rest = []
    for k, w in enumerate(words):
        if (rank := ranks.get(w)) is not None:
            out[k] = rank.to_bytes(4, "little")
        elif w:
            rest.append(k)
    for at in range(0, len(rest), WORDS_PER_QUERY):
        part = rest[at: at + WORDS_PER_QUERY]
        sizes = np.array([len(words[k]) for k in part])
        raw = np.frombuffer(b"".join(words[k] for k in part), np.uint8)
        word = np.repeat(np.arange(len(part), dtype=np.int32), sizes)
        state = {"word": word, "place": np.arange(len(raw), dtype=np.int32) + word,
                 "size": np.ones(len(raw), np.int32), "token": single[raw]}
        done: list[dict] = []
        while len(state["word"]):  # one query, unless a word needs more turns than there is memory for
            if long := np.bincount(state["word"]).max() > LONG:
                state = cut_words(state, path)
            how = {"risky": RISKY, "first": FIRST_RUN} if long else {"risky": "", "first": FIRST}
            turns = max(1, STATE_ROWS // len(state["word"]))
            con.register("pieces", pa.table(state))
            got = con.execute(MERGE.format(turns=turns, **how)).fetchnumpy()
            con.unregister("pieces")
            more = got["turn"] >= turns
            done.append({c: np.asarray(got[c])[~more] for c in state})
            state = {c: np.asarray(got[c])[more] for c in state}
        place, token = (np.concatenate([x[c] for x in done]) for c in ("place", "token"))
        order = np.argsort(place)
        ids = token[order].astype("<u4").tobytes()
        ends = np.searchsorted(place[order], np.cumsum(sizes + 1) - 1).tolist()
        for k, lo, hi in zip(part, [0, *ends], ends):
            out[k] = ids[4 * lo: 4 * hi]
    return out


_memo: dict[str, Memo] = {}


def encode_texts(texts: list[str], path: str, pattern: str) -> list[bytes]:
    """The ids of each text, as little-endian 32-bit integers."""
    known = _memo.setdefault(path, Memo(WORDS_KEPT))
    cut = regex.compile(pattern).findall
    split = [cut(t) for t in texts]
    new = sorted(known.missing(set().union(*split)))
    known.young.update(zip(new, encode_words([w.encode("utf-8", "surrogatepass") for w in new], path)))
    return [b"".join(map(known.young.__getitem__, ws)) for ws in split]


def decode_ids(ids: list[bytes], path: str) -> list[bytes]:
    """The bytes of each list of ids."""
    found = vocabulary(path).take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
    if found.null_count:
        raise ValueError("an id that the vocabulary does not hold")
    if not len(found):
        return [b""] * len(ids)
    _, starts, raw = found.buffers()
    starts, raw = np.frombuffer(starts, np.int64)[found.offset:], memoryview(raw)
    ends = starts[np.cumsum([len(x) // 4 for x in ids])].tolist()
    return [bytes(raw[a:b]) for a, b in zip([0, *ends], ends)]


def encode(docs: DataFrame, path: str, pattern: str, decoded: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) per row of ``docs``; ids holds little-endian unsigned 32-bit
    integers, decoded the bytes that they decode to."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for part in slices(batch, 1):
            texts = [t or "" for t in part.column(1).to_pylist()]
            ids = encode_texts(texts, path, pattern)
            back = decode_ids(ids, path) if decoded else [None] * len(ids)
            yield from zip(part.column(0).to_pylist(), (len(x) // 4 for x in ids), ids, back)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(lambda batches: arrow_rows(batches, schema, rows, 500), "doc_id long, n_tokens long, ids binary, decoded binary"))


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
