import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import token_files
from quarry.llm.common import Memo, shared_path
from tests.llm.util import edge_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=400), max_size=6))
def test_round_trip(docs):
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    ids = np.array([x for d in docs for x in d], dtype=np.uint32)
    payloads = token_files.pack(ids, lengths)
    assert token_files.unpack(payloads, lengths).tolist() == ids.tolist()
    for d, p in zip(docs, payloads):  # each on its own
        assert token_files.unpack([p], np.array([len(d)])).tolist() == d


def test_outliers_are_patched():
    ids = np.array([1000 + k % 8 for k in range(120)] + [2**31] * 8, dtype=np.uint32)
    (payload,) = token_files.pack(ids, np.array([128]))
    index = np.frombuffer(payload[: token_files._INDEX.itemsize], token_files._INDEX)[0]
    assert (index["width"], index["base"], index["exceptions"]) == (3, 1000, 8)
    assert len(payload) == token_files._INDEX.itemsize + 48 + 40


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, rows):
    out, start = [], 0
    for doc, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def read_back(spark, docs):
    path = shared_path(spark, "tokens")
    token_files.write_tokens(docs, path, PATH)
    return [tuple(r) for r in token_files.read_tokens(spark, path).selectExpr("doc_id", "start", "n_tokens", "crc32(ids)").orderBy("start").collect()]


def test_edge_cases(spark, library, no_docs):
    rows = [(k, r[1]) for k, r in enumerate(edge_rows())] + [(90, "ΑΣ ΟΔΟΣ É é ́x \x1c\x85 ﬁ İ"), (91, "<|endoftext|> 's a'll"), (93, "a <|endoftext|> b"), (94, "x<|startoftext|>y <|endoftext|><|endoftext|>"),
        (95, "<|ENDOFTEXT|> É<|endoftext|>é <|endoftext |> <|<|endoftext|>|>"),
        (92, "It's. don'. (x). ab,'s a.b. 9., é, É!? ?! ,;: w.... 3.14. Ⅷ. ǅ. ß: x\u0301. A\u030a,")]
    docs = spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(3)
    assert read_back(spark, docs) == expected(library, sorted(rows, key=lambda r: r[0]))
    assert read_back(spark, no_docs) == []


def test_capitals_whose_marks_compose_in_small_letters_only(library):
    texts = ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a", "aJ\u030cB. Plain WORDS", "\u00c9T\u00c9, J\u030c!"]
    for text, got in zip(texts, token_files.tokenise(texts, PATH, 1)):
        assert np.frombuffer(got, "<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], text


def test_repeated_and_null_ids(spark, library):
    rows = [(4, "a"), (4, "a"), (None, None), (2, None)]
    got = read_back(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r[0] for r in got] == [None, 2, 4, 4] and [r[2] for r in got] == [1, 1, 2, 2] and [r[1] for r in got] == [0, 1, 2, 4]


def test_whole_table(spark, library, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert read_back(spark, docs) == expected(library, rows)


def test_words_of_letters_go_in_rows(library, monkeypatch):
    monkeypatch.setattr(token_files, "_memo", {})
    words = [f"{a}{b}{c}" for a in "aeiouéßǅ" for b in "nrstlΣñ" for c in ("a", "K", "漢", "x")] + ["İx", "don't", "9a", "a_b", "ﬁn", "a.", "ǰ", "J̌", "Ⅷ", "ª"]
    pieces = [w.encode() for w in words]
    rows = []
    tokenizer = token_files._tokenizer(PATH)

    class Counted:
        def encode_batch_fast(self, texts, **kw):
            rows.append(len(texts))
            return tokenizer[0].encode_batch_fast(texts, **kw)

    monkeypatch.setattr(token_files, "_ROW", 20)
    token_files._word_ends(PATH)
    monkeypatch.setattr(token_files, "_tokenizer", lambda path: (Counted(), *tokenizer[1:]))
    found = token_files._encode_pieces(words, PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [library.encode(w.decode(), add_special_tokens=False).ids for w in pieces]
    assert sum(rows) < len(words) / 2


def test_composed_texts_are_lower_cased_as_a_whole(library):
    assert token_files._pieces("Été À LA Mode") == ["Été".encode(), "À".encode(), b"la", b"mode"]
    assert token_files._pieces("ÉTE J̌ A") == ["ÉTE".encode(), "J̌".encode(), b"a"]
    for text in ("ÉTÉ ΟΔΟΣ ΑΣa İI J̌", "Łódź ÉTE ΟΔΟΣ. İI", "K K ẞ"):
        (got,) = token_files.tokenise([text], PATH, 1)
        assert np.frombuffer(got, "<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, 1]


def test_python_meets_each_distinct_piece_once(library, monkeypatch):
    texts = ["a b  a\x0bc ", "", " \t", "b\u00a0b \u00e9 a", "x <|endoftext|> a <|endoftext|>", "A"] * 3
    lowered = [token_files._lowered(t) for t in texts]
    pieces, numbers, ends = token_files._cut(lowered)
    assert len(set(pieces)) == len(pieces)
    cut = [[pieces[k] for k in part if pieces[k]] for part in np.split(numbers, ends[:-1])]
    assert cut == [t.split() for t in lowered]
    met, known = [], token_files._known_ids
    monkeypatch.setattr(token_files, "_known_ids", lambda found, path: met.extend(found) or known(found, path))
    ids, lengths = token_files.token_ids(texts, PATH)
    assert sorted(met) == sorted({b"", *(w for t in texts for w in t.lower().replace("<|endoftext|>", "").encode().split())})
    assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == [[*library.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert token_files.tokenise([], PATH) == []


def test_words_are_encoded_once_whatever_marks_follow(library, monkeypatch):
    monkeypatch.setattr(token_files, "_memo", {})
    words = ["caf\u00e9", "\u00e9t\u00e9", "\u00f1and\u00fa", "wort"]
    texts = [f"{w}{m}" for w in words for m in ("", ".", ",", "###", "$$$", ".%%%", ")", "<|")]
    met, encode = [], token_files._encode_pieces
    monkeypatch.setattr(token_files, "_encode_pieces", lambda pieces, path: met.extend(pieces) or encode(pieces, path))
    for _ in range(2):
        got = token_files.tokenise([*texts, " ".join(texts)], PATH)
        for text, raw in zip([*texts, " ".join(texts)], got):
            assert np.frombuffer(raw, "<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], text
    assert sorted(met) == sorted({*words, "", ".", ",", "###", "$$$", ".%%%", ")", "<|"})


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abSTJ\u00e9\u00c9\u0130\u00df\u00aa\u00b5\u00d719'.,#$<|>=~_- \n\u00a0\u0301\u0338\u030c\u01c5\u03a3\u6f22\u2026", max_size=30), max_size=4))
def test_random_marks(library, texts):
    for text, raw in zip(texts, token_files.tokenise(texts, PATH)):
        assert np.frombuffer(raw, "<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], text


def test_memo_keeps_what_the_last_calls_met():
    memo, made = Memo(8), []
    make = lambda keys: made.extend(keys) or [x * 2 for x in keys]
    assert memo.values(["a", "b"], make) == ["aa", "bb"]
    assert memo.values(["b", "c", "d", "e"], make) == ["bb", "cc", "dd", "ee"]
    assert memo.values(["a", "e"], make) == ["aa", "ee"] and made == ["a", "b", "c", "d", "e"]
    for k in range(20):
        assert memo.values([str(k), "e"], make) == [str(k) * 2, "ee"]
        assert len(memo.young) + len(memo.old) <= 8
    assert made.count("e") == 1


def test_packed_in_parts_as_in_one(monkeypatch):
    monkeypatch.setattr(token_files, "PACKED_IDS", 100)
    lengths = np.array([0, 1, 99, 0, 300, 5, 95, 1, 0, 40, 0])
    ids = np.arange(lengths.sum(), dtype=np.uint32) * 977 % 50_000
    ids[::7] += 2**20
    assert token_files.pack_all(ids, lengths) == token_files.pack(ids, lengths)
    assert token_files.pack_all(ids[:0], lengths[:0]) == []
