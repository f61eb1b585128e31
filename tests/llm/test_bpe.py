import hashlib
import random
import time
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from quarry.llm import bpe
from tests.llm.util import edge_rows

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def ids_of(library, text):
    return np.array(library.encode_ordinary(text or ""), "<u4").tobytes()


@pytest.mark.parametrize("text", ["ab" * 400, "aaa" * 50 + "b", "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(900)), "\x00\x1c\x85  　x", " \n \n  x\t\t", "I'll we'Re 12½ ³",
                                  "<|endoftext|>", "".join(chr(33 + (i * 31) % 900) for i in range(2000))])
def test_words_like_the_library(library, text):
    got = bpe.encode_texts([text, "", text], PATH, public_tokenizers.PATTERN)
    assert got == [ids_of(library, text), b"", ids_of(library, text)]
    assert bpe.decode_ids(got, PATH) == [text.encode(), b"", text.encode()]


def test_queries_that_stop_and_go_on(library, monkeypatch):
    monkeypatch.setattr(bpe, "STATE_ROWS", 100)
    text = "".join(chr(97 + (i * i * 5 + i // 4) % 26) for i in range(300))
    assert bpe.encode_words([text.encode(), b"ab", text[:99].encode()], PATH) == [ids_of(library, text), ids_of(library, "ab"), ids_of(library, text[:99])]


def test_long_words_are_cut_or_run_in_few_turns(library, monkeypatch):
    draw = random.Random(3)
    texts = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)), "ab" * 100_000, "".join(draw.choices("eta", k=50_000)), "aab" * 30_000,
             "".join(chr(draw.randint(0x4E00, 0x9FA0)) for _ in range(100_000)), "theablestringofwords" * 5_000, "".join(draw.choices("=-_#*/", k=50_000))]
    started = time.time()
    for text in texts:
        assert bpe.encode_texts([text], PATH, public_tokenizers.PATTERN) == [ids_of(library, text)]
    assert time.time() - started < 120
    monkeypatch.setattr(bpe, "LONG", 3)
    words = ["".join(draw.choices(letters, k=draw.randint(1, 60))) for letters in ("ab", "eta", "aeinorst", "abcdefghijklmnopqrstuvwxyz ", "éa漢=") for _ in range(150)]
    assert bpe.encode_words([w.encode() for w in words], PATH) == [np.array(library._encode_single_piece(w), "<u4").tobytes() for w in words]


def test_long_words_are_cut_or_run_in_few_turns(library, monkeypatch):
    draw = random.Random(3)
    texts = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)), "ab" * 100_000, "".join(draw.choices("eta", k=50_000)), "aab" * 30_000,
             "".join(chr(draw.randint(0x4E00, 0x9FA0)) for _ in range(100_000)), "theablestringofwords" * 5_000, "".join(draw.choices("=-_#*/", k=50_000))]
    started = time.time()
    for text in texts:
        assert bpe.encode_texts([text], PATH, public_tokenizers.PATTERN) == [ids_of(library, text)]
    assert time.time() - started < 120
    monkeypatch.setattr(bpe, "LONG", 3)
    words = ["".join(draw.choices(letters, k=draw.randint(1, 60))) for letters in ("ab", "eta", "aeinorst", "abcdefghijklmnopqrstuvwxyz ", "éa漢=") for _ in range(150)]
    assert bpe.encode_words([w.encode() for w in words], PATH) == [np.array(library._encode_single_piece(w), "<u4").tobytes() for w in words]


def test_tables(spark, edge_docs, no_docs, library):
    rows = sorted(((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(bpe.encode(edge_docs, PATH, public_tokenizers.PATTERN)).collect()))
    want = sorted((r[0] or -1, len(i := ids_of(library, r[1])) // 4, hashlib.sha256(i).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in edge_rows())
    assert rows == want
    assert bpe.encode(no_docs, PATH, public_tokenizers.PATTERN).collect() == []


def test_whole_table(spark, small_dir, library):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in bpe.encode(docs, PATH, public_tokenizers.PATTERN).collect():
        assert bytes(r.ids) == ids_of(library, texts[r.doc_id]) and bytes(r.decoded) == texts[r.doc_id].encode()


def test_decoding_takes_bytes_from_the_vocabulary(library):
    texts = ["É漢字 \U0001F600 words" * 50, "", "x"]
    ids = [ids_of(library, t) for t in texts]
    assert bpe.vocabulary(PATH)[bpe.read_ranks(PATH)[b" the"]].as_py() == b" the"
    assert bpe.decode_ids(ids, PATH) == [t.encode() for t in texts] and bpe.decode_ids([], PATH) == [] and bpe.decode_ids([b""], PATH) == [b""]


def test_words_met_all_the_time_are_encoded_once(monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 40)
    monkeypatch.setattr(bpe, "_memo", {})
    encoded, encode = [], bpe.encode_words
    monkeypatch.setattr(bpe, "encode_words", lambda words, path: encoded.extend(words) or encode(words, path))
    for k in range(12):
        bpe.encode_texts(["often" + "".join(f" w{chr(97 + k)}{chr(97 + j)}" for j in range(9))], PATH, public_tokenizers.PATTERN)
    assert encoded.count(b"often") == 1 and len(encoded) == 1 + 12 * 9
    assert len(bpe._memo[PATH].young) + len(bpe._memo[PATH].old) <= 40
