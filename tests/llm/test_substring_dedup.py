import random

import pytest

from quarry.llm import substring_dedup as S
from quarry.llm.suffix_sort import suffix_array
from tests.llm.util import edge_rows


def test_suffix_array_matches_sorting():
    rng = random.Random(1)
    for _ in range(800):
        text = [rng.randint(1, rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 60))] + [0]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute(rows):
    """rows: (id, text) in order -> {id: (bytes, removed, spans, kept)}."""
    seen, out = {}, {}
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 99):
            piece = raw[k:k + 100]
            if seen.setdefault(piece, (doc, k)) != (doc, k):
                gone[k:k + 100] = b"\x01" * 100
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[doc] = (len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g))
    return out


def run(docs):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.remove_repeats(docs).collect()}


def corpus():
    rng = random.Random(9)
    words = [f"w{k:x}" for k in range(3000)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, long = say(60), say(400)
    rows = [(k, r[1] if len(r[1] or "") < 9000 else r[1][:3000]) for k, r in enumerate(edge_rows()[:22])]
    rows += [(100 + k, f"{say(rng.randint(5, 40))} {passage[k % 9:]} {say(rng.randint(5, 40))}") for k in range(60)]
    rows += [(200, long), (201, long), (202, long[:1000] + "X" + long[1000:]), (203, long[300:900]), (204, "abcdefg" * 200), (205, "z" * 99), (206, "z" * 100),
             (207, "zy" * 300), (208, long[:100]), (209, long[1:100] + "!")]
    return rows


@pytest.mark.parametrize("group_bytes", [S.GROUP_BYTES, 600])
def test_matches_brute_force(spark, monkeypatch, group_bytes):
    monkeypatch.setattr(S, "GROUP_BYTES", group_bytes)  # 600: groups are sorted in pieces
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert run(docs) == brute(rows)


def test_pieces_of_a_group(monkeypatch):
    """The sorting of one group, in one piece and in many, by the results of all its rows."""
    import pyarrow as pa

    rng = random.Random(3)
    common = bytes(rng.randrange(97, 123) for _ in range(130))
    rows = [(7, k, k, 0, 0, 20, False, bytes(rng.randrange(97, 123) for _ in range(k % 20)) + common[k % 5:] + b"!" * (k % 3)) for k in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), S._schema(S._PART))], schema=S._schema(S._PART))
    results = []
    for size in (1 << 16, 300):
        monkeypatch.setattr(S, "GROUP_BYTES", size)
        out = [r for b in S._sorted_groups(iter([batch.slice(0, 11), batch.slice(11)])) for r in b.to_pylist()]
        covered = {(r["doc"], r["place"] + k) for r in out if not r["open"] for k in range(r["starts"])}
        first = {}
        for r in sorted((r for r in out if r["open"]), key=lambda r: (r["doc"], r["place"])):
            if first.setdefault((r["h1"], r["h2"]), r) is not r:
                covered.add((r["doc"], r["place"]))
        results.append(covered)
    assert results[0] == results[1] and results[0]


def test_repeated_ids_columns_and_empty(spark, no_docs):
    text = "".join(chr(97 + (k * k * 7 + k // 5) % 26) for k in range(150))
    rows = [(1, text, "a"), (1, text, "a"), (None, text[:120], "b"), (2, None, "c"), (1, text[20:] + "new text", "d")]
    out = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, kept string"))
    got = [(r.doc_id, r.n_bytes, r.n_removed) for r in out.collect()]
    assert out.columns == ["doc_id", "text", "n_removed", "n_spans", "kept", "n_bytes"] and len(got) == 5
    assert (None, 120, 0) in got and (2, 0, 0) in got and len({g for g in got if g[:2] == (1, 150)}) == 1
    assert S.remove_repeats(no_docs).collect() == []


def test_ranges_by_all_columns():
    """A key may be that of many bounds, of one or of none."""
    from bisect import bisect_right

    import pyarrow as pa

    rng = random.Random(5)
    rows = [(rng.choice([7, 7, 7, rng.randint(-9, 9), -(1 << 63)]), rng.randint(0, 3), rng.randint(0, 3), 0, rng.randint(0, 9)) for _ in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], list("abcde"))
    for bounds in ([], sorted(set(rng.sample(rows, 40))), [(7, 1, 1, 0, 1)]):
        got = [n for b in S._dealt(iter([batch, batch.slice(0, 0)]), bounds) for n in b.column(5).to_pylist()]
        assert got == [bisect_right(bounds, r) for r in rows]


def test_dropped_parts_hold_no_repeat():
    rng = random.Random(6)
    say = lambda n: bytes(rng.choice(b"abc\0") for _ in range(n))
    cut = 0
    for _ in range(300):
        core = say(rng.choice([72, 92, 99, 100, 101, 110]))
        pieces = [((k, 0), 1000 * k, say(rng.randint(0, 30)) + core + say(rng.randint(0, 30))) for k in range(rng.randint(1, 4))]
        pieces = [(d, p, raw + (raw[:105] if rng.random() < 0.2 else b"")) for d, p, raw in pieces if len(raw) >= S.SPAN]
        want = {r[:3] for r in S.repeats_in(pieces) if not r[3]}
        kept = S.shared_parts(pieces)
        assert {r[:3] for r in S.repeats_in(kept, False)} == want
        cut += sum(len(x[2]) for x in kept) < sum(len(x[2]) for x in pieces)
    assert cut > 30


def test_long_text_across_sections(spark):
    """Repeats on both sides of a section's end, and of a text with itself a section later."""
    rng = random.Random(8)
    say = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz     ", k=n))
    own, shared = say(400), say(500)
    long = say(S.SECTION - 250) + shared + say(70_000) + own + say(300_000) + own
    rows = [(1, long), (2, say(50) + shared + say(50)), (3, long[S.SECTION - 150: S.SECTION + 50]), (4, own[:99])]
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
