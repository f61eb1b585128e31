import hashlib
import re
import time

from pyspark.sql import functions as F

from quarry.llm import pii
from tests.llm.util import edge_rows

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    found = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)) \
                    or kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(found))


def base_of(df):
    return [(r[0], r[1]) for r in pii.find_pii(df).select("text", pii.listed(F.col("pii_base"))).collect()]


HARD = ["1.2.3.4.5.6.7.8.9", "x 1.2.3 4.5.6.7", "001.002.003.0255 256.1.1.1.1", "5 -4111 1111-1111 1111", "4111-1111-1111-1111 2", "4111--111111111111 4111111111111111",
        "12 4111111111111111 4111111111111111", "a@b.c_d@e.f g@h..i @j.k l@m", "a@b.c%d@e.f.g-@h.i", "+1 2 3 4 5 6 7 8 9 0 - +44 (0)20.7946 0958)", "+1+12345678901 +123456789012345 6",
        "é漢 a@b.cd 漢 +49 170 1234567", "9" * 5000, "1 " * 9000, "a." * 20000 + "b@" + "c." * 9000, "4" * 14 + " " + "4" * 5, "+1" + "-" * 3000 + "234567890",
        "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "pay 4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1 now"]


def test_base_spans_match_plain_patterns(spark, edge_docs):
    texts = HARD + [r[1] for r in edge_rows()]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    for text, got in base_of(df):
        assert got == brute(text), (text or "")[:80]


def test_whole_table(spark, small_dir):
    for text, got in base_of(spark.read.parquet(f"{small_dir}/documents.parquet")):
        assert got == brute(text)


def test_added_spans_and_scores(spark):
    rows = [(1, "my iban is DE89 3704 0044 0532 0130 00 ok"), (2, "iban DE88 3704 0044 0532 0130 00"), (3, "ssn 123-45-6789"), (4, "order 123-45-6789"),
            (5, "see 123-45-6789"), (6, "phone (988) 555-2485"), (7, "+1 (988) 555-2485")]
    df = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: [(x.kind, x.start, x.stop) for x in r.pii_added] for r in df.collect()}
    assert got == {1: [("iban", 11, 38)], 2: [], 3: [("ssn", 4, 15)], 4: [], 5: [], 6: [("phone", 6, 20)], 7: []}
    masked = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert masked[1] == "my iban is <iban> ok" and masked[7] == "<phone>" and masked[4] == rows[3][1]


def test_card_with_a_separator_after_every_digit(spark):
    rows = [(1, "pay 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 now"), (2, "4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1")]
    df = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: [(x.kind, x.start, x.stop) for x in r.pii_base] for r in df.collect()} == {1: [("card", 4, 35)], 2: [("card", 0, 31)]}
    assert {r.doc_id: r.text for r in pii.mask(df).collect()} == {1: "pay <card> now", 2: "<card>"}


def test_iban_beside_capitals_and_numbers(spark):
    iban, packed = "DE89 3704 0044 0532 0130 00", "DE89370400440532013000"
    cases = [(f"{iban} BIC COBADEFF", [(0, 27)]), (f"{iban} I said", [(0, 27)]), (f"{packed} EUR 50", [(0, 22)]), (f"my iban is {iban} ok", [(11, 38)]),
             (f"{iban} GB82 WEST 1234 5698 7654 32", [(0, 27), (28, 55)]), (f"REF AB12 {packed} CD34 {iban}", [(9, 31), (37, 64)]), (f"{iban}X", []),
             ("DE88 3704 0044 0532 0130 00 BIC COBADEFF", []), (f"é \U0001F600 {packed} NOK 7", [(4, 26)]), ("AB12 " * 3000 + packed, [(15000, 15022)])]
    df = pii.find_pii(spark.createDataFrame([(k, t) for k, (t, _) in enumerate(cases)], "doc_id long, text string"))
    got = {r.doc_id: [(x.start, x.stop) for x in r.pii_added if x.kind == "iban"] for r in df.collect()}
    assert got == {k: want for k, (_, want) in enumerate(cases)}
    masked = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert masked[0] == "<iban> BIC COBADEFF" and masked[1] == "<iban> I said" and masked[2] == "<iban> EUR 50" and masked[4] == "<iban> <iban>"


MANY = ["a1@b.cd mail 10.0.0.1, " * 20000, "é\U0001F600 +49 170 1234567; ssn 123-45-6789 " * 8000, "DE89 3704 0044 0532 0130 00 (988) 555-2485 tel " * 6000,
        "x" * 511 + "10.1.1.1" + "y" * 505 + " 4111111111111111"]


def plain_mask(text, found):
    out, at = [], 0
    for start, stop, kind in found:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
            at = stop
    return "".join(out) + text[at:]


def test_texts_with_many_matches(spark):
    df = pii.find_pii(spark.createDataFrame(list(enumerate(MANY)), "doc_id long, text string").repartition(4))
    started = time.time()
    got = {r.doc_id: r for r in pii.mask(df).withColumn("listed", pii.listed(F.col("pii_base"))).collect()}
    took = time.time() - started
    for k, text in enumerate(MANY):
        assert got[k].listed == brute(text)
        base = [(x.start, x.stop, x.kind) for x in got[k].pii_base]
        added = [(x.start, x.stop, x.kind) for x in got[k].pii_added]
        assert got[k].text == plain_mask(text, sorted(base + added, key=lambda x: (x[0], pii.KINDS.index(x[2]) if x[2] in pii.KINDS else 9)))
    assert [len(got[k].pii_added) for k in range(4)] == [0, 8000, 12000, 0]
    assert took < 120  # lists that grow match by match take hours


def test_choices_across_blocks(spark, monkeypatch):
    rows = [(0, "AB12 " * 3000), (1, "DE89 3704 0044 0532 0130 00 " * 40), (2, "(988) 555-2485 1.2.3.4 " * 30 + "10.0.0.1 " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = pii.mask(pii.find_pii(df)).collect()
    monkeypatch.setattr(pii, "CHOICES", 3)
    monkeypatch.setattr(pii, "BLOCK", 47)
    assert pii.mask(pii.find_pii(df)).collect() == want and want[1].text == "<iban> " * 40


def test_empty_table(spark, no_docs):
    assert pii.find_pii(no_docs).collect() == []
    assert hashlib.sha256(brute("").encode()).hexdigest().startswith("e3b0")
