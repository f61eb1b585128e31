"""Personal data in whole texts (DataFrame functions only).

Regular expressions propose spans, checksums confirm them (Luhn for cards, mod 97 for IBANs,
number ranges for addresses and ssn), and words close by move a proposal's score up or down.
The base kinds (email, ip, card, phone) always stay once confirmed; further kinds stay with a
score of at least ``MIN_SCORE`` and where they overlap no base span:

    iban    country, check digits and 11 to 30 more characters, mod 97; a run of words in capitals
            or numbers is tried whole and then up to each space in it, the longest that holds counts
    ssn     NNN-NN-NNNN in the ranges that are given out
    phone   a national number such as (988) 555-2485 without the leading +

The places of all matches come from cutting the text at them: a match starts where the pieces
and matches before it end. The patterns match exactly what the plain forms match, written so
that no match attempt starts inside a run that has failed already and no group recurses. No list
grows by one match at a time: lengths are summed by doubling steps, choices that hang on the one
before are made in blocks, overlaps are found by binary search, and the words around a match come
from the text cut into blocks. So the work stays in proportion, but for a logarithm, to very long
texts and to the number of their matches.

Defined results: a null or empty text has no spans; equal rows give equal results; an empty
table gives no rows. Only doc_id and text are read; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]  # order of spans with one start
MIN_SCORE = 60
NEAR = 40  # code points on either side in which context words count
BLOCK = 512  # code points in a block of text, more than NEAR
CHOICES = 128  # spans in a block of choices
SPAN = "struct<start:int,kind:string,stop:int,score:int>"

_LOCAL, _LABEL = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: kind, pattern, what a text must hold for a match, test of a match (m), score, words that add, words that take away
RULES = [
    ("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++", "contains(text, '@')", "true", 90, "mail|contact", ""),
    ("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "text rlike '[0-9]\\\\.[0-9]'", rf"m rlike '^{_OCTET}(?:\.{_OCTET}){{3}}$'".replace("\\", "\\\\"), 70, "ip|address|host|server", "version|release"),
    ("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}(?![ -]?[0-9])", "text rlike '[0-9](?:[ -]?[0-9]){13}'", "luhn_check(replace(replace(m, ' ', ''), '-', ''))", 80, "card|visa|credit|payment", "order|isbn|serial"),
    ("phone", r"\+[0-9][ ().0-9-]+[0-9]", "contains(text, '+')", "length(regexp_replace(m, '[^0-9]', '')) between 10 and 15", 80, "phone|tel|call|mobile|fax", ""),
]
MORE_RULES = [
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9]))", "text rlike '[A-Z]{2}[0-9]{2}'", "mod97", 80, "iban|bank|account|konto|compte|cuenta", ""),
    ("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "text rlike '[0-9]-[0-9]{2}-[0-9]'", "true", 50, "ssn|social|security|tax", "order|part|serial"),
    ("phone", r"(?<![0-9+().-])(?<!\+[0-9]{1,3} )\([2-9][0-9]{2}\) ?[2-9][0-9]{2}-[0-9]{4}(?![0-9-])", "text rlike '[(][0-9]{3}[)]'", "true", 60, "phone|tel|call|mobile|fax", "order|part|serial"),
]


def matches(pattern: str, gate: str) -> Column:
    """All leftmost non-overlapping matches in text: struct(m: matches, p: the pieces between them,
    r: what a pattern that looks ahead sees after each match)."""
    hit = F.expr(gate)
    none = F.array().cast("array<string>")
    fields = [F.when(hit, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none).alias("m"),
              F.when(hit, F.split("text", pattern, -1)).otherwise(none).alias("p")]
    if "(?=(" in pattern:
        fields.append(F.when(hit, F.regexp_extract_all("text", F.lit(pattern), F.lit(1))).otherwise(none).alias("r"))
    return F.struct(*fields)


def _mod97(m: str) -> str:
    """The check of an IBAN: first four characters to the end, letters as 10 to 35, remainder 1."""
    c = f"replace({m}, ' ', '')"
    return (f"aggregate(split(concat(substring({c}, 5), substring({c}, 1, 4)), ''), 0, (r, x) -> case when x = '' then r "
            f"when x rlike '[0-9]' then (r * 10 + int(x)) % 97 else (r * 100 + ascii(x) - 55) % 97 end) = 1 and length({c}) between 15 and 34")


def running(values: str, n: str, op: str) -> str:
    """Running results of ``op`` (of x and the earlier y) over ``n`` values, by doubling steps."""
    return (f"aggregate(sequence(0, length(bin({n})) - 1), {values}, (had, k) -> transform(had, "
            f"(x, i) -> if(i >= shiftleft(1, k), {op.replace('y', 'had[i - shiftleft(1, k)]')}, x)))")


def apart(found: str, kind: str) -> str:
    """The spans of the column ``found`` (array of ``kind`` by start) without those that start before the end of
    the last one kept: first where each block of CHOICES spans starts from, then the choices in each block."""
    inside = f"sequence(b * {CHOICES}, least(size({found}), (b + 1) * {CHOICES}) - 1)"
    blocks = f"sequence(0, int((size({found}) - 1) div {CHOICES}))"
    ends = (f"aggregate({blocks}, array(0), (e, b) -> concat(e, array(aggregate({inside}, element_at(e, -1), "
            f"(at, i) -> if({found}[i].start >= at, {found}[i].stop, at)))))")
    chosen = (f"transform({blocks}, b -> aggregate({inside}, named_struct('at', ends[b], 'kept', cast(array() as array<{kind}>)), "
              f"(a, i) -> if({found}[i].start >= a.at, named_struct('at', {found}[i].stop, 'kept', concat(a.kept, array({found}[i]))), a)).kept)")
    return f"if(size({found}) = 0, cast(array() as array<{kind}>), flatten(element_at(transform(array({ends}), ends -> {chosen}), 1)))"


def part(start: str, n: str) -> str:
    """``n`` code points of text from place ``start``, at most BLOCK, out of its blocks."""
    at = f"int({start} div {BLOCK})"
    return f"substring(concat(coalesce(get(_blocks, {at}), ''), coalesce(get(_blocks, {at} + 1), '')), {start} % {BLOCK} + 1, {n})"


def places(found: str, kind: str, ahead: bool) -> Column:
    """array<struct<start, stop, m>> of the matches in ``found`` (see matches)."""
    span = "struct<start:int,stop:int,m:string>"
    lengths = f"transform({found}.m, (m, i) -> length({found}.p[i]) + length(m))"
    placed = (f"transform({running(lengths, f'size({found}.m)', 'x + y')}, "
              f"(stop, i) -> named_struct('start', stop - length({found}.m[i]), 'stop', stop, 'm', {found}.m[i]))")
    if ahead:  # the longest part up to a space that holds
        placed = (f"transform({placed}, (x, i) -> named_struct('start', x.start, 'm', filter(transform(sequence(size(split({found}.r[i], ' ')), 1, -1), "
                  f"k -> concat(x.m, substring_index({found}.r[i], ' ', k))), y -> {_mod97('y')})))")
        placed = f"transform(filter({placed}, x -> size(x.m) > 0), x -> named_struct('start', x.start, 'stop', x.start + length(x.m[0]), 'm', x.m[0]))"
    return F.expr(f"if(size({found}.m) = 0, cast(array() as array<{span}>), {placed})")


def spans(placed: str, kind: str, test: str, score: int, more: str, less: str) -> Column:
    """array<SPAN> of the confirmed matches in ``placed`` (see places); of IBANs that overlap the first."""
    if test == "mod97":
        confirmed = apart(placed, "struct<start:int,stop:int,m:string>")
    else:
        confirmed = f"filter({placed}, x -> {test.replace('(m,', '(x.m,').replace('m rlike', 'x.m rlike').replace('replace(m', 'replace(x.m')})"
    around = f"lower(concat({part(f'greatest(x.start - {NEAR}, 0)', f'least(x.start, {NEAR})')}, ' ', {part('x.stop', str(NEAR))}))"
    points = f"{score}" + (f" + if({around} rlike '\\\\b(?:{more})', 20, 0)" if more else "") + (f" - if({around} rlike '\\\\b(?:{less})', 30, 0)" if less else "")
    return F.expr(f"transform({confirmed}, x -> named_struct('start', x.start, 'kind', '{kind}', 'stop', x.stop, 'score', {points}))")


def text_blocks(gate: Column) -> Column:
    return F.when(gate, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))).otherwise(F.array().cast("array<string>"))


def find_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with pii_base and pii_added, arrays of struct<start, kind, stop, score> by start.
    Places are code points, stop is exclusive."""
    names = [c for c in docs.columns if c not in ("pii_base", "pii_added")]
    rules = RULES + MORE_RULES
    n = len(RULES)
    out = docs.select(*names, *(matches(r[1], r[2]).alias(f"_f{k}") for k, r in enumerate(rules)))
    out = out.select(*names, *(places(f"_f{k}", r[0], r[3] == "mod97").alias(f"_p{k}") for k, r in enumerate(rules)))
    out = out.select("*", text_blocks(F.expr(" or ".join(f"size(_p{k}) > 0" for k in range(len(rules))))).alias("_blocks"))
    out = out.select(*names, *(spans(f"_p{k}", r[0], r[3], *r[4:]).alias(f"_s{k}") for k, r in enumerate(rules)))
    base = F.concat(*(F.col(f"_s{k}") for k in range(n)))
    added = F.filter(F.concat(*(F.col(f"_s{k}") for k in range(n, len(rules)))), lambda x: x["score"] >= MIN_SCORE)
    out = out.select(*names, in_order(base).alias("pii_base"), in_order(added).alias("_added"))
    stops = running("pii_base.stop", "size(pii_base)", "greatest(x, y)")
    out = out.select(*names, "pii_base", "_added", F.expr(f"if(size(_added) = 0 or size(pii_base) = 0, cast(array() as array<int>), {stops})").alias("_stops"))
    # the number of base spans that start before x ends, bit by bit; x is free if all of them end before it
    before = ("aggregate(sequence(length(bin(size(_stops))) - 1, 0, -1), 0, (at, k) -> if(at + shiftleft(1, k) <= size(_stops) "
              "and pii_base[least(at + shiftleft(1, k), size(_stops)) - 1].start < x.stop, at + shiftleft(1, k), at))")
    return out.select(*names, "pii_base", F.expr(f"filter(_added, x -> coalesce(get(_stops, {before} - 1), 0) <= x.start)").alias("pii_added"))


def in_order(found: Column) -> Column:
    """By start, then kind as listed in KINDS, further kinds after them."""
    rank = lambda x: F.array_position(F.array(*map(F.lit, KINDS)), x["kind"])
    keyed = F.transform(found, lambda x: F.struct(x["start"].alias("a"), F.when(rank(x) > 0, rank(x)).otherwise(9).alias("b"), x["stop"].alias("c"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda k: k["x"])


def listed(found: Column) -> Column:
    """kind:start:stop, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def count_kind(found: str, kind: str) -> Column:
    return F.size(F.filter(F.col(found), lambda x: x["kind"] == kind)).cast("long")


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` (with pii_base and pii_added) with every span of text replaced by its kind in brackets;
    of spans that overlap the first."""
    names = docs.columns
    out = docs.select(*names, in_order(F.concat("pii_base", "pii_added")).alias("_all"), text_blocks(F.size(F.concat("pii_base", "pii_added")) > 0).alias("_blocks"))
    out = out.select(*names, "_blocks", F.expr(apart("_all", SPAN)).alias("_kept"))
    first, start = "if(i = 0, 0, _kept[greatest(i - 1, 0)].stop)", "if(i < size(_kept), get(_kept, i).start, greatest(size(_blocks), 1) * {0})".format(BLOCK)
    between = (f"array_join(transform(sequence(int({first} div {BLOCK}), int({start} div {BLOCK})), b -> substring(coalesce(get(_blocks, b), ''), "
               f"greatest({first} - b * {BLOCK}, 0) + 1, {start} - greatest({first}, b * {BLOCK}))), '')")
    pieces = f"array_join(transform(sequence(0, size(_kept)), i -> concat({between}, if(i < size(_kept), concat('<', get(_kept, i).kind, '>'), ''))), '')"
    return out.select(*(F.expr(f"if(size(_kept) > 0, {pieces}, text)").alias(c) if c == "text" else c for c in names))
