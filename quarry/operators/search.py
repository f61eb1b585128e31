"""Batch ranked retrieval: a whole table of queries is answered by joins and aggregates.

A query batch is a ``clauses`` DataFrame (:data:`CLAUSE_SCHEMA`), one row per clause:

* ``kind``: ``term`` (analysed text; several tokens are OR-ed), ``phrase`` (tokens at
  consecutive positions, or within ``slop`` moves), ``prefix``, ``wildcard`` (``*`` and
  ``?``), ``regexp`` (anchored full match), ``fuzzy`` (``max_edits`` <= 2 incl. one
  adjacent swap), ``range`` (``lo``/``hi`` lexicographic, ``incl_lo``/``incl_hi``, open
  when null), ``all`` (every document), ``group`` (a nested boolean group).
* ``occur``: ``MUST`` / ``SHOULD`` / ``MUST_NOT``; ``boost`` multiplies the clause score.
* ``group_id``: 0 for top-level clauses, otherwise the ``clause_id`` of the parent group.
* ``field`` null means the index's default fields: the clause matches when any field does
  and the field scores are summed.

Plan: analyse clause text -> (clause, field, term) rows -> join the term dictionary
(df) and field stats (N, avgdl) -> join postings (broadcast when the query side has a
checked, bounded size; shuffle join otherwise) -> per (query, clause, doc) scores ->
boolean evaluation bottom-up over groups -> per query top-k with ``row_number``
(Catalyst adds a ``WindowGroupLimit`` so each partition keeps k rows before the shuffle).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import bm25
from quarry.functions.stemmer import stem_column_values
from quarry.operators.index import ANALYZERS, LOWERCASING, Index, dealt_postings_for_terms, match_terms, positions_for_terms, postings_for_terms
from quarry.session import ensure_checkpoint_dir

CLAUSE_SCHEMA = (
    "query_id long, group_id int, clause_id int, index string, field string, kind string, "
    "text string, occur string, boost double, slop int, max_edits int, lo string, hi string, "
    "incl_lo boolean, incl_hi boolean"
)

TEXT_KINDS = ["term", "phrase", "prefix", "wildcard", "regexp", "fuzzy"]
EXPANSION_KINDS = ["prefix", "wildcard", "regexp", "range"]

# Largest query-side table that is broadcast to the postings scan.
BROADCAST_MAX_ROWS = 200_000
# Scores of a task: documents times clauses.
SCORES_PER_TASK = 250_000
# Clauses whose terms lie within so many two-byte cells are joined on those, wider ones on first bytes.
NARROW_CELLS = 512
# Scores are compared after rounding to this many decimals, so that summation order
# (which differs between partitions and engines) cannot reorder tied documents.
RANK_DECIMALS = 9


def fits_broadcast(df: DataFrame) -> tuple[DataFrame, bool]:
    """Cache a query-side table and check its row count against the broadcast bound."""
    df = df.cache()
    return df, df.count() <= BROADCAST_MAX_ROWS


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast ``df`` only after checking its row count; otherwise leave it to a
    shuffle join (AQE may still convert it at run time from measured sizes)."""
    df, ok = fits_broadcast(df)
    return F.broadcast(df) if ok else df


# ---------------------------------------------------------------------------
# Validation (Q19) and normalisation
# ---------------------------------------------------------------------------

def validate_clauses(clauses: DataFrame, known_indexes: list[str], depths: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Split clauses into (valid, rejected(query_id, clause_id, index, reason)).

    A query is refused as a whole on an index if one of its clauses there is wrong: dropping
    only that clause would change what the query asks. Groups must lead to the top level
    (``depths``: the clauses' depths, if known)."""
    reason = (
        F.when(F.col("index").isNull() | (F.trim("index") == ""), F.lit("no index chosen"))
        .when(F.col("kind").isin(TEXT_KINDS) & (F.col("text").isNull() | (F.trim("text") == "")),
              F.lit("blank query"))
        .when(~F.col("kind").isin(TEXT_KINDS + ["range", "all", "group"]), F.lit("unknown kind"))
        .when((F.col("kind") == "fuzzy") & (F.coalesce("max_edits", F.lit(2)) > 2),
              F.lit("max_edits above 2"))
        .when(~F.col("index").isin(known_indexes), F.lit("unknown index"))
    )
    wrong = clauses.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("query_id", "clause_id", "index", "reason")
    if depths is None and is_grouped(clauses):
        depths = clause_depths(clauses)
    if depths is not None:
        lost = depths.where("depth is null").select(
            "query_id", "clause_id", "index", F.lit("group does not lead to the top level").alias("reason"))
        wrong = wrong.unionByName(lost)
    bad = wrong.select(F.col("query_id").alias("_q"), F.col("index").alias("_i")).distinct()
    valid = clauses.join(bad, F.col("query_id").eqNullSafe(F.col("_q")) & F.col("index").eqNullSafe(F.col("_i")), "left_anti")
    return valid, wrong


def _normalised(clauses: DataFrame) -> DataFrame:
    return (clauses
            .withColumn("occur", F.upper(F.coalesce("occur", F.lit("SHOULD"))))
            .withColumn("boost", F.coalesce("boost", F.lit(1.0)).cast("double"))
            .withColumn("slop", F.coalesce("slop", F.lit(0)))
            .withColumn("max_edits", F.coalesce("max_edits", F.lit(2)))
            .withColumn("group_id", F.coalesce("group_id", F.lit(0))))


def _with_fields(clauses: DataFrame, index: Index) -> DataFrame:
    """Resolve the field of every clause; null -> the index's default fields."""
    defaults = F.array(*[F.lit(f) for f in index.default_fields])
    field = F.col("field")
    for alias, target in index.aliases.items():
        field = F.when(F.col("field") == alias, F.lit(target)).otherwise(field)
    return clauses.withColumn(
        "field", F.explode(F.when(F.col("field").isNull(), defaults).otherwise(F.array(field))))


def _analyse(index: Index, text: Column) -> Column:
    expr = None
    for f in set(index.analyzers) - {"*"}:
        branch = ANALYZERS[index.analyzers[f]](text)
        expr = F.when(F.col("field") == f, branch) if expr is None else expr.when(F.col("field") == f, branch)
    fallback = ANALYZERS[index.analyzer("*")](text)
    return fallback if expr is None else expr.otherwise(fallback)


def _is_stemmed(index: Index) -> Column:
    names = [f for f, a in index.analyzers.items() if a == "porter" and f != "*"]
    others = [f for f, a in index.analyzers.items() if a != "porter" and f != "*"]
    if index.analyzer("*") == "porter":
        return ~F.col("field").isin(others) if others else F.lit(True)
    return F.col("field").isin(names) if names else F.lit(False)


def _normalise_pattern(index: Index, text: Column) -> Column:
    lower = [f for f, a in index.analyzers.items() if a in LOWERCASING and f != "*"]
    default_lower = index.analyzer("*") in LOWERCASING
    cond = ~F.col("field").isin([f for f, a in index.analyzers.items() if a not in LOWERCASING and f != "*"]) \
        if default_lower else F.col("field").isin(lower)
    return F.when(cond, F.lower(text)).otherwise(text)


# ---------------------------------------------------------------------------
# Query-side term rows
# ---------------------------------------------------------------------------

def _query_terms(index: Index, leaf: DataFrame) -> DataFrame:
    """term/phrase/fuzzy clauses -> (query_id, clause_id, field, qpos, term, n_terms, ...)."""
    toks = leaf.withColumn("_tokens", _analyse(index, F.col("text")))
    rows = toks.select("*", F.size("_tokens").alias("n_terms"),
                       F.posexplode("_tokens").alias("qpos", "term"))
    # only what matching and scoring read goes on, never the query's text
    rows = rows.select("query_id", "clause_id", "field", "kind", "boost", "slop", "max_edits", "n_terms", "qpos", "term")
    if any(a == "porter" for a in list(index.analyzers.values()) + [index.analyzer("*")]):
        stemmed = rows.withColumn("_stem", _is_stemmed(index) & (F.col("kind") != "fuzzy"))
        vocab = stemmed.where("_stem").select("term").distinct()
        stems = stem_column_values(vocab, "term", "stem")
        rows = (stemmed.join(stems, "term", "left")
                .withColumn("term", F.when(F.col("_stem"), F.coalesce("stem", "term")).otherwise(F.col("term")))
                .drop("stem", "_stem"))
    return rows


def _with_stats(index: Index, qterms: DataFrame, by_document: bool = False) -> tuple[DataFrame, bool, DataFrame]:
    """Attach df and field stats to query terms; terms absent from the index are dropped.

    Returns (query side, bounded, postings of the query terms). The query side is never
    larger than ``qterms`` (one df per (field, term)), so its size is checked once here.
    ``by_document``: postings for a bounded query side lie where :func:`score_tasks` puts their document."""
    stats = F.broadcast(index.length_stats())  # one row per field
    qterms, ok = fits_broadcast(qterms)
    by_document = by_document and ok and index.deal is not None
    if by_document:
        plist = dealt_postings_for_terms(index, qterms, score_tasks(index, qterms.select("query_id", "clause_id").distinct().count()))
    else:
        plist = postings_for_terms(index, qterms, ok)
    joined = _with_df(index, qterms, ok, plist, stats)
    if ok and not by_document:  # dealt postings: left in the plan, where both sides read one exchange of the texts
        # small (checked) and read by several branches: computed once, not once per branch
        joined = joined.cache()
        joined.count()
    return joined, ok, plist


def _with_df(index: Index, side: DataFrame, ok: bool, plist: DataFrame, stats: DataFrame) -> DataFrame:
    """Query-side (field, term) rows with df, doc_count, avgdl and idf."""
    if index.tokens is not None:
        dfs = plist.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
        joined = (F.broadcast(side) if ok else side).join(dfs, ["field", "term"])
    else:
        joined = match_terms(index, index.term_dict, side, ok).select(*side.columns, "df")
    return (joined.join(stats, "field")
            .withColumn("idf", bm25.idf(F.col("df").cast("double"), F.col("doc_count").cast("double"))))


# ---------------------------------------------------------------------------
# Leaf clause evaluation -> (query_id, clause_id, doc_id, score)
# ---------------------------------------------------------------------------

def score_tasks(index: Index, n_clauses: int) -> int:
    """So many tasks that a task's documents have at most ``SCORES_PER_TASK`` scores. Documents are dealt to them by id
    before they are tokenised: clause and group scores of a document are summed where its postings are,
    and neither postings nor hits (a row for each posting and query) are exchanged."""
    n = -(-index.docs.count() * max(n_clauses, 1) // SCORES_PER_TASK)
    return max(n, index.docs.sparkSession.sparkContext.defaultParallelism)


def _term_hits(index: Index, qterms: DataFrame) -> DataFrame:
    q, ok, plist = _with_stats(index, qterms.where(F.col("kind") == "term"), by_document=True)
    hits = match_terms(index, plist, q, ok)
    return hits.select("query_id", "clause_id", "doc_id",
                       bm25.weight(F.col("tf"), F.col("dl"), F.col("avgdl"), F.col("idf"), F.col("boost")).alias("score"))


def sloppy_length(found: Column, anchor: Column, n_terms: Column, slop: Column) -> Column:
    """Length of the shortest sloppy match at an anchor, null without one.

    ``anchor`` is a position of the phrase's first token, ``found`` the sorted (qpos, pos) of the other
    tokens near it. The other tokens take a position each, no position serving two tokens; a match's
    length is the spread of the tokens' shifts against the phrase. Tokens are alike or share no
    position, so giving each token in turn its first free position inside a window finds an
    assignment if there is one. Windows hold the anchor, lengths are tried from 0 to ``slop``."""
    def fills(length: Column, before: Column) -> Column:
        def take(used: Column, q: Column) -> Column:
            lo = anchor + q - before
            free = F.filter(found, lambda x: (x["qpos"] == q) & x["pos"].between(lo, lo + length) & ~F.array_contains(used, x["pos"]))
            return F.concat(used, F.transform(F.slice(free, 1, 1), lambda x: x["pos"]))
        taken = F.aggregate(F.sequence(F.lit(1), n_terms - 1), F.array(anchor), take)
        return F.size(taken) == n_terms
    lengths = F.filter(F.sequence(F.lit(0), slop), lambda n: F.exists(F.sequence(F.lit(0), n), lambda k: fills(n, k)))
    return F.get(lengths, F.lit(0))


def _sloppy_hits(occ: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, freq, dl, boost, avgdl): each occurrence of a phrase's first token anchors one match, which
    adds 1 / (1 + length). Anchors meet the occurrences of the other tokens at most ``slop`` away by an
    equi-join on cells of slop + 1 positions, so a document's work is linear in its occurrences."""
    cell = F.floor(F.col("rel") / (F.col("slop") + 1))
    anchors = (occ.where("qpos = 0").withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1)))
               .select(*keys, "cell", F.col("pos").alias("anchor"), "n_terms", "slop", "dl", "boost", "avgdl"))
    others = occ.where("qpos > 0").select(*keys, cell.alias("cell"), "qpos", "pos", "rel")
    near = (anchors.join(others, [*keys, "cell"]).where(F.abs(F.col("rel") - F.col("anchor")) <= F.col("slop"))
            .groupBy(*keys, "anchor")
            .agg(F.sort_array(F.collect_list(F.struct("qpos", "pos"))).alias("found"),  # 2 * slop + 1 of a token at most
                 *(F.first(c).alias(c) for c in ("n_terms", "slop", "dl", "boost", "avgdl"))))
    length = near.withColumn("length", sloppy_length(F.col("found"), F.col("anchor"), F.col("n_terms"), F.col("slop")))
    return (length.where(F.col("length").isNotNull()).groupBy(*keys)
            .agg(F.sum(F.lit(1.0) / (F.col("length") + 1)).alias("freq"), *(F.first(c).alias(c) for c in ("dl", "boost", "avgdl"))))


def _phrase_hits(index: Index, qterms: DataFrame, sloppy: bool) -> DataFrame:
    """Phrase occurrences. Exact: every token at ``start + qpos`` (group by start). Sloppy, planned only if
    a clause has slop: :func:`_sloppy_hits`."""
    q, ok, _ = _with_stats(index, qterms.where(F.col("kind") == "phrase"))
    # clauses whose every token is in the dictionary
    full = (q.groupBy("query_id", "clause_id", "field")
            .agg(F.countDistinct("qpos").alias("_found"), F.first("n_terms").alias("_n"),
                 F.sum("idf").alias("idf_sum"))
            .where(F.col("_found") == F.col("_n")).drop("_found", "_n"))
    q = q.join(full, ["query_id", "clause_id", "field"], "left_semi")
    keys = ["query_id", "clause_id", "field", "doc_id"]
    occ = (positions_for_terms(index, q, ok)
           .select(*keys, "dl", "qpos", "n_terms", "slop", "boost", "avgdl", "pos", (F.col("pos") - F.col("qpos")).alias("rel")))

    freqs = (occ.where("slop = 0")
             .groupBy(*keys, "rel")
             # one occurrence per (doc, offset, query position): a plain count suffices
             .agg(F.count(F.lit(1)).alias("_k"), F.first("n_terms").alias("n_terms"),
                  F.first("dl").alias("dl"), F.first("boost").alias("boost"), F.first("avgdl").alias("avgdl"))
             .where(F.col("_k") == F.col("n_terms"))
             .groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("freq"), F.first("dl").alias("dl"),
                                 F.first("boost").alias("boost"), F.first("avgdl").alias("avgdl")))
    if sloppy:
        freqs = freqs.unionByName(_sloppy_hits(occ.where("slop > 0"), keys))
    scored = freqs.join(full, ["query_id", "clause_id", "field"])
    return scored.select("query_id", "clause_id", "doc_id",
                         bm25.weight(F.col("freq"), F.col("dl"), F.col("avgdl"), F.col("idf_sum"), F.col("boost"))
                         .alias("score"))


def _swap_variants(term: Column) -> Column:
    """The term and every variant with one adjacent pair of characters swapped."""
    n = F.length(term)
    idx = F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)))
    swaps = F.transform(idx, lambda i: F.concat(F.substring(term, 1, i - 1), F.substring(term, i + 1, 1),
                                                F.substring(term, i, 1), F.substring(term, i + 2, 1 << 20)))
    return F.array_distinct(F.filter(swaps, lambda v: v != term))


def term_pieces(term: Column, n_pieces: int) -> Column:
    """(nth, piece) of a term cut into ``n_pieces`` pieces of about equal length; one empty piece if it is shorter."""
    cuts = F.transform(F.sequence(F.lit(0), F.lit(n_pieces - 1)), lambda i: F.struct(
        i.alias("nth"), F.substring(term, _cut(i, F.length(term), n_pieces) + 1,
                                    _cut(i + 1, F.length(term), n_pieces) - _cut(i, F.length(term), n_pieces)).alias("piece")))
    return F.when(F.length(term) >= n_pieces, cuts).otherwise(_whole())


def _cut(i: Column, length: Column, n_pieces: int) -> Column:
    return F.floor(i * length / n_pieces).cast("int")


def _whole() -> Column:
    return F.array(F.struct(F.lit(0).alias("nth"), F.lit("").alias("piece")))


def probe_pieces(term: Column, length: Column, edits: int) -> Column:
    """(nth, piece) that a dictionary term of ``length`` within ``edits`` of this term may hold: the substrings
    of this term as long as the nth piece, at most ``edits`` places from where that piece begins."""
    n = edits + 2
    nth = F.sequence(F.lit(0), F.lit(n - 1))
    size = lambda i: _cut(i + 1, length, n) - _cut(i, length, n)
    shifts = F.sequence(F.lit(-edits), F.lit(edits))
    some = F.transform(nth, lambda i: F.transform(
        F.filter(shifts, lambda s: (_cut(i, length, n) + s >= 0) & (_cut(i, length, n) + s + size(i) <= F.length(term))),
        lambda s: F.struct(i.alias("nth"), F.substring(term, _cut(i, length, n) + s + 1, size(i)).alias("piece"))))
    return F.when(length >= n, F.array_distinct(F.flatten(some))).otherwise(_whole())


def _fuzzy_candidates(vocab: DataFrame, q: DataFrame) -> DataFrame:
    """(query term, dictionary term) pairs that share a piece, by an equi-join on (field, edits, length, nth, piece).

    Pigeonhole: of edits + 2 pieces of a dictionary term, an insertion, deletion or substitution spoils one
    and the one adjacent swap two at most, so a term within ``edits`` has a piece unspoilt, shifted by at most
    ``edits``. Each clause is joined by its own number of edits."""
    def keyed(edits: int) -> Column:
        return F.transform(term_pieces(F.col("term"), edits + 2),
                           lambda p: F.struct(F.lit(edits).alias("edits"), p["nth"].alias("nth"), p["piece"].alias("piece")))
    pieces = F.concat(keyed(0), keyed(1), keyed(2))
    dictionary = vocab.select("field", "term", F.length("term").alias("len"), F.explode(pieces).alias("p")).select("field", "term", "len", "p.*")
    probe = q.withColumn("len", F.explode(F.sequence(F.greatest(F.col("qlen") - F.col("max_edits"), F.lit(1)), F.col("qlen") + F.col("max_edits"))))
    found = F.when(F.col("max_edits") == 0, probe_pieces(F.col("qterm"), F.col("len"), 0))
    for e in (1, 2):
        found = found.when(F.col("max_edits") == e, probe_pieces(F.col("qterm"), F.col("len"), e))
    probe = probe.withColumn("p", F.explode(found)).select(*q.columns, "len", F.col("max_edits").alias("edits"), "p.nth", "p.piece")
    probe, ok = fits_broadcast(probe)
    return (dictionary.join(F.broadcast(probe) if ok else probe, ["field", "edits", "len", "nth", "piece"]).drop("edits", "nth", "piece")
            .dropDuplicates(["query_id", "clause_id", "field", "qpos", "term"]))


def _fuzzy_hits(index: Index, qterms: DataFrame) -> DataFrame:
    """Dictionary terms within ``max_edits`` (insert/delete/substitute, plus at most one
    adjacent swap counted as one edit). Every expansion is scored by BM25 with its own
    df, times a similarity boost ``1 - edits / min(len(query term), len(term))``.
    Candidates come from :func:`_fuzzy_candidates` and are verified exactly."""
    q = (qterms.where(F.col("kind") == "fuzzy")
         .select("query_id", "clause_id", "field", "boost", "max_edits", "qpos", F.col("term").alias("qterm"))
         .withColumn("qlen", F.length("qterm")))
    cand = _fuzzy_candidates(index.vocabulary(), q)
    swap_best = F.array_min(F.transform(_swap_variants(F.col("qterm")),
                                        lambda v: F.levenshtein(v, F.col("term")) + 1))
    ed = (cand.withColumn("edits", F.least(F.levenshtein("qterm", "term"), F.coalesce(swap_best, F.lit(1 << 20))))
          .where(F.col("edits") <= F.col("max_edits"))
          .withColumn("sim", F.lit(1.0) - F.col("edits") / F.least(F.col("qlen"), F.col("len")))
          .where(F.col("sim") > 0)
          .select("query_id", "clause_id", "field", "term", "boost", "sim"))
    # expansions are kept whole (no top-n cap); their count is checked before broadcasting
    exp, ok = fits_broadcast(ed)
    plist = postings_for_terms(index, exp, ok)
    side = _with_df(index, exp, ok, plist, F.broadcast(index.length_stats()))
    hits = match_terms(index, plist, side, ok)
    return hits.select("query_id", "clause_id", "doc_id",
                       (bm25.weight(F.col("tf"), F.col("dl"), F.col("avgdl"), F.col("idf"), F.col("boost")) * F.col("sim"))
                       .alias("score"))


def wildcard_to_regex(pattern: Column) -> Column:
    """``*`` -> any run, ``?`` -> one character; everything else literal; anchored."""
    chars = F.split(pattern, "")
    parts = F.transform(chars, lambda c: F.when(c == "*", F.lit(".*")).when(c == "?", F.lit("."))
                        .when(c.rlike("^[A-Za-z0-9]$"), c)
                        .when(c.rlike("^[\\\\^$.|?*+()\\[\\]{}]$"), F.concat(F.lit("\\"), c))
                        .otherwise(c))
    return F.concat(F.lit("^"), F.array_join(parts, ""), F.lit("$"))


def _cell(term: Column, fill: str = "0") -> Column:
    """First two bytes of a term as a number; keeps the order of terms. ``fill`` F: the greatest term with this start."""
    return F.conv(F.rpad(F.hex(F.substring(term.cast("binary"), 1, 2)), 4, fill), 16, 10).cast("int")


def _first_byte(cell: Column) -> Column:
    """Key of all cells with this first byte, below every cell."""
    return F.lit(-1) - F.floor(cell / 256).cast("int")


def _grams(text: Column) -> Column:
    """Distinct runs of three characters."""
    return F.when(F.length(text) >= 3, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - 2), lambda i: F.substring(text, i, 3)))
                  ).otherwise(F.array().cast("array<string>"))


def _literals(kind: Column, pat: Column) -> tuple[Column, Column]:
    """(text that every match begins with, runs that every match holds) of a pattern; regular expressions
    give runs of ASCII letters and digits, and none if they have choices, groups, classes or escapes."""
    plain = ~pat.rlike("[|()\\[\\]\\\\{}]")
    start = (F.when(kind == "prefix", pat).when(kind == "wildcard", F.regexp_extract(pat, "^[^*?]*", 0))
             .when((kind == "regexp") & plain, F.regexp_extract(pat, "^(?:[A-Za-z0-9](?![?*]))*", 0)).otherwise(F.lit("")))
    runs = (F.when(kind == "wildcard", F.split(pat, "[*?]+"))
            .when((kind == "regexp") & plain, F.split(F.regexp_replace(pat, "[A-Za-z0-9][?*]", "."), "[^A-Za-z0-9]+"))
            .otherwise(F.array().cast("array<string>")))
    return start, runs


def _expansion_terms(vocab: DataFrame, q: DataFrame) -> DataFrame:
    """(query_id, clause_id, field, term, boost) of the dictionary terms that the clauses match.

    Each clause meets the dictionary by one of two equi-joins and is then verified. Prefixes, ranges and
    patterns with a literal start of two bytes: on order-preserving cells, the first two bytes of a term, or
    the first byte where a clause spans many cells. Other patterns with a literal run of three characters or
    more: on an inverted index of the terms' character trigrams, all of the pattern's trigrams being in the term.
    What has neither spans all first bytes."""
    t = F.col("term")
    lo_ok = F.col("lo_n").isNull() | F.when(F.coalesce("incl_lo", F.lit(True)), t >= F.col("lo_n")).otherwise(t > F.col("lo_n"))
    hi_ok = F.col("hi_n").isNull() | F.when(F.coalesce("incl_hi", F.lit(True)), t <= F.col("hi_n")).otherwise(t < F.col("hi_n"))
    match = (F.when(F.col("kind") == "prefix", F.startswith(t, F.col("pat")))
             .when(F.col("kind") == "wildcard", F.regexp_like(t, wildcard_to_regex(F.col("pat"))))
             .when(F.col("kind") == "regexp", F.regexp_like(t, F.concat(F.lit("^(?:"), F.col("pat"), F.lit(")$"))))
             .when(F.col("kind") == "range", lo_ok & hi_ok)
             .otherwise(F.lit(False)))
    start, runs = _literals(F.col("kind"), F.col("pat"))
    ranged = F.col("kind") == "range"
    lo = F.when(ranged, F.coalesce("lo_n", F.lit(""))).otherwise(F.col("start"))
    hi = F.when(ranged, _cell(F.col("hi_n"), "F")).otherwise(_cell(F.col("start"), "F"))
    q = (q.withColumn("start", start).withColumn("runs", runs)
         .withColumn("grams", F.array_distinct(F.flatten(F.transform("runs", _grams))))
         .withColumn("lo_cell", _cell(lo)).withColumn("hi_cell", F.coalesce(hi, F.lit(0xFFFF)))
         .withColumn("by_grams", (F.size("grams") > 0) & (F.octet_length("start") < 2)))
    wide = F.col("hi_cell") - F.col("lo_cell") > NARROW_CELLS
    cells = F.when(wide, F.sequence(_first_byte(F.col("hi_cell")), _first_byte(F.col("lo_cell")))).otherwise(F.sequence("lo_cell", "hi_cell"))
    clause = [c for c in q.columns if c not in ("start", "runs", "grams", "lo_cell", "hi_cell", "by_grams")]
    out = ["query_id", "clause_id", "field", "term", "boost"]
    by_cell = bounded_broadcast(q.where("not by_grams and lo_cell <= hi_cell").select(*clause, F.explode(cells).alias("cell")))
    by_gram = bounded_broadcast(q.where("by_grams").select(*clause, F.size("grams").alias("n_grams"), F.explode("grams").alias("gram")))
    own = _cell(t)
    first = (vocab.select("field", "term", F.explode(F.array(own, _first_byte(own))).alias("cell"))
             .join(by_cell, ["field", "cell"]).where(match).select(*out))
    second = (vocab.select("field", "term", F.explode(_grams(t)).alias("gram")).join(by_gram, ["field", "gram"])
              .groupBy(*clause, "term", "n_grams").agg(F.count(F.lit(1)).alias("n")).where("n = n_grams").where(match).select(*out))
    return first.unionByName(second)


def _expansion_hits(index: Index, leaf: DataFrame) -> DataFrame:
    """prefix / wildcard / regexp / range: constant score ``boost`` per matching doc."""
    q = (leaf.where(F.col("kind").isin(EXPANSION_KINDS))
         .withColumn("pat", _normalise_pattern(index, F.col("text")))
         .withColumn("lo_n", _normalise_pattern(index, F.col("lo")))
         .withColumn("hi_n", _normalise_pattern(index, F.col("hi")))
         .select("query_id", "clause_id", "field", "kind", "boost", "pat", "lo_n", "hi_n", "incl_lo", "incl_hi"))
    terms, ok = fits_broadcast(_expansion_terms(index.vocabulary(), q))  # expansions kept whole; size checked before broadcasting
    hits = match_terms(index, postings_for_terms(index, terms, ok), terms, ok)
    per_field = hits.groupBy("query_id", "clause_id", "field", "doc_id").agg(F.first("boost").alias("score"))
    return per_field.select("query_id", "clause_id", "doc_id", "score")


def _all_hits(index: Index, leaf: DataFrame) -> DataFrame:
    q = leaf.where(F.col("kind") == "all").select("query_id", "clause_id", "boost").distinct()
    return index.docs.select("doc_id").crossJoin(bounded_broadcast(q)).select(
        "query_id", "clause_id", "doc_id", F.col("boost").alias("score"))


def leaf_hits(index: Index, clauses: DataFrame, kinds: set[str] | None = None, sloppy: bool = True) -> DataFrame:
    """All non-group clauses -> (query_id, clause_id, doc_id, score); a doc matches a
    clause if any of its fields/tokens match; scores over fields and tokens are summed."""
    leaf = _with_fields(clauses.where(F.col("kind") != "group"), index)
    textual = leaf.where(F.col("kind").isin("term", "phrase", "fuzzy"))
    qterms = _query_terms(index, textual)
    # one-token phrases are plain terms
    qterms = qterms.withColumn("kind", F.when((F.col("kind") == "phrase") & (F.col("n_terms") == 1), F.lit("term"))
                               .otherwise(F.col("kind")))
    if kinds is None:
        kinds = {r[0] for r in leaf.select("kind").distinct().collect()}  # a few enum values
    parts = []
    if kinds & {"term", "phrase"}:
        parts.append(_term_hits(index, qterms))
    if "phrase" in kinds:
        if index.positions is None:
            raise ValueError("phrase clauses need an index built with positions")
        parts.append(_phrase_hits(index, qterms, sloppy))
    if "fuzzy" in kinds:
        parts.append(_fuzzy_hits(index, qterms))
    if kinds & set(EXPANSION_KINDS):
        parts.append(_expansion_hits(index, leaf))
    if "all" in kinds:
        parts.append(_all_hits(index, leaf))
    if not parts:
        kind = index.docs.schema["doc_id"].dataType.simpleString()
        return leaf.sparkSession.createDataFrame([], f"query_id long, clause_id int, doc_id {kind}, score double")
    hits = reduce(DataFrame.unionByName, parts)
    return hits.groupBy("query_id", "clause_id", "doc_id").agg(F.sum("score").alias("score"))


# ---------------------------------------------------------------------------
# Boolean evaluation
# ---------------------------------------------------------------------------

def is_grouped(clauses: DataFrame) -> bool:
    return not clauses.where(F.coalesce("group_id", F.lit(0)) != 0).isEmpty()


def clause_depths(clauses: DataFrame) -> DataFrame:
    """(query_id, index, clause_id, depth): depth 0 for top level, null where the parents lead in a
    circle or to no group. Each pass doubles the number of parents walked, so a nesting of any
    depth takes a logarithm of it in passes; walks that have not ended once the passes exceed
    the logarithm of the largest query go in a circle."""
    ensure_checkpoint_dir(clauses.sparkSession)
    rows = clauses.select("query_id", "index", "clause_id", F.coalesce("group_id", F.lit(0)).alias("up"), "kind")
    groups = rows.where("kind = 'group'").select("query_id", "index", F.col("clause_id").alias("up"), F.lit(True).alias("known"))
    same = ["query_id", "index", "up"]
    walk = (_null_safe_join(rows, groups.distinct(), same, "left")
            .select("query_id", "index", "clause_id", F.when((F.col("up") == 0) | F.col("known"), F.col("up")).alias("up"),
                    F.when(F.col("up") == 0, 0).otherwise(1).alias("depth"))).checkpoint()
    size = rows.groupBy("query_id", "index").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0  # one number
    for _ in range(size.bit_length() + 1):
        if walk.where("up <> 0").isEmpty():
            break
        step = walk.select("query_id", "index", F.col("clause_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more")).distinct()
        walk = (_null_safe_join(walk, step, same, "left")
                .select("query_id", "index", "clause_id", F.when(F.col("up") == 0, 0).otherwise(F.col("next")).alias("up"),
                        (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))).checkpoint()
    return walk.select("query_id", "index", "clause_id", F.when(F.col("up") == 0, F.col("depth")).alias("depth"))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    renamed = right.select(*(F.col(k).alias(f"_{k}") for k in keys), *(c for c in right.columns if c not in keys))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(renamed, reduce(lambda a, b: a & b, on), how).drop(*(f"_{k}" for k in keys))


def evaluate_boolean(clauses: DataFrame, hits: DataFrame, n_clauses: int | None = None,
                     grouped: bool | None = None) -> DataFrame:
    """Combine clause hits bottom-up into (query_id, doc_id, score) for the top group.

    Per group: every MUST child must match, no MUST_NOT child may match, and when the
    group has no MUST child at least one SHOULD child must match (so a purely negative
    group matches nothing). Score = sum of matching MUST and SHOULD child scores, times
    the group clause's boost."""
    meta = clauses.select("query_id", "index", "clause_id", "group_id", "occur", "boost", "kind", *(["depth"] if "depth" in clauses.columns else []))
    if n_clauses is None:
        meta, small = fits_broadcast(meta)
    else:
        small = n_clauses <= BROADCAST_MAX_ROWS
    bc = F.broadcast if small else (lambda d: d)  # clause-sized tables, row count checked
    if grouped is None:
        grouped = meta.where(F.col("group_id") != 0).limit(1).count() > 0
    if not grouped:
        max_depth, meta = 0, meta.withColumn("depth", F.lit(0))
    else:
        if "depth" not in meta.columns:
            depths = clause_depths(meta).where("depth is not null").select("query_id", "clause_id", "depth")
            meta = meta.join(depths, ["query_id", "clause_id"])
        max_depth = meta.agg(F.max("depth")).first()[0] or 0  # one scalar
        # every level reads the hits of its own clauses: written once to the shared folder
        ensure_checkpoint_dir(hits.sparkSession)
        hits, meta = hits.checkpoint(), meta.checkpoint()
    need = (meta.groupBy("query_id", "group_id")
            .agg(F.sum(F.when(F.col("occur") == "MUST", 1).otherwise(0)).alias("n_must")))
    result, below = None, None  # below: the groups of the level under this one, the only hits that are not leaves
    for d in range(max_depth, -1, -1):
        level = meta.where(F.col("depth") == d).select("query_id", "clause_id", "group_id", "occur")
        known = hits if below is None else hits.unionByName(below)
        child = known.join(bc(level), ["query_id", "clause_id"])
        agg = (child.groupBy("query_id", "group_id", "doc_id")
               # hits are unique per (query, clause, doc), so counting MUST rows counts clauses
               .agg(F.sum(F.when(F.col("occur") == "MUST", 1).otherwise(0)).alias("must_hit"),
                    F.max(F.when(F.col("occur") == "MUST_NOT", 1).otherwise(0)).alias("neg_hit"),
                    F.max(F.when(F.col("occur") == "SHOULD", 1).otherwise(0)).alias("should_hit"),
                    F.sum(F.when(F.col("occur") != "MUST_NOT", F.col("score")).otherwise(0.0)).alias("score"))
               .join(bc(need), ["query_id", "group_id"])
               .where((F.col("must_hit") == F.col("n_must")) & (F.col("neg_hit") == 0)
                      & ((F.col("n_must") > 0) | (F.col("should_hit") == 1))))
        if d == 0:
            result = agg.where(F.col("group_id") == 0).select("query_id", "doc_id", "score")
        else:
            boosts = meta.select("query_id", F.col("clause_id").alias("group_id"), F.col("boost").alias("gboost"))
            below = (agg.join(bc(boosts), ["query_id", "group_id"])
                     .select("query_id", F.col("group_id").alias("clause_id"), "doc_id",
                             (F.col("score") * F.col("gboost")).alias("score")))
    return result


def top_k(scored: DataFrame, k: int = 10, partition: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """Keep the k best documents per query: score desc, ties by doc id."""
    w = Window.partitionBy(*partition).orderBy(F.round("score", RANK_DECIMALS).desc(), F.col("doc_id").asc())
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(indexes: dict[str, Index], clauses: DataFrame, k: int = 10) -> DataFrame:
    """Answer a batch of queries over one or more indexes.

    Returns (query_id, index, rank, doc_id, score); one independent top-k list per
    (query, index). A query that is wrong on an index, or names one that is not loaded, has no
    list there (see :func:`validate_clauses` for the reasons). Document ids keep their type if
    all indexes have the same, else they are strings."""
    depths = clause_depths(clauses) if is_grouped(clauses) else None
    valid, _ = validate_clauses(clauses, list(indexes), depths)
    if depths is not None:
        valid = _null_safe_join(valid, depths, ["query_id", "index", "clause_id"], "inner")
    valid = _normalised(valid)
    mixed = len({index.docs.schema["doc_id"].dataType for index in indexes.values()}) > 1
    doc_id = F.col("doc_id").cast("string") if mixed else F.col("doc_id")
    results = []
    for name, index in indexes.items():  # static catalogue of indexes, not data
        c = valid.where(F.col("index") == name).cache()
        # facts about the (small) clause table in one job: size, kinds, nesting
        facts = c.agg(F.count(F.lit(1)).alias("n"), F.collect_set("kind").alias("kinds"),
                      F.max(F.when(F.col("group_id") != 0, 1).otherwise(0)).alias("grouped"),
                      F.max(F.when((F.col("kind") == "phrase") & (F.col("slop") > 0), 1).otherwise(0)).alias("sloppy")).first()
        kinds = set(facts["kinds"] or []) - {"group"}
        scored = evaluate_boolean(c, leaf_hits(index, c, kinds, bool(facts["sloppy"])), facts["n"], bool(facts["grouped"]))
        results.append(top_k(scored, k).select("query_id", F.lit(name).alias("index"), "rank", doc_id.alias("doc_id"), "score"))
    return reduce(DataFrame.unionByName, results)
