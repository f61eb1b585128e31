"""Inverted index as DataFrames (and Parquet tables): postings, lengths, dictionary, stats.

Plan shape of :func:`build_index` (one wide shuffle):

    docs --unpivot fields--> (doc_id, field, text) --analyse--> tokens array
         --posexplode--> token rows --groupBy(field, term, doc_id)--> postings
    postings --groupBy(field, term)--> term_dict          (partial + final aggregate)
    token rows at position 0 -->       doc_len            (no shuffle, no second tokenising)
    doc_len  --groupBy(field)-->       field_stats        (tiny; broadcast at query time)

All tokens of a document sit in one input row, so the partial aggregate before the shuffle
already collapses repeated terms of a document: the shuffle carries postings, not tokens.
Document length travels on every posting (``dl``), so scoring never joins ``doc_len``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field as dc_field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.stemmer import stem_column_values
from quarry.session import written

ANALYZERS = {
    "letters": T.letter_tokens,
    "standard": T.standard_tokens,
    "whitespace": T.whitespace_tokens,
    "porter": T.whitespace_tokens,  # stemmed afterwards, once per distinct token
    "keyword": T.keyword_tokens,
}

# Analysers that lower-case; dictionary patterns (prefix, wildcard, ...) are normalised
# the same way but never stemmed.
LOWERCASING = {"letters", "standard"}


@dataclass
class Index:
    """A built (or loaded) index over one document collection."""

    name: str
    key: str
    analyzers: dict[str, str]
    default_fields: list[str]
    postings: DataFrame      # field, term, doc_id, tf, dl
    doc_len: DataFrame       # field, doc_id, dl
    term_dict: DataFrame     # field, term, df, ttf
    field_stats: DataFrame   # field, doc_count, sum_ttf, avgdl, n_terms
    docs: DataFrame          # stored fields, keyed by doc_id
    aliases: dict[str, str] = dc_field(default_factory=dict)
    tokens: DataFrame | None = None     # token rows (doc_id, field, dl, pos, term) when built on the fly
    positions: DataFrame | None = None  # occurrence table (field, term, doc_id, dl, pos) for phrases
    buckets: int = 0                    # stored tables: number of term buckets, a partition column
    lengths: DataFrame | None = None    # (field, dl) of every text, also of those without a token
    unstemmed: DataFrame | None = None  # token rows before stemming, if any field is stemmed
    dealt: DataFrame | None = None      # token rows of documents dealt by id, for what groups all of them by document
    deal: Callable[[int], DataFrame] | None = None  # unstemmed token rows of documents dealt by id to so many tasks
    _stats: DataFrame | None = None

    def analyzer(self, field: str) -> str:
        return self.analyzers.get(field, self.analyzers.get("*", "porter"))

    def vocabulary(self) -> DataFrame:
        """Distinct (field, term). From token rows this is a cheap distinct (partial
        aggregation collapses repeats before the shuffle); no postings are built."""
        if self.tokens is not None:
            return self.tokens.select("field", "term").distinct()
        return self.term_dict.select("field", "term")

    def length_stats(self) -> DataFrame:
        """(field, doc_count, avgdl) for BM25, from document lengths only."""
        if self.lengths is not None:
            if self._stats is None:  # one row per field, read by every kind of clause
                some = F.col("dl") > 0
                self._stats = written(self.lengths.groupBy("field").agg(F.count_if(some).alias("doc_count"), F.sum("dl").alias("n")).where("doc_count > 0")
                                      .select("field", "doc_count", (F.col("n") / F.col("doc_count")).alias("avgdl")), "length-stats")
            return self._stats
        return self.field_stats.select("field", "doc_count", "avgdl")


def unpivot_fields(docs: DataFrame, key: str, fields: dict[str, Column]) -> DataFrame:
    """(key, f1, f2, ...) -> one row per (doc_id, field, text); null texts dropped."""
    pairs = F.array(*[F.struct(F.lit(name).alias("field"), expr.cast("string").alias("text"))
                      for name, expr in fields.items()])
    return (docs.select(F.col(key).alias("doc_id"), F.explode(pairs).alias("f"))
            .select("doc_id", F.col("f.field").alias("field"), F.col("f.text").alias("text"))
            .where(F.col("text").isNotNull()))


def analyze_column(field_col: Column, text_col: Column, analyzers: dict[str, str]) -> Column:
    """Per-field analyser dispatch with a catch-all default (``'*'``)."""
    default = analyzers.get("*", "porter")
    expr = None
    for name, an in analyzers.items():
        if name == "*":
            continue
        branch = ANALYZERS[an](text_col)
        expr = F.when(field_col == name, branch) if expr is None else expr.when(field_col == name, branch)
    fallback = ANALYZERS[default](text_col)
    return fallback if expr is None else expr.otherwise(fallback)


def token_rows(field_texts: DataFrame, analyzers: dict[str, str]) -> DataFrame:
    """(doc_id, field, text) -> (doc_id, field, dl, pos, term), not stemmed yet."""
    toks = field_texts.select(
        "doc_id", "field", analyze_column(F.col("field"), F.col("text"), analyzers).alias("tokens"))
    return explode_tokens(toks, ["doc_id", "field"])


def is_stemmed(analyzers: dict[str, str]) -> bool:
    return "porter" in [*analyzers.values(), analyzers.get("*", "porter")]


#: documents that a task gets when they are dealt by id
DOCS_PER_TASK = 10_000


def dealt_by(docs: DataFrame, key: str) -> DataFrame:
    """Documents hash-partitioned by their key, a bounded number each: what is grouped by document (and more)
    later is not exchanged again, so their texts travel, not a row for each token."""
    n = max(docs.sparkSession.sparkContext.defaultParallelism, -(-docs.select(key).count() // DOCS_PER_TASK))
    return docs.repartition(n, key)


def explode_tokens(toks: DataFrame, keys: list[str], tokens: str = "tokens") -> DataFrame:
    """(keys..., tokens array) -> (keys..., dl, pos, term), one row per token occurrence.

    ``posexplode_outer`` + a null filter instead of ``posexplode``: for the latter the
    optimizer infers a ``size(tokens) > 0`` filter below the projection and evaluates the
    tokenizer twice per text."""
    return (toks.select(*keys, F.size(tokens).alias("dl"), F.posexplode_outer(tokens).alias("pos", "term"))
            .where(F.col("term").isNotNull()))


def stemmed_field(analyzers: dict[str, str]) -> Column:
    default = analyzers.get("*", "porter")
    explicit = {f: a for f, a in analyzers.items() if f != "*"}
    non_porter = [f for f, a in explicit.items() if a != "porter"]
    porter_named = [f for f, a in explicit.items() if a == "porter"]
    if default == "porter":
        return ~F.col("field").isin(non_porter) if non_porter else F.lit(True)
    return F.col("field").isin(porter_named)


def apply_stemming(rows: DataFrame, analyzers: dict[str, str]) -> DataFrame:
    """Replace ``term`` by its Porter stem on stemmed fields.

    The stemmer runs once per *distinct* token and is joined back on the token, never once per
    occurrence.
    """
    rows = rows.withColumn("_stem", stemmed_field(analyzers))
    vocab = rows.where("_stem").select("term").distinct()
    stems = stem_column_values(vocab, "term", "stem")
    stemmed = (rows.where("_stem").join(stems, "term", "left")
               .withColumn("term", F.coalesce("stem", "term")).drop("stem"))
    return stemmed.unionByName(rows.where(~F.col("_stem"))).drop("_stem")


def postings_from_tokens(tok: DataFrame) -> DataFrame:
    """(field, term, doc_id) -> tf and document length. Positions are not aggregated into
    arrays: phrase queries read the occurrence table (one row per token) for their terms
    only, so BM25 never carries positions and frequent terms never build huge arrays."""
    return tok.groupBy("field", "term", "doc_id").agg(F.count(F.lit(1)).alias("tf"), F.max("dl").alias("dl"))


def position_lists(positions: DataFrame) -> DataFrame:
    """Occurrence rows -> (field, term, doc_id, positions) sorted position lists (AGG2)."""
    return positions.groupBy("field", "term", "doc_id").agg(F.sort_array(F.collect_list("pos")).alias("positions"))


def term_dictionary(postings: DataFrame) -> DataFrame:
    return postings.groupBy("field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf"))


def field_statistics(doc_len: DataFrame, term_dict: DataFrame) -> DataFrame:
    lens = doc_len.groupBy("field").agg(F.count(F.lit(1)).alias("doc_count"), F.sum("dl").alias("sum_ttf"))
    terms = term_dict.groupBy("field").agg(F.count(F.lit(1)).alias("n_terms"))
    return (lens.join(terms, "field", "left")
            .select("field", "doc_count", "sum_ttf",
                    (F.col("sum_ttf") / F.col("doc_count")).alias("avgdl"),
                    F.coalesce("n_terms", F.lit(0)).alias("n_terms")))


def build_index(name: str, docs: DataFrame, key: str, fields: dict[str, Column],
                analyzers: dict[str, str], default_fields: list[str],
                with_positions: bool = True, aliases: dict[str, str] | None = None) -> Index:
    """Build all index tables for ``docs`` lazily (nothing runs until an action)."""
    field_texts = unpivot_fields(docs, key, fields)
    raw = token_rows(field_texts, analyzers)
    stem = is_stemmed(analyzers)
    tok = apply_stemming(raw, analyzers) if stem else raw
    dealt = tok if stem else token_rows(unpivot_fields(dealt_by(docs, key), key, fields), analyzers)
    postings = postings_from_tokens(dealt)
    lengths = field_texts.select("field", F.size(analyze_column(F.col("field"), F.col("text"), analyzers)).alias("dl"))
    # every (doc, field) with at least one token has exactly one row at position 0
    doc_len = raw.where(F.col("pos") == 0).select("doc_id", "field", "dl")
    term_dict = term_dictionary(postings)
    stats = field_statistics(doc_len, term_dict)
    stored = docs.withColumnRenamed(key, "doc_id") if key != "doc_id" else docs
    return Index(name, key, dict(analyzers), list(default_fields), postings, doc_len, term_dict,
                 stats, stored, dict(aliases or {}), tok,
                 tok.select("field", "term", "doc_id", "dl", "pos") if with_positions else None,
                 lengths=lengths, unstemmed=raw if stem else None, dealt=dealt,
                 deal=lambda n: token_rows(unpivot_fields(docs.repartition(n, key), key, fields), analyzers))


def bucket_of(term: Column, buckets: int) -> Column:
    """Partition of a term in the stored tables."""
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def match_terms(index: Index, rows: DataFrame, side: DataFrame, bounded: bool) -> DataFrame:
    """Rows of an index table (postings, occurrences, dictionary) joined with a query side on (field, term).

    The stored tables are partitioned by field and term bucket. The join is on the bucket, too, and a
    broadcast side then prunes partitions at run time (dynamic partition pruning, which Catalyst only
    plans for a side with a predicate: the one on the bucket), so that only the files of the query terms'
    buckets are read."""
    keys = ["field", "term"]
    if index.buckets:
        side = side.withColumn("bucket", bucket_of(F.col("term"), index.buckets)).where(F.col("bucket") >= 0)
        keys = ["field", "bucket", "term"]
    return rows.join(F.broadcast(side) if bounded else side, keys)


def postings_for_terms(index: Index, terms: DataFrame, bounded: bool) -> DataFrame:
    """The postings that a query side can match.

    For an index built on the fly the query terms are joined to the token rows *before*
    the aggregation, so only matching occurrences are grouped (no full postings build).
    A stored index's postings stay as they are: :func:`match_terms` prunes them."""
    if index.tokens is None:
        return index.postings
    return written(postings_from_tokens(tokens_for_terms(index, terms, bounded)), "matched-postings")


def dealt_postings_for_terms(index: Index, terms: DataFrame, tasks: int) -> DataFrame:
    """As :func:`postings_for_terms` for a bounded query side, hash-partitioned by document into so many tasks. The
    documents are dealt before they are tokenised, so their texts are exchanged, once, and postings neither exchanged nor written."""
    return postings_from_tokens(tokens_for_terms(index, terms, True, index.deal(tasks)))


def tokens_for_terms(index: Index, terms: DataFrame, bounded: bool, rows: DataFrame | None = None) -> DataFrame:
    """Token rows (of ``rows``, unstemmed, else of the whole index) of the query side's terms. On stemmed fields the distinct tokens are stemmed and those with
    a stem of the query side are joined to the occurrences, broadcast if their number allows it, so that
    occurrences of other words are not exchanged."""
    keys = terms.select("field", "term").distinct()
    if index.unstemmed is None:
        return (index.tokens if rows is None else rows).join(F.broadcast(keys) if bounded else keys, ["field", "term"])
    stemmed = stemmed_field(index.analyzers)
    vocab = index.unstemmed.where(stemmed).select("term").distinct()
    # written, as a join on the stem itself would repeat its long expression in filters
    stems = written(stem_column_values(vocab, "term", "stem"), "stems").select(F.col("term").alias("token"), F.coalesce("stem", "term").alias("term"))
    forms = keys.where(stemmed).join(stems, "term").select("field", "token", "term").unionByName(
        keys.where(~stemmed).select("field", F.col("term").alias("token"), "term"))
    forms = written(forms, "query-forms")
    forms = F.broadcast(forms) if forms.count() <= FORMS_MAX_ROWS else forms
    return (index.unstemmed if rows is None else rows).withColumnRenamed("term", "token").join(forms, ["field", "token"]).drop("token")


def positions_for_terms(index: Index, side: DataFrame, bounded: bool) -> DataFrame:
    """Occurrences (field, term, doc_id, dl, pos) of the query side's terms, beside its columns; those of an index
    built on the fly are written once, several kinds of phrases read them."""
    if index.positions is None:
        raise ValueError("phrase clauses need an index built with positions")
    rows = index.positions
    if index.tokens is not None:
        rows = written(tokens_for_terms(index, side, bounded).select("field", "term", "doc_id", "dl", "pos"), "matched-positions")
    return match_terms(index, rows, side, bounded)


#: most (field, token, stem) rows that are broadcast to the occurrences
FORMS_MAX_ROWS = 500_000


TERM_BUCKETS = 64


def write_index(index: Index, path: str, rebuild: bool = True, buckets: int = TERM_BUCKETS) -> None:
    """Persist the index as Parquet tables (SNK2-SNK4).

    ``rebuild=True`` replaces an existing index (overwrite); otherwise the write fails
    when the index exists. The tables by term are partitioned by field and term bucket
    (``buckets`` of them; more for larger corpora) and sorted by term inside each file. The corpus is
    tokenised once: the occurrences are written first, if the index has positions, else the
    postings; everything else is derived from what is written (which also cuts the lineage if
    an executor is lost)."""
    mode = "overwrite" if rebuild else "errorifexists"
    spark = index.docs.sparkSession

    def write(table: DataFrame, name: str, *order: str) -> DataFrame:
        # range partitioning: files hold contiguous term ranges and a hot term's rows are split over many
        # files by doc_id instead of landing in one task as a hash on the term would do
        keyed = table.withColumn("bucket", bucket_of(F.col("term"), buckets))
        by = ["field", "bucket", "term", *order]
        (keyed.repartitionByRange(*by[:4]).sortWithinPartitions(*by)
         .write.mode(mode).partitionBy("field", "bucket").parquet(f"{path}/{name}"))
        return spark.read.parquet(f"{path}/{name}")

    postings = index.postings
    if index.positions is not None:
        postings = postings_from_tokens(write(index.positions, "positions", "doc_id", "pos"))
    stored = write(postings, "postings", "doc_id")
    write(term_dictionary(stored), "term_dict")
    doc_len = stored.groupBy("field", "doc_id").agg(F.max("dl").alias("dl"))
    doc_len.write.mode(mode).partitionBy("field").parquet(f"{path}/doc_len")
    field_statistics(spark.read.parquet(f"{path}/doc_len"), spark.read.parquet(f"{path}/term_dict")) \
        .write.mode(mode).parquet(f"{path}/field_stats")
    index.docs.write.mode(mode).parquet(f"{path}/docs")
    meta = spark.createDataFrame(
        [(index.name, index.key, f, a) for f, a in index.analyzers.items()]
        + [(index.name, index.key, f"@default:{f}", "") for f in index.default_fields]
        + [(index.name, index.key, f"@alias:{a}", t) for a, t in index.aliases.items()]
        + [(index.name, index.key, "@buckets", str(buckets)), (index.name, index.key, "@positions", str(index.positions is not None))],
        "index string, key string, field string, analyzer string")
    meta.coalesce(1).write.mode(mode).parquet(f"{path}/meta")


def read_index(spark: SparkSession, path: str) -> Index:
    meta = spark.read.parquet(f"{path}/meta").collect()  # a handful of configuration rows
    analyzers, defaults, aliases, facts = {}, [], {}, {}
    name, key = meta[0]["index"], meta[0]["key"]
    for r in meta:
        if r["field"].startswith("@default:"):
            defaults.append(r["field"][len("@default:"):])
        elif r["field"].startswith("@alias:"):
            aliases[r["field"][len("@alias:"):]] = r["analyzer"]
        elif r["field"].startswith("@"):
            facts[r["field"]] = r["analyzer"]
        else:
            analyzers[r["field"]] = r["analyzer"]
    table = lambda t: spark.read.parquet(f"{path}/{t}")
    return Index(name, key, analyzers, defaults, table("postings"), table("doc_len"), table("term_dict"), table("field_stats"), table("docs"),
                 aliases, None, table("positions") if facts["@positions"] == "True" else None, int(facts["@buckets"]))


def index_statistics(index: Index, fields: list[str] | None = None) -> DataFrame:
    """Documents per index and distinct terms per field (AGG6-AGG8).

    Fields listed in ``fields`` but holding no term are kept with ``n_terms = 0``
    (reported as "none" by the reference)."""
    spark = index.docs.sparkSession
    n_docs = index.docs.agg(F.count(F.lit(1)).alias("num_docs"))
    stats = index.field_stats.select("field", "n_terms", "doc_count", "sum_ttf")
    if fields:
        wanted = spark.createDataFrame([(f,) for f in fields], "field string")
        stats = wanted.join(stats, "field", "left").fillna(0, ["n_terms", "doc_count", "sum_ttf"])
    return stats.crossJoin(F.broadcast(n_docs)).select(
        F.lit(index.name).alias("index"), "field", "num_docs", "doc_count", "n_terms", "sum_ttf")


def approx_terms_per_field(index: Index, rsd: float = 0.01) -> DataFrame:
    """Distinct terms per field estimated from raw token rows with HyperLogLog++
    (``approx_count_distinct``): one pass, no dictionary build (AGG7 on raw tokens).
    Exact counts come from ``field_stats.n_terms``."""
    rows = index.tokens if index.tokens is not None else index.postings
    return rows.groupBy("field").agg(F.approx_count_distinct("term", rsd).alias("approx_terms"))
