"""The registered queries of the training-data operators: thin digests of what the operators return."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (bpe, centroid_clusters, collocations, decontam, language_crf, line_dedup, near_dedup, pii, quality, sharding,
                        substring_dedup, token_files, url_rules)
from quarry.llm.common import shared_path
from quarry.sources.tables import read_table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents", ["doc_id", "text"]), read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    return quality.judge(docs, labels).select("doc_id", *quality.STATS, "base_failed", "kept", "rule")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = read_table(spark, sf_dir, "pages", ["page_id", "url"]), read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    rules = url_rules.mine(pages.withColumn("doc_id", url_rules.document_of()), url_rules.page_labels(labels), on="doc_id")
    return url_rules.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict", "mined")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    out = sharding.shard_records(docs, 8, shared_path(spark, "slot-map"))
    return out.select("doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "vslot", "next_shard")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return bpe.digests(bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents, one row for each with every item that it contains."""
    docs, items = read_table(spark, sf_dir, "documents", ["doc_id", "text"]), read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    return decontam.contaminated(docs, items).select("doc_id", "item_id", "n_words", "n_covered", "n_tiles", F.lit(False).alias("kept"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    token_files.write_tokens(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find_pii(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return out.select("doc_id", *(pii.count_kind("pii_base", k).alias(f"n_{k}") for k in pii.KINDS),
                      F.sha2(pii.listed(F.col("pii_base")), 256).alias("base_sha256"),
                      pii.listed(pii.in_order(F.concat("pii_base", "pii_added"))).alias("spans"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.cluster_vectors(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents", ["text", "lang"]))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_crf.identify(read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_quality_rules, op3_near_dedup, op4_url_filter, op5_sharding, op6_byte_bpe, op7_decontamination, op8_suffix_array_dedup, op9_token_files, op10_pii,
                                   op11_centroid_clusters, op12_collocations, op13_language_id)}


def _lloyd_sql(k: int = 8, rounds: int = 10) -> str:
    """Ten unrolled rounds; distance * k + number orders by distance, then number."""
    nearest = lambda r: (f"a{r} as materialized (select vec_id, min(d * {k} + c) as m from (select vec_id, c, sum((x - y) * (x - y))::bigint as d "  # noqa: E731
                         f"from v join c{r} using (i) group by vec_id, c) group by vec_id)")
    steps = [f"""c{r} as materialized (
  select c, i, coalesce((s - ((s % n) + n) % n) // n, y)::bigint as y from c{r - 1} left join (
    select m % {k} as c, i, sum(x)::bigint as s, count(*) as n from v join a{r - 1} using (vec_id) group by 1, 2) using (c, i)),
{nearest(r)}""" for r in range(1, rounds + 1)]
    return f"""
with kept as (
  select vec_id, embedding from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x::double))) = 64),
v as materialized (select vec_id, unnest(range(64)) as i, floor(1024 * unnest(embedding)::double)::bigint as x from kept),
firsts as (select vec_id, row_number() over (order by sha256('3:' || vec_id)) - 1 as c from kept qualify c < {k}),
c0 as materialized (select c, i, x as y from firsts join v using (vec_id)),
{nearest(0)},
{(',' + chr(10)).join(steps)},
spelled as (select c, sha256(string_agg(y::varchar, ',' order by i)) as centroid_sha256 from c{rounds} group by c),
sums as (select m % {k} as c, sum(m // {k})::bigint as cluster_inertia from a{rounds} group by 1)
select vec_id, c::int as cluster, m // {k} as distance, cluster_inertia, (select sum(m // {k})::bigint from a{rounds}) as inertia, centroid_sha256
from (select *, m % {k} as c from a{rounds}) join sums using (c) join spelled using (c)"""


ORACLES = {
    "op1_line_dedup": r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
  from documents),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
shared as (
  select k, max(doc_id) as last from keyed where length(k) >= 40 group by k having count(distinct doc_id) >= 5),
marked as (
  select l.doc_id, l.place, l.line, s.k is not null and l.doc_id <> s.last as gone
  from keyed l left join shared s on l.k = s.k)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
from marked group by doc_id""",
    "op3_near_dedup": r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w
  from documents),
shingles as (
  select distinct doc_id, s from (
    select doc_id, unnest(case when len(w) < 5 then [list_aggregate(w, 'string_agg', ' ')]
                               else list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) end) as s
    from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (
  select x, y from common join sizes p on x = p.doc_id join sizes q on y = q.doc_id
  where 100 * c >= 75 * (p.n + q.n - c)),
both_ways as (select x, y from links union all select y, x from links),
reach as (
  select doc_id, doc_id as node from documents
  union
  select r.doc_id, e.y from reach r join both_ways e on r.node = e.x),
tops as (select doc_id, min(node) as component_id from reach group by doc_id)
select t.doc_id, coalesce(n, 0) as n_shingles, component_id, t.doc_id = component_id as kept
from tops t left join sizes s on t.doc_id = s.doc_id""",
    "op8_suffix_array_dedup": r"""
with texts as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
sized as (select doc_id, h, length(h) // 2 as n from texts),
starts as (select doc_id, h, unnest(range(0, n - 99)) as place from sized where n >= 100),
strings as (select doc_id, place, md5(substr(h, 2 * place + 1, 200)) as s from starts),
covered as (
  select doc_id, place from strings
  qualify row_number() over (partition by s order by doc_id, place) > 1),
breaks as (
  select doc_id, place, coalesce(place - lag(place) over (partition by doc_id order by place) > 100, true) as new
  from covered),
numbered as (select doc_id, place, sum(new::int) over (partition by doc_id order by place) as span from breaks),
spans as (select doc_id, span, min(place) as lo, max(place) + 100 as hi from numbered group by doc_id, span),
edges as (
  select doc_id, coalesce(lag(hi) over (partition by doc_id order by lo), 0) as a, lo as b, 1 as is_span from spans
  union all
  select z.doc_id, coalesce(max(p.hi), 0), z.n, 0 from sized z left join spans p on z.doc_id = p.doc_id group by z.doc_id, z.n)
select e.doc_id, any_value(z.n) as n_bytes, any_value(z.n) - cast(sum(b - a) as bigint) as n_removed, cast(sum(is_span) as bigint) as n_spans,
       sha256(unhex(string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' order by a))) as kept_sha256
from edges e join sized z on e.doc_id = z.doc_id group by e.doc_id""",
    "op11_centroid_clusters": _lloyd_sql(),
    "op12_collocations": r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p
  from documents),
worded as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from pieces),
totals as (select lang, sum(len(w))::bigint as n from worded group by lang),
grams as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_aggregate(w[i:i + k - 1], 'string_agg', ' '))) as phrase
  from worded, (select unnest([1, 2, 3, 4, 5]) as k) where len(w) >= k),
f as materialized (select lang, k, phrase, count(*) as f from grams group by all having count(*) >= 100),
split as (select *, string_split(phrase, ' ') as w from f where k >= 2),
inner_phrases as (
  select lang, list_aggregate(w[lo:lo + z - 1], 'string_agg', ' ') as phrase, max(f) as most
  from split, (select unnest(range(2, 5)) as z), (select unnest(range(1, 5)) as lo) where z < k and lo + z - 1 <= k group by 1, 2),
kept as (select s.* from split s left join inner_phrases i using (lang, phrase) where i.most is null or 100 * i.most < 100 * s.f),
cuts as (
  select lang, phrase, f as a, cut, list_aggregate(w[1:cut], 'string_agg', ' ') as lhs, list_aggregate(w[cut + 1:], 'string_agg', ' ') as rhs
  from kept, (select unnest(range(1, 5)) as cut) where cut < k),
scored as (
  select c.lang, c.phrase, c.a, x.f as l, y.f as r, n, cut, ((1000::hugeint * c.a * n) // (x.f::hugeint * y.f))::bigint as score
  from cuts c join f x on x.lang = c.lang and x.phrase = c.lhs join f y on y.lang = c.lang and y.phrase = c.rhs join totals t on t.lang = c.lang),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from best qualify rank <= 2000""",
}
