"""URL filtering by given rules and by mined association rules.

Given rules name a host and the beginning of a path; a rule fits its host and all subdomains,
and the longest that fits wins. Other urls are judged by rules that FP-growth mines from
labelled pages: a url becomes a set of tokens (labels of the host, segments of the path, names
of parameters, the scheme), the page's label is one token more, and combinations of tokens that
imply the label ``block`` with enough support and confidence become rules, unless fewer of the
tokens do so as surely. Labels are those of documents; a page has the label of the document
that it shows, whose number ends the path of its url. A rule must fit ``MIN_SUPPORT`` of the
labelled pages and ``MIN_ROWS`` bad ones at least: of a few pages a share of 0.6 is bad by
chance (a quarter is bad on the test tables; 5 of 8 by chance once in 37 combinations, 10 of 16 once in 600). A mined rule is listed in an inverted index under its rarest token;
urls meet it there and are then tested for its other tokens.

Defined results: a null url and one without :// have an empty host and path and no tokens, so
nothing fits and they are allowed; pages with no label, a null label or a null id, and labels by
document of pages whose path ends in no number, don't teach, a page labelled more than once is bad if any label is; rows that repeat an id are judged each by its
own url; without labels nothing is mined; an empty table gives no rows. Columns of the input that bear a
result's name are replaced.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise

#: host and path, verdict; fixed by the contract of the query
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
MIN_SUPPORT, MIN_CONFIDENCE = 0.002, 0.6
MIN_ROWS = 10  # labelled bad pages that a mined rule fits at least
MAX_TOKENS = 3  # of a mined rule
BLOCK = "label=block"


def host_of(url: str = "url") -> Column:
    host = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "://[^/?#]*([^?#]*)", 1)


def given_rule(rules: list[tuple[str, str]], host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):  # the longest is tested first
        at, _, rest = text.partition("/")
        fits = ((F.col(host) == at) | F.col(host).endswith(f".{at}")) & F.col(path).startswith(f"/{rest}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def document_of(url: str = "url") -> Column:
    """The id of the document that a page shows: the number that ends the path, as in /en/12, /en/12/ or /en/12.html; else null."""
    return F.regexp_extract(path_of(url), r"/([0-9]+)(?:\.[A-Za-z0-9]+)?/?\z", 1).try_cast("long")


def url_tokens(url: str = "url", host: str = "host", path: str = "path") -> Column:
    """The distinct tokens of a url; numbers in a path count as one token."""
    part = lambda text, cut, sign: F.transform(F.filter(F.split(text, cut), lambda x: x != ""), lambda x: F.concat(F.lit(sign), F.when(x.rlike("^[0-9]+$"), "#").otherwise(x)))
    query = F.regexp_extract(F.col(url), r"://[^?#]*\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("?"), F.substring_index(x, "=", 1)))
    scheme = F.array(F.concat(F.regexp_extract(F.col(url), "^([^:/?#]*)://", 1), F.lit(":")))
    known = F.col(url).contains("://")
    return F.when(known, F.array_distinct(F.concat(part(F.col(host), r"\.", "@"), part(F.lower(F.col(path)), r"[/._-]+", "/"), names, scheme))).otherwise(F.array().cast("array<string>"))


def mine(pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         min_rows: int = MIN_ROWS, on: str = "page_id") -> DataFrame:
    """(tokens, rarest, confidence, support) of the rules for ``block``. ``labels`` has bad and the id ``on``, as have ``pages``."""
    known = labels.where(f"{on} is not null and bad is not null").groupBy(on).agg(F.max(F.col("bad").cast("boolean")).alias("bad"))
    rows = (pages.where(f"{on} is not null").select(on, host_of().alias("host"), path_of().alias("path"), "url")
            .join(known, on).where("host <> ''").select(url_tokens().alias("tokens"), "bad"))
    rows = materialise(rows.select(F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BLOCK)))).otherwise(F.col("tokens")).alias("items")), "url-tokens")
    kind = "tokens array<string>, rarest string, confidence double, support double"
    n = rows.count()
    if n < max(1, min_rows):
        return pages.sparkSession.createDataFrame([], kind)
    support = max(min_support, (min_rows - 0.5) / n)  # half a row less, as FPGrowth rounds the rows up
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(rows)
    found = (model.associationRules.where((F.size("consequent") == 1) & F.array_contains("consequent", BLOCK) & (F.size("antecedent") <= MAX_TOKENS))
             .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"))
    # a rule goes if a part of it is as sure; parts are joined by their whole token list
    found = materialise(found, "url-rules")
    parts = (found.where(F.size("tokens") > 1).select(F.col("tokens").alias("whole"), F.col("confidence").alias("sure"), F.explode(_parts("tokens")).alias("tokens")))
    needless = parts.join(found, "tokens").where(F.col("confidence") >= F.col("sure")).select(F.col("whole").alias("tokens")).distinct()
    kept = found.join(needless, "tokens", "left_anti")
    freq = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rarest = (kept.select("tokens", F.explode("tokens").alias("token")).join(freq, "token")
              .groupBy("tokens").agg(F.min(F.struct("freq", "token"))["token"].alias("rarest")))
    return kept.join(rarest, "tokens").select("tokens", "rarest", "confidence", "support")


def _parts(tokens: str) -> Column:
    """All proper non-empty parts of a list of two or three tokens, in order."""
    t = F.col(tokens)
    singles = F.transform(t, lambda x: F.array(x))
    pairs = F.when(F.size(t) == 3, F.transform(t, lambda x: F.filter(t, lambda y: y != x))).otherwise(F.array().cast("array<array<string>>"))
    return F.concat(singles, pairs)


def blocked_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, mined): the urls that a mined rule fits, with the surest rule. ``urls`` has distinct url, host, path."""
    tokens = urls.select("url", url_tokens().alias("_has")).select("url", "_has", F.explode("_has").alias("rarest"))
    hits = tokens.join(rules, "rarest").where(F.forall("tokens", lambda t: F.array_contains(F.col("_has"), t)))
    best = F.max(F.struct("confidence", "support", F.array_join("tokens", " ").alias("text")))
    return hits.groupBy("url").agg(best["text"].alias("mined"))


def judge(pages: DataFrame, rules: DataFrame, given: list[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with host, path, rule (a given one), mined (a mined one) and verdict."""
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "mined", "verdict")]
    out = pages.select(*names, host_of().alias("host"), path_of().alias("path"))
    rule, verdict = given_rule(given)
    open_urls = out.where(rule.isNull() & (F.col("host") != "")).select("url", "host", "path").distinct()
    mined = blocked_urls(open_urls, rules).select(F.col("url").alias("_url"), "mined")
    out = out.withColumn("rule", rule).withColumn("verdict", verdict).join(mined, F.col("url") == F.col("_url"), "left")
    return out.select(*names, "host", "path", "rule", "mined",
                      F.coalesce("verdict", F.when(F.col("mined").isNotNull(), "block").otherwise("allow")).alias("verdict"))


def page_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, bad) from a labels table: low quality or toxic."""
    return labels.select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
