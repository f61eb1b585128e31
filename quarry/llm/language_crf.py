"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a language; the chain's transitions say how likely a language goes on
or gives way to another inside a text, so that code-switched texts keep their parts. A word's
score for a language is the sum of hashed features (affixes and character n-grams of the word
between boundary marks, and the word itself) and of a lexicon feature: the logarithm of the
language's share among the word's occurrences, with a learned weight for each range of the
occurrences' number. Forward-backward gives each word's probabilities; a text's language is the
one with the most probability over its letters, the score is its share.

* The lexicon counts all words of all documents to learn from, in ``BUCKETS`` buckets by the
  word's hash: a table of fixed size for each language.
* Weights are fitted on a bounded sample: at most ``PER_LANG`` distinct texts of a language and
  ``PER_TEXT`` runs of ``RUN`` words of a text, both chosen by hash. Runs of all languages follow
  one another in the training chains, so that switches are learned; a training word's own
  occurrence does not count for its lexicon feature. ``SHARDS`` shards train from the same
  weights, which are averaged ``ROUNDS`` times.
* Prediction is exact on whole texts of any length: long texts are cut in blocks, whose products
  of transfer matrices join them.

Learned weights and the lexicon are what is broadcast; both are of fixed size for each language.
Hot sources or repeated texts make no task larger, as rows are never dealt by their values.

Defined results: ``und`` and a score of 0 for a null text, one without letters, and for all
texts if there is nothing to learn from; equal probabilities go to the language that sorts
first; a null id is never learned from and counts as held out; repeated rows give equal rows;
an empty table gives no rows. Only doc_id, text and, of documents to learn from, lang are read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import arrow_rows, materialise, slices

UNKNOWN = "und"
BUCKETS, FEATURES = 2**18, 2**17
SLICE = 2**12  # buckets of the lexicon that a task fills at a time
PER_LANG, PER_TEXT, RUN = 500, 8, 16
SHARDS, ROUNDS, EPOCHS = 8, 4, 2
CHAIN, BATCH, RATE, DECAY = 32, 64, 0.4, 1e-5
LONGEST_GRAM = 5
RANGES = np.array([1, 3, 10, 100])  # of a word's number of occurrences in the lexicon
BLOCK = 64
WORDS_KEPT = 300_000  # words whose scores a worker remembers, a speed bound only

_WORD = re.compile(r"[^\W\d_]+")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    found = _WORD.findall(text.lower()) if text else []
    return found if not text or text.isascii() else [w for w in found if w.isascii() or any(map(str.isalpha, w))]


def bucket(words: list[str]) -> np.ndarray:
    of = xxhash.xxh3_64_intdigest
    return (np.fromiter((of(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words)) % np.uint64(BUCKETS)).astype(np.int64)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature ids, number of each word's features), word by word."""
    marked = "".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(marked, "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    at, end = np.arange(len(codes)), np.repeat(ends, sizes)
    edge = (at == end - sizes[owner])
    ids, owners = [], []
    h = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, LONGEST_GRAM + 1):
        fits = at + n <= end
        h[fits] = (h[fits] ^ codes[at[fits] + n - 1]) * _MIX[0]
        h ^= h >> np.uint64(31)
        use = fits if n < LONGEST_GRAM else fits & (edge | (at + n == end))  # the longest: affixes only
        ids.append(((h[use] * _MIX[1]) >> np.uint64(40)) % np.uint64(FEATURES))
        owners.append(owner[use])
    whole = bucket(words).astype(np.uint64) * _MIX[1] >> np.uint64(40)
    ids.append(whole % np.uint64(FEATURES))
    owners.append(np.arange(len(words)))
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(ids)[order].astype(np.int64), np.bincount(owners, minlength=len(words))


@dataclass
class Model:
    """Weights (features x languages), transitions, weight of the lexicon feature by range, and the lexicon."""

    langs: list[str]
    weights: np.ndarray
    moves: np.ndarray
    trust: np.ndarray
    lexicon: np.ndarray  # buckets x languages

    def shares(self, buckets: np.ndarray, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(log of each language's share against an even one, range) of the words in these buckets."""
        counts = self.lexicon[buckets].astype(np.float64)
        if own is not None:
            counts = np.maximum(counts - own, 0)
        total = counts.sum(axis=1)
        n = len(self.langs)
        return np.log((counts + 0.5) * n / (total + 0.5 * n)[:, None]), np.searchsorted(RANGES, total, side="right")

    def scores(self, words: list[str]) -> np.ndarray:
        """Words x languages."""
        ids, sizes = word_features(words)
        starts = np.cumsum(sizes) - sizes
        out = np.add.reduceat(self.weights[ids].astype(np.float64), starts, axis=0) / np.sqrt(sizes)[:, None]
        log_share, span = self.shares(bucket(words))
        return out + log_share * self.trust[span][:, None]


def marginals(scores: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Each word's probabilities of the languages, words x languages; ``sizes`` are the chains' lengths, none 0."""
    n_labels, go = scores.shape[1], np.exp(moves)
    unit = np.exp(scores - scores.max(axis=1, keepdims=True))
    per_chain = -(-sizes // BLOCK)
    first = np.cumsum(per_chain) - per_chain
    chain = np.repeat(np.arange(len(sizes)), per_chain)
    nth = np.arange(len(chain)) - first[chain]
    length = np.minimum(BLOCK, sizes[chain] - nth * BLOCK)
    begin = (np.cumsum(sizes) - sizes)[chain] + nth * BLOCK
    order = np.argsort(-length, kind="stable")
    running = [int(np.searchsorted(-length[order], -t, side="left")) for t in range(BLOCK + 1)]  # blocks with more than t words
    entry = (nth == 0)[order]

    def step(t: int, live: int) -> np.ndarray:
        return unit[begin[order[:live]] + t]

    enter, leave = np.ones((len(chain), n_labels)), np.ones((len(chain), n_labels))
    if per_chain.max() > 1:  # transfer matrices of the blocks of longer chains, then from block to block
        many = (per_chain > 1)[chain[order]]
        at = np.flatnonzero(many)
        transfer = np.broadcast_to(np.eye(n_labels), (len(at), n_labels, n_labels)).copy()
        for t in range(BLOCK):
            live = int(np.searchsorted(at, running[t]))
            if not live:
                break
            now = transfer[:live] @ go
            if t == 0:
                now[entry[at[:live]]] = transfer[:live][entry[at[:live]]]
            now *= unit[begin[order[at[:live]]] + t][:, None, :]
            transfer[:live] = now / now.max(axis=(1, 2), keepdims=True)
        of = np.full(len(chain), -1)
        of[order[at]] = np.arange(len(at))
        for j in range(1, int(per_chain.max())):
            b = first[per_chain > j] + j
            v = np.einsum("bi,bij->bj", enter[b - 1], transfer[of[b - 1]])
            enter[b] = v / v.max(axis=1, keepdims=True)
        for j in range(int(per_chain.max()) - 1, 0, -1):
            b = first[per_chain > j] + j
            v = np.einsum("bij,bj->bi", transfer[of[b]], leave[b])
            leave[b - 1] = v / v.max(axis=1, keepdims=True)
    out = np.empty_like(unit)
    now = enter[order]
    for t in range(BLOCK):
        live = running[t]
        if not live:
            break
        v = now[:live] @ go
        if t == 0:
            v[entry[:live]] = now[:live][entry[:live]]
        v *= step(t, live)
        now[:live] = v / v.sum(axis=1, keepdims=True)
        out[begin[order[:live]] + t] = now[:live]
    back = leave[order]
    for t in range(BLOCK - 1, -1, -1):
        live, on = running[t], running[t + 1]
        if not live:
            continue
        if on:  # the blocks that have a word after this one
            v = (back[:on] * step(t + 1, on)) @ go.T
            back[:on] = v / v.max(axis=1, keepdims=True)
        places = begin[order[:live]] + t
        both = out[places] * back[:live]
        out[places] = both / both.sum(axis=1, keepdims=True)
    return out


def _learn_from() -> Column:
    return F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def count_words(docs: DataFrame) -> DataFrame:
    """(bucket, lang, n) over all words of (text, lang)."""
    schema = pa.schema([("bucket", pa.int32()), ("lang", pa.string()), ("n", pa.int64())])

    def flush(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, seen in held.items():
            sums = np.bincount(bucket(list(seen)), np.fromiter(seen.values(), np.float64, len(seen)), BUCKETS)
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([lang] * len(at), pa.string()), pa.array(sums[at].astype(np.int64))], schema=schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for part in slices(batch, 0):
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    held[lang].update(words_of(text))
                if sum(map(len, held.values())) > WORDS_KEPT:
                    yield from flush(held)
                    held.clear()
        yield from flush(held)

    return docs.select("text", "lang").mapInArrow(rows, "bucket int, lang string, n long").groupBy("bucket", "lang").agg(F.sum("n").alias("n"))


def dense_lexicon(counts: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages and their counts, buckets x languages. Tasks fill slices of the table, of fixed size for each
    language; the driver puts them together."""
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    number = {lang: k for k, lang in enumerate(langs)}
    schema = pa.schema([("slice", pa.int32()), ("counts", pa.binary())])

    def fill(part: pa.Table) -> pa.Table:
        nth = part.column("slice")[0].as_py()
        out = np.zeros((SLICE, len(number)), dtype=np.int64)
        out[part.column("bucket").to_numpy() - nth * SLICE, [number[x] for x in part.column("lang").to_pylist()]] = part.column("n").to_numpy()
        return pa.table({"slice": [nth], "counts": [out.tobytes()]}, schema=schema)

    lexicon = np.zeros((BUCKETS, len(langs)), dtype=np.int64)
    sliced = counts.withColumn("slice", F.floor(F.col("bucket") / SLICE).cast("int"))
    for r in sliced.groupBy("slice").applyInArrow(fill, "slice int, counts binary").collect():
        lexicon[r.slice * SLICE: (r.slice + 1) * SLICE] = np.frombuffer(r.counts, np.int64).reshape(SLICE, -1)
    return langs, lexicon


def training_runs(docs: DataFrame) -> DataFrame:
    """(shard, key, lang, words) of the sample to fit on; words joined by spaces."""
    hashed = docs.withColumn("h", F.xxhash64("text")).where("text is not null")
    rank = Window.partitionBy("lang").orderBy("h")
    chosen = hashed.select("lang", "h").distinct().withColumn("_n", F.row_number().over(rank)).where(F.col("_n") <= PER_LANG).drop("_n")
    texts = hashed.join(F.broadcast(chosen), ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"])  # PER_LANG rows of a language
    schema = pa.schema([("shard", pa.int32()), ("key", pa.int64()), ("lang", pa.string()), ("words", pa.string())])

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for part in slices(batch, 0):
            for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                found = words_of(text)
                runs = [" ".join(found[k: k + RUN]) for k in range(0, len(found), RUN)]
                keyed = sorted((xxhash.xxh3_64_intdigest(r.encode("utf-8", "surrogatepass")) >> 1, r) for r in set(runs))
                yield from ((key % SHARDS, key, lang, run) for key, run in keyed[:PER_TEXT])

    return texts.select("text", "lang").mapInArrow(lambda b: arrow_rows(b, schema, rows), "shard int, key long, lang string, words string")


def train_shard(model: Model, runs: list[tuple[int, str, str]], seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """New (weights, moves, trust) after ``EPOCHS`` passes of AdaGrad over chains of (key, lang, words) runs."""
    rng, n = np.random.default_rng(seed), len(model.langs)
    number: defaultdict[str, int] = defaultdict(count().__next__)
    label = {lang: k for k, lang in enumerate(model.langs)}
    cut = [(np.fromiter(map(number.__getitem__, ws := w.split(" ")), np.int64, len(ws)), label[lang]) for _, lang, w in sorted(runs)]
    words = list(number)
    ids, sizes = word_features(words)
    starts, buckets, scale = np.cumsum(sizes) - sizes, bucket(words), 1 / np.sqrt(sizes)
    weights, moves, trust = model.weights.astype(np.float64), model.moves.copy(), model.trust.copy()
    seen = [np.full_like(weights, 1.0), np.full_like(moves, 1.0), np.full_like(trust, 1.0)]
    eye = np.eye(n)
    for _ in range(EPOCHS):
        some = [cut[k] for k in rng.permutation(len(cut))]
        stream, labels = np.concatenate([w for w, _ in some]), np.concatenate([np.full(len(w), y) for w, y in some])
        short = -len(stream) % CHAIN  # the last chain goes round to the first words
        stream, labels = np.resize(stream, len(stream) + short), np.resize(labels, len(labels) + short)
        for lo in range(0, len(stream), CHAIN * BATCH):
            w, y = stream[lo: lo + CHAIN * BATCH], eye[labels[lo: lo + CHAIN * BATCH]]
            distinct, which = np.unique(w, return_inverse=True)
            own = sizes[distinct]
            flat = ids[np.repeat(starts[distinct], own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)]
            base = np.add.reduceat(weights[flat], np.cumsum(own) - own, axis=0) * scale[distinct][:, None]
            log_share, span = model.shares(buckets[w], y)
            score = base[which] + log_share * trust[span][:, None]
            prob, pairs = _chain_expectations(score.reshape(-1, CHAIN, n), moves)
            miss = y - prob.reshape(-1, n)
            by_word = np.stack([np.bincount(which, miss[:, k], len(distinct)) for k in range(n)], axis=1) * scale[distinct][:, None]
            spread = np.repeat(by_word, own, axis=0)
            step = np.stack([np.bincount(flat, spread[:, k], FEATURES) for k in range(n)], axis=1) - DECAY * weights
            z = y.reshape(-1, CHAIN, n)
            pull = np.einsum("bti,btj->ij", z[:, :-1], z[:, 1:]) - pairs
            lean = np.bincount(span, (miss * log_share).sum(axis=1), len(trust))
            for value, gradient, sums in zip((weights, moves, trust), (step, pull, lean), seen):
                sums += gradient * gradient
                value += RATE * gradient / np.sqrt(sums)
    return weights, moves, trust


def _chain_expectations(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probabilities, expected number of each transition) of chains of one length, chains x words x languages."""
    go, unit = np.exp(moves), np.exp(scores - scores.max(axis=2, keepdims=True))
    ahead, back, norm = np.empty_like(unit), np.ones_like(unit), np.empty(unit.shape[:2] + (1,))
    for t in range(unit.shape[1]):
        v = unit[:, t] * (ahead[:, t - 1] @ go if t else 1)
        norm[:, t] = v.sum(axis=1, keepdims=True)
        ahead[:, t] = v / norm[:, t]
    for t in range(unit.shape[1] - 2, -1, -1):
        back[:, t] = (unit[:, t + 1] * back[:, t + 1]) @ go.T / norm[:, t + 1]
    pairs = np.einsum("bti,btj->ij", ahead[:, :-1], unit[:, 1:] * back[:, 1:] / norm[:, 1:]) * go
    prob = ahead * back
    return prob / prob.sum(axis=2, keepdims=True), pairs


def learn(docs: DataFrame) -> Model | None:
    """The model of (text, lang) rows; None if they hold no word of any language."""
    spark = docs.sparkSession
    langs, lexicon = dense_lexicon(materialise(count_words(docs), "lexicon"))
    if not langs:
        return None
    model = Model(langs, np.zeros((FEATURES, len(langs)), np.float32), np.eye(len(langs)), np.full(len(RANGES) + 1, 0.5), lexicon)
    runs = materialise(training_runs(docs), "runs")
    for turn in range(ROUNDS):
        sent = spark.sparkContext.broadcast(model)

        def train(table: pa.Table) -> pa.Table:
            rows = list(zip(*(table.column(c).to_pylist() for c in ("key", "lang", "words"))))
            parts = train_shard(sent.value, rows, turn)
            return pa.table({"n": [len(rows)], "state": [b"".join(p.astype(np.float32).tobytes() for p in parts)]}, schema=pa.schema([("n", pa.int64()), ("state", pa.binary())]))

        got = runs.groupBy("shard").applyInArrow(train, "n long, state binary").collect()  # SHARDS states
        total = sum(r.n for r in got)
        mean = sum(np.frombuffer(r.state, np.float32).astype(np.float64) * (r.n / total) for r in sorted(got, key=lambda r: (r.n, r.state)))
        n = len(langs)
        weights, moves, trust = np.split(mean, [FEATURES * n, FEATURES * n + n * n])
        model = Model(langs, weights.reshape(-1, n).astype(np.float32), moves.reshape(n, n), trust, lexicon)
        sent.destroy()
    return model


def predict_texts(model: Model, texts: list[str | None], known: dict) -> list[tuple[str, float]]:
    """(language, score) of each text; ``known`` remembers words' scores between calls."""
    if not known or len(known["number"]) > WORDS_KEPT:
        known.update(number=defaultdict(count().__next__), scores=np.empty((0, len(model.langs))))
    number, had = known["number"], len(known["scores"])
    ids = [np.fromiter(map(number.__getitem__, ws := words_of(t)), np.int64, len(ws)) for t in texts]
    if len(number) > had:
        known["scores"] = np.concatenate([known["scores"], model.scores(list(number)[had:])])
        known["letters"] = np.fromiter(map(len, number), np.float64, len(number))
    out = [(UNKNOWN, 0.0)] * len(texts)
    full = [k for k, x in enumerate(ids) if len(x)]
    if full:
        sizes = np.array([len(ids[k]) for k in full])
        flat = np.concatenate([ids[k] for k in full])
        prob = marginals(known["scores"][flat], sizes, model.moves) * known["letters"][flat][:, None]
        sums = np.add.reduceat(prob, np.cumsum(sizes) - sizes, axis=0)
        best, top = sums.argmax(axis=1), sums.max(axis=1) / sums.sum(axis=1)
        for k, b, s in zip(full, best.tolist(), top.tolist()):
            out[k] = (model.langs[b], min(1.0, s))
    return out


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) of each row's whole text."""
    if model is None:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def all_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for part in slices(batch, 1):
                for doc_id, found in zip(part.column(0).to_pylist(), predict_texts(sent.value, part.column(1).to_pylist(), known)):
                    yield doc_id, *found

        return arrow_rows(batches, schema, rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(all_rows, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of all documents, by a model of those that are not held out."""
    model = learn(docs.where(_learn_from()).select("text", "lang"))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
