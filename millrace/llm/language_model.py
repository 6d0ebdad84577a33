"""Scores of texts under a probabilistic suffix tree learnt from the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import columns, crc_fold, mixed, word_hashes, words_of

END = xxhash.xxh64_intdigest(b"\n")  # a newline is no word
# n-grams with at least this share of the training tokens are frequent: at most 1 / SHARE of each length.
SHARE = 1e-4
# Weight of the shorter context's distribution, in tokens.
PRIOR = 3000.0
# A context is kept if its likelihood ratio against the shorter one exceeds chance by so many deviations, and by MIN_GAIN.
DEVIATIONS = 6.0
MIN_GAIN = 20.0
BATCH_TOKENS = 1_500_000
BATCH_DOCS = 60_000
HELD_OUT_REMAINDER = 1


class Frequent:
    """Frequent n-grams in key order with their counts: words by hash, longer ones by (index of the start, last word)."""

    def __init__(self, rows: list[tuple[int, int]], kind=np.int64):
        rows = sorted((np.array([k], dtype=np.int64).view(kind)[0], n) for k, n in rows)
        self.keys = np.array([k for k, _ in rows], dtype=kind)
        self.counts = np.array([n for _, n in rows], dtype=np.int64)

    def find(self, keys: np.ndarray, valid: np.ndarray | None = None) -> np.ndarray:
        """Index of each key, -1 where it is not frequent or not valid."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return np.where(hit if valid is None else hit & valid, at, -1)


class SuffixTree:
    """States (contexts of one and two words), counts of the frequent n-grams, and the base distribution.

    Bounded by 3 / SHARE entries; the counts of all other n-grams stay in Spark.
    """

    def __init__(self, tokens: int, types: int, words: Frequent, prior: float = PRIOR):
        self.tokens, self.types, self.prior = tokens, types, prior
        self.words, self.pairs, self.triples = words, Frequent([]), Frequent([])
        self.states1 = np.zeros(len(words.keys), dtype=bool)
        self.states2 = np.zeros(0, dtype=bool)

    @property
    def mass(self) -> float:
        return self.tokens + 0.5 * (self.types + 1)

    def pair_key(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return first * max(1, len(self.words.keys)) + second

    def choose_states(self) -> None:
        """Divergence test of each context's distribution over its frequent next words (all others as one) against
        the distribution after the context without its first word; suffixes of kept contexts are kept."""
        m = max(1, len(self.words.keys))
        first, second = self.pairs.keys // m, self.pairs.keys % m
        self.states1 = self._diverges(len(self.words.keys), first, self.pairs.counts, self.words.counts, self.words.counts[second] / max(1, self.tokens))
        start, last = self.triples.keys // m, self.triples.keys % m
        shorter = self.pairs.find(self.pair_key(second[start], last)) if len(start) else start
        after = self.pairs.counts[shorter] / self.words.counts[second[start]] if len(start) else np.empty(0)
        self.states2 = self._diverges(len(self.pairs.keys), start, self.triples.counts, self.pairs.counts, after)
        self.states1[second[self.states2]] = True

    @staticmethod
    def _diverges(n: int, context: np.ndarray, counts: np.ndarray, totals: np.ndarray, parent: np.ndarray) -> np.ndarray:
        totals = totals.astype(float)
        sums = lambda values: np.bincount(context, values, minlength=n)[:n] if len(context) else np.zeros(n)
        if len(totals) < n:
            return np.zeros(n, dtype=bool)
        own = counts / totals[context] if len(context) else np.empty(0)
        gain = sums(counts * np.log(np.maximum(own, 1e-300) / np.maximum(parent, 1e-300)))
        rest, rest_parent = totals - sums(counts), np.maximum(1 - sums(parent), 1e-12)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain += np.where(rest > 0, rest * np.log(np.maximum(rest / totals, 1e-300) / rest_parent), 0.0)
        cells = sums(np.ones(len(context)))
        return 2 * gain > cells + DEVIATIONS * np.sqrt(2 * cells) + MIN_GAIN

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / self.mass


class Tokens:
    """The tokens of a batch of documents, with indices of the frequent n-grams that end at each."""

    def __init__(self, texts: list[np.ndarray], tree: SuffixTree):
        sizes = [len(t) for t in texts]
        self.hash = np.concatenate([*texts, np.empty(0, dtype=np.uint64)]).astype(np.uint64)
        self.doc = np.repeat(np.arange(len(texts)), sizes)
        inside = np.ones(len(self.hash), dtype=bool)
        inside[np.cumsum([0, *sizes[:-1]])[: len(sizes)] if sizes else []] = False
        self.word = tree.words.find(self.hash)
        self.before = np.where(inside, np.roll(self.word, 1), -1)
        self.pair = tree.pairs.find(tree.pair_key(self.before, self.word), (self.before >= 0) & (self.word >= 0))
        self.pair_before = np.where(inside, np.roll(self.pair, 1), -1)


def text_tokens(text: str | None) -> np.ndarray:
    """Hashes of the words and of the end."""
    return np.append(word_hashes(words_of(text)), np.uint64(END))


def _batches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """Parts of bounded size with the tokens of their texts."""
    for batch in batches:
        texts, size, start = [], 0, 0
        for i, text in enumerate(batch["text"]):
            texts.append(text_tokens(text))
            size += len(texts[-1])
            if size >= BATCH_TOKENS or len(texts) >= BATCH_DOCS:
                yield batch.iloc[start : i + 1], texts
                texts, size, start = [], 0, i + 1
        if texts:
            yield batch.iloc[start:], texts


def _counted(training: DataFrame, keys_of) -> DataFrame:
    """key and n over all training documents; counted per batch before the shuffle."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, texts in _batches(batches):
            keys, n = np.unique(keys_of(texts), return_counts=True)
            yield pd.DataFrame({"key": keys.view(np.int64), "n": n})

    return training.select("text").mapInPandas(counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def fit_suffix_tree(training: DataFrame, prior: float = PRIOR) -> SuffixTree:
    """Counts all words, then the pairs and triples whose parts are frequent, and tests the contexts."""
    spark = training.sparkSession
    words = _counted(training, lambda texts: np.concatenate(texts)).persist()
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    least = max(2.0, SHARE * total["n"])
    frequent = lambda table: [tuple(r) for r in table.where(F.col("n") >= least).collect()]
    tree = SuffixTree(total["n"], total["v"], Frequent(frequent(words), np.uint64), prior)
    words.unpersist()
    shared = spark.sparkContext.broadcast(tree)

    def pairs(texts):
        t = Tokens(texts, shared.value)
        own = (t.before >= 0) & (t.word >= 0)
        return shared.value.pair_key(t.before[own], t.word[own])

    tree.pairs = Frequent(frequent(_counted(training, pairs)))
    with_pairs = spark.sparkContext.broadcast(tree)

    def triples(texts):
        t = Tokens(texts, with_pairs.value)
        own = (t.pair_before >= 0) & (t.pair >= 0)
        return with_pairs.value.pair_key(t.pair_before[own], t.word[own])

    tree.triples = Frequent(frequent(_counted(training, triples)))
    tree.choose_states()
    return tree


# Of the open tokens of a batch in one shard: keys and their counts and words, and per token its document (place in the
# batch), whether that is held out, and the states. ids, flags and known describe the whole batch, in one shard only.
_BLOB = "batch long, shard int, keys binary, reps binary, w binary, doc binary, held binary, s1 binary, s2 binary, ids binary, flags binary, known binary"
_SETTLED = "batch long, doc binary, n_known binary, base binary, gain binary, ids binary, flags binary, known binary"
_SUMS = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _levels(tree: SuffixTree, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """The states of one and two words that each token follows, -1 for none."""
    s1 = np.where((t.before >= 0) & tree.states1[t.before], t.before, -1) if len(tree.states1) else np.full(len(t.word), -1)
    s2 = np.where((t.pair_before >= 0) & tree.states2[t.pair_before], t.pair_before, -1) if len(tree.states2) else np.full(len(t.word), -1)
    return s1, s2


def _smoothed(tree: SuffixTree, base, s1, s2, after1, after2) -> np.ndarray:
    """Probability after the longest state: each state's counts and ``prior`` tokens of the next shorter one's."""
    p = base
    if len(tree.states1):
        p = np.where(s1 >= 0, (after1 + tree.prior * p) / (tree.words.counts[s1] + tree.prior), p)
    if len(tree.states2):
        p = np.where(s2 >= 0, (after2 + tree.prior * p) / (tree.pairs.counts[s2] + tree.prior), p)
    return p


def _spread(shared, shards: int):
    """Per batch: sums over the tokens whose counts are all frequent, and the other tokens by shard.

    A token's shard follows from the shortest n-gram ending in it whose count is not known: that of the
    word, of the word after its state of one word, or of two. No such n-gram is frequent, so no shard
    gets a hot key.
    """

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = shared.value
        for rows, texts in _batches(batches):
            t = Tokens(texts, tree)
            n = len(texts)
            s1, s2 = _levels(tree, t)
            triple = tree.triples.find(tree.pair_key(t.pair_before, t.word), (s2 >= 0) & (t.word >= 0))
            known0 = t.word >= 0
            known1 = known0 & ((s1 < 0) | (t.pair >= 0))
            known = known1 & ((s2 < 0) | (triple >= 0))
            count = lambda f, at: f.counts[np.maximum(at, 0)] if len(f.counts) else np.zeros(len(at))
            base = tree.base(count(tree.words, t.word))
            p = _smoothed(tree, base, s1, s2, count(tree.pairs, t.pair), count(tree.triples, triple))
            sums = np.stack([
                np.bincount(t.doc, minlength=n), np.bincount(t.doc, known0, minlength=n),
                np.bincount(t.doc, np.where(known0, np.log10(base), 0), minlength=n),
                np.bincount(t.doc, np.where(known, np.log10(p), 0), minlength=n),
            ])
            key = np.where(known0, 0, t.hash)
            one = mixed(tree.pair_key(s1, t.word).view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
            two = mixed(mixed(tree.pair_key(s2, t.word).view(np.uint64)) ^ np.uint64(0x14057B7EF767814F))
            key = np.where(known0 & ~known1, one, np.where(known1, two, key))
            open_ = np.flatnonzero(~known)
            shard = (mixed(key[open_]) % np.uint64(shards)).astype(np.int64)
            order = np.lexsort((key[open_], shard))
            open_, shard = open_[order], shard[order]
            missing = rows["doc_id"].isna().to_numpy()
            held = rows["held_out"].fillna(True).to_numpy().astype(bool)
            batch = int(rows["row"].iloc[0])
            whole = {
                "ids": rows["doc_id"].fillna(0).to_numpy().astype(np.int64).tobytes(), "flags": (missing + 2 * held).astype(np.uint8).tobytes(),
                "known": sums.tobytes(),
            }
            edges = np.searchsorted(shard, np.arange(shards + 1))
            own = int(mixed(np.array([batch], dtype=np.uint64))[0] % np.uint64(shards))
            blobs = []
            for i in range(shards):
                at = open_[edges[i] : edges[i + 1]]
                if not len(at) and i != own:
                    continue
                keys, first, reps = np.unique(key[at], return_index=True, return_counts=True)
                blobs.append({
                    "batch": batch, "shard": i, "keys": keys.tobytes(), "reps": reps.astype(np.uint32).tobytes(),
                    "w": t.word[at][first].astype(np.int16).tobytes(), "doc": t.doc[at].astype(np.uint16).tobytes(),
                    "held": np.packbits(held[t.doc[at]]).tobytes(), "s1": s1[at].astype(np.int16).tobytes(),
                    "s2": s2[at].astype(np.int16).tobytes(), **(whole if i == own else dict.fromkeys(whole, b"")),
                })
            yield pd.DataFrame(blobs, columns=_names(_BLOB))

    return spread


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _settle(shared):
    """Counts the n-grams of a shard over its training tokens and scores its tokens, summed per document of each batch."""

    def settle(group: pd.DataFrame) -> pd.DataFrame:
        tree, parts = shared.value, []
        for number, blob in enumerate(group.itertuples(index=False)):
            reps = np.frombuffer(blob.reps, dtype=np.uint32)
            doc = np.frombuffer(blob.doc, dtype=np.uint16).astype(np.int64)
            parts.append((
                np.repeat(np.frombuffer(blob.keys, dtype=np.uint64), reps), doc + (number << 16),
                np.unpackbits(np.frombuffer(blob.held, dtype=np.uint8), count=len(doc)) == 0,
                np.frombuffer(blob.s1, dtype=np.int16), np.frombuffer(blob.s2, dtype=np.int16), np.repeat(np.frombuffer(blob.w, dtype=np.int16), reps),
            ))
        key, doc, trains, s1, s2, w = (np.concatenate(c) for c in zip(*parts, strict=True))
        s1, s2, w = s1.astype(np.int64), s2.astype(np.int64), w.astype(np.int64)
        _, own = np.unique(key, return_inverse=True)

        def seen(codes: np.ndarray) -> np.ndarray:
            _, which = np.unique(codes, return_inverse=True)
            return np.bincount(which, trains, minlength=1)[which] if len(which) else np.empty(0)

        rare = w < 0
        counts = np.where(rare, seen(own), tree.words.counts[w] if len(tree.words.counts) else 0)
        pair = tree.pairs.find(tree.pair_key(s1, w), (s1 >= 0) & ~rare)
        after1 = np.where(pair >= 0, tree.pairs.counts[pair] if len(tree.pairs.counts) else 0, seen(own * 40_000 + s1 + 1))
        base = tree.base(counts)
        p = _smoothed(tree, base, s1, s2, after1, seen(own * 40_000 + s2 + 1))
        touched, place = np.unique(doc, return_inverse=True)
        n = len(touched)
        n_known = np.bincount(place, rare & (counts > 0), minlength=n).astype(np.uint32)
        bases = np.bincount(place, np.where(rare, np.log10(base), 0), minlength=n)
        gains = (np.bincount(place, np.log10(p), minlength=n) - bases).astype(np.float32)
        edges = np.searchsorted(touched >> 16, np.arange(len(group) + 1))
        spans = [slice(*edges[i : i + 2]) for i in range(len(group))]
        return group[["batch", "ids", "flags", "known"]].assign(
            doc=[(touched[s] & 0xFFFF).astype(np.uint16).tobytes() for s in spans], n_known=[n_known[s].tobytes() for s in spans],
            base=[bases[s].tobytes() for s in spans], gain=[gains[s].tobytes() for s in spans],
        )[_names(_SETTLED)]

    return settle


def _totals(group: pd.DataFrame) -> pd.DataFrame:
    """One row per document of a batch from the sums of all shards."""
    whole = next(row for row in group.itertuples(index=False) if row.ids)
    ids, flags = np.frombuffer(whole.ids, dtype=np.int64), np.frombuffer(whole.flags, dtype=np.uint8)
    n_tokens, n_known, base, score = np.frombuffer(whole.known).reshape(4, -1).copy()
    for row in group.itertuples(index=False):
        doc, bases = np.frombuffer(row.doc, dtype=np.uint16), np.frombuffer(row.base)
        n_known[doc] += np.frombuffer(row.n_known, dtype=np.uint32)
        base[doc] += bases
        score[doc] += bases + np.frombuffer(row.gain, dtype=np.float32)
    out = pd.DataFrame({
        "doc_id": pd.array(ids, dtype="Int64"), "held_out": pd.array(flags & 2 > 0, dtype="boolean"),
        "n_tokens": n_tokens.astype(np.int64), "n_known": n_known.astype(np.int64), "base_score": base, "score": score,
    })
    out.loc[flags & 1 > 0, ["doc_id", "held_out"]] = pd.NA
    return out


def language_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", prior: float = PRIOR) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows whose crc32(id) mod 5 is not 1. A null text is empty: its end is its only token. Rows
    with a null id are scored, never learnt from, and have held_out null; repeated rows are
    learnt from and scored each. Without training rows the base is the formula's value for no counts.

    All counts are exact. Counts of frequent n-grams (at most 1 / ``SHARE`` of each length) go to every
    task; the tokens of all others are shuffled once by n-gram, in packed arrays, and are counted and
    scored where they meet. Their sums go back in packed arrays too, to the batch that they came from.
    """
    spark = docs.sparkSession
    source = columns(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    source = source.withColumn("held_out", crc_fold("doc_id") == HELD_OUT_REMAINDER)
    tree = fit_suffix_tree(source.where("not held_out"), prior)
    shared = spark.sparkContext.broadcast(tree)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blobs = source.withColumn("row", F.monotonically_increasing_id()).mapInPandas(_spread(shared, shards), _BLOB)
    settled = blobs.groupBy("shard").applyInPandas(_settle(shared), _SETTLED)
    return settled.groupBy("batch").applyInPandas(_totals, _SUMS).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tree.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
