"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, from a block-max inverted index."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.calibration import Calibrator
from millrace.llm.common import Workspace, columns, crc_fold, mixed
from millrace.llm.quality import targets_of

EXAMPLES_PER_CLASS = 2048
# Of the sampled examples, texts over this many bytes teach nothing: bounds what the driver and a model hold.
EXAMPLE_BYTES = 32_768
# Weight of a term that the labels do not tell apart: ten thousand such in a long text count as much as one telling term.
PLAIN_WEIGHT = 0.01
NEIGHBOURS = 15
COPY_TRIES = 16
BLOCK = 256
# Blocks that a search opens first; twice as many each time after that.
FIRST_BLOCKS = 8
# Terms in at least this share of the examples have their lists as rows of a matrix.
DENSE_SHARE = 0.05
CACHED = 20_000
THRESHOLD = 0.5
HELD_OUT_REMAINDER = 0

_EDGES = b".,!?;:\"'()[]{}#$%&*|-"


def terms_of(text: str | None) -> list[bytes]:
    """Lower-cased words of the whole text without marks at their ends."""
    raw = text.encode("utf-8", "replace").lower().split() if isinstance(text, str) else []
    return [t for t in (w.strip(_EDGES) for w in raw) if t]


def label_weights(in_toxic: np.ndarray, in_others: np.ndarray, n_toxic: int, n_others: int) -> np.ndarray:
    """A weight per term: ``PLAIN_WEIGHT``, and more for terms whose likelihood ratio against the labels is no chance find.

    The largest of V ratios comes to about 2 ln V by chance, so a term's weight rises with what its own has beyond that.
    """
    base = n_toxic / max(1, n_toxic + n_others)
    seen = in_toxic + in_others
    unseen_toxic, unseen_others = n_toxic - in_toxic, n_others - in_others

    def part(count: np.ndarray, share: float, total: np.ndarray) -> np.ndarray:
        return count * np.log(np.maximum(count, 1e-9) / np.maximum(share * total, 1e-9))

    ratio = 2 * (
        part(in_toxic, base, seen) + part(in_others, 1 - base, seen)
        + part(unseen_toxic, base, unseen_toxic + unseen_others) + part(unseen_others, 1 - base, unseen_toxic + unseen_others)
    )
    chance = 2 * np.log(max(len(seen), 2))
    return PLAIN_WEIGHT + np.sqrt(np.maximum(0.0, ratio / chance - 1))


def one_per_copy_group(texts: list[Counter], toxic: np.ndarray) -> list[int]:
    """Indices of examples, one of each group of copies, so that a text copied often teaches once.

    Examples of a class count as copies if they share the smallest hashes of their terms under any of
    ``COPY_TRIES`` groups of hash functions: first six functions over all terms, which unites large
    groups, then three over the terms that at most a twentieth of the remaining examples have. Nearly
    all pairs that share 0.6 of these terms meet, and hardly one that shares 0.05.
    """
    hashes = [np.array([xxhash.xxh64_intdigest(t) for t in own] or [0], dtype=np.uint64) for own in texts]
    kept = _first_of_each(list(range(len(texts))), hashes, toxic, 6)
    spread = Counter(h for i in kept for h in hashes[i].tolist())
    common = np.array(sorted(h for h, n in spread.items() if n > max(2, len(kept) // 20)), dtype=np.uint64)
    rare = [h if (known := np.isin(h, common)).all() else h[~known] for h in hashes]
    return _first_of_each(kept, rare, toxic, 3)


def _first_of_each(kept: list[int], hashes: list[np.ndarray], toxic: np.ndarray, functions: int) -> list[int]:
    for number in range(COPY_TRIES):
        seeds = mixed(np.arange(functions * number + 1, functions * (number + 1) + 1, dtype=np.uint64))
        first: dict[tuple, int] = {}
        for i in kept:
            lowest = mixed(hashes[i][:, None] ^ seeds[None, :]).min(axis=0)
            first.setdefault((bool(toxic[i]), *lowest.tolist()), i)
        kept = sorted(first.values())
    return kept


class BlockMaxIndex:
    """Inverted lists of unit TF-IDF vectors, with the largest weight of each term in each block of examples.

    Lists and peaks are flat arrays, term by term; terms that many examples have are rows of a matrix per block instead.
    """

    def __init__(self, vectors: list[dict[int, float]], n_terms: int):
        self.size = len(vectors)
        self.blocks = -(-self.size // BLOCK)
        sizes = [len(v) for v in vectors]
        example = np.repeat(np.arange(self.size), sizes)
        term = np.fromiter((t for v in vectors for t in v), dtype=np.int64, count=sum(sizes))
        weight = np.fromiter((w for v in vectors for w in v.values()), dtype=float, count=sum(sizes))
        order = np.lexsort((example, term))
        example, term, weight = example[order], term[order], weight[order]
        # A stretch is the part of a term's list that lies in one block.
        fresh = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(example // BLOCK, prepend=-1) != 0))
        self.stretch_block, self.stretch_start = example[fresh] // BLOCK, fresh
        self.stretch_stop = np.append(fresh[1:], len(term))
        self.peak = np.maximum.reduceat(weight, fresh) if len(fresh) else np.empty(0)
        self.stretches = np.searchsorted(term[fresh], np.arange(n_terms + 1))
        self.cell, self.weight = example % BLOCK, weight
        common = np.flatnonzero(np.bincount(term, minlength=n_terms) >= max(8, DENSE_SHARE * self.size))
        self.row = np.full(n_terms, -1)
        self.row[common] = np.arange(len(common))
        self.dense = np.zeros((self.blocks, len(common), BLOCK))
        in_rows = self.row[term] >= 0
        self.dense[example[in_rows] // BLOCK, self.row[term[in_rows]], example[in_rows] % BLOCK] = weight[in_rows]

    def nearest(self, query: dict[int, float], k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """``nearest_to`` of a vector given as term: weight."""
        terms = np.fromiter(query.keys(), dtype=np.int64, count=len(query))
        return self.nearest_to(terms, np.fromiter(query.values(), dtype=float, count=len(query)), k, without)

    def nearest_to(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Examples and cosines of the k nearest with a positive cosine: exact, ties to the lower example.

        Blocks are opened by falling upper bound, until no unopened block can reach the k-th cosine.
        """
        ids, cosines = np.empty(0, dtype=np.int64), np.empty(0)
        if not len(terms) or not self.size:
            return ids, cosines
        starts, stops = self.stretches[terms], self.stretches[terms + 1]
        own, times = _spans(starts, stops), stops - starts
        block, weight = self.stretch_block[own], np.repeat(weights, times)
        bounds = np.bincount(block, weight * self.peak[own], minlength=self.blocks).astype(float)
        rows = self.row[terms]
        in_rows, of_rows = rows[rows >= 0], weights[rows >= 0]
        listed = np.repeat(rows < 0, times)
        own, block, weight = own[listed], block[listed], weight[listed]
        order = np.argsort(-bounds, kind="stable")
        step, at = FIRST_BLOCKS, 0
        while at < len(order) and bounds[order[at]] > 0:
            if len(ids) >= k and bounds[order[at]] < cosines[k - 1] - 1e-12:
                break
            opened = order[at : at + step]
            at, step = at + step, step * 2
            place = np.full(self.blocks, -1)
            place[opened] = np.arange(len(opened))
            there = place[block]
            here = there >= 0
            lo = self.stretch_start[own[here]]
            times = self.stretch_stop[own[here]] - lo
            entries = _spans(lo, lo + times)
            cells = self.cell[entries] + np.repeat(there[here] * BLOCK, times)
            sums = np.bincount(cells, self.weight[entries] * np.repeat(weight[here], times), minlength=len(opened) * BLOCK).astype(float)
            for number, one in enumerate(opened):
                sums[number * BLOCK : (number + 1) * BLOCK] += of_rows @ self.dense[one, in_rows]
            positive = np.flatnonzero(sums > 0)
            found = opened[positive // BLOCK] * BLOCK + positive % BLOCK
            positive, found = positive[found != without], found[found != without]
            ids, cosines = np.concatenate([ids, found]), np.concatenate([cosines, sums[positive]])
            if len(ids) > k:
                # What lies clearly under the k-th cosine need not be put in order.
                high = cosines >= np.partition(cosines, -k)[-k] - 1e-11
                ids, cosines = ids[high], cosines[high]
            best = np.lexsort((ids, -np.round(cosines, 12)))[:k]
            ids, cosines = ids[best], cosines[best]
        return ids[:k], cosines[:k]


def _spans(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The numbers of all ranges from ``starts`` to below ``stops``, one range after the other."""
    sizes = stops - starts
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def pooled(votes: np.ndarray, targets: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted means over groups of neighbouring votes, as many groups as each has rows: no single example sets a step."""
    order = np.argsort(votes, kind="stable")
    groups = np.array_split(order, max(1, math.isqrt(len(order)))) if len(order) else []
    mass = np.array([weights[g].sum() for g in groups])
    means = [np.array([(a[g] * weights[g]).sum() for g in groups]) / mass for a in (votes, targets)]
    return means[0], means[1], mass


class ToxicityModel:
    """All terms of the examples with their weights, the example index and the calibration.

    Bounded by ``2 * EXAMPLES_PER_CLASS`` examples of ``EXAMPLE_BYTES`` bytes at any corpus size.
    """

    def __init__(self, terms: list[bytes], weights: np.ndarray, examples: list[Counter], toxic: np.ndarray, ids: list, mass: np.ndarray):
        self.terms = {t: i for i, t in enumerate(terms)}
        self.weights, self.toxic, self.example_ids = weights, toxic.astype(float), ids
        vectors = [self.vector(c) for c in examples]
        self.index = BlockMaxIndex([dict(zip(*map(np.ndarray.tolist, v), strict=True)) for v in vectors], len(terms))
        empty = np.array([not len(v[0]) for v in vectors], dtype=bool)
        among = empty if empty.any() else np.ones(len(vectors), dtype=bool)
        self.blank = min(float((mass * self.toxic)[among].sum() / max(mass[among].sum(), 1e-9)), 1.0)
        raw = np.array([self._vote(*v, without=i)[0] for i, v in enumerate(vectors)])
        told = ~empty & ~np.isnan(raw)
        self.calibrator = Calibrator(*pooled(raw[told], self.toxic[told], mass[told]), self.blank)
        self._seen = {}

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Unit TF-IDF vector over the examples' terms, as terms and weights; empty if the text has none of them."""
        terms = np.fromiter(map(self.terms.get, counts, repeat(-1)), dtype=np.int64, count=len(counts))
        times = np.fromiter(counts.values(), dtype=float, count=len(counts))
        known = terms >= 0
        terms = terms[known]
        own = (1 + np.log(times[known])) * self.weights[terms]
        return terms, own / np.sqrt((own * own).sum()) if len(own) else own

    def _vote(self, terms: np.ndarray, weights: np.ndarray, without: int = -1) -> tuple[float, np.ndarray]:
        ids, cosines = self.index.nearest_to(terms, weights, NEIGHBOURS, without)
        if not len(ids):
            return float("nan"), ids
        votes = 1 / (1.05 - np.minimum(cosines, 1.0))
        return float(votes @ self.toxic[ids] / votes.sum()), ids

    def _score(self, text: str | None) -> tuple[float, list]:
        raw, ids = self._vote(*self.vector(Counter(terms_of(text))))
        if np.isnan(raw):
            return self.blank, []
        return float(self.calibrator(np.array([raw]))[0]), [self.example_ids[i] for i in ids]

    def score(self, text: str | None) -> tuple[float, list]:
        """Score in [0, 1] and the ids of the neighbours that voted, nearest first; recent texts are remembered by digest."""
        if not isinstance(text, str):
            return self._score(text)
        digest = xxhash.xxh128_digest(text.encode("utf-8", "replace"))
        if digest not in self._seen:
            if len(self._seen) >= CACHED:
                self._seen.clear()
            self._seen[digest] = self._score(text)
        return self._seen[digest]


def _example_sample(targets: DataFrame) -> DataFrame:
    """At most ``EXAMPLES_PER_CLASS`` rows of each class, chosen by a hash of the id."""
    marked = targets.select("doc_id", (F.col("target") >= 0.5).alias("toxic"))
    order = F.xxhash64("doc_id")
    return marked.where("toxic").orderBy(order).limit(EXAMPLES_PER_CLASS).union(
        marked.where("not toxic").orderBy(order).limit(EXAMPLES_PER_CLASS)
    )


def fit_toxicity(docs: DataFrame, targets: DataFrame) -> ToxicityModel:
    """Fit on ``docs`` (doc_id, text) and ``targets`` (doc_id, target).

    The examples are a bounded sample; class sizes and document frequencies count all rows.
    Without labelled rows every score is 0.
    """
    docs = docs.where("doc_id is not null")
    sample = _example_sample(targets)
    short = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= EXAMPLE_BYTES)
    chosen = short.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = sorted(chosen.collect(), key=lambda r: str(r["doc_id"]))
    sizes = dict(targets.groupBy((F.col("target") >= 0.5).alias("toxic")).count().collect())
    toxic = np.array([r["toxic"] for r in rows], dtype=bool)
    counts = [Counter(terms_of(r["text"])) for r in rows]
    kept = one_per_copy_group(counts, toxic)
    ids, counts, toxic = [rows[i]["doc_id"] for i in kept], [counts[i] for i in kept], toxic[kept]
    mass = np.array([sizes[bool(t)] / max(1, int((toxic == t).sum())) for t in toxic], dtype=float)
    terms = sorted({t for c in counts for t in c})
    place = {t: i for i, t in enumerate(terms)}
    spread = np.zeros((2, len(terms)))
    for own, y in zip(counts, toxic, strict=True):
        spread[int(y), [place[t] for t in own]] += 1
    telling = label_weights(spread[1], spread[0], int(toxic.sum()), int((~toxic).sum()))
    return ToxicityModel(terms, telling * _inverse_frequencies(docs, place), counts, toxic, ids, mass)


def _inverse_frequencies(docs: DataFrame, place: dict[bytes, int]) -> np.ndarray:
    """Smoothed inverse document frequency of every term over all documents; a task returns one row per term it saw."""
    wanted = docs.sparkSession.sparkContext.broadcast(place)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = wanted.value
        seen, n = np.zeros(len(own), dtype=np.int64), 0
        for batch in batches:
            n += len(batch)
            for text in batch["text"]:
                seen[[own[t] for t in set(terms_of(text)) if t in own]] += 1
        terms = np.flatnonzero(seen)
        yield pd.DataFrame({"term": np.append(terms, -1), "n": np.append(seen[terms], n)})

    found = dict(docs.select("text").mapInPandas(counted, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    wanted.unpersist()
    frequency = np.array([found.get(i, 0) for i in range(len(place))], dtype=float)
    return np.log((1 + found.get(-1, 0)) / (1 + frequency)) + 1


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, evidence (ids of the neighbours that voted).

    Learns from rows whose crc32(id) mod 5 is not 0. Texts that share no term with an example, null and
    empty ones among them, get the share of toxic rows among examples without terms, or among all. A null id is scored, never
    learnt from, and has held_out null; repeated rows are scored each.
    """
    source = columns(docs, doc_id=id_col, text=text_col)
    targets = targets_of(labels, label_col).where(crc_fold("doc_id") != HELD_OUT_REMAINDER)
    staged = Workspace(docs.sparkSession, "toxicity").stage(targets)
    model = docs.sparkSession.sparkContext.broadcast(fit_toxicity(source, staged))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            both = list(map(model.value.score, batch["text"]))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": [s for s, _ in both], "evidence": [e for _, e in both]})

    kind = source.schema["doc_id"].dataType.simpleString()
    result = source.mapInPandas(scored, f"doc_id {kind}, score double, evidence array<{kind}>")
    return result.select(
        "doc_id", (crc_fold("doc_id") == HELD_OUT_REMAINDER).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence",
    )
