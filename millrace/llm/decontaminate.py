"""Benchmark decontamination: rare word pairs seed passages, Smith-Waterman alignment scores them."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Workspace, columns, fresh_column, words_of

MATCH, MISMATCH, GAP = 2, -1, -1
# Part of the score of a verbatim copy of the whole item from which a passage counts as a copy.
MIN_SCORE = 0.5
# Benchmark items are probed in blocks of about this many words, so that a block fits every task.
BLOCK_WORDS = 1_000_000


def pairs_needed(words: int) -> int:
    """How many words of an item must lead a seed pair in every passage that reaches ``MIN_SCORE``.

    Between two neighbouring matched words an alignment pays at least 1 for each word left out on the
    side that leaves out more. A seed pair is one with at most one word left out on either side. With
    M matched words of which c lead a seed pair, the score is at most 2 M - 2 (M - 1 - c) = 2 + 2 c.
    """
    return max(1, math.ceil((MIN_SCORE * MATCH * words - 2) / 2))


class SeedIndex:
    """The two-word seeds of a block of benchmark items: words next to each other, and one word apart.

    ``pairs_needed`` of an item's words lead a seed pair in every copy, so of the words ranked by the
    frequency of their pairs, all but the ``pairs_needed - 1`` most frequent must be looked up to
    find every copy; the others only count.
    """

    def __init__(self, items: list[tuple]):
        # Inside, an item is its number in the block; ids may be null or repeat.
        self.ids = [i for i, _ in items]
        texts = [words_of(text) for _, text in items]
        self.vocabulary = {w: n for n, w in enumerate(sorted({w for words in texts for w in words}))}
        self.items = [self.encode(words) for words in texts]
        near, far = zip(*map(self._item_pairs, self.items), strict=True) if items else ((), ())
        none = np.empty(0, dtype=np.int64)
        self.pairs = np.unique(np.concatenate([*near, *far, none]))
        # The two pairs that each word leads, of all items in a row, and where each item begins.
        self.near = np.searchsorted(self.pairs, np.concatenate([*near, none]))
        self.far = np.searchsorted(self.pairs, np.concatenate([*far, none]))
        self.edges = np.concatenate([[0], np.cumsum([len(n) for n in near])]).astype(np.int64)
        self.needed = np.array([pairs_needed(len(h)) for h in self.items], dtype=np.int64)
        self.single = any(len(h) == 1 for h in self.items)
        self.rank(np.zeros(len(self.pairs), dtype=np.int64))

    def encode(self, words: list[bytes]) -> np.ndarray:
        """The numbers of the words; -1 for words of no item."""
        return np.fromiter(map(self.vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words))

    def _pair(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return first * len(self.vocabulary) + second

    def _item_pairs(self, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of an item's words with the next and the next but one; the last one has the next only."""
        if len(item) == 1:
            # A single word is no pair: numbers below 0 are free for it.
            return (-1 - item,) * 2
        near = self._pair(item[:-1], item[1:])
        # Items of one or two words have one seed, the whole item.
        return near, np.concatenate([self._pair(item[:-2], item[2:]), near[-1:]]) if len(item) > 2 else near

    def rank(self, frequency: np.ndarray) -> SeedIndex:
        """Seed every item with the words whose pairs are rarest, by the documents that hold each pair."""
        owner = np.repeat(np.arange(len(self.items)), np.diff(self.edges))
        order = np.lexsort((frequency[self.near] + frequency[self.far], owner))
        place = np.arange(len(order)) - self.edges[owner]
        seeds = order[place <= (np.diff(self.edges) - self.needed)[owner]]
        held, items = np.concatenate([self.near[seeds], self.far[seeds]]), np.tile(owner[seeds], 2)
        by_seed, by_item = np.lexsort((items, held)), np.lexsort((held, items))
        self.seeds, self.holders = held[by_seed], items[by_seed]
        self.seeds_of = np.split(held[by_item], np.searchsorted(items[by_item], np.arange(1, len(self.items))))
        self.seed_pairs = self.pairs[np.unique(held)]
        return self

    def pairs_in(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of a text that could be seeds, and the words at which they begin."""
        parts, places = [], []
        known = np.flatnonzero(words >= 0)
        for apart in (1, 2):
            first = known[known < len(words) - apart]
            first = first[words[first + apart] >= 0]
            parts.append(self._pair(words[first], words[first + apart]))
            places.append(first)
        if self.single:
            parts.append(-1 - words[known])
            places.append(known)
        return np.concatenate(parts), np.concatenate(places)

    def held(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pairs are pairs of items, and their numbers."""
        return _found(pairs, self.pairs)

    def seeded(self, pairs: np.ndarray) -> bool:
        """Whether one of the pairs is a seed."""
        return len(_found(pairs, self.seed_pairs)[0]) > 0

    def leading(self, items: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """How many words of each item lead one of the pairs."""
        spans = _spans(self.edges[items], self.edges[items + 1])
        led = np.isin(self.near[spans], pairs) | np.isin(self.far[spans], pairs)
        sizes = self.edges[items + 1] - self.edges[items]
        return np.add.reduceat(led.astype(np.int64), np.cumsum(sizes) - sizes)

    def candidates(self, pairs: np.ndarray) -> np.ndarray:
        """Items that one of the pairs seeds and that have enough words leading one of them: sorted."""
        starts, stops = np.searchsorted(self.seeds, pairs, "left"), np.searchsorted(self.seeds, pairs, "right")
        items = np.unique(self.holders[_spans(starts, stops)])
        return items[self.leading(items, pairs) >= self.needed[items]] if len(items) else items


def _found(values: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are in a sorted array, and where."""
    if not len(among):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    hit = np.flatnonzero(among[at] == values)
    return hit, at[hit]


def _spans(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The numbers of all ranges from ``starts`` to below ``stops``, one range after the other."""
    sizes = stops - starts
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def can_score(window: np.ndarray, item: np.ndarray) -> bool:
    """Whether the window holds enough of the item's words, each as often, for ``MIN_SCORE``."""
    words, needed = np.unique(item, return_counts=True)
    at = np.minimum(np.searchsorted(words, window), len(words) - 1)
    held = np.bincount(at[words[at] == window], minlength=len(words))
    return int(np.minimum(held, needed).sum()) >= MIN_SCORE * len(item)


def align(text: np.ndarray, item: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment of two word sequences: score, first and last word in the text, matched words.

    Smith-Waterman, one row of the matrix at a time; a gap along the row is a running maximum,
    since gaps cost the same per word. Every cell carries where its alignment begins and how many
    words it matches, so two rows are all that is held.
    """
    m = len(item)
    cells, steps = np.arange(m + 1), np.arange(m + 1) * GAP
    score, first, matched = np.zeros(m + 1, dtype=np.int64), np.zeros(m + 1, dtype=np.int64), np.zeros(m + 1, dtype=np.int64)
    best = (0, 0, -1, 0)
    for i, word in enumerate(text):
        same = item == word
        diagonal = score[:-1] + np.where(same, MATCH, MISMATCH)
        skipped = score[1:] + GAP
        own = np.zeros(m + 1, dtype=np.int64)
        own[1:] = np.maximum(0, np.maximum(diagonal, skipped))
        direct = diagonal >= skipped
        begins, counts = np.empty_like(first), np.zeros_like(matched)
        begins[0] = i + 1
        begins[1:] = np.where(direct, first[:-1], first[1:])
        counts[1:] = np.where(direct, matched[:-1] + same, matched[1:])
        reached = np.maximum.accumulate(own - steps)
        origin = np.maximum.accumulate(np.where(own - steps == reached, cells, 0))
        score, first, matched = reached + steps, begins[origin], counts[origin]
        blank = score == 0
        first[blank], matched[blank] = i + 1, 0
        j = int(score.argmax())
        if score[j] > best[0]:
            best = (int(score[j]), int(first[j]), i, int(matched[j]))
    return best


def passages_of(n_words: int, where: np.ndarray, item_words: int) -> Iterator[tuple[int, int]]:
    """Windows of the text around runs of seeds; a passage that reaches ``MIN_SCORE`` is at most two items long."""
    reach = 2 * item_words
    start = last = int(where[0])
    for at in [*map(int, where[1:]), None]:
        if at is not None and at - last <= reach and at - start <= 8 * reach:
            last = at
            continue
        yield max(0, start - reach), min(n_words, last + reach)
        if at is not None:
            start = last = at


def leaks_in(text: np.ndarray, index: SeedIndex) -> list[tuple]:
    """The best passage of every item that this text copies: (item number, score, start, length, matched words)."""
    pairs, begins = index.pairs_in(text)
    if not index.seeded(pairs):
        return []
    hit, which = index.held(pairs)
    order = np.argsort(begins[hit], kind="stable")
    where, which = begins[hit][order], which[order]
    found = []
    for item in index.candidates(np.unique(which)).tolist():
        words, best = index.items[item], None
        for lo, hi in passages_of(len(text), np.unique(where[np.isin(which, index.seeds_of[item])]), len(words)):
            inside = which[np.searchsorted(where, lo) : np.searchsorted(where, hi)]
            if index.leading(np.array([item]), inside)[0] < index.needed[item] or not can_score(text[lo:hi], words):
                continue
            score, first, last, matched = align(text[lo:hi], words)
            share = score / (MATCH * len(words))
            if share >= MIN_SCORE and (best is None or share > best[1]):
                best = (item, share, lo + first, last - first + 1, matched)
        if best:
            found.append(best)
    return found


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in bounded blocks, by row; items without words or id take no part.

    ``toLocalIterator`` holds one partition at a time, a block at most ``BLOCK_WORDS`` words and one item.
    """
    block, size = [], 0
    for row in benchmark.where("item_id is not null and text is not null").dropDuplicates(["item_id", "text"]).toLocalIterator():
        words = len(words_of(row["text"]))
        if not words:
            continue
        if block and size + words > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += words
    if block:
        yield block


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per document and benchmark item it copies: doc_id, item_id, score, start, length, matched_words.

    ``score`` is the best local word alignment as a share of a verbatim copy's; ``start`` and
    ``length`` are words of the document. Every passage that reaches ``MIN_SCORE`` is found
    (``pairs_needed`` says why); an item of two words needs both, with one word between them at most.
    Documents are read twice, once to count the seeds' documents, and never shuffled. Items without
    an id cannot be reported. Null and empty texts copy nothing, rows with a null id are reported
    under null, repeated rows repeat their rows. Without items the result is empty. A benchmark
    over ``BLOCK_WORDS`` words is searched block by block.
    """
    spark = docs.sparkSession
    source = columns(docs, doc_id=id_col, text=text_col)
    items = columns(benchmark, item_id=item_id_col, text=item_text_col)
    kind, item_kind = (t.schema[c].dataType.simpleString() for t, c in ((source, "doc_id"), (items, "item_id")))
    schema = f"doc_id {kind}, item_id {item_kind}, score double, start long, length long, matched_words long"
    result = None
    for block in _blocks(items):
        index = SeedIndex(block)
        index.rank(_pair_frequencies(source, index))
        found = _leaks_of_block(source, spark.sparkContext.broadcast(index), schema)
        result = found if result is None else result.union(found)
    return spark.createDataFrame([], schema) if result is None else result


def _pair_frequencies(source: DataFrame, index: SeedIndex) -> np.ndarray:
    """How many documents hold each pair of the block; a task returns one row per pair that it saw."""
    shared = source.sparkSession.sparkContext.broadcast(index)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        seen = np.zeros(len(own.pairs), dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                seen[np.unique(own.held(own.pairs_in(own.encode(words_of(text)))[0])[1])] += 1
        pairs = np.flatnonzero(seen)
        yield pd.DataFrame({"pair": pairs, "n": seen[pairs]})

    frequency = np.zeros(len(index.pairs), dtype=np.int64)
    for row in source.select("text").mapInPandas(counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toLocalIterator():
        frequency[row["pair"]] = row["n"]
    shared.unpersist()
    return frequency


def _leaks_of_block(source: DataFrame, index, schema: str) -> DataFrame:
    def aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = index.value
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                rows += [(doc, own.ids[item], *leak) for item, *leak in leaks_in(own.encode(words_of(text)), own)]
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "score", "start", "length", "matched_words"])

    return source.mapInPandas(aligned, schema)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The documents that copy no benchmark item, with all their columns and repeated rows.

    Rows with a null id are judged by their text like all others, and so are items.
    """
    row = fresh_column(docs, "row")
    work = Workspace(docs.sparkSession, "leaks")
    numbered = work.stage(docs.withColumn(row, F.monotonically_increasing_id()))
    items = columns(benchmark, text=item_text_col).distinct().withColumn("item_id", F.monotonically_increasing_id())
    leaks = find_leaks(numbered, items, id_col=row, text_col=text_col).select(F.col("doc_id").alias(row)).distinct()
    return numbered.join(leaks, row, "left_anti").drop(row)
