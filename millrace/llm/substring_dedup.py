"""Passages that repeat across documents, found by level-wise doubling of window lengths.

Windows repeated at one length alone go on to twice that length. Below the wanted length only sampled windows are
looked up: of every stretch as long as the wanted window, the window with the least hash. What is sampled depends on
the stretch alone, so a passage has the same samples wherever it stands, and a stretch whose sample is in one
document only cannot repeat. At the wanted length all windows that are left are compared, those of one sample as one
row: equal rows are settled by the smallest document that has them, and single windows are looked up only where
rows of the same sample differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Workspace, columns, fresh_column, mixed, word_hashes

WINDOW = 50
SHORTEST = 25
_MULTIPLIER, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def level_lengths(window: int, shortest: int) -> list[int]:
    """Window lengths from the shortest on, each at most twice the one before, up to ``window``."""
    lengths = [window]
    while (half := -(-lengths[0] // 2)) >= shortest and half < lengths[0]:
        lengths.insert(0, half)
    return lengths


class _Text:
    """Hashes of the windows of one text's words."""

    powers = np.ones(1, dtype=np.uint64)
    inverses = np.ones(1, dtype=np.uint64)

    def __init__(self, words: list[bytes]):
        n = len(words)
        with np.errstate(over="ignore"):
            if n >= len(self.powers):
                steps = np.full((2, 2 * n), 1, dtype=np.uint64)
                steps[0, 1:], steps[1, 1:] = _MULTIPLIER, _INVERSE
                _Text.powers, _Text.inverses = np.multiply.accumulate(steps, axis=1)
            self.sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(mixed(word_hashes(words)) * self.powers[:n], out=self.sums[1:])

    def windows(self, length: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            sums = self.sums[length:] - self.sums[: len(self.sums) - length]
            return mixed(sums * self.inverses[: len(sums)])

    def samples(self, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
        """For every stretch of ``window`` words the place and the hash of its sampled window of ``length``."""
        hashes = self.windows(length)
        width = window - length + 1
        if len(hashes) < width:
            return np.empty(0, dtype=np.int64), hashes[:0]
        stretches = np.lib.stride_tricks.sliding_window_view(hashes, width)
        # the last of equal ones
        places = np.arange(len(stretches)) + (width - 1 - stretches[:, ::-1].argmin(axis=1))
        return places, hashes[places]


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum([len(v) for v in values])].astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), _signed(flat))


def _words(text: pa.Scalar) -> list[bytes]:
    return (text.as_py() or b"").split()


def _alive(samples: np.ndarray, known: pa.Scalar) -> np.ndarray:
    return np.isin(samples.view(np.int64), known.values.to_numpy(zero_copy_only=False))


def _scan(length: int, window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """n_words, words_sha256 and the distinct samples of every document."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, samples = [], [], []
            for text in batch.column("text"):
                words = _words(text)
                sizes.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                found = _Text(words).samples(length, window)[1] if len(words) >= window else np.empty(0, dtype=np.uint64)
                samples.append(np.unique(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), _lists(samples)],
                names=["doc_id", "key", "n_words", "words_sha256", "samples"],
            )

    return scanned


def _longer(before: int, length: int, window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The samples of the next length, of stretches whose sample before is still alive."""

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            samples = []
            for text, alive in zip(batch.column("text"), batch.column("alive"), strict=True):
                hashed = _Text(_words(text))
                left = _alive(hashed.samples(before, window)[1], alive)
                samples.append(np.unique(hashed.samples(length, window)[1][left]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), _lists(samples)], names=["doc_id", "key", "samples"]
            )

    return extended


def _whole_windows(before: int, window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """doc_id, key, sample, starts, windows: the hashes of consecutive whole windows of one alive sample.

    Where a document repeats them they are one row, so a text that is one word over and over has one row.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple] = []
            for doc_id, key, text, alive in zip(*[batch.column(c) for c in ("doc_id", "key", "text", "alive")], strict=True):
                hashed = _Text(_words(text))
                places, found = hashed.samples(before, window)
                left, whole = _alive(found, alive), hashed.windows(window)
                edges = np.flatnonzero(np.r_[True, places[1:] != places[:-1], True])
                own: dict[tuple[int, bytes], list[int]] = {}
                for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    if left[low]:
                        own.setdefault((found[low], whole[low:high].tobytes()), []).append(low)
                held += [(doc_id.as_py(), key.as_py(), sample, starts, hashes) for (sample, hashes), starts in own.items()]
                if len(held) >= 5000:
                    yield _rows_of(held)
                    held = []
            if held:
                yield _rows_of(held)

    return rows


def _rows_of(held: list[tuple]) -> pa.RecordBatch:
    ids, keys, samples, starts, windows = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(starts, pa.list_(pa.int64())),
         _signed(np.array(samples, dtype=np.uint64)), _lists([np.frombuffer(w, dtype=np.uint64) for w in windows])],
        names=["doc_id", "key", "starts", "sample", "windows"],
    )


def _kept(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """doc_id, key, n_removed, kept: the texts without the words under the cuts (start, number of windows)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for text, cuts in zip(batch.column("text"), batch.column("cuts"), strict=True):
                words = _words(text)
                starts, counts = (cuts.values.field(i).to_numpy() for i in range(2))
                change = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(change, starts, 1)
                np.add.at(change, starts + counts + window - 1, -1)
                left = np.flatnonzero(np.cumsum(change[:-1]) == 0)
                removed.append(len(words) - len(left))
                kept.append(b" ".join([words[i] for i in left]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "key", "n_removed", "kept"],
            )

    return cut


def _in_several(samples: DataFrame) -> DataFrame:
    """key, alive: the samples of a document that stand in documents of other ids too.

    Grouping by the hash too gives the join a shuffle of its own, which adaptive execution splits at a
    sample that very many documents have.
    """
    single = samples.where("doc_id is not null").select("doc_id", "key", F.explode("samples").alias("sample"))
    spread = single.groupBy("sample", F.hash("sample").alias("_hash")).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    several = spread.where("low != high").select("sample")
    return single.select("key", "sample").join(several, "sample").groupBy("key").agg(F.collect_set("sample").alias("alive"))


def _cuts(texts: DataFrame, before: int, window: int, work: Workspace) -> DataFrame:
    """doc_id, key, cuts: where windows stand that a document of a smaller id has as well."""
    schema = "doc_id bigint, key bigint, starts array<bigint>, sample bigint, windows array<bigint>"
    rows = work.stage(texts.mapInArrow(_whole_windows(before, window), schema).withColumn("phrase", F.xxhash64("windows")))
    same = ("sample", "phrase")
    first = work.stage(
        rows.groupBy(*same, F.hash(*same).alias("_hash")).agg(F.min("doc_id").alias("first"), F.any_value("windows").alias("windows")).drop("_hash")
    )
    # Only samples with different rows have windows to be looked up one by one.
    differing = first.groupBy("sample", F.hash("sample").alias("_hash")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sample")
    single = work.stage(first.join(differing, "sample").select(*same, "first", F.posexplode("windows").alias("place", "window")))
    least = (
        single.groupBy("sample", "window", F.hash("window", "sample").alias("_hash"))
        .agg(F.min("first").alias("low"), F.max("first").alias("high")).where("low != high").select("sample", "window", "low")
    )
    earlier = (
        single.join(least, ["sample", "window"]).where("low < first").groupBy(*same).agg(F.collect_list("place").alias("places"))
    )
    # Written and read back, this side has no order of its own, so the join may split a row that very many documents have.
    judged = work.stage(first.select(*same, "first").join(earlier, list(same), "left"))
    met = rows.select("doc_id", "key", "starts", *same, F.size("windows").cast("long").alias("n")).join(judged, list(same))
    whole = F.transform("starts", lambda s: F.struct(s.alias("start"), F.col("n").alias("count")))
    parts = F.flatten(F.transform("starts", lambda s: F.transform("places", lambda p: F.struct((s + p).alias("start"), F.lit(1).cast("long").alias("count")))))
    cuts = F.when(F.col("doc_id") > F.col("first"), whole).otherwise(parts)
    return met.select("doc_id", "key", F.explode(cuts).alias("cut")).groupBy("doc_id", "key").agg(F.collect_list("cut").alias("cuts"))


def _work_through(docs: DataFrame, id_col: str, text_col: str, window: int, shortest: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, n_words, words_sha256) of every row, and (doc_id, key, n_removed, kept) of texts that lose words.

    The key is a hash of id and text: rows equal in both have equal results.
    """
    if window < 2 or shortest < 2:
        raise ValueError("windows have at least two words")
    work = Workspace(docs.sparkSession, "substrings")
    lengths = level_lengths(window, shortest)
    if len(lengths) < 2:
        raise ValueError("the shortest window is at most half the wanted one")
    source = columns(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("key"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    scan = "doc_id bigint, key bigint, n_words bigint, words_sha256 string, samples array<bigint>"
    scanned = work.stage(source.mapInArrow(_scan(lengths[0], window), scan))
    texts, samples = source.where("doc_id is not null"), scanned
    for n, length in enumerate(lengths[:-1]):
        if n:
            samples = work.stage(texts.mapInArrow(_longer(lengths[n - 1], length, window), "doc_id bigint, key bigint, samples array<bigint>"))
        alive = work.stage(_in_several(samples))
        repeated = texts.drop("alive").join(alive, "key")
        texts = work.stage(repeated if n else repeated.dropDuplicates(["key", "doc_id"]))
    cuts = _cuts(texts.select("doc_id", "key", "text", "alive"), lengths[-2], window, work)
    cut = texts.select("doc_id", "key", "text").join(cuts, ["key", "doc_id"]).select("doc_id", "key", "text", "cuts")
    kept = cut.mapInArrow(_kept(window), "doc_id bigint, key bigint, n_removed bigint, kept binary")
    return scanned.drop("samples"), kept


def passage_digests(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shortest: int = SHORTEST
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: one row per row of the table, see :func:`without_repeated_passages`."""
    scanned, kept = _work_through(docs, id_col, text_col, window, shortest)
    lost = kept.select(F.col("doc_id").alias("_doc_id"), F.col("key").alias("_key"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    joined = scanned.join(lost, (F.col("key") == F.col("_key")) & (F.col("doc_id") == F.col("_doc_id")), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "words_sha256").alias("kept_sha256"),
    )


def without_repeated_passages(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shortest: int = SHORTEST
) -> DataFrame:
    """The documents, each without the words under a window of ``window`` words that a document of a smaller id has too.

    Words are parted by ASCII blanks and compared as they are; windows are judged on the texts as given. A text that loses
    words comes back as its other words, joined by blanks; other texts stay as they are. Rows that share an id
    take nothing from each other; rows without an id neither lose words nor make others lose any. Texts of
    fewer words, empty and null ones stay. ``shortest`` is the length at which the doubling begins.
    """
    _, kept = _work_through(docs, id_col, text_col, window, shortest)
    key, other_id, other_key, text = (fresh_column(docs, c) for c in ("key", "kept_id", "kept_key", "kept"))
    named = kept.select(F.col("doc_id").alias(other_id), F.col("key").alias(other_key), F.col("kept").cast("string").alias(text))
    source = docs.withColumn(key, F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")))
    same = (F.col(key) == F.col(other_key)) & (F.col(f"`{id_col}`").cast("long") == F.col(other_id))
    joined = source.join(named, same, "left")
    return joined.select(*[F.coalesce(text, f"`{c}`").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
