"""Periodic runs of words in texts, and texts with each run collapsed to its first period."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import columns
from millrace.llm.runs import MIN_LENGTH, maximal_runs

BATCH_WORDS = 2**18  # texts worked on at once; a longer text is a batch of its own

Rewrite = Callable[[list[bytes], int | None], list[bytes]]


def looped_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """A tenth of the texts, by the checksum of the id, with a part of the words repeated to the end.

    Texts without an id stay as they are.
    """
    if doc_id is None or not words:
        return words
    checksum = zlib.crc32(str(doc_id).encode())
    if checksum % 10:
        return words
    rest, n = checksum // 10, len(words)
    at = rest % n
    period = 1 + (n - at) // (3 + rest % 8)
    part = words[at : at + period]
    return words[:at] + (part * ((n - at) // period + 1))[: n - at]


def _numbered(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Words as numbers, equal ones alike."""
    numbers: dict[bytes, int] = {}
    return [np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)) for words in texts]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside the runs and the first period of each, joined by blanks."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)])


def periodic_runs(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
    rewrite: Rewrite | None = None,
) -> DataFrame:
    """doc_id, n_words, runs (start, length, period), collapsed: one row per row of the table.

    Words are parted by ASCII blanks and compared as they are. A run is a stretch of words with a least
    period, at least twice that and ``min_length`` long, that no neighbouring word extends. ``collapsed`` has no word
    that lies in a run behind that run's first period. Texts without words, and nulls, have no runs and an empty
    ``collapsed``; repeated ids and rows are rows of their own; other columns fall away. ``rewrite`` changes a
    text's words beforehand. Every task works on the texts it reads, about ``BATCH_WORDS`` at once.
    """
    source = columns(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text")
    )
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def found(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = maximal_runs(_numbered(texts), min_length)
        rows = np.concatenate(runs)
        values = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], fields=list(run))
        offsets = pa.array(np.r_[0, np.cumsum([len(r) for r in runs])].astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                pa.ListArray.from_arrays(offsets, values),
                pa.array(map(_collapsed, texts, runs), pa.binary()),
            ],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )

    def worked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                words, doc_id = (text.as_py() or b"").split(), doc_id.as_py()
                words = rewrite(words, doc_id) if rewrite else words
                if held and held + len(words) > BATCH_WORDS:
                    yield found(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                held += len(words) + 1
        if ids:
            yield found(ids, texts)

    rows = source.mapInArrow(
        worked, "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary"
    )
    return rows.withColumn("collapsed", F.col("collapsed").cast("string"))


def run_digests(found: DataFrame) -> DataFrame:
    """The rows of :func:`periodic_runs` as counts, the longest run and hashes; four nulls without a run."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("less"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    digested = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("longest"), "n_words",
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    length, period = F.col("longest.length"), -F.col("longest.less")
    return digested.select(
        "doc_id", "n_runs", (-F.col("longest.before")).alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * longest.length div -longest.less").alias("exponent_milli"), "n_words", "runs_sha256", "collapsed_sha256",
    )
