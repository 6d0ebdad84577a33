"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.calibration import BINS, Calibrator
from millrace.llm.common import Workspace, columns, crc_fold, fresh_column

FEATURES = 256
RIDGE = 1e-3
SEED = 20240501
THRESHOLD = 0.3
HELD_OUT_REMAINDER = 0
# Share of the training rows (by a hash of their id) that calibrates and does not fit.
CALIBRATION_SHARE = 0.25

STATISTICS = (
    "log_words", "log_bytes", "word_length", "upper", "digit", "period", "comma", "bang", "bar", "symbol", "other_mark",
    "high_byte", "blank", "distinct_words", "echo", "short_words", "log_lines", "distinct_lines", "words_per_line",
    "top_word", "capital_words",
)
_SYMBOLS = b"#$%&*@^~_=+<>/\\"
_MARKS = b"?;:\"'()[]{}-`"


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text, all shares but the logarithms and means; null counts as empty."""
    raw = text.encode("utf-8", "replace") if isinstance(text, str) else b""
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    size, n = len(raw), len(words)
    distinct: dict[bytes, int] = {}
    for w in words:
        distinct[w] = distinct.get(w, 0) + 1
    lines = [line for line in raw.split(b"\n") if line]
    return [
        np.log1p(n), np.log1p(size), (size - count[32] - count[10]) / n,
        count[65:91].sum() / size, count[48:58].sum() / size, count[46] / n, count[44] / n, count[33] / n, count[124] / n,
        sum(count[c] for c in _SYMBOLS) / n, sum(count[c] for c in _MARKS) / n,
        count[128:].sum() / size, (count[32] + count[10] + count[9]) / size,
        len(distinct) / n, sum(map(bytes.__eq__, words, words[1:])) / n, sum(1 for w in words if len(w) <= 3) / n,
        np.log1p(len(lines)), len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))),
        max(distinct.values()) / n, sum(map(bytes.isupper, words)) / n,
    ]


@dataclass
class QualityModel:
    """Means, deviations, frequencies, phases, weights and the calibration: a few hundred KB at any corpus size."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    calibrator: Calibrator

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        """cos features whose inner products approximate a Gaussian kernel, and a constant."""
        x = np.clip((stats - self.mean) / self.scale, -5, 5)
        z = np.cos(x @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        """The ridge output, which falls in about [-0.5, 1.5], brought to [0, 1]."""
        return np.clip((self.fourier(stats) @ self.weights + 0.5) / 2, 0, 1)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return self.calibrator(self.raw(stats))


def statistics_table(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``stats`` (array<double>) per row."""
    source = columns(docs, doc_id=id_col, text=text_col)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "stats": list(map(statistics, batch["text"]))})

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInPandas(measured, f"doc_id {kind}, stats array<double>")


def _stack(batch: pd.DataFrame) -> np.ndarray:
    return np.vstack(batch["stats"].to_list()) if len(batch) else np.empty((0, len(STATISTICS)))


def targets_of(labels: DataFrame, label_col: str, *, id_col: str = "doc_id") -> DataFrame:
    """doc_id and target (the mean of an id's labels), without null ids and labels."""
    clean = columns(labels, doc_id=id_col, target=label_col).where("doc_id is not null and target is not null")
    return clean.groupBy("doc_id").agg(F.avg(F.col("target").cast("double")).alias("target"))


def fit_quality(stats: DataFrame, targets: DataFrame) -> QualityModel:
    """Fit on the rows of ``stats`` (doc_id, stats) that have a target (doc_id, target).

    Partition sums of the normal equations are added up by Spark, one row of the matrix per
    key; the driver solves a system of ``FEATURES`` + 1 unknowns. All labelled rows count, none
    is sampled. Without any, every score is 0.5.
    """
    rng = np.random.default_rng(SEED)
    d = len(STATISTICS)
    frequencies = rng.normal(size=(d, FEATURES)) / np.sqrt(d)
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    with_fold = stats.join(targets, "doc_id").withColumn(
        "calibrates", F.pmod(F.xxhash64("doc_id"), F.lit(1000)) < int(1000 * CALIBRATION_SHARE)
    )
    fitting = with_fold.where("not calibrates")
    each = [f(F.col("stats")[i]).alias(f"{name}{i}") for i in range(d) for name, f in (("m", F.avg), ("s", F.stddev_pop))]
    moments = fitting.agg(*each).first()
    mean = np.array([moments[f"m{i}"] or 0.0 for i in range(d)])
    scale = np.array([moments[f"s{i}"] or 0.0 for i in range(d)])
    model = QualityModel(
        mean, np.where(scale > 1e-9, scale, 1.0), frequencies, phases, np.zeros(FEATURES + 1), Calibrator([], [], [])
    )

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((FEATURES + 1, FEATURES + 2)), 0
        for batch in batches:
            z = model.fourier(_stack(batch))
            total += z.T @ np.hstack([z, batch["target"].to_numpy()[:, None]])
            n += len(batch)
        if n:
            yield pd.DataFrame({"line": np.arange(FEATURES + 1), "cells": list(total)})

    def added(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"line": group["line"].iloc[:1], "cells": [np.sum(group["cells"].to_list(), axis=0)]})

    sums = fitting.mapInPandas(partial, "line int, cells array<double>")
    rows = sums.groupBy("line").applyInPandas(added, "line int, cells array<double>").collect()
    if rows:
        system = np.array([r["cells"] for r in sorted(rows, key=lambda r: r["line"])])
        gram, right = system[:, :-1], system[:, -1]
        penalty = RIDGE * max(gram[-1, -1], 1.0) * np.eye(FEATURES + 1) / FEATURES
        penalty[-1, -1] = 1e-9
        model.weights = np.linalg.solve(gram + penalty, right)

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"bin": np.round(model.raw(_stack(batch)) * BINS).astype(int), "target": batch["target"]})

    bins = (
        with_fold.where("calibrates").mapInPandas(binned, "bin int, target double")
        .groupBy("bin").agg(F.avg("target").alias("target"), F.count("*").alias("n")).orderBy("bin").collect()
    )
    default = float(system[-1, -1] / system[-1, -2]) if rows else 0.5
    model.calibrator = Calibrator(
        [b["bin"] / BINS for b in bins], [b["target"] for b in bins], [b["n"] for b in bins], default
    )
    return model


def score_statistics(stats: DataFrame, model: QualityModel) -> DataFrame:
    """``stats`` with a column score in [0, 1]; higher means label 1 is likelier."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": shared.value.score(_stack(batch))})

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.select("doc_id", "stats").mapInPandas(scored, f"doc_id {kind}, score double")


def score_text(model: QualityModel, spark) -> Callable[[Column], Column]:
    """A column function from text to score, for filters that keep the table as it is."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        return pd.Series(shared.value.score(np.array(list(map(statistics, texts)))))

    return score


def quality_scores(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Learns from rows whose crc32(id) mod 5 is not 0. Null and empty texts get the score of a text
    without words; a null id is scored, never learnt from, and has held_out null. Repeated rows
    are scored each. Statistics are taken once and staged.
    """
    work = Workspace(docs.sparkSession, "quality")
    stats = work.stage(statistics_table(docs, id_col=id_col, text_col=text_col))
    targets = targets_of(labels, label_col).where(crc_fold("doc_id") != HELD_OUT_REMAINDER)
    model = fit_quality(stats, targets)
    return score_statistics(stats, model).select(
        "doc_id", (crc_fold("doc_id") == HELD_OUT_REMAINDER).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_quality(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns and repeated rows."""
    work = Workspace(docs.sparkSession, "quality")
    stats = work.stage(statistics_table(docs, id_col=id_col, text_col=text_col))
    targets = targets_of(labels, label_col).where(crc_fold("doc_id") != HELD_OUT_REMAINDER)
    model = fit_quality(stats, targets)
    name = fresh_column(docs, "score")
    score = score_text(model, docs.sparkSession)
    return docs.withColumn(name, score(F.col(text_col))).where(F.col(name) >= THRESHOLD).drop(name)
