"""The quality classifier against a version that solves the whole system at once, without Spark."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import quality
from millrace.llm.calibration import BINS, isotonic


def _tables(spark):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        words = [f"{'word' if good else 'W!!'}{k}" for k in rng.integers(0, 200 if good else 9, rng.integers(5, 80))]
        rows.append((i, " ".join(words), "s"))
        if i % 2:
            labels.append((i, int(good), "text", 0.5))
    rows += [(1000, None, "s"), (1001, "", "s"), (None, "word1 word2", "s"), (7, "word1", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, stats string")
    return rows, docs, spark.createDataFrame([*labels, (None, 1, "x", 0.1), (9, None, "x", 0.1)], "doc_id long, quality int, text string, target double")


def test_scores_equal_the_whole_system_solved_at_once(spark):
    rows, docs, labels = _tables(spark)
    calibrates = {
        r["doc_id"]: r["c"] for r in docs.select("doc_id", (F.pmod(F.xxhash64("doc_id"), F.lit(1000)) < int(1000 * quality.CALIBRATION_SHARE)).alias("c")).collect()
    }
    target = {r["doc_id"]: r["quality"] for r in labels.collect() if r["doc_id"] is not None and r["quality"] is not None}
    learns = [(i, t) for i, t, _ in rows if i in target and zlib.crc32(str(i).encode()) % 5]
    x = {k: np.array([quality.statistics(t) for i, t in learns if calibrates[i] is k]) for k in (True, False)}
    y = {k: np.array([float(target[i]) for i, _ in learns if calibrates[i] is k]) for k in (True, False)}

    rng = np.random.default_rng(quality.SEED)
    d = len(quality.STATISTICS)
    frequencies = rng.normal(size=(d, quality.FEATURES)) / np.sqrt(d)
    phases = rng.uniform(0, 2 * np.pi, quality.FEATURES)
    mean, scale = x[False].mean(axis=0), x[False].std(axis=0)
    scale[scale <= 1e-9] = 1

    def features(stats):
        z = np.cos(np.clip((stats - mean) / scale, -5, 5) @ frequencies + phases) * np.sqrt(2 / quality.FEATURES)
        return np.hstack([z, np.ones((len(z), 1))])

    z = features(x[False])
    penalty = np.full(quality.FEATURES + 1, quality.RIDGE * len(z) / quality.FEATURES)
    penalty[-1] = 1e-9
    # The ridge solution as the least squares of the rows with the penalties' roots below them.
    weights = np.linalg.lstsq(np.vstack([z, np.diag(np.sqrt(penalty))]), np.append(y[False], np.zeros(len(penalty))), rcond=None)[0]

    def raw(stats):
        return np.clip((features(stats) @ weights + 0.5) / 2, 0, 1)

    bins = np.round(raw(x[True]) * BINS).astype(int)
    places = np.unique(bins)
    levels = np.clip(isotonic(places, [y[True][bins == b].mean() for b in places], [(bins == b).sum() for b in places]), 0, 1)
    got = quality.quality_scores(docs.repartition(7), labels).collect()
    assert len(got) == len(rows)
    wanted = {}
    for i, text, _ in rows:
        score = float(np.interp(raw(np.array([quality.statistics(text)]))[0], places / BINS, levels))
        wanted.setdefault(i, []).append(score)
    for r in got:
        assert any(r["score"] == pytest.approx(s, abs=1e-4) for s in wanted[r["doc_id"]])
        assert r["predicted"] == int(r["score"] >= quality.THRESHOLD)
        assert r["held_out"] == (None if r["doc_id"] is None else zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in quality.keep_quality(docs, labels).collect())
    assert kept == sorted(
        (i is None, i or 0, t or "") for i, t, _ in rows
        if np.interp(raw(np.array([quality.statistics(t)]))[0], places / BINS, levels) >= quality.THRESHOLD
    )
