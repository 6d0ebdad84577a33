"""Toxicity against a brute-force version, and on the held-out rows of the given tables."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import toxicity
from millrace.llm.calibration import Calibrator
from millrace.llm.queries import QUERIES

TELLING = ["vile", "rotten", "foul", "nasty"]


def _fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(11)
    texts, labels = [], {}
    for i in range(200):
        words = [f"w{k}" for k in rng.integers(0, 300, rng.integers(3, 60))]
        labels[i] = int(i % 4 == 0)
        if labels[i]:
            words += list(rng.choice(TELLING, 2))
        texts.append(" ".join(rng.permutation(words)))
    texts += [None, "", "?! .", "W1 w1, unseen", "nobody knows these", texts[0], "x" * 40_000 + " vile"]
    labels[206] = 1
    return list(enumerate(texts)), labels


def _weights(rows, labels, counts, toxic):
    n, a, b = len(rows), int(toxic.sum()), int((~toxic).sum())
    frequency = Counter(t for _, text in rows for t in set(toxicity.terms_of(text)))
    terms = sorted({t for c in counts for t in c})
    weights = {}
    for t in terms:
        k, m = (sum(t in c for c, y in zip(counts, toxic, strict=True) if y == side) for side in (True, False))
        table = [(k, a * (k + m)), (m, b * (k + m)), (a - k, a * (a + b - k - m)), (b - m, b * (a + b - k - m))]
        ratio = 2 * sum(seen * math.log(seen * (a + b) / expected) for seen, expected in table if seen)
        weights[t] = toxicity.PLAIN_WEIGHT + math.sqrt(max(0.0, ratio / (2 * math.log(len(terms))) - 1))
        weights[t] *= math.log((1 + n) / (1 + frequency[t])) + 1
    return weights


def test_scores_and_evidence_match_brute_force(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame([(i, t, "a", 0.5) for i, t in rows], "doc_id long, text string, evidence string, score double")
    marks = spark.createDataFrame([(i, y, "x", "y") for i, y in labels.items()], "doc_id long, toxic int, text string, target string")
    got = {r["doc_id"]: r for r in toxicity.toxicity_scores(docs.repartition(5), marks).collect()}

    sample = sorted((i for i in labels if _fold(i) and i != 206), key=str)
    counts = [Counter(toxicity.terms_of(rows[i][1])) for i in sample]
    toxic = np.array([bool(labels[i]) for i in sample])
    kept = toxicity.one_per_copy_group(counts, toxic)
    sample, counts, toxic = [sample[i] for i in kept], [counts[i] for i in kept], toxic[kept]
    classes = Counter(bool(labels[i]) for i in labels if _fold(i))
    mass = np.array([classes[bool(y)] / (toxic == y).sum() for y in toxic])
    weights = _weights(rows, labels, counts, toxic)
    place = {t: i for i, t in enumerate(weights)}

    def unit(c):
        v = np.zeros(len(place))
        for t, n in c.items():
            if t in place:
                v[place[t]] = (1 + math.log(n)) * weights[t]
        return v / (np.linalg.norm(v) or 1)

    examples = np.array([unit(c) for c in counts])

    def vote(v, without=-1):
        cosines = np.round(examples @ v, 12)
        near = [i for i in np.lexsort((np.arange(len(cosines)), -cosines)) if cosines[i] > 0 and i != without][: toxicity.NEIGHBOURS]
        share = 1 / (1.05 - np.minimum(cosines[near], 1))
        return (float(share @ toxic[near] / share.sum()) if near else None), [sample[i] for i in near]

    raw = np.array([vote(v, i)[0] for i, v in enumerate(examples)])
    calibrate = Calibrator(*toxicity.pooled(raw, toxic.astype(float), mass))
    blank = (mass * toxic).sum() / mass.sum()
    for i, text in rows:
        share, near = vote(unit(Counter(toxicity.terms_of(text))))
        wanted = blank if share is None else calibrate(np.array([share]))[0]
        assert got[i]["score"] == pytest.approx(wanted, abs=1e-9) and got[i]["evidence"] == near
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.5) and got[i]["held_out"] == (_fold(i) == 0)
    held = [i for i in labels if got[i]["held_out"]]
    assert all(got[i]["predicted"] == labels[i] for i in held) and sum(labels[i] for i in held) > 5


def test_copies_teach_once():
    rng = np.random.default_rng(2)
    base = [f"c{k}" for k in range(100)]
    copies = [[w if rng.random() > 0.1 else f"n{rng.integers(10**6)}" for w in base] for _ in range(40)]
    others = [[f"o{k}" for k in rng.integers(0, 5000, 100)] for _ in range(200)]
    kept = toxicity.one_per_copy_group([Counter(w) for w in [*copies, *others]], np.zeros(240, dtype=bool))
    assert sum(i < 40 for i in kept) <= 3 and sum(i >= 40 for i in kept) >= 195


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_held_out_toxicity(spark, scale):
    sf = f"/root/testdata/{scale}"
    rows = QUERIES["op7_toxicity"](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.95 * len(rows)
    assert sum(r["predicted"] > r["toxic"] for r in rows) <= 0.01 * len(rows)
