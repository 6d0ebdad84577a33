"""Periodic runs against a comparison of every text with itself at every shift."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from millrace.llm import periodic, runs
from millrace.llm.queries import QUERIES


def plain_runs(words, min_length=12):
    """(start, length, period) of all maximal runs; quadratic."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array([numbers[w] for w in words], dtype=np.int64)
    found = {}
    for q in range(1, len(words) // 2 + 1):
        equal = np.r_[False, ids[q:] == ids[:-q], False]
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        for start, stop in zip(edges[::2], edges[1::2], strict=True):
            if stop - start >= q:
                found.setdefault((int(start), int(stop) + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= max(min_length, 2 * q))


def ids_of(text):
    return np.array([ord(c) for c in text], dtype=np.int64)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def made_texts(seed):
    rng = random.Random(seed)
    texts = [fibonacci(700), thue_morse(1500), "a" * 500, "ab" * 100 + "b" + "ab" * 100, "", "a", "ababababababa"]
    # a period that is itself highly periodic, and runs of one period that touch
    texts += [("a" * 60 + "b") * 3, ("a" * 60 + "b") * 2, "ab" * 40 + "ba" * 40, ("ab" * 40 + "c") * 2 + "ab" * 9, "abc" * 30 + "bca" * 30 + "cab" * 25]
    texts += ["".join(rng.choices("ab", k=rng.randrange(400))) for _ in range(40)]
    texts += ["".join(rng.choices("abcd", k=rng.randrange(900))) for _ in range(20)]
    for _ in range(120):  # powers of powers with faults
        part = "".join(rng.choices("ab", k=rng.randrange(1, 5)))
        for _ in range(rng.randrange(1, 5)):
            part = part * rng.randrange(1, 7) + "".join(rng.choices("abc", k=rng.randrange(3)))
            part = part[rng.randrange(len(part)) :] + part if rng.random() < 0.3 else part
            if len(part) > 1500:
                break
        text = list(part[:3000])
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = rng.choice("abc")
        texts.append("".join(text))
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_match_brute_force(seed):
    texts = made_texts(seed)
    got = runs.maximal_runs([ids_of(t) for t in texts])
    for text, rows in zip(texts, got, strict=True):
        assert [tuple(r) for r in rows.tolist()] == plain_runs(list(text)), text[:80]


def test_runs_with_few_hashes_kept(monkeypatch):
    monkeypatch.setattr(runs, "_HELD", 0)
    texts = made_texts(4)
    for text, rows in zip(texts, runs.maximal_runs([ids_of(t) for t in texts]), strict=True):
        assert [tuple(r) for r in rows.tolist()] == plain_runs(list(text)), text[:80]


def test_long_texts():
    rng = random.Random(1)
    part = [rng.randrange(1000) for _ in range(20_000)]
    text = np.array([5] * 1000 + part * 3 + part[:77] + [9, 9, 3] * 30_000 + list(range(50_000)), dtype=np.int64)
    rows = {tuple(r) for r in runs.maximal_runs([text])[0].tolist()}
    assert (1000, 60_077, 20_000) in rows
    assert any(length >= 90_000 - 2 and period == 3 for _, length, period in rows)
    for start, length, period in rows:
        run = text[start : start + length]
        assert (run[period:] == run[:-period]).all()


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *head, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_query_matches_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = sorted((expected(r["doc_id"], r["text"]) for r in docs.collect()), key=str)
    assert rows_of(QUERIES["op12_periodic_runs"](spark, sf_dir)) == want
    assert sum(r[1] > 0 for r in want) > 5


def test_odd_tables(spark, monkeypatch):
    monkeypatch.setattr(periodic, "BATCH_WORDS", 50)
    texts = [None, "", " \n\t ", "a", "a b " * 200, "é x " * 30, "x y " * 20, "q " * 30_000, "one two three " * 4]
    rows = [(i, t, "k", 1) for i, t in enumerate(texts)] + [(None, texts[4], "k", 1), (None, None, "k", 1), (4, texts[4], "k", 1)]
    schema = "doc_id long, text string, runs string, n_words int"
    for table in (rows, []):
        found = periodic.periodic_runs(spark.createDataFrame(table, schema), rewrite=periodic.looped_tail)
        assert rows_of(periodic.run_digests(found)) == sorted((expected(r[0], r[1]) for r in table), key=str)
    whole = periodic.periodic_runs(spark.createDataFrame(rows, schema)).where("doc_id = 8").first()
    assert whole["collapsed"] == "one two three" and [tuple(r) for r in whole["runs"]] == [(0, 12, 3)]
