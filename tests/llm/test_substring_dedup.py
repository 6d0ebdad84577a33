"""Repeated passages against a plain dictionary of all windows."""

import hashlib
import random

import pytest

from millrace.llm import substring_dedup
from millrace.llm.queries import QUERIES


def expected(rows, window=50):
    """(doc_id, n_words, n_removed, kept text) of every row, and whether it lost words."""
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for doc_id, words in split:
        if doc_id is not None:
            for i in range(len(words) - window + 1):
                w = tuple(words[i : i + window])
                first[w] = min(first.get(w, doc_id), doc_id)
    out = []
    for doc_id, words in split:
        covered = [False] * len(words)
        if doc_id is not None:
            for i in range(len(words) - window + 1):
                if first[tuple(words[i : i + window])] < doc_id:
                    covered[i : i + window] = [True] * window
        kept = [w for w, c in zip(words, covered, strict=True) if not c]
        out.append((doc_id, len(words), sum(covered), b" ".join(kept)))
    return out


def digests(rows, window=50):
    return sorted(((i, n, r, hashlib.sha256(k).hexdigest()) for i, n, r, k in expected(rows, window)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def made_rows(seed, window, n):
    """Texts of a few words with copies, edited copies, shared passages, loops and long passages in the middle of others."""
    rng = random.Random(seed)
    fresh = lambda size: [f"w{rng.randrange(3000)}" for _ in range(size)]
    passages = [fresh(rng.randrange(window - 2, 4 * window)) for _ in range(8)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(4)):
            kind = rng.random()
            if kind < 0.4:
                part = list(rng.choice(passages))
                if rng.random() < 0.5:
                    part = part[rng.randrange(len(part)) :] if rng.random() < 0.5 else part[: rng.randrange(len(part))]
                for _ in range(rng.choice([0, 0, 1, 2])):
                    if part:
                        part[rng.randrange(len(part))] = "edited"
            elif kind < 0.5:
                part = ["a", "b"][: rng.randrange(1, 3)] * rng.randrange(2 * window)
            elif kind < 0.7 and rows:
                part = (rng.choice(rows)[1] or "").split()
            else:
                part = fresh(rng.randrange(2 * window))
            words += part
        rows.append((rng.choice([i, i, i, i, n // 2, None]), " ".join(words) if rng.random() < 0.95 else None))
    rows += [(n + i, rows[3][1]) for i in range(40)] + rows[:3]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("window, shortest", [(50, 25), (50, 7), (9, 3), (2, 2)])
def test_digests_match_brute_force(spark, window, shortest):
    if window == 2:
        with pytest.raises(ValueError):
            substring_dedup.passage_digests(spark.createDataFrame([], "doc_id long, text string"), window=2, shortest=2)
        return
    rows = made_rows(window + shortest, window, 150)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert got(substring_dedup.passage_digests(table, window=window, shortest=shortest)) == digests(rows, window)


def test_levels():
    assert substring_dedup.level_lengths(50, 25) == [25, 50]
    assert substring_dedup.level_lengths(50, 6) == [7, 13, 25, 50]


def test_texts_without_their_repeated_passages(spark):
    rows = made_rows(5, 50, 60)
    schema = "doc_id long, text string, key string, kept string, alive int"
    table = spark.createDataFrame([(*r, "k", "t", 1) for r in rows], schema)
    out = substring_dedup.without_repeated_passages(table)
    assert out.columns == table.columns
    want = [(i, k.decode() if lost else t) for (i, t), (_, _, lost, k) in zip(rows, expected(rows), strict=True)]
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted(want, key=str)


def test_query_matches_brute_force(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = digests(docs)
    assert got(QUERIES["op13_substring_dedup"](spark, sf_dir)) == want
    assert sum(r[2] > 0 for r in want) > 5


def test_odd_tables(spark):
    long_text = " ".join(f"é{i % 700}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "x " * 5000), (6, "x " * 5000), (7, long_text), (8, long_text), (None, long_text)]
    for table in (rows, [*rows, *rows], []):
        assert got(substring_dedup.passage_digests(spark.createDataFrame(table, "doc_id long, text string"))) == digests(table)
