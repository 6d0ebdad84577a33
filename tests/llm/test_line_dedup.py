"""Line dedup: places in longs and in decimals, and a bitmap in which rows share their bits."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import final_plan
from millrace.llm import line_dedup

SCHEMA = "doc_id long, text string"


def made(seed, n=80):
    rng = random.Random(seed)
    line = lambda: " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 16)))
    shared = [line() for _ in range(12)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rng.randrange(1, 7)):
            words = (rng.choice(shared) if rng.random() < 0.5 else line()).split()
            if rng.random() < 0.3:
                words[rng.randrange(len(words))] = "other"
            lines.append(" ".join(words))
        rows.append((i * 3, "\n".join(lines)))
    return rows


def results(spark, rows):
    return {r["doc_id"]: (r["text"], r["n_dropped"]) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_both_kinds_of_places_give_the_same(spark, seed, monkeypatch):
    rows = made(seed)
    by_long = results(spark, rows)
    far = results(spark, [*rows, (2**62, "quite another text")])  # a span that no long holds
    assert {k: v for k, v in far.items() if k != 2**62} == by_long
    assert any(n for _, n in by_long.values())
    monkeypatch.setattr(line_dedup, "_FILTER_BITS", 15)
    monkeypatch.setattr(line_dedup, "_BITMAP", 8)
    assert results(spark, rows) == by_long


def test_only_texts_that_lose_lines_are_moved(spark):
    rows = [(i, f"text {i} alone") for i in range(500)] + [(1000, "text 3 alone")]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA))
    assert found.where("n_dropped > 0").count() == 1
    assert "BroadcastHashJoin" in final_plan(found.where(F.col("doc_id") >= 0))


@pytest.mark.parametrize("fits", [True, False])
def test_moved_texts_and_shared_bits_lose_nothing(spark, fits, monkeypatch):
    """Drops sent to every task or joined by moving texts, with sieves that let much or all pass."""
    rows = made(3)
    plain = results(spark, rows)
    assert any(n for _, n in plain.values())
    monkeypatch.setattr(line_dedup, "fits_in_every_task", lambda df, **bounds: fits)
    monkeypatch.setattr(line_dedup, "_SIEVE_BITS", 7)
    assert results(spark, rows) == plain
    monkeypatch.setattr(line_dedup, "_SIEVE_BITS", 6 if fits else 20)
    assert results(spark, rows) == plain


def test_small_tables_of_drops_move_no_text(spark):
    found = line_dedup.dedup_lines(spark.createDataFrame([(i, f"text {i} alone") for i in range(50)] + [(60, "text 3 alone")], SCHEMA))
    plan = final_plan(found)
    assert "Union" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("blank", ["\t", "\r", "\f", "\x0b", "  ", " \t\r "])
def test_all_ascii_blanks_part_words(spark, blank):
    rows = [(1, "Ab cd"), (2, f"{blank}aB{blank}Cd{blank}"), (3, f"ab{blank}\u00a0cd\n{blank}"), (4, f"abcd\n\n{blank}\nAB CD")]
    assert results(spark, rows) == {1: ("Ab cd", 0), 2: ("", 1), 3: (rows[2][1], 0), 4: (f"abcd\n\n{blank}", 1)}


def test_line_numbers_fit_where_bytes_do_not(spark):
    """Ids so far apart that only the count of lines, not of bytes, leaves room for places in longs."""
    rows = [(0, "a b\n" + "x" * 200), (2**56, "A B\nrest")]
    docs = spark.createDataFrame(rows, SCHEMA)
    _, source = line_dedup._numbered(docs, "row", "doc_id", "text", None)
    assert dict(source.dtypes)["head"] == "bigint"
    assert results(spark, rows) == {0: (rows[0][1], 0), 2**56: ("rest", 1)}
