"""The operators on small tables: brute force, edge cases, clashing columns, empty tables."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import (
    decontaminate, embedding_dedup, language_model, licenses, line_dedup, minhash, packing, quality, toxicity, url_filter,
)
from millrace.llm.common import Workspace, connected_components, words_of
from millrace.llm.queries import QUERIES, URL_RULES

DOCS = "doc_id long, text string, lang string, kept string, component_id string, score string, row string, drops string"
LONG = " ".join(f"wort{i}" for i in range(40))
ITEM = " ".join(f"item{i}" for i in range(30))


@pytest.fixture
def odd(spark):
    texts = [None, "", " \n\t ", "a", "a", LONG, LONG + " end", LONG.upper(), "x " * 30_000, f"start {ITEM} stop", "two\nlines\ntwo"]
    rows = [(i, t, "en", "k", "c", "s", "r", "d") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[5], (None, LONG, *rows[0][2:]), (None, None, *rows[0][2:])], DOCS)


@pytest.fixture
def labels(spark):
    rows = [(i, i % 2, i % 2) for i in range(11)] + [(1, 1, 1), (None, 1, 1), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_components(spark, tmp_path):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 102), (100, 100), (None, 5)]
    table = spark.createDataFrame(edges, "a long, b long")
    got = {r["id"]: r["component_id"] for r in connected_components(table, Workspace(spark, "test")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100, 102: 100}


def test_every_operator_takes_odd_and_empty_tables(spark, odd, labels):
    items = spark.createDataFrame([(1, ITEM), (2, None), (None, "x"), (3, "")], "item_id long, text string")
    for docs, n in ((odd, odd.count()), (odd.limit(0), 0)):
        assert quality.quality_scores(docs, labels).count() == n
        assert quality.quality_scores(docs, labels.limit(0)).count() == n
        assert toxicity.toxicity_scores(docs, labels).count() == n
        assert toxicity.toxicity_scores(docs, labels.limit(0)).count() == n
        assert language_model.language_scores(docs).count() == n
        assert line_dedup.dedup_lines(docs).count() == n
        assert minhash.near_duplicates(docs).count() == n
        assert packing.pack(docs).select("doc_id").distinct().count() <= n
        hits = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()}
        assert hits == ({(9, 1)} if n else set())
        assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0
        licenses.scan_licenses(docs).collect()
        for kept in (quality.keep_quality(docs, labels), line_dedup.without_repeated_lines(docs),
                     minhash.keep_one_of_each(docs), decontaminate.drop_contaminated(docs, items)):
            assert kept.columns == docs.columns
            assert kept.count() <= n


def test_near_duplicates_edges(odd):
    rows = {r["doc_id"]: r for r in minhash.near_duplicates(odd).collect() if r["doc_id"] is not None}
    assert [rows[i]["component_id"] for i in (0, 1, 2)] == [0, 1, 2]
    assert rows[4]["component_id"] == 3 and not rows[4]["kept"]
    assert {rows[i]["component_id"] for i in (5, 6, 7)} == {5}
    assert minhash.near_duplicates(odd).where("doc_id is null and not kept").count() == 0


def test_near_duplicates_match_brute_force(spark):
    rng = np.random.default_rng(3)
    base = [f"w{rng.integers(400)}" for _ in range(120)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 5)):
            words[at] = f"n{rng.integers(1000)}"
        rows.append((i, " ".join(words)))
    sets = [minhash._exact_set(t, 3) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        return x if root[x] == x else find(root[x])

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(table, shingle_words=3, threshold=0.85).collect()}
    assert got == {i: find(i) for i in range(len(rows))}


def test_vectors_match_brute_force_and_odd_ones_link_with_nothing(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(6, 16))
    v = [list(map(float, centre[i % 6] + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.4]))) for i in range(200)]
    v += [v[0], [0.0] * 16, None, [], [float("nan")] * 16, [None] + [1.0] * 15, [float("inf")] * 16, [1.0, 2.0]]
    rows = list(enumerate(v))
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicate_vectors(
        spark.createDataFrame([*rows, rows[3], (None, v[0])], "vec_id long, embedding array<double>")).collect()}
    sound = np.array(v[:201])
    unit = sound / np.linalg.norm(sound, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.95) & ~np.eye(201, dtype=bool)
    for i in range(201):
        assert got[i]["n_links"] == linked[i].sum()
        reach = {i}
        while (more := reach | {int(j) for r in reach for j in np.flatnonzero(linked[r])}) != reach:
            reach = more
        assert got[i]["component_id"] == min(reach) and got[i]["kept"] == (i == min(reach))
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(201, 208)) and got[None]["n_links"] == 0
    assert embedding_dedup.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_language_model_base_and_gain(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.collect()
    counts = Counter()
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1:
            counts.update([*words_of(r["text"]), b"\n"])
    n, v = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in language_model.language_scores(docs).collect()}
    for r in rows:
        words = [*words_of(r["text"]), b"\n"]
        g = got[r["doc_id"]]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert g["base_score"] == pytest.approx(base) and g["train_tokens"] == n
        assert (g["n_tokens"], g["n_known"]) == (len(words), sum(counts[w] > 0 for w in words))
    held = [g for g in got.values() if g["held_out"]]
    assert sum(g["score"] for g in held) >= sum(g["base_score"] for g in held)


def test_packing_round_trip(spark, sf_dir):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = packing.pack(docs).collect()
    model = Tokenizer.from_file(packing.default_tokenizer())
    ids = {r["doc_id"]: model.encode(r["text"], add_special_tokens=False).ids + [1] for r in docs.collect()}
    covered, filled = Counter(), {}
    for p in pieces:
        own = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert len(own) == p["length"] and zlib.crc32(np.array(own, dtype="<u4").tobytes()) == p["ids_crc32"]
        assert p["doc_tokens"] == len(ids[p["doc_id"]])
        covered[p["doc_id"]] += p["length"]
        filled.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert covered == {d: len(i) for d, i in ids.items()}
    padding = 0
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and len(parts) <= packing.MAX_SEGMENTS
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 0.01 * sum(covered.values())


@pytest.mark.parametrize("text", [" a  b", "x <|endoftext|> y", "a\n b\n\n c", "a\x1cb  d", "don't 12 3a!?", "\ta ", "é 漢字 😀 x́", "  "])
def test_tokenizer_equals_the_library(text):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    own = packing.ByteTokenizer(open(path, encoding="utf-8").read())
    assert np.frombuffer(own.ids(text), dtype="<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_cutting_a_long_document_copies_little():
    ids, loss = np.arange(500_000, dtype="<u4").tobytes(), bytes([0, 1]) * 250_000
    rest, starts, buffers = packing.Example(1, ids, 500_000, loss=loss), [], set()
    while rest.tokens > 2048:
        head, rest = rest.split(2048)
        starts.append(head.start)
        buffers.add(len(rest.ids.obj))
        assert head.loss_tokens == 1024 and len(head.ids.obj) == 4 * 2048 and len(rest.ids.obj) <= 2 * len(rest.ids)
        assert zlib.crc32(head.ids) == zlib.crc32(ids[4 * head.start : 4 * (head.start + 2048)])
    assert len(buffers) < 10 and rest.loss_tokens == sum(loss[rest.start :]) and starts == list(range(0, 500_000 - 2048, 2048))


def test_packing_respects_loss_and_segments(spark):
    rows = spark.createDataFrame([(i, "b " * 50, "a " * 30) for i in range(300)], "doc_id long, text string, prompt string")
    pieces = packing.pack(rows, prompt_col="prompt", max_segments=5, max_loss=200).collect()
    segments, loss = Counter(p["sequence_id"] for p in pieces), Counter()
    for p in pieces:
        loss[p["sequence_id"]] += p["loss_tokens"]
    assert max(segments.values()) <= 5 and max(loss.values()) <= 200


def test_edited_benchmark_copies_are_found(spark):
    words = ITEM.split()
    edited = " ".join("other" if i % 9 == 4 else w for i, w in enumerate(words))
    docs = spark.createDataFrame([(1, f"{LONG} {edited} {LONG}"), (2, LONG), (3, " ".join(words[:8]))], "doc_id long, text string")
    found = decontaminate.find_leaks(docs, spark.createDataFrame([(7, ITEM)], "item_id long, text string")).collect()
    assert [(r["doc_id"], r["item_id"], r["start"], r["length"]) for r in found] == [(1, 7, 40, 30)]


def test_copies_with_every_fourth_word_replaced_are_found(spark):
    items = {n: [f"n{n}w{i}" for i in range(n)] for n in (16, 20, 30, 43, 59)}
    edited = {n: " ".join(f"other{i}" if i % 4 == 3 else w for i, w in enumerate(words)) for n, words in items.items()}
    rows = [(100 * n + k, f"{LONG} {text} {LONG}") for n, text in edited.items() for k in range(20)]
    verbatim = [(10_000 + n, " ".join(words)) for n, words in items.items()]
    benchmark = spark.createDataFrame([(n, " ".join(words)) for n, words in items.items()], "item_id long, text string")
    for extra in ([], verbatim):
        docs = spark.createDataFrame([*rows, *extra], "doc_id long, text string")
        found = decontaminate.find_leaks(docs, benchmark).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == {(i, i // 100) for i, _ in rows} | {(i, i - 10_000) for i, _ in extra}
        assert all(r["start"] == 40 for r in found if r["doc_id"] < 10_000)


def test_leaks_match_brute_force(spark):
    rng = np.random.default_rng(5)
    items = [[f"v{k}" for k in rng.integers(0, 60, rng.integers(6, 25))] for _ in range(12)]
    rows = []
    for i in range(80):
        words = [f"v{k}" for k in rng.integers(0, 60, rng.integers(10, 90))]
        copy = [w if rng.random() > (i % 4) * 0.12 else "x" for w in items[i % 12]]
        rows.append((i, " ".join(words + copy * (i % 5 > 0) + words[:7])))
    wanted = set()
    for i, text in rows:
        text = words_of(text)
        for j, item in enumerate(items):
            item = [w.encode() for w in item]
            score, above = 0, [0] * (len(item) + 1)
            for a in text:
                row = [0]
                for k, b in enumerate(item):
                    row.append(max(0, above[k] + (2 if a == b else -1), above[k + 1] - 1, row[k] - 1))
                score, above = max(score, *row), row
            if score >= len(item):
                wanted.add((i, j, score / (2 * len(item))))
    found = decontaminate.find_leaks(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame([(j, " ".join(item)) for j, item in enumerate(items)], "item_id long, text string")).collect()
    assert len(wanted) > 40 and {(r["doc_id"], r["item_id"], r["score"]) for r in found} == wanted


def test_copies_without_three_words_in_a_row_are_found(spark):
    items = {j: [f"i{j}_{k}" for k in range(n)] for j, n in enumerate((16, 20, 30, 43, 59))}
    edits = {
        "third word replaced": lambda k, w: ["other"] if k % 3 == 2 else [w],
        "third word dropped": lambda k, w: [] if k % 3 == 2 else [w],
        "word put in after each": lambda k, w: [w, f"in{k}"],
    }
    rows = [
        (100 * e + j, " ".join(["before"] * 30 + [x for k, w in enumerate(item) for x in edit(k, w)] + ["after"] * 30))
        for e, edit in enumerate(edits.values()) for j, item in items.items()
    ]
    rows += [(1000 + j, " ".join(item[::-1])) for j, item in items.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(j, " ".join(item)) for j, item in items.items()], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert found == {(i, i % 100) for i, _ in rows if i < 1000}


def test_alignment_carries_what_a_whole_matrix_tells():
    rng = np.random.default_rng(3)
    for _ in range(300):
        text, item = rng.integers(0, 6, rng.integers(1, 30)), rng.integers(0, 6, rng.integers(1, 14))
        score, first, last, matched = decontaminate.align(text.astype(np.uint64), item.astype(np.uint64))
        whole = np.zeros((len(text) + 1, len(item) + 1), dtype=int)
        for i, a in enumerate(text, 1):
            for j, b in enumerate(item, 1):
                whole[i, j] = max(0, whole[i - 1, j - 1] + (2 if a == b else -1), whole[i - 1, j] - 1, whole[i, j - 1] - 1)
        assert score == whole.max()
        if score:
            # The reported passage alone aligns as well, from its first word to its last.
            part = text[first : last + 1].astype(np.uint64)
            assert decontaminate.align(part, item.astype(np.uint64)) == (score, 0, len(part) - 1, matched)
            assert text[first] in item and text[last] in item and 2 * matched >= score


def test_long_items_need_no_matrix():
    import tracemalloc

    item = [f"w{k}" for k in range(6000)]
    index = decontaminate.SeedIndex([(1, " ".join(item))])
    text = [f"w{k}" if k % 5 else "x" for k in range(6000)] * 2
    numbers = index.encode([w.encode() for w in text])
    tracemalloc.start()
    [(number, score, start, length, matched)] = decontaminate.leaks_in(numbers, index)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (number, start, length, matched) == (0, 1, 5999, 4800) and round(score, 3) == 0.7
    assert peak < 50_000_000


def test_seeds_are_the_rare_pairs():
    index = decontaminate.SeedIndex([(1, " ".join(f"w{k}" for k in range(30)))])
    frequency = np.zeros(len(index.pairs), dtype=np.int64)
    frequency[index.near[:13]] = 1000
    index.rank(frequency)
    assert len(set(index.near[:13]) & set(index.seeds.tolist())) == 0
    assert set(index.near[13:].tolist()) <= set(index.seeds.tolist())


def test_benchmark_items_without_an_id_clean_documents_too(spark):
    docs = spark.createDataFrame([(1, f"{LONG} {ITEM}"), (2, LONG)], "doc_id long, text string")
    items = spark.createDataFrame([(None, ITEM), (None, "some other item")], "item_id long, text string")
    assert [r["doc_id"] for r in decontaminate.drop_contaminated(docs, items).collect()] == [2]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{sf}/labels.parquet")
    for name, label, least in (("op8_quality", "quality", 0.97), ("op7_toxicity", "toxic", 0.95)):
        rows = QUERIES[name](spark, sf).where("held_out").join(truth, "doc_id").collect()
        assert sum(r["predicted"] == r[label] for r in rows) >= least * len(rows)


def test_block_max_index_is_exact():
    rng = np.random.default_rng(0)
    vectors = [{int(t): float(w) for t, w in zip(rng.choice(40, 5, replace=False), rng.random(5), strict=True)} for _ in range(700)]
    index = toxicity.BlockMaxIndex(vectors, 40)
    dense = np.zeros((700, 40))
    for i, v in enumerate(vectors):
        dense[i, list(v)] = list(v.values())
    for i in range(0, 700, 35):
        ids, cosines = index.nearest(vectors[i], 10)
        assert np.allclose(cosines, np.sort(dense @ dense[i])[::-1][:10])


def test_url_array_confirms_texts_and_matches_join(spark, sf_dir):
    pages = spark.createDataFrame(
        [(1, "http://A.example.com/en/x?q"), (2, "no url"), (3, None), (4, "https://www.example.com/en/"), (5, "x://evilexample.com/en/"),
         (6, "http://b.net/es"), (None, "http://b.net/es/#"), (1, "http://net/fr/")], "page_id long, url string")
    got = sorted(map(str, url_filter.judge_urls(pages, URL_RULES).collect()))
    parts = pages.select("page_id", *url_filter.url_parts(pages["url"]))
    assert got == sorted(map(str, url_filter._judge_by_join(parts, URL_RULES).collect()))
    verdicts = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages.where("page_id != 1"), URL_RULES).collect()}
    assert verdicts == {2: (None, "allow"), 3: (None, "allow"), 4: ("www.example.com/en/", "allow"), 5: ("com/", "allow"), 6: (None, "allow")}


def test_rows_with_null_or_repeated_ids_are_documents_of_their_own(spark):
    rows = [(None, f"shared\nown {i}\nshared") for i in range(20)] + [(4, "one\nonly here"), (4, "other\none"), (4, "other\none"), (9, "a\na")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted((r["doc_id"] or 0, r["text"], r["n_dropped"]) for r in line_dedup.dedup_lines(docs).collect())
    nulls = [(0, f"own {i}", 2) for i in range(1, 20)] + [(0, "shared\nown 0", 1)]
    assert got == sorted([*nulls, (4, "one\nonly here", 0), (4, "other", 1), (4, "", 2), (9, "a", 1)])
    kept = sorted(r["text"] for r in line_dedup.without_repeated_lines(docs).collect())
    assert kept == sorted(text for _, text, _ in got if text)


def test_equal_lines_at_one_number_of_two_rows_with_an_id_are_repeats(spark):
    line = " ".join(f"w{i}" for i in range(12))
    rows = [(None, line), (None, line.replace("w5", "x")), (2**63 - 1, line), (2**63 - 1, "new"), (-(2**63), "low"), (2**63 - 1, "low")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [r["text"] for r in line_dedup.dedup_lines(docs).collect()]
    assert sorted(got)[:3] == ["", "", ""] and sorted(got)[3:5] == ["low", "new"] and sorted(got)[5] in (rows[0][1], rows[1][1])


def test_dense_cluster_and_copies_of_vectors_match_brute_force(spark):
    rng = np.random.default_rng(5)

    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)

    centre = unit(rng.normal(size=64))
    members = unit(centre + 0.42 * unit(rng.normal(size=(350, 64))))
    near = unit(members + 0.28 * unit(rng.normal(size=(350, 64))))
    v = np.vstack([members, near, unit(rng.normal(size=(1300, 64))), np.tile(unit(rng.normal(size=64)), (100, 1))])
    linked = v @ v.T >= 0.95
    np.fill_diagonal(linked, False)
    assert linked[:700].any(axis=1).all() and not linked[700:2000].any()
    table = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(v)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicate_vectors(table).collect()}
    smallest = np.arange(len(v))
    while (lower := np.minimum(smallest, np.where(linked, smallest, len(v)).min(axis=1))).tolist() != smallest.tolist():
        smallest = lower
    assert [got[i]["component_id"] for i in range(len(v))] == smallest.tolist()
    assert [got[i]["n_links"] for i in range(len(v))] == linked.sum(axis=1).tolist()
    assert len(set(smallest[:700].tolist())) > 20


def test_passes_leave_no_tables_behind(spark, monkeypatch):
    import os

    spaces = []
    monkeypatch.setattr(embedding_dedup, "Workspace", lambda *a: spaces.append(Workspace(*a)) or spaces[-1])
    rows = [(i, [1.0, float(i % 7), float(i % 3)]) for i in range(60)]
    embedding_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    left = [os.path.exists(space.path.removeprefix("file:")) for space in spaces]
    assert left[0] and len(left) > 2 and not any(left[1:])


def test_block_pairs_of_one_component_get_a_shuffle_of_their_own(spark):
    blocks = spark.range(40_000).selectExpr("7L as c", "id % 20 as q", "id % 19 as m", "20 * 1024L as n").repartition(4, "c")
    small = spark.range(4000).selectExpr("id + 100 as c", "0L as q", "0L as m", "3L as n").repartition(4, "c")
    dealt = embedding_dedup._dealt(blocks.union(small), 4000)
    grouped = dealt.groupBy("share").agg(F.max("c").alias("c"), F.count("*").alias("n"))
    assert "hashpartitioning(share" in grouped._jdf.queryExecution().toString()
    shares = grouped.collect()
    large = [r for r in shares if r["c"] == 7]
    assert len(large) == 380 and max(r["n"] for r in large) < 200
    assert len([r for r in shares if r["c"] != 7]) == 4


def test_lines_one_word_apart_keep_the_earliest(spark):
    line = [f"w{i}" for i in range(12)]
    rows = [
        (1, "\n".join([" ".join(line), "short one"])), (2, "\n".join([" ".join([*line[:5], "x", *line[6:]]), "short two"])),
        (3, " ".join(line[:-1])), (4, " ".join([*line, "y"])), (5, " ".join([*line[:3], "p", "q", *line[5:]])), (6, "SHORT one\n\n"),
    ]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "short two", 3: "", 4: "", 5: rows[4][1], 6: "\n"}
