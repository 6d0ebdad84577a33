"""Nulls, empty tables and clashing names in the tables beside the documents, and in vectors and pages."""

from millrace.llm import decontaminate, embedding_dedup, url_filter
from millrace.llm.queries import URL_RULES

ITEM = " ".join(f"item{i}" for i in range(20))


def test_benchmark_with_clashing_and_null_columns(spark):
    docs = spark.createDataFrame(
        [(1, f"a {ITEM} b", 0.5, "x"), (None, ITEM, 0.5, "x"), (1, f"a {ITEM} b", 0.5, "x"), (2, None, None, None)],
        "doc_id long, text string, score double, item_id string")
    items = spark.createDataFrame(
        [(7, ITEM, 1, "s", 2), (7, ITEM, 1, "s", 2), (8, None, 1, "s", 2), (None, ITEM, 1, "s", 2), (9, "one", 1, "s", 2), (10, "two words", 1, "s", 2)],
        "item_id long, text string, doc_id long, score string, start long")
    found = sorted((r["doc_id"] or 0, r["item_id"], r["score"], r["start"], r["length"]) for r in decontaminate.find_leaks(docs, items).collect())
    assert found == [(0, 7, 1.0, 0, 20), (1, 7, 1.0, 1, 20), (1, 7, 1.0, 1, 20)]
    assert [r["doc_id"] for r in decontaminate.drop_contaminated(docs, items).collect()] == [2]
    assert decontaminate.drop_contaminated(docs, items).columns == docs.columns


def test_items_of_one_and_two_words_need_all_their_words(spark):
    docs = spark.createDataFrame([(1, "so One it is"), (2, "two more words"), (3, "the two words"), (4, ""), (5, "two of the words"), (6, "words two")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one"), (2, "two words")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"], r["score"]) for r in decontaminate.find_leaks(docs, items).collect()} == {(1, 1, 1.0), (2, 2, 0.75), (3, 2, 1.0)}


def test_vectors_with_clashing_columns_and_none_at_all(spark):
    rows = [(i, [1.0, i / 10], i, "k", "c", "v", [0.0]) for i in range(3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id long, kept string, component_id string, n_links string, v array<double>")
    got = embedding_dedup.near_duplicate_vectors(table)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == [(0, 2, 0, True), (1, 2, 0, False), (2, 2, 0, False)]
    for empty in (table.limit(0), table.where("vec_id = 0").selectExpr("vec_id", "cast(null as array<float>) as embedding", "id")):
        assert [tuple(r) for r in embedding_dedup.near_duplicate_vectors(empty).collect()] == [(0, 0, 0, True)] * empty.count()


def test_pages_with_clashing_columns_and_none_at_all(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x", "h", "p", "r", "v")], "page_id long, url string, host string, path string, rule string, verdict string")
    [row] = url_filter.judge_urls(pages, URL_RULES).collect()
    assert (row["page_id"], row["host"], row["path"], row["rule"], row["verdict"]) == (1, "a.com", "/x", "com/", "allow")
    assert url_filter.judge_urls(pages.limit(0), URL_RULES).count() == 0
