"""The pipeline's stages and ``run`` against plain versions, on documents with planted cases."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import quality


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    rng = np.random.default_rng(8)
    line = lambda n: " ".join(f"word{k}" for k in rng.integers(0, 4000, n))
    items = [line(n).split() for n in (18, 25, 40)]
    shared, texts = [line(12), line(14), "short shared line"], []
    for i in range(120):
        lines = [line(int(rng.integers(8, 20))) for _ in range(4)]
        if i % 6 == 0:
            lines.insert(2, shared[i // 6 % 3])
        if i % 10 == 3:
            words = shared[0].split()
            lines.append(" ".join([*words[:4], "else", *words[5:]]))
        texts.append("\n".join(lines))
    for i in range(8):  # near copies in one line, which line dedup does not see: two words of many differ
        words = texts[i].replace("\n", " ").split()
        words[3 + i], words[-4] = "changed", "altered"
        texts += [texts[i].replace("\n", " "), " ".join(words)]
    for j, item in enumerate(items):
        texts.append(line(30) + "\n" + " ".join(w for k, w in enumerate(item) if k % 3 < 2) + "\n" + line(30))
        texts.append(line(30) + "\n" + " ".join(w if k % 4 else "gone" for k, w in enumerate(item)) + "\n" + line(30))
        texts.append(line(30) + "\n" + " ".join(item[: len(item) // 3]) + "\n" + line(30))
    poor = len(texts)
    texts += [" ".join(["BUY!!!", "NOW!!!", "$$$"] * int(n)) for n in rng.integers(5, 60, 60)]
    order = rng.permutation(len(texts))
    docs = [(int(new), texts[old], "en", f"s{old % 3}", int(old >= poor)) for new, old in enumerate(order)]
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = spark.createDataFrame([(*d[:4], 7) for d in docs], "doc_id long, text string, lang string, source string, score int")
    rows.repartition(5).write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(d[0], 1 - d[4], 0) for d in docs], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    benchmark = spark.createDataFrame([(j, " ".join(i)) for j, i in enumerate(items)], "item_id long, text string")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    return folder, {d[0]: d[1] for d in docs}, {d[0]: d[4] for d in docs}, items


def _one_word_apart(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    at = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return any(a[at + x :] == b[at + y :] for x, y in ((1, 1), (1, 0), (0, 1)))


def plain_lines(docs):
    seen, out = [], {}
    for i in sorted(docs):
        kept, dropped = [], 0
        for line in docs[i].split("\n"):
            words = line.lower().split()
            again = words and any(
                words == other or (min(len(words), len(other)) >= 10 and _one_word_apart(words, other)) for other in seen
            )
            if words:
                seen.append(words)
            dropped += bool(again)
            kept += [] if again else [line]
        if "".join(kept).strip() or not dropped:
            out[i] = "\n".join(kept)
    return out


def plain_minhash(docs):
    sets = {}
    for i, text in docs.items():
        words = text.lower().split()
        n = min(5, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in docs:
        for j in docs:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: t for i, t in docs.items() if find(i) == i}


def plain_decontaminate(docs, items):
    def copies(text, item):
        above, most = [0] * (len(item) + 1), 0
        for a in text.lower().split():
            row = [0]
            for k, b in enumerate(item):
                row.append(max(0, above[k] + (2 if a == b else -1), above[k + 1] - 1, row[k] - 1))
            above, most = row, max(most, *row)
        return most >= len(item)

    return {i: t for i, t in docs.items() if not any(copies(t, item) for item in items)}


def test_stages_and_run_match_plain_versions(spark, sf):
    folder, docs, poor, items = sf
    table = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "line_dedup", "minhash", "decontaminate", "packing"]
    predicted = {r["doc_id"]: r["predicted"] for r in quality.quality_scores(table, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    plain = [
        lambda d: {i: t for i, t in d.items() if predicted[i]}, plain_lines, plain_minhash, lambda d: plain_decontaminate(d, items),
    ]
    kept = docs
    for (name, stage), same in zip(list(stages.items())[:-1], plain, strict=True):
        after = stage(spark, spark.createDataFrame([(i, t, "en", "s", 7) for i, t in kept.items()], table.schema), folder)
        assert after.columns == table.columns, name
        before, kept = kept, same(kept)
        assert {r["doc_id"]: r["text"] for r in after.collect()} == kept, name
        assert kept != before, name
        if name == "quality":
            assert set(kept) == {i for i in docs if not poor[i]}

    from tokenizers import Tokenizer

    from millrace.llm import packing

    model = Tokenizer.from_file(packing.default_tokenizer())
    ids = {i: model.encode(t, add_special_tokens=False).ids + [1] for i, t in kept.items()}
    pieces, places = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, folder).collect():
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(own, dtype="<u4").tobytes()) == r["ids_crc32"] and len(own) == r["length"]
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for parts, ends in [(p, len(ids[i])) for i, p in pieces.items()] + [(p, None) for p in places.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == ends if ends else at <= 2048
