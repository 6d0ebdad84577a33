"""Near-duplicate documents by HyperMinHash registers: banding, collision-corrected estimate, exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Workspace, columns, connected_components, fresh_column, mixed, shingle_set, words_of
from millrace.operators.joins import fits_in_every_task

ROWS = 6
# Chance that two sets exactly at the threshold share no band.
MISS = 1e-5
MANTISSA_BITS = 10
ZEROS_BITS = 6
# Pairs are passed over only if their estimate lies so many deviations under the threshold.
ESTIMATE_MARGIN = 5.0
BLOCK = 256
SLICE = 4096


def bands_for(threshold: float) -> int:
    """Bands of ``ROWS`` registers that leave a chance of ``MISS`` at the threshold."""
    return math.ceil(math.log(MISS) / math.log(1 - threshold**ROWS))


def registers_of(shingles: np.ndarray, buckets: int) -> np.ndarray:
    """One 16-bit register per bucket: leading zeros of the bucket's smallest hash, then its mantissa bits.

    The sorted hashes fall into buckets by their value; a bucket without a hash takes the minimum of a
    hash function of its own over the whole set, so that small sets fill all registers as well.
    """
    if not len(shingles):
        return np.empty(0, dtype=np.uint16)
    hashes = np.sort(mixed(shingles ^ np.uint64(0xA0761D6478BD642F)))
    scaled = (hashes >> np.uint64(32)) * np.uint64(buckets)
    bucket = (scaled >> np.uint64(32)).astype(np.int64)
    firsts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    lowest = np.empty(buckets, dtype=np.uint64)
    # What is left of a hash within its bucket, spread over 64 bits again.
    lowest[bucket[firsts]] = (scaled[firsts] << np.uint64(32)) | (hashes[firsts] & np.uint64(0xFFFFFFFF))
    empty = np.ones(buckets, dtype=bool)
    empty[bucket[firsts]] = False
    if empty.any():
        own = mixed(np.flatnonzero(empty).astype(np.uint64) + np.uint64(1))
        lowest[empty] = mixed(hashes[None, :] ^ own[:, None]).min(axis=1)
    return compress(lowest)


def compress(lowest: np.ndarray) -> np.ndarray:
    """Leading zeros (up to 63) in the high bits, the bits after the first one in the low bits."""
    _, exponent = np.frexp(np.maximum(lowest, 1).astype(np.float64))
    length = np.minimum(exponent, 64).astype(np.int64)
    length -= ((lowest >> (length - 1).astype(np.uint64)) == 0) & (lowest > 0)
    zeros = np.minimum(64 - length, 2**ZEROS_BITS - 1)
    shift = length - 1 - MANTISSA_BITS
    mantissa = np.where(
        shift >= 0, lowest >> np.maximum(shift, 0).astype(np.uint64), lowest << np.maximum(-shift, 0).astype(np.uint64)
    ) & np.uint64(2**MANTISSA_BITS - 1)
    return ((zeros.astype(np.uint64) << np.uint64(MANTISSA_BITS)) | mantissa).astype(np.uint16)


def expected_collisions(size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Share of registers in which two disjoint sets agree by chance.

    The minima of sets of n and m hashes have leading zeros z with chances 2^-z scaled by the set
    sizes; given the same z, the mantissas agree in one of 2^MANTISSA_BITS cases.
    """
    total = np.zeros(np.broadcast(size_a, size_b).shape)
    for z in range(2**ZEROS_BITS - 1):
        both = [
            np.exp(-n * 2.0 ** -(z + 1)) - np.exp(-n * 2.0**-z) for n in (np.asarray(size_a, float), np.asarray(size_b, float))
        ]
        total += both[0] * both[1]
    return total * 2.0**-MANTISSA_BITS


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from two register tables (rows: pairs), corrected for chance collisions."""
    agree = (a == b).mean(axis=1)
    buckets = a.shape[1]
    chance = expected_collisions(np.maximum(size_a / buckets, 1), np.maximum(size_b / buckets, 1))
    return np.clip((agree - chance) / (1 - chance), 0, 1)


def sketches(docs: DataFrame, shingle_words: int, threshold: float) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_id (128-bit digest of the set) and registers of each row of (doc_id, text)."""
    buckets = ROWS * bands_for(threshold)

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                shingles = shingle_set(text, shingle_words)
                own = xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) >> 1 if text else 0
                digest = xxhash.xxh128_digest(shingles.tobytes()) if len(shingles) else None
                rows.append((doc, own, len(shingles), digest, registers_of(shingles, buckets).tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "text_hash", "n_shingles", "set_id", "registers"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInPandas(
        sketched, f"doc_id {kind}, text_hash long, n_shingles long, set_id binary, registers binary"
    )


def _band_keys(representatives: DataFrame) -> DataFrame:
    """node, band (hash of the band's number and registers); one row per band."""

    def banded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            table = np.frombuffer(b"".join(batch["registers"]), dtype=np.uint16).reshape(len(batch), -1)
            for band in range(table.shape[1] // ROWS):
                own = np.ascontiguousarray(table[:, band * ROWS : (band + 1) * ROWS])
                keys = [xxhash.xxh64_intdigest(r.tobytes(), band) for r in own]
                yield pd.DataFrame({"node": batch["node"], "band": np.array(keys, dtype=np.uint64).view(np.int64)})

    return representatives.select("node", "registers").mapInPandas(banded, "node long, band long")


def _verified(pairs: DataFrame, sketch: DataFrame, texts: DataFrame, shingle_words: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose full sets are linked: 100 * intersection >= 100 * threshold * union, in whole numbers.

    Pairs whose corrected estimate lies ``ESTIMATE_MARGIN`` deviations under the threshold are not looked at.
    """
    percent = round(100 * threshold)

    def side(name: str) -> DataFrame:
        return sketch.select(F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("registers").alias(f"r_{name}"))

    def estimated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            a, b = (np.frombuffer(b"".join(batch[c]), dtype=np.uint16).reshape(len(batch), -1) for c in ("r_a", "r_b"))
            guess = estimate(a, b, batch["n_a"].to_numpy(), batch["n_b"].to_numpy())
            margin = ESTIMATE_MARGIN * np.sqrt(threshold * (1 - threshold) / a.shape[1])
            yield batch.loc[guess >= threshold - margin, ["a", "b"]]

    near = pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(estimated, "a long, b long")
    sides = near.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, hub, hub_set = [], None, None
            for a, b, text_a, text_b in batch[["a", "b", "text_a", "text_b"]].itertuples(index=False):
                if a != hub:
                    hub, hub_set = a, _exact_set(text_a, shingle_words)
                other = _exact_set(text_b, shingle_words)
                common = len(hub_set & other)
                union = len(hub_set) + len(other) - common
                if union and 100 * common >= percent * union:
                    rows.append((a, b))
            yield pd.DataFrame(rows, columns=["a", "b"], dtype="int64")

    return sides.mapInPandas(verified, "a long, b long")


def _exact_set(text: str | None, size: int) -> set:
    words = words_of(text)
    size = min(size, len(words))
    return set(zip(*(words[i:] for i in range(size)))) if size else set()


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, threshold: float = 0.8,
) -> DataFrame:
    """One row per row of the input: doc_id, n_shingles, component_id, kept.

    Documents are linked if their shingle sets have at least ``threshold`` in common (words lower-cased
    in A-Z; fewer words than a shingle: one shingle). ``component_id`` is the smallest id that links
    reach, ``kept`` whether it is the document's own. Null, empty and wordless texts are linked with
    nothing. Rows with a null id are linked with nothing and kept. Rows that repeat an id are one
    document, whose text is the one with the smallest hash.

    Equal sets are one node. Nodes that share a band are compared with the smallest of their bucket,
    which settles a bucket of copies in one comparison a node. Buckets left in several components
    are compared in blocks, by their full sets and without emitting pairs.
    """
    work = Workspace(docs.sparkSession, "minhash")
    source = columns(docs, doc_id=id_col, text=text_col)
    table = work.stage(sketches(source, shingle_words, threshold))
    known = table.where("doc_id is not null")
    ids = known.groupBy("doc_id").agg(F.min(F.struct("text_hash", "n_shingles", "set_id")).alias("s")).select(
        "doc_id", "s.text_hash", "s.n_shingles", "s.set_id"
    )
    ids = work.stage(ids)
    members = ids.where("set_id is not null")
    nodes = members.groupBy("set_id").agg(F.min("doc_id").alias("node"))
    nodes = work.stage(
        nodes.join(members.withColumnRenamed("doc_id", "node"), ["set_id", "node"])
        .join(known.select(F.col("doc_id").alias("node"), "text_hash", "registers"), ["node", "text_hash"])
        .dropDuplicates(["node"]).select("node", "set_id", "text_hash", "n_shingles", "registers")
    )
    links = _links(work, source, nodes, shingle_words, threshold)
    classes = connected_components(links, work)
    of_set = nodes.join(classes.withColumnRenamed("id", "node"), "node", "left").select(
        "set_id", F.coalesce("component_id", "node").alias("component_id")
    )
    result = ids.join(of_set, "set_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    if known.count() != ids.count():
        result = known.select("doc_id").join(result, "doc_id")
    nameless = table.where("doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return result.union(nameless).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _links(work: Workspace, source: DataFrame, nodes: DataFrame, shingle_words: int, threshold: float) -> DataFrame:
    """a, b: enough links to join what is linked."""
    bands = work.stage(_band_keys(nodes))
    # Staged, so that both sides of the join have a shuffle of their own, which adaptive execution splits at a hot band.
    shared = work.stage(
        bands.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("hi")).where("hub != hi").select("band", "hub")
    )
    members = work.stage(bands.join(shared, "band"))
    work.drop(bands, shared)
    wanted = members.select("node").distinct().join(nodes.select("node", "text_hash"), "node")
    wanted = F.broadcast(wanted) if fits_in_every_task(wanted) else wanted
    texts = source.withColumnRenamed("doc_id", "node").join(wanted, "node")
    texts = work.stage(
        texts.where(_text_hash(F.col("text")) == F.col("text_hash")).select("node", "text").dropDuplicates(["node"])
    )
    pairs = members.where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    stars = work.stage(_verified(pairs, nodes, texts, shingle_words, threshold))
    joined = work.stage(connected_components(stars, work))
    rest = work.stage(_links_in_blocks(members, joined, texts, shingle_words, threshold))
    return stars.union(rest)


def _links_in_blocks(members: DataFrame, joined: DataFrame, texts: DataFrame, shingle_words: int, threshold: float) -> DataFrame:
    """a, b: links between components within the buckets that the stars left in several.

    Each bucket is cut into blocks of about ``BLOCK`` nodes; one task compares two blocks by their
    full sets and returns a spanning forest of the links it finds. Buckets of equal membership are
    taken once.
    """
    percent = round(100 * threshold)
    named = members.join(joined.withColumnRenamed("id", "node"), "node", "left").select(
        "band", "node", F.coalesce("component_id", "node").alias("part")
    )
    split = (
        named.groupBy("band").agg(
            F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("node")).alias("mark"),
        ).where("lo != hi").groupBy("n", "mark").agg(F.min("band").alias("band"))
        .select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    placed = named.join(split, "band").withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    paired = placed.select(
        "band", "node", "part", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "part")

    def compared(group: pd.DataFrame) -> pd.DataFrame:
        nodes, parts = group["node"].to_list(), group["part"].to_list()
        sets = [shingle_set(t, shingle_words) for t in group["text"]]
        sizes = np.array([len(x) for x in sets])
        common = _common(sets)
        linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
        root = {p: p for p in parts}

        def find(p):
            while root[p] != p:
                p = root[p]
            return p

        edges = []
        for x, y in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
            p, q = find(parts[x]), find(parts[y])
            if p != q:
                root[q] = p
                edges.append((nodes[x], nodes[y]))
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return paired.join(texts, "node").groupBy("band", "i", "j").applyInPandas(compared, "a long, b long")


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by matrix products over slices of the shared shingles."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, which, n = np.unique(np.concatenate([*sets, np.empty(0, dtype=np.uint64)]), return_inverse=True, return_counts=True)
    order = np.argsort(which, kind="stable")
    order = order[n[which[order]] > 1]
    which, owner = np.unique(which[order], return_inverse=True)[1], owner[order]
    total = np.zeros((len(sets), len(sets)))
    for lo in range(0, int(which[-1]) + 1 if len(which) else 0, SLICE):
        a, b = np.searchsorted(which, [lo, lo + SLICE])
        table = np.zeros((len(sets), SLICE), dtype=np.float32)
        table[owner[a:b], which[a:b] - lo] = 1
        total += table @ table.T
    return total + np.diag(np.array([len(x) for x in sets]) - np.diag(total))


def _text_hash(text) -> object:
    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([xxhash.xxh64_intdigest(t.encode("utf-8", "replace")) >> 1 if t else 0 for t in texts], dtype="int64")

    return hashed(text)


def keep_one_of_each(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, threshold: float = 0.8,
) -> DataFrame:
    """The documents that are the smallest id of their group of near-duplicates, with all their columns.

    Rows that repeat an id stay or go together; rows with a null id stay.
    """
    groups = near_duplicates(docs, id_col=id_col, text_col=text_col, shingle_words=shingle_words, threshold=threshold)
    name = fresh_column(docs, "dropped")
    dropped = groups.where("not kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(dropped, docs[id_col] == dropped[name], "left_anti")
