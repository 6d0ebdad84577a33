"""Words, hashes, staged tables and connected components, shared by the operators."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import quoted
from millrace.sinks.storage import delete_path, scratch_dir

WORD = r"[^\x20\x09-\x0D]+"
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased; only the ASCII blanks part words. Null: none."""
    return text.encode("utf-8", "replace").lower().split() if isinstance(text, str) else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scattered over the whole range, one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words, in order; with fewer words, none."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        total = hashes[:n].copy()
        for i in range(1, size):
            total = mixed(total) * _MIX[0] + hashes[i : i + n]
    return mixed(total)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a text with fewer words counts as one shingle."""
    hashes = word_hashes(words_of(text))
    if not len(hashes):
        return hashes
    return np.unique(gram_hashes(hashes, min(size, len(hashes))))


def columns(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under the operators' own names; clashing extra columns fall away."""
    return df.select(*[quoted(source).alias(name) for name, source in names.items()])


def fresh_column(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a longer name if the table has one like it in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def crc_fold(id_column: str, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


class Workspace:
    """Tables staged in the cluster's shared folder, so that a lost executor costs no earlier step.

    Each staged table is written whole and read back: the plan behind it runs once, and its
    lineage ends there.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path, self.count = spark, scratch_dir(spark, label), 0

    def stage(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.path}/{self.count}"
        df.write.parquet(path)
        staged = self.spark.read.schema(df.schema).parquet(path)
        staged.staged_at = path
        return staged

    def drop(self, *staged: DataFrame) -> None:
        """Delete staged tables that nothing reads any more."""
        for df in staged:
            delete_path(self.spark, df.staged_at)


    def clear(self) -> None:
        """Delete all staged tables."""
        delete_path(self.spark, self.path)


def connected_components(edges: DataFrame, work: Workspace) -> DataFrame:
    """``(id, component_id)`` for every id that an edge ``(a, b)`` names; smallest id of the component.

    Each round sends every node to the smallest of its neighbourhood and contracts the edges.
    Nodes are ordered by a one-to-one hash of their ids, so chains of rising ids shrink by a
    constant share a round too. A hub's edges meet in a map-side combined minimum and in joins
    against one row per node, which adaptive execution splits. Nulls and loops are left out.
    """
    ids = edges.select("a", "b").where("a is not null and b is not null and a != b")
    nodes = work.stage(ids.select("a").union(ids.select("b")).distinct().select(F.col("a").alias("id")))
    links = work.stage(_ordered(ids.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))))
    labels = work.stage(nodes.select("id", F.xxhash64("id").alias("root")))
    while not links.isEmpty():
        around = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
        lowest = work.stage(
            around.groupBy("node").agg(F.min("other").alias("other"))
            .select("node", F.least("node", "other").alias("root"))
        )
        left = lowest.select(F.col("node").alias("a"), F.col("root").alias("left"))
        right = lowest.select(F.col("node").alias("b"), F.col("root").alias("right"))
        contracted = links.join(left, "a").join(right, "b").select(F.col("left").alias("a"), F.col("right").alias("b"))
        moved = lowest.select(F.col("node").alias("root"), F.col("root").alias("next"))
        old = (links, labels, lowest)
        links = work.stage(_ordered(contracted))
        labels = work.stage(labels.join(moved, "root", "left").select("id", F.coalesce("next", "root").alias("root")))
        work.drop(*old)
    smallest = labels.groupBy("root").agg(F.min("id").alias("component_id"))
    return labels.join(smallest, "root").select("id", "component_id")


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
