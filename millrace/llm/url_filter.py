"""URL rules kept as a sorted array of 64-bit digests, memory-mapped by every worker."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import columns
from millrace.sinks.storage import scratch_dir

Rule = tuple[str, str, str]  # verdict, host, path

MAX_ARRAY_BYTES = 256 * 1024 * 1024
HOST = r"://([^/?#]*)"
PATH = r"://[^/?#]*([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_HIT = T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])


def url_parts(url: str) -> tuple:
    """Host (A-Z lower-cased) and path of the url column; empty for null or without ``://``."""
    host = F.translate(F.regexp_extract(url, HOST, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")).alias("host"), F.coalesce(F.regexp_extract(url, PATH, 1), F.lit("")).alias("path")


def build_array(rules: Sequence[Rule]) -> bytes:
    """The rules as one file: count, sorted digests, ends of the texts, verdicts, path lengths, texts.

    A rule's text is its host followed by its path. Of rules with the same text the last counts.
    """
    last = {f"{host}{path}": (verdict, path) for verdict, host, path in rules}
    for text, (verdict, path) in last.items():
        if verdict not in ("allow", "block"):
            raise ValueError(f"rule {text!r}: unknown verdict {verdict!r}")
        if path and not path.startswith("/"):
            raise ValueError(f"rule {text!r}: a path starts with /")
    entries = sorted((xxhash.xxh64_intdigest(text.encode()), text.encode(), *rest) for text, rest in last.items())
    ends = np.cumsum([len(e[1]) for e in entries], dtype=np.int64)
    lengths = sorted({len(path) for *_, path in entries})
    return b"".join([
        np.array([len(entries), len(lengths)], dtype=np.int64).tobytes(),
        np.array([e[0] for e in entries], dtype=np.uint64).tobytes(),
        ends.astype(np.int64).tobytes(),
        np.array([e[2] == "block" for e in entries], dtype=np.int64).tobytes(),
        np.array(lengths, dtype=np.int64).tobytes(),
        b"".join(e[1] for e in entries),
    ])


class DigestArray:
    """A rule file mapped into memory: the pages are the system's, shared by all workers of a host."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        rules, lengths = (int(n) for n in raw[:16].view(np.int64))
        ends = np.cumsum([16, *[8 * rules] * 3, 8 * lengths])
        self.keys = raw[ends[0] : ends[1]].view(np.uint64)
        self.text_ends = raw[ends[1] : ends[2]].view(np.int64)
        self.blocks = raw[ends[2] : ends[3]].view(np.int64)
        self.path_lengths = raw[ends[3] : ends[4]].view(np.int64).tolist()
        self.texts = raw[ends[4] :]

    def text(self, i: int) -> bytes:
        return self.texts[self.text_ends[i - 1] if i else 0 : self.text_ends[i]].tobytes()

    def probe(self, candidates: list[bytes]) -> np.ndarray:
        """Index of the rule whose text each candidate is, else -1.

        One binary search over all candidates; the stored text decides, also between digests
        that several texts share.
        """
        digests = np.fromiter(map(xxhash.xxh64_intdigest, candidates), dtype=np.uint64, count=len(candidates))
        first = np.searchsorted(self.keys, digests, "left")
        last = np.searchsorted(self.keys, digests, "right")
        found = np.full(len(candidates), -1, dtype=np.int64)
        for c in np.flatnonzero(first < last):
            found[c] = next((i for i in range(first[c], last[c]) if self.text(i) == candidates[c]), -1)
        return found


@lru_cache(maxsize=4)
def _mapped(name: str) -> DigestArray:
    return DigestArray(SparkFiles.get(name))


def candidates_of(host: str, path: str, path_lengths: list[int]) -> list[bytes]:
    """Texts of all rules that could fit: the host and each parent domain, with each path start that long."""
    labels = host.split(".")
    hosts = [".".join(labels[i:]) for i in range(len(labels))]
    starts = [path[:n] for n in path_lengths if n <= len(path)]
    return [f"{h}{p}".encode("utf-8", "replace") for h in hosts for p in starts if h]


def judge_urls(pages: DataFrame, rules: Sequence[Rule], *, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest
    text wins. Without a fitting rule the rule is null and the verdict is allow. Null urls and
    urls without ``://`` have an empty host and path, which no rule fits. Repeated pages give
    repeated rows, null ids stay. Rule lists over ``MAX_ARRAY_BYTES`` are joined by a shuffle.
    """
    parts = columns(pages, page_id=id_col, url=url_col).select("page_id", *url_parts("url"))
    raw = build_array(rules)
    if len(raw) > MAX_ARRAY_BYTES:
        return _judge_by_join(parts, rules)
    name = _share_file(pages.sparkSession, raw)
    schema = T.StructType([*parts.schema.fields, *_HIT.fields])

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        array = _mapped(name)
        for batch in batches:
            texts, owner = [], []
            for row, (host, path) in enumerate(zip(batch["host"], batch["path"], strict=True)):
                own = candidates_of(host, path, array.path_lengths)
                texts += own
                owner += [row] * len(own)
            found = array.probe(texts)
            best: dict[int, int] = {}
            for c in np.flatnonzero(found >= 0):
                row = owner[c]
                if row not in best or len(texts[c]) > len(array.text(best[row])):
                    best[row] = int(found[c])
            rule = [array.text(best[r]).decode() if r in best else None for r in range(len(batch))]
            verdict = ["block" if r in best and array.blocks[best[r]] else "allow" for r in range(len(batch))]
            yield batch.assign(rule=pd.Series(rule, dtype=object, index=batch.index), verdict=verdict)

    return parts.mapInPandas(judged, schema)


def _share_file(spark: SparkSession, raw: bytes) -> str:
    """Put the file into the shared folder, from which Spark copies it to every executor."""
    name = f"rules_{uuid.uuid4().hex}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark, 'rules')}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    for start in range(0, len(raw), 1 << 22):
        out.write(bytearray(raw[start : start + (1 << 22)]))
    out.close()
    spark.sparkContext.addFile(path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString())
    return os.path.basename(name)


def _judge_by_join(parts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The same rows by an equi-join with the rule texts, for lists too long to copy to every executor."""
    spark = parts.sparkSession
    last = {f"{host}{path}": (verdict, len(path)) for verdict, host, path in rules}
    lengths = sorted({n for _, n in last.values()})
    table = spark.createDataFrame([(t, v) for t, (v, _) in last.items()], "rule string, verdict string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = [F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths] or [F.lit(None).cast("string")]
    numbered = parts.withColumn("row", F.monotonically_increasing_id())
    probes = (
        numbered.select("row", F.explode(suffixes).alias("suffix"), F.array(*starts).alias("starts"))
        .where("suffix != ''").select("row", "suffix", F.explode("starts").alias("start"))
        .where("start is not null").select("row", F.concat("suffix", "start").alias("rule"))
    )
    best = probes.join(table, "rule").groupBy("row").agg(
        F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("hit")
    )
    return numbered.join(best, "row", "left").select(
        *parts.columns, F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit("allow")).alias("verdict")
    )
