"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Workspace, columns, connected_components

THRESHOLD = 0.95
WINDOW = 32
BITS = 64
# Chance that a pair exactly at the threshold comes together in no pass.
MISS = 1e-3
SEED = 7
BLOCK = 1024
SLACK = 1e-9


def bits_for(rows: int, window: int = WINDOW) -> int:
    """Leading bits that part evenly spread rows into runs of half the window's length."""
    return min(BITS, max(1, math.ceil(math.log2(max(2, 2 * rows) / window))))


def passes_for(rows: int, threshold: float = THRESHOLD, window: int = WINDOW) -> int:
    """Passes that leave a chance of ``MISS``: in a pass all vectors that agree in the leading bits are compared."""
    agree = 1 - math.acos(threshold) / math.pi
    return math.ceil(math.log(MISS) / math.log(1 - agree ** bits_for(rows, window)))


def _unit_vectors(vectors: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(id, unit array<double>) of the vectors that can be compared, once per id; and all ids."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x))
    sound = vectors.where("id is not null and v is not null").where(F.size("v") > 0).where(finite)
    largest = F.aggregate("v", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x)))
    scaled = sound.withColumn("largest", largest).where("largest > 0").select("id", F.transform("v", lambda x: x / F.col("largest")).alias("v"))
    unit = scaled.withColumn("norm", norm).select("id", F.transform("v", lambda x: x / F.col("norm")).alias("v"))
    return work.stage(unit.groupBy("id").agg(F.min("v").alias("v"))), vectors.select("id")


def _bit_keys(v: np.ndarray, number: int) -> np.ndarray:
    """The signs of ``BITS`` random projections of the pass, as one sortable number per vector."""
    planes = np.random.default_rng([SEED, number, v.shape[1]]).normal(size=(v.shape[1], BITS))
    signs = (v @ planes > 0).astype(np.uint64)
    keys = (signs << np.arange(BITS - 1, -1, -1, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return (keys ^ np.uint64(1 << 63)).view(np.int64)


class _Forest:
    """Union-find over the ids of one block, so that a block returns at most one link per vector."""

    def __init__(self):
        self.root: dict[int, int] = {}

    def find(self, x: int) -> int:
        self.root.setdefault(x, x)
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def join(self, x: int, y: int) -> bool:
        a, b = self.find(x), self.find(y)
        self.root[max(a, b)] = min(a, b)
        return a != b


def _window_links(ids: np.ndarray, v: np.ndarray, first: int, threshold: float, window: int, forest: _Forest) -> list[tuple]:
    """Links of rows from ``first`` on with the rows up to ``window`` before them, a band of distances at a time."""
    found = []
    for back in range(1, min(window, len(ids) - 1) + 1):
        lo = max(first, back)
        cosines = np.einsum("ij,ij->i", v[lo:], v[lo - back : len(v) - back])
        for i in np.flatnonzero(cosines >= threshold) + lo:
            if forest.join(int(ids[i]), int(ids[i - back])):
                found.append((int(ids[i]), int(ids[i - back])))
    return found


def _copies(unit: DataFrame) -> DataFrame:
    """Links (a, b) of every vector with the smallest id that has an equal one."""
    hashed = unit.select("id", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    groups = hashed.groupBy("h1", "h2").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1")
    return hashed.join(groups, ["h1", "h2"]).where("id != a").select("a", F.col("id").alias("b"))


def _spanning_links(ids: np.ndarray, linked: np.ndarray) -> list[tuple]:
    """One link from the first of every component to each other member, given who is linked."""
    found, seen = [], ~linked.any(axis=1)
    for start in range(len(ids)):
        if seen[start]:
            continue
        seen[start] = True
        reached = np.array([start])
        while len(reached):
            reached = np.flatnonzero(linked[reached].any(axis=0) & ~seen)
            seen[reached] = True
            found += [(int(ids[start]), int(ids[i])) for i in reached]
    return found


def _run_links(keyed: DataFrame, bits: int, threshold: float, window: int, work: Workspace) -> DataFrame | None:
    """Links (a, b) within the runs that agree in the leading bits and are longer than the window; None without such runs.

    Every pair of a run is compared, a pair of blocks at a time; short runs share a task's group.
    """
    keyed = keyed.withColumn("run", F.shiftright("key", BITS - bits))
    runs = work.stage(keyed.groupBy("size", "run").agg(F.count("*").alias("n")).where(F.col("n") > window))
    in_runs = runs.agg(F.sum("n")).first()[0]
    if not in_runs:
        return None
    shares = math.ceil(in_runs / BLOCK)
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("id"), blocks).cast("int")
    share = F.when(blocks == 1, F.pmod(F.xxhash64("size", "run"), F.lit(shares))).otherwise(F.xxhash64("size", "run"))
    rows = keyed.join(runs, ["size", "run"]).select(
        "id", "v", "size", "run", share.alias("share"), block.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"),
    ).withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})

    def compared(group: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, run in group.groupby(["size", "run"]):
            ids, v, own = run["id"].to_numpy(), np.vstack(run["v"]), run["own"].to_numpy()
            low, high = np.flatnonzero(own == run["lo"].iloc[0]), np.flatnonzero(own == run["hi"].iloc[0])
            linked = np.zeros((len(ids), len(ids)), dtype=bool)
            linked[np.ix_(low, high)] = v[low] @ v[high].T >= threshold
            linked |= linked.T
            np.fill_diagonal(linked, False)
            links += _spanning_links(ids, linked)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return rows.groupBy("share", "lo", "hi").applyInPandas(compared, "a long, b long")


def _pass_links(unit: DataFrame, number: int, bits: int, threshold: float, window: int, work: Workspace) -> DataFrame:
    """Links (a, b) between neighbours in the order of one pass, and within its long runs."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, own in batch.groupby(batch["v"].map(len)):
                yield pd.DataFrame({"id": own["id"], "v": own["v"], "size": size, "key": _bit_keys(np.vstack(own["v"]), number)})

    def swept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        block, forest, before, heads, n_heads = TaskContext.get().partitionId(), _Forest(), None, [], 0
        for batch in batches:
            for part in range(0, len(batch), 2 * BLOCK):
                rows = batch.iloc[part : part + 2 * BLOCK]
                if n_heads < window:
                    heads.append(rows.iloc[: window - n_heads])
                    n_heads += len(heads[-1])
                both = rows if before is None else pd.concat([before, rows])
                links = []
                start = 0 if before is None else len(before)
                # Vectors of different lengths cannot be compared; sorted by length first, they do not mix.
                for size, own in both.groupby("size", sort=False):
                    place = np.flatnonzero((both["size"] == size).to_numpy())
                    own_first = int((place < start).sum())
                    links += _window_links(own["id"].to_numpy(), np.vstack(own["v"]), own_first, threshold, window, forest)
                if links:
                    yield _rows(links, block)
                before = both.iloc[-window:]
        if before is not None:
            yield _edge_rows(pd.concat(heads), "head", block)
            yield _edge_rows(before, "tail", block)

    def bordered(group: pd.DataFrame) -> pd.DataFrame:
        ordered = pd.concat([group[group["kind"] == "tail"].sort_values(["size", "key", "a"]), group[group["kind"] == "head"].sort_values(["size", "key", "a"])])
        first, links, forest = int((ordered["kind"] == "tail").sum()), [], _Forest()
        for size in ordered["size"].unique():
            place = np.flatnonzero((ordered["size"] == size).to_numpy())
            own = ordered.iloc[place]
            links += _window_links(own["a"].to_numpy(), np.vstack(own["v"]), int((place < first).sum()), threshold, window, forest)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    keys = unit.mapInPandas(keyed, "id long, v array<double>, size int, key long")
    ordered = keys.repartitionByRange("size", "key", "id").sortWithinPartitions("size", "key", "id")
    swept_rows = work.stage(ordered.mapInPandas(swept, "kind string, block int, a long, b long, v array<double>, size int, key long"))
    borders = swept_rows.where("kind != 'link'").withColumn("border", F.expr("if(kind = 'tail', block + 1, block)"))
    across = borders.groupBy("border").applyInPandas(bordered, "a long, b long")
    links = swept_rows.where("kind = 'link'").select("a", "b").union(across)
    in_runs = _run_links(keys, bits, threshold, window, work)
    return links if in_runs is None else links.union(in_runs)


_FIELDS = ["kind", "block", "a", "b", "v", "size", "key"]


def _rows(links: list[tuple], block: int) -> pd.DataFrame:
    return pd.DataFrame([("link", block, a, b, None, 0, 0) for a, b in links], columns=_FIELDS)


def _edge_rows(rows: pd.DataFrame, kind: str, block: int) -> pd.DataFrame:
    return rows.rename(columns={"id": "a"}).assign(kind=kind, block=block, b=0)[_FIELDS]


def _dealt(pairs: DataFrame, rows: int) -> DataFrame:
    """A column ``share`` for the pairs of blocks (c, q, m) of components: one for each pair of a large component, wherever
    its rows lie now, and about ``BLOCK`` rows of small components together."""
    small = F.pmod(F.xxhash64("c"), F.lit(max(1, math.ceil(rows / BLOCK))))
    return pairs.withColumn("share", F.when(F.col("n") <= BLOCK, small).otherwise(F.xxhash64("c", "q", "m")))


def _link_counts(unit: DataFrame, classes: DataFrame, threshold: float, rows: int, work: Workspace) -> DataFrame:
    """id and n_links, counted within the components (no link leaves one).

    Angles obey the triangle inequality: two vectors whose angles to the component's mean direction
    add up to no more than the threshold's are linked without a look. Only vectors that lie farther
    out than that are compared, block by block against their component, and only counts are returned.
    """
    limit = math.acos(threshold)
    members = work.stage(classes.join(unit, "id").select("id", F.col("component_id").alias("c"), "v"))

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                [(c, len(own), np.sum(own["v"].to_list(), axis=0)) for c, own in batch.groupby("c")], columns=["c", "n", "v"]
            )

    def added(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"c": group["c"].iloc[:1], "n": [group["n"].sum()], "mean": [np.sum(group["v"].to_list(), axis=0)]})

    centres = members.mapInPandas(summed, "c long, n long, v array<double>").groupBy("c").applyInPandas(
        added, "c long, n long, mean array<double>"
    )

    def angled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            angle = np.full(len(batch), np.pi)
            for size, place in batch.groupby(batch["v"].map(len)).indices.items():
                v, mean = np.vstack(batch["v"].iloc[place]), np.vstack(batch["mean"].iloc[place])
                norm = np.maximum(np.linalg.norm(mean, axis=1), 1e-300)
                angle[place] = np.arccos(np.clip(np.einsum("ij,ij->i", v, mean) / norm, -1, 1))
            yield pd.DataFrame({"c": batch["c"], "id": batch["id"], "n": batch["n"], "angle": angle, "v": batch["v"]})

    placed = work.stage(
        members.join(centres, "c").select("c", "id", "n", "v", "mean").mapInPandas(angled, "c long, id long, n long, angle double, v array<double>")
    )
    widest = placed.groupBy("c").agg(F.max("angle").alias("widest"))
    placed = placed.join(widest, "c").withColumn("sure", F.col("angle") + F.col("widest") <= limit - SLACK)
    sure = placed.where("sure").select("id", (F.col("n") - 1).alias("n_links"))
    loose = placed.where("not sure").select("c", "id", "n", "v")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("id"), blocks).cast("int")
    asking = loose.select("c", block.alias("q"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("m"), "id", "v", "n", F.lit(True).alias("asks"))
    open_blocks = loose.select("c", block.alias("q")).distinct()
    answering = placed.select("c", "id", "v", "n", block.alias("m")).join(open_blocks, "c").select(
        "c", "q", "m", "id", "v", "n", F.lit(False).alias("asks")
    )

    def counted(group: pd.DataFrame) -> pd.DataFrame:
        counts = []
        for _, pair in group.groupby(["c", "q", "m"]):
            asks = pair["asks"].to_numpy()
            mine, others = pair[asks], pair[~asks]
            if not len(mine) or not len(others):
                continue
            linked = np.vstack(mine["v"]) @ np.vstack(others["v"]).T >= threshold
            linked &= mine["id"].to_numpy()[:, None] != others["id"].to_numpy()[None, :]
            counts.append(pd.DataFrame({"id": mine["id"].to_numpy(), "n": linked.sum(axis=1)}))
        return pd.concat(counts) if counts else pd.DataFrame({"id": [], "n": []}, dtype="int64")

    compared = _dealt(asking.unionByName(answering), rows).groupBy("share").applyInPandas(counted, "id long, n long")
    return sure.union(compared.groupBy("id").agg(F.sum("n").alias("n_links")))


def near_duplicate_vectors(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, window: int = WINDOW,
) -> DataFrame:
    """One row per distinct id: vec_id, n_links, component_id, kept.

    Equal vectors are merged. The others are ordered by the signs of random projections, once per pass;
    neighbours up to ``window`` rows apart are compared in double precision and linked at a cosine of
    ``threshold``, and so are all pairs that agree in the leading signs, however many rows do: in a dense
    cluster that is every pair of a long run, block by block. The passes' links are united; links within a
    component are then counted exactly, also those of vectors that were never compared. The number of
    passes follows from the number of distinct vectors, the chance of a miss from that number alone.

    Vectors that are null, empty, zero or hold a null or non-finite number are linked with nothing, nor
    are vectors of different lengths. Rows that repeat an id are one vector, the smallest of those
    that can be compared. A null id is one row with no links and no component, kept.
    """
    work = Workspace(vectors.sparkSession, "vectors")
    source = columns(vectors, id=id_col, v=vector_col).select(
        F.col("id").cast("long"), F.col("v").cast("array<double>").alias("v")
    )
    unit, ids = _unit_vectors(source, work)
    links = work.stage(_copies(unit))
    single = unit
    if not links.isEmpty():
        single = work.stage(unit.join(links.select(F.col("b").alias("id")), "id", "left_anti"))
    rows = single.count()
    for number in range(passes_for(rows, threshold, window)):
        own = Workspace(vectors.sparkSession, "vectors_pass")
        links = links.union(work.stage(_pass_links(single, number, bits_for(rows, window), threshold, window, own).distinct()))
        own.clear()
    classes = work.stage(connected_components(links, work))
    counts = _link_counts(unit, classes, threshold, rows, work)
    return (
        ids.distinct().join(classes, "id", "left").join(counts, "id", "left")
        .select(
            F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
