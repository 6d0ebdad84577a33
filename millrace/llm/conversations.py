"""Repair of conversation structure by grammar-compressed dynamic programming.

Rows are put in order by a range shuffle, so the rows of one conversation may lie in many tasks, and
become sequences of role/fault symbols in chunks of bounded length. Digrams counted over all
sequences give the rules (Re-Pair, many pairs a round); sequences are then evaluated over the rules'
transfer matrices (:mod:`millrace.llm.turn_grammar`). Texts move once, next to the audits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import Workspace, columns
from millrace.llm.turn_grammar import compressed, count_digrams, grammar

CHUNK = 4096
PAIRS_A_ROUND = 64
MAX_RULES = 1024  # bounds the matrices of a task; sequences are exact whatever rules there are
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")
_ORDER = ("conv_id", "turn", "role", "text_md5")
_PLAN = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows damaged by the checksum of ``conv_id:turn``, modulo 20.

    0 drops the row (no copies), 1 empties its text, 2 takes its sentence ends out, 3 doubles it, 4 makes
    its role ``user``. Null roles, texts and parts of the checksum count as one space.
    """
    blank = F.lit(" ")
    source = columns(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    conv_id, turn, role, text = (F.coalesce(F.col(c).cast("string"), blank) for c in source.columns)
    kind = F.crc32(F.concat(conv_id, F.lit(":"), turn).cast("binary")) % 20
    return source.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _rows(conversations: DataFrame) -> DataFrame:
    """The rows under the operator's names, nulls as one space, with the hash that orders rows of one turn and role."""
    blank = F.lit(" ")
    names = {c: c for c in ("conv_id", "turn", "role", "text")}
    if "copies" in conversations.columns:
        names["copies"] = "copies"
    source = columns(conversations, **names)
    text = F.coalesce(F.col("text").cast("string"), blank)
    copies = F.greatest(F.coalesce("copies", F.lit(1)), F.lit(0)).cast("long") if "copies" in names else F.lit(1).cast("long")
    return source.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("text_md5"), copies.alias("copies"),
    )


def _symbol(role: Column, text: Column) -> Column:
    """``B`` for blank rows, else the role's letter, in upper case if the text breaks off."""
    initial = F.left(role, F.lit(1))
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    whole = F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1)).isin(".", "!", "?")
    return F.when(F.length(F.btrim(text, F.lit(BLANKS))) == 0, "B").when(whole, letter).otherwise(F.upper(letter))


def _marked(rows: DataFrame, work: Workspace) -> DataFrame:
    """Distinct rows without their texts: how often each stands there and whether an earlier turn has the same.

    Equal rows are counted before the shuffle. What a conversation says in several turns meets in a
    map-side combined minimum; grouping by the hash too gives the join a shuffle of its own, which
    adaptive execution splits at a text that one conversation repeats very often.
    """
    lean = work.stage(
        rows.select(*_ORDER, "copies", _symbol(F.col("role"), F.col("text")).alias("symbol"))
        .groupBy(*_ORDER).agg(F.sum("copies").alias("copies"), F.min("symbol").alias("symbol"))
    )
    said = ("conv_id", "role", "text_md5")
    first = F.min(F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")).alias("first")
    again = (
        lean.where("copies > 0 and symbol != 'B'").groupBy(*said, F.hash(*said).alias("_hash"))
        .agg(first, F.count(F.lit(1)).alias("turns")).where("turns > 1")
        .select(*[F.col(c).alias(f"_{c}") for c in said], F.col("first.turn").alias("_turn"), F.lit(True).alias("_several"))
    )
    joined = lean.join(again, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in said], "left")
    repeats = F.col("_several").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_turn"))
    marked = work.stage(joined.select(*lean.columns, F.left("role", F.lit(1)).alias("initial"), repeats.alias("repeats")))
    work.drop(lean)
    return marked


_CHUNKS = [
    ("part", pa.int32()), ("seq", pa.int64()), ("symbols", pa.string()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("first_initial", pa.string()), ("last_initial", pa.string()),
    ("low_turn", pa.int64()), ("high_turn", pa.int64()), ("turns", pa.int64()),
]
_CHUNK_DDL = (
    "part int, seq bigint, symbols string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "first_initial string, last_initial string, low_turn bigint, high_turn bigint, turns bigint"
)


class _Chunk:
    """Symbols and counts of some consecutive rows of one conversation."""

    def __init__(self, conv_id, seq: int):
        self.conv_id, self.seq, self.symbols, self.size = conv_id, seq, [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_initial = self.last_initial = self.low_turn = self.high_turn = None

    def row(self, initial: str, turn: int | None) -> None:
        if self.last_initial is None:
            self.first_initial = initial
        elif self.last_initial + initial not in LEGAL:
            self.illegal += 1
        self.last_initial = initial
        if turn is not None:
            if self.high_turn != turn:
                self.turns += 1
            self.low_turn = turn if self.low_turn is None else self.low_turn
            self.high_turn = turn

    def values(self, part: int) -> tuple:
        return (self.conv_id, part, self.seq, "".join(self.symbols), self.blank, self.duplicate, self.truncated, self.illegal,
                self.first_initial, self.last_initial, self.low_turn, self.high_turn, self.turns)


def _batches(kind: pa.DataType, fields: list, rows: Iterator[tuple], size: int = 2000) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", kind), *fields])
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held = []
    if held:
        yield batch()


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered rows as chunks of symbols; a conversation without rows gives one empty chunk."""
    from pyspark import TaskContext

    part, kind = TaskContext.get().partitionId(), []

    def chunks() -> Iterator[tuple]:
        chunk = None
        for batch in batches:
            kind[:] = [batch.schema.field("conv_id").type]
            for conv_id, turn, initial, symbol, copies, repeats in zip(*[batch.column(c).to_pylist() for c in _CHUNK_INPUT], strict=True):
                if chunk is None or chunk.conv_id != conv_id:
                    if chunk:
                        yield chunk.values(part)
                    chunk = _Chunk(conv_id, 0)
                for i in range(copies):
                    if chunk.size == CHUNK:
                        yield chunk.values(part)
                        chunk = _Chunk(conv_id, chunk.seq + 1)
                    chunk.size += 1
                    chunk.row(initial, turn)
                    if symbol == "B":
                        chunk.blank += 1
                        chunk.symbols.append("D")
                    elif repeats or i:
                        chunk.duplicate += 1
                        chunk.symbols.append("D")
                    else:
                        chunk.truncated += symbol.isupper()
                        chunk.symbols.append(symbol)
        if chunk:
            yield chunk.values(part)

    rows = chunks()
    head = next(rows, None)
    if head is not None:
        yield from _batches(kind[0], _CHUNKS, _with(head, rows))


_CHUNK_INPUT = ("conv_id", "turn", "initial", "symbol", "copies", "repeats")


def _with(head: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
    yield head
    yield from rows


def learn_rules(chunks: DataFrame, work: Workspace) -> tuple[str, ...]:
    """Re-Pair over all sequences: the most frequent pairs of neighbours become rules, round by round.

    Pairs are counted where the (distinct) sequences lie and added up by Spark; ``PAIRS_A_ROUND`` of them
    come to the driver a round, until no pair occurs twice or there are ``MAX_RULES`` rules.
    """
    sequences = work.stage(chunks.where("symbols != ''").groupBy("symbols").agg(F.count(F.lit(1)).alias("times")))
    rules: list[str] = []
    while len(rules) < MAX_RULES:
        known = tuple(rules)

        def counted(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, times = (batch.column(c).to_pylist() for c in ("symbols", "times"))
                counts = count_digrams((compressed(s, known), n) for s, n in zip(texts, times, strict=True))
                yield pa.RecordBatch.from_pydict({"pair": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})

        pairs = sequences.mapInArrow(counted, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
        best = pairs.orderBy(F.desc("n"), "pair").limit(min(PAIRS_A_ROUND, MAX_RULES - len(rules))).collect()
        if not best:
            break
        rules += [r["pair"] for r in best]
    work.drop(sequences)
    return tuple(rules)


def _plans(chunks: DataFrame, rules: tuple[str, ...]) -> DataFrame:
    """One row per conversation: the counts of its chunks put together, cost and audit."""

    def evaluated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, kind = grammar(rules).repair, []

        def records() -> Iterator[tuple]:
            for batch in batches:
                kind[:] = [batch.schema.field("conv_id").type]
                yield from zip(*[batch.column(c).to_pylist() for c in ("conv_id", *[n for n, _ in _CHUNKS])], strict=True)

        def plans() -> Iterator[tuple]:
            rest = records()
            ahead = next(rest, None)
            while ahead is not None:
                conv_id, total, known = ahead[0], _Totals(), {}

                def own() -> Iterator[str]:
                    nonlocal ahead
                    while ahead is not None and ahead[0] == conv_id:  # noqa: B023
                        total.add(*ahead[4:])  # noqa: B023
                        yield ahead[3]
                        ahead = next(rest, None)

                cost, audit = repair(own())
                yield conv_id, total.gaps(), total.blank, total.duplicate, total.truncated, total.illegal, cost, str(audit)

        rows = plans()
        head = next(rows, None)
        if head is not None:
            fields = [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())]
            yield from _batches(kind[0], fields, _with(head, rows), 500)

    kind = chunks.schema["conv_id"].dataType.simpleString()
    ordered = chunks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return ordered.mapInArrow(evaluated, f"conv_id {kind}, {_PLAN}")


class _Totals:
    """Counts of a conversation over its chunks, which come in order."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.last = self.low = self.high = None

    def add(self, blank, duplicate, truncated, illegal, first_initial, last_initial, low, high, turns) -> None:
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.illegal += illegal
        if first_initial is not None:
            self.illegal += self.last is not None and self.last + first_initial not in LEGAL
            self.last = last_initial
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low = low if self.low is None else self.low
            self.high = high

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def repair_plans(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit: the cheapest repair of every conversation.

    Takes conv_id, turn, role, text and, if there, copies: how often a row stands there (0: it only names its
    conversation); other columns are left out. Rows come by turn, nulls first, then by role and the MD5 of the
    text. The audit has one letter an edit: K keeps a row, R gives it the role user or assistant (cost 3), D
    deletes it (4, required for blank rows and for those whose role and text came earlier), I puts in an empty
    row of either role (3); a truncated row that stays costs 3 more. What is left has the role initials
    ``(s?(ua)+)?``; of the cheapest audits the ASCII-least is taken. Null roles and texts count as one space, rows
    without a conv_id are one conversation, an empty role is none of the three. A conversation without rows has
    zeros and an empty audit; an empty table gives no rows.
    """
    return _planned(_rows(conversations), Workspace(conversations.sparkSession, "turns"))


def _planned(rows: DataFrame, work: Workspace) -> DataFrame:
    marked = _marked(rows, work)
    kind = rows.schema["conv_id"].dataType.simpleString()
    ordered = marked.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).select(*_CHUNK_INPUT)
    chunks = work.stage(ordered.mapInArrow(_chunked, f"conv_id {kind}, {_CHUNK_DDL}"))
    work.drop(marked)
    return work.stage(_plans(chunks, learn_rules(chunks, work)))


class _Repair:
    """Follows an audit: which role the next row takes, and what is put in before it."""

    def __init__(self, audit: str):
        self.audit, self.at, self.after_user = audit, 0, False

    def _taken(self, initial: bytes | None) -> bytes:
        """The role of the next row, its own if it is kept."""
        role = b"assistant" if self.after_user else b"user"
        self.after_user = (initial or role[:1]) == b"u"
        return role

    def inserted(self) -> Iterator[tuple[str, bytes, bytes]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield "I", self._taken(None), b""

    def row(self, role: bytes, text: bytes) -> Iterator[tuple[str, bytes, bytes]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._taken(role[:1])
            yield edit, role, text
        elif edit == "R":
            yield edit, self._taken(None), text


def _beside_plans(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Every conversation's plan, followed by its rows in order; one task reads a conversation as a stream."""
    texts = rows.where("copies > 0").select(
        *_ORDER, F.lit(1).alias("kind"), F.col("text"), F.lit(None).cast("string").alias("audit"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).drop("copy")
    heads = plans.select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("binary").alias("text_md5"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("text"), "audit",
    )
    ordered = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text_md5")
    return ordered.select("conv_id", "kind", "audit", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"))


def _conversations(batches: Iterator[pa.RecordBatch], kind: list) -> Iterator[tuple]:
    """(conv_id, edit, role, text) of every repaired row; before each conversation (conv_id, None, None, None)."""
    conv_id = repair = None
    for batch in batches:
        kind[:] = [batch.schema.field("conv_id").type]
        for found, row_kind, audit, role, text in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
            if row_kind == 0:
                if repair:
                    yield from ((conv_id, *r) for r in repair.inserted())
                conv_id, repair = found, _Repair(audit)
                yield conv_id, None, None, None
            else:
                yield from ((conv_id, *r) for r in repair.row(role, text))
    if repair:
        yield from ((conv_id, *r) for r in repair.inserted())


def repaired_rows(conversations: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, position, edit, role, text: what :func:`repair_plans` leaves of the conversations."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind: list = []

        def numbered() -> Iterator[tuple]:
            position = 0
            for conv_id, edit, role, text in _conversations(batches, kind):
                if edit is None:
                    position = 0
                else:
                    yield conv_id, position, edit, role, text
                    position += 1

        found = numbered()
        head = next(found, None)
        if head is not None:
            fields = [("position", pa.int64()), ("edit", pa.string()), ("role", pa.binary()), ("text", pa.binary())]
            yield from _batches(kind[0], fields, _with(head, found))

    kind = plans.schema["conv_id"].dataType.simpleString()
    out = _beside_plans(_rows(conversations), plans).mapInArrow(rows, f"conv_id {kind}, position bigint, edit string, role binary, text binary")
    return out.select("conv_id", "position", "edit", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))


def repaired_digests(conversations: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: the hash of every repaired conversation's ``role:text`` lines.

    The hash runs along as the rows come, so a conversation of any length takes a batch of memory.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind: list = []

        def digests() -> Iterator[tuple]:
            conv_id = digest = None
            empty = True
            for found, edit, role, text in _conversations(batches, kind):
                if edit is None:
                    if digest:
                        yield conv_id, digest.hexdigest()
                    conv_id, digest, empty = found, hashlib.sha256(), True
                    continue
                digest.update((b"" if empty else b"\n") + role + b":")
                digest.update(text)
                empty = False
            if digest:
                yield conv_id, digest.hexdigest()

        found = digests()
        head = next(found, None)
        if head is not None:
            yield from _batches(kind[0], [("repaired_sha256", pa.string())], _with(head, found))

    kind = plans.schema["conv_id"].dataType.simpleString()
    return _beside_plans(_rows(conversations), plans).mapInArrow(hashed, f"conv_id {kind}, repaired_sha256 string")


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """The plans of :func:`repair_plans` with the hash of each repaired conversation."""
    plans = repair_plans(conversations)
    digests = repaired_digests(conversations, plans).withColumnRenamed("conv_id", "_conv_id")
    joined = plans.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv_id")))
    return joined.select("conv_id", *[f.name for f in T.StructType.fromDDL(_PLAN)], "repaired_sha256")
