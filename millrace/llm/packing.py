"""Vector bin packing of tokenised examples into fixed-length sequences."""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import columns

SEQUENCE = 2048
MAX_SEGMENTS = 64
END_ID = 1
POOL_TOKENS = 64 * SEQUENCE
MIN_CUT = 16
CACHE_ENTRIES = 600_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"

# The splitting pattern of the byte-level vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A blank between two characters that are not blanks always begins a token of that pattern.
_SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")
_OTHER_BLANKS = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ByteTokenizer:
    """Ids of a byte-level BPE vocabulary in the ``tokenizers`` JSON form, as little-endian 32-bit bytes.

    Texts are cut where the vocabulary's pattern always cuts; each part is encoded once and kept
    in a table of bounded size, as words repeat (parts that begin with a blank, without it).
    """

    def __init__(self, model: str):
        import tiktoken

        parsed = json.loads(model)
        if parsed["model"]["type"] != "BPE" or parsed["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("expected a byte-level BPE tokenizer")
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"] if t["special"]}
        to_byte = _byte_alphabet()
        ranks = {
            bytes(to_byte[c] for c in token): i
            for token, i in parsed["model"]["vocab"].items() if token not in self.special
        }
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.parts: dict[str, bytes] = {}

    def _encode(self, part: str) -> bytes:
        if "<" in part and any(s in part for s in self.special):
            ids = self.encoding.encode(part, allowed_special="all")
        else:
            ids = self.encoding.encode_ordinary(part)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode_after_blank(self, part: str) -> bytes:
        encoded = self._encode(" " + part)
        if len(self.parts) < CACHE_ENTRIES and len(part) < 64:
            self.parts[part] = encoded
        return encoded

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "  " in text or " \n" in text or "\n " in text or text[-1] == " " or _OTHER_BLANKS.search(text):
            return b"".join(map(self._encode, _SAFE_CUT.split(text)))
        first, *rest = text.split(" ")
        get, encode = self.parts.get, self._encode_after_blank
        return (self._encode(first) if first else b"") + b"".join([get(p) or encode(p) for p in rest])


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 byte values: printable bytes stand for themselves, the others follow from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def _tokenizer(model: str) -> ByteTokenizer:
    return ByteTokenizer(model)


def _view(part: bytes | memoryview) -> memoryview:
    """A view of the part; once less than half of what it is a part of, a copy, so that a short rest does not hold a long document."""
    view = memoryview(part)
    return memoryview(bytes(view)) if 2 * len(view) < len(view.obj) else view


class Example:
    """A run of ids of one document that is not placed yet; ``loss`` is a 0/1 byte per id or None for all."""

    __slots__ = ("doc", "ids", "total", "start", "loss", "tokens", "loss_tokens")

    def __init__(self, doc, ids: bytes, total: int, start: int = 0, loss: bytes | None = None, loss_tokens: int | None = None):
        # Views, so that cutting a long document piece by piece does not copy the rest each time.
        self.ids, self.loss = _view(ids), None if loss is None else _view(loss)
        self.doc, self.total, self.start = doc, total, start
        self.tokens = len(ids) // 4
        if loss_tokens is None:
            loss_tokens = self.tokens if loss is None else sum(self.loss)
        self.loss_tokens = loss_tokens

    def split(self, tokens: int) -> tuple[Example, Example]:
        head, tail = (None, None) if self.loss is None else (self.loss[:tokens], self.loss[tokens:])
        first = Example(self.doc, self.ids[: 4 * tokens], self.total, self.start, head)
        rest = Example(
            self.doc, self.ids[4 * tokens :], self.total, self.start + tokens, tail, self.loss_tokens - first.loss_tokens
        )
        return first, rest


@dataclass
class Packer:
    """Fills one sequence after the other from a pool of examples of bounded size.

    The next example for a sequence is the one that fits all three limits and whose demand
    (tokens, segments, loss-bearing tokens, each as a share of its limit) has the largest dot
    product with what the sequence has left. When none fits whole and at least ``MIN_CUT`` tokens
    are free, the longest example is cut to fill the sequence. The last sequences are cut to
    powers of two, which need no padding.
    """

    first_sequence: int
    sequence: int = SEQUENCE
    max_segments: int = MAX_SEGMENTS
    max_loss: int = SEQUENCE
    pool: list[Example] = field(default_factory=list)
    pooled: int = 0
    made: int = 0

    def add(self, example: Example) -> Iterator[tuple]:
        self.pool.append(example)
        self.pooled += example.tokens
        while self.pooled > POOL_TOKENS:
            yield from self._fill(self.sequence)

    def finish(self) -> Iterator[tuple]:
        while self.pooled >= self.sequence:
            yield from self._fill(self.sequence)
        while self.pooled:
            yield from self._fill(1 << (self.pooled.bit_length() - 1))

    def _fill(self, capacity: int) -> Iterator[tuple]:
        limits = np.array([capacity, self.max_segments, self.max_loss], dtype=float)
        left = limits.copy()
        need = np.array([[e.tokens, 1, e.loss_tokens] for e in self.pool], dtype=float)
        open_ = np.ones(len(need), dtype=bool)
        offset, sequence_id, rest = 0, self.first_sequence + self.made, []
        while left[0] > 0 and left[1] > 0:
            fits = np.flatnonzero(open_ & (need <= left).all(axis=1))
            if len(fits):
                best = int(fits[np.argmax((need[fits] / limits) @ (left / limits))])
                example = self.pool[best]
                open_[best] = False
            else:
                if left[0] < min(MIN_CUT, capacity) or not open_.any():
                    break
                best = int(np.argmax(np.where(open_, need[:, 0], -1)))
                example, tail = self._cut(self.pool[best], left)
                open_[best] = False
                if example is None:
                    rest.append(tail)
                    break
                rest.append(tail)
            yield _piece(example, sequence_id, offset)
            offset += example.tokens
            left -= [example.tokens, 1, example.loss_tokens]
        self.pool = [e for e, o in zip(self.pool, open_, strict=True) if o] + [e for e in rest if e.tokens]
        self.pooled -= offset
        self.made += 1

    @staticmethod
    def _cut(example: Example, left: np.ndarray) -> tuple[Example | None, Example]:
        """The longest start of the example within the limits left, and the rest of it."""
        tokens = min(int(left[0]), example.tokens)
        if example.loss is None:
            tokens = min(tokens, int(left[2]))
        else:
            marks = np.cumsum(np.frombuffer(example.loss[:tokens], dtype=np.uint8))
            tokens = int(np.searchsorted(marks, left[2], "right"))
        return example.split(tokens) if tokens else (None, example)


def _piece(e: Example, sequence_id: int, offset: int) -> tuple:
    return e.doc, e.start, e.tokens, zlib.crc32(e.ids), e.total, sequence_id, offset, e.loss_tokens


def pack(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
    max_segments: int = MAX_SEGMENTS, max_loss: int = SEQUENCE, prompt_col: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens.

    A document is its ids and the end id; a null or empty text is the end id alone. With
    ``prompt_col`` the prompt's ids come first and bear no loss; without, every id bears loss.
    Every task packs the rows it reads: no shuffle, a pool of ``POOL_TOKENS`` and one document in
    memory, and sequences of no two tasks share an id. Repeated rows and null ids are packed like
    all others.
    """
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    names = {"doc_id": id_col, "text": text_col} | ({"prompt": prompt_col} if prompt_col else {})
    source = columns(docs, **names).select(
        F.col("doc_id").cast("long"), *[F.col(c).cast("string") for c in names if c != "doc_id"]
    )
    end = np.array([END_ID], dtype="<u4").tobytes()

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        tok = _tokenizer(model.value)
        packer = Packer(TaskContext.get().partitionId() << 40, max_segments=max_segments, max_loss=max_loss)
        rows: list[tuple] = []
        for batch in batches:
            prompts = batch["prompt"] if prompt_col else [None] * len(batch)
            for doc, text, prompt in zip(batch["doc_id"], batch["text"], prompts, strict=True):
                before = tok.ids(prompt)
                ids = before + tok.ids(text) + end
                loss = bytes(len(before) // 4) + b"\1" * (len(ids) // 4 - len(before) // 4) if before else None
                rows += packer.add(Example(doc, ids, len(ids) // 4, loss=loss))
            if len(rows) >= 10_000:
                yield _frame(rows)
                rows = []
        rows += packer.finish()
        yield _frame(rows)

    return source.mapInPandas(packed, PIECES)


_FIELDS = [field_.split()[0] for field_ in PIECES.split(", ")]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=_FIELDS)
    frame["doc_id"] = pd.array([None if pd.isna(d) else int(d) for d in frame["doc_id"]], dtype="Int64")
    return frame
