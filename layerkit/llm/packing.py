"""Hierarchical multi-length packing of documents into training sequences.

Each document goes to the smallest context-size tier that holds it; one longer
than the longest tier is cut into whole windows and a tail, which is routed by
its own length. Windows of a tier open with its own documents. The gap that is
left in a window is filled from shorter tiers, with the longest piece that fits
whole, and only where none fits by cutting one. A window therefore ends full,
and its length, a power of two, needs no padding. Only the last pieces of a
task can leave a window of the longest tier short.

Sequences are dealt to step groups of equally many tokens: ``STEP_TOKENS`` hold
twice as many windows of half the size.

Tokenising is nearly all of the work, and each text is tokenised once. A task
packs what it reads, a bounded run of documents at a time, so nothing is
shuffled and a hot source or group of copies plays no part. Numbers depend only
on the split of the input that a task reads, so a task that is run again writes
the same ones.

Defined cases: a null or empty text is one piece of the closing id alone. Rows
may repeat, each is packed. An empty table gives no pieces. A null doc_id is
carried along. Other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from layerkit.llm.common import mapped, table

TIERS = (128, 256, 512, 1024)
STEP_TOKENS = 8192
RUN_TOKENS = 1 << 20
CLOSING_ID = 0


@lru_cache(maxsize=2)
def encoder(name: str) -> Callable[[str], np.ndarray]:
    """Byte-level BPE of a vocabulary that the public tokenizers package has by name.

    The vocabulary comes as ranks, which give the same ids as its JSON form at
    several times the speed. The JSON form says which strings are tokens of
    their own wherever they stand in a text.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(name)) as whole:
        added = {token["content"]: token["id"] for token in json.load(whole)["added_tokens"]}
    with open(public_tokenizers.path(name.removesuffix(".json") + ".tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    made = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return partial(made.encode_to_numpy, allowed_special="all")


@dataclass
class Piece:
    row: int
    start: int
    length: int


@dataclass
class Packer:
    """Packs runs of documents; each call of ``pack`` uses up all but the last few pieces."""

    tiers: Sequence[int] = TIERS
    waiting: list[deque[Piece]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.waiting = [deque() for _ in self.tiers]

    def add(self, row: int, length: int) -> None:
        """Route a document: whole windows of the longest tier, and what is left by its length."""
        longest, start = self.tiers[-1], 0
        while length - start > longest:
            self.waiting[-1].append(Piece(row, start, longest))
            start += longest
        self._route(Piece(row, start, length - start))

    def _route(self, piece: Piece) -> None:
        tier = next(t for t, size in enumerate(self.tiers) if piece.length <= size)
        self.waiting[tier].append(piece)

    def _fill(self, tier: int) -> Iterator[Piece]:
        """Pieces of one window of this tier; the last one is cut where the window ends."""
        gap = self.tiers[tier]
        while gap:
            fits = next((w for w in reversed(self.waiting[: tier + 1]) if w and w[0].length <= gap), None)
            if fits is not None:
                piece = fits.popleft()
            else:
                source = next((w for w in [*self.waiting[: tier + 1], *self.waiting[tier + 1 :]] if w), None)
                if source is None:
                    return
                whole = source.popleft()
                piece = Piece(whole.row, whole.start, gap)
                self._route(Piece(whole.row, whole.start + gap, whole.length - gap))
            gap -= piece.length
            yield piece

    def tokens(self, tier: int) -> int:
        return sum(p.length for w in self.waiting[: tier + 1] for p in w)

    def pack(self) -> Iterator[tuple[int, list[Piece]]]:
        """``(tier, pieces)`` of each window, the longest tiers first."""
        for tier in reversed(range(len(self.tiers))):
            left = self.tokens(tier)
            # A window opens for a document of its own tier while there is enough to fill it.
            while self.waiting[tier] and left >= self.tiers[tier]:
                yield tier, list(self._fill(tier))
                left -= self.tiers[tier]
        # What is left fills less than a window of some tier; shorter windows first use it up.
        for tier in reversed(range(len(self.tiers))):
            while self.tokens(len(self.tiers) - 1) >= self.tiers[tier]:
                yield tier, list(self._fill(tier))
        if rest := list(self._fill(len(self.tiers) - 1)):
            yield len(self.tiers) - 1, rest


_FIELDS = [
    (name, pa.int64())
    for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group")
]
_SCHEMA = pa.schema(_FIELDS)
_DDL = ", ".join(f"{name} long" for name, _ in _FIELDS)


def _packed(name: str, tiers: Sequence[int], step_tokens: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(name)
        task = TaskContext.get().partitionId() << 33
        windows = [0] * len(tiers)
        made = 0

        def flush(ids: list[np.ndarray], names: list[int | None]) -> pa.RecordBatch:
            nonlocal made
            packer = Packer(tiers)
            for row, tokens in enumerate(ids):
                packer.add(row, len(tokens))
            rows = []
            for tier, pieces in packer.pack():
                step = windows[tier] * tiers[tier] // step_tokens * len(tiers) + tier
                offset = 0
                for p in pieces:
                    crc = zlib.crc32(ids[p.row][p.start : p.start + p.length].tobytes())
                    rows.append((names[p.row], p.start, p.length, crc, len(ids[p.row]), task + made, offset, tiers[tier], task + step))
                    offset += p.length
                windows[tier] += 1
                made += 1
            columns = zip(*rows) if rows else ([] for _ in _FIELDS)
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], schema=_SCHEMA)

        ids, names, held = [], [], 0
        for batch in batches:
            # One text at a time: a batch of long texts is never a list of strings.
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                tokens = np.append(encode(text.as_py() or ""), np.array([CLOSING_ID], np.uint32)).astype("<u4", copy=False)
                ids.append(tokens)
                names.append(doc_id.as_py())
                held += len(tokens)
                if held >= RUN_TOKENS:
                    yield flush(ids, names)
                    ids, names, held = [], [], 0
        if ids:
            yield flush(ids, names)

    return pack


def packed(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", tiers: Sequence[int] = TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece of a document, with its place in a sequence.

    ``tiers`` are powers of two, ascending. ``offset`` counts the
    sequence's ids before the piece, ``tier`` is its size and ``step_group`` the step that it belongs to.
    """
    return mapped(docs.select("doc_id", "text"), _packed(tokenizer, tuple(tiers), step_tokens), _DDL)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of up to 1024 tokens."""
    return packed(table(spark, sf_dir, "documents"))
