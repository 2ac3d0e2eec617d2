"""Vector bin packing of examples into training sequences.

A sequence has three limits: tokens, segments and tokens that bear loss. Sequences are filled one
at a time: of the examples that fit under all three limits, the one whose demand has the largest
weighted dot product with what is left of the limits comes next (weights: mean demand over the
limit, so that the scarce limit decides). Examples of equal demand form a class and picks go by
class, so that time is linear in examples. Each Spark task packs what it reads in groups of bounded
size and carries what is left over into its next group, so nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import id_and_text, ship_package, slices
from ledgermill.llm.tokens import encoder


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048

    def array(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss], dtype=np.float64)


GROUP_TOKENS = 1 << 20  # waiting tokens, or examples, that are packed together
GROUP_EXAMPLES = 1 << 15
MIN_PIECE = 32  # a rest of fewer tokens is padded rather than filled with a scrap of a document

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, loss_tokens long"
)
EXAMPLES = "example_id long, tokens long, loss_tokens long, sequence_id long, offset long, fits boolean"


class _Pool:
    """Examples that wait for a sequence, in classes of equal demand: a pick looks at classes, not at examples."""

    def __init__(self, limits: np.ndarray):
        self.limits = limits
        self.demand = np.zeros((0, 3))  # of each class
        self.members: list[list[tuple]] = []  # (owner, start) of each class, the last one goes first
        self.place: dict[tuple[int, int], int] = {}
        self.total = np.zeros(3)
        self.size = 0

    def add(self, owner: int, start: int, tokens: int, loss: int) -> None:
        at = self.place.get((tokens, loss))
        if at is None:
            at = self.place[tokens, loss] = len(self.members)
            self.members.append([])
            self.demand = np.concatenate([self.demand, [(tokens, 1.0, loss)]])
        self.members[at].append((owner, start))
        self.total += self.demand[at]
        self.size += 1

    def _take(self, at: int) -> tuple[int, int]:
        owner, start = self.members[at].pop()
        self.total -= self.demand[at]
        self.size -= 1
        if not self.members[at]:
            # The last class moves to the place of the one that is empty now.
            del self.place[int(self.demand[at, 0]), int(self.demand[at, 2])]
            last = len(self.members) - 1
            if at < last:
                self.members[at], self.demand[at] = self.members[last], self.demand[last]
                self.place[int(self.demand[at, 0]), int(self.demand[at, 2])] = at
            self.members.pop()
            self.demand = self.demand[:last]
        return owner, start

    def weights(self) -> np.ndarray:
        """Mean demand over the limit, so that the scarce limit decides."""
        return (self.total / max(self.size, 1) / self.limits) / self.limits**2

    def fill(self, limits: np.ndarray, weights: np.ndarray, min_piece: int | None) -> list[tuple[int, int, int, int]]:
        """One sequence: (owner, start, tokens, loss) of each piece in it.

        With ``min_piece`` the rest of at least so many tokens is filled with the head of a longest
        example, all of whose tokens bear loss; its tail goes on waiting. Of examples of equal
        demand the one that came last is taken.
        """
        left, out = limits.copy(), []
        while self.size and left[1] >= 1:
            fits = (self.demand <= left).all(axis=1)
            if fits.any():
                at = int(np.argmax(np.where(fits, self.demand @ (weights * left), -1.0)))
                tokens, loss = int(self.demand[at, 0]), int(self.demand[at, 2])
                left -= self.demand[at]
                out.append((*self._take(at), tokens, loss))
                continue
            room = int(min(left[0], left[2]))
            if min_piece is not None and room >= min_piece:
                at = int(np.argmax(self.demand[:, 0]))
                tokens = int(self.demand[at, 0])
                owner, start = self._take(at)
                out.append((owner, start, room, room))
                self.add(owner, start + room, tokens - room, tokens - room)
            break
        return out


def pack_examples(df: DataFrame, id_col: str, tokens_col: str, loss_col: str, limits: Limits | None = None) -> DataFrame:
    """Packs whole examples, as instruction data needs it; no example is cut.

    Returns ``example_id, tokens, loss_tokens, sequence_id, offset, fits``. Null and negative counts
    are zero. An example beyond a limit gets a sequence of its own and ``fits`` false. Rows with
    equal ids are separate examples. Examples of one task that are left when less than a sequence
    waits go on to its next group. An empty table gives an empty result.
    """
    limits = limits or Limits()
    ship_package(df.sparkSession)
    rows = df.select(
        df[id_col].cast("long").alias("example_id"),
        F.greatest(df[tokens_col].cast("long"), F.lit(0)).alias("tokens"),
        F.greatest(df[loss_col].cast("long"), F.lit(0)).alias("loss_tokens"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _ExamplePacker(limits, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                packer.add(*row)
                if packer.pool.size >= GROUP_EXAMPLES:
                    packer.pack(last=False)
            if packer.rows:
                yield packer.take()
        packer.pack(last=True)
        if packer.rows:
            yield packer.take()

    return rows.mapInArrow(run, EXAMPLES)


def conversation_examples(
    turns: DataFrame,
    tokenizer: str,
    loss_role: str = "assistant",
    id_col: str = "conv_id",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One example per conversation: ``example_id, turns, tokens, loss_tokens``.

    Each turn counts its whole text and one end id; the turns of ``loss_role`` (in any case) bear
    loss. A null text is empty, a null role bears no loss, rows with a null id are one conversation,
    repeated rows count each time. An empty table gives an empty result.
    """
    ship_package(turns.sparkSession)
    rows = turns.select(
        turns[id_col].cast("long").alias("example_id"),
        F.coalesce(F.lower(turns[role_col]) == loss_role, F.lit(False)).alias("bears"),
        F.coalesce(turns[text_col].cast("string"), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            for part in slices(batch, "text"):
                sizes = [len(ids) // 4 + 1 for ids in encode(part.column(2).to_pylist())]
                columns = [part.column(0), part.column(1), pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["example_id", "bears", "tokens"])

    counted = rows.mapInArrow(run, "example_id long, bears boolean, tokens long")
    return counted.groupBy("example_id").agg(
        F.count(F.lit(1)).alias("turns"),
        F.sum("tokens").alias("tokens"),
        F.sum(F.when(F.col("bears"), F.col("tokens")).otherwise(0)).alias("loss_tokens"),
    )


class _ExamplePacker:
    """Packs the whole examples of one task."""

    def __init__(self, limits: Limits, serial: int):
        self.cap, self.serial = limits.array(), serial
        self.pool = _Pool(self.cap)
        self.rows: list[tuple] = []

    def add(self, example_id: int | None, tokens: int, loss: int) -> None:
        if tokens > self.cap[0] or loss > self.cap[2] or self.cap[1] < 1:
            self.rows.append((example_id, tokens, loss, self.serial, 0, False))
            self.serial += 1
        else:
            self.pool.add(example_id, 0, tokens, loss)

    def pack(self, last: bool) -> None:
        weights = self.pool.weights()
        while self.pool.size and (last or (self.pool.total >= self.cap).any()):
            at = 0
            for example_id, _, tokens, loss in self.pool.fill(self.cap, weights, None):
                self.rows.append((example_id, tokens, loss, self.serial, at, True))
                at += tokens
            self.serial += 1

    def take(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 5 + [pa.bool_()]
        columns = [pa.array(c, k) for c, k in zip(zip(*self.rows, strict=True), kinds, strict=True)]
        self.rows = []
        return pa.RecordBatch.from_arrays(columns, names=[part.split()[0] for part in EXAMPLES.split(", ")])


class _DocumentPacker:
    """Packs the documents of one task; cuts them where a sequence has room."""

    def __init__(self, limits: Limits, serial: int):
        self.limits, self.cap, self.serial = limits, limits.array(), serial
        self.docs: dict[int, tuple[int | None, bytes]] = {}
        self.pool = _Pool(self.cap)
        self.next_doc = 0
        self.rows: list[tuple] = []

    @property
    def tokens(self) -> int:
        return int(self.pool.total[0])

    def full(self) -> bool:
        return self.tokens >= GROUP_TOKENS or self.pool.size >= GROUP_EXAMPLES and self.enough()

    def enough(self) -> bool:
        """Whether what waits exceeds one sequence under some limit."""
        return bool((self.pool.total >= self.cap).any())

    def _emit(self, pieces: list[tuple[int, int, int, int]]) -> None:
        at = 0
        for doc, start, length, loss in pieces:
            doc_id, ids = self.docs[doc]
            crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
            self.rows.append((doc_id, start, length, crc, len(ids) // 4, self.serial, at, loss))
            at += length
        self.serial += 1

    def add(self, doc_id: int | None, ids: bytes) -> None:
        doc, self.next_doc = self.next_doc, self.next_doc + 1
        self.docs[doc] = (doc_id, ids)
        size, start = len(ids) // 4, 0
        full = min(self.limits.tokens, self.limits.loss)
        while size - start > full:
            self._emit([(doc, start, full, full)])
            start += full
        self.pool.add(doc, start, size - start, size - start)

    def pack(self, last: bool) -> None:
        """Fills sequences; the items of a rest below one sequence wait unless it is the last."""
        pool, weights = self.pool, self.pool.weights()
        full = min(self.limits.tokens, self.limits.loss)
        while pool.size and (last or self.enough()):
            cap, least = self.cap, MIN_PIECE
            if self.tokens < full:
                # The rest goes to sequences of a power of two, which need no padding.
                power = 1 << (self.tokens.bit_length() - 1)
                cap, least = np.minimum(cap, (power, cap[1], power)), 1
            self._emit(pool.fill(cap, weights, least))
        waiting = {owner for members in pool.members for owner, _ in members}
        self.docs = {doc: self.docs[doc] for doc in waiting}

    def take(self) -> pa.RecordBatch:
        names = [part.split()[0] for part in PIECES.split(", ")]
        columns = list(zip(*self.rows, strict=True)) if self.rows else [()] * len(names)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    limits: Limits | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Tokenizes documents and packs them, cut where a sequence has room; every token bears loss.

    One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    loss_tokens``. A null or empty text is the end id alone. Rows with equal ids are separate
    documents; a null id stays null. An empty table gives an empty result.
    """
    limits = limits or Limits()
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _DocumentPacker(limits, TaskContext.get().partitionId() << 40)
        encode = encoder(tokenizer).encode
        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()), strict=True):
                    packer.add(doc_id, ids + end)
                    if packer.full():
                        packer.pack(last=False)
                if packer.rows:
                    yield packer.take()
        packer.pack(last=True)
        yield packer.take()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, PIECES)
