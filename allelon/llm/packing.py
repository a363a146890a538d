"""Cost-balanced packing of token sequences: linear plus quadratic attention cost."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelon.llm.common import kept, parts, texts_of
from allelon.llm.tokens import ByteIds

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]
)


def cost(length: int, linear: float, quadratic: float) -> float:
    """Estimated cost of a piece: attention runs within a piece."""
    return linear * length + quadratic * length * length


class Cheapest:
    """Open sequences by remaining room; gives the one of lowest cost among those with enough room. Exact.

    A heap for each room, and above the heaps a tree of minima over ranges of rooms.
    """

    NONE = (float("inf"), -1)

    def __init__(self, capacity: int, sequences: int):
        self.leaves = 1 << capacity.bit_length()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(self.leaves)]
        self.tree = [self.NONE] * (2 * self.leaves)
        self.heaps[capacity] = [(0.0, s) for s in range(sequences)]
        self._rise(capacity)

    def _rise(self, room: int) -> None:
        heap, at, tree = self.heaps[room], room + self.leaves, self.tree
        tree[at] = heap[0] if heap else self.NONE
        while at > 1:
            at >>= 1
            tree[at] = min(tree[2 * at], tree[2 * at + 1])

    def put(self, room: int, cost: float, sequence: int) -> None:
        heapq.heappush(self.heaps[room], (cost, sequence))
        self._rise(room)

    def take(self, least: int, room_of: list[int]) -> tuple[float, int] | None:
        """The (cost, sequence) of lowest cost with room for ``least``, ties to the first sequence; taken out."""
        best, at, end, tree = self.NONE, least + self.leaves, 2 * self.leaves, self.tree
        while at < end:
            if at & 1:
                best = min(best, tree[at])
                at += 1
            at >>= 1
            end >>= 1
        if best is self.NONE:
            return None
        room = room_of[best[1]]
        heapq.heappop(self.heaps[room])
        self._rise(room)
        return best


def pack(lengths: list[int], capacity: int = 1024, linear: float = 1.0, quadratic: float = 1 / 512) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of the pieces of documents with ``lengths`` tokens.

    There are as many sequences as all tokens need, so the sequences of a call have less padding than one
    sequence together. Full sequences are cut from longer documents first. The rest, in descending order, each go to
    the lowest-cost sequence with room for all of it; where none has, the piece is cut to fill the lowest-cost
    sequence with any room and its remainder goes on to the next.
    """
    pieces, rest, n = [], [], 0
    for d, length in enumerate(lengths):
        for at in range(0, length - length % capacity, capacity):
            pieces.append((d, at, capacity, n, 0))
            n += 1
        if length % capacity:
            rest.append((length % capacity, d, length - length % capacity))
    rest.sort(key=lambda x: (-x[0], x[1]))
    room = [capacity] * -(-sum(x[0] for x in rest) // capacity)
    open_ = Cheapest(capacity, len(room))
    for length, d, at in rest:
        while length:
            c, s = open_.take(length, room) or open_.take(1, room)
            take = min(length, room[s])
            pieces.append((d, at, take, n + s, capacity - room[s]))
            room[s] -= take
            if room[s]:
                open_.put(room[s], c + cost(take, linear, quadratic), s)
            at += take
            length -= take
    return pieces


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 0,
    window_tokens: int = 1 << 22) -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` tokens, each document's ids followed by ``end_id``.

    A task packs its documents in windows of about ``window_tokens`` tokens without any shuffle, so padding is below one
    sequence a window. Sequence ids are unique over all tasks: the task's partition in the upper bits. Each id of a document is
    in exactly one piece. Null and empty texts are documents of the end id alone; repeated rows and null ids are
    packed like any other, texts of any length whole. Only the id and the text are read; an empty table gives no pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_ids, used = kept(("bytes", tokenizer_path), lambda: ByteIds(tokenizer_path)), TaskContext.get().partitionId() << 40
        end = end_id.to_bytes(4, "little")
        own, held, tokens = [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal used, tokens
            pieces = pack([len(x) // 4 for x in held], capacity)
            for at in range(0, len(pieces), 4096):
                rows = []
                for d, start, length, sequence, offset in pieces[at : at + 4096]:
                    ids = held[d][4 * start : 4 * (start + length)]
                    rows.append((own[d], start, length, len(held[d]) // 4, used + sequence, offset, ids))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)
            used += 1 + max((p[3] for p in pieces), default=-1)
            own.clear()
            held.clear()
            tokens = 0

        for batch in parts(batches):
            for name, text in zip(batch.column(0).to_pylist(), texts_of(batch, "text"), strict=True):
                own.append(name)
                held.append(own_ids.encode(text) + end)
                tokens += len(held[-1]) // 4
            if tokens >= window_tokens:
                yield from out()
        if held:
            yield from out()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
