"""Hierarchical packing of documents into sequences of several lengths.

A document's ids (with a separator) are cut into whole windows of the longest tier; the rest is routed to the
shortest tier that holds it. Tiers are packed from the longest down: a sequence starts with the tier's largest
piece, its gap is filled with the largest pieces of shorter tiers that fit, and a last piece is cut where none
fits, so that sequences are full. Full sequences are dealt to step groups of equal tokens, heaviest first.

Everything happens in one pass over the input's partitions, without a shuffle: a task holds at most BUFFER ids
of remainders and leaves fewer than the shortest tier's ids for one padded sequence at its end. A retried task
packs the same rows again and gives the same ids, as they come from the partition's number.

Defined results: a null or empty text is the separator alone. Repeated rows are packed once each. A null id stays
null. An empty table gives no piece. Other columns of the input are never read.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import short_batches
from .tokens import encoder, vocabulary

TIERS = (1024, 512, 256, 128)
SEPARATOR = 0
#: Ids of remainders held by a task before they are packed.
BUFFER = 2_000_000
#: Tokens of a step group.
STEP = 64 * 1024
#: Sequences of a partition are numbered from its number times this.
SPAN = 1 << 40
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
WIDTH = 4


class Packer:
    """Packs one partition. Items are (doc_id, ids, start, length, doc_tokens)."""

    def __init__(self, tiers: tuple[int, ...], base: int):
        self.tiers, self.next, self.next_group = tiers, base, base
        self.stacks: dict[int, list] = defaultdict(list)
        self.mask, self.total = 0, 0
        self.done: list[tuple[int, list]] = []

    def add(self, doc_id, ids: bytes) -> None:
        n, top = len(ids) // WIDTH, self.tiers[0]
        for start in range(0, n - top + 1, top):
            self.done.append((top, [(doc_id, ids, start, top, n)]))
        if rest := n % top:
            self._put((doc_id, ids, n - rest, rest, n))

    def _put(self, item: tuple) -> None:
        self.stacks[item[3]].append(item)
        self.mask |= 1 << item[3]
        self.total += item[3]

    def _take(self, length: int) -> tuple:
        stack = self.stacks[length]
        item = stack.pop()
        if not stack:
            self.mask &= ~(1 << length)
        self.total -= length
        return item

    def _fill(self, room: int) -> list:
        """Pieces that fill the room exactly: the largest that fits, again and again, then a cut."""
        got = []
        while room:
            if fits := (self.mask & ((2 << room) - 1)).bit_length() - 1:
                if fits > 0:
                    got.append(self._take(fits))
                    room -= fits
                    continue
            above = self.mask >> (room + 1)
            doc_id, ids, start, length, n = self._take(room + (above & -above).bit_length())
            got.append((doc_id, ids, start, room, n))
            self._put((doc_id, ids, start + room, length - room, n))
            room = 0
        return got

    def pack(self, last: bool = False) -> None:
        for tier in self.tiers:
            least = tier // 2 if tier != self.tiers[-1] else 0
            while self.mask >> (least + 1) and self.total >= tier:
                self.done.append((tier, self._fill(tier)))
        if last and self.total:
            self.done.append((self.tiers[0], self._fill(self.total)))

    def rows(self) -> list[tuple]:
        """The finished sequences, as rows; step groups get equal tokens, heaviest sequence first."""
        done, self.done = self.done, []
        groups = max(1, round(sum(tier for tier, _ in done) / STEP))
        heap = [(0, self.next_group + i) for i in range(groups)]
        self.next_group += groups
        out = []
        for tier, items in sorted(done, key=lambda x: -x[0]):
            load, group = heapq.heappop(heap)
            heapq.heappush(heap, (load + tier, group))
            offset = 0
            for doc_id, ids, start, length, n in items:
                crc = zlib.crc32(memoryview(ids)[start * WIDTH : (start + length) * WIDTH])
                out.append((doc_id, start, length, crc, n, self.next, offset, tier, group))
                offset += length
            self.next += 1
        return out


def _packed(path: str, tiers: tuple[int, ...], separator: int):
    names = [x.strip().split(" ")[0] for x in SCHEMA.split(",")]
    kinds = [pa.int32() if " int" in x else pa.int64() for x in SCHEMA.split(",")]
    schema = pa.schema(list(zip(names, kinds, strict=True)))
    end = separator.to_bytes(WIDTH, "little")

    def batch(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(rows), 50_000):
            part = rows[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), kinds, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer, held = encoder(path), Packer(tiers, TaskContext.get().partitionId() * SPAN), 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = encode(text.as_py()) + end
                held += len(ids) // WIDTH
                packer.add(doc_id, ids)
                if held >= BUFFER:
                    packer.pack()
                    yield from batch(packer.rows())
                    held = packer.total
        packer.pack(last=True)
        yield from batch(packer.rows())

    return run


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", tiers: tuple[int, ...] = TIERS, separator: int = SEPARATOR, path: str | None = None) -> DataFrame:
    """A row per piece: which ids of which document lie where in which sequence."""
    short_batches(docs.sparkSession)
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(_packed(path or vocabulary(), tuple(tiers), separator), SCHEMA)
