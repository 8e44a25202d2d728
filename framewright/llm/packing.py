"""Packing documents into token sequences with a bounded number of open windows."""

from __future__ import annotations

import math
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from framewright.llm.common import slices, written
from framewright.llm.tokens import Recent, remembered, tokenizer

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, is_open boolean, ids binary"
)
PIECES_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ("is_open", pa.bool_()), ("ids", pa.binary()),
])
#: Bits of a sequence id below the number of the task that made it.
COUNTER_BITS = 40


@lru_cache(maxsize=4)
def piece_ids(path: str) -> Recent:
    """Ids of pieces without spaces, as little-endian unsigned 32-bit numbers."""
    tok = tokenizer(path)
    packed = lambda ids: struct.pack(f"<{len(ids)}I", *ids)
    return remembered(
        path, lambda run: [packed(e.ids) for e in tok.encode_batch(run, add_special_tokens=False)],
        packed, b"".join,
    )


def text_ids(path: str, texts: list[str]) -> Iterator[bytes]:
    """Ids of each text, for a tokenizer that drops white space. Each word is encoded once and remembered; where a text
    is not all Latin, that holds for the pieces between spaces and line feeds, which separate words in any text."""
    known = piece_ids(path)
    at_once = getattr(known.encode, "text", lambda text: None)
    for text in texts:
        ids = at_once(text)
        yield b"".join(map(known.__getitem__, text.replace("\n", " ").split(" "))) if ids is None else ids


class Packer:
    """Online best-fit packing into windows of ``size`` ids, at most ``most`` of them open.

    What a document has beyond whole windows goes to the open window with the smallest gap that holds it.
    If none does, and ``most`` are open, the fullest is emitted: filled up with the
    head of the document when its gap is at least ``least`` ids, else with that padding.
    """

    def __init__(self, size: int, most: int, least: int, first_id: int, with_ids: bool):
        self.size, self.most, self.least = size, most, least
        self.next_id, self.with_ids = first_id, with_ids
        self.gaps: list[tuple[int, int]] = []  # (gap, window), sorted
        self.windows: dict[int, list[tuple]] = {}
        self.out: list[tuple] = []

    def row(self, piece: tuple, window: int, offset: int, is_open: bool) -> tuple:
        doc_id, start, ids, total = piece
        keep = ids if is_open or self.with_ids else None
        return doc_id, start, len(ids) // 4, zlib.crc32(ids), total, window, offset, is_open, keep

    def emit(self, window: int, is_open: bool = False) -> None:
        offset = 0
        for piece in self.windows.pop(window):
            self.out.append(self.row(piece, window, offset, is_open))
            offset += len(piece[2]) // 4

    def put(self, piece: tuple, gap: int, window: int) -> None:
        self.windows[window].append(piece)
        left = gap - len(piece[2]) // 4
        if left:
            insort(self.gaps, (left, window))
        else:
            self.emit(window)

    def new(self) -> int:
        self.next_id += 1
        self.windows[self.next_id - 1] = []
        return self.next_id - 1

    def add(self, doc_id: int | None, start: int, ids: bytes, total: int) -> None:
        at, end = 0, len(ids) // 4
        piece = lambda a, b: (doc_id, start + a, ids[4 * a:4 * b], total)
        while end - at >= self.size:
            self.put(piece(at, at + self.size), self.size, self.new())
            at += self.size
        while at < end:
            found = bisect_left(self.gaps, (end - at, -1))
            if found < len(self.gaps):
                gap, window = self.gaps.pop(found)
                return self.put(piece(at, end), gap, window)
            if len(self.gaps) < self.most:
                return self.put(piece(at, end), self.size, self.new())
            gap, window = self.gaps.pop(0)
            if gap >= self.least:
                self.put(piece(at, at + gap), gap, window)
                at += gap
            else:
                self.emit(window)

    def rest(self) -> None:
        """The open windows, marked as such."""
        for _, window in self.gaps:
            self.emit(window, is_open=True)
        self.gaps = []

    def taken(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(PIECES_ARROW)], schema=PIECES_ARROW
        )


def pack(
    df: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text", size: int = 2048,
    open_windows: int = 64, least: int = 32, with_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``size`` ids; columns as in ``PIECES``.

    A document is its ids (tokenizers file ``path``, which must drop white space, no special tokens added) and
    then ``end_id``. Every partition packs online with ``open_windows`` open windows (``Packer``). The windows still
    open at its end, a bounded number for each partition, are merged over all partitions: dealt to groups
    of about 1,024 windows, laid end to end and cut into full sequences, so a group has one
    sequence that is not full. The first step is written to the shared folder once; the ids
    of a sequence come from one task, so a repeated task gives the same sequences.

    ``ids`` holds a piece's ids as little-endian unsigned 32-bit numbers (NULL without ``with_ids``).
    NULL text is empty and gives the one id ``end_id``. A NULL document id is kept. Rows with the same id are
    packed one by one. An empty table gives no rows. Other columns are not looked at.
    """
    spark = df.sparkSession

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << COUNTER_BITS
        packer = Packer(size, open_windows, least, first, with_ids)
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            for part in slices(batch, "t", 4 << 20):
                names, texts = part.column("d").to_pylist(), part.column("t").to_pylist()
                for name, ids in zip(names, text_ids(path, texts)):
                    ids += end
                    packer.add(name, 0, ids, len(ids) // 4)
                yield packer.taken()
        packer.rest()
        yield packer.taken()

    rows = df.select(F.col(doc_id).cast("bigint").alias("d"), F.coalesce(text, F.lit("")).alias("t"))
    first = written(rows.mapInArrow(packed, PIECES), "pieces")
    rest = first.where("is_open")
    windows = rest.where("offset = 0").count()
    groups = max(1, math.ceil(windows / 1024))
    window, count = F.col("sequence_id"), groups

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, at = None, None
        for batch in batches:
            for g, d, s, ids, total in zip(*(batch.column(c).to_pylist() for c in ("g", "doc_id", "start", "ids", "doc_tokens"))):
                if g != at:
                    if packer:
                        packer.rest()
                        yield packer.taken()
                    packer = Packer(size, 1, 1, (1 << 62) | (g << COUNTER_BITS), with_ids)
                    at = g
                packer.add(d, s, ids, total)
            if packer:
                yield packer.taken()
        if packer:
            packer.rest()
            yield packer.taken()

    dealt = rest.withColumn("g", F.pmod(F.xxhash64(window), F.lit(count)))
    dealt = dealt.repartition(min(groups, 4096), "g").sortWithinPartitions("g", "sequence_id", "offset")
    last = written(dealt.mapInArrow(merged, PIECES), "pieces-merged")
    out = first.where("not is_open").unionByName(last).drop("is_open")
    return out if with_ids else out.withColumn("ids", F.lit(None).cast("binary"))
