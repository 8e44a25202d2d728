"""Benchmark decontamination: Wu-Manber search for word windows of benchmark items."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from framewright.llm.common import words_of, written
from framewright.llm.tokens import balanced

FOUND = "struct<n_words: bigint, n_hit: bigint, items: array<string>, spans: array<struct<start: bigint, stop: bigint>>>"
FOUND_ARROW = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
])


class Patterns:
    """Search tables for the windows of some items, one set of tables per window length.

    Words are numbers, and a block is two neighbouring words. ``shift`` tells how far a window can be moved
    when its last block is met: by the block's distance from the end of the nearest pattern,
    or past the block when no pattern holds it. Where the distance is 0, the bucket of the
    patterns with that suffix is compared word by word.
    """

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.number: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                found.setdefault(tuple(words[i:i + size]), set()).add(item)
        self.base = len(self.number) + 1
        self.tables = []
        for size in sorted({len(p) for p in found}):
            block = min(2, size)
            shift: dict[int, int] = {}
            bucket: dict[int, list] = {}
            for pattern, names in found.items():
                if len(pattern) != size:
                    continue
                for end in range(block, size + 1):
                    code = self.code(pattern, end - 1, block)
                    shift[code] = min(shift.get(code, size), size - end)
                bucket.setdefault(self.code(pattern, size - 1, block), []).append((list(pattern), names))
            self.tables.append((size, block, shift, bucket))

    def code(self, words, at: int, block: int) -> int:
        return words[at] if block == 1 else words[at - 1] * self.base + words[at]

    def search(self, words: list[bytes]) -> tuple[set[str], list[tuple[int, int]]]:
        """Items with occurring windows, and (start, stop) of all occurrences."""
        items: set[str] = set()
        spans: list[tuple[int, int]] = []
        number, base, n = self.number, self.base, len(words)
        ids = [number.get(w, 0) for w in words]
        for size, block, shift, bucket in self.tables:
            past = size - block + 1
            at = size - 1
            while at < n:
                code = ids[at] if block == 1 else ids[at - 1] * base + ids[at]
                step = shift.get(code, past)
                if step:
                    at += step
                    continue
                start = at - size + 1
                here = ids[start:at + 1]
                for pattern, names in bucket[code]:
                    if pattern == here:
                        items |= names
                        spans.append((start, at + 1))
                at += 1
        return items, spans


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


@lru_cache(maxsize=4)
def patterns_of(name: str, window: int) -> Patterns:
    """Tables of the block in a file; a worker keeps those of the four blocks it used last."""
    block = pq.ParquetFile(SparkFiles.get(name)).read()
    return Patterns(sorted(zip(block.column("i").to_pylist(), block.column("t").to_pylist())), window)


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = 13, out: str = "found", block_bytes: int = 1 << 20,
) -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_hit (words inside an occurrence), items (the ids, as
    strings, of the items with an occurring window, sorted) and spans (of hit words).

    A window is ``window`` consecutive words of an item; an item with fewer words, but not
    none, is one window. Words are runs of [0-9A-Za-z] and non-ASCII characters, A-Z lower-cased.

    The benchmark is searched in blocks of about ``block_bytes`` of text, each a file of a table in the shared folder.
    Items don't pass through the driver: executors fetch the files once and a worker holds the tables of four blocks
    at most, however large the benchmark is. Whole documents pass all blocks where they lie, without a shuffle, in runs of
    16 million characters if there are more than four.

    NULL text has no words. Items without id or words are never found; rows with the same item id
    are one item. An empty benchmark hits nothing. Other columns pass through; ``out`` is replaced if it is there.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")).dropna()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    table = written(items.repartition(blocks, F.xxhash64("i")), "benchmark")
    files = sorted(table.inputFiles())
    for file in files:
        spark.sparkContext.addFile(file)
    names = [file.rpartition("/")[2] for file in files]
    most = 2_000_000 if len(names) <= 4 else 16_000_000

    @arrow_udf(FOUND)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for run in balanced(batch.to_pylist(), most):
                cut = [words_of(t) for t in run]
                hits: list[tuple[set[str], list]] = [(set(), []) for _ in cut]
                for name in names:
                    tables = patterns_of(name, window)
                    for words, (ids, spans) in zip(cut, hits):
                        more, at = tables.search(words)
                        ids |= more
                        spans += at
                for words, (ids, spans) in zip(cut, hits):
                    parts = merged(spans)
                    rows.append({
                        "n_words": len(words), "n_hit": sum(b - a for a, b in parts), "items": sorted(ids),
                        "spans": [{"start": a, "stop": b} for a, b in parts],
                    })
            yield pa.array(rows, FOUND_ARROW)

    return docs.withColumn(out, search(F.coalesce(text, F.lit(""))))


def contaminated(found: str = "found"):
    """Whether a twentieth of a document's words, and one at least, are hit."""
    hit, words = F.col(found).getField("n_hit"), F.col(found).getField("n_words")
    return (hit > 0) & (20 * hit >= words)
