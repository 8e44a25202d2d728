"""Phrases that stand together more often than their parts: Toivonen's sampling search, exact counts over all documents."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from framewright.llm.common import LOWER, UPPER, slices, written

LONGEST = 4
#: Bytes of text taken apart at a time. It bounds memory only.
CHUNK = 1 << 19
#: Codes added up in a task before they are handed on. It bounds memory only.
POOL = 1 << 19
#: Smallest and largest number of bits of a filter (32 MB), and bits for each phrase in it.
LEAST_BITS, MOST_BITS, BITS_EACH = 1 << 20, 1 << 28, 16
#: Bits in one value of Spark's bitmap aggregate.
PAGE = 1 << 15
#: Fixed odd numbers that mix 64-bit codes.
MIX, STEP, SECOND = (np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0x9E3779B97F4A7C15, 0xC4CEB9FE1A85EC53))

BREAK, SPACE = 10, 32
#: Byte table: A-Z to a-z, the marks that end a piece to a line feed, a tab to a space.
PIECES = bytes(
    BREAK if chr(b) in ".,;:!?\n\x0b\x0c\r" else SPACE if b == 9 else ord(LOWER[UPPER.index(chr(b))]) if chr(b) in UPPER else b
    for b in range(256)
)
BLANKS, NEXT_WORDS = re.compile(rb"  +"), re.compile(rb"(?: ?[^ \n]+){0,%d}" % (LONGEST - 1))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * MIX
    return x ^ (x >> np.uint64(29))


class Powers:
    """Powers of an odd base and of its inverse, modulo 2^64, for the hashes of byte ranges."""

    def __init__(self):
        base = int(STEP)
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        rng = np.random.default_rng(12)
        self.byte = rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


@dataclass
class Words:
    """Words of some bytes in the form of ``PIECES``: where they start and end, their pieces, texts and hashes."""

    data: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    piece: np.ndarray
    hash: np.ndarray

    @classmethod
    def of(cls, data: bytes, powers: Powers) -> Words:
        raw = np.frombuffer(data, np.uint8)
        inside = (raw != SPACE) & (raw != BREAK)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
        start, stop = edge[::2], edge[1::2]
        piece = np.cumsum(raw == BREAK, dtype=np.int32)[start] if len(start) else np.zeros(0, np.int32)
        powers.upto(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(powers.byte[raw] * powers.up[:len(raw)], out=sums[1:])
        return cls(raw, start, stop, piece, mixed((sums[stop] - sums[start]) * powers.down[start]))

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        """The phrases of ``size`` words that start at the words ``at``."""
        first, last = self.start[at], self.stop[at + size - 1]
        lengths = last - first
        offsets = np.zeros(len(at) + 1, np.int64)
        np.cumsum(lengths, out=offsets[1:])
        where = np.repeat(first - offsets[:-1], lengths) + np.arange(offsets[-1])
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(self.data[where])).cast(pa.string())


def language_code(lang: str) -> int:
    return int.from_bytes(blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def longer(prefix: np.ndarray, last: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """Code of phrases of ``size`` words from the codes of their prefix and last word. The last two bits of a code are
    the size less one."""
    return (mixed(prefix * STEP + last) & ~np.uint64(3)) | (np.uint64(size) - np.uint64(1) if isinstance(size, int) else size - np.uint64(1))


def codes(words: Words, seed: np.ndarray) -> list[np.ndarray]:
    """Code of the phrase of 1, 2, ... words from each word on; ``seed`` is the language of each word."""
    out = [mixed(words.hash ^ seed) & ~np.uint64(3)]
    for size in range(2, LONGEST + 1):
        n = max(0, len(words.hash) - size + 1)
        out.append(longer(out[-1][:n], out[0][size - 1:size - 1 + n], size))
    return out


def bits_for(n: int) -> int:
    """Bits of a filter of ``n`` phrases."""
    bits = LEAST_BITS
    while bits < min(MOST_BITS, BITS_EACH * n):
        bits *= 2
    return bits


def places(code: np.ndarray, bits: int) -> list[np.ndarray]:
    """Two bits for each code."""
    last = np.uint64(bits - 1)
    return [(code >> np.uint64(7)) & last, ((code * SECOND) >> np.uint64(20)) & last]


@dataclass
class Filter:
    """A set of phrase codes as bits, two for each: it may hold more than was put in, never less."""

    bits: np.ndarray

    @classmethod
    def empty(cls, bits: int = LEAST_BITS) -> Filter:
        return cls(np.zeros(bits // 8, np.uint8))

    def holds(self, code: np.ndarray) -> np.ndarray:
        found = np.ones(len(code), bool)
        for p in places(code, len(self.bits) * 8):
            found &= (self.bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0
        return found


def chunks(texts: list[str | None], langs: list[str], most: int) -> Iterator[tuple[bytes, int, np.ndarray, list[str]]]:
    """(bytes, own, first bytes of the texts, their languages): texts in the form of ``PIECES``, a line feed
    between two. Phrases that start at ``own`` or later belong to the next chunk. A text longer than ``most`` is cut between two
    words, and the words after the cut that a phrase may reach into are added."""
    parts, starts, held, size = [], [], [], 0
    for text, lang in zip(texts, langs):
        data = BLANKS.sub(b" ", (text or "").encode("utf-8", "surrogatepass").translate(PIECES))
        if parts and size + len(data) > most:
            yield b"\n".join(parts), size, np.array(starts), held
            parts, starts, held, size = [], [], [], 0
        at = 0
        while len(data) - at > most:
            cut = max(data.rfind(b" ", at + 1, at + most), data.rfind(b"\n", at + 1, at + most))
            if cut < 0:  # one word longer than a chunk
                cut = min((p for p in (data.find(b" ", at + most), data.find(b"\n", at + most)) if p >= 0), default=len(data))
            yield data[at:NEXT_WORDS.match(data, cut).end()], cut - at, np.zeros(1, int), [lang]
            at = cut
        starts.append(size)
        held.append(lang)
        parts.append(data[at:])
        size += len(data) - at + 1
    if parts:
        yield b"\n".join(parts), size, np.array(starts), held


@dataclass
class Rule:
    """Which phrases of ``sizes`` words are counted by their codes: those whose prefix and suffix, one word shorter, are
    both in ``known``. With ``added``: those that this has left out, hold a phrase of ``added``, and whose shorter phrases are in
    ``known`` or hold one of ``added`` too. Without ``known``: all of them, with their words."""

    sizes: tuple[int, ...]
    known: Filter | None = None
    added: Filter | None = None

    def wanted(self, code: list[np.ndarray], piece: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """(size, positions among the first ``n`` words) of the phrases to count."""
        holds = np.zeros(len(code[0]), bool)  # whether the phrase, one word shorter, holds one of ``added``
        for size in self.sizes:
            m = min(n, len(code[size - 1]))
            at = np.flatnonzero(piece[:m] == piece[size - 1:size - 1 + m])
            before = code[max(0, size - 2)]
            if not self.known:
                yield size, at
            elif not self.added:
                at = at[self.known.holds(before[at])]
                yield size, at[self.known.holds(before[at + 1])]
            else:
                holds = (holds[:-1] | holds[1:] if size > 2 else holds) | self.added.holds(before)
                at = at[holds[at] | holds[at + 1]]
                first, rest = self.known.holds(before[at]), self.known.holds(before[at + 1])
                yield size, at[(first | holds[at]) & (rest | holds[at + 1]) & ~(first & rest)]


class Pool:
    """Counts by code, each with columns of its own, added up until there are ``most``."""

    def __init__(self, names: list[str], most: int = POOL):
        self.names, self.most, self.limit, self.parts, self.size = names, most, most, [], 0

    def add(self, code: np.ndarray, n: np.ndarray, columns: list[pa.Array]) -> None:
        self.parts.append((code, n, columns))
        self.size += len(code)

    def combine(self) -> None:
        code, n = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1))
        order = np.argsort(code, kind="stable")
        code = code[order]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
        sums = np.add.reduceat(n[order], first) if len(code) else n
        chosen = pa.array(order[first])
        columns = [pa.chunked_array([p[2][i] for p in self.parts]).combine_chunks().take(chosen) for i in range(len(self.names) - 1)]
        self.parts, self.size = [(code[first], sums, columns)], len(first)

    def flush(self, end: bool = False) -> Iterator[pa.RecordBatch]:
        """What has been added up, if there is too much of it, or at the end."""
        if self.parts and (end or self.size > self.limit):
            self.combine()
            self.limit = max(self.most, 2 * self.size)
            if end or self.size > self.most:
                [(_, n, columns)] = self.parts
                yield from pa.Table.from_arrays([*columns, pa.array(n)], self.names).to_batches(1 << 16)
                self.parts, self.size, self.limit = [], 0, self.most


def long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def count_batches(batches: Iterator[pa.RecordBatch], rule: Rule, chunk: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Sums of ``rule`` for batches of (lang, text): (prefix, last, n) by the codes of a phrase's prefix and last word, or without
    ``known`` (lang, phrase, code, n), where the empty phrase counts all words."""
    named = not rule.known
    powers, pool = Powers(), Pool(["lang", "phrase", "code", "n"] if named else ["prefix", "last", "n"])
    for batch in batches:
        for part in slices(batch, "text", 4 * chunk):
            for data, own, starts, held in chunks(part.column("text").to_pylist(), part.column("lang").to_pylist(), chunk):
                words = Words.of(data, powers)
                n = int(np.searchsorted(words.start, own))
                names, number = np.unique(np.array(held, object), return_inverse=True)
                lang = number[np.searchsorted(starts, words.start, "right") - 1]
                seeds = np.array([language_code(x) for x in names], np.uint64)
                code = codes(words, seeds[lang])
                names = pa.array(list(names), pa.string())
                if named and n:
                    totals = np.bincount(lang[:n], minlength=len(names))
                    pool.add(seeds | np.uint64(3), totals, [names, pa.array([""] * len(names)), pa.array(np.zeros(len(names), np.int64))])
                for size, at in rule.wanted(code, words.piece, n):
                    here = code[size - 1][at]
                    if named:  # a phrase is cut out once for each chunk
                        here, first, inverse = np.unique(here, return_index=True, return_inverse=True)
                        at = at[first]
                        count = np.bincount(inverse, minlength=len(here))
                        pool.add(here, count, [names.take(pa.array(lang[at])), words.phrases(at, size), long(here)])
                    else:
                        pool.add(here, np.ones(len(here), np.int64), [long(code[size - 2][at]), long(code[0][at + size - 1])])
                yield from pool.flush()
    yield from pool.flush(True)


def frequent_words(docs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, code, n) of the words found ``least`` times or more in ``docs`` (lang, text), and of the empty phrase."""
    found = docs.select("lang", "text").mapInArrow(
        lambda batches: count_batches(batches, Rule((1,))), "lang string, phrase string, code bigint, n bigint"
    )
    return written(found.groupBy("lang", "phrase", "code").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "collocation-words")


def frequent_pairs(docs: DataFrame, rule: Rule, least: int, name: str) -> DataFrame:
    """(prefix, last, n, code) of the phrases that ``rule`` counts ``least`` times or more in ``docs`` (lang, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(rule)  # two filters of at most MOST_BITS
    found = docs.select("lang", "text").mapInArrow(lambda batches: count_batches(batches, sent.value), "prefix bigint, last bigint, n bigint")
    sums = found.groupBy("prefix", "last").agg(F.sum("n").alias("n")).where(F.col("n") >= least)

    def add_code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix, last = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("prefix", "last"))
            code = longer(prefix, last, (prefix & np.uint64(3)) + np.uint64(2))
            yield pa.RecordBatch.from_arrays([*batch.columns, long(code)], ["prefix", "last", "n", "code"])

    return written(sums.mapInArrow(add_code, "prefix bigint, last bigint, n bigint, code bigint"), name)


def filled(coded: DataFrame, start: Filter) -> Filter:
    """``start`` and the codes of a table. The bits are put together in Spark; only they reach the driver."""
    size = len(start.bits) * 8

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column("code").to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(places(code, size)).astype(np.int64))], ["at"])

    page, spot = F.floor(F.col("at") / PAGE).alias("page"), F.col("at") % PAGE
    found = coded.select("code").mapInArrow(spots, "at bigint").groupBy(page).agg(F.bitmap_construct_agg(spot).alias("bits"))
    bits = start.bits.copy()
    for r in found.toLocalIterator():
        first = r["page"] * PAGE // 8
        bits[first:first + PAGE // 8] |= np.frombuffer(r["bits"], np.uint8)
    return Filter(bits)


def unknown(coded: DataFrame, known: Filter) -> DataFrame:
    """Rows of ``coded`` whose code ``known`` does not hold."""
    sent = coded.sparkSession.sparkContext.broadcast(known)

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column("code").to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(~sent.value.holds(code)))

    return coded.mapInArrow(left_out, coded.schema)


def frequent_phrases(docs: DataFrame, least: int, one_in: int) -> tuple[DataFrame, int]:
    """((lang, phrase, n) of all phrases of up to ``LONGEST`` words found ``least`` times or more, passes over all rows that counted
    longer phrases than words).

    Toivonen's search. Words are counted with all rows. In a sample (one of ``one_in`` rows by their hashes) longer phrases that
    are frequent by a lowered bound are found size by size: the proposed ones. One pass over all rows then counts
    them and their negative border, the phrases that are not proposed though their prefix and suffix are.
    If phrases of the border are frequent, longer ones that hold them may have been missed: they are added, and an expansion
    pass counts every phrase that holds one of them and of which nothing is known to be rare. A
    frequent phrase that the first pass left out has a shortest part that is not proposed; the first pass counted that
    part, so it is added. So one expansion closes the search, and no phrase is missed whatever the sample was.
    Proposed phrases are sent as a filter of bits of bounded size; what it lets through by mistake is counted in vain.
    Longer phrases are counted by 128 bits, the codes of their prefix and last word, and get their words from the tables of
    shorter ones. Counts are exact unless 62-bit codes of two frequent words, or of prefixes with one last word, agree.
    """
    words = frequent_words(docs, least)
    singles = words.where("phrase <> ''")
    rows = docs.withColumn("__fw_h", F.xxhash64(*docs.columns)).where(F.pmod("__fw_h", F.lit(one_in)) == 0)
    sample = written(rows.select("lang", "text"), "collocation-sample")
    mean = least / one_in
    lowered = max(2, int(mean - 1.5 * sqrt(mean)))
    known = filled(singles, Filter.empty(bits_for(4 * singles.count())))
    for size in range(2, LONGEST):
        known = filled(frequent_pairs(sample, Rule((size,), known), lowered, "collocation-proposed"), known)
    sizes = tuple(range(2, LONGEST + 1))
    frequent = frequent_pairs(docs, Rule(sizes, known), least, "collocation-counts")
    passes = 1
    shorter = frequent.where(F.col("code").bitwiseAND(F.lit(3)) < LONGEST - 1)
    border = written(unknown(shorter, known), "collocation-border")
    n = border.count()
    if n:
        rule = Rule(sizes, known, filled(border, Filter.empty(bits_for(n))))
        frequent = frequent.unionByName(frequent_pairs(docs, rule, least, "collocation-counts"))
        passes = 2

    lasts = singles.select(F.col("code").alias("last_code"), F.col("phrase").alias("last_word"))
    level, named = singles, words.select("lang", "phrase", "n")
    for size in sizes:
        prefixes = level.select(F.col("code").alias("prefix_code"), "lang", "phrase")
        level = frequent.where(F.col("code").bitwiseAND(F.lit(3)) == size - 1)
        level = level.join(prefixes, F.col("prefix") == F.col("prefix_code")).join(lasts, F.col("last") == F.col("last_code"))
        level = written(level.select("lang", F.concat_ws(" ", "phrase", "last_word").alias("phrase"), "code", "n"), "collocation-named")
        named = named.unionByName(level.select("lang", "phrase", "n"))
    return named, passes


def scored(frequent: DataFrame, share: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words and more, without those that stand mostly in a longer one.

    A cut after the first k words gives floor(2000000 a / (l + r)), in exact decimals, l and r being the counts of the
    parts; the lowest counts, on ties the smallest k. A phrase goes if a longer one that holds it has
    ``share`` hundredths of its count or more. Both sides of every join are tables or shuffled rows, so a word that begins or
    ends many phrases can be split."""
    words = F.split("phrase", " ")
    several = frequent.where(F.contains("phrase", F.lit(" "))).select("lang", "phrase", F.col("n").alias("a"), words.alias("w"))
    size = F.size("w")
    cuts = several.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, size), " ").alias("rest"),
    )
    for part, out in (("first", "l"), ("rest", "r")):
        counts = frequent.select(F.col("lang").alias("part_lang"), F.col("phrase").alias("part"), F.col("n").alias(out))
        cuts = cuts.join(counts, (F.col("lang") == F.col("part_lang")) & (F.col(part) == F.col("part"))).drop("part_lang", "part")
    value = F.expr("(cast(a as decimal(28,0)) * 2000000BD) div (cast(l as decimal(28,0)) + cast(r as decimal(28,0)))")
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(value.alias("score"), "k", "l", "r")).alias("s"))
    lowest = lowest.select("lang", "phrase", "a", "s.l", "s.r", "s.score")

    def inner(k: int) -> Column:
        """The phrases of ``k`` words inside a longer one."""
        runs = F.transform(F.sequence(F.lit(1), size - (k - 1)), lambda i: F.array_join(F.slice("w", i, F.lit(k)), " "))
        return F.when(size > k, runs).otherwise(F.array().cast("array<string>"))

    longer = several.select("lang", "a", F.explode(F.concat(*[inner(k) for k in range(2, LONGEST)])).alias("part"))
    longer = longer.groupBy("lang", "part").agg(F.max("a").alias("most")).withColumnRenamed("lang", "part_lang")
    out = lowest.join(longer, (F.col("lang") == F.col("part_lang")) & (F.col("phrase") == F.col("part")), "left")
    gone = F.expr(f"cast(most as decimal(28,0)) * 100BD >= cast(a as decimal(28,0)) * {share}BD")
    return out.where(F.col("most").isNull() | ~gone).drop("part_lang", "part", "most")


def collocations(
    df: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, share: int = 80, top: int = 2000, one_in: int = 4,
) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score (numbers long).

    Texts in lower case (A-Z only) are cut into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and
    tabs. Phrases of 2 to ``LONGEST`` words found ``least`` times or more inside pieces, overlaps included, are found and counted by
    ``frequent_phrases`` over all rows, scored and thinned out by ``scored``, and ordered by score, count (both descending) and
    phrase (bytes). n counts all words of the language.

    NULL or empty texts have no words; a NULL language is ``und``. Repeated rows count once each. Very long texts are
    read in chunks, and no phrase is lost at their ends. Ties are broken by the phrase, so the result is the same each time. An
    empty table, or one without frequent phrases, gives no rows. Other columns are ignored, whatever their names.
    """
    docs = df.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"), *[
        F.col(c).alias(f"__fw_{i}") for i, c in enumerate(df.columns) if c not in (lang, text)
    ])
    frequent, _ = frequent_phrases(docs, least, one_in)
    found = scored(frequent.where("phrase <> ''"), share)
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    total = frequent.where("phrase = ''").select(F.col("lang").alias("n_lang"), "n")
    out = ranked.join(total, F.col("lang") == F.col("n_lang"))
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
