"""Near duplicates by BagMinHash: weighted-Jaccard signatures of shingle multisets, bands, exact checks."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from framewright.llm.common import components, slices, text_key, words_of, written

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Characters of text whose signatures are computed together, and members and elements of a tile.
BATCH = 4 << 20
TILE_DOCS, TILE_ELEMENTS = 1024, 2_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (splitmix64's)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of ``size`` words of each text; a text with fewer words is one shingle, with none it has none."""
    cut = [words_of(t) for t in texts]
    lengths = np.fromiter(map(len, cut), np.int64, len(cut))
    owner = np.repeat(np.arange(len(cut)), lengths)
    words = np.fromiter((zlib.crc32(w) for ws in cut for w in ws), np.uint64, int(lengths.sum()))
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(words))
    first = np.zeros(len(words), bool)
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    start = np.flatnonzero((left >= size) | first)
    last = np.minimum(left[start], size)
    h = np.zeros(len(start), np.uint64)
    for k in range(size):
        here = last > k
        h[here] = mix(h[here] * GOLDEN + words[start[here] + k] + np.uint64(k + 1))
    return owner[start], h


def counted(owner: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, times) of the different shingles of each text."""
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return owner[at], h[at], np.diff(np.append(at, len(h)))


def blocks(owner: np.ndarray, h: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
    """The dyadic weight blocks [1], [2], [3, 4], [5, 8], ... that a shingle's weight reaches:
    (text, seed, low end, width, weight). A block is one Poisson process, whatever its width."""
    out = []
    low, width, level = 0, 1, 0
    while len(h):
        seed = mix(h ^ (np.full(1, level + 1, np.uint64) * GOLDEN))
        out.append((owner, seed, np.full(len(h), low), np.full(len(h), width), times))
        low, width, level = low + width, max(1, low + width), level + 1
        more = times > low
        owner, h, times = owner[more], h[more], times[more]
    return tuple(np.concatenate(c) for c in zip(*out)) if out else tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, np.int64))


def signatures(owner: np.ndarray, h: np.ndarray, times: np.ndarray, docs: int, slots: int) -> np.ndarray:
    """BagMinHash signatures: for each text and slot the first point (a number that only equal points share) of
    the Poisson processes of its weights. Two texts agree in a slot with the probability of their weighted Jaccard similarity.

    Points of a block come at a rate of its width, in random order of slots. A point stands at a weight level within
    its block and counts where the shingle's weight reaches that level. Points are drawn up to a horizon
    at which all slots are likely taken; texts for which they are not are drawn again with twice the horizon."""
    sig = np.full((docs, slots), np.inf)
    weight = np.bincount(owner, times, docs)
    horizon = np.divide(slots * (math.log(slots) + 3), weight, out=np.full(docs, np.inf), where=weight > 0)
    todo = weight > 0
    while todo.any():
        pick = todo[owner]
        who, seed, low, width, reach = blocks(owner[pick], h[pick], times[pick])
        state, time = seed.copy(), np.zeros(len(who))
        sig[todo] = np.inf
        while len(who):
            state = state + GOLDEN
            draw = mix(state)
            time = time - np.log(((draw >> np.uint64(11)).astype(float) + 1) * 2.0 ** -53) / width
            alive = time <= horizon[who]
            who, seed, low, width, reach, state, time = (x[alive] for x in (who, seed, low, width, reach, state, time))
            bits = mix(state ^ np.uint64(0xD1B54A32D192ED03))
            slot = ((bits >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
            level = low + 1 + ((bits & np.uint64(0xFFFFFFFF)) * width.astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            count = level <= reach
            np.minimum.at(sig.reshape(-1), who[count] * slots + slot[count], time[count])
        todo = todo & np.isinf(sig).any(axis=1)
        horizon = np.where(todo, 2 * horizon, horizon)
    return sig.view(np.uint64)


def band_hashes(sig: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit hash for each band of equally many slots; bands never share hashes."""
    rows = sig.shape[1] // bands
    out = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN, (len(sig), 1))
    for r in range(rows):
        out = mix(out * GOLDEN + sig[:, r::rows][:, :bands])
    return out.view(np.int64)


def sketches(df: DataFrame, bands: int, rows: int, size: int) -> DataFrame:
    """(k1, k2, id, n, bands) for rows (k1, k2, id, text): n shingles and the hashes of the bands; none without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH):
                owner, h = shingles(part.column("text").to_pylist(), size)
                n = np.bincount(owner, minlength=part.num_rows)
                hashes = band_hashes(signatures(*counted(owner, h), part.num_rows, bands * rows), bands)
                lists = pa.array([row if k else [] for row, k in zip(hashes, n)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("k1"), part.column("k2"), part.column("id"), pa.array(n, pa.int64()), lists], ["k1", "k2", "id", "n", "bands"]
                )

    kind = df.schema["id"].dataType.simpleString()
    return df.select("k1", "k2", "id", "text").mapInArrow(run, f"k1 bigint, k2 bigint, id {kind}, n bigint, bands array<bigint>")


def elements(text: str, size: int) -> np.ndarray:
    """The shingles of a text as a set: each with its number among its equals, as one hash."""
    owner, h = shingles([text], size)
    _, h, times = counted(owner, h)
    first = np.repeat(np.cumsum(times) - times, times)
    return mix(np.repeat(h, times) + (np.arange(len(first)) - first).astype(np.uint64) * GOLDEN)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of some sets of hashes: products of 0/1 matrices over the hashes that two or more sets hold."""
    sizes = [len(s) for s in sets]
    out = np.diag(np.array(sizes, np.float32))
    everything = np.concatenate(sets)
    order = np.argsort(everything, kind="stable")
    values, owner = everything[order], np.repeat(np.arange(len(sets)), sizes)[order]
    new = np.append(True, values[1:] != values[:-1]) if len(values) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1 if len(values) else new
    owner, column = owner[shared], column[shared]
    if not len(owner):
        return out
    column = np.cumsum(np.append(True, column[1:] != column[:-1])) - 1
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = max(256, (8 << 20) // len(sets))
    for start in range(0, column[-1] + 1, width):
        a, b = np.searchsorted(column, [start, start + width])
        grid = np.zeros((len(sets), min(width, column[-1] + 1 - start)), np.float32)
        grid[owner[a:b], column[a:b] - start] = 1
        total += grid @ grid.T
    np.fill_diagonal(total, sizes)
    return total


def linked(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets whose Jaccard similarity is ``least`` or more. All pairs are compared."""
    both = overlaps(sets)
    size = np.diag(both).copy()
    near = both * (1 + least) >= least * (size[:, None] + size[None, :]) - 1e-6 * np.maximum(1, size[:, None])
    near &= both > 0
    out, left = [], np.ones(len(sets), bool)
    for i in range(len(sets)):
        if not left[i]:
            continue
        left[i] = False
        queue = [i]
        while queue:
            at = queue.pop()
            found = np.flatnonzero(near[at] & left)
            left[found] = False
            out += [(at, int(j)) for j in found]
            queue += found.tolist()
    return out


PAIRS = pa.schema([("u", pa.string()), ("v", pa.string())])


def links_in_tiles(members: DataFrame, size: int, least: float) -> DataFrame:
    """(u, v): the links of a spanning forest within each tile of rows (tile, node, text).

    Rows are dealt by tile and streamed tile by tile, so a task holds one tile, whose size is bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, nodes, sets = None, [], []

        def close() -> pa.RecordBatch:
            pairs = linked(sets, least) if len(sets) > 1 else []
            return pa.RecordBatch.from_pylist([{"u": nodes[i], "v": nodes[j]} for i, j in pairs], PAIRS)

        for batch in batches:
            for t, node, text in zip(*(batch.column(c).to_pylist() for c in ("tile", "node", "text"))):
                if t != tile:
                    if len(sets) > 1:
                        yield close()
                    tile, nodes, sets = t, [], []
                if not nodes or nodes[-1] != node:
                    nodes.append(node)
                    sets.append(elements(text, size))
        yield close()

    dealt = members.select("tile", "node", "text").repartition("tile").sortWithinPartitions("tile", "node")
    return dealt.mapInArrow(run, "u string, v string")


def tiled(members: DataFrame, group: str) -> DataFrame:
    """Members (node, group, n, ...) with their group's number of tiles ``tiles`` and their ``part``: groups
    of up to ``TILE_DOCS`` members and ``TILE_ELEMENTS`` shingles are one tile, larger ones as many as they need."""
    sizes = members.groupBy(group).agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    sizes = sizes.select(
        F.col(group).alias("__g"), F.greatest(F.ceil(F.col("c") / TILE_DOCS), F.ceil(F.col("s") / TILE_ELEMENTS)).alias("tiles")
    )
    sizes = written(sizes, "group-sizes")  # AQE splits a hot group only if both sides of the join are shuffled for it
    out = members.join(sizes, F.col(group) == F.col("__g")).drop("__g")
    return out.withColumn("part", F.pmod(F.xxhash64("node", F.lit(3)), F.col("tiles")))


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, least: float = 0.8, bands: int = 40, rows: int = 6
) -> DataFrame:
    """One row for each row of ``df``: (doc_id, class_id, class_size, kept), and hashes (k1, k2) of its text.

    Documents are near duplicates if the weighted Jaccard similarity of their multisets of ``size``-word shingles
    is ``least`` or more; classes are the connected components. ``class_id`` is the smallest id in the class and ``kept``
    marks the row with that id (rows that repeat both its id and its text, too). Words as in ``words_of``; a text with fewer words is one shingle.

    1. Equal texts are one node, kept as a 128-bit hash. Every row's BagMinHash signature is cut into ``bands`` bands;
       a pair at 0.8 misses all 40 bands of 6 slots with a probability of 5e-6.
    2. Nodes that share a band are candidates: every node is tied to the smallest of its band, and the connected groups
       of these ties hold all candidate pairs.
    3. A group of up to ``TILE_DOCS`` nodes is one tile: all of its pairs are compared exactly, in matrix products,
       and a spanning forest of the links comes out. Larger groups are dealt to several tiles first; what
       that links is contracted, and bands that still hold several classes are compared in tiles (``across``).
    4. The links' connected components are the classes.

    No pair is emitted that is not a link of a spanning forest. Bands and groups are counted before rows are dealt, copies
    of a text and ties of a band are added up before the shuffle. Texts without words are only equal to the same text.
    NULL text counts as empty. NULL ids are never the smallest; a class with NULL ids only has a NULL class_id.
    Repeated rows are in one class. An empty table gives no rows.
    """
    keys = text_key(F.coalesce(text, F.lit("")))
    rows_in = df.select(F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text"), keys[0].alias("k1"), keys[1].alias("k2"))
    sketch = written(sketches(rows_in, bands, rows, size), "sketches")
    node = F.concat_ws("_", F.hex("k1"), F.hex("k2")).alias("node")

    ids = sketch.groupBy("k1", "k2").agg(F.min("id").alias("least_id"), F.max("n").alias("n"))
    one = sketch.where("n > 0").select("k1", "k2", "bands").dropDuplicates(["k1", "k2"])
    band = one.select(node, F.explode_outer("bands").alias("h"))
    shared = band.groupBy("h").agg(F.count("*").alias("c"), F.min("node").alias("pivot")).where("c > 1")
    band = written(band.join(written(shared.drop("c"), "pivots"), "h"), "shared-bands")
    groups = components(band.where("node <> pivot").select(F.col("node").alias("u"), F.col("pivot").alias("v")), "candidates")

    members = groups.join(ids.select(node, "n", "k1", "k2", "least_id"), "node")
    members = written(tiled(members, "root"), "members").withColumn("tile", F.concat_ws(":", "root", "part"))

    def with_text(m: DataFrame) -> DataFrame:
        """Members with the text of their node, from the row with the node's smallest id."""
        m = m.withColumnsRenamed({"k1": "m1", "k2": "m2"})
        same = (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2")) & F.col("id").eqNullSafe(F.col("least_id"))
        return rows_in.join(m, same).select("tile", "node", "text")

    links = written(links_in_tiles(with_text(members), size, least), "links")
    if members.where("tiles > 1").limit(1).count():
        links = links.union(across(members.where("tiles > 1"), band, links, with_text, size, least))
    classes = components(links, "classes")

    named = ids.select(node, "k1", "k2", "least_id").join(classes, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    copies = sketch.groupBy("k1", "k2").agg(F.count("*").alias("copies"))
    named = written(named.join(copies, ["k1", "k2"]).drop("node"), "named")
    least_of = named.groupBy("root").agg(F.min("least_id").alias("class_id"), F.sum("copies").alias("class_size"))
    least_of = written(least_of.withColumnRenamed("root", "__r"), "class-ids")
    named = named.join(least_of, F.col("root") == F.col("__r")).select("k1", "k2", "root", "class_id", "class_size")
    named = named.withColumnsRenamed({"k1": "n1", "k2": "n2"})
    out = sketch.select("id", "k1", "k2").join(named, (F.col("k1") == F.col("n1")) & (F.col("k2") == F.col("n2")))

    # one row of the class stays: among those with the smallest id, the one with the smallest hash
    first = out.where(F.col("id").eqNullSafe(F.col("class_id"))).groupBy("root").agg(F.min(F.struct("k1", "k2")).alias("f"))
    first = written(first.withColumnRenamed("root", "__r"), "class-heads")
    out = out.join(first, F.col("root") == F.col("__r"), "left")
    kept = F.col("id").eqNullSafe(F.col("class_id")) & (F.struct("k1", "k2") == F.col("f"))
    return out.select(F.col("id").alias(doc_id), "class_id", "class_size", F.coalesce(kept, F.lit(False)).alias("kept"), "k1", "k2")


def across(members: DataFrame, band: DataFrame, links: DataFrame, with_text, size: int, least: float) -> DataFrame:
    """Links between the tiles of large groups.

    What the tiles linked is contracted to classes. A band all of whose nodes are in one class is done; equal
    sets of nodes that several bands hold are compared once. In the other bands, nodes are dealt to parts so that a class
    with many nodes has parts of its own, and every two parts that are not of one class are a tile: together
    the tiles compare each pair of nodes of different classes that share a band."""
    classes = components(links, "classes-of-tiles")
    m = members.drop("tile", "part", "tiles", "root").join(classes, "node", "left").withColumn("class", F.coalesce("root", "node")).drop("root")
    held = band.select("h", "node").join(m, "node")
    seen = held.groupBy("h").agg(
        F.count("*").alias("c"), F.min("class").alias("low"), F.max("class").alias("high"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("print"),
    ).where("low <> high")
    chosen = seen.groupBy("c", "print").agg(F.min("h").alias("h")).select(F.col("h").alias("__h"))
    held = written(held.join(chosen, F.col("h") == F.col("__h")).drop("__h"), "open-bands")
    half_docs, half_elements = TILE_DOCS // 2, TILE_ELEMENTS // 2
    parts = lambda c, s: F.greatest(F.ceil(c / half_docs), F.ceil(s / half_elements))
    by_class = held.groupBy("h", "class").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    by_class = by_class.withColumn("own", parts(F.col("c"), F.col("s")))
    small = by_class.where("own <= 1").groupBy("h").agg(parts(F.sum("c"), F.sum("s")).alias("pool"))
    plan = by_class.join(small.withColumnRenamed("h", "__h"), F.col("h") == F.col("__h"), "left").select(
        F.col("h").alias("ph"), F.col("class").alias("pc"), "own", F.coalesce("pool", F.lit(1)).alias("pool")
    )
    held = held.join(plan, (F.col("h") == F.col("ph")) & (F.col("class") == F.col("pc")))
    part = F.when(F.col("own") > 1, F.concat_ws("/", "class", F.pmod(F.xxhash64("node"), F.col("own")))).otherwise(
        F.concat_ws("/", F.lit(""), F.pmod(F.xxhash64("class"), F.col("pool")))
    )
    held = written(held.withColumn("part", part).withColumn("alone", F.when(F.col("own") > 1, F.col("class"))), "open-parts")
    each = held.select("h", "part", "alone").distinct()
    other = each.select(F.col("h").alias("oh"), F.col("part").alias("other"), F.col("alone").alias("other_alone"))
    pairs = each.join(other, (F.col("h") == F.col("oh")) & (F.col("part") <= F.col("other")))
    pairs = pairs.where(~F.coalesce(F.col("alone") == F.col("other_alone"), F.lit(False)))
    tile = F.concat_ws(":", "h", "part", "other")
    sides = pairs.select("h", "part", tile.alias("tile")).union(pairs.select("h", F.col("other").alias("part"), tile.alias("tile"))).distinct()
    sides = sides.withColumnsRenamed({"h": "sh", "part": "sp"})
    dealt = held.join(sides, (F.col("h") == F.col("sh")) & (F.col("part") == F.col("sp")))
    return written(links_in_tiles(with_text(dealt.select("tile", "node", "k1", "k2", "least_id")), size, least), "links-across")
