"""Toxicity: a support vector machine on a subsequence string kernel, with Nyström landmarks."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf

from framewright.llm.common import slices, written
from framewright.llm.tokens import balanced

#: Letters; what stands between the letters of a word is dropped, so it cannot hide them.
LETTERS = re.compile(r"[^\W\d_]+")
#: Longest unit; longer runs of letters are read in overlapping parts of this length.
LONGEST = 24
#: Lengths of the parts of units that landmarks are chosen from.
PARTS = range(4, 9)
#: Units remembered per Python worker. It bounds memory only.
REMEMBERED = 200_000


def runs(numbers: list[int]) -> Iterator[tuple[int, int]]:
    """First and last of every two or more consecutive numbers."""
    first = last = None
    for n in [*numbers, None]:
        if last is not None and n != last + 1:
            if last > first:
                yield first, last
            first = n
        if last is None:
            first = n
        last = n


def units(text: str) -> set[str]:
    """The different units of a text: its white-space separated words in lower case, letters only, between ^ and $.

    A row of single letters, each with a mark at most, as in a word spelt with gaps, is one unit. Runs longer than ``LONGEST`` letters are cut
    into overlapping parts, so every stretch of half that length lies whole in one of them."""
    words = text.lower().split()
    out = set(words)
    alone = [i for i, w in enumerate(words) if len(w) < 3 and (len(w) == 1 or w[0].isalpha() != w[1].isalpha())]
    for first, last in runs(alone):
        out.add("".join(words[first:last + 1]))
    plain = {w if w.isalpha() else "".join(LETTERS.findall(w)) for w in out}
    for w in [w for w in plain if len(w) > LONGEST]:
        plain.remove(w)
        plain.update(w[i:i + LONGEST] for i in range(0, len(w) - LONGEST // 2, LONGEST // 2))
    plain.discard("")
    return {f"^{w}$" for w in plain}


@dataclass
class Kernel:
    """Gap-weighted kernel of subsequences of ``order`` characters within ``span`` characters.

    A subsequence that takes s characters of a string, gaps included, weighs ``decay`` ** s in it; the kernel of two
    strings adds up the products of the weights of their common subsequences, divided by the norms the strings
    would have if all of their subsequences differed. That stays a kernel: each string is scaled by a number of its own.
    Strings shorter than ``order`` are padded with a mark that no text holds.
    """

    order: int = 3
    span: int = 7
    decay: float = 0.7
    offsets: list[tuple[int, ...]] = field(init=False)

    def __post_init__(self):
        from itertools import combinations

        inner = [c for k in range(self.order - 1, self.span) for c in combinations(range(1, self.span), self.order - 1) if c[-1] == k]
        self.offsets = [(0, *c) for c in dict.fromkeys(inner)]

    def features(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(string, code, weight) of every subsequence, weights scaled by the string's norm."""
        padded = ["\1" * max(0, self.order - len(s)) + s for s in strings]
        lengths = np.fromiter(map(len, padded), np.int64, len(padded))
        text = np.frombuffer("".join(padded).encode("utf-32-le"), "<u4").astype(np.uint64)
        owner = np.repeat(np.arange(len(padded)), lengths)
        left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(text))  # characters from here to the string's end
        who, codes, weights = [], [], []
        for c in self.offsets:
            at = np.flatnonzero(left > c[-1])
            code = np.zeros(len(at), np.uint64)
            for o in c:
                code = (code * np.uint64(1_000_003)) ^ text[at + o]
            who.append(owner[at])
            codes.append(code)
            weights.append(np.full(len(at), self.decay ** (c[-1] + 1), np.float32))
        who, codes, weights = np.concatenate(who), np.concatenate(codes), np.concatenate(weights)
        norm = np.sqrt(np.bincount(who, weights.astype(float) ** 2, len(padded)))
        return who, codes, weights / np.maximum(norm[who], 1e-12).astype(np.float32)


class Landmarks:
    """Kernel values of strings against fixed landmark strings, by a table of the landmarks' subsequences."""

    def __init__(self, kernel: Kernel, strings: list[str]):
        self.kernel, self.strings = kernel, strings
        who, codes, weights = kernel.features(strings)
        self.codes, inverse = np.unique(codes, return_inverse=True)
        self.table = np.zeros((len(self.codes), len(strings)), np.float32)
        self.maybe = np.zeros(1 << 16, bool)  # by the upper bits of a code: whether any landmark may have it
        self.maybe[self.folded(self.codes)] = True
        np.add.at(self.table, (inverse, who), weights)

    @staticmethod
    def folded(codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)

    def against(self, strings: list[str], project: np.ndarray) -> np.ndarray:
        """k(string, landmark) @ project for each string."""
        rows = self.table @ project
        most = 5_000 if project.ndim == 1 else 500  # a row of ``project`` for each subsequence found
        parts = [self._against(strings[i:i + most], rows) for i in range(0, len(strings), most)]
        return np.concatenate(parts) if parts else np.zeros((0, *rows.shape[1:]))

    def _against(self, strings: list[str], rows: np.ndarray) -> np.ndarray:
        """Sums of the landmark subsequences' ``rows`` that each string has, by their weights."""
        out = np.zeros((len(strings), *rows.shape[1:]))
        if not len(self.codes):
            return out
        who, codes, weights = self.kernel.features(strings)
        some = np.flatnonzero(self.maybe[self.folded(codes)])
        who, codes, weights = who[some], codes[some], weights[some]
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        hit = np.flatnonzero(self.codes[at] == codes)
        if rows.ndim == 1:
            return np.bincount(who[hit], weights[hit] * rows[at[hit]], len(strings))
        hit = hit[np.argsort(who[hit], kind="stable")]
        first = np.flatnonzero(np.diff(who[hit], prepend=-1))
        if len(first):
            out[who[hit[first]]] = np.add.reduceat(weights[hit, None] * rows[at[hit]], first, axis=0)
        return out


@dataclass
class Model:
    """f(unit) = alpha · k(unit, landmarks) + bias; a text's score is a sigmoid of its largest f."""

    landmarks: Landmarks
    alpha: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    known: dict[str, float] = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def margins(self, texts: list[str]) -> list[float]:
        """The largest f of each text's units; -inf without units. The units of a few texts are held at a time."""
        return [m for run in balanced(texts, 500_000) for m in self.margins_of([units(t) for t in run])]

    def margins_of(self, found: list[set[str]]) -> list[float]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = list(set().union(*found) - known.keys())
        for i in range(0, len(new), 5_000):
            part = new[i:i + 5_000]
            known.update(zip(part, (self.landmarks.against(part, self.alpha) + self.bias).tolist()))
        return [max(map(known.__getitem__, us), default=-np.inf) for us in found]

    def best(self, us: list[str], most: int) -> list[tuple[float, str]]:
        """The unit with the largest f, and up to ``most`` in all whose f is above 0."""
        top = sorted(zip(self.landmarks.against(us, self.alpha) + self.bias, us), reverse=True)[:most]
        return [x for i, x in enumerate(top) if i == 0 or x[0] > 0]

    def scores(self, texts: list[str]) -> np.ndarray:
        best = np.array(self.margins(texts))
        best = np.where(np.isfinite(best), best, -2.0)  # nothing to judge: as far out as a clear clean unit
        return 1 / (1 + np.exp(-np.clip(self.slope * best + self.shift, -30, 30)))


def nystrom(landmarks: Landmarks) -> np.ndarray:
    """K^(-1/2) of the landmarks' own kernel matrix: maps kernel values to features whose dot product approximates the kernel."""
    k = landmarks.against(landmarks.strings, np.eye(len(landmarks.strings), dtype=np.float32)).astype(float)
    values, vectors = np.linalg.eigh((k + k.T) / 2)
    values = np.maximum(values, 1e-3)
    return vectors @ np.diag(values ** -0.5) @ vectors.T


@dataclass
class Examples:
    """Which strings count as what: ``counts`` of toxic units, clean units, and the total weights of both classes.

    A toxic unit weighs log(1 + n); from three on its disguised forms weigh that in all, but for those that are clean units."""

    counts: dict[str, int]
    negatives: set[str]
    total: float = field(init=False)

    def __post_init__(self):
        self.total = sum(np.log1p(n) for n in self.counts.values())
        for u in self.disguisable():
            self.total += sum(self.hidden(u) for h in disguised(u) if h not in self.negatives)

    def disguisable(self) -> list[str]:
        return [u for u, n in self.counts.items() if n >= 3]

    def hidden(self, unit: str) -> float:
        return np.log1p(self.counts[unit]) / len(unit)

    def of(self, unit: str, base: str | None) -> tuple[float, float]:
        """(y, weight) of a unit, or of a disguised form of ``base``; a weight of 0 leaves it out."""
        if base is not None:
            known = self.counts.get(base, 0) >= 3 and unit not in self.negatives
            return 1.0, self.hidden(base) / self.total if known else 0.0
        if unit in self.negatives:
            return -1.0, 1.0 / len(self.negatives)
        return 1.0, np.log1p(self.counts.get(unit, 0)) / self.total


def kernel_rows(plain: list[str], bases: list[str], marks: Landmarks, root: np.ndarray, spark: SparkSession) -> DataFrame:
    """(unit, base, x) as a table, computed by the executors: the Nyström features of each string, 4-byte floats as bytes, and of the
    disguised forms of each base."""
    sent = spark.sparkContext.broadcast((marks, root.astype(np.float32)))  # a fixed number of short strings

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, root = sent.value
        for batch in batches:
            pairs = []
            for unit, is_base in zip(*(c.to_pylist() for c in batch.columns)):
                pairs += [(h, unit) for h in disguised(unit)] if is_base else [(unit, None)]
            for i in range(0, len(pairs), 4096):
                units, of = zip(*pairs[i:i + 4096])
                x = marks.against(list(units), root).astype("<f4")
                cells = pa.array([r.tobytes() for r in x], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(units), pa.array(of, pa.string()), cells], ["unit", "base", "x"])

    frame = spark.createDataFrame(pa.table({"unit": pa.array(plain + bases, pa.string()), "is_base": [False] * len(plain) + [True] * len(bases)}))
    dealt = frame.repartition(2 * spark.sparkContext.defaultParallelism)
    return written(dealt.mapInArrow(rows, "unit string, base string, x binary"), "toxic-kernel")


def hinge_sums(x: DataFrame, examples, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(sum of weight · max(0, 1 - y f)², its gradient, its Hessian) at ``w``, whose last number is the bias, over the rows of ``x``,
    as the broadcast ``Examples`` judge them. A task adds up its rows; only sums reach the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, grad, hessian, d = 0.0, np.zeros(len(w)), np.zeros((len(w), len(w))), len(w) - 1
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                y, weight = np.array([examples.value.of(u, b) for u, b in zip(part.column("unit").to_pylist(), part.column("base").to_pylist())]).T
                rows = np.frombuffer(b"".join(part.column("x").to_pylist()), "<f4").reshape(-1, d)
                slack = 1 - y * (rows @ w[:-1] + w[-1])
                on = (slack > 0) & (weight > 0)
                z = np.column_stack([rows[on], np.ones(int(on.sum()))])
                value += float(weight[on] @ slack[on] ** 2)
                grad -= 2 * z.T @ (weight[on] * y[on] * slack[on])
                hessian += 2 * (z.T * weight[on]) @ z
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([[value], grad, hessian.ravel()]).tobytes()], pa.binary())], ["s"])

    sums = [np.frombuffer(r["s"]) for r in x.mapInArrow(add, "s binary").collect()]
    total, n = np.sum(sums, axis=0), len(w)
    return float(total[0]), total[1:n + 1], total[n + 1:].reshape(n, n)


def svm(x: DataFrame, examples, cost: float, w: np.ndarray, steps: int = 60) -> np.ndarray:
    """Linear SVM with squared hinge loss by Newton steps from ``w``: half |w|² + cost · ``hinge_sums``, a job for each step."""
    reg = np.eye(len(w))
    reg[-1, -1] = 1e-6

    def at(w: np.ndarray):
        loss, grad, hessian = hinge_sums(x, examples, w)
        return 0.5 * w @ reg @ w + cost * loss, reg @ w + cost * grad, reg + cost * hessian

    value, grad, hessian = at(w)
    for _ in range(steps):
        step, size = np.linalg.solve(hessian, grad), 1.0
        new = at(w - step)
        while size > 1e-4 and new[0] > value:
            size /= 2
            new = at(w - size * step)
        w, (value, grad, hessian) = w - size * step, new
        if np.abs(size * step).max() < 1e-6:
            break
    return w


def platt(margin: np.ndarray, label: np.ndarray, weight: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of a sigmoid from margins to probabilities, by Newton steps."""
    z = np.column_stack([margin, np.ones(len(margin))])
    positive, negative = label.sum(), len(label) - label.sum()
    target = np.where(label == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z.T * (weight * p * (1 - p) + 1e-9)) @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, z.T @ (weight * (p - target)) + 1e-3 * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def labelled_units(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, most: int) -> DataFrame:
    """(label, units) of a sample of at most ``most`` labelled documents, half of them toxic where there are enough.

    The sample is the rows with the smallest hashes of their ids, so it is the same each time. Only its ids, at
    most ``most``, are sent to the tasks; the texts are taken apart where they lie and the units are written once."""
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).groupBy(doc_id).agg(F.max(label).alias("y"))
    picked = [
        known.where(F.col("y") == y).orderBy(F.xxhash64(doc_id), doc_id).limit(most // 2) for y in (0, 1)
    ]
    ids = picked[0].unionByName(picked[1]).withColumnRenamed(doc_id, "__fw_id")
    found = docs.select(doc_id, F.coalesce(text, F.lit("")).alias("t")).join(F.broadcast(ids), F.col(doc_id) == F.col("__fw_id"))

    def take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t", 4 << 20):
                cut = [sorted(units(t)) for t in part.column("t").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("y"), pa.array(cut, pa.list_(pa.string()))], ["y", "units"])

    return written(found.select(F.col("y").cast("int").alias("y"), "t").mapInArrow(take_apart, "y int, units array<string>"), "toxic-units")


def typical_units(sample: DataFrame, gains: DataFrame, most: int = 3) -> DataFrame:
    """(y, unit) of each sampled document's most typical units, to begin with: a unit's gain is that of its best part. At most
    ``most`` units, those with half of the best one's gain. All gains are joined, none is picked out before."""
    # the outer forms: Spark would compute the parts several times more to filter empty arrays
    numbered = sample.select("y", "units", F.monotonically_increasing_id().alias("d"))
    rows = numbered.select("y", "d", F.explode_outer("units").alias("u")).where("u is not null")
    tasks = 4 * sample.sparkSession.sparkContext.defaultParallelism
    cut = rows.select("u").distinct().repartition(tasks, "u").select("u", F.explode_outer(parts_of("u")).alias("p"))
    best = cut.join(gains, "p").groupBy("u").agg(F.max("gain").alias("gain"))
    found = rows.join(best, "u", "left").select("y", "d", F.struct(F.coalesce("gain", F.lit(0.0)).alias("gain"), "u").alias("s"))
    top = found.groupBy("d", "y").agg(F.slice(F.sort_array(F.collect_list("s"), asc=False), 1, most).alias("top"))
    top = top.select("y", F.col("top")[0]["gain"].alias("first"), F.explode("top").alias("s"))
    return top.where(F.col("s.gain") >= 0.5 * F.col("first")).select("y", F.col("s.u").alias("unit"))


def parts_of(unit: str) -> Column:
    """The parts of a unit, of the lengths of ``PARTS``."""
    none = F.array().cast("array<string>")

    def cut(k: int):
        starts = F.sequence(F.lit(1), F.length(unit) - (k - 1))
        return F.when(F.length(unit) >= k, F.transform(starts, lambda i: F.substring(unit, i, F.lit(k)))).otherwise(none)

    return F.flatten(F.array(*[cut(k) for k in PARTS]))


def spread(kernel: Kernel, strings: list[str], most: int, chunk: int = 64) -> list[str]:
    """The first ``most`` strings whose kernel with one chosen before is 0.6 at most. Strings are compared with the chosen
    ones and with their own chunk, so memory does not grow with the number of strings."""
    out: list[str] = []
    for start in range(0, len(strings), chunk):
        if len(out) >= most:
            break
        part = strings[start:start + chunk]
        if out:
            k = Landmarks(kernel, out).against(part, np.eye(len(out), dtype=np.float32))
            part = [s for s, near in zip(part, k.max(axis=1)) if near <= 0.6]
        k = Landmarks(kernel, part).against(part, np.eye(len(part), dtype=np.float32)) if part else None
        taken: list[int] = []
        for i in range(len(part)):
            if len(out) + len(taken) < most and (not taken or k[i, taken].max() <= 0.6):
                taken.append(i)
        out += [part[i] for i in taken]
    return out


def choose_landmarks(sample: DataFrame, kernel: Kernel, landmarks: int) -> tuple[Landmarks, DataFrame]:
    """Landmark strings: half of them the parts of units most typical of toxic documents, half the units most
    frequent in clean ones, leaving out a string whose kernel with a chosen one is above 0.6.

    A part is typical by its count times the log of its share in toxic over its share in clean documents. Landmarks come from the
    16 times as many most typical parts; the table (p, gain) has all parts with a gain."""
    seen = sample.select("y", F.explode_outer("units").alias("u")).where("u is not null").groupBy("u").agg(
        F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")
    )
    seen = written(seen, "toxic-candidates")
    total = seen.agg(F.sum("t"), F.sum("c")).first()
    toxic, clean = float(total[0] or 0) + 1, float(total[1] or 0) + 1
    parts = seen.select("t", "c", F.explode_outer(F.array_distinct(parts_of("u"))).alias("p")).where("p is not null")
    parts = parts.groupBy("p").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    gain = F.col("t") * (F.log((F.col("t") + 0.5) / toxic) - F.log((F.col("c") + 0.5) / clean))
    gains = written(parts.select("p", gain.alias("gain")).where("gain > 0"), "toxic-gains")
    top = gains.orderBy(F.desc("gain"), F.desc(F.length("p")), "p").limit(16 * landmarks)
    likely = [r["p"] for r in top.collect()]
    usual = [r["u"] for r in seen.where("t <= c and length(u) > 4").orderBy(F.desc("c"), "u").limit(2 * landmarks).collect()]
    first, second = spread(kernel, likely, landmarks // 2), spread(kernel, usual, landmarks // 2)
    return Landmarks(kernel, first + second), gains


def best_units(sample: DataFrame, model: Model, most: int = 3) -> list:
    """(label, rank, margin, unit) of the best units of each sampled document."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {"y": y, "rank": i, "margin": float(m), "unit": u}
                for y, us in zip(batch.column("y").to_pylist(), batch.column("units").to_pylist())
                for i, (m, u) in enumerate(model.best(us or [], most))
            ]
            yield pa.RecordBatch.from_pylist(
                rows, pa.schema([("y", pa.int32()), ("rank", pa.int32()), ("margin", pa.float64()), ("unit", pa.string())])
            )

    return sample.mapInArrow(best, "y int, rank int, margin double, unit string").collect()


def disguised(unit: str) -> list[str]:
    """The unit with a letter put in or doubled, each at every inner place."""
    inner = range(2, len(unit) - 1)
    return [unit[:i] + "qxz"[i % 3] + unit[i:] for i in inner] + [unit[:i] + unit[i - 1] + unit[i:] for i in inner]


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    kernel: Kernel | None = None, landmarks: int = 128, max_documents: int = 6000, rounds: int = 4, cost: float = 2000.0,
) -> Model | None:
    """Train on at most ``max_documents`` labelled documents (documented bound; NULL ids and labels are left out).

    A document's label says that some unit of it is toxic, or that none is. In each round the best units of
    every toxic document are positive examples, those met three times also with letters put in or doubled; the best
    units of clean documents so far are the negative ones.
    The machine is linear in the Nyström features K(landmarks)^(-1/2) k(unit, landmarks). Margins become
    probabilities by a sigmoid fitted to the documents, weighted to the classes' shares among all labels.
    Without both classes there is no model (None).
    """
    shares = dict(map(tuple, labels.where(F.col(label).isin(0, 1)).groupBy(label).count().collect()))
    if not shares.get(0) or not shares.get(1):
        return None
    sample = labelled_units(docs, labels, doc_id, text, label, max_documents)
    marks, gains = choose_landmarks(sample, kernel or Kernel(), landmarks)
    model = None
    if not marks.strings:
        return None
    root, spark = nystrom(marks), docs.sparkSession
    negatives: set[str] = set()
    rows, done = None, (set(), set())  # kernel rows are kept by string: most strings come back in every round
    w = np.zeros(len(marks.strings) + 1)
    for _ in range(rounds):
        found = best_units(sample, model) if model else typical_units(sample, gains).collect()  # a few units for each document
        negatives |= {r["unit"] for r in found if r["y"] == 0}
        counts = Counter(r["unit"] for r in found if r["y"] == 1 and r["unit"] not in negatives)
        if not counts or not negatives:
            return None
        examples = Examples(dict(counts), negatives)
        new = sorted((counts.keys() | negatives) - done[0]), sorted(set(examples.disguisable()) - done[1])
        if new[0] or new[1]:
            more = kernel_rows(*new, marks, root, spark)
            rows = more if rows is None else rows.unionByName(more)
            done[0].update(new[0])
            done[1].update(new[1])
        sent = spark.sparkContext.broadcast(examples)  # at most the best units of ``max_documents`` texts
        w = svm(rows, sent, cost, w)
        sent.destroy()
        model = Model(marks, root @ w[:-1], float(w[-1]))
    found = best_units(sample, model, 1)
    margin, truth = np.array([r["margin"] for r in found]), np.array([r["y"] for r in found])
    sampled = {c: max(1, int((truth == c).sum())) for c in (0, 1)}
    weight = np.array([shares[c] / sampled[c] for c in truth]) / (sum(shares.values()) / len(found))
    model.slope, model.shift = platt(margin, truth, weight)
    return model


def score(df: DataFrame, model: Model | None, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with ``out``: 0 to 1, higher for texts whose worst unit is likelier toxic.

    Whole texts are scored in Arrow functions; a worker remembers the units it has met. NULL or empty texts, and
    texts without letters, get the score of a clearly clean unit. Without a model every score is 0. An empty table gives no rows.
    """
    if model is None:
        return df.withColumn(out, F.lit(0.0))
    sent = df.sparkSession.sparkContext.broadcast(model)  # landmarks: a fixed number of short strings

    @arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(sent.value.scores(batch.to_pylist()), pa.float64())

    return df.withColumn(out, scores(F.coalesce(text, F.lit(""))))


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels must not be learnt from: crc32 of the id as text, modulo 5, is 0. NULL ids are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))
