"""Hard negatives, phrase mining and licence scans against brute force, and their edges."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from framewright.llm import collocations as col, licenses, negatives

# ---- hard negatives


def brute_negatives(rows, every=100, positives=5, most=10):
    """rows: (vec_id, label, vector) without NULLs, repeated rows once."""
    ints = [(i, l, [math.floor(256 * float(x)) for x in v]) for i, l, v in rows]
    out = []
    for a, label, v in ints:
        if a % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), b, l == label) for b, l, w in ints if b != a))
        near = [(b, -s) for s, b, same in scored if same][:positives]
        for b, p in near:
            inside = [(n, -s) for s, n, same in scored if not same and 30 * p <= 100 * -s <= 90 * p][:most]
            out += [(a, b, r, n, p, s) for r, (n, s) in enumerate(inside, 1)]
    return sorted(out)


def found_negatives(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>, rank string, anchor_id int, p double")
    return sorted(map(tuple, negatives.hard_negatives(df.repartition(3), **options).collect()))


@pytest.mark.parametrize("block", [16, 4096])
def test_hard_negatives(spark, block):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 6))
    rows = [(i, int(l), (centres[l] + rng.normal(size=6) * 0.7).astype(np.float32).tolist()) for i in range(300) for l in [rng.integers(4)]]
    rows += [(1000 + i, 1, rows[0][2]) for i in range(60)]  # many equal scores
    given = [(*r, "x", 7, 0.5) for r in rows]
    odd = [(None, 1, [1.0] * 6), (5000, None, [1.0] * 6), (5100, 1, None), (5200, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (5300, 1, [math.nan] * 6), (5400, 1, [math.inf] * 6)]
    given += [(*r, "x", 7, 0.5) for r in odd] + given[:5]
    expected = brute_negatives(rows)
    assert expected and found_negatives(spark, given, block=block, anchor_block=2) == expected


def test_hard_negatives_of_nothing(spark):
    assert found_negatives(spark, []) == []
    assert found_negatives(spark, [(0, 1, [], "x", 1, 0.0), (1, 1, [], "x", 1, 0.0), (2, 2, [1.0], "x", 1, 0.0)]) == [(0, 1, 1, 2, 0, 0)]
    assert found_negatives(spark, [(0, 1, [1.0], "x", 1, 0.0), (0, 1, [1.0], "x", 1, 0.0)]) == []


def test_large_components_are_exact(spark):
    big = [float(2**22), 3.0]
    rows = [(0, 1, big), (1, 1, big), (2, 2, [float(2**21), 1.0]), (3, 2, [float(2**20) + 32, 5.0])]
    assert found_negatives(spark, [(*r, "x", 1, 0.0) for r in rows]) == brute_negatives(rows)


def test_search_stops_early():
    """With one strong direction the threshold falls below the best rows long before the lists end."""
    rng = np.random.default_rng(0)
    vectors = np.column_stack([np.arange(4000.0), rng.integers(-3, 4, (4000, 3)).astype(float)])
    lists = negatives.Lists(np.arange(4000), np.zeros(4000, int), vectors)
    anchor, depths = np.array([5.0, 1.0, -1.0, 0.0]), lists.depths()
    bounds = [lists.thresholds(anchor[None], d)[0] for d in depths]
    met = []
    spy = negatives.search

    def counting(*args):
        rows, scores = spy(*args)
        met.append(len(rows))
        return rows, scores

    negatives.search = counting
    try:
        rows, scores = negatives.positives_of(lists, anchor, -1, 0, bounds, depths, 5)
    finally:
        negatives.search = spy
    every = vectors @ anchor
    assert sorted(scores) == sorted(every)[-5:] and met[0] < 1000


# ---- collocations


def brute_phrases(rows, least, share=80, top=2000):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(low)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(" ".join(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: c for p, c in counts.items() if " " in p and c >= least}
        rated = []
        for p, a in frequent.items():
            w = p.split(" ")
            cuts = [(2000000 * a // (counts[" ".join(w[:k])] + counts[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            longer = [c for q, c in frequent.items() if len(q) > len(p) and f" {p} " in f" {q} "]
            if not any(100 * c >= share * a for c in longer):
                rated.append((-score, -a, p.encode(), counts[" ".join(w[:k])], counts[" ".join(w[k:])]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rated)[:top], 1)]
    return sorted(out)


def invented(seed, n=300):
    rng = random.Random(seed)
    words = ["a", "b", "The", "the", "é", "É", "x1", "c d", "e\tf", "漢", "-", "g  h", "\xa0", "i\x0bj", "k.l", " "]
    return [(rng.choice(["en", "en", "de", None, ""]), " ".join(rng.choice(words[:rng.choice([3, 16])]) for _ in range(rng.randrange(40)))) for _ in range(n)]


def found_phrases(spark, rows, **options):
    df = spark.createDataFrame([(i, t, l, 1, "x") for i, (l, t) in enumerate(rows)], "doc_id bigint, text string, lang string, n int, phrase string")
    return sorted(map(tuple, col.collocations(df.repartition(4), **options).collect()))


def test_phrases_against_brute_force(spark):
    rows = invented(1) + [("en", None), ("en", ""), (None, "one word"), ("fr", "only. three, words")] + [("en", "near copy of one text")] * 40
    assert found_phrases(spark, rows, least=8) == brute_phrases(rows, 8)
    assert found_phrases(spark, rows, least=8, top=3) == brute_phrases(rows, 8, top=3)


def test_expansion_closes_the_search(spark):
    """A sample in which hardly anything is frequent: the border fails, the expansion finds all the same."""
    rows = invented(2)
    docs = spark.createDataFrame([("und" if l is None else l, t) for l, t in rows], "lang string, text string")
    frequent, passes = col.frequent_phrases(docs, 8, 1000)
    assert passes == 2
    low = collections.Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text.lower() if text.isascii() else text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))):
            w = re.findall(r"[^\x20\x09]+", piece)
            low.update(("und" if lang is None else lang, " ".join(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    got = {(r["lang"], r["phrase"]): r["n"] for r in frequent.where("phrase <> ''").collect()}
    assert got == {k: n for k, n in low.items() if n >= 8}


def test_phrases_of_nothing(spark):
    assert found_phrases(spark, []) == [] and found_phrases(spark, [("en", None), (None, "a b")]) == []


@pytest.mark.parametrize("chunk", [7, 64, 1 << 19])
def test_chunks_lose_no_phrase(chunk):
    rng = random.Random(chunk)
    text = "".join(rng.choice("ab c  d.\n") for _ in range(2000)) + "y" * 300 + " z"
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "de", "en"], "text": [text, "", "a b c d e f"]})
    got = collections.Counter()
    for b in col.count_batches(iter([batch]), col.Rule((1, 2, 3, 4)), chunk):
        for lang, phrase, _, n in zip(*(c.to_pylist() for c in b.columns)):
            got[lang, phrase] += n
    expected = collections.Counter()
    for lang, t in (("en", text), ("en", "a b c d e f")):
        for piece in re.split(r"[.\n]", t):
            w = piece.split()
            expected[lang, ""] += len(w)
            expected.update((lang, " ".join(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    assert +got == +expected


# ---- licences


def brute_licences(text, k=3, share=0.7, drift=3):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    starts, labels, best = [], set(), 0.0
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    base = sorted(labels)
    for t in licenses.parsed(licenses.TEMPLATES):
        hits = collections.defaultdict(set)
        for i in range(len(words) - k + 1):
            for at in range(len(t.words) - k + 1):
                if tuple(words[i:i + k]) == t.words[at:at + k]:
                    hits[i - at] |= set(range(at, at + k))
        groups, last = {}, None
        for d in sorted(hits):
            if last is None or d - last > drift:
                first = d
            last = d
            groups.setdefault((first, (d - first) // (2 * drift + 1)), set()).update(hits[d])
        for covered in groups.values():
            if len(covered) >= share * len(t.words) and set(t.marked) <= covered:
                labels.add(t.label)
                best = max(best, len(covered) / len(t.words))
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), base, sorted(labels), 1.0 if starts else best


MIT = licenses.TEMPLATES["mit"][2]
LICENCE_TEXTS = [
    None, "", " \n", "cc by", "CC BY-NC 4.0. Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU Lesser General Public License",
    "Released under the MIT License.", "Released under the license", f"x y {MIT} z", MIT.replace("charge", "fee").replace("copy", "a a copy"),
    " ".join(MIT.split()[::-1]), f"{MIT} {MIT}", "All rights reserved. ALL RIGHTS, reserved!", "É cc by é", "of the " * 200 + MIT[:60],
    "Licensed under CC BY-SA 4.0", "the software " * 50, "cc\x00by",
]


def test_licences_against_brute_force(spark):
    rng = random.Random(5)
    pool = " ".join(w for ts in licenses.TEMPLATES.values() for t in ts for w in t.replace("*", "").split()).split()
    texts = LICENCE_TEXTS + [" ".join(rng.choice(pool) for _ in range(rng.randrange(80))) for _ in range(60)]
    for t in licenses.parsed(licenses.TEMPLATES):  # notices with words changed, put in and left out
        for _ in range(4):
            words = list(t.words)
            for _ in range(rng.randrange(3)):
                i = rng.randrange(len(words))
                words[i:i + 1] = rng.choice([[], ["zz"], [words[i], "zz"]])
            texts.append(" ".join(["some", "words", *words, "and", "more"]))
    rows = [(i if i % 7 else None, t, "x", 1.5) for i, t in enumerate(texts)] + [(1, "", "x", 1.5)] * 3
    df = spark.createDataFrame(rows, "doc_id bigint, text string, labels string, score double").repartition(3)
    got = licenses.scan_licenses(df, prefix="f_").collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[f"f_{c}"] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")) == brute_licences(r["text"])
        assert r["labels"] == "x" and r["score"] == 1.5
    assert licenses.scan_licenses(df.where("false")).count() == 0


def test_spans_of_a_notice(spark):
    df = spark.createDataFrame([(1, f"one two {MIT.replace('charge', 'any charge')} three")], "doc_id bigint, text string")
    [span] = licenses.scan_licenses(df).first()["spans"]
    assert (span["label"], span["start"], span["stop"]) == ("mit", 2, 2 + len(MIT.split()) + 1) and span["share"] == 1.0


def test_licence_scan_stays_native(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    text = licenses.scan_licenses(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
