"""Line dedup, token counts, decontamination, quality rules and packing against brute force, and their edges."""

import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from framewright.llm import decontaminate, lines, packing, quality, tokens
from framewright.llm.common import components, words_of
from __spark_entry__ import queries

from llm_helpers import SF, docs  # noqa: F401  (a fixture)

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n", "  a  b", "don't  'sup <|endoftext|> x<|endoftext|>y", "ΑΣ ΣΑΣ", "a\tb\x1cc\x85d\xa0e", "İstanbul ı ǅ",
    "１２ ½ ² Ⅷ ª", "漢字 かな", "x\0y z", "a\r\nb", "<|im", "😀😀 🏳️‍🌈", "-- ''s 't 'LL", "foo_bar a1b2", "\n\n a \n b", "ÀÉÎ ßß ×÷", "é é",
]


def alphabet(seed, n=300):
    rng = random.Random(seed)
    letters = "abé ÀÉ'sStT  \n\n<|>endoftext1234.,!_-́ßΣ×\t"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


# ---- lines

SHARED = "This line stands in many documents."


def test_lines(docs):
    df = docs(
        (1, f"one\n  {SHARED.upper()}\t\nend"), (2, f"{SHARED}\n{SHARED}\nshort\nshort"), (3, f"a\n{SHARED}"), (3, f"a\n{SHARED}"),
        (4, "short"), (5, "short"), (6, "short"), (7, None), (8, ""), (None, SHARED), (9, "É" * 20), (10, "é" * 20), (11, "É" * 20),
    )
    out = lines.drop_repeated_lines(df, prefix="x_")
    got = sorted((r["doc_id"] or -1, r["x_n_lines"], r["x_n_dropped"], r["x_kept"]) for r in out.collect())
    assert got == sorted([
        (-1, 1, 1, ""), (1, 3, 1, "one\nend"), (2, 4, 2, "short\nshort"), (3, 2, 0, f"a\n{SHARED}"), (3, 2, 0, f"a\n{SHARED}"),
        (4, 1, 0, "short"), (5, 1, 0, "short"), (6, 1, 0, "short"), (7, 1, 0, ""), (8, 1, 0, ""),
        (9, 1, 0, "É" * 20), (10, 1, 0, "é" * 20), (11, 1, 0, "É" * 20),
    ])
    assert {"n_lines", "kept", "score"} <= set(out.columns)
    assert lines.drop_repeated_lines(df.where("false")).count() == 0


# ---- tokens

@pytest.mark.parametrize("path", [BYTES, WORDS, public_tokenizers.path("piece_bpe_32k.model")])
def test_counts_equal_the_library(path):
    texts = [t or "" for t in ODD] + alphabet(1) + [" ".join(["word"] * 30_000), "x" * 50_000]
    if path.endswith(".model"):
        want = [len(ids) for ids in tokens.pieces_model(path).encode(texts)]
    else:
        want = [len(e) for e in tokens.tokenizer(path).encode_batch(texts, add_special_tokens=False)]
        if path == WORDS:
            assert [len(x) // 4 for x in packing.text_ids(path, texts)] == want
            return
    assert tokens.count_texts(path, texts) == want


def test_count_tokens(docs, real):
    out = tokens.count_tokens(docs(*enumerate(ODD)), BYTES).collect()
    tok = tokens.tokenizer(BYTES)
    for r in out:
        text = r["text"] or ""
        want = len(tok.encode(text, add_special_tokens=False))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), want, want > 1024)
    got = queries()["op3_token_counts"](real.sparkSession, SF).collect()
    texts = texts_of(real)
    assert len(got) == len(texts)
    assert all(r["n_tokens"] == len(tok.encode(texts[r["doc_id"]], add_special_tokens=False)) for r in got[::7])
    assert tokens.count_tokens(real.where("false"), BYTES).count() == 0


def test_small_memory_gives_the_same(monkeypatch):
    known = tokens.Recent(len, most=3)
    assert [known[k] for k in ["a", "bb", "a", "ccc", "dd", "a", "eeee", "bb"]] == [1, 2, 1, 3, 2, 1, 4, 2]
    assert len(known) <= 3


# ---- decontamination

def brute_windows(text, items, window):
    """Words, hit words and items by trying every window at every place."""
    words = words_of(text)
    hit, names = set(), set()
    for name, item in items:
        if name is None:
            continue
        w = words_of(item)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            for at in range(len(words) - size + 1):
                if words[at:at + size] == w[i:i + size]:
                    hit |= set(range(at, at + size))
                    names.add(str(name))
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_windows_by_brute_force(spark, docs, block_bytes):
    rng = random.Random(3)
    vocabulary = ["a", "B", "c", "é", "9"]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, some(rng.randrange(0, 9))) for i in range(12)] + [(3, some(4)), (20, None), (None, some(3)), (21, "!!")]
    texts = [None, "", "?!"] + [some(rng.randrange(60)) for _ in range(40)] + [some(3000)]
    bench = spark.createDataFrame(items, "item_id int, text string")
    out = decontaminate.find_benchmark(docs(*enumerate(texts)), bench, window=4, out="score", block_bytes=block_bytes)
    for r in out.collect():
        f = r["score"]
        assert (f["n_words"], f["n_hit"], f["items"]) == brute_windows(texts[r["doc_id"]], items, 4)
        assert sum(s["stop"] - s["start"] for s in f["spans"]) == f["n_hit"]
    empty = decontaminate.find_benchmark(docs((1, "a b")), bench.where("false")).collect()
    assert empty[0]["found"]["n_hit"] == 0 and empty[0]["found"]["n_words"] == 2


# ---- quality

def brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    triples = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if triples[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def test_base_rules(docs, real):
    texts = ODD + ["a b c a b c", "a b c\na b c\n \n \nx", " ".join("ab"[i % 2] for i in range(200)), "\x0bq\x0c"]
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for r in quality.base_rules(docs(*enumerate(texts)), prefix="q_").collect():
        assert tuple(r[f"q_{c}"] for c in base) == brute_quality(texts[r["doc_id"]]), texts[r["doc_id"]]
    whole = texts_of(real)
    got = queries()["op9_quality_rules"](real.sparkSession, SF).collect()
    assert len(got) == len(whole)
    assert all(tuple(r[c] for c in base) == brute_quality(whole[r["doc_id"]]) for r in got)


def brute_ratios(texts, trusted, buckets):
    import xxhash

    def signed(h):
        return h - (1 << 64) if h >= 1 << 63 else h

    def of(text):
        ends = [signed(xxhash.xxh64(w[-3:].encode(), seed=42).intdigest()) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        number = lambda h: (h & (1 << 64) - 1).to_bytes(8, "little")
        pair = lambda a, b: signed(xxhash.xxh64(number(b), seed=xxhash.xxh64(number(a), seed=42).intdigest()).intdigest())
        return [h % buckets for h in ends] + [pair(a, b) % buckets for a, b in zip(ends, ends[1:])]

    raw, good = collections.Counter(), collections.Counter()
    for i, t in texts:
        raw.update(of(t))
        if i in trusted:
            good.update(of(t))
    raws, goods = sum(raw.values()), sum(good.values())
    weight = {b: np.log((good[b] + 1) / (goods + buckets)) - np.log((raw[b] + 1) / (raws + buckets)) for b in raw}
    return {i: float(np.mean([weight[b] for b in of(t)])) if of(t) else 0.0 for i, t in texts}


def test_llr_by_brute_force(spark, docs):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdé!") for _ in range(rng.randrange(1, 6)))
    texts = [(i, " ".join(word() for _ in range(80))) for i in range(20)] + [(20, None), (21, ""), (22, "one")]
    trusted = spark.createDataFrame([(i,) for i in (1, 2, 3, 3, 22)] + [(None,)], "doc_id bigint")
    want = brute_ratios(texts, {1, 2, 3, 22}, 64)
    got = {r["doc_id"]: r for r in quality.quality(docs(*texts), trusted, buckets=64, prefix="q_").collect()}
    for i, _ in texts:
        assert got[i]["q_llr"] == pytest.approx(want[i], abs=1e-9)
        assert got[i]["q_kept"] == (not got[i]["q_base_failed"] and got[i]["q_llr"] >= -0.5)
    free = quality.quality(docs(*texts), trusted.where("false"), prefix="q_").collect()
    assert {r["q_llr"] for r in free} == {0.0}
    assert quality.quality(docs(*texts).where("false"), trusted).count() == 0


def test_queries_judge_whole_words(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(6)
    stems, ends = ["garden", "river", "window", "letter"], ["ing", "ed", "ness", "ly"]
    junk = ["qzxv", "wkjq", "zzgh", "xqvw"]
    of = lambda s: " ".join(rng.choice(s) + rng.choice(ends) for _ in range(120))
    texts = [(i, of(stems if i < 20 else junk)) for i in range(40)]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(10)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["doc_id"]: r for r in queries()["op9_quality_rules"](spark, str(tmp_path)).collect()}
    assert all(got[i]["kept"] == (i < 20) for i in range(40))
    documents = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, documents, str(tmp_path)).collect()} == set(range(20))


def test_quality_keeps_good_documents(real):
    got = queries()["op9_quality_rules"](real.sparkSession, SF)
    labels = real.sparkSession.read.parquet(f"{SF}/labels.parquet")
    known = got.join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k"))
    rate = {r["quality"]: r["k"] for r in known.collect()}
    assert rate[1] > 0.99 and rate[0] < 0.05


# ---- packing

def check_pieces(rows, ids, size=2048):
    """Every id in exactly one piece; sequences without gaps and not too long. Returns the share of padding."""
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for name, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids[name])
            at += p["length"]
            assert zlib.crc32(np.asarray(ids[name][p["start"]:at], "<u4").tobytes()) == p["ids_crc32"]
        assert at == len(ids[name])
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert 0 < at <= size
        padding += size - at
    return padding / max(1, size * len(by_seq))


def test_packing(real):
    tok = tokens.tokenizer(WORDS)
    ids = {i: tok.encode(t, add_special_tokens=False).ids + [1] for i, t in texts_of(real).items()}
    rows = queries()["op8_packing"](real.sparkSession, SF).collect()
    assert check_pieces(rows, ids) < 0.01


def test_packing_edges(docs):
    tok = tokens.tokenizer(WORDS)
    texts = [*ODD, "word " * 5000, *alphabet(2, 50)]
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    for size, windows, least in ((64, 1, 1), (64, 4, 16), (2048, 64, 32)):
        out = packing.pack(docs(*enumerate(texts)).repartition(3), WORDS, 1, size=size, open_windows=windows, least=least).collect()
        check_pieces(out, ids, size)
        assert all(np.frombuffer(r["ids"], "<u4").tolist() == ids[r["doc_id"]][r["start"]:r["start"] + r["length"]] for r in out)
    twice = packing.pack(docs((1, "a b"), (1, "a b"), (None, None)), WORDS, 1).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in twice) == [(0, 1), (1, 3), (1, 3)]
    assert packing.pack(docs((1, "a")).where("false"), WORDS, 1).count() == 0


# ---- shared

def test_components(spark):
    rng = random.Random(1)
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)]
    pairs = chain + [(f"r{rng.randrange(80):02}", f"r{rng.randrange(80):02}") for _ in range(60)] + [("x", "x"), ("hub", "zz")] * 2
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "u string, v string"), "t").collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    tied = {n for pair in pairs for n in pair if pair[0] != pair[1]}
    assert got == {n: find(n) for n in tied}
