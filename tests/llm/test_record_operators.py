"""WARC, HTML text, chat format, toxicity, near duplicates and the pipeline."""

import gzip
import hashlib
import io
import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from framewright.llm import chat, html, neardup, toxicity, warc
from framewright.llm.common import words_of
from __spark_entry__ import queries

from llm_helpers import SF, docs  # noqa: F401  (a fixture)


# ---- WARC

def test_warc_round_trip(spark):
    big = "x" * 100
    pages = [(1, "u", big, 0), (2, None, big, 0), (3, "http://a\r\nb c", None, 0), (4, "u", "", 0), (5, "é", "é" * 60, 0), (None, "u", big, 0), (1, "u", big, 0),
             (6, "u", "y" * 99, 0), (7, "u", "y" * 99, 0)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, offset int").repartition(2)
    files = warc.write_archives(df, file_bytes=700)
    index = warc.normalise(files)
    rows = sorted(
        ((r["record_id"].removeprefix(warc.URN), r["record_type"], r["payload"], r["payload_bytes"], r["refers_to"]) for r in warc.read_records(index).collect()),
        key=str,
    )
    want = []
    for i, _, h, _ in pages:
        data = (h or "").encode()
        again = i == 2
        want.append((str(i or ""), "revisit" if again else "response", None if again else data, len(data), f"{warc.URN}1" if again else None))
    assert [(a, b, c and bytes(c), d, e) for a, b, c, d, e in rows] == sorted(want, key=str)
    for name, offset, length in index.select("file", "offset", "length").collect():
        raw = open(name.removeprefix("file:"), "rb").read()
        assert gzip.decompress(raw[offset:offset + length]).startswith(b"WARC/1.1\r\n")
        side = [json.loads(x) for x in open(name.removeprefix("file:").replace(".warc.gz", ".index.jsonl"))]
        assert [raw[x["offset"]:x["offset"] + x["length"]][:2] for x in side] == [b"\x1f\x8b"] * len(side)
    assert warc.read_records(warc.normalise(warc.write_archives(df.where("false")))).count() == 0


@pytest.mark.parametrize("members", [1, 3, 10])
def test_inflate_any_members(members):
    records = [warc.record(str(i), "u", bytes([65 + i]) * (i * 200_000), "d", None, "now") for i in range(10)]
    data = b"".join(gzip.compress(b"".join(records[i::members])) for i in range(members))
    got = [raw for _, raw in warc.records_of(io.BytesIO(data))]
    assert got == [r for i in range(members) for r in records[i::members]]
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(gzip.compress(records[3])[:-30])))


# ---- HTML

RICH = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="x"><header class="site"><h2>Site</h2></header>
<nav><ul><li><a href=/>Home</a></ul></nav><div id="cookie-notice">We use cookies</div><div class="wrap"><div class="post-content"><h1>A &amp; B %d</h1>
<p>One <b>two</b>\n\tthree&nbsp;four %d.<p>Five &lt; six<ul><li>a<li>b</ul><div class="ad">Buy now</div><table><tr><td>x<td>y</table><script>var a="</p>";</script></div>
<div class="sidebar">Side <a href=x>link</a></div><div id="comments"><p>A long reader comment that says a lot about the article.</p></div></div>
<form>Name <input name=a></form><footer>&copy; c</footer></body></html>"""


def test_main_text(spark):
    pages = [(i, f"http://h{i % 2}.example/{i}", RICH % (i, i), "t") for i in range(6)]
    pages += [(10, "http://h0.example/x", None, "t"), (11, None, "", "t"), (12, "http://h1.example", "<p>alone", "t"), (13, "nonsense", "plain < text &amp; more", "t"), (None, None, "<article>é", "t")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, text string").repartition(3)
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html.extract_text(df).collect()}
    want = {i: f"A & B {i}\nOne two three four {i}.\nFive < six\na\nb\nx\ny" for i in range(6)}
    want |= {10: "", 11: "", 12: "alone", 13: "plain < text & more", None: "é"}
    assert got == {k: (v, len(v)) for k, v in want.items()}
    assert html.extract_text(df.where("false")).count() == 0


def test_wrapper_inference():
    def tree(text):
        return html.fold(html.read_page(text)[0])

    a = tree("<div><h1>x</h1><p>a<p>b</div><footer>same</footer>")
    b = tree("<div><h1>y</h1><p>c<blockquote>q</blockquote></div><footer>same</footer>")
    assert html.expression(html.merge(a, b)) == "<div><h1>#TEXT</> (<p>#TEXT</>)+ (<blockquote>#CONST</>)?</> <footer>#CONST</>"
    pairs = tree("<dl>" + "<dt>k<dd>v" * 4 + "</dl>")
    assert html.expression(pairs) == "<dl>(<dt>#CONST</> <dd>#CONST</>)+</>"
    again = html.Node.unpack(json.loads(json.dumps(pairs.pack())))
    assert again.pack() == pairs.pack()


def test_pages_of_the_table(spark):
    def brute(page):
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        parts = re.sub(r"<[^>]+>", "", re.sub(r"<br>", " ", re.sub(r"</?(?:p|h1)>", "\0", article))).split("\0")
        import html as h
        return "\n".join(x for x in (" ".join(h.unescape(p).split()) for p in parts) if x)

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries()["op4_html_text"](spark, SF).collect()
    assert len(got) == len(pages) and all(r["text"] == brute(pages[r["page_id"]]) for r in got)


def text_of(page):
    return html.main_text(page, [])


def test_every_class_word_is_judged():
    page = "<body><article><h1>A</h1><p>Text.</p><div class='%s' id='%s'>Buy now</div></article></body>"
    for words in ("block container module row widget", "c-box l-col l-right m-top sidebar", "a b c d e f g comments"):
        assert text_of(page % (words, "")) == text_of(page % ("a b c d", "x y " + words)) == "A\nText."
    assert text_of(page % ("a b c d e", "f")) == "A\nText.\nBuy now"
    outside = "<body><div class='a b c d topbar'>Site</div><div class=post><p>Text one.</p></div></body>"
    assert "Site" not in text_of(outside)


def test_names_never_empty_a_page(spark):
    body = "<h1>A</h1><p>The text of the article.</p><div class='sidebar'>Side</div>"
    want = "A\nThe text of the article."
    for c in ("has-sidebar", "no-sidebar", "comments-open", "widget sidebar", "popup modal", "masthead"):
        assert text_of(f"<html class='{c}'><body class='{c}'><article>{body}</article><p>Other.</p></body></html>") == want
        assert text_of(f"<body class='{c}' aria-hidden=true><div class=post>{body}</div></body>") == want
        for outer in ("<div class='%s'><article>%s</article><div class='related'><article>Card</article></div></div>", "<div id='%s'>%s</div>", "<main><div class='%s'>%s</div></main>", "<article class='%s'>%s</article>"):
            page = "<body><div class='ad'>Buy</div>" + outer % (c, body) + "<div class='comments'><p>I say.</p></div></body>"
            assert text_of(page) == want, page
    # parts are parts still
    page = "<body><article>%s</article><div class='comments'><article>%s</article></div><div class='related'><article>Card</article></div></body>"
    assert text_of(page % (body, "I say a lot more than the article does. " * 9)) == want
    thread = "<body><div class='post'>%s</div><div id='comments'><p>%s</p></div></body>"
    assert text_of(thread % (body, "I say a lot more than the article does. " * 9)) == want
    assert text_of(f"<body><main>{body}<div class='related'><article>Card</article></div></main></body>") == want
    df = spark.createDataFrame([(i, "http://h/", f"<body class='has-sidebar'><div class='with-sidebar'><article>{body}{i}</article></div></body>") for i in range(3)], "page_id int, url string, html string")
    assert {r["page_id"]: r["text"] for r in html.extract_text(df).collect()} == {i: f"{want}\n{i}" for i in range(3)}


def test_names_inside_an_article():
    kept = '<h2 id="legal-history">A</h2><h2 id="related-work">B</h2><h2 id="search">C</h2><p class="share-price">D</p>'
    kept += "".join(f'<section id="{i}">{i}</section>' for i in ("side-effects", "social-impact", "ad-hoc-methods", "alert-systems", "comments-on-method"))
    cut = "".join(f'<div class="{c}">no</div>' for c in ("ad", "related-posts", "comment-list", "werbung", "newsletter-box"))
    cut += '<p class="notice">no</p><div id="kommentare"><article>no</article></div><div class="search-topics"><a href=x>all of it links</a></div>'
    want = "A\nB\nC\nD\nside-effects\nsocial-impact\nad-hoc-methods\nalert-systems\ncomments-on-method"
    assert text_of(f"<body><article>{kept}{cut}</article></body>") == want


def test_constant_slots_go(spark):
    def page(i, box="Call us."):
        return f"<body><article><h1>Title {i}</h1><h2>Method</h2><p>Text of {i} is longer.</p><div class='box7'><p>{box}</p><p>Now.</p></div><ul><li>a</ul></article></body>"

    pages = [(i, "http://a/", page(i)) for i in range(5)]  # constant on five pages
    pages += [(10 + i, "http://b/", page(i, f"Box {i}.")) for i in range(5)]  # varies
    pages += [(20 + i, "http://c/", page(i % 2)) for i in range(6)]  # two different pages, three times each
    pages += [(30 + i, "http://d/", f"<body><article><div class=x><p>The one article.</p></div><p>{i}</p></article></body>") for i in range(5)]  # most of it
    df = spark.createDataFrame(pages, "page_id int, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in html.extract_text(df).collect()}
    for i in range(5):
        assert got[i] == f"Title {i}\nMethod\nText of {i} is longer.\na"
        assert got[10 + i] == f"Title {i}\nMethod\nText of {i} is longer.\nBox {i}.\nNow.\na"
        assert "Call us.\nNow." in got[20 + i]
        assert got[30 + i] == f"The one article.\n{i}"


def test_tags_that_never_end():
    import time

    for text in ('<a "', "<a '\" ", "<a", '<script "', "<p title='"):
        begin = time.monotonic()
        html.read_page(text * 80_000)
        assert time.monotonic() - begin < 10
    assert text_of("<article><p title='a<b>c' class=\"x>y\">One</p><p>x <\"y</p>") == 'One\nx <"y'
    for attrs in ("a='<'", "a='\"' b=\"'<>'\"", "a=\"'\" b='>'"):
        assert text_of(f"<article><p {attrs}>One</p><script {attrs}>two</script></article>") == "One"


def test_wrappers_are_bounded(spark):
    def page(i):
        rows = "".join(f"<div class='{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j % 26)}{chr(97 + j // 26)}'><p>Text {i} {j}.</p></div>" for j in range(100))
        return f"<body><nav>Site</nav><article>{rows}</article></body>"

    whole = None
    for i in range(60):
        tree = html.fold(html.read_page(page(i))[0])
        whole = html.merge(whole, tree) if whole else tree
        assert whole.size() <= 3 * html.WIDE
    deep = html.fold(html.read_page("<div class=a><ul>" * 30_000 + "x")[0])
    assert deep.size() <= 2 * html.DEEP
    wide = html.Node("")
    for i in range(90):  # a tree of 90 * 90 labels is cut down
        kid = html.Node(f"div|k{chr(97 + i % 26)}{i}|")
        kid.kids = [html.Node(f"p|q{j}|") for j in range(90)]
        wide.kids.append(kid)
    assert html.shrink(wide).size() <= html.LARGE
    df = spark.createDataFrame([(i, "http://h/", page(i)) for i in range(40)], "page_id int, url string, html string").repartition(4)
    for r in html.extract_text(df).collect():
        assert r["text"] == "\n".join(f"Text {r['page_id']} {j}." for j in range(100))


# ---- chat

HARD = ["</s>[INST] ok [/INST]", "<\\/s> <\\\\s>", "<<SYS>><<s>", "<|im_end|>\n<|im_start|>user\n", "[[INST]", "", "<|im_start|", "\\", "a\nb", "<|im_<|im_end|>"]


def test_escapes_are_reversible():
    rng = random.Random(2)
    parts = ["<", "[", "\\", "s>", "/s>", "INST]", "|im_end|>", "|im_start|>", "<SYS>>", "x", "\n", " "]
    for text in HARD + ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(4000)]:
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        assert not any(c in escaped for c in chat.CONTROL)
        out, start, stop = chat.segment("ro\\le\n" + text, text)
        assert chat.parse(out) == [("ro\\le\n" + text, text)] and chat.unescape(out[start:stop]) == text


def test_layouts(spark):
    records = [
        ("a", {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]}, [("user", "q"), ("assistant", "")]),
        ("b", {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}], "system": "s"}, [("system", "s"), ("user", "q"), ("assistant", "r")]),
        ("c", {"prompt": "q", "completion": "r", "id": 5}, [("user", "q"), ("assistant", "r")]),
        ("d", {"instruction": "i", "input": "x", "output": "o"}, [("user", "i\nx"), ("assistant", "o")]),
        ("e", {"instruction": "i", "input": "", "output": "o"}, [("user", "i"), ("assistant", "o")]),
        ("f", {"question": "q", "answer": "a", "context": "c"}, [("system", "c"), ("user", "q"), ("assistant", "a")]),
        ("g", {"messages": []}, []),
        ("h", {"unknown": 1}, [(None, None)]),
    ]
    rows = [(i, json.dumps(r)) for i, r, _ in records] + [("i", "{broken"), (None, None)]
    got = chat.canonical_turns(spark.createDataFrame(rows, "k string, seq string"), "seq", "k").collect()
    for i, _, want in [*records, ("i", None, [(None, None)]), (None, None, [(None, None)])]:
        assert [(r["role"], r["text"]) for r in sorted((r for r in got if r["id"] == i), key=lambda r: r["seq"])] == want


def test_digests(spark):
    turns = [("a", 1, "assistant", HARD[0]), ("a", 0, "user", HARD[1]), ("a", 1, "assistant", HARD[0]), ("b", 0, None, None), (None, 0, "assistant", "x"), ("c", None, "assistant", "é")]
    df = spark.createDataFrame(turns, "id string, seq bigint, role string, text string")
    got = {r["id"]: r for r in chat.read_back(chat.format_turns(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got["a"]["turns_sha256"] == sha(f"user\n{HARD[1]}\nassistant\n{HARD[0]}\nassistant\n{HARD[0]}\n")
    assert (got["a"]["n_turns"], got["a"]["loss_chars"], got["a"]["loss_sha256"]) == (3, 2 * len(HARD[0]), sha(HARD[0] * 2))
    assert (got["b"]["n_turns"], got["b"]["loss_chars"]) == (1, 0) and got[None]["loss_chars"] == got["c"]["loss_chars"] == 1
    assert chat.read_back(chat.format_turns(df.where("false"))).count() == 0


# ---- toxicity

def test_kernel_by_brute_force():
    from itertools import combinations

    kernel = toxicity.Kernel(order=3, span=5, decay=0.5)

    def weights(s):
        out = {}
        for c in combinations(range(len(s)), 3):
            if c[-1] - c[0] < 5:
                key = "".join(s[i] for i in c)
                out.setdefault(key, []).append(0.5 ** (c[-1] - c[0] + 1))
        return out

    def k(a, b):
        wa, wb = weights(a), weights(b)
        norm = lambda w: sum(x * x for v in w.values() for x in v) ** 0.5
        return sum(sum(v) * sum(wb.get(key, [])) for key, v in wa.items()) / (norm(wa) * norm(wb))

    strings = ["idiot", "id-iot", "banana", "anan", "xyz", "abcdefgh"]
    got = toxicity.Landmarks(kernel, strings).against(strings, np.eye(len(strings), dtype=np.float32))
    assert np.allclose(got, [[k(a, b) for b in strings] for a in strings], atol=1e-5)


def test_units():
    assert toxicity.units("You I id-i-o.t! i d i o t. then a\n42 ") == {"^you$", "^idiot$", "^then$", "^i$", "^a$", "^d$", "^o$", "^t$"}
    long = "x" * 10 + "abcdefghijkl" + "y" * 40
    assert any("abcdefghijkl" in u for u in toxicity.units(long))


def test_toxicity(spark, docs):  # noqa: F811
    rng = random.Random(4)
    plain = ["the", "river", "stone", "morning", "other", "house", "linen", "early", "wandering", "green"]
    bad = ["grumbix", "vortag"]
    texts = [" ".join(rng.choice(plain) for _ in range(30)) + (" " + bad[i % 2] if i % 3 == 0 else "") for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 9) for i in range(300)] + [(None, 1, 9), (1, None, 9)], "doc_id bigint, toxic int, score int")
    model = toxicity.fit(docs(*enumerate(texts)), labels)
    tests = ["the g r u m b i x river", "the gru-mbix", "gruumbix house", "VORTAG!!", "vorxtag", "the other house", None, "", "??"]
    got = [r["s"] for r in toxicity.score(docs(*enumerate(tests)), model, out="s").orderBy("doc_id").collect()]
    assert min(got[:5]) > max(got[5:]) and min(got[:4]) > 0.5 and max(got[5:]) < 0.1
    assert toxicity.fit(docs((1, "a")), labels.where("toxic = 0")) is None
    assert toxicity.score(docs((1, None)), None, out="s").collect()[0]["s"] == 0.0
    assert toxicity.score(docs((1, "a")).where("false"), model, out="s").count() == 0


def test_typical_units_of_rare_languages(spark, docs):  # noqa: F811
    def word(rng):
        return "".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(5))

    rng = random.Random(8)
    many, rare = [word(rng) for _ in range(60)], "zuxqizwaj"
    texts = [f"{word(rng)} {word(rng)} {many[i % 60]}" for i in range(600)] + [f"{word(rng)} {rare}" for _ in range(2)]
    texts += [f"{word(rng)} {word(rng)}" for _ in range(300)]
    labels = spark.createDataFrame([(i, int(i < 602)) for i in range(len(texts))], "doc_id bigint, toxic int")
    sample = toxicity.labelled_units(docs(*enumerate(texts)), labels, "doc_id", "text", "toxic", 2000)
    marks, gains = toxicity.choose_landmarks(sample, toxicity.Kernel(), 8)
    got = [r["unit"] for r in toxicity.typical_units(sample, gains).where("y = 1").collect()]
    assert got.count(f"^{rare}$") == 2 and all(got.count(f"^{w}$") == 10 for w in many)


def test_landmarks_in_chunks():
    rng, kernel = random.Random(9), toxicity.Kernel()
    strings = ["".join(rng.choice("abcd") for _ in range(rng.randrange(4, 9))) for _ in range(200)]
    k = toxicity.Landmarks(kernel, strings).against(strings, np.eye(len(strings), dtype=np.float32))
    taken = []
    for i in range(len(strings)):
        if len(taken) < 40 and (not taken or k[i, taken].max() <= 0.6):
            taken.append(i)
    assert toxicity.spread(kernel, strings, 40, chunk=16) == [strings[i] for i in taken]


# ---- near duplicates

def brute_classes(texts, least=0.8):
    """Components by comparing all pairs of texts' shingle counts."""
    from collections import Counter

    def bag(t):
        w = words_of(t)
        return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else None

    bags = [bag(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            a, b = bags[i], bags[j]
            both = sum((a & b).values()) if a and b else 0
            if texts[i] == texts[j] or both and both >= least * sum((a | b).values()) - 1e-9:
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return [find(i) for i in range(len(texts))]


def copies(seed, groups, words, members):
    """Texts in groups of chained near copies, their similarities on both sides of the bound."""
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{rng.randrange(60)}" for _ in range(words)]
        for _ in range(members):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(words)] = f"e{rng.randrange(1000)}"
            out.append(" ".join(text))
            if rng.random() < 0.5:
                base = text
    return out


@pytest.mark.parametrize("tile", [1024, 8])
def test_classes_by_brute_force(docs, monkeypatch, tile):  # noqa: F811
    monkeypatch.setattr(neardup, "TILE_DOCS", tile)
    texts = copies(1, 4, 80, 25) + ["", "", "!!", "!!", "?", "a b", "A, b.", "a b c d e", "x y " * 200, "x y " * 210, "x y " * 150]
    want = brute_classes(texts)
    got = {r["doc_id"]: r for r in neardup.near_duplicates(docs(*enumerate(texts))).collect()}
    assert [got[i]["class_id"] for i in range(len(texts))] == want
    assert all(r["kept"] == (i == want[i]) and r["class_size"] == want.count(want[i]) for i, r in got.items())


def test_near_duplicate_edges(docs):  # noqa: F811
    same = "one two three four five six"
    rows = [(5, same), (5, same), (3, same), (None, same), (None, "alone in here"), (9, None)]
    got = sorted(((r["doc_id"] or 0, r["class_id"], r["class_size"], r["kept"]) for r in neardup.near_duplicates(docs(*rows)).collect()), key=str)
    assert got == sorted([(5, 3, 4, False)] * 2 + [(3, 3, 4, True), (0, 3, 4, False), (0, None, 1, True), (9, 9, 1, True)], key=str)
    assert neardup.near_duplicates(docs((1, "a")).where("false")).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 60, 60).astype(np.uint64)
    for a, b in ((np.ones(60, int), np.where(np.arange(60) < 30, 1, 0)), (rng.integers(1, 9, 60), rng.integers(0, 9, 60)), (np.full(60, 40), np.full(60, 50))):
        owner = np.repeat([0, 1], 60)
        times = np.concatenate([a, b])
        keep = times > 0
        sig = neardup.signatures(owner[keep], np.concatenate([base, base])[keep], times[keep], 2, 4000)
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((sig[0] == sig[1]).mean() - want) < 0.03


# ---- pipeline

def test_pipeline_against_operators_by_brute_force(spark):
    raw = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, raw, SF)
    assert kept.columns == raw.columns
    verdict = {r["doc_id"] for r in queries()["op9_quality_rules"](spark, SF).where("kept").collect()}
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert set(rows) == verdict
    cut = {r["doc_id"]: r for r in corpus_pipeline.line_dedup(spark, kept, SF).collect()}
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(table)
    holders = {}
    for i, r in rows.items():
        for line in set(map(key, r["text"].split("\n"))):
            if len(line) >= 20:
                holders.setdefault(line, set()).add(i)
    for i, r in rows.items():
        lines = [x for x in r["text"].split("\n") if not (len(holders.get(key(x), ())) >= 3 and max(holders[key(x)]) != i)]
        assert cut[i]["text"] == "\n".join(lines) and cut[i]["n_chars"] == len(cut[i]["text"])
    texts = sorted((i, r["text"]) for i, r in cut.items())
    frame = spark.createDataFrame([(i, t, "x", "s", len(t)) for i, t in texts], raw.schema)
    one = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, frame, SF).collect()}
    sets = [neardup.elements(t, 5) for _, t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in neardup.linked(sets, 0.8):
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    same = {}
    for n, (_, t) in enumerate(texts):
        if t in same:
            low, high = sorted((find(same[t]), find(n)))
            parent[high] = low
        same.setdefault(t, n)
    assert one == {texts[find(n)][0] for n in range(len(texts))}


def test_pipeline_edges(spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    words = " ".join(f"word{i}" for i in range(60))
    rows = [(1, words, "en", "s", 1), (1, words, "en", "t", 1), (2, words + " more", "en", "s", 1), (3, bench, "en", "s", 1), (None, None, None, None, None), (4, "", "en", "s", 0)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame.where("false"), SF).count() == 0
    assert [r["doc_id"] for r in corpus_pipeline.quality_rules(spark, frame, SF).where("doc_id <> 3").collect()].count(4) == 0
    assert sorted((r["doc_id"] or 0) for r in corpus_pipeline.near_dedup(spark, frame, SF).collect()) == [1, 3, 4]
    assert sorted((r["doc_id"] or 0) for r in corpus_pipeline.decontaminate(spark, frame, SF).collect()) == [0, 1, 1, 2, 4]
    assert corpus_pipeline.packing(spark, frame, SF).agg(F.count_distinct("doc_id")).first()[0] == 4
