"""Token counts and token ids with public tokenizers."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

#: Pieces remembered per Python worker (twice as many, in two generations) and the longest worth it. They bound memory only.
REMEMBERED, LONGEST = 400_000, 64
#: Texts are encoded in batches of about so many characters.
BATCH_CHARS = 1_000_000
#: Where a byte-level tokenizer's words may be cut apart: before a space or line feed that stands alone.
LONE_SPACE = re.compile(r"(?<=\S)(?=[ \n]\S)")
TWO_SPACES = re.compile(r"\s\s")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a ``.json`` file, loaded once per process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def pieces_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def safe_pieces(text: str) -> list[str]:
    """``text`` cut before every space or line feed with no white space beside it.

    The words of a byte-level tokenizer take at most the one space before them, so it counts
    the pieces of such a cut as it counts the whole text. Runs of white space stay in one piece.
    """
    if "\0" not in text and not TWO_SPACES.search(text):
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
    return LONE_SPACE.split(text)


def balanced(texts: list[str], most: int = BATCH_CHARS) -> Iterator[list[str]]:
    """Runs of texts with about ``most`` characters each, one text at least."""
    run: list[str] = []
    size = 0
    for text in texts:
        if run and size + len(text) > most:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


class Recent(dict):
    """Results by key, made when first asked for. Of two generations the older one goes when the newer is
    full, so what is met again and again stays known."""

    def __init__(self, make, most: int = REMEMBERED):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def put(self, key, value) -> None:
        if len(key) <= LONGEST:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value


#: Letters from A to U+024F; in this range, libraries agree on what is a letter, on lower case and on composition.
LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
LATIN = re.compile(rf"[ \n]?[!-~{LETTER}]+")
#: Words as the pre-tokenizers of the two kinds of files cut them, for texts in that range.
BYTE_WORDS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTER}]+| ?[0-9]+| ?[^\s{LETTER}0-9]+|\s")
LOWER_WORDS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{LETTER}]+|[0-9]|[^\s{LETTER}0-9]+")
LATIN_TEXT = re.compile(rf"[ \n\r\t!-~{LETTER}]*")


@lru_cache(maxsize=4)
def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def word_model(path: str):
    """(ids of a word, pattern of words, whether to lower) if the file's rules are those that ``BYTE_WORDS`` or
    ``LOWER_WORDS`` follow, else None. Whole encodings cost several times more than the ids alone."""
    tok = tokenizer(path)
    rules = json.loads(tok.to_str())
    steps = [s["type"] for s in (rules["normalizer"] or {}).get("normalizers", [rules["normalizer"] or {"type": ""}])]
    cuts = rules["pre_tokenizer"] or {}
    model, letters = tok.model, byte_letters()
    if rules["model"].get("type", "BPE") != "BPE" or rules["model"].get("dropout") or rules["post_processor"]:
        return None

    def ids(word: str) -> list[int]:
        return [t.id for t in model.tokenize(word.encode().decode("latin-1").translate(letters))]

    if steps == [""] and cuts.get("type") == "ByteLevel" and cuts["use_regex"] and not cuts["add_prefix_space"]:
        return ids, BYTE_WORDS, False
    split = [c.get("pattern", {}).get("Regex") or c["type"] for c in cuts.get("pretokenizers", [])]
    if steps == ["NFC", "Replace", "Lowercase"] and split == [
        r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+", "ByteLevel"
    ]:
        return ids, LOWER_WORDS, True
    return None


def encoder(path: str, whole, one, join):
    """A function from pieces to results: ``join`` of ``one`` for the ids of each word of a Latin piece, ``whole`` of a batch of others."""
    found = word_model(path)
    if found is None:
        return whole
    ids, pattern, lower = found
    words = Recent(lambda w: one(ids(w)))

    def text(whole_text: str):
        """The result of a whole Latin text whose white space counts for nothing, else None."""
        low = whole_text.lower()
        if lower and LATIN_TEXT.fullmatch(low) and "<|" not in low:
            return join(map(words.__getitem__, pattern.findall(low)))
        return None

    def encode(pieces: list[str]) -> list:
        out, others = {}, []
        for piece in pieces:
            text = piece.lower() if lower else piece
            if LATIN.fullmatch(text) and "<|" not in text:
                out[piece] = join(map(words.__getitem__, pattern.findall(text)))
            else:
                others.append(piece)
        for run in balanced(others):
            out.update(zip(run, whole(run)))
        return [out[p] for p in pieces]

    encode.text = text
    return encode


def results(known: Recent, cut: list[list[str]]) -> Iterator[map]:
    """Results of the pieces of each text. What is new is computed first, in one go."""
    new = [p for p in dict.fromkeys(chain.from_iterable(cut)) if p not in known and p not in known.old and len(p) <= LONGEST]
    for piece, result in zip(new, known.encode(new)):
        known.put(piece, result)
    return (map(known.__getitem__, pieces) for pieces in cut)


def remembered(path: str, whole, one, join) -> Recent:
    encode = encoder(path, whole, one, join)
    known = Recent(lambda piece: encode([piece])[0])
    known.encode = encode
    return known


@lru_cache(maxsize=4)
def piece_counts(path: str) -> Recent:
    tok = tokenizer(path)
    return remembered(
        path, lambda run: [len(e) for e in tok.encode_batch_fast(run, add_special_tokens=False)],
        len, sum,
    )


def count_texts(path: str, texts: list[str]) -> list[int]:
    """Tokens of each text as the library counts them, without special tokens at its ends."""
    if path.endswith(".model"):
        model = pieces_model(path)
        return [len(ids) for run in balanced(texts) for ids in model.encode(run, num_threads=1)]
    known, out = piece_counts(path), []
    for run in balanced(texts):
        out += map(sum, results(known, [safe_pieces(t) for t in run]))
    return out


def count_tokens(
    df: DataFrame, path: str, text: str = "text", limit: int = 1024, prefix: str = ""
) -> DataFrame:
    """``df`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``path`` names a tokenizer file: ``.json`` for tokenizers (byte-level: texts are cut at safe
    boundaries, see ``safe_pieces``, and each new piece is encoded once, in batches balanced by size),
    ``.model`` for sentencepiece (whole texts). The texts go to Arrow functions, only lengths
    come back; no text is cut off and rows are not shuffled.

    NULL or empty text: 0 bytes, 0 tokens. Special strings inside a text count as the library
    counts them by default. An empty table gives no rows. Columns that already have one of the new names are replaced;
    ``prefix`` avoids that.
    """

    @arrow_udf("bigint")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(count_texts(path, pc.fill_null(batch, "").to_pylist()), pa.int64())

    out = df.withColumn(f"{prefix}n_bytes", F.octet_length(F.coalesce(text, F.lit(""))).cast("long"))
    out = out.withColumn(f"{prefix}n_tokens", tokens(F.coalesce(text, F.lit(""))))
    return out.withColumn(f"{prefix}over_limit", F.col(f"{prefix}n_tokens") > limit)
