"""Chat formatting: records of different layouts to canonical turns, to one template and back."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain, combinations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Strings that chat templates give a meaning to.
CONTROL = [
    "<|im_start|>", "<|im_end|>", "<|startoftext|>", "<|endoftext|>", "<s>", "</s>", "<unk>", "<pad>",
    "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
]
START, END = "<|im_start|>", "<|im_end|>\n"
_RESTS = "|".join(re.escape(c[1:]) for c in CONTROL)
_PLAIN = re.compile(rf"(<|\[)(\\*)({_RESTS})")
_ESCAPED = re.compile(rf"(<|\[)\\(\\*)({_RESTS})")

#: Roles by the names that layouts give them; other names stay as they are.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
#: Declarative mappings. paths: fields that must be there, optional: fields that may be. turns: in order, each a
#: (role, field), or for lists of messages (list, role field, text field). seq: the turn's number, for one message a record.
LAYOUTS = {
    "message row": {"paths": ["turn", "role", "text"], "seq": "turn", "turns": [("", "role", "text")]},
    "messages": {"paths": ["messages[].role", "messages[].content"], "optional": ["id"], "turns": [("messages", "role", "content")]},
    "conversations": {"paths": ["conversations[].from", "conversations[].value"], "optional": ["id", "system"],
                      "turns": [("system", "system"), ("conversations", "from", "value")]},
    "prompt": {"paths": ["prompt", "completion"], "optional": ["id", "system"],
               "turns": [("system", "system"), ("user", "prompt"), ("assistant", "completion")]},
    "prompt response": {"paths": ["prompt", "response"], "optional": ["id", "system"],
                        "turns": [("system", "system"), ("user", "prompt"), ("assistant", "response")]},
    "question": {"paths": ["question", "answer"], "optional": ["id", "context"],
                 "turns": [("system", "context"), ("user", "question"), ("assistant", "answer")]},
    "instruction": {"paths": ["instruction", "output"], "optional": ["id", "input", "system"],
                    "turns": [("system", "system"), ("user", "instruction"), ("user+", "input"), ("assistant", "output")]},
}
CANONICAL = pa.schema([("id", pa.string()), ("seq", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("layout", pa.string())])
SEGMENTS = pa.schema([
    ("id", pa.string()), ("n", pa.int64()), ("formatted", pa.string()), ("start", pa.int64()),
    ("loss_start", pa.int64()), ("loss_stop", pa.int64()),
])


def escape(text: str) -> str:
    """A backslash goes behind the first character of every control string, before any that are there."""
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def field_paths(value, at: str = "") -> set[str]:
    """Paths of the fields of a nested value; list elements are ``[]``."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union({f"{at}[]"} if not value else set(), *(field_paths(v, f"{at}[]") for v in value))
    return {at}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def fingerprints(layouts: dict) -> dict[str, str]:
    """Layout by the fingerprint of each set of fields that it allows."""
    out = {}
    for name, layout in layouts.items():
        extra = layout.get("optional", [])
        for more in chain.from_iterable(combinations(extra, k) for k in range(len(extra) + 1)):
            out.setdefault(fingerprint([*layout["paths"], *more]), name)
        for step in layout["turns"]:
            if len(step) == 3 and step[0]:  # a list without messages shows no fields
                others = [p for p in layout["paths"] if not p.startswith(f"{step[0]}[]")]
                for more in chain.from_iterable(combinations(extra, k) for k in range(len(extra) + 1)):
                    out.setdefault(fingerprint([*others, f"{step[0]}[]", *more]), name)
    return out


def _string(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_by(layout: dict, record: dict) -> list[tuple[str, str]]:
    """(role, text) of a record by a declarative mapping."""
    out: list[tuple[str, str]] = []
    for step in layout["turns"]:
        if len(step) == 3:
            for m in record[step[0]] if step[0] else [record]:
                role = _string(m.get(step[1]))
                out.append((ROLES.get(role, role), _string(m.get(step[2]))))
        elif step[1] in record and (step[0] in ("user", "assistant") or record[step[1]]):
            if step[0] == "user+":
                out[-1] = (out[-1][0], f"{out[-1][1]}\n{_string(record[step[1]])}")
            else:
                out.append((step[0], _string(record[step[1]])))
    return out


def canonical_turns(df: DataFrame, record: str, record_id: str, layouts: dict | None = None) -> DataFrame:
    """(id, seq, role, text, layout): the turns of JSON records, each by the mapping its schema selects.

    A record's schema fingerprint, a hash of its nested field paths, is looked up among those of ``layouts``.
    Ids are strings. A record that is no JSON object, or whose fields no layout has, gives one row with NULL role,
    text and layout, so nothing is lost unseen. NULL texts and roles are empty. A list without messages gives no
    turn. Repeated records are repeated. An empty table gives no rows. Other columns are not looked at.
    """
    layouts = layouts or LAYOUTS
    known = fingerprints(layouts)

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, raw in zip(batch.column("id").to_pylist(), batch.column("record").to_pylist()):
                try:
                    value = json.loads(raw or "null")
                except ValueError:
                    value = None
                layout = known.get(fingerprint(field_paths(value))) if isinstance(value, dict) else None
                if layout is None:
                    rows.append((name, 0, None, None, None))
                    continue
                seq = layouts[layout].get("seq")
                for i, (role, text) in enumerate(turns_by(layouts[layout], value)):
                    rows.append((name, value[seq] if seq else i, role, text, layout))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(CANONICAL)], schema=CANONICAL
            )

    picked = df.select(F.col(record_id).cast("string").alias("id"), F.col(record).alias("record"))
    return picked.mapInArrow(turns, "id string, seq bigint, role string, text string, layout string")


def in_order(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows of a key in one partition, in order; a stream can then pass over them without holding a key."""
    return df.repartition(F.col(key)).sortWithinPartitions(key, *order)


def segment(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its text starts and stops there."""
    named = escape(role.replace("\\", "\\\\").replace("\n", "\\n"))
    head, body = f"{START}{named}\n", escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation, or of a part made of whole turns."""
    out = []
    for part in formatted.split(START)[1:]:
        if not part.endswith(END):
            raise ValueError("a turn without its end")
        named, _, body = part[:-len(END)].partition("\n")
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(named))
        out.append((role, unescape(body)))
    return out


def format_turns(turns: DataFrame, train_on: str = "assistant") -> DataFrame:
    """(id, n, formatted, start, loss_start, loss_stop): a row for each turn, in order.

    The segments of a conversation, one after the other, are its formatted text; ``start`` and the loss span
    (of the texts of role ``train_on``, else NULL) are offsets in that text, in code points. Turns are ordered by (seq,
    role, text). A conversation is streamed turn by turn, so a very long one needs no more memory.
    NULL role or text: empty. Turns with a NULL id are one conversation. An empty table gives no rows.
    """
    ordered = in_order(
        turns.select("id", "seq", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")),
        "id", "seq", "role", "text",
    )

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, n, at = object(), 0, 0
        for batch in batches:
            rows = []
            for name, role, text in zip(*(batch.column(c).to_pylist() for c in ("id", "role", "text"))):
                if name != here:
                    here, n, at = name, 0, 0
                out, start, stop = segment(role, text)
                loss = (at + start, at + stop) if role == train_on else (None, None)
                rows.append((name, n, out, at, *loss))
                n, at = n + 1, at + len(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SEGMENTS)], schema=SEGMENTS
            )

    return ordered.mapInArrow(
        formatted, "id string, n bigint, formatted string, start bigint, loss_start bigint, loss_stop bigint"
    )


DIGESTS = pa.schema([
    ("id", pa.string()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of each conversation, from its formatted text and loss mask alone: (id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars). Streamed like ``format_turns``."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state = object(), None
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("id", "formatted", "start", "loss_start", "loss_stop"))
            for name, text, start, loss_start, loss_stop in zip(*columns):
                if state is None or name != here:
                    if state:
                        rows.append(closed(here, state))
                    here, state = name, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                if loss_start is not None:
                    learnt = unescape(text[loss_start - start:loss_stop - start])
                    state[2] += len(learnt)
                    state[3].update(learnt.encode())
                state[4] += len(text)
            yield pa.RecordBatch.from_pylist(rows, DIGESTS)
        if state:
            yield pa.RecordBatch.from_pylist([closed(here, state)], DIGESTS)

    def closed(name, s) -> dict:
        return dict(zip(DIGESTS.names, (name, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4])))

    return in_order(segments, "id", "n").mapInArrow(
        digests, "id string, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
