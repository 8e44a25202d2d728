"""Licence scan: votes of word k-grams for the diagonals of licence notices, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from framewright.llm.common import LOWER, UPPER, text_key, words_of, written

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Word k-grams of templates that are sent to every task; longer lists of templates are joined by a shuffle.
SENT = 100_000

#: Phrases that give a label wherever their words stand consecutively.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Published notices by label. Words marked with * must be found, or the notice does not count:
#: they tell it from notices of the same form.
TEMPLATES = {
    "agpl": ["licensed under the gnu *affero general public license"],
    "apache-2.0": [
        "licensed under the *apache license version *2.0",
        "you may not use this file except in compliance with the license",
        "distributed under the license is distributed on an as is basis without warranties or conditions of any kind "
        "either express or implied",
    ],
    "bsd": [
        "licensed under the *bsd license",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer",
    ],
    "cc-by": [
        "licensed under *cc *by 4.0",
        "this work is licensed under a creative commons *attribution 4.0 international license",
    ],
    "cc-by-nc": [
        "licensed under cc by *nc 4.0",
        "this work is licensed under a creative commons attribution *noncommercial 4.0 international license",
    ],
    "cc-by-nd": ["licensed under cc by *nd 4.0"],
    "cc-by-sa": [
        "licensed under cc by *sa 4.0",
        "this work is licensed under a creative commons attribution *sharealike 4.0 international license",
    ],
    "cc0": ["*cc0 1.0 universal public domain dedication"],
    "epl": ["made available under the terms of the *eclipse public license"],
    "gpl": [
        "licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
    ],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "lgpl": ["licensed under the gnu *lesser general public license"],
    "mit": [
        "released under the *mit license",
        "licensed under the *mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files",
        "the software is provided as is without warranty of any kind express or implied including but not limited to "
        "the warranties of merchantability fitness for a particular purpose and noninfringement",
    ],
    "mpl-2.0": ["this source code form is subject to the terms of the *mozilla public license"],
    "public-domain": ["this work is in the *public *domain", "released into the *public *domain"],
    "reserved": [
        "no part of this publication may be reproduced distributed or transmitted in any form or by any means",
    ],
    "unlicense": ["this is *free and *unencumbered *software released into the public domain"],
}


@dataclass(frozen=True)
class Template:
    """A notice: its label, its words and the positions of those that must be found."""

    label: str
    words: tuple[str, ...]
    marked: tuple[int, ...]


def parsed(templates: Mapping[str, Sequence[str]]) -> list[Template]:
    """Templates in the order given, their words cut like those of a text."""
    out = []
    for label, notices in templates.items():
        for notice in notices:
            words, marked = [], []
            for part in notice.split():
                own = [w.decode() for w in words_of(part)]
                if part.startswith("*"):
                    marked += range(len(words), len(words) + len(own))
                words += own
            out.append(Template(label, tuple(words), tuple(marked)))
    return out


def normal(text: str | Column) -> Column:
    """A text in lower case (A-Z only), its words separated by single spaces; NULL is empty."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    only_ascii = F.octet_length(text) == F.length(text)
    low = F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.btrim(F.regexp_replace(low, BREAKS, " "))


def template_grams(spark: SparkSession, templates: list[Template], k: int) -> DataFrame:
    """(h, t, at, gram): hash, template, position and words of every k-gram of the templates."""
    rows = [(n, i, list(t.words[i:i + k])) for n, t in enumerate(templates) for i in range(len(t.words) - k + 1)]
    grams = spark.createDataFrame(rows, "t int, at int, gram array<string>")
    grams = grams.select(F.xxhash64(*[F.get("gram", F.lit(i)) for i in range(k)]).alias("h"), "t", "at", "gram")
    return F.broadcast(grams) if len(rows) <= SENT else grams


def notice_spans(
    df: DataFrame, keys: Sequence[str], norm: str, templates: list[Template], k: int, share: float, drift: int
) -> DataFrame:
    """(keys, label, start, stop, share): places of ``df``'s texts (in the form of ``normal``) that hold a notice.

    Every rolling k-gram of a text is hashed and joined to the positions of the templates; a hit counts if the words
    agree as well. Hits are added up by diagonal (position in the text less position in the template). Diagonals
    at most ``drift`` apart are one place, so words put in or left out do not break a notice; longer chains are cut every
    2 · ``drift`` + 1 diagonals. A place holds the notice if the words under its hits are ``share`` or more of the template's
    and all marked ones. Only hits are shuffled, and no group is larger than one text and one template.
    """
    spark, keys = df.sparkSession, list(keys)
    words = df.select(*keys, F.split(norm, " ").alias("words"))
    gram = lambda w, i: F.xxhash64(w, *[F.get("words", i + j) for j in range(1, k)])
    # the outer form: Spark would compute the hashes once more to filter empty arrays
    rolled = words.select(*keys, "words", F.posexplode_outer(F.transform("words", gram)).alias("pos", "hash"))
    found = rolled.join(template_grams(spark, templates, k), F.col("hash") == F.col("h"))
    votes = found.where(F.slice("words", F.col("pos") + 1, F.lit(k)) == F.col("gram")).select(
        *keys, "t", "at", "pos", (F.col("pos") - F.col("at")).alias("diagonal")
    )
    lines = votes.groupBy(*keys, "t", "diagonal").agg(
        F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.collect_set("at").alias("at")
    )
    order = W.partitionBy(*keys, "t").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(order)
    lines = lines.withColumn("first", F.when(gap.isNull() | (gap > drift), F.col("diagonal")))
    lines = lines.withColumn("first", F.last("first", ignorenulls=True).over(order))
    part = F.floor((F.col("diagonal") - F.col("first")) / (2 * drift + 1))
    places = (
        lines.select(*keys, "t", "first", part.alias("part"), "lo", "hi", F.explode("at").alias("at"))
        .groupBy(*keys, "t", "first", "part")
        .agg(F.min("lo").alias("start"), (F.max("hi") + k).alias("stop"), F.collect_set("at").alias("at"))
    )
    covered = F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(a, a + (k - 1)))))
    known = spark.createDataFrame(
        [(n, t.label, len(t.words), list(t.marked)) for n, t in enumerate(templates)],
        "n int, label string, size int, marked array<int>",
    )
    places = places.withColumn("covered", covered).join(F.broadcast(known) if len(templates) <= SENT else known, F.col("t") == F.col("n"))
    held = (F.size("covered") >= share * F.col("size")) & (F.size(F.array_except("marked", "covered")) == 0)
    return places.where(held).select(
        *keys, "label", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"),
        (F.size("covered") / F.col("size")).alias("share"),
    )


def starting(phrase: str):
    """For each word and its position: the position, where the words of ``phrase`` start there."""
    parts = phrase.split(" ")

    def here(w: Column, i: Column) -> Column:
        same = w == parts[0]
        for j, p in enumerate(parts[1:], 1):
            same = same & (F.get("__fw_words", i + j) == p)
        return F.when(same, i)

    return here


def scan_licenses(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: Mapping[str, Sequence[str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES, k: int = 3, share: float = 0.7, drift: int = 3, prefix: str = "",
) -> DataFrame:
    """``df`` with the licences that its texts name.

    Adds n_words, n_base, first_word, last_word (long), base_labels and labels (sorted arrays), score (double) and spans
    (label, start, stop, share; words from 0, sorted). The base columns are the places of ``phrases``, exact; labels has theirs
    and those of the notices found by ``notice_spans``. The score is 1 where a phrase stands, else the largest
    share of a notice found, else 0.

    NULL or empty text: no words, no labels, score 0. Very long texts are read whole; a text never shares a group
    with another one. Repeated rows each get the same result, rows with a NULL id are scanned like others, an empty table
    gives no rows. Notices shorter than ``k`` words are never found. Other columns pass through; those that have a new
    name already are replaced, which ``prefix`` avoids. Names starting with ``__fw_`` are reserved.
    """
    key = text_key(F.coalesce(F.col(doc_id).cast("string"), F.lit("\0")), F.coalesce(text, F.lit("")))
    rows = df.select("*", key[0].alias("__fw_r1"), key[1].alias("__fw_r2"), normal(text).alias("__fw_norm"))
    keys = ["__fw_r1", "__fw_r2"]
    spans = notice_spans(rows, keys, "__fw_norm", parsed(templates), k, share, drift)
    found = spans.groupBy(*keys).agg(
        F.array_sort(F.collect_set(F.struct("label", "start", "stop", "share"))).alias("__fw_spans")
    ).withColumnsRenamed({"__fw_r1": "__fw_f1", "__fw_r2": "__fw_f2"})
    found = written(found, "licences")  # a table of its own: Spark can then split rows that repeat many times

    none = F.array().cast("array<int>")
    rows = rows.withColumn("__fw_words", F.when(F.col("__fw_norm") == "", F.array().cast("array<string>")).otherwise(F.split("__fw_norm", " ")))
    padded = F.concat(F.lit(" "), "__fw_norm", F.lit(" "))
    starts, named = [], []
    for phrase, label in phrases.items():
        has = F.contains(padded, F.lit(f" {phrase} "))  # most texts are not searched word by word
        starts.append(F.when(has, F.filter(F.transform("__fw_words", starting(phrase)), lambda i: i.isNotNull())).otherwise(none))
        named.append(F.when(has, F.lit(label)))
    rows = rows.withColumns({
        "__fw_n": F.size("__fw_words").cast("long"),
        "__fw_starts": F.concat(*starts),
        "__fw_base": F.array_sort(F.array_distinct(F.filter(F.array(*named), lambda x: x.isNotNull()))),
    }).drop("__fw_words", "__fw_norm")
    out = rows.join(found, (F.col("__fw_r1") == F.col("__fw_f1")) & (F.col("__fw_r2") == F.col("__fw_f2")), "left")
    spans = F.coalesce("__fw_spans", F.array().cast(found.schema["__fw_spans"].dataType))
    out = out.withColumn("__fw_spans", spans)
    made = {
        "n_words": F.col("__fw_n"),
        "n_base": F.size("__fw_starts").cast("long"),
        "first_word": F.array_min("__fw_starts").cast("long"),
        "last_word": F.array_max("__fw_starts").cast("long"),
        "base_labels": F.col("__fw_base"),
        "labels": F.array_sort(F.array_distinct(F.concat("__fw_base", F.transform("__fw_spans", lambda s: s["label"])))),
        "score": F.when(F.size("__fw_starts") > 0, F.lit(1.0)).otherwise(
            F.coalesce(F.array_max(F.transform("__fw_spans", lambda s: s["share"])), F.lit(0.0))
        ),
        "spans": F.col("__fw_spans"),
    }
    made = {prefix + name: value for name, value in made.items()}
    return out.select(*[F.col(c) for c in df.columns if c not in made], *[v.alias(name) for name, v in made.items()])
