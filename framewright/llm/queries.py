"""Registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, functions as F

from framewright.llm.chat import canonical_turns, format_turns, read_back
from framewright.llm.collocations import collocations
from framewright.llm.decontaminate import contaminated, find_benchmark
from framewright.llm.html import extract_text
from framewright.llm.licenses import PHRASES, TEMPLATES, parsed, scan_licenses
from framewright.llm.lines import drop_repeated_lines
from framewright.llm.neardup import near_duplicates
from framewright.llm.negatives import hard_negatives
from framewright.llm.packing import pack
from framewright.llm.quality import quality
from framewright.llm.tokens import count_tokens
from framewright.llm.toxicity import fit, held_out, score
from framewright.llm.warc import normalise, page_of, read_records, write_archives
from framewright.registry import Tables, query


@query("op1_line_dedup", """
    with d as (select doc_id, coalesce(text, '') as text from documents),
    l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from d),
    k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
    s as (select key, max(doc_id) as keeper from k where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
    m as (select k.*, s.key is not null and k.doc_id <> s.keeper as gone from k left join s on k.key = s.key)
    select doc_id, count(*) as n_lines, cast(sum(gone::int) as bigint) as n_dropped,
        sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
    from m group by doc_id""")
def op1_line_dedup(t: Tables) -> DataFrame:
    out = drop_repeated_lines(t("documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_token_counts")
def op3_token_counts(t: Tables) -> DataFrame:
    out = count_tokens(t("documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


#: Word windows by SQL: words of documents and items, windows of 13 words (or of a whole shorter item), equal keys.
_WORDS = r"""regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query("op6_decontaminate", f"""
    with b as (select cast(item_id as varchar) as item, {_WORDS.format("text")} as w from benchmark),
    bn as (select *, least(len(w), 13) as m from b where len(w) > 0),
    bw as (select distinct item, m, array_to_string(w[i:i + m - 1], ' ') as key
        from (select *, unnest(range(1, len(w) - m + 2)) as i from bn)),
    d as (select doc_id, {_WORDS.format("coalesce(text, '')")} as w from documents),
    dw as (select doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') as key
        from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i from d, (select distinct m from bn))),
    hit as (select doc_id, item, i, dw.m from dw join bw on dw.key = bw.key and dw.m = bw.m),
    words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + m)) as p from hit) group by doc_id),
    items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
        from (select distinct doc_id, item from hit) group by doc_id)
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
        sha256(coalesce(names, '')) as items_sha256,
        coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
    from d left join words using (doc_id) left join items using (doc_id)""")
def op6_decontaminate(t: Tables) -> DataFrame:
    out = find_benchmark(t("documents").select("doc_id", "text"), t("benchmark"))
    found = F.col("found")
    return out.select(
        "doc_id", found.n_words.alias("n_words"), found.n_hit.alias("n_hit"),
        F.size(found.getField("items")).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(found.getField("items"), ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


@query("op8_packing")
def op8_packing(t: Tables) -> DataFrame:
    return pack(
        t("documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, with_ids=False
    ).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op2_warc", """
    with d as (select page_id, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as g from pages),
    f as (select g, min(page_id) as k from d where n >= 100 group by g)
    select page_id, n as payload_bytes, d.g as payload_digest,
        case when page_id > k then 'revisit' else 'response' end as record_type,
        case when page_id > k then k end as refers_to
    from d left join f on d.g = f.g and d.n >= 100""")
def op2_warc(t: Tables) -> DataFrame:
    files = write_archives(t("pages"))
    out = read_records(normalise(files), with_payload=False)
    return out.select(
        page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_of("refers_to").alias("refers_to"),
    )


_ESCAPE = (
    r"(<|\[)(\\*)(\|im_start\|>|\|im_end\|>|\|startoftext\|>|\|endoftext\|>|s>|/s>|unk>|pad>|INST\]|/INST\]|<SYS>>|</SYS>>)"
)


@query("op7_chat_format", f"""
    with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all select -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
    e as (select *, regexp_replace(text, '{_ESCAPE}', '\\1\\\\\\2\\3', 'g') as said from c)
    select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
        cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
        sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
        cast(sum(length('<|im_start|>') + length(role) + 1 + length(said) + length('<|im_end|>') + 1) as bigint) as formatted_chars
    from e group by conv_id""")
def op7_chat_format(t: Tables) -> DataFrame:
    rows = t("conversations").select("conv_id", "turn", "role", "text")
    added = rows.sparkSession.createDataFrame(
        [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
        "conv_id bigint, turn bigint, role string, text string",
    )
    records = rows.unionByName(added).select(
        "conv_id", F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"}).alias("record")
    )
    out = read_back(format_turns(canonical_turns(records, "record", "conv_id")))
    return out.select(F.col("id").cast("bigint").alias("conv_id"), *[c for c in out.columns if c != "id"])


@query("op9_quality_rules")
def op9_quality_rules(t: Tables) -> DataFrame:
    out = quality(t("documents").select("doc_id", "text"), t("labels").where("quality = 1"), whole=True)
    return out.drop("text")


@query("op5_toxicity")
def op5_toxicity(t: Tables) -> DataFrame:
    docs = t("documents").select("doc_id", "text")
    model = fit(docs, t("labels").where(~held_out()))
    out = score(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op4_html_text")
def op4_html_text(t: Tables) -> DataFrame:
    return extract_text(t("pages"))


@query("op10_minhash_near_dedup")
def op10_minhash_near_dedup(t: Tables) -> DataFrame:
    return near_duplicates(t("documents").select("doc_id", "text")).select("doc_id", "class_id", "class_size", "kept")


def _listed(values) -> str:
    return "[" + ", ".join(repr(v) for v in values) + "]"


#: The notices and phrases as SQL values.
_NOTICES = ", ".join(
    f"({n}, '{x.label}', {_listed(x.words)}, {_listed(x.marked)}::int[])" for n, x in enumerate(parsed(TEMPLATES))
)
_PHRASES = ", ".join(f"('{label}', {_listed(phrase.split())})" for phrase, label in PHRASES.items())


@query("op13_license_scan", f"""
    with d as (select doc_id, {_WORDS.format("coalesce(text, '')")} as w from documents),
    phrases as (select * from (values {_PHRASES}) as v(label, p)),
    notices as (select * from (values {_NOTICES}) as v(t, label, n, m)),
    starts as (select doc_id, label, i - 1 as i from phrases, (select doc_id, w, unnest(range(1, len(w) + 1)) as i from d)
        where w[i:i + len(p) - 1] = p),
    base as (select doc_id, count(*) as n_base, min(i) as first_word, max(i) as last_word,
        string_agg(distinct label, ',' order by label) as base_labels from starts group by doc_id),
    tg as (select t, a as spot, n[a + 1:a + 3] as g from (select *, unnest(range(0, len(n) - 2)) as a from notices)),
    dg as (select doc_id, i as pos, w[i + 1:i + 3] as g from (select *, unnest(range(0, len(w) - 2)) as i from d)),
    votes as (select doc_id, t, spot, pos, pos - spot as diagonal from dg join tg using (g)),
    lines as (select doc_id, t, diagonal, diagonal - lag(diagonal) over (partition by doc_id, t order by diagonal) as gap
        from (select distinct doc_id, t, diagonal from votes)),
    chains as (select doc_id, t, diagonal, max(case when gap is null or gap > 3 then diagonal end)
        over (partition by doc_id, t order by diagonal) as first from lines),
    covered as (select distinct doc_id, t, first, (diagonal - first) // 7 as part, spot + j as spot
        from votes join chains using (doc_id, t, diagonal), (select unnest(range(0, 3)) as j)),
    places as (select doc_id, label, count(*) / len(n) as share from covered join notices using (t)
        group by doc_id, t, first, part, label, n, m
        having count(*) >= 0.7 * len(n) and count(*) filter (list_contains(m, spot)) = len(m)),
    named as (select doc_id, label from starts union select doc_id, label from places),
    labels as (select doc_id, string_agg(label, ',' order by label) as labels from named group by doc_id),
    best as (select doc_id, max(share) as share from places group by doc_id)
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_base, 0) as n_base,
        cast(first_word as double) as first_word, cast(last_word as double) as last_word,  -- a column with NULLs, as a data frame has it
        coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
        case when n_base > 0 then 1.0 else coalesce(share, 0.0) end::double as score
    from d left join base using (doc_id) left join labels using (doc_id) left join best using (doc_id)""")
def op13_license_scan(t: Tables) -> DataFrame:
    out = scan_licenses(t("documents").select("doc_id", "text"))
    joined = {c: F.array_join(c, ",") for c in ("base_labels", "labels")}
    return out.withColumns(joined).drop("text", "spans")


@query("op12_collocations", r"""
    with d as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
    p as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as piece from d),
    w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
    g as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
        from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from w, (select unnest([1, 2, 3, 4]) as k))),
    f as (select lang, k, phrase, count(*) as n from g group by all having count(*) >= 30),
    cuts as (select c.lang, c.phrase, c.n as a, j, l.n as l, r.n as r, (2000000::hugeint * c.n) // (l.n + r.n) as score
        from (select *, string_split(phrase, ' ') as ws, unnest(range(1, k)) as j from f where k > 1) c
        join f l on l.lang = c.lang and l.phrase = array_to_string(c.ws[1:j], ' ')
        join f r on r.lang = c.lang and r.phrase = array_to_string(c.ws[j + 1:], ' ')),
    low as (select lang, phrase, a, l, r, cast(score as bigint) as score from cuts
        qualify row_number() over (partition by lang, phrase order by score, j) = 1),
    inner_parts as (select lang, n, array_to_string(ws[i:i + s - 1], ' ') as phrase
        from (select lang, n, ws, s, unnest(range(1, k - s + 2)) as i from (select *, string_split(phrase, ' ') as ws, unnest(range(2, k)) as s from f where k > 2))),
    longer as (select lang, phrase, max(n) as most from inner_parts group by lang, phrase),
    kept as (select low.* from low left join longer using (lang, phrase) where most is null or 100 * most < 80 * a),
    n as (select lang, sum(len(w))::bigint as n from w group by lang)
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
    from kept join n using (lang) qualify rank <= 2000""")
def op12_collocations(t: Tables) -> DataFrame:
    return collocations(t("documents").select("doc_id", "lang", "text"))


@query("op11_hard_negatives", """
    with e as (select vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label,
            list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
        from embeddings where label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    pairs as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_inner_product(a.v, b.v) as bigint) as score
        from e a join e b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
    positive as (select anchor_id, vec_id as positive_id, score as positive_score from pairs where same
        qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
    negative as (select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as rank,
            vec_id as negative_id, positive_score, score as negative_score
        from positive p join pairs n on n.anchor_id = p.anchor_id and not n.same
            and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
    select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from negative where rank <= 10""")
def op11_hard_negatives(t: Tables) -> DataFrame:
    rows = t("embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label))
