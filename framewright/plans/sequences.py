"""Vocabulary, encoding, windows and shards of the conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from framewright.operators import sequences as ops
from framewright.registry import Tables, query
from framewright.session import new_path

TOKENS = "list_filter(string_split(lower(coalesce(text, '')), ' '), lambda x: x <> '')"
VOCAB = f"""v as (select token, n, row_number() over (order by n desc, token) as id
  from (select token, count(*) as n from (select unnest({TOKENS}) as token from conversations) group by token having count(*) >= 2))"""
ENCODED = f"""{VOCAB}, t as (select conv_id, turn, unnest({TOKENS}) as token, generate_subscripts({TOKENS}, 1) as pos from conversations),
e as (select conv_id, turn, list(coalesce(id, 0) order by pos) as ids from t left join v using (token) group by conv_id, turn)"""


def vocab(t: Tables) -> DataFrame:
    return ops.build_vocab(t("conversations"), "text", min_count=2)


@query("build_vocab", f"with {VOCAB} select * from v")
def build_vocab(t: Tables) -> DataFrame:
    return vocab(t)


@query("encode_tokens", f"""with {ENCODED}
select c.conv_id, c.turn, coalesce(array_to_string(ids, ' '), '') as ids from conversations c left join e on c.conv_id = e.conv_id and c.turn = e.turn""")
def encode_tokens(t: Tables) -> DataFrame:
    out = ops.encode_tokens(t("conversations"), vocab(t), "text", ["conv_id", "turn"])
    return out.withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), " "))


@query("sequence_windows", f"""with {ENCODED},
w as (select conv_id, turn, ids, unnest(range(0, greatest(cast(ceil((len(ids) - 16) / 8.0) as int), 0) + 1)) * 8 as start from e)
select conv_id, turn, cast(start as int) as start, array_to_string(ids[start + 1:start + 16], ' ') as window from w""")
def sequence_windows(t: Tables) -> DataFrame:
    rows = ops.encode_tokens(t("conversations"), vocab(t), "text", ["conv_id", "turn"])
    out = ops.sequence_windows(rows, "ids", 16, 8)
    return out.withColumn("window", F.array_join(F.col("window").cast("array<string>"), " "))


@query("write_shards", "select conv_id, turn, role, text, true as in_range from conversations")
def write_shards(t: Tables) -> DataFrame:
    out = ops.write_shards(t("conversations"), new_path(t.spark, "shards"), 8)
    return out.withColumn("in_range", F.col("shard").between(0, 7)).drop("shard")
