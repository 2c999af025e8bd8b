"""Preference formatting of chosen and rejected conversations.

A pair of conversations is split at its longest common prefix of turns (equal
role and text, in order).  The prefix is rendered once as the prompt, what
follows in each conversation is its completion, and a mask says which code
points of a completion are trained on: the content and end mark of assistant
turns.  The mask is a run-length list "flag:code points" in order.

Two kinds of pairs are made from a table of conversations.  ``opening``:
conversations that open with the same turn answer the same prompt; in each
such group the one with the most assistant text (the smallest conv_id on ties)
is chosen, and every other one is rejected against it.  That is one pair less
than the group has conversations, and the choice is an aggregate that combines
map-side, so a very common opening costs no more than its rows.  ``stale``: a
conversation up to its last assistant turn is chosen, and rejected is the same
with that turn's text replaced by the assistant's text before it (the user's,
if there is none; else the empty text), a reply that repeats instead of
answering.  That is one pair for each conversation with an assistant turn.

Defined results: rows without conv_id belong to no conversation; turns order
by turn, role and text (null first), repeated rows are turns of their own; a
null role renders as "none" and a null text as empty, and both equal only
themselves; if one conversation continues the other, the shorter one's
completion is empty; an empty table gives no pairs.  Extra columns of the
input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table

TRAINED = "assistant"
END = "<|end|>\n"


def _header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("none")), F.lit("|>\n"))


def _content(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(END))


def render(turns: Column) -> Column:
    return F.concat_ws("", F.transform(turns, lambda t: F.concat(_header(t), _content(t))))


def mask(turns: Column) -> Column:
    def runs(t: Column) -> Column:
        head, body = F.char_length(_header(t)).cast("string"), F.char_length(_content(t)).cast("string")
        whole = F.char_length(F.concat(_header(t), _content(t))).cast("string")
        return F.when(t["role"] == TRAINED, F.concat(F.lit("0:"), head, F.lit(",1:"), body)).otherwise(F.concat(F.lit("0:"), whole))

    return F.concat_ws(",", F.transform(turns, runs))


def common_turns(a: Column, b: Column) -> Column:
    """Number of turns that two lists of turns have in common from the start."""
    shorter = F.least(F.size(a), F.size(b))
    same = F.transform(F.slice(a, 1, shorter), lambda t, i: t["role"].eqNullSafe(F.get(b, i)["role"]) & t["text"].eqNullSafe(F.get(b, i)["text"]))
    differs = F.array_position(same, False)
    return F.when(differs > 0, differs - 1).otherwise(shorter).cast("int")


def conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation (conv_id, turns) of (conv_id, turn, role, text)."""
    listed = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return turns.where("conv_id is not null").groupBy("conv_id").agg(listed.alias("turns"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Prompt and masked completions of (chosen, rejected: lists of turns); other columns stay."""
    n = F.col("_prompt_turns")
    rest = lambda c: F.slice(F.col(c), n + 1, F.greatest(F.size(c) - n, F.lit(0)))
    cut = pairs.withColumn("_prompt_turns", common_turns(F.col("chosen"), F.col("rejected")))
    others = [c for c in pairs.columns if c not in ("chosen", "rejected")]
    return cut.select(
        *others,
        n.alias("n_prompt_turns"),
        render(F.slice("chosen", 1, n)).alias("prompt"),
        render(rest("chosen")).alias("chosen"),
        mask(rest("chosen")).alias("chosen_mask"),
        render(rest("rejected")).alias("rejected"),
        mask(rest("rejected")).alias("rejected_mask"),
    )


def preference_pairs(turns: DataFrame) -> DataFrame:
    """(kind, chosen_id, rejected_id, chosen, rejected) of the pairs of a table of conversations."""
    scratch = Scratch(turns.sparkSession, "preference")
    weight = F.aggregate(
        F.filter("turns", lambda t: t["role"] == TRAINED), F.lit(0).cast("long"), lambda n, t: n + F.coalesce(F.char_length(t["text"]), F.lit(0))
    )
    first = F.col("turns")[0]
    # null and empty must differ, so nulls are hashed as flags
    opening = [F.xxhash64(F.lit(salt), first["role"].isNull(), first["role"], first["text"].isNull(), first["text"]) for salt in (1, 2)]
    convs = scratch.cut(conversations(turns).select("conv_id", "turns", opening[0].alias("o1"), opening[1].alias("o2"), weight.alias("weight")))
    best = convs.groupBy("o1", "o2").agg(F.max(F.struct("weight", (-F.col("conv_id")).alias("minus"))).alias("top"))
    best = best.select("o1", "o2", (-F.col("top.minus")).alias("chosen_id"))
    rejected = convs.join(best, ["o1", "o2"]).where("conv_id <> chosen_id").select("chosen_id", F.col("conv_id").alias("rejected_id"), F.col("turns").alias("rejected"))
    chosen = convs.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen"))
    opening = rejected.join(chosen, "chosen_id").select(F.lit("opening").alias("kind"), "chosen_id", "rejected_id", "chosen", "rejected")
    return opening.union(stale_pairs(convs))


def stale_pairs(convs: DataFrame) -> DataFrame:
    """Pairs of conversations (conv_id, turns) with themselves, ending in a stale reply."""
    last = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == TRAINED, i + 1)))
    before = F.slice("turns", 1, F.col("last") - 1)
    said = lambda role: F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.transform(F.filter(before, lambda t: t["role"] == role), lambda t: F.coalesce(t["text"], F.lit("")))), -1)
    reply = F.element_at("turns", F.col("last"))
    stale = F.struct(reply["turn"].alias("turn"), reply["role"].alias("role"), F.coalesce(said(TRAINED), said("user"), F.lit("")).alias("text"))
    pairs = convs.select("conv_id", "turns", last.alias("last")).where("last is not null")
    return pairs.select(F.lit("stale").alias("kind"), F.col("conv_id").alias("chosen_id"), F.col("conv_id").alias("rejected_id"), F.slice("turns", 1, F.col("last")).alias("chosen"), F.concat(before, F.array(stale)).alias("rejected"))


def op5_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of all conversations, as prompt and masked completions."""
    return format_pairs(preference_pairs(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))


OP5_SQL = """
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, sum(CASE WHEN role = 'assistant' THEN length(coalesce(text, '')) ELSE 0 END) AS weight,
         max(i) FILTER (role = 'assistant') AS last FROM t GROUP BY conv_id
), o AS (SELECT c.*, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i = 1
), g AS (SELECT *, first_value(conv_id) OVER (PARTITION BY role, text ORDER BY weight DESC, conv_id) AS chosen_id FROM o
), alt AS (
  SELECT c.conv_id, coalesce(arg_max(coalesce(t.text, ''), t.i) FILTER (t.role = 'assistant'), arg_max(coalesce(t.text, ''), t.i) FILTER (t.role = 'user'), '') AS stale
  FROM c LEFT JOIN t ON t.conv_id = c.conv_id AND t.i < c.last WHERE c.last IS NOT NULL GROUP BY c.conv_id
), u AS (
  SELECT 'opening' AS kind, g.chosen_id, g.conv_id AS rejected_id, TRUE AS is_chosen, t.i, t.role, t.text FROM g JOIN t ON t.conv_id = g.chosen_id WHERE g.conv_id <> g.chosen_id
  UNION ALL
  SELECT 'opening', g.chosen_id, g.conv_id, FALSE, t.i, t.role, t.text FROM g JOIN t ON t.conv_id = g.conv_id WHERE g.conv_id <> g.chosen_id
  UNION ALL
  SELECT 'stale', conv_id, conv_id, TRUE, i, role, text FROM c JOIN t USING (conv_id) WHERE i <= last
  UNION ALL
  SELECT 'stale', conv_id, conv_id, FALSE, i, role, CASE WHEN i = last THEN stale ELSE text END FROM c JOIN t USING (conv_id) JOIN alt USING (conv_id) WHERE i <= last
), s AS (
  SELECT kind, chosen_id, rejected_id, least(count(*) FILTER (is_chosen), count(*) FILTER (NOT is_chosen)) AS shorter FROM u GROUP BY 1, 2, 3
), d AS (
  SELECT a.kind, a.chosen_id, a.rejected_id, min(a.i) - 1 AS differs
  FROM u a JOIN u b ON a.kind = b.kind AND a.chosen_id = b.chosen_id AND a.rejected_id = b.rejected_id AND a.i = b.i AND a.is_chosen AND NOT b.is_chosen
  WHERE a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text GROUP BY 1, 2, 3
), k AS (SELECT s.*, coalesce(d.differs, s.shorter)::INT AS k FROM s LEFT JOIN d USING (kind, chosen_id, rejected_id)
), w AS (
  SELECT u.*, k.k, '<|' || coalesce(role, 'none') || '|>' || chr(10) AS head, coalesce(text, '') || '<|end|>' || chr(10) AS body FROM u JOIN k USING (kind, chosen_id, rejected_id)
), r AS (
  SELECT kind, chosen_id, rejected_id, k, is_chosen,
         coalesce(string_agg(head || body, '' ORDER BY i) FILTER (i <= k), '') AS prompt,
         coalesce(string_agg(head || body, '' ORDER BY i) FILTER (i > k), '') AS rest,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN '0:' || length(head) || ',1:' || length(body) ELSE '0:' || length(head || body) END, ',' ORDER BY i) FILTER (i > k), '') AS mask
  FROM w GROUP BY 1, 2, 3, 4, 5
)
SELECT x.kind, x.chosen_id, x.rejected_id, x.k AS n_prompt_turns, x.prompt, x.rest AS chosen, x.mask AS chosen_mask, y.rest AS rejected, y.mask AS rejected_mask
FROM r x JOIN r y ON x.kind = y.kind AND x.chosen_id = y.chosen_id AND x.rejected_id = y.rejected_id AND x.is_chosen AND NOT y.is_chosen
"""
