"""Chat formatting of preference pairs, native.

The longest common prefix of turns (role and text) of a chosen and a rejected conversation is rendered once as the prompt;
what remains of each is a completion, with the character spans that count in the loss: what the assistant says, with its
end mark. Headers and other roles' turns are masked.

Nulls and edge cases: a null role is `user`, a null text is empty. `<|` and `|>` inside a role, and `<|` inside a text, are
written `< |` and `| >`, so neither can forge a mark. Turns of the same number are ordered by role and text. A pair without one side, or with equal sides, has empty
completions where nothing remains. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm.common import table

TURNS = "array<struct<turn: bigint, role: string, text: string, at: bigint>>"


def _head(t: Column) -> Column:
    return F.concat(F.lit("<|"), t["role"], F.lit("|>\n"))


def _body(t: Column) -> Column:
    return F.concat(F.replace(t["text"], F.lit("<|"), F.lit("< |")), F.lit("<|end|>\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def _spans(turns: Column) -> Column:
    """Of what the assistant says, in characters from the first of the turns; each turn knows where it begins."""
    first = F.get(turns, F.lit(0))["at"]
    start = lambda t: (t["at"] - first + F.length(_head(t))).cast("int")
    return F.transform(F.filter(turns, lambda t: t["role"] == "assistant"), lambda t: F.struct(start(t).alias("start"), (start(t) + F.length(_body(t))).alias("end")))


def format_preferences(turns: DataFrame) -> DataFrame:
    """turns: (pair_id, side: chosen or rejected, turn, role, text). One row a pair: prompt, completions, their loss spans."""
    role = F.replace(F.replace(F.coalesce("role", F.lit("user")), F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))
    rows = turns.repartition("pair_id").select("pair_id", "side", F.struct(F.col("turn").cast("bigint").alias("turn"), role.alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    size = F.length(_head(F.col("t"))) + F.length(_body(F.col("t")))
    rows = rows.withColumn("at", F.sum(size).over(Window.partitionBy("pair_id", "side").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)) - size)
    turn = F.struct("t.turn", "t.role", "t.text", "at")
    sides = rows.groupBy("pair_id").agg(*(F.array_sort(F.collect_list(F.when(F.col("side") == s, turn))).cast(TURNS).alias(s) for s in ("chosen", "rejected")))
    both = F.least(F.size("chosen"), F.size("rejected"))
    c, r = F.col("chosen"), F.col("rejected")
    differ = F.filter(F.sequence(F.lit(0), F.greatest(both - 1, F.lit(0))), lambda i: (F.get(c, i)["role"] != F.get(r, i)["role"]) | (F.get(c, i)["text"] != F.get(r, i)["text"]))
    sides = sides.withColumn("n_prompt", F.when(both == 0, 0).otherwise(F.coalesce(F.array_min(differ), both)))
    rest = {s: F.slice(s, F.col("n_prompt") + 1, F.greatest(F.size(s), F.lit(1))) for s in ("chosen", "rejected")}
    longer = F.when(F.size("chosen") > 0, c).otherwise(r)
    sides = sides.withColumn("shared", F.slice(longer, F.lit(1), F.col("n_prompt"))).withColumns({f"{s}_rest": x for s, x in rest.items()})
    c, r = F.col("chosen_rest"), F.col("rejected_rest")
    return sides.select(
        "pair_id", F.col("n_prompt").alias("n_prompt_turns"), _rendered(F.col("shared")).alias("prompt"),
        _rendered(c).alias("chosen"), _spans(c).alias("chosen_spans"),
        _rendered(r).alias("rejected"), _spans(r).alias("rejected_spans"),
    )


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations: chosen is a conversation up to its last reply, rejected has there the last reply of its neighbour (the id with the lowest bit flipped), or its own if that has none."""
    turns = conversations.select("conv_id", "turn", "role", "text").where("conv_id is not null")
    said = F.when(F.col("role") == "assistant", F.struct(F.col("turn"), F.coalesce("text", F.lit("")).alias("text")))
    last = turns.groupBy("conv_id").agg(F.max(said).alias("last"))
    near = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("last.text").alias("other"))
    pairs = last.join(near, "conv_id", "left").select("conv_id", F.col("last.turn").alias("to"), F.col("last.text").alias("own"), F.coalesce("other", "last.text").alias("other"))
    turns = turns.join(pairs, "conv_id").where(F.col("to").isNull() | (F.col("turn") <= F.col("to")))
    swapped = F.when((F.col("turn") == F.col("to")) & (F.col("role") == "assistant") & (F.coalesce("text", F.lit("")) == F.col("own")), F.col("other")).otherwise(F.col("text"))
    sides = F.array(F.struct(F.lit("chosen").alias("side"), F.col("text")), F.struct(F.lit("rejected").alias("side"), swapped.alias("text")))
    return turns.select(F.col("conv_id").alias("pair_id"), "turn", "role", F.inline(sides))


def query(spark, sf_dir: str) -> DataFrame:
    out = format_preferences(swapped_replies(table(spark, sf_dir, "conversations"))).withColumnRenamed("pair_id", "conv_id")
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",").alias(c)
    return out.select("conv_id", "n_prompt_turns", "prompt", "chosen", "rejected", text("chosen_spans"), text("rejected_spans"))


ORACLE = """
WITH l AS (SELECT conv_id, max(turn) FILTER (role = 'assistant') AS z FROM conversations GROUP BY 1),
r AS (SELECT c.conv_id, max(coalesce(text, '')) AS reply FROM conversations c JOIN l ON c.conv_id = l.conv_id AND turn = z AND role = 'assistant' GROUP BY 1),
t AS (SELECT c.conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS a, CASE WHEN turn = z AND role = 'assistant' AND coalesce(text, '') = r.reply THEN coalesce(o.reply, r.reply) ELSE coalesce(text, '') END AS b
      FROM conversations c JOIN l USING (conv_id) LEFT JOIN r USING (conv_id) LEFT JOIN r o ON o.conv_id = xor(c.conv_id, 1) WHERE z IS NULL OR turn <= z),
i AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, a) AS i FROM t),
d AS (SELECT conv_id, coalesce(min(i) FILTER (a <> b), max(i) + 1) - 1 AS n FROM i GROUP BY 1),
p AS (SELECT i.*, n, '<|' || role || '|>' || chr(10) AS h, replace(a, '<|', '< |') || '<|end|>' || chr(10) AS x, replace(b, '<|', '< |') || '<|end|>' || chr(10) AS y FROM i JOIN d USING (conv_id)),
s AS (SELECT *, coalesce(sum(length(h || x)) FILTER (i > n) OVER w, 0) AS u, coalesce(sum(length(h || y)) FILTER (i > n) OVER w, 0) AS v FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT conv_id, any_value(n)::INTEGER AS n_prompt_turns, coalesce(string_agg(h || x, '' ORDER BY i) FILTER (i <= n), '') AS prompt, coalesce(string_agg(h || x, '' ORDER BY i) FILTER (i > n), '') AS chosen, coalesce(string_agg(h || y, '' ORDER BY i) FILTER (i > n), '') AS rejected,
  coalesce(string_agg((u + length(h))::BIGINT || '-' || (u + length(h) + length(x))::BIGINT, ',' ORDER BY i) FILTER (i > n AND role = 'assistant'), '') AS chosen_spans,
  coalesce(string_agg((v + length(h))::BIGINT || '-' || (v + length(h) + length(y))::BIGINT, ',' ORDER BY i) FILTER (i > n AND role = 'assistant'), '') AS rejected_spans
FROM s GROUP BY 1
"""
