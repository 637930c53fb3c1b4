r"""Chat formatting by prefix-target expansion (native).

Template of a turn::

    <s>[INST] role [/INST] text </s>\n

The four control strings are escaped in roles and texts (a backslash becomes
``\e``, ``<s>`` ``\s``, ``</s>`` ``\t``, ``[INST]`` ``\u``, ``[/INST]`` ``\v``),
so they occur in the output as marks only, and every backslash of the output
starts one of the five codes: the way back is exact.

Every assistant turn becomes an example of its own: the formatted turns up to
and including it, with the span of its (escaped) text as the only trainable
part.  A conversation that does not end in an assistant turn gets one more row
without a trainable span, so nothing is lost.

The turns of one conversation form one row: a training example is one record.
A conversation of n turns gives up to n prefixes, as the method states; long
conversations therefore cost the square of their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed codes of the control strings, in the order of escaping.
CODES = (("\\", "\\e"), ("<s>", "\\s"), ("</s>", "\\t"), ("[INST]", "\\u"), ("[/INST]", "\\v"))
OPEN, MID, CLOSE = "<s>[INST] ", " [/INST] ", " </s>\n"
TARGET = "assistant"


def escape(c: Column) -> Column:
    for raw, code in CODES:
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for raw, code in reversed(CODES):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def format_conversations(conv: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, example, text, loss_start, loss_len)``, one row per example.

    * Turns are ordered by turn (NULL first), ties by role, then text; NULL role
      or text is empty; NULL conv_id is a conversation of its own; repeated rows
      are turns of their own.
    * ``loss_start`` (code points from 0) and ``loss_len`` mark the reply;
      both are NULL in the row for turns after the last reply (``example`` is
      the index of the last turn the text holds).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    role = F.coalesce(F.col(role_col), F.lit(""))
    turns = (conv.groupBy(F.col(id_col).alias("conv_id"))
             .agg(F.sort_array(F.collect_list(F.struct(
                 F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")))).alias("turns")))
    head = lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(MID))
    full = lambda t: F.concat(head(t), escape(t["text"]), F.lit(CLOSE))
    parts = turns.select("conv_id", "turns", F.transform("turns", full).alias("parts"))
    last = F.size("turns") - 1
    index = F.filter(F.sequence(F.lit(0), last),
                     lambda i: (F.get("turns", i)["role"] == TARGET) | (i == last))
    at = parts.select("conv_id", "turns", "parts", F.explode(index).alias("example"))
    turn = F.get("turns", F.col("example"))
    start = F.length(F.concat(F.array_join(F.slice("parts", F.lit(1), F.col("example")), ""), head(turn)))
    trained = turn["role"] == TARGET
    return at.select(
        "conv_id", "example", F.array_join(F.slice("parts", F.lit(1), F.col("example") + 1), "").alias("text"),
        F.when(trained, start).alias("loss_start"), F.when(trained, F.length(escape(turn["text"]))).alias("loss_len"))


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation, what the formatted examples say when read back."""
    reply = F.when(F.col("loss_start").isNotNull(), F.struct(
        "example", unescape(F.substring("text", F.col("loss_start") + 1, F.col("loss_len"))).alias("said")))
    back = (examples.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("whole"),
        F.sort_array(F.collect_list(reply)).alias("replies"),
        F.sum(F.length("text")).cast("long").alias("formatted_chars")))
    pieces = F.filter(F.split("whole", " </s>\\n"), lambda p: p != "")
    sides = F.transform(pieces, lambda p: F.split(p, " \\[/INST\\] ", 2))
    turns = F.transform(sides, lambda s: F.concat(
        unescape(F.substring(F.get(s, F.lit(0)), F.lit(len(OPEN) + 1), F.length(F.get(s, F.lit(0))))), F.lit("\n"),
        unescape(F.get(s, F.lit(1))), F.lit("\n")))
    back = back.select("conv_id", "formatted_chars", turns.alias("turns"),
                       F.array_join(F.transform("replies", lambda r: r["said"]), "").alias("loss"))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")


PROBE = "</s>[INST] ok [/INST]"


def with_probe(conv: DataFrame) -> DataFrame:
    """The table plus conversation -1, whose texts are control strings."""
    probe = conv.sparkSession.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(TARGET).alias("role"), F.lit(PROBE).alias("text"))
    return conv.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(probe)


_ESC = "replace(replace(replace(replace(replace({0}, '\\', '\\e'), '<s>', '\\s'), '</s>', '\\t'), '[INST]', '\\u'), '[/INST]', '\\v')"
ORACLE_SQL = f"""
WITH t AS (
  SELECT conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
o AS (
  SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         sum(length({_ESC.format('role')}) + length({_ESC.format('text')}) + {len(OPEN + MID + CLOSE)}) OVER w AS upto
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(upto) FILTER (role = 'assistant' OR i = n - 1)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""
