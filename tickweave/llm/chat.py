"""Chat formatting: turns of a conversation become one templated string, and can be read back from it.

Adjacent turns of one role form a block ``<s>role\\ntext[NEXT]text</s>``; ``[NEXT]`` keeps the turns of a block apart. No
text or role can forge a mark: ``<``, ``[``, the escape character itself and (in roles) newlines are written as the escape
character and a digit. The loss mask covers the texts of the ``assistant`` role.

Only Spark expressions. A conversation is first gathered by stretches of turns, so that the rows of a long one are brought
together by many tasks; the last step sees one row per stretch. The formatted string itself is one value by definition.

Defined results: null texts and roles are empty; turns are ordered by number (null first), then role, then text; rows
without a conversation id form one conversation; repeated rows are repeated turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE, NEXT = "<s>", "</s>", "[NEXT]"
# What stands for the escape character (data link escape), the marks' first characters and a newline.
ESCAPE = "\u0010"
ESCAPED = {ESCAPE: ESCAPE + "0", "<": ESCAPE + "1", "[": ESCAPE + "2"}
NEWLINE = ESCAPE + "3"
STRETCH = 256


def escaped(text: Column) -> Column:
    for plain, code in ESCAPED.items():
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``; the escape character itself comes last, so nothing is read twice."""
    for plain, code in [(p, c) for p, c in ESCAPED.items() if p != ESCAPE]:
        text = F.replace(text, F.lit(code), F.lit(plain))
    return F.replace(text, F.lit(ESCAPED[ESCAPE]), F.lit(ESCAPE))


def format_chat(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, formatted``."""
    rows = df.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("t"),
    )
    stretches = rows.groupBy("conv_id", F.floor(F.col("t.turn") / STRETCH).alias("stretch")).agg(F.sort_array(F.collect_list("t")).alias("turns"))
    gathered = stretches.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("stretch", "turns"))).alias("parts"))
    turns = gathered.select("conv_id", F.flatten(F.col("parts.turns")).alias("turns"))
    before = lambda i: F.get("turns", i - 1)["role"]
    name = lambda r: F.replace(escaped(r), F.lit("\n"), F.lit(NEWLINE))
    opens = lambda t, i: F.concat(F.when(i > 0, F.lit(CLOSE)).otherwise(F.lit("")), F.lit(OPEN), name(t["role"]), F.lit("\n"))
    parts = F.transform("turns", lambda t, i: F.concat(F.when((i > 0) & (before(i) == t["role"]), F.lit(NEXT)).otherwise(opens(t, i)), escaped(t["text"])))
    return turns.select("conv_id", F.concat(F.array_join(parts, ""), F.lit(CLOSE)).alias("formatted"))


def read_back(formatted: Column) -> Column:
    """The turns ``array<struct<role, text>>`` of a formatted conversation."""
    blocks = F.filter(F.split(formatted, F.lit(CLOSE)), lambda b: b != "")

    def parsed(block: Column) -> Column:
        at = F.instr(block, "\n")
        role = F.substring(block, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
        return F.struct(unescaped(F.replace(role, F.lit(NEWLINE), F.lit("\n"))).alias("role"), F.split(F.substring(block, at + 1, F.length(block)), r"\[NEXT\]").alias("texts"))

    # in two steps, so that a block is taken apart once and not once for each of its texts
    return F.flatten(F.transform(F.transform(blocks, parsed), lambda b: F.transform(b["texts"], lambda t: F.struct(b["role"].alias("role"), unescaped(t).alias("text")))))


def read_chat(df: DataFrame, formatted: str = "formatted", masked_role: str = "assistant") -> DataFrame:
    """``conv_id, turns, masked, formatted``: what the string says, and the texts under the loss mask, in order."""
    out = df.select("conv_id", F.col(formatted).alias("formatted"), read_back(F.col(formatted)).alias("turns"))
    mask = F.transform(F.filter("turns", lambda t: t["role"] == masked_role), lambda t: t["text"])
    return out.select("conv_id", "turns", F.array_join(mask, "").alias("masked"), "formatted")
