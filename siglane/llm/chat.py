"""Chat examples by prefix-target expansion, in DataFrame functions only.

A turn is written as START role, line feed, text, STOP, line feed. Inside roles and texts a backslash is doubled and
the first two characters of control strings, ``<|``, get a backslash between them, so control strings occur where the
template puts them and nowhere else; a line feed in a role is written ``<\\n`` for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, STOP = "<|im_start|>", "<|im_end|>"
TARGET_ROLE = "assistant"
_B = "\\"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(_B), F.lit(_B * 2)), F.lit("<|"), F.lit(f"<{_B}|"))


def unescape(text: Column) -> Column:
    """The inverse of escape(): after doubling, a single backslash stands only between ``<`` and ``|``."""
    return F.replace(F.replace(text, F.lit(f"<{_B}|"), F.lit("<|")), F.lit(_B * 2), F.lit(_B))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(f"<{_B}n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(f"<{_B}n"), F.lit("\n")))


def prefix_targets(conversations: DataFrame, target_role: str = TARGET_ROLE) -> DataFrame:
    """One example for each assistant turn: conv_id, example, n_turns, text, loss_start, loss_length.

    ``text`` holds all turns before it, formatted, and the turn itself; the mask is the turn's escaped text, from
    character ``loss_start`` (from 0) on. Turns that follow the last reply, or all turns where there is none, are no
    example's context; they come with all before them as a last row without any mask, so the output holds every turn.
    Turns are ordered by turn, role, text (nulls first), repeated rows are turns of their own; null role or text count as
    empty, null conv_id is a conversation like others. An empty table gives an empty one; other columns are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct("turn", role.alias("role"), text.alias("text"))
    turns = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def written(t: Column) -> Column:
        return F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(STOP + "\n"))

    turns = turns.withColumn("written", F.transform("turns", written)).withColumn("n_turns", F.size("turns").cast("long"))
    last = F.element_at("turns", -1)["role"] != F.lit(target_role)
    places = F.transform("turns", lambda t, i: F.when((t["role"] == target_role) | (i == F.size("turns") - 1), i))
    turns = turns.withColumn("tail", last).withColumn("place", F.explode(F.array_compact(places)))
    own = F.get("turns", F.col("place"))
    target = (F.col("place") < F.col("n_turns") - 1) | ~F.col("tail")
    body = F.array_join(F.slice("written", F.lit(1), F.col("place") + 1), "")
    length = F.when(target, F.length(escape(own["text"]))).otherwise(0)
    examples = turns.select("conv_id", F.col("place").alias("example"), "n_turns", body.alias("text"), length.cast("long").alias("loss_length"), target.alias("target"))
    start = F.length("text") - F.lit(len(STOP) + 1) - F.col("loss_length")
    return examples.select("conv_id", "example", "n_turns", "text", F.when(F.col("target"), start.cast("long")).alias("loss_start"), "loss_length")


def parse_turns(text: Column) -> Column:
    """array<struct<role, text>> of a formatted text."""
    parts = F.slice(F.split(text, r"<\|im_start\|>"), 2, 1 << 30)

    def parsed(part: Column) -> Column:
        cut = F.instr(part, "\n")
        return F.struct(unescape_role(part.substr(F.lit(1), cut - 1)).alias("role"), unescape(part.substr(cut + 1, F.length(part) - cut - len(STOP) - 1)).alias("text"))

    return F.transform(parts, parsed)


def read_back(examples: DataFrame) -> DataFrame:
    """Digests of each conversation, from its examples: turns from the longest one, trained text from the masks."""
    masked = unescape(F.col("text").substr((F.col("loss_start") + 1).cast("int"), F.col("loss_length").cast("int")))
    rows = examples.select("conv_id", "example", "text", F.when(F.col("loss_start").isNotNull(), masked).otherwise("").alias("masked"))
    by = rows.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("whole"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "masked"))), lambda x: x["masked"]), "").alias("loss"),
        F.sum(F.length("text")).cast("long").alias("formatted_chars"),
    )
    by = by.withColumn("turns", parse_turns(F.col("whole")))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return by.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
