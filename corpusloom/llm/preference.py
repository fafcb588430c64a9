"""Preference formatting (native): paired masked completions after the longest common turn prefix.

A pair is two conversations, chosen and rejected. Their longest common prefix of turns (equal role and text) is
rendered once as the prompt; what follows in either is its completion. A completion's mask lists the character ranges
that are trained on, the contents of its assistant turns with their end marks; headers and other roles are masked out.

Defined results: null roles count as "user" and null texts as empty; turns are ordered by turn number, then role and
text, null numbers first; rows that repeat are turns of their own; turns without a conversation id belong to none;
chosen and rejected that are equal give two empty completions; texts of any length are rendered whole; an empty table
gives an empty result. Columns of the input that are named like those which `format_pairs` adds are replaced, all others
pass through.

A rendered conversation is one value, so the turns of one conversation (and its partner) meet in one task; nothing
else does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"


def common_turns(chosen: Column, rejected: Column) -> Column:
    """How many leading turns are equal."""
    both = F.least(F.size(chosen), F.size(rejected))
    differ = F.filter(F.sequence(F.lit(0), both), lambda i: (i == both) | ~F.get(chosen, i).eqNullSafe(F.get(rejected, i)))
    return F.element_at(differ, 1)


def head(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit(MIDDLE))


def render(turns: Column) -> Column:
    return F.concat_ws("", F.transform(turns, lambda t: F.concat(head(t), t["text"], F.lit(END))))


def mask(turns: Column) -> Column:
    """Trained ranges "from-to" (characters, `to` not included) of the rendered turns, joined by commas."""
    step = F.aggregate(
        turns,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda s, t: F.struct(
            (s["at"] + F.length(head(t)) + F.length(t["text"]) + len(END)).alias("at"),
            F.when(
                t["role"] == "assistant",
                F.concat(s["out"], F.when(s["out"] == "", "").otherwise(","), (s["at"] + F.length(head(t))).cast("string"), F.lit("-"), (s["at"] + F.length(head(t)) + F.length(t["text"]) + len(END)).cast("string")),
            )
            .otherwise(s["out"])
            .alias("out"),
        ),
    )
    return step["out"]


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """`pairs` with prompt_turns, prompt, and text, mask and turns of both completions.

    `chosen` and `rejected` are arrays of struct(role, text) without nulls inside.
    """
    a, b = F.col(chosen), F.col(rejected)
    after = lambda c: F.slice(c, F.col("prompt_turns") + 1, F.size(c))
    out = pairs.withColumn("prompt_turns", common_turns(a, b))
    out = out.withColumns({"prompt": render(F.slice(a, F.lit(1), F.col("prompt_turns"))), "__rest_a": after(a), "__rest_b": after(b)})
    return out.withColumns(
        {"chosen_text": render(F.col("__rest_a")), "chosen_mask": mask(F.col("__rest_a")), "rejected_text": render(F.col("__rest_b")), "rejected_mask": mask(F.col("__rest_b"))}
    ).drop("__rest_a", "__rest_b")


def mismatched_pairs(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, chosen and rejected: a conversation up to its last assistant turn, against one that leaves it at some
    assistant turn and goes on as its partner does.

    Conversations 2k and 2k + 1 are partners. Of its n assistant turns a conversation is left at number conv_id mod n
    (from 0), and the partner's turns from the one that is chosen likewise, up to its last assistant turn, follow. A
    conversation without assistant turn, or whose partner has none, gives no pair. One shuffle brings both together.
    """
    rows = turns.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("user")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"),
    )
    two = rows.groupBy(F.shiftright("conv", 1).alias("duo")).agg(F.collect_list(F.struct("conv", "t")).alias("all"))
    own = lambda odd: F.transform(F.array_sort(F.filter("all", lambda x: x["conv"].bitwiseAND(1) == odd)), lambda x: F.struct(x["t"]["role"].alias("role"), x["t"]["text"].alias("text")))
    two = two.select("duo", own(0).alias("x"), own(1).alias("y"))
    replies = lambda c: F.filter(F.transform(c, lambda t, i: F.when(t["role"] == "assistant", i + 1)), lambda i: i.isNotNull())
    two = two.withColumns({"i": replies(F.col("x")), "j": replies(F.col("y"))}).filter((F.size("i") > 0) & (F.size("j") > 0))
    left = lambda offset, at: F.get(at, F.pmod(F.col("duo") * 2 + offset, F.size(at)).cast("int"))

    def pair(offset: int, a: str, i: str, b: str, j: str) -> Column:
        own, other = left(offset, F.col(i)), left(1 - offset, F.col(j))
        chosen = F.slice(F.col(a), F.lit(1), F.array_max(i))
        rejected = F.concat(F.slice(F.col(a), F.lit(1), own - 1), F.slice(F.col(b), other, F.array_max(j) - other + 1))
        return F.struct((F.col("duo") * 2 + offset).alias("conv_id"), chosen.alias("chosen"), rejected.alias("rejected"))

    return two.select(F.explode(F.array(pair(0, "x", "i", "y", "j"), pair(1, "y", "j", "x", "i"))).alias("p")).select("p.conv_id", "p.chosen", "p.rejected")
