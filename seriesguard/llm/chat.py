"""Preference formatting of conversation pairs, in DataFrame functions only.

The longest common turn prefix of a chosen and a rejected conversation is rendered once as the prompt; the turns after
it become two completions with loss masks: spans of assistant text are trained, other turns and all markup are not.
Turns are compared and rendered as single rows; only ``part_turns`` turns at most are put together in one string, so a
conversation of any length works: it comes out in several parts.

Defined results: turns are ordered by (turn, role, text); a null turn number comes first, a null role is ``user`` and a
null text is empty; a pair whose sides are equal has empty completions; own columns of the input are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store

#: Turns that one output string may hold.
PART_TURNS = 256
#: Turns of one side of a pair that one window group numbers.
GROUP_TURNS = 1 << 16
OPEN, CLOSE = "<|", "|>\n"
END = "<|end|>\n"


def turns_of(conversations: DataFrame, pair: Column, side: str) -> DataFrame:
    """Turn rows of one side of the pairs, for ``preference_pairs``."""
    return conversations.select(pair.alias("pair_id"), F.lit(side).alias("side"), F.col("turn").cast("long"),
                                F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def preference_pairs(turns: DataFrame, *, part_turns: int = PART_TURNS, group_turns: int = GROUP_TURNS) -> DataFrame:
    """Rows (pair_id, side, turn, role, text) with side ``chosen`` or ``rejected`` as training pairs.

    One row for each pair and part: ``prompt``, ``chosen`` and ``rejected`` strings, ``chosen_mask`` and
    ``rejected_mask`` (trained spans of the string, code points, end exclusive), ``prompt_turns`` of the whole pair.
    """
    turns = _placed(turns, group_turns)
    # a position differs if its rows are not one chosen and one rejected turn with equal content
    by_place = turns.groupBy("pair_id", "at").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("role").alias("roles"),
        F.min(F.sha2("text", 256)).alias("low"), F.max(F.sha2("text", 256)).alias("high"))
    differs = (F.col("n") < 2) | (F.col("roles") > 1) | (F.col("low") != F.col("high"))
    prefix = by_place.groupBy("pair_id").agg(
        F.coalesce(F.min(F.when(differs, F.col("at"))), F.max("at") + 1).alias("prompt_turns"))
    head = F.concat(F.lit(OPEN), F.col("role"), F.lit(CLOSE))
    shared = F.col("at") < F.col("prompt_turns")
    lines = turns.join(prefix, "pair_id").where(~shared | (F.col("side") == "chosen")).select(
        "pair_id", "prompt_turns", F.when(shared, "prompt").otherwise(F.col("side")).alias("side"),
        F.when(shared, F.col("at")).otherwise(F.col("at") - F.col("prompt_turns")).alias("at"),
        F.concat(head, "text", F.lit(END)).alias("line"), F.length(head).alias("head"),
        F.when(~shared & (F.col("role") == "assistant"), F.length("text") + F.length(F.lit("<|end|>"))).alias("trained"))
    lines = lines.withColumn("part", F.expr(f"at div {int(part_turns)}"))
    put = lambda side: F.sort_array(F.collect_list(F.when(
        F.col("side") == side, F.struct("at", "line", "head", "trained"))))
    parts = lines.groupBy("pair_id", "part").agg(F.max("prompt_turns").cast("int").alias("prompt_turns"),
                                                 *[put(s).alias(s) for s in ("prompt", "chosen", "rejected")])
    text = lambda c: F.array_join(F.transform(c, lambda x: x["line"]), "")

    def mask(c: str) -> Column:
        start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
        step = lambda a, x: F.struct(
            (a["end"] + F.length(x["line"])).alias("end"),
            F.when(x["trained"].isNull(), a["spans"]).otherwise(F.concat(a["spans"], F.array(F.struct(
                (a["end"] + x["head"]).alias("start"),
                (a["end"] + x["head"] + x["trained"]).alias("end"))))).alias("spans"))
        return F.aggregate(c, start, step, lambda a: a["spans"])

    return parts.select("pair_id", "part", "prompt_turns", *[text(s).alias(s) for s in ("prompt", "chosen", "rejected")],
                        *[mask(s).alias(f"{s}_mask") for s in ("chosen", "rejected")])


def _placed(turns: DataFrame, group_turns: int) -> DataFrame:
    """The rows with their place ``at``. Sides with more turns than a group holds are numbered inside runs of turn
    numbers, after the rows of the runs before, so that one very long conversation is the work of many tasks."""
    sizes = turns.groupBy("pair_id", "side").agg(F.count(F.lit(1)).alias("n"), F.min("turn").alias("low"),
                                                 F.max("turn").alias("high"))
    long = store(sizes.where(F.col("n") > group_turns).select("pair_id", "side", "low", (
        (F.col("high").cast("double") - F.col("low")) * group_turns / F.col("n") + 1).alias("step")), "long")
    order = ["turn", "role", "text"]
    if long.isEmpty():
        return turns.withColumn("at", F.row_number().over(Window.partitionBy("pair_id", "side").orderBy(*order)) - 1)
    span = F.floor((F.col("turn").cast("double") - F.col("low")) / F.col("step"))
    turns = turns.join(long, ["pair_id", "side"], "left") \
        .withColumn("run", F.coalesce(span, F.lit(-1))).drop("low", "step")  # null turns come before all others
    run = ["pair_id", "side", "run"]
    before = Window.partitionBy("pair_id", "side").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = turns.groupBy(*run).agg(F.count(F.lit(1)).alias("n")).select(
        *run, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return turns.withColumn("at", F.row_number().over(Window.partitionBy(*run).orderBy(*order)) - 1).join(runs, run) \
        .withColumn("at", F.col("at") + F.col("offset")).drop("run", "offset")


def regenerated_pairs(conversations: DataFrame) -> DataFrame:
    """Turn rows of pairs made from single conversations: the rejected side of a conversation is the conversation
    with its last assistant turn replaced by that of the conversation with the next id (none: by an empty text).

    Conversations without an assistant turn make no pair, nor do null ids.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .where("conv_id is not null")
    last = rows.where("role = 'assistant'").groupBy("conv_id").agg(
        F.max(F.struct("turn", "text")).alias("last"))
    other = last.select(F.try_subtract("conv_id", F.lit(1)).cast("long").alias("conv_id"), F.col("last.text").alias("other"))
    swap = last.select("conv_id", F.col("last.turn").alias("last_turn"), F.col("last.text").alias("last_text")) \
        .join(other, "conv_id", "left")
    both = rows.join(swap, "conv_id").withColumn("sides", F.explode(F.array(F.lit("chosen"), F.lit("rejected"))))
    replaced = (F.col("sides") == "rejected") & (F.col("role") == "assistant") & \
        F.col("turn").eqNullSafe(F.col("last_turn")) & (F.col("text") == F.col("last_text"))
    return both.select(F.col("conv_id").alias("pair_id"), F.col("sides").alias("side"), "turn", "role",
                       F.when(replaced, F.coalesce("other", F.lit(""))).otherwise(F.col("text")).alias("text"))
