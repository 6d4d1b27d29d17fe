"""Preference formatting of conversations.

``preference_pairs`` takes pairs of conversations (chosen, rejected): the longest common prefix of their turns
(equal role and text) is rendered once as the prompt, the rest of each as its completion, masked so that only
the completion's assistant turns are learned. The result has one row for each rendered turn, so that a
conversation of any length is never gathered: pair_id, part ('prompt', 'chosen', 'rejected'), position (turn
within the conversation, from 0), role, rendered, learned (the mask), start (characters of the same side's
rendering before this turn, the prompt's included). ``joined`` makes one row per pair where turns are few.

Turns are ordered by turn, equal numbers by role and text; repeated rows are turns of their own; null turn
numbers come first, a null role is rendered as "unknown" and a null text as empty (and both compare equal to
null only). Rows without conv_id belong to no conversation. Equal conversations have empty completions. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from phenolith.llm.common import materialise

#: Turns numbered together; a longer conversation is numbered in several groups.
RUN = 1024
TEMPLATE = ("<|", "|>\n", "<|end|>\n")


def _numbered(turns: DataFrame) -> DataFrame:
    """conv_id, position, role, text, same (hash of role and text): positions by turn, numbered in groups of
    ``RUN`` turn numbers, with the sizes of the groups before added."""
    rows = turns.where("conv_id is not null").select(
        "conv_id", "turn", "role", "text", F.coalesce(F.floor(F.col("turn") / RUN), F.lit(-(1 << 60))).alias("run"),
        F.sha2(F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}), 256).alias("same"))
    rows = materialise(rows, "turns")
    ahead = F.sum("n").over(W.partitionBy("conv_id").orderBy("run").rowsBetween(W.unboundedPreceding, -1))
    runs = rows.groupBy("conv_id", "run").agg(F.count("*").alias("n")).select(
        "conv_id", "run", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    nth = F.row_number().over(W.partitionBy("conv_id", "run").orderBy(F.col("turn").asc_nulls_first(), "role", "text")) - 1
    return rows.withColumn("nth", nth).join(runs, ["conv_id", "run"]).select(
        "conv_id", (F.col("ahead") + F.col("nth")).alias("position"), "role", "text", "same")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(TEMPLATE[0]), F.coalesce(role, F.lit("unknown")), F.lit(TEMPLATE[1]),
                    F.coalesce(text, F.lit("")), F.lit(TEMPLATE[2]))


def same_opening(turns: DataFrame) -> DataFrame:
    """Pairs among conversations with the same first turn: the one with the most assistant characters (then the
    smallest id) is chosen, every other one rejected in one pair. pair_id is the rejected conversation's id."""
    first = turns.where("position = 0").select("conv_id", F.col("same").alias("opening"))
    worth = turns.groupBy("conv_id").agg(
        F.sum(F.when(F.col("role") == "assistant", F.char_length("text")).otherwise(0)).alias("worth"))
    scored = first.join(worth, "conv_id").select("conv_id", "opening", F.coalesce("worth", F.lit(0)).alias("worth"))
    best = scored.groupBy("opening").agg(F.min(F.struct((-F.col("worth")).alias("w"), "conv_id")).alias("b"))
    best = best.select("opening", F.col("b.conv_id").alias("chosen"))
    return scored.join(best, "opening").where("conv_id != chosen").select(
        F.col("conv_id").alias("pair_id"), "chosen", F.col("conv_id").alias("rejected"))


def common_turns(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs with ``common``, the number of leading turns that are equal on both sides."""
    ends = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    sized = pairs.join(ends.select(F.col("conv_id").alias("chosen"), F.col("n").alias("of_chosen")), "chosen").join(
        ends.select(F.col("conv_id").alias("rejected"), F.col("n").alias("of_rejected")), "rejected")
    mine = pairs.join(turns.select(F.col("conv_id").alias("rejected"), "position", F.col("same").alias("r")), "rejected")
    theirs = turns.select(F.col("conv_id").alias("chosen"), "position", F.col("same").alias("c"))
    differ = mine.join(theirs, ["chosen", "position"]).where("r != c").groupBy("pair_id").agg(F.min("position").alias("differ"))
    return sized.join(differ, "pair_id", "left").select(
        "pair_id", "chosen", "rejected", F.least(F.coalesce("differ", "of_chosen"), "of_chosen", "of_rejected").alias("common"))


def preference_pairs(turns: DataFrame, pairs: DataFrame | None = None, numbered: bool = False) -> DataFrame:
    """``turns``: conv_id, turn, role, text, or turns that are ``numbered`` already; ``pairs``: pair_id, chosen,
    rejected (default: ``same_opening``)."""
    numbered = turns if numbered else materialise(_numbered(turns), "numbered")
    pairs = same_opening(numbered) if pairs is None else pairs.select("pair_id", "chosen", "rejected")
    found = materialise(common_turns(numbered, materialise(pairs, "pairs")), "common")
    text = rendered(F.col("role"), F.col("text"))
    before = F.sum("length").over(W.partitionBy("conv_id", "run").orderBy("position").rowsBetween(W.unboundedPreceding, -1))
    ahead = F.sum("all").over(W.partitionBy("conv_id").orderBy("run").rowsBetween(W.unboundedPreceding, -1))
    shown = numbered.select("conv_id", "position", "role", text.alias("rendered"), F.char_length(text).cast("long").alias("length"),
                            F.floor(F.col("position") / RUN).alias("run"))
    runs = shown.groupBy("conv_id", "run").agg(F.sum("length").alias("all")).select(
        "conv_id", "run", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    shown = shown.withColumn("before", F.coalesce(before, F.lit(0))).join(runs, ["conv_id", "run"]).select(
        "conv_id", "position", "role", "rendered", (F.col("ahead") + F.col("before")).alias("start"))
    shown = materialise(shown, "rendered")
    sides = found.select("pair_id", F.col("chosen").alias("conv_id"), "common", F.lit("chosen").alias("side")).unionByName(
        found.select("pair_id", F.col("rejected").alias("conv_id"), "common", F.lit("rejected").alias("side")))
    rows = sides.join(shown, "conv_id").where("position >= common or side = 'chosen'")
    part = F.when(F.col("position") < F.col("common"), F.lit("prompt")).otherwise(F.col("side"))
    return rows.select("pair_id", part.alias("part"), "conv_id", "position", "role", "rendered", "start",
                       ((part != "prompt") & F.coalesce(F.col("role") == "assistant", F.lit(False))).alias("learned"))


def joined(rows: DataFrame) -> DataFrame:
    """pair_id, prompt, chosen, rejected and the learned character ranges of both completions. For pairs whose
    turns fit into one row."""
    def text(part):
        own = F.array_sort(F.collect_list(F.when(F.col("part") == part, F.struct("position", "rendered"))))
        return F.array_join(F.transform(own, lambda x: x["rendered"]), "").alias(part)

    def mask(part):
        own = F.when((F.col("part") == part) & F.col("learned"),
                     F.struct("start", (F.col("start") + F.char_length("rendered")).alias("stop")))
        return F.array_sort(F.collect_list(own)).alias(f"{part}_learned")

    return rows.groupBy("pair_id").agg(*[text(p) for p in ("prompt", "chosen", "rejected")], mask("chosen"), mask("rejected"))


def swapped_answers(turns: DataFrame) -> DataFrame:
    """A copy of every conversation whose last assistant turn has the text of the last assistant turn of the
    next conversation that has one (by conv_id; after the last: the first). Takes and returns numbered turns
    with a numeric conv_id; conversations without an assistant turn are left out."""
    answers = turns.where("role = 'assistant'").groupBy("conv_id").agg(F.max(F.struct("position", "text")).alias("a"))
    ordered = answers.select("conv_id", "a.*").repartitionByRange("conv_id")
    answers = materialise(ordered.withColumn("part", F.spark_partition_id()), "answers")
    in_part = W.partitionBy("part").orderBy("conv_id")
    following = answers.select("conv_id", "part", F.col("position").alias("at"), F.lead("text").over(in_part).alias("answer"),
                               F.lead("conv_id").over(in_part).isNull().alias("last"))
    # the last of a range of ids goes on in the next range that has any: one number for each range in one task
    firsts = answers.groupBy("part").agg(F.min(F.struct("conv_id", "text")).alias("f")).select(
        F.col("part").alias("to"), F.col("f.text").alias("opening"))
    after = answers.select("part").distinct().select("part", F.coalesce(
        F.lead("part").over(W.orderBy("part")), F.first("part").over(W.orderBy("part"))).alias("to")).join(firsts, "to")
    following = following.join(after, "part").select(
        "conv_id", "at", F.when(F.col("last"), F.col("opening")).otherwise(F.col("answer")).alias("answer"))
    swapped = F.col("position") == F.col("at")
    return turns.join(following, "conv_id").select(
        "conv_id", "position", "role", F.when(swapped, F.col("answer")).otherwise(F.col("text")).alias("text"))


def preference_digest(turns: DataFrame) -> DataFrame:
    """Pairs over all conversations: those with the same first turn (kind 'opening'), and every conversation
    against its copy with a swapped answer (kind 'swapped'). Per rendered turn: kind, pair_id (the rejected
    conversation), conv_id, part, position, role, start, n_chars, learned and the text's sha256."""
    own = materialise(_numbered(turns), "numbered").select("conv_id", "position", "role", "text")
    keyed = lambda df, kind: df.withColumn("conv_id", F.concat(F.lit(kind), F.col("conv_id").cast("string")))
    every = keyed(own, "o").unionByName(keyed(swapped_answers(own), "s")).withColumnRenamed("position", "turn")
    numbered = _numbered(every)
    numbered = materialise(numbered, "numbered")
    swapped = numbered.where("conv_id like 's%'").select("conv_id").distinct().select(
        F.col("conv_id").alias("pair_id"), F.concat(F.lit("o"), F.substring("conv_id", 2, 40)).alias("chosen"),
        F.col("conv_id").alias("rejected"))
    pairs = same_opening(numbered.where("conv_id like 'o%'")).unionByName(swapped)
    number = lambda c: F.substring(c, 2, 40).cast("long")
    return preference_pairs(numbered, pairs, numbered=True).select(
        F.when(F.col("pair_id").startswith("s"), "swapped").otherwise("opening").alias("kind"),
        number("pair_id").alias("pair_id"), number("conv_id").alias("conv_id"), "part", "position", "role", "start",
        F.char_length("rendered").cast("long").alias("n_chars"), "learned", F.sha2("rendered", 256).alias("rendered_sha256"))
