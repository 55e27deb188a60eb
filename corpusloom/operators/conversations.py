"""Conversation turns to message arrays and training pairs.

One conversation may hold a large part of all turns, so nothing here works on a whole
conversation at once: turns are handled in blocks of `block_turns` turn numbers. Ordinary
conversations fit in block 0. (conv_id, turn) must be unique and turn numbers start at 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK_TURNS = 16384


def _block(block_turns: int) -> Column:
    return F.greatest(F.floor(F.col("turn") / block_turns), F.lit(0)).cast("long")


def assemble_messages(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(conv_id, part, messages) with messages as role and content structs in turn order.

    A conversation of up to `block_turns` turns is one row with part 0; a longer one goes on
    in parts 1, 2, ... Parts are how a long conversation is stored; all work on cases takes the
    parts of a conversation together.
    """
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    messages = F.transform(
        ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))
    )
    return turns.groupBy("conv_id", _block(block_turns).alias("part")).agg(messages.alias("messages"))


def last_messages(turns: DataFrame) -> DataFrame:
    """(conv_id, content) of the last turn of each conversation, whatever its role."""
    last = F.max(F.struct("turn", "role", "text"))
    return turns.groupBy("conv_id").agg(last.alias("last")).select("conv_id", F.col("last.text").alias("content"))


def count_conversations(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id").distinct().agg(F.count("*").alias("cases"))


def _next_turns(long_turns: DataFrame) -> DataFrame:
    """The first turn of each block, as a helper row behind the turns of the block before it."""
    firsts = long_turns.groupBy("conv_id", "block").agg(
        F.min(F.struct("turn", "role", "text")).alias("first")
    )
    previous = F.lag("block", 1, 0).over(W.partitionBy("conv_id").orderBy("block"))
    return firsts.select(
        "conv_id", "first.turn", "first.role", "first.text", previous.alias("block"), F.lit(1).alias("edge")
    )


def _system_turns(turns: DataFrame, long_turns: DataFrame) -> DataFrame:
    """The first system turn of a long conversation, as a helper row in front of each block."""
    # One row per conversation before the join, however many system turns there are.
    systems = (
        turns.where(F.col("role") == "system")
        .groupBy("conv_id")
        .agg(F.min(F.struct("turn", "role", "text")).alias("first"))
    )
    blocks = long_turns.select(
        "conv_id", F.explode(F.array(F.lit(0).cast("long"), "block")).alias("block")
    ).distinct()
    return blocks.join(systems, "conv_id").select(
        "conv_id", "first.turn", "first.role", "first.text", "block", F.lit(-1).alias("edge")
    )


def pair_turns(turns: DataFrame, *, with_system: bool = True, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """A user turn directly followed by an assistant turn gives one row:
    (conv_id, turn, prompt, response[, system_prompt]), turn being that of the prompt.

    system_prompt is the first system turn of the conversation, null when there is none.

    One shuffle of the turns by (conv_id, block), then windows over one sort. Helper rows make
    each block of a conversation that goes beyond block 0 complete in itself; they come from a
    scan for turn >= block_turns, which skips every row group of an ordinary table.
    """
    turns = turns.select("conv_id", "turn", "role", "text")
    rows = turns.withColumns({"block": _block(block_turns), "edge": F.lit(0)})
    long_turns = turns.where(F.col("turn") >= block_turns).withColumn("block", _block(block_turns))
    rows = rows.unionByName(_next_turns(long_turns))
    if with_system:
        rows = rows.unionByName(_system_turns(turns, long_turns))
    in_block = W.partitionBy("conv_id", "block").orderBy("edge", "turn", "role", "text")
    whole_block = in_block.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    system_turn = F.when(F.col("role") == "system", F.struct("text"))
    # The text keeps its name up to the end: renamed here, it would be shuffled twice.
    paired = rows.withColumns(
        {"next_role": F.lead("role").over(in_block), "response": F.lead("text").over(in_block)}
    )
    out = ["conv_id", "turn", F.col("text").alias("prompt"), "response"]
    if with_system:
        paired = paired.withColumn("system", F.first(system_turn, ignorenulls=True).over(whole_block))
        out.append(F.col("system.text").alias("system_prompt"))
    return paired.where(
        (F.col("edge") == 0) & (F.col("role") == "user") & (F.col("next_role") == "assistant")
    ).select(*out)


def staged_corpus(stages: dict[str, DataFrame], stage_col: str = "stage") -> DataFrame:
    """Tables of equal columns as one, with the stage name in front."""
    named = [df.select(F.lit(name).alias(stage_col), "*") for name, df in stages.items()]
    return reduce(DataFrame.unionByName, named)
