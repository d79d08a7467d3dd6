"""Chat formatting: cumulative snapshots are collapsed, then conversations rendered.

A chat log often holds a conversation once per reply, each record repeating the one
before it with more turns.  A turn's hash covers its position, role and text;
the hashes of a conversation's first n turns, combined by exclusive or, name that
prefix.  Equal conversations are reduced to one; an anti-join on (n, hash) then
removes those that are a proper prefix of a longer one.  Only DataFrame
functions are used.

Distinct turns are numbered by a range sort with an offset for each partition, and
dealt in blocks of ``BLOCK_TURNS`` places, so that a conversation of any length, whatever its
turn numbers, is spread over many tasks; a window per conversation
adds up one row a block, not the turns.  A rendered conversation has a row
for each of its blocks; put together in order of ``first_turn`` they are its text.

Defined results: rows without a conversation id form one conversation; turns
without a number come first; turns of one number are ordered by role, then text
(nulls first); rows that repeat all four columns count once; a null role is
rendered as ``unknown`` and a null text as empty, and they are told apart from
those; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faceoff.llm.common import written
from faceoff.operators.ranking import global_row_number

BLOCK_TURNS = 256
# The rendered form of a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
UNKNOWN_ROLE = "unknown"


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(
        F.lit(OPEN), F.coalesce(role, F.lit(UNKNOWN_ROLE)), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit(CLOSE)
    )


def numbered(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(key, turn, role, text, said_a, said_b, place): the distinct turns with two hashes of
    what was said, and their place in their block.

    ``key`` is (conv, block).  As a struct it is never null and equals itself even
    where its fields are null, so one hash partitioning serves every window,
    group and join over blocks.
    """
    turns = conversations.select(
        F.struct(F.col(conv_col).alias("conv")).alias("of"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
        F.col(text_col).alias("text"),
    ).distinct()
    placed = global_row_number(turns, ["of", "turn", "role", "text"], "pos")
    starts = placed.groupBy("of").agg(F.min("pos").alias("start"))
    at = F.col("pos") - F.col("start")
    turns = placed.join(starts, "of").select(
        F.struct(F.col("of.conv").alias("conv"), F.floor(at / BLOCK_TURNS).alias("block")).alias("key"),
        "turn", "role", "text", (at % BLOCK_TURNS + 1).cast("int").alias("place"),
    )
    # xxhash64 passes over nulls: the flags tell a null from an empty string
    said = [F.col("role").isNull(), "role", F.col("text").isNull(), "text"]
    hashes = {"said_a": F.xxhash64(F.lit(1), *said), "said_b": F.xxhash64(*said, F.lit(2))}
    return turns.withColumns(hashes)


def blocks(turns: DataFrame) -> DataFrame:
    """(key, before, n): turns of the conversation in earlier blocks, and in all."""
    sizes = turns.groupBy("key").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("key.conv").orderBy("key.block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        "key", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"),
        F.sum("size").over(Window.partitionBy("key.conv")).alias("n"),
    )


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, n, a, b, whole): every prefix of every conversation by its number of turns and two hashes."""
    slim = turns.select("key", "place", "said_a", "said_b")
    at = slim.join(blocks(turns), "key").withColumn("at", F.col("before") + F.col("place"))
    hashed = at.select("key", "place", "at", "n", F.xxhash64("at", "said_a").alias("a"), F.xxhash64("said_b", "at").alias("b"))
    within = Window.partitionBy("key").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    inside = hashed.select("key", "at", "n", *(F.bit_xor(h).over(within).alias(h) for h in "ab"))
    sums = hashed.groupBy("key").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    earlier = Window.partitionBy("key.conv").orderBy("key.block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("key", *(F.coalesce(F.bit_xor(h).over(earlier), F.lit(0)).alias(f"{h}0") for h in "ab"))
    return inside.join(carried, "key").select(
        F.col("key.conv").alias("conv"), F.col("at").alias("n"), *(F.col(h).bitwiseXOR(F.col(f"{h}0")).alias(h) for h in "ab"),
        (F.col("at") == F.col("n")).alias("whole"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """(conv, n, copies): one conversation of each set of equal ones, the least id, that no longer one begins with."""
    found = written(prefixes(turns), "chat-prefixes")  # read twice; a few numbers a turn
    key = ["n", "a", "b"]
    whole = found.filter("whole").groupBy(*key).agg(F.min("conv").alias("conv"), F.count("*").alias("copies"))
    begun = found.filter(~F.col("whole")).select(*key).distinct()
    return whole.join(begun, key, "left_anti").select("conv", "n", "copies")


def chat_format(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """(conv_id, first_turn, n_turns, copies, text): the maximal conversations, rendered.

    ``first_turn`` is the number, from 0, of the row's first turn: 0 for all but very long conversations.
    """
    turns = written(numbered(conversations, conv_col, turn_col, role_col, text_col), "chat-turns")
    kept = maximal(turns).withColumnRenamed("conv", "kept_conv")
    found = blocks(turns).select("key", "before")
    parts = found.join(kept, F.col("key.conv").eqNullSafe(F.col("kept_conv"))).drop("kept_conv")
    rows = turns.join(parts, "key").select(
        "key", "place", "before", "n", "copies", rendered_turn(F.col("role"), F.col("text")).alias("said")
    )
    texts = rows.groupBy("key", "before", "n", "copies").agg(F.array_sort(F.collect_list(F.struct("place", "said"))).alias("said"))
    return texts.select(
        F.col("key.conv").alias(conv_col), F.col("before").alias("first_turn"), F.col("n").alias("n_turns"), "copies",
        F.array_join("said.said", "").alias("text"),
    )
