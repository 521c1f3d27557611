"""Preference pairs of conversations: the common turns once as prompt, both endings masked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnlake.llm.common import stage, whole


def rendered(role: Column, text: Column) -> Column:
    """A turn in the chat template."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n"))


def _turns(rows: DataFrame, pair: str, turn: str, role: str, text: str) -> DataFrame:
    return rows.filter(F.col(pair).isNotNull()).select(F.col(pair).alias("pair_id"), F.col(turn).cast("long").alias("turn"),
                       whole(role).alias("role"), whole(text).alias("text"))


def preference_segments(chosen: DataFrame, rejected: DataFrame, pair: str = "conv_id", turn: str = "turn",
                        role: str = "role", text: str = "text") -> DataFrame:
    """One row for each rendered turn: pair_id, part, turn, role, piece and learn.

    The prompt is the longest common prefix of the two conversations of a pair: all turns with a
    number below the first one at which they differ in role or text or that one of them lacks. It
    is given once, as part `prompt`; the rest are parts `chosen` and `rejected`. learn is the mask:
    only assistant turns of the two endings are learned, never the prompt. Read in the order of
    turn, role and piece, the pieces of prompt and ending are the rendered conversation.

    The prefix comes from counts of equal turns and a smallest number for each pair, both with
    partial sums, so a conversation of any length is never collected in one task. A null turn
    number sorts first, a null role or text is empty, repeated turns count once. Turns without a
    pair id belong to no conversation and to no pair. A pair that lacks one side has no prompt.
    """
    sides = _turns(chosen, pair, turn, role, text).withColumn("side", F.lit(1)).unionByName(
        _turns(rejected, pair, turn, role, text).withColumn("side", F.lit(2)))
    # Turns of both sides in one row: 1 chosen, 2 rejected, 3 both.
    turns = sides.groupBy("pair_id", "turn", "role", "text").agg(F.bit_or("side").alias("side"))
    # No turn number sorts before all others; the flag keeps it apart from the smallest long.
    at = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("turn"))
    differing = turns.filter("side < 3").groupBy("pair_id").agg(F.min(at).alias("_first"))
    marked = turns.join(differing, "pair_id", "left")
    common = F.col("_first").isNull() | (at < F.col("_first"))
    parts = F.when(common, F.array(F.lit("prompt"))).otherwise(F.filter(F.array(
        F.when(F.col("side").bitwiseAND(1) > 0, F.lit("chosen")),
        F.when(F.col("side").bitwiseAND(2) > 0, F.lit("rejected"))), lambda part: part.isNotNull()))
    return marked.withColumn("part", F.explode(parts)).select(
        "pair_id", "part", "turn", "role", rendered(F.col("role"), F.col("text")).alias("piece"),
        ((F.col("part") != "prompt") & (F.col("role") == "assistant")).alias("learn"))


def assembled(segments: DataFrame) -> DataFrame:
    """One row for each pair: pair_id, prompt, chosen, rejected, chosen_mask and rejected_mask.

    A mask lists the learned (start, end) of its ending in code points, in order. A part without
    turns is empty, and so is its mask. A row holds one pair, so the pair must fit a row; the
    segments themselves have no such limit.
    """
    pieces = F.array_sort(F.collect_list(F.struct(
        F.col("turn").isNotNull().alias("numbered"), "turn", "role", "piece", "learn", "part")))
    pairs = segments.groupBy("pair_id").agg(pieces.alias("pieces"))
    parts = ("prompt", "chosen", "rejected")
    split = pairs.select("pair_id", *[_of_part(name).alias(name) for name in parts])
    return split.select("pair_id", *[F.concat_ws("", f"{name}.piece").alias(name) for name in parts],
                        *[_mask(F.col(name)).alias(f"{name}_mask") for name in ("chosen", "rejected")])


def _of_part(name: str) -> Column:
    return F.filter("pieces", lambda piece: piece["part"] == name)


def preference_pairs(chosen: DataFrame, rejected: DataFrame, pair: str = "conv_id", turn: str = "turn",
                     role: str = "role", text: str = "text") -> DataFrame:
    """Prompt, completions and masks of each pair, see preference_segments and assembled."""
    return assembled(preference_segments(chosen, rejected, pair, turn, role, text))


def mask_text(mask: Column) -> Column:
    """A mask as start:end, comma-joined."""
    return F.array_join(F.transform(mask, lambda span: F.concat_ws(
        ":", span["start"].cast("string"), span["end"].cast("string"))), ",")


def _mask(pieces: Column) -> Column:
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,`end`:int>>").alias("spans"))
    return F.aggregate(pieces, start, lambda state, piece: F.struct(
        (state["at"] + F.length(piece["piece"])).alias("at"),
        F.when(piece["learn"], F.concat(state["spans"], F.array(F.struct(
            state["at"].alias("start"), (state["at"] + F.length(piece["piece"])).alias("end"))))).otherwise(
            state["spans"]).alias("spans")))["spans"]


def swapped_replies(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """Rejected sides for a table without any: each conversation with another's last reply.

    The assistant turn with the highest number of a conversation is replaced by that of the next
    conversation that has one, in the order of ids; the last one takes that of the first. Of several
    texts with the highest number the smallest is taken. Only where no other conversation has a
    reply does the rejected side lack it. Conversations without a numbered reply stay as they are,
    turns without a conversation id are left out.

    The order comes from a range exchange of one row for each conversation, written with its place.
    """
    known = conversations.filter(F.col(conv).isNotNull()).select(conv, F.col(turn).cast("long").alias(turn), role, text)
    replies = known.filter((F.col(role) == "assistant") & F.col(turn).isNotNull())
    # Inverted numbers, so that the smallest struct has the highest number and then the smallest text.
    last = replies.groupBy(conv).agg(F.min(F.struct(F.bitwise_not(turn).alias("turn"), whole(text).alias("text"))).alias("reply"))
    ring = _numbered(last.select(conv, F.bitwise_not("reply.turn").alias("_last"), F.col("reply.text").alias("_text")), conv)
    total = ring.agg(F.count("*")).scalar()
    following = ring.select(F.pmod(F.col("_number") - 1, total).alias("_number"), F.col("_text").alias("_other"))
    swapped = ring.join(following, "_number").filter(total > 1).select(
        conv, F.col("_last").alias(turn), F.lit("assistant").alias(role), F.col("_other").alias(text))
    kept = known.join(ring.select(conv, "_last"), conv, "left").filter(
        F.col("_last").isNull() | ~F.col(turn).eqNullSafe(F.col("_last")) | ~F.col(role).eqNullSafe(F.lit("assistant")))
    return kept.select(conv, turn, role, text).unionByName(swapped)


def _numbered(rows: DataFrame, key: str) -> DataFrame:
    """Rows with their place in the order of a key without repeats as _number, from 0."""
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = stage(rows.repartitionByRange(key).sortWithinPartitions(key).withColumns(
        {"_part": F.spark_partition_id(), "_place": place}), "ring")
    # One row for each partition of the exchange.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return placed.join(F.broadcast(offsets), "_part").withColumn(
        "_number", F.col("_offset") + F.col("_place")).drop("_part", "_place", "_offset")
