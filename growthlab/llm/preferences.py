"""Preference pairs rendered for training: one prompt, two masked completions.

A pair names a chosen and a rejected conversation. Their longest common prefix of turns is rendered once as
the prompt; what each continues with is a completion in which only the assistant's words are trained on.
The prefix is found from per-turn differences that are summed before the shuffle, so conversations are
never compared as wholes. Only DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthlab.llm.storage import ready, stored

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: stands for a NULL turn number: before all others
FIRST = -(1 << 63)


def segments(
    turns: DataFrame, pairs: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    """One row per rendered turn: _pair, part (prompt, chosen, rejected), place in the part, piece, and start
    and stop of the trained characters within the part (NULL where the turn is masked)."""
    said = turns.select(
        F.col(conv_col).alias("_conv"),
        F.coalesce(F.col(turn_col).cast("long"), F.lit(FIRST)).alias("at"),
        F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("said"),
    )
    sides = pairs.select(
        "_pair",
        F.explode(F.array(F.struct(F.lit(1).alias("sign"), F.col("chosen_id").alias("conv")),
                          F.struct(F.lit(-1).alias("sign"), F.col("rejected_id").alias("conv")))).alias("s"),
    ).select("_pair", "s.sign", F.col("s.conv").alias("_conv"))
    rows = sides.join(said, "_conv")
    # turn by turn, what only one side says leaves a difference in the number or the hashes of its rows
    signed = lambda h: F.sum(h.cast("decimal(20,0)") * F.col("sign"))
    turn = rows.groupBy("_pair", "at").agg(
        F.sum("sign").alias("n"), signed(F.xxhash64("role", "said")).alias("x"), signed(F.hash("role", "said")).alias("y")
    )
    cut = turn.where("n <> 0 OR x <> 0 OR y <> 0").groupBy("_pair").agg(F.min("at").alias("cut"))
    side = F.when(F.col("sign") == 1, "chosen").otherwise("rejected")
    shared = F.col("cut").isNull() | (F.col("at") < F.col("cut"))
    parts = rows.join(cut, "_pair", "left").withColumn("part", F.when(shared, "prompt").otherwise(side))
    parts = parts.where((F.col("part") != "prompt") | (F.col("sign") == 1))
    head = F.concat(F.lit(OPEN), "role", F.lit("\n"))
    parts = parts.withColumn("piece", F.concat(head, "said", F.lit(CLOSE + "\n")))
    order = W.partitionBy("_pair", "part").orderBy("at", "role", "said")
    size = F.char_length("piece").cast("long")
    before = F.coalesce(F.sum(size).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))
    trained = (F.col("part") != "prompt") & (F.col("role") == "assistant")
    return parts.select(
        "_pair", "part", F.row_number().over(order).alias("place"), "piece",
        F.when(trained, before + F.char_length(head)).alias("start"),
        F.when(trained, before + size - 1).alias("stop"),
    )


def preference_records(
    turns: DataFrame,
    pairs: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per distinct pair (pair_id, chosen_id, rejected_id): these, prompt, prompt_turns, chosen,
    rejected (rendered texts), chosen_train and rejected_train: arrays of (start, stop) of the characters to
    train on, each an assistant's words and their closing mark.

    Turns are ordered by number (NULL first), then role, then text; turns of one number are compared as a
    bag, so repeated rows count as often as they occur. A NULL role is "unknown", a NULL text empty. Turns of
    a NULL conversation belong to no pair. A side that is missing or has no turns gives an empty completion;
    equal conversations are all prompt. Other columns are ignored. A record is as large as its two
    conversations; segments() gives the same turn by turn."""
    ready(turns.sparkSession)
    wanted = pairs.select("pair_id", "chosen_id", "rejected_id").distinct()
    wanted = stored(wanted.withColumn("_pair", F.monotonically_increasing_id()), "pairs")
    rows = segments(turns, wanted, conv_col, turn_col, role_col, text_col)

    def joined(part: str) -> Column:
        mine = F.collect_list(F.when(F.col("part") == part, F.struct("place", "piece")))
        return F.array_join(F.transform(F.array_sort(mine), lambda x: x["piece"]), "")

    def spans(part: str) -> Column:
        mine = (F.col("part") == part) & F.col("start").isNotNull()
        return F.array_sort(F.collect_list(F.when(mine, F.struct("start", "stop"))))

    made = rows.groupBy("_pair").agg(
        joined("prompt").alias("prompt"),
        F.count(F.when(F.col("part") == "prompt", 1)).alias("prompt_turns"),
        joined("chosen").alias("chosen"),
        joined("rejected").alias("rejected"),
        spans("chosen").alias("chosen_train"),
        spans("rejected").alias("rejected_train"),
    )
    out = wanted.join(made, "_pair", "left").drop("_pair")
    return out.fillna({"prompt": "", "prompt_turns": 0, "chosen": "", "rejected": ""}).withColumns(
        {c: F.coalesce(c, F.array().cast("array<struct<start:bigint,stop:bigint>>")) for c in ("chosen_train", "rejected_train")}
    )


def span_text(spans: str) -> Column:
    """start:stop of each span, comma-joined."""
    one = lambda s: F.concat_ws(":", s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
