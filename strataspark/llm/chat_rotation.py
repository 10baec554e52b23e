"""Chat formatting by multi-party perspective rotation (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

START, END = "<|im_start|>", "<|im_end|>"
PART_TURNS = 512
SPREAD = 32


def speaker(role: Column) -> Column:
    """A role as a name fit for a header: other characters become ``_``; none at all is ``unknown``."""
    name = F.regexp_replace(F.coalesce(role, F.lit("")), "[^A-Za-z0-9_-]", "_")
    return F.when(name == "", "unknown").otherwise(name)


def parts_by_count(said: DataFrame, part_turns: int) -> DataFrame:
    """(conv_id, part, m): the rows of each dialogue in its order (turn, who, what), cut every ``part_turns`` rows.

    Equal rows are counted first. The others are dealt by ranges of the order (of texts the first letters; a window sorts the rest), so
    no task holds a dialogue; the place of a row is a running count within its range plus its dialogue's totals in the ranges before.
    """
    order = ["conv_id", "turn", "who", "what"]
    rows = said.groupBy(*order).agg(F.count(F.lit(1)).alias("n")).repartitionByRange("conv_id", "turn", "who", F.substring("what", 1, 200))
    rows = cut(rows.withColumn("range", F.spark_partition_id()))
    totals = rows.groupBy("range", "conv_id").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(F.col("range").alias("r"), F.col("conv_id").alias("c"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    w = Window.partitionBy("range", "conv_id").orderBy("turn", "who", "what").rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.withColumn("upto", F.sum("n").over(w)).join(before, (F.col("range") == F.col("r")) & F.col("conv_id").eqNullSafe(F.col("c")))
              .withColumn("stop", F.col("before") + F.col("upto")).withColumn("start", F.col("stop") - F.col("n")))
    first, last = F.floor(F.col("start") / part_turns), F.floor((F.col("stop") - 1) / part_turns)
    dealt = placed.withColumn("part", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    copies = F.least("stop", (F.col("part") + 1) * part_turns) - F.greatest("start", F.col("part") * part_turns)
    m = F.sort_array(F.collect_list(F.struct("turn", "who", "what", copies.cast("int").alias("copies"))))
    plain = F.flatten(F.transform(m, lambda x: F.array_repeat(F.struct(x["turn"].alias("turn"), x["who"].alias("who"), x["what"].alias("what")), x["copies"])))
    return dealt.groupBy("conv_id", "part").agg(plain.alias("m"))


def rotate_perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text",
                        system: str = "system", part_turns: int = PART_TURNS) -> DataFrame:
    """Render each dialogue once for each participant.

    The chosen speaker's turns are the assistant's, everyone else is a named user and
    ``system`` turns stay system turns (``system`` is no participant). ``mask`` holds
    the spans (code points, end exclusive) to train on: what the chosen speaker says,
    its end mark included. Markers inside texts are defused (``<|`` becomes ``< |``).

    Returns conv_id, perspective, part, n_turns, n_masked, text, mask
    (array of struct<start, end>). Turns are ordered by (turn, speaker, text), nulls
    first; repeated rows stay. A null role speaks as ``unknown``, a null text is empty,
    null conversation ids form one dialogue. Dialogues with only system turns have no rendering.
    Scale: a dialogue of any length is rendered in parts of ``part_turns`` rows in that order, numbered from 0, whatever its turn numbers
    are; those of longer ones are cut without gathering them (see ``parts_by_count``).
    """
    said = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"), speaker(F.col(role_col)).alias("who"),
        F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("<|"), F.lit("< |")).alias("what"))
    people = (said.filter(F.col("who") != system).select("conv_id", "who").distinct()
              .select(F.col("conv_id").alias("c"), F.col("who").alias("perspective")))
    rows = said.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    large = cut(rows.filter(F.col("n") > part_turns).select(F.col("conv_id").alias("long_id")))
    any_large = large.limit(1).count() > 0
    is_large = lambda c: F.col(c).eqNullSafe(F.col("long_id"))
    short = said.join(large, is_large("conv_id"), "left_anti") if any_large else said
    parts = short.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "who", "what"))).alias("m")).withColumn("part", F.lit(0).cast("long"))
    pairs = parts.join(people, F.col("conv_id").eqNullSafe(F.col("c"))).select("conv_id", "part", "m", "perspective")
    if any_large:  # the parts of a long dialogue meet its people in many tasks
        cuts = parts_by_count(said.join(large, is_large("conv_id"), "left_semi"), part_turns).withColumn("salt", F.pmod("part", F.lit(SPREAD)))
        spread = people.join(large, is_large("c"), "left_semi").withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
        met = cuts.join(spread, (F.col("salt") == F.col("s")) & F.col("conv_id").eqNullSafe(F.col("c")))
        pairs = pairs.unionByName(met.select("conv_id", "part", "m", "perspective"))
    head = lambda m: F.concat(F.lit(START), F.when(m["who"] == F.col("perspective"), F.lit("assistant"))
                              .when(m["who"] == system, F.lit(system))
                              .otherwise(F.concat(F.lit("user name="), m["who"])), F.lit("\n"))
    pieces = pairs.select(
        "conv_id", "perspective", "part",
        F.transform("m", lambda m: F.struct(
            head(m).alias("head"), F.concat(m["what"], F.lit(END)).alias("body"),
            (m["who"] == F.col("perspective")).alias("own"))).alias("p"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["head"])
        stop = start + F.length(p["body"])
        span = F.struct(start.alias("start"), stop.alias("end"))
        return F.struct((stop + 1).alias("at"),
                        F.when(p["own"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    done = pieces.select(
        "conv_id", "perspective", "part", F.size("p").cast("long").alias("n_turns"),
        F.array_join(F.transform("p", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("text"),
        F.aggregate("p", zero, add, lambda acc: acc["spans"]).alias("mask"))
    size = F.aggregate("mask", F.lit(0).cast("long"), lambda s, x: s + (x["end"] - x["start"]))
    return done.select("conv_id", "perspective", "part", "n_turns", size.alias("n_masked"), "text", "mask")
