"""Walks along relation edges by pointer doubling."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import cut, discard

c = F.col


def chain_walks(nodes: DataFrame, edges: DataFrame, most: float) -> DataFrame:
    """(node, state, hops, last, first_failing_hop): the walk from every node along edges (a, b, error) to where it stops.

    ``nodes`` are (node, terminal). A walk is ``complete`` at a terminal node, ``broken`` where no edge leads on or the next node does not exist, ``branching`` where several edges lead on (the walk ends before
    them) and ``cyclic`` if it never stops, with neither hops nor last node. The first hop with an error over ``most`` (or none) is named, 1 being the edge out of the node itself; in a cycle too. Each round doubles the hops of all
    walks at once, so rounds grow with the logarithm of the longest walk; walks that have stopped take no part.
    """
    out = edges.groupBy(c("a").alias("node")).agg(F.count(F.lit(1)).alias("ways"), F.min("b").alias("next"), F.min(F.coalesce(c("error") <= most, F.lit(False)).cast("int")).alias("held"))
    known = nodes.groupBy("node").agg(F.max(F.coalesce("terminal", F.lit(False))).alias("terminal"))
    step = known.join(out, "node", "left").join(known.select(c("node").alias("next"), F.lit(True).alias("there")), "next", "left")
    stop = (F.when(c("terminal"), "complete").when(F.coalesce("ways", F.lit(0)) > 1, "branching").when(c("there").isNull(), "broken"))
    first = cut(step.select("node", stop.alias("stop"), "next", "held"))
    onward = first.select(c("node").alias("at"), c("stop").alias("ended"))
    go = first.filter("stop is null").select("node", c("next").alias("at"), F.lit(1).cast("long").alias("hops"), F.when(c("held") == 0, F.lit(1).cast("long")).alias("failing")).join(onward, "at")
    still = first.filter("stop is not null").select(c("node").alias("at"), "node", F.lit(0).cast("long").alias("hops"), F.lit(None).cast("long").alias("failing"), c("stop").alias("ended"))
    walks = cut(go.unionByName(still))
    moving = c("ended").isNull()
    for _ in range(math.ceil(math.log2(first.count() + 1)) + 1):  # by then every walk that stops has stopped
        if not walks.filter(moving).limit(1).count():
            break
        ahead = walks.select(c("node").alias("at"), c("at").alias("to"), c("hops").alias("more"), c("failing").alias("later"), c("ended").alias("then"))
        grown = walks.filter(moving).join(ahead, "at").select("node", c("to").alias("at"), (c("hops") + c("more")).alias("hops"), F.coalesce("failing", c("hops") + c("later")).alias("failing"), c("then").alias("ended"))
        before, walks = walks, cut(grown.unionByName(walks.filter(~moving).select("node", "at", "hops", "failing", "ended")))
        discard(before)
    discard(first)
    return walks.select("node", F.coalesce("ended", F.lit("cyclic")).alias("state"), F.when(~moving, c("hops")).alias("hops"), F.when(~moving, c("at")).alias("last"), c("failing").alias("first_failing_hop"))
