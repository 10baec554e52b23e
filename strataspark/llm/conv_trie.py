"""The prefix trie of conversations by smallest-member ownership.

A node is a distinct sequence of first turns; its members are the conversations that start with it. The member with the smallest id owns the node,
and as it then owns every deeper node of its own as well, a conversation owns a suffix of its path. A node is named by depth and owner. Sums over a node's
subtree need no walk: every turn of a member at or below the node counts once for each member that has it and is taken off once where its node is owned, which
leaves, of each member, the turns above its own suffix. One group-by over (node, member) rows adds these up with the flags of leaves and of children.

Sequences are told apart by their depth and running sums of 128 bits of hashes of position and turn (SHA-256 of role and text), so that texts are not
shuffled, and no task holds a conversation, a node's members or a common first turn: running sums carry over from range to range, and keys with a large share
of the rows are met by broadcast. A digest over a node's ends is sequential by nature; a task streams the ids of one node, put together to blocks before.

Null roles and texts are empty; rows without conv_id belong to no conversation; turns are in order of turn (null first), then role, then text, and repeated
rows are turns of their own. Empty tables give no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard
from .keyed import by_key, running_by_key

BLOCK_IDS = 4096
LANES = ("k0", "k1", "k2", "k3")


def positions(conversations: DataFrame) -> DataFrame:
    """A written table (conv_id, position from 1, digest, n): the turns in order, ``digest`` of role and text, n code points. Only rows that share their turn
    number carry role and text along, to be put in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    counted = rows.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("same"))
    tied = cut(counted.filter("same > 1").withColumn("has", F.col("turn").isNotNull()).withColumn("turn", F.coalesce("turn", F.lit(0).cast("long"))))
    rows, order = rows.withColumn("digest", digest).withColumn("n", F.length("text").cast("long")), [F.col("turn").asc_nulls_first()]
    if tied.count():
        keys = ["conv_id", "__turn", "has"]
        named = rows.withColumn("has", F.col("turn").isNotNull()).withColumn("__turn", F.coalesce("turn", F.lit(0).cast("long")))
        ranked = by_key(named, tied.withColumnRenamed("turn", "__turn"), keys, "same")
        single = named.drop("role", "text").join(tied.select("conv_id", F.col("turn").alias("__turn"), "has"), keys, "left_anti")
        rows = ranked.unionByName(single, allowMissingColumns=True)
        order += [F.col("role"), F.col("text")]
        rows = rows.select("conv_id", "turn", "role", "text", "digest", "n")
    else:
        rows = rows.select("conv_id", "turn", "digest", "n")
    out = running_by_key(rows, "conv_id", order, {"position": F.lit(1).cast("long")})
    discard(tied)
    return out.select("conv_id", "position", "digest", "n")


def rebuilt(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, ids) of conversations whose first h turns are those of conversation ``id - id % every`` (all if it has fewer, none if it is absent), h being
    crc32 of the decimal id modulo ``most``, followed by their own after the first h."""
    own = F.col("conv_id")
    base, h = own - own % every, F.crc32(own.cast("string").cast("binary")) % most
    ids = cut(turns.filter("position = 1").select("conv_id"))
    heads = cut(turns.filter((own % every == 0) & (F.col("position") < most)).select(own.alias("base"), "position", "digest", "n"))
    sizes = turns.groupBy(base.alias("base")).agg(F.count(F.lit(1)).alias("met"), F.coalesce(F.max(F.when((own % every == 0) & (F.col("position") < most), F.col("position"))), F.lit(0)).alias("held"))
    first = ids.withColumn("base", base).join(heads, "base").filter(F.col("position") <= h).select("conv_id", F.col("position").alias("depth"), "digest", "n")
    later = by_key(turns.filter(F.col("position") > h).withColumn("base", base), cut(sizes), ["base"], "met")
    later = later.select("conv_id", (F.col("position") - h + F.least(h, F.col("held"))).alias("depth"), "digest", "n")
    return first.unionByName(later), ids


def trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """Nodes (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of the conversations ``ids`` (conv_id, each once), whose turns are
    (conv_id, depth from 1 without gaps, digest, n)."""
    roots = ids.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("n"))
    at = [F.when(F.col("depth") > 0, F.xxhash64(F.lit(i), "depth", "digest")).otherwise(F.lit(0).cast("long")) for i in (1, 2)]
    lanes = [part for x in at for part in (x.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(x, 32))]
    paths = running_by_key(turns.unionByName(roots), "conv_id", [F.col("depth")], dict(zip(LANES, lanes)) | {"total": F.col("n")})
    nodes = cut(paths.groupBy("depth", *LANES).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("owner")).withColumn("met", F.col("n_convs")))
    owned = cut(by_key(paths, nodes, ["depth", *LANES], "met").select("conv_id", "depth", "owner", "n", "total", "n_convs"))
    mine = F.col("owner") == F.col("conv_id")
    ends = owned.groupBy("conv_id").agg(
        F.max("depth").alias("last"), F.min(F.when(mine, F.col("depth"))).alias("since"), F.coalesce(F.max(F.when(~mine, F.col("total"))), F.lit(0)).alias("shared"),
        F.max_by(F.when(~mine, F.col("owner")), F.when(~mine, F.col("depth"))).alias("branch"), F.max_by("owner", "depth").alias("end_owner"), F.max_by("n_convs", "depth").alias("end_convs"))
    ends = cut(ends)
    stops = ends.groupBy(F.col("end_owner").alias("conv_id"), F.col("last")).agg(F.count(F.lit(1)).alias("n_ends"))
    known = ends.join(stops, ["conv_id", "last"], "left").withColumn("leaf", F.coalesce(F.col("end_convs") == F.col("n_ends"), F.lit(False)) & (F.col("end_owner") == F.col("conv_id")))
    known = cut(known.select("conv_id", "last", "since", "shared", "branch", "leaf", (F.col("last") + 1).alias("met")))
    rows = by_key(owned, known, ["conv_id"], "met")
    depth, since = F.col("depth"), F.col("since")
    parent = F.when(mine & (depth > 0), F.when(depth > since, F.col("conv_id")).otherwise(F.col("branch")))
    sums = rows.groupBy(F.col("owner").alias("conv_id"), "depth").agg(
        F.max(parent).alias("parent_conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count(F.when((F.col("last") > depth) & (since <= depth + 1), 1)).alias("n_children"),
        F.count(F.when(F.col("leaf"), 1)).alias("n_leaves"), F.sum(F.when(mine, F.lit(0)).otherwise(F.col("shared") - F.col("total") + F.col("n"))).alias("saved_tokens"))
    hashes = end_digests(ends.select(F.col("end_owner").alias("conv_id"), F.col("last").alias("depth"), F.col("conv_id").alias("member")))
    out = sums.join(hashes, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def end_digests(members: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of (conv_id, depth, member): SHA-256 of a node's members, in order and joined by commas."""
    order = ["conv_id", "depth", "member"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, out = None, [], []
        for batch in batches:
            for c, d, m in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if node != (c, d) or len(ids) == BLOCK_IDS:
                    if ids:
                        out.append((*node, ids[0], ",".join(map(str, ids))))
                    node, ids = (c, d), []
                ids.append(m)
            if len(out) > BLOCK_IDS:
                yield packed(out)
                out = []
        if ids:
            out.append((*node, ids[0], ",".join(map(str, ids))))
        if out:
            yield packed(out)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["conv_id", "depth", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for c, d, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                if node == (c, d):
                    state.update(b",")
                else:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (c, d), hashlib.sha256()
                state.update(ids.encode())
            yield named(out)
        if node is not None:
            yield named([(*node, state.hexdigest())])

    def named(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["conv_id", "depth", "ends_sha256"])

    joined = members.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(blocks, "conv_id long, depth long, first long, ids string")
    return joined.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first").mapInArrow(digests, "conv_id long, depth long, ends_sha256 string")
