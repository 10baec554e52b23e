"""Freezing releases of a registry under a digest of their ids."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

c = F.col
BLOCK_IDS = 4096
SHOWN = 20  # blocking ids that a refusal names


def set_digests(ids: DataFrame) -> DataFrame:
    """(release, asset_set_sha256) of (release, id): SHA-256 of a release's ids, in order of their bytes and joined by line feeds.

    Ids are dealt by ranges of release and id and put together to blocks there; a task then reads the blocks of a release in order. A digest is sequential, so that
    task sees all of a release's ids, but one block at a time.
    """
    kind = dict(ids.dtypes)["release"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            releases, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out, start = [], 0
            for i in range(1, len(names) + 1):
                if i == len(names) or releases[i] != releases[start] or i - start == BLOCK_IDS:
                    out.append((releases[start], names[start], "\n".join(names[start:i])))
                    start = i
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((batch.schema.field(0).type, pa.string(), pa.string()))], names=["release", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release, state, kind_of = None, None, None
        row = lambda done: pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((kind_of, pa.string()))], names=["release", "asset_set_sha256"])
        for batch in batches:
            kind_of, done = batch.schema.field(0).type, []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if state is None or name != release:
                    if state is not None:
                        done.append((release, state.hexdigest()))
                    release, state = name, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(text.encode())
            yield row(done)
        if state is not None:
            yield row([(release, state.hexdigest())])

    rows = ids.select("release", c("id").cast("string").alias("id")).dropna().repartitionByRange("release", "id").sortWithinPartitions("release", "id")
    joined = rows.mapInArrow(blocks, f"release {kind}, first string, ids string")
    return joined.repartition("release").sortWithinPartitions("release", "first").mapInArrow(digests, f"release {kind}, asset_set_sha256 string")


def freeze_releases(releases: DataFrame, assets: DataFrame) -> DataFrame:
    """(release, state, n_assets, n_blocking, blocking, asset_set_sha256) of releases (release) and assets (release, id, status).

    A release is ``frozen``, under the digest of its ids, if it has assets and all are accepted; without assets it is ``empty``; an id that comes twice is ``invalid``; else it is
    ``blocked``, and the smallest ids that block it are named. A missing status or id blocks.
    """
    held = assets.filter("release is not null")
    named = F.coalesce(c("id").cast("string"), F.lit(""))
    waits = ~F.coalesce((c("status") == "accepted") & c("id").isNotNull(), F.lit(False))
    sums = held.groupBy("release").agg(F.count(F.lit(1)).alias("n_assets"), F.count(F.when(waits, 1)).alias("n_blocking"))
    twice = held.filter("id is not null").groupBy("release", "id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("release").distinct().withColumn("twice", F.lit(True))
    first = held.filter(waits).select("release", named.alias("id"))
    # the smallest ids of many: each task keeps its own first, so that a release without any accepted asset is not gathered
    ranked = first.groupBy("release", F.pmod(F.xxhash64("id"), F.lit(64)).alias("lot")).agg(F.slice(F.sort_array(F.collect_set("id")), 1, SHOWN).alias("ids"))
    shown = ranked.groupBy("release").agg(F.slice(F.array_distinct(F.sort_array(F.flatten(F.collect_list("ids")))), 1, SHOWN).alias("ids"))
    state = F.when(F.coalesce("n_assets", F.lit(0)) == 0, "empty").when(c("twice"), "invalid").when(c("n_blocking") > 0, "blocked").otherwise("frozen")
    out = releases.select("release").dropna().distinct().join(sums, "release", "left").join(twice, "release", "left").join(shown, "release", "left").withColumn("state", state)
    whole = set_digests(held.join(out.filter("state = 'frozen'").select("release"), "release", "left_semi"))
    zero = lambda v: F.coalesce(v, F.lit(0).cast("long")).alias(v)
    out = out.join(whole, "release", "left")
    return out.select("release", "state", zero("n_assets"), zero("n_blocking"), F.coalesce(F.array_join("ids", ","), F.lit("")).alias("blocking"), "asset_set_sha256")
