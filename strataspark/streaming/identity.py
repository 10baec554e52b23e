"""Identities of observations over a stream: keyed state, event-time timers, late rows and restarts."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.sequences import tie_batch

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"  # the store that keyed state with timers asks for


class Identities(StatefulProcessor):
    """Holds, for each key, the observations of batches that are still open and the tracks of the last ``most`` batches.

    A batch is ``length_ms`` of event time. A timer at its end fires once the watermark has passed it; then its observations are tied to tracks, in the order of batches however rows arrived, and put out. Rows of
    a batch that has been closed are late and dropped. Another timer removes the tracks of a key that has fallen silent, so state holds live keys only.
    """

    def __init__(self, key: str, kind: str, length_ms: int, gate: float, most: int) -> None:
        self.key, self.kind, self.length, self.gate, self.most = key, kind, length_ms, gate, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "batch long, id long", "value double")
        self.tracks = handle.getMapState("tracks", "track_id long", "value double, batch long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        ends, known = set(), set(self.handle.listTimers())
        for pdf in rows:
            for batch, i, value in zip(pdf["batch"].tolist(), pdf["id"].tolist(), pdf["value"].tolist()):
                if (batch + 1) * self.length > timerValues.getCurrentWatermarkInMs():
                    self.open.updateValue((batch, i), (value,))
                    ends.add((batch + 1) * self.length)
        for at in ends - known:
            self.handle.registerTimer(at)
        return iter([])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        over = expiredTimerInfo.getExpiryTimeInMs()
        due: dict[int, list[tuple[int, float]]] = {}
        for (batch, i), (value,) in list(self.open.iterator()):
            if (batch + 1) * self.length <= over:
                due.setdefault(batch, []).append((i, value))
                self.open.removeKey((batch, i))
        held = {t: (value, batch) for (t,), (value, batch) in list(self.tracks.iterator())}
        live, out = dict(held), []
        for batch in sorted(due):
            ids, values = zip(*sorted(due[batch]))
            live, named = tie_batch(live, batch, list(ids), list(values), self.gate, self.most)
            out += [(key[0], batch, i, t) for i, t in zip(ids, named)]
        now = over // self.length - 1
        live = {t: s for t, s in live.items() if now - s[1] <= self.most}
        for t in held.keys() - live.keys():
            self.tracks.removeKey((t,))
        for t, state in live.items():
            if held.get(t) != state:
                self.tracks.updateValue((t,), state)
        if due and live:
            self.handle.registerTimer((max(s[1] for s in live.values()) + self.most + 2) * self.length)  # by then all these tracks have ended
        if out:
            yield pd.DataFrame(out, columns=[self.key, "batch", "id", "track_id"])

    def close(self) -> None:
        pass


def identity_stream(obs: DataFrame, key: str, at: str, value: str, length_ms: int, late: str, gate: float, most: int) -> DataFrame:
    """(key, batch, id, track_id) of a stream (key, ``at``, id, value): ``sequences.identities`` over batches of ``length_ms`` of event time, each once the watermark, ``late`` behind the newest row, has passed
    its end. Rows with a null take no part."""
    kind = dict(obs.dtypes)[key]
    rows = obs.select(key, F.col(at).cast("timestamp").alias("at"), F.col("id").cast("long").alias("id"), F.col(value).cast("double").alias("value")).dropna()
    rows = rows.withWatermark("at", late).withColumn("batch", F.floor(F.unix_millis("at") / length_ms).cast("long"))
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=Identities(key, kind, length_ms, gate, most), outputStructType=f"{key} {kind}, batch long, id long, track_id long", outputMode="append", timeMode="eventTime")


@contextlib.contextmanager
def keyed_store(spark: SparkSession) -> Iterator[None]:
    """For the time of a run, state is kept in the store that timers ask for."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STORE)
        else:
            spark.conf.set(STORE, before)


def tie_available(spark: SparkSession, folder: str, schema, out: str, state: str, files: int = 100, **how) -> None:
    """Tie the rows of files that are new in ``folder`` since the last call, at most ``files`` in a micro-batch, and append what has been closed to the table ``out``; tracks, open batches, timers and
    the watermark go on from ``state``."""
    with keyed_store(spark):
        tied = identity_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder), **how)
        tied.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
