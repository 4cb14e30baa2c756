"""Windows over a stream with timed state: counts, late facts kept aside, and actors that fell silent.

The state of an actor is the list of its facts' times inside the window. It goes by an event-time timer once
the watermark has passed the last of them by the window's length, which is when no fact that is still on time
could count it. Actors are dealt to shares by hash, and a share's states are one value with one timer, that of the
actor which falls silent first: state is asked for once a share and batch, whatever the number of actors. Facts that are later than the watermark aren't counted and aren't lost: they come out as rows of
their own. For that the column that carries the watermark is left behind before the rows are grouped, since
the engine silently drops late rows of a state operator that can see it; the watermark itself goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from factloom.plans.connector import Signature

COUNTED, LATE, EVICTED = "counted", "late", "evicted"
_OUT = "kind string, seq long, actor string, system_timestamp long, window_count long, fired boolean"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


#: Actors share their states by hash in so many values.
SHARES = 1024
STATE = "actors array<string>, sizes array<int>, times array<long>"
_COLUMNS = ["kind", "seq", "actor", "system_timestamp", "window_count", "fired"]


def dealt(facts: DataFrame) -> DataFrame:
    """facts with ``share``, that of their actor."""
    return facts.withColumn("share", F.pmod(F.xxhash64("actor"), F.lit(SHARES)))


def unpacked(state: tuple | None) -> dict[str, np.ndarray]:
    """The times of each actor of a share, as they were packed."""
    if state is None:
        return {}
    ends = np.cumsum(np.array(state[1], dtype=np.int64))
    return dict(zip(state[0], np.split(np.array(state[2], dtype=np.int64), ends[:-1]), strict=True))


def packed(kept: dict) -> tuple[list[str], list[int], list[int]]:
    return list(kept), [len(t) for t in kept.values()], [int(t) for times in kept.values() for t in times]


class _Windows(StatefulProcessor):
    def __init__(self, window_secs: int, threshold: int) -> None:
        self.span, self.threshold = window_secs * 1_000_000, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("windows", STATE)

    def _keep(self, kept: dict[str, np.ndarray]) -> None:
        """Write the share's states, and set a timer to the first of them that goes."""
        if not kept:
            self.state.clear()
            return
        self.state.update(packed(kept))
        self.handle.registerTimer(min(self._goes(t) for t in kept.values()))

    def _goes(self, times: np.ndarray) -> int:
        return (int(times[-1]) + self.span) // 1000 + 1

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        mark = timerValues.getCurrentWatermarkInMs()
        came = pd.concat(list(rows)).sort_values(["actor", "system_timestamp", "seq"])
        late = came["system_timestamp"] // 1000 < mark
        if late.any():
            yield came[late].assign(kind=LATE, window_count=None, fired=None)[_COLUMNS]
        came = came[~late]
        if not len(came):
            return
        kept = unpacked(self.state.get())
        who, times = came["actor"].to_numpy(), came["system_timestamp"].to_numpy()
        starts = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        counts = []
        for actor, new in zip(who[starts], np.split(times, starts[1:]), strict=True):
            old = kept.get(actor, new[:0])
            old = old[np.searchsorted(old, mark * 1000 - self.span) :]
            before = np.searchsorted(old, new, "right") - np.searchsorted(old, new - self.span)
            counts.append(before + np.arange(1, len(new) + 1) - np.searchsorted(new, new - self.span))
            kept[actor] = np.sort(np.concatenate([old, new]), kind="stable")
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
        self._keep(kept)
        n = np.concatenate(counts)
        yield came.assign(kind=COUNTED, window_count=n, fired=n >= self.threshold)[_COLUMNS]

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        mark, kept = timerValues.getCurrentWatermarkInMs(), unpacked(self.state.get())
        gone = {a: int(t[-1]) for a, t in kept.items() if self._goes(t) <= mark}
        if gone:
            self._keep({a: t for a, t in kept.items() if a not in gone})
            yield pd.DataFrame({"kind": EVICTED, "seq": None, "actor": list(gone), "system_timestamp": list(gone.values()), "window_count": None, "fired": None})

    def close(self) -> None:
        pass


@contextmanager
def timers(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB, which timed state needs; the session is left as it was."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def windows(facts: DataFrame, signature: Signature, lateness: str) -> DataFrame:
    """(kind, seq, actor, system_timestamp, window_count, fired) of a stream's facts with the signature's action.

    ``counted``: the facts of the actor that have come so far and lie within the window up to this one; those of
    one batch come in order of (system_timestamp, seq). ``late``: facts over lateness behind the newest of earlier
    batches. ``evicted``: an actor whose state went, with the time of its last fact.
    """
    mine = facts.filter(facts["action"] == signature.action).select("seq", "actor", "system_timestamp").fillna({"actor": "unknown"})
    marked = mine.withColumn("__at", F.timestamp_micros("system_timestamp")).withWatermark("__at", lateness).select("seq", "actor", "system_timestamp")
    return dealt(marked).groupBy("share").transformWithStateInPandas(_Windows(signature.window_secs, signature.threshold), _OUT, "Append", "EventTime")


def kinds_to(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink: rows by kind in one write; a retried batch takes its own place."""
    return lambda batch, batch_id: batch.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/batch={batch_id}")


def of_kind(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """What kinds_to has written of a kind, with ``batch``."""
    return spark.read.schema(f"{_OUT}, batch long").parquet(path).filter(F.col("kind") == kind).drop("kind")


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """(batch, late): how many facts of each batch came too late."""
    return of_kind(spark, path, LATE).groupBy("batch").agg(F.count("*").alias("late"))
