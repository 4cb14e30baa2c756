"""The same parse, rules and windows over a stream of observations."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from factloom.operators import evolve, ingest
from factloom.plans.connector import Connector, Signature
from factloom.sources import store
from factloom.sources.shared import scratch
from factloom.streaming import timed

_OUT = "seq long, actor string, system_timestamp long, window_count long, fired boolean"


def behavior_stream(facts: DataFrame, signature: Signature, lateness: str | None = None) -> DataFrame:
    """(seq, actor, system_timestamp, window_count, fired) of the trigger facts of a stream.

    The state of an actor is the timestamps inside its window, pruned on every visit; actors are dealt to shares by
    hash, whose states are one value each. Arrival order within a micro-batch is (system_timestamp, seq). With
    ``lateness``, facts that are later than that behind the newest are left out, and the state of an actor goes when
    its window has passed.
    """
    span, threshold = signature.window_secs * 1_000_000, signature.threshold

    def goes(times: Sequence[int]) -> int:
        return (int(max(times)) + span) // 1000 + 1

    def keep(kept: dict, state: GroupState) -> None:
        state.update(timed.packed(kept))
        if lateness is not None:
            state.setTimeoutTimestamp(max(min(map(goes, kept.values())), state.getCurrentWatermarkMs() + 1))

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept: dict[str, Sequence[int]] = timed.unpacked(state.get if state.exists else None)
        if state.hasTimedOut:
            mark = state.getCurrentWatermarkMs()
            left = {a: t for a, t in kept.items() if goes(t) > mark}
            if left:
                keep(left, state)
            else:
                state.remove()
            return
        rows = pd.concat(list(batches)).sort_values(["actor", "system_timestamp", "seq"])
        counts, who = [], None
        for actor, t in zip(rows["actor"].tolist(), rows["system_timestamp"].tolist(), strict=True):
            if actor != who:
                who, times = actor, deque(int(x) for x in kept.get(actor, ()))
                kept[actor] = times
            times.append(t)
            while times[0] < t - span:
                times.popleft()
            counts.append(len(times))
        keep(kept, state)
        rows["window_count"] = counts
        rows["fired"] = rows["window_count"] >= threshold
        yield rows[["seq", "actor", "system_timestamp", "window_count", "fired"]]

    trigger = facts.filter(facts["action"] == signature.action).select("seq", "actor", "system_timestamp").fillna({"actor": "unknown"})
    if lateness is None:
        return timed.dealt(trigger).groupBy("share").applyInPandasWithState(run, _OUT, timed.STATE, "append", GroupStateTimeout.NoTimeout)
    marked = trigger.withColumn("at", F.timestamp_micros("system_timestamp")).withWatermark("at", lateness)
    return timed.dealt(marked).groupBy("share").applyInPandasWithState(run, _OUT, timed.STATE, "append", GroupStateTimeout.EventTimeTimeout)


def seal_to(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink: a batch's facts are appended to the store at path, once however often retried.

    A batch is computed once and written, since an append reads its facts twice.
    """
    return lambda batch, batch_id: store.append(scratch(batch, "batch"), path, batch_id)


def ingest_to(path: str, connector: Connector) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink of observations: facts to the store, drift lines to ``quarantine`` as text, and
    (batch_id, sealed, quarantined) to ``counters``; a retried batch takes its own place.

    Lines are parsed once and written; what is counted is observed on the way, what is sealed or kept comes from there.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation("drift")
        counted = ingest.parse(batch, connector).observe(seen, F.count_if("parsed").alias("sealed"), F.count_if(~F.col("parsed")).alias("quarantined"))
        parsed = scratch(counted, "parsed")
        store.append(ingest.facts_of(parsed, connector), path, batch_id)
        ingest.quarantine(parsed).select("raw").write.mode("overwrite").text(f"{path}/quarantine/batch={batch_id}")
        n = seen.get
        row = batch.sparkSession.createDataFrame([(n["sealed"], n["quarantined"], batch_id)], "sealed long, quarantined long, batch_id long")
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/counters/batch={batch_id}")

    return write


def clusters_to(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink of drift lines: the clusters kept at path grow by each batch, once however often retried."""
    return lambda batch, batch_id: evolve.absorb(batch.select("seq", "raw"), path, batch_id)
