"""State machines over event streams: runs that may hang, review items that are approved, rejected and edited.

Events are kept until the watermark has passed them and are then applied in the order of their time, so the result is
that of a fold over all events in order, whatever the order in which they came; repeated events count once, and events
from before the watermark come too late. Timers end states that nothing has touched for too long.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lexledger.streaming.replay import partitions_for, settings

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Machine:
    """moves: (state, event) -> state; other events change nothing. touches: (state, event) that only show that the
    state is alive. timeouts: state -> (seconds without a move or touch, the state that it ends in)."""

    initial: str
    moves: dict[tuple[str, str], str]
    touches: frozenset[tuple[str, str]] = frozenset()
    timeouts: dict[str, tuple[int, str]] = field(default_factory=dict)

    def deadline(self, state: str, since: int) -> int | None:
        """When a state ends by itself, in microseconds."""
        return since + 1_000_000 * self.timeouts[state][0] if state in self.timeouts else None


#: A run is queued, started and ends; a new attempt can be queued whenever none is running.
RUNS = Machine(
    "new", {(s, "queue"): "queued" for s in ("new", "succeeded", "failed")} | {("queued", "start"): "running", ("running", "succeed"): "succeeded", ("running", "fail"): "failed"},
    frozenset({("running", "progress")}), {"running": (12 * 3600, "failed")},
)
#: A review item waits until somebody decides; an edit makes it wait again, whatever was decided.
REVIEWS = Machine("pending", {("pending", "approve"): "approved", ("pending", "reject"): "rejected"} | {(s, "edit"): "pending" for s in ("pending", "approved", "rejected")})

EVENTS = "key long, event_id long, ts timestamp, event string"
MOVES = "key long, seq int, moved_at timestamp, event string, from_state string, state string"
#: Rows of state hold the values of up to CHUNK events, or keys.
_WAITING = "key array<long>, at array<long>, event_id array<long>, event array<string>"
_NOW = "key array<long>, state array<string>, since array<long>, seq array<int>, upto array<long>"
CHUNK = 1000


def _chunks(rows: list[tuple]) -> list[tuple]:
    return [tuple(list(c) for c in zip(*rows[at : at + CHUNK], strict=True)) for at in range(0, len(rows), CHUNK)]


class _Processor(StatefulProcessor):
    """Keys are handled bucket by bucket: calls of the state store cost as much as hundreds of events."""

    def __init__(self, machine: Machine):
        self.machine = machine

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _WAITING)
        self.now = handle.getListState("now", _NOW)

    def handleInputRows(self, key, rows, timerValues):
        columns = ("key", "at", "event_id", "event")
        return self._step([tuple(batch[c].tolist() for c in columns) for batch in rows], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return self._step([], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _step(self, new: list[tuple[list, ...]], watermark_ms: int) -> Iterator[pd.DataFrame]:
        now = {row[0]: row[1:] for chunk in self.now.get() for row in zip(*chunk, strict=True)}
        chunks = [*new, *self.waiting.get()]
        *places, event = [[x for c in chunks for x in c[k]] for k in range(4)]
        places = np.array(places, dtype="int64")
        order = np.lexsort(places[::-1])  # by key, time and id
        places = places[:, order]
        once = np.append((places[:, 1:] != places[:, :-1]).any(axis=0), True)[: len(order)]
        key, at, event_id = places[:, once].tolist()
        event = [event[k] for k in order[once].tolist()]
        cuts = [0, *(np.flatnonzero(np.diff(places[0, once])) + 1).tolist(), len(key)]
        mine = {key[a]: (a, b) for a, b in zip(cuts, cuts[1:]) if a < b}
        out, rest, next_ = [], [], []
        for one in now.keys() | mine.keys():
            begin, end = mine.get(one, (0, 0))
            now[one], left, then = self._moved(one, now.get(one, (self.machine.initial, 0, 0, -1)), at, event, begin, end, 1000 * watermark_ms, out)
            rest += zip(key[left:end], at[left:end], event_id[left:end], event[left:end])
            next_ += then
        self.waiting.put(_chunks(rest)) if rest else self.waiting.clear()
        self.now.put(_chunks([(key, *x) for key, x in now.items()]))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if next_:
            self.handle.registerTimer(-(-min(next_) // 1000))
        if out:
            kinds = {"key": "int64", "seq": "int32", "moved_at": "int64", "event": object, "from_state": object, "state": object}
            yield pd.DataFrame({c: pd.Series(values, dtype=kind) for values, (c, kind) in zip(zip(*out, strict=True), kinds.items(), strict=True)})

    def _moved(self, key: int, before: tuple, at: list[int], event: list[str], begin: int, end: int, watermark: int, out: list) -> tuple[tuple, int, list[int]]:
        """A key's state, where the events begin that still wait and the next times at which something happens by itself.
        Its events are those from begin to end, in order. Moves up to the watermark are added to ``out``."""
        state, since, seq, upto = before
        reached = max(upto, watermark)
        # what is not later than what has been applied is late, or repeated
        begin = bisect_right(at, upto, begin, end)
        done = bisect_right(at, reached, begin, end)
        moves, touches, timeouts = self.machine.moves, self.machine.touches, self.machine.timeouts

        def move(when: int, what: str, to: str) -> None:
            nonlocal state, since, seq
            seq += 1
            out.append((key, seq, when, what, state, to))
            state, since = to, when

        def end_before(time: int) -> None:
            """Ends the state by its timeout if that is before a time."""
            over = self.machine.deadline(state, since)
            if over is not None and over < time:
                move(over, "timeout", timeouts[state][1])

        for k in range(begin, done):
            if state in timeouts:
                end_before(at[k])
            to = moves.get((state, event[k]))
            if to is not None:
                move(at[k], event[k], to)
            elif (state, event[k]) in touches:
                since = at[k]
        end_before(reached + 1)
        return (state, since, seq, reached), done, [x for x in (at[done] if done < end else None, self.machine.deadline(state, since)) if x is not None]


#: Rows of a replay for which a bucket of keys is worth its calls of the state store.
ROWS_OF_BUCKET = 2000


def moves(events: DataFrame, machine: Machine, late: str, buckets: int = 1024) -> DataFrame:
    """The moves of every key of a stream of events (key, event_id, ts, event), as far as the watermark has come: each
    as soon as it has passed them. late: how long events may come out of order.

    Events without a key, a time or an id are left out. Events of one time apply in the order of their ids. State is a
    few numbers for a key, and the events that the watermark has not passed; it is kept by buckets of keys, whose number
    is fixed for the life of a stream. Needs the state store of RocksDB.
    """
    some = events.where("key IS NOT NULL AND ts IS NOT NULL AND event_id IS NOT NULL").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    some = some.select(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), "key", "event_id", "ts", F.unix_micros("ts").alias("at"), "event")
    if machine.initial not in machine.timeouts:
        # events that change nothing in any state go no further; the watermark counts them, so this must not be decided
        # before it, as a condition without the time would be
        told = F.col("event").isin(*sorted({e for _, e in [*machine.moves, *machine.touches]}))
        some = some.where(told | (F.unix_micros("ts") < F.lit(-(1 << 62))))
    out = T.StructType.fromDDL(MOVES.replace("moved_at timestamp", "moved_at long"))
    found = some.groupBy("bucket").transformWithStateInPandas(_Processor(machine), outputStructType=out, outputMode="append", timeMode="eventTime")
    return found.withColumn("moved_at", F.timestamp_micros("moved_at"))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def replayed(arrivals: list[DataFrame], machine: Machine, late: str, folder: str) -> DataFrame:
    """The moves that a stream finds when tables of events arrive one after the other: each is put into the stream's
    input and the stream is started on it, ended and continued from its checkpoint."""
    spark = arrivals[0].sparkSession
    count = sum(rows.count() for rows in arrivals)
    n = partitions_for(spark, count)
    buckets = max(n, 64, count // ROWS_OF_BUCKET)
    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB, spark__sql__shuffle__partitions=n):
        for rows in arrivals:
            rows.select("key", "event_id", "ts", "event").write.mode("append").parquet(f"{folder}/events")
            stream = spark.readStream.schema(rows.select("key", "event_id", "ts", "event").schema).parquet(f"{folder}/events")
            query = moves(stream, machine, late, buckets).writeStream.format("parquet").option("path", f"{folder}/moves").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
            query.awaitTermination()
    return spark.read.schema(MOVES).parquet(f"{folder}/moves")
