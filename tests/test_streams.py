"""Streams against folds over all events in order, and against batch joins."""

import datetime
import random
import uuid

import pytest
from pyspark.sql import functions as F

from lexledger.streaming import joins, machines, replay

T0 = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


def minute(n):
    return T0 + datetime.timedelta(minutes=n)


def fold(rows, machine, upto):
    """The moves of a machine over events in order, up to a time."""
    out = []
    for key in sorted({r[0] for r in rows}):
        state, since, seq = machine.initial, None, 0
        events = sorted({(r[2], r[1], r[3]) for r in rows if r[0] == key and r[2] <= upto})

        def move(at, event, to):
            nonlocal state, since, seq
            seq += 1
            out.append((key, seq, at, event, state, to))
            state, since = to, at

        for at, _, event in [*events, (None, 0, None)]:
            if state in machine.timeouts:
                end = since + datetime.timedelta(seconds=machine.timeouts[state][0])
                if end < at if at else end <= upto:
                    move(end, "timeout", machine.timeouts[state][1])
            if (state, event) in machine.moves:
                move(at, event, machine.moves[state, event])
            elif (state, event) in machine.touches:
                since = at
    return out


def got_of(df):
    return sorted((r.key, r.seq, r.moved_at.astimezone(datetime.timezone.utc), r.event, r.from_state, r.state) for r in df.collect())


@pytest.mark.parametrize("machine", [machines.RUNS, machines.REVIEWS])
def test_moves_equal_a_fold_in_order(spark, tmp_path, machine):
    rng = random.Random(7)
    kinds = sorted({e for _, e in [*machine.moves, *machine.touches]}) + ["unknown"]
    rows = [(rng.randrange(6), k, minute(rng.randrange(6000)), rng.choice(kinds)) for k in range(500)]
    arriving = sorted([(r[2] + datetime.timedelta(minutes=rng.randrange(90)), r) for r in rows] + [(r[2] + datetime.timedelta(minutes=100), r) for r in rows[::7]], key=lambda x: x[0])
    cuts = [arriving[k * len(arriving) // 3 : (k + 1) * len(arriving) // 3] for k in range(3)]
    tables = [spark.createDataFrame([r for _, r in c] + [(None, 1, T0, "x"), (1, None, T0, "x"), (1, 1, None, "x")], machines.EVENTS).repartition(2) for c in cuts]
    got = machines.replayed(tables, machine, "2 hours", str(tmp_path / uuid.uuid4().hex))
    upto = max(r[2] for r in rows) - datetime.timedelta(hours=2)
    assert got_of(got) == fold(rows, machine, upto)


def test_late_events_are_left_out_and_hanging_runs_end(spark, tmp_path):
    first = [(1, 1, minute(0), "queue"), (1, 2, minute(1), "start"), (2, 3, minute(0), "queue"), (2, 4, minute(5), "start"), (2, 6, minute(600), "progress"), (9, 9, minute(1000), "queue")]
    second = [(1, 7, minute(2), "succeed"), (2, 4, minute(5), "start"), (9, 10, minute(2000), "start")]
    got = got_of(machines.replayed([spark.createDataFrame(t, machines.EVENTS) for t in (first, second)], machines.RUNS, "10 minutes", str(tmp_path / "x")))
    assert [m for m in got if m[0] == 1] == [(1, 1, minute(0), "queue", "new", "queued"), (1, 2, minute(1), "start", "queued", "running"), (1, 3, minute(721), "timeout", "running", "failed")]
    assert [m[2:] for m in got if m[0] == 2][-1] == (minute(600 + 720), "timeout", "running", "failed")
    assert [m[2:] for m in got if m[0] == 9] == [(minute(1000), "queue", "new", "queued")]  # the watermark has not passed its start


def test_joined_streams_equal_the_batch_join(spark, tmp_path):
    rng = random.Random(3)
    made = [(k, rng.choice([1, 2, 3, None]), minute(rng.randrange(3000) + 0.5)) for k in range(120)] + [(999, 1, None)]
    runs = [(k, rng.choice([1, 2, 3, 4, None]), minute(rng.randrange(3000))) for k in range(60)] + [(998, 1, None)]
    arrive = lambda rows, n: [[r for r in rows if (r[2] or T0) >= minute(a) and (r[2] or T0) < minute(b)] for a, b in zip([0, 1000, 2000], [1000, 2000, 9000], strict=True)][:n]
    frame = lambda rows, ddl: spark.createDataFrame(rows, ddl).repartition(2)
    pairs = [(frame(m, joins.VERSIONS), frame(r + r[:5], joins.RUNS)) for m, r in zip(arrive(made, 3), arrive(runs, 3), strict=True)]
    got = joins.replayed(pairs, "'2' HOUR", "10 minutes", str(tmp_path / "x")).collect()
    want = joins.with_runs(frame(made, joins.VERSIONS), frame(runs + runs[:9], joins.RUNS), "'2' HOUR", "10 minutes").collect()
    upto = min(max(r[2] for r in rows if r[2]) for rows in (made, runs)) - datetime.timedelta(minutes=10)
    assert sorted(map(str, got)) == sorted(str(r) for r in want if r.run_id is not None or r.created_at.astimezone(datetime.timezone.utc) + datetime.timedelta(hours=2) < upto)
    assert {r.document_version_id for r in want} == set(range(120)) and any(r.run_id is None for r in got) and any(r.run_id is not None for r in got)


def test_state_is_kept_by_buckets_of_keys(spark, tmp_path):
    """A row of state, and calls of the state store, for each bucket, not for each key."""
    rows = spark.range(3000).selectExpr("id % 1500 AS key", "id AS event_id", "timestamp_seconds(1704067200 + id) AS ts", "'queue' AS event")
    rows.write.parquet(str(tmp_path / "in"))
    with machines.settings(spark, spark__sql__streaming__stateStore__providerClass=machines.ROCKSDB):
        stream = machines.moves(spark.readStream.schema(machines.EVENTS).parquet(str(tmp_path / "in")), machines.RUNS, "1 minute", buckets=8)
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 8 * 10
    assert spark.read.parquet(str(tmp_path / "out")).where("seq = 1 AND state = 'queued'").count() == 1500


def test_partitions_of_state_grow_no_faster_than_the_rows(spark):
    with replay.settings(spark, spark__sql__shuffle__partitions=10_000):
        assert replay.partitions_for(spark, 15_000_000) <= 100 and replay.partitions_for(spark, 90_000_000) <= 6 * replay.partitions_for(spark, 15_000_000) and replay.partitions_for(spark, 10) == 4


def test_pairs_of_partitions_of_state_grow_no_faster_than_the_rows(spark):
    """Each task of a stateful operator reports on all partitions of state, so what is sent goes with their square."""
    with replay.settings(spark, spark__sql__shuffle__partitions=10_000):
        few, many = replay.partitions_for(spark, 15_000_000), replay.partitions_for(spark, 90_000_000)
        assert few < many and many**2 <= 6.5 * few**2


def test_events_that_change_nothing_move_the_watermark_and_leave_no_state(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, minute(0), "approve"), (1, 3, minute(1), "comment")] + [(k, 10 + k, minute(1000), "comment") for k in range(2, 50)], machines.EVENTS)
    rows.write.parquet(str(tmp_path / "in"))
    with machines.settings(spark, spark__sql__streaming__stateStore__providerClass=machines.ROCKSDB):
        stream = machines.moves(spark.readStream.schema(machines.EVENTS).parquet(str(tmp_path / "in")), machines.REVIEWS, "1 minute", buckets=64)
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3  # of one key; its bucket's timer may stand
    assert got_of(spark.read.schema(machines.MOVES).parquet(str(tmp_path / "out"))) == [(1, 1, minute(0), "approve", "pending", "approved")]
