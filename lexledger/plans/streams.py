"""Queries that run as streams over the tables, in several arrivals, against SQL over all rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexledger.operators.lineage import settled, shared_folder
from lexledger.plans.registering import registrar
from lexledger.sources import paging
from lexledger.streaming import joins, machines

QUERIES, ORACLES, query, _ = registrar()

ARRIVALS, LATE = 3, "3 hours"


def _folder(v, name: str) -> str:
    return f"{shared_folder(v.spark)}/{name}-{uuid.uuid4().hex}"


def _arriving(rows: DataFrame) -> list[DataFrame]:
    """rows in ARRIVALS parts of equal length in time, by their column ``arrives``, which is dropped."""
    rows = settled(rows)
    low, high = rows.agg(F.unix_micros(F.min("arrives")), F.unix_micros(F.max("arrives"))).first()
    part = F.least(F.lit(ARRIVALS - 1), F.floor((F.unix_micros("arrives") - F.lit(low)) * ARRIVALS / F.lit(max(high - low, 1))))
    return [rows.where(part == k).drop("arrives") for k in range(ARRIVALS)]


def _late(rows: DataFrame, id_: str, at: str) -> DataFrame:
    """rows plus ``arrives``: up to two hours after their time, so that parts overlap in time."""
    return rows.withColumn("arrives", F.timestamp_micros(F.unix_micros(F.col(at).cast("timestamp")) + F.pmod(F.col(id_) * 7919, F.lit(7200)) * 1_000_000))


_RUN_EVENTS = """SELECT user_id AS key, event_id, ts, CASE event_type WHEN 'signup' THEN 'queue' WHEN 'view' THEN 'start' WHEN 'click' THEN 'progress' WHEN 'purchase' THEN 'succeed' ELSE 'fail' END AS event FROM {events}"""
_REVIEW_EVENTS = """SELECT user_id % 40 AS key, event_id, ts, CASE event_type WHEN 'signup' THEN 'edit' WHEN 'click' THEN 'approve' WHEN 'purchase' THEN 'reject' ELSE 'comment' END AS event FROM {events}"""


def _fold_sql(events: str, machine: machines.Machine) -> str:
    """A machine as a recursion over the events of each key in order, up to where the watermark comes to."""
    one = lambda pairs: ", ".join(f"'{s}/{e}'" for s, e in pairs) or "''"
    to = " ".join(f"WHEN '{s}/{e}' THEN '{x}'" for (s, e), x in machine.moves.items())
    ends = " ".join(f"WHEN '{s}' THEN since + INTERVAL '{n}' SECOND" for s, (n, _) in machine.timeouts.items())
    end = f"CASE state {ends} END" if ends else "CAST(NULL AS TIMESTAMP)"
    after = "CASE state " + " ".join(f"WHEN '{s}' THEN '{x}'" for s, (_, x) in machine.timeouts.items()) + " END" if ends else "CAST(NULL AS VARCHAR)"
    return f"""WITH RECURSIVE given AS ({events}), upto AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '{LATE}' AS upto FROM given),
  e AS (SELECT key, ts, event, row_number() OVER (PARTITION BY key ORDER BY ts, event_id) AS n FROM given, upto WHERE ts <= upto),
  f AS (SELECT key, CAST(0 AS BIGINT) AS n, CAST(NULL AS TIMESTAMP) AS ts, '' AS event, '' AS before, CAST(NULL AS TIMESTAMP) AS ended, '{machine.initial}' AS mid, '{machine.initial}' AS state, CAST(NULL AS TIMESTAMP) AS since FROM (SELECT DISTINCT key FROM e)
    UNION ALL
    SELECT key, n, ts, event, before, ended, mid, CASE concat(mid, '/', event) {to} ELSE mid END, CASE WHEN concat(mid, '/', event) IN ({one([*machine.moves, *machine.touches])}) THEN ts ELSE coalesce(ended, since) END
    FROM (SELECT key, n, ts, event, before, ended, since, CASE WHEN ended IS NOT NULL THEN ends_in ELSE before END AS mid
      FROM (SELECT e.key, e.n, e.ts, e.event, f.state AS before, since, {after} AS ends_in, CASE WHEN {end} < e.ts THEN {end} END AS ended FROM f JOIN e ON e.key = f.key AND e.n = f.n + 1))),
  moved AS (
    SELECT key, n, 0 AS part, ended AS moved_at, 'timeout' AS event, before AS from_state, mid AS state FROM f WHERE ended IS NOT NULL
    UNION ALL SELECT key, n, 1, ts, event, mid, state FROM f WHERE concat(mid, '/', event) IN ({one(machine.moves)})
    UNION ALL SELECT key, n, 2, {end}, 'timeout', state, {after} FROM (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC) = 1), upto WHERE {end} <= upto)
  SELECT key, CAST(row_number() OVER (PARTITION BY key ORDER BY n, part) AS INT) AS seq, moved_at, event, from_state, state FROM moved"""


def _moves(v, events: str, machine: machines.Machine, name: str) -> DataFrame:
    """Events come up to two hours late, and failures once more, by which time they may be too late."""
    rows = _late(v.spark.sql(events, events=v["events"]), "event_id", "ts")
    again = rows.where("event IN ('fail', 'edit')").withColumn("arrives", F.col("arrives") + F.expr("INTERVAL '50' MINUTE"))
    found = machines.replayed(_arriving(rows.unionByName(again)), machine, LATE, _folder(v, name))
    return found.withColumn("moved_at", F.col("moved_at").cast("timestamp_ntz"))  # like the events' times


@query(_fold_sql(_RUN_EVENTS, machines.RUNS))
def run_states(v):
    """Moves of all runs, those that hang included."""
    return _moves(v, _RUN_EVENTS, machines.RUNS, "run-states")


@query(_fold_sql(_REVIEW_EVENTS, machines.REVIEWS))
def review_states(v):
    """Decisions on all review items, and the edits that open them again."""
    return _moves(v, _REVIEW_EVENTS, machines.REVIEWS, "review-states")


_SPARK_CREATED = """SELECT o_orderkey AS document_version_id, o_custkey AS owner, timestamp_micros(unix_micros(TIMESTAMP '2024-01-01 00:00:00') + (datediff(o_orderdate, DATE '1992-01-01') % 30 * 86400 + o_orderkey % 86400) * 1000000) AS created_at FROM {orders}"""
_DUCK_CREATED = """SELECT o_orderkey AS document_version_id, o_custkey AS owner, make_timestamp(epoch_us(TIMESTAMP '2024-01-01 00:00:00') + (date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) % 30 * 86400 + o_orderkey % 86400) * 1000000) AS created_at FROM {orders}"""
_STARTED = "SELECT event_id AS run_id, user_id AS owner, ts AS started_at FROM {events}"


@query(f"""WITH v AS ({_DUCK_CREATED}), r AS ({_STARTED}), upto AS (SELECT least((SELECT date_trunc('milliseconds', max(created_at)) FROM v), (SELECT date_trunc('milliseconds', max(started_at)) FROM r)) - INTERVAL '{LATE}' AS upto)
  SELECT v.*, run_id, started_at FROM v LEFT JOIN r ON v.owner = r.owner AND started_at BETWEEN created_at AND created_at + INTERVAL '1' DAY, upto WHERE run_id IS NOT NULL OR created_at + INTERVAL '1' DAY < upto""")
def versions_with_runs(v):
    """Versions with the runs of their owner within a day, as two streams; those without any as soon as that is known."""
    made = _late(v.spark.sql(_SPARK_CREATED, orders=v["orders"]), "document_version_id", "created_at")
    runs = _late(v.spark.sql(_STARTED, events=v["events"]), "run_id", "started_at")
    again = runs.where("run_id % 9 = 0").withColumn("arrives", F.col("arrives") + F.expr("INTERVAL '50' MINUTE"))
    found = joins.replayed(list(zip(_arriving(made), _arriving(runs.unionByName(again)), strict=True)), "'1' DAY", LATE, _folder(v, "versions-with-runs"))
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "started_at")})


_PAGED = "SELECT CAST(page_id AS INT) AS page_number, CAST(length(html) AS INT) AS chars, md5(html) AS digest FROM {pages}"


def _digested(pages: DataFrame) -> DataFrame:
    return pages.select("page_number", F.length("text").alias("chars"), F.md5("text").alias("digest"))


@query(_PAGED)
def pages_read(v):
    """All pages through the page source."""
    v.spark.dataSource.register(paging.page_source(paging.ParquetPages("html", "page_id"), "html_pages"))
    return _digested(v.spark.read.format("html_pages").load(f"{v.sf_dir}/pages.parquet"))


@query(_PAGED)
def pages_streamed(v):
    """All pages through the page source, as a stream."""
    v.spark.dataSource.register(paging.page_source(paging.ParquetPages("html", "page_id"), "html_pages"))
    stream, folder = v.spark.readStream.format("html_pages").load(f"{v.sf_dir}/pages.parquet"), _folder(v, "pages")
    stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return _digested(v.spark.read.schema(paging.PAGE).parquet(f"{folder}/out"))
