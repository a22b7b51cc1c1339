"""S: streaming forms, run to the end over the events table and returned as a batch."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources.shared import shared_dir
from ..streaming import events as st
from .registry import query, table


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex[:12]}"


def _run(spark, sf, make, mode="append"):
    """Run a stream over events to its end, and read what it wrote."""
    out = _folder(spark)
    schema = table(spark, sf, "events").schema
    stream = make(st.read_stream(spark, f"{sf}/events.parquet*", schema).withColumn("ts", F.col("ts").cast("timestamp")))
    st.run_available(stream, f"{out}/checkpoint", st.idempotent_parquet(f"{out}/data", "_batch"), mode)
    return spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(f"{out}/data")


@query("S01_incremental", "SELECT event_id, value FROM events WHERE event_type = 'click'")
def incremental(spark, sf):
    return _run(spark, sf, lambda e: e.filter("event_type = 'click'").select("event_id", "value"))


@query("S02_skip_existing", "SELECT event_id, value FROM events WHERE event_type = 'click' AND event_id % 2 = 1")
def skip_existing(spark, sf):
    done = table(spark, sf, "events").filter("event_id % 2 = 0").select("event_id")
    return st.skip_existing(incremental(spark, sf), done, ["event_id"])


@query("S03_windowed_meter", "SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, count(*) AS n, round(sum(value), 4) AS total, max(value) AS top FROM events GROUP BY 1, 2")
def windowed_meter(spark, sf):
    m = _run(spark, sf, lambda e: st.windowed_meter(e, ["event_type"], "1 day", "40 days"), "complete")
    return m.select(F.col("start").cast("timestamp_ntz").alias("day"), "event_type", "n", F.round("total", 4).alias("total"), "top")


@query("S04_chunk_lookup", "WITH c AS (SELECT user_id, event_id AS chunk, epoch(ts)::DOUBLE AS s, epoch(ts)::DOUBLE + 50000 AS e FROM events WHERE event_type = 'signup') SELECT p.event_id, c.chunk FROM (SELECT event_id, user_id, epoch(ts)::DOUBLE AS t FROM events WHERE event_type = 'view') p JOIN c ON p.user_id = c.user_id AND p.t BETWEEN c.s AND c.e")
def chunk_lookup(spark, sf):
    t = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    chunks = table(spark, sf, "events").filter("event_type = 'signup'").select("user_id", F.col("event_id").alias("chunk"), t.alias("s"), (t + 50000).alias("e"))
    return _run(spark, sf, lambda e: st.in_chunk(e.filter("event_type = 'view'").select("event_id", "user_id", t.alias("t")), chunks, 50000.0).select("event_id", "chunk"))


@query("S05_rig_groups", "SELECT count(DISTINCT user_id) AS rigs FROM events")
def rig_groups(spark, sf):
    return _run(spark, sf, lambda e: st.first_of_rig(e, ["user_id"], "60 days").select("user_id")).agg(F.count_distinct("user_id").alias("rigs"))
