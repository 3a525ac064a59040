"""Plans of incremental jobs: what has landed is read in runs that stop, and the stored state is the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from lychgate.operators import lookup, maintain
from lychgate.registry import query
from lychgate.sources import schemas, writers
from lychgate.sources.scratch import folder
from lychgate.sources.tables import table
from lychgate.streaming import jobs


def _drop(spark, d, which, path: str) -> None:
    """Notices of the orders' customers as a list file in a landing folder."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    made = {"provider_id": F.lit(1), "provider_key": F.col("o_custkey") % 4, "id": F.col("o_custkey"), "url": F.concat(F.lit("http://example.org/"), F.col("o_custkey").cast("string")), "pub_date": day}
    orders = table(spark, d, "orders").where(which)
    writers.obit_list(orders.select(*[made.get(n, F.lit(None).cast("string")).alias(n) for n in schemas.OBIT_LIST]), path)


@query("stream_upsert", "SELECT o_custkey::VARCHAR AS id, max(strftime(o_orderdate, '%Y-%m-%d')) AS pub_date FROM orders GROUP BY 1")
def stream_upsert(spark, d):
    """Two drops, the later notices first, each taken by a run of its own, and a replay of both that changes nothing."""
    landed, root = folder(spark, "landed"), folder(spark, "notices")
    sink = jobs.upsert_parquet(["id"], "pub_date", root)
    for half, which in enumerate((F.col("o_orderstatus") == "F", F.col("o_orderstatus") != "F")):
        _drop(spark, d, which, f"{landed}/{half}")
        jobs.run_once(jobs.landed_lists(spark, f"{landed}/*", glob="part-*"), sink, f"{root}-state")
    jobs.run_once(jobs.landed_lists(spark, f"{landed}/*", glob="part-*"), sink, f"{root}-again")
    return jobs.current(spark, root).select("id", "pub_date")


def _events(spark, d):
    """The events as a stream of what has landed."""
    path = folder(spark, "events")
    table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts")).write.mode("overwrite").parquet(path)
    return spark.readStream.schema("event_id long, user_id long, event_type string, ts timestamp").parquet(path)


def _stored(spark, stream, name: str):
    out = folder(spark, name)
    stream.writeStream.format("parquet").option("checkpointLocation", f"{out}-state").outputMode("append").trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query("stream_first", "SELECT DISTINCT user_id FROM events")
def stream_first(spark, d):
    return _stored(spark, jobs.first_notices(_events(spark, d), "user_id", "ts", "3650 days"), "first").select("user_id")


@query(
    "stream_activity",
    """SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, count(*) AS n FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 3 DAY FROM events) GROUP BY 1, 2""",
)
def stream_activity(spark, d):
    """Windows that the watermark has closed; later ones are still open."""
    closed = jobs.activity(_events(spark, d), "event_type", "ts").select(F.col("window.start").alias("day"), "event_type", "n")
    return _stored(spark, closed, "activity")


@query("high_water", "SELECT o_custkey, max(o_orderkey) AS last_o_orderkey, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders GROUP BY 1")
def high_water(spark, d):
    return jobs.high_water(table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate")), "o_custkey", "o_orderkey", "day")


@query("order_restored", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS place FROM orders")
def order_restored(spark, d):
    """Rows in random order, numbered by the order that they had."""
    mixed = lookup.shuffled(table(spark, d, "orders").select("o_orderkey"), 7, "o_orderkey")
    return maintain.numbered(mixed, "o_orderkey", "place", 1).select("o_orderkey", F.col("place").cast("long").alias("place"))


@query(
    "valid_record",
    "SELECT s_suppkey, EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_linenumber = s_nationkey % 9) AS found FROM supplier",
)
def valid_record(spark, d):
    wanted = table(spark, d, "supplier").select("s_suppkey", (F.col("s_nationkey") % 9).alias("line"))
    known = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_linenumber").alias("line"), F.lit(0).alias("number"))
    return lookup.valid_record_exists(wanted, known, ["s_suppkey", "line"], "number").select("s_suppkey", "found")
