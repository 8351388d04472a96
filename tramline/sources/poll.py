"""Several feeds polled as one ingestion, and what it wrote read back."""

from __future__ import annotations

import os
import tomllib
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators.ops import history_rows
from tramline.sources.http_feed import FeedSource
from tramline.sources.sinks import committed, ingest
from tramline.streaming.runner import start as start_query

MOST_FEEDS = 8


def feeds(path: str) -> list[dict]:
    """Entries of a TOML file, [[feeds]] with agency_id, feed_id, url and, if wanted, interval: one to eight, unique by agency and feed."""
    with open(path, "rb") as f:
        found = tomllib.load(f).get("feeds", [])
    if not 1 <= len(found) <= MOST_FEEDS:
        raise ValueError(f"a configuration has 1 to {MOST_FEEDS} feeds")
    for entry in found:
        if lacks := [k for k in ("agency_id", "feed_id", "url") if not isinstance(entry.get(k), str) or not entry[k]]:
            raise ValueError(f"a feed lacks {lacks}")
        if urlsplit(entry["url"]).scheme not in ("http", "https"):
            raise ValueError("a feed is fetched by http or https")
        if not float(entry.get("interval", 30)) > 0:
            raise ValueError("an interval is longer than nothing")
    if len({(e["agency_id"], e["feed_id"]) for e in found}) < len(found):
        raise ValueError("a feed is named twice")
    return found


def start(spark: SparkSession, entries: list[dict], root: str, outbox: str, checkpoint: str, once: bool = False) -> list:
    """One query for each feed, each with one request at a time, a retry delay and a checkpoint of its own.

    A feed that is slow or down holds up no other. `outbox` must be a durable folder of the driver; each feed writes
    below `root` to a folder of its own.
    """
    spark.dataSource.register(FeedSource)
    out = []
    for e in entries:
        name = f"{e['agency_id']}-{e['feed_id']}"
        rows = spark.readStream.format("transit_feed").options(url=e["url"], agency_id=e["agency_id"], feed_id=e["feed_id"], outbox=os.path.join(outbox, name), interval=str(e.get("interval", 30))).load()
        trigger = {"once": True} if once else {"processingTime": f"{e.get('interval', 30)} seconds"}
        out.append(start_query(rows, name, checkpoint, write=ingest(f"{root}/{name}"), trigger=trigger))
    return out


def raw_bodies(spark: SparkSession, root: str) -> DataFrame:
    """Bodies of committed batches as they were fetched, each proved against the digest in its manifest."""
    bodies, manifests = committed(spark, root, "raw_objects"), committed(spark, root, "raw_feed_snapshots").select("object_uri", "snapshot_id", "body_sha256", "body_bytes")
    body = F.when(F.sha2("body", 256) == F.col("body_sha256"), F.col("body")).otherwise(F.raise_error(F.concat(F.lit("the object is not what was written: "), "object_uri")).cast("binary"))
    return manifests.join(bodies, "object_uri").withColumn("body", body).dropDuplicates(["object_uri"])


def audit(spark: SparkSession, late: str, rejected: str, schema_late, schema_rejected) -> DataFrame:
    """Two streams of audit records as one stream of history rows, told apart by topic."""
    read = lambda path, schema: spark.readStream.schema(schema).parquet(path)
    one = history_rows(read(late, schema_late)).withColumn("topic", F.lit("late_events"))
    return one.unionByName(history_rows(read(rejected, schema_rejected)).withColumn("topic", F.lit("rejected_events")))
