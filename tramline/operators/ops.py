"""Small operators: event time, history, lateness, integrity, operational figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tramline.functions.scalars import beyond_retention, window_start
from tramline.plans.config import Settings


def event_time(entity_seconds: Column, header_seconds: Column) -> tuple[Column, Column]:
    """Milliseconds and their source: the entity's own time, else the header's; 0 counts as missing."""
    entity, header = F.nullif(entity_seconds, F.lit(0)), F.nullif(header_seconds, F.lit(0))
    return F.coalesce(entity, header) * 1000, F.when(entity.isNotNull(), "entity").when(header.isNotNull(), "feed_header")


def history_rows(rows: DataFrame, *times: str) -> DataFrame:
    """event_id, observed_at, record_json. The id is the row's or the record's SHA-256, the time the first there is, or 0.

    Times, unless others are named: the row's own, when it was fetched or ingested, and that of a nested `event`.
    """
    record = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    ident = F.col("event_id") if "event_id" in rows.columns else F.lit(None).cast("string")
    at = [F.col(c) for c in times or ("observed_at", "fetched_at", "ingested_at") if c in rows.columns]
    event = next((f.dataType for f in rows.schema if f.name == "event"), None)
    if not times and isinstance(event, StructType) and "observed_at" in event.names:
        at.append(F.col("event.observed_at"))
    return rows.withColumn("record_json", record).select(F.coalesce(ident, F.sha2("record_json", 256)).alias("event_id"), F.coalesce(*at, F.lit(0)).cast("long").alias("observed_at"), "record_json")


def distinct_events(events: DataFrame) -> DataFrame:
    return events.dropDuplicates(["event_id"])


def late_audit(events: DataFrame, arrival: str, settings: Settings = Settings()) -> DataFrame:
    """Events in order of arrival with the watermark before each, and whether each came beyond retention.

    The watermark is a running maximum over all arrivals, taken in three steps: within each second of arrival, over the
    seconds of an hour, over the hours. No task orders more than a second's events or an hour's 3,600 maxima; only
    one row an hour is ordered as a whole.
    """
    rows = events.withColumn("_second", F.floor(F.col(arrival) / 1000).cast("long"))
    earlier = lambda by, *order: Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.max("observed_at").over(earlier(["_second"], arrival, "event_id")))
    seconds = events.groupBy(F.floor(F.col(arrival) / 1000).cast("long").alias("_second")).agg(F.max("observed_at").alias("_most")).withColumn("_hour", F.floor(F.col("_second") / 3600))
    hours = seconds.groupBy("_hour").agg(F.max("_most").alias("_most")).withColumn("_hours_before", F.max("_most").over(earlier([], "_hour"))).drop("_most")
    before = seconds.withColumn("_seconds_before", F.max("_most").over(earlier(["_hour"], "_second"))).join(hours, "_hour").select("_second", F.greatest("_seconds_before", "_hours_before").alias("_before"))
    rows = rows.join(before, "_second").withColumn("watermark", F.greatest("_inside", "_before") - settings.out_of_order)
    return rows.withColumn("late", beyond_retention(F.col("observed_at"), F.col("watermark"), settings.dedup_retention)).drop("_second", "_inside", "_before")


def dangling(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Keys of child rows that lead to no parent."""
    keys = child.select(F.col(column).alias("key")).where("key IS NOT NULL").distinct()
    return keys.join(parent.select(F.col(parent_column).alias("key")), "key", "left_anti")


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that one side lacks."""
    a, b = left.select(key).distinct().withColumn("in_left", F.lit(True)), right.select(key).distinct().withColumn("in_right", F.lit(True))
    out = a.join(b, key, "full").where("in_left IS NULL OR in_right IS NULL")
    return out.select(key, F.coalesce("in_left", F.lit(False)).alias("in_left"), F.coalesce("in_right", F.lit(False)).alias("in_right"))


def counter_rate(samples: DataFrame, by: list[str], width: int) -> DataFrame:
    """Growth per second of counters (at, total) in each window, from neighbouring samples; a total that falls began anew at 0."""
    w = Window.partitionBy(*by).orderBy("at", "event_id")
    before = F.lag("total").over(w)
    steps = samples.withColumn("ms", F.col("at") - F.lag("at").over(w)).withColumn("more", F.when(F.col("total") < before, F.col("total")).otherwise(F.col("total") - before)).where("ms IS NOT NULL")
    return steps.groupBy(*by, window_start("at", width).alias("window_start")).agg((F.sum("more") / (F.sum("ms") / 1000.0)).alias("rate"))


def age(samples: DataFrame, by: list[str], now: int) -> DataFrame:
    """Seconds since the newest sample (at, in ms) of each series."""
    return samples.groupBy(*by).agg(((F.lit(now) - F.max("at")) / 1000.0).alias("age_seconds"))


def offset_lag(low: Column, high: Column, committed: Column) -> Column:
    """Messages still to read: from the commit, held within the log, or from its beginning where there is none."""
    return high - F.when(committed.isNull(), low).otherwise(F.least(F.greatest(committed, low), high))


def benchmark_stats(rows: DataFrame, by: str, value: str) -> DataFrame:
    return rows.groupBy(by).agg(F.median(value).alias("median"), F.stddev_samp(value).alias("stdev"))


def serving_gauges(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.count("*").alias("rows"), F.coalesce(F.sum("prediction_count"), F.lit(0)).cast("long").alias("predictions"))
