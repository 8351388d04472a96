"""The engine's inputs seen in the driver's tables: transit observations from `events`, schedules from `customer`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.plans.model import PAYLOAD


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observed(events: DataFrame) -> DataFrame:
    """Flat observations, of a batch or a stream of `events`."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    return events.select(
        F.concat(F.lit("e"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("event_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("observed_at"),
        F.lit("demo").alias("agency_id"),
        F.concat(F.lit("R"), (F.col("user_id") % 5).cast("string")).alias("route_id"),
        F.expr("cast((user_id div 5) % 2 as int)").alias("direction_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("service_date"),
        F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("trip_id"),
        F.when(k % 13 != 0, F.concat(F.lit("V"), F.col("user_id").cast("string"))).alias("vehicle_id"),
        F.concat(F.lit("S"), (k % 3).cast("string")).alias("stop_id"),
        (k % 4).cast("int").alias("stop_sequence"),
        F.when(k % 11 != 0, F.floor("value").cast("int") - 120).alias("arrival_delay"),
        F.when(F.col("event_type") == "error", "cancel").when(F.col("event_type").isin("click", "view"), "prediction").otherwise("visit").alias("kind"),
    )


def as_events(obs: DataFrame) -> DataFrame:
    """Flat observations as events with their payload."""
    kind = F.col("kind")
    relation = F.when(kind == "cancel", "CANCELED").otherwise("SCHEDULED")
    trip = F.struct(F.col("trip_id"), F.col("route_id"), F.regexp_replace("service_date", "-", "").alias("start_date"), F.lit(None).cast("string").alias("start_time"), F.col("direction_id"), relation.alias("schedule_relationship"))
    null = lambda t: F.lit(None).cast(t)
    position = F.when(kind == "visit", F.struct(null("double").alias("latitude"), null("double").alias("longitude"), null("double").alias("bearing"), null("double").alias("speed"), F.col("stop_id"), F.col("stop_sequence").alias("current_stop_sequence"), F.lit("STOPPED_AT").alias("current_status")))
    stop = F.struct(F.col("stop_sequence"), F.col("stop_id"), F.col("arrival_delay"), null("long").alias("arrival_time"), null("int").alias("departure_delay"), null("long").alias("departure_time"), null("string").alias("schedule_relationship"))
    update = F.when(kind == "prediction", F.struct(F.array(stop).alias("stop_time_updates")))
    payload = F.struct(trip.alias("trip"), position.alias("vehicle_position"), update.alias("trip_update"), F.col("vehicle_id")).cast(PAYLOAD)
    return obs.select("event_id", "observed_at", "agency_id", "route_id", "direction_id", "service_date", "trip_id", "vehicle_id", payload.alias("payload"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_events(observed(table(spark, sf_dir, "events")))


def one_day(events: DataFrame) -> DataFrame:
    """A constant service date, so that routes run on over midnight."""
    return events.withColumn("service_date", F.lit("2024-01-01"))


#: Versions of the schedule: agency, version, effective from (ms).
VERSIONS = [("demo", "v1", 1704067200000), ("demo", "v2", 1704931200000), ("demo", "v3", 1705795200000), ("other", "w1", 1704067200000)]
CALENDAR = [
    ("AUTOMOBILE", "1111100", "20240101", "20240131"), ("BUILDING", "1111111", "20240101", "20240115"), ("FURNITURE", "0000011", "20240101", "20240131"),
    ("HOUSEHOLD", "1010101", "20240105", "20240125"), ("MACHINERY", "1111111", "20240101", "20240131"),
]
EXCEPTIONS = [("AUTOMOBILE", "20240106", "1", 1), ("MACHINERY", "20240110", "2", 2), ("MACHINERY", "20240111", "2", 3), ("MACHINERY", "20240111", "1", 4), ("BUILDING", "20240120", "1", 5)]


def schedule(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Schedule tables with schedule_version; trips come from customers, every seventh is unknown."""
    versions = spark.createDataFrame(VERSIONS, "agency_id string, schedule_version string, effective_from long")
    named = F.explode(F.array(*[F.lit(v) for _, v, _ in VERSIONS]))
    days = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    calendar = spark.createDataFrame([(s, *flags, a, b) for s, flags, a, b in CALENDAR], "service_id string, " + ", ".join(f"{d} string" for d in days) + ", start_date string, end_date string")
    dates = spark.createDataFrame(EXCEPTIONS, "service_id string, date string, exception_type string, row_no int")
    trips = table(spark, sf_dir, "customer").where("c_custkey % 7 <> 0").select(F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("trip_id"), F.col("c_mktsegment").alias("service_id"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("route_id"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise((F.col("c_custkey") % 2).cast("string")).alias("direction_id"))
    of = lambda df: df.withColumn("schedule_version", named)  # noqa: E731  the same tables in each version
    return {"versions": versions, "trips": of(trips), "calendar": of(calendar), "calendar_dates": of(dates)}


def stop_times(trips: DataFrame) -> DataFrame:
    """Three stops a trip, some after midnight of the service day."""
    n = F.substring("trip_id", 2, 20).cast("long")
    base = trips.select("trip_id", n.alias("n"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("stop_sequence"))
    at = (F.col("n") % 26) * 3600 + F.col("stop_sequence") * 600
    clock = F.format_string("%02d:%02d:00", F.expr("cast(n % 26 as int)"), F.expr("cast(stop_sequence * 10 as int)"))
    return base.select("trip_id", F.concat(F.lit("S"), F.col("stop_sequence").cast("string")).alias("stop_id"), F.col("stop_sequence").cast("string").alias("stop_sequence"), clock.alias("departure_time"), at.cast("int").alias("seconds"))
