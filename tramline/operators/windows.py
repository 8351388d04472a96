"""Final route windows: delays, cancellations, vehicles, visits and headways within a window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tramline.functions.scalars import canonical_order, digest, seconds, window_start
from tramline.plans.config import ROUTE_KEY, WINDOW_KEY, Settings


def is_cancel() -> Column:
    return F.coalesce(F.col("payload.trip.schedule_relationship") == "CANCELED", F.lit(False))


def is_update() -> Column:
    """A trip update that is no cancellation; updates inside a cancellation are ignored."""
    return ~is_cancel() & F.col("payload.trip_update").isNotNull()


def is_visit(non_empty: bool = False) -> Column:
    """Stopped at a stop; across windows the stop must also have a name."""
    stop = F.col("payload.vehicle_position.stop_id")
    fits = F.coalesce(F.col("payload.vehicle_position.current_status") == "STOPPED_AT", F.lit(False)) & stop.isNotNull()
    return fits & (stop != "") if non_empty else fits


def windowed(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Distinct events with the start of their window. One shuffle by route key serves every aggregate that follows.

    The route key is a prefix of the grouping of all of them, so Catalyst adds no exchange; a window holds the
    events of one route and direction for minutes, which bounds a group.
    """
    key = [c for c in ROUTE_KEY]
    out = events.withColumn("direction_id", F.coalesce(F.col("direction_id").cast("int"), F.lit(-1))).repartition(*key)
    return out.withColumn("window_start", window_start("observed_at", settings.window)).dropDuplicates([*key, "event_id"])


def trip_states(events: DataFrame, *by: str) -> DataFrame:
    """By trip: the last cancellation and the last update, in canonical order; canceled if the former is later."""
    order = canonical_order()
    out = events.groupBy(*(by or WINDOW_KEY), "trip_id").agg(F.max(F.when(is_cancel(), order)).alias("last_cancel"), F.max(F.when(is_update(), order)).alias("last_update"))
    return out.withColumn("canceled", F.col("last_cancel").isNotNull() & (F.col("last_update").isNull() | (F.col("last_cancel") > F.col("last_update"))))


def latest_predictions(events: DataFrame) -> DataFrame:
    """The last delay of each (trip, stop, sequence) in a window; a null delay or a later cancellation removes it."""
    at = F.struct("observed_at", "event_id", "pos")
    rows = events.where(is_update()).select(*WINDOW_KEY, "trip_id", "observed_at", "event_id", F.posexplode("payload.trip_update.stop_time_updates").alias("pos", "u"))
    rows = rows.select(*WINDOW_KEY, "trip_id", F.col("u.stop_id").alias("stop_id"), F.col("u.stop_sequence").alias("stop_sequence"), F.col("u.arrival_delay").alias("delay"), at.alias("at"))
    last = rows.groupBy(*WINDOW_KEY, "trip_id", "stop_id", "stop_sequence").agg(F.max(F.struct("at", "delay")).alias("m")).select(*WINDOW_KEY, "trip_id", "stop_id", "stop_sequence", F.col("m.delay").alias("delay"), F.col("m.at.observed_at").alias("observed_at"), F.col("m.at.event_id").alias("event_id"))
    trips = trip_states(events).select(*WINDOW_KEY, F.col("trip_id").alias("t"), "last_cancel").where("last_cancel IS NOT NULL")
    joined = _joined(last.where("delay IS NOT NULL"), trips, F.col("trip_id").eqNullSafe(F.col("t")), WINDOW_KEY)
    return joined.where(F.col("last_cancel").isNull() | (canonical_order() > F.col("last_cancel"))).drop("t", "last_cancel")


def _joined(left: DataFrame, right: DataFrame, more: Column, keys: list[str]) -> DataFrame:
    """A left join on keys that may be null, with the left columns of the keys."""
    r = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = more
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return left.join(r, on, "left").drop(*[f"_{k}" for k in keys])


def delay_statistics(predictions: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Count, mean, nearest-rank percentiles and the share within the on-time band."""
    d = F.col("delay")
    return predictions.groupBy(*WINDOW_KEY).agg(
        F.count("*").alias("prediction_count"),
        F.avg(d).alias("mean_delay_seconds"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY delay)").cast("double").alias("p50_delay_seconds"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY delay)").cast("double").alias("p95_delay_seconds"),
        F.avg(d.between(settings.early_seconds, settings.on_time_seconds).cast("double")).alias("adherence_rate"),
    )


def first_visits(events: DataFrame) -> DataFrame:
    """The first time each trip stood at each stop in a window."""
    rows = events.where(is_visit()).withColumn("stop_id", F.col("payload.vehicle_position.stop_id"))
    return rows.groupBy(*WINDOW_KEY, "stop_id", "trip_id").agg(F.min("observed_at").alias("observed_at"))


def headways(visits: DataFrame) -> DataFrame:
    """Visits, headways and their mean in a window; a headway is the gap between neighbouring visits of a stop."""
    w = Window.partitionBy(*WINDOW_KEY, "stop_id").orderBy("observed_at", "trip_id")
    gaps = visits.withColumn("gap", F.col("observed_at") - F.lag("observed_at").over(w))
    return gaps.groupBy(*WINDOW_KEY).agg(F.count("*").alias("arrival_count"), F.count("gap").alias("headway_count"), seconds(F.avg("gap")).alias("mean_headway_seconds"))


def route_windows(events: DataFrame, settings: Settings = Settings(), generation: str = "live-v2") -> DataFrame:
    """One final row for each window with an event. Duplicate deliveries and order change nothing."""
    rows = windowed(events, settings)
    base = rows.groupBy(*WINDOW_KEY).agg(F.count_distinct("vehicle_id").alias("vehicle_count"), digest(F.collect_set("event_id")).alias("input_digest"))
    canceled = trip_states(rows).groupBy(*WINDOW_KEY).agg(F.count_if("canceled").alias("canceled_trip_count"))
    out = base
    for part in (delay_statistics(latest_predictions(rows), settings), canceled, headways(first_visits(rows))):
        out = _joined(out, part, F.lit(True), WINDOW_KEY)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(
        F.lit(1).alias("schema_version"), F.lit(generation).alias("generation"), *WINDOW_KEY, (F.col("window_start") + settings.window).alias("window_end"), F.lit(1).cast("long").alias("version"), "input_digest",
        *[zero(c) for c in ("vehicle_count", "prediction_count", "canceled_trip_count", "arrival_count", "headway_count")],
        "mean_delay_seconds", "p50_delay_seconds", "p95_delay_seconds", "adherence_rate", "mean_headway_seconds",
    )
