"""Telemetry coverage: which scheduled trips were due, and what was heard of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.scalars import canonical_order, clock_seconds, digest, direction, service_instant
from tramline.operators.windows import is_cancel, is_update


@dataclass
class Report:
    """One report: header, counts of evidence left out by reason, one row a route and direction, one row a trip."""

    header: dict
    excluded: DataFrame
    routes: DataFrame
    trips: DataFrame


def trip_due_times(trips: DataFrame, stop_times: DataFrame, service_date: str, zone: str, grace_seconds: int) -> DataFrame:
    """trip_id, scheduled_departure (of the first stop), scheduled_completion (latest departure), due_at; in ms.

    A trip without stop times is an error when the plan runs: nothing tells when it was due.
    """
    day = F.lit(service_date).cast("date")
    s = stop_times.withColumn("at", service_instant(day, clock_seconds(F.col("departure_time")), zone) * 1000).withColumn("n", F.col("stop_sequence").cast("int"))
    due = s.groupBy("trip_id").agg(F.min_by("at", "n").alias("scheduled_departure"), F.max("at").alias("scheduled_completion"))
    rows = trips.select("trip_id").join(due, "trip_id", "left")
    there = F.coalesce("scheduled_completion", F.raise_error(F.concat(F.lit("no stop times for scheduled trip "), "trip_id")).cast("long"))
    return rows.withColumn("scheduled_completion", there).withColumn("due_at", F.col("scheduled_completion") + grace_seconds * 1000)


def distinct_or_error(events: DataFrame) -> DataFrame:
    """One row for each event_id; rows that differ under one event_id are an error when the plan runs.

    One aggregation both drops repeats and compares the records, so events are read once.
    """
    record = F.sha2(F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"}), 256)
    one = events.groupBy("event_id").agg(F.first(F.struct(*events.columns)).alias("row"), F.min(record).alias("lo"), F.max(record).alias("hi"))
    checked = F.when(F.col("lo") == F.col("hi"), F.col("row")).otherwise(F.raise_error(F.concat(F.lit("conflicting records for one event ID: "), "event_id")))
    return one.select(checked.alias("row")).select("row.*")


def labelled(events: DataFrame, trips: DataFrame, agency: str, version: str, service_date: str, as_of: int) -> DataFrame:
    """Distinct events of the agency and day with the first reason to leave them out, or null for evidence."""
    rows = distinct_or_error(events.where(F.col("agency_id") == agency)).where(F.col("service_date") == service_date)
    known = trips.select(F.col("trip_id").alias("_trip")).distinct()
    rows = rows.join(known, F.col("trip_id") == F.col("_trip"), "left")
    reason = (
        F.when(F.col("unmatched_reason").isNotNull(), "unmatched")
        .when(~F.col("schedule_version").eqNullSafe(F.lit(version)), "schedule_version")
        .when(F.col("observed_at") > as_of, "after_as_of")
        .when(F.col("_trip").isNull(), "unscheduled_trip")
    )
    return rows.withColumn("excluded", reason).drop("_trip")


def trip_status(trips: DataFrame, evidence: DataFrame, as_of: int) -> DataFrame:
    """Scheduled trips, each with its status, whether its cancellation stands, and the digest of its evidence.

    A cancellation stands until a later update; telemetry, once heard, stays heard.
    """
    order = canonical_order()
    heard = is_update() | (~is_cancel() & F.col("payload.vehicle_position").isNotNull())
    e = evidence.groupBy(F.col("trip_id").alias("_trip")).agg(
        F.max(F.when(is_cancel(), order)).alias("c"), F.max(F.when(is_update(), order)).alias("u"), F.max(heard).alias("heard"), F.count("*").alias("n"), F.collect_set("event_id").alias("ids")
    )
    rows = trips.join(e, F.col("trip_id") == F.col("_trip"), "left")
    canceled = F.coalesce(F.col("c").isNotNull() & (F.col("u").isNull() | (F.col("c") > F.col("u"))), F.lit(False))
    status = F.when(F.lit(as_of) < F.col("due_at"), "not_due").when(canceled, "canceled").when(F.coalesce("heard", F.lit(False)), "telemetry_present").otherwise("missing_telemetry")
    return rows.select(
        "trip_id", "route_id", direction(F.col("direction_id")).alias("direction_id"), "scheduled_departure", "scheduled_completion", "due_at", status.alias("status"),
        canceled.alias("reported_canceled"), F.coalesce("n", F.lit(0)).cast("long").alias("evidence_count"), digest(F.coalesce("ids", F.array().cast("array<string>"))).alias("input_digest"),
    )


def route_coverage(statuses: DataFrame) -> DataFrame:
    """By route and direction; the rate is null where no trip was due and not canceled."""
    n = lambda s: F.count_if(F.col("status") == s)
    out = statuses.groupBy("route_id", "direction_id").agg(
        F.count("*").alias("scheduled_trip_count"), F.count_if(F.col("status") != "not_due").alias("due_trip_count"), n("not_due").alias("not_due_trip_count"),
        n("telemetry_present").alias("telemetry_trip_count"), n("canceled").alias("canceled_trip_count"), n("missing_telemetry").alias("missing_telemetry_trip_count"),
    )
    return out.withColumn("telemetry_coverage_rate", F.col("telemetry_trip_count") / F.nullif(F.col("due_trip_count") - F.col("canceled_trip_count"), F.lit(0)))


def coverage(events: DataFrame, trips: DataFrame, stop_times: DataFrame, *, agency: str, version: str, zone: str, service_date: str, as_of: int, grace_seconds: int = 300) -> Report:
    """The report over active trips (trip_id, route_id, direction_id) and enriched events.

    Trips are in order of their id, routes by route and direction, reasons by name. Conflicting records and trips without
    stop times are errors of whatever action runs a frame of the report.
    """
    if isinstance(grace_seconds, bool) or not isinstance(grace_seconds, int) or not 0 <= grace_seconds <= 86400:
        raise ValueError("grace seconds must be a whole number from 0 to 86400")
    due = trip_due_times(trips, stop_times, service_date, zone, grace_seconds)
    rows = labelled(events, trips, agency, version, service_date, as_of)
    status = trip_status(trips.select("trip_id", "route_id", "direction_id").join(due, "trip_id"), rows.where("excluded IS NULL"), as_of)
    header = {"schema_version": 1, "agency_id": agency, "schedule_version": version, "service_date": service_date, "as_of": as_of, "grace_seconds": grace_seconds, "agency_timezone": zone}
    excluded = rows.where("excluded IS NOT NULL").groupBy(F.col("excluded").alias("reason")).agg(F.count("*").alias("events"))
    return Report(header, excluded.orderBy("reason"), route_coverage(status).orderBy("route_id", "direction_id"), status.orderBy("trip_id"))
