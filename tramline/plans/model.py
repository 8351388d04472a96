"""Types of the records that travel through the engine, as DDL: a session is needed only where they are used."""

from __future__ import annotations

TRIP = "trip_id string, route_id string, start_date string, start_time string, direction_id int, schedule_relationship string"
POSITION = "latitude double, longitude double, bearing double, speed double, stop_id string, current_stop_sequence int, current_status string"
STOP_UPDATE = "stop_sequence int, stop_id string, arrival_delay int, arrival_time long, departure_delay int, departure_time long, schedule_relationship string"


def _nested(ddl: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (f.strip().split(" ", 1) for f in ddl.split(",")))


PAYLOAD = f"struct<trip: struct<{_nested(TRIP)}>, vehicle_position: struct<{_nested(POSITION)}>, trip_update: struct<stop_time_updates: array<struct<{_nested(STOP_UPDATE)}>>>, vehicle_id: string>"
EVENT_DDL = f"schema_version int, event_id string, agency_id string, feed_id string, entity_type string, entity_id string, trip_id string, route_id string, vehicle_id string, observed_at long, feed_generated_at long, ingested_at long, timestamp_source string, schedule_version string, payload_hash string, payload {PAYLOAD}"
EVENT = EVENT_DDL
ENRICHED = EVENT_DDL + ", direction_id int, service_date string, unmatched_reason string"
RAW_SNAPSHOT = "snapshot_id string, agency_id string, feed_id string, fetched_at long, url string, status_code int, content_type string, etag string, last_modified string, body binary"
MANIFEST = "schema_version int, snapshot_id string, agency_id string, feed_id string, fetched_at long, url string, status_code int, content_type string, etag string, last_modified string, object_uri string, body_sha256 string, body_bytes long"
DEAD_LETTER = "schema_version int, agency_id string, feed_id string, snapshot_id string, entity_id string, ingested_at long, reason string, detail string, object_uri string"
HISTORY = "event_id string, observed_at long, record_json string"
METRIC = (
    "schema_version int, generation string, agency_id string, route_id string, direction_id int, service_date string, window_start long, window_end long, version long, input_digest string, vehicle_count long, prediction_count long, canceled_trip_count long, arrival_count long, headway_count long, mean_delay_seconds double, p50_delay_seconds double, p95_delay_seconds double, adherence_rate double, mean_headway_seconds double, context_event_count long, headway_lookback_seconds long"
)
#: The columns of the schedule tables; all are strings where they are read.
SCHEDULE_TABLES = {
    "agency": ["agency_id", "agency_name", "agency_url", "agency_timezone"],
    "routes": ["route_id", "agency_id", "route_short_name", "route_long_name", "route_type"],
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon"],
    "trips": ["route_id", "service_id", "trip_id", "direction_id"],
    "stop_times": ["trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence"],
    "calendar": ["service_id", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "start_date", "end_date"],
    "calendar_dates": ["service_id", "date", "exception_type"],
}
