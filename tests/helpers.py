"""Events for tests, with the parts that a case cares about."""

from __future__ import annotations

from pyspark.sql.types import StructType

from tramline.plans.model import ENRICHED

BASE = {"schema_version": 1, "agency_id": "demo", "feed_id": "feed", "route_id": "R1", "vehicle_id": "V1", "trip_id": "T1", "direction_id": 0, "service_date": "2026-09-10", "schedule_version": "v"}


def event(event_id, at, *, status=None, stop=None, delay=None, updates=None, relationship="SCHEDULED", lat=None, **more):
    e = {**BASE, "event_id": event_id, "observed_at": at, **more}
    position = None
    if status or stop is not None and delay is None and updates is None:
        position = {"latitude": lat, "longitude": lat, "bearing": None, "speed": None, "stop_id": stop, "current_stop_sequence": None, "current_status": status}
    if delay is not None:
        updates = [(stop or "S1", 1, delay)]
    update = None
    if updates is not None:
        update = {"stop_time_updates": [{"stop_sequence": q, "stop_id": s, "arrival_delay": d, "arrival_time": None, "departure_delay": None, "departure_time": None, "schedule_relationship": None} for s, q, d in updates]}
    trip = {"trip_id": e["trip_id"], "route_id": e["route_id"], "start_date": (e["service_date"] or "").replace("-", ""), "start_time": None, "direction_id": None, "schedule_relationship": relationship}
    e["payload"] = {"trip": trip, "vehicle_position": position, "trip_update": update, "vehicle_id": e["vehicle_id"]}
    return e


def frame(spark, events):
    schema = StructType.fromDDL(ENRICHED)
    return spark.createDataFrame([{f: e.get(f) for f in schema.names} for e in events], schema)


def one(df):
    (row,) = df.collect()
    return row
