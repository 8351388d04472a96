"""Realtime feeds: decoding protobuf bodies, then validating and normalising entities as columns."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.identity import event_id, payload_hash
from tramline.functions.scalars import snapshot_id, text
from tramline.operators.ops import event_time
from tramline.plans.model import PAYLOAD, POSITION, STOP_UPDATE, TRIP, _nested

# Fixed values of the public feed format: message fields by number, type and label, and enumerations.
MESSAGES = {
    "FeedMessage": "1 header FeedHeader required, 2 entity FeedEntity repeated",
    "FeedHeader": "1 gtfs_realtime_version string required, 2 incrementality Incrementality optional, 3 timestamp uint64 optional",
    "FeedEntity": "1 id string required, 2 is_deleted bool optional, 3 trip_update TripUpdate optional, 4 vehicle VehiclePosition optional",
    "TripUpdate": "1 trip TripDescriptor required, 2 stop_time_update StopTimeUpdate repeated, 3 vehicle VehicleDescriptor optional, 4 timestamp uint64 optional, 5 delay int32 optional",
    "StopTimeEvent": "1 delay int32 optional, 2 time int64 optional, 3 uncertainty int32 optional",
    "StopTimeUpdate": "1 stop_sequence uint32 optional, 2 arrival StopTimeEvent optional, 3 departure StopTimeEvent optional, 4 stop_id string optional, 5 schedule_relationship StopRelationship optional",
    "VehiclePosition": "1 trip TripDescriptor optional, 2 position Position optional, 3 current_stop_sequence uint32 optional, 4 current_status VehicleStopStatus optional, 5 timestamp uint64 optional, 7 stop_id string optional, 8 vehicle VehicleDescriptor optional",
    "Position": "1 latitude float required, 2 longitude float required, 3 bearing float optional, 4 odometer double optional, 5 speed float optional",
    "TripDescriptor": "1 trip_id string optional, 2 start_time string optional, 3 start_date string optional, 4 schedule_relationship TripRelationship optional, 5 route_id string optional, 6 direction_id uint32 optional",
    "VehicleDescriptor": "1 id string optional, 2 label string optional, 3 license_plate string optional",
}
ENUMS = {
    "Incrementality": {"FULL_DATASET": 0, "DIFFERENTIAL": 1},
    "StopRelationship": {"SCHEDULED": 0, "SKIPPED": 1, "NO_DATA": 2, "UNSCHEDULED": 3},
    "VehicleStopStatus": {"INCOMING_AT": 0, "STOPPED_AT": 1, "IN_TRANSIT_TO": 2},
    "TripRelationship": {"SCHEDULED": 0, "ADDED": 1, "UNSCHEDULED": 2, "CANCELED": 3, "REPLACEMENT": 5, "DUPLICATED": 6, "DELETED": 7},
}

DECODED = f"snapshot int, error string, incrementality int, header_timestamp long, entity_id string, missing string, is_deleted boolean, has_vehicle boolean, has_update boolean, timestamp long, trip struct<{_nested(TRIP)}>, vehicle_id string, position struct<{_nested(POSITION)}>, has_position boolean, stops array<struct<{_nested(STOP_UPDATE)}>>"


@lru_cache(1)
def feed_message():
    """The message class of a feed, built from the tables above."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    file = descriptor_pb2.FileDescriptorProto(name="feed.proto", package="feed", syntax="proto2")
    field = descriptor_pb2.FieldDescriptorProto
    for name, values in ENUMS.items():
        e = file.enum_type.add(name=name)
        for v, n in values.items():
            e.value.add(name=f"{name}_{v}", number=n)
    for name, fields in MESSAGES.items():
        m = file.message_type.add(name=name)
        for f in fields.split(", "):
            number, label, kind, rule = f.split(" ")
            new = m.field.add(name=label, number=int(number), label=getattr(field, f"LABEL_{rule.upper()}"))
            if kind in MESSAGES:
                new.type, new.type_name = field.TYPE_MESSAGE, f".feed.{kind}"
            elif kind in ENUMS:
                new.type, new.type_name = field.TYPE_ENUM, f".feed.{kind}"
                if kind == "VehicleStopStatus":
                    new.default_value = f"{kind}_IN_TRANSIT_TO"
            else:
                new.type = getattr(field, f"TYPE_{kind.upper()}")
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file) if hasattr(pool, "Add") else pool.AddSerializedFile(file.SerializeToString())
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("feed.FeedMessage"))


_NAMES = {e: {n: v for v, n in values.items()} for e, values in ENUMS.items()}


def _get(message, field):
    return getattr(message, field) if message is not None and message.HasField(field) else None


def _entities(body: bytes) -> list[dict]:
    """One record for each entity, or one with the error of the whole body. Presence is kept: what is absent is null."""
    message = feed_message()()
    try:
        message.ParseFromString(body or b"")
    except Exception as e:  # the decoder's error classes differ between its implementations
        return [{"error": f"protobuf_decode_error: {e}"}]
    if not message.HasField("header") or not message.header.IsInitialized():
        return [{"error": "validation_error: the feed header lacks required fields"}]
    head = {"incrementality": message.header.incrementality, "header_timestamp": _get(message.header, "timestamp")}
    if head["incrementality"] == ENUMS["Incrementality"]["DIFFERENTIAL"]:
        return [{"error": "validation_error: differential feeds are not supported"}]
    out = []
    for e in message.entity:
        source = e.vehicle if e.HasField("vehicle") else e.trip_update if e.HasField("trip_update") else None
        trip, vehicle = _get(source, "trip"), _get(source, "vehicle")
        row = head | {
            "entity_id": e.id, "missing": ", ".join(e.FindInitializationErrors()) or None, "is_deleted": e.is_deleted, "has_vehicle": e.HasField("vehicle"), "has_update": e.HasField("trip_update"),
            "timestamp": _get(source, "timestamp"), "vehicle_id": vehicle.id if vehicle is not None else None,
        }
        if trip is not None:
            row["trip"] = {"trip_id": trip.trip_id, "route_id": trip.route_id, "start_date": trip.start_date, "start_time": trip.start_time, "direction_id": _get(trip, "direction_id"), "schedule_relationship": _NAMES["TripRelationship"].get(trip.schedule_relationship)}
        if e.HasField("vehicle"):
            p, status = _get(e.vehicle, "position"), _get(e.vehicle, "current_status")
            row["has_position"] = p is not None
            row["position"] = {**{k: _get(p, k) for k in ("latitude", "longitude", "bearing", "speed")}, "stop_id": e.vehicle.stop_id, "current_stop_sequence": _get(e.vehicle, "current_stop_sequence"), "current_status": _NAMES["VehicleStopStatus"].get(status)}
        elif e.HasField("trip_update"):
            row["stops"] = [
                {"stop_sequence": _get(s, "stop_sequence"), "stop_id": s.stop_id, "arrival_delay": _get(_get(s, "arrival"), "delay"), "arrival_time": _get(_get(s, "arrival"), "time"), "departure_delay": _get(_get(s, "departure"), "delay"), "departure_time": _get(_get(s, "departure"), "time"), "schedule_relationship": _NAMES["StopRelationship"].get(_get(s, "schedule_relationship"))}
                for s in e.trip_update.stop_time_update
            ]
        out.append(row)
    return out


def decode(snapshots: DataFrame) -> DataFrame:
    """Snapshots (agency_id, feed_id, fetched_at, body) as one row an entity; the only step in Python."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ddl = f"agency_id string, feed_id string, ingested_at long, snapshot_id string, {DECODED}"
    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [{**{k: s[k] for k in ("agency_id", "feed_id", "ingested_at", "snapshot_id")}, **e} for s in b.to_pylist() for e in _entities(s["body"])]
            yield pa.RecordBatch.from_pylist(rows, arrow)

    keyed = snapshots.select("agency_id", "feed_id", F.col("fetched_at").alias("ingested_at"), snapshot_id(F.col("feed_id"), F.col("body")).alias("snapshot_id"), "body")
    return keyed.mapInArrow(run, schema)


def first_problem() -> Column:
    """The first reason against an entity, as `kind: detail`; null if it is sound."""
    lat, lon = F.col("position.latitude"), F.col("position.longitude")
    at, _ = event_time(F.col("timestamp"), F.col("header_timestamp"))
    bad = lambda m: F.lit(f"validation_error: {m}")
    return (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("missing").isNotNull(), F.concat(bad("missing required fields: "), F.col("missing")))
        .when(F.col("is_deleted"), bad("deleted entities are not supported"))
        .when(F.coalesce(F.col("entity_id"), F.lit("")) == "", bad("the entity has no ID"))
        .when(F.col("has_vehicle") == F.col("has_update"), bad("an entity has exactly one of vehicle and trip update"))
        .when(F.col("has_vehicle") & ~F.coalesce(F.col("has_position"), F.lit(False)), bad("the vehicle has no latitude and longitude"))
        .when(F.col("has_vehicle") & ~(lat.between(-90, 90) & lon.between(-180, 180)), bad("coordinates out of range"))
        .when(at.isNull(), bad("neither entity nor feed header has a time"))
    )


def normalise(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events with content identities, and dead letters, from decoded entities. Problems of one leave the others alone."""
    rows = decoded.withColumn("_problem", first_problem())
    good = rows.where("_problem IS NULL")
    observed, source = event_time(F.col("timestamp"), F.col("header_timestamp"))
    trip = F.when(F.col("trip").isNotNull(), F.struct(*[text(F.col(f"trip.{c}")).alias(c) for c in ("trip_id", "route_id", "start_date", "start_time")], "trip.direction_id", "trip.schedule_relationship"))
    position = F.when(F.col("has_vehicle"), F.col("position").withField("stop_id", text(F.col("position.stop_id"))))
    stops = F.when(F.col("has_update"), F.struct(F.transform("stops", lambda s: s.withField("stop_id", text(s["stop_id"]))).alias("stop_time_updates")))
    payload = F.struct(trip.alias("trip"), position.alias("vehicle_position"), stops.alias("trip_update"), text(F.col("vehicle_id")).alias("vehicle_id")).cast(PAYLOAD)
    kind = F.when(F.col("has_vehicle"), "vehicle_position").otherwise("trip_update")
    base = good.select(
        "agency_id", "feed_id", "ingested_at", kind.alias("entity_type"), "entity_id", observed.alias("observed_at"), (F.nullif(F.col("header_timestamp"), F.lit(0)) * 1000).alias("feed_generated_at"),
        source.alias("timestamp_source"), payload.alias("payload"),
    )
    base = base.withColumn("payload_hash", payload_hash(F.col("payload")))
    ident = event_id(F.col("agency_id"), F.col("feed_id"), F.col("entity_type"), F.col("entity_id"), F.col("observed_at"), F.col("payload_hash"))
    events = base.select(
        F.lit(1).alias("schema_version"), ident.alias("event_id"), "agency_id", "feed_id", "entity_type", "entity_id", F.col("payload.trip.trip_id").alias("trip_id"), F.col("payload.trip.route_id").alias("route_id"),
        F.col("payload.vehicle_id").alias("vehicle_id"), "observed_at", "feed_generated_at", "ingested_at", "timestamp_source", F.lit(None).cast("string").alias("schedule_version"), "payload_hash", "payload",
    )
    split = F.split("_problem", ": ", 2)
    letters = rows.where("_problem IS NOT NULL").select(
        F.lit(1).alias("schema_version"), "agency_id", "feed_id", "snapshot_id", text(F.col("entity_id")).alias("entity_id"), "ingested_at", split[0].alias("reason"), split[1].alias("detail"), F.concat(F.lit("raw/"), F.sha2(F.concat_ws("\u0000", "agency_id", "feed_id"), 256), F.lit("/"), "snapshot_id", F.lit(".pb")).alias("object_uri"),
    )
    return events, letters
