"""Schedule versions, service days, and the enrichment of events from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tramline.functions.scalars import direction, strict_date, weekday

WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def version_ranges(versions: DataFrame) -> DataFrame:
    """agency_id, schedule_version, effective_from, effective_to: a version holds until the agency's next begins."""
    w = Window.partitionBy("agency_id").orderBy("effective_from")
    return versions.withColumn("effective_to", F.lead("effective_from").over(w))


def choose_version(events: DataFrame, versions: DataFrame) -> DataFrame:
    """Events with the schedule_version in force when they were observed; null before an agency's first.

    An as-of join as a range join on agency. Versions of an agency are few; Spark broadcasts the side if it is
    below its own size limit and joins by agency otherwise.
    """
    v = version_ranges(versions).select(F.col("agency_id").alias("_agency"), F.col("schedule_version").alias("chosen_version"), "effective_from", "effective_to")
    on = (F.col("agency_id") == F.col("_agency")) & (F.col("observed_at") >= F.col("effective_from")) & (F.col("effective_to").isNull() | (F.col("observed_at") < F.col("effective_to")))
    return events.join(v, on, "left").drop("_agency", "effective_from", "effective_to")


def service_calendar(calendar: DataFrame) -> DataFrame:
    """One row for each (version, service, weekday) that runs, with its range of dates."""
    flags = F.explode(F.array(*[F.struct(F.lit(d).alias("weekday"), F.col(d).alias("flag")) for d in WEEKDAYS]))
    return calendar.select("schedule_version", "service_id", "start_date", "end_date", flags.alias("x")).where("x.flag = '1'").select("schedule_version", "service_id", F.col("x.weekday").alias("weekday"), "start_date", "end_date")


def last_exceptions(calendar_dates: DataFrame) -> DataFrame:
    """The last listed exception of each service and date; `row_no` is the place in the file."""
    return calendar_dates.groupBy("schedule_version", "service_id", "date").agg(F.max_by("exception_type", "row_no").alias("exception_type"))


def with_activity(rows: DataFrame, calendar: DataFrame, calendar_dates: DataFrame, day: str = "start_date") -> DataFrame:
    """Rows (schedule_version, service_id, a yyyyMMdd day) with `active`: an exception decides, else the calendar."""
    date = strict_date(F.col(day))
    out = rows.join(service_days(calendar, calendar_dates), ["schedule_version", "service_id"], "left")
    on = F.exists("_runs", lambda r: F.col(day).between(r["start_date"], r["end_date"]) & (r["weekday"] == weekday(date)))
    active = F.coalesce(F.element_at("_exceptions", F.col(day)) == "1", on, F.lit(False))
    return out.withColumn("active", date.isNotNull() & active).drop("_runs", "_exceptions")


def service_days(calendar: DataFrame, calendar_dates: DataFrame) -> DataFrame:
    """One row for each (schedule_version, service_id): its weekly ranges, and its exceptions by date.

    A service has seven ranges a calendar row and an exception a date, so its row is small; rows of any number meet
    it in one join by equality, without being told apart by day first.
    """
    key = ["schedule_version", "service_id"]
    runs = service_calendar(calendar).groupBy(*key).agg(F.collect_list(F.struct("weekday", "start_date", "end_date")).alias("_runs"))
    exceptions = last_exceptions(calendar_dates).where("date IS NOT NULL").groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("date", "exception_type"))).alias("_exceptions"))
    return runs.join(exceptions, key, "full")


def unmatched_reason(version: Column, service: Column, start_date: Column, active: Column) -> Column:
    """The first reason that holds: no version, unknown trip, no date, no valid date, no service on that day."""
    return (
        F.when(version.isNull(), "schedule_unavailable")
        .when(service.isNull(), "unknown_trip")
        .when(F.coalesce(start_date, F.lit("")) == "", "ambiguous_service_date")
        .when(strict_date(start_date).isNull(), "invalid_service_date")
        .when(~active, "inactive_service")
    )


def enrich(events: DataFrame, versions: DataFrame, trips: DataFrame, calendar: DataFrame, calendar_dates: DataFrame) -> DataFrame:
    """Events with schedule_version, route_id, direction_id and service_date of the schedule in force, or a reason.

    Where a reason is given, service_date is null and the event keeps its own route. Schedule tables carry
    schedule_version and join on it, so no version's rows meet another's.
    """
    return match_trips(choose_version(events.drop("schedule_version"), versions), trips, calendar, calendar_dates)


def match_trips(rows: DataFrame, trips: DataFrame, calendar: DataFrame, calendar_dates: DataFrame) -> DataFrame:
    """The same for events that have their chosen_version already."""
    rows = rows.withColumn("start_date", F.col("payload.trip.start_date"))
    t = trips.select(F.col("schedule_version").alias("_v"), F.col("trip_id").alias("_t"), "service_id", F.col("route_id").alias("_route"), F.col("direction_id").alias("_direction"))
    rows = rows.join(t, (F.col("chosen_version") == F.col("_v")) & (F.col("trip_id") == F.col("_t")), "left").drop("_v", "_t").withColumnRenamed("chosen_version", "schedule_version")
    rows = with_activity(rows, calendar, calendar_dates)
    reason = unmatched_reason(F.col("schedule_version"), F.col("service_id"), F.col("start_date"), F.col("active"))
    rows = rows.withColumn("unmatched_reason", reason)
    matched = F.col("unmatched_reason").isNull()
    new = {
        "route_id": F.when(matched, F.col("_route")).otherwise(F.col("route_id")),
        "direction_id": F.when(matched, direction(F.col("_direction"))),
        "service_date": F.when(matched, F.date_format(strict_date(F.col("start_date")), "yyyy-MM-dd")),
    }
    return rows.withColumns(new).drop("_route", "_direction", "service_id", "start_date", "active")


def split_matched(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    return enriched.where("unmatched_reason IS NULL"), enriched.where("unmatched_reason IS NOT NULL")


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """rule, key: references that lead nowhere and keys that are not unique, over the tables of one schedule."""
    out = []

    def dangling(rule, child, column, parent, parent_column):
        c = tables[child].select(F.col(column).alias("key")).where("key IS NOT NULL").distinct()
        out.append(c.join(tables[parent].select(F.col(parent_column).alias("key")), "key", "left_anti").select(F.lit(rule).alias("rule"), "key"))

    def repeated(rule, table, *columns):
        out.append(tables[table].groupBy(*columns).count().where("count > 1").select(F.lit(rule).alias("rule"), F.concat_ws("/", *columns).alias("key")))

    dangling("trip_route", "trips", "route_id", "routes", "route_id")
    services = tables["calendar"].select("service_id").unionByName(tables["calendar_dates"].select("service_id"))
    tables = {**tables, "services": services}
    dangling("trip_service", "trips", "service_id", "services", "service_id")
    dangling("stop_time_trip", "stop_times", "trip_id", "trips", "trip_id")
    dangling("stop_time_stop", "stop_times", "stop_id", "stops", "stop_id")
    for rule, table, *columns in (("route_unique", "routes", "route_id"), ("stop_unique", "stops", "stop_id"), ("trip_unique", "trips", "trip_id"), ("stop_time_unique", "stop_times", "trip_id", "stop_sequence")):
        repeated(rule, table, *columns)
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found
