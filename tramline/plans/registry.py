"""Registered queries of the engine over the driver's tables, each with its DuckDB SQL where there is one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tramline.functions import identity as I
from tramline.functions import scalars as S
from tramline.operators import coverage as C
from tramline.operators import headways as H
from tramline.operators import ops
from tramline.operators import quality as Q
from tramline.operators import replay as R
from tramline.operators import schedules as SC
from tramline.operators import serving as V
from tramline.operators import windows as W
from tramline.plans import oracles as O
from tramline.plans.adapter import as_events, observations, observed, one_day, schedule, stop_times, table
from tramline.plans.config import WINDOW_KEY, Settings
from tramline.plans.model import METRIC
from tramline.streaming import job as SJ
from tramline.streaming import processors as SP
from tramline.streaming import runner as ST

SIX = Settings(window=O.H6, lookback=O.H48)
FIVE = Settings()
QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# ---- scans, projections, scalars -------------------------------------------------------------------


@query(f"WITH {O.OBS} SELECT event_id, observed_at, route_id, trip_id FROM obs WHERE agency_id = 'demo' AND kind = 'visit' AND observed_at >= 1705276800000")
def scan_filter_project(spark, d):
    return observed(table(spark, d, "events")).where("agency_id = 'demo' AND kind = 'visit' AND observed_at >= 1705276800000").select("event_id", "observed_at", "route_id", "trip_id")


@query("SELECT event_id, coalesce(try_cast(props->>'$.k' AS BIGINT), 0) AS k, try_cast(props->>'$.missing' AS DOUBLE) AS missing FROM events")
def json_extract_typed(spark, d):
    j = lambda p: F.get_json_object("props", p)
    return table(spark, d, "events").select("event_id", F.coalesce(j("$.k").try_cast("long"), F.lit(0)).cast("long").alias("k"), j("$.missing").try_cast("double").alias("missing"))


@query("WITH t AS (SELECT event_id, nullif((props->>'$.k')::BIGINT % 5, 0) AS entity, nullif(user_id % 3, 0) AS header FROM events) SELECT event_id, coalesce(entity, header) * 1000 AS observed_at, CASE WHEN entity IS NOT NULL THEN 'entity' WHEN header IS NOT NULL THEN 'feed_header' END AS timestamp_source FROM t")
def event_time_choice(spark, d):
    k = F.get_json_object("props", "$.k").try_cast("long")
    at, source = ops.event_time(k % 5, F.col("user_id") % 3)
    return table(spark, d, "events").select("event_id", at.alias("observed_at"), source.alias("timestamp_source"))


@query("SELECT c_custkey, coalesce(try_cast(nullif(CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 5 = 0 THEN NULL ELSE (c_custkey % 2)::VARCHAR END, '') AS INT), -1) AS direction_id FROM customer")
def direction_default(spark, d):
    raw = F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 5 == 0, None).otherwise((F.col("c_custkey") % 2).cast("string"))
    return table(spark, d, "customer").select("c_custkey", S.direction(raw).alias("direction_id"))


@query("SELECT o_orderkey, nullif(CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderstatus END, '') AS status FROM orders")
def nullif_empty(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.text(F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.col("o_orderstatus"))).alias("status"))


@query("SELECT event_id, t - ((t % 300000) + 300000) % 300000 AS window_start FROM (SELECT event_id, epoch_us(ts) // 1000 - 1705000000000 AS t FROM events)")
def window_start_floor(spark, d):
    return table(spark, d, "events").select("event_id", S.window_start(F.unix_millis(F.col("ts").cast("timestamp")) - 1705000000000, 300_000).alias("window_start"))


_CLOCK = "CASE WHEN o_orderkey % 11 = 0 THEN '8:75:00' WHEN o_orderkey % 13 = 0 THEN 'noon' ELSE (o_orderkey % 130)::VARCHAR || ':' || lpad((o_orderkey % 60)::VARCHAR, 2, '0') || ':' || lpad((o_custkey % 60)::VARCHAR, 2, '0') END"


@query(f"WITH c AS (SELECT o_orderkey, {_CLOCK} AS clock FROM orders) SELECT o_orderkey, clock, CASE WHEN regexp_full_match(clock, '[0-9]{{1,3}}:[0-5][0-9]:[0-5][0-9]') THEN (split_part(clock, ':', 1)::INT * 3600 + split_part(clock, ':', 2)::INT * 60 + split_part(clock, ':', 3)::INT) END AS seconds FROM c")
def gtfs_clock_seconds(spark, d):
    two = lambda c: F.lpad((F.col(c) % 60).cast("string"), 2, "0")
    clock = F.when(F.col("o_orderkey") % 11 == 0, "8:75:00").when(F.col("o_orderkey") % 13 == 0, "noon").otherwise(F.concat_ws(":", (F.col("o_orderkey") % 130).cast("string"), two("o_orderkey"), two("o_custkey")))
    return table(spark, d, "orders").select("o_orderkey", clock.alias("clock"), S.clock_seconds(clock).alias("seconds"))


@query("WITH c AS (SELECT o_orderkey, DATE '2026-03-01' + (o_orderkey % 270)::INT AS day, (o_custkey % 30 * 3600)::INT AS s FROM orders) SELECT o_orderkey, day, epoch(timezone('America/Los_Angeles', day + INTERVAL 12 HOUR))::BIGINT - 43200 + s AS instant FROM c")
def service_instant(spark, d):
    day = F.date_add(F.lit("2026-03-01").cast("date"), (F.col("o_orderkey") % 270).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", day.alias("day"), S.service_instant(day, (F.col("o_custkey") % 30 * 3600).cast("int"), "America/Los_Angeles").alias("instant"))


@query("SELECT o_orderkey, lower(dayname(o_orderdate)) AS weekday FROM orders")
def weekday_name(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.weekday(F.col("o_orderdate")).alias("weekday"))


_DAY8 = "CASE o_orderkey % 7 WHEN 0 THEN '20260231' WHEN 1 THEN '2026910' WHEN 2 THEN '20260910Z' WHEN 3 THEN '' ELSE strftime(o_orderdate, '%Y%m%d') END"


@query(f"SELECT o_orderkey, CASE WHEN regexp_full_match({_DAY8}, '[0-9]{{8}}') THEN try_strptime({_DAY8}, '%Y%m%d')::DATE END AS day FROM orders")
def strict_date_parse(spark, d):
    k = F.col("o_orderkey") % 7
    raw = F.when(k == 0, "20260231").when(k == 1, "2026910").when(k == 2, "20260910Z").when(k == 3, "").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return table(spark, d, "orders").select("o_orderkey", S.strict_date(raw).alias("day"))


@query("SELECT page_id, sha256('feed' || chr(0) || html) AS snapshot_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '^([A-Za-z][A-Za-z0-9+.-]*://)[^/@]*@', '\\1') AS url FROM pages")
def snapshot_identity(spark, d):
    return table(spark, d, "pages").select("page_id", S.snapshot_id(F.lit("feed"), F.encode("html", "UTF-8")).alias("snapshot_id"), S.redacted(F.col("url")).alias("url"))


@query(f"WITH {O.windows(O.M5)} SELECT {O.KEY}, input_digest FROM base")
def sha_digest_by_window(spark, d):
    rows = W.windowed(observations(spark, d), FIVE)
    return rows.groupBy(*WINDOW_KEY).agg(S.digest(F.collect_set("event_id")).alias("input_digest"))


@query(f"WITH {O.OBS} SELECT event_id, observed_at, sha256(event_id) AS id_sha FROM obs")
def history_rows(spark, d):
    rows = ops.history_rows(observed(table(spark, d, "events")))
    return rows.select("event_id", "observed_at", F.sha2(F.get_json_object("record_json", "$.event_id"), 256).alias("id_sha"))


@query(f"WITH {O.OBS} SELECT event_id, sha256('[\"demo\",\"f\u00e9ed\",\"' || kind || '\",\"' || trip_id || '\",' || observed_at || ',\"' || sha256(event_id) || '\"]') AS identity FROM obs")
def event_identity(spark, d):
    o = observed(table(spark, d, "events"))
    return o.select("event_id", I.event_id(F.col("agency_id"), F.lit("f\u00e9ed"), F.col("kind"), F.col("trip_id"), F.col("observed_at"), F.sha2("event_id", 256)).alias("identity"))


# ---- deduplication, lateness, history --------------------------------------------------------------


@query(f"WITH {O.OBS}, twice AS (SELECT * FROM obs UNION ALL SELECT * FROM obs WHERE kind = 'visit') SELECT DISTINCT ON (event_id) event_id, observed_at, kind FROM twice ORDER BY event_id")
def dedup_events(spark, d):
    o = observed(table(spark, d, "events"))
    return ops.distinct_events(o.unionByName(o.where("kind = 'visit'"))).select("event_id", "observed_at", "kind")


_LATE = f"WITH {O.OBS}, a AS (SELECT *, observed_at + (hash_no * 7919 % 1000000) AS arrives FROM (SELECT *, substr(event_id, 2)::BIGINT AS hash_no FROM obs)), b AS (SELECT *, max(observed_at) OVER (ORDER BY arrives, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 30000 AS wm FROM a)"


@query(f"{_LATE} SELECT event_id, observed_at, wm AS watermark, coalesce(observed_at <= wm - 120000, false) AS late FROM b")
def late_audit_batch(spark, d):
    o = observed(table(spark, d, "events")).withColumn("n", F.substring("event_id", 2, 20).cast("long"))
    o = o.withColumn("arrives", F.col("observed_at") + F.col("n") * 7919 % 1_000_000)
    return ops.late_audit(o, "arrives", FIVE).select("event_id", "observed_at", "watermark", "late")


@query("SELECT event_id, epoch_us(ts) // 1000 AS version, CASE WHEN event_type = 'view' THEN 'a' ELSE 'b' END AS branch FROM events WHERE event_type IN ('view', 'click') UNION ALL SELECT event_id, 0 AS version, 'late' AS branch FROM events WHERE event_type = 'error'")
def union_late_outputs(spark, d):
    e = table(spark, d, "events")
    metrics = e.where("event_type IN ('view', 'click')").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("version"), F.when(F.col("event_type") == "view", "a").otherwise("b").alias("branch"))
    late = e.where("event_type = 'error'").select("event_id", F.lit(0).cast("long").alias("version"), F.lit("late").alias("branch"))
    return metrics.unionByName(late)


# ---- schedules --------------------------------------------------------------------------------------


@query(f"WITH {O.OBS}, {O.SCHEDULE} SELECT o.event_id, v.schedule_version FROM obs o ASOF LEFT JOIN (SELECT * FROM versions WHERE agency_id = 'demo') v ON o.agency_id = v.agency_id AND o.observed_at >= v.effective_from")
def asof_schedule_version(spark, d):
    return SC.choose_version(observed(table(spark, d, "events")), schedule(spark, d)["versions"]).select("event_id", F.col("chosen_version").alias("schedule_version"))


def _enriched(spark, d):
    s = schedule(spark, d)
    return SC.enrich(observations(spark, d), s["versions"], s["trips"], s["calendar"], s["calendar_dates"])


@query(f"WITH {O.ENRICHED} SELECT event_id, schedule_version, route_id, direction_id, service_date, unmatched_reason FROM enr")
def schedule_enrich(spark, d):
    return _enriched(spark, d).select("event_id", "schedule_version", "route_id", "direction_id", "service_date", "unmatched_reason")


@query(f"WITH {O.ENRICHED} SELECT coalesce(unmatched_reason, 'matched') AS reason, count(*) AS events FROM enr GROUP BY ALL")
def unmatched_reasons(spark, d):
    return _enriched(spark, d).groupBy(F.coalesce("unmatched_reason", F.lit("matched")).alias("reason")).agg(F.count("*").alias("events"))


@query(f"WITH {O.OBS}, {O.SCHEDULE} SELECT o.event_id, s.route, s.service_id FROM obs o LEFT JOIN sched s ON o.trip_id = s.trip_id")
def trip_lookup(spark, d):
    t = schedule(spark, d)["trips"].where("schedule_version = 'v1'").select("trip_id", F.col("route_id").alias("route"), "service_id")
    return observed(table(spark, d, "events")).select("event_id", "trip_id").join(t, "trip_id", "left").drop("trip_id")


_DAYS = f"WITH {O.SCHEDULE}, days AS (SELECT DISTINCT c_mktsegment AS service_id, strftime(DATE '2024-01-01' + x::INT, '%Y%m%d') AS start_date FROM customer, range(31) r(x))"


def _days(spark, d):
    n = F.explode(F.sequence(F.lit(0), F.lit(30)))
    base = table(spark, d, "customer").select(F.col("c_mktsegment").alias("service_id")).distinct().withColumn("x", n)
    return base.select("service_id", F.lit("v1").alias("schedule_version"), F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("x")), "yyyyMMdd").alias("start_date"))


@query(f"{_DAYS} SELECT service_id, start_date, EXISTS (SELECT 1 FROM cal c WHERE c.service_id = days.service_id AND start_date BETWEEN c.start_date AND c.end_date AND substr(c.flags, isodow(strptime(days.start_date, '%Y%m%d'))::INT, 1) = '1') AS active FROM days".replace("AND start_date BETWEEN", "AND days.start_date BETWEEN"))
def calendar_active(spark, d):
    s = schedule(spark, d)
    return SC.with_activity(_days(spark, d), s["calendar"], s["calendar_dates"].limit(0)).select("service_id", "start_date", "active")


@query(f"{_DAYS} SELECT service_id, start_date, {O.active('days.service_id', 'days.start_date')} AS active FROM days")
def calendar_exceptions(spark, d):
    s = schedule(spark, d)
    return SC.with_activity(_days(spark, d), s["calendar"], s["calendar_dates"]).select("service_id", "start_date", "active")


@query("SELECT 'line_order' AS rule, l_orderkey AS key FROM (SELECT DISTINCT l_orderkey FROM lineitem) l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderkey % 50 <> 0) UNION ALL SELECT 'line_part', l_partkey FROM (SELECT DISTINCT l_partkey FROM lineitem) l WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_partkey % 40 <> 0)")
def referential_integrity(spark, d):
    line, o, p = (table(spark, d, t) for t in ("lineitem", "orders", "part"))
    a = ops.dangling(line, "l_orderkey", o.where("o_orderkey % 50 <> 0"), "o_orderkey").select(F.lit("line_order").alias("rule"), "key")
    return a.unionByName(ops.dangling(line, "l_partkey", p.where("p_partkey % 40 <> 0"), "p_partkey").select(F.lit("line_part").alias("rule"), "key"))


# ---- windows ----------------------------------------------------------------------------------------


@query(f"WITH {O.windows(O.H6)} {O.v2_rows(O.H6)}")
def route_window_v2(spark, d):
    return rounded(W.route_windows(observations(spark, d), SIX))


@query(f"WITH {O.windows(O.M5)} {O.v2_rows(O.M5)}")
def route_window_v2_5min(spark, d):
    return rounded(W.route_windows(observations(spark, d), FIVE))


@query(f"WITH {O.windows(O.H6)} SELECT {O.KEY}, trip_id, stop_id, stop_sequence, arrival_delay AS delay FROM live")
def latest_prediction(spark, d):
    return W.latest_predictions(W.windowed(observations(spark, d), SIX)).drop("observed_at", "event_id")


@query(f"WITH {O.windows(O.H6)} SELECT {O.KEY}, trip_id, lc IS NOT NULL AND (lu IS NULL OR lc > lu) AS canceled FROM trips")
def canceled_trips(spark, d):
    return W.trip_states(W.windowed(observations(spark, d), SIX)).drop("last_cancel", "last_update")


@query(f"WITH {O.windows(O.H6)} SELECT {O.KEY}, prediction_count, round(mean_delay_seconds, 6) AS mean_delay_seconds, p50_delay_seconds, p95_delay_seconds, round(adherence_rate, 6) AS adherence_rate FROM delays")
def delay_stats(spark, d):
    return rounded(W.delay_statistics(W.latest_predictions(W.windowed(observations(spark, d), SIX)), SIX))


@query(f"WITH {O.windows(O.H6)} SELECT {O.KEY}, vehicle_count FROM base")
def vehicle_count(spark, d):
    return W.windowed(observations(spark, d), SIX).groupBy(*WINDOW_KEY).agg(F.count_distinct("vehicle_id").alias("vehicle_count"))


@query(f"WITH {O.windows(O.H6)} SELECT * FROM visits")
def first_stop_visits(spark, d):
    return W.first_visits(W.windowed(observations(spark, d), SIX))


@query(f"WITH {O.windows(O.H6)} SELECT {O.KEY}, arrival_count, headway_count, round(mean_headway_seconds, 6) AS mean_headway_seconds FROM hw")
def headways_in_window(spark, d):
    return rounded(W.headways(W.first_visits(W.windowed(observations(spark, d), SIX))))


_V3 = f"WITH RECURSIVE {O.accepted(O.H6, O.H48)}"


def _visits(spark, d):
    return H.accepted_visits(W.windowed(one_day(observations(spark, d)), SIX), SIX)


@query(f"{_V3} SELECT {O.ROUTE}, stop_id, trip_id, observed_at, event_id FROM acc")
def accepted_visits(spark, d):
    return _visits(spark, d).drop("earlier")


@query(f"{_V3} SELECT event_id, gap FROM cross_gaps")
def headways_cross_window(spark, d):
    return H.predecessor_gaps(_visits(spark, d), SIX).select("event_id", "gap")


@query(f"{_V3} SELECT {O.KEY}, count(DISTINCT event_id) AS context_event_count FROM ctx GROUP BY ALL")
def context_counts(spark, d):
    rows = W.windowed(one_day(observations(spark, d)), SIX)
    return H.context(rows, H.accepted_visits(rows, SIX), SIX).select(*WINDOW_KEY, F.size("context_ids").cast("long").alias("context_event_count"))


@query(f"{_V3} {O.v3_rows(O.H6, O.H48)}")
def route_window_v3(spark, d):
    return rounded(H.cross_windows(one_day(observations(spark, d)), SIX))


@query(f"WITH RECURSIVE {O.accepted(O.M5, 7_200_000)} {O.v3_rows(O.M5, 7_200_000)}")
def route_window_v3_5min(spark, d):
    return rounded(H.cross_windows(one_day(observations(spark, d)), FIVE))


# ---- coverage ---------------------------------------------------------------------------------------

_AS_OF = 1704931200000 - 3 * 3600_000  # 2024-01-10T21:00Z
_COVER = f"""{O.ENRICHED},
due AS (SELECT trip_id, min_by(dep, seq) AS scheduled_departure, max(dep) AS scheduled_completion, max(dep) + 300000 AS due_at FROM
  (SELECT 'T' || c_custkey AS trip_id, seq, (epoch(TIMESTAMP '2024-01-10 00:00:00')::BIGINT + (c_custkey % 26) * 3600 + seq * 600) * 1000 AS dep FROM customer, range(1, 4) r(seq)) GROUP BY ALL),
act AS (SELECT s.trip_id, s.route AS route_id, coalesce(try_cast(nullif(s.direction, '') AS INT), -1) AS direction_id FROM sched s WHERE s.service_id IN
  (SELECT service_id FROM (SELECT DISTINCT service_id FROM sched) q WHERE {O.active("q.service_id", "'20240110'")})),
lab AS (SELECT e.*, lpad(observed_at::VARCHAR, 15, '0') || event_id AS ord, CASE WHEN unmatched_reason IS NOT NULL THEN 'unmatched' WHEN schedule_version IS DISTINCT FROM 'v1' THEN 'schedule_version' WHEN observed_at > {_AS_OF} THEN 'after_as_of'
  WHEN trip_id NOT IN (SELECT trip_id FROM act) THEN 'unscheduled_trip' END AS excluded FROM enr e WHERE service_date = '2024-01-10'),
ev AS (SELECT trip_id, max(CASE WHEN kind = 'cancel' THEN ord END) AS c, max(CASE WHEN kind = 'prediction' THEN ord END) AS u, bool_or(kind <> 'cancel') AS heard, count(*) AS n, string_agg(event_id, chr(10) ORDER BY event_id) AS ids FROM lab WHERE excluded IS NULL GROUP BY ALL),
st AS (SELECT a.trip_id, a.route_id, a.direction_id, scheduled_departure, scheduled_completion, due_at, coalesce(c IS NOT NULL AND (u IS NULL OR c > u), false) AS reported_canceled, coalesce(n, 0) AS evidence_count, sha256(coalesce(ids, '')) AS input_digest, coalesce(heard, false) AS heard
  FROM act a JOIN due USING (trip_id) LEFT JOIN ev USING (trip_id)),
status AS (SELECT * EXCLUDE (heard), CASE WHEN {_AS_OF} < due_at THEN 'not_due' WHEN reported_canceled THEN 'canceled' WHEN heard THEN 'telemetry_present' ELSE 'missing_telemetry' END AS status FROM st)"""


def _coverage(spark, d) -> C.Report:
    s = schedule(spark, d)
    trips = s["trips"].where("schedule_version = 'v1'").withColumn("start_date", F.lit("20240110"))
    active = SC.with_activity(trips, s["calendar"], s["calendar_dates"]).where("active")
    return C.coverage(_enriched(spark, d), active, stop_times(active), agency="demo", version="v1", zone="UTC", service_date="2024-01-10", as_of=_AS_OF)


@query(f"WITH {_COVER} SELECT * FROM status")
def trip_coverage_status(spark, d):
    return _coverage(spark, d).trips


@query(f"WITH {_COVER} SELECT route_id, direction_id, count(*) AS scheduled_trip_count, count(*) FILTER (WHERE status <> 'not_due') AS due_trip_count, count(*) FILTER (WHERE status = 'not_due') AS not_due_trip_count, count(*) FILTER (WHERE status = 'telemetry_present') AS telemetry_trip_count, count(*) FILTER (WHERE status = 'canceled') AS canceled_trip_count, count(*) FILTER (WHERE status = 'missing_telemetry') AS missing_telemetry_trip_count, round(count(*) FILTER (WHERE status = 'telemetry_present') / nullif(count(*) FILTER (WHERE status NOT IN ('not_due', 'canceled')), 0), 6) AS telemetry_coverage_rate FROM status GROUP BY ALL")
def route_coverage(spark, d):
    return rounded(_coverage(spark, d).routes)


@query(f"WITH {_COVER} SELECT excluded AS reason, count(*) AS events FROM lab WHERE excluded IS NOT NULL GROUP BY ALL")
def excluded_evidence(spark, d):
    return _coverage(spark, d).excluded


@query(f"WITH {_COVER} SELECT a.trip_id, scheduled_departure, scheduled_completion, due_at FROM act a JOIN due USING (trip_id)")
def trip_due_times(spark, d):
    return _coverage(spark, d).trips.select("trip_id", "scheduled_departure", "scheduled_completion", "due_at")


# ---- serving and quality ----------------------------------------------------------------------------

_VERSIONED = f"""{O.windows(O.H6)}, m AS ({O.v2_rows(O.H6)}),
served AS (SELECT generation, {O.KEY}, x AS version, prediction_count * x AS prediction_count, mean_delay_seconds FROM m, (VALUES (1::BIGINT), (2)) v(x) WHERE x = 1 OR window_start % 43200000 = 0)"""
_GKEY = f"generation, {O.KEY}"


def _metrics(spark, d):
    """Metric rows; every other window has a second version with twice the predictions."""
    m = rounded(W.route_windows(observations(spark, d), SIX))
    second = m.where("window_start % 43200000 = 0").withColumns({"version": F.lit(2).cast("long"), "prediction_count": F.col("prediction_count") * 2})
    return m.unionByName(second)


@query(f"WITH {_VERSIONED} SELECT {_GKEY}, max(version) AS version, arg_max(prediction_count, version) AS prediction_count FROM served GROUP BY ALL")
def latest_version(spark, d):
    rows = V.latest_version(V.serving_rows(_metrics(spark, d)))
    return rows.select(*Q.METRIC_KEY, "version", F.get_json_object("record_json", "$.prediction_count").cast("long").alias("prediction_count"))


@query(f"WITH {_VERSIONED} SELECT {_GKEY}, max(version) AS version FROM served WHERE route_id = 'R1' GROUP BY ALL")
def serving_latest(spark, d):
    V.latest(V.serving_rows(_metrics(spark, d))).drop("record_json").createOrReplaceTempView("served_windows")
    return V.query(spark, "SELECT * FROM served_windows WHERE route_id = :route", route="R1")


@query(f"WITH {O.windows(O.H6)}, m AS ({O.v2_rows(O.H6)}) SELECT generation, {O.KEY}, window_end, vehicle_count, prediction_count, canceled_trip_count, arrival_count, headway_count, mean_delay_seconds, p50_delay_seconds, p95_delay_seconds, adherence_rate, mean_headway_seconds FROM m")
def route_reliability(spark, d):
    m = rounded(W.route_windows(observations(spark, d), SIX))
    return rounded(V.route_reliability(V.latest_version(V.serving_rows(m))))


_SEEDED = f"""{O.windows(O.H6)}, m0 AS ({O.v2_rows(O.H6)}),
m AS (SELECT * REPLACE (CASE WHEN window_start % 129600000 = 0 THEN -1 ELSE prediction_count END AS prediction_count, CASE WHEN window_start % 86400000 = 0 THEN -5.0 ELSE mean_headway_seconds END AS mean_headway_seconds) FROM m0)"""


def _seeded(spark, d):
    m = rounded(W.route_windows(observations(spark, d), SIX))
    return m.withColumns({"prediction_count": F.when(F.col("window_start") % 129600000 == 0, -1).otherwise(F.col("prediction_count")), "mean_headway_seconds": F.when(F.col("window_start") % 86400000 == 0, -5.0).otherwise(F.col("mean_headway_seconds"))})


@query(f"WITH {_VERSIONED} SELECT {_GKEY}, count(*) AS rows FROM served GROUP BY ALL HAVING count(*) > 1")
def quality_unique(spark, d):
    return Q.repeated_windows(_metrics(spark, d))


@query(f"WITH {_SEEDED} SELECT {_GKEY}, prediction_count FROM m WHERE prediction_count < 0 OR canceled_trip_count < 0 OR adherence_rate NOT BETWEEN 0 AND 1 OR p50_delay_seconds > p95_delay_seconds OR (prediction_count = 0 AND mean_delay_seconds IS NOT NULL) OR (prediction_count > 0 AND mean_delay_seconds IS NULL)")
def quality_prediction(spark, d):
    return Q.bad_predictions(_seeded(spark, d)).select(*Q.METRIC_KEY, "prediction_count")


@query(f"WITH {_SEEDED} SELECT {_GKEY}, mean_headway_seconds FROM m WHERE arrival_count < 0 OR headway_count < 0 OR mean_headway_seconds < 0 OR (headway_count = 0 AND mean_headway_seconds IS NOT NULL) OR (headway_count > 0 AND mean_headway_seconds IS NULL)")
def quality_headway(spark, d):
    return Q.bad_headways(_seeded(spark, d)).select(*Q.METRIC_KEY, "mean_headway_seconds")


@query(f"WITH {O.windows(O.H6)} SELECT {O.KEY}, p50_delay_seconds, p95_delay_seconds FROM delays ORDER BY prediction_count DESC, {O.KEY} LIMIT 10")
def top_windows(spark, d):
    s = W.delay_statistics(W.latest_predictions(W.windowed(observations(spark, d), SIX)), SIX)
    return s.orderBy(F.desc("prediction_count"), *WINDOW_KEY).limit(10).select(*WINDOW_KEY, "p50_delay_seconds", "p95_delay_seconds")


# ---- replay -----------------------------------------------------------------------------------------


@query(f"WITH {O.windows(O.H6)} SELECT event_id FROM w JOIN (SELECT {O.KEY} FROM base WHERE window_start % 43200000 = 0) k USING ({O.KEY})")
def replay_semi(spark, d):
    e = observations(spark, d)
    keys = W.windowed(e, SIX).select(*WINDOW_KEY).distinct().where("window_start % 43200000 = 0")
    return R.in_windows(e, keys, SIX).select("event_id")


@query(f"WITH {O.windows(O.H6)} SELECT {O.KEY} FROM base b WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.kind <> 'prediction' AND w.agency_id = b.agency_id AND w.route_id = b.route_id AND w.direction_id = b.direction_id AND w.service_date = b.service_date AND w.window_start = b.window_start)")
def migration_anti(spark, d):
    e = observations(spark, d)
    ledger = e.where(F.col("payload.trip_update").isNull())
    return R.without_ledger(W.windowed(e, SIX).select(*WINDOW_KEY).distinct(), ledger, SIX)


@query(f"WITH {O.windows(O.H6)} {O.v2_rows(O.H6).replace(chr(39) + 'live-v2' + chr(39), chr(39) + 'replay-1' + chr(39))}")
def replay_rebuild(spark, d):
    e = observations(spark, d)
    recorded = W.route_windows(e, SIX)
    ledger = e.withColumns({"generation": F.lit("live-v2"), "unmatched_reason": F.lit(None).cast("string")})
    return rounded(R.rebuild(recorded, ledger, "live-v2", "replay-1", SIX))


_DIFF = "WITH l AS (SELECT c_custkey AS k, c_nationkey::VARCHAR AS a, c_mktsegment AS b FROM customer WHERE c_custkey % 10 <> 1), r AS (SELECT c_custkey AS k, (c_nationkey + CASE WHEN c_custkey % 97 = 0 THEN 1 ELSE 0 END)::VARCHAR AS a, c_mktsegment AS b FROM customer WHERE c_custkey % 10 <> 2), f AS (SELECT coalesce(l.k, r.k) AS k, l.k AS lk, r.k AS rk, l.a AS la, r.a AS ra FROM l FULL JOIN r ON l.k = r.k)"


def _two_sides(spark, d):
    c = table(spark, d, "customer")
    left = c.where("c_custkey % 10 <> 1").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("a"), F.col("c_mktsegment").alias("b"))
    right = c.where("c_custkey % 10 <> 2").select(F.col("c_custkey").alias("k"), (F.col("c_nationkey") + F.when(F.col("c_custkey") % 97 == 0, 1).otherwise(0)).alias("a"), F.col("c_mktsegment").alias("b"))
    return left, right


@query(f"{_DIFF} SELECT k, CASE WHEN lk IS NULL OR rk IS NULL THEN 'row' ELSE 'a' END AS field, CASE WHEN lk IS NULL THEN NULL WHEN rk IS NULL THEN 'present' ELSE la END AS left_value, CASE WHEN rk IS NULL THEN NULL WHEN lk IS NULL THEN 'present' ELSE ra END AS right_value FROM f WHERE lk IS NULL OR rk IS NULL OR la <> ra ORDER BY k, field LIMIT 10")
def parity_diff_topn(spark, d):
    return R.differences(*_two_sides(spark, d), ["k"]).orderBy("k", "field").limit(10)


@query(f"{_DIFF} SELECT k, lk IS NOT NULL AS in_left, rk IS NOT NULL AS in_right FROM f WHERE lk IS NULL OR rk IS NULL")
def key_set_difference(spark, d):
    return ops.key_difference(*_two_sides(spark, d), "k")


@query("SELECT o_custkey, count(DISTINCT (o_orderstatus, o_orderpriority)) AS records FROM orders GROUP BY ALL HAVING count(DISTINCT (o_orderstatus, o_orderpriority)) > 1")
def conflict_keys(spark, d):
    return Q.conflicts(table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority"), "o_custkey")


# ---- operations --------------------------------------------------------------------------------------


@query("WITH c AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS tms, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS total FROM events), l AS (SELECT *, tms - lag(tms) OVER w AS ms, total - lag(total) OVER w AS more FROM c WINDOW w AS (PARTITION BY user_id ORDER BY tms, event_id)) SELECT user_id, tms - tms % 86400000 AS window_start, round(sum(more) / (sum(ms) / 1000.0), 6) AS rate FROM l WHERE ms IS NOT NULL GROUP BY ALL")
def counter_rate(spark, d):
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    total = F.sum("value").over(Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0))
    c = table(spark, d, "events").select("user_id", "event_id", at.alias("at"), total.alias("total"))
    return rounded(ops.counter_rate(c, ["user_id"], 86_400_000))


@query("SELECT l_orderkey, l_linenumber, high - CASE WHEN c IS NULL THEN low ELSE least(greatest(c, low), high) END AS lag FROM (SELECT l_orderkey, l_linenumber, l_quantity::BIGINT AS low, l_quantity::BIGINT + 20 AS high, CASE WHEN l_linenumber % 3 <> 0 THEN l_partkey % 90 END AS c FROM lineitem)")
def offset_lag(spark, d):
    low = F.col("l_quantity").cast("long")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", ops.offset_lag(low, low + 20, F.when(F.col("l_linenumber") % 3 != 0, F.col("l_partkey") % 90)).alias("lag"))


@query("SELECT l_returnflag, round(median(l_extendedprice), 4) AS median, round(stddev_samp(l_extendedprice), 4) AS stdev FROM lineitem GROUP BY ALL")
def benchmark_stats(spark, d):
    out = ops.benchmark_stats(table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice")
    return out.select("l_returnflag", F.round("median", 4).alias("median"), F.round("stdev", 4).alias("stdev"))


@query(f"WITH {O.windows(O.H6)} SELECT count(*) AS rows, sum(coalesce(prediction_count, 0))::BIGINT AS predictions FROM base LEFT JOIN delays USING ({O.KEY})")
def serving_gauges(spark, d):
    return ops.serving_gauges(W.route_windows(observations(spark, d), SIX))


@query(f"WITH {O.OBS} SELECT route_id, max(observed_at) AS newest FROM obs GROUP BY ALL")
def newest_observation(spark, d):
    return observed(table(spark, d, "events")).groupBy("route_id").agg(F.max("observed_at").alias("newest"))


# ---- streams: the same tables read as a stream, run until all is read ---------------------------------


def _stream(spark, d):
    schema = table(spark, d, "events").schema
    return as_events(observed(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)))


def _folder(spark) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    root = root or "file:///tmp/checkpoints"
    return f"{root.rstrip('/')}/tramline-stream-{uuid.uuid4().hex}"


def _run(rows, write=None, path=None, root=None):
    ST.start(rows, "windows", f"{root}/checkpoint", write, path, {"availableNow": True}).awaitTermination()


_CLOSED = "observed_at - observed_at % 300000 + 300000 + 120000 <= (SELECT max(observed_at) FROM obs) - 30000"


@query(f"WITH {O.OBS} SELECT event_id, observed_at, 'admitted' AS outcome FROM obs")
def stream_admission(spark, d):
    root = _folder(spark)
    rows = SP.admit(_stream(spark, d).select("event_id", "observed_at", "route_id"), FIVE)
    _run(rows, path=f"{root}/out", root=root)
    return spark.read.schema(rows.schema).parquet(f"{root}/out").select("event_id", "observed_at", "outcome")


@query(f"WITH {O.OBS} SELECT event_id, observed_at FROM obs WHERE {_CLOSED}")
def stream_final_windows(spark, d):
    root = _folder(spark)
    rows = SP.final_windows(_stream(spark, d), FIVE).select("event_id", "observed_at")
    _run(rows, path=f"{root}/out", root=root)
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


def _stream_metrics(spark, d, generation):
    root = _folder(spark)
    _run(SP.gate(one_day(_stream(spark, d)), FIVE), write=ST.windows_batch(root, FIVE), root=root)
    return rounded(spark.read.schema(METRIC).parquet(f"{root}/metrics").where(F.col("generation") == generation).drop("batch_id"))


_ALL = "window_start + 420000 <= (SELECT max(observed_at) FROM obs) - 30000"


@query(f"WITH {O.windows(O.M5, True)} SELECT * FROM ({O.v2_rows(O.M5)}) WHERE {_ALL}")
def stream_window_v2(spark, d):
    return _stream_metrics(spark, d, "live-v2").drop("context_event_count", "headway_lookback_seconds")


@query(f"WITH RECURSIVE {O.accepted(O.M5, 7_200_000)} SELECT * FROM ({O.v3_rows(O.M5, 7_200_000)}) WHERE {_ALL}")
def stream_window_v3(spark, d):
    return _stream_metrics(spark, d, "live-v3")


@query(ORACLES["schedule_enrich"])
def stream_job(spark, d):
    """The whole job, from events and announced versions to its tables; what its enrichment has written, matched or not."""
    root, s = _folder(spark), schedule(spark, d)
    s["versions"].write.parquet(f"{root}/versions")
    announced = spark.readStream.schema(SJ.VERSION).parquet(f"{root}/versions")
    SJ.start_job(spark, _stream(spark, d), announced, s, f"{root}/tables", f"{root}/checkpoint", FIVE, {"availableNow": True})
    tables = SJ.job_tables(spark, f"{root}/tables")
    rows = tables["enriched_events"].unionByName(tables["unmatched"])
    return rows.select("event_id", "schedule_version", "route_id", "direction_id", "service_date", "unmatched_reason")
