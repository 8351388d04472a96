"""DuckDB SQL for the registered queries, written apart from the engine."""

from __future__ import annotations

from tramline.plans.adapter import CALENDAR, EXCEPTIONS, VERSIONS

H6, H48, M5 = 21_600_000, 172_800_000, 300_000

OBS = """
e AS (SELECT *, (props->>'$.k')::INT AS k, epoch_us(ts) // 1000 AS ms FROM events),
obs AS (SELECT 'e' || lpad(event_id::VARCHAR, 9, '0') AS event_id, ms AS observed_at, 'demo' AS agency_id,
  'R' || (user_id % 5) AS route_id, ((user_id // 5) % 2)::INT AS direction_id, strftime(ts, '%Y-%m-%d') AS service_date, 'T' || user_id AS trip_id,
  CASE WHEN k % 13 <> 0 THEN 'V' || user_id END AS vehicle_id, 'S' || (k % 3) AS stop_id, (k % 4)::INT AS stop_sequence,
  CASE WHEN k % 11 <> 0 THEN floor(value)::INT - 120 END AS arrival_delay,
  CASE event_type WHEN 'error' THEN 'cancel' WHEN 'click' THEN 'prediction' WHEN 'view' THEN 'prediction' ELSE 'visit' END AS kind FROM e)"""
KEY = "agency_id, route_id, direction_id, service_date, window_start"
ROUTE = "agency_id, route_id, direction_id, service_date"


def windows(width: int, one_day: bool = False) -> str:
    date = "'2024-01-01'" if one_day else "service_date"
    return f"""{OBS},
w AS (SELECT * REPLACE ({date} AS service_date), observed_at - observed_at % {width} AS window_start, lpad(observed_at::VARCHAR, 15, '0') || event_id AS ord FROM obs),
trips AS (SELECT {KEY}, trip_id, max(CASE WHEN kind = 'cancel' THEN ord END) AS lc, max(CASE WHEN kind = 'prediction' THEN ord END) AS lu FROM w GROUP BY ALL),
canceled AS (SELECT {KEY}, count(*) FILTER (WHERE lc IS NOT NULL AND (lu IS NULL OR lc > lu)) AS canceled_trip_count FROM trips GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {KEY}, trip_id, stop_id, stop_sequence ORDER BY ord DESC) AS rn FROM w WHERE kind = 'prediction'),
live AS (SELECT r.* FROM ranked r JOIN trips t USING ({KEY}, trip_id) WHERE rn = 1 AND arrival_delay IS NOT NULL AND (t.lc IS NULL OR r.ord > t.lc)),
delays AS (SELECT {KEY}, count(*) AS prediction_count, avg(arrival_delay) AS mean_delay_seconds, quantile_disc(arrival_delay, 0.5)::DOUBLE AS p50_delay_seconds,
  quantile_disc(arrival_delay, 0.95)::DOUBLE AS p95_delay_seconds, avg(CASE WHEN arrival_delay BETWEEN -60 AND 300 THEN 1.0 ELSE 0.0 END) AS adherence_rate FROM live GROUP BY ALL),
visits AS (SELECT {KEY}, stop_id, trip_id, min(observed_at) AS observed_at FROM w WHERE kind = 'visit' GROUP BY ALL),
gaps AS (SELECT *, observed_at - lag(observed_at) OVER (PARTITION BY {KEY}, stop_id ORDER BY observed_at, trip_id) AS gap FROM visits),
hw AS (SELECT {KEY}, count(*) AS arrival_count, count(gap) AS headway_count, avg(gap) / 1000 AS mean_headway_seconds FROM gaps GROUP BY ALL),
base AS (SELECT {KEY}, count(DISTINCT vehicle_id) AS vehicle_count, sha256(string_agg(event_id, chr(10) ORDER BY event_id)) AS input_digest FROM w GROUP BY ALL)"""


def v2_rows(width: int) -> str:
    return f"""SELECT 1 AS schema_version, 'live-v2' AS generation, {KEY}, window_start + {width} AS window_end, 1::BIGINT AS version, input_digest, vehicle_count,
  coalesce(prediction_count, 0) AS prediction_count, coalesce(canceled_trip_count, 0) AS canceled_trip_count, coalesce(arrival_count, 0) AS arrival_count, coalesce(headway_count, 0) AS headway_count,
  round(mean_delay_seconds, 6) AS mean_delay_seconds, p50_delay_seconds, p95_delay_seconds, round(adherence_rate, 6) AS adherence_rate, round(mean_headway_seconds, 6) AS mean_headway_seconds
  FROM base LEFT JOIN delays USING ({KEY}) LEFT JOIN canceled USING ({KEY}) LEFT JOIN hw USING ({KEY})"""


def accepted(width: int, lookback: int) -> str:
    return f"""{windows(width, True)},
chain AS (SELECT *, row_number() OVER c AS rn FROM w WHERE kind = 'visit' WINDOW c AS (PARTITION BY {ROUTE}, stop_id, trip_id ORDER BY ord)),
nexts AS (SELECT a.event_id, min(b.rn) AS nx FROM chain a JOIN chain b ON a.agency_id = b.agency_id AND a.route_id = b.route_id AND a.direction_id = b.direction_id AND a.service_date = b.service_date
  AND a.stop_id = b.stop_id AND a.trip_id = b.trip_id AND b.observed_at > a.observed_at + {lookback} GROUP BY a.event_id),
linked AS (SELECT c.*, nx FROM chain c LEFT JOIN nexts USING (event_id)),
acc AS (SELECT * FROM linked WHERE rn = 1 UNION ALL SELECT l.* FROM acc a JOIN linked l ON a.agency_id = l.agency_id AND a.route_id = l.route_id AND a.direction_id = l.direction_id
  AND a.service_date = l.service_date AND a.stop_id = l.stop_id AND a.trip_id = l.trip_id AND l.rn = a.nx),
pred AS (SELECT *, lag(observed_at) OVER p AS before_at, lag(trip_id) OVER p AS before_trip FROM acc WINDOW p AS (PARTITION BY {ROUTE}, stop_id ORDER BY ord)),
cross_gaps AS (SELECT * , CASE WHEN before_trip <> trip_id AND observed_at - before_at <= {lookback} THEN observed_at - before_at END AS gap FROM pred),
ctx AS (SELECT w.agency_id, w.route_id, w.direction_id, w.service_date, w.window_start, a.event_id FROM (SELECT DISTINCT {KEY} FROM w) w JOIN acc a
  ON w.agency_id = a.agency_id AND w.route_id = a.route_id AND w.direction_id = a.direction_id AND w.service_date = a.service_date
  AND a.observed_at >= w.window_start - {lookback} AND a.observed_at < w.window_start),
all_ids AS (SELECT {KEY}, event_id FROM w UNION SELECT {KEY}, event_id FROM ctx)"""


def v3_rows(width: int, lookback: int) -> str:
    return f"""SELECT 2 AS schema_version, 'live-v3' AS generation, {KEY}, window_start + {width} AS window_end, 1::BIGINT AS version, d.input_digest, vehicle_count,
  coalesce(prediction_count, 0) AS prediction_count, coalesce(canceled_trip_count, 0) AS canceled_trip_count, coalesce(g.n, 0) AS arrival_count, coalesce(g.gaps, 0) AS headway_count,
  round(mean_delay_seconds, 6) AS mean_delay_seconds, p50_delay_seconds, p95_delay_seconds, round(adherence_rate, 6) AS adherence_rate, round(g.mean_gap, 6) AS mean_headway_seconds,
  coalesce(c.n, 0) AS context_event_count, {lookback // 1000}::BIGINT AS headway_lookback_seconds
  FROM base LEFT JOIN delays USING ({KEY}) LEFT JOIN canceled USING ({KEY})
  LEFT JOIN (SELECT {KEY}, count(*) AS n, count(gap) AS gaps, avg(gap) / 1000 AS mean_gap FROM cross_gaps GROUP BY ALL) g USING ({KEY})
  LEFT JOIN (SELECT {KEY}, count(DISTINCT event_id) AS n FROM ctx GROUP BY ALL) c USING ({KEY})
  LEFT JOIN (SELECT {KEY}, sha256(string_agg(event_id, chr(10) ORDER BY event_id)) AS input_digest FROM all_ids GROUP BY ALL) d USING ({KEY})"""


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
SCHEDULE = f"""
versions(agency_id, schedule_version, effective_from) AS (VALUES {_values(VERSIONS)}),
sched AS (SELECT 'T' || c_custkey AS trip_id, c_mktsegment AS service_id, 'N' || c_nationkey AS route, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE (c_custkey % 2)::VARCHAR END AS direction FROM customer WHERE c_custkey % 7 <> 0),
cal(service_id, flags, start_date, end_date) AS (VALUES {_values(CALENDAR)}),
exc(service_id, date, exception_type, row_no) AS (VALUES {_values(EXCEPTIONS)}),
lastexc AS (SELECT service_id, date, arg_max(exception_type, row_no) AS exception_type FROM exc GROUP BY ALL)"""


def active(service: str, day: str) -> str:
    """Whether a service runs on a yyyyMMdd day."""
    weekday = f"((isodow(strptime({day}, '%Y%m%d')))::INT)"
    return f"""coalesce((SELECT x.exception_type = '1' FROM lastexc x WHERE x.service_id = {service} AND x.date = {day}),
  EXISTS (SELECT 1 FROM cal c WHERE c.service_id = {service} AND {day} BETWEEN c.start_date AND c.end_date AND substr(c.flags, {weekday}, 1) = '1'))"""


ENRICHED = f"""{OBS}, {SCHEDULE},
chosen AS (SELECT o.*, v.schedule_version FROM obs o ASOF LEFT JOIN (SELECT * FROM versions WHERE agency_id = 'demo') v ON o.agency_id = v.agency_id AND o.observed_at >= v.effective_from),
joined AS (SELECT c.*, s.service_id, s.route, s.direction, replace(service_date, '-', '') AS day FROM chosen c LEFT JOIN sched s ON c.trip_id = s.trip_id),
days AS (SELECT DISTINCT service_id, day FROM joined WHERE service_id IS NOT NULL),
runs AS (SELECT service_id, day, {active("days.service_id", "days.day")} AS active FROM days),
enr AS (SELECT j.* EXCLUDE (route_id, direction_id, service_date, route, direction, day, service_id), CASE WHEN j.service_id IS NULL THEN 'unknown_trip' WHEN NOT r.active THEN 'inactive_service' END AS unmatched_reason,
  CASE WHEN j.service_id IS NULL OR NOT r.active THEN j.route_id ELSE j.route END AS route_id,
  CASE WHEN j.service_id IS NULL OR NOT r.active THEN NULL ELSE coalesce(try_cast(nullif(j.direction, '') AS INT), -1) END AS direction_id,
  CASE WHEN j.service_id IS NULL OR NOT r.active THEN NULL ELSE j.service_date END AS service_date
  FROM joined j LEFT JOIN runs r ON j.service_id = r.service_id AND j.day = r.day)"""
