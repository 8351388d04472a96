"""Windows: stated values, order and duplication, and a plain sequential version."""

import hashlib
import math
import random

import pytest

from tests.helpers import event, frame, one
from tramline.operators.headways import cross_windows
from tramline.operators.windows import route_windows
from tramline.plans.config import Settings

T0 = 1789052400000
VISIT = dict(status="STOPPED_AT", stop="S1")


def sequential(events, s=Settings(), across=False):
    """Rows by window, one event after the other."""
    seen = {}
    for e in events:
        seen.setdefault(e["event_id"], e)
    groups = {}
    for e in sorted(seen.values(), key=lambda e: (e["observed_at"], e["event_id"])):
        route = (e["agency_id"], e["route_id"], -1 if e["direction_id"] is None else e["direction_id"], e["service_date"])
        groups.setdefault((route, e["observed_at"] // s.window * s.window), []).append(e)
    out, accepted = {}, {}
    for (route, start), rows in sorted(groups.items(), key=lambda x: (str(x[0][0]), x[0][1])):
        latest, canceled, first = {}, set(), {}
        for e in rows:
            p, trip = e["payload"], e["trip_id"]
            if p["trip"]["schedule_relationship"] == "CANCELED":
                canceled.add(trip)
                latest = {k: v for k, v in latest.items() if k[0] != trip}
            elif p["trip_update"]:
                canceled.discard(trip)
                for u in p["trip_update"]["stop_time_updates"]:
                    k = (trip, u["stop_id"], u["stop_sequence"])
                    latest.pop(k, None)
                    if u["arrival_delay"] is not None:
                        latest[k] = u["arrival_delay"]
            v = p["vehicle_position"]
            if v and v["current_status"] == "STOPPED_AT" and v["stop_id"] is not None:
                first.setdefault((v["stop_id"], trip), e["observed_at"])
        d, ids, gaps, arrivals, context = sorted(latest.values()), {e["event_id"] for e in rows}, [], len(first), None
        if across:
            old = accepted.setdefault(route, [])
            context = {x[3] for x in old if start - s.lookback <= x[0] < start}
            ids, arrivals = ids | context, 0
            for e in rows:
                v = e["payload"]["vehicle_position"]
                if not v or v["current_status"] != "STOPPED_AT" or not v["stop_id"]:
                    continue
                at, stop, trip = e["observed_at"], v["stop_id"], e["trip_id"]
                if any(x[1] == stop and x[2] == trip and at - x[0] <= s.lookback for x in old):
                    continue
                before = [x for x in old if x[1] == stop]
                if before and before[-1][2] != trip and at - before[-1][0] <= s.lookback:
                    gaps.append(at - before[-1][0])
                old.append((at, stop, trip, e["event_id"]))
                arrivals += 1
        else:
            for stop in {k[0] for k in first}:
                t = sorted(at for k, at in first.items() if k[0] == stop)
                gaps += [b - a for a, b in zip(t, t[1:])]
        mean = lambda x: round(sum(x) / len(x), 6) if x else None
        out[(*route, start)] = (
            hashlib.sha256("\n".join(sorted(ids)).encode()).hexdigest(), len({e["vehicle_id"] for e in rows} - {None}), len(d), len(canceled), arrivals, len(gaps), mean(d),
            d[math.ceil(len(d) * 0.5) - 1] if d else None, d[math.ceil(len(d) * 0.95) - 1] if d else None, mean([-60 <= x <= 300 for x in d]), mean([g / 1000 for g in gaps]), None if context is None else len(context),
        )
    return out


def rows_of(df):
    r6 = lambda x: None if x is None else round(x, 6)
    return {
        (r.agency_id, r.route_id, r.direction_id, r.service_date, r.window_start): (
            r.input_digest, r.vehicle_count, r.prediction_count, r.canceled_trip_count, r.arrival_count, r.headway_count, r6(r.mean_delay_seconds), r.p50_delay_seconds, r.p95_delay_seconds,
            r6(r.adherence_rate), r6(r.mean_headway_seconds), r.context_event_count if "context_event_count" in r else None,
        )
        for r in df.collect()
    }


def test_correction_replaces_and_retry_changes_nothing(spark):
    a, b = event("a", T0, delay=60), event("b", T0 + 1000, delay=120)
    once, twice = (one(route_windows(frame(spark, x))) for x in ([a, b], [b, a, b]))
    assert once == twice and (once.prediction_count, once.mean_delay_seconds, once.vehicle_count, once.adherence_rate) == (1, 120, 1, 1.0)


def test_single_delay_and_no_invented_headway(spark):
    r = one(route_windows(frame(spark, [event("a", T0, delay=60)])))
    assert (r.p50_delay_seconds, r.p95_delay_seconds, r.mean_headway_seconds, r.arrival_count, r.headway_count) == (60, 60, None, 0, 0)


def test_keys_do_not_collide(spark):
    rows = [event("a", T0, delay=1, agency_id="a/b", route_id="c"), event("b", T0, delay=1, agency_id="a", route_id="b/c")]
    assert route_windows(frame(spark, rows)).count() == 2


def test_cancel_stays_until_an_update(spark):
    cancel, vehicle, update = event("a", T0, relationship="CANCELED", updates=[("S1", 1, 9)]), event("b", T0 + 1, status="IN_TRANSIT_TO", stop="S1"), event("c", T0 + 2, delay=5)
    r = one(route_windows(frame(spark, [cancel, vehicle])))
    assert (r.canceled_trip_count, r.prediction_count) == (1, 0)
    r = one(route_windows(frame(spark, [cancel, vehicle, update])))
    assert (r.canceled_trip_count, r.prediction_count) == (0, 1)


GOLDEN = [event("a", 290000, trip_id="T1", **VISIT), event("dwell", 305000, trip_id="T1", **VISIT), event("b", 310000, trip_id="T2", **VISIT), event("c", 910000, trip_id="T3", **VISIT), event("d", 910000, trip_id="T4", **VISIT)]


@pytest.mark.parametrize("events", [GOLDEN, GOLDEN[::-1] + GOLDEN[:2]])
def test_cross_windows_golden(spark, events):
    got = [(r.window_start, r.arrival_count, r.headway_count, r.mean_headway_seconds, r.context_event_count, r.input_digest) for r in cross_windows(frame(spark, events)).orderBy("window_start").collect()]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == [(0, 1, 0, None, 0, sha("a")), (300000, 1, 1, 20, 1, sha("a\nb\ndwell")), (900000, 2, 2, 300, 2, sha("a\nb\nc\nd"))]
    assert [r.arrival_count for r in route_windows(frame(spark, events)).orderBy("window_start").collect()] == [1, 2, 2]


@pytest.mark.parametrize(("at", "more", "mean"), [(7_490_000, {}, 7200), (7_490_001, {}, None), (310_000, {"route_id": "R2"}, None), (310_000, {"direction_id": 1}, None), (310_000, {"service_date": "2026-09-11"}, None), (310_000, {"stop": "S2"}, None)])
def test_lookback_and_scope(spark, at, more, mean):
    second = event("b", at, trip_id="T2", **{**VISIT, **more})
    rows = cross_windows(frame(spark, [GOLDEN[0], second])).orderBy("window_start").collect()
    assert [r.mean_headway_seconds for r in rows if r.window_start][0] == mean


@pytest.mark.parametrize("seed", range(3))
def test_random_events_match_the_sequential_version(spark, seed):
    r = random.Random(seed)
    events = []
    for k in range(160):
        kind, at = r.choice(["visit", "visit", "update", "cancel", "move"]), r.randrange(0, 9_000_000, 50_000)
        more = dict(trip_id=f"T{r.randrange(5)}", vehicle_id=r.choice([None, "V1", "V2"]), route_id=r.choice(["R1", "R2"]), direction_id=r.choice([None, 0]))
        if kind == "visit":
            e = event(f"e{k}", at, status="STOPPED_AT", stop=r.choice(["", "S1", "S2"]), **more)
        elif kind == "move":
            e = event(f"e{k}", at, status="IN_TRANSIT_TO", stop="S1", **more)
        else:
            e = event(f"e{k}", at, updates=[(r.choice(["S1", None]), r.choice([1, None]), r.choice([None, 10, -100, 400])) for _ in range(r.randrange(4))], relationship="CANCELED" if kind == "cancel" else "SCHEDULED", **more)
        events.append(e)
    events += r.sample(events, 20)
    r.shuffle(events)
    df = frame(spark, events)
    assert rows_of(route_windows(df)) == sequential(events)
    assert rows_of(cross_windows(df)) == sequential(events, across=True)
    s = Settings(lookback=600_000)
    assert rows_of(cross_windows(df, s)) == sequential(events, s, across=True)
