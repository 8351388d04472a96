"""Streams: lateness, restarts, windows that close once, parity with the batch, waiting for schedules."""

import shutil
import time
import urllib.request

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.helpers import event, frame
from tramline import commands
from tramline.functions.scalars import window_start
from tramline.operators import serving
from tramline.operators.headways import cross_windows
from tramline.operators.windows import route_windows
from tramline.plans.config import Settings
from tramline.plans.model import ENRICHED, METRIC
from tramline.streaming import metrics as M
from tramline.streaming import processors as P
from tramline.streaming import runner as R

VISIT = dict(status="STOPPED_AT", stop="S1")


class Feed:
    """A folder that a stream reads; each call of run() takes what is new and stops, on one checkpoint."""

    def __init__(self, spark, tmp_path, build, write=None):
        self.spark, self.at, self.build, self.write, self.n = spark, tmp_path, build, write, 0
        (tmp_path / "in").mkdir()

    def put(self, *events):
        self.n += 1
        frame(self.spark, events).coalesce(1).write.parquet(str(self.at / f"part{self.n}"))
        for f in (self.at / f"part{self.n}").glob("*.parquet"):
            shutil.copy(f, self.at / "in" / f"{self.n:03d}.parquet")

    def run(self):
        rows = self.build(self.spark.readStream.schema(ENRICHED).option("maxFilesPerTrigger", 1).parquet(str(self.at / "in")))
        R.start(rows, "test", str(self.at / "ck"), self.write, str(self.at / "out"), {"availableNow": True}).awaitTermination()
        if not self.write:
            return self.spark.read.schema(rows.schema).parquet(str(self.at / "out"))


@pytest.fixture(autouse=True)
def two_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_admission_drops_duplicates_and_audits_late_rows_over_a_restart(spark, tmp_path):
    f = Feed(spark, tmp_path, lambda s: P.admit(s.select("event_id", "observed_at")))
    f.put(event("a", 1_000_000), event("a", 1_000_000))
    f.put(event("far", 1_530_000, route_id="R9"))
    f.run()
    f.put(event("b", 1_000_000), event("c", 1_600_000), event("far", 1_530_000, route_id="R9"))  # the watermark is 1 500 000
    got = sorted((r.event_id, r.outcome) for r in f.run().collect())
    assert got == [("a", "admitted"), ("b", "late"), ("c", "admitted"), ("far", "admitted")]


def test_windows_close_once_and_never_reopen(spark, tmp_path):
    root = str(tmp_path / "tables")
    f = Feed(spark, tmp_path, P.gate, R.windows_batch(root))
    f.put(event("a", 290_000, **VISIT))
    f.put(event("far", 450_000 + 30_000, agency_id="other"))  # watermark 450 000: the window of 0 is final at 420 000
    f.run()
    f.put(event("old", 280_000, **VISIT), event("b", 310_000, trip_id="T2", **VISIT), event("dwell", 305_000, **VISIT))
    f.put(event("far2", 3_000_000, agency_id="other"))
    f.run()
    read = lambda t, s: spark.read.schema(s).parquet(f"{root}/{t}")
    assert [r.event_id for r in read("late", ENRICHED).collect()] == ["old"]
    assert {r.event_id for r in read("ledger", ENRICHED).collect()} == {"a", "b", "dwell", "far", "far2"}
    rows = read("metrics", METRIC).where("agency_id = 'demo' AND generation = 'live-v3'").orderBy("window_start").collect()
    assert [(r.window_start, r.arrival_count, r.mean_headway_seconds, r.context_event_count) for r in rows] == [(0, 1, None, 0), (300_000, 1, 20, 1)]
    events = frame(spark, [event("a", 290_000, **VISIT), event("b", 310_000, trip_id="T2", **VISIT), event("dwell", 305_000, **VISIT)])
    key = lambda df: sorted((r.generation, r.window_start, r.input_digest, r.arrival_count, r.headway_count, r.vehicle_count) for r in df.collect())
    assert key(read("metrics", METRIC).where("agency_id = 'demo'")) == sorted(key(route_windows(events)) + key(cross_windows(events)))


def test_visits_are_carried_until_they_expire(spark, tmp_path):
    """Each batch reads what the one before it carried on, and the windows are those of one run over all events."""
    s, root = Settings(lookback=600_000), str(tmp_path)
    batches = [[event("a", 10_000, **VISIT)], [event("b", 310_000, trip_id="T2", **VISIT)], [], [event("c", 1_300_000, trip_id="T3", **VISIT)]]
    live = {}
    for n in (0, 1, 2, 3, 3):  # the last is replayed
        closed = frame(spark, batches[n]).withColumn("window_start", window_start("observed_at", s.window)).withColumn("outcome", F.lit("closed"))
        R.windows_batch(root, s)(closed, n)
        live[n] = sorted(r.event_id for r in spark.read.schema(R.VISITS).parquet(f"{root}/live/batch_id={n}").collect())
    assert live == {0: ["a"], 1: ["a", "b"], 2: ["a", "b"], 3: ["c"]}
    assert sorted(p.name for p in (tmp_path / "live").glob("batch_id=*")) == ["batch_id=2", "batch_id=3"]
    key = lambda df: sorted((r.window_start, r.input_digest, r.arrival_count, r.headway_count, r.context_event_count) for r in df.collect())
    got = spark.read.schema(METRIC).parquet(f"{root}/metrics").where("generation = 'live-v3'")
    assert key(got) == key(cross_windows(frame(spark, [e for b in batches for e in b]), s)) and len(key(got)) == 3
    with pytest.raises(AnalysisException):
        R.windows_batch(root, s)(closed, 9)  # what the batch before carried on is gone


def test_serving_follows_the_metrics(spark, tmp_path):
    events = frame(spark, [event("a", 10_000, **VISIT), event("b", 310_000, trip_id="T2", **VISIT)])
    root = str(tmp_path / "tables")
    for n, metrics in enumerate([route_windows(events.where("event_id = 'a'")), route_windows(events)]):
        metrics.write.parquet(f"{root}/metrics/batch_id={n}")
        commands.serve(spark, f"{root}/metrics", str(tmp_path / "serving"), str(tmp_path / "ck"), once=True).awaitTermination()
    want = serving.latest(serving.serving_rows(spark.read.schema(METRIC).parquet(f"{root}/metrics").drop("batch_id")))
    rows = lambda df: [(r.window_start, r.version, r.record_json) for r in df.collect()]
    got = commands.served(spark, str(tmp_path / "serving"))
    assert rows(got) == rows(want) and [r.window_start for r in got.collect()] == [0, 300_000]


def test_figures_as_text(spark):
    p = R.Progress()
    p.rows = [("q\"1", 0, 5, 2.5, None, 1), ("q\"1", 1, 7, 3.5, None, 0), ("q\"1", 1, 7, 3.5, None, 0)]
    samples = M.of_progress(p.frame(spark))
    body = M.text(samples.unionByName(M.of_lag(spark.createDataFrame([("g", "t", 58)], "group string, topic string, lag long"))))
    assert 'tramline_input_rows_total{query="q\\"1"} 12.0\n' in body and 'tramline_late_rows_total{query="q\\"1"} 1.0\n' in body
    assert 'tramline_rows_per_second{query="q\\"1"} 3.5\n' in body and 'tramline_lag{group="g",topic="t"} 58.0\n' in body
    assert "# TYPE tramline_input_rows_total counter\n" in body
    server = M.endpoint(lambda: body)
    try:
        with urllib.request.urlopen(f"http://127.0.0.1:{server.server_port}/metrics", timeout=10) as r:
            assert r.read().decode() == body
    finally:
        server.shutdown()


def test_log_boundaries():
    offsets = lambda **parts: '{"t": {%s}}' % ", ".join(f'"{k[1:]}": {v}' for k, v in parts.items())
    logs = {"startOffset": offsets(p0=10), "endOffset": offsets(p0=12), "latestOffset": offsets(p0=30, p1=4)}
    got = M.boundaries({"name": "q", "sources": [logs, {"startOffset": None, "endOffset": '{"logOffset": 3}', "latestOffset": None}, {"endOffset": "none"}]})
    assert got == [("q", "t", 10, 30, 12), ("q", "t", 0, 4, None)]


def test_progress_of_a_running_query(spark, tmp_path):
    p = R.Progress()
    spark.streams.addListener(p)
    try:
        f = Feed(spark, tmp_path, lambda s: s.select("event_id"))
        f.put(event("a", 1), event("b", 2))
        f.run()
        deadline = time.time() + 30
        while time.time() < deadline and sum(r[2] for r in p.rows) < 2:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(p)
    got = {r["name"]: r["value"] for r in M.of_progress(p.frame(spark)).where("labels['query'] = 'test'").collect()}
    assert got["input_rows_total"] == 2 and got["late_rows_total"] == 0


def test_native_windows_equal_the_batch(spark, tmp_path):
    events = [event(f"e{k}", 1_000_000 + 100_000 * k, trip_id=f"T{k % 3}", **VISIT) for k in range(20)]
    f = Feed(spark, tmp_path, lambda s: P.final_windows(s.select("event_id", "observed_at", "agency_id", "route_id", "direction_id", "service_date")))
    f.put(*events, *events[:5])
    f.put(event("far", 9_000_000, route_id="R9"))
    got = [r.event_id for r in f.run().collect()]
    assert sorted(got) == sorted(e["event_id"] for e in events)


def test_waiting_for_a_schedule(spark, tmp_path):
    s = Settings(wait_rows=2, wait_deadline=15_000, wait_retry=1_000)
    ddl = "agency_id string, kind string, at long, schedule_version string, record string"
    (tmp_path / "in").mkdir()

    def put(name, rows):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(str(tmp_path / name))
        for p in (tmp_path / name).glob("*.parquet"):
            shutil.copy(p, tmp_path / "in" / f"{name}.parquet")

    out = P.wait_for_schedule(spark.readStream.schema(ddl).parquet(str(tmp_path / "in")), s)
    q = R.start(out, "wait", str(tmp_path / "ck"), path=str(tmp_path / "out"), trigger={"processingTime": "200 milliseconds"})
    def seen(n):
        deadline, got = time.time() + 40, {}
        while time.time() < deadline and len(got) < n:
            time.sleep(0.5)
            got = {r.record: (r.schedule_version, r.unmatched_reason) for r in spark.read.schema(P.WAITED).parquet(str(tmp_path / "out")).collect()}
        return got

    try:
        put("a", [("x", "event", 50, None, "1"), ("x", "event", 60, None, "2"), ("x", "event", 70, None, "3"), ("y", "event", 5, None, "4")])
        assert list(seen(1).values()) == [(None, "schedule_buffer_full")]  # two of three are held
        put("b", [("x", "version", 55, "v1", None)])
        got = seen(4)
    finally:
        q.stop()
    full = next(k for k, v in got.items() if v[1] == "schedule_buffer_full")
    want = {"1": (None, "schedule_unavailable"), "2": ("v1", None), "3": ("v1", None), "4": (None, "schedule_unavailable")}
    assert got == {**want, full: (None, "schedule_buffer_full")}


def test_no_fresh_start_over_history(spark, tmp_path):
    with pytest.raises(RuntimeError):
        R.guard_fresh_start(spark, spark.range(1), str(tmp_path / "none"))
    R.guard_fresh_start(spark, spark.range(0), str(tmp_path / "none"))


def test_lag(spark):
    rows = [("g", "t", 10, 30, c) for c in (12, None, 2, 50)]
    got = R.lag(spark.createDataFrame(rows, "group string, topic string, low long, high long, committed long")).first().lag
    assert got == 18 + 20 + 20 + 0


def test_the_whole_job(spark, tmp_path):
    """Duplicates, late, unknown and unscheduled events go where they belong; a second start goes on from the first."""
    from tests.test_schedules import T0, load
    from tramline.operators.schedules import enrich
    from tramline.streaming import job as J

    _, t, versions = load(spark)
    versions = versions.select("agency_id", "schedule_version", "effective_from")
    source, root, n = tmp_path / "in", str(tmp_path / "tables"), 0
    source.mkdir()
    versions.coalesce(1).write.parquet(str(tmp_path / "versions"))

    def put(*events):
        nonlocal n
        n += 1
        frame(spark, events).coalesce(1).write.parquet(str(tmp_path / f"part{n}"))
        for f in (tmp_path / f"part{n}").glob("*.parquet"):
            shutil.copy(f, source / f"{n:03d}.parquet")

    def run(checkpoint="ck"):
        events = spark.readStream.schema(J.EVENT).option("maxFilesPerTrigger", 1).parquet(str(source))
        announced = spark.readStream.schema(J.VERSION).parquet(str(tmp_path / "versions"))
        running = J.start_job(spark, events, announced, t, root, str(tmp_path / checkpoint), Settings(wait_deadline=0), {"availableNow": True})
        J.stop_job(running)
        return {name: sorted(r.event_id for r in rows.select("event_id").collect()) for name, rows in J.job_tables(spark, root).items() if name != "metrics"}

    first = [event("e1", T0, **VISIT), event("e2", T0 + 20_000, trip_id="T2", **VISIT)]
    put(*first, first[0], event("u", T0, trip_id="TX", **VISIT), event("o", T0, agency_id="other", **VISIT))
    put(event("far", T0 + 3_000_000, trip_id="T3", **VISIT))
    put(event("old", T0, **VISIT))
    got = run()
    assert got["admitted"] == ["e1", "e2", "far", "o", "u"] and got["late_events"] == ["old"]
    assert got["unmatched"] == ["o", "u"] and got["enriched_events"] == got["ledger"] == ["e1", "e2", "far"]
    assert {r.event_id: r.unmatched_reason for r in J.job_tables(spark, root)["unmatched"].collect()} == {"o": "schedule_unavailable", "u": "unknown_trip"}
    put(event("new", T0 + 3_020_000, **VISIT), event("new", T0 + 3_020_000, **VISIT))
    again = run()
    assert again["enriched_events"] == again["ledger"] == ["e1", "e2", "far", "new"]
    key = lambda df: sorted((r.generation, r.window_start, r.route_id, r.input_digest, r.headway_count) for r in df.collect())
    batch = enrich(frame(spark, first), versions, t["trips"], t["calendar"], t["calendar_dates"])
    assert key(J.job_tables(spark, root)["metrics"]) == sorted(key(route_windows(batch)) + key(cross_windows(batch)))
    with pytest.raises(RuntimeError):
        run("lost")


def test_state_is_by_lot_and_rows_come_through_whole(spark, tmp_path):
    """Many ids, windows and events of one agency: few states, each event once, and nothing of it changed."""
    n = 3000
    events = [event(f"é{k}", 1_000_000 + 1_000 * k, trip_id=f"T{k % 7}", stop="S\n\"1", delay=k % 90, vehicle_id=None if k % 5 else "V", route_id=f"R{k % 11}") for k in range(n)]
    for name in ("admission", "gate", "wait"):
        (tmp_path / name).mkdir()
        f = Feed(spark, tmp_path / name, None)
        if name == "wait":
            ddl = "agency_id string, kind string, at long, schedule_version string, record string"
            rows = [("a", "event", k, None, str(k)) for k in range(n)] + [("a", "version", 10, "v1", None), ("a", "version", 1000, "v3", None), ("a", "version", 1000, "v2", None)]
            spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / name / "rows"))
            out = P.wait_for_schedule(spark.readStream.schema(ddl).parquet(str(tmp_path / name / "rows")), Settings(wait_rows=6, wait_deadline=0))
            q = R.start(out, name, str(tmp_path / name / "ck"), path=str(tmp_path / name / "out"), trigger={"once": True})
        else:
            f.put(*events[: n // 2], *events[:9])
            f.put(*events[n // 2 :])
            f.put(event("far", 9_000_000))
            source = spark.readStream.schema(ENRICHED).option("maxFilesPerTrigger", 1).parquet(str(f.at / "in"))
            out = P.admit(source) if name == "admission" else P.gate(source)
            q = R.start(out, name, str(f.at / "ck"), path=str(f.at / "out"), trigger={"availableNow": True})
        q.awaitTermination()
        assert max(s["numRowsUpdated"] for p in q.recentProgress for s in p["stateOperators"]) <= 1024  # entries of 256 lots with their timers, not of each row
        got = spark.read.schema(out.schema).parquet(str(tmp_path / name / "out"))
        if name == "wait":
            seen = {int(r.record): (r.schedule_version, r.unmatched_reason) for r in got.collect()}
            assert len(seen) == got.count() == n and all(seen[k] == ("v3" if k >= 1000 else "v1", None) for k in range(10, n))
            early = sorted(seen[k][1] for k in range(10))
            assert early == ["schedule_buffer_full"] * 4 + ["schedule_unavailable"] * 6
            continue
        want_columns = frame(spark, events[:1]).columns
        want = frame(spark, events).select(F.to_json(F.struct("*")).alias("j"))
        left = got.where(("outcome = 'admitted'" if name == "admission" else "outcome = 'closed'") + " AND event_id <> 'far'").dropDuplicates(["event_id"])
        assert sorted(r.j for r in left.select(F.to_json(F.struct(*want_columns)).alias("j")).collect()) == sorted(r.j for r in want.collect())
        assert got.where("outcome = 'admitted'").count() == (n + 1 if name == "admission" else n + 10)
