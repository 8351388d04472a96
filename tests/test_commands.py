"""The commands over a lake, from a schedule to a replay."""

import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import event, frame
from tests.test_schedules import T0, feed, zipped
from tramline import __main__ as cli
from tramline import commands as K
from tramline.operators import schedules as SC
from tramline.operators.windows import route_windows
from tramline.plans.model import METRIC
from tramline.sources.lake import Lake


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def test_schedule_versions_advance(lake):
    body = zipped()
    v = K.load_schedule(lake, body, "demo", "2020-01-01T00:00:00+00:00")
    assert K.load_schedule(lake, body, "demo", "2020-01-01T00:00:00+00:00") == v  # loaded before
    with pytest.raises(ValueError, match="another beginning"):
        K.load_schedule(lake, body, "demo", "2030-01-01T00:00:00+00:00")
    other = zipped(routes="route_id,agency_id,route_short_name,route_long_name,route_type\nR1,demo,2,Other,3\n")
    with pytest.raises(ValueError):
        K.load_schedule(lake, other, "demo", "2020-01-01T00:00:00+00:00")
    with pytest.raises(ValueError, match="timezone"):
        K.load_schedule(lake, other, "demo", "2021-01-01T00:00:00")
    assert lake.version("schedule_versions") == 1 and K.schedule(lake, v)["trips"].count() == 3


def test_a_load_that_broke_off_is_taken_up(lake, monkeypatch):
    body, append = zipped(), Lake.append

    def broken(self, table, rows, **k):
        if table == "schedule_versions":
            raise OSError("gone")
        return append(self, table, rows, **k)

    monkeypatch.setattr(Lake, "append", broken)
    with pytest.raises(OSError):
        K.load_schedule(lake, body, "demo", "2020-01-01T00:00:00+00:00")
    monkeypatch.setattr(Lake, "append", append)
    v = K.load_schedule(lake, body, "demo", "2020-01-01T00:00:00+00:00")
    assert K.schedule(lake, v)["trips"].count() == 3 and lake.version("schedule_trips") == 1 and lake.version("schedule_versions") == 1


def test_archives_are_bounded(tmp_path):
    (tmp_path / "a.zip").write_bytes(b"x" * 100)
    assert K.fetch_archive(str(tmp_path / "a.zip")) == b"x" * 100
    with pytest.raises(ValueError, match="larger"):
        K.fetch_archive(str(tmp_path / "a.zip"), most=99)


def test_coverage_replay_and_migration(spark, lake, tmp_path):
    v = K.load_schedule(lake, zipped(), "demo", "2020-01-01T00:00:00+00:00")
    t = K.schedule(lake, v)
    rows = SC.enrich(frame(spark, feed() + [event("u", T0, trip_id="TX", delay=1)]), K._scan(lake, "schedule_versions", K.VERSIONS), t["trips"], t["calendar"], t["calendar_dates"])
    names = K._schema(spark, K.ENRICHED).names
    lake.append("enriched_events", rows.select(*names))
    good = rows.where("unmatched_reason IS NULL")
    m = route_windows(good)
    for c in K._schema(spark, METRIC).names:
        if c not in m.columns:
            m = m.withColumn(c, F.lit(None).cast("long"))
    lake.append("route_window_metrics", m.select(*K._schema(spark, METRIC).names))
    with pytest.raises(ValueError, match="pin"):
        K.pin(lake)
    manifest = K.pin(lake, required=("route_window_metrics",), path=str(tmp_path / "m.json"))
    assert manifest["snapshots"]["metric_inputs"] is None
    with pytest.raises(FileExistsError):
        K.pin(lake, required=("route_window_metrics",), path=str(tmp_path / "m.json"))
    manifest["created_at"] = K.instant("2026-09-10T17:00:00+00:00")
    whole = K.coverage_report(lake, manifest, "demo", "2026-09-10", "2026-09-10T16:00:00+00:00", v)
    r = whole.routes.first()
    K.write_report(whole, str(tmp_path / "r.json"))
    with pytest.raises(FileExistsError):
        K.write_report(whole, str(tmp_path / "r.json"))
    with open(tmp_path / "r.json") as f:
        told = json.load(f)
    assert [x["trip_id"] for x in told["trips"]] == ["T1", "T2", "T3"] and len(told["schedule_digest"]) == 64 and told["schedule_version"] == v
    with pytest.raises(ValueError, match="no such"):
        K.coverage_report(lake, manifest, "demo", "2026-09-10", "2026-09-10T16:00:00+00:00", "else")
    other = zipped(routes="route_id,agency_id,route_short_name,route_long_name,route_type\nR1,demo,2,Other,3\n")
    later = K.load_schedule(lake, other, "demo", "2026-12-01T00:00:00+00:00")
    assert K.schedule(lake, later, manifest["snapshots"])["trips"].count() == 0 < K.schedule(lake, later)["trips"].count()  # not yet there when pinned
    assert (r.scheduled_trip_count, r.telemetry_trip_count, r.canceled_trip_count, r.telemetry_coverage_rate) == (3, 2, 1, 1.0)
    with pytest.raises(ValueError, match="after snapshot"):
        K.coverage_report(lake, manifest, "demo", "2026-09-10", "2026-09-10T18:00:00+00:00", v)
    assert K.migrate(lake, manifest) == 4 and lake.version("metric_inputs") is None
    assert K.migrate(lake, manifest, apply=True) == 4
    origins = K._scan(lake, "metric_input_origins", K.ORIGINS).collect()
    assert len(origins) == 4 and all(json.loads(x.manifest)["snapshots"]["route_window_metrics"] == 1 for x in origins)
    with pytest.raises(RuntimeError):
        K.migrate(lake, manifest, apply=True)  # the ledger has moved on
    with open(tmp_path / "m2.json", "w") as f:
        json.dump(K.pin(lake), f)
    assert cli.main(["--lake", lake.root, "replay", str(tmp_path / "m2.json"), "again"]) == 0
    assert [x.generation for x in K.query(lake, "again").collect()] == ["again"]
    with pytest.raises(ValueError, match="has rows"):
        K.replay_pinned(lake, K.pin(lake), "again")
    assert cli.main(["--lake", lake.root, "quality"]) == 0
