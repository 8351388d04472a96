"""What an operator runs over the lake: load a schedule, pin, replay, report coverage, migrate a ledger, query, check."""

from __future__ import annotations

import hashlib
import json
import re
import time
import urllib.request
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators import coverage as C
from tramline.operators import quality, replay, schedules, serving
from tramline.plans.config import Settings
from tramline.plans.model import ENRICHED, METRIC, SCHEDULE_TABLES
from tramline.sources import archive
from tramline.sources.lake import Lake
from tramline.sources.sinks import committed, idempotent
from tramline.streaming.runner import start

LEDGER = ENRICHED + ", generation string"
ORIGINS = "event_id string, generation string, origin string, manifest string"
VERSIONS = "agency_id string, schedule_version string, publication_id string, effective_from long"
TABLES = ("route_window_metrics", "metric_inputs", "enriched_events", "normalized_events", "schedule_versions", *(f"schedule_{n}" for n in SCHEDULE_TABLES))


def instant(iso: str) -> int:
    """Epoch milliseconds of an ISO instant with a timezone."""
    at = datetime.fromisoformat(iso)
    if at.tzinfo is None:
        raise ValueError("an instant needs a timezone")
    return int(at.timestamp() * 1000)


def _schema(spark: SparkSession, ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def _scan(lake: Lake, table: str, ddl: str, version="latest") -> DataFrame:
    return lake.scan(table, _schema(lake.spark, ddl), version)


def _schedule_ddl(name: str) -> str:
    return ", ".join(f"`{c}` string" for c in SCHEDULE_TABLES[name]) + ", row_no int, publication_id string, schedule_version string"


def load_schedule(lake: Lake, body: bytes, agency: str, effective_from: str) -> str:
    """The schedule version. Tables are written first, the version row last; a publication loaded before is left alone.

    A new version must begin after every other of its agency, and one loaded before must be given the same beginning.
    A load that broke off is taken up where it did: tables that hold the publication already are not written again.
    """
    start = instant(effective_from)
    version, tables = archive.tables(lake.spark, body, agency)
    archive.check(tables)
    publication = tables["agency"].first()["publication_id"]
    known = _scan(lake, "schedule_versions", VERSIONS).where(F.col("agency_id") == agency)
    before = known.where(F.col("publication_id") == publication).first()
    if before is not None:
        if before["effective_from"] != start:
            raise ValueError("the publication is loaded with another beginning")
        return version
    last = known.agg(F.max("effective_from")).first()[0]
    if last is not None and start <= last:
        raise ValueError("a version begins after the one before it")
    for name, df in tables.items():
        if not _scan(lake, f"schedule_{name}", _schedule_ddl(name)).where(F.col("publication_id") == publication).isEmpty():
            continue
        lake.append(f"schedule_{name}", df.select(*SCHEDULE_TABLES[name], "row_no", "publication_id", "schedule_version"))
    lake.append("schedule_versions", lake.spark.createDataFrame([(agency, version, publication, start)], VERSIONS))
    return version


def fetch_archive(place: str, most: int = 16 << 20) -> bytes:
    """The bytes of a local file or of an http(s) address, at most `most`."""
    opened = urllib.request.urlopen(place, timeout=60) if re.match("https?://", place) else open(place, "rb")
    with opened as f:
        body = f.read(most + 1)
    if len(body) > most:
        raise ValueError("the archive is larger than allowed")
    return body


def schedule(lake: Lake, version: str, snapshots: dict | None = None) -> dict[str, DataFrame]:
    """The tables of a schedule version; where `snapshots` pins them, as they were then."""
    at = lambda n: (snapshots or {}).get(f"schedule_{n}", "latest")
    return {n: _scan(lake, f"schedule_{n}", _schedule_ddl(n), at(n)).where(F.col("schedule_version") == version) for n in SCHEDULE_TABLES}


def pin(lake: Lake, generation: str = "live-v2", required: tuple[str, ...] = ("route_window_metrics", "metric_inputs"), path: str | None = None) -> dict:
    """The current version of each table. An absent table is pinned as null, never read as its latest; required ones must exist."""
    snapshots = lake.pin(*required, optional=tuple(t for t in TABLES if t not in required))
    manifest = {"source_generation": generation, "schema_version": 1, "created_at": int(time.time() * 1000), "snapshots": snapshots}
    if path:
        with open(path, "x") as f:  # never over another
            json.dump(manifest, f)
    return manifest


def pin_coverage(lake: Lake, path: str | None = None) -> dict:
    """The current versions of all that a coverage report reads: events, versions and the tables of schedules."""
    return pin(lake, required=("enriched_events", "schedule_versions", *(f"schedule_{n}" for n in SCHEDULE_TABLES)), path=path)


def replay_pinned(lake: Lake, manifest: dict, generation: str, settings: Settings = Settings()) -> DataFrame:
    """Rebuilds the pinned windows, writes them under a new generation, reads them again and compares."""
    pinned, source = manifest["snapshots"], manifest["source_generation"]
    if not _scan(lake, "route_window_metrics", METRIC).where(F.col("generation") == generation).isEmpty():
        raise ValueError(f"generation {generation} has rows")
    metrics = _scan(lake, "route_window_metrics", METRIC, pinned["route_window_metrics"])
    ledger = _scan(lake, "metric_inputs", LEDGER, pinned["metric_inputs"])
    built = replay.rebuild(metrics, ledger, source, generation, settings)
    columns = _schema(lake.spark, METRIC).names
    for c in columns:
        if c not in built.columns:
            built = built.withColumn(c, F.lit(None).cast("long"))
    built = built.select(*columns)
    lake.append("route_window_metrics", built)
    written = _scan(lake, "route_window_metrics", METRIC).where(F.col("generation") == generation)
    off = replay.differences(written, built, quality.METRIC_KEY).limit(10).collect()
    if off:
        raise replay.ParityError([r.asDict() for r in off])
    return written


def coverage_report(lake: Lake, manifest: dict, agency: str, service_date: str, as_of: str, version: str, grace_seconds: int = 300) -> C.Report:
    """Coverage of a day from pinned events, by the schedule version given, as the pinned tables hold it.

    The header carries the digests of the schedule's rows and of the pins, so that a report tells what it was made from.
    """
    cutoff = instant(as_of)
    if cutoff > manifest["created_at"]:
        raise ValueError("as_of lies after snapshot collection")
    versions = _scan(lake, "schedule_versions", VERSIONS, manifest["snapshots"]["schedule_versions"]).where(F.col("agency_id") == agency)
    found = versions.where(F.col("schedule_version") == version).first()
    if found is None:
        raise ValueError("the agency has no such schedule version")
    t = schedule(lake, version, manifest["snapshots"])
    day = F.lit(service_date.replace("-", ""))
    active = schedules.with_activity(t["trips"].withColumn("start_date", day), t["calendar"], t["calendar_dates"]).where("active")
    events = _scan(lake, "enriched_events", ENRICHED, manifest["snapshots"]["enriched_events"])
    zone = t["agency"].first()["agency_timezone"]
    report = C.coverage(events, active, t["stop_times"], agency=agency, version=version, zone=zone, service_date=service_date, as_of=cutoff, grace_seconds=grace_seconds)
    report.header |= {"publication_id": found["publication_id"], "effective_from": found["effective_from"], "schedule_digest": schedule_digest(t), "snapshots": manifest["snapshots"]}
    return report


def schedule_digest(tables: dict[str, DataFrame]) -> str:
    """SHA-256 over the tables by name, each as the count and the order-free sum of its rows' hashes."""
    out = []
    for name in sorted(tables):
        columns = SCHEDULE_TABLES[name]
        row = F.xxhash64(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})).cast("decimal(20,0)")
        r = tables[name].agg(F.count("*").alias("n"), F.coalesce(F.sum(row), F.lit(0)).cast("string").alias("s")).first()
        out.append([name, r["n"], r["s"]])
    return hashlib.sha256(json.dumps(out).encode()).hexdigest()


def write_report(report: C.Report, path: str) -> None:
    """The report as one JSON file, never over another: header, reasons, routes and trips in their order."""
    rows = lambda df: [r.asDict(recursive=True) for r in df.toLocalIterator()]
    with open(path, "x") as f:
        json.dump({**report.header, "excluded": rows(report.excluded), "routes": rows(report.routes), "trips": rows(report.trips)}, f)


def migrate(lake: Lake, manifest: dict, apply: bool = False, settings: Settings = Settings()) -> int:
    """How many ledger rows are missing and proved; with `apply` they are appended, if the ledger is still the pinned one."""
    pinned = manifest["snapshots"]
    rows = replay.migration(_scan(lake, "route_window_metrics", METRIC, pinned["route_window_metrics"]), _scan(lake, "enriched_events", ENRICHED, pinned["enriched_events"]), _scan(lake, "metric_inputs", LEDGER, pinned["metric_inputs"]), manifest["source_generation"], settings)
    n = rows.count()
    if apply and n:
        if (now := lake.version("metric_inputs")) != pinned["metric_inputs"]:
            raise RuntimeError(f"metric_inputs is at version {now}, not {pinned['metric_inputs']}")
        # Where recovered rows come from is kept beside the ledger, by event, before the ledger itself grows.
        origin = json.dumps({"snapshots": pinned, "created_at": manifest["created_at"]}, sort_keys=True)
        lake.append("metric_input_origins", rows.select("event_id", "generation", F.lit("enriched_events").alias("origin"), F.lit(origin).alias("manifest")))
        lake.append("metric_inputs", rows.select(*_schema(lake.spark, LEDGER).names), expect=pinned["metric_inputs"])
    return n


def query(lake: Lake, generation: str = "live-v2") -> DataFrame:
    return serving.latest(serving.serving_rows(_scan(lake, "route_window_metrics", METRIC)), generation)


def serve(spark: SparkSession, metrics: str, root: str, checkpoint: str, once: bool = False):
    """A query that inserts the metrics written to a folder into a serving table, as they come; `once`: those that are there.

    A file counts as read once its rows are inserted. What is inserted again has the same keys and versions, so that
    readers of the latest version see no difference; a file that a replayed batch has replaced is read as the new one.
    """
    rows = spark.readStream.schema(_schema(spark, METRIC)).option("ignoreMissingFiles", "true").parquet(metrics)
    write = idempotent(lambda batch: {"serving": serving.serving_rows(batch.select(*_schema(spark, METRIC).names))}, root)
    return start(rows, "serving", checkpoint, write, trigger={"availableNow": True} if once else None)


def served(spark: SparkSession, root: str, generation: str = "live-v2") -> DataFrame:
    """The latest version of each key in a serving table."""
    return serving.latest(committed(spark, root, "serving"), generation)


def check(lake: Lake) -> dict[str, int]:
    """Rows that break each assertion."""
    return {name: df.count() for name, df in quality.run(_scan(lake, "route_window_metrics", METRIC)).items()}
