"""Static schedules: a ZIP of CSV tables, validated and turned into DataFrames."""

from __future__ import annotations

import csv
import io
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.identity import canonical_json, sha256_hex
from tramline.functions.scalars import clock_seconds
from tramline.operators.schedules import violations
from tramline.plans.model import SCHEDULE_TABLES

#: Columns that a table needs; others are kept as they come.
NEEDED = {**SCHEDULE_TABLES, "agency": ["agency_timezone"], "routes": ["route_id"], "stops": ["stop_id", "stop_lat", "stop_lon"], "trips": ["route_id", "service_id", "trip_id"]}
OPTIONAL = ("calendar", "calendar_dates")
MOST_ENTRIES, MOST_BYTES = 100, 64 << 20


def read_archive(body: bytes) -> dict[str, tuple[list[str], list[list[str]]]]:
    """Header and rows of each table; an archive out of bounds or malformed is an error."""
    with zipfile.ZipFile(io.BytesIO(body)) as z:
        entries = z.infolist()
        names = [e.filename for e in entries]
        if len(entries) > MOST_ENTRIES or sum(e.file_size for e in entries) > MOST_BYTES:
            raise ValueError("the archive exceeds its limits")
        if len(set(names)) < len(names) or any("/" in n or "\\" in n for n in names):
            raise ValueError("names must be unique and without folders")
        if "frequencies.txt" in names:
            raise ValueError("schedules by frequency are not supported")
        out = {}
        for table, needed in NEEDED.items():
            if f"{table}.txt" not in names:
                if table not in OPTIONAL:
                    raise ValueError(f"{table}.txt is missing")
                continue
            header, *rows = list(csv.reader(io.StringIO(z.read(f"{table}.txt").decode("utf-8-sig")))) or [[]]
            rows = [r for r in rows if r]
            if not set(needed) <= set(header):
                raise ValueError(f"columns are missing in {table}")
            if any(len(r) != len(header) for r in rows):
                raise ValueError(f"rows of {table} are malformed")
            out[table] = (header, rows)
    if not any(out.get(t, ([], []))[1] for t in OPTIONAL):
        raise ValueError("a service calendar is needed")
    if len(out["agency"][1]) != 1:
        raise ValueError("an archive has one agency")
    return out


def tables(spark: SparkSession, body: bytes, agency_id: str) -> tuple[str, dict[str, DataFrame]]:
    """schedule_version (SHA-256 of the archive) and its tables as strings, with publication_id, version and row number."""
    version = sha256_hex(body)
    publication = sha256_hex(canonical_json([agency_id, version]))
    out = {}
    parsed = read_archive(body)
    for name, columns in SCHEDULE_TABLES.items():
        header, rows = parsed.get(name, (columns, []))
        ddl = ", ".join(f"`{c}` string" for c in header) + ", row_no int"
        df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], ddl)
        for c in columns:
            if c not in header:
                df = df.withColumn(c, F.lit(None).cast("string"))
        out[name] = df.withColumn("publication_id", F.lit(publication)).withColumn("schedule_version", F.lit(version))
    return version, out


def check(schedule: dict[str, DataFrame]) -> None:
    """Raises if keys repeat, references lead nowhere, coordinates or clocks are out of range."""
    rows = violations(schedule).limit(10).collect()
    if rows:
        raise ValueError(f"the schedule is inconsistent: {[tuple(r) for r in rows]}")
    lat, lon = F.col("stop_lat").try_cast("double"), F.col("stop_lon").try_cast("double")
    if not schedule["stops"].where(~F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))).isEmpty():
        raise ValueError("a stop has no valid coordinates")
    bad = clock_seconds(F.col("arrival_time")).isNull() | clock_seconds(F.col("departure_time")).isNull() | (F.coalesce(F.col("stop_sequence").try_cast("int"), F.lit(-1)) < 0)
    if not schedule["stop_times"].where(bad).isEmpty():
        raise ValueError("a stop time is malformed")
