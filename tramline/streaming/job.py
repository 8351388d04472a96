"""The whole job: events are admitted, wait for their schedule, are enriched, and close in windows.

Three queries with stable names, each with its own checkpoint, joined by tables of Spark's file sink, whose log makes
what one query writes arrive at the next exactly once, also after a failure between the two:

    events --admission--> admitted --enrichment--> enriched_events --windows--> ledger, late, visits, metrics
                                       ^ schedule versions, as a stream of their own
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tramline.operators.schedules import match_trips
from tramline.plans.config import Settings
from tramline.plans.model import ENRICHED, EVENT
from tramline.sources.sinks import committed
from tramline.streaming import processors as P
from tramline.streaming.runner import guard_fresh_start, start, windows_batch

QUERIES = ("admission", "enrichment", "windows")
VERSION = "agency_id string, schedule_version string, effective_from long"


def _folder(spark: SparkSession, path: str) -> str:
    """The folder, made if it is not there: a stream of files cannot begin without."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)
    return path


def admitted(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return P.admit(events, settings)


def enriched(events: DataFrame, versions: DataFrame, schedule: dict[str, DataFrame], settings: Settings = Settings()) -> DataFrame:
    """Admitted events with the version that they waited for and what its schedule says, or a reason.

    events, versions: streams of EVENT and VERSION rows. schedule: trips, calendar and calendar_dates, each with
    schedule_version; they are read anew in each micro-batch, so a version must be in them before it is announced.
    """
    schema = T.StructType.fromDDL(EVENT)
    record = F.to_json(F.struct(*schema.names))
    waiting = events.select("agency_id", F.lit("event").alias("kind"), F.col("observed_at").alias("at"), F.lit(None).cast("string").alias("schedule_version"), record.alias("record"))
    known = versions.select("agency_id", F.lit("version").alias("kind"), F.col("effective_from").alias("at"), "schedule_version", F.lit(None).cast("string").alias("record"))
    out = P.wait_for_schedule(waiting.unionByName(known), settings)
    out = out.select(F.from_json("record", schema).alias("e"), F.col("schedule_version").alias("chosen_version"), F.col("unmatched_reason").alias("waited")).select("e.*", "chosen_version", "waited").drop("schedule_version")
    out = match_trips(out, schedule["trips"], schedule["calendar"], schedule["calendar_dates"])
    out = out.withColumn("unmatched_reason", F.coalesce("waited", "unmatched_reason"))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(ENRICHED)])


def start_job(spark: SparkSession, events: DataFrame, versions: DataFrame, schedule: dict[str, DataFrame], root: str, checkpoint: str, settings: Settings = Settings(), trigger: dict | None = None) -> dict[str, StreamingQuery]:
    """Starts the queries; with {"availableNow": True} as trigger, they take what is there, one after the other.

    Timers of processing time keep such a query running for ever, so enrichment then takes what is there as one batch;
    events that still wait are looked at again by the next start.

    Refuses to begin anew where tables were written but the checkpoint of their query is gone.
    """
    out = {}
    for name in QUERIES:
        tables = {"admission": "admitted", "enrichment": "enriched_events", "windows": "ledger"}
        path = _folder(spark, f"{root}/{tables[name]}")
        guard_fresh_start(spark, spark.read.schema("event_id string").parquet(path), f"{checkpoint}/{name}")
        drain = bool(trigger and trigger.get("availableNow"))
        more = {"checkpoint": checkpoint, "trigger": {"once": True} if drain and name == "enrichment" else trigger}
        if name == "admission":
            q = start(admitted(events, settings), name, path=path, **more)
        elif name == "enrichment":
            rows = _stream(spark, f"{root}/admitted", f"{EVENT}, outcome string").where("outcome = 'admitted'").drop("outcome")
            q = start(enriched(rows, versions, schedule, settings), name, path=path, **more)
        else:
            rows = _stream(spark, f"{root}/enriched_events", ENRICHED).where("unmatched_reason IS NULL")
            q = start(P.gate(rows, settings), name, write=windows_batch(root, settings), **more)
        if drain:
            q.awaitTermination()
        out[name] = q
    return out


def _stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def stop_job(running: dict[str, StreamingQuery], seconds: float = 60) -> None:
    """Stops the queries from the source on; checkpoints and tables stay, so that start_job goes on from there.

    Raises what a query failed with, and a TimeoutError for one that is still active after so many seconds.
    """
    for q in running.values():
        q.stop()
    for name, q in running.items():
        if q.isActive and not q.awaitTermination(seconds):
            raise TimeoutError(f"{name} is still active")
        if q.exception():
            raise q.exception()


def job_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """What the job has written: events admitted and late, enriched and unmatched, and the tables of committed windows."""
    seen = spark.read.schema(f"{EVENT}, outcome string").parquet(f"{root}/admitted")
    rows = spark.read.schema(ENRICHED).parquet(f"{root}/enriched_events")
    out = {name: seen.where(F.col("outcome") == of).drop("outcome") for name, of in (("admitted", "admitted"), ("late_events", "late"))}
    out |= {"enriched_events": rows.where("unmatched_reason IS NULL"), "unmatched": rows.where("unmatched_reason IS NOT NULL")}
    for table in ("ledger", "late", "visits", "metrics"):
        out[table] = committed(spark, root, table)
    return out
