"""The serving table: a typed key, a version and the record as JSON; the latest version of a key is what is served."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators.quality import METRIC_KEY

_LONGS = ("window_end", "vehicle_count", "prediction_count", "canceled_trip_count", "arrival_count", "headway_count")
_DOUBLES = ("mean_delay_seconds", "p50_delay_seconds", "p95_delay_seconds", "adherence_rate", "mean_headway_seconds")


def serving_rows(metrics: DataFrame) -> DataFrame:
    return metrics.select(*METRIC_KEY, F.col("version").cast("long").alias("version"), F.to_json(F.struct(*metrics.columns), {"ignoreNullFields": "false"}).alias("record_json"))


def latest_version(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*METRIC_KEY).agg(F.max_by("record_json", "version").alias("record_json"), F.max("version").alias("version"))


def latest(rows: DataFrame, generation: str = "live-v2") -> DataFrame:
    """The served rows of one generation, by key. The filter on the key reaches the scan, below the aggregate."""
    return latest_version(rows).where(F.col("generation") == generation).orderBy(*METRIC_KEY)


def route_reliability(served: DataFrame) -> DataFrame:
    """Typed columns from the JSON record: whole numbers default to 0, doubles to null."""
    get = lambda c: F.get_json_object("record_json", f"$.{c}")
    return served.select(*METRIC_KEY, *[F.coalesce(get(c).try_cast("long"), F.lit(0)).cast("long").alias(c) for c in _LONGS], *[get(c).try_cast("double").alias(c) for c in _DOUBLES])


def query(spark: SparkSession, sql: str, **parameters) -> DataFrame:
    """SQL with named parameters, bound as values."""
    return spark.sql(sql, args=parameters)
