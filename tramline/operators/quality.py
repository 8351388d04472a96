"""Assertions over metric rows: each returns the rows that break it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRIC_KEY = ["generation", "agency_id", "route_id", "direction_id", "service_date", "window_start"]


def repeated_windows(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy(*METRIC_KEY).agg(F.count("*").alias("rows")).where("rows > 1")


def bad_predictions(metrics: DataFrame) -> DataFrame:
    """Negative counts, rates outside 0 to 1, percentiles out of order, statistics without predictions."""
    return metrics.where(
        "prediction_count < 0 OR canceled_trip_count < 0 OR adherence_rate NOT BETWEEN 0 AND 1 OR p50_delay_seconds > p95_delay_seconds"
        " OR (prediction_count = 0 AND mean_delay_seconds IS NOT NULL) OR (prediction_count > 0 AND mean_delay_seconds IS NULL)"
    )


def bad_headways(metrics: DataFrame, lookback_seconds: int = 7200) -> DataFrame:
    """Negative counts or means, a mean without headways, and across windows a mean beyond the lookback."""
    return metrics.where(
        "arrival_count < 0 OR headway_count < 0 OR mean_headway_seconds < 0 OR (headway_count = 0 AND mean_headway_seconds IS NOT NULL)"
        f" OR (headway_count > 0 AND mean_headway_seconds IS NULL) OR (generation = 'live-v3' AND mean_headway_seconds > {lookback_seconds})"
    )


def conflicts(rows: DataFrame, *key: str) -> DataFrame:
    """Keys that stand for more than one distinct record."""
    record = F.to_json(F.struct(*[c for c in rows.columns]), {"ignoreNullFields": "false"})
    return rows.groupBy(*key).agg(F.count_distinct(F.sha2(record, 256)).alias("records")).where("records > 1")


def run(metrics: DataFrame) -> dict[str, DataFrame]:
    return {"unique_windows": repeated_windows(metrics), "valid_predictions": bad_predictions(metrics), "valid_headways": bad_headways(metrics)}
