"""Replay of pinned inputs: rebuild windows from their ledger and prove that they are the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.operators.headways import cross_windows
from tramline.operators.quality import METRIC_KEY, conflicts
from tramline.operators.windows import _joined, route_windows, windowed
from tramline.plans.config import WINDOW_KEY, Settings

RESERVED = ("live-v1", "live-v2", "live-v3")


class ParityError(ValueError):
    """Rebuilt rows differ from recorded ones; `differences` holds at most ten fields."""

    def __init__(self, differences: list):
        super().__init__(f"replay differs: {differences}")
        self.differences = differences


def in_windows(events: DataFrame, keys: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Events whose window is among the keys."""
    rows = windowed(events, settings)
    k = keys.select(*[F.col(c).alias(f"_{c}") for c in WINDOW_KEY]).distinct()
    on = F.lit(True)
    for c in WINDOW_KEY:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(k, on, "left_semi")


def without_ledger(metrics: DataFrame, events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Metric rows none of whose events are in the ledger."""
    return _joined(metrics, windowed(events, settings).select(*WINDOW_KEY).distinct().withColumn("_has", F.lit(True)), F.lit(True), WINDOW_KEY).where("_has IS NULL").drop("_has")


def differences(left: DataFrame, right: DataFrame, key: list[str], skip: tuple[str, ...] = ()) -> DataFrame:
    """key..., field, left_value, right_value where two tables differ, a row that one lacks as field `row`."""
    fields = [c for c in left.columns if c not in key and c not in skip]
    side = lambda df, n: df.select(*[F.col(k).alias(k if n == "l" else f"_{k}") for k in key], F.struct(*[F.col(c).cast("string").alias(c) for c in fields]).alias(n))
    on = F.lit(True)
    for k in key:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    both = side(left, "l").join(side(right, "r"), on, "full")
    both = both.select(*[F.coalesce(k, f"_{k}").alias(k) for k in key], "l", "r")
    lacks = F.col("l").isNull() | F.col("r").isNull()
    each = [F.struct(F.lit(c).alias("field"), F.col(f"l.{c}").alias("left_value"), F.col(f"r.{c}").alias("right_value")) for c in fields]
    row = F.struct(F.lit("row").alias("field"), F.when(F.col("l").isNotNull(), "present").alias("left_value"), F.when(F.col("r").isNotNull(), "present").alias("right_value"))
    cells = F.when(lacks, F.array(row)).otherwise(F.filter(F.array(*each), lambda x: ~x["left_value"].eqNullSafe(x["right_value"])))
    return both.select(*key, F.explode(cells).alias("d")).select(*key, "d.*")


def rebuild(metrics: DataFrame, ledger: DataFrame, source: str, generation: str, settings: Settings = Settings()) -> DataFrame:
    """Rows of the source generation rebuilt from the ledger under a new name, after they proved equal.

    A reserved name, a clash of records under one key, or any difference is an error before anything is returned. Windows
    that reach back need the whole ledger of their routes, so only their rows are narrowed to the recorded keys.
    """
    if generation in RESERVED:
        raise ValueError(f"{generation} is a reserved generation")
    recorded = metrics.where(F.col("generation") == source)
    if not conflicts(recorded, *METRIC_KEY).isEmpty():
        raise ValueError("conflicting records for one window")
    recorded = recorded.dropDuplicates(METRIC_KEY)
    events = ledger.where((F.col("generation") == source) & F.col("unmatched_reason").isNull()).drop("generation")
    across = source == "live-v3"
    built = cross_windows(events, settings) if across else route_windows(in_windows(events, recorded, settings).drop("window_start"), settings)
    built = built.withColumn("generation", F.lit(source))
    if across:
        built = _joined(built, recorded.select(*WINDOW_KEY).distinct().withColumn("_has", F.lit(True)), F.lit(True), WINDOW_KEY).where("_has").drop("_has")
    off = differences(recorded.select(*built.columns), built, METRIC_KEY).orderBy(*METRIC_KEY, "field").limit(10).collect()
    if off:
        raise ParityError([r.asDict() for r in off])
    return built.withColumn("generation", F.lit(generation))


def migration(metrics: DataFrame, enriched: DataFrame, ledger: DataFrame, source: str = "live-v2", settings: Settings = Settings()) -> DataFrame:
    """Ledger rows for recorded windows that have none: the enriched events of those windows, if they rebuild them exactly.

    Not for windows that reach back: their context cannot be proved from the enriched events of a window.
    """
    if source == "live-v3":
        raise ValueError("live-v3 needs its own ledger")
    have = ledger.where(F.col("generation") == source)
    missing = without_ledger(metrics.where(F.col("generation") == source), have, settings)
    events = in_windows(enriched.where("unmatched_reason IS NULL"), missing, settings).drop("window_start")
    built = route_windows(events, settings)
    off = differences(missing.select(*built.columns), built, METRIC_KEY).limit(10).collect()
    if off:
        raise ParityError([r.asDict() for r in off])
    return events.withColumn("generation", F.lit(source))
