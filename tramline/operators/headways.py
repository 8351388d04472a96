"""Headways across windows: accepted visits, their predecessors, and the context that a window is computed in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tramline.functions.scalars import digest, seconds, window_start
from tramline.operators.windows import _joined, is_visit, route_windows, windowed
from tramline.plans.config import ROUTE_KEY, WINDOW_KEY, Settings


def accepted_visits(events: DataFrame, settings: Settings = Settings(), history: DataFrame | None = None) -> DataFrame:
    """Visits that count: a trip at a stop again within the lookback of its last counted visit is the same stay.

    Each chain is folded in order by one aggregate over its sorted visits. `history` holds visits that were counted
    before (same columns); they start the chains and come back with `earlier` true.
    """
    stop = F.col("payload.vehicle_position.stop_id")
    rows = events.where(is_visit(non_empty=True)).select(*ROUTE_KEY, stop.alias("stop_id"), "trip_id", "observed_at", "event_id", F.lit(False).alias("earlier"))
    if history is not None:
        rows = rows.unionByName(history.select(*ROUTE_KEY, "stop_id", "trip_id", "observed_at", "event_id").withColumn("earlier", F.lit(True)))
    chains = rows.groupBy(*ROUTE_KEY, "stop_id", "trip_id").agg(F.array_sort(F.collect_list(F.struct("observed_at", "event_id", "earlier"))).alias("v"))
    kind = "array<struct<observed_at: bigint, event_id: string, earlier: boolean>>"
    last = lambda a: F.element_at(a, -1)["observed_at"]
    fold = F.aggregate(
        "v",
        F.from_json(F.lit("[]"), kind),
        lambda a, x: F.when((F.size(a) == 0) | x["earlier"], F.concat(a, F.array(x))).when(x["observed_at"] - last(a) > settings.lookback, F.concat(a, F.array(x))).otherwise(a),
    )
    return chains.select(*ROUTE_KEY, "stop_id", "trip_id", F.explode(fold).alias("x")).select(*ROUTE_KEY, "stop_id", "trip_id", "x.*")


def predecessor_gaps(visits: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Each counted visit with the gap to the visit before it at the stop, if that was another trip within the lookback."""
    w = Window.partitionBy(*ROUTE_KEY, "stop_id").orderBy("observed_at", "event_id")
    before = F.lag(F.struct("observed_at", "trip_id")).over(w)
    gap = F.col("observed_at") - F.col("before.observed_at")
    fits = ~F.col("before.trip_id").eqNullSafe(F.col("trip_id")) & (gap <= settings.lookback)
    return visits.withColumn("before", before).withColumn("gap", F.when(F.col("before").isNotNull() & fits, gap)).drop("before")


def context(windows: DataFrame, visits: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Ids of counted visits in the lookback before each window.

    A visit can serve windows that start within the lookback after it, which touch at most two lookback-long
    buckets of the route: an equality join on route and bucket, whatever the number of windows.
    """
    b = lambda c: F.floor(c / F.lit(settings.lookback)).cast("long")
    w = windows.select(*WINDOW_KEY).distinct().withColumn("bucket", b(F.col("window_start") - 1))
    v = visits.withColumn("bucket", F.explode(F.array(b(F.col("observed_at")), b(F.col("observed_at")) + 1)))
    v = v.select(*[F.col(k).alias(f"_{k}") for k in ROUTE_KEY], F.col("bucket").alias("_bucket"), "observed_at", "event_id")
    on = (F.col("bucket") == F.col("_bucket")) & (F.col("observed_at") < F.col("window_start")) & (F.col("observed_at") >= F.col("window_start") - settings.lookback)
    for k in ROUTE_KEY:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return w.join(v, on).groupBy(*WINDOW_KEY).agg(F.collect_set("event_id").alias("context_ids"))


def cross_windows(events: DataFrame, settings: Settings = Settings(), generation: str = "live-v3", history: DataFrame | None = None) -> DataFrame:
    """Route windows whose visits and headways reach back over the lookback; delays are those of the window alone."""
    rows = windowed(events, settings)
    visits = accepted_visits(rows, settings, history)
    gaps = predecessor_gaps(visits, settings).where(~F.col("earlier")).withColumn("window_start", window_start("observed_at", settings.window))
    counted = gaps.groupBy(*WINDOW_KEY).agg(F.count("*").alias("arrivals"), F.count("gap").alias("gaps"), seconds(F.avg("gap")).alias("mean_gap"))
    ids = rows.groupBy(*WINDOW_KEY).agg(F.collect_set("event_id").alias("ids"))
    none = F.array().cast("array<string>")
    out = route_windows(events, settings, generation)
    for part in (counted, ids, context(rows, visits, settings)):
        out = _joined(out, part, F.lit(True), WINDOW_KEY)
    known = F.coalesce("context_ids", none)
    new = {
        "schema_version": F.lit(2), "arrival_count": F.coalesce("arrivals", F.lit(0)).cast("long"), "headway_count": F.coalesce("gaps", F.lit(0)).cast("long"), "mean_headway_seconds": F.col("mean_gap"),
        "input_digest": digest(F.concat("ids", known)), "context_event_count": F.size(known).cast("long"), "headway_lookback_seconds": F.lit(settings.lookback // 1000).cast("long"),
    }
    return out.withColumns(new).drop("arrivals", "gaps", "mean_gap", "ids", "context_ids")
