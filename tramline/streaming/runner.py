"""Queries that run: stable names and checkpoints, several tables a batch, a guard against a fresh start over history."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tramline.operators.headways import accepted_visits, cross_windows
from tramline.operators.ops import offset_lag
from tramline.operators.windows import route_windows, windowed
from tramline.plans.config import ROUTE_KEY, Settings
from tramline.sources.sinks import idempotent

VISITS = "agency_id string, route_id string, direction_id int, service_date string, stop_id string, trip_id string, observed_at long, event_id string"


def _live(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """The visits that the batch before carried on. It is an error if they are gone: windows would lose what they look back to."""
    if batch_id == 0:
        return spark.createDataFrame([], VISITS)
    return spark.read.schema(VISITS).parquet(f"{root}/live/batch_id={batch_id - 1}")


def windows_batch(root: str, settings: Settings = Settings()):
    """For foreachBatch over gate(): ledger and late rows, metrics within and across windows, and the visits that count.

    Visits that a window to come can look back to are carried on from batch to batch as the table `live`: a batch reads
    that of the batch before it and no other. Windows close in order of time on all routes, so that those which close
    later begin at least a window after the last that closed; visits more than the lookback before that have expired. A
    replayed batch reads the same table again and writes the same rows to the same place.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def split(rows: DataFrame) -> dict[str, DataFrame]:
            closed = rows.where("outcome = 'closed'")
            last = closed.agg(F.max("window_start")).first()[0]
            closed = closed.drop("outcome", "window_start")
            live = _live(spark, root, batch_id)
            old = live.join(closed.select(*ROUTE_KEY).distinct(), ROUTE_KEY, "left_semi")
            visits = accepted_visits(windowed(closed, settings), settings, old).where(~F.col("earlier")).drop("earlier")
            metrics = route_windows(closed, settings).unionByName(cross_windows(closed, settings, history=old), allowMissingColumns=True)
            live = live.unionByName(visits)
            if last is not None:
                live = live.where(F.col("observed_at") >= last + settings.window - settings.lookback)
            return {"ledger": rows.where("outcome = 'admitted'").drop("outcome"), "late": rows.where("outcome = 'late'").drop("outcome"), "visits": visits, "live": live, "metrics": metrics}

        idempotent(split, root)(batch, batch_id)
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/live/batch_id={batch_id - 2}")  # no replay reaches back to it
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)

    return write


def guard_fresh_start(spark: SparkSession, history: DataFrame, checkpoint: str) -> None:
    """Refuses to begin anew where history was written but its checkpoint is gone."""
    try:
        begun = not spark.read.text(f"{checkpoint}/commits").isEmpty()
    except AnalysisException:
        begun = False
    if not begun and not history.isEmpty():
        raise RuntimeError("history is there but no checkpoint to go on from")


def start(rows: DataFrame, name: str, checkpoint: str, write=None, path: str | None = None, trigger: dict | None = None):
    """Starts a query with a stable name and a checkpoint below `checkpoint`; to foreachBatch or to Parquet."""
    w = rows.writeStream.queryName(name).option("checkpointLocation", f"{checkpoint}/{name}").outputMode("append")
    w = w.trigger(**(trigger or {"processingTime": "10 seconds"}))
    return w.foreachBatch(write).start() if write else w.format("parquet").option("path", path).start()


class Progress(StreamingQueryListener):
    """Figures of running queries as rows: query, batch, input rows, rates, watermark, late rows."""

    def __init__(self):
        self.rows: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self.rows.append((p.name, p.batchId, p.numInputRows, p.processedRowsPerSecond, p.eventTime.get("watermark"), late))

    def onQueryTerminated(self, event) -> None:
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "query string, batch long, input_rows long, rows_per_second double, watermark string, late_rows long")


def lag(offsets: DataFrame) -> DataFrame:
    """group, topic, lag from rows (group, topic, low, high, committed)."""
    return offsets.groupBy("group", "topic").agg(F.sum(offset_lag(F.col("low"), F.col("high"), F.col("committed"))).alias("lag"))
