"""Writers of a micro-batch: several tables, each tagged with the batch, replays without effect."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.operators.ops import history_rows


def idempotent(split: Callable[[DataFrame], dict[str, DataFrame]], root: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each table's rows go to a folder of the batch, which a replay overwrites with the same rows.

    The folder `committed` is written last; readers that keep to batches listed there never see half a batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for table, rows in split(batch).items():
                rows.write.mode("overwrite").parquet(f"{root}/{table}/batch_id={batch_id}")
            batch.sparkSession.range(1).select(F.lit(batch_id).cast("long").alias("batch")).coalesce(1).write.mode("overwrite").parquet(f"{root}/committed/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def committed(spark, root: str, table: str) -> DataFrame:
    """Rows of a table from committed batches only."""
    done = spark.read.parquet(f"{root}/committed").select("batch_id")
    return spark.read.parquet(f"{root}/{table}").join(done, "batch_id", "left_semi").drop("batch_id")


def raw_objects(snapshots: DataFrame) -> DataFrame:
    """Manifests and the place of each body, named by content."""
    uri = F.concat(F.lit("raw/"), F.sha2(F.concat_ws("\u0000", "agency_id", "feed_id"), 256), F.lit("/"), "snapshot_id", F.lit(".pb"))
    return snapshots.withColumns({"object_uri": uri, "body_sha256": F.sha2("body", 256), "body_bytes": F.length("body").cast("long"), "schema_version": F.lit(1)})


def ingest(root: str):
    """For foreachBatch over raw snapshots: bodies, manifests, events, dead letters and their history as one batch."""
    from tramline.sources.feed import decode, normalise

    def split(batch: DataFrame) -> dict[str, DataFrame]:
        raw = raw_objects(batch)
        events, letters = normalise(decode(batch))
        return {"raw_objects": raw.select("object_uri", "body"), "raw_feed_snapshots": raw.drop("body"), "normalized_events": events, "dead_letter": letters, "rejected_events": history_rows(letters), "history": history_rows(events)}

    return idempotent(split, root)
