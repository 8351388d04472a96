"""Append-only tables with versions that can be pinned, on any file system that Spark writes to."""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LOG = "version long, path string, rows long, written_at long"


class Lake:
    """A table is a folder of data folders and a log; version n is what the first n entries of the log name.

    Data are written first, the log entry last: it alone makes rows visible, and it refuses to overwrite, so that of two
    writers of one version one fails. A version that is None is an empty table, never the latest.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self, table: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(LOG).option("recursiveFileLookup", "true").json(f"{self.root}/{table}/log")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def version(self, table: str) -> int | None:
        log = self._log(table)
        return None if log is None else log.agg(F.max("version")).first()[0]

    def append(self, table: str, rows: DataFrame, expect: int | None | str = "any") -> int:
        """The new version. With `expect`, fails if the table has moved on from that version."""
        now = self.version(table)
        if expect != "any" and now != expect:
            raise RuntimeError(f"{table} is at version {now}, not {expect}")
        path = f"{self.root}/{table}/data/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        count = self.spark.read.schema(rows.schema).parquet(path).count()
        new = (now or 0) + 1
        entry = self.spark.createDataFrame([(new, path, count, int(time.time() * 1000))], LOG)
        entry.coalesce(1).write.mode("errorifexists").json(f"{self.root}/{table}/log/{new:020d}")
        return new

    def scan(self, table: str, schema: StructType, version: int | None | str = "latest") -> DataFrame:
        """Rows of a version; filters and columns reach the Parquet scan."""
        version = self.version(table) if version == "latest" else version
        if version is None:
            return self.spark.createDataFrame([], schema)
        paths = [r["path"] for r in self._log(table).where(F.col("version") <= version).orderBy("version").collect()]
        return self.spark.read.schema(schema).parquet(*paths)

    def pin(self, *tables: str, optional: tuple[str, ...] = ()) -> dict[str, int | None]:
        """Current versions; an absent table is an error, or None if it may be absent."""
        out = {t: self.version(t) for t in (*tables, *optional)}
        absent = [t for t in tables if out[t] is None]
        if absent:
            raise ValueError(f"nothing to pin in {absent}")
        return out
