"""Keyed state with timers: admission with an audit of late rows, windows that close once, rows that wait for a schedule.

Rows are dealt into lots by a hash and travel as one JSON string beside what is decided on. A lot has one state, which is read and
written once a batch, and its rows are handled as arrays: no call to the state store for a row, an id or a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tramline.functions.scalars import window_start
from tramline.plans.config import ROUTE_KEY, Settings

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
JUDGED = "record string, outcome string"
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def stateful(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def watermarked(events: DataFrame, delay_ms: int) -> DataFrame:
    """A watermark on the event time, whose column is then dropped.

    A stateful operator that still sees the column loses late rows before it can audit them; without it they arrive.
    """
    ts = F.timestamp_millis("observed_at")
    return events.withColumn("_ts", ts).withWatermark("_ts", f"{delay_ms} milliseconds").drop("_ts")


def _lot(of: str, settings: Settings) -> Column:
    return F.pmod(F.xxhash64(of), F.lit(settings.lots)).cast("int")


def _record(rows: DataFrame) -> Column:
    return F.to_json(F.struct(*rows.columns), _JSON)


def _opened(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows (record, outcome) as the rows that they were, with outcome."""
    return rows.select(F.from_json("record", schema, _JSON).alias("e"), "outcome").select("e.*", "outcome")


def _frozen(df: pd.DataFrame) -> bytes:
    """A frame as compressed bytes, for a state."""
    out, table = pa.BufferOutputStream(), pa.Table.from_pandas(df, preserve_index=False)
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    return out.getvalue().to_pybytes()


def _thawed(raw: bytes) -> pd.DataFrame:
    with pa.ipc.open_stream(raw) as r:
        return r.read_pandas()


def _times(column: pd.Series) -> np.ndarray:
    """Milliseconds; a row without is an error."""
    return column.astype(np.int64).to_numpy()


class Admission(StatefulProcessor):
    """By event id: the first delivery is admitted, others go; one beyond retention is late. State lives for retention."""

    def __init__(self, retention: int):
        self.retention = retention

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.seen = handle, handle.getValueState("seen", "ids binary")

    def _seen(self) -> dict:
        if not self.seen.exists():
            return {}
        old = _thawed(bytes(self.seen.get()[0]))
        return dict(zip(old["event_id"].tolist(), old["at"].tolist(), strict=True))

    def _keep(self, seen: dict) -> None:
        if not seen:
            return self.seen.clear()
        self.seen.update((_frozen(pd.DataFrame({"event_id": pd.Series(list(seen), dtype=object), "at": np.array(list(seen.values()), np.int64)})),))
        self.handle.registerTimer(min(seen.values()) + self.retention)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark, seen = timerValues.getCurrentWatermarkInMs(), self._seen()
        for df in rows:
            at, ids = _times(df["observed_at"]), df["event_id"].tolist()
            late = (at <= watermark - self.retention) & (watermark > 0)  # 0: there is none yet
            first = np.zeros(len(df), bool)
            for k in np.flatnonzero(~late).tolist():
                if ids[k] not in seen:
                    seen[ids[k]] = int(at[k])
                    first[k] = True
            use = late | first
            yield pd.DataFrame({"record": df["record"][use], "outcome": np.where(late, "late", "admitted")[use]})
        self._keep(seen)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        self._keep({i: at for i, at in self._seen().items() if at + self.retention >= watermark})
        return iter(())

    def close(self) -> None:
        pass


class WindowGate(StatefulProcessor):
    """By window: rows are admitted until it is final, `hold` after its start, late from then on; then all leave as closed, once.

    Windows that end together close in the same batch in every lot: a timer is due when the watermark is past it, and so is
    a window. A lot holds its rows in the pieces in which they came, each with the first and the last of its starts, and
    has a timer for the first of all; only pieces in which a window is due are opened.
    """

    def __init__(self, hold: int):
        self.hold = hold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.held = handle, handle.getListState("held", "first long, last long, rows binary")

    def _piece(self, df: pd.DataFrame) -> tuple[int, int, bytes]:
        starts = _times(df["window_start"])
        return int(starts.min()), int(starts.max()), _frozen(df)

    def _remind(self, pieces: list) -> None:
        if pieces:
            self.handle.registerTimer(min(first for first, _, _ in pieces) + self.hold)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark, new = timerValues.getCurrentWatermarkInMs(), []
        for df in rows:
            late = (_times(df["window_start"]) + self.hold <= watermark) & (watermark > 0)
            yield pd.DataFrame({"record": df["record"], "outcome": np.where(late, "late", "admitted")})
            if not late.all():
                new.append(self._piece(df.loc[~late, ["window_start", "record"]]))
        for piece in new:
            self.held.appendValue(piece)
        self._remind(new)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due, left = timerValues.getCurrentWatermarkInMs() - self.hold, []
        for first, last, raw in [tuple(x) for x in self.held.get()]:
            if first >= due:
                left.append((first, last, bytes(raw)))
                continue
            df = _thawed(bytes(raw))
            done = _times(df["window_start"]) < due
            yield pd.DataFrame({"record": df["record"][done], "outcome": "closed"})
            if not done.all():
                left.append(self._piece(df[~done]))
        self.held.clear()
        for piece in left:
            self.held.appendValue(piece)
        self._remind(left)

    def close(self) -> None:
        pass


class _Versions:
    """Versions of an agency by their start, as state; of those that start together the greatest holds."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.state = handle.getListState("versions", "at long, version string")

    def read(self) -> None:
        self._sort(tuple(v) for v in self.state.get())

    def _sort(self, rows) -> None:
        self.rows = sorted(set(rows))
        self.starts, self.names = np.array([at for at, _ in self.rows], np.int64), np.array([None, *(v for _, v in self.rows)], object)

    def add(self, df: pd.DataFrame) -> None:
        new = set(zip(_times(df["at"]).tolist(), df["schedule_version"].tolist(), strict=True)) - set(self.rows)
        for v in new:
            self.state.appendValue(v)
        self._sort([*self.rows, *new])

    def chosen(self, at: np.ndarray) -> np.ndarray:
        """The version with the greatest start at or before each time, or None."""
        return self.names[np.searchsorted(self.starts, at, "right")]


class ScheduleChoice(StatefulProcessor):
    """By agency and lot: events get the version that holds; those without one, and the versions, go on to the agency's wait.

    Rows are of two kinds: `version` (schedule_version, at) and `event` (record, at). The lane of an event that has its
    version is its lot; that of the others is -1.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.versions = _Versions(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self.versions.read()
        lot, events = int(key[1]), []
        for df in rows:
            new = df["kind"] == "version"
            if new.any():
                self.versions.add(df[new])
                if lot == 0:
                    yield df.loc[new, ["agency_id", "kind", "at", "schedule_version", "record"]].assign(lane=np.int32(-1))
            events.append(df.loc[~new, ["agency_id", "kind", "at", "record"]])
        for df in events:
            version = self.versions.chosen(_times(df["at"]))
            yield df.assign(schedule_version=version, lane=np.where(pd.isna(version), -1, lot).astype(np.int32))[["agency_id", "kind", "at", "schedule_version", "record", "lane"]]

    def close(self) -> None:
        pass


class ScheduleWait(StatefulProcessor):
    """By agency: rows wait for a version in force, at most `wait_rows` of them and `wait_deadline` of processing time.

    An event leaves with the version of the greatest start at or before it, or with a reason. Lanes from 0 on hold events
    that have their version already, which pass.
    """

    def __init__(self, settings: Settings):
        self.s = settings

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.versions = handle, _Versions(handle)
        self.waiting = handle.getListState("waiting", "at long, record string, until long")

    def _out(self, agency, at, record, version, reason) -> pd.DataFrame:
        n = len(at)
        whole = lambda x: pd.Series([x] * n, dtype=object)
        return pd.DataFrame({"agency_id": whole(agency), "at": np.array(at, np.int64), "record": pd.Series(list(record), dtype=object), "schedule_version": pd.Series(list(version), dtype=object) if version is not None else whole(None), "unmatched_reason": whole(reason)})

    def _settle(self, key, now) -> Iterator[pd.DataFrame]:
        held = [tuple(w) for w in self.waiting.get()]
        if not held:
            return
        at, until = (np.array([w[k] for w in held], np.int64) for k in (0, 2))
        version = self.versions.chosen(at)
        hit = ~pd.isna(version)
        for rows, reason in ((hit, None), (~hit & (until <= now), "schedule_unavailable")):
            if rows.any():
                yield self._out(key[0], at[rows], [held[k][1] for k in np.flatnonzero(rows)], version[rows], reason)
        rest = [held[k] for k in np.flatnonzero(~hit & (until > now))]
        self.waiting.put(rest) if rest else self.waiting.clear()
        if rest:
            self.handle.registerTimer(now + self.s.wait_retry)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[1] >= 0:
            for df in rows:
                yield df[["agency_id", "at", "record", "schedule_version"]].assign(unmatched_reason=pd.Series(None, df.index, object))
            return
        now = timerValues.getCurrentProcessingTimeInMs()
        self.versions.read()
        room = max(0, self.s.wait_rows - len(list(self.waiting.get())))
        for df in rows:
            new = df["kind"] == "version"
            if new.any():
                self.versions.add(df[new])
            events = df[~new]
            take, full = events.iloc[:room], events.iloc[room:]
            room -= len(take)
            for at, record in zip(take["at"].tolist(), take["record"].tolist(), strict=True):
                self.waiting.appendValue((int(at), record, now + self.s.wait_deadline))
            if len(full):
                yield self._out(key[0], _times(full["at"]), full["record"], None, "schedule_buffer_full")
        yield from self._settle(key, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.versions.read()
        yield from self._settle(key, timerValues.getCurrentProcessingTimeInMs())

    def close(self) -> None:
        pass


def admit(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A stream of events with `outcome`: admitted once an id, or late. Duplicates within retention are left out."""
    stateful(events.sparkSession)
    rows = watermarked(events, settings.out_of_order)
    dealt = rows.select(_lot("event_id", settings).alias("lot"), "event_id", "observed_at", _record(rows).alias("record"))
    out = dealt.groupBy("lot").transformWithStateInPandas(Admission(settings.dedup_retention), JUDGED, "Append", "EventTime")
    return _opened(out, events.schema)


def gate(events: DataFrame, settings: Settings = Settings(), watermark: bool = True) -> DataFrame:
    """A stream of events with window_start and `outcome`: admitted (the ledger) or late, and again as closed when final."""
    stateful(events.sparkSession)
    rows = watermarked(events, settings.out_of_order) if watermark else events
    rows = rows.withColumn("direction_id", F.coalesce(F.col("direction_id").cast("int"), F.lit(-1))).withColumn("window_start", window_start("observed_at", settings.window))
    dealt = rows.select(_lot("event_id", settings).alias("lot"), "window_start", _record(rows).alias("record"))
    out = dealt.groupBy("lot").transformWithStateInPandas(WindowGate(settings.window + settings.lateness), JUDGED, "Append", "EventTime")
    return _opened(out, rows.schema)


def final_windows(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Events of closed windows without a Python operator: duplicates dropped, late rows dropped without an audit."""
    stateful(events.sparkSession)
    delay = settings.out_of_order + settings.lateness
    ts = F.timestamp_millis("observed_at")
    rows = events.withColumn("_ts", ts).withWatermark("_ts", f"{delay} milliseconds").dropDuplicatesWithinWatermark(["event_id"])
    w = F.window("_ts", f"{settings.window} milliseconds")
    closed = rows.groupBy(w, *ROUTE_KEY).agg(F.collect_list(F.struct(*events.columns)).alias("held"))
    return closed.select(F.explode("held").alias("e")).select("e.*")


WAITED = "agency_id string, at long, record string, schedule_version string, unmatched_reason string"


def wait_for_schedule(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows (agency_id, kind, at, schedule_version, record) of events and versions; events leave with version or reason.

    `kind` is version (schedule_version, at) or event (record, at). Versions go to each lot of their agency's events, so that
    an event whose version is known meets it there; the others wait together, by agency.
    """
    stateful(rows.sparkSession)
    lots = F.when(F.col("kind") == "version", F.sequence(F.lit(0), F.lit(settings.lots - 1))).otherwise(F.array(_lot("record", settings)))
    dealt = rows.select("agency_id", F.explode(lots).alias("lot"), "kind", "at", "schedule_version", "record")
    ddl = "agency_id string, kind string, at long, schedule_version string, record string, lane int"
    chosen = dealt.groupBy("agency_id", "lot").transformWithStateInPandas(ScheduleChoice(), ddl, "Append", "None")
    return chosen.groupBy("agency_id", "lane").transformWithStateInPandas(ScheduleWait(settings), WAITED, "Append", "ProcessingTime")
