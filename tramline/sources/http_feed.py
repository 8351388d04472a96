"""Conditional polling of feeds as a streaming source, with a durable outbox of what was fetched."""

from __future__ import annotations

import json
import os
import random
import time
import urllib.error
import urllib.request
from dataclasses import dataclass
from urllib.parse import urlsplit, urlunsplit

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from tramline.functions.identity import sha256_hex

SNAPSHOT = "snapshot_id string, agency_id string, feed_id string, fetched_at long, url string, status_code int, content_type string, etag string, last_modified string, body binary"


class FeedError(RuntimeError):
    """A response other than a complete feed; retry_after in seconds where the server named one."""

    def __init__(self, message: str, retry_after: float | None = None):
        super().__init__(message)
        self.retry_after = retry_after


@dataclass(frozen=True)
class Validators:
    etag: str | None = None
    last_modified: str | None = None


class _NoRedirect(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *a, **k):
        return None


def redact_url(url: str) -> str:
    """Without user information, query and fragment."""
    p = urlsplit(url)
    return urlunsplit((p.scheme, p.netloc.rpartition("@")[2], p.path, "", ""))


def fetch_feed(url: str, agency_id: str, feed_id: str, known: Validators = Validators(), *, most: int = 4 << 20, timeout: float = 15, clock=lambda: int(time.time() * 1000)):
    """(snapshot or None, validators). 304 gives no snapshot and keeps validators that it does not renew."""
    headers = {"Accept": "application/x-protobuf"}
    if known.etag:
        headers["If-None-Match"] = known.etag
    if known.last_modified:
        headers["If-Modified-Since"] = known.last_modified
    try:
        with urllib.request.build_opener(_NoRedirect).open(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
            body, status, got = r.read(most + 1), r.status, r.headers
    except urllib.error.HTTPError as e:
        if e.code == 304:
            return None, Validators(e.headers.get("ETag") or known.etag, e.headers.get("Last-Modified") or known.last_modified)
        after = e.headers.get("Retry-After") or ""
        raise FeedError(f"HTTP {e.code} from {redact_url(url)}", min(3600.0, float(after)) if after.isdigit() else None) from None
    if len(body) > most:
        raise FeedError("the feed is larger than allowed")
    if status != 200:
        raise FeedError(f"HTTP {status} is no complete feed")
    new = Validators(got.get("ETag"), got.get("Last-Modified"))
    row = (sha256_hex(feed_id.encode() + b"\0" + body), agency_id, feed_id, clock(), redact_url(url), status, got.get("Content-Type"), new.etag, new.last_modified, body)
    return row, new


def delay(interval: float, failures: int, retry_after: float | None = None, rng=random) -> float:
    """Seconds until the next poll: the interval, doubled with each failure up to five minutes, spread by a fifth."""
    wait = min(300.0, interval * 2 ** min(failures, 8)) * rng.uniform(0.8, 1.2)
    return max(wait, min(3600.0, retry_after or 0.0))


class FeedReader(SimpleDataSourceStreamReader):
    """Offsets are sequence numbers of the outbox; validators move on with the offset, so only once a batch is taken.

    A fetched body is on disk before its offset is given out. A batch that is read again comes from there.
    """

    def __init__(self, options: dict):
        self.o = options
        self.failures, self.next_at = 0, 0.0

    def _file(self, n: int) -> str:
        return os.path.join(self.o["outbox"], f"{n:020d}.json")

    def initialOffset(self) -> dict:
        return {"n": 0, "etag": None, "last_modified": None}

    def read(self, start: dict):
        os.makedirs(self.o["outbox"], exist_ok=True)
        n = int(start["n"])
        if os.path.exists(self._file(n)):  # fetched before, never taken
            return iter(self._rows(n)), self._next(n)
        if time.time() < self.next_at:
            return iter(()), start
        try:
            row, new = fetch_feed(self.o["url"], self.o["agency_id"], self.o["feed_id"], Validators(start["etag"], start["last_modified"]), most=int(self.o.get("max_bytes", 4 << 20)))
            self.failures = 0
        except (FeedError, OSError) as e:
            self.failures += 1
            self.next_at = time.time() + delay(float(self.o.get("interval", 30)), self.failures, getattr(e, "retry_after", None))
            return iter(()), start
        if row is None:
            return iter(()), {"n": n, "etag": new.etag, "last_modified": new.last_modified}
        record = {"row": [*row[:-1], row[-1].hex()], "etag": new.etag, "last_modified": new.last_modified}
        with open(self._file(n) + ".part", "w") as f:
            json.dump(record, f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(self._file(n) + ".part", self._file(n))
        return iter([row]), self._next(n)

    def _load(self, n: int) -> dict:
        with open(self._file(n)) as f:
            return json.load(f)

    def _rows(self, n: int) -> list[tuple]:
        row = self._load(n)["row"]
        return [(*row[:-1], bytes.fromhex(row[-1]))]

    def _next(self, n: int) -> dict:
        r = self._load(n)
        return {"n": n + 1, "etag": r["etag"], "last_modified": r["last_modified"]}

    def readBetweenOffsets(self, start: dict, end: dict):
        return iter([r for n in range(int(start["n"]), int(end["n"])) for r in self._rows(n)])

    def commit(self, end: dict) -> None:
        for n in range(max(0, int(end["n"]) - 100), int(end["n"]) - 1):
            if os.path.exists(self._file(n)):
                os.remove(self._file(n))


class FeedSource(DataSource):
    """format("transit_feed"): options url, agency_id, feed_id, outbox (a durable folder), interval, max_bytes."""

    @classmethod
    def name(cls) -> str:
        return "transit_feed"

    def schema(self) -> str:
        return SNAPSHOT

    def simpleStreamReader(self, schema):
        return FeedReader(dict(self.options))
