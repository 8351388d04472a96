"""Figures of a running engine as samples (name, labels, value), and as the text that a monitoring server reads."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.operators.ops import serving_gauges

#: Each figure with its kind and what it says.
FIGURES = {
    "input_rows_total": ("counter", "Rows that a query has read."),
    "late_rows_total": ("counter", "Rows that a query has dropped as late."),
    "rows_per_second": ("gauge", "Rows a second in the last batch of a query."),
    "last_batch": ("gauge", "The last batch of a query."),
    "lag": ("gauge", "Messages still to read."),
    "serving_rows": ("gauge", "Rows in the serving table."),
    "serving_predictions": ("gauge", "Predictions that the served windows rest on."),
}


def _samples(rows: DataFrame, labels: list[str], figures: list[str]) -> DataFrame:
    named = F.map_from_arrays(F.array(*[F.lit(x) for x in labels]), F.array(*[F.coalesce(F.col(x).cast("string"), F.lit("")) for x in labels])) if labels else F.from_json(F.lit("{}"), "map<string,string>")
    each = F.array(*[F.struct(F.lit(f).alias("name"), F.col(f).cast("double").alias("value")) for f in figures])
    return rows.select(named.alias("labels"), F.explode(each).alias("x")).select("x.name", "labels", "x.value").where("value IS NOT NULL")


def of_progress(progress: DataFrame) -> DataFrame:
    """Samples of each query from the rows of Progress; a batch that is reported twice counts once."""
    rows = progress.dropDuplicates(["query", "batch"]).groupBy("query")
    last = F.max_by("rows_per_second", "batch").alias("rows_per_second")
    return _samples(rows.agg(F.sum("input_rows").alias("input_rows_total"), F.sum("late_rows").alias("late_rows_total"), last, F.max("batch").alias("last_batch")), ["query"], ["input_rows_total", "late_rows_total", "rows_per_second", "last_batch"])


def of_lag(lags: DataFrame) -> DataFrame:
    """Samples from rows (group, topic, lag)."""
    return _samples(lags, ["group", "topic"], ["lag"])


def of_serving(metrics: DataFrame) -> DataFrame:
    return _samples(serving_gauges(metrics).toDF("serving_rows", "serving_predictions"), [], ["serving_rows", "serving_predictions"])


def boundaries(progress: dict) -> list[tuple]:
    """(group, topic, low, high, committed) for each partition of a query's logs, from its progress as a dictionary.

    Offsets are those of a log by topic and partition; sources with offsets of another kind have none. The query's name
    is its group, what it had read before the batch its low, and a partition that it has not read yet has no commit.
    """
    out = []
    for source in progress.get("sources", []):
        low, done, high = (_offsets(source.get(x)) for x in ("startOffset", "endOffset", "latestOffset"))
        for topic, partition in sorted(set(high) | set(done)):
            at = (topic, partition)
            out.append((progress.get("name"), topic, low.get(at, 0), high.get(at, done.get(at)), done.get(at)))
    return out


def _offsets(found: str | dict | None) -> dict[tuple[str, str], int]:
    try:
        found = json.loads(found) if isinstance(found, str) else found
    except ValueError:
        return {}
    topics = found.items() if isinstance(found, dict) else ()
    return {(t, p): int(n) for t, parts in topics if isinstance(parts, dict) for p, n in parts.items() if isinstance(n, int)}


def text(samples: DataFrame, prefix: str = "tramline_") -> str:
    """The samples in the text exposition format, by name and labels. There is one for each query, topic or table."""
    quoted = lambda s: s.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")
    by_name: dict[str, list[str]] = {}
    for r in samples.collect():
        labels = ",".join(f'{k}="{quoted(v)}"' for k, v in sorted(r["labels"].items()))
        by_name.setdefault(r["name"], []).append(f"{prefix}{r['name']}{{{labels}}} {r['value']!r}" if labels else f"{prefix}{r['name']} {r['value']!r}")
    lines = []
    for name in sorted(by_name):
        kind, says = FIGURES[name]
        lines += [f"# HELP {prefix}{name} {says}", f"# TYPE {prefix}{name} {kind}", *sorted(by_name[name])]
    return "".join(f"{line}\n" for line in lines)


def endpoint(figures: Callable[[], str], port: int = 0, host: str = "127.0.0.1") -> ThreadingHTTPServer:
    """A server that answers /metrics with what `figures` returns, until its shutdown(); port 0 takes any that is free."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            found = self.path == "/metrics"
            body = figures().encode() if found else b""
            self.send_response(200 if found else 404)
            self.send_header("Content-Type", "text/plain; version=0.0.4; charset=utf-8")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args) -> None:
            pass

    server = ThreadingHTTPServer((host, port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
