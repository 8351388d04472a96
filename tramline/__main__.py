"""python -m tramline --lake FOLDER VERB ...: load-schedule, pin, pin-coverage, replay, coverage, migrate-inputs, query, serve, quality, poll."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from tramline import commands
from tramline.sources import poll
from tramline.sources.lake import Lake


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tramline")
    p.add_argument("--lake", required=True)
    verbs = p.add_subparsers(dest="verb", required=True)
    v = verbs.add_parser("load-schedule")
    v.add_argument("archive")
    v.add_argument("--agency", required=True)
    v.add_argument("--effective-from", required=True)
    v = verbs.add_parser("pin")
    v.add_argument("manifest")
    v.add_argument("--generation", default="live-v2")
    v = verbs.add_parser("pin-coverage")
    v.add_argument("manifest")
    v = verbs.add_parser("poll")
    v.add_argument("config")
    v.add_argument("--outbox", required=True)
    v.add_argument("--checkpoint", required=True)
    v.add_argument("--once", action="store_true")
    v = verbs.add_parser("replay")
    v.add_argument("manifest")
    v.add_argument("generation")
    v = verbs.add_parser("coverage")
    v.add_argument("manifest")
    v.add_argument("--agency", required=True)
    v.add_argument("--service-date", required=True)
    v.add_argument("--as-of", required=True)
    v.add_argument("--schedule-version", required=True)
    v.add_argument("--report")
    v.add_argument("--grace-seconds", type=int, default=300)
    v = verbs.add_parser("migrate-inputs")
    v.add_argument("manifest")
    v.add_argument("--apply", action="store_true")
    v = verbs.add_parser("query")
    v.add_argument("--generation", default="live-v2")
    v = verbs.add_parser("serve")
    v.add_argument("metrics")
    v.add_argument("--serving", required=True)
    v.add_argument("--checkpoint", required=True)
    v.add_argument("--once", action="store_true")
    verbs.add_parser("quality")
    a = p.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    lake = Lake(spark, a.lake)
    manifest = None
    if a.verb in ("replay", "coverage", "migrate-inputs"):
        with open(a.manifest) as f:
            manifest = json.load(f)
    if a.verb == "load-schedule":
        print(commands.load_schedule(lake, commands.fetch_archive(a.archive), a.agency, a.effective_from))
    elif a.verb == "pin-coverage":
        print(json.dumps(commands.pin_coverage(lake, a.manifest)))
    elif a.verb == "poll":
        for q in poll.start(spark, poll.feeds(a.config), lake.root, a.outbox, a.checkpoint, once=a.once):
            q.awaitTermination()
    elif a.verb == "pin":
        print(json.dumps(commands.pin(lake, a.generation, path=a.manifest)))
    elif a.verb == "replay":
        print(commands.replay_pinned(lake, manifest, a.generation).count())
    elif a.verb == "coverage":
        r = commands.coverage_report(lake, manifest, a.agency, a.service_date, a.as_of, a.schedule_version, a.grace_seconds)
        if a.report:
            commands.write_report(r, a.report)
        r.routes.show(truncate=False)
        print(json.dumps(r.header))
    elif a.verb == "migrate-inputs":
        print(commands.migrate(lake, manifest, a.apply))
    elif a.verb == "serve":
        commands.serve(spark, a.metrics, a.serving, a.checkpoint, a.once).awaitTermination()
    elif a.verb == "query":
        commands.query(lake, a.generation).show(truncate=False)
    else:
        broken = commands.check(lake)
        print(json.dumps(broken))
        return int(any(broken.values()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
