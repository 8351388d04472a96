"""Content identities. The bytes of canonical JSON depend on how Python writes doubles, so that one function is Python."""

from __future__ import annotations

import hashlib
import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(value) -> bytes:
    """Sorted keys, no spaces, UTF-8; NaN and infinities are errors."""
    return json.dumps(value, allow_nan=False, ensure_ascii=False, separators=(",", ":"), sort_keys=True).encode()


def sha256_hex(value: bytes) -> str:
    return hashlib.sha256(value).hexdigest()


def payload_hash(payload: Column) -> Column:
    """SHA-256 of the canonical JSON of a payload struct, in Arrow batches."""

    def hashed(batch: pa.Array) -> pa.Array:
        return pa.array([None if v is None else sha256_hex(canonical_json(v)) for v in batch.to_pylist()], pa.string())

    return F.arrow_udf(hashed, "string")(payload)


def event_id(agency: Column, feed: Column, kind: Column, entity: Column, observed_at: Column, payload_digest: Column) -> Column:
    """SHA-256 of the canonical JSON array of the six parts. Strings are written as JSON with non-ASCII left as it is."""

    def quoted(c: Column) -> Column:
        # to_json of a one-field struct escapes as JSON asks; the field's wrapping goes.
        return F.regexp_replace(F.to_json(F.struct(c.alias("v"))), r'^\{"v":(.*)\}$', "$1")

    parts = [quoted(agency), quoted(feed), quoted(kind), quoted(entity), observed_at.cast("string"), quoted(payload_digest)]
    return F.sha2(F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]")), 256)
