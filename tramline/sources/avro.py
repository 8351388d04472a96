"""Records in Avro object containers, one a message, as DataFrames see them."""

from __future__ import annotations

import io
import json
import os
import struct
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MAGIC = b"Obj\x01"


class _Reader:
    def __init__(self, data: bytes):
        self.f = io.BytesIO(data)

    def take(self, n: int) -> bytes:
        out = self.f.read(n) if n >= 0 else b""
        if n < 0 or len(out) < n:
            raise ValueError("the container ends too early")
        return out

    def long(self) -> int:
        n = shift = 0
        while True:
            b = self.take(1)[0]
            n |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return (n >> 1) ^ -(n & 1)
            if shift > 63:
                raise ValueError("a number is too long")

    def bytes(self) -> bytes:
        return self.take(self.long())

    def value(self, schema, names: dict):
        if isinstance(schema, list):
            at = self.long()
            if not 0 <= at < len(schema):
                raise ValueError("no such branch")
            return self.value(schema[at], names)
        kind = schema["type"] if isinstance(schema, dict) else schema
        if isinstance(kind, (dict, list)):
            return self.value(kind, names)
        if kind in names:
            return self.value(names[kind], names)
        if kind == "record":
            names[schema["name"]] = schema
            return {f["name"]: self.value(f["type"], names) for f in schema["fields"]}
        if kind == "enum":
            return schema["symbols"][self.long()]
        if kind in ("array", "map"):
            out = {} if kind == "map" else []
            while n := self.long():
                if n < 0:
                    n = -n
                    self.long()
                for _ in range(n):
                    if kind == "map":
                        key = self.bytes().decode()
                        out[key] = self.value(schema["values"], names)
                    else:
                        out.append(self.value(schema["items"], names))
            return out
        if kind == "fixed":
            return self.take(schema["size"]).hex()
        return {"null": lambda: None, "boolean": lambda: self.take(1) != b"\0", "int": self.long, "long": self.long, "float": lambda: struct.unpack("<f", self.take(4))[0], "double": lambda: struct.unpack("<d", self.take(8))[0], "string": lambda: self.bytes().decode(), "bytes": lambda: self.bytes().hex()}[kind]()


def _long(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _written(value, schema, names: dict) -> bytes:
    if isinstance(schema, list):
        at = next(k for k, s in enumerate(schema) if (s == "null") == (value is None))
        return _long(at) + _written(value, schema[at], names)
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, (dict, list)):
        return _written(value, kind, names)
    if kind in names:
        return _written(value, names[kind], names)
    if kind == "record":
        names[schema["name"]] = schema
        return b"".join(_written(value.get(f["name"], f.get("default")), f["type"], names) for f in schema["fields"])
    if kind == "enum":
        return _long(schema["symbols"].index(value))
    if kind == "array":
        return (_long(len(value)) + b"".join(_written(v, schema["items"], names) for v in value) if value else b"") + b"\0"
    if kind == "map":
        return (_long(len(value)) + b"".join(_written(k, "string", names) + _written(v, schema["values"], names) for k, v in value.items()) if value else b"") + b"\0"
    if kind == "fixed":
        return bytes.fromhex(value)
    if kind == "bytes":
        value = bytes.fromhex(value)
    elif kind == "string":
        value = value.encode()
    if kind in ("bytes", "string"):
        return _long(len(value)) + value
    return {"null": lambda: b"", "boolean": lambda: bytes([bool(value)]), "int": lambda: _long(value), "long": lambda: _long(value), "float": lambda: struct.pack("<f", value), "double": lambda: struct.pack("<d", value)}[kind]()


def encode(record: dict, schema: dict, sync: bytes | None = None) -> bytes:
    """An object container that holds one record; bytes and fixed values are given in hexadecimal."""
    sync = sync or os.urandom(16)
    body = _written(record, schema, {})
    meta = {"avro.schema": json.dumps(schema).encode(), "avro.codec": b"null"}
    head = _long(len(meta)) + b"".join(_long(len(k)) + k.encode() + _long(len(v)) + v for k, v in meta.items()) + b"\0"
    return MAGIC + head + sync + _long(1) + _long(len(body)) + body + sync


def decode(data: bytes) -> dict:
    """The one record of an object container, by the schema it carries. None, several or trailing bytes are errors."""
    r = _Reader(data)
    if r.take(4) != MAGIC:
        raise ValueError("no object container")
    meta = {}
    while n := r.long():
        if n < 0:
            n = -n
            r.long()
        for _ in range(n):
            key = r.bytes().decode()
            meta[key] = r.bytes()
    codec, schema, sync = meta.get("avro.codec", b"null"), json.loads(meta["avro.schema"]), r.take(16)
    if codec not in (b"null", b"deflate"):
        raise ValueError("the codec is not known")
    found = []
    while r.f.tell() < len(data):
        n, body = r.long(), r.bytes()
        if r.take(16) != sync:
            raise ValueError("the block does not end as it should")
        block = _Reader(zlib.decompress(body, -15) if codec == b"deflate" else body)
        found += [block.value(schema, {}) for _ in range(n)]
        if block.f.read(1):
            raise ValueError("the block holds more than its records")
    if len(found) != 1:
        raise ValueError(f"a message holds one record, not {len(found)}")
    return found[0]


def from_container(message: str | Column, ddl: str) -> Column:
    """The record of each binary message as a struct of the given DDL. Null stays null; a message that is no container of one
    record is an error. Bytes are decoded in Arrow batches; columns and types are Spark's own after that."""

    @F.pandas_udf("string")
    def as_json(messages: pd.Series) -> pd.Series:
        return messages.map(lambda m: None if m is None else json.dumps(decode(bytes(m))))

    return F.from_json(as_json(message), ddl)


def to_container(record: str | Column, schema: dict) -> Column:
    """Each struct as an object container of its own, in the given Avro schema."""

    @F.pandas_udf("binary")
    def as_bytes(records: pd.Series) -> pd.Series:
        return records.map(lambda r: None if r is None else encode(json.loads(r), schema))

    return as_bytes(F.to_json(record, {"ignoreNullFields": "false"}))
