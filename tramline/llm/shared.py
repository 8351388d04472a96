"""Shared folders, row keys and vectorised word hashing for the operators of this subpackage."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as a regular expression and as bytes.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_LAST_ID = 2**63 - 1


#: Folders that staged() has made and nothing has removed yet.
_FOLDERS: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share, spark.checkpoint.dir.

    Where that is unset, a session of one process uses /tmp/checkpoints; on a cluster its executors would not see one
    another's files there, so that it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file:///tmp/checkpoints"
    return f"{root.rstrip('/')}/tramline-{uuid.uuid4().hex}"


def staged(df: DataFrame, by: str | None = None) -> DataFrame:
    """The same rows, written to the shared folder and read again: lineage ends here, lost executors cost nothing.

    by: a column of few values, each of which gets a folder of its own, so that a filter on it reads no other.
    """
    path = shared_folder(df.sparkSession)
    _FOLDERS.append(path)
    out = df.write.option("compression", "zstd")
    (out.partitionBy(by) if by else out).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def folders_made() -> int:
    """How many folders staged() has made that are still there; release() goes back to it."""
    return len(_FOLDERS)


def release(spark: SparkSession, since: int, *keep: DataFrame) -> None:
    """Removes the folders that staged() has made since, but for those that `keep` reads. For when a result is written."""
    name = lambda path: path.rpartition("/tramline-")[2].partition("/")[0]
    held = {name(f) for df in keep for f in df.inputFiles()}
    for path in [p for p in _FOLDERS[since:] if name(p) not in held]:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        _FOLDERS.remove(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, th (hash of the text; tells apart rows that share a doc_id) and text, null text as empty.

    Sets spark.sql.execution.arrow.maxBytesPerBatch of the session to 8 MB, for its later queries too: batches of
    10,000 rows, whatever their size, would add up long texts in a worker.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"), *more)


def without(docs: DataFrame, drop: DataFrame) -> DataFrame:
    """Rows of `docs`, all columns kept, whose doc_id and text hash are not among `drop` (id, key)."""
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("key"))
    left = rows.join(drop, rows["id"].eqNullSafe(drop["id"]) & (rows["key"] == drop["key"]), "left_anti")
    return left.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def order_id(c: str | Column = "doc_id") -> Column:
    """A null doc_id sorts after every other."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(_LAST_ID))


# ---- vectorised words ----------------------------------------------------------------------------

_U = np.uint64
_STEP, _TURN = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
#: Words of more bytes are hashed one by one.
_LONG = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; bijective."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of what a stands for followed by what b does. Mixed at each step, so no sum of powers can cancel out."""
    return mix((a ^ (a << _U(23))) * _STEP + mix(b + _TURN))


def lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on (little-endian), zeros beyond the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))


def _lowest(n: np.ndarray) -> np.ndarray:
    """Masks of the lowest n bytes of eight."""
    return np.where(n >= 8, ~_U(0), (_U(1) << (_U(8) * np.minimum(n, 7).astype(np.uint64))) - _U(1))


def _hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, mixed after every eight bytes."""
    size, eight = end - start, lanes(data)
    out = mix(size.astype(np.uint64) * _STEP + _TURN)
    for k in range(0, min(int(size.max(initial=0)), _LONG), 8):
        on = np.flatnonzero((size > k) & (size <= _LONG)) if k else np.flatnonzero(size <= _LONG)
        left = size[on] - k
        out[on] = mix((out[on] ^ (eight[start[on] + k] & _lowest(left))) * _STEP + _U(k + 1))
    for i in np.flatnonzero(size > _LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]].tobytes())
    return out


class Words:
    """Words of a batch of texts: byte range, 64-bit hash, and for each text the range of its words."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        """lower: A-Z count as a-z."""
        data, offs = utf8(texts)
        if lower:
            data = data + (((data >= 65) & (data <= 90)).view(np.uint8) << 5)
        n = len(data)
        self.data, self.offs = data, offs
        solid = ~_IS_SPACE[data]
        joins = np.zeros(n + 1, bool)  # byte i continues the word of byte i - 1
        if n:
            joins[1:n] = solid[1:] & solid[:-1]
            joins[offs[offs < n]] = False
        self.start = np.flatnonzero(solid & ~joins[:n])
        self.end = np.flatnonzero(solid & ~joins[1:]) + 1
        self.first = np.searchsorted(self.start, offs)
        self.hash = _hashed(data, self.start, self.end)

    def at(self, places: np.ndarray, n: int) -> np.ndarray:
        """Hash of the n words from each place, equal wherever the same words stand."""
        out = self.hash[places]
        for k in range(1, n):
            out = joined(out, self.hash[places + k])
        return out

    def runs(self, n: int) -> np.ndarray:
        """Hash of the n words from every place that has so many, by doubling."""
        total = max(0, len(self.hash) - n + 1)
        out, power, size, done = None, self.hash, 1, 0
        while True:
            if n & size:
                out = power[:total] if out is None else joined(out, power[done : done + total])
                done += size
            if done == n:
                return out
            power, size = joined(power[:-size], power[size:]), 2 * size


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after the other, and where each begins; null counts as empty."""
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        texts, kind = texts.cast(pa.string()), np.int32
    if texts.null_count:
        texts = texts.fill_null("")
    _, offs, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offs, kind, len(texts) + 1 + texts.offset)[texts.offset :].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each has about `most` bytes of text; a longer text stands alone. No text is cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offs = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offs, offs[at] + most, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to
