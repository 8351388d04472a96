"""Substring deduplication by relative Lempel-Ziv parsing against reference blocks that are found by sampled anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.shared import Words, joined, keyed, order_id, slices, staged, utf8

BLOCKS = "id long, th long, start int, runs int, anchor long, body long"
OPENED = "anchor long, id long, th long, start int, runs int, words binary, body long"
FACTORS = "id long, th long, start int, runs int"


def sampled_blocks(texts: pa.Array, window: int, anchor: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words, and for each block: its text, first window (word offset in the text), windows, anchor and body hash.

    A window's anchor is the run of `anchor` words in it with the smallest hash, the first of equals: equal windows
    have equal anchors wherever they stand. Neighbouring windows with one anchor form a block; every window of a
    text is in exactly one. Equal blocks (anchor, place of the anchor, all words) hold equal windows.
    """
    words = Words(texts)
    first, n = words.first, len(words.hash)
    width = window - anchor + 1
    size = np.diff(first)
    none = np.zeros(0, np.int64)
    if n < window or not (size >= window).any():
        return words, none, none, none, none.view(np.uint64), none.view(np.uint64)
    grams = words.runs(anchor)
    # Position of the first smallest of `width` runs from each place, by doubling.
    best, reach = np.arange(n - anchor + 1), 1
    while reach < width:
        step = min(reach, width - reach)
        a, b = best[:-step], best[step:]
        best = np.where(grams[b] < grams[a], b, a)
        reach += step
    starts = np.arange(n - window + 1)
    owner = np.searchsorted(first, starts, "right") - 1
    inside = starts + window <= first[owner + 1]
    starts, owner = starts[inside], owner[inside]
    chosen = best[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    runs = np.diff(np.append(head, len(starts)))
    start, owner, chosen = starts[head], owner[head], chosen[head]
    whole = words.runs(window)  # the first and the last window of a block overlap and so tell all its words
    body = joined(joined(whole[start], whole[start + runs - 1]), ((chosen - start) * window + runs).astype(np.uint64))
    return words, owner, start - first[owner], runs, grams[chosen], body


def covered_words(n: int, starts: np.ndarray, runs: np.ndarray, window: int) -> np.ndarray:
    """Words of a text that windows cover, given runs of windows by their first."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + runs + window - 1, n), -1)
    return np.cumsum(edge[:-1]) > 0


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3).compress
    for b in slices(batches):
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), b.column("doc_id"), pa.array([press(t.encode()) for t in b.column("text").to_pylist()], pa.binary()), pa.array(np.diff(utf8(b.column("text"))[1]))], ["id", "th", "doc_id", "packed", "bytes"])


def _texts(column: pa.Array) -> pa.Array:
    unpress = zstandard.ZstdDecompressor().decompress
    return pa.array([unpress(x) for x in column.to_pylist()], pa.binary()).cast(pa.large_string(), safe=False)


def _small(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut by the bytes that their texts unpack to; a longer text stands alone."""
    for b in batches:
        ends = np.cumsum(b.column("bytes").to_numpy())
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            yield b.slice(at, to - at)
            at = to


class Reference:
    """Reference blocks of one anchor: each window's words, and the block and place where they stand first."""

    def __init__(self, window: int):
        self.window, self.index = window, {}

    @staticmethod
    def places(text: bytes) -> list[int]:
        """Where each word begins; words stand with one space between, and one is taken to follow the last."""
        out, at = [0], text.find(b" ")
        while at >= 0:
            out.append(at + 1)
            at = text.find(b" ", at + 1)
        return [*out, len(text) + 1]

    def add(self, text: bytes) -> None:
        at, n = self.places(text), self.window
        for k in range(len(at) - n):
            self.index.setdefault(text[at[k] : at[k + n] - 1], (text, at, k))

    def factors(self, text: bytes) -> list[tuple[int, int]]:
        """Greedy parse: (first word, words) of factors that are as long as a window at least.

        From each word on, the window there is looked up by its words; where a block has it, the factor goes on as long as
        the words agree. Then the parse goes on at the first window that the factor does not hold whole, so that windows
        across the factor's end are looked up as well; where nothing is found, at the next word.
        """
        at, n, k, out = self.places(text), self.window, 0, []
        while k < len(at) - n:
            hit = self.index.get(text[at[k] : at[k + n] - 1])
            if not hit:
                k += 1
                continue
            ref, ref_at, place = hit
            size = n
            while k + size < len(at) - 1 and place + size < len(ref_at) - 1 and text[at[k + size] : at[k + size + 1] - 1] == ref[ref_at[place + size] : ref_at[place + size + 1] - 1]:
                size += 1
            out.append((k, size))
            k += size - n + 1
        return out


def _parsed(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Factors of blocks sorted by anchor and document, each against the blocks of its anchor in smaller documents."""
    anchor = doc = reference = None
    same: list[bytes] = []  # blocks of the document at hand, which is no reference of its own
    for b in batches:
        cols: list[list[int]] = [[], [], [], []]
        for a, i, th, start, text in zip(*(b.column(c).to_pylist() for c in ("anchor", "id", "th", "start", "words")), strict=True):
            if a != anchor:
                anchor, doc, reference, same = a, i, Reference(window), []
            elif i != doc:
                for t in same:
                    reference.add(t)
                doc, same = i, []
            for k, size in reference.factors(text):
                for col, v in zip(cols, (i, th, start + k, size - window + 1), strict=True):
                    col.append(v)
            same.append(text)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["id", "th", "start", "runs"])


def without_repeats(docs: DataFrame, window: int = 50, anchor: int = 10, most_blocks: int = 4_000) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, kept (the words that stay, joined by one space).

    A word goes if a window of `window` words over it also starts in a document with a smaller doc_id. Null text has
    no words. Rows that share a doc_id are judged alike, and none is smaller than the other; a null doc_id
    is larger than all (2**63 - 1 ranks with it). Other columns are ignored. No rows give no rows.

    1. Each text is cut into blocks of windows that share an anchor. Equal windows have equal anchors wherever they stand, so
       that all reference blocks in which a factor of a block can stand are those of its anchor.
    2. Blocks are summed up by anchor and words to the smallest document that has them, first in each input split: that is the
       reference block. In all larger documents the block is a factor as a whole.
    3. The reference blocks of an anchor that differ are sent, with their words, to the owner task of the anchor. There each is
       parsed greedily, in the order of documents, against all those before it: the longest runs of words that a
       reference has as well become factors, and the windows across a factor's end are looked up in turn. An anchor of more
       than `most_blocks` blocks has no owner: its windows are dealt by the hash of their words and summed up to the smallest
       document, first in each split, which finds the same factors window by window, at any number of blocks.
    4. The words covered by factors of `window` words or more go. Nothing pairs the occurrences of a passage with one another.

    Words are compared as they are in step 3; equal blocks and dealt windows are known by 128 bits of hash (anchor, words).
    """
    width = window

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, most=1 << 20):
            _, owner, start, runs, anchors, body = sampled_blocks(b.column("text"), width, anchor)
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(at), b.column("th").take(at), pa.array(start.astype(np.int32)), pa.array(runs.astype(np.int32)), pa.array(anchors.view(np.int64)), pa.array(body.view(np.int64))],
                ["id", "th", "start", "runs", "anchor", "body"],
            )

    texts = keyed(docs).withColumn("id", order_id())
    blocks = staged(texts.select("id", "th", "text").mapInArrow(cut, BLOCKS))
    # Sides that are aggregated by the key of a join are written first: then Spark splits a key with very many rows.
    shared = staged(blocks.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("anchor"))
    blocks = staged(blocks.join(shared, "anchor"))
    least = staged(blocks.groupBy("anchor", "body").agg(F.min("id").alias("least"), F.max("id").alias("most")))
    whole = blocks.join(staged(least.where("least < most").select("anchor", "body", "least")), ["anchor", "body"]).where("least < id").select("id", "th", "start", "runs")

    mixed = least.groupBy("anchor").agg(F.count("*").alias("c"), F.min("least").alias("lo"), F.max("least").alias("hi")).where("c > 1 AND lo < hi")
    mixed = staged(mixed.select("anchor", (F.col("c") > most_blocks).alias("dealt")))
    edges = staged(least.join(mixed, "anchor").select("anchor", "body", F.col("least").alias("id"), "dealt"))
    edges = blocks.join(edges, ["anchor", "body", "id"]).groupBy("id", "th").agg(F.collect_set(F.struct("start", "runs", "anchor", "dealt")).alias("at"))
    packed = texts.select("id", "th", "doc_id", "text").mapInArrow(_packed, "id long, th long, doc_id long, packed binary, bytes long")

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "id", "th", "start", "runs", "words", "body"]
        for b in _small(batches):
            words, at = Words(_texts(b.column("packed"))), b.column("at")
            row, inner = np.repeat(np.arange(len(at)), np.diff(at.offsets.to_numpy())), at.flatten()
            start, runs, anchors, dealt = (inner.field(k).to_numpy(zero_copy_only=False) for k in ("start", "runs", "anchor", "dealt"))
            start = start.astype(np.int64)

            own = np.flatnonzero(~dealt.astype(bool))
            data, place = words.data.tobytes(), words.first[row[own]] + start[own]
            lists = [data[words.start[p] : words.end[p + n + width - 2]] for p, n in zip(place.tolist(), runs[own].tolist(), strict=True)]
            for k in range(0, len(own), 4_000):
                s = own[k : k + 4_000]
                to = pa.array(row[s])
                block = [b" ".join(x.split()) for x in lists[k : k + 4_000]]
                yield pa.RecordBatch.from_arrays([pa.array(anchors[s]), b.column("id").take(to), b.column("th").take(to), pa.array(start[s].astype(np.int32)), pa.array(runs[s]), pa.array(block, pa.binary()), pa.nulls(len(s), pa.int64())], names)

            own = np.flatnonzero(dealt.astype(bool))
            if len(own):
                n = runs[own]
                single, of = words.runs(width), np.repeat(own, n)
                first = start[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                for k in range(0, len(of), 100_000):
                    s, f = of[k : k + 100_000], first[k : k + 100_000]
                    to, body = pa.array(row[s]), single[words.first[row[s]] + f]
                    yield pa.RecordBatch.from_arrays([pa.array(anchors[s]), b.column("id").take(to), b.column("th").take(to), pa.array(f.astype(np.int32)), pa.array(np.ones(len(s), np.int32)), pa.nulls(len(s), pa.binary()), pa.array(body.view(np.int64))], names)

    open_ = staged(packed.dropDuplicates(["id", "th"]).join(edges, ["id", "th"]).select("id", "th", "packed", "bytes", "at").mapInArrow(opened, OPENED))
    owned = open_.where("words IS NOT NULL").select("anchor", "id", "th", "start", "words").repartition("anchor").sortWithinPartitions("anchor", "id")
    factors = owned.mapInArrow(lambda batches: _parsed(batches, width), FACTORS)
    dealt = open_.where("words IS NULL").select("anchor", "body", "id", "th", "start", "runs")
    first = staged(dealt.groupBy("anchor", "body").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("anchor", "body", "least"))
    single = dealt.join(first, ["anchor", "body"]).where("least < id").select("id", "th", "start", "runs")

    spans = whole.unionByName(factors).unionByName(single).groupBy("id", "th").agg(F.collect_set(F.struct("start", "runs")).alias("spans"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _small(batches):
            cols: list[list] = [[], [], []]
            for text, spans in zip(_texts(b.column("packed")), b.column("spans"), strict=True):
                words = text.as_py().encode().split()
                if spans.is_valid and len(spans):
                    s = spans.values
                    gone = covered_words(len(words), s.field("start").to_numpy().astype(np.int64), s.field("runs").to_numpy().astype(np.int64), width)
                    stay = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                else:
                    stay = words
                for col, v in zip(cols, (len(words), len(words) - len(stay), b" ".join(stay).decode()), strict=True):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return packed.join(spans, ["id", "th"], "left").select("doc_id", "packed", "bytes", "spans").mapInArrow(kept, "doc_id long, n_words long, n_removed long, kept string")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
win AS (SELECT doc_id, i, sha256(array_to_string(words[i : i + 49], ' ')) AS k FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d)),
least AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + j AS pos FROM (SELECT w.doc_id, w.i FROM win w JOIN least l ON w.k = l.k WHERE l.m < w.doc_id), range(50) r(j)),
all_words AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d),
kept AS (SELECT a.doc_id, string_agg(word, ' ' ORDER BY a.pos) AS text, count(*) AS n FROM all_words a LEFT JOIN gone g ON a.doc_id = g.doc_id AND a.pos = g.pos WHERE g.pos IS NULL GROUP BY a.doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""
