"""Packing documents into token windows by best-fit decreasing."""

from __future__ import annotations

import json
import os
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.shared import keyed, staged


class Encoder:
    """Ids of texts by a tokenizer that cuts at white space: each distinct word is encoded once and kept.

    Words are cut at ASCII white space and looked up by their bytes; the tokenizer deals with whatever else is inside
    one. The table is emptied when its words and ids come to `most` bytes, which bounds memory and changes no result.
    """

    def __init__(self, path: str, most: int = 64 << 20):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        with open(path, encoding="utf-8") as f:
            self.model = self.tokenizer.model if _plain(json.load(f)) else None
        self.clear()

    def clear(self) -> None:
        self.table, self.held = {}, 0

    def __call__(self, text: str) -> bytes:
        """Ids of a text, little-endian unsigned 32-bit."""
        data = text.encode()
        return b"".join(self.part(data[lo:hi]) for lo, hi in _stretches(data))

    def part(self, data: bytes) -> bytes:
        words = data.split()
        if new := list(set(words).difference(self.table)):
            if self.held > self.most:
                self.clear()
                new = list(set(words))
            for w, ids in zip(new, self.encode([w.decode() for w in new]), strict=True):
                self.table[w] = ids = np.array(ids, "<u4").tobytes()
                self.held += len(w) + len(ids) + 160  # with what Python adds to each
        return b"".join(map(self.table.__getitem__, words))

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of words. Plain ones (Latin letters, then signs) go to the model as the tokenizer would hand them over."""
        if self.model is None:
            return [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        out, rest, known, tokenize = [], [], {}, self.model.tokenize

        def part(p: str) -> list[int]:
            if p not in known:
                known[p] = [t.id for t in tokenize(p if p.isascii() else "".join(map(_ALPHABET.__getitem__, p.encode())))]
            return known[p]

        for k, w in enumerate(words):
            if m := _PLAIN.fullmatch(w):
                out.append(part(m[1].lower()) + part(m[2]) if m[2] else part(m[1].lower()))
            else:
                out.append([])
                rest.append(k)
        for k, e in zip(rest, self.tokenizer.encode_batch([words[k] for k in rest], add_special_tokens=False), strict=True):
            out[k] = e.ids
        return out


def _stretches(data: bytes, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of about `most` bytes that end at white space, so that a long text is never held as a list of all its words."""
    at = 0
    while len(data) - at > most:
        end = _GAP.search(data, at + most)
        if not end:
            break
        yield at, end.start()
        at = end.start()
    yield at, len(data)


_GAP = re.compile(rb"[\x20\x09-\x0D]")

#: A run of Latin letters without marks of their own, then ASCII signs that begin no contraction or special token.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\[-`{-~]*)")


def _alphabet() -> dict[int, str]:
    """The printable character that byte-level models write for each byte: itself, or the next one from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return {b: chr(b if b in own else next(spare)) for b in range(256)}


_ALPHABET = _alphabet()


def _plain(config: dict) -> bool:
    """Whether a tokenizer lowers letters and cuts words into runs of letters, digits and signs on byte level."""
    parts = (config.get("normalizer") or {}).get("normalizers", []), (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    steps = [[x["type"] for x in p] for p in parts]
    runs = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    return steps == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]] and parts[1][0]["pattern"] == {"Regex": runs} and not config.get("post_processor")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Capacities:
    """A segment tree over remaining capacity: how many open windows have each, and the tightest that still fits."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)

    def add(self, remaining: int, n: int) -> None:
        i = remaining + self.size
        while i:
            self.tree[i] += n
            i >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least `least` that an open window has."""
        i = least + self.size
        if self.tree[i]:
            return least
        while i > 1:
            if not i & 1 and self.tree[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.tree[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces go, given how many there are of each length: (length, rank from, rank to, window, offset).

    The pieces of a length are interchangeable, as are windows with the same remaining capacity, so each step
    places many: the result is that of placing the pieces one by one, longest first, each into the tightest
    open window that holds it. Steps depend on capacity, not on the number of pieces. A range of ranks goes
    to consecutive windows from the given one, all at the same offset.
    """
    tree, open_, out, windows = Capacities(capacity), defaultdict(list), [], 0
    for length in sorted(counts, reverse=True):
        n, rank = counts[length], 0
        while rank < n:
            left, room = n - rank, tree.tightest(length)
            if room is None:
                room = capacity
                first, there = windows, -(-left // (capacity // length))
                windows += there
            else:
                first, there = open_[room].pop()
                tree.add(room, -there)
            each = room // length  # a window stays the tightest until it can't hold another
            full = min(there, left // each)
            rest = min(left - full * each, each - 1) if full < there else 0
            for k in range(each if full else 0):
                out.append((length, rank, rank + full, first, capacity - room + k * length))
                rank += full
            for k in range(rest):
                out.append((length, rank, rank + 1, first + full, capacity - room + k * length))
                rank += 1
            _reopen(tree, open_, room - each * length, first, full)
            if rest:
                _reopen(tree, open_, room - rest * length, first + full, 1)
            _reopen(tree, open_, room, first + full + bool(rest), there - full - bool(rest))
    return out


def _reopen(tree: Capacities, open_: dict, room: int, first: int, n: int) -> None:
    if room and n:
        open_[room].append((first, n))
        tree.add(room, n)


def laid_out(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window and offset of each piece by best-fit decreasing, and how much of each window is filled."""
    kinds, counts = np.unique(lengths, return_counts=True)
    order = np.argsort(lengths, kind="stable")
    begin = dict(zip(kinds.tolist(), (np.cumsum(counts) - counts).tolist(), strict=True))
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for length, lo, hi, first, at in best_fit_decreasing(dict(zip(kinds.tolist(), counts.tolist(), strict=True)), capacity):
        of = order[begin[length] + lo : begin[length] + hi]
        window[of], offset[of] = first + np.arange(hi - lo), at
    return window, offset, np.bincount(window, lengths).astype(np.int64)


class _Block:
    """Pieces that are packed together, and their windows as batches."""

    NAMES = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())

    def __init__(self, capacity: int, level: int):
        self.capacity, self.windows = capacity, (level << 62) | (TaskContext.get().partitionId() << 36)
        self.clear()

    def clear(self) -> None:
        self.rows, self.size = ([], [], [], [], []), 0

    def add(self, *piece) -> None:
        for col, v in zip(self.rows, piece, strict=True):
            col.append(v)
        self.size += len(piece[3])

    def flush(self, full: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        """Batches of about 1 MB of ids, and which of their pieces are in windows of fewer than `full` tokens."""
        if not self.rows[0]:
            return
        window, offset, filled = laid_out(np.array(self.rows[2], np.int64), self.capacity)
        short = filled[window] < full
        cut = np.searchsorted(np.cumsum([len(x) for x in self.rows[3]]), np.arange(1 << 20, self.size, 1 << 20)).tolist()
        for lo, hi in zip([0, *cut], [*cut, len(window)], strict=True):
            if hi > lo:
                cols = [*(c[lo:hi] for c in self.rows), window[lo:hi] + self.windows, offset[lo:hi]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, self.KINDS, strict=True)], self.NAMES), short[lo:hi]
        self.windows += len(filled)
        self.clear()


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, block_bytes: int = 24 << 20) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document is its ids and then end_id; null text counts as empty and is end_id alone. While it is longer
    than a window it is cut into full windows, and the rest is placed by best-fit decreasing over the pieces of its
    block, so no piece is lost or split further. A row is a document, repeated doc_ids too; a null doc_id stays null.
    Columns other than doc_id and text are ignored. No rows give no rows.

    A task packs what it reads in blocks of `block_bytes` of ids (3,000 windows), which bounds its memory at any size of
    input; nothing is shuffled and nothing reaches the driver. Windows that a block leaves with a 64th of their room or
    more are opened again: their pieces, a few a block, are packed a second time, over as many blocks as a task reads.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, block, end = encoder(tokenizer), _Block(capacity, 0), int(end_id).to_bytes(4, "little")
        for b in batches:
            for doc, text in zip(b.column("doc_id"), b.column("text"), strict=True):
                doc, data = doc.as_py(), encode(text.as_py() or "") + end
                n = len(data) // 4
                for at in range(0, n, capacity):
                    block.add(doc, at, min(capacity, n - at), data[4 * at : 4 * (at + capacity)], n)
                    if block.size >= block_bytes:
                        yield from marked(block)
        yield from marked(block)

    def marked(block: _Block) -> Iterator[pa.RecordBatch]:
        for batch, short in block.flush(capacity - capacity // 64):
            yield batch.append_column("again", pa.array(short))

    def repack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(capacity, 1)
        for b in batches:
            for piece in zip(*(b.column(k) for k in block.NAMES[:5]), strict=True):
                block.add(*(x.as_py() for x in piece))
                if block.size >= block_bytes:
                    yield from (batch for batch, _ in block.flush(0))
        yield from (batch for batch, _ in block.flush(0))

    packed = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    pieces = staged(keyed(docs).select("doc_id", "text").mapInArrow(cut, f"{packed}, again boolean"), "again")
    names = list(_Block.NAMES)
    again = pieces.where("again").select(*names[:5]).mapInArrow(repack, packed)
    return pieces.where("NOT again").select(*names).unionByName(again)


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
