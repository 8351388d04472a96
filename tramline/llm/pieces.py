"""Piece encoding and decoding by a streaming Viterbi search."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.shared import keyed, slices

#: How a sentencepiece vocabulary writes a space. Here pieces hold plain spaces, so the sign itself is just a character.
SPACE = "▁"
#: Pieces that the vocabulary lists without a rank have scores below this.
_UNRANKED = -1e8


class Pieces:
    """Vocabulary of a sentencepiece model: pieces with scores, one id for each byte; encoding and decoding."""

    def __init__(self, path: str, most: int = 64 << 20):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, tuple[float, int]] = {}
        self.bytes, self.out = [0] * 256, []
        for i in range(m.vocab_size()):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.out.append(bytes([int(piece[3:5], 16)]))
            elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
                self.out.append(b"")
            else:
                piece = piece.replace(SPACE, " ")
                self.ids[piece] = (m.get_score(i), i)
                self.out.append(piece.encode())
        self.reach = max(map(len, self.ids))
        #: Finds all pieces that end at each place, the longest first.
        self.machine = ahocorasick.Automaton()
        for piece, (score, _) in self.ids.items():
            self.machine.add_word(piece, (len(piece), score))
        self.machine.make_automaton()
        #: Of a character that is no piece and becomes its bytes; worse than any ranked piece.
        self.fallback = 10 * min((s for s, _ in self.ids.values() if s > _UNRANKED), default=0.0) - 10
        self.odd = re.compile("[^" + re.escape("".join(sorted(c for c in self.ids if len(c) == 1))) + "]")
        # If a piece has spaces only at its start, the best path has a boundary before each run of spaces, and around
        # white space that is in no longer piece: units between these can be searched, and kept, alone.
        inner = re.escape("".join(sorted({c for p in self.ids if len(p) > 1 for c in p if c.isspace() and c != " "})))
        body = f"(?:\\S|[{inner}])" if inner else r"\S"
        apart = all(re.fullmatch(f" *{body}*", p) for p in self.ids if len(p) > 1)
        self.units = re.compile(f" *{body}+| +|\\s") if apart else re.compile(r"(?s).+")
        self.most, self.known, self.held = most, {}, 0

    def _settle(self, found: Iterable, shift: int, text: str, low: int, score: list[float], back: list[int]) -> None:
        """Best scores and links of the places after `low`; found: (end - shift is the place, (length, score)) by place."""
        odd = iter([m.end() for m in self.odd.finditer(text, low)])  # characters that are no piece
        u, none = next(odd, 1 << 62), self.fallback
        for end, (n, w) in found:
            to = end - shift
            while u < to:
                if score[u - 1] + none > score[u]:
                    score[u], back[u] = score[u - 1] + none, u - 1
                u = next(odd, 1 << 62)
            at = to - n
            if at >= 0 and (new := score[at] + w) > score[to]:
                score[to], back[to] = new, at
        while u < 1 << 62:
            if score[u - 1] + none > score[u]:
                score[u], back[u] = score[u - 1] + none, u - 1
            u = next(odd, 1 << 62)

    def stream(self, parts: Iterable[str]) -> Iterator[list[int]]:
        """Ids of a text that comes in parts, given out as soon as they are certain.

        The greatest sum of scores wins; of equal ones that with the longer last piece. A piece that ends further on
        begins at one of the last `reach` places, so only the best paths to these survive. After every `reach` characters
        they are traced back to the last boundary through which all run: ids up to it are given out, and scores, links and
        characters before it are dropped. Memory is that window and what is open behind it, however long the text.
        """
        reach, search = self.reach, self.machine.iter("")
        text, score, back, gone = "", [0.0], [0], 0  # from the last boundary on, `gone` characters into the text
        for part in parts:
            for k in range(0, len(part), reach):
                low, text = len(text), text + part[k : k + reach]
                n = len(text)
                score += [-np.inf] * (n - low)
                back += [0] * (n - low)
                search.set(part[k : k + reach], False)  # goes on where the last one ended
                self._settle(search, gone - 1, text, low, score, back)
                live = {j for j in range(max(0, n + 1 - reach), n + 1) if score[j] > -np.inf}
                while len(live) > 1:
                    last = max(live)
                    live.discard(last)
                    live.add(back[last])
                if joint := live.pop():
                    yield self._path(text, back, joint)
                    text, score, back, gone = text[joint:], score[joint:], [max(0, j - joint) for j in back[joint:]], gone + joint
        if text:
            yield self._path(text, back, len(text))

    def whole(self, text: str) -> list[int]:
        """Ids of a short text, which is a window by itself."""
        n = len(text)
        score, back = [0.0, *[-np.inf] * n], [0] * (n + 1)
        if self.odd.search(text):
            self._settle(self.machine.iter(text), -1, text, 0, score, back)
            return self._path(text, back, n)
        for end, (size, w) in self.machine.iter(text):
            at = end + 1 - size
            w += score[at]
            if w > score[end + 1]:
                score[end + 1], back[end + 1] = w, at
        out, ids = [], self.ids
        while n:
            out.append(ids[text[back[n] : n]][1])
            n = back[n]
        return out[::-1]

    def _path(self, text: str, back: list[int], at: int) -> list[int]:
        out: list[list[int]] = []
        while at:
            k = back[at]
            hit = self.ids.get(text[k:at])
            out.append([hit[1]] if hit else [self.bytes[b] for b in text[k:at].encode()])
            at = k
        return list(chain.from_iterable(reversed(out)))

    def encode(self, text: str) -> bytes:
        """Ids of a text, little-endian unsigned 32-bit; a space goes before it, as the vocabulary expects. An empty text has none.

        All paths meet where one unit ends and the next begins, so that ids are certain there; units are kept with theirs.
        """
        if not text:
            return b""
        units, known = self.units.findall(" " + text), self.known
        if self.held > self.most:
            known.clear()  # bounds memory, changes no result
            self.held = 0
        for u in set(units).difference(known):
            ids = self.whole(u) if len(u) <= 4 * self.reach else list(chain.from_iterable(self.stream((u,))))
            known[u] = pack(f"<{len(ids)}I", *ids)
            self.held += len(u) + 4 * len(ids) + 160  # with what Python adds
        return b"".join(map(known.__getitem__, units))

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.out.__getitem__, ids.tolist())).decode("utf-8", "replace")[1:]


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def encode(docs: DataFrame, model: str) -> DataFrame:
    """One row per row of `docs`: doc_id, th (hash of the text), ids (little-endian unsigned 32-bit).

    Null text counts as empty and has no ids. Whole texts of any length are encoded; a row is a row, whatever its
    doc_id. Other columns are ignored. No rows give no rows. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array([p.encode(t) for t in b.column("text").to_pylist()], pa.binary())], ["doc_id", "th", "ids"])

    return keyed(docs).mapInArrow(run, "doc_id long, th long, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """The rows of encode() with text; null ids give an empty text, bytes that are no UTF-8 the replacement sign."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for b in batches:
            for k in range(0, b.num_rows, 256):
                s = b.slice(k, 256)
                texts = [p.decode(np.frombuffer(x or b"", "<u4")) for x in s.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([s.column("doc_id"), s.column("th"), s.column("ids"), pa.array(texts, pa.string())], ["doc_id", "th", "ids", "text"])

    return encoded.select("doc_id", "th", "ids").mapInArrow(run, "doc_id long, th long, ids binary, text string")


def digest(decoded: DataFrame) -> DataFrame:
    """Ids in short, and whether the text came back byte for byte."""
    return decoded.select("doc_id", F.expr("length(ids) div 4").cast("long").alias("n_ids"), F.crc32("ids").cast("long").alias("ids_crc32"), F.sha2("text", 256).alias("decoded_sha256"), (F.xxhash64("text") == F.col("th")).alias("exact"))
