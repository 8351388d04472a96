"""Toxicity: a weighted lexicon, matched by Aho-Corasick on folded text, normalised by length."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.shared import keyed, slices, staged

#: Look-alike letters of other scripts, and signs and digits that stand for letters. l and 1 fold to i.
HOMOGLYPHS = {
    **dict(zip("аеорсухіјѕԁһԛԝвкмнтг", "aeopcyxijsdhqwbkmhtr", strict=True)),
    **dict(zip("αβεικνορτυχωγη", "abeiknoptuxwyn", strict=True)),
    **dict(zip("0134578@$!|łøđıæœß", "oieastbasiiiodiaos", strict=True)),
    "l": "i",
}
_TABLE = str.maketrans(HOMOGLYPHS)
_GAP = re.compile(r"[\W_]+")
PREFIXES = range(4, 9)


@lru_cache(1 << 16)
def _plain(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).lower()


def fold(text: str) -> str:
    """Lower case, marks stripped, look-alikes as Latin letters, one space before, between and after words."""
    text = text.lower()
    if not text.isascii():
        odd = {c for c in set(text) if c > "\x7f"}
        text = text.translate({ord(c): HOMOGLYPHS.get(c) or HOMOGLYPHS.get(p := _plain(c)) or p for c in odd})
    # $ @ ! | stand for letters only inside a word
    text = re.sub(r"(?<=\w)[$@!|](?=\w)", lambda m: HOMOGLYPHS[m[0]], text)
    return " " + _GAP.sub(" ", text.translate(_TABLE_WORD)).strip() + " "


_TABLE_WORD = {k: v for k, v in _TABLE.items() if chr(k) not in "$@!|"}


def terms_of(text: str) -> set[str]:
    """Candidate lexicon entries of a text: words (" word ") and their beginnings (" begi")."""
    out = set()
    for w in set(fold(text).split()):
        out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in PREFIXES if k <= len(w))
    return out


class Lexicon:
    """Weighted entries and exception phrases, with the logistic curve that turns hits into a score."""

    def __init__(self, weights: dict[str, float], exceptions: list[str], curve: list[float]):
        self.weights, self.exceptions, self.curve = weights, exceptions, curve
        self._machine = None

    def __getstate__(self):
        return {**self.__dict__, "_machine": None}

    def machine(self):
        if self._machine is None:
            self._machine = ahocorasick.Automaton()
            for t, w in self.weights.items():
                self._machine.add_word(t, (len(t), w))
            for t in self.exceptions:
                self._machine.add_word(t, (len(t), None))
            if len(self._machine):
                self._machine.make_automaton()
        return self._machine

    def features(self, text: str) -> tuple[float, float, float]:
        """Weight of all hits, that weight over the words, the share of words that hit.

        Of entries that begin at one place the heaviest counts; hits inside an exception phrase don't.
        """
        folded, machine = fold(text), self.machine()
        if not len(machine):
            return 0.0, 0.0, 0.0
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (n, w) in machine.iter(folded):
            at = end - n + 1
            if w is None:
                spared.append((at, end))
            elif w > best.get(at, 0.0):
                best[at] = w
        if spared and best:
            spared.sort()
            until, i = 0, 0
            for k in sorted(best):
                while i < len(spared) and spared[i][0] <= k:
                    until = max(until, spared[i][1])
                    i += 1
                if k < until:
                    del best[k]
        n_words = max(1, folded.count(" ") - 1)
        total = sum(best.values())
        return total, total / n_words, len(best) / n_words

    def score(self, total: float, dense: float, share: float) -> float:
        x = np.array([1.0, np.log1p(total), np.log1p(100 * dense), 100 * share])
        return float(1 / (1 + np.exp(-np.clip(x @ np.array(self.curve), -40, 40))))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    by = {0: Counter(), 1: Counter()}
    for b in batches:
        for text, label in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
            by[label].update(terms_of(text))
    terms = [t for t in by[1]]
    yield pa.RecordBatch.from_pydict({"term": terms, "tox": [by[1][t] for t in terms], "clean": [by[0][t] for t in terms]}, pa.schema([("term", pa.string()), ("tox", pa.int64()), ("clean", pa.int64())]))
    # Clean counts of terms that no toxic text of this task has; another task may need them.
    rest = [t for t, c in by[0].items() if t not in by[1]]
    yield pa.RecordBatch.from_pydict({"term": rest, "tox": [0] * len(rest), "clean": [by[0][t] for t in rest]}, pa.schema([("term", pa.string()), ("tox", pa.int64()), ("clean", pa.int64())]))


def choose(rows: list[tuple[str, int, int]], n_tox: int, n_clean: int, min_precision: float) -> dict[str, float]:
    """Entries by falling reach among toxic texts; one that begins with a chosen entry adds nothing."""
    chosen: dict[str, float] = {}
    rate = n_tox / max(1, n_clean)
    scored = []
    for t, a, c in rows:
        precision = (a + 0.1) / (a + 0.1 + (c + 0.1) * rate)
        if precision >= min_precision:
            scored.append((-a, t, float(np.log((a + 0.5) / (n_tox + 1) / ((c + 0.5) / (n_clean + 1))))))
    for _, t, w in sorted(scored):
        if not any(t[:k] in chosen for k in range(2, len(t))):
            chosen[t] = w
    return chosen


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-2) -> list[float]:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return [float(v) for v in w]


def learn(docs: DataFrame, labels: DataFrame, sample: int = 12_000, min_support: int = 8, min_precision: float = 0.9, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """A lexicon from at most `sample` labelled rows outside the held-out fold (crc32(doc_id) mod 5 is 0).

    `sample`, the stated bound, takes the rows whose doc_id hashes lowest, so it is the same at each run. A doc_id
    labelled twice counts as toxic if either label says so, and of rows that share one the text of the smallest hash is its
    text; null labels and null doc_ids are left out. What reaches the driver is bounded by the sample. Every term
    of min_support toxic texts and min_precision becomes an entry. Without both classes the lexicon is empty
    and every text scores 0.
    """
    spark = docs.sparkSession
    rows = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    train = rows.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    found = keyed(docs).join(F.broadcast(train), "doc_id")  # `train` has at most `sample` rows, one for each doc_id
    texts = found.groupBy("doc_id").agg(F.min(F.struct("th", "text", "toxic")).alias("row"))
    texts = staged(texts.select("row.text", "row.toxic").repartition(12))
    size = texts.agg(F.sum("toxic").alias("tox"), F.count("*").alias("n")).first()
    n_tox, n_clean = size.tox or 0, size.n - (size.tox or 0)
    if not n_tox or not n_clean:
        return Lexicon({}, [], [-40.0, 0.0, 0.0, 0.0])
    counts = texts.mapInArrow(_counted, "term string, tox long, clean long").groupBy("term").agg(F.sum("tox").alias("tox"), F.sum("clean").alias("clean"))
    hits, misses = F.col("tox") + 0.1, (F.col("clean") + 0.1) * (n_tox / n_clean)
    # choose() decides; here only what is clearly below the precision goes.
    precise = counts.where((F.col("tox") >= min_support) & (hits / (hits + misses) >= min_precision - 1e-9)).collect()
    weights = choose([tuple(r) for r in precise], n_tox, n_clean, min_precision)
    plain = Lexicon(weights, [], [0.0] * 4)

    def phrases(batches):
        """Pairs of words around a hit, with how many clean and toxic texts have them."""
        tox, clean = Counter(), Counter()
        machine = plain.machine()
        for b in batches:
            for text, label in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                folded, own = fold(text), set()
                for end, (n, _) in machine.iter(folded) if len(machine) else ():
                    at = end - n + 1
                    stop = folded.find(" ", at + 1)
                    before, after = folded.rfind(" ", 0, at) if at else -1, folded.find(" ", stop + 1)
                    own |= {folded[before : stop + 1]} if before >= 0 else set()
                    own |= {folded[at : after + 1]} if after > 0 else set()
                (tox if label else clean).update(own)
        keys = list({*tox, *clean})
        yield pa.RecordBatch.from_pydict({"phrase": keys, "tox": [tox[k] for k in keys], "clean": [clean[k] for k in keys]}, pa.schema([("phrase", pa.string()), ("tox", pa.int64()), ("clean", pa.int64())]))

    spare = texts.mapInArrow(phrases, "phrase string, tox long, clean long").groupBy("phrase").agg(F.sum("tox").alias("tox"), F.sum("clean").alias("clean"))
    spare = spare.where(f"tox = 0 AND clean >= {min_support}").orderBy("phrase").collect()
    fitted = Lexicon(weights, [r.phrase for r in spare] + [fold(x) for x in exceptions], [0.0] * 4)

    def measured(batches):
        for b in batches:
            f = [fitted.features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in f], pa.float64()) for i in range(3)] + [b.column("toxic")], ["a", "b", "c", "toxic"])

    m = np.array([(r.a, r.b, r.c, r.toxic) for r in texts.mapInArrow(measured, "a double, b double, c double, toxic int").collect()])
    x = np.column_stack([np.ones(len(m)), np.log1p(m[:, 0]), np.log1p(100 * m[:, 1]), 100 * m[:, 2]])
    return Lexicon(fitted.weights, fitted.exceptions, _logistic(x, m[:, 3]))


def score_toxicity(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted.

    Null text counts as empty; an empty text scores as a text without hits. A null doc_id is not held out. Equal
    texts get equal scores; columns of `docs` other than doc_id and text are never read. No rows give no rows.
    """
    lexicon = learn(docs, labels, **parameters)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [lexicon.score(*lexicon.features(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    out = keyed(docs).select("doc_id", "text").mapInArrow(scored, "doc_id long, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """Rows of `docs` that score below 0.5, all columns kept."""
    lexicon = learn(docs, labels, **parameters)
    schema = docs.schema

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            keep = [lexicon.score(*lexicon.features(t or "")) < 0.5 for t in b.column("text").to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(clean, schema)
