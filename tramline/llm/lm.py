"""Language-model scoring of whole documents: a gated recurrent network over corpus-wide counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.gru import Model
from tramline.llm.shared import Words, keyed, mix, slices, staged

_U = np.uint64
#: The end of a text as a token.
END = int(mix(np.array([0x456E64], np.uint64))[0])
BLOCKS = "block long, docs array<long>, held array<boolean>, sizes array<int>, types binary, shapes binary, tokens binary"
SLICES = "part int, block long, types binary, shapes binary, counts binary"
COUNTED = "part int, block long, counts binary, types binary, shapes binary, seen array<long>, kinds array<long>"
SUMS = "slice int, of int, n long, sum binary"
SHAPES = 18
#: Parts of the model that are added up apart.
_SLICES = 16


def shapes_of(words: Words) -> np.ndarray:
    """Classes of rare words: last character (comma, full stop, other), any byte above ASCII, length."""
    last = words.data[words.end - 1] if len(words.end) else np.zeros(0, np.uint8)
    high = np.concatenate(([0], np.cumsum(words.data > 127)))
    odd = high[words.end] > high[words.start]
    size = np.digitize(words.end - words.start, (6, 10))
    return (((last == 44) + 2 * (last == 46)) * 6 + odd * 3 + size).astype(np.uint8)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows of about `most` bytes of text each: distinct words, sorted by hash, and each text as places among them."""
    press, task, number = zstandard.ZstdCompressor(level=3).compress, TaskContext.get().partitionId(), 0
    ids, held, sizes, hashes, shapes, held_bytes = [], [], [], [], [], 0

    def block():
        words = np.concatenate(hashes)
        order = np.argsort(words)  # any row of a word will do: its shape is that of the others
        words = words[order]
        new = np.concatenate(([True], words[1:] != words[:-1]))
        types, first, places = words[new], order[new], np.empty(len(words), np.uint32)
        places[order] = np.cumsum(new, dtype=np.uint32) - np.uint32(1)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([(task << 24) + number], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([held], pa.list_(pa.bool_())),
                pa.array([np.concatenate(sizes).astype(np.int32)], pa.list_(pa.int32())),
                pa.array([types.tobytes()], pa.binary()),
                pa.array([np.concatenate(shapes)[first].tobytes()], pa.binary()),
                pa.array([press(places.reshape(-1, 1).view(np.uint8).reshape(-1, 4).T.tobytes())], pa.binary()),
            ],
            ["block", "docs", "held", "sizes", "types", "shapes", "tokens"],
        )

    for b in slices(batches):
        words = Words(b.column("text"), lower=True)
        ends = words.first[1:]
        hashes.append(np.insert(words.hash, ends, _U(END)))
        shapes.append(np.insert(shapes_of(words), ends, 0))
        sizes.append(np.diff(words.first) + 1)
        ids += b.column("doc_id").to_pylist()
        held += b.column("held").to_pylist()
        held_bytes += len(words.data)
        if held_bytes >= most:
            yield block()
            ids, held, sizes, hashes, shapes, held_bytes, number = [], [], [], [], [], 0, number + 1
    if ids:
        yield block()


def _places(packed: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view(np.uint32).reshape(-1)


def _list(scalar: pa.Scalar) -> np.ndarray:
    return scalar.values.to_numpy(zero_copy_only=False)


def corpus_counts(blocks: DataFrame, parts: int, vocabulary: int) -> DataFrame:
    """Training counts over the whole corpus, given back to each block for its words in their order.

    A block counts its words before anything is shuffled and cuts its sorted words into `parts` ranges of hashes;
    a part holds, of each block, one row. What a frequent word costs is one entry a block, so no part is hot.
    Parts also tell tokens, words and, for the `vocabulary` most frequent of their range, the counts.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)
        for b in batches:
            for row in range(b.num_rows):
                types = np.frombuffer(b.column("types")[row].as_py(), np.uint64)
                shapes = np.frombuffer(b.column("shapes")[row].as_py(), np.uint8)
                places, sizes, held = _places(b.column("tokens")[row].as_py()), _list(b.column("sizes")[row]), _list(b.column("held")[row]).astype(bool)
                counts = np.bincount(places[np.repeat(~held, sizes)], minlength=len(types)).astype(np.uint32)
                at = np.concatenate(([0], np.searchsorted(types, edges), [len(types)]))
                ranges = [(k, slice(at[k], at[k + 1])) for k in range(parts) if at[k + 1] > at[k]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in ranges], pa.int32()), pa.array([b.column("block")[row].as_py()] * len(ranges), pa.int64()), *[pa.array([x[s].tobytes() for _, s in ranges], pa.binary()) for x in (types, shapes, counts)]],
                    ["part", "block", "types", "shapes", "counts"],
                )

    def add(key, group):
        each = [np.frombuffer(x, np.uint64) for x in group.column("types").to_pylist()]
        own = np.concatenate([np.frombuffer(x, np.uint32) for x in group.column("counts").to_pylist()])
        types, first, places = np.unique(np.concatenate(each), return_index=True, return_inverse=True)
        shapes = np.frombuffer(b"".join(group.column("shapes").to_pylist()), np.uint8)[first]
        total = np.bincount(places, own, len(types)).astype(np.uint64)
        back, at = total[places], 0
        rows = {n: [] for n in ("part", "block", "counts", "types", "shapes", "seen", "kinds")}

        def row(*values):
            for col, v in zip(rows.values(), values, strict=True):
                col.append(v)

        part = key[0].as_py()
        for block, x in zip(group.column("block").to_pylist(), each, strict=True):
            row(part, block, back[at : at + len(x)].tobytes(), None, None, None, None)
            at += len(x)
        top = np.lexsort((types, -total.astype(np.int64)))[:vocabulary]
        top = top[total[top] > 0]
        seen = np.bincount(shapes, total, SHAPES).astype(np.int64)
        kinds = np.bincount(shapes[total > 0], minlength=SHAPES)
        row(part, -1, total[top].tobytes(), types[top].tobytes(), shapes[top].tobytes(), seen.tolist(), kinds.tolist())
        kind = {"part": pa.int32(), "block": pa.int64(), "counts": pa.binary(), "types": pa.binary(), "shapes": pa.binary(), "seen": pa.list_(pa.int64()), "kinds": pa.list_(pa.int64())}
        return pa.table({n: pa.array(v, kind[n]) for n, v in rows.items()})

    sliced = blocks.select("block", "held", "sizes", "types", "shapes", "tokens").mapInArrow(cut, SLICES)
    return staged(sliced.groupBy("part").applyInArrow(add, COUNTED))


def _frequent(counted: DataFrame, vocabulary: int) -> np.ndarray:
    """The most frequent words of the corpus: hash, count, shape. Ties go to the smaller hash."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t, c, s in zip(*(b.column(n).to_pylist() for n in ("types", "counts", "shapes")), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(t, np.int64)), pa.array(np.frombuffer(c, np.int64)), pa.array(np.frombuffer(s, np.uint8).astype(np.int32))], ["type", "n", "shape"])

    rows = counted.where("block = -1").select("types", "counts", "shapes").mapInArrow(spread, "type long, n long, shape int")
    rows = rows.orderBy(F.desc("n"), "type").limit(vocabulary).collect()
    return np.array([(r.type, r.n, r.shape) for r in rows], np.int64).reshape(-1, 3)


def taught(ids: np.ndarray, held: np.ndarray, turn: int, rounds: int, seed: int) -> np.ndarray:
    """Places of the training documents that are taught in this round when they are told apart by doc_id."""
    lot = (mix(ids.view(np.uint64) + _U(seed)) >> _U(11)) / 2.0**53 * rounds
    return np.flatnonzero((lot.astype(np.int64) == turn) & ~held)


def _added(key, group):
    """Sums of weighted parameters of one slice."""
    total = np.sum([np.frombuffer(x, np.float64) for x in group.column("sum").to_pylist()], 0)
    n = int(np.sum(group.column("n").to_numpy()))
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "of": pa.array([key[1].as_py() if len(key) > 1 else 0], pa.int32()), "n": pa.array([n], pa.int64()), "sum": pa.array([total.tobytes()], pa.binary())})


def score_documents(docs: DataFrame, held_out, vocabulary: int = 2000, per: int = 40, hidden: int = 32, rounds: int = 4, block_bytes: int = 8 << 20, part_types: int = 1 << 22, most_tokens: int = 1 << 22, seed: int = 5) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words of the text, A-Z in lower case, and its end; null text counts as empty and is its end alone.
    `held_out` is a condition on doc_id; rows where it is true are scored and teach nothing; where it is null, the row
    teaches. base_score is that of add-one counts over all training tokens. `score` is the log10 likelihood of the whole
    text under the model: the class of each token given all before it in the text, then the word given the class. Words
    of frequent classes come from the network, words of rare classes from add-one counts of the whole corpus. Rows that
    share a doc_id are rows of their own. Other columns are ignored. No rows give no rows.

    The network learns from every token of all training documents, at every size of corpus. A document is taught in one of
    `rounds` rounds, with its block or, where blocks are few, by its doc_id: every task goes on from the model so far over its
    own documents of that round, by truncated backpropagation, `most_tokens` or a document more at a time, and the models are
    averaged, weighted by tokens, on the executors. Only the parameters, a fixed number, reach the driver. Counts,
    vocabulary, classes and shares of rare words are over all training documents. Words
    are known by 64-bit hashes, mixed over all their bytes.
    """
    texts = keyed(docs).withColumn("held", F.coalesce(held_out, F.lit(False))).select("doc_id", "held", "text")
    blocks = staged(texts.mapInArrow(lambda batches: _blocks(batches, block_bytes), BLOCKS))
    total = blocks.agg(F.sum(F.length("types") / 8).alias("types"), F.count("*").alias("n")).first()
    parts = max(32, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int((total["types"] or 0) / part_types) + 1)
    counted = corpus_counts(blocks, parts, vocabulary)
    sums = counted.where("block = -1").select(F.posexplode("seen").alias("shape", "seen"), "kinds").select("shape", "seen", F.col("kinds")[F.col("shape")].alias("kinds")).groupBy("shape").agg(F.sum("seen").alias("seen"), F.sum("kinds").alias("kinds")).collect()
    seen, kinds = np.zeros(SHAPES, np.int64), np.zeros(SHAPES, np.int64)
    for r in sums:
        seen[r["shape"]], kinds[r["shape"]] = r["seen"], r["kinds"]
    n_train, n_types = int(seen.sum()), int(kinds.sum())
    top = _frequent(counted, vocabulary)
    np.subtract.at(seen, top[:, 2], top[:, 1])
    np.subtract.at(kinds, top[:, 2], 1)
    if not (top[:, 0] == np.int64(np.uint64(END).view(np.int64))).any():
        top = np.vstack((top, [[np.uint64(END).view(np.int64), 0, 0]]))
    words = top[:, 0].view(np.uint64) if top[:, 0].flags.c_contiguous else np.ascontiguousarray(top[:, 0]).view(np.uint64)
    order = np.argsort(words)
    lookup, symbol = words[order], order.astype(np.int32)
    start = int(np.flatnonzero(words == _U(END))[0])

    def symbols(types: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        """The symbol of each word: itself if frequent, else the class of its shape."""
        at = np.minimum(np.searchsorted(lookup, types), len(lookup) - 1)
        return np.where(lookup[at] == types, symbol[at], len(lookup) + shapes.astype(np.int32))

    model = Model(top[:, 1].astype(np.float64), seen.astype(np.float64), per, hidden, seed)
    by_block = total["n"] >= 16 * rounds
    place = F.pmod(F.shiftright("block", 24) + F.col("block").bitwiseAND(F.lit((1 << 24) - 1)), F.lit(rounds))  # the blocks of a task take turns
    for turn in range(rounds):

        def lesson(batches: Iterator[pa.RecordBatch], turn: int = turn, now: np.ndarray = model.flat()) -> Iterator[pa.RecordBatch]:
            """The model after this task's documents of the round, in slices."""
            tokens, sizes, held, n = [], [], 0, 0
            own = Model(top[:, 1].astype(np.float64), seen.astype(np.float64), per, hidden, seed).load(now)

            def teach():
                own.train(np.concatenate(tokens), np.concatenate(sizes).astype(np.int64), start, 1, rate=8e-3 * (1 - turn / rounds))

            for b in batches:
                for row in range(b.num_rows):
                    ids = np.array([-1 if x is None else x for x in b.column("docs")[row].as_py()], np.int64)
                    out = _list(b.column("held")[row]).astype(bool)
                    use = np.flatnonzero(~out) if by_block else taught(ids, out, turn, rounds, seed)
                    if not len(use):
                        continue
                    got = symbols(np.frombuffer(b.column("types")[row].as_py(), np.uint64), np.frombuffer(b.column("shapes")[row].as_py(), np.uint8))
                    seq, size = got[_places(b.column("tokens")[row].as_py())], _list(b.column("sizes")[row])
                    first = np.cumsum(size) - size
                    for d in use:
                        tokens.append(seq[first[d] : first[d] + size[d]].astype(np.int32))
                        sizes.append(size[d : d + 1])
                        held += int(size[d])
                        if held >= most_tokens:
                            teach()
                            tokens, sizes, held, n = [], [], 0, n + held
            if tokens:
                teach()
                n += held
            if not n:
                return
            cut = np.array_split(own.flat(), _SLICES)
            yield pa.RecordBatch.from_arrays([pa.array(range(_SLICES), pa.int32()), pa.array([TaskContext.get().partitionId() % 64] * _SLICES, pa.int32()), pa.array([n] * _SLICES, pa.int64()), pa.array([(n * c.astype(np.float64)).tobytes() for c in cut], pa.binary())], ["slice", "of", "n", "sum"])

        learnt = (blocks.where(place == turn) if by_block else blocks).select("docs", "held", "sizes", "types", "shapes", "tokens").mapInArrow(lesson, SUMS)
        sums = sorted(learnt.groupBy("slice", "of").applyInArrow(_added, SUMS).groupBy("slice").applyInArrow(_added, SUMS).collect())
        if sums:
            model.load(np.concatenate([np.frombuffer(r["sum"], np.float64) / r["n"] for r in sums]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                types, shapes = np.frombuffer(b.column("types")[row].as_py(), np.uint64), np.frombuffer(b.column("shapes")[row].as_py(), np.uint8)
                got = sorted((x["part"], x["counts"]) for x in b.column("got")[row].as_py())
                counts = np.frombuffer(b"".join(c for _, c in got), np.uint64)
                places, sizes = _places(b.column("tokens")[row].as_py()).astype(np.int64), _list(b.column("sizes")[row]).astype(np.int64)
                symbol_of = symbols(types, shapes)
                base = np.log10((counts + 1.0) / (n_train + n_types + 1))
                rare = symbol_of >= len(lookup)
                own = np.where(rare, np.log10((counts + 1.0) / (seen[shapes] + kinds[shapes] + 1)), 0.0)
                first = np.concatenate(([0], np.cumsum(sizes)))[:-1]  # each document has a token at least
                add = lambda v, p=places, f=first: np.add.reduceat(v[p], f)
                deep = model.score(symbol_of[places], sizes, start) / np.log(10)
                ids = b.column("docs")[row].values
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [ids, b.column("held")[row].values, pa.array(sizes), pa.array(add((counts > 0).astype(np.int64))), pa.array(np.full(n, n_train)), pa.array(add(base)), pa.array(deep + add(own))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    of_block = counted.where("block >= 0").groupBy("block").agg(F.collect_list(F.struct("part", "counts")).alias("got"))
    rows = blocks.join(of_block, "block").select("docs", "held", "sizes", "types", "shapes", "tokens", "got")
    return rows.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
