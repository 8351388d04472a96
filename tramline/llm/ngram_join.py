"""N-gram Jaccard join: MinHash bands find candidate groups, full n-gram sets decide each pair."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.llm.graph import components
from tramline.llm.shared import Words, keyed, mix, slices, staged, without

_U = np.uint64
SIGNED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("th", T.LongType()),
        T.StructField("hi", T.LongType()),
        T.StructField("lo", T.LongType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("bands", T.ArrayType(T.LongType(), False)),
    ]
)


def bands_for(threshold: float, rows: int, recall: float) -> int:
    """Bands of `rows` rows that find a pair at the threshold with at least this probability."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))


def shingles(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit n-gram hashes, sorted within each text, and where each text's begin.

    A text of one to n - 1 words is a single n-gram of all its words; one without words has none.
    """
    words = Words(texts)
    first = words.first
    size = np.diff(first)
    count = np.where(size >= n, size - n + 1, np.minimum(size, 1))
    starts = np.concatenate(([0], np.cumsum(count)))
    owner = np.repeat(np.arange(len(size)), count)
    at = np.arange(starts[-1]) - starts[owner] + first[owner]
    grams, short = np.zeros(len(at), np.uint64), size[owner] < n
    grams[~short] = words.at(at[~short], n)
    for k in range(1, n):
        of = np.flatnonzero(size[owner] == k)
        grams[of] = words.at(at[of], k)
    order = np.lexsort((grams, owner))
    grams = grams[order]  # owner is sorted already
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new], np.concatenate(([0], np.cumsum(np.bincount(owner[new], minlength=len(size)))))


def signatures(grams: np.ndarray, starts: np.ndarray, bands: int, rows: int, seed: int) -> np.ndarray:
    """Band hashes of each text that has n-grams, bands x texts."""
    rng = np.random.default_rng(seed)
    salt = rng.integers(1, 2**63, (bands * rows, 2), np.int64).astype(np.uint64)
    has = np.flatnonzero(np.diff(starts))
    at, out = starts[has], np.zeros((bands, len(has)), np.uint64)
    for b in range(bands):
        for r in range(rows):
            x, y = salt[b * rows + r]
            low = np.minimum.reduceat((grams ^ x) * (y | _U(1)), at) if len(at) else np.zeros(0, np.uint64)
            out[b] = mix(out[b] * _U(0x9E3779B97F4A7C15) + low)
    return out


def _linked(a: list[np.ndarray], b: list[np.ndarray] | None, num: int, den: int) -> list[tuple[int, np.ndarray]]:
    """For each set of a, those of b (of a itself, if None) with a Jaccard similarity of at least num / den.

    An inverted index over n-grams that two sets have: work follows the n-grams shared, no matrix is made.
    """
    other = a if b is None else b
    sizes = np.array([len(x) for x in other], np.int64)
    grams = np.concatenate(other) if other else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(other)), sizes)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    out = []
    for i, x in enumerate(a):
        lo, hi = np.searchsorted(grams, x, "left"), np.searchsorted(grams, x, "right")
        n = hi - lo
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        shared = np.bincount(owner[at], minlength=len(other))
        found = np.flatnonzero(shared * den >= num * (len(x) + sizes - shared))
        out.append((i, found[found != i] if b is None else found))
    return out


def near_duplicates(docs: DataFrame, n: int = 5, threshold: float = 0.8, rows: int = 5, recall: float = 0.9995, seed: int = 7, block: int = 400_000, most_sent: int = 100_000) -> DataFrame:
    """One row per row of `docs`: doc_id, class_id, text_id, n_links, th (hash of the text).

    Two texts are linked if they share a band and the Jaccard similarity of their sets of n-grams of words (case and
    punctuation count) is at least `threshold`; a pair at the threshold shares one with a probability of `recall`. class_id is
    the smallest doc_id that links lead to, text_id the smallest doc_id with the same set of n-grams, n_links the number
    of other rows linked to the row, copies included. A null or empty text has no n-grams, no links and itself as class.
    Rows that share a doc_id count as rows of their own; a null doc_id sorts last and is null where it is the smallest.
    Other columns are ignored. No rows give no rows.

    1. Rows with one set of n-grams are one text; a group of copies, however large, is one row from here on.
    2. MinHash band hashes are shuffled. A bucket of two texts or more is a group of candidates; of buckets with the same
       texts, the one of the first band stays.
    3. Each text is sent to the tasks of its buckets. A task compares the full n-gram sets of its bucket by an inverted index
       and returns, for each text, the count of its links and one link towards the smallest text that it leads to; a pair
       that meets in several buckets counts in the first. A bucket of more than `block` n-grams is dealt into parts by
       hash and each pair of parts is a task, so that tasks stay bounded and no pair goes unseen. Texts that never share
       a band never meet, whatever chains of buckets lie between them.
    4. The components of the links are the classes.

    The ids of candidate texts are broadcast to the scan that fetches the texts if they are at most `most_sent`, and joined
    with it by shuffle beyond.
    """
    bands = bands_for(threshold, rows, recall)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            grams, starts = shingles(b.column("text"), n)
            size = np.diff(starts)
            has = np.flatnonzero(size)
            hi, lo = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
            if len(has):
                hi[has], lo[has] = np.add.reduceat(mix(grams ^ _U(0x1234567)), starts[has]), np.bitwise_xor.reduceat(mix(grams + _U(0x89ABCDE)), starts[has])
            found = signatures(grams, starts, bands, rows, seed)
            ends = np.concatenate(([0], np.cumsum(np.where(size > 0, bands, 0)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)), pa.array(size.astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(found.T.reshape(-1).view(np.int64)))],
                SIGNED.names,
            )

    texts = keyed(docs)
    signed = staged(texts.mapInArrow(sign, SIGNED))
    own = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"))
    kinds = signed.where("n > 0").withColumn("own", own).groupBy("hi", "lo", "n").agg(F.min(F.struct("own", "th")).alias("m"), F.count("*").alias("size"), F.first("bands").alias("bands"))
    # A text is known by its smallest doc_id; where rows of several texts share that doc_id, by set as well.
    kinds = staged(kinds.select("hi", "lo", "n", F.struct("m.own.none", "m.own.id", "hi", "lo").alias("k"), F.col("m.th").alias("th"), "size", "bands"))
    banded = kinds.select("k", "n", F.posexplode("bands").alias("band", "h"))
    mark = F.xxhash64("k")
    buckets = banded.groupBy("band", "h").agg(F.count("*").alias("c"), F.sum("n").alias("grams"), F.bit_xor(mark).alias("x"), F.sum(mark.cast("decimal(20,0)")).cast("string").alias("s"), F.min("k").alias("least")).where("c > 1")
    buckets = buckets.groupBy("c", "x", "s", "least").agg(F.min(F.struct("band", "h", "grams")).alias("b")).select("b.band", "b.h", F.ceil(F.col("b.grams") / block).cast("int").alias("parts"))
    member = staged(banded.select("k", "band", "h").join(staged(buckets), ["band", "h"]))

    of_text = member.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("band", "h", "parts"))).alias("in")).join(kinds.select("k", "th", "size"), "k")  # at most `bands` entries
    of_text = staged(of_text)
    wanted = of_text.select(F.col("k.none").alias("none"), F.col("k.id").alias("id"), "th").distinct()
    if of_text.count() <= most_sent:  # a checked size; beyond it both sides are dealt by doc_id
        wanted = F.broadcast(wanted)
    with_id = texts.select(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "th", "text")
    fetched = with_id.join(wanted, ["none", "id", "th"], "left_semi").dropDuplicates(["none", "id", "th"])
    chosen = of_text.withColumn("none", F.col("k.none")).withColumn("id", F.col("k.id")).join(fetched, ["none", "id", "th"])
    each = chosen.select("k", "size", "text", F.transform("in", lambda x: x["band"]).alias("bands"), F.transform("in", lambda x: x["h"]).alias("hs"), F.explode("in").alias("b"))
    each = each.withColumn("part", F.pmod(mark, F.col("b.parts")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("b.parts") - 1), lambda o: F.struct(F.least("part", o).alias("p"), F.greatest("part", o).alias("q")))
    dealt = each.withColumn("at", F.explode(pairs)).select("b.band", "b.h", "at.p", "at.q", "part", "k", "size", "text", "bands", "hs")
    share = Fraction(str(threshold))
    name = kinds.schema["k"].dataType
    out = T.StructType([T.StructField("a", name), T.StructField("b", name), T.StructField("links", T.LongType())])

    def compare(key, group):
        band, _, p, q = (x.as_py() for x in key)
        group = group.combine_chunks()
        fields = group.column("k").chunk(0).flatten()
        group = group.take(pa.array(np.lexsort([f.to_numpy(zero_copy_only=False) for f in reversed(fields)])))
        k, part = group.column("k").combine_chunks(), group.column("part").to_numpy()
        grams, starts = shingles(group.column("text").combine_chunks(), n)
        sets = [grams[starts[i] : starts[i + 1]] for i in range(len(k))]
        size, root, links = group.column("size").to_numpy(), np.arange(len(k)), np.zeros(len(k), np.int64)
        # Buckets of earlier bands, one column each; where a text is in none, a number that no other has.
        before = np.repeat(-1 - np.arange(len(k), dtype=np.int64)[:, None], band, 1)
        none = np.ones((len(k), band), bool)
        lists, hs = group.column("bands").combine_chunks(), group.column("hs").combine_chunks()
        row, at = np.repeat(np.arange(len(k)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
        early = at < band
        before[row[early], at[early]], none[row[early], at[early]] = hs.flatten().to_numpy()[early], False

        def top(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        left, right = (np.flatnonzero(part == x) for x in (p, q))
        for i, found in _linked([sets[x] for x in left], None if p == q else [sets[x] for x in right], share.numerator, share.denominator):
            i, found = left[i], right[found]
            found = found[~((before[found] == before[i]) & ~none[found] & ~none[i]).any(1)]
            links[i] += size[found].sum()
            if p != q:
                links[found] += size[i]
            for j in found:
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
        hit = np.flatnonzero(links)
        to = np.array([top(i) for i in hit], np.int64)
        return pa.Table.from_arrays([k.take(pa.array(hit)), k.take(pa.array(to)), pa.array(links[hit])], ["a", "b", "links"])

    linked = staged(dealt.groupBy("band", "h", "p", "q").applyInArrow(compare, out))
    classes = components(linked.select("a", "b")).select(F.col("node").alias("k"), "component")
    counted = linked.groupBy(F.col("a").alias("k")).agg(F.sum("links").alias("links"))
    known = kinds.select("hi", "lo", "n", "k", "size").join(classes, "k", "left").join(counted, "k", "left")
    real = lambda c: F.when(~F.col(f"{c}.none"), F.col(f"{c}.id"))
    known = staged(known.withColumn("c", F.coalesce("component", "k")).select("hi", "lo", "n", "size", real("c").alias("class_id"), real("k").alias("text_id"), F.coalesce("links", F.lit(0)).alias("links")))
    rows_ = signed.select("doc_id", "th", "hi", "lo", "n").join(known, ["hi", "lo", "n"], "left")
    alone = F.col("n") == 0
    return rows_.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("text_id")).alias("text_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("size") - 1 + F.col("links")).cast("long").alias("n_links"),
        "th",
    )


def one_of_each(docs: DataFrame, **parameters) -> DataFrame:
    """Rows of `docs` that are the smallest of their class, all columns kept."""
    found = near_duplicates(docs, **parameters)
    drop = found.where(~F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id").alias("id"), F.col("th").alias("key")).distinct()
    return without(docs, drop)
