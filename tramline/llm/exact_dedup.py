"""Exact deduplication over an extendible-hash index in shared files. DataFrame operations only."""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tramline.llm.shared import SPACE, staged

KEY_BITS = 64


def _prefix(key: str, depth) -> F.Column:
    """The first `depth` bits of a key."""
    return F.expr(f"CASE WHEN {depth} = 0 THEN 0L ELSE shiftrightunsigned({key}, {KEY_BITS} - {depth}) END")


def directory(keys: DataFrame, capacity: int) -> DataFrame:
    """The directory of an extendible hash over `key` (distinct): cell (the first `bits` bits of a key), bits, bucket, depth.

    It starts with an eighth as many buckets as full ones would be, one at least. A bucket of more than `capacity` keys
    splits by its next bit; the directory doubles whenever a bucket is deeper than it, until all fit, which distinct keys do
    at 64 bits at the latest: there is no cap. The sizes at all depths between are rolled up from one count of fine cells;
    cells that are still overfull there are counted again, by more bits. Joins are by equality of (depth, prefix), where a
    bucket meets its parent; no row is met by many. Keys are hashes, so that depths differ by a few bits, and the
    directory has a few rows for each bucket.
    """
    fine = max(0, ceil(log2(max(1, keys.count()) / capacity)) + 3)
    start = max(0, fine - 6)
    level = staged(keys.groupBy(_prefix("key", fine).alias("prefix")).agg(F.count("*").alias("held")).select(F.lit(fine).alias("depth"), "prefix", "held"))
    sizes = [level]
    for depth in range(fine - 1, start - 1, -1):
        up = level.groupBy(F.expr(f"shiftrightunsigned(prefix, {fine - depth})").alias("prefix")).agg(F.sum("held").alias("held"))
        sizes.append(up.select(F.lit(depth).alias("depth"), "prefix", "held"))
    while not (over := level.where(F.col("held") > capacity)).isEmpty() and fine < KEY_BITS:
        deeper = min(KEY_BITS, fine + 4)
        rest = keys.join(over.select(F.col("prefix").alias("cell")), _prefix("key", fine) == F.col("cell"), "left_semi")
        level = staged(rest.groupBy(_prefix("key", deeper).alias("prefix")).agg(F.count("*").alias("held")).select(F.lit(deeper).alias("depth"), "prefix", "held"))
        sizes += [level.groupBy(F.expr(f"shiftrightunsigned(prefix, {deeper - depth})").alias("prefix")).agg(F.sum("held").alias("held")).select(F.lit(depth).alias("depth"), "prefix", "held") for depth in range(fine + 1, deeper)]
        sizes.append(level)
        fine = deeper
    tree = sizes[0]
    for s in sizes[1:]:
        tree = tree.unionByName(s)
    tree = staged(tree)
    split = tree.where(F.col("held") > capacity).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    child = tree.where((F.col("held") <= capacity) | (F.col("depth") == KEY_BITS)).withColumn("parent", F.expr("shiftrightunsigned(prefix, 1)"))
    leaves = child.join(split, ["depth", "parent"], "left_semi").unionByName(child.where(F.col("depth") == start))
    leaves = staged(leaves.select("depth", "prefix", "held"))
    bits = leaves.agg(F.max("depth")).first()[0] or 0
    width = F.expr(f"shiftleft(1L, {bits} - depth)")
    cells = leaves.withColumn("cell", F.explode(F.sequence(F.expr(f"shiftleft(prefix, {bits} - depth)"), F.expr(f"shiftleft(prefix, {bits} - depth)") + width - 1)))
    bucket = F.expr(f"shiftleft(prefix, {bits} - depth)")
    return staged(cells.select("cell", F.lit(bits).alias("bits"), bucket.alias("bucket"), "depth"))


def normalised(text: str = "text"):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ")


def exact_dedup(docs: DataFrame, capacity: int = 128, key_bits: int = 64, most_sent: int = 1_000_000) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256, th (hash of the text as it is).

    Texts are equal when identical once every run of white space is one space; null counts as empty.
    The smallest doc_id of a group stays. Rows that share a doc_id are one document and share its fate,
    each counts in group_size. A null doc_id sorts last and stays only where its group has no other.
    Columns of `docs` besides doc_id and text are ignored, whatever their names. No rows give no rows.

    1. Every row gets the hash key of its text (key_bits < 64 weakens it, to exercise chains in tests), and keys are
       counted, first within each input split: a huge group of copies travels as one row a split.
    2. The directory doubles until its buckets, ranges of keys, hold at most `capacity` keys each.
    3. A key of one row is an entry of its bucket as it is. The texts behind all other keys are read again, and those of one
       bucket and key are compared by their bytes, again first within each split; texts that differ chain up in the key.
    4. Owner tasks, one range of keys each, chain the entries of their buckets and write the index to the shared folder.
    5. Each row looks up its cell of the directory, there its bucket, and in the bucket the entry of its key and digest.

    Texts travel only where a key has two rows. Which texts those are is broadcast to the scan if they are at most
    `most_sent`, and joined with it by shuffle beyond.
    """
    hashed = F.xxhash64("norm")
    key = F.expr(f"shiftleft(shiftrightunsigned(xxhash64(norm), {64 - key_bits}), {64 - key_bits})") if key_bits < 64 else hashed
    raw = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    base = raw.select("doc_id", F.xxhash64("text").alias("th"), normalised().alias("norm")).withColumn("key", key)
    rows = staged(base.select("doc_id", "th", "key", F.unhex(F.sha2("norm", 256)).alias("sha")))

    keys = staged(rows.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.min("sha").alias("sha")))
    cells = directory(keys, capacity)
    bits = cells.agg(F.max("bits")).first()[0] or 0
    placed = lambda df: df.withColumn("cell", _prefix("key", bits)).join(cells.select("cell", "bucket"), "cell")

    shared = keys.where("n > 1").select("key")
    wanted = staged(rows.join(shared, "key", "left_semi").select("th", "key").distinct())
    if wanted.count() <= most_sent:  # a checked size; beyond it both sides are dealt by hash
        wanted = F.broadcast(wanted)
    again = raw.select("doc_id", F.xxhash64("text").alias("th"), "text").join(wanted, "th").select("doc_id", "key", normalised().alias("norm")).where(key == F.col("key"))
    merged = placed(again).groupBy("bucket", "key", "norm").agg(F.min("doc_id").alias("first"), F.count("*").alias("group_size"))
    merged = merged.select("bucket", "key", F.unhex(F.sha2("norm", 256)).alias("sha"), "first", "group_size")
    single = placed(keys.where("n = 1")).select("bucket", "key", "sha", "first", F.col("n").alias("group_size"))
    chain = Window.partitionBy("bucket", "key").orderBy(F.col("first").asc_nulls_last(), "sha")
    index = staged(single.unionByName(merged).repartition("bucket").withColumn("link", F.row_number().over(chain)))
    found = placed(rows).join(index, ["bucket", "key", "sha"])
    return found.select(
        "doc_id",
        F.col("first").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("first")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "th",
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def one_of_each(docs: DataFrame, **parameters) -> DataFrame:
    """Rows of `docs` that stay, all columns kept; of rows that share doc_id and text one stays.

    Rows are told by doc_id and the hash of their text; only those that are to go or are repeated are looked for.
    """
    found = staged(exact_dedup(docs, **parameters).select("doc_id", "kept", "text_sha256", "th"))
    stays = found.where("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("c"), F.min("th").alias("th")).where("c > 1")
    gone = found.where(~F.col("kept")).select("doc_id", "th").distinct()
    other = found.where("kept").join(stays.select("doc_id", "text_sha256", F.col("th").alias("one")), ["doc_id", "text_sha256"]).where("th <> one").select("doc_id", "th").distinct()
    marks = staged(gone.unionByName(other).withColumn("again", F.lit(False)).unionByName(stays.select("doc_id", "th").withColumn("again", F.lit(True))))
    if marks.count() <= 1_000_000:  # a checked size; beyond it both sides are dealt by doc_id
        marks = F.broadcast(marks)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    marked = rows.join(marks, rows["id"].eqNullSafe(marks["doc_id"]) & (rows["hash"] == marks["th"]), "left")
    back = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    rest = marked.where("again IS NULL").select(*back)
    if not stays.isEmpty():
        rest = rest.unionByName(marked.where("again").dropDuplicates(["id", "hash"]).select(*back))
    return rest


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
"""
