"""Approximate nearest neighbours by cross-polytope hashing with multiprobe and exact reranking."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tramline.llm.shared import staged

NEAR = "query_id long, kin long, times long, vec_id long, copies long, score double"


class Rotations:
    """Pseudo-random rotations: three rounds of random signs and a fast Hadamard transform, for each table."""

    def __init__(self, dim: int, tables: int, seed: int):
        self.dim, self.width = dim, 1 << max(0, dim - 1).bit_length()
        rng = np.random.default_rng([seed, dim])
        self.signs = rng.choice(np.array([-1.0, 1.0]), (tables, 3, self.width))

    def __call__(self, unit: np.ndarray, table: int) -> np.ndarray:
        y = np.zeros((len(unit), self.width))
        y[:, : self.dim] = unit
        for signs in self.signs[table]:
            y = hadamard(y * signs)
        return y


def hadamard(y: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of each row, in log2(width) passes."""
    n, width = y.shape
    h = 1
    while h < width:
        y = y.reshape(n, -1, 2, h)
        y = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2)
        h *= 2
    return y.reshape(n, width) / np.sqrt(width)


def cells(y: np.ndarray, probes: int) -> np.ndarray:
    """The `probes` signed axes nearest to each row, nearest first: 2 * axis, one more if it points down."""
    size = np.abs(y)
    probes = min(probes, y.shape[1])
    top = np.argpartition(-size, probes - 1, 1)[:, :probes] if probes < y.shape[1] else np.argsort(-size, 1)
    return 2 * top + (np.take_along_axis(y, top, 1) < 0)


def candidates(own: list[np.ndarray], probed: list[np.ndarray], n: int) -> np.ndarray:
    """Places of the rows, of n, that are in a probed cell of any table; own: by table, the rows of each cell."""
    hit = np.zeros(n, bool)
    for of_cell, cells_ in zip(own, probed, strict=True):
        for c in cells_:
            hit[of_cell[c]] = True
    return np.flatnonzero(hit)


def nearest(query: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest rows, ties to the smaller id, and their distances.

    Distances by products choose who may be among the k, with room for rounding; theirs are then taken exactly.
    """
    n = min(k, len(rows))
    if not n:
        return np.zeros(0, np.int64), np.zeros(0)
    norm, own = np.einsum("ij,ij->i", rows, rows), float(query @ query)
    rough = norm - 2 * (rows @ query) + own
    slack = 1e-9 * (1 + norm.max() + own)
    may = np.flatnonzero(rough <= np.partition(rough, n - 1)[n - 1] + 2 * slack) if np.isfinite(rough).all() else np.arange(len(rows))
    exact = np.sqrt(((rows[may] - query) ** 2).sum(1))
    best = np.lexsort((ids[may], exact))[:n]
    return may[best], exact[best]


def _valid(vectors: DataFrame) -> DataFrame:
    """vec_id, v, kin (hash of v), dim, copies: equal rows as one; vectors that take no part left out."""
    v = F.col("embedding").cast("array<double>")
    fine = F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(fine).groupBy("vec_id", "v").agg(F.count("*").alias("copies"))
    return rows.select("vec_id", "v", F.xxhash64("v").alias("kin"), F.size("v").alias("dim"), "copies")


def nearest_neighbours(vectors: DataFrame, query_every: int = 100, k: int = 10, tables: int = 16, probes: int = 8, rows_a_block: int = 16_384, queries_a_block: int = 4_096, seed: int = 3) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest vectors found for each query, by Euclidean distance.

    Queries are the rows whose vec_id is divisible by `query_every`, candidates all rows but the query's own; rows that
    share a vec_id are rows of their own, as queries and as candidates. A vector that is null, zero or holds a null or
    non-finite component takes no part; nor does a null vec_id. A query meets only vectors of its own length. Ties go to
    the smaller vec_id. Other columns are ignored. No rows give no rows.

    Every vector is hashed into one cell of each table: the signed axis that its direction is nearest to after a
    rotation. A query asks the `probes` nearest cells of each, and what they hold is reranked by exact distance. Nothing is
    fitted. Rows are dealt by hash into blocks of about `rows_a_block`, each with tables of its own, and the queries into blocks of
    about `queries_a_block`; a task answers one block of queries from one block of rows, so that a vector travels once for
    each block of queries, no cell is cut short, and no task holds more than two blocks. A query that found fewer
    than k asks the blocks again, without cells.
    """
    base = staged(_valid(vectors))
    asks = F.col("vec_id") % query_every == 0
    parts = base.groupBy("dim").agg(F.ceil(F.count("*") / rows_a_block).cast("int").alias("parts"), F.ceil(F.sum(asks.cast("long")) / queries_a_block).cast("int").alias("q_parts"), F.sum("copies").alias("there"))
    base = base.join(staged(parts), "dim")

    def answered(queries: DataFrame, hashed: bool) -> DataFrame:
        """The k nearest that each query finds in each block of rows."""
        mine = lambda n: F.array(F.pmod(F.xxhash64("vec_id", "kin"), F.col(n)).cast("int"))
        every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
        cols = ["dim", "p", "q", "asks", "vec_id", "kin", "copies", "v"]
        held = base.where("q_parts > 0").withColumn("asks", F.lit(False)).withColumn("p", mine("parts")[0]).withColumn("q", F.explode(every("q_parts")))
        asked = queries.withColumn("asks", F.lit(True)).withColumn("q", mine("q_parts")[0]).withColumn("p", F.explode(every("parts")))

        def answer(key, group):
            dim, of = key[0].as_py(), group.column("asks").to_numpy()
            ids, kin, copies = (group.column(c).to_numpy() for c in ("vec_id", "kin", "copies"))
            v = group.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            rows, r_ids, r_kin, r_copies = v[~of], ids[~of], kin[~of], copies[~of]
            queries = v[of]
            if hashed and len(rows) and len(queries):
                turn, unit, q_unit = Rotations(dim, tables, seed), _unit(rows), _unit(queries)
                own, probed = [], []
                for t in range(tables):
                    cell = cells(turn(unit, t), 1)[:, 0]
                    order = np.argsort(cell, kind="stable")
                    own.append(np.split(order, np.searchsorted(cell[order], np.arange(1, 2 * turn.width))))
                    probed.append(cells(turn(q_unit, t), probes))
            out: list[list[np.ndarray]] = [[], [], [], []]
            for j, query in enumerate(queries):
                at = candidates(own, [x[j] for x in probed], len(rows)) if hashed and len(rows) else np.arange(len(rows))
                alone = (r_ids[at] == ids[of][j]) & (r_kin[at] == kin[of][j]) & (r_copies[at] == 1)
                at = at[~alone]
                best, score = nearest(query, rows[at], r_ids[at], k)
                at = at[best]
                same = (r_ids[at] == ids[of][j]) & (r_kin[at] == kin[of][j])
                for col, x in zip(out, (np.full(len(at), j), r_ids[at], r_copies[at] - same, score), strict=True):
                    col.append(x)
            j, found, there, score = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in out)
            j = j.astype(np.int64)
            return pa.Table.from_arrays([pa.array(x) for x in (ids[of][j], kin[of][j], copies[of][j], found, there, score.astype(float))], ["query_id", "kin", "times", "vec_id", "copies", "score"])

        found = held.select(cols).unionByName(asked.select(cols)).groupBy("dim", "p", "q").applyInArrow(answer, NEAR)
        each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))))
        order = Window.partitionBy("query_id", "kin").orderBy("score", "vec_id", "copy")
        return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "kin", "times", "rank", "vec_id", "score")

    queries = base.where(asks)
    found = staged(answered(queries, True))
    full = found.groupBy(F.col("query_id").alias("vec_id"), "kin").agg(F.count("*").alias("n"))
    few = staged(queries.join(full, ["vec_id", "kin"], "left").where(F.coalesce("n", F.lit(0)) < F.least(F.lit(k), F.col("there") - 1)).drop("n"))
    if not few.isEmpty():
        rest = answered(few, False)
        found = found.join(few.select(F.col("vec_id").alias("query_id"), "kin"), ["query_id", "kin"], "left_anti").select(*rest.columns).unionByName(rest)
    return found.withColumn("time", F.explode(F.sequence(F.lit(1), "times"))).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]
