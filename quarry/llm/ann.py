"""Approximate nearest neighbours by cross-polytope hashing.

Each table turns unit vectors by a fast pseudo-rotation (three rounds of
random signs and a Hadamard transform) and stores a vector under the nearest
signed axis.  A query looks, in each table, under the axes nearest to it: PROBES,
or an eighth of all axes if that is more.  What lies there is ranked exactly,
by cosine in double precision on the original vectors.  A query that is left
with fewer than k and its own id, and fewer than its length has, is compared
with all vectors of its length.

A bucket's points and queries are cut into pieces of bounded size by a hash
of their id, and each pair of pieces is one group of matrix products, so a
bucket that holds a third of all rows is shared by many tasks.  Vectors that
occur many times are indexed by their k + 1 smallest ids, which is all that a
ranking with ties to the smaller id can return; queries with equal vectors are
searched once.

Edge cases: rows with a null id, and vectors that are null, empty, zero or
hold null or non-finite components take no part; vectors are compared with
vectors of their length only; repeated rows count once; a query with fewer
candidates returns those; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage

TABLES = 8
PROBES = 16
#: Points or queries of a bucket compared in one group.
PIECE = 4096
SEED = 7
_ROUNDS = 3


def _signs(table: int, width: int) -> np.ndarray:
    return np.random.default_rng([SEED, table, width]).choice([-1.0, 1.0], (_ROUNDS, width))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row; the width is a power of two."""
    width, h = x.shape[1], 1
    while h < width:
        x = x.reshape(len(x), width // (2 * h), 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(len(x), width)
        h *= 2
    return x / np.sqrt(width)


def rotate(unit: np.ndarray, table: int) -> np.ndarray:
    """A table's pseudo-rotation of unit vectors, padded to a power of two."""
    width = 1 << max(1, (unit.shape[1] - 1).bit_length())
    x = np.zeros((len(unit), width))
    x[:, : unit.shape[1]] = unit
    for s in _signs(table, width):
        x = hadamard(x * s)
    return x


def matrix(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """For a list column: the lengths, and each row as doubles (nulls as NaN)."""
    size = np.asarray(pc.fill_null(pc.list_value_length(column), 0), dtype=np.int64)
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    return size, flat


def usable(embedding: str = "embedding"):
    """Whether a vector takes part: it has components, all finite, not all zero."""
    e = F.col(embedding)
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return e.isNotNull() & (F.size(e) > 0) & F.forall(e, fine) & F.exists(e, lambda x: x != 0)


def _hasher(name: str, probes: int | None, tables: int):
    """A row for each table (and probe): bucket, id, vector. Without a number
    of probes it follows the dimension."""
    def run(batches):
        for whole in batches:
            for lo in range(0, len(whole), 1024):
                b = whole.slice(lo, 1024)
                column = b.column("embedding")
                size, flat = matrix(column)
                first = np.cumsum(size) - size
                for d in np.unique(size):
                    rows = np.flatnonzero(size == d)
                    x = flat[first[rows][:, None] + np.arange(d)]
                    x = x / np.abs(x).max(axis=1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    for t in range(tables):
                        y = rotate(x, t)
                        both = np.concatenate([y, -y], axis=1)
                        n = min(max(PROBES, both.shape[1] // 8) if probes is None else probes, both.shape[1])
                        axis = np.argsort(-both, axis=1, kind="stable")[:, :n] if n > 1 else both.argmax(axis=1)[:, None]
                        bucket = (int(d) << 32) | (t << 24) | axis
                        take = pa.array(np.repeat(rows, n))
                        yield pa.RecordBatch.from_arrays([pa.array(bucket.ravel().astype(np.int64)), b.column(name).take(take),
                                                          column.take(take)], ["bucket", name, "embedding"])
    return run


def _ranker(k: int):
    """Best k points of a group for each query, scored exactly."""
    def vectors(t: pa.Table):
        column = t.column("embedding").combine_chunks()
        size, flat = matrix(column)
        return flat.reshape(len(size), -1)

    def run(queries: pa.Table, points: pa.Table) -> pa.Table:
        out = [[], [], []]
        if queries.num_rows and points.num_rows:
            q, p = vectors(queries), vectors(points)
            qid, pid = np.asarray(queries.column("query")), np.asarray(points.column("vec_id"))
            # scaled by the largest component first, so that squares stay finite
            qs, ps = q / np.abs(q).max(axis=1, keepdims=True), p / np.abs(p).max(axis=1, keepdims=True)
            qn, pn = np.sqrt((qs * qs).sum(axis=1)), np.sqrt((ps * ps).sum(axis=1))
            qu, pu = qs / qn[:, None], ps / pn[:, None]
            for lo in range(0, len(q), 256):
                s = qu[lo : lo + 256] @ pu.T
                n = min(k, s.shape[1])
                least = -np.partition(-s, n - 1, axis=1)[:, n - 1 : n]
                r, c = np.nonzero(s >= least - 1e-9)
                exact = (qs[lo + r] * ps[c]).sum(axis=1) / (qn[lo + r] * pn[c])
                order = np.lexsort((pid[c], -exact, r))
                r, c, exact = r[order], c[order], exact[order]
                place = np.arange(len(r)) - np.searchsorted(r, r)
                keep = place < k
                for x, v in zip(out, (qid[lo + r[keep]], pid[c[keep]], exact[keep]), strict=True):
                    x.append(v)
        arrays = [np.concatenate(x) if x else np.zeros(0, kind) for x, kind in zip(out, (np.int64, np.int64, float), strict=True)]
        return pa.Table.from_arrays([pa.array(a) for a in arrays], ["query", "vec_id", "score"])
    return run


def _pieces(rows: DataFrame, name: str, own: str, other: str, sizes: DataFrame) -> DataFrame:
    """Deal a bucket's rows to its pieces, once for each piece of the other side."""
    d = rows.join(sizes, "bucket")
    d = d.withColumn(own, F.pmod(F.xxhash64(name), F.col(f"n_{own}")).cast("int"))
    return d.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1))).drop("n_points", "n_queries")


def _completed(found: DataFrame, classes: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """`found`, with the exact k best for queries that have fewer than k and
    than there are ids with vectors of their length."""
    length = F.size("embedding").cast("long").alias("bucket")
    have = found.groupBy("query").agg(F.count("*").alias("have"))
    there = cut_lineage(index.select("vec_id", length).groupBy("bucket").agg(F.countDistinct("vec_id").alias("there"), F.count("*").alias("p")))
    short = classes.select("query", "embedding", length).join(have, "query", "left").join(there, "bucket")
    short = cut_lineage(short.where(F.coalesce("have", F.lit(0)) < F.least(F.lit(k), "there")).select("bucket", "query", "embedding"))
    if short.isEmpty():
        return found
    sizes = cut_lineage(short.groupBy("bucket").agg(F.count("*").alias("q")).join(there, "bucket").select(
        "bucket", F.ceil(F.col("p") / PIECE).cast("int").alias("n_points"), F.ceil(F.col("q") / PIECE).cast("int").alias("n_queries")))
    left = _pieces(short, "query", "queries", "points", sizes).groupBy("bucket", "queries", "points")
    right = _pieces(index.select(length, "vec_id", "embedding"), "vec_id", "points", "queries", sizes).groupBy("bucket", "queries", "points")
    exact = left.cogroup(right).applyInArrow(_ranker(k), "query long, vec_id long, score double")
    exact = exact.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    exact = exact.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k).drop("_n")
    return cut_lineage(found.join(short.select("query"), "query", "left_anti").unionByName(exact))


def nearest(vectors: DataFrame, is_query, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
            tables: int = TABLES, probes: int | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest found for
    each row that the condition `is_query` (over vec_id) admits, its own id left out."""
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable())
    by_vector = Window.partitionBy("embedding").orderBy("vec_id")
    index = (rows.dropDuplicates(["vec_id", "embedding"]).withColumn("_n", F.row_number().over(by_vector))
             .where(F.col("_n") <= k + 1).drop("_n"))
    asked = rows.where(is_query).dropDuplicates(["vec_id", "embedding"])
    classes = cut_lineage(asked.groupBy("embedding").agg(F.min("vec_id").alias("query")).select("query", "embedding"))
    kind = rows.schema["embedding"].dataType.simpleString()
    points = index.mapInArrow(_hasher("vec_id", 1, tables), f"bucket long, vec_id long, embedding {kind}")
    probing = classes.mapInArrow(_hasher("query", probes, tables), f"bucket long, query long, embedding {kind}")
    counts = points.groupBy("bucket").agg(F.count("*").alias("p")).join(probing.groupBy("bucket").agg(F.count("*").alias("q")), "bucket")
    # one row per bucket: at most two per dimension and table
    sizes = cut_lineage(counts.select("bucket", F.ceil(F.col("p") / PIECE).cast("int").alias("n_points"),
                                      F.ceil(F.col("q") / PIECE).cast("int").alias("n_queries")))
    small = F.broadcast(sizes) if sizes.count() <= 100_000 else sizes
    left = _pieces(probing, "query", "queries", "points", small).groupBy("bucket", "queries", "points")
    right = _pieces(points, "vec_id", "points", "queries", small).groupBy("bucket", "queries", "points")
    found = left.cogroup(right).applyInArrow(_ranker(k + 1), "query long, vec_id long, score double")
    found = found.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    found = cut_lineage(found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).drop("_n"))
    found = _completed(found, classes, index, k + 1)
    # back to every query row: its class's list without itself
    names = classes.select(F.col("embedding").alias("_e"), F.col("query"))
    each = asked.join(names, asked["embedding"] == names["_e"]).select(F.col("vec_id").alias("query_id"), "query")
    own = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    listed = each.join(found, "query").where("query_id != vec_id").withColumn("rank", F.row_number().over(own))
    return listed.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
