"""Approximate nearest neighbours by cross-polytope hashing.

A table turns unit vectors by a fast pseudo-rotation, three times random signs and a
Hadamard transform, and hashes each to the nearest of the signed axes: a bucket. Near
vectors share a bucket in some of the ``TABLES`` tables. A query probes, in each table,
the ``PROBES`` buckets whose axes are nearest to it, and all vectors in these are ranked
by their exact inner product.

Every vector is in a bucket of every table. Buckets are dealt into blocks of rows, and a
bucket's queries into chunks, so a bucket of any size is searched by many tasks, each of
which holds one block and one chunk. A task gives the k best of each of its queries.
Queries for which the probed buckets held fewer than k vectors are compared with all.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stowage.llm.shared import scratch_root, stored
from stowage.llm.vectors import matrices, unpack

TABLES = 16
PROBES = 12
SEED = 7
BLOCK_ROWS = 4096
FOUND = "query_id long, vec_id long, score double"


@lru_cache(maxsize=64)
def _signs(seed: int, table: int, width: int) -> np.ndarray:
    return np.random.default_rng([seed, table, width]).choice(np.array([-1.0, 1.0]), (3, width))


def rotate(x: np.ndarray, table: int, seed: int = SEED) -> np.ndarray:
    """Pseudo-random rotation of the rows of ``x``, padded with zeros to a power of two."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    y = np.zeros((len(x), width))
    y[:, : x.shape[1]] = x
    for signs in _signs(seed, table, width):
        y *= signs
        half = 1
        while half < width:  # the fast Hadamard transform, in place
            pairs = y.reshape(len(y), -1, 2, half)
            low, high = pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]
            pairs[:, :, 0], pairs[:, :, 1] = low, high
            half *= 2
        y /= np.sqrt(width)
    return y


def axes(x: np.ndarray, table: int, n: int, seed: int = SEED) -> np.ndarray:
    """The ``n`` nearest signed axes of each row of ``x`` once rotated, nearest first."""
    y = rotate(x, table, seed)
    both = np.hstack([y, -y])
    n = min(n, both.shape[1])
    return np.argsort(-both, axis=1, kind="stable")[:, :n]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """The ``k`` rows of ``vectors`` nearest to each of ``queries``, by inner product.

    Both have ``vec_id`` and ``embedding`` (an array of numbers). One row per query and
    neighbour: ``query_id``, ``rank`` from 1, ``vec_id``, ``score`` (the inner product in
    double precision), nearest first, ties to the smaller ``vec_id``. A query's own id is
    no neighbour of it. Vectors that are null, empty, zero, hold nulls or non-finite
    numbers, or have no id take no part; vectors of different lengths never meet. Rows
    that repeat an id are versions of one vector, and the nearest version counts. A query
    with fewer than ``k`` candidates gets all. Empty tables give no rows. Other columns are
    not read.
    """
    scratch = scratch_root(vectors.sparkSession)
    rows = stored(_hashed(vectors, tables, 1), f"{scratch}/rows")
    asks = stored(_hashed(queries, tables, probes), f"{scratch}/asks")
    bucket = ["dim", "table", "bucket"]
    blocks = rows.groupBy(*bucket).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    chunks = asks.groupBy(*bucket).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("chunks"))
    plan = stored(blocks.join(chunks, bucket), f"{scratch}/plan")
    found = stored(_best(_search(rows, asks, plan, bucket, k), k), f"{scratch}/found")

    # What probing left short is compared with all vectors of the same length.
    whole = rows.filter("table = 0").withColumn("bucket", F.lit(0))
    each = asks.filter("table = 0 AND nearest")
    there = whole.groupBy("dim").agg(F.count_distinct("vec_id").alias("there"))
    got = found.groupBy("query_id").agg(F.count("*").alias("got"))
    short = stored(
        each.join(there, "dim").join(got, each["vec_id"] == got["query_id"], "left")
        .filter(F.coalesce("got", F.lit(0)) < F.least(F.lit(k), F.col("there") - 1))
        .select(each["*"]).withColumn("bucket", F.lit(0)), f"{scratch}/short",
    )
    if not short.isEmpty():
        every = whole.groupBy(*bucket).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
        chunks = short.groupBy(*bucket).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("chunks"))
        plan = stored(every.join(chunks, bucket), f"{scratch}/short_plan")
        found = _best(found.select("query_id", "vec_id", "score").unionByName(_search(whole, short, plan, bucket, k)), k)
    return found.select("query_id", "rank", "vec_id", "score")


def _hashed(vectors: DataFrame, tables: int, probes: int) -> DataFrame:
    """A row for each usable vector, table and probed bucket. ``nearest``: the first probe."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                for rows, x in matrices(part.column("embedding")):
                    ids = np.array(part.column("vec_id").cast(pa.int64()))[rows]
                    unit = x / np.sqrt((x * x).sum(1))[:, None]
                    payload = np.array([v.tobytes() for v in x], object)
                    for table in range(tables):
                        near = axes(unit, table, probes)
                        n = near.shape[1]
                        yield pa.record_batch({
                            "dim": pa.array(np.full(near.size, x.shape[1]), pa.int32()),
                            "table": pa.array(np.full(near.size, table), pa.int32()),
                            "bucket": pa.array(near.ravel(), pa.int32()),
                            "nearest": pa.array(np.arange(near.size) % n == 0),
                            "vec_id": pa.array(np.repeat(ids, n)),
                            "vector": pa.array(np.repeat(payload, n), pa.binary()),
                        })

    return vectors.filter("vec_id IS NOT NULL").select("vec_id", "embedding").mapInArrow(
        hashed, "dim int, table int, bucket int, nearest boolean, vec_id long, vector binary")


def _search(rows: DataFrame, asks: DataFrame, plan: DataFrame, bucket: list[str], k: int) -> DataFrame:
    """The ``k`` best of each query in each block of the buckets that it probes."""
    def dealt(side: DataFrame, own: str, of_own: str, other: str, of_other: str) -> DataFrame:
        """Each row in its own part, for every part of the other side."""
        return (
            side.join(plan, bucket)
            .withColumn(own, F.pmod(F.xxhash64("vec_id"), F.col(of_own)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(of_other) - 1)))
            .select(*bucket, "block", "chunk", "vec_id", "vector")
        )

    key = [*bucket, "block", "chunk"]

    def search(table: pa.Table, queries: pa.Table) -> pa.Table:
        none = {"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)}
        if not table.num_rows or not queries.num_rows:
            return pa.table(none)
        ids = table["vec_id"].to_numpy()
        x, y = unpack(table["vector"]), unpack(queries["vector"])
        asked = queries["vec_id"].to_numpy()
        out = [none]
        for at in range(0, len(y), 256):
            scores = y[at : at + 256] @ x.T
            for q, s in zip(asked[at : at + 256], scores, strict=True):
                can = np.flatnonzero(ids != q)
                if len(can) > k:
                    last = np.partition(s[can], len(can) - k)[len(can) - k]
                    can = can[s[can] >= last]
                can = can[np.lexsort((ids[can], -s[can]))[:k]]
                out.append({"query_id": np.full(len(can), q), "vec_id": ids[can], "score": s[can]})
        return pa.table({c: np.concatenate([part[c] for part in out]) for c in none})

    left = dealt(rows, "block", "blocks", "chunk", "chunks").groupBy(*key)
    right = dealt(asks, "chunk", "chunks", "block", "blocks").groupBy(*key)
    return left.cogroup(right).applyInArrow(search, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    distinct = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return distinct.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
