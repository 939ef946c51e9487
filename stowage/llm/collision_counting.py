"""Near-duplicate embeddings by counting collisions of one-dimensional projections.

Unit vectors are projected on ``PROJECTIONS`` random lines. Two vectors collide on a line
if one lies in the window around the other, ``WINDOW`` times as wide as the spread that a
pair exactly at the threshold has there. A pair at the threshold collides on each line
with probability 0.866 (1.5 standard deviations), a pair at right angles with 0.31. Pairs
that collide on at least ``need`` lines are checked by their exact cosine; ``need`` is the
largest count that a pair at the threshold falls short of with probability ``MISS``.

Equal vectors of a label are one class, and only classes are compared. A label's classes
are dealt into blocks by hash; a task compares two blocks. On each line it sorts one
block, finds each vector's window there, and counts. It gives no pairs: for each vector
its number of links, and of the links a forest that joins the same vectors.

The work grows with the square of a label's distinct vectors; memory does not.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stowage.llm.components import components
from stowage.llm.shared import scratch_root, stored
from stowage.llm.vectors import matrices, unpack

THRESHOLD = 0.93
PROJECTIONS = 32
WINDOW = 1.5
WITHIN = 0.8664  # of a normal distribution within 1.5 standard deviations
MISS = 1e-6
SEED = 11
BLOCK_ROWS = 1024


def needed(projections: int = PROJECTIONS, within: float = WITHIN, miss: float = MISS) -> int:
    """The most collisions that pairs at the threshold fall short of with probability ``miss`` at most."""
    below = 0.0
    for n in range(projections + 1):
        below += comb(projections, n) * within**n * (1 - within) ** (projections - n)
        if below > miss:
            return n
    return projections


def lines(dim: int, projections: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, projections))


def collisions(a: np.ndarray, b: np.ndarray, half: float) -> np.ndarray:
    """For each row of ``a`` and of ``b``, projected: on how many lines they collide."""
    counts = np.zeros((len(a), len(b)), np.uint8)
    for line in range(a.shape[1]):
        order = np.argsort(b[:, line], kind="stable")
        values = b[order, line]
        place = np.empty(len(b), np.int32)
        place[order] = np.arange(len(b), dtype=np.int32)
        low = np.searchsorted(values, a[:, line] - half, "left").astype(np.int32)
        high = np.searchsorted(values, a[:, line] + half, "right").astype(np.int32)
        counts += (place >= low[:, None]) & (place < high[:, None])
    return counts


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links of every row of ``vectors`` (``vec_id``, ``embedding``, ``label``).

    Vectors of one label link if their cosine, in double precision, is ``threshold`` or
    more. One row per input row: ``vec_id``; ``n_links``, other rows it links with
    directly; ``component_id``, the smallest id reached by links, its own included;
    ``kept``, whether that is its own. Links of copies are counted, not listed. A row
    with a null label, or a vector that is null, empty, zero or holds nulls or non-finite
    numbers, links with nothing. Vectors of different lengths do not link. Rows that
    repeat an id link like other rows, and their components are one. A row without an id
    links with nothing and has a null component; it is kept. An empty table gives no
    rows. Labels may be of any type that can be grouped, and are compared as they are. Other
    columns are not read.
    """
    scratch = scratch_root(vectors.sparkSession)
    half, need = WINDOW * sqrt(2 - 2 * threshold), needed()
    rows = stored(_usable(vectors), f"{scratch}/rows")
    same = ["label", "key1", "key2"]
    classes = stored(rows.groupBy(*same).agg(F.min("vec_id").alias("id"), F.count("*").alias("n")), f"{scratch}/classes")
    of = classes.select(*[F.col(c).alias(f"of_{c}") for c in same], "id", "n")
    alike = (F.col("vec_id") == F.col("id")) & (F.col("label") == F.col("of_label")) \
        & (F.col("key1") == F.col("of_key1")) & (F.col("key2") == F.col("of_key2"))
    heads = stored(
        rows.join(of, alike).dropDuplicates(["id", "of_label", "of_key1", "of_key2"]).select("id", "n", "label", "dim", "vector"),
        f"{scratch}/heads",
    )
    sizes = stored(
        heads.groupBy("label", "dim").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")), f"{scratch}/sizes"
    )
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = (
        heads.join(sizes, ["label", "dim"]).withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
        .select("label", "dim", "low", "high", "block", "id", "n", "vector")
    )

    def compare(table: pa.Table) -> pa.Table:
        return _compare(table, threshold, half, need)

    found = stored(dealt.groupBy("label", "dim", "low", "high").applyInArrow(compare, f"a long, b long, links long, label {_label_type(vectors)}"), f"{scratch}/found")
    direct = found.filter("b IS NULL").groupBy(F.col("a").alias("id"), "label").agg(F.sum("links").alias("links"))
    named = stored(
        rows.select("vec_id", *same).join(classes, same).select("vec_id", "label", "id", "n"), f"{scratch}/named"
    )
    ids = named.groupBy("vec_id").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    several = named.join(ids.filter("low < high").select("vec_id"), "vec_id", "left_semi").select(F.col("vec_id").alias("a"), F.col("id").alias("b"))
    joined = stored(found.filter("b IS NOT NULL").select("a", "b").union(several), f"{scratch}/joined")
    groups = components(joined, f"{scratch}/components")
    per_class = stored(
        classes.select("id", "label", "n").distinct().join(direct, ["id", "label"], "left")
        .join(groups.withColumnRenamed("id", "node"), F.col("id") == F.col("node"), "left")
        .select("id", "label", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")),
        f"{scratch}/per_class",
    )
    linked = named.join(per_class, ["id", "label"]).select("vec_id", "n_links", "component_id")
    alone = _unusable(vectors).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _slim(vectors: DataFrame) -> DataFrame:
    return vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"], vectors["embedding"])


def _label_type(vectors: DataFrame) -> str:
    return vectors.schema["label"].dataType.simpleString()


def _usable(vectors: DataFrame) -> DataFrame:
    def usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in matrices(batch.column("embedding")):
                part = batch.take(pa.array(rows))
                yield pa.record_batch({
                    "vec_id": part.column("vec_id"), "label": part.column("label"),
                    "dim": pa.array(np.full(len(rows), x.shape[1]), pa.int32()),
                    "vector": pa.array([(v + 0.0).tobytes() for v in x], pa.binary()),
                })

    good = _slim(vectors).filter("vec_id IS NOT NULL AND label IS NOT NULL")
    return good.mapInArrow(usable, f"vec_id long, label {_label_type(vectors)}, dim int, vector binary").withColumns({
        "key1": F.xxhash64("vector"), "key2": F.xxhash64(F.lit(SEED), "vector"),
    })


def _unusable(vectors: DataFrame) -> DataFrame:
    def unusable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = np.ones(batch.num_rows, bool)
            for rows, _ in matrices(batch.column("embedding")):
                bad[rows] = False
            nameless = batch.column("vec_id").is_null().to_numpy(zero_copy_only=False) | batch.column("label").is_null().to_numpy(zero_copy_only=False)
            yield batch.select(["vec_id"]).filter(pa.array(bad | nameless))

    return _slim(vectors).mapInArrow(unusable, "vec_id long")


def _compare(table: pa.Table, threshold: float, half: float, need: int) -> pa.Table:
    """Of the links between two blocks, or within one: each vector's number, and a forest."""
    of = table["block"].to_numpy()
    first = of == table["low"][0].as_py()
    within = table["low"][0].as_py() == table["high"][0].as_py()
    ids, times, x = table["id"].to_numpy(), table["n"].to_numpy(), unpack(table["vector"])
    x = x / np.sqrt((x * x).sum(1))[:, None]
    p = x @ lines(x.shape[1])
    left = np.flatnonzero(first)
    right = left if within else np.flatnonzero(~first)
    links = np.zeros(len(ids), np.int64)
    parent = np.arange(len(ids))
    forest: list[tuple[int, int]] = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for at in range(0, len(left), 256):
        some = left[at : at + 256]
        i, j = np.nonzero(collisions(p[some], p[right], half) >= need)
        i, j = some[i], right[j]
        if within:
            i, j = i[i < j], j[i < j]
        good = np.einsum("ij,ij->i", x[i], x[j]) >= threshold
        i, j = i[good], j[good]
        np.add.at(links, i, times[j])
        np.add.at(links, j, times[i])
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[rb] = ra
                forest.append((a, b))
    some = np.flatnonzero(links)
    a = np.concatenate([ids[some], ids[[e[0] for e in forest]]]) if forest else ids[some]
    b = pa.array([None] * len(some) + [int(ids[e[1]]) for e in forest], pa.int64())
    count = np.concatenate([links[some], np.zeros(len(forest), np.int64)])
    return pa.table({"a": pa.array(a, pa.int64()), "b": b, "links": pa.array(count),
                     "label": table["label"].take(pa.array(np.zeros(len(a), np.int64)))})
