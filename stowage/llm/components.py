"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stowage.llm.shared import stored


def components(links: DataFrame, path: str) -> DataFrame:
    """For each node of ``links`` (``a``, ``b``, longs): ``id`` and ``component``, the smallest node it reaches.

    Each node takes the smallest label among its own and its neighbours', then, until none changes, the
    label of the node it is labelled by, so that paths halve. Nodes of one label become one, and the
    links that are left between labels go on, at most half the nodes with them; a star needs no second
    round. All are tables below ``path``. Nodes with many links are aggregated before the
    shuffle, and joins are between stored tables, which Spark can split.
    """
    links = stored(links.select("a", "b").filter("a <> b"), f"{path}/links0")
    n, found = 0, None
    while True:
        both = links.union(links.select("b", "a"))
        labels = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
        labels = _followed(stored(labels, f"{path}/least{n}"), f"{path}/labels{n}")
        next_of = labels.select(F.col("id").alias("via"), F.col("label").alias("then"))
        if found is None:
            found = labels
        else:
            there = found.join(next_of, F.col("label") == F.col("via"), "left").select("id", F.coalesce("then", "label").alias("label"))
            found = stored(there, f"{path}/found{n}")
        for end in "ab":
            links = links.join(next_of, F.col(end) == F.col("via")).withColumn(end, F.col("then")).drop("via", "then")
        n += 1
        links = stored(links.select("a", "b").filter("a <> b"), f"{path}/links{n}")
        if links.isEmpty():
            return found.select("id", F.col("label").alias("component"))


def _followed(labels: DataFrame, path: str) -> DataFrame:
    """Each node with the label at the end of its path of labels."""
    n, total = 0, _sum(labels)
    while True:
        next_of = labels.select(F.col("id").alias("via"), F.col("label").alias("then"))
        labels = stored(
            labels.join(next_of, F.col("label") == F.col("via")).select("id", F.col("then").alias("label")), f"{path}_{n}"
        )
        # Labels only fall: if their sum is what it was, all paths are at their ends.
        n, before, total = n + 1, total, _sum(labels)
        if total == before:
            return labels


def _sum(labels: DataFrame):
    return labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
