"""Best-fit packing of documents into bins of one length, without conflicts in a bin.

A bin never holds two documents of one source, nor two of one cluster of copies. Each
bin carries a bitmap of the sources and one of the clusters it holds. Bins are ordered by
the room left; for a document, longest first, the search starts at the tightest bin that
it fits and goes on to the next roomier one until there is no conflict. If none is left,
it opens a bin.

A document longer than a bin is cut into full bins and a rest, which is packed like a
document. Documents are dealt by a hash into shards of about ``SHARD_DOCS``, and each
shard is packed by itself: a shard is what a task holds. Equal rows are collapsed and numbered first,
and the number is part of the hash, so that they are dealt to all shards.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
SHARD_DOCS = 4096
WORDS = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, source string, n_words long, first_word long, length long, bin_id long, place int, bin_length long"


def content_cluster(docs: DataFrame) -> Column:
    """Texts that differ only in the case of A-Z and in white space are copies of one another."""
    text = F.translate(docs["text"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.xxhash64(F.trim(F.regexp_replace(text, r"[ \t\n\x0b\f\r]+", " ")))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, cluster: Column | None = None, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Pack all rows of ``docs`` (``doc_id``, ``text``, ``source``) by their number of words.

    One row per piece: ``doc_id``, ``source``, ``n_words`` of the document, ``first_word``
    and ``length`` of the piece, ``bin_id`` (numbers of different shards never meet),
    ``place`` in the bin from 0, and ``bin_length``, the words in it. ``cluster`` names
    a document's cluster of copies; by default copies are texts equal but for case and
    white space. A null source or null cluster conflicts with nothing. A null or empty text
    has one row with length 0 and no bin. Rows without an id and repeated rows are documents
    of their own; repeated rows are copies, so they never share a bin. Ties are broken by
    id, so reruns agree. An empty table gives no rows. Other columns are not read.
    """
    if capacity < 1:
        raise ValueError("capacity is at least 1")
    items = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        F.coalesce(F.regexp_count(docs["text"], F.lit(WORDS)), F.lit(0)).cast("long").alias("n_words"),
        (content_cluster(docs) if cluster is None else F.xxhash64(cluster)).alias("cluster"),
        (docs["text"] if cluster is None else cluster).isNotNull().alias("has_cluster"),
    )
    shards = max(1, -(-docs.count() // shard_docs))
    equal = items.groupBy(*items.columns).agg(F.count("*").alias("copies"))
    items = equal.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")
    items = items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "copy"), F.lit(shards)))

    def pack_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _pack_shard(key[0], rows, capacity)

    return items.groupBy("shard").applyInPandas(pack_shard, SCHEMA)


def best_fit(items: Iterable[tuple[int, int, int]], capacity: int) -> list[int]:
    """The bin of each item (length, source bit, cluster bit), in the order given.

    Bits are masks: a bin takes an item if it holds none of its bits; 0 never conflicts.
    An item equal to the one before goes on where that one's search ended, as all bins
    passed over conflict with it too.
    """
    order: list[tuple[int, int]] = []  # (room left, bin), by room
    sources: list[int] = []
    clusters: list[int] = []
    chosen = []
    last, resume = None, 0
    for length, source, cluster in items:
        same = (length, source, cluster) == last and bool(source or cluster)
        at = resume if same else bisect_left(order, (length, -1))
        last = (length, source, cluster)
        while at < len(order):
            b = order[at][1]
            if not (sources[b] & source or clusters[b] & cluster):
                break
            at += 1
        if at < len(order):
            room, b = order.pop(at)
            sources[b] |= source
            clusters[b] |= cluster
        else:
            room, b = capacity, len(sources)
            sources.append(source)
            clusters.append(cluster)
        resume = at
        if room > length:
            left = (room - length, b)
            resume += bisect_left(order, left) <= at
            insort(order, left)
        chosen.append(b)
    return chosen


def _bits(values: pd.Series, known: pd.Series, shared_only: bool) -> list[int]:
    """A bit for each value; 0 where there is none, or where no other item has the same."""
    codes, _ = pd.factorize(values.where(known), use_na_sentinel=True)
    if shared_only:
        counts = np.bincount(codes[codes >= 0], minlength=1)
        new = np.cumsum(counts > 1) - 1
        codes = np.array([new[c] if c >= 0 and counts[c] > 1 else -1 for c in codes], np.int64)
    return [1 << int(c) if c >= 0 else 0 for c in codes]


def _pack_shard(shard: int, rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    rest = rows["n_words"] % capacity
    full = rows["n_words"] // capacity
    rows = rows.assign(rest=rest, full=full)
    packed = rows[rows["rest"] > 0].sort_values(["rest", "doc_id", "cluster", "n_words", "source"], ascending=[False, True, True, True, True])
    bits = zip(packed["rest"].tolist(), _bits(packed["source"], packed["source"].notna(), False),
               _bits(packed["cluster"], packed["has_cluster"], True), strict=True)
    packed = packed.assign(bin=best_fit(bits, capacity), length=packed["rest"], first_word=packed["full"] * capacity)
    packed["place"] = packed.groupby("bin").cumcount()
    packed["bin_length"] = packed.groupby("bin")["length"].transform("sum")
    used = int(packed["bin"].max()) + 1 if len(packed) else 0

    long = rows[rows["full"] > 0].sort_values(["doc_id", "cluster", "n_words", "source"])
    whole = long.loc[long.index.repeat(long["full"])]
    whole = whole.assign(first_word=whole.groupby(level=0).cumcount() * capacity, length=capacity, place=0, bin_length=capacity,
                         bin=used + np.arange(len(whole)))
    none = rows[rows["n_words"] == 0].assign(first_word=0, length=0, place=None, bin_length=None, bin=None)

    out = pd.concat([part.astype({c: "Int64" for c in ("doc_id", "first_word", "length", "place", "bin_length", "bin")})
                     for part in (packed, whole, none)])
    out["bin_id"] = out["bin"] + (int(shard) << 40)
    return out[["doc_id", "source", "n_words", "first_word", "length", "bin_id", "place", "bin_length"]]
