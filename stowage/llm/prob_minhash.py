"""Near-duplicate documents by ProbMinHash.

A document is the weighted set of its shingles of five words, A-Z made lower case. In a
sketch, each shingle with weight w sends arrivals of a Poisson process of rate w, each to
a random one of ``REGISTERS`` registers, all drawn from the shingle's hash; a register
keeps the earliest arrival. A shingle stops once its next arrival is later than the
latest register holds. Two sketches agree in a register with a probability that is the
probability Jaccard similarity of the two weighted sets.

Two similarities count, and a link needs 0.8 in either: that with shingles weighted by
how often they stand in the document, and that with all weights 1, which is the Jaccard
similarity of the two sets. A document without repeated shingles has one sketch for both.

1. Documents with the same words are one *class*; only classes go on.
2. Sketches are cut into ``BANDS`` bands; classes that agree in a band share a bucket. A bucket's
   *centre* is its smallest class.
3. Rounds of contraction. In each, a class has one candidate at most: the smallest centre of
   its buckets that is of another component and that it has not met. Pairs are compared by the registers'
   agreement, which rules out those more than five standard errors too low, then exactly, on all
   shingles; linked classes become one component. A centre's text is sent once for each
   ``CHUNK_BYTES`` of its members' texts.
4. Buckets that are still of several components join these to a *family*. A family of
   one block is compared there through an index of its shingles. In a larger one, such as pages of one template
   make, prefixes come first: of a class's shingles in the order of their number, rare ones before,
   those at the beginning that make up the share that a linked class may lack. That is 1 - t for a threshold
   of t, and 1 - 2t/(1 + t) for that of the two that lacks less. Linked
   classes have a shingle of their prefixes in common, so only classes that share one across components stay, in
   families that these make anew. Their largest component stands still, the others
   are compared with all of it, block by block. No pairs are written, only links that join components.

So texts move once in a round and once for the blocks, but for families that prefixes leave larger
than a block: those outside a family's largest component move once for each of its blocks.

In a block, ``bounds`` rules out most pairs with repeated shingles that are no link, and pairs that links
already join are not compared.

A pair of similarity 0.8 shares no band with probability 7e-5, of 0.9 with 2e-9; of 0.7 with 0.012.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stowage.llm.components import components
from stowage.llm.shared import free_names, scratch_root, stored
from stowage.llm.text import ODD, STEP, join_hashes, mix, slices, space_words, text_buffer, windows

SHINGLE = 5
THRESHOLD = 0.8
REGISTERS = 120
BANDS = 24
ROUNDS = 3
#: Rows of a family, and bytes of their texts, that are compared with as many at a time.
BLOCK_ROWS = 1024
BLOCK_BYTES = 16 << 20
#: Texts that are compared with one centre in one task.
CHUNK_BYTES = 8 << 20
KEYS = "doc_id long, class1 long, class2 long, bands array<long>, sketch binary, size long"


class Shingles:
    """The weighted shingle sets of a column of texts, ordered by row, then by hash.

    A text of fewer words than a shingle has one, of all its words.
    """

    def __init__(self, texts: pa.Array | pa.ChunkedArray, size: int = SHINGLE):
        words = space_words(texts, lower=True)
        self.words = words
        h = words.hashes()
        self.word_hashes = h
        five = windows(h, size)
        rows = words.rows[: len(five)]
        inside = np.flatnonzero(rows == words.rows[size - 1 :]) if len(five) else np.zeros(0, np.int64)
        hashes, rows = five[inside], rows[inside]
        short = np.flatnonzero((words.counts > 0) & (words.counts < size))
        if len(short):
            whole = []
            for row in short:
                of = h[words.of_row(row)]
                one = of[:1]
                for k in range(1, len(of)):
                    one = join_hashes(one, of[k : k + 1])
                whole.append(mix(one + np.uint64(len(of)))[0])
            hashes = np.concatenate([hashes, np.array(whole, np.uint64)])
            rows = np.concatenate([rows, short])
        order = np.lexsort((hashes, rows))
        hashes, rows = hashes[order], rows[order]
        first = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])])) if len(hashes) else np.zeros(0, np.int64)
        self.weights = np.diff(np.append(first, len(hashes)))
        self.hashes, self.rows = hashes[first], rows[first]
        self.bounds = np.searchsorted(self.rows, np.arange(len(words.counts) + 1))

    def of_row(self, row: int) -> slice:
        return slice(self.bounds[row], self.bounds[row + 1])

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that name each text's sequence of words."""
        words = self.words
        place = (np.arange(len(words)) - np.repeat(words.bounds[:-1], words.counts)).astype(np.uint64)
        out = []
        for salt in (ODD, STEP):
            total = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(mix(self.word_hashes ^ mix(place * ODD + salt)), out=total[1:])
            out.append(mix(total[words.bounds[1:]] - total[words.bounds[:-1]] + words.counts.astype(np.uint64)).view(np.int64))
        return out[0], out[1]


def sketch(rows: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n_rows: int, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash of each row's weighted set: the hash of the earliest arrival of each register.

    All shingles of all rows take their i-th arrival together, as long as it can count.
    """
    earliest = np.full(n_rows * registers, np.inf)
    held = np.zeros(n_rows * registers, np.uint64)
    latest = np.full(n_rows, np.inf)
    live = np.arange(len(rows))
    at = np.zeros(len(rows))
    n = 0
    while len(live):
        n += 1
        draw = mix(hashes[live] + np.uint64(n * int(ODD) % 2**64))
        at[live] -= np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights[live]
        counts = at[live] < latest[rows[live]]
        live, draw = live[counts], draw[counts]
        slot = rows[live] * registers + (mix(draw ^ STEP) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(earliest, slot, at[live])
        won = earliest[slot] == at[live]
        held[slot[won]] = hashes[live[won]]
        some = np.unique(rows[live])
        latest[some] = earliest.reshape(n_rows, registers)[some].max(1)
    return held.reshape(n_rows, registers)


def band_keys(held: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A key for each band of each sketch; bands never share a key by design."""
    parts = held.reshape(len(held), bands, -1)
    key = np.tile(mix(np.arange(bands).astype(np.uint64) + ODD), (len(held), 1))
    for k in range(parts.shape[2]):
        key = join_hashes(key, parts[:, :, k])
    return key.view(np.int64)


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Exact probability Jaccard similarity of two weighted sets, each ordered by hash."""
    union = np.union1d(a, b)
    wide_a, wide_b = np.zeros(len(union)), np.zeros(len(union))
    wide_a[np.searchsorted(union, a)] = wa
    wide_b[np.searchsorted(union, b)] = wb
    both = (wide_a > 0) & (wide_b > 0)
    ratios, of = np.unique(wide_b[both] / wide_a[both], return_inverse=True)
    total = sum(wide_a[both][of == k].sum() / np.maximum(wide_a, wide_b / r).sum() for k, r in enumerate(ratios))
    return float(total)


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray, enough: float = 1.0) -> float:
    """The larger of the two similarities of two weighted sets; the plain one if that is ``enough``."""
    if not len(a) or not len(b):
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    plain = common / (len(a) + len(b) - common)
    if plain >= enough or (wa.max() == 1 and wb.max() == 1):
        return plain
    return max(plain, probability_jaccard(a, wa, b, wb))


def bounds(mine: np.ndarray, other: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Upper bounds of one weighted set's probability Jaccard similarity with the sets of ``rows``.

    For each shingle that the set has in common with a row: its share ``mine`` of the one, ``other`` of the row's.
    A shingle of shares p and q counts 1 / sum max(p_y / p, q_y / q), over all shingles y. With u and v for what
    the two lack of each other that sum is at least 1 / p + v / q, and 1 / q + u / p. The bound is
    exact if the shares in common have one ratio, and never above the sum of min(p, q).
    """
    u = 1 - np.bincount(rows, mine, n_rows)[rows]
    v = 1 - np.bincount(rows, other, n_rows)[rows]
    return np.bincount(rows, 1 / np.maximum(1 / mine + v / other, 1 / other + u / mine), n_rows)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, shingle: int = SHINGLE) -> DataFrame:
    """The group of near copies of every row of ``docs`` (``doc_id``, ``text``).

    One row per input row: ``doc_id``; ``exact_id``, the smallest id of a document with
    the same words; ``class_id``, the smallest id reached by links; ``kept``, whether the
    row's id is ``class_id``. Texts that are null, empty or all white space link with
    nothing: each is its own class. Rows of one id are one document and their groups
    are one. Rows without an id link with nothing, have null ids and are kept. An empty
    table gives no rows. Other columns are not read. Texts are read whole; a worker holds
    some MB of them, or one that is longer. ``bands`` divides ``REGISTERS``.
    """
    if REGISTERS % bands:
        raise ValueError(f"{bands} bands do not divide {REGISTERS} registers")
    spark = docs.sparkSession
    scratch = scratch_root(spark)
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sketches(batches, bands, shingle)

    keys = stored(docs.filter("doc_id IS NOT NULL").mapInArrow(sketches, KEYS), f"{scratch}/keys")
    classes = stored(
        keys.filter("bands IS NOT NULL").groupBy("class1", "class2").agg(F.min("doc_id").alias("id")), f"{scratch}/classes"
    )
    links = _Search(threshold, shingle, scratch).links(docs, keys, classes)
    # Ids that stand in several classes (repeated ids) join those classes' groups.
    named = stored(
        keys.select("doc_id", "class1", "class2", F.col("bands").isNull().alias("blank"))
        .join(classes, ["class1", "class2"], "left")
        .select("doc_id", F.when(~F.col("blank"), F.col("id")).alias("id")),
        f"{scratch}/named",
    )
    several = named.groupBy("doc_id").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high")
    repeats = named.join(several.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    final = components(links.union(repeats.filter("b IS NOT NULL")), f"{scratch}/final")
    exact = F.coalesce("id", "doc_id")
    found = (
        named.select("doc_id", exact.alias("exact_id"))
        .join(final.withColumnRenamed("id", "of"), F.col("exact_id") == F.col("of"), "left")
        .select("doc_id", "exact_id", F.coalesce("component", "exact_id").alias("class_id"))
        .withColumn("kept", F.col("doc_id") == F.col("class_id"))
    )
    none = F.lit(None).cast("long")
    return found.unionByName(
        docs.filter("doc_id IS NULL").select("doc_id", none.alias("exact_id"), none.alias("class_id"), F.lit(True).alias("kept"))
    )


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, shingle: int = SHINGLE) -> DataFrame:
    """One row of each group of near copies, that with the smallest id, with all columns, whatever their names.

    ``near_duplicates`` has the rules; of rows that repeat an id one stays.
    """
    (name,) = free_names(docs, "kept")
    kept = near_duplicates(docs, threshold, bands, shingle).filter("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias(name))
    with_id = docs.join(kept.distinct().hint("merge"), docs["doc_id"].cast("long") == F.col(name)).dropDuplicates([name]).drop(name)
    return with_id.unionByName(docs.filter(docs["doc_id"].isNull()))


def _sketches(batches: Iterator[pa.RecordBatch], n_bands: int, shingle: int) -> Iterator[pa.RecordBatch]:
    """Rows of KEYS. A text without words has no bands and no sketch."""
    for batch in slices(batches, "text", 1 << 20):
        s = Shingles(batch.column("text"), shingle)
        n = batch.num_rows
        plain = sketch(s.rows, s.hashes, np.ones(len(s.rows)), n)
        counted = plain.copy()
        repeats = np.zeros(n, bool)
        repeats[s.rows[s.weights > 1]] = True
        some = np.flatnonzero(repeats[s.rows])
        if len(some):
            new = np.cumsum(repeats) - 1
            counted[repeats] = sketch(new[s.rows[some]], s.hashes[some], s.weights[some].astype(float), int(repeats.sum()))
        blank = s.words.counts == 0
        keys = np.hstack([band_keys(plain, n_bands), band_keys(counted, n_bands)])
        bands = [None if blank[r] else np.unique(keys[r]) for r in range(n)]
        prints = np.hstack([plain, counted]).view(np.uint8).reshape(n, -1, 8)[:, :, 0]
        class1, class2 = s.classes()
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"),
            "class1": pa.array(class1),
            "class2": pa.array(class2),
            "bands": pa.array(bands, pa.list_(pa.int64())),
            "sketch": pa.array([None if blank[r] else prints[r].tobytes() for r in range(n)], pa.binary()),
            "size": pa.array(np.diff(text_buffer(batch.column("text"))[1])),
        })


def agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The larger share of registers that agree, of the two sketches. One byte of a register is kept."""
    same = x == y
    return np.maximum(same[..., :REGISTERS].mean(-1), same[..., REGISTERS:].mean(-1))


class _Search:
    """Links between classes, enough to join all that links join."""

    def __init__(self, threshold: float, shingle: int, scratch: str):
        self.threshold, self.shingle, self._scratch = threshold, shingle, scratch
        #: Five standard errors of an agreement of ``threshold`` over the registers.
        self.margin = 5 * (threshold * (1 - threshold) / REGISTERS) ** 0.5

    def links(self, docs: DataFrame, keys: DataFrame, classes: DataFrame) -> DataFrame:
        """Rows ``a``, ``b``."""
        # The row whose sketch and text stand for a class: its first by id.
        of = classes.select(F.col("class1").alias("of1"), F.col("class2").alias("of2"), "id")
        same = (F.col("doc_id") == F.col("id")) & (F.col("class1") == F.col("of1")) & (F.col("class2") == F.col("of2"))
        heads = keys.join(of, same).dropDuplicates(["id", "of1", "of2"]).select("id", "bands", "sketch", "size")
        heads = self._stored(heads, "heads")
        members = heads.select("id", F.explode("bands").alias("bucket"))
        centers = members.groupBy("bucket").agg(F.min("id").alias("center"), F.count("*").alias("n")).filter("n > 1")
        shared = self._stored(members.join(centers.drop("n"), "bucket"), "shared")
        named = shared.select("id").distinct()
        sketches = self._stored(heads.select("id", "sketch", "size").join(named, "id", "left_semi"), "sketches")
        texts = self._stored(
            docs.join(sketches.select("id").hint("shuffle_hash"), docs["doc_id"] == F.col("id"), "left_semi")
            .select(F.col("doc_id").alias("id"), "text"),
            "texts",
        )
        now = shared.select("bucket", "center", "id", F.col("center").alias("of_center"), F.col("id").alias("of_id"), F.lit(-(2**63)).alias("met"))
        links = None
        for n in range(ROUNDS):
            open_ = now.filter("of_center <> of_id AND center > met AND center < id")
            candidates = self._stored(open_.groupBy("id").agg(F.min("center").alias("a")).select("a", F.col("id").alias("b")), f"candidates{n}")
            likely = self._stored(self._likely(candidates, sketches), f"likely{n}")
            found = self._stored(self._compare(likely, texts), f"links{n}")
            links = found if links is None else links.union(found)
            now = self._stored(self._contracted(now, links, candidates, f"components{n}"), f"now{n}")
        return links.union(self._rest(now, sketches.select("id", "size"), texts))

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        return stored(df, f"{self._scratch}/{name}")

    def _contracted(self, now: DataFrame, links: DataFrame, candidates: DataFrame, name: str) -> DataFrame:
        """``now`` with the components that the links make, without buckets of one component."""
        of = components(links, f"{self._scratch}/{name}")
        met = candidates.select(F.col("b").alias("id"), F.col("a").alias("newly"))
        named = now.drop("of_center", "of_id").join(of, "id", "left").withColumn("of_id", F.coalesce("component", "id")).drop("component")
        named = named.join(met, "id", "left").withColumn("met", F.coalesce("newly", "met")).drop("newly")
        named = named.join(of.withColumnRenamed("id", "center"), "center", "left")
        named = named.withColumn("of_center", F.coalesce("component", "center")).drop("component")
        mixed = named.groupBy("bucket").agg(F.min("of_id").alias("low"), F.max("of_id").alias("high")).filter("low < high")
        return named.join(mixed.select("bucket"), "bucket", "left_semi").select(now.columns)

    def _likely(self, pairs: DataFrame, sketches: DataFrame) -> DataFrame:
        """Pairs whose sketches do not rule out a link, with the ``size`` of the text of ``b``."""
        least = self.threshold - self.margin
        for end in "ab":
            more = ["size"] if end == "b" else []
            side = sketches.select(F.col("id").alias(f"id_{end}"), F.col("sketch").alias(f"sketch_{end}"), *more).hint("merge")
            pairs = pairs.join(side, F.col(end) == F.col(f"id_{end}")).drop(f"id_{end}")

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x, y = (_prints(batch.column(f"sketch_{s}")) for s in "ab")
                    yield batch.select(["a", "b", "size"]).filter(pa.array(agreement(x, y) >= least))

        return pairs.mapInArrow(check, "a long, b long, size long")

    def _compare(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """The pairs that are linked. Of a centre's members some MB at a time follow its text."""
        chunks = pairs.groupBy("a").agg(F.ceil((F.sum("size") + 1) / CHUNK_BYTES).cast("int").alias("chunks"))
        dealt = pairs.join(chunks, "a").join(texts.withColumnRenamed("id", "b").hint("merge"), "b").select(
            "a", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("chunk"), "b", "text")
        first = chunks.join(texts.withColumnRenamed("id", "a").hint("merge"), "a").select(
            "a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(None).cast("long").alias("b"), "text")
        rows = first.unionByName(dealt).repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
        threshold, shingle = self.threshold, self.shingle

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            center = None
            for batch in slices(batches, "text", 1 << 20):
                s = Shingles(batch.column("text"), shingle)
                linked = np.zeros(batch.num_rows, bool)
                for row, other in enumerate(batch.column("b").to_pylist()):
                    of = s.of_row(row)
                    mine = s.hashes[of], s.weights[of]
                    if other is None:
                        center = tuple(x.copy() for x in mine)
                    else:
                        linked[row] = similarity(*center, *mine, enough=threshold) >= threshold
                yield batch.select(["a", "b"]).filter(pa.array(linked))

        return rows.mapInArrow(check, "a long, b long")

    def _rest(self, now: DataFrame, sizes: DataFrame, texts: DataFrame) -> DataFrame:
        """Links between components that still share a bucket."""
        edges = now.groupBy("bucket").agg(F.min("of_id").alias("low")).join(now.select("bucket", "of_id"), "bucket")
        of = self._families(edges, "families")
        members = now.select("id", F.col("of_id").alias("component")).distinct().join(of, "component")
        sized = self._stored(members.join(sizes, "id"), "sized")
        totals = sized.groupBy("family").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
        large = totals.filter((F.col("n") > BLOCK_ROWS) | (F.col("bytes") > BLOCK_BYTES)).select("family")
        small = sized.join(large, "family", "left_anti")
        left = self._with_common_prefix(sized.join(large, "family", "left_semi"), texts)
        return self._blocks(self._stored(small.unionByName(left), "members"), texts)

    def _families(self, edges: DataFrame, name: str) -> DataFrame:
        """The family of each component: all that ``edges`` (``low``, ``of_id``) reach."""
        links = edges.select(F.col("low").alias("a"), F.col("of_id").alias("b")).distinct()
        return components(links, f"{self._scratch}/{name}").select(F.col("id").alias("component"), F.col("component").alias("family"))

    def _with_common_prefix(self, members: DataFrame, texts: DataFrame) -> DataFrame:
        """Of members of large families those that share a prefix's shingle with another component, in new families."""
        shingle = self.shingle

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", 1 << 20):
                s = Shingles(batch.column("text"), shingle)
                n = np.diff(s.bounds)
                totals = np.bincount(s.rows, s.weights, batch.num_rows)
                yield pa.record_batch({
                    "id": batch.column("id").take(pa.array(s.rows)), "component": batch.column("component").take(pa.array(s.rows)),
                    "shingle": pa.array(s.hashes.view(np.int64)),
                    "one": pa.array(1 / n[s.rows]), "part": pa.array(s.weights / totals[s.rows]),
                })

        rows = self._stored(
            members.select("id", "component").join(texts.select("id", "text").hint("merge"), "id")
            .mapInArrow(spread, "id long, component long, shingle long, one double, part double"), "spread")
        # Shingles of one class are common to nothing; they come first in every order.
        times = rows.groupBy("shingle").agg(F.count("*").alias("times"), F.min("component").alias("low"), F.max("component").alias("high")).filter("times > 1")
        common = rows.join(times.hint("merge"), "shingle")
        in_order = Window.partitionBy("id").orderBy("times", "shingle").rowsBetween(Window.unboundedPreceding, -1)
        every = Window.partitionBy("id")
        before = {c: F.lit(1.0) - F.sum(c).over(every) + F.coalesce(F.sum(c).over(in_order), F.lit(0.0)) for c in ("one", "part")}
        t, slack = self.threshold, 1e-9
        long = (F.col("one") <= 1 - t + slack) | (F.col("part") <= 1 - t + slack)
        # Two sets that lack shares u and v of each other are (1 - u)(1 - v) / (1 - uv) alike at most (``bounds``).
        least = 1 - 2 * t / (1 + t) + slack
        short = (F.col("one") <= least) | (F.col("part") <= least)
        prefix = common.select("id", "component", "shingle", "low", "high", *[before[c].alias(c) for c in before]).filter("low < high")
        prefix = self._stored(prefix.filter(long | short).select("id", "component", "shingle", short.alias("short")), "prefix")
        mixed = prefix.groupBy("shingle").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.max("short").alias("short")).filter("low < high AND short")
        shared = prefix.drop("short").join(mixed.select("shingle", "low"), "shingle")
        of = self._families(shared.select("low", F.col("component").alias("of_id")), "subfamilies")
        stay = shared.select("id").distinct()
        return members.drop("family").join(stay, "id", "left_semi").join(of, "component").select(members.columns)

    def _blocks(self, members: DataFrame, texts: DataFrame) -> DataFrame:
        """Compare the members of each family outside its largest component with all of it."""
        parts = members.groupBy("family", "component").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))

        def blocks(n, size):
            return F.greatest(F.ceil(n / BLOCK_ROWS), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")

        main = F.max(F.struct("n", "component", "bytes"))
        split = self._stored(
            parts.groupBy("family").agg(
                main["component"].alias("main"), F.count("*").alias("parts"), blocks(F.sum("n"), F.sum("bytes")).alias("blocks"),
                blocks(F.sum("n") - main["n"], F.sum("bytes") - main["bytes"]).alias("asks"),
            ).filter("parts > 1"),
            "split",
        )
        rows = members.join(split, "family")
        place = F.xxhash64("id")
        own = rows.withColumn("block", F.pmod(place, F.col("blocks")).cast("int")) \
            .withColumn("ask", F.explode(F.sequence(F.lit(0), F.col("asks") - 1))).withColumn("asking", F.lit(False))
        outside = rows.filter("component <> main").withColumn("ask", F.pmod(place, F.col("asks")).cast("int")) \
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("asking", F.lit(True))
        cells = self._stored(own.unionByName(outside).select("family", "block", "ask", "id", "component", "asking"), "cells")
        with_text = cells.join(texts.select("id", "text").hint("merge"), "id")
        threshold, shingle = self.threshold, self.shingle

        def join(table: pa.Table) -> pa.Table:
            return _join_components(table, threshold, shingle)

        return self._stored(with_text.groupBy("family", "block", "ask").applyInArrow(join, "a long, b long"), "rest")


def _prints(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(v.as_py(), np.uint8) for v in column]).reshape(len(column), -1)


def _join_components(table: pa.Table, threshold: float, shingle: int) -> pa.Table:
    """Links from the asking rows to the others that join components not joined before."""
    asking = table["asking"].to_numpy().astype(bool)
    ids, component = table["id"].to_numpy(), table["component"].to_numpy().copy()
    s = Shingles(table["text"], shingle)
    sizes = np.diff(s.bounds)
    totals = np.add.reduceat(np.append(s.weights, 0), np.minimum(s.bounds[:-1], len(s.weights)))
    share = s.weights / totals[s.rows]
    repeats = np.zeros(len(ids), bool)
    repeats[s.rows[s.weights > 1]] = True
    # The index: for each distinct shingle of the rows that are asked, in which rows and with what share.
    entry = np.flatnonzero(~asking[s.rows])
    entry = entry[np.argsort(s.hashes[entry], kind="stable")]
    held, first = np.unique(s.hashes[entry], return_index=True)
    times = np.diff(np.append(first, len(entry)))
    a, b = [], []
    for i in np.flatnonzero(asking):
        mine = s.of_row(i)
        at = np.searchsorted(held, s.hashes[mine])
        hit = np.flatnonzero((at < len(held)) & (held[np.minimum(at, len(held) - 1)] == s.hashes[mine])) if len(held) else at[:0]
        n = times[at[hit]]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found = entry[np.repeat(first[at[hit]], n) + within]
        rows = s.rows[found]
        common = np.bincount(rows, minlength=len(ids))
        alike = common / np.maximum(sizes + sizes[i] - common, 1) >= threshold
        linked = list(_one_of_each(component, i, alike & ~asking))
        some = (~alike & (repeats | repeats[i]) & (component != component[i]))[rows]
        if some.any():
            most = bounds(np.repeat(share[mine][hit], n)[some], share[found][some], rows[some], len(ids))
            for j in np.flatnonzero(most >= threshold - 1e-9):
                other = s.of_row(j)
                if component[j] != component[i] and similarity(
                        s.hashes[mine], s.weights[mine], s.hashes[other], s.weights[other], threshold) >= threshold:
                    linked += _one_of_each(component, i, np.arange(len(ids)) == j)
        a += [ids[i]] * len(linked)
        b += [ids[j] for j in linked]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _one_of_each(component: np.ndarray, i: int, others: np.ndarray) -> Iterator[int]:
    """Of ``others`` one row of each component but that of row ``i``, which they join, in place."""
    others = np.flatnonzero(others & (component != component[i]))
    found, first = np.unique(component[others], return_index=True)
    if len(found):
        component[np.isin(component, found)] = component[i]
    yield from others[first]
