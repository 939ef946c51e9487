"""Mixing sources to target weights, by capped water-filling.

The words of the mix, ``share`` times all words of the input, are dealt to the sources
by weight. A source takes at most ``epochs`` times its own words; what it cannot take
goes to the others by weight, until none is above its limit. That is one water level L:
a source's target is the smaller of weight * L and its limit.

A source's documents are then taken as often as its target asks for: all of them whole
as many times as fit, and the rest in a seeded random order, down to a part of one
document. So the words taken are the target, to the word.

The random order is by MD5 of seed, id and text. Which documents the rest reaches is
found from sums over 4,096 ranges of that hash in each source, then over 4,096 ranges of
the one where the rest ends; only documents of the last range are put in order. No step
brings a source together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stowage.llm.shared import scratch_root, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2.0
SEED = 1
WORDS = r"[^\x20\x09-\x0D]+"


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: float = EPOCHS, seed: int = SEED) -> DataFrame:
    """What the mix takes of every row of ``docs`` (``doc_id``, ``text``, ``source``).

    One row per input row: ``doc_id``, ``source``, ``size`` (words), ``source_size``,
    ``target`` (of its source) and ``taken`` (words, repeats counted). Sources in the
    order of their code points, null last, get ``weights`` in turn. A null or empty text
    has size 0 and nothing is taken of it; a source of such texts has target 0. Rows
    without an id, and repeated rows, are documents of their own. Reruns give the same.
    An empty table gives no rows. Other columns are not read. Words of a text are counted in
    whole, however long it is.
    """
    scratch = scratch_root(docs.sparkSession)
    sizes, marks = _plan(docs, weights, share, epochs, seed, scratch)
    return _take(sizes, marks).select(
        "doc_id", F.col("__source").alias("source"), F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        F.col("__taken").alias("taken"),
    )


def repeat_texts(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: float = EPOCHS, seed: int = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with all its columns.

    A document that is taken in part (one of a source) comes with as many of its first
    words as are taken, joined by spaces; of one that is not taken there is no row.
    ``mix_sources`` has the rules. Columns may have any names.
    """
    _, marks = _plan(docs, weights, share, epochs, seed, scratch_root(docs.sparkSession))
    # The input row is one column, so no working name meets one of its own.
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("__row"))
    rows = _take(_sized(rows, seed, F.col("__row")), marks)
    text = F.col("__row").getField("text")
    whole = F.floor(F.col("__taken") / F.greatest(F.col("__size"), F.lit(1))).cast("int")
    part = (F.col("__taken") - whole * F.col("__size")).cast("int")
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    texts = F.concat(
        F.array_repeat(text, whole),
        F.when(part > 0, F.array(F.array_join(F.slice(words, F.lit(1), part), " "))).otherwise(F.array().cast("array<string>")),
    )
    return rows.withColumn("__text", F.explode(texts)).select(
        *[(F.col("__text") if c == "text" else F.col("__row").getField(c)).alias(c) for c in docs.columns]
    )


def _sized(docs: DataFrame, seed: int, row: Column | None = None) -> DataFrame:
    """``docs`` with each row's id, source, number of words and place in the random order.

    ``row`` is the column that holds the row, where it is not spread over columns.
    """
    def of(name: str) -> Column:
        return F.col(name) if row is None else row.getField(name)

    doc_id = of("doc_id").cast("long")
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")),
                             F.coalesce(of("text"), F.lit(""))).cast("binary"))
    return docs.withColumns({
        "doc_id": doc_id,
        "__source": of("source").cast("string"),
        "__size": F.coalesce(F.regexp_count(of("text"), F.lit(WORDS)), F.lit(0)).cast("long"),
        "__draw": draw,
    })


def _plan(docs: DataFrame, weights, share: float, epochs: float, seed: int, scratch: str) -> tuple[DataFrame, DataFrame]:
    """The sizes of all rows, without texts, and per source what ``_take`` needs."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source")
    sizes = stored(_sized(slim, seed).drop("text", "source"), f"{scratch}/sizes")
    targets = stored(_targets(sizes, weights, share, epochs, scratch), f"{scratch}/targets")
    return sizes, _marks(sizes, targets, scratch)


def _targets(sizes: DataFrame, weights, share: float, epochs: float, scratch: str) -> DataFrame:
    """Of each source: its size, its target, how often it goes in whole, and the words beyond that."""
    sources = sizes.groupBy(F.col("__source").alias("source")).agg(F.sum("__size").alias("source_size"))
    ranked = _with_rank(sources, F.col("source").asc_nulls_last(), f"{scratch}/sources")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = stored(
        ranked.select("source", "source_size", (F.col("source_size") * epochs).alias("most"),
                      turn[(F.col("rank") % len(weights)).cast("int")].alias("weight")),
        f"{scratch}/weights",
    )
    total = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    filled = F.least(F.col("most"), F.col("weight") * F.lit(_level(ranked, total, f"{scratch}/levels")))
    words = F.round("target").cast("long")
    return ranked.select(
        "source", "source_size", filled.alias("target"),
    ).withColumn("whole", F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(F.lit(0))
    ).withColumn("rest", words - F.col("whole") * F.col("source_size"))


def _level(sources: DataFrame, total: float, path: str) -> float:
    """The water level at which the targets of ``sources`` come to ``total``.

    Sources fill in the order of most / weight. Whichever are taken for filled, the level is
    at least (total - their limits) / (weights of the others), and for the right ones it is
    that; so it is the largest of these over the order. Sources that fill at one level count as one.
    """
    steps = sources.groupBy(F.try_divide("most", "weight").alias("at")).agg(
        F.sum("most").alias("most"), F.sum("weight").alias("weight"))
    parts = stored(steps.repartitionByRange(F.col("at").asc_nulls_last()).withColumn("part", F.spark_partition_id()), path)
    sums = sorted(parts.groupBy("part").agg(F.sum("most"), F.sum("weight")).collect())  # a row per partition
    filled, open_, begins = 0.0, sum(weight for _, _, weight in sums), []
    for part, most, weight in sums:
        begins.append((part, F.struct(F.lit(filled).alias("filled"), F.lit(open_).alias("open"))))
        filled, open_ = filled + most, open_ - weight
    if not begins:
        return 0.0
    begin = F.create_map(*[x for part, sums_there in begins for x in (F.lit(part), sums_there)])[F.col("part")]
    before = Window.partitionBy("part").orderBy(F.col("at").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    filled_there = begin["filled"] + F.coalesce(F.sum("most").over(before), F.lit(0.0))
    open_there = begin["open"] - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = parts.select(F.try_divide(F.lit(float(total)) - filled_there, open_there).alias("level"))
    return levels.agg(F.max("level")).first()[0] or 0.0


def _with_rank(df: DataFrame, order: Column, path: str) -> DataFrame:
    """Number the rows from 0 in order, without bringing them to one task."""
    parts = stored(
        df.repartitionByRange(order).sortWithinPartitions(order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
        path,
    )
    before, begins = 0, []
    for part, n in sorted(parts.groupBy("part").count().collect()):  # a row per partition
        begins.append((part, before))
        before += n
    begin = F.create_map(*[F.lit(x) for pair in begins or [(-1, 0)] for x in pair])
    return parts.withColumn("rank", begin[F.col("part")] + F.col("place")).drop("part", "place")


def _range(level: int) -> Column:
    """The number of the range that holds ``__draw``, of 4,096 ranges of the range above."""
    return F.conv(F.substring("__draw", 1 + 3 * level, 3), 16, 10).cast("int")


def _marks(sizes: DataFrame, targets: DataFrame, scratch: str) -> DataFrame:
    """The targets with the ranges in which each source's rest ends, and the words left there."""
    marks = targets.withColumn("left", F.col("rest"))
    for level in (0, 1):
        here = sizes if level == 0 else _with_source(sizes, marks).filter(_range(0) == F.col("range0"))
        sums = here.groupBy("__source", _range(level).alias("range")).agg(F.sum("__size").alias("n"))
        ends = sums.withColumn("upto", F.sum("n").over(Window.partitionBy("__source").orderBy("range")))
        first = (
            _with_source(ends, marks).filter(F.col("upto") > F.col("left")).groupBy("__source")
            .agg(F.min(F.struct("range", (F.col("upto") - F.col("n")).alias("before"))).alias("at"))
        )
        marks = stored(
            marks.join(first, marks["source"].eqNullSafe(first["__source"]), "left").drop("__source")
            .withColumn(f"range{level}", F.col("at.range"))
            .withColumn("left", F.col("left") - F.coalesce(F.col("at.before"), F.lit(0))).drop("at"),
            f"{scratch}/marks{level}",
        )
    return marks.withColumnRenamed("source", "of").select(*[F.col(c).alias(f"__{c}") for c in ["of", *marks.columns[1:]]])


def _take(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """``rows`` with ``__taken``, and what ``marks`` has of their sources."""
    rows = rows.join(marks, rows["__source"].eqNullSafe(marks["__of"]))
    last = F.coalesce((F.col("__range0") == _range(0)) & (F.col("__range1") == _range(1)), F.lit(False))
    below = (_range(0) < F.col("__range0")) | ((_range(0) == F.col("__range0")) & (_range(1) < F.col("__range1")))
    sure = rows.filter(~last).withColumn("__more", F.when((F.col("__rest") > 0) & below, F.col("__size")).otherwise(F.lit(0)))
    order = Window.partitionBy("__source").orderBy("__draw", "doc_id", "__size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__size").over(order), F.lit(0))
    edge = rows.filter(last).withColumn("__more", F.greatest(F.lit(0), F.least(F.col("__size"), F.col("__left") - before)))
    return sure.unionByName(edge).withColumn("__taken", (F.col("__whole") * F.col("__size") + F.col("__more")).cast("long"))


def _with_source(left: DataFrame, marks: DataFrame) -> DataFrame:
    """Join by source; null is a source too."""
    return left.join(marks, left["__source"].eqNullSafe(marks["source"]))
