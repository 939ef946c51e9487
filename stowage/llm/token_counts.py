"""Token counts of documents, with a cache by digest.

The cache is a Parquet table of (``content``, ``tokenizer``, ``n_tokens``): SHA-256 of a
text's normalised content, and of the tokenizer's version. Each distinct content that
the cache does not hold is encoded once, whatever the number of its copies, and appended.

Normalising folds each run of ASCII white space to one space and strips the ends. It is
for tokenizers that part words at white space and drop it, as that of the vocabulary
here: the count is then the same for all texts of one content. ``normalise=False``
digests texts as they are, for any other tokenizer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from stowage.llm.shared import scratch_root, stored
from stowage.llm.text import slices

CACHE = "content string, tokenizer string, n_tokens long"
LIMIT = 2048
#: Texts are encoded in batches of about this size.
BATCH_BYTES = 1 << 18
#: A worker remembers counts of stretches up to about this size; beyond, it begins anew.
MEMO_BYTES = 1 << 27
#: What an entry takes beside its stretch.
ENTRY_BYTES = 100
SPACE = "[ \t\n\x0b\f\r]+"


def version_digest(path: str) -> str:
    """SHA-256 over the tokenizer's file and its library's version."""
    return hashlib.sha256(Path(path).read_bytes() + tokenizers.__version__.encode()).hexdigest()


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> tokenizers.Tokenizer:
    return tokenizers.Tokenizer.from_file(path)


def count_batch(texts: list[str], path: str, dropped: bool) -> list[int]:
    """Tokens of each text, without special tokens at the ends.

    With ``dropped``, for a tokenizer that parts words at white space and drops it, a
    text's tokens are those of its stretches between ASCII white space. Each distinct
    stretch is encoded once in a while: counts are remembered up to ``MEMO_BYTES``.
    """
    if not dropped:
        return [n for at in range(0, len(texts), 64) for n in _encode(texts[at : at + 64], path)]
    memo = _memo(path)
    counts = []
    for text in texts:
        parts = text.encode().split()
        if memo.size > MEMO_BYTES:
            memo.known.clear()
            memo.size = 0
        new = [p for p in set(parts) if p not in memo.known]
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            memo.known.update(zip(some, _encode([p.decode() for p in some], path), strict=True))
        memo.size += sum(map(len, new)) + ENTRY_BYTES * len(new)
        counts.append(sum(map(memo.known.__getitem__, parts)))
    return counts


@dataclass
class Memo:
    """Tokens by stretch, and about how many bytes they take."""

    known: dict[bytes, int] = field(default_factory=dict)
    size: int = 0


def _encode(texts: list[str], path: str) -> list[int]:
    return [len(code) for code in _tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def _memo(path: str) -> Memo:
    return Memo()


def count_tokens(docs: DataFrame, tokenizer_path: str, cache: str, limit: int = LIMIT, normalise: bool = True) -> DataFrame:
    """Tokens of every row of ``docs`` (``doc_id``, ``text``); other columns are not read.

    ``tokenizer_path`` is a file that all executors have; ``cache`` a folder on shared
    storage, made when there is none. One row per input row: ``doc_id``, ``n_bytes``
    (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit``). A null text counts as
    empty: 0 bytes, 0 tokens. Repeated rows, rows without an id and copies get the count
    of their content. An empty table gives no rows. Texts are encoded in whole; a text lies in
    one task's memory, as do the counts of its stretches beside the remembered ones. Two calls that overlap may both
    append a content; counts are then equal, and one is used.
    """
    spark = docs.sparkSession
    version = version_digest(tokenizer_path)
    scratch = scratch_root(spark)
    text = F.coalesce(docs["text"], F.lit(""))
    content = F.trim(F.regexp_replace(text, SPACE, " ")) if normalise else text
    keyed = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.sha2(content, 256).alias("content")
    )
    keys = stored(keyed.select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes")), f"{scratch}/keys")
    known = _known(spark, cache, version)
    # Of each content one row is picked; only the picked rows' texts are moved and encoded.
    pick = keys.groupBy("content").agg(F.min("doc_id").alias("pick"))
    found = known.join(pick, "content", "left_semi") if known is not None else spark.createDataFrame([], "content string, n_tokens long")
    if known is not None:
        pick = pick.join(known, "content", "left_anti")
    misses = keyed.join(
        pick.withColumnRenamed("content", "miss").hint("shuffle_hash"),
        (F.col("content") == F.col("miss")) & F.col("doc_id").eqNullSafe(F.col("pick")),
    ).select("content", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            counts = count_batch(batch.column("text").to_pylist(), tokenizer_path, normalise)
            yield pa.record_batch([batch.column("content"), pa.array(counts, pa.int64())], names=["content", "n_tokens"])

    counted = misses.mapInArrow(encode, "content string, n_tokens long").groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    new = stored(counted, f"{scratch}/new")
    new.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    counts = new.unionByName(stored(found, f"{scratch}/found"))
    return keys.join(counts, "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def _known(spark, cache: str, version: str) -> DataFrame | None:
    """Stored counts of one tokenizer, one row per content; None where there is no cache."""
    try:
        rows = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.filter(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
