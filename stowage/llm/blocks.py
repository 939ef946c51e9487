"""Corpus-wide lookups by key, without a row for each key of each document.

Documents are dealt into *blocks* (groups by a hash of the row, some MB of text each).
A block sends each distinct 64-bit key of its texts once, to the *bucket* that the
key's upper bits name; a bucket sees all keys of its range and answers each block. So a
key that a third of all documents hold costs one entry per block, and both blocks and
buckets have a bounded size: their numbers follow the input.

The keys of one block in one bucket (a *cell*) travel as one row, sorted, as the steps from
one to the next. Answers are in the order of the cell, and the block
finds them by sorting its keys again. Nothing depends on the order of rows.

Equal rows have the same block. Before they move, each task joins those that stand within 32 MB
of its input to one row with a number (``TIMES``); results are repeated as often at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The columns for a row's block, and for how often it is there. Inputs must not have such names.
BLOCK, TIMES = "__block", "__times"
#: Rows among which a task looks for equal ones are of about this size.
JOINED_BYTES = 32 << 20
CELLS = "bucket int, __block long, n int, keys binary, extra binary"
ANSWERS = "__block long, bucket int, kind int, answer binary"


@dataclass(frozen=True)
class Layout:
    """How many blocks and buckets there are, and how wide keys are within a bucket."""

    blocks: int
    bits: int  # buckets: 2 ** bits
    width: int  # bytes of a key that are kept, beside those that name its bucket

    @classmethod
    def of(cls, text_bytes: int, keys_per_byte: float, width: int,
           block_bytes: int = 2 << 20, bucket_keys: int = 1 << 20) -> Layout:
        buckets = max(1, int(text_bytes * keys_per_byte / bucket_keys))
        return cls(max(1, -(-text_bytes // block_bytes)), min(30, buckets.bit_length()), width)

    @property
    def kept_bits(self) -> int:
        return min(64, self.bits + 8 * self.width)

    def cut(self, keys: np.ndarray) -> np.ndarray:
        """The upper bits of the keys, as many as travel."""
        return keys >> np.uint64(64 - self.kept_bits)

    def within(self) -> np.uint64:
        return np.uint64((1 << (self.kept_bits - self.bits)) - 1)


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def with_blocks(docs: DataFrame, layout: Layout) -> DataFrame:
    """Deal rows by their id and text, so that rows without an id spread as well.

    The texts are compressed one by one: each moves once, and lies there until the end.
    """
    dealt = docs.withColumn(BLOCK, F.pmod(F.xxhash64("doc_id", "text"), F.lit(layout.blocks)))
    fields = [T.StructField(f.name, T.BinaryType()) if f.name == "text" else f for f in dealt.schema.fields]
    return dealt.mapInArrow(_close, T.StructType([*fields, T.StructField(TIMES, T.LongType())]))


def as_often(df: DataFrame) -> DataFrame:
    """Each row ``TIMES`` times, without that column."""
    return df.withColumn(TIMES, F.explode(F.array_repeat(F.lit(0), F.col(TIMES).cast("int")))).drop(TIMES)


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= JOINED_BYTES:
            yield from _joined(pa.Table.from_batches(held))
            held, size = [], 0
    if held:
        yield from _joined(pa.Table.from_batches(held))


def _joined(table: pa.Table) -> list[pa.RecordBatch]:
    """One row for equal ones, with their number, and texts compressed."""
    texts = table["text"].cast(pa.binary()).to_pylist()
    rows = list(zip(table["doc_id"].to_pylist(), texts, strict=True))
    if len(set(rows)) < len(rows):
        rest = table.drop_columns(["doc_id", "text", BLOCK]).to_pylist()
        rows = [(*r, repr(other)) for r, other in zip(rows, rest, strict=True)]
    times: dict[tuple, int] = {}
    first: list[int] = []
    for i, row in enumerate(rows):
        if row not in times:
            first.append(i)
        times[row] = times.get(row, 0) + 1
    if len(first) < len(rows):
        table = table.take(first)
    coder = zstandard.ZstdCompressor(level=3)
    closed = pa.array([None if texts[i] is None else coder.compress(texts[i]) for i in first], pa.binary())
    table = table.set_column(table.schema.get_field_index("text"), "text", closed)
    return table.append_column(TIMES, pa.array(times.values(), pa.int64())).combine_chunks().to_batches()


def _open(table: pa.Table) -> pa.Table:
    coder = zstandard.ZstdDecompressor()
    texts = [None if t is None else coder.decompress(t) for t in table["text"].to_pylist()]
    return table.set_column(table.schema.get_field_index("text"), "text", pa.array(texts, pa.binary()).cast(pa.string()))


def planes(x: np.ndarray) -> bytes:
    """Numbers as the lowest bytes of all, then the next and so on, compressed."""
    raw = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T)
    return zstandard.compress(raw.tobytes(), 1)


def from_planes(payload: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(payload), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _pack(keys: np.ndarray) -> bytes:
    """Sorted keys, as the steps from one to the next: their upper bytes are nearly all alike."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def _unpack(payload: bytes) -> np.ndarray:
    return np.cumsum(from_planes(payload, np.uint64), dtype=np.uint64)


def cells(block: int, keys: np.ndarray, extra: np.ndarray, layout: Layout) -> pa.Table:
    """Rows of CELLS for the sorted, distinct, cut keys of a block; ``extra`` goes with each."""
    edges, buckets = _edges(keys, layout)
    rest = keys & layout.within()
    parts = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pa.table({
        "bucket": pa.array(buckets, pa.int32()),
        BLOCK: pa.array(np.full(len(parts), block), pa.int64()),
        "n": pa.array(np.diff(edges), pa.int32()),
        "keys": pa.array([_pack(rest[p]) for p in parts], pa.binary()),
        "extra": pa.array([planes(extra[p]) for p in parts], pa.binary()),
    })


def _edges(keys: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    of = (keys >> np.uint64(layout.kept_bits - layout.bits)).astype(np.int64)
    first = np.flatnonzero(np.diff(of, prepend=-1))
    return np.append(first, len(keys)), of[first]


class Bucket:
    """All cells of one bucket: which entries hold the same key."""

    def __init__(self, table: pa.Table, extra: type):
        self.bucket = table["bucket"][0].as_py()
        self.blocks = table[BLOCK].to_numpy()
        self.sizes = table["n"].to_numpy()
        keys = [_unpack(k.as_py()) for k in table["keys"]]
        self.extra = np.concatenate([from_planes(x.as_py(), extra) for x in table["extra"]])
        keys = np.concatenate(keys)
        self.order = np.argsort(keys, kind="stable")
        keys = keys[self.order]
        self.first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.times = np.diff(np.append(self.first, len(keys)))

    def per_key(self, reduce: np.ufunc) -> np.ndarray:
        return reduce.reduceat(self.extra[self.order], self.first)

    def answers(self, of_key: np.ndarray, encode: Callable[[np.ndarray], bytes], kind: int = 0) -> pa.Table:
        """Rows of ANSWERS: for each entry of each cell what ``of_key`` has for its key."""
        back = np.empty(len(self.order), of_key.dtype)
        back[self.order] = np.repeat(of_key, self.times)
        ends = np.cumsum(self.sizes)
        return pa.table({
            BLOCK: pa.array(self.blocks, pa.int64()),
            "bucket": pa.array(np.full(len(self.blocks), self.bucket), pa.int32()),
            "kind": pa.array(np.full(len(self.blocks), kind), pa.int32()),
            "answer": pa.array([encode(back[e - n : e]) for e, n in zip(ends, self.sizes, strict=True)], pa.binary()),
        })


def answer_to(keys: np.ndarray, answers: pa.Table, kind: int, layout: Layout,
              decode: Callable[[bytes, int], np.ndarray]) -> np.ndarray:
    """What the buckets answered for the sorted, distinct, cut keys of a block; ``decode`` gets bytes and their number."""
    edges, buckets = _edges(keys, layout)
    mine = answers.filter(pa.compute.equal(answers["kind"], kind))
    by = dict(zip(mine["bucket"].to_pylist(), mine["answer"], strict=True))
    return np.concatenate([decode(by[b].as_py(), n) for b, n in zip(buckets.tolist(), np.diff(edges).tolist(), strict=True)])


def ask(blocks: DataFrame, send: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """Run ``send`` on each block's rows; gives rows of CELLS."""
    def run(table: pa.Table) -> pa.Table:
        return send(_open(table))

    return blocks.groupBy(BLOCK).applyInArrow(run, CELLS)


def reply(sent: DataFrame, resolve: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """Run ``resolve`` on each bucket's cells; gives rows of ANSWERS."""
    return sent.groupBy("bucket").applyInArrow(resolve, ANSWERS)


def meet(blocks: DataFrame, answers: DataFrame, finish: Callable[[pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
    """Run ``finish`` on each block's rows and the answers it got."""
    def run(table: pa.Table, heard: pa.Table) -> pa.Table:
        return finish(_open(table), heard)

    return blocks.groupBy(BLOCK).cogroup(answers.groupBy(BLOCK)).applyInArrow(run, schema)

