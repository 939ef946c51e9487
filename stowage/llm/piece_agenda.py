"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text begins as its characters. An agenda holds every pair of neighbouring symbols that
together are a piece, ordered by the piece's score, then from left to right; the best pair
is merged, and its new neighbours enter the agenda, until that is empty. A symbol that is
no piece becomes the pieces of its UTF-8 bytes.

Done for all texts of an Arrow batch at once:

1. Texts are parted before each white space that follows something else, as no piece
   reaches over that; equal parts are encoded once.
2. Parts are parted again between characters that stand side by side in no piece. No
   merge reaches over such a place, so each stretch has an agenda of its own.
3. Short stretches take their best pairs in step, as array operations over all of them;
   a long stretch has a heap. Both give the same merges.
4. The ids of each batch, and the texts decoded from them, are compared with those of the
   sentencepiece library. Parts are told apart by 64-bit hashes; should two ever meet,
   the comparison shows it, and the text is encoded by itself.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from stowage.llm.text import ODD, STEP, mix, slices

#: Texts are encoded in batches of about this size.
BATCH_BYTES = 4 << 20
#: Stretches of more symbols than this get a heap.
IN_STEP = 48
SPACE = 0x2581
CODE_POINTS = 0x110000
NEVER = np.int32(2**31 - 1)
LAST = np.int64(2**62)
SCHEMA = "doc_id long, ids binary, decoded string"


class PairTable:
    """Numbers for pairs of symbols, found for whole arrays of pairs, by open addressing."""

    def __init__(self, numbers: dict[tuple[int, int], int]):
        self._shift = np.uint64(64 - max(4, (4 * len(numbers)).bit_length()))
        self._keys = np.full(1 << (64 - int(self._shift)), -1, np.int64)
        self._numbers = np.zeros(len(self._keys), np.int32)
        for (left, right), number in numbers.items():
            key = np.array([(left << 21) | right], np.int64)
            slot = int(self._slots(key)[0])
            while self._keys[slot] >= 0:
                slot = (slot + 1) % len(self._keys)
            self._keys[slot], self._numbers[slot] = key[0], number

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * ODD) >> self._shift).view(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each pair, and whether it has one."""
        keys = (left.astype(np.int64) << 21) | right
        slots = self._slots(keys)
        held = self._keys[slots]
        more = np.flatnonzero((held != keys) & (held >= 0))
        while len(more):
            slots[more] = (slots[more] + 1) & (len(self._keys) - 1)
            held[more] = self._keys[slots[more]]
            more = more[(held[more] != keys[more]) & (held[more] >= 0)]
        return self._numbers[slots], held == keys


class MergeModel:
    """A merge-type vocabulary: its pieces, and which pairs of symbols make one.

    Symbols are numbered by piece, and beyond the pieces by code point.
    """

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = model_pb2.ModelProto.FromString(self.library.serialized_model_proto())
        _refuse_unlike(proto)
        self.dummy_prefix = proto.normalizer_spec.add_dummy_prefix
        kinds = model_pb2.ModelProto.SentencePiece
        self.size = len(proto.pieces)
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.bos, self.eos = self.library.bos_id(), self.library.eos_id()
        self.byte_ids = np.zeros(256, np.int64)
        self._bytes = []
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                self._bytes.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == kinds.NORMAL:
                self._bytes.append(p.piece.replace(chr(SPACE), " ").encode())
            else:
                self._bytes.append(proto.trainer_spec.unk_surface.encode() if p.type == kinds.UNKNOWN else b"")
        self._flat = np.frombuffer(b"".join(self._bytes), np.uint8)
        self._lengths = np.array([len(b) for b in self._bytes])
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._spaced = np.array([p.type == kinds.NORMAL and p.piece.startswith(chr(SPACE)) for p in proto.pieces])
        # The symbol of each character, and the characters that stand side by side in a piece.
        self.symbols = np.arange(CODE_POINTS, dtype=np.int32) + np.int32(self.size)
        for piece, i in normal.items():
            if len(piece) == 1:
                self.symbols[ord(piece)] = i
        beside = {(a, b) for piece in normal for a, b in zip(piece, piece[1:], strict=False)}
        self.parts_at_space = not any(b == chr(SPACE) != a for a, b in beside)
        self._beside = PairTable({(ord(a), ord(b)): 1 for a, b in beside})
        self._merges(normal, [p.score for p in proto.pieces])

    def _merges(self, normal: dict[str, int], scores: list[float]) -> None:
        """The pairs that make a piece, with the piece and the rank of its score."""
        rank = {s: r for r, s in enumerate(sorted({scores[i] for i in normal.values()}, reverse=True))}
        #: For each pair of symbols: the rank of the piece they make, and that piece.
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for piece, i in normal.items():
            for k in range(1, len(piece)):
                sides = [self._symbol(s, normal) for s in (piece[:k], piece[k:])]
                if None not in sides:
                    self.merges[tuple(sides)] = rank[scores[i]], i
        self._pairs = PairTable({pair: i for pair, (_, i) in self.merges.items()})
        self._rank = np.full(self.size, NEVER, np.int32)
        for i in normal.values():
            self._rank[i] = rank[scores[i]]

    def _symbol(self, text: str, normal: dict[str, int]) -> int | None:
        return normal.get(text, int(self.symbols[ord(text)]) if len(text) == 1 else None)

    def beside(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether some piece holds these characters side by side."""
        return self._beside.find(left, right)[1]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of pairs of symbols; rank ``NEVER`` where they make none."""
        piece, found = self._pairs.find(left, right)
        return np.where(found, self._rank[piece], NEVER), piece

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids. Bytes that are no UTF-8 become U+FFFD one by one."""
        lengths = self._lengths[ids]
        if not lengths.sum():
            return ""
        within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        raw = self._flat[np.repeat(self._starts[ids], lengths) + within].tobytes()
        if self.dummy_prefix and self._spaced[ids[np.argmax(lengths > 0)]]:
            raw = raw[1:]
        return _lenient(raw)


def _refuse_unlike(proto) -> None:
    kinds, normal = model_pb2.ModelProto.SentencePiece, proto.normalizer_spec
    odd = {p.type for p in proto.pieces} & {kinds.USER_DEFINED, kinds.UNUSED}
    if proto.trainer_spec.model_type != model_pb2.TrainerSpec.BPE or not proto.trainer_spec.byte_fallback or odd:
        raise ValueError("only merge-type vocabularies with byte pieces, without user-defined or unused ones")
    if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only vocabularies that leave texts as they are, with marked white space before words")


def _lenient(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError as e:
        return raw[: e.start].decode() + "�" + _lenient_rest(raw, e.start + 1)


def _lenient_rest(raw: bytes, at: int) -> str:
    out = []
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as e:
            out += [raw[at : at + e.start].decode(), "�"]
            at += e.start + 1
    return "".join(out)


@lru_cache(maxsize=2)
def model_of(path: str) -> MergeModel:
    return MergeModel(path)


def encode_batch(texts: list[str], model: MergeModel) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, one after the other, and where each text's begin and the last's end."""
    spaced = [(" " + t if t and model.dummy_prefix else t).replace(" ", chr(SPACE)) for t in texts]
    lengths = np.array([len(t) for t in spaced], np.int64)
    points = np.frombuffer("".join(spaced).encode("utf-32-le"), np.int32)
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    first = np.zeros(len(points), bool)
    first[offsets[:-1][lengths > 0]] = True
    if model.parts_at_space:
        space = points == SPACE
        first[1:] |= space[1:] & ~space[:-1]
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(points)))
    names = _hashes(points, starts, sizes)
    _, one, which = np.unique(names, return_index=True, return_inverse=True)
    # The distinct parts, back to back, and their ids.
    inside = _ranges(starts[one], sizes[one])
    ids, bounds = _encode_parts(points[inside], sizes[one], model)
    counts = np.diff(bounds)[which]
    out = ids[_ranges(bounds[:-1][which], counts)]
    ends = np.concatenate([[0], np.cumsum(counts)])
    return out, ends[np.searchsorted(starts, offsets)]


def _hashes(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    place = np.arange(len(points)) - np.repeat(starts, sizes)
    each = mix(points.astype(np.uint64) * ODD + place.astype(np.uint64) * STEP)
    return mix(np.add.reduceat(each, starts) + sizes.astype(np.uint64))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the given ranges, one range after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _encode_parts(points: np.ndarray, sizes: np.ndarray, model: MergeModel) -> tuple[np.ndarray, np.ndarray]:
    """Ids of parts that lie back to back, and where each part's begin and the last's end."""
    edges = np.concatenate([[0], np.cumsum(sizes)])
    first = np.ones(len(points), bool)
    first[1:] = ~model.beside(points[:-1], points[1:])
    first[edges[:-1]] = True
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(points)))
    symbols = model.symbols[points]
    left = np.ones(len(points), bool)  # symbols that no merge has taken into the one before
    short = (lengths > 1) & (lengths <= IN_STEP)
    _merge_in_step(symbols, left, starts[short], lengths[short], model)
    for k in np.flatnonzero(lengths > IN_STEP):
        _merge_by_heap(symbols, left, int(starts[k]), int(starts[k] + lengths[k]), model)
    where = np.flatnonzero(left)
    symbols = symbols[where]
    return _with_bytes(symbols, np.searchsorted(where, edges), model)


def _merge_in_step(symbols: np.ndarray, left: np.ndarray, starts: np.ndarray, lengths: np.ndarray, model: MergeModel) -> None:
    """Take the best pair of every stretch's agenda until all are empty; changes both arrays."""
    at = _ranges(starts, lengths).astype(np.int32)  # where each symbol still there lies
    now = symbols[at]
    last = np.zeros(len(at), bool)
    last[np.cumsum(lengths) - 1] = True
    rank = np.full(len(at), NEVER)
    makes = np.zeros(len(at), np.int32)
    inner = np.flatnonzero(~last)
    rank[inner], makes[inner] = model.look_up(now[inner], now[inner + 1])
    while len(at):
        begins = np.flatnonzero(np.concatenate([[True], last[:-1]]))
        sizes = np.diff(np.append(begins, len(at)))
        # By rank, then by place: the agenda's order.
        order = np.where(rank < NEVER, (rank.astype(np.int64) << 32) + np.arange(len(at)), LAST)
        best = np.minimum.reduceat(order, begins)
        going = best < LAST
        done = ~np.repeat(going, sizes)
        symbols[at[done]] = now[done]
        pick = best[going] & 0xFFFFFFFF
        now[pick] = makes[pick]
        keep = ~done
        gone = pick + 1
        left[at[gone]] = False
        last[pick] = last[gone]
        keep[gone] = False
        touched = np.zeros(len(at), bool)
        touched[pick] = True
        before = pick - 1
        before = before[(before >= 0)]
        touched[before[~last[before]]] = True
        at, now, last, rank, makes, touched = (x[keep] for x in (at, now, last, rank, makes, touched))
        new = np.flatnonzero(touched)
        rank[new] = NEVER
        new = new[~last[new]]
        rank[new], makes[new] = model.look_up(now[new], now[new + 1])


def _merge_by_heap(symbols: np.ndarray, left: np.ndarray, start: int, end: int, model: MergeModel) -> None:
    """The same for one long stretch, with a heap as its agenda."""
    now = symbols[start:end].tolist()
    n = len(now)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    agenda: list[tuple[int, int, int, int]] = []

    def enter(i: int, j: int) -> None:
        found = model.merges.get((now[i], now[j]))
        if found:
            heapq.heappush(agenda, (found[0], i, now[i], now[j]))

    for i in range(n - 1):
        enter(i, i + 1)
    while agenda:
        _, i, a, b = heapq.heappop(agenda)
        j = after[i]
        if now[i] != a or j >= n or now[j] != b:
            continue  # one of the two has been merged since
        now[i] = model.merges[a, b][1]
        now[j] = -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            enter(i, after[i])
        if before[i] >= 0:
            enter(before[i], i)
    merged = np.array(now)
    symbols[start:end] = merged
    left[start:end] = merged >= 0


def _with_bytes(symbols: np.ndarray, bounds: np.ndarray, model: MergeModel) -> tuple[np.ndarray, np.ndarray]:
    """Symbols that are no pieces become those of their bytes; bounds follow."""
    strange = np.flatnonzero(symbols >= model.size)
    if not len(strange):
        return symbols, bounds
    raw = [chr(c).encode() for c in (symbols[strange] - model.size).tolist()]
    counts = np.ones(len(symbols), np.int64)
    counts[strange] = [len(b) for b in raw]
    out = np.repeat(symbols, counts)
    ends = np.concatenate([[0], np.cumsum(counts)])
    out[_ranges(ends[strange], counts[strange])] = model.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
    return out, ends[bounds]


def encode_and_decode(docs: DataFrame, model_path: str, bos: bool = True, eos: bool = True) -> DataFrame:
    """The ids of every row of ``docs`` (``doc_id``, ``text``), and the text they decode to.

    ``model_path`` is a file that all executors have. One row per input row, also for rows
    that repeat an id or have none: ``doc_id``; ``ids``, little-endian 32-bit numbers one
    after the other, with the begin and end ids if asked; ``decoded``. A null text is
    empty: its ids are those of begin and end, and it decodes to the empty text. Texts are
    encoded whole, however long; a worker holds a batch of about ``BATCH_BYTES``, or one
    longer text. An empty table gives no rows. Other columns are not read. A text on
    which the library differs ends the job with its id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(model_path)
        for batch in slices(batches, "text", BATCH_BYTES):
            texts = batch.column("text").to_pylist()
            ids = checked(texts, batch.column("doc_id"), model, bos, eos)
            decoded = checked_texts(ids, batch.column("doc_id"), model)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "ids": pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()),
                "decoded": pa.array(decoded, pa.string()),
            })

    text = F.coalesce(docs["text"], F.lit("")).alias("text")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text).mapInArrow(run, SCHEMA)


def checked(texts: list[str], names: pa.Array, model: MergeModel, bos: bool, eos: bool) -> list[np.ndarray]:
    """The ids of each text, the same as the library's."""
    flat, bounds = encode_batch(texts, model)
    head, tail = [model.bos] * bos, [model.eos] * eos
    out = []
    for row, want in enumerate(model.library.encode(texts, out_type="numpy", add_bos=bos, add_eos=eos, num_threads=1)):
        got = np.concatenate([head, flat[bounds[row] : bounds[row + 1]], tail]).astype(np.int64)
        if not np.array_equal(got, want):
            got = np.concatenate([head, encode_alone(texts[row], model), tail]).astype(np.int64)
            if not np.array_equal(got, want):
                raise ValueError(f"ids of document {names[row]} differ from the library's")
        out.append(got)
    return out


def encode_alone(text: str, model: MergeModel) -> np.ndarray:
    """The ids of one text by one agenda, without parts or hashes."""
    if not text:
        return np.zeros(0, np.int64)
    spaced = (" " + text if model.dummy_prefix else text).replace(" ", chr(SPACE))
    symbols = model.symbols[np.frombuffer(spaced.encode("utf-32-le"), np.uint32)]
    left = np.ones(len(symbols), bool)
    _merge_by_heap(symbols, left, 0, len(symbols), model)
    symbols = symbols[left]
    return _with_bytes(symbols, np.array([0, len(symbols)]), model)[0]


def checked_texts(ids: list[np.ndarray], names: pa.Array, model: MergeModel) -> list[str]:
    """The text that each list of ids decodes to, the same as the library's."""
    texts = [model.decode(i) for i in ids]
    for row, want in enumerate(model.library.decode([i.tolist() for i in ids], num_threads=1)):
        if texts[row] != want:
            raise ValueError(f"the decoded text of document {names[row]} differs from the library's")
    return texts
