"""Fill-in-the-middle forms of whole texts, on texts kept as seekable compressed frames.

A text is stored as independent zstandard frames of about ``FRAME_BYTES`` each, cut where
a unit ends. With each frame stand the units and the characters before it, so a unit is
found without opening the frames before it. Units are words with the white space before
them, and white space at the end: ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``.

1. ``store_frames`` writes the table of framed texts.
2. ``fill_in_middle`` draws the form and two cuts of each text from a hash of its id, opens
   the one or two frames that the cuts fall into, and puts frames into the order of the
   form. All other frames move as they are. The frames of an output, one after the other,
   are a valid zstandard stream of its text.
3. ``digest_outputs`` streams the frames of each output, one at a time, and rebuilds the
   text from the output and its form alone, by looking for the sentinels.

A worker holds the compressed frames of one text and one open frame; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stowage.llm.shared import stored
from stowage.llm.text import SPACES, Words, slices, text_buffer

FRAME_BYTES = 1 << 16
SENTINELS = ("<P>", "<S>", "<M>")
SEED = 42
#: Of 100: texts that are rearranged, and of these those that are in the order suffix, prefix, middle.
RATE = 50
SPM_RATE = 80
#: The order of the parts (prefix 0, suffix 1, middle 2) in each form.
FORMS = {"psm": (0, 1, 2), "spm": (1, 0, 2)}
STORE = "doc_id long, n long, n_chars long, marked boolean, frames array<struct<units: long, chars: long, data: binary>>"
OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output array<binary>"
DIGESTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def store_frames(docs: DataFrame, path: str, sentinels=SENTINELS, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write each row of ``docs`` (``doc_id``, ``text``) to ``path`` as frames; gives the table.

    One row per input row, also for rows that repeat an id or have none: ``doc_id``, ``n``
    units, ``n_chars`` (code points), ``marked`` (the text holds a sentinel) and
    ``frames``. A null text is empty; an empty text has no frames. A unit longer than
    ``frame_bytes`` is one frame. An empty table gives an empty one. Other columns are
    not read.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    marked = F.lit(False)
    for sentinel in sentinels:
        marked = marked | F.contains(text, F.lit(sentinel))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), marked.alias("marked"))

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield _framed(batch, frame_bytes)

    return stored(rows.mapInArrow(frame, STORE), path)


def _framed(batch: pa.RecordBatch, frame_bytes: int) -> pa.RecordBatch:
    data, offsets = text_buffer(batch.column("text"))
    ends, bounds = unit_ends(data, offsets)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    coder = zstandard.ZstdCompressor(level=3)
    raw, units, before, payload, first = data.tobytes(), [], [], [], [0]
    for row in range(batch.num_rows):
        start, stop = int(offsets[row]), int(offsets[row + 1])
        mine = ends[bounds[row] : bounds[row + 1]]
        at, done = start, 0
        while at < stop:
            # The last unit that ends within the frame, or one unit that is longer.
            upto = len(mine) if stop - at <= frame_bytes else max(int(np.searchsorted(mine, at + frame_bytes, "right")), done + 1)
            end = int(mine[upto - 1])
            units.append(done)
            before.append(chars[at] - chars[start])
            payload.append(coder.compress(raw[at:end]))
            at, done = end, upto
        first.append(len(payload))
    frames = pa.StructArray.from_arrays(
        [pa.array(units, pa.int64()), pa.array(before, pa.int64()), pa.array(payload, pa.binary())], names=["units", "chars", "data"])
    return pa.record_batch({
        "doc_id": batch.column("doc_id"),
        "n": pa.array(np.diff(bounds)),
        "n_chars": pa.array(chars[offsets[1:]] - chars[offsets[:-1]]),
        "marked": batch.column("marked"),
        "frames": pa.ListArray.from_arrays(pa.array(first, pa.int32()), frames),
    })


def unit_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the units of all rows end in the buffer; those of row r are ``ends[bounds[r]:bounds[r + 1]]``."""
    words = Words(data, offsets, ~SPACES)
    filled = offsets[1:] > offsets[:-1]
    trailing = np.zeros(len(filled), bool)
    trailing[filled] = SPACES[data[offsets[1:][filled] - 1]]
    bounds = np.concatenate([[0], np.cumsum(words.counts + trailing)])
    ends = np.empty(bounds[-1], np.int64)
    last = bounds[1:][trailing] - 1
    own = np.ones(len(ends), bool)
    own[last] = False
    ends[own], ends[last] = words.ends, offsets[1:][trailing]
    return ends, bounds


def fill_in_middle(store: DataFrame, sentinels=SENTINELS, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """The output of every row of ``store_frames``.

    h1 to h4 are 32 bits each of the SHA-256 of ``seed:doc_id``; a missing id is the empty
    text there. The prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) units, the
    middle after the larger. A text that is empty, holds a sentinel, or has h3 % 100 >=
    ``rate`` is ``plain`` and stays as it is; otherwise the form is ``spm`` if h4 % 100 <
    ``spm_rate`` and ``psm`` if not. One row per row: ``doc_id``, ``n``, ``form``,
    ``prefix_chars`` and ``middle_chars`` (null if plain), and ``output``, its frames.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)

    def h(k: int) -> Column:
        return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")

    one, two = h(1) % (F.col("n") + 1), h(2) % (F.col("n") + 1)
    plain = (F.col("n") == 0) | F.col("marked") | (h(3) % 100 >= rate)
    form = F.when(plain, "plain").when(h(4) % 100 < spm_rate, "spm").otherwise("psm")
    rows = store.select("doc_id", "n", "n_chars", form.alias("form"), F.least(one, two).alias("first"), F.greatest(one, two).alias("second"), "frames")
    signs = [s.encode() for s in sentinels]

    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _arranged(batch, signs)

    return rows.mapInArrow(arrange, OUTPUT)


def _arranged(batch: pa.RecordBatch, signs: list[bytes]) -> pa.RecordBatch:
    coder = zstandard.ZstdCompressor(level=3)
    signs = [coder.compress(s) for s in signs]
    forms = batch.column("form").to_pylist()
    head, middle, output = [], [], []
    columns = (batch.column(c).to_pylist() for c in ("n", "n_chars", "first", "second", "frames"))
    for form, n, n_chars, first, second, frames in zip(forms, *columns, strict=True):
        if form == "plain":
            output.append([f["data"] for f in frames])
            head.append(None)
            middle.append(None)
            continue
        text = Framed(frames, n, n_chars)
        to_first, to_second = text.place(first), text.place(second)
        parts = [text.between(text.start, to_first), text.between(to_second, text.end), text.between(to_first, to_second)]
        output.append([f for k in FORMS[form] for f in (signs[k], *parts[k])])
        head.append(to_first.chars)
        middle.append(to_second.chars - to_first.chars)
    return pa.record_batch({
        "doc_id": batch.column("doc_id"), "n": batch.column("n"), "form": batch.column("form"),
        "prefix_chars": pa.array(head, pa.int64()), "middle_chars": pa.array(middle, pa.int64()),
        "output": pa.array(output, pa.list_(pa.binary())),
    })


class Place:
    """A cut: a frame, a byte within it, and the characters before."""

    def __init__(self, frame: int, byte: int, chars: int):
        self.frame, self.byte, self.chars = frame, byte, chars


class Framed:
    """One text as frames; opens those that a cut falls into, and no others."""

    def __init__(self, frames: list[dict], n: int, n_chars: int):
        self._frames, self._units = frames, [f["units"] for f in frames]
        self._n = n
        self._opened: dict[int, bytes] = {}
        self.start, self.end = Place(0, 0, 0), Place(len(frames), 0, n_chars)

    def place(self, unit: int) -> Place:
        """Where the first ``unit`` units end."""
        if unit >= self._n:
            return self.end
        k = int(np.searchsorted(self._units, unit, "right")) - 1
        within = unit - self._units[k]
        if within == 0:
            return Place(k, 0, self._frames[k]["chars"])
        data = np.frombuffer(self._open(k), np.uint8)
        byte = int(unit_ends(data, np.array([0, len(data)]))[0][within - 1])
        return Place(k, byte, self._frames[k]["chars"] + int(((data[:byte] & 0xC0) != 0x80).sum()))

    def between(self, start: Place, end: Place) -> list[bytes]:
        """The frames of the text between two cuts: whole ones as they are, parts compressed anew."""
        if start.frame == end.frame:
            return self._part(start.frame, start.byte, end.byte)
        whole = start.frame + (start.byte > 0)
        head = self._part(start.frame, start.byte, None) if start.byte else []
        return [*head, *(f["data"] for f in self._frames[whole : end.frame]), *self._part(end.frame, 0, end.byte)]

    def _part(self, k: int, start: int, end: int | None) -> list[bytes]:
        if end is not None and end <= start:
            return []
        return [zstandard.ZstdCompressor(level=3).compress(self._open(k)[start:end])]

    def _open(self, k: int) -> bytes:
        if k not in self._opened:
            self._opened[k] = zstandard.decompress(self._frames[k]["data"])
        return self._opened[k]


def digest_outputs(outputs: DataFrame, sentinels=SENTINELS) -> DataFrame:
    """SHA-256 of every output and of the text rebuilt from it (rows of DIGESTS)."""
    signs = [s.encode() for s in sentinels]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [
                (_sha256(opened(frames)), _sha256(restored(frames, form, signs)))
                for frames, form in zip(batch.column("output").to_pylist(), batch.column("form").to_pylist(), strict=True)
            ]
            of_output, of_text = zip(*pairs, strict=True) if pairs else ((), ())
            same = batch.select(["doc_id", "n", "form", "prefix_chars", "middle_chars"])
            yield pa.record_batch(
                [*same.columns, pa.array(of_output, pa.string()), pa.array(of_text, pa.string())],
                names=[*same.schema.names, "output_sha256", "restored_sha256"])

    return outputs.mapInArrow(digest, DIGESTS)


def opened(frames: list[bytes]) -> Iterator[bytes]:
    """The text of some frames, frame by frame."""
    coder = zstandard.ZstdDecompressor()
    for frame in frames:
        yield coder.decompress(frame)


def restored(frames: list[bytes], form: str, signs: list[bytes]) -> Iterator[bytes]:
    """The text that an output was made of, piece by piece.

    The first pass finds the sentinels, also such as lie across frames; the second reads
    prefix, middle and suffix. Units hold no sentinel, so the first match is the right one.
    """
    if form == "plain":
        yield from opened(frames)
        return
    order = [signs[k] for k in FORMS[form]]
    found, tail, size, sizes = [], b"", 0, []
    for chunk in opened(frames):
        seen, base = tail + chunk, size - len(tail)
        begin = max(0, found[-1] + len(order[len(found) - 1]) - base) if found else 0
        while len(found) < len(order) and (at := seen.find(order[len(found)], begin)) >= 0:
            begin = at + len(order[len(found)])
            found.append(base + at)
        size += len(chunk)
        sizes.append(len(chunk))
        tail = seen[max(0, len(seen) - max(map(len, order)) + 1) :]
    if len(found) != len(order):
        raise ValueError(f"output of form {form} lacks a sentinel")
    spans = [(at + len(sign), stop) for at, sign, stop in zip(found, order, [*found[1:], size], strict=True)]
    of = dict(zip(FORMS[form], spans, strict=True))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for part in (0, 2, 1):
        start, stop = of[part]
        k = int(np.searchsorted(starts, start, "right")) - 1
        while start < stop:
            chunk = zstandard.decompress(frames[k])[start - int(starts[k]) : stop - int(starts[k])]
            yield chunk
            start += len(chunk)
            k += 1


def _sha256(chunks: Iterator[bytes]) -> str:
    total = hashlib.sha256()
    for chunk in chunks:
        total.update(chunk)
    return total.hexdigest()
