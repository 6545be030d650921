"""Fill-in-the-middle on texts kept as seekable compressed frames.

``store`` cuts every text into pieces of at most ``FRAME`` bytes and keeps each
as an independent zstandard frame, with the units (words with the white space
before them) that begin before the frame.  The frames, one after the other, are
a valid zstandard file.

* ``transform`` decompresses only the frames that hold a cut, to find its place;
  the output takes all other frames over as they are, in the order of the form.
* ``restore`` finds the markers of an output and puts its frames back in order.
* ``digest`` streams the frames in order.

No text is ever whole in memory, however long it is: a task holds the frames of
one row, compressed, and one frame of text.

Edge cases: null and empty texts have no units and no frames, and stay plain; a
text of white space is one unit; a text with a marker in it stays plain; cuts
before the first unit, behind the last, or on the same place give empty parts;
a null doc_id draws as an empty id; equal and repeated rows are transformed one
by one (rows that share a doc_id share its draws); an empty table gives no
rows; columns other than doc_id and text are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

#: Bytes of text in a frame (four at least, for one code point).
FRAME = 1 << 15
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_MARKS = (PREFIX, SUFFIX, MIDDLE)
#: What a frame is, and the units and code points that begin before it.
FRAMES = "array<struct<data: binary, units: bigint, chars: bigint>>"
_FRAMES = pa.list_(pa.struct([("data", pa.binary()), ("units", pa.int64()), ("chars", pa.int64())]))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(maxsize=1)
def _codec() -> tuple:
    """Compress and decompress; one of each for a worker."""
    return zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress


def _starts(data: bytes, before: int) -> np.ndarray:
    """Where units begin in a piece of text: at the start of the text and where
    white space follows something else; ``before`` is the byte in front (-1: none)."""
    space = _SPACE[np.frombuffer(data, np.uint8)]
    begins = np.empty(len(space), bool)
    begins[1:] = space[1:] & ~space[:-1]
    begins[0] = before < 0 or (space[0] and not _SPACE[before])
    return np.flatnonzero(begins)


def _chars(data: bytes) -> int:
    """Code points of a piece of UTF-8."""
    return int(((np.frombuffer(data, np.uint8) & 0xC0) != 0x80).sum())


def _pieces(data: bytes) -> Iterator[bytes]:
    """At most FRAME bytes each, cut between code points."""
    at = 0
    while at < len(data):
        end = min(at + FRAME, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


@dataclass
class Text:
    """A text in frames, how many units and code points it has, and whether it
    holds a marker."""

    frames: list[dict]
    units: int
    chars: int
    marked: bool


def pack_text(text: str | None) -> Text:
    compress, _ = _codec()
    out, units, chars, before = [], 0, 0, -1
    data = (text or "").encode("utf-8", "surrogatepass")
    for piece in _pieces(data):
        out.append({"data": compress(piece), "units": units, "chars": chars})
        units, chars, before = units + len(_starts(piece, before)), chars + _chars(piece), piece[-1]
    return Text(out, units, chars, any(m in data for m in _MARKS))


def _split(frames: list[dict], units: int, chars: int, cut: int) -> tuple[list[dict], list[dict], int]:
    """The frames before and behind the start of unit ``cut`` (all of them
    before, if there is none), and the code points before it.  Only the frame
    that holds the cut is decompressed."""
    compress, decompress = _codec()
    if cut >= units:
        return frames, [], chars
    k = int(np.searchsorted([f["units"] for f in frames], cut, side="right")) - 1
    piece = decompress(frames[k]["data"])
    # Whether the frame's first byte begins a unit shows in its counts alone.
    inside = _starts(piece, 0x20)
    here = (frames[k + 1]["units"] if k + 1 < len(frames) else units) - frames[k]["units"]
    if len(inside) < here:
        inside = np.append(0, inside)
    at = int(inside[cut - frames[k]["units"]])
    if at == 0:
        return frames[:k], frames[k:], frames[k]["chars"]
    head, tail = piece[:at], piece[at:]
    done = frames[k]["chars"] + _chars(head)
    first, second = {**frames[k], "data": compress(head)}, {"data": compress(tail), "units": cut, "chars": done}
    return [*frames[:k], first], [second, *frames[k + 1 :]], done


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit draws of a document."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(h[k : k + 8], 16) for k in (0, 8, 16, 24))


def transform_text(held: Text, doc_id: int | None, seed: int, rate: int, spm: int) -> tuple[str, int | None, int | None, list[dict]]:
    """Form, code points of prefix and middle, and the frames of the output."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not held.frames or held.marked or h3 % 100 >= rate:
        return "plain", None, None, held.frames
    lo, hi = sorted((h1 % (held.units + 1), h2 % (held.units + 1)))
    rest, suffix, end = _split(held.frames, held.units, held.chars, hi)
    prefix, middle, start = _split(rest, hi, end, lo)
    form = "spm" if h4 % 100 < spm else "psm"
    parts = ((SUFFIX, suffix), (PREFIX, prefix), (MIDDLE, middle)) if form == "spm" else ((PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle))
    compress, _ = _codec()
    return form, start, end - start, [f for mark, frames in parts for f in ({"data": compress(mark)}, *frames)]


def restore_frames(form: str, data: list[bytes]) -> list[bytes]:
    """The frames of the text that gave an output, from the output's frames.
    They are read for the markers, which may lie anywhere in them."""
    if form == "plain":
        return data
    compress, decompress = _codec()
    order = (SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE)
    found: dict[bytes, list[bytes]] = {m: [] for m in order}
    part, left = None, b""
    for frame in data:
        # ``left`` is the end of the frame before, if a marker may begin in it.
        piece, whole = left + decompress(frame), not left
        left = b""
        while (k := 0 if part is None else order.index(part) + 1) < 3 and (at := piece.find(order[k])) >= 0:
            if part is not None and at:
                found[part].append(compress(piece[:at]))
            part, piece, whole = order[k], piece[at + 3 :], False
        if k < 3:
            keep = next((n for n in (2, 1) if piece.endswith(order[k][:n])), 0)
            if keep:
                piece, left, whole = piece[:-keep], piece[-keep:], False
        if part is not None and piece:
            found[part].append(frame if whole else compress(piece))
    if left:
        found[part].append(compress(left))
    return found[PREFIX] + found[MIDDLE] + found[SUFFIX]


def digest(data: list[bytes]) -> str:
    """Hexadecimal sha256 of the text in the frames."""
    _, decompress = _codec()
    h = hashlib.sha256()
    for frame in data:
        h.update(decompress(frame))
    return h.hexdigest()


def read(data: list[bytes]) -> str:
    _, decompress = _codec()
    return b"".join(map(decompress, data)).decode("utf-8", "surrogatepass")


# ------------------------------------------------------------------ as jobs
def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            held = [pack_text(t) for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"].cast(pa.int64()), pa.array([h.units for h in held], pa.int64()), pa.array([h.chars for h in held], pa.int64()),
                 pa.array([h.marked for h in held], pa.bool_()), pa.array([h.frames for h in held], _FRAMES)],
                names=["doc_id", "n", "n_chars", "marked", "frames"])


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n (units), n_chars, marked and the frames of each text."""
    return docs.select("doc_id", "text").mapInArrow(_store, f"doc_id long, n long, n_chars long, marked boolean, frames {FRAMES}")


def _transform(seed: int, rate: int, spm: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = part.to_pylist()
                got = [transform_text(Text(r["frames"], r["n"], r["n_chars"], r["marked"]), r["doc_id"], seed, rate, spm) for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["n"], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.int64()),
                     pa.array([g[2] for g in got], pa.int64()), pa.array([[f["data"] for f in g[3]] for g in got], pa.list_(pa.binary()))],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def transform(stored: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the output's frames, for
    ``rate`` per cent of the stored texts (``spm`` per cent of them with the
    suffix first), the others as they are."""
    return stored.mapInArrow(
        _transform(seed, rate, spm), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output array<binary>")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        frames = batch["output"].to_pylist()
        restored = [digest(restore_frames(form, data)) for form, data in zip(batch["form"].to_pylist(), frames, strict=True)]
        kept = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
        yield pa.RecordBatch.from_arrays(
            [*(batch[c] for c in kept), pa.array([digest(f) for f in frames], pa.string()), pa.array(restored, pa.string())],
            names=[*kept, "output_sha256", "restored_sha256"])


def digests(transformed: DataFrame) -> DataFrame:
    """The rows of ``transform`` with the digests of the output and of the text
    rebuilt from it, in place of the output."""
    return transformed.mapInArrow(
        _digests, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):  # one text at a time
            row = batch.slice(k, 1)
            yield pa.RecordBatch.from_arrays([row["doc_id"], row["form"], pa.array([read(row["output"][0].as_py())])], names=["doc_id", "form", "output"])


def texts(transformed: DataFrame) -> DataFrame:
    """doc_id, form and the output as text."""
    return transformed.select("doc_id", "form", "output").mapInArrow(_texts, "doc_id long, form string, output string")
