"""Helpers shared by the operators: lineage cuts, size-checked joins, hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.session import ensure_checkpoint_dir

#: A side is broadcast only after its rows were counted and are at most this
#: many (a few narrow columns each: some MB); beyond it the join shuffles.
BROADCAST_ROWS = 200_000


def scratch(spark: SparkSession) -> str:
    """The shared folder for checkpoints that the session names (see ``session``
    for one that names none)."""
    return ensure_checkpoint_dir(spark).rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint in the shared folder."""
    scratch(df.sparkSession)
    return df.checkpoint()


def small(df: DataFrame, limit: int = BROADCAST_ROWS, values: str | None = None) -> DataFrame:
    """``df`` (already checkpointed) with a broadcast hint if its row count, and
    the number of elements in its array column ``values``, prove it small;
    otherwise unchanged, so that the join shuffles."""
    rows, elements = df.agg(F.count(F.lit(1)), F.sum(F.size(values)) if values else F.lit(0)).first()
    return F.broadcast(df) if rows <= limit and (elements or 0) <= 5 * limit else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in parts, so that few texts are Python objects at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


# ---------------------------------------------------------------- hashing
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: a bijection of 64-bit words."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


#: One random 64-bit word for each byte value, and the odd base of the rolling hash.
with np.errstate(over="ignore"):
    BYTE_WORDS = mix64((np.arange(1, 257, dtype=np.uint64)) * _GOLD)
BASE = 0x9E6C63D0876A9A47
#: Powers of the base that are kept (4 MB); longer texts make their own.
KEPT_POWERS = 1 << 18


def _make_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, BASE, np.uint64), np.full(n + 1, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


_POWERS = _make_powers(KEPT_POWERS)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i = 0 .. n, or more."""
    return _POWERS if n <= KEPT_POWERS else _make_powers(n)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] the unscaled rolling hash of data[i:j]."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(BYTE_WORDS[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end) from their prefix hashes."""
    _, down = powers(len(prefix))
    with np.errstate(over="ignore"):
        h = (prefix[end] - prefix[start]) * down[start]
        return mix64(h + (end - start).astype(np.uint64) * _GOLD)


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character: the
    printable bytes of Latin-1 as themselves, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(other)}


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes other than space and 09-0D."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~_SPACE[data]
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(text: str | bytes | None) -> np.ndarray:
    """One 64-bit hash for each word of the text (or its UTF-8), A-Z lower-cased."""
    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw.lower(), np.uint8)
    start, end = word_spans(data)
    return span_hash(prefix_hash(data), start, end)


def sequence_hash(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words."""
    n = len(h) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width if n > 0 else 0):
            out = mix64(out * np.uint64(BASE) + h[j : j + n])
    return out
