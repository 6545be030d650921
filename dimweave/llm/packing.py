"""Packing: concatenate and cut.

Pass 1 tokenizes every document once and checkpoints the ids (two bytes each,
compressed) with the partition that holds them; the token totals of the
partitions are prefix-summed into global offsets.  Pass 2 walks each partition
from its offset and cuts the stream at every multiple of the window, which
yields one boundary record for each piece of a document.

The order of documents is that of the input's partitions, and of the rows
inside them; the checkpoint fixes it, so a task that runs again sees the same
stream.  Every sequence but the last is full.

Edge cases: null or empty text still has the closing id; equal and repeated
rows are packed one by one; a null doc_id is carried along; a document of any
length is cut as often as needed; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import byte_letters, checkpoint

WINDOW = 4096
#: Distinct words whose ids a task remembers before it starts over, and the
#: longest such word: some 100 MB, dropped with the task.
REMEMBERED, LONGEST = 300_000, 64
#: How the byte-level vocabulary with word ends prepares and cuts a text.
_NORMAL = ["NFC", "Replace", "Lowercase"]
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of ASCII (but A-Z) and lower-case letters of Latin-1, which no
#: normalisation changes, and the same cuts on them.
_PLAIN = re.compile(r"[!-@\[-~ß-öø-ÿ]+").fullmatch
_CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+").findall
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


@lru_cache(maxsize=1)
def _part_encoder(path: str):
    """For a byte-level BPE vocabulary with a mark at word ends, cut as above: a
    function from the UTF-8 bytes of one part of a word to its ids, else None.

    The mark is written as the byte FF, which UTF-8 never has.  The ids of the
    entries are the merges' ranks: single bytes, single bytes at word ends, then
    the merges in order."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    model, end = held["model"], held["model"].get("end_of_word_suffix")
    normal = [n["type"] for n in (held["normalizer"] or {}).get("normalizers", [])]
    cuts = [p.get("pattern", {}).get("Regex") for p in (held["pre_tokenizer"] or {}).get("pretokenizers", [])]
    if model.get("type") != "BPE" or not end or normal != _NORMAL or cuts[:1] != [_CUTS]:
        return None
    byte_of, ranks = byte_letters(), {}
    for token, i in model["vocab"].items():
        body = token.removesuffix(end)
        if all(c in byte_of for c in body):
            ranks[bytes(map(byte_of.__getitem__, body)) + b"\xff" * (body != token)] = i
    return tiktoken.Encoding("parts", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


class WordIds(dict):
    """Ids of whole texts by a tokenizer that never joins across white space:
    each distinct word is encoded once and its ids (little-endian unsigned 32
    bits) are remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.encode, self.encode_part = Tokenizer.from_file(path).encode, _part_encoder(path)

    def __missing__(self, word: str) -> bytes:
        if self.encode_part and _PLAIN(word) and "<|" not in word:  # special tokens start with <|
            found = [i for part in _CUT(word) for i in self.encode_part(part.encode() + b"\xff")]
        else:
            found = self.encode(word, add_special_tokens=False).ids
        ids = array("I", found).tobytes()
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        # The tokenizer lower-cases; A-Z are done here, so that fewer words differ.
        if "<|" not in text:
            text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
        # Only ASCII white space: every tokenizer here drops it between words.
        return b"".join(map(self.__getitem__, text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")))


def _tokenize(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, last = WordIds(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                raw = [ids_of.of(t or "") + last for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"].cast(pa.int64()), pa.array([len(r) // 4 for r in raw], pa.int64()),
                     pa.array([_pack(r) for r in raw], pa.binary())],
                    names=["doc_id", "doc_tokens", "ids"],
                )
    return run


def _pack(raw: bytes) -> bytes:
    ids = np.frombuffer(raw, "<u4")
    narrow = ids.astype("<u2")
    return b"2" + zlib.compress(narrow.tobytes(), 1) if np.array_equal(narrow, ids) else b"4" + zlib.compress(raw, 1)


def _unpack(packed: bytes) -> bytes:
    raw = zlib.decompress(packed[1:])
    return np.frombuffer(raw, "<u2").astype("<u4").tobytes() if packed[:1] == b"2" else raw


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            if at is None and batch.num_rows:
                at = batch["base"][0].as_py()
            out: list[tuple] = []
            for doc, n, packed in zip(batch["doc_id"].to_pylist(), batch["doc_tokens"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                raw, start = memoryview(_unpack(packed)), 0
                while start < n:
                    length = min(n - start, window - at % window)
                    out.append((doc, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]), n, at // window, at % window))
                    start, at = start + length, at + length
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
                )
    return run


def tokenize(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """doc_id, doc_tokens and the ids of every document, checkpointed."""
    return checkpoint(docs.select("doc_id", "text").mapInArrow(_tokenize(path, end_id), "doc_id long, doc_tokens long, ids binary"))


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = 2) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.  ``path`` is the tokenizer's vocabulary file."""
    tokens = tokenize(docs, path, end_id).withColumn("part", F.spark_partition_id())
    # One total for each partition: as many numbers as tasks, not as rows.
    totals = dict(tokens.groupBy("part").agg(F.sum("doc_tokens")).collect())
    bases, at = [], 0
    for part in sorted(totals):
        bases.append((part, at))
        at += totals[part]
    base = docs.sparkSession.createDataFrame(bases, "part int, base long")
    # A broadcast join keeps partitions and their order.
    return tokens.join(F.broadcast(base), "part").select("doc_id", "doc_tokens", "ids", "base").mapInArrow(_cut(window), PIECES)
