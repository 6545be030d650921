"""Alignment of the tokens of two tokenizers.

Both tokenizers cut the same bytes (a space and the text).  Laid end to end,
the documents of a batch give every token a start on one axis, so
``pandas.merge_asof``, keyed by document, finds for each token start the token
of the other side that covers it.  The two directions together are all pairs of
tokens that share a byte: of two such tokens the one that starts later has its
start inside the other.  Pairs that also end together are links; their ends cut
both sequences into groups.

* ``align``: ids, overlapping pairs and groups of every document.
* ``profiles``: counts and digests of every document, with how often the id
  pairs of its links are linked in the whole corpus.

The corpus counts need no join with the documents: of two tokens that end
together the shorter is a suffix of the longer, so the two vocabularies bound
the id pairs that can occur (``possible_pairs``), whatever the corpus.  The
table of counts is broadcast under that bound.

Edge cases: null or empty texts, and texts that a tokenizer does not give back
byte for byte (it normalises them, or they hold its space mark), have no
tokens: all counts are 0 and the digest is ''; such texts add nothing to the
corpus counts.  Equal and repeated rows are aligned, and counted, one by one; a
null doc_id is carried along; a text of any length is one unit of memory (some
100 bytes for each of its tokens); an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import byte_letters, checkpoint

#: Bytes of text that are aligned together (a longer text is alone).
TOGETHER = 1 << 19
#: Corpus counts are broadcast if no more id pairs than this are possible
#: (24 bytes each); with larger vocabularies they are joined.
BROADCAST_PAIRS = 2_000_000


class ByteLevel:
    """A byte-level BPE vocabulary file (JSON); special tokens in a text are plain text."""

    #: Fixed value: how the tokenizer cuts a text into words before merging.
    WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        byte_of, special = byte_letters(), {t["content"] for t in held["added_tokens"]}
        entries = {t: i for t, i in held["model"]["vocab"].items() if t not in special}
        self.entries: list[bytes] = [b""] * (1 + max(entries.values()))
        for token, i in entries.items():
            self.entries[i] = bytes(map(byte_of.__getitem__, token))
        # Ids grow in the order of the merges, so they are the merge ranks.
        self._encode = tiktoken.Encoding("byte level", pat_str=self.WORDS, special_tokens={},
                                         mergeable_ranks={e: i for i, e in enumerate(self.entries) if e}).encode_to_numpy

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._encode(" " + t, disallowed_special=()).astype(np.int32) for t in texts]


class Pieces:
    """A sentencepiece model, which puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.entries = [
            bytes([int(self._model.id_to_piece(i)[3:5], 16)]) if self._model.is_byte(i)
            else self._model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self._model.get_piece_size())
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int32) for ids in self._model.encode(texts, num_threads=1)]


@lru_cache(maxsize=4)
def _load(path: str) -> ByteLevel | Pieces:
    return Pieces(path) if path.endswith(".model") else ByteLevel(path)


def possible_pairs(a: list[bytes], b: list[bytes]) -> int:
    """How many id pairs can end together at most: one entry is a suffix of the other."""
    total = 0
    for longer, shorter, equal in ((a, b, True), (b, a, False)):
        by_bytes: dict[bytes, int] = {}
        for entry in shorter:
            by_bytes[entry] = by_bytes.get(entry, 0) + 1
        for entry in longer:
            total += sum(by_bytes.get(entry[k:], 0) for k in range(0 if equal else 1, len(entry)))
    return total


@dataclass
class Aligned:
    """Some documents laid end to end; a_doc, b_doc: the document of each token."""

    a: np.ndarray
    b: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    a_end: np.ndarray
    b_end: np.ndarray
    over_a: np.ndarray  # overlapping pairs: places in a and b
    over_b: np.ndarray

    @property
    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places in a and b of the pairs that end together, in order."""
        together = self.a_end[self.over_a] == self.b_end[self.over_b]
        i, j = self.over_a[together], self.over_b[together]
        order = np.argsort(i, kind="stable")
        return i[order], j[order]


def _whole(table: list[bytes], ids: np.ndarray, data: bytes) -> bool:
    return b"".join(map(table.__getitem__, ids.tolist())) == data


def align_texts(texts: list[str | None], a_side: ByteLevel | Pieces, b_side: ByteLevel | Pieces) -> Aligned:
    """All pairs of overlapping tokens of the texts."""
    sides = (a_side, b_side)
    asked = [k for k, t in enumerate(texts) if t]
    ids = [dict(zip(asked, s.encode([texts[k] for k in asked]), strict=True)) for s in sides]
    kept = [k for k in asked if all(_whole(s.entries, i[k], b" " + texts[k].encode("utf-8", "surrogatepass")) for s, i in zip(sides, ids, strict=True))]
    frames, ends = [], []
    for side, of in zip(sides, ids, strict=True):
        length = np.fromiter(map(len, side.entries), np.int64, len(side.entries))
        token = np.concatenate([of[k] for k in kept] or [np.zeros(0, np.int32)])
        end = np.cumsum(length[token])
        ends.append(end)
        frames.append(pd.DataFrame({
            "start": end - length[token], "doc": np.repeat(np.array(kept, np.int64), [len(of[k]) for k in kept]),
            "token": token, "place": np.arange(len(token))}))
    a, b = frames
    # Each start of a in the token of b that covers it, and the other way round;
    # equal starts are found by both.
    ab = pd.merge_asof(a, b, on="start", by="doc", suffixes=("", "_other"))
    ba = pd.merge_asof(b, a, on="start", by="doc", suffixes=("", "_other"), allow_exact_matches=False).dropna(subset="place_other")
    covers = ba["place_other"].to_numpy(np.int64)
    inside = ends[0][covers] > ba["start"].to_numpy()  # else the token before ends where this one starts
    over_a = np.concatenate([ab["place"].to_numpy(), covers[inside]])
    over_b = np.concatenate([ab["place_other"].to_numpy(np.int64), ba["place"].to_numpy()[inside]])
    return Aligned(a["token"].to_numpy(), b["token"].to_numpy(), a["doc"].to_numpy(), b["doc"].to_numpy(), *ends, over_a, over_b)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most TOGETHER bytes of text, or one row."""
    sizes = np.array([len(t or "") for t in batch["text"].to_pylist()], np.int64)
    at = 0
    while at < batch.num_rows:
        n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), TOGETHER, side="right")))
        yield batch.slice(at, n)
        at += n


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values))


def _rows(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                n = part.num_rows
                got = align_texts(part["text"].to_pylist(), _load(a_path), _load(b_path))
                counts = [np.bincount(d, minlength=n) for d in (got.a_doc, got.b_doc)]
                first = [np.concatenate([[0], np.cumsum(c)[:-1]]) for c in counts]
                order = np.lexsort((got.over_b, got.over_a))
                i, j = got.over_a[order], got.over_b[order]
                doc = got.a_doc[i]
                many = np.bincount(doc, minlength=n)
                linked = got.links
                linked_doc = got.a_doc[linked[0]]
                cuts = np.bincount(linked_doc, minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"].cast(pa.int64()), _lists(got.a, counts[0]), _lists(got.b, counts[1]),
                     _lists((i - first[0][doc]).astype(np.int32), many), _lists((j - first[1][doc]).astype(np.int32), many),
                     _lists((linked[0] + 1 - first[0][linked_doc]).astype(np.int32), cuts), _lists((linked[1] + 1 - first[1][linked_doc]).astype(np.int32), cuts)],
                    names=["doc_id", "a_ids", "b_ids", "overlap_a", "overlap_b", "group_end_a", "group_end_b"])
    return run


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row for each document: doc_id, the ids of both sides, the places of
    the overlapping tokens (overlap_a[k] with overlap_b[k]), and for each group
    how many tokens of either side stand before its end."""
    return docs.select("doc_id", "text").mapInArrow(
        _rows(a_path, b_path),
        "doc_id long, a_ids array<int>, b_ids array<int>, overlap_a array<int>, overlap_b array<int>, group_end_a array<int>, group_end_b array<int>")


#: An id pair is one number: the id of A times this, and the id of B.
_PAIR = 1 << 24


@lru_cache(maxsize=4)
def _written(n: int, inner: str, last: str) -> np.ndarray:
    """The ids in decimal, each followed by one mark inside a group and another at its end."""
    return np.array([f"{i}{mark}" for i in range(n) for mark in (inner, last)], object)


def _digests(got: Aligned, n: int, a_size: int, b_size: int) -> list[str]:
    """For each of the n documents the sha256 of its groups, '' without tokens."""
    i, j = got.links
    # Tokens in the order of the text: the group's of A, then the group's of B.
    before_a, before_b = np.concatenate([[0], i + 1]), np.concatenate([[0], j + 1])
    last_a, last_b = np.zeros(len(got.a), np.int64), np.zeros(len(got.b), np.int64)
    last_a[i], last_b[j] = 1, 1
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    out = np.empty(len(got.a) + len(got.b), object)
    out[np.arange(len(got.a)) + before_b[group_a]] = _written(a_size, ",", "|")[2 * got.a + last_a]
    out[np.arange(len(got.b)) + before_a[group_b + 1]] = _written(b_size, ",", ";")[2 * got.b + last_b]
    size = np.bincount(got.a_doc, minlength=n) + np.bincount(got.b_doc, minlength=n)
    digests, at = [], 0
    for k in size.tolist():
        digests.append(hashlib.sha256("".join(out[at : at + k].tolist())[:-1].encode()).hexdigest() if k else "")
        at += k
    return digests


def _profile(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side = _load(a_path), _load(b_path)
        for batch in batches:
            for part in _parts(batch):
                n = part.num_rows
                got = align_texts(part["text"].to_pylist(), a_side, b_side)
                i, j = got.links
                doc = got.a_doc[i]
                links = np.bincount(doc, minlength=n)
                # The id pairs of each document with how many links hold them.
                pair = got.a[i].astype(np.int64) * _PAIR + got.b[j]
                order = np.lexsort((pair, doc))
                pair, doc = pair[order], doc[order]
                new = np.ones(len(pair), bool)
                new[1:] = (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])
                at = np.flatnonzero(new)
                distinct = np.bincount(doc[at], minlength=n)
                times = np.diff(np.append(at, len(pair))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"].cast(pa.int64()), pa.array(np.bincount(got.a_doc, minlength=n)), pa.array(np.bincount(got.b_doc, minlength=n)),
                     pa.array(links), pa.array(links),
                     pa.array(_digests(got, n, len(a_side.entries), len(b_side.entries)), pa.string()),
                     _lists(pair[at], distinct), _lists(times, distinct)],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
    return run


def _against(table):
    """n_best and count_sum of each document from the corpus counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = table.value
        for batch in batches:
            asked, times = batch["pairs"].flatten().to_numpy(), batch["times"].flatten().to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(batch.num_rows), batch["pairs"].value_lengths().to_numpy())
            at = np.searchsorted(pairs, asked)
            total, top = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, doc, counts[at] * times)
            np.add.at(top, doc, best[at] * times)
            kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array(top), pa.array(total), batch["groups_sha256"]],
                names=[*kept, "n_best", "count_sum", "groups_sha256"])
    return run


def pair_counts(profiled: DataFrame) -> DataFrame:
    """pair, links: how many links of the corpus hold each id pair; best: whether
    no pair with the same id of B has more."""
    counts = checkpoint(
        profiled.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("links")))
    most = counts.groupBy((F.col("pair") % _PAIR).alias("b_id")).agg(F.max("links").alias("most"))
    return counts.join(most, F.col("pair") % _PAIR == F.col("b_id")).select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def _joined(found: DataFrame) -> DataFrame:
    """The documents with n_best and count_sum by a join, for vocabularies whose
    possible pairs are too many to broadcast."""
    rows = checkpoint(found.withColumn("row", F.monotonically_increasing_id()))
    asked = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.times", F.col("p.pairs").alias("pair"))
    sums = asked.join(checkpoint(pair_counts(found)), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("links")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def profiles(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row for each document: doc_id, n_a, n_b, n_groups, n_links, n_best
    (links whose id pair is the most frequent one of its id of B in the corpus,
    ties included), count_sum (corpus counts summed over the links) and
    groups_sha256 (of ``a1,a2|b1;a3|b2,b3``)."""
    found = checkpoint(docs.select("doc_id", "text").mapInArrow(
        _profile(a_path, b_path),
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"))
    if possible_pairs(_load(a_path).entries, _load(b_path).entries) > BROADCAST_PAIRS:
        return _joined(found)
    held = pair_counts(found).toArrow().sort_by("pair")
    table = docs.sparkSession.sparkContext.broadcast(
        (held["pair"].to_numpy(), held["links"].to_numpy(), held["best"].to_numpy().astype(np.int64)))
    return found.mapInArrow(
        _against(table), "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
