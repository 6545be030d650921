"""Suffix-array dedup: removes every byte covered by a repeated string.

A string of ``LENGTH`` bytes is repeated if it also starts anywhere else, in
the same document or another; matches never cross documents.

1. Each such string has a canonical anchor: the least hash among its first
   ``REACH`` byte 16-grams.  Equal strings have it at the same place, so they
   can only be found among anchors with equal following bytes (the core).
   Neighbouring strings share their anchor; what they cover together is the
   anchor's context.
2. Equal contexts are counted.  A core with one context needs no sorting: its
   strings are repeated if and only if the context is.
3. The contexts of a core are cut into blocks of ``BLOCK`` bytes, aligned at
   the anchor, with the core as one symbol, and the suffixes of many contexts
   are sorted together by grouping (see ``suffix_array``).  Suffixes that agree
   in as many symbols as a string has whole blocks stand side by side; in such
   a run the strings are told apart by the few bytes at their two ends.

All strings of a context contain its core, so what is removed around an anchor
is one interval, from its first to its last repeated string.  The contexts of a
core with more than ``TOGETHER`` of them are cut into pieces by where a string
starts before the anchor; the strings of a piece share most of their bytes, which
become its core.  So equal strings still meet in one group, equal pieces are
counted and sorted once, and the groups are small again.  Only a piece's core with
more than ``TOGETHER`` different pieces is dealt out to several tasks; strings that
a task found no partner for then meet by hash, one of each kind.

Edge cases: null or empty texts, and texts shorter than LENGTH bytes, lose
nothing (null counts as empty); rows that repeat a text repeat all its strings,
whatever their ids; texts may be of any length; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import KEPT_POWERS, checkpoint, mix64, partitions, prefix_hash, slices, small, span_hash

LENGTH = 400
REACH = 240
GRAM = 16
BLOCK = 16
#: Bytes after an anchor that all its strings have, and their whole blocks.
CORE = LENGTH + 1 - REACH
CORE_BLOCKS = CORE // BLOCK
#: Symbols of a string: its whole blocks whatever its offset, the core as one.
SYMBOLS = LENGTH // BLOCK - 1 - CORE_BLOCKS + 1
TOGETHER = 4096
#: Starts that make a piece of a context whose core has more.
PIECE = 60
#: Symbols sorted at a time.
SORTED = 200_000
#: Bytes of a pile whose strings are hashed at a time: the kept powers suffice, so
#: none are made anew (for every call, as many as a pile has bytes).
HASHED = KEPT_POWERS // 2
#: A context is common if it has more than COMMON rows and more than one in
#: COMMON_KEYS of all rows, so there are fewer than COMMON_KEYS such contexts.
COMMON = 1000
COMMON_KEYS = 20_000
_MASK = np.uint64(0xFFFFFFFF)


# ---------------------------------------------------------------- suffix array
def suffix_array(s: list[int]) -> list[int]:
    """Suffix array of ``s``, whose last symbol is its unique least.

    Phase 1 orders the suffixes by their longest Lyndon prefix.  Groups, first
    of one symbol, are taken in descending order.  Each member points to the
    nearest suffix before it that is in a smaller group; a suffix that members
    point to has its prefix extended by theirs, so it leaves its group for a
    new one right behind, further back the more members point to it.

    Phase 2 fills the groups in ascending order.  A suffix goes to the next
    slot of its group as soon as the suffix behind its Lyndon prefix has its
    place; those suffixes are found along the same pointers.
    """
    n = len(s)
    order = np.argsort(np.array(s), kind="stable").tolist()
    place, group, size = [0] * n, [0] * n, [0] * n
    start = 0
    for k, i in enumerate(order):
        if s[i] != s[order[start]]:
            start = k
        place[i], group[i] = k, start
        size[start] += 1
    before = list(range(-1, n - 1))
    end = n
    while end > 0:
        start = group[order[end - 1]]
        hits: dict[int, int] = {}
        for i in sorted(order[start:end]) if end - start > 1 else order[start:end]:
            j = before[i]
            while j >= 0 and group[j] >= start:
                j = before[j]
            before[i] = j
            if j >= 0:
                hits[j] = hits.get(j, 0) + 1
        end = start
        levels: dict[int, list[int]] = {}
        for j, times in hits.items():
            levels.setdefault(times, []).append(j)
        for times in sorted(levels, reverse=True):
            moved: dict[int, int] = {}
            for j in levels[times]:
                g = group[j]
                m = moved[g] = moved.get(g, 0) + 1
                to, at = g + size[g] - m, place[j]
                other = order[to]
                order[at], order[to] = other, j
                place[other], place[j] = at, to
            for j in levels[times]:
                g = group[j]
                group[j] = g + size[g] - moved[g]
            for g, m in moved.items():
                left = size[g] - m
                size[g + left] = m
                if left:
                    size[g] = left
    out, slot, done = [0] * n, list(range(n)), [False] * n
    out[0] = n - 1
    done[n - 1] = True
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[slot[g]] = j
            slot[g] += 1
            done[j] = True
            j = before[j]
    return out


# ---------------------------------------------------------------- anchors
def anchors(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """core hash, context hash, first and last string start, and anchor, for
    every anchor of a document."""
    n = len(data)
    if n < LENGTH:
        empty = np.zeros(0, np.int64)
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    p = prefix_hash(data)
    at = np.arange(n - GRAM + 1)
    value = (span_hash(p, at, at + GRAM) & ~_MASK) | at.astype(np.uint64)
    # Minima of REACH neighbours: of the rest of one block and the start of the next.
    value = np.concatenate([value, np.full(-len(value) % REACH, 0xFFFFFFFFFFFFFFFF, np.uint64)]).reshape(-1, REACH)
    head = np.minimum.accumulate(value, axis=1).ravel()
    tail = np.minimum.accumulate(value[:, ::-1], axis=1)[:, ::-1].ravel()
    start = np.arange(n - LENGTH + 1)
    anchor = (np.minimum(tail[start], head[start + REACH - 1]) & _MASK).astype(np.int64)
    cut = np.flatnonzero(np.diff(anchor)) + 1
    lo, hi = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(anchor) - 1]])
    a = anchor[lo]
    context = mix64(span_hash(p, lo, hi + LENGTH) ^ mix64(((a - lo) * REACH + (hi - lo)).astype(np.uint64)))
    return span_hash(p, a, a + CORE), context, lo, hi, a


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 200):
            part = batch.slice(k, 200)
            got = [anchors(np.frombuffer(_bytes(t), np.uint8)) for t in part["text"].to_pylist()]
            rows = pa.array(np.repeat(np.arange(len(got)), [len(g[0]) for g in got]))
            core, context, lo, hi, a = (np.concatenate([g[c] for g in got]) for c in range(5))
            if len(core):
                yield pa.RecordBatch.from_arrays(
                    [part["t1"].take(rows), part["t2"].take(rows), pa.array(core.view(np.int64)), pa.array(context.view(np.int64)),
                     pa.array(lo << 16 | (a - lo) << 8 | (hi - lo))],
                    names=["t1", "t2", "core", "context", "spot"])


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts that are asked for, text by text."""
    for batch in batches:
        for text, asked in zip(batch["text"].to_pylist(), batch["asked"].to_pylist(), strict=True):
            data = _bytes(text)
            out = []
            for x in asked:
                lo = x["spot"] >> 16
                out.append((x["core"], x["context"], x["copies"], x["spot"] & 0xFFFF, data[lo : lo + (x["spot"] & 0xFF) + LENGTH]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _KINDS, strict=True)], names=_CONTEXT)


_CONTEXT = ["core", "context", "copies", "shape", "data"]
_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts cut into pieces: the strings that start PIECE * j bytes before
    the anchor or up to PIECE - 1 more share LENGTH - PIECE + 1 bytes, which are
    the core of the piece."""
    for batch in batches:
        out = []
        for core, context, copies, shape, data in zip(*(batch[c].to_pylist() for c in _CONTEXT), strict=True):
            before, span = shape >> 8, shape & 0xFF
            for j in range((before - span) // PIECE, before // PIECE + 1):
                most, least = min(before, PIECE * j + PIECE - 1), max(before - span, PIECE * j)
                shared = data[before - PIECE * j : before - PIECE * j + LENGTH - PIECE + 1]
                piece = data[before - most : before - least + LENGTH]
                new = int.from_bytes(hashlib.blake2b(b"%d,%d;" % (core, j) + shared, digest_size=8).digest(), "little", signed=True)
                own = int.from_bytes(hashlib.blake2b(b"%d,%d;" % (most, least) + piece, digest_size=8).digest(), "little", signed=True)
                out.append((new, own, copies, most << 8 | (most - least), piece, core, context))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (*_KINDS, pa.int64(), pa.int64()), strict=True)], names=[*_CONTEXT, "of_core", "of_context"])


# ---------------------------------------------------------------- sorting
class _Pile:
    """Contexts gathered for one sort; ``dealt`` marks those of dealt-out cores."""

    def __init__(self):
        self.rows: list[tuple[int, int, int, int, bytes, bool]] = []
        self.symbols = 0

    def add(self, core: int, context: int, copies: int, shape: int, data: bytes, dealt: bool) -> None:
        self.rows.append((core, context, copies, shape, data, dealt))
        self.symbols += (len(data) - CORE) // BLOCK + 2

    def sort(self) -> tuple[list[tuple[int, int, int, int]], tuple[np.ndarray, ...]]:
        """(core, context, first, last): what is repeated, as offsets before the
        anchor; and for dealt-out cores one string of each kind, as columns:
        core, context, offset and two hashes."""
        cores = {}
        pieces, text_of, block_of, raw = [], [], [], []
        for r, (core, _, _, shape, data, _) in enumerate(self.rows):
            before, after = shape >> 8, len(data) - (shape >> 8) - CORE_BLOCKS * BLOCK
            left, right = before // BLOCK, after // BLOCK
            a = before - left * BLOCK
            b = before + CORE_BLOCKS * BLOCK
            raw.append(data[a:before])
            raw.append(data[b : b + right * BLOCK])
            text_of.append(np.full(left + 1 + right + 1, r))
            block_of.append(np.concatenate([np.arange(left, -1, -1), np.full(right + 1, -1)]))
            pieces.append((left, right, cores.setdefault(core, len(cores))))
        blocks = np.frombuffer(b"".join(raw), np.uint64).reshape(-1, BLOCK // 8)
        by_bytes = np.lexsort(blocks.T)
        name = np.zeros(len(blocks), np.int64)
        name[by_bytes[1:]] = np.cumsum((blocks[by_bytes[1:]] != blocks[by_bytes[:-1]]).any(axis=1))
        name, at, s = (name + 2 + len(cores)).tolist(), 0, []
        for left, right, core in pieces:
            s += name[at : at + left]
            s.append(2 + core)
            s += name[at + left : at + left + right]
            s.append(1)
            at += left + right
        s.append(0)
        array = np.array(suffix_array(s), np.int64)
        text, block = np.append(np.concatenate(text_of), -1), np.append(np.concatenate(block_of), -1)
        # Suffixes that can start a string: in front of the core or at it, and long enough.
        spots = array[block[array] >= 0]
        sym = np.concatenate([np.array(s, np.int64), np.zeros(SYMBOLS, np.int64)])
        ends = np.array([left + 1 + right for left, right, _ in pieces])
        first_of = np.concatenate([[0], np.cumsum(ends + 1)[:-1]])
        spots = spots[first_of[text[spots]] + ends[text[spots]] - spots >= SYMBOLS]
        if not len(spots):
            return [], ()
        view = np.lib.stride_tricks.sliding_window_view(sym, SYMBOLS)
        differs = np.concatenate([[True], (view[spots[1:]] != view[spots[:-1]]).any(axis=1)])
        run = np.cumsum(differs) - 1
        return self._ends(text[spots], block[spots], run)

    def _ends(self, text, block, run):
        """Tell apart the strings of each run by their bytes outside whole blocks."""
        shape = np.array([x[3] for x in self.rows])
        copies = np.array([x[2] for x in self.rows])
        dealt = np.array([x[5] for x in self.rows])
        before, span = shape >> 8, shape & 0xFF
        size = np.array([len(x[4]) for x in self.rows])
        base = np.concatenate([[0], np.cumsum(size)[:-1]])
        data = np.frombuffer(b"".join(x[4] for x in self.rows) + bytes(LENGTH), np.uint8)
        words = data.astype(np.uint64)
        first = np.full(len(self.rows), -1)
        last = np.full(len(self.rows), -1)
        lonely = np.flatnonzero(dealt)
        single: list[np.ndarray] = []
        for extra in range(BLOCK):
            offset = block * BLOCK + extra  # bytes before the anchor
            fits = (offset <= before[text]) & (offset >= before[text] - span[text])
            t, o, r = text[fits], offset[fits], run[fits]
            if not len(t):
                continue
            begin = base[t] + before[t] - o
            key = mix64(r.astype(np.uint64))
            for k in range(extra):
                key = mix64(key ^ (words[begin + k] + np.uint64(1 + 256 * k)))
            for k in range(extra, BLOCK):
                key = mix64(key ^ (words[begin + LENGTH - BLOCK + k] + np.uint64(1 + 256 * k)))
            _, lead, kind, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            kind = kind.ravel()
            # The ends are compared byte by byte with those of the kind's first string.
            for k in (*range(extra), *range(LENGTH - BLOCK + extra, LENGTH)):
                if (data[begin + k] != data[begin[lead][kind] + k]).any():
                    raise RuntimeError("two strings have one key")
            total = np.bincount(kind, weights=copies[t])
            again = total[kind] >= 2
            np.maximum.at(first, t[again], o[again])
            low = np.full(len(first), 1 << 30)
            np.minimum.at(low, t[again], o[again])
            last = np.where(low < (1 << 30), np.where(last < 0, low, np.minimum(last, low)), last)
            if len(lonely):
                one = lead[dealt[t[lead]]]
                single.append(np.stack([t[one], o[one], begin[one]], axis=1))
        out = [(self.rows[r][0], self.rows[r][1], int(first[r]), int(last[r])) for r in np.flatnonzero(first >= 0)]
        open_ = ()
        if single:
            t, o, begin = np.concatenate(single).T
            keys = np.array([x[:2] for x in self.rows], np.int64)[t]
            h = np.empty(len(begin), np.uint64)
            slice_of = begin // HASHED
            for k in np.unique(slice_of).tolist():
                own = np.flatnonzero(slice_of == k)
                at = begin[own] - k * HASHED
                h[own] = span_hash(prefix_hash(data[k * HASHED : (k + 1) * HASHED + LENGTH]), at, at + LENGTH)
            two = b"".join(hashlib.blake2b(data[x : x + LENGTH], digest_size=8).digest() for x in begin.tolist())
            open_ = keys[:, 0], keys[:, 1], o.astype(np.int32), h.view(np.int64), np.frombuffer(two, "<i8")
        return out, open_


def _sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort the contexts of whole (core, deal) groups, many groups at a time."""
    names = ["core", "context", "first", "last", "h1", "h2"]

    def flush(pile: _Pile) -> Iterator[pa.RecordBatch]:
        found, open_ = pile.sort() if pile.rows else ([], ())
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        if found:
            columns = [*zip(*found, strict=True), pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)
        if open_:
            core, context, offset, h1, h2 = open_
            columns = [core, context, offset, pa.nulls(len(core), pa.int32()), h1, h2]
            yield from slices(pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names), 20_000)

    pile, group, last = _Pile(), None, None
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("core", "deal", "context", "copies", "shape", "data")]
        for core, deal, context, copies, shape, data in zip(*columns, strict=True):
            if (core, deal, context) == last:
                continue  # a repeated text brings its contexts again
            if (core, deal) != group and pile.symbols >= SORTED:
                yield from flush(pile)
                pile = _Pile()
            group, last = (core, deal), (core, deal, context)
            pile.add(core, context, copies, shape, data, deal >= 0)
    yield from flush(pile)


# ---------------------------------------------------------------- jobs
def _text_key() -> list[Column]:
    """128 bits of a text, from two seeds."""
    return [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")]


_CONTEXT_TYPE = "core long, context long, copies long, shape int, data binary"


def _asked(texts: DataFrame, contexts: DataFrame) -> DataFrame:
    """core, context, copies, shape and data of the contexts, from the texts that
    hold them."""
    asked = checkpoint(contexts.groupBy("t1", "t2").agg(
        F.collect_list(F.struct("core", "context", "copies", "spot")).alias("asked")))  # at most a text's anchors
    keys = small(asked.select("t1", "t2"))
    wanted = texts.join(keys, ["t1", "t2"], "left_semi").dropDuplicates(["t1", "t2"]).join(asked, ["t1", "t2"])
    return wanted.select("text", "asked").mapInArrow(_fetch, _CONTEXT_TYPE)


def _found(data: DataFrame) -> DataFrame:
    """core, context, first and last: what is repeated in each context, by sorting
    the groups (core, deal); a deal from 0 on is one part of a core."""
    tasks = partitions(data.sparkSession)
    told = checkpoint(data.repartition(tasks, "core", "deal").sortWithinPartitions("core", "deal", "context").mapInArrow(
        _sorted, "core long, context long, first int, last int, h1 long, h2 long"))
    # Dealt-out cores: a string of one task may be that of another.
    open_ = told.where("h1 is not null").select("core", "h1", "h2", F.col("first").alias("offset"), "context")
    met = open_.groupBy("core", "h1", "h2", "offset").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    late = open_.join(met, ["core", "h1", "h2", "offset"]).groupBy("core", "context").agg(
        F.max("offset").alias("first"), F.min("offset").alias("last"))
    return told.where("h1 is null").select("core", "context", "first", "last").unionByName(late)


def _found_in_pieces(pieces: DataFrame) -> DataFrame:
    """The same for the contexts (of_core, of_context) that the pieces come from."""
    # Equal pieces have equal bytes, so the first is as good as any.
    distinct = checkpoint(pieces.groupBy("core", "context").agg(
        F.sum("copies").alias("copies"), F.first("shape").alias("shape"), F.first("data").alias("data")))
    kinds = checkpoint(distinct.groupBy("core").agg(F.count(F.lit(1)).alias("kinds")))
    deals = F.when(F.col("kinds") > TOGETHER, F.pmod("context", F.ceil(F.col("kinds") / TOGETHER))).otherwise(-1).cast("int")
    data = distinct.join(kinds, "core").where("kinds > 1 or copies > 1").select(*_CONTEXT, deals.alias("deal"))
    found = _found(data).groupBy("core", "context").agg(F.max("first").alias("first"), F.min("last").alias("last"))
    back = pieces.select("core", "context", "of_core", "of_context").join(found, ["core", "context"])
    return back.select(F.col("of_core").alias("core"), F.col("of_context").alias("context"), "first", "last")


def _spans(rows: DataFrame, contexts: DataFrame, found: DataFrame) -> DataFrame:
    """t1, t2, start and end of what is repeated, for every row.  Rows of a common
    context would all meet in one task; they need no join with ``found``, since
    all strings of a context that comes twice are repeated."""
    keys = ["core", "context"]
    most = max(COMMON, (contexts.agg(F.sum("copies")).first()[0] or 0) // COMMON_KEYS)
    common = F.broadcast(contexts.where(F.col("copies") > most).select(*keys))
    lo, before, span = F.shiftright("spot", 16), F.shiftright("spot", 8).bitwiseAND(255), F.col("spot").bitwiseAND(255)
    whole = rows.join(common, keys, "left_semi").select("t1", "t2", lo.alias("start"), (lo + span + LENGTH).alias("end"))
    return rows.join(common, keys, "left_anti").join(found, keys).select(
        "t1", "t2", (lo + before - F.col("first")).alias("start"), (lo + before - F.col("last") + LENGTH).alias("end")).unionByName(whole)


def repeated(docs: DataFrame) -> DataFrame:
    """t1, t2 (a text's key) and spans: what is repeated in it, as an array of
    (start, end), possibly overlapping."""
    texts = docs.where("text is not null").select(*_text_key(), "text")
    rows = texts.mapInArrow(_scan, "t1 long, t2 long, core long, context long, spot long")
    # A table of its own, so that the join can split a core that many rows have.
    cores = checkpoint(rows.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core"))
    rows = checkpoint(rows.join(cores, "core"))
    # `first` of three columns picks them from one row: none of them is null.
    contexts = rows.groupBy("core", "context").agg(
        F.count(F.lit(1)).alias("copies"), F.first("t1").alias("t1"), F.first("t2").alias("t2"), F.first("spot").alias("spot"))
    contexts = checkpoint(contexts)
    kinds = contexts.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"))
    contexts = contexts.join(kinds, "core")
    alone = contexts.where("kinds = 1 and copies > 1").select(
        "core", "context", (F.shiftright("spot", 8).bitwiseAND(255)).cast("int").alias("first"),
        (F.shiftright("spot", 8).bitwiseAND(255) - F.col("spot").bitwiseAND(255)).cast("int").alias("last"))
    found = _found(_asked(texts, contexts.where(f"kinds > 1 and kinds <= {TOGETHER}")).withColumn("deal", F.lit(-1))).unionByName(alone)
    crowded = contexts.where(f"kinds > {TOGETHER}")
    if not crowded.isEmpty():
        found = found.unionByName(_found_in_pieces(checkpoint(
            _asked(texts, crowded).mapInArrow(_cut, f"{_CONTEXT_TYPE}, of_core long, of_context long"))))
    found = found.groupBy("core", "context").agg(F.max("first").alias("first"), F.min("last").alias("last"))
    return _spans(rows, contexts, found).distinct().groupBy("t1", "t2").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Maximal runs of the union of sorted spans (touching ones are one run)."""
    out: list[list[int]] = []
    for start, end in spans:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 200):
            part, runs, kept, n = batch.slice(k, 200), [], [], []
            for text, spans in zip(part["text"].to_pylist(), part["spans"].to_pylist(), strict=True):
                data = _bytes(text)
                cut = merged([(x["start"], x["end"]) for x in spans or []])
                edges = [0, *(e for run in cut for e in run), len(data)]
                runs.append([{"start": a, "end": b} for a, b in cut])
                kept.append(b"".join(data[edges[j] : edges[j + 1]] for j in range(0, len(edges), 2)))
                n.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(n, pa.int64()), pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "removed", "kept"])


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, removed (the maximal runs, as byte offsets) and kept (the
    bytes that are left), one row for each document."""
    spans = repeated(docs)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_text_key())
    return own.join(spans, ["t1", "t2"], "left").select("doc_id", "text", "spans").mapInArrow(
        _remove, "doc_id long, n_bytes long, removed array<struct<start: long, end: long>>, kept binary")
