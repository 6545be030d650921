"""Line dedup by a deletion-neighbourhood join.

Lines end at line feeds; their words are the runs of characters other than
space and U+0009 to U+000D, with A-Z lower-cased (all other letters, and white
space such as the no-break space, are as they are).  Two lines are near-equal if
their words can be made equal by inserting, deleting or replacing at most one
word; lines of fewer than ``SHORTEST`` words must be equal.  A line goes if an equal or
near-equal line stands earlier, in the order of doc_id, then of the document's
text (for rows that share an id), then of the lines; blank lines stay.

1. Equal lines meet by a 128-bit digest; only the earliest goes on.
2. Two near-equal lines agree in their first or their last half (by the length
   of the shorter one).  Lines that share such a half with no other line leave:
   an exact filter that spares them the next step.
3. Every other line emits itself and all variants with one word deleted, as
   hashed keys.  Lines that share the variant at one place differ by a
   replacement there; a line that equals another one's variant differs by an
   insertion.  For each key only the earliest line is joined back, so a key
   that many lines share costs one row a line, and the edit distance of each
   such pair is verified on the words.

Edge cases: null or empty texts have no lines; a null doc_id comes last in the
order; rows that repeat doc_id and text have one place and keep the same lines;
lines and texts may be of any length; an empty table gives no rows; extra
columns are ignored, or kept by ``clean``.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import BASE, checkpoint, mix64, partitions, powers, slices, small, word_hashes

SHORTEST = 8
_TWO = struct.Struct("<qq")
_PLACE = ["no_id", "doc_id", "text_hash", "line_no"]


def _lines_of(text: str) -> list[bytes]:
    """Bytes are lower-cased in A-Z alone, and split at space and 09-0D alone."""
    return text.encode("utf-8", "surrogatepass").lower().split(b"\n")


def _prefix(words: np.ndarray) -> np.ndarray:
    """Rolling prefix hashes over word hashes."""
    up, _ = powers(len(words))
    out = np.zeros(len(words) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(words * up[: len(words)], out=out[1:])
    return out


def _run(p: np.ndarray, start, end) -> np.ndarray:
    """Hash of the words [start, end), wherever they stand."""
    _, down = powers(len(p))
    with np.errstate(over="ignore"):
        return (p[end] - p[start]) * down[start]


def _line_hash(words: list[bytes]) -> np.ndarray:
    """One hash for each word (without white space in it)."""
    return word_hashes(b" ".join(words)) if words else np.zeros(0, np.uint64)


def half_keys(lines: list[bytes]) -> list[list[int]]:
    """For each line (its words, one space between them) the keys of its first and last half, for partners of its
    own length, one word longer or one word shorter; none for short lines."""
    n = np.array([line.count(b" ") + 1 for line in lines], np.int64)
    p = _prefix(word_hashes(b" ".join(lines)))
    start = np.cumsum(n) - n
    keys = np.empty((len(lines), 4), np.uint64)
    for c, (h, side) in enumerate(((n // 2, 0), (n // 2, 1), ((n - 1) // 2, 0), ((n - 1) // 2, 1))):
        at = start + side * (n - h)
        keys[:, c] = mix64(_run(p, at, at + h) ^ mix64((2 * h + side).astype(np.uint64)))
    # Of an odd length both kinds of partner have the same halves.  Even places: first halves.
    return [k[: 2 if m % 2 else 4] if m >= SHORTEST else [] for k, m in zip(keys.view(np.int64).tolist(), n.tolist(), strict=True)]


def variant_keys(words: list[bytes]) -> np.ndarray:
    """Key of the line itself, then of the line without word 0, 1, 2 ..."""
    p = _prefix(_line_hash(words))
    n = len(words)
    i = np.arange(n)
    with np.errstate(over="ignore"):
        without = p[i] + (p[n] - p[i + 1]) * np.uint64(pow(BASE, -1, 1 << 64))
    lengths = np.concatenate([[n], np.full(n, n - 1)]).astype(np.uint64)
    return mix64(np.concatenate([[p[n]], without]) ^ mix64(lengths)).view(np.int64)


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether at most one inserted, deleted or replaced word makes a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number, 128-bit digest (in two words) and half keys of every line that has words."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part, rows, split = batch.slice(at, 200), [], []
            for doc, th, text in zip(part["doc_id"].to_pylist(), part["text_hash"].to_pylist(), part["text"].to_pylist(), strict=True):
                for no, line in enumerate(_lines_of(text)):
                    words = b" ".join(line.split())
                    if words:
                        rows.append((doc, th, no, *_TWO.unpack(xxhash.xxh3_128_digest(words))))
                        split.append(words)
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] + [pa.array(half_keys(split), pa.list_(pa.int64()))],
                    names=["doc_id", "text_hash", "line_no", "d1", "d2", "keys"])


def _texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the lines that are asked for."""
    for part in (part for batch in batches for part in slices(batch)):
        out = []
        for doc, th, text, nos in zip(part["doc_id"].to_pylist(), part["text_hash"].to_pylist(), part["text"].to_pylist(), part["nos"].to_pylist(), strict=True):
            lines = _lines_of(text)
            out += [(doc is None, doc, th, no, b" ".join(lines[no].split()).decode("utf-8", "surrogatepass")) for no in nos]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.string()), strict=True)],
                names=[*_PLACE, "words"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The line itself (left_out -1) and its variants.  A line that shares its
    first half with others differs from them behind it, and so on; only words
    of the part where a difference can be are left out."""
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            part, left, keys = batch.slice(at, 100), [], []
            for words, head, tail in zip(part["words"].to_pylist(), part["head"].to_pylist(), part["tail"].to_pylist(), strict=True):
                own = variant_keys(words.encode("utf-8", "surrogatepass").split(b" "))
                n = len(own) - 1
                place = np.arange(-1, n)
                on = (place < 0) | (head & (place >= (n - 1) // 2)) | (tail & (place < n - (n - 1) // 2))
                left.append(place[on])
                keys.append(own[on])
            if keys:
                rows = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
                yield pa.RecordBatch.from_arrays(
                    [part["at"].take(rows), pa.array(np.concatenate(left), pa.int32()), pa.array(np.concatenate(keys))], names=["at", "left_out", "key"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = [within_one(a.split(" "), b.split(" ")) for a, b in zip(batch["words"].to_pylist(), batch["other"].to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch["at"].filter(pa.array(good, pa.bool_()))], names=["at"])


def _place() -> Column:
    return F.struct(*_PLACE)


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash"))


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, gone: the numbers (from 0) of the lines that go."""
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    lines = checkpoint(texts.mapInArrow(_lines, "doc_id long, text_hash long, line_no int, d1 long, d2 long, keys array<long>"))
    again = lines.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d1", "d2")
    repeats = checkpoint(lines.drop("keys").join(again, ["d1", "d2"]).select(
        "d1", "d2", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "line_no").alias("place")))
    first = repeats.groupBy("d1", "d2").agg(F.min("place").alias("first"))
    equal = repeats.join(first, ["d1", "d2"]).where(F.col("place") > F.col("first")).select("place")
    near = checkpoint(_near(texts, lines))
    gone = equal.union(near.select(_place())).union(repeats.join(near.select("d1", "d2"), ["d1", "d2"]).select("place"))
    return gone.select("place.*").groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("line_no")).alias("gone"))


def _near(texts: DataFrame, lines: DataFrame) -> DataFrame:
    """The place, d1 and d2 of the distinct lines that have a near-equal earlier one."""
    halves = lines.select("doc_id", "text_hash", "line_no", "d1", "d2", F.posexplode("keys").alias("side", "key"))
    # Halves that different lines share.
    shared = halves.groupBy("key").agg(F.min("d1").alias("lo"), F.max("d1").alias("hi")).where("lo <> hi").select("key")
    members = halves.join(small(checkpoint(shared)), "key").withColumn("no_id", F.col("doc_id").isNull())
    even = F.col("side") % 2 == 0
    asked = checkpoint(members.groupBy("d1", "d2").agg(F.min(_place()).alias("place"), F.max(even).alias("head"), F.max(~even).alias("tail"))
                       .select("place.*", "d1", "d2", "head", "tail"))
    by_text = checkpoint(asked.groupBy("doc_id", "text_hash").agg(F.collect_list("line_no").alias("nos")))
    got = texts.alias("t").join(small(by_text, values="nos").alias("a"), _same("t", "a")).select("t.doc_id", "t.text_hash", "t.text", "a.nos")
    words = got.mapInArrow(_texts_of, "no_id boolean, doc_id long, text_hash long, line_no int, words string").dropDuplicates(_PLACE)
    found = words.alias("w").join(asked.alias("a"), _same("w", "a") & (F.col("w.line_no") == F.col("a.line_no"))).select(
        "w.no_id", "w.doc_id", "w.text_hash", "w.line_no", "w.words", "a.d1", "a.d2", "a.head", "a.tail")
    # One number for each line that keeps the order of the places.
    found = found.repartitionByRange(partitions(texts.sparkSession), *_PLACE).sortWithinPartitions(*_PLACE)
    found = checkpoint(found.withColumn("at", F.monotonically_increasing_id()))
    rows = found.select("at", "words", "head", "tail").mapInArrow(_variants, "at long, left_out int, key long")
    least = rows.groupBy("key", "left_out").agg(F.min("at").alias("least"), F.max("at").alias("most"))
    by_key = least.groupBy("key").agg(
        F.min(F.when(F.col("left_out") < 0, F.col("least"))).alias("whole"), F.min(F.when(F.col("left_out") >= 0, F.col("least"))).alias("variant"))
    # Keys without a second line leave here.
    target = least.join(by_key, "key").select(
        "key", "left_out", "most", F.when(F.col("left_out") < 0, F.col("variant")).otherwise(F.least("least", F.coalesce("whole", "least"))).alias("earlier"))
    target = target.where("earlier < most").drop("most")
    pairs = rows.join(target, ["key", "left_out"]).where("earlier < at").select("at", "earlier").distinct()
    both = pairs.join(found.select("at", "words"), "at").join(found.select(F.col("at").alias("earlier"), F.col("words").alias("other")), "earlier")
    sure = both.select("at", "words", "other").mapInArrow(_verify, "at long").distinct()
    return found.join(sure, "at").select(*_PLACE, "d1", "d2")


def _joined(docs: DataFrame) -> DataFrame:
    gone = small(checkpoint(removed_lines(docs)), values="gone")
    return docs.withColumn("text_hash__", F.xxhash64("text")).alias("t").join(
        gone.alias("g"), F.col("t.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("t.text_hash__") == F.col("g.text_hash")), "left")


def _kept() -> Column:
    lines = F.split("t.text", "\n")
    kept = F.filter(F.transform(lines, lambda x, i: F.when(~F.array_contains("g.gone", i), x)), lambda x: x.isNotNull())
    return F.when(F.col("g.gone").isNull(), F.col("t.text")).otherwise(F.array_join(kept, "\n"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the text that is left, one row for each
    document (a null text stays null and has no lines)."""
    return _joined(docs).select(
        "t.doc_id", F.when(F.col("t.text").isNull(), 0).otherwise(F.size(F.split("t.text", "\n"))).alias("n_lines"),
        F.coalesce(F.size("g.gone"), F.lit(0)).alias("n_removed"), _kept().alias("text"))


def clean(docs: DataFrame) -> DataFrame:
    """The documents (all their columns) without the lines that go; n_chars, if
    there, follows the text.  A document of which nothing is left goes too."""
    out = _joined(docs).withColumn("kept__", _kept()).where(F.col("g.gone").isNull() | (F.trim(F.col("kept__")) != ""))
    columns = []
    for f in docs.schema:
        own = F.col(f"t.`{f.name}`")
        if f.name == "text":
            own = F.col("kept__")
        elif f.name == "n_chars":
            own = F.when(F.col("g.gone").isNull(), own).otherwise(F.length("kept__").cast(f.dataType))
        columns.append(own.alias(f.name))
    return out.select(*columns)
