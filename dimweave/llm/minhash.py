"""MinHash near-dedup by a multi-index Hamming join.

A document's set are its distinct shingles of five words (A-Z lower-cased).
Equal sets are one class; only a class's first document goes on.  Its
signature has ``SYMBOLS`` minima cut to 16 bits.  Two sets of similarity s
differ in about (1 - s) * SYMBOLS symbols; ``RADIUS`` lies far above what the
threshold allows by chance (4.7 standard deviations), and the signature is cut
into ``CHUNKS`` = (RADIUS + 1) / 2 chunks.  By the pigeonhole principle two
signatures within the radius differ in at most one symbol of some chunk.  Every
such error is enumerated by leaving out one symbol of a chunk at a time, so
equal keys reach all pairs within the radius.

Buckets are never expanded into all pairs:

1. Classes that share no bucket leave.  For the others the shingles that no
   other of them has are counted: they bound every similarity from above,
   which drops classes and pairs exactly.
2. In each bucket every class is held against the one with the fewest such
   shingles (the centre of a group of copies); links are confirmed on full
   sets and merged into components.
3. Classes of one bucket that are still in different components are compared
   with one another only if the bounds and a prefix filter on their rarest
   shingles (both exact) allow a link.

Edge cases: null or empty texts, or texts of white space, have no shingles and
are linked with nothing; fewer than five words are one shingle; repeated rows
come back each; rows without doc_id are returned with a null component and not
linked; rows that share a doc_id but not a text are judged row by row, and
count as one node when both stand for a group; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimweave.llm.common import checkpoint, mix64, sequence_hash, slices, small, word_hashes
from dimweave.llm.graph import components

WIDTH = 5
THRESHOLD = 85  # per cent
SYMBOLS, CHUNKS = 96, 16
RADIUS = 2 * CHUNKS - 1


@dataclass(frozen=True)
class Cut:
    """From what similarity (per cent) sets are linked, and the signature for it."""

    threshold: int = THRESHOLD
    symbols: int = SYMBOLS
    chunks: int = CHUNKS

    @property
    def radius(self) -> int:
        return 2 * self.chunks - 1


#: At 80 per cent sets differ in 20 of 100 symbols on average, and the radius
#: of 39 lies 4.7 standard deviations above that too.
NEAR_80 = Cut(80, 100, 20)

_rng = np.random.default_rng(20)
_A = (_rng.integers(0, 2**32, SYMBOLS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _rng.integers(0, 2**32, SYMBOLS, dtype=np.uint64).astype(np.uint32)
_MORE = NEAR_80.symbols - SYMBOLS  # functions of longer signatures
_A = np.append(_A, (_rng.integers(0, 2**32, _MORE, dtype=np.uint64) | np.uint64(1)).astype(np.uint32))
_B = np.append(_B, _rng.integers(0, 2**32, _MORE, dtype=np.uint64).astype(np.uint32))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = word_hashes(text)
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(sequence_hash(words, min(width, len(words))))


def signature(items: np.ndarray, n: int = SYMBOLS) -> np.ndarray:
    """16-bit symbols of the set's minima under ``n`` hash functions."""
    low = np.full(n, 0xFFFFFFFF, np.uint32)
    h = (items ^ (items >> np.uint64(32))).astype(np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(h), 512):
            x = h[at : at + 512, None] * _A[:n]
            x += _B[:n]
            # A second round: products alone keep low-bit patterns.
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            np.minimum(low, x.min(axis=0), out=low)
    return (mix64(low.astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)


def chunk_keys(symbols: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """For each signature (row), the hash of every chunk with one symbol left out."""
    step = symbols.shape[-1] // chunks
    rows = symbols.reshape(-1, chunks, step).astype(np.uint64)
    out = np.empty((len(rows), chunks, step), np.uint64)
    place = np.arange(chunks, dtype=np.uint64)
    for left_out in range(step):
        key = np.broadcast_to(place * np.uint64(step) + np.uint64(left_out), rows.shape[:2])
        for j in range(step):
            if j != left_out:
                key = mix64((key << np.uint64(16)) ^ (key >> np.uint64(48)) ^ rows[:, :, j])
        out[:, :, left_out] = key
    return out.reshape(len(rows), -1).view(np.int64)


def _digest(cut: Cut):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in slices(batch)):
            n, digest, sig = [], [], []
            for text in part["text"].to_pylist():
                items = shingles(text)
                n.append(len(items))
                digest.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
                sig.append(signature(items, cut.symbols).tobytes() if len(items) else None)
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], part["text_hash"], pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "digest", "sig"])
    return run


def _keys(cut: Cut):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                symbols = np.frombuffer(b"".join(part["sig"].to_pylist()), np.uint16).reshape(-1, cut.symbols)
                keys = chunk_keys(symbols, cut.chunks)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part["node"].to_numpy(), keys.shape[1])), pa.array(keys.ravel())], names=["node", "key"])
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            got = [shingles(t).view(np.int64) for t in part["text"].to_pylist()]
            ends = np.cumsum([0, *map(len, got)])
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array([xxhash.xxh3_128_digest(g.tobytes()) for g in got], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*got, np.zeros(0, np.int64)])))],
                names=["node", "own_digest", "items"])


def _distance(cut: Cut):
    """Keep the pairs whose signatures differ in at most the radius's symbols."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint16).reshape(-1, cut.symbols) for c in ("sig", "other_sig"))
                near = batch.filter(pa.array((a != b).sum(axis=1) <= cut.radius))
                yield pa.RecordBatch.from_arrays([near["a"], near["b"]], names=["a", "b"])
    return run


def _may_link(n: Column, own: Column, n2: Column, own2: Column, threshold: int) -> Column:
    """Whether sets of n and n2 shingles, own and own2 of them found in no other
    set, can be similar enough: the shared ones are at most n - own and
    n2 - own2, and shared + own + own2 are in the union."""
    shared = F.least(n - own, n2 - own2)
    return shared * 100 >= threshold * (n + n2 - shared)


def near_links(reps: DataFrame, docs: DataFrame, cut: Cut = Cut()) -> DataFrame:
    """Links (a, b) that connect every component of the classes ``reps``
    (node, digest, n, sig); ``docs`` has the texts (doc_id, text)."""
    # Buckets that hold at least two classes.
    keys = reps.select("node", "sig").mapInArrow(_keys(cut), "node long, key long")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("key")
    members = checkpoint(keys.join(shared, "key"))
    active = checkpoint(members.select("node").distinct())
    # The full sets of those classes, read again from their documents.
    wanted = reps.select("node", "digest", "n", "sig").join(active, "node")
    texts = docs.join(small(active.withColumnRenamed("node", "doc_id")), "doc_id", "left_semi").select("doc_id", "text")
    sets = texts.mapInArrow(_sets, "node long, own_digest binary, items array<long>")
    sets = checkpoint(sets.join(small(wanted), "node").where("digest = own_digest").select("node", "items").dropDuplicates(["node"]))
    own = (
        sets.select("node", F.explode("items").alias("item")).groupBy("item")
        .agg(F.count(F.lit(1)).alias("in_sets"), F.min("node").alias("node")).where("in_sets = 1")
        .groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    )
    facts = wanted.join(own, "node", "left").select("node", "n", "sig", F.coalesce("own", F.lit(0)).alias("own"))
    facts = checkpoint(facts.where(100 * (F.col("n") - F.col("own")) >= cut.threshold * F.col("n")))
    members = members.join(facts.select("node", "n", "own"), "node")

    def confirm(pairs: DataFrame) -> DataFrame:
        """Of the distinct pairs (a, b), those within the radius and the threshold."""
        sig_a, sig_b = facts.select(F.col("node").alias("a"), "sig"), facts.select(F.col("node").alias("b"), F.col("sig").alias("other_sig"))
        near = pairs.join(sig_a, "a").join(sig_b, "b").mapInArrow(_distance(cut), "a long, b long")
        both = near.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a").join(
            sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
        common = F.size(F.array_intersect("x", "y"))
        return both.where(common * 100 >= cut.threshold * (F.size("x") + F.size("y") - common)).select("a", "b")

    # Round 1: every member of a bucket against its centre.
    centre = members.groupBy("key").agg(
        F.min(F.struct((F.col("own") / F.col("n")).alias("share"), "node", "n", "own")).alias("c"), F.count(F.lit(1)).alias("m")).where("m > 1")
    star = (
        members.join(centre.select("key", "c.node", "c.n", "c.own").toDF("key", "c_node", "c_n", "c_own"), "key")
        .where(F.col("node") != F.col("c_node")).where(_may_link(F.col("n"), F.col("own"), F.col("c_n"), F.col("c_own"), cut.threshold))
        .select(F.least("node", "c_node").alias("a"), F.greatest("node", "c_node").alias("b")).distinct()
    )
    star = checkpoint(star)
    links = checkpoint(confirm(star))
    # Round 2: classes of buckets that hold more than one component.
    comp = components(links)
    placed = members.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    apart = checkpoint(placed.join(mixed, "key").select("node", "n", "own", "component").distinct())
    rest = _apart_pairs(apart, sets, cut.threshold).join(star, ["a", "b"], "left_anti")
    return checkpoint(links.union(confirm(checkpoint(rest))))


def _apart_pairs(apart: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Distinct pairs (a, b) of nodes in different components that can be similar
    enough.

    Take each set's shingles in the order of how few sets have them.  Two sets
    of n and m shingles that are similar enough share n + m times t / (1 + t)
    of them, so their first common one stands far enough ahead in both (prefix
    filter with places, exact).  In a group of copies the first ones are what
    a copy does not share with most others.  For each shingle only the nodes
    outside its largest component look for partners."""
    items = sets.join(apart, "node").select("node", "n", "own", "component", F.explode("items").alias("item"))
    among = items.groupBy("item").agg(F.count(F.lit(1)).alias("in_sets"))
    turn = F.row_number().over(Window.partitionBy("node").orderBy("in_sets", "item"))
    first = items.join(among, "item").withColumn("turn", turn).where(
        (F.col("turn") <= F.col("n") - F.ceil(F.col("n") * threshold / 100) + 1) & (F.col("in_sets") > 1))
    size = apart.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    first = checkpoint(first.join(size, "component").select("item", "node", "n", "own", "component", "turn", "size"))
    main = first.groupBy("item").agg(F.max(F.struct("size", "component")).alias("main"), F.count(F.lit(1)).alias("m")).where("m > 1")
    asks = first.join(main, "item").where("component <> main.component").select(
        "item", "node", "n", "own", "component", "turn", F.col("main.component").alias("largest"))
    other = first.select("item", "node", "n", "own", "component", "turn").toDF("item", "node2", "n2", "own2", "component2", "turn2")
    ahead = 1 + F.least(F.col("n") - F.col("turn"), F.col("n2") - F.col("turn2"))
    return (
        asks.join(other, "item")
        .where("component <> component2 and (component2 = largest or node < node2)")
        .where(ahead * (100 + threshold) >= threshold * (F.col("n") + F.col("n2")))
        .where(_may_link(F.col("n"), F.col("own"), F.col("n2"), F.col("own2"), threshold))
        .select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()
    )


def judged(docs: DataFrame, cut: Cut = Cut()) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and kept of each document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    rows = checkpoint(docs.mapInArrow(_digest(cut), "doc_id long, text_hash long, n_shingles long, digest binary, sig binary"))
    reps = checkpoint(
        rows.where("digest is not null and doc_id is not null").groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")))
    found = components(near_links(reps, docs, cut))
    places = reps.select("digest", "node").join(found, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    return rows.select("doc_id", "text_hash", "n_shingles", "digest").join(places, "digest", "left").select(
        "doc_id", "text_hash", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row for each document."""
    return judged(docs).drop("text_hash")


def keep_one(docs: DataFrame, cut: Cut = Cut()) -> DataFrame:
    """The documents (all their columns) without near-copies of a kept one.
    Documents without shingles or without id stay; of rows that repeat doc_id
    and text one stays."""
    found = judged(docs, cut)
    gone = checkpoint(found.where("not kept and doc_id is not null").select(F.col("doc_id").alias("id__"), F.col("text_hash").alias("hash__")).distinct())
    again = checkpoint(found.where("kept").groupBy(F.col("doc_id").alias("id__"), F.col("text_hash").alias("hash__"))
                       .agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    same = (docs["doc_id"].cast("long") == F.col("id__")) & (F.xxhash64(docs["text"]) == F.col("hash__"))
    left = docs.join(small(gone), same, "left_anti")
    same = (left["doc_id"].cast("long") == F.col("id__")) & (F.xxhash64(left["text"]) == F.col("hash__"))
    once = left.join(small(again), same, "left_anti")
    return once.union(left.join(small(again), same, "left_semi").dropDuplicates(["doc_id", "text"]))
