"""N-gram Jaccard join by vertical partitioning.

A document's set are its distinct shingles of four words (A-Z lower-cased).
Equal sets are one class, and classes are joined, so copies are never expanded.
Two sets are linked if their Jaccard similarity reaches the threshold.

1. *Who can be linked at all.*  The shingles below a fixed hash value (a
   quarter of all; whole short sets) are counted over the classes.  A linked
   class has at most as many shingles in no other class as the threshold leaves
   it, so a class that has more of them already in that quarter leaves.
2. *Global order and fragments.*  The shingles of the classes left are ordered
   by how many classes hold them, rarest first, and the order is cut into
   ``FRAGMENTS`` of about equal weight.  Each class keeps its set cut at the
   same places.
3. *Candidates* meet at the rarest shingles alone: linked sets share one of
   their first few in any global order (prefix filter).  At each shingle all
   classes first meet one centre; classes that are then still in different
   components meet one another, if bounds allow a link.
4. *Partial overlaps.*  A candidate pair's overlap is counted fragment by
   fragment and summed per pair.  A pair leaves as soon as what is counted and
   what the fragments left can still add is too little.

All bounds are exact; shingles are compared by 64-bit hashes and equal sets
found by 128-bit digests.

Edge cases: null or empty texts, or texts of white space, have no shingles and
are linked with nothing; fewer than four words are one shingle; repeated rows
come back each; rows without doc_id are returned with a null component, and
link nothing; rows that share a doc_id but not a text are judged row by row
(classes are numbered, so each text keeps its own links); an empty table gives
no rows; extra columns are ignored; a very long text's set is one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimweave.llm.common import checkpoint, sequence_hash, small, word_hashes
from dimweave.llm.graph import components

WIDTH = 4
THRESHOLD = 85  # per cent
FRAGMENTS = 8
#: Shingles whose hash is below this share of all are counted first, and all
#: shingles of sets of up to SHORT.
SHARE, SHORT = 0.25, 64
_LOW = np.int64(-(2**63) + int(SHARE * 2**64))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct signed 64-bit hashes of the text's shingles."""
    words = word_hashes(text)
    return np.unique(sequence_hash(words, min(width, len(words))).view(np.int64)) if len(words) else np.zeros(0, np.int64)


def _digest(items: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(items.tobytes())


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*values, np.zeros(0, np.int64)])))


def _first_pass(width: int, whole_up_to: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                sets = [shingles(t, width) for t in part["text"].to_pylist()]
                digests = [_digest(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                     pa.array([d and int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64()),
                     _lists([s if len(s) <= whole_up_to else s[: np.searchsorted(s, _LOW)] for s in sets])],
                    names=["doc_id", "n_shingles", "digest", "mark", "low"])
    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                sets = [shingles(t, width) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()), _lists(sets)], names=["digest", "items"])
    return run


def _spare(n: Column, threshold: int) -> Column:
    """How many of a set's n items a linked set may lack at most."""
    return n - F.ceil(n * threshold / 100)


def _least(n: Column, n2: Column, threshold: int) -> Column:
    """The smallest overlap of linked sets of n and n2 items."""
    return F.ceil((n + n2) * threshold / (100 + threshold))


def classes(rows: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """All classes (digest, doc_id: the smallest), and those that may be linked
    (node, digest, doc_id, n), of the first pass's ``rows``."""
    judged = rows.where("digest is not null and doc_id is not null")
    reps = checkpoint(judged.groupBy("digest").agg(F.min("mark").alias("mark"), F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n")))
    # Shingles that one class alone holds: partial minima cut copies down before the shuffle.
    alone = (
        judged.select("mark", F.explode("low").alias("item")).groupBy("item")
        .agg(F.min("mark").alias("mark"), F.max("mark").alias("other")).where("mark = other")
        .groupBy("mark").agg(F.count(F.lit(1)).alias("own"), F.count(F.when(F.col("item") < int(_LOW), 1)).alias("own_low"))
    )
    own = F.coalesce(F.when(F.col("n") <= SHORT, F.col("own")).otherwise(F.col("own_low")), F.lit(0))
    able = reps.where(F.col("n") >= _least(F.col("n"), F.col("n") + 1, threshold))
    left = able.join(alone, "mark", "left").where(own <= _spare(F.col("n"), threshold)).select("digest", "doc_id", "n")
    return reps.select("digest", "doc_id"), checkpoint(left.withColumn("node", F.monotonically_increasing_id()))


def ordered(active: DataFrame, docs: DataFrame, width: int, threshold: int) -> DataFrame:
    """node, n, own (shingles that no other class has), items (the others in the
    global order) and cuts (how many items stand before each fragment's end)."""
    texts = docs.join(small(active.select("doc_id").distinct()), "doc_id", "left_semi").select("text")
    sets = texts.mapInArrow(_sets(width), "digest binary, items array<long>").join(small(active), "digest")
    sets = checkpoint(sets.select("node", "n", "items").dropDuplicates(["node"]))
    single = sets.select("node", F.explode("items").alias("item"))
    # Eight steps for each doubling of the number of classes, so a few hundred at most.
    step = F.floor(8 * F.log2("in_sets")).cast("int")
    among = checkpoint(single.groupBy("item").agg(F.count(F.lit(1)).alias("in_sets")).where("in_sets > 1").withColumn("step", step))
    weights = sorted(map(tuple, among.groupBy("step").agg(F.sum("in_sets")).collect()))
    part = (F.col("item").cast("double") + 2.0**63) / 2.0**64
    place, start, total = F.when(F.lit(False), 0.0), 0, sum(w for _, w in weights)
    for at, weight in weights:
        place = place.when(F.col("step") == at, (float(start) + float(weight) * part) / float(total) * FRAGMENTS)
        start += weight
    fragment = F.least(F.floor(place).cast("int"), F.lit(FRAGMENTS - 1))
    among = checkpoint(among.select("item", "step", fragment.alias("fragment")))
    held = single.join(among, "item").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("fragment", "step", "item"))).alias("shared"))
    cuts = F.transform(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1)), lambda k: F.size(F.filter("shared", lambda x: x["fragment"] <= k)))
    out = sets.select("node", "n").join(held, "node").select(
        "node", "n", (F.col("n") - F.size("shared")).alias("own"), F.col("shared.item").alias("items"), cuts.alias("cuts"))
    return checkpoint(out.where(F.col("own") <= _spare(F.col("n"), threshold)))


def _allowed(threshold: int, bound: Column | None = None) -> Column:
    """Whether (n, own) and (n2, own2) can overlap enough; ``bound``: a further limit."""
    most = F.least(F.col("n") - F.col("own"), F.col("n2") - F.col("own2"))
    return (most if bound is None else F.least(most, bound)) >= _least(F.col("n"), F.col("n2"), threshold)


def linked(pairs: DataFrame, cut: DataFrame, threshold: int) -> DataFrame:
    """Of the distinct pairs (a, b), those that reach the threshold.  Overlaps
    are counted in each fragment apart and summed; after the first ``FRAGMENTS
    // 4`` fragments only the pairs go on that the others can still bring there."""
    first = FRAGMENTS // 4
    parts = checkpoint(cut.select("node", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(FRAGMENTS - 1)),
        lambda k: F.slice("items", F.when(k == 0, 0).otherwise(F.get("cuts", k - 1)) + 1,
                          F.get("cuts", k) - F.when(k == 0, 0).otherwise(F.get("cuts", k - 1))))).alias("fragment", "part"))
        .where(F.size("part") > 0))
    size = cut.select("node", "n", (F.size("items") - F.get("cuts", F.lit(first - 1))).alias("rest"))
    facts = (
        pairs.join(size.toDF("a", "n", "rest"), "a").join(size.toDF("b", "n2", "rest2"), "b")
        .select("a", "b", _least(F.col("n"), F.col("n2"), threshold).alias("need"), F.least("rest", "rest2").alias("rest"))
    )

    def summed(facts: DataFrame, which: Column) -> DataFrame:
        """need, rest and the overlap in the fragments so far."""
        mine, theirs = parts.where(which).toDF("a", "fragment", "part"), parts.where(which).toDF("b", "fragment", "other")
        partial = facts.join(mine, "a").join(theirs, ["b", "fragment"]).select(
            "a", "b", "need", "rest", F.size(F.array_intersect("part", "other")).alias("overlap"))
        return partial.union(facts.select("a", "b", "need", "rest", F.col("overlap") if "overlap" in facts.columns else F.lit(0))).groupBy("a", "b").agg(
            F.max("need").alias("need"), F.max("rest").alias("rest"), F.sum("overlap").alias("overlap"))

    some = checkpoint(summed(facts, F.col("fragment") < first).where("overlap + rest >= need"))
    return summed(some, F.col("fragment") >= first).where("overlap >= need").select("a", "b")


def links(cut: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) that connect every component of the classes ``cut``."""
    ahead = (_spare(F.col("n"), threshold) + 1 - F.col("own")).cast("int")
    members = checkpoint(
        cut.select("node", "n", "own", F.posexplode(F.slice("items", F.lit(1), ahead)).alias("k", "item"))
        .select("item", "node", "n", "own", (F.col("own") + F.col("k") + 1).alias("place")))
    # Round 1: every class against the centre of each of its first shingles.
    centre = checkpoint(
        members.groupBy("item").agg(F.min(F.struct((F.col("own") / F.col("n")).alias("share"), "node", "n", "own")).alias("c"), F.count(F.lit(1)).alias("m"))
        .where("m > 1").select("item", F.col("c.node").alias("node2"), F.col("c.n").alias("n2"), F.col("c.own").alias("own2")))
    star = checkpoint(
        members.join(centre, "item").where("node <> node2").where(_allowed(threshold))
        .select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct())
    found = checkpoint(linked(star, cut, threshold))
    # Round 2: classes that share a first shingle, but no component yet.
    placed = members.join(components(found), "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("item").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("item")
    apart = checkpoint(placed.join(checkpoint(mixed), "item"))
    largest = checkpoint(
        apart.groupBy("item", "component").agg(F.count(F.lit(1)).alias("m")).groupBy("item").agg(F.max(F.struct("m", "component")).alias("most"))
        .select("item", F.col("most.component").alias("largest")))
    asks = checkpoint(apart.join(largest, "item").where("component <> largest"))
    other = apart.toDF(*[c if c == "item" else c + "2" for c in apart.columns])
    bound = 1 + F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))
    rest = (
        asks.join(other, "item").where("component <> component2 and (component2 = largest or node < node2)").where(_allowed(threshold, bound))
        .select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()
    )
    return found.union(linked(checkpoint(rest.join(star, ["a", "b"], "left_anti")), cut, threshold))


def linked_classes(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """One row for each document: doc_id, n_shingles, and component_id, the
    smallest doc_id that links and equal sets reach."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # A short set's largest partners are emitted whole as well.
    whole = -(-SHORT * 100 // threshold)
    rows = checkpoint(docs.mapInArrow(
        _first_pass(width, whole), "doc_id long, n_shingles long, digest binary, mark long, low array<long>"))
    reps, active = classes(rows, threshold)
    cut = ordered(active, docs, width, threshold)
    reached = checkpoint(
        active.join(components(checkpoint(links(cut, threshold))), "node").select("digest", "doc_id", "component"))
    smallest = reached.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    moved = reached.join(smallest, "component").select("digest", "component_id")
    places = checkpoint(reps.join(moved, "digest", "left").select("digest", F.coalesce("component_id", "doc_id").alias("component_id")))
    has_class = F.col("digest").isNotNull() & F.col("doc_id").isNotNull()
    return (
        rows.where(has_class).join(places, "digest").select("doc_id", "n_shingles", "component_id")
        .union(rows.where(~has_class).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    )
