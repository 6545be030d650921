"""Exact top-k search on a bit-sliced index.

The index holds blocks of vectors.  In a block every component is quantised to
at most ``BITS`` bits and stored as bit slices: one bitmap over the block's
rows for each (dimension, bit).  For a query, the slices are added with the
weights of its components by carry-save bitmap arithmetic, which gives the bit
slices of every row's quantised score.  A walk from the most significant slice
downward finds the k-th largest quantised score; all rows that the rounding
could still lift to it (the boundary) are resolved exactly by their integer
inner products.  Query blocks meet index blocks in a salted equi-join; only
each block's k best rows go on to the final ranking.

Every component x counts as floor(1024 * x), x as a double.

Edge cases: vectors that are null, empty or hold null or non-finite components
take no part, nor do rows without an id; vectors meet only vectors of their
length; ties go to the smaller id; a query's own id is never its result;
several rows with one id are each a candidate, and equal query rows are asked
once; an empty table gives no rows; extra columns are ignored.  Components so
large that a score could leave 62 bits raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimweave.llm.common import checkpoint, partitions

SCALE = 1024
BITS = 8
#: Components in one index block or query block (rows = cells / dimension).
CELLS = 1 << 20
_BLOCK = "dim int, n int, ids binary, cells binary, mark binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of quantised vectors of one dimension; ``mark`` tells equal ids apart."""
    kept: dict[int, list[tuple]] = {}

    def block(dim: int) -> pa.RecordBatch:
        rows = kept.pop(dim)
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([len(rows)], pa.int32())]
            + [pa.array([np.array(c, t).tobytes()], pa.binary()) for c, t in zip(zip(*rows, strict=True), ("<i8", "<i8", "<i8"), strict=True)],
            names=["dim", "n", "ids", "cells", "mark"],
        )

    for batch in batches:
        for vec, mark, x in zip(batch["vec_id"].to_pylist(), batch["mark"].to_pylist(), batch["embedding"].to_pylist(), strict=True):
            if not x or None in x:
                continue
            x = np.array(x, np.float64)
            if not np.isfinite(x).all():
                continue
            cells = np.floor(SCALE * x)
            if np.abs(cells).max() ** 2 * len(x) >= 2.0**62:
                raise ValueError(f"vec_id {vec}: its scores could leave 62 bits")
            rows = kept.setdefault(len(x), [])
            rows.append((vec, cells.astype(np.int64), mark))
            if len(rows) * len(x) >= CELLS:
                yield block(len(x))
    for dim in list(kept):
        yield block(dim)


class SlicedBlock:
    """Bit slices of one block of integer vectors (rows x dim)."""

    def __init__(self, cells: np.ndarray):
        self.cells, (n, dim) = cells, cells.shape
        self.low = int(cells.min())
        self.shift = max(0, (int(cells.max()) - self.low).bit_length() - BITS)
        high = (cells - self.low) >> self.shift
        self.bits = max(1, int(high.max()).bit_length())
        self.words = -(-n // 64)
        planes = np.zeros((dim, self.bits, self.words * 8), np.uint8)
        for b in range(self.bits):
            packed = np.packbits(((high >> b) & 1).astype(np.uint8).T, axis=1, bitorder="little")
            planes[:, b, : packed.shape[1]] = packed
        planes = planes.reshape(dim * self.bits, -1).view(np.uint64)
        self.planes = np.concatenate([planes, ~planes])  # the second half serves negative weights

    def scores(self, query: np.ndarray) -> list[np.ndarray]:
        """Bit slices, least significant first, of sum |q| * (q < 0 ? top - u : u)."""
        weight, dim = np.abs(query), len(query)
        first = np.arange(dim) * self.bits + np.where(query < 0, dim * self.bits, 0)
        columns: list[list[np.ndarray]] = [[] for _ in range(int(weight.max()).bit_length() + self.bits)]
        for t in range(int(weight.max()).bit_length()):
            on = first[(weight >> t) & 1 == 1]
            for b in range(self.bits):
                columns[t + b].append(on + b)
        out, carried = [], []
        j = 0
        while j < len(columns) or carried:
            own = [self.planes[np.concatenate(columns[j])]] if j < len(columns) and columns[j] else []
            stack = np.concatenate(own + carried) if own or carried else np.zeros((1, self.words), np.uint64)
            carried = []
            while len(stack) > 1:
                if len(stack) == 2:
                    carried.append(stack[:1] & stack[1:])
                    stack = stack[:1] ^ stack[1:]
                    break
                m = len(stack) // 3
                a, b, c = stack[:m], stack[m : 2 * m], stack[2 * m : 3 * m]
                half = a ^ b
                carried.append((a & b) | (half & c))
                stack = np.concatenate([half ^ c, stack[3 * m :]])
            out.append(stack[0] if len(stack) else np.zeros(self.words, np.uint64))
            j += 1
        return out

    def top(self, query: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
        """Rows (of those in the bitmap) that may be among the k best."""
        if int(np.bitwise_count(allowed).sum()) <= k or not query.any():
            rows = allowed
        else:
            slices = self.scores(query)
            sure, open_, kth = np.zeros_like(allowed), allowed, 0
            for j in range(len(slices) - 1, -1, -1):
                high = open_ & slices[j]
                if int(np.bitwise_count(sure | high).sum()) >= k:
                    open_, kth = high, kth | 1 << j
                else:
                    sure, open_ = sure | high, open_ & ~slices[j]
            slack = int(np.abs(query).sum()) * ((1 << self.shift) - 1) >> self.shift
            rows, equal, least = np.zeros_like(allowed), allowed, max(0, kth - slack)
            for j in range(len(slices) - 1, -1, -1):
                if least >> j & 1:
                    equal = equal & slices[j]
                else:
                    rows, equal = rows | (equal & slices[j]), equal & ~slices[j]
            rows = rows | equal
        return np.flatnonzero(np.unpackbits(rows.view(np.uint8), bitorder="little"))


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block = None, None
        for batch in batches:
            for row in batch.to_pylist():
                dim, n = row["dim"], row["n"]
                ids = np.frombuffer(row["ids"], "<i8")
                if last != row["ids"] or block.cells.shape != (n, dim):
                    last, block = row["ids"], SlicedBlock(np.frombuffer(row["cells"], "<i8").reshape(n, dim))
                elif not np.array_equal(block.cells, np.frombuffer(row["cells"], "<i8").reshape(n, dim)):
                    block = SlicedBlock(np.frombuffer(row["cells"], "<i8").reshape(n, dim))
                everyone = np.packbits(np.arange(block.words * 64) < n, bitorder="little").view(np.uint64)
                queries = np.frombuffer(row["query_cells"], "<i8").reshape(-1, dim)
                out: list[np.ndarray] = []
                for q, qid, mark in zip(queries, np.frombuffer(row["query_ids"], "<i8"), np.frombuffer(row["query_mark"], "<i8"), strict=True):
                    allowed = everyone
                    own = np.flatnonzero(ids == qid)
                    if len(own):
                        allowed = everyone.copy()
                        np.bitwise_and.at(allowed, own // 64, ~(np.uint64(1) << (own % 64).astype(np.uint64)))
                    rows = block.top(q, allowed, k)
                    score = block.cells[rows] @ q
                    best = np.lexsort((ids[rows], -score))[:k]
                    out.append(np.stack([np.full(len(best), qid), np.full(len(best), mark), ids[rows][best], score[best]]))
                if out:
                    found = np.concatenate(out, axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["query_id", "mark", "vec_id", "score"])
    return run


def build_index(vectors: DataFrame) -> DataFrame:
    """The blocks: dim, n, ids, cells (and mark, a hash of each vector)."""
    rows = vectors.where("vec_id is not null and embedding is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.xxhash64("embedding").alias("mark"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(_blocks, _BLOCK)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of every query row
    (vec_id, embedding) among all vectors with another id."""
    spark = vectors.sparkSession
    # Checkpointed: the blocks of a second run need not hold the same rows.
    asked = checkpoint(build_index(queries.dropDuplicates(["vec_id", "embedding"])).select(
        "dim", F.col("ids").alias("query_ids"), F.col("cells").alias("query_cells"), F.col("mark").alias("query_mark"),
        F.xxhash64("dim", "ids", "mark").alias("query_block")))
    names = [tuple(r) for r in asked.select("dim", "query_block").distinct().collect()]  # one for a million query components
    by_dim: dict[int, list[int]] = {}
    for dim, name in names:
        by_dim.setdefault(dim, []).append(name)
    salts = max(1, partitions(spark) // max(1, len(names)))
    meets = spark.createDataFrame([(d, v) for d, v in by_dim.items()], "dim int, query_block array<long>")
    index = (
        build_index(vectors).withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(salts)))
        .join(F.broadcast(meets), "dim").withColumn("query_block", F.explode("query_block"))
    )
    pairs = index.drop("mark").join(
        asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>"))), ["dim", "query_block", "salt"])
    found = pairs.mapInArrow(_search(k), "query_id long, mark long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
