"""Language identification: sparse multinomial logistic regression.

Features are character n-grams (1 to 3 letters, words bounded by blanks),
hashed into ``FEATURES`` cells and weighted by TF-IDF.  Document frequencies
come from every training document; the weights are fitted with
follow-the-regularised-leader (elastic net) on a bounded sample of labelled
documents, and a temperature fitted on held-back rows of that sample
calibrates the scores.  The model is a fixed-size table, whatever the input.

Edge cases: a null text, or one without a letter, gets ``und`` with score 0;
rows with a null lang are never learned from; without any labelled text every
prediction is ``und``; whole texts count, however long; repeated rows are
predicted one by one; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimweave.llm.common import BROADCAST_ROWS, checkpoint, mix64, slices

FEATURES = 1 << 14
ORDERS = (1, 2, 3)
#: The classifier is fitted on at most this many documents of each language,
#: and at most this many in all; document frequencies cover all of them.
PER_LANGUAGE = 1000
SAMPLE = 8000
SPARE = 4
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """For each code point of the basic plane: its lower-case letter, or a blank."""
    table = np.full(0x10000, 0x20, np.uint16)
    for c in range(0x10000):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


_TABLE = _letters()


def ngrams(text: str | None) -> np.ndarray:
    """Feature cells of the text's n-grams, with repetitions; empty if it has no letter."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    # Beyond the basic plane letters count as themselves, the rest as blanks.
    if len(points) and points.max() >= 0x10000:
        high = np.unique(points[points >= 0x10000])
        points = np.where(np.isin(points, [c for c in high.tolist() if not chr(c).isalpha()]), 0x20, points)
    chars = np.where(points < 0x10000, _TABLE[np.minimum(points, 0xFFFF)], points).astype(np.uint64)
    if not len(chars) or not (chars != 0x20).any():
        return np.zeros(0, np.int64)
    chars = np.concatenate([[np.uint64(0x20)], chars, [np.uint64(0x20)]])
    keep = np.ones(len(chars), bool)
    keep[1:] = (chars[1:] != 0x20) | (chars[:-1] != 0x20)
    chars = chars[keep]
    out = []
    for n in ORDERS:
        m = len(chars) - n + 1
        if m <= 0:
            continue
        key = np.full(m, n, np.uint64)
        for j in range(n):
            key = (key << np.uint64(20)) ^ chars[j : j + m]
        key = key[chars[:m] != 0x20] if n == 1 else key
        out.append((mix64(key) >> np.uint64(64 - 14)).astype(np.int64) % FEATURES)
    return np.concatenate(out)


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature cells of the text and how often each occurs."""
    dense = np.bincount(ngrams(text), minlength=FEATURES)
    cells = np.flatnonzero(dense)
    return cells, dense[cells]


def weigh(cells: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Sublinear TF times IDF, scaled to length 1."""
    x = (1 + np.log(n)) * idf[cells]
    return x / max(np.sqrt((x * x).sum()), 1e-12)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    """Languages, IDF, weights (features x languages), offsets, temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray
    temperature: float = 1.0
    info: dict = field(default_factory=dict)

    def predict(self, text: str | None) -> tuple[str, float]:
        cells, n = counts(text)
        if not len(cells) or not self.languages:
            return UNKNOWN, 0.0
        p = _softmax((weigh(cells, n, self.idf) @ self.weights[cells] + self.offsets) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, epochs: int = 3,
             alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Follow-the-regularised-leader with per-coordinate rates; L1 keeps
    coordinates at exactly zero until their gradients add up, L2 shrinks."""
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))  # the last row: offsets

    def lead(c):
        zc = z[c]
        return np.where(np.abs(zc) <= l1, 0.0, (np.sign(zc) * l1 - zc) / ((beta + np.sqrt(n[c])) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            cells = np.append(rows[i][0], FEATURES)
            x = np.append(rows[i][1], 1.0)
            w = lead(cells)
            p = _softmax(x @ w)
            p[labels[i]] -= 1.0
            g = x[:, None] * p[None, :]
            z[cells] += g - (np.sqrt(n[cells] + g * g) - np.sqrt(n[cells])) / alpha * w
            n[cells] += g * g
    w = lead(np.arange(FEATURES + 1))
    return w[:-1], w[-1]


def fit_temperature(z: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search on its
    logarithm.  One row's worth of even odds is added to the labels, so that a
    sample without errors does not ask for certainty."""
    if not len(z):
        return 1.0
    n, k = z.shape
    want = (np.eye(k)[labels] * n + 1 / k) / (n + 1)

    def loss(t: float) -> float:
        return float(-(want * np.log(np.maximum(_softmax(z / math.exp(t)), 1e-300))).sum(axis=1).mean())

    lo, hi, g = math.log(0.02), math.log(50), (math.sqrt(5) - 1) / 2
    while hi - lo > 1e-3:
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, docs = np.zeros(FEATURES, np.int64), 0
    for part in (part for batch in batches for part in slices(batch)):
        for text in part["text"].to_pylist():
            seen = np.zeros(FEATURES, bool)
            seen[ngrams(text)] = True
            total += seen
            docs += bool(seen.any())
    cells = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(cells, -1), pa.int32()), pa.array(np.append(total[cells], docs), pa.int64())],
                                     names=["cell", "df"])


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in (part for batch in batches for part in slices(batch)):
        got = [counts(t) for t in part["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part["lang"], part["draw"], pa.array([c.astype("<i4").tobytes() for c, _ in got], pa.binary()),
             pa.array([n.astype("<i4").tobytes() for _, n in got], pa.binary())],
            names=["lang", "draw", "cells", "counts"])


def train(labelled: DataFrame) -> Model:
    """Fit the model on doc_id, text, lang; rows without text or lang are skipped."""
    rows = labelled.select("doc_id", "text", "lang").where("lang is not null and text is not null")
    df = rows.select("text").mapInArrow(_frequencies, "cell int, df long").groupBy("cell").agg(F.sum("df")).collect()
    freq = np.zeros(FEATURES, np.int64)
    docs = 0
    for cell, n in df:  # at most FEATURES + 1 rows
        if cell < 0:
            docs = n
        else:
            freq[cell] = n
    idf = np.log((1 + docs) / (1 + freq)) + 1
    # A draw by hash, the same however the rows are laid out.  Only draws below
    # a bound that lets some SPARE times the sample pass are ranked, so that a
    # language with most of the rows does not meet in one task.
    share = rows.groupBy("lang").agg((F.lit(float(SPARE * PER_LANGUAGE)) / F.count(F.lit(1))).alias("share"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    chosen = (
        rows.select("doc_id", "lang", F.xxhash64("doc_id", F.lit("language sample")).alias("draw")).join(share, "lang")
        .where(F.col("draw") / 2.0**64 + 0.5 <= F.col("share")).select("doc_id", "lang", "draw").distinct().withColumn("turn", turn)
        .where(F.col("turn") <= PER_LANGUAGE).orderBy("turn", "lang").limit(SAMPLE).select("doc_id", "lang", "draw")
    )
    assert SAMPLE <= BROADCAST_ROWS
    # A doc_id on several rows would bring them all: one of each is enough.
    sample = (
        rows.join(F.broadcast(checkpoint(chosen)), ["doc_id", "lang"])
        .select("lang", "draw", "text").mapInArrow(_sample_features, "lang string, draw long, cells binary, counts binary")
        .dropDuplicates(["draw", "lang"]).orderBy("draw", "lang").limit(SAMPLE).collect()
    )
    got = [(r.lang, np.frombuffer(r.cells, "<i4"), np.frombuffer(r.counts, "<i4")) for r in sample]
    got = [(lang, c, weigh(c, n, idf)) for lang, c, n in got if len(c)]
    languages = sorted({g[0] for g in got})
    labels = np.array([languages.index(g[0]) for g in got], np.int64)
    rows_ = [(c, x) for _, c, x in got]
    held = np.arange(len(rows_)) % 5 == 4 if len(rows_) >= 20 else np.zeros(len(rows_), bool)
    fit, cal = np.flatnonzero(~held), np.flatnonzero(held)
    if not languages:
        return Model([], idf, np.zeros((FEATURES, 0)), np.zeros(0))
    w, b = fit_ftrl([rows_[i] for i in fit], labels[fit], len(languages))
    z = np.array([rows_[i][1] @ w[rows_[i][0]] + b for i in cal])
    model = Model(languages, idf, w, b, fit_temperature(z, labels[cal]))
    model.info = {"documents": int(docs), "sample": len(rows_), "zero_weights": float((w == 0).mean())}
    return model


def _predict(shared, out: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in (part for batch in batches for part in slices(batch)):
            got = [model.predict(t) for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=[*part.schema.names, *out])
    return run


def predict(docs: DataFrame, model: Model, carry: list[str], out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns of ``carry`` (text must be one of them) with the language and
    its score, under the names ``out``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.select(*carry)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema)
    return own.mapInArrow(_predict(shared, out), f"{schema}, `{out[0]}` string, `{out[1]}` double")


def held_out(doc_id: Column) -> Column:
    """True for the third of the documents that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
