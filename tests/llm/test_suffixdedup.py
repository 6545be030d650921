import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from dimweave.llm import common, suffixdedup as sd
from dimweave.llm.queries import QUERIES
from llm_fixtures import docs_of  # noqa: F401


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(1500):
        s = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 40))]
        s = (s * 2 if rng.random() < .3 else s) + [0]
        assert sd.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def brute(rows, length=sd.LENGTH):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for b in texts:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    out = []
    for (doc, _), b in zip(rows, texts, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=repr)


def run(docs):
    got = sd.dedup(docs).collect()
    return sorted(((r.doc_id, r.n_bytes, sum(x.end - x.start for x in r.removed), len(r.removed), hashlib.sha256(r.kept).hexdigest()) for r in got), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choices("abcdefgh äß\n", k=n))
    shared = [text(n) for n in (150, 390, 398, 400, 402, 450, 900, 1500)]
    rows = []
    for doc in range(45):
        parts = []
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a, b = sorted(rng.sample(range(len(s) + 1), 2)) if rng.random() < .4 else (0, len(s))
            s = s[a:b]
            if s and rng.random() < .3:
                k = rng.randrange(len(s))
                s = s[:k] + "Z" + s[k + 1:]
            parts += [text(rng.choice([0, 1, 20, 300])), s]
        rows.append((doc, "".join(parts)))
    return rows


@pytest.mark.parametrize("together", [4096, 12, 3])
def test_equals_brute_force(docs_of, monkeypatch, together):
    monkeypatch.setattr(sd, "TOGETHER", together)
    rows = corpus(together)
    got = run(docs_of(rows))
    assert got == brute(rows) and sum(g[2] for g in got) > 5000


def test_runs_of_one_byte_and_periods(docs_of):
    rows = [(1, "a" * 1000), (2, "ab" * 300 + "c" * 399), (3, "c" * 400), (4, "xyz" * 133 + "x"), (5, "q" * 400), (6, "a" * 401)]
    assert run(docs_of(rows)) == brute(rows)


def test_edge_rows(docs_of):
    long = "".join(random.Random(1).choices("abcdefghij", k=60_000))
    rows = [(1, None), (2, ""), (3, "short"), (3, "short"), (None, long[:500]), (4, long), (5, "é" * 250), (5, "é" * 250), (6, "é" * 199)]
    got = run(docs_of(rows))
    # Only the text of 60,000 bytes is too long for the brute force's table: it loses what it shares.
    want = brute([(d, t if t is not long else long[:1500]) for d, t in rows])
    assert [g for g in got if g[0] != 4] == [w for w in want if w[0] != 4]
    assert [g[1:4] for g in got if g[0] == 4] == [(60_000, 500, 1)]
    assert run(docs_of([])) == []


def test_query_columns(spark):
    got = QUERIES["op10_suffix_dedup"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "holds_repeats"]
    assert got.where("holds_repeats <> (n_removed > 0)").count() == 0
    got = got.drop("holds_repeats")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_a_crowded_core_is_cut_into_pieces(docs_of, monkeypatch):
    """Near copies of one text: a few rows for each context, and no strings that
    look for partners in other tasks."""
    rng = random.Random(8)
    base = "".join(rng.choices("abcdefgh ", k=1500))
    rows = []
    for doc in range(150):
        text = list(base)
        for _ in range(6):
            text[rng.randrange(len(text))] = rng.choice("XYZ")
        rows.append((doc, "".join(text)))
    monkeypatch.setattr(sd, "TOGETHER", 60)
    whole, cut = sd._found, []
    monkeypatch.setattr(sd, "_found", lambda data: cut.append((data.count(), data.where("deal >= 0").count())) or whole(data))
    got = run(docs_of(rows))
    assert got == brute(rows) and sum(g[2] for g in got) > 50_000
    assert len(cut) == 2 and cut[1][0] > 60 and cut[1][1] == 0


def test_rows_of_a_common_context_need_no_join(docs_of, monkeypatch):
    """They would all meet in the one task of their context."""
    rng = random.Random(5)
    text = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    often, twice = text(900), text(700)
    rows = [(doc, text(50) + often + text(50)) for doc in range(60)] + [(100, twice), (101, text(30) + twice), (102, "ab" * 2000)]
    monkeypatch.setattr(sd, "COMMON", 20)
    whole, met = sd._spans, []

    def spans(of, contexts, found):
        hot = contexts.where("copies > 20").select("core", "context")
        free = whole(of, contexts, found.limit(0))
        met.append((of.join(hot, ["core", "context"]).distinct().count(), free.distinct().count(), free.exceptAll(whole(of, contexts, found)).count()))
        return whole(of, contexts, found)

    monkeypatch.setattr(sd, "_spans", spans)
    assert run(docs_of(rows)) == brute(rows)
    assert met[0][0] == met[0][1] > 60 and met[0][2] == 0


def test_strings_of_dealt_out_cores_are_hashed_together(monkeypatch):
    """A pile longer than the kept powers made them anew for each string."""
    rng = random.Random(9)
    shared = rng.randbytes(341)
    data = [rng.randbytes(59) + shared + rng.randbytes(59) for _ in range(600)]
    data[599] = data[0][:40] + rng.randbytes(19) + shared + data[0][400:]
    assert sum(map(len, data)) > common.KEPT_POWERS
    made, whole = [], common._make_powers
    monkeypatch.setattr(common, "_make_powers", lambda n: made.append(n) or (whole(n) if len(made) < 9 else pytest.fail("powers for each string")))
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    rows = [(7, k % 2, k, 1, 59 << 8 | 59, x) for k, x in enumerate(data)]
    rows.sort(key=lambda x: x[1])
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                       names=["core", "deal", "context", "copies", "shape", "data"])
    out = [r for b in sd._sorted(iter([batch])) for r in b.to_pylist()]
    assert not made
    # Contexts 0 and 599 share the string at offset 0 alone, which one of them tells.
    assert [(r["context"], r["first"], r["last"]) for r in out if r["h1"] is None] == [(0, 0, 0), (599, 0, 0)]
    told = {(r["context"], r["first"]): (r["core"], r["h1"], r["h2"]) for r in out if r["h1"] is not None}
    want = {}
    for k, x in enumerate(data):
        p = common.prefix_hash(np.frombuffer(x, np.uint8))
        h = common.span_hash(p, np.arange(60), np.arange(60) + sd.LENGTH).view(np.int64)
        for o in range(60):
            two = int.from_bytes(hashlib.blake2b(x[59 - o : 459 - o], digest_size=8).digest(), "little", signed=True)
            want[k, o] = (7, int(h[59 - o]), two)
    del want[599 if (0, 0) in told else 0, 0]
    assert told == want and len(out) == 2 + 600 * 60 - 1
